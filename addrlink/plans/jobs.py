"""Whole runs: one job for each group of states, skipped where done; reports as JSON and Markdown; column notes."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..operators.region import states_of

DONE, STARTED = "_DONE", "_STARTED"


def run_jobs(groups: dict[str, str], out: str, job: Callable[[tuple[str, ...], str], None], only: Iterable[str] = (), force: bool = False, dry_run: bool = False) -> dict[str, str]:
    """Run ``job(states, folder)`` for each named group; returns what became of each.

    A finished group is skipped unless forced. A group that was started and not
    finished is blocked until forced, so that half-written tables are not added to.
    """
    wanted, result = set(only), {}
    for name, states in groups.items():
        at = os.path.join(out, name)
        if wanted and name not in wanted:
            continue
        if os.path.exists(f"{at}/{DONE}") and not force:
            result[name] = "done before"
        elif os.path.exists(f"{at}/{STARTED}") and not force:
            result[name] = "needs wiping"
        elif dry_run:
            result[name] = "would run"
        else:
            os.makedirs(at, exist_ok=True)
            for mark in (DONE, STARTED):
                if os.path.exists(f"{at}/{mark}"):
                    os.remove(f"{at}/{mark}")
            open(f"{at}/{STARTED}", "w").close()
            job(states_of(states), at)
            os.replace(f"{at}/{STARTED}", f"{at}/{DONE}")
            result[name] = "done"
    return result


def write_json(report: DataFrame, path: str) -> dict:
    """A histogram table (kind, value, n) as one JSON object of objects."""
    out: dict[str, dict[str, int]] = {}
    for r in report.orderBy("kind", "value").collect():
        out.setdefault(r["kind"], {})[r["value"]] = r["n"]
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, ensure_ascii=False, indent=1, sort_keys=True)
    return out


def markdown(title: str, table: DataFrame, most: int = 200) -> str:
    """The first rows of a report table as Markdown."""
    names = table.columns
    lines = [f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "-|" * len(names)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in table.limit(most).collect()]
    return "\n".join(lines) + "\n"


def column_notes(tables: dict[str, StructType]) -> str:
    """Positional columns of @ tables, numbered from 0."""
    return "\n".join(f"{name}\n" + "\n".join(f"  {n} {f.name}" for n, f in enumerate(schema)) for name, schema in tables.items()) + "\n"
