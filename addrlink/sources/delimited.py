"""@ tables: scans with stable ordinals, row text, fixed-size shards with a manifest."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import row_text

MANIFEST = "MANIFEST.json"


def resolve_paths(folder: str, key: str) -> list[str]:
    """Files of a dataset: its shard folder in manifest order, else the flat file, else a name that differs in case, else none."""
    at = os.path.join(folder, key)
    if os.path.isdir(at):
        for top, _, names in sorted(os.walk(at)):
            if MANIFEST in names:
                with open(os.path.join(top, MANIFEST), encoding="utf-8") as f:
                    return [os.path.join(top, s["file"]) for s in json.load(f)["shards"]]
        return sorted(os.path.join(top, n) for top, _, names in os.walk(at) for n in names if n.lower().endswith(".txt"))
    flat = os.path.join(folder, f"{key}.TXT")
    if os.path.exists(flat):
        return [flat]
    if os.path.isdir(folder):
        return [os.path.join(folder, n) for n in sorted(os.listdir(folder)) if n.lower() == f"{key}.txt".lower()]
    return []


def exists(folder: str, key: str) -> bool:
    return bool(resolve_paths(folder, key))


UNIT = 1 << 16  # bytes; Spark's splits are longer, and 2**30 units (64 TiB in all files) fit an ordinal


def _plain(path: str) -> str:
    return os.path.abspath(path.removeprefix("file://"))


def read(spark: SparkSession, paths: list[str], schema: StructType, encoding: str = "UTF-8") -> DataFrame:
    """Rows with ``ord``, which follows file order and line order; short rows are padded with nulls, nulls are ''.

    Files are read in parallel; the ordinal comes from the file's place in ``paths``
    and the row's place in its split, so it needs no sort of the data.
    """
    if not paths:
        return spark.createDataFrame([], schema).withColumn("ord", F.lit(0).cast("long"))
    raw = spark.read.csv(paths, sep="@", quote="", encoding=encoding, schema=schema, mode="PERMISSIVE", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    # units before each file: split starts lie further apart than one, so a split's place is its file's plus its own
    units = [os.path.getsize(p) // UNIT + 1 for p in paths]
    place = F.create_map(*(x for n, p in enumerate(paths) for x in (F.lit(_plain(p)), F.lit(sum(units[:n])))))
    keyed = raw.select("*", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    number = F.element_at(place, F.regexp_replace("_f", "^file:/*", "/")).cast("long")
    # file, then split, then row: a running number within each split is enough to order rows
    within = F.col("_m").bitwiseAND((1 << 33) - 1)
    out = keyed.withColumn("ord", F.shiftleft(number + F.floor(F.col("_b") / UNIT), 33) + within)
    return out.select(*(F.coalesce(F.col(f.name), F.lit("")).alias(f.name) for f in schema), "ord")


def dense(df: DataFrame, order: str = "ord") -> DataFrame:
    """A gapless row number from 0, where one is needed."""
    return df.withColumn("nth", F.row_number().over(Window.orderBy(order)) - 1)


def write(df: DataFrame, path: str, columns: list[str], partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Rows as text lines, a folder for each value of ``partition_by``."""
    keys = partition_by or []
    out = df.select(row_text(*columns).alias("value"), *keys)
    writer = out.write.mode(mode)
    (writer.partitionBy(*keys) if keys else writer).text(path)


def write_shards(df: DataFrame, folder: str, key: str, columns: list[str], lines: int, order: str = "ord") -> dict:
    """``lines`` rows a file in row order, as 000001.txt and so on, with a manifest.

    Row numbers are counted a range partition at a time; each shard is written by
    one task from its own rows.
    """
    text = df.select(row_text(*columns).alias("value"), F.col(order).alias("o")).repartitionByRange("o").sortWithinPartitions("o").withColumn("p", F.spark_partition_id()).persist()
    sizes = {r["p"]: r["n"] for r in text.groupBy("p").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]
    out = os.path.join(folder, key, f"{lines}-linhas")
    os.makedirs(out, exist_ok=True)
    if total:
        start = F.element_at(F.create_map(*(x for p, n in before.items() for x in (F.lit(p), F.lit(n)))), F.col("p"))
        nth = start + F.row_number().over(Window.partitionBy("p").orderBy("o")) - 1
        numbered = text.withColumn("nth", nth).withColumn("shard", F.floor(F.col("nth") / lines).cast("int"))
        tmp = os.path.join(out, "_tmp")
        numbered.repartition("shard").sortWithinPartitions("shard", "nth").select("value", "shard").write.mode("overwrite").partitionBy("shard").text(tmp)
        for n in range(-(-total // lines)):
            (part,) = [f for f in os.listdir(f"{tmp}/shard={n}") if f.startswith("part-")]
            os.replace(f"{tmp}/shard={n}/{part}", f"{out}/{n + 1:06d}.txt")
        import shutil

        shutil.rmtree(tmp)
    text.unpersist()
    shards = [{"file": f"{n + 1:06d}.txt", "lines": min(lines, total - n * lines), "line_from": n * lines + 1, "line_to": min(total, (n + 1) * lines)} for n in range(-(-total // lines))]
    manifest = {"dataset_key": key, "shard_lines": lines, "shard_dir": f"{lines}-linhas", "complete": True, "total_lines": total, "shard_count": len(shards), "shards": shards}
    with open(os.path.join(out, MANIFEST), "w", encoding="utf-8") as f:
        json.dump(manifest, f, indent=1)
    return manifest
