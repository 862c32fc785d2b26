"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over each whole text and stops only at anchors:
at-signs, plus signs, digits, schemes and identifier cues. Around an anchor a
deterministic parser walks outwards over the characters its kind allows, never
past the end of the span before it, and validates what it has walked over.

Base kinds (always): email, ip, card, phone. Added kinds: url (scheme://...),
secret (a value of at least 16 letters and digits after an identifier cue) and
account (IBAN with a right check number after its country and check digits).
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "secret", "account")

#: Schemes and identifier cues, lower case.
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "iban", "account", "ssn")

LOWER = {65 + i: 97 + i for i in range(26)}
DIGITS = frozenset("0123456789")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
PHONE = frozenset(" ().0123456789-")
_chain = re.compile(r"[0-9](?:[ -]?[0-9])*").match
_labels = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_phone = re.compile(r"[ ().0-9-]*").match
_digits = re.compile(r"[0-9]+").match
_url = re.compile(r"[^\s\"'<>]+").match
_value = re.compile(r"[\s=:\"']{1,6}([A-Za-z0-9_/+-]{16,})").match
_iban = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}").match

COLUMNS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_url long, n_secret long, n_account long"


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[::-2]))
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def iban_ok(raw: str) -> bool:
    raw = raw.replace(" ", "")
    return 15 <= len(raw) <= 34 and int("".join(str(int(c, 36)) for c in raw[4:] + raw[:4])) % 97 == 1


def anchors():
    """The automaton; its values say which parser an anchor starts."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for word, kind in [("@", "@"), ("+", "+"), *((d, "0") for d in "0123456789"), *((s, "u") for s in SCHEMES), *((c, "c") for c in CUES)]:
        out.add_word(word, (kind, len(word)))
    out.make_automaton()
    return out


class Parser:
    def __init__(self):
        self.automaton = anchors()

    def __call__(self, text: str) -> dict[str, list[tuple[int, int]]]:
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        end = dict.fromkeys((*KINDS, "cue"), 0)
        number = address = 0  # ends of the digit chain and of the dotted chain last walked
        # letters A-Z are anchors in any case; offsets stay, since only they are lowered
        for last, (kind, size) in self.automaton.iter(text.translate(LOWER)):
            at = last + 1 - size
            if kind == "0":
                if at >= number:
                    number = self._card(text, at, found)
                if at >= address:
                    address = self._ip(text, at, found)
            elif kind == "@":
                self._email(text, at, found, end)
            elif kind == "+":
                self._phone(text, at, found)
            elif kind == "u":
                if at >= end["url"] and (m := _url(text, at)) and m.end() > last + 1:
                    found["url"].append((at, m.end()))
                    end["url"] = m.end()
            elif last + 1 > end["cue"]:
                end["cue"] = last + 1
                self._cue(text, last + 1, found, end)
        return found

    @staticmethod
    def _card(text: str, at: int, found) -> int:
        """A chain of digits with single separators, walked once from its first digit."""
        to = _chain(text, at).end()
        if to - at >= 16:
            digits = text[at:to].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append((at, to))
        return to

    @staticmethod
    def _ip(text: str, at: int, found) -> int:
        """A chain of digit runs with single dots: every four runs are one candidate."""
        runs, to = [], at
        while m := _digits(text, to):
            runs.append((to, m.end()))
            to = m.end()
            if text[to : to + 1] != ".":
                break
            to += 1
        for k in range(0, len(runs) - 3, 4):
            four = [text[a:b].lstrip("0") for a, b in runs[k : k + 4]]
            if all(len(x) <= 3 and int(x or "0") <= 255 for x in four):
                found["ip"].append((runs[k][0], runs[k + 3][1]))
        return runs[-1][1]

    @staticmethod
    def _email(text: str, at: int, found, end) -> None:
        domain = _labels(text, at + 1)
        if not domain:
            return
        start, floor = at, end["email"]
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            found["email"].append((start, domain.end()))
            end["email"] = domain.end()

    @staticmethod
    def _phone(text: str, at: int, found) -> None:
        if text[at + 1 : at + 2] not in DIGITS or at + 1 >= len(text):
            return
        to = _phone(text, at + 2).end()
        while to > at + 2 and text[to - 1] not in DIGITS:
            to -= 1
        if to >= at + 4 and 8 <= sum(c in DIGITS for c in text[at:to]) <= 15:
            found["phone"].append((at, to))

    @staticmethod
    def _cue(text: str, at: int, found, end) -> None:
        if m := _value(text, at):
            if m.start(1) >= end["secret"] and any(c in DIGITS for c in m[1]):
                found["secret"].append(m.span(1))
                end["secret"] = m.end(1)
        start = at
        while start < len(text) and start < at + 6 and text[start] in " =:\"'":
            start += 1
        if start >= end["account"] and (m := _iban(text, start)):
            raw = m[0]
            while len(raw) >= 15 and not iban_ok(raw):
                raw = raw[:-1].rstrip()
            if len(raw) >= 15:
                found["account"].append((start, start + len(raw)))
                end["account"] = start + len(raw)


def joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


_held: list[Parser] = []


def parser() -> Parser:
    if not _held:
        _held.append(Parser())
    return _held[0]


def find(docs: DataFrame) -> DataFrame:
    """Spans of every row of ``docs`` (doc_id, text), one row out for each row in.

    Null text is empty; an empty text has no spans and the digest of the empty
    string; repeated rows come out as often as they came in; a null doc_id stays
    null; an empty table gives no rows. Other columns are not read. Text is walked
    once, in time linear in its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = parser()
        for batch in (part for whole in batches for part in runs(whole, 1)):
            rows = [parse(t) if t else {k: [] for k in KINDS} for t in batch.column(1).to_pylist()]
            cols = [batch.column(0)]
            cols += [pa.array([len(r[k]) for r in rows], pa.int64()) for k in BASE]
            cols.append(pa.array([hashlib.sha256(joined(r, BASE).encode()).hexdigest() for r in rows], pa.string()))
            cols.append(pa.array([joined(r, KINDS) for r in rows], pa.string()))
            cols += [pa.array([len(r[k]) for r in rows], pa.int64()) for k in KINDS[4:]]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in COLUMNS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, COLUMNS)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of its text replaced by the kind in angle brackets; all columns and rows stay.

    Overlapping spans are masked as one, named after the first. Null text stays
    null. A column n_chars gets the new number of code points where text changed.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = parser()
        for batch in (part for whole in batches for part in runs(whole, "text")):
            k = batch.schema.names.index("text")
            before = batch.column(k).to_pylist()
            texts = [masked(t, parse(t)) if t else t for t in before]
            batch = batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))
            if "n_chars" in batch.schema.names:
                j = batch.schema.names.index("n_chars")
                sizes = [n if a is b else len(b) for n, a, b in zip(batch.column(j).to_pylist(), before, texts, strict=True)]
                batch = batch.set_column(j, batch.schema.field(j), pa.array(sizes, batch.schema.field(j).type))
            yield batch

    return docs.select(*names).mapInArrow(run, docs.schema)


def masked(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    spans = sorted((a, -b, k) for k, v in found.items() for a, b in v)
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{k}>"]
        at = max(at, -b)
    return "".join([*out, text[at:]]) if spans else text
