"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised to words; every window of ten consecutive words
(an item of fewer words is one window) is a pattern of one automaton. Each
document is normalised the same way and scanned once; ends of matches map to
words, and words to code points of the original text.

The benchmark side is the only thing sent to executors, in blocks of at most
``block_chars`` characters of normalised text. A benchmark within one block
takes one scan; a larger one is scanned block by block and the blocks' hits are
merged by document, so no broadcast grows with the data.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, runs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {65 + i: 97 + i for i in range(26)}
COLUMNS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


def windows(item: list[str], k: int) -> list[str]:
    """Patterns of one item, each with a space at both ends."""
    return [f" {' '.join(item[i : i + k])} " for i in range(max(1, len(item) - k + 1))] if item else []


def automaton(block: list[tuple[str, list[str]]], k: int):
    """Patterns to (words of the pattern, numbers of the items that have it)."""
    import ahocorasick

    by: dict[str, tuple[int, set[int]]] = {}
    for n, (_, item) in enumerate(block):
        for w in windows(item, k):
            by.setdefault(w, (w.count(" ") - 1, set()))[1].add(n)
    out = ahocorasick.Automaton()
    for w, (size, items) in by.items():
        out.add_word(w, (size, tuple(sorted(items))))
    if by:
        out.make_automaton()
    return out if by else None


def blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[str, list[str]]]]:
    """Items (id as string, words) in blocks of bounded size, streamed from the executors in item order."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    for row in rows.toLocalIterator():
        item = words(row["text"])
        if item:
            block.append((row["item"], item))
            size += 10 * sum(map(len, item)) + 200
            if size >= block_chars:
                yield block
                block, size = [], 0
    yield block


def scan(text: str | None, search, k: int) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, merged word intervals that are hit, numbers of the items found."""
    found = words(text)
    if not found or search is None:
        return len(found), [], set()
    line = f" {' '.join(found)} "
    ends, items = [], set()
    for end, (size, numbers) in search.iter(line):
        ends.append((end, size))
        items.update(numbers)
    if not ends:
        return len(found), [], items
    word_end, at = {}, 0  # position of the space after each word -> number of words up to there
    for n, w in enumerate(found, 1):
        at += len(w) + 1
        word_end[at] = n
    return len(found), merge([(word_end[end] - size, word_end[end]) for end, size in ends]), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def original(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points of the original text that word intervals cover, first to last word."""
    at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


def digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = 10, block_chars: int = 20_000_000, with_spans: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): words, hit words, items whose windows occur in it.

    Null or empty text has no words and no hits. Items without words have no
    windows; items that share an id count once. A null item_id is the empty
    string, a null doc_id stays null. Repeated rows come out as often as they came
    in; empty tables give no rows or no hits. ``with_spans`` adds the hit spans of
    the original text as a string start:end, comma-joined (code points).
    """
    spark = docs.sparkSession
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = COLUMNS + ", spans string" * with_spans
    parts = list(_first_two(blocks(benchmark, block_chars)))
    if len(parts) > 1:
        return _by_blocks(one, benchmark, k, block_chars, with_spans)
    sent = spark.sparkContext.broadcast(parts[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = automaton(sent.value, k)
        names = [x[0] for x in sent.value]
        for batch in (part for whole in batches for part in runs(whole, 1)):
            rows = []
            for text in batch.column(1).to_pylist():
                n, spans, items = scan(text, search, k)
                hit = {names[i] for i in items}
                row = (n, sum(b - a for a, b in spans), len(hit), digest(hit), bool(spans))
                rows.append((*row, ",".join(f"{a}:{b}" for a, b in original(text, spans)) if spans else "") if with_spans else row)
            yield _batch(batch.column(0), rows, schema)

    return one.mapInArrow(run, schema)


def _batch(ids, rows, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * (len(fields) - 1)
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields[1:], strict=True))], names=[n for n, _ in fields])


def _first_two(parts):
    for n, part in enumerate(parts):
        yield part
        if n:
            return


def _hits(keyed: DataFrame, benchmark: DataFrame, k: int, block_chars: int) -> DataFrame:
    """(key, spans, items) of the rows (key, text) that hold a window, from one scan for each block of the benchmark."""
    spark, found = keyed.sparkSession, None
    for part in blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast(part)

        def run(batches, sent=sent):
            search = automaton(sent.value, k)
            for batch in (part for whole in batches for part in runs(whole, 1)):
                keys, spans_of, items_of = [], [], []
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    _, spans, items = scan(text, search, k)
                    if spans:
                        keys.append(key)
                        spans_of.append([x for s in spans for x in s])
                        items_of.append(sorted({sent.value[i][0] for i in items}))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(spans_of, pa.list_(pa.int64())), pa.array(items_of, pa.list_(pa.string()))], names=["key", "spans", "items"])

        hits = materialize(keyed.select("key", "text").mapInArrow(run, "key long, spans array<long>, items array<string>"), "hits")
        sent.unpersist()
        found = hits if found is None else found.unionByName(hits)
    return found


def _by_blocks(one: DataFrame, benchmark: DataFrame, k: int, block_chars: int, with_spans: bool) -> DataFrame:
    """A benchmark of many blocks: hits of the blocks merged by row."""
    schema = COLUMNS + ", spans string" * with_spans
    # rows that are equal in id and text have equal results, so this key may stand for all of them
    keyed = one.withColumn("key", F.xxhash64("doc_id", "text"))
    found = _hits(keyed, benchmark, k, block_chars)
    by_key = found.distinct().groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def finish(batches):
        for batch in batches:
            rows = []
            for text, flat, items in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                spans = merge(list(zip(flat[::2], flat[1::2], strict=True))) if flat else []
                row = (len(words(text)), sum(b - a for a, b in spans), len(items or []), digest(items or []), bool(spans))
                rows.append((*row, ",".join(f"{a}:{b}" for a, b in original(text, spans)) if spans else "") if with_spans else row)
            yield _batch(batch.column(0), rows, schema)

    return keyed.join(by_key, "key", "left").select("doc_id", "text", "spans", "items").mapInArrow(finish, schema)


def drop(docs: DataFrame, benchmark: DataFrame, k: int = 10, block_chars: int = 20_000_000) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; columns are unchanged, null and wordless texts stay."""
    parts = list(_first_two(blocks(benchmark, block_chars)))
    if len(parts) > 1:
        name = fresh("_key", docs.columns)
        keyed = docs.withColumn(name, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
        hit = _hits(keyed.select(F.col(name).alias("key"), F.col("text").cast("string").alias("text")), benchmark, k, block_chars).select("key").distinct()
        return keyed.join(hit, keyed[name] == hit["key"], "left_anti").select(*docs.columns)
    sent = docs.sparkSession.sparkContext.broadcast(parts[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = automaton(sent.value, k)
        for batch in (part for whole in batches for part in runs(whole, "text")):
            texts = batch.column(batch.schema.names.index("text")).to_pylist()
            yield batch.filter(pa.array([not scan(t, search, k)[1] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
