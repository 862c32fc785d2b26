"""Removal of word windows that occur more than once, by recompression.

Each text is parsed in rounds. A round first names every run of equal symbols by
(symbol, length), then gives each symbol a side by its name and names every
left-right pair anew. A name is a function of what it names, so names agree over
the whole corpus; with each symbol goes the least word interval that decides it
(its own words, and the neighbours that end its runs or do not pair with it).
Equal windows hold equal symbols at equal places wherever they hold their whole
intervals: the consistent interior symbols.

A window's anchor is the least of its interior symbols of the highest round that
has any; round 0, the words, always has. Only anchors that occur twice are looked
at further:

1. anchors carry ``f``, the name of the symbol and of its interval, and ``g``, 128
   bits of all words of all windows that they serve; one shuffle counts symbols with
   partial sums, so a passage that a third of all texts share is no hot key;
2. where all anchors of a symbol agree in ``g``, all their windows are repeated;
3. else one anchor for each distinct ``g`` is opened: its windows are compared by
   128 bits of their words, which verifies them.

Texts are shuffled once, by a hash of the row, and once more where anchors are opened.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, sieve, tidy
from .tokens import U, Words, mix, signed, slices

COLUMNS = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class Symbols(NamedTuple):
    """Symbols of one round in text order: names, first words, and the word intervals [low, high) that decide them."""

    name: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


def rounds_for(window: int) -> int:
    """Rounds after which a symbol is usually decided by half a window: each leaves about three symbols of four."""
    out, around, size = 0, 0.0, 1.0
    while around + 4 * size + size / 0.75 <= window / 2 + 2:
        around, size, out = around + 4 * size, size / 0.75, out + 1
    return max(1, out)


def parse(words: Words, rounds: int) -> list[Symbols]:
    """The symbols of every round, words first."""
    text = words.text()
    before, after = words.first[text] - 1, words.first[text + 1] + 1  # beyond the text: no window holds them
    at = np.arange(words.n)
    out = [Symbols(words.hash, at, at, at + 1)]
    for level in range(1, rounds + 1):
        name, at, low, high = out[-1]
        if not len(at):
            break
        doc = text[at]
        # runs of equal symbols; where one ends shows in its neighbours
        new = np.r_[True, (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])]
        head = np.flatnonzero(new)
        size = np.diff(np.r_[head, len(at)])
        tail = head + size - 1
        low, high = _beside(low, high, head, tail, doc, before[at], after[at])
        name, at, doc = name[head], at[head], doc[head]
        name = np.where(size > 1, mix(name + mix(size.astype(U) + U(level << 40))), name)
        # pairs of a left and a right symbol; one that does not pair is decided by the neighbour that it might have paired with
        left = mix(name ^ U(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> U(63) == 0
        pair = np.r_[left[:-1] & ~left[1:] & (doc[:-1] == doc[1:]), False]
        second = np.r_[False, pair[:-1]]
        near_low, near_high = _beside(low, high, np.arange(len(at)), np.arange(len(at)), doc, before[at], after[at])
        joined = mix(name + U(level) + mix(np.r_[name[1:], U(0)] ^ U(0xD1B54A32D192ED03)))
        low = np.where(pair | left, low, near_low)
        high = np.where(pair, np.r_[high[1:], 0], np.where(left, near_high, high))
        name = np.where(pair, joined, name)
        out.append(Symbols(name[~second], at[~second], low[~second], high[~second]))
    return out


def _beside(low, high, head, tail, doc, before, after) -> tuple[np.ndarray, np.ndarray]:
    """Intervals of the runs head..tail of symbols with the symbols next to them; at a text's ends, beyond it."""
    prior, later = np.maximum(head - 1, 0), np.minimum(tail + 1, len(doc) - 1)
    inner = (head > 0) & (doc[prior] == doc[head])
    outer = (tail < len(doc) - 1) & (doc[later] == doc[tail])
    return np.where(inner, low[prior], before[head]), np.where(outer, high[later], after[tail])


def least(value: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each range first[i]:end[i] (not empty) the first place of its least value."""
    power = np.frexp((end - first).astype(float))[1] - 1
    best, out = np.arange(len(value)), np.empty(len(first), np.int64)
    for p in range(int(power.max()) + 1 if len(power) else 0):
        if p:
            k = 1 << p - 1
            other = best[k:]
            mine = best[: len(other)]
            best = np.where(value[mine] <= value[other], mine, other)
        i = np.flatnonzero(power == p)
        a, b = best[first[i]], best[end[i] - (1 << p)]
        out[i] = np.where(value[a] <= value[b], a, b)
    return out


def anchors(words: Words, window: int, rounds: int | None = None) -> tuple[np.ndarray, ...]:
    """For each anchor: its word, symbol name, two hashes of all it serves, first window served, number of windows."""
    start = words.window_starts(window)
    if not len(start):
        empty = np.zeros(0, np.int64)
        return empty, empty.view(U), empty.view(U), empty.view(U), empty, empty
    levels = parse(words, rounds or rounds_for(window))
    place, name = np.empty(len(start), np.int64), np.empty(len(start), U)
    todo = np.arange(len(start))
    for level in range(len(levels) - 1, -1, -1):
        if not len(todo):
            break
        of, s = levels[level], start[todo]
        # intervals begin and end in the order of the symbols
        count = np.bincount(np.maximum(of.low, 0) + (of.low >= 0), minlength=words.n + 2)
        first = np.cumsum(count)[s]
        end = np.cumsum(np.bincount(of.high, minlength=words.n + 2))[s + window]
        has = end > first
        k = least(of.name, first[has], end[has])
        place[todo[has]] = of.at[k]
        decided = words.spans(of.low[k], of.high[k])
        name[todo[has]] = mix(of.name[k] + U(level) ^ mix(decided + (of.at[k] - of.low[k]).astype(U)))
        todo = todo[~has]
    new = np.r_[True, (place[1:] != place[:-1]) | (name[1:] != name[:-1]) | (start[1:] != start[:-1] + 1)]
    p, first, f = place[new], start[new], name[new]
    count = np.diff(np.r_[np.flatnonzero(new), len(start)])
    shape = mix((p - first).astype(U) * U(1 << 32) + count.astype(U))
    g, h = (mix(words.spans(first, first + count + window - 1, second) ^ shape) for second in (False, True))
    return p, f, g, h, first, count


def _rows(docs: DataFrame) -> DataFrame:
    """Rows with a key of 128 bits: rows of one key are equal in id and text, so they have equal results."""
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return one.withColumn("key", F.xxhash64("doc_id", "text")).withColumn("key2", F.xxhash64(F.lit(7), "text", "doc_id"))


def removals(rows: DataFrame, window: int = 35) -> DataFrame:
    """Word intervals to remove, by key, for keyed rows."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, keys2 = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for at, part in slices(batch.column(2)):
                words = Words(part)
                p, f, g, h, first, count = anchors(words, window)
                doc = np.searchsorted(words.first, p, "right") - 1
                cols = [signed(f), signed(g), signed(h), keys[at + doc], keys2[at + doc], (first - words.first[doc]).astype(np.int32), count.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["f", "g", "h", "key", "key2", "start", "count"])
        tidy()

    found = materialize(rows.select("key", "key2", "text").mapInArrow(find, "f long, g long, h long, key long, key2 long, start int, count int"), "anchors")
    mixed = (F.min("g") != F.max("g")) | (F.min("h") != F.max("h"))
    twice = materialize(found.groupBy("f").agg(F.count("*").alias("n"), mixed.alias("mixed")).where("n > 1").drop("n"), "twice")
    shared = materialize(sieve(found, "f", twice).join(twice, "f"), "shared")
    whole = shared.where("not mixed").select("key", "key2", "start", (F.col("start") + F.col("count") + window - 1).alias("end"))

    mixed = shared.where("mixed")
    by_g = mixed.groupBy("f", "g", "h").agg(F.count("*").alias("n"), F.min(F.struct("key", "key2", "start", "count")).alias("one"))
    opened = by_g.select("one.key", "one.key2", F.struct("f", "g", "h", F.col("one.start").alias("start"), F.col("one.count").alias("count")).alias("anchor")).groupBy("key", "key2").agg(F.collect_list("anchor").alias("anchors"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            for at, part in slices(batch.column(0)):
                words = Words(part)
                mine = lists.slice(at, len(part))
                doc = np.repeat(np.arange(len(part)), np.asarray(mine.value_lengths()))
                flat = mine.flatten()
                f, g, h, start, count = (np.asarray(flat.field(k)) for k in range(5))
                which = np.repeat(np.arange(len(start)), count)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                s = words.first[doc[which]] + start[which] + nth
                cols = [f[which], g[which], h[which], nth.astype(np.int32), signed(words.spans(s, s + window)), signed(words.spans(s, s + window, second=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["f", "g", "h", "nth", "w1", "w2"])
        tidy()

    # a row that is there twice sends its windows twice; they are repeated anyway
    opened = materialize(opened, "opened")
    opened_texts = sieve(rows, "key", opened).join(opened, ["key", "key2"]).select("text", "anchors")
    windows = materialize(opened_texts.mapInArrow(compare, "f long, g long, h long, nth int, w1 long, w2 long"), "windows")
    again = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    nths = windows.join(again, ["w1", "w2"], "left_semi").groupBy("f", "g", "h").agg(F.collect_set("nth").alias("nths"))
    all_of = F.sequence(F.lit(0), F.col("one.count") - 1)
    known = by_g.join(nths, ["f", "g", "h"], "left").select("f", "g", "h", F.when(F.col("n") > 1, all_of).otherwise(F.col("nths")).alias("nths")).where("nths is not null")
    known = materialize(known, "known")  # both sides of the join are then dealt by it, and a hot symbol can be split
    partly = mixed.join(known, ["f", "g", "h"]).select("key", "key2", F.explode(F.transform("nths", lambda i: F.col("start") + i)).alias("start")).select("key", "key2", "start", (F.col("start") + window).alias("end"))
    return whole.unionByName(partly).groupBy("key", "key2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def kept_words(words: Words, gone: np.ndarray) -> list[bytes]:
    """Each text's words that are not gone, joined by one space."""
    text = words.text()
    start, size = words.start[~gone], (words.end - words.start)[~gone] + 1
    to = np.cumsum(size)
    at = np.arange(int(to[-1]) if len(to) else 0) + np.repeat(start - (to - size), size)
    line = words.data[np.minimum(at, max(len(words.data) - 1, 0))]
    line[to - 1] = 32
    line = line.tobytes()
    edge = np.r_[0, to][np.searchsorted(text[~gone], np.arange(len(words.first)))].tolist()
    return [line[a : max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def dedup(docs: DataFrame, window: int = 35, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): words, removed words, digest of the kept ones.

    Null and empty texts have no words. Texts of fewer than ``window`` words keep
    all. Repeated rows are texts of their own, so all their windows are repeated.
    Any window of one word or more will do. A null doc_id stays null; an empty
    table gives no rows; other columns are not read. Of a very long text memory
    is proportional to it, in one task. ``with_text`` adds the kept words joined
    by one space.
    """
    rows = _rows(docs)
    spans = removals(rows, window)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            for at, part in slices(batch.column(1)):
                words, mine = Words(part, hashes=False), lists.slice(at, len(part))
                per = np.asarray(mine.value_lengths().fill_null(0))
                flat = mine.flatten()
                base = np.repeat(words.first[:-1], per)
                edge = np.bincount(base + np.asarray(flat.field(0)), minlength=words.n + 1) - np.bincount(base + np.asarray(flat.field(1)), minlength=words.n + 1)
                gone = np.cumsum(edge[: words.n]) > 0
                n = np.diff(words.first)
                removed = np.bincount(words.text()[gone], minlength=len(part))
                kept = kept_words(words, gone)
                data = [batch.column(0).slice(at, len(part)), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                yield pa.RecordBatch.from_arrays(data + [pa.array([x.decode("utf-8") for x in kept], pa.string())] * with_text, names=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text)
        tidy()

    return rows.join(spans, ["key", "key2"], "left").select("doc_id", "text", "spans").mapInArrow(finish, COLUMNS + ", kept string" * with_text)
