"""Language-model scores of documents: subword lattices, and a unigram base over the same training rows.

Pass 1 (training rows) gathers expected piece counts under the vocabulary's own
weights and re-estimates the weights; counts of all tasks are summed by piece, so
the driver gets one row a piece. Pass 2 scores every row and also writes, for each
run of texts and each hash bucket of words, one compact block of (word hash, text,
count). Blocks meet by bucket, where word counts of all training rows are summed
and turned into each text's part of the base score; parts then meet by run. No
word row of its own is ever shuffled; the number of buckets follows the corpus, so
no block or bucket grows with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import pack, unpack
from .common import materialize, partitions, tidy
from .langid import remainder
from .lattice import vocabulary
from .tokens import U, Words, mix, slices

RUN_BYTES = 3_000_000
BUCKET_BYTES = 32_000_000  # of training texts whose words a bucket holds, on average
CACHE_WORDS = 200_000
LONGEST = 2000  # longer words are learned from one by one
COLUMNS = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(words.hash, return_index=True, return_inverse=True)


def learn(rows: DataFrame, vocabulary_path: str) -> tuple[np.ndarray, float]:
    """Natural-log weights of the pieces and of the end mark, one EM step from the vocabulary's own weights."""
    return _learned(rows, vocabulary_path)[:2]


def _learned(rows: DataFrame, vocabulary_path: str) -> tuple[np.ndarray, float, float]:
    """What ``learn`` gives, and the bytes learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(vocabulary_path)
        counts, ends, size = np.zeros(len(voc.pieces)), 0, 0
        for batch in batches:
            ends += len(batch)
            for _, part in slices(batch.column(0), RUN_BYTES):
                size += part.nbytes
                words = Words(part, lower=True)
                _, one, where = distinct(words)
                times = np.bincount(where.reshape(-1), minlength=len(one)).astype(float)
                for group, chars in voc.groups(words, one):
                    if chars.shape[1] > LONGEST:  # memory of the pass over all rows at once grows with the word
                        for g, c in zip(group, chars, strict=True):
                            voc.expected_long(c, voc.first, times[g], counts)
                    else:
                        voc.expected(chars, voc.first, times[group], counts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *at.tolist()], pa.int32()), pa.array([float(ends), float(size), *counts[at].tolist()], pa.float64())], names=["piece", "n"])
        tidy()

    got = rows.where("not held_out").select("text").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    voc = vocabulary(vocabulary_path)
    counts, ends, size = np.exp(voc.first) * 100.0, 1.0, 0.0
    for r in got:
        if r["piece"] == -1:
            ends += r["n"]
        elif r["piece"] == -2:
            size = r["n"]
        else:
            counts[r["piece"]] += r["n"]
    total = counts.sum() + ends
    return np.log(counts / total), float(np.log(ends / total)), size


def _pack(kind: int, bucket: int, run: int, *arrays: np.ndarray) -> tuple[int, int, int, bytes]:
    return kind, bucket, run, pack(*arrays)


BLOCK = (np.uint64, np.uint32, np.uint16, np.uint16)  # word hashes, entries of each, texts (twice their number, plus one in training rows), counts
PARTS = (np.uint16, np.float64, np.uint32)  # texts, their gains, their known tokens
MOST_TEXTS = 30_000


def _runs(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    for at, part in slices(texts, RUN_BYTES):
        for k in range(0, len(part), MOST_TEXTS):
            yield at + k, part.slice(k, MOST_TEXTS)


def score(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text), learning from those whose remainder by 10 is not 0.

    Null text is empty: one end token. Rows with equal ids count each on its own;
    a null id has the remainder of the empty text (0, held out). With no training
    rows N and V are 0 and the weights are the vocabulary's own. An empty table
    gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(10) == 0).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    weights, end, learned = _learned(rows, vocabulary_path)
    sent = spark.sparkContext.broadcast(weights)  # one weight a piece of the vocabulary file
    buckets = max(partitions(spark), int(learned // BUCKET_BYTES) + 1)  # a worker holds the words of one bucket

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, logp = vocabulary(vocabulary_path), sent.value
        cache: dict[int, float] = {}
        run = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, part in _runs(batch.column(2)):
                words = Words(part, lower=True)
                keys, one, where = distinct(words)
                where, n = where.reshape(-1), len(part)
                known = np.fromiter(map(cache.get, keys.tolist(), iter(lambda: np.nan, 0)), float, len(keys))
                if len(new := np.flatnonzero(np.isnan(known))):
                    known[new] = voc.log10(words, one[new], logp)
                    if len(cache) > CACHE_WORDS:
                        cache.clear()
                    cache.update(zip(keys[new].tolist(), known[new].tolist(), strict=True))
                text = words.text()
                total = np.bincount(text, known[where], n) + end / np.log(10.0)
                size = np.diff(words.first)
                ids = batch.column(0).slice(at, n)
                held = np.asarray(batch.column(1).slice(at, n).to_numpy(zero_copy_only=False), bool)
                out = [_pack(1, -1, run, np.asarray(ids.fill_null(0)), np.asarray(ids.is_null().to_numpy(zero_copy_only=False), np.uint8), held.astype(np.uint8), size.astype(np.int64), total)]
                # entries (word, text) with counts, words in the order of their buckets and hashes
                bucket = (keys >> U(40)) % U(buckets)
                place = np.argsort(bucket, kind="stable")
                rank = np.empty(len(keys), np.int64)
                rank[place] = np.arange(len(keys))
                entry, times = np.unique(rank[where] * n + text, return_counts=True)
                word, doc = entry // max(n, 1), entry % max(n, 1)
                times = np.minimum(times, 65_535) if not len(times) or times.max() <= 65_535 else times
                if len(times) and times.max() > 65_535:  # a count over 16 bits is dealt over entries
                    more = (times + 65_534) // 65_535
                    rest = times - (more - 1) * 65_535
                    word, doc = np.repeat(word, more), np.repeat(doc, more)
                    last = np.cumsum(more) - 1
                    times = np.full(len(word), 65_535)
                    times[last] = rest
                cut = np.searchsorted(bucket[place], np.arange(buckets + 1, dtype=U))
                edge = np.searchsorted(word, cut)
                per = np.bincount(word, minlength=len(keys)).astype(np.uint32)
                doc = doc * 2 + ~held[doc]
                for b in range(buckets):
                    if cut[b] < cut[b + 1]:
                        e = slice(edge[b], edge[b + 1])
                        out.append(_pack(0, b, run, keys[place[cut[b] : cut[b + 1]]], per[cut[b] : cut[b + 1]], doc[e].astype(np.uint16), times[e].astype(np.uint16)))
                run += 1
                yield _rows(out)
        cache.clear()
        tidy()

    blocks = materialize(rows.mapInArrow(read, "kind int, bucket int, run long, raw binary"), "lm-blocks")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for b, run, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held.setdefault(b, []).append((run, raw))
        seen = 0
        for b in sorted(held):
            keys, count = np.zeros(0, U), np.zeros(0, np.int64)
            waiting: list[tuple[np.ndarray, np.ndarray]] = []

            def settle(keys, count, waiting):
                k, where = np.unique(np.concatenate([keys, *(x[0] for x in waiting)]), return_inverse=True)
                return k, np.bincount(where.reshape(-1), np.concatenate([count, *(x[1] for x in waiting)]).astype(float), len(k)).astype(np.int64)

            for _, raw in held[b]:
                word, per, doc, times = unpack(raw, *BLOCK)
                c = np.bincount(np.repeat(np.arange(len(word)), per), times * (doc & 1).astype(np.int64), len(word)).astype(np.int64)
                waiting.append((word[c > 0], c[c > 0]))
                if sum(len(x[0]) for x in waiting) > len(keys) + 1_000_000:
                    keys, count, waiting = *settle(keys, count, waiting), []
            if waiting:
                keys, count = settle(keys, count, waiting)
            seen += len(keys)
            for run, raw in held.pop(b):
                word, per, doc, times = unpack(raw, *BLOCK)
                doc = doc >> 1
                at = np.searchsorted(keys, word)
                c = np.where((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == word), count[np.minimum(at, len(keys) - 1)], 0) if len(keys) else np.zeros(len(word), np.int64)
                gain = np.repeat(np.log10(c + 0.1) + 1.0, per)  # over a word that was not seen
                on = np.repeat(c > 0, per)
                if on.any():
                    texts, where = np.unique(doc[on], return_inverse=True)
                    yield _rows([_pack(2, b, run, texts, np.bincount(where.reshape(-1), gain[on] * times[on], len(texts)), np.bincount(where.reshape(-1), times[on], len(texts)).astype(np.uint32))])
        yield _rows([(3, -1, seen, b"")])
        tidy()

    parts = materialize(blocks.where("kind = 0").select("bucket", "run", "raw").repartition(buckets, "bucket").mapInArrow(meet, "kind int, bucket int, run long, raw binary"), "lm-parts")
    seen_words = parts.where("kind = 3").agg(F.sum("run")).first()[0] or 0

    def tokens(batches):
        for batch in batches:
            n = ends = 0
            for raw in batch.column(0).to_pylist():
                _, _, held, size, _ = unpack(raw, np.int64, np.uint8, np.uint8, np.int64, np.float64)
                n, ends = n + int(size[held == 0].sum()), ends + int((held == 0).sum())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([ends], pa.int64())], names=["n", "ends"])

    sums = blocks.where("kind = 1").select("raw").mapInArrow(tokens, "n long, ends long").agg(F.sum("n"), F.sum("ends")).first()
    ends = sums[1] or 0
    total, types = (sums[0] or 0) + ends, seen_words + (ends > 0)
    floor, of_end = log10(total + 0.1 * (types + 1)), log10(ends + 0.1)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # run, ids, nulls, held_out, sizes, scores, gains, known

        def out() -> pa.RecordBatch:
            _, ids, null, is_held, size, lattice, gain, known = held
            base = gain - size + of_end - (size + 1) * floor
            cols = [pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(is_held.astype(bool)), pa.array(size + 1), pa.array(known + (ends > 0)), pa.array(np.full(len(ids), total)), pa.array(base), pa.array(lattice)]
            return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in COLUMNS.split(", ")])

        for batch in batches:
            for kind, run, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if kind == 1:
                    if held:
                        yield out()
                    fields = unpack(raw, np.int64, np.uint8, np.uint8, np.int64, np.float64)
                    held = (run, *fields, np.zeros(len(fields[0])), np.zeros(len(fields[0]), np.int64))
                else:
                    texts, gains, known = unpack(raw, *PARTS)
                    held[6][texts] += gains
                    held[7][texts] += known
        if held:
            yield out()

    both = blocks.where("kind = 1").unionByName(parts.where("kind = 2"))
    return both.repartition(buckets, "run").sortWithinPartitions("run", "kind", "bucket").select("kind", "run", "raw").mapInArrow(finish, COLUMNS)


def _rows(out: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kind, bucket, run, raw = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(run, pa.int64()), pa.array(raw, pa.binary())], names=["kind", "bucket", "run", "raw"])
