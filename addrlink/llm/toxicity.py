"""Toxicity by a classifier chain.

Categories are predicted in order; each linear model sees which tokens a text
has and the probabilities of the categories before it. While learning, those
probabilities come from models that did not see the row (out of fold), so later
models meet the same kind of input as in prediction.

Learning is on the driver, on at most ``sample`` labelled rows drawn by a hash of
their id; tokens are hashed, and a model keeps those whose presence goes with its
category more than chance does. Prediction reads whole texts once, without a
shuffle, with weights of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import ALNUM, SPACED, U, Words, slices

BITS = 20
SYMBOLS = SPACED & ~ALNUM
FOLDS, LEAST_ROWS = 3, 5
#: Bytes of a word's beginning that are features, and counts from which a beginning is another feature.
STEMS, OFTEN = (4, 5, 6, 7), (2, 3, 5)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the features of a slice: lower-cased words, runs of symbols, and word beginnings; beginnings also by how often they occur."""
    words, symbols = Words(texts, ALNUM, lower=True), Words(texts, SYMBOLS)
    found = [_pairs(w.text(), w.hash) for w in (words, symbols)]
    text = words.text()
    for size in STEMS:
        at, h = words.prefixes(size)
        pairs, times = np.unique(_pairs(text[at], h), return_counts=True)
        found.append(pairs)
        for least in OFTEN:
            often = pairs[times >= least]
            found.append((often >> BITS << BITS) | ((often * 0x9E3779B1 + least * 0x85EBCA6B) & ((1 << BITS) - 1)))
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _pairs(text: np.ndarray, h: np.ndarray) -> np.ndarray:
    return text << BITS | (h >> U(64 - BITS)).astype(np.int64)


class Linear:
    """Logistic model over chosen buckets and the chain's earlier probabilities."""

    def __init__(self, rows: np.ndarray, at: np.ndarray, y: np.ndarray, chain: np.ndarray, least_z: float = 4.5, rounds: int = 150):
        n, pos = len(y), y.sum()
        self.at = np.zeros(0, np.int64)
        self.w, self.c, self.b = np.zeros(0), np.zeros(chain.shape[1]), float(np.log((pos + 0.5) / (n - pos + 0.5)))
        if not n or pos in (0, n):
            return
        seen = np.bincount(at, minlength=1 << BITS).astype(float)
        with_y = np.bincount(at, y[rows].astype(float), 1 << BITS)
        share = pos / n
        z = np.abs(with_y - seen * share) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
        self.at = np.flatnonzero((seen >= LEAST_ROWS) & (z >= least_z))
        place = np.full(1 << BITS, -1)
        place[self.at] = np.arange(len(self.at))
        kept = place[at] >= 0
        r, k = rows[kept], place[at][kept]
        w, m, v = np.zeros(len(self.at) + chain.shape[1] + 1), 0.0, 0.0
        w[-1] = self.b
        for t in range(1, rounds + 1):  # Adam on the logistic loss with a small ridge
            f = np.bincount(r, w[k], n) + chain @ w[len(self.at) : -1] + w[-1]
            d = (1 / (1 + np.exp(-np.clip(f, -30, 30))) - y) / n
            g = np.r_[np.bincount(k, d[r], len(self.at)), chain.T @ d, d.sum()] + 1e-4 * np.r_[w[:-1], 0] / 10
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w = w - 0.3 / np.sqrt(1 + t / 30) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        self.w, self.c, self.b = w[: len(self.at)], w[len(self.at) : -1], float(w[-1])

    def __call__(self, rows: np.ndarray, at: np.ndarray, n: int, chain: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.at, at), max(len(self.at) - 1, 0))
        gain = np.where(self.at[place] == at, self.w[place], 0.0) if len(self.at) else np.zeros(len(at))
        f = np.bincount(rows, gain, n) + chain @ self.c + self.b
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


class Chain:
    def __init__(self, rows: np.ndarray, at: np.ndarray, labels: np.ndarray, fold: np.ndarray):
        n, self.models = len(labels), []
        earlier = np.zeros((n, 0))
        for j in range(labels.shape[1]):
            y, out = labels[:, j], np.zeros(n)
            for k in range(FOLDS):
                train = fold != k
                number = np.cumsum(train) - 1
                mine = train[rows]
                model = Linear(number[rows[mine]], at[mine], y[train], earlier[train])
                other = np.flatnonzero(~train)
                back = np.full(n, -1)
                back[other] = np.arange(len(other))
                theirs = ~mine
                out[other] = model(back[rows[theirs]], at[theirs], len(other), earlier[other])
            self.models.append(Linear(rows, at, y, earlier))
            earlier = np.c_[earlier, out]

    def predict(self, rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        earlier = np.zeros((n, 0))
        for model in self.models:
            earlier = np.c_[earlier, model(rows, at, n, earlier)]
        return earlier


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], sample: int = 5_000) -> Chain:
    """Learn from at most ``sample`` labelled rows that have a text and all categories (0 or 1; the larger of repeated ones)."""
    given = labels.select(F.col("doc_id").cast("long").alias("id"), *(F.col(c).cast("int").alias(c) for c in categories)).dropna()
    drawn = given.groupBy("id").agg(*(F.max(c).alias(c) for c in categories)).orderBy(F.xxhash64("id"), "id").limit(sample)
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = text.join(F.broadcast(drawn), "id").select("text", "id", F.array(*categories).alias("y"))  # at most ``sample`` rows are sent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(0)):
                doc, bucket = tokens(part)
                cut = np.searchsorted(doc, np.arange(len(part) + 1))
                raw = [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, len(part)), batch.column(2).slice(at, len(part)), pa.array(raw, pa.binary())], names=["id", "y", "at"])

    got = sorted(((r["id"], bytes(r["at"]), r["y"]) for r in rows.mapInArrow(run, "id long, y array<int>, at binary").collect()), key=lambda r: r[:2])
    at = np.concatenate([np.frombuffer(r[1], np.int32) for r in got]) if got else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(got), dtype=np.int32), [len(r[1]) // 4 for r in got])
    often = (np.bincount(at, minlength=1 << BITS) >= LEAST_ROWS)[at]  # models never keep rarer ones
    at, row = at[often], row[often]
    y = np.array([r[2] for r in got], float).reshape(len(got), len(categories))
    fold = np.array([(r[0] * 2654435761 >> 16) % FOLDS for r in got], int)
    return Chain(row, at, y, fold)


def classify(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], threshold: float = 0.5, sample: int = 5_000) -> DataFrame:
    """doc_id, p_<category> for each category, and <last category> as a boolean, for each row of ``docs``.

    Null and empty texts have no tokens and get the models' base rates. Without
    labelled rows all probabilities are one half and nothing is flagged (the
    threshold must be passed). Repeated rows come out as often as they came in; a
    null doc_id stays null; an empty table gives no rows. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, categories, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(1)):
                p = sent.value.predict(*tokens(part), len(part))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *(pa.array(np.ascontiguousarray(p[:, j])) for j in range(len(categories))), pa.array(p[:, -1] > threshold)], names=["doc_id", *(f"p_{c}" for c in categories), categories[-1]])

    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return one.mapInArrow(run, ", ".join(["doc_id long", *(f"p_{c} double" for c in categories), f"{categories[-1]} boolean"]))
