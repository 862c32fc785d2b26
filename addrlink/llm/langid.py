"""Language identification with error-correcting output codes.

Each language has a codeword of +1 and -1 bits; one linear classifier over
hashed byte trigrams predicts each bit. A text gets the language whose codeword
has the least loss-weighted distance to the predicted bits, and is flagged as
ambiguous where the runner-up is close. Classifiers are fitted on the driver on
a bounded sample of labelled rows (``per_language`` rows a language, chosen by a
hash of their id); prediction reads whole texts in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tidy
from .tokens import LOWER, slices

BITS = 12
BUCKETS = 1 << BITS
ROWS = 250  # texts whose feature rows are held at once
_LETTERS = LOWER.copy()
for _b in range(128):
    if not chr(_b).isalpha():
        _LETTERS[_b] = 32


def codewords(n: int) -> np.ndarray:
    """A row for each of n classes: the exhaustive code up to seven classes, else random distinct columns with a fixed seed."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        cols = [[1, *(1 if (c >> k) & 1 else -1 for k in range(n - 1))] for c in range(2 ** (n - 1) - 1)]
        return np.array(cols, float).T
    rng, size = np.random.default_rng(7), int(np.ceil(10 * np.log2(n)))
    tries = [np.where(rng.random((n, size)) < 0.5, -1.0, 1.0) for _ in range(50)]
    apart = [min(np.sum(a[i] != a[j]) for i in range(n) for j in range(i)) for a in tries]
    return tries[int(np.argmax(apart))]


def features(texts: pa.Array) -> np.ndarray:
    """A unit row for each text of a slice: square roots of its hashed trigram counts."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[int(offsets[0]) : int(offsets[-1])] if raw is not None and raw.size else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    # a space before and after each text, so short texts have trigrams too
    size = np.diff(offsets) + 2
    first = np.cumsum(size) - size
    line = np.full(int(size.sum()), 32, np.uint8)
    line[np.arange(len(data)) + np.repeat(first + 1 - offsets[:-1], np.diff(offsets))] = _LETTERS[data]
    a = line.astype(np.uint32)
    gram = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:] if len(a) > 2 else np.zeros(0, np.uint32)
    doc = np.repeat(np.arange(n), size)[: len(gram)]
    kept = (np.arange(len(gram)) < (first + size - 2)[doc]) & ~((a[: len(gram)] == 32) & (a[1 : 1 + len(gram)] == 32)) & ~((a[1 : 1 + len(gram)] == 32) & (a[2 : 2 + len(gram)] == 32))
    bucket = (gram * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    out = np.sqrt(np.bincount(doc[kept] * BUCKETS + bucket[kept], minlength=n * BUCKETS).astype(np.float32)).reshape(n, BUCKETS)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)


class Model:
    """Languages, their codewords, the bit classifiers and the weight of each bit for each language."""

    def __init__(self, names: list[str], x: np.ndarray, y: np.ndarray, rounds: int = 120):
        self.names, self.code = names, codewords(len(names))
        want = self.code[y] if len(y) else np.zeros((0, self.code.shape[1]))
        w = np.zeros((BUCKETS + 1, self.code.shape[1]), np.float32)
        if len(names) > 1:
            x1 = np.c_[x, np.full(len(x), 0.3, np.float32)]
            share = 1.0 / np.bincount(y, minlength=len(names))[y]
            share = (share / share.sum())[:, None].astype(np.float32)
            m, v = np.zeros_like(w), np.zeros_like(w)
            for t in range(1, rounds + 1):  # Adam on the logistic loss
                g = x1.T @ (share * -want / (1 + np.exp(np.clip(want * (x1 @ w), -30, 30)))).astype(np.float32) + 1e-6 * w
                m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
                w -= 0.5 / np.sqrt(t) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
            right = (np.sign(x1 @ w) == want).astype(float)
            self.weight = np.array([right[y == k].mean(0) for k in range(len(names))]) + 1e-6
        else:
            self.weight = np.ones_like(self.code)
        self.weight /= self.weight.sum(1, keepdims=True)
        self.w = w

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, score in (0, 1], and margin of the loss over the runner-up's."""
        bits = np.c_[x, np.full(len(x), 0.3, np.float32)] @ self.w
        loss = (np.logaddexp(0, -self.code[None] * bits[:, None]) * self.weight[None]).sum(2)
        order = np.sort(loss, 1)
        p = np.exp(-self.code.shape[1] * (loss - order[:, :1]))
        return loss.argmin(1), 1 / p.sum(1), (order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.full(len(x), np.inf))


def remainder(by: int):
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % by


def fit(docs: DataFrame, per_language: int = 1000) -> Model:
    """Learn from rows with text and lang whose remainder by 3 is not 1, at most ``per_language`` a language."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where((remainder(3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(counts)
    if not names:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0, int))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    most = F.create_map(*(F.lit(v) for k in names for v in (k, min(1_000_000, 1 + 2_000_000 * per_language // counts[k]))))
    drawn = rows.withColumn("draw", draw).where(F.col("draw") < most[F.col("lang")])
    kept = drawn.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text")))).where(F.col("nth") <= per_language)

    def run(batches):
        for batch in batches:
            for at, part in slices(batch.column(0), rows=ROWS):
                x = features(part)
                rows = [np.flatnonzero(r).astype(np.uint16) for r in x]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, len(part)), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array([x[i, r].astype(np.float32).tobytes() for i, r in enumerate(rows)], pa.binary())], names=["lang", "at", "value"])

    got = kept.select("text", "lang").mapInArrow(run, "lang string, at binary, value binary").collect()
    got.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["value"])))
    x = np.zeros((len(got), BUCKETS), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float32)
    return Model(names, x, np.array([names.index(r["lang"]) for r in got], int))


def identify(docs: DataFrame, model: Model | None = None, unsure: float = 0.02) -> DataFrame:
    """``docs`` rows as doc_id, held_out, lang_pred, score, ambiguous.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text when nothing could be learned. Repeated rows come out as often as they
    came in; empty tables give no rows. Columns besides doc_id and text (and lang
    for learning) are not read.
    """
    model = model or fit(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: weights of fixed size for each bit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for at, part in slices(batch.column(2), rows=ROWS):
                letters = np.asarray(pc.match_substring_regex(part, r"\p{L}").to_numpy(zero_copy_only=False), bool)
                if m.names:
                    k, score, margin = m.predict(features(part))
                    names = np.array(m.names, object)[k]
                else:
                    letters[:] = False
                    names, score, margin = np.full(len(part), "und", object), np.zeros(len(part)), np.zeros(len(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)), pa.array(np.where(letters, names, "und"), pa.string()), pa.array(np.where(letters, score, 0.0), pa.float64()), pa.array(~letters | (margin < unsure), pa.bool_())],
                    names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )
        tidy()

    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(3) == 1).alias("held_out"), F.col("text").cast("string").alias("text"))
    return one.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_known(docs: DataFrame, model: Model | None = None, unsure: float = 0.02) -> DataFrame:
    """Rows of ``docs`` whose text has a language (not ``und``), with that language in ``lang``.

    Null, empty and letterless texts go. ``lang`` becomes the predicted language; where
    the prediction is ambiguous a language that is given stays. Where nothing could be
    learned (no row with text and lang) all values stay. Repeated rows, null ids and other
    columns stay as they are; an empty table gives none.
    """
    model = model or fit(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for batch in batches:
            to = batch.schema.names.index("lang") if "lang" in batch.schema.names else None
            for at, part in slices(batch.column(batch.schema.names.index("text")), rows=ROWS):
                known = np.asarray(pc.match_substring_regex(part, r"\p{L}").to_numpy(zero_copy_only=False), bool)
                rows = batch.slice(at, len(part))
                if m.names and to is not None:
                    k, score, margin = m.predict(features(part))
                    known &= score > 0
                    given = rows.column(to)
                    told = pa.array(np.array(m.names, object)[k], pa.string()).cast(given.type)
                    sure = pc.or_(pa.array(margin >= unsure), pc.is_null(given))
                    rows = rows.set_column(to, batch.schema.field(to), pc.if_else(sure, told, given))
                yield rows.filter(pa.array(known))
        tidy()

    return docs.mapInArrow(run, docs.schema)
