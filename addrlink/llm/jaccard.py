"""Similarity join of shingle sets with count vectors in packed R-trees.

Texts with equal sets are one class and take part once. Candidates come from
equal groups (see ``shingles``): buckets of one class level in which all sets hold
the same tokens of one group. Each set leaves as many of its largest buckets as it
can without missing a similar set.

First every set meets the least one of each of its buckets only, so a group of
thousands costs thousands of comparisons, not millions. Buckets whose sets are all
connected then are done. The sets of the others meet as families, the buckets of one
least set; the count vectors of a family are packed into two-level R-trees, in
blocks of bounded size, and leaf pairs, then pairs of different components, survive
where the sum of coordinate minima (of leaf maxima, then of vectors) reaches the
overlap that the similarity needs. Survivors are verified on their token sets, those
of a family where they meet and only until its components are connected. So
components are exact, while pairs within one are not listed.

A tree over all vectors at once does not prune (in tens of dimensions every leaf
overlaps every query), hence trees for each family. Families are not tied together
further where they share sets: a few common passages would make one of a large part
of the corpus, whose cost is its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shingles
from .blocks import pack, unpack
from .common import few, materialize, partitions, passes, sieve_apart, sieve_bits, tidy
from .graph import components
from .tokens import U, Words, mix, signed, slices

LEAF, BLOCK = 32, 4000
BLOCK_BYTES = 4_000_000  # of token sets in a block
BATCH = 500  # rows with count vectors or token sets that go to Python at once
BUCKET = 12_000_000  # shingles whose keys a bucket holds, on average


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))


def _unit(lv: int, percent: int) -> int:
    """Spare keys travel as a byte, in units of this (rounded down: fewer are left out, no pair is missed)."""
    return shingles.groups(lv, percent) // 256 + 1


def _describe(k: int, percent: int, buckets: int, keyed: bool):
    """Texts to rows (doc_id, set size, class, hash of the text), or, when ``keyed``, to blocks of keys (bucket, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at, part in slices(batch.column(1)):
                sets = shingles.sets(Words(part, lower=True), k)
                names = np.array([shingles.name(s) if len(s) else 0 for s in sets], U)
                sizes = np.array([len(s) for s in sets], np.int64)
                n = len(sets)
                if not keyed:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(sizes), pa.array(signed(names), mask=sizes == 0), batch.column(2).slice(at, n)], names=["doc_id", "n", "cls", "row"])
                    continue
                # an entry for each level of a new set: its class, size, level and spare keys
                key, count, entry = [], [], []
                for d in range(n):
                    if sizes[d] >= shingles.least(percent) and (c := int(names[d])) not in seen:
                        seen.add(c)
                        for lv, x, spare in shingles.keyed(sets[d], percent):
                            key.append(x)
                            count.append(len(x))
                            entry.append((d, lv, spare // _unit(lv, percent)))
                if not key:
                    continue
                key, who = np.concatenate(key), np.repeat(np.arange(len(entry)), count)
                of, level, spare = np.array(entry).T
                bucket = ((key >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                key, who = key[order].astype(np.uint32), who[order]
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                raws, to = [], np.flatnonzero(np.diff(cut)).tolist()
                for b in to:
                    here, many = np.unique(who[cut[b] : cut[b + 1]], return_counts=True)
                    raws.append(pack(key[cut[b] : cut[b + 1]], many.astype(np.uint32), names[of[here]], sizes[of[here]].astype(np.uint32), level[here].astype(np.uint8), spare[here].astype(np.uint8)))
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(raws, pa.binary())], names=["bucket", "raw"])
        tidy()

    return run


def _meet(percent: int):
    """Blocks to rows of the buckets that hold several classes, with the number of classes that each holds.

    Of a key 32 bits travel and the bucket of the shuffle stands for the others; keys that
    agree by chance cost comparisons only.
    """

    def bucket(number: int, held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key, many, names, sizes, level, spare = (np.concatenate([x[i] for x in held]) for i in range(6))
        who = np.repeat(np.arange(len(many), dtype=np.uint32), many)
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        count = np.diff(np.r_[first, len(order)])
        order = order[np.repeat(count > 1, count)]
        key, who = key[order].astype(U) | level[who[order]].astype(U) << U(32) | U(number << 40), who[order]
        cls = names[who]
        order = np.lexsort((cls, key))
        key, cls, who = key[order], cls[order], who[order]
        kept = np.r_[True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])][: len(key)]  # several tasks may meet a class
        key, cls, who = key[kept], cls[kept], who[kept]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        count = np.diff(np.r_[first, len(key)])
        count = np.repeat(count, count)
        key, cls, who, count = (x[count > 1] for x in (key, cls, who, count))
        unit = np.array([_unit(lv, percent) for lv in range(int(level.max()) + 1)])
        for at in range(0, len(key), 200_000):
            s = slice(at, at + 200_000)
            w = who[s]
            cols = [signed(key[s]), signed(cls[s]), sizes[w].astype(np.int64), level[w].astype(np.int32), (spare[w] * unit[level[w]]).astype(np.int32), count[s].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "cls", "n", "level", "spare", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for to, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(to, []).append(unpack(raw, np.uint32, np.uint32, np.uint64, np.uint32, np.uint8, np.uint8))
        while held:
            yield from bucket(*held.popitem())
        tidy()

    return run


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int):
    """The least overlap of similar sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def _chosen(k: int, percent: int, rows, classes, describe, names: list[str], types: list):
    """Texts that pass both filters to rows of their sets: the class, then what ``describe`` tells of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(rows.value, np.asarray(batch.column(0)))))
            for _, part in slices(batch.column(1)):
                cls, out = [], []
                for s in shingles.sets(Words(part, lower=True), k):
                    if len(s) >= shingles.least(percent) and passes(classes.value, signed(np.array([c := shingles.name(s)], U)))[0]:
                        cls.append(c)
                        out.append(describe(s))
                cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.array(cls, U))), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["cls", *names])

    return run


def _bounded(percent: int):
    """Pairs whose summed coordinate minima allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            va, vb = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            least = needed(np.asarray(batch.column(2)), np.asarray(batch.column(3)), percent)
            ok = []
            for x, y, m in zip(va, vb, least.tolist(), strict=True):
                counts, marks = shingles.read_vectors([x, y])
                ok.append(int(np.minimum(counts[0], counts[1]).sum(dtype=np.int64) - _unlike(counts[0], counts[1], marks[0], marks[1]).sum()) >= m)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _unlike(ca: np.ndarray, cb: np.ndarray, ma: np.ndarray, mb: np.ndarray) -> np.ndarray:
    """Groups with equal counts and unequal content."""
    return (ca == cb) & (ma != mb)


class Tree:
    """Count vectors packed into leaves: sorted by size, then by their widest coordinates; each leaf has its maxima."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, marks: np.ndarray | None = None):
        order = self._order(vectors, np.argsort(sizes, kind="stable"))
        self.order, self.vectors, self.sizes = order, vectors[order], sizes[order]
        self.marks = None if marks is None else marks[order]
        self.start = np.arange(0, len(order), LEAF)
        self.high = np.maximum.reduceat(self.vectors, self.start) if len(order) else self.vectors
        self.largest = np.maximum.reduceat(self.sizes, self.start) if len(order) else self.sizes
        self.smallest = np.minimum.reduceat(self.sizes, self.start) if len(order) else self.sizes

    def _order(self, vectors: np.ndarray, order: np.ndarray) -> np.ndarray:
        if len(order) <= LEAF:
            return order
        wide = int(np.argmax(vectors[order].max(0).astype(int) - vectors[order].min(0)))
        order = order[np.argsort(vectors[order, wide], kind="stable")]
        half = max(LEAF, len(order) // 2 // LEAF * LEAF)
        return np.concatenate([self._order(vectors, order[:half]), self._order(vectors, order[half:])])

    def join(self, other: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (in each tree's own input) of the pairs that survive both bounds."""
        for i, at in enumerate(self.start):
            fits = (100 * self.largest[i] >= percent * other.smallest) & (100 * other.largest >= percent * self.smallest[i])
            bound = np.minimum(self.high[i], other.high).sum(1, dtype=np.int64)
            leaves = np.flatnonzero(fits & (bound >= needed(self.smallest[i], other.smallest, percent)))
            mine = slice(at, at + LEAF)
            for j in leaves:
                theirs = slice(other.start[j], other.start[j] + LEAF)
                overlap = np.minimum(self.vectors[mine, None], other.vectors[None, theirs]).sum(2, dtype=np.int64)
                least = needed(self.sizes[mine, None], other.sizes[None, theirs], percent)
                x, y = np.nonzero(overlap >= least)
                if len(x) and self.marks is not None:
                    less = _unlike(self.vectors[mine][x], other.vectors[theirs][y], self.marks[mine][x], other.marks[theirs][y]).sum(1)
                    kept = overlap[x, y] - less >= least[x, y]
                    x, y = x[kept], y[kept]
                if len(x):
                    yield self.order[mine][x], other.order[theirs][y]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets (sorted tokens) link."""
    same = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * same >= percent * (len(a) + len(b) - same)


def _search(percent: int):
    """Sorted rows of (family, level, low block, high block) groups to links that connect their components.

    Survivors of the trees are verified here unless what the task has linked so far connects
    them already, so a task gives fewer links than it has components.
    """
    above: dict[int, int] = {}  # of components that the task has connected: one with a lesser root

    def find(c: int) -> int:
        top = c
        while top in above:
            top = above[top]
        while c != top:
            above[c], c = top, above[c]
        return top

    def group(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        cls, size, comp, block = (rows.column(c).to_numpy() for c in ("cls", "n", "comp", "block"))
        low, high, lv = (rows.column(c)[0].as_py() for c in ("low", "high", "level"))
        tokens = [np.frombuffer(raw.as_buffer(), U) for raw in rows.column("tokens")]  # views
        held, label = np.unique(comp, return_inverse=True)
        root, to = np.unique([find(c) for c in held.tolist()], return_inverse=True)
        label = to.reshape(-1)[label.reshape(-1)]
        if len(root) < 2:
            return
        counts, marks = shingles.read_vectors([shingles.vector(t, lv, shingles.groups(lv, percent)) for t in tokens])
        a = np.flatnonzero(block == low)
        b = a if low == high else np.flatnonzero(block == high)
        one = Tree(counts[a], size[a], marks[a])
        two = one if low == high else Tree(counts[b], size[b], marks[b])
        links = []
        for x, y in one.join(two, percent):
            x, y = a[x], b[y]
            ok = label[x] != label[y]
            for i, j in zip(x[ok].tolist(), y[ok].tolist(), strict=True):
                if label[i] != label[j] and similar(tokens[i], tokens[j], percent):
                    links.append((min(cls[i], cls[j]), max(cls[i], cls[j])))
                    to, gone = min(label[i], label[j]), max(label[i], label[j])  # labels follow the order of roots
                    above[int(root[gone])] = int(root[to])
                    label[label == gone] = to
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*links, strict=True)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # pieces of the group that is being read
        last = None
        for batch in batches:
            if not len(batch):
                continue
            names = [np.asarray(batch.column(batch.schema.names.index(c))) for c in ("key", "level", "low", "high")]
            cut = np.flatnonzero(np.r_[True, np.logical_or.reduce([x[1:] != x[:-1] for x in names]), True])
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                one = tuple(int(c[x]) for c in names)
                if held and one != last:
                    yield from group(pa.Table.from_batches(held))
                    held = []
                last = one
                held.append(batch.slice(x, y - x))
        if held:
            yield from group(pa.Table.from_batches(held))
        tidy()

    return run


def join(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text).

    Null and wordless texts have empty sets and are linked with nothing: their
    component is their own id. Repeated rows come out as often as they came in. A
    null doc_id takes part in links but is never a component's id. An empty table
    gives no rows. Other columns are not read.
    """
    described, classes = _linked(docs, k, percent)
    return described.join(classes, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that of its least doc_id (of repeated ids, the least text); texts without words all stay.

    Columns are unchanged. Rows go one by one, not by doc_id: other rows of an id stay.
    A component of null ids only keeps one of its rows.
    """
    described, classes = _linked(docs, k, percent)
    placed = described.join(classes, "cls").select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "root", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("top"))
    several = placed.where("top").groupBy("root").agg(F.count("*").alias("rows")).where("rows > 1")
    # rows that go, and (with their component) rows of which one stays
    named = materialize(placed.join(several, "root", "left").where("not top or rows is not null").select("d", "r", F.when(F.col("top"), F.col("root")).alias("root")).distinct(), "gone")
    # most rows are surely not gone and need not meet the list
    text, one = F.coalesce(docs["text"].cast("string"), F.lit("")), docs["doc_id"].cast("long")
    maybe, sure = sieve_apart(docs, F.xxhash64(F.coalesce(one, F.lit(0)), F.xxhash64(text)), sieve_bits(named.select(F.xxhash64(F.coalesce("d", F.lit(0)), "r").alias("h")), "h"))
    held = F.struct(*(maybe[c] for c in docs.columns))
    keyed = maybe.select(F.col("doc_id").cast("long").alias("_d"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_r"), held.alias("_row"))
    match = F.col("_d").eqNullSafe(F.col("d")) & (F.col("_r") == F.col("r"))
    lone = sure.unionByName(keyed.join(named, match, "left_anti").select("_row.*"))
    first = keyed.join(named.where("root is not null"), match).groupBy("root").agg(F.min_by("_row", F.coalesce(F.col("_row.text").cast("string"), F.lit(""))).alias("row"))
    return lone.unionByName(first.select("row.*"))


def _linked(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, cls, hash of the text) of all rows, and root and component_id of all classes."""
    spark = docs.sparkSession
    rows = _rows(docs)
    described = materialize(few(rows.mapInArrow(_describe(k, percent, 1, False), "doc_id long, n long, cls long, row long")), "sets")
    buckets = max(partitions(spark), -(-(described.agg(F.sum("n")).first()[0] or 0) // BUCKET))  # a worker holds one bucket
    # the keys are made in a pass of their own, straight into their shuffle: written first they would take as much disk again
    blocks = rows.mapInArrow(_describe(k, percent, buckets, True), "bucket int, raw binary")
    met = materialize(blocks.repartition(buckets, "bucket").mapInArrow(_meet(percent), "key long, cls long, n long, level int, spare int, held int"), "met")
    rarest = F.row_number().over(Window.partitionBy("cls", "level").orderBy(F.desc("held"), "key"))
    of_key = Window.partitionBy("key")
    kept = met.withColumn("nth", rarest).where("nth > spare").select("key", "cls", "n", "level", F.min(F.struct("cls", "n")).over(of_key).alias("one"), F.count("*").over(of_key).alias("held"))
    found = materialize(kept.where("held > 1").select("key", "cls", "n", "level", F.col("one.cls").alias("centre"), F.col("one.n").alias("centre_n")), "buckets")
    least = described.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))

    # count vectors of the classes that share a bucket, from one row of each; token sets of the few pairs that come to be verified
    shared = found.select("cls").distinct()
    one = materialize(shared.join(least, "cls").select("cls", F.xxhash64(F.coalesce("least", F.lit(0))).alias("h")), "shared")
    hashed = rows.select(F.xxhash64(F.coalesce("doc_id", F.lit(0))).alias("h"), "text")

    def told(of: DataFrame, describe, names: list[str], types: list, schema: str) -> DataFrame:
        return hashed.mapInArrow(_chosen(k, percent, sieve_bits(of, "h"), sieve_bits(of, "cls"), describe, names, types), schema)

    at_levels = lambda s: ([lv for lv, _ in shingles.levels(len(s), percent)], [shingles.vector(s, lv, m) for lv, m in shingles.levels(len(s), percent)])
    held = materialize(told(one, at_levels, ["levels", "vectors"], [pa.list_(pa.int32()), pa.list_(pa.binary())], "cls long, levels array<int>, vectors array<binary>"), "vectors")
    vectors = held.select("cls", F.explode(F.arrays_zip("levels", "vectors")).alias("x")).select("cls", F.col("x.levels").alias("level"), F.col("x.vectors").alias("vector"))

    def side(name: str) -> DataFrame:
        return vectors.select(F.col("cls").alias(name), "level", F.col("vector").alias(f"v{name}"))

    def asked(classes: DataFrame) -> DataFrame:
        return materialize(one.join(classes.distinct(), "cls", "left_semi"), "asked")

    def verified(pairs: DataFrame) -> DataFrame:
        both = asked(pairs.select(F.explode(F.array("a", "b")).alias("cls")))
        tokens = materialize(told(both, lambda s: (signed(s),), ["tokens"], [pa.list_(pa.int64())], "cls long, tokens array<long>"), "tokens")
        a, b = (tokens.select(F.col("cls").alias(x), F.col("tokens").alias(f"t{x}")) for x in "ab")
        both = pairs.join(a, "a").join(b, "b")
        same = F.size(F.array_intersect("ta", "tb"))
        return both.where(100 * same >= percent * (F.size("ta") + F.size("tb") - same)).select("a", "b").distinct()

    fits = (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))
    stars = found.where("cls != centre").select(F.col("centre").alias("a"), F.col("cls").alias("b"), F.col("centre_n").alias("na"), F.col("n").alias("nb"), "level").where(fits).groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.min("level").alias("level"))
    likely = stars.join(side("a"), ["a", "level"]).join(side("b"), ["b", "level"]).select("a", "b", "na", "nb", "va", "vb").mapInArrow(_bounded(percent), "a long, b long")
    links = materialize(few(verified(materialize(few(likely), "likely", BATCH))), "links")
    roots = components(links)

    # sets of buckets that still hold several components; those of one least set meet as one family, each set once
    placed = found.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("key", "cls", "n", "level", "centre", F.coalesce("root", "cls").alias("comp"))
    open_ = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("key")
    cross = materialize(placed.join(open_, "key").select(F.col("centre").alias("key"), "cls", "n", "level", "comp").distinct(), "open")
    top = cross.agg(F.max("level")).first()[0] or 0
    room = F.element_at(F.array(*(F.lit(max(1, min(BLOCK, BLOCK_BYTES // (8 * shingles.upper(lv, percent))))) for lv in range(top + 1))), F.col("level") + 1)
    sizes = cross.groupBy("key", "level").agg(F.count("*").alias("sets")).select("key", "level", F.ceil(F.col("sets") / room).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    tokens = materialize(told(asked(cross.select("cls")), lambda s: (s.tobytes(),), ["tokens"], [pa.binary()], "cls long, tokens binary"), "tokens")
    dealt = cross.join(sizes, ["key", "level"]).join(tokens, "cls").withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", "level", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "cls", "n", "comp", "tokens")
    grouped = dealt.repartition(buckets, "key", "level", "low", "high").sortWithinPartitions("key", "level", "low", "high")
    more = materialize(few(grouped.mapInArrow(_search(percent), "a long, b long")), "links", BATCH)
    final = components(links.unionByName(more))
    joined = least.join(final.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    tops = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return described, joined.join(tops, "root").select("cls", "root", "component_id")
