"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import slices


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where set, else one of our own (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        at = "file://" + tempfile.mkdtemp(prefix="addrlink-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: lineage ends there and survives lost executors.

    The shuffle files of the write go when it has ended, since nothing needs them any more.
    ``batch`` is the most rows that go to Python at once, for rows that are large.
    """
    spark, at = df.sparkSession, scratch(df.sparkSession, name)
    conf = {CLEANUP: "true"} | ({BATCH: str(batch)} if batch else {})
    before = {k: spark.conf.get(k, {CLEANUP: "false", BATCH: "10000"}[k]) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(at)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(at)


def few(df: DataFrame) -> DataFrame:
    """A small table that many tasks make, dealt to few partitions before it is written.

    Without its native library Hadoop starts three processes (chmod) for each file on a local disk, from an executor's JVM.
    """
    return df.hint("rebalance")


def tidy() -> None:
    """At the end of a task: give freed memory back, since the next task of a Python worker need not be of the same kind."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


SIEVE_BITS = 26


def sieve_bits(keys: DataFrame, column: str):
    """A Bloom filter of fixed size (8 MB) over a column of 64-bit hashes, sent to the executors."""
    low = F.col(column).bitwiseAND((1 << SIEVE_BITS) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(63).cast("int"))
    got = keys.select(F.shiftright(low, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    table[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter."""
    h = h & ((1 << SIEVE_BITS) - 1)
    return (bits[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1


def sieve(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``df`` without most rows whose ``column`` (a 64-bit hash) is not in ``keys``; no row that is in it goes.

    Put ahead of an exact join, so that rows without a partner are not shuffled.
    With far more keys than bits all rows pass and the join does all the work.
    """
    sent = sieve_bits(keys, column)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(passes(sent.value, np.asarray(batch.column(batch.schema.names.index(column))))))

    return df.mapInArrow(run, df.schema)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, longer where a column has it already (in any case)."""
    while name.lower() in {x.lower() for x in taken}:
        name += "_"
    return name


def runs(batch: pa.RecordBatch, column: str | int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of bounded bytes of a text column."""
    for at, part in slices(batch.column(column)):
        yield batch.slice(at, len(part))


def sieve_apart(df: DataFrame, value: Column, bits) -> tuple[DataFrame, DataFrame]:
    """(rows whose 64-bit ``value`` may be in the filter, rows whose value is not), each in one pass without a shuffle."""
    names = df.columns
    keyed = df.select(value.alias(fresh("_sieve", names)), *names)

    def side(inside: bool) -> DataFrame:
        def run(batches):
            for batch in batches:
                hit = passes(bits.value, np.asarray(batch.column(0)))
                yield batch.select(names).filter(pa.array(hit == inside))

        return keyed.mapInArrow(run, df.schema)

    return side(True), side(False)
