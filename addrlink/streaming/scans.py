"""Streams within the batch operators' meaning: the checkpoint location is the resume point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import inventory
from ..sources.pbf import PbfSource


def blobs(spark: SparkSession, path: str, most_blobs: int = 64) -> DataFrame:
    """Elements of a dump as a stream; each trigger takes at most ``most_blobs`` blobs."""
    spark.dataSource.register(PbfSource)
    return spark.readStream.format("osm_pbf").option("path", path).option("maxBlobsPerTrigger", most_blobs).load()


def scan_signals(elements: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Signal counters of each trigger under ``out``; batches are written under their number, so a repeated one replaces itself.

    The query runs until it is stopped; ``processAllAvailable`` waits for what is there.
    """

    def save(batch: DataFrame, number: int) -> None:
        inventory.signals(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return elements.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()


def total_signals(spark: SparkSession, out: str) -> DataFrame:
    return inventory.merge(spark.read.parquet(out).drop("batch"))


def session_counts(rows: DataFrame, time: str, by: list[str], gap_seconds: int = 90, late: str = "10 minutes") -> DataFrame:
    """Closed sessions of a stream; rows later than the watermark are left out."""
    s = F.session_window(time, f"{gap_seconds} seconds")
    return rows.withWatermark(time, late).groupBy(*by, s.alias("s")).agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last")).select(*by, "n", "first", "last")
