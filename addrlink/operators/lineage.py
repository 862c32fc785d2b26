"""Cutting lineage between phases."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: later phases plan from there, and lost executors cost no earlier phase.

    The folder is that of spark.checkpoint.dir; one of our own only where none is set.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or "file://" + tempfile.mkdtemp(prefix="addrlink-"))
    return df.checkpoint()
