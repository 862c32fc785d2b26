"""The postal cache on disk: one @ file, or one for each state; the last row of a key counts."""

from __future__ import annotations

import glob
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text
from ..operators import postal
from ..operators.lineage import cut
from . import delimited


def files(path: str) -> list[str]:
    return sorted(glob.glob(os.path.join(path, "CEP_EXTERNO_*.TXT"))) if os.path.isdir(path) else [path] if os.path.exists(path) else []


def load(spark: SparkSession, path: str) -> DataFrame:
    raw = delimited.read(spark, files(path), schemas.POSTAL_CACHE)
    typed = raw.where(text.postal_digits("cep") != "").withColumn("cep", text.postal_digits("cep")).withColumn("lat", text.num("lat")).withColumn("lng", text.num("lng"))
    return postal.last_of(typed, "cep", "ord")


def row(df: DataFrame) -> DataFrame:
    """Columns as written: coordinates only of ok rows, text trimmed."""
    ok = F.col("status") == "ok"
    cols = [F.when(ok, F.coalesce(F.col(f.name).cast("string"), F.lit(""))).otherwise("").alias(f.name) if f.name in ("lat", "lng") else F.trim(text.sanitize(f.name)).alias(f.name) for f in schemas.POSTAL_CACHE]
    return df.select(*cols)


def save(df: DataFrame, path: str) -> None:
    """Rows sorted by key in state folders; only states that are present are replaced."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        names = [f.name for f in schemas.POSTAL_CACHE]
        ready = row(df).withColumn("uf", text.cache_state("state")).repartition("uf").sortWithinPartitions("uf", "cep")
        delimited.write(ready, path, names, ["uf"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def load_states(spark: SparkSession, path: str, states: list[str] | None = None) -> DataFrame:
    """Rows of the state folders that ``save`` wrote, all or those of ``states``; a missing folder has no rows."""
    names = [f.name for f in schemas.POSTAL_CACHE]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schemas.POSTAL_CACHE)
    raw = spark.read.schema("value string, uf string").text(path)
    parts = F.split(raw["value"], "@")
    kept = raw.where(F.col("uf").isin(states)) if states is not None else raw
    return kept.select(*(F.coalesce(F.get(parts, F.lit(n)), F.lit("")).alias(c) for n, c in enumerate(names)))


def merge(rows: DataFrame, path: str, order: str = "ord") -> list[str]:
    """Upsert into the state folders; returns the states that were written.

    The last row of a key (by ``order``) replaces the old one in whatever state that lies. Folders
    of the new rows' states and of the replaced rows' states are written anew with all their other rows; the rest are not touched.
    """
    spark = rows.sparkSession
    names = [f.name for f in schemas.POSTAL_CACHE]
    keyed = rows.withColumn("cep", text.postal_digits("cep")).where("cep != ''")
    new = row(postal.last_of(keyed.select(*names, order), "cep", order))
    old = load_states(spark, path)
    gone = old.join(new.select("cep"), "cep", "left_semi")
    state = text.cache_state("state").alias("uf")
    touched = sorted(r["uf"] for r in new.select(state).union(gone.select(state)).distinct().collect())  # states, so few
    if not touched:
        return []
    # the folders that are read are also written: the rows go through the checkpoint folder first
    every = cut(postal.upsert(load_states(spark, path, touched), new))
    save(every, path)
    left = {r["uf"] for r in every.select(state).distinct().collect()}
    for uf in set(touched) - left:  # a state whose last row moved away
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/uf={uf}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return touched


def fetch(wanted: DataFrame, get: Callable[[str], dict]) -> DataFrame:
    """Rows for wanted ceps from a lookup function, which runs on the executors; there is no network client here."""
    names = [f.name for f in schemas.POSTAL_CACHE]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([{n: None for n in names} | {"cep": c} | get(c) for c in batch["cep"]], columns=names)

    return wanted.select("cep").mapInPandas(run, schemas.POSTAL_CACHE)
