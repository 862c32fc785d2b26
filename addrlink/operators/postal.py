"""The external postal cache: upserts, bucket quality, sessions, stratified samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .inventory import percentiles

#: The country's centre and box, and how near the centre counts as a fallback point.
CENTRE, FALLBACK = (-14.2400732, -53.1805017), 0.001
COUNTRY = (-34.0, 6.0, -74.5, -28.5)


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("x")).select(key, "x.*").select(*rows.columns)


def import_lines(rows: DataFrame) -> DataFrame:
    """First row of each cep, but an ok row beats an earlier one that is not."""
    w = Window.partitionBy("cep").orderBy(F.desc(F.col("status") == "ok"), "seq")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, key: str = "cep") -> DataFrame:
    """New rows replace old ones of the same key, whatever state either is in."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def is_fallback(lat, lng):
    return (F.abs(text._c(lat) - CENTRE[0]) < FALLBACK) & (F.abs(text._c(lng) - CENTRE[1]) < FALLBACK)


def is_suspicious(lat, lng):
    y, x = text._c(lat), text._c(lng)
    return y.isNull() | x.isNull() | ((F.abs(y) < 0.001) & (F.abs(x) < 0.001)) | ~y.between(COUNTRY[0], COUNTRY[1]) | ~x.between(COUNTRY[2], COUNTRY[3])


def to_fetch(wanted: DataFrame, cache: DataFrame, force: bool = False, retry_errors: bool = False) -> DataFrame:
    """Wanted keys that the cache does not answer."""
    if force:
        return wanted
    held = cache.where("status != 'error'") if retry_errors else cache
    return wanted.join(held.select("cep"), "cep", "left_anti")


def municipal_boxes(rows: DataFrame, least: int = 5, margin: float = 0.02) -> DataFrame:
    """Box of a municipality's matched rows, grown by ``margin``; only where there are ``least`` rows."""
    return rows.groupBy("ibge").agg(F.count("*").alias("n"), (F.min("lat") - margin).alias("lat_min"), (F.max("lat") + margin).alias("lat_max"), (F.min("lng") - margin).alias("lng_min"), (F.max("lng") + margin).alias("lng_max")).where(F.col("n") >= least)


def sessions(rows: DataFrame, time: str, gap_seconds: int = 90, by: list[str] | None = None) -> DataFrame:
    """Runs of rows in which no pause exceeds the gap; a pause of exactly the gap does not split."""
    s = F.session_window(time, f"{gap_seconds} seconds")
    return rows.groupBy(*(by or []), s.alias("s")).agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last")).drop("s")


def quality(rows: DataFrame, boxes: DataFrame, by: str) -> DataFrame:
    """Per bucket: rows, ok, distinct and shared 4-decimal places, inside or outside the municipal box, distance percentiles."""
    place = F.when(F.col("status") == "ok", F.concat_ws(",", F.format_string("%.4f", "lat"), F.format_string("%.4f", "lng")))
    joined = rows.withColumn("place", place).join(boxes.select("ibge", "lat_min", "lat_max", "lng_min", "lng_max"), "ibge", "left")
    within = F.col("lat").between(F.col("lat_min"), F.col("lat_max")) & F.col("lng").between(F.col("lng_min"), F.col("lng_max"))
    per_place = joined.where("place is not null").groupBy(by, "place").agg(F.count("*").alias("n"))
    shared = per_place.groupBy(by).agg(F.count("*").alias("places"), F.sum((F.col("n") >= 2).cast("long")).alias("shared2"), F.sum((F.col("n") >= 5).cast("long")).alias("shared5"), F.max("n").alias("most")).join(percentiles(per_place, [by], "n", {"p50": 0.5, "p90": 0.9}), by)
    ok = F.col("status") == "ok"
    base = joined.groupBy(by).agg(F.count("*").alias("rows"), F.sum(ok.cast("long")).alias("ok"), F.coalesce(F.sum((ok & within).cast("long")), F.lit(0)).alias("inside"), F.coalesce(F.sum((ok & ~within).cast("long")), F.lit(0)).alias("outside"))
    return base.join(shared, by, "left")


def stratified(rows: DataFrame, n: int, stratum, shares: dict[str, float]) -> DataFrame:
    """One row a cep (best score), then a quota for each stratum and the best of the rest until there are ``n``.

    ``shares`` gives parts of n; strata not named share what is left over. Quotas and
    ranks are counted within bounded top lists, so no stratum is sorted whole.
    """
    best = rows.groupBy("cep").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "cep"]), F.struct("score", -F.col("id"))).alias("x")).select("cep", "x.*").withColumn("stratum", stratum)
    quota = {k: int(n * v + 0.5) for k, v in shares.items()}
    quota["other"] = n - sum(quota.values())
    order = [F.desc("score"), "cep"]
    picked = None
    for k, q in quota.items():
        part = best.where(F.col("stratum") == k).orderBy(*order).limit(max(q, 0))
        picked = part if picked is None else picked.unionByName(part)
    rest = best.join(picked.select("cep"), "cep", "left_anti").orderBy(*order).limit(n)
    return picked.withColumn("turn", F.lit(0)).unionByName(rest.withColumn("turn", F.lit(1))).orderBy("turn", *order).limit(n).drop("turn")
