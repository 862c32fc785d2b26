"""Inventory of a dump: tag signals, key counts, coordinate layout, path trees, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

COUNTERS = ["addr_any", "addr_street", "addr_housenumber", "addr_city", "addr_postcode", "addr_country", "name", "name_localized", "place", "highway", "building"]


def signals(elements: DataFrame) -> DataFrame:
    """One row of counters over elements (kind: node, way or relation; lat, lon, tags). Counters of parts add up (``merge``)."""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("long")
    keys = F.coalesce(F.map_keys("tags"), F.array().cast("array<string>"))
    hit = lambda test: F.coalesce(F.sum(F.size(F.filter(keys, test))), F.lit(0)).cast("long")
    node = F.col("kind") == "node"
    lat, lon = F.col("lat").isNotNull(), F.col("lon").isNotNull()
    return elements.agg(
        n(node).alias("node"), n(F.col("kind") == "way").alias("way"), n(F.col("kind") == "relation").alias("relation"), n(node & lat).alias("node_with_lat"), n(node & lon).alias("node_with_lon"), n(node & lat & lon).alias("node_with_lat_lon"),
        hit(lambda k: k.startswith("addr:")).alias("addr_any"), hit(lambda k: k == "addr:street").alias("addr_street"), hit(lambda k: k == "addr:housenumber").alias("addr_housenumber"), hit(lambda k: k.isin("addr:city", "addr:municipality")).alias("addr_city"), hit(lambda k: k == "addr:postcode").alias("addr_postcode"), hit(lambda k: k == "addr:country").alias("addr_country"),
        hit(lambda k: k == "name").alias("name"), hit(lambda k: k.startswith("name:")).alias("name_localized"), hit(lambda k: k == "place").alias("place"), hit(lambda k: k == "highway").alias("highway"), hit(lambda k: k == "building").alias("building"),
    )


def merge(parts: DataFrame) -> DataFrame:
    """Counters of several parts (or saved snapshots) as one row."""
    return parts.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in parts.columns))


def hints(counters: DataFrame) -> DataFrame:
    c = lambda name: F.col(name) > 0
    point, address, place, named = c("node_with_lat_lon"), c("addr_any"), c("place"), c("name") | c("name_localized")
    return counters.select(point.alias("has_point_geometry"), address.alias("has_address_tags"), place.alias("has_place_tags"), named.alias("has_named_features"), (c("highway") | c("way")).alias("has_road_network"), (point & (address | place | named)).alias("likely_has_geocode_material"))


def key_counts(elements: DataFrame) -> DataFrame:
    return elements.select(F.explode(F.map_keys("tags")).alias("k")).groupBy("k").agg(F.count("*").alias("n"))


def top_keys(elements: DataFrame, most: int = 40) -> DataFrame:
    return key_counts(elements).orderBy(F.desc("n"), "k").limit(most)


def layout(points: DataFrame, small: float = 0.01) -> DataFrame:
    """Per block: count, box, sum and largest jump between consecutive points, number of small jumps. Blocks are windows of their own."""
    w = Window.partitionBy("block").orderBy("ordinal")
    jump = geo.jump_deg(F.lag("lat").over(w), F.lag("lng").over(w), "lat", "lng")
    return points.withColumn("jump", jump).groupBy("block").agg(
        F.count("*").alias("n"), F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"), F.min("lng").alias("lng_min"), F.max("lng").alias("lng_max"),
        F.min_by("lat", "ordinal").alias("lat_first"), F.max_by("lat", "ordinal").alias("lat_last"), F.min_by("lng", "ordinal").alias("lng_first"), F.max_by("lng", "ordinal").alias("lng_last"),
        F.coalesce(F.sum("jump"), F.lit(0.0)).alias("jump_sum"), F.coalesce(F.max("jump"), F.lit(0.0)).alias("jump_max"), F.coalesce(F.sum((F.col("jump") < small).cast("long")), F.lit(0)).alias("small"),
    )


def sequence(blocks: DataFrame, small: float = 0.01) -> DataFrame:
    """Global jump statistics: those of the blocks plus the jumps from each block's last point to the next one's first."""
    w = Window.orderBy("block")  # one row a block
    between = geo.jump_deg(F.lag("lat_last").over(w), F.lag("lng_last").over(w), "lat_first", "lng_first")
    total = blocks.withColumn("between", between).agg(F.sum("n").alias("n"), (F.sum("jump_sum") + F.coalesce(F.sum("between"), F.lit(0.0))).alias("jump_sum"), F.greatest(F.max("jump_max"), F.max("between")).alias("jump_max"), (F.sum("small") + F.coalesce(F.sum((F.col("between") < small).cast("long")), F.lit(0))).alias("small"))
    share = F.col("small") / F.greatest(F.col("n") - 1, F.lit(1))
    return total.withColumn("small_share", share).withColumn("layout", F.when(share >= 0.5, "lay~seq").otherwise("lay~rand"))


def merge_blocks(blocks: DataFrame, halvings: int) -> DataFrame:
    """Blocks merged in runs of 2**halvings."""
    run = F.floor(F.col("block") / (1 << halvings)).cast("long")
    return blocks.groupBy(run.alias("block")).agg(F.sum("n").alias("n"), F.min("lat_min").alias("lat_min"), F.max("lat_max").alias("lat_max"), F.min("lng_min").alias("lng_min"), F.max("lng_max").alias("lng_max"), F.sum("jump_sum").alias("jump_sum"), F.max("jump_max").alias("jump_max"), F.sum("small").alias("small"))


def address_from(blocks: DataFrame) -> DataFrame:
    """First block by which the running signals qualify: points, and an address, place or name (cumulative)."""
    w = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    ok = (F.sum("points").over(w) > 0) & (F.sum("tagged").over(w) > 0)
    return blocks.withColumn("ok", ok).where("ok").agg(F.min("block").alias("block"))


def path_tree(events: DataFrame) -> DataFrame:
    """(path, k): number, first and last sequence number and value; last is null until a second one is seen."""
    again = F.count("*") > 1
    return events.groupBy("path", "k").agg(F.count("*").alias("n"), F.min("seq").alias("first"), F.min_by("v", "seq").alias("first_value"), F.when(again, F.max("seq")).alias("last"), F.when(again, F.max_by("v", "seq")).alias("last_value"))


def sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """A sample of fixed size that depends on the keys alone."""
    return df.orderBy(F.xxhash64(key), key).limit(most)


def percentiles(df: DataFrame, by: list[str], value: str, of: dict[str, float]) -> DataFrame:
    """(by, a column for each of ``of``): the value at floor(n * p) of a group's sorted values (the last one at most).

    Values are counted first, so a group is never held as a list: its distinct values pass in order once.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    upto = F.sum("_n").over(group.orderBy(value))
    placed = counted.withColumn("_to", upto).withColumn("_all", F.sum("_n").over(group))
    rank = lambda p: F.least(F.col("_all") - 1, F.floor(F.col("_all") * F.lit(p)))
    return placed.groupBy(*by).agg(*(F.min(F.when(F.col("_to") > rank(p), F.col(value))).alias(name) for name, p in of.items()))
