"""Streets, places, address points and geometry from decoded map data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text

#: Place tags of each feature class and the roles of a relation's centre.
MUNICIPALITY_PLACES = ["city", "municipality", "town"]
NEIGHBOURHOOD_PLACES = ["suburb", "neighbourhood", "quarter", "district"]
CENTRE_ROLES = ["admin_centre", "label", "capital"]


def _get(tags: Column | str, key: str) -> Column:
    t = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(F.element_at(t, F.lit(key)), F.lit(""))


def _admin(tags, level: str) -> Column:
    return (_get(tags, "boundary") == "administrative") & (_get(tags, "admin_level") == level)


def is_state(tags) -> Column:
    return (_get(tags, "place") == "state") | _admin(tags, "4")


def is_municipality(tags) -> Column:
    return _get(tags, "place").isin(MUNICIPALITY_PLACES) | _admin(tags, "8")


def is_neighbourhood(tags) -> Column:
    return _get(tags, "place").isin(NEIGHBOURHOOD_PLACES)


def is_street_way(tags) -> Column:
    return (text.street_kind(tags) != "") & (text.display_name(tags) != "")


def is_street_node(tags) -> Column:
    return (_get(tags, "place") == "square") & (text.display_name(tags) != "")


def is_address(tags) -> Column:
    return _get(tags, "addr:street") != ""


def way_geometry(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Mean and box of a way's resolved refs (repeats count), all its refs counted, points in order.

    ``ways`` has id and refs, ``nodes`` id, lat, lon. One shuffle join on the node
    id; node rows no way asks for are left out of it by the join itself. A way
    without a resolved ref has null geometry.
    """
    refs = ways.select("id", F.posexplode("refs").alias("pos", "ref"))
    placed = refs.join(nodes.select(F.col("id").alias("ref"), "lat", F.col("lon").alias("lng")), "ref", "left")
    found = F.col("lat").isNotNull()
    return placed.groupBy("id").agg(
        F.avg("lat").alias("lat"), F.avg("lng").alias("lng"), F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"), F.min("lng").alias("lng_min"), F.max("lng").alias("lng_max"), F.count("*").alias("way_node_count"),
        F.transform(F.sort_array(F.collect_list(F.when(found, F.struct("pos", "lat", "lng")))), lambda p: F.struct(p["lat"].alias("lat"), p["lng"].alias("lng"))).alias("points"),
    )


def relation_points(relations: DataFrame, nodes: DataFrame) -> DataFrame:
    """Point of a relation: its first member, in order, that is a node with a centre's role and resolves."""
    members = relations.select("id", F.posexplode("members").alias("pos", "m")).where((F.col("m.type") == 0) & F.col("m.role").isin(CENTRE_ROLES))
    placed = members.select("id", "pos", F.col("m.id").alias("ref")).join(nodes.select(F.col("id").alias("ref"), "lat", F.col("lon").alias("lng")), "ref")
    return placed.groupBy("id").agg(F.min_by(F.struct("lat", "lng"), "pos").alias("p")).select("id", "p.lat", "p.lng")


def street_rows(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """The street table: named ways of a street kind, and squares mapped as nodes."""
    name = text.display_name("tags")
    kept = ways.where(is_street_way("tags"))
    geom = way_geometry(kept.select("id", "refs"), nodes)
    city = F.coalesce(F.nullif(_get("tags", "addr:city"), F.lit("")), F.nullif(_get("tags", "is_in:city"), F.lit("")), F.lit(""))
    fields = lambda d, kind, points: d.select(
        "id", name.alias("name"), text.name_norm(name).alias("name_norm"), kind.alias("kind"), city.alias("city"), text.name_norm(city).alias("city_norm"), _get("tags", "addr:suburb").alias("suburb"), text.name_norm(_get("tags", "addr:suburb")).alias("suburb_norm"),
        _get("tags", "addr:postcode").alias("postcode"), F.array_join(text.alt_names("tags", name), ";").alias("name_alt"), F.array_join(F.filter(F.transform(text.alt_names("tags", name), text.name_norm), lambda x: x != ""), ";").alias("name_alt_norm"), text.oneway_code(_get("tags", "oneway")).alias("oneway"),
        *(["lat", "lon"] if points else []),
    )
    by_way = fields(kept, text.street_kind("tags"), False).join(geom, "id").withColumn("polyline", geo.encode_polyline("points")).withColumn("osm_type", F.lit("way")).drop("points")
    squares = fields(nodes.where(is_street_node("tags")), F.lit("square"), True)
    by_node = squares.withColumnRenamed("lon", "lng")
    for c, base in (("lat_min", "lat"), ("lat_max", "lat"), ("lng_min", "lng"), ("lng_max", "lng")):
        by_node = by_node.withColumn(c, F.col(base))
    by_node = by_node.withColumn("way_node_count", F.lit(1).cast("long")).withColumn("polyline", F.lit("")).withColumn("osm_type", F.lit("node"))
    return by_way.unionByName(by_node.select(*by_way.columns))


def address_rows(nodes: DataFrame) -> DataFrame:
    return nodes.where(is_address("tags")).select(
        "id", "lat", F.col("lon").alias("lng"), _get("tags", "addr:street").alias("street"), text.name_norm(_get("tags", "addr:street")).alias("street_norm"), _get("tags", "addr:housenumber").alias("housenumber"), _get("tags", "addr:city").alias("city"), _get("tags", "addr:suburb").alias("suburb"), _get("tags", "addr:postcode").alias("postcode"), text.display_name("tags").alias("name"),
    )


def place_rows(nodes: DataFrame, which: Column) -> DataFrame:
    """States, municipalities or neighbourhoods mapped as nodes."""
    name = text.display_name("tags")
    return nodes.where(which & (name != "")).select("id", name.alias("name"), text.name_norm(name).alias("name_norm"), text.ibge_of("tags").alias("ibge"), text.ibge_source("tags").alias("source_tag"), "lat", F.col("lon").alias("lng"), _get("tags", "admin_level").alias("admin_level"), _get("tags", "place").alias("place"))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")
