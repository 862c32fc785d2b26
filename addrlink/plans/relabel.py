"""Relabelling the state of map tables of many slices: which slices there are, and the four families in order."""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geo, text
from ..operators import region
from ..operators.extract import first_of
from ..operators.lineage import cut
from ..sources import delimited

#: How datasets of a family are called, and whether there is one for each state.
FAMILY = {"street": ("OSM_LOGRADOURO_", True), "geometry": ("OSM_LOGRADOURO_GEOM_", True), "address": ("OSM_ADDR_POINT_", True), "neighbourhood": ("OSM_BAIRRO", False)}
SCHEMA = {"street": schemas.STREET, "geometry": schemas.GEOMETRY, "address": schemas.ADDRESS, "neighbourhood": schemas.NEIGHBOURHOOD}


def datasets(folder: str, family: str) -> list[str]:
    """Dataset keys of a family in a folder, sorted; flat files count by their name without ending."""
    prefix, by_state = FAMILY[family]
    keys = sorted({n[:-4] if n.upper().endswith(".TXT") else n for n in os.listdir(folder)}) if os.path.isdir(folder) else []
    if not by_state:
        return [k for k in keys if k == prefix]
    geometry = FAMILY["geometry"][0]
    return [k for k in keys if k.startswith(prefix) and (family == "geometry" or not k.startswith(geometry))]


def slices(base: str = "", dirs: Iterable[str] = (), only: Iterable[str] = ()) -> list[tuple[str, str]]:
    """(name, folder): the given folders, else ``base`` if it holds tables, else its subfolders that do (those of ``only``)."""
    if dirs := list(dirs):
        return [(os.path.basename(os.path.normpath(d)), d) for d in dirs]
    holds = lambda d: any(datasets(d, f) for f in FAMILY)
    if holds(base):
        return [(os.path.basename(os.path.normpath(base)), base)]
    wanted = {x.lower() for x in only}
    found = [(n, os.path.join(base, n)) for n in sorted(os.listdir(base)) if os.path.isdir(os.path.join(base, n))]
    return [(n, d) for n, d in found if (not wanted or n.lower() in wanted) and holds(d)]


def load(spark: SparkSession, parts: list[tuple[str, str]], family: str) -> DataFrame | None:
    """All rows of a family with slice and file (places in order), line, and the old label; none where no slice has it."""
    out = []
    for n, (_, folder) in enumerate(parts):
        for m, key in enumerate(datasets(folder, family)):
            rows = delimited.read(spark, delimited.resolve_paths(folder, key), SCHEMA[family])
            old = F.lit(key.removeprefix(FAMILY[family][0])) if "uf" not in rows.columns else F.col("uf")
            kind = F.col("osm_type") if "osm_type" in rows.columns else F.lit("")
            out.append(rows.withColumn("uf", old).withColumn("osm_type", kind).withColumn("slice", F.lit(n)).withColumn("file", F.lit(m)).withColumnRenamed("ord", "line"))
    return reduce(DataFrame.unionByName, out) if out else None


def _polygons(once: DataFrame, edges: DataFrame, cells: DataFrame) -> DataFrame:
    """(osm_type, osm_id, poly) of rows with a place."""
    at = once.select(F.struct("osm_type", "osm_id").alias("key"), text.num("lat").alias("lat"), text.num("lng").alias("lng")).where("lat is not null and lng is not null")
    return region.polygon_of(at, edges, cells, "key").select("key.osm_type", "key.osm_id", "poly")


def relabel(spark: SparkSession, parts: list[tuple[str, str]], polygons: DataFrame, out: str, families: Iterable[str] = tuple(FAMILY)) -> DataFrame:
    """Write each family once, by new state, under ``out``; returns (family, old_uf, new_uf, n).

    Streets go first, since geometry follows its street; then address points and neighbourhoods. Nothing is written
    if ``out`` holds a wanted family already. ``polygons`` is (poly, rings), poly being the state.
    """
    wanted = [f for f in FAMILY if f in set(families)]
    taken = [f for f in wanted if os.path.exists(os.path.join(out, f))]
    if taken:
        raise FileExistsError(f"{out} holds {', '.join(taken)} already")
    edges = cut(region.edge_table(polygons))
    cells, counts, streets = cut(region.grid(edges)), [], None
    for family in wanted:
        rows = load(spark, parts, family)
        if rows is None:
            continue
        once = first_of(rows, ["osm_type", "osm_id"], ["slice", "file", "line"])
        if family == "geometry":
            known = streets if streets is not None else spark.createDataFrame([], "osm_id string, new_uf string")
            first = once.select("osm_id", geo.first_point("polyline").alias("p")).where("p is not null").select("osm_id", "p.lat", "p.lng")
            done = region.relabel_geometry(once, known, region.polygon_of(first, edges, cells, "osm_id"))
        else:
            done = region.relabel(once, _polygons(once, edges, cells))
        done = cut(done)
        if family == "street":
            streets = done.where("osm_type in ('way', '')").select("osm_id", "new_uf").dropDuplicates(["osm_id"])
        names = [f.name for f in SCHEMA[family]]
        relabelled = done.withColumn("uf", F.col("new_uf")) if "uf" in names else done
        delimited.write(relabelled.repartition("new_uf", "file").sortWithinPartitions("slice", "file", "line"), os.path.join(out, family), names, ["new_uf"], mode="errorifexists")
        counts.append(region.relabel_counts(done).select(F.lit(family).alias("family"), "old_uf", "new_uf", "n"))
    empty = spark.createDataFrame([], "family string, old_uf string, new_uf string, n long")
    return reduce(DataFrame.unionByName, counts, empty)
