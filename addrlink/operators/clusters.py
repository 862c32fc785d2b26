"""Spatial clusters of same-named features, and their summaries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text


def _label(cells: pd.DataFrame) -> pd.DataFrame:
    """Components of a name's cells that touch (also at corners); a component is named by its least cell."""
    at = {c: n for n, c in enumerate(zip(cells["ci"], cells["cj"], strict=True))}
    root = list(range(len(at)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for (i, j), n in at.items():
        for near in ((i, j + 1), (i + 1, j - 1), (i + 1, j), (i + 1, j + 1)):
            if (m := at.get(near)) is not None:
                a, b = find(n), find(m)
                root[max(a, b)] = min(a, b)
    tops: dict[int, tuple] = {}
    for c, n in at.items():
        r = find(n)
        tops[r] = min(c, tops.get(r, c))
    top = [tops[find(n)] for n in range(len(at))]
    return cells.assign(comp_i=[t[0] for t in top], comp_j=[t[1] for t in top])


def components(feats: DataFrame, size: float, by: tuple[str, ...] = ("name_norm",)) -> DataFrame:
    """``feats`` with comp_i, comp_j: the least cell of the feature's component among equal names.

    Only distinct cells of names with several cells go to Python; a name's cells are
    few next to its features. The rest never leaves the JVM.
    """
    celled = feats.withColumn("ci", geo.cell("lat", size)).withColumn("cj", geo.cell("lng", size))
    cells = celled.select(*by, "ci", "cj").distinct()
    names = cells.groupBy(*by).agg(F.count("*").alias("cells"))
    many = cells.join(names.where("cells > 1").select(*by), [*by])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.schema) + ", comp_i bigint, comp_j bigint"
    labelled = many.groupBy(*by).applyInPandas(_label, schema)
    return celled.join(labelled, [*by, "ci", "cj"], "left").withColumn("comp_i", F.coalesce("comp_i", "ci")).withColumn("comp_j", F.coalesce("comp_j", "cj")).drop("ci", "cj")


def summarise(feats: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted centre, box, kinds, ways and weight of each group of features (n below 1 counts as 1)."""
    w = F.greatest(F.coalesce(F.col("n"), F.lit(1)), F.lit(1)).cast("double")
    kind = F.nullif(F.col("kind"), F.lit(""))
    return feats.groupBy(*keys).agg(
        (F.sum(F.col("lat") * w) / F.sum(w)).alias("lat"),
        (F.sum(F.col("lng") * w) / F.sum(w)).alias("lng"),
        F.min("lat_min").alias("lat_min"), F.max("lat_max").alias("lat_max"), F.min("lng_min").alias("lng_min"), F.max("lng_max").alias("lng_max"),
        F.array_join(F.sort_array(F.collect_set(kind)), "+").alias("kinds"),
        F.count("*").alias("ways"), F.sum(w).alias("weight"),
        F.coalesce(F.max(kind.isNotNull() & ~text.is_area_kind(kind)), F.lit(False)).alias("has_via"),
        F.coalesce(F.max(text.is_area_kind(kind)), F.lit(False)).alias("has_area"),
    )


def clusters(feats: DataFrame, size: float) -> DataFrame:
    """One row for each (name_norm, component)."""
    return summarise(components(feats, size), ["name_norm", "comp_i", "comp_j"])


def footprint(points: DataFrame, size: float, dilate: int, key: str = "loc_nu") -> DataFrame:
    """Distinct cells of a locality's points, grown by ``dilate`` cells on each side."""
    base = points.select(key, geo.cell("lat", size).alias("i"), geo.cell("lng", size).alias("j")).distinct()
    span = F.sequence(F.lit(-dilate).cast("long"), F.lit(dilate).cast("long"))
    return base.withColumn("di", F.explode(span)).withColumn("dj", F.explode(span)).select(key, (F.col("i") + F.col("di")).alias("ci"), (F.col("j") + F.col("dj")).alias("cj")).distinct()


def trim_outliers(points: DataFrame, radius_km: float, mass_cell: float, key: str = "loc_nu", order: str = "ord") -> DataFrame:
    """Points within ``radius_km`` of the centre of their locality's fullest cell (ties: seen first).

    Localities of one point and radii of at most 0 keep all; a locality never loses all its points.
    """
    if radius_km <= 0:
        return points
    celled = points.withColumn("mi", geo.cell("lat", mass_cell)).withColumn("mj", geo.cell("lng", mass_cell))
    per = celled.groupBy(key, "mi", "mj").agg(F.count("*").alias("n"), F.min(order).alias("first"), F.avg("lat").alias("clat"), F.avg("lng").alias("clng"))
    mass = per.groupBy(key).agg(F.max_by(F.struct("clat", "clng"), F.struct("n", -F.col("first"))).alias("c"), F.sum("n").alias("total"))
    joined = points.join(mass, key)
    return joined.where((F.col("total") < 2) | (geo.dist_km(F.col("c.clat"), F.col("c.clng"), "lat", "lng") <= radius_km)).drop("c", "total")
