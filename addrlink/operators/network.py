"""The street network: crossings and connections between way geometries, and evenly spaced points along them."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..params import NetworkParams

MERGE_KM = 0.0005


def in_bbox(ways: DataFrame, bbox: tuple[float, float, float, float]) -> DataFrame:
    """Ways whose envelope meets lng_min, lat_min, lng_max, lat_max."""
    lats, lngs = F.transform("points", lambda p: p["lat"]), F.transform("points", lambda p: p["lng"])
    return ways.where((F.array_min(lngs) <= bbox[2]) & (F.array_max(lngs) >= bbox[0]) & (F.array_min(lats) <= bbox[3]) & (F.array_max(lats) >= bbox[1]))


def segments(ways: DataFrame) -> DataFrame:
    """(way, seg, ay, ax, by, bx) of consecutive points."""
    at = ways.select("way", "points", F.explode(F.when(F.size("points") > 1, F.sequence(F.lit(0), F.size("points") - 2))).alias("seg"))
    a, b = F.get("points", F.col("seg")), F.get("points", F.col("seg") + 1)
    return at.select("way", "seg", a["lat"].alias("ay"), a["lng"].alias("ax"), b["lat"].alias("by"), b["lng"].alias("bx"))


def with_cells(segs: DataFrame, size: float, margin: int = 1) -> DataFrame:
    """A row for each grid cell of a segment's box, grown by ``margin`` cells."""
    span = lambda lo, hi: F.explode(F.sequence(geo.cell(F.least(lo, hi), size) - margin, geo.cell(F.greatest(lo, hi), size) + margin))
    return segs.withColumn("ci", span("ay", "by")).withColumn("cj", span("ax", "bx"))


def apart(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never sent whole: Spark's estimate of its size does not see what an explode adds."""
    return df.hint("merge")


def shared_vertices(ways: DataFrame) -> DataFrame:
    """Pairs of ways that have a point in common (millionths of a degree)."""
    v = ways.select("way", F.explode("points").alias("p")).select("way", geo.micro("p.lat").alias("a"), geo.micro("p.lng").alias("b"), F.col("p.lat").alias("lat"), F.col("p.lng").alias("lng")).dropDuplicates(["way", "a", "b"])
    w = v.select(F.col("way").alias("other"), "a", "b")
    return v.join(apart(w), ["a", "b"]).where("way < other").select(F.col("way").alias("way_a"), F.col("other").alias("way_b"), "lat", "lng", F.lit("conexao").alias("kind"))


SHAPE = ["ay", "ax", "by", "bx"]


def crossings(ways: DataFrame, size: float) -> DataFrame:
    """Proper crossings of segments of different ways. A pair meets in many cells and is looked at once.

    Segments of one shape are looked at once, too, and become those of their ways where they cross.
    """
    s = segments(ways)
    one = with_cells(s.select(*SHAPE).distinct(), size, 0)
    two = one.select(*(F.col(c).alias(f"o_{c}") for c in SHAPE), "ci", "cj")
    # the cell that both boxes hold first is the only one in which the pair counts
    top_i, top_j = (F.greatest(geo.cell(F.least(a, b), size), geo.cell(F.least(f"o_{a}", f"o_{b}"), size)) for a, b in (("ay", "by"), ("ax", "bx")))
    pairs = one.join(apart(two), ["ci", "cj"]).where((F.col("ci") == top_i) & (F.col("cj") == top_j))
    hit = geo.intersection("ay", "ax", "by", "bx", "o_ay", "o_ax", "o_by", "o_bx")
    found = pairs.select(*SHAPE, *(f"o_{c}" for c in SHAPE), hit.alias("x")).where("x is not null")
    other = s.select(F.col("way").alias("o_way"), *(F.col(c).alias(f"o_{c}") for c in SHAPE))
    both = found.join(apart(s), SHAPE).join(apart(other), [f"o_{c}" for c in SHAPE]).where("way < o_way")
    return both.select(F.col("way").alias("way_a"), F.col("o_way").alias("way_b"), "x.lat", "x.lng", F.lit("cruzamento").alias("kind"))


def touches(ways: DataFrame, size: float, touch_km: float) -> DataFrame:
    """Ends of ways that lie within ``touch_km`` of the inside of another way's segment. Equal shapes and equal ends are looked at once."""
    s = segments(ways)
    ends = ways.where(F.size("points") > 0).select("way", F.explode(F.array(F.get("points", F.lit(0)), F.get("points", F.size("points") - 1))).alias("p")).select(F.col("way").alias("e_way"), F.col("p.lat").alias("py"), F.col("p.lng").alias("px")).distinct()
    spots = ends.select("py", "px").distinct().withColumn("ci", geo.cell("py", size)).withColumn("cj", geo.cell("px", size))
    near = with_cells(s.select(*SHAPE).distinct(), size, 1).join(apart(spots), ["ci", "cj"]).withColumn("q", geo.project("py", "px", "ay", "ax", "by", "bx"))
    found = near.where((F.col("q.km") <= touch_km) & (F.col("q.t") > 0) & (F.col("q.t") < 1)).select(*SHAPE, "py", "px", F.col("q.lat").alias("lat"), F.col("q.lng").alias("lng"))
    kept = found.join(apart(s), SHAPE).join(apart(ends), ["py", "px"]).where("way != e_way")
    return kept.select(F.least("way", "e_way").alias("way_a"), F.greatest("way", "e_way").alias("way_b"), "lat", "lng", F.lit("conexao").alias("kind"))


def hits(ways: DataFrame, p: NetworkParams | None = None) -> DataFrame:
    """Distinct (way_a, way_b, kind, point) of shared points, touches and crossings."""
    p = p or NetworkParams()
    ways = in_bbox(ways, p.bbox) if p.bbox else ways
    every = shared_vertices(ways).unionByName(touches(ways, p.cell, p.touch_km)).unionByName(crossings(ways, p.cell))
    # dealt by way_a once: the grouping and a join on way_a that follows need no other shuffle
    return every.withColumn("a", geo.micro("lat")).withColumn("b", geo.micro("lng")).repartition("way_a").groupBy("way_a", "way_b", "kind", "a", "b").agg(F.min("lat").alias("lat"), F.min("lng").alias("lng"))


def edges(found: DataFrame, streets: DataFrame) -> DataFrame:
    """Hits as edges between the streets of their ways (ids as strings, lower first); a street does not meet itself."""
    a = streets.select(F.col("way").alias("way_a"), F.col("street").cast("string").alias("sa"))
    b = streets.select(F.col("way").alias("way_b"), F.col("street").cast("string").alias("sb"))
    both = found.join(apart(a), "way_a").join(apart(b), "way_b").where("sa != sb")
    return both.select(F.least("sa", "sb").alias("lo"), F.greatest("sa", "sb").alias("hi"), "kind", "way_a", "way_b", "a", "b", geo.round7("lat").alias("lat"), geo.round7("lng").alias("lng")).dropDuplicates(["lo", "hi", "kind", "way_a", "way_b", "a", "b"]).drop("a", "b")


def _anchors(most_km: float):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        out, rank = [], {"vertice": 0}
        kept: list[list] = []
        for r in g.sort_values(["along", "label"]).itertuples():
            if kept and r.along - kept[-1][0] <= MERGE_KM:
                if rank.get(kept[-1][3], 1) < rank.get(r.label, 1):
                    kept[-1][3] = r.label
                continue
            kept.append([r.along, r.lat, r.lng, r.label])
        way = g["way"].iloc[0]
        for n, (along, lat, lng, label) in enumerate(kept):
            out.append((way, along, lat, lng, label))
            if n + 1 < len(kept):
                b = kept[n + 1]
                d = _km(lat, lng, b[1], b[2])
                m = math.ceil(d / most_km)
                out += [(way, along + (b[0] - along) * k / m, lat + (b[1] - lat) * k / m, lng + (b[2] - lng) * k / m, "amostra") for k in range(1, m)]
        return pd.DataFrame(out, columns=["way", "along", "lat", "lng", "label"])

    return run


def _km(a: float, b: float, c: float, d: float) -> float:
    dy, dx = (c - a) * geo.KM, (d - b) * geo.KM * math.cos(math.radians((a + c) / 2))
    return math.sqrt(dx * dx + dy * dy)


def densify(ways: DataFrame, found: DataFrame, p: NetworkParams | None = None) -> DataFrame:
    """Points along each way: its vertices and hits, merged where they fall together, and samples in between.

    The merge compares with the point kept last, so a way's points are folded in order, a way at a time.
    """
    p = p or NetworkParams()
    s = segments(ways).withColumn("km", geo.dist_km("ay", "ax", "by", "bx"))
    from pyspark.sql import Window

    before = F.coalesce(F.sum("km").over(Window.partitionBy("way").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    s = s.withColumn("start", before)
    last = F.row_number().over(Window.partitionBy("way").orderBy(F.desc("seg")))
    ends = s.withColumn("nth", last).where("nth = 1").select("way", (F.col("start") + F.col("km")).alias("along"), F.col("by").alias("lat"), F.col("bx").alias("lng"), F.lit("vertice").alias("label"))
    vertices = s.select("way", F.col("start").alias("along"), F.col("ay").alias("lat"), F.col("ax").alias("lng"), F.lit("vertice").alias("label")).unionByName(ends)
    extra = found.select(F.explode(F.array("way_a", "way_b")).alias("way"), F.col("lat").alias("py"), F.col("lng").alias("px"), "kind")
    on = extra.join(s, "way").withColumn("q", geo.project("py", "px", "ay", "ax", "by", "bx"))
    nearest = on.groupBy("way", "py", "px", "kind").agg(F.min_by(F.struct((F.col("start") + F.col("km") * F.col("q.t")).alias("along"), F.col("q.lat").alias("lat"), F.col("q.lng").alias("lng")), F.struct("q.km", "seg")).alias("z"))
    return vertices.unionByName(nearest.select("way", "z.along", "z.lat", "z.lng", F.col("kind").alias("label"))).groupBy("way").applyInPandas(_anchors(p.max_segment_km), "way long, along double, lat double, lng double, label string")


def counts(found: DataFrame, points: DataFrame, geometry: DataFrame) -> DataFrame:
    """(kind, value, n): hits by kind, dense points by origin, ways by one-way code (0 where there is none)."""
    of = lambda df, kind, value: df.groupBy(F.lit(kind).alias("kind"), value.alias("value")).agg(F.count("*").alias("n"))
    code = F.coalesce(F.nullif(F.col("oneway").cast("string"), F.lit("")), F.lit("0"))
    return of(found, "hit", F.col("kind")).unionByName(of(points, "point", F.col("label"))).unionByName(of(geometry, "oneway", code))


def geometry_of(geometry: DataFrame, ids: DataFrame) -> DataFrame:
    """The first geometry row of each wanted id."""
    from .extract import first_of

    return first_of(geometry.join(ids, "osm_id", "left_semi"), ["osm_id"], ["ord"])
