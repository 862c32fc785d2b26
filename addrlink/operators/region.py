"""Which state a feature is in: tags, municipality code, polygons, boxes; and re-labelling of slices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, text

#: State by the first two digits of a municipality code.
IBGE_STATE = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO", "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL",
    "28": "SE", "29": "BA", "31": "MG", "32": "ES", "33": "RJ", "35": "SP", "41": "PR", "42": "SC", "43": "RS", "50": "MS", "51": "MT", "52": "GO", "53": "DF",
}

#: Approximate boxes of the states (lat min, lat max, lng min, lng max).
STATE_BOX = {
    "AC": (-11.15, -7.11, -73.99, -66.62), "AL": (-10.5, -8.81, -38.24, -35.15), "AP": (-1.24, 4.44, -54.88, -49.86), "AM": (-9.82, 2.25, -73.8, -56.1), "BA": (-18.35, -8.53, -46.62, -37.34),
    "CE": (-7.86, -2.78, -41.42, -37.25), "DF": (-16.05, -15.5, -48.29, -47.31), "ES": (-21.35, -17.85, -41.9, -39.65), "GO": (-19.5, -12.4, -53.25, -45.9), "MA": (-10.26, -1.05, -48.76, -41.8),
    "MT": (-18.04, -7.35, -61.63, -50.22), "MS": (-24.07, -17.17, -58.17, -50.92), "MG": (-22.95, -14.2, -51.05, -39.75), "PA": (-9.84, 2.59, -58.9, -46.03), "PB": (-8.3, -6.03, -38.77, -34.79),
    "PR": (-26.72, -22.52, -54.62, -48.02), "PE": (-9.48, -7.15, -41.36, -34.81), "PI": (-10.93, -2.74, -45.99, -40.37), "RJ": (-23.4, -20.7, -44.9, -40.85), "RN": (-6.98, -4.83, -38.58, -34.97),
    "RS": (-33.75, -27.08, -57.65, -49.69), "RO": (-13.69, -7.97, -66.81, -59.77), "RR": (-1.58, 5.27, -64.82, -58.89), "SC": (-29.35, -25.96, -53.84, -48.33), "SP": (-25.35, -19.75, -53.15, -44.05),
    "SE": (-11.57, -9.52, -38.24, -36.39), "TO": (-13.47, -5.17, -50.74, -45.7),
}

#: Regions, and names of the states without accents.
REGIONS = {"norte": "AC AP AM PA RO RR TO", "nordeste": "AL BA CE MA PB PE PI RN SE", "centro-oeste": "DF GO MT MS", "centrooeste": "DF GO MT MS", "co": "DF GO MT MS", "sudeste": "ES MG RJ SP", "se": "ES MG RJ SP", "sul": "PR RS SC"}
STATE_NAMES = {
    "acre": "AC", "alagoas": "AL", "amapa": "AP", "amazonas": "AM", "bahia": "BA", "ceara": "CE", "distrito federal": "DF", "espirito santo": "ES", "goias": "GO", "maranhao": "MA", "mato grosso": "MT", "mato grosso do sul": "MS",
    "minas gerais": "MG", "para": "PA", "paraiba": "PB", "parana": "PR", "pernambuco": "PE", "piaui": "PI", "rio de janeiro": "RJ", "rio grande do norte": "RN", "rio grande do sul": "RS", "rondonia": "RO", "roraima": "RR",
    "santa catarina": "SC", "sao paulo": "SP", "sergipe": "SE", "tocantins": "TO",
}
STATE_TAGS = ["ISO3166-2", "addr:state", "is_in:state", "is_in:state_code", "state", "ref"]


def states_of(text_: str) -> tuple[str, ...]:
    """States named by codes and regions, separated by commas or plus signs."""
    out: list[str] = []
    for token in text_.replace("+", ",").split(","):
        token = token.strip()
        out += REGIONS[token.lower()].split() if token.lower() in REGIONS else [token.upper()] if token else []
    return tuple(dict.fromkeys(out))


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def state_of_code(code: Column | str) -> Column:
    d = F.regexp_replace(F.coalesce(text._c(code).cast("string"), F.lit("")), "[^0-9]", "")
    return F.coalesce(F.element_at(_map(IBGE_STATE), F.substring(d, 1, 2)), F.lit(""))


def state_token(x: Column | str) -> Column:
    """BR-XX, any two letters, or a state's full name; else ''."""
    s = F.trim(F.coalesce(text._c(x), F.lit("")))
    iso = F.upper(F.regexp_extract(s, "(?i)^(?:ISO3166-2:)?BR-([A-Za-z]{2})$", 1))
    return F.when(iso != "", iso).when(s.rlike("^[A-Za-z]{2}$"), F.upper(s)).otherwise(F.coalesce(F.element_at(_map(STATE_NAMES), F.lower(text.strip_accents(s))), F.lit("")))


def state_of_tags(tags: Column | str) -> Column:
    t = text._c(tags)
    get = lambda k: F.coalesce(F.element_at(t, F.lit(k)), F.lit(""))
    named = F.when((get("place") == "state") | (get("admin_level") == "4"), F.coalesce(F.nullif(state_token(get("name")), F.lit("")), state_token(get("name:pt"))))
    return F.coalesce(*(F.nullif(state_token(get(k)), F.lit("")) for k in STATE_TAGS), F.nullif(named, F.lit("")), F.lit(""))


def state_of_box(lat: Column | str, lng: Column | str, states: tuple[str, ...] = ()) -> Column:
    """The smallest box that holds the point; '' where none does. Twenty-seven constant boxes need no join."""
    y, x = text._c(lat), text._c(lng)
    order = sorted((s for s in STATE_BOX if not states or s in states), key=lambda s: (STATE_BOX[s][1] - STATE_BOX[s][0]) * (STATE_BOX[s][3] - STATE_BOX[s][2]))
    boxes = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("uf", "y0", "y1", "x0", "x1"), (s, *map(float, STATE_BOX[s])), strict=True))) for s in order))
    hit = F.filter(boxes, lambda b: y.between(b["y0"], b["y1"]) & x.between(b["x0"], b["x1"]))  # one small expression instead of 27 in the generated code
    return F.coalesce(F.get(hit, F.lit(0))["uf"], F.lit(""))


def edge_table(polygons: DataFrame) -> DataFrame:
    """(poly, ay, ax, by, bx) of polygons given as poly and rings: arrays of flat lng, lat numbers; rings close themselves."""
    ring = polygons.select("poly", F.posexplode("rings").alias("ring_no", "ring"))
    n = F.floor(F.size("ring") / 2).cast("int")
    at = ring.withColumn("n", n).where("n >= 3").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    nxt = (F.col("i") + 1) % F.col("n")
    g = lambda k: F.get("ring", k.cast("int"))
    return at.select("poly", g(F.col("i") * 2 + 1).alias("ay"), g(F.col("i") * 2).alias("ax"), g(nxt * 2 + 1).alias("by"), g(nxt * 2).alias("bx"))


def inside(points: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """``points`` (keys, poly, lat, lng) with inside (null where the polygon is unknown) and km to its border."""
    crossed = F.sum(F.when(geo.edge_crossed("lat", "lng", "ay", "ax", "by", "bx"), 1).otherwise(0))
    touched = F.max(geo.edge_touched("lat", "lng", "ay", "ax", "by", "bx"))
    got = points.join(edges, "poly").groupBy(*keys, "poly").agg((touched | (crossed % 2 == 1)).alias("inside"), F.min(geo.edge_km("lat", "lng", "ay", "ax", "by", "bx")).alias("border_km"))
    return points.join(got, [*keys, "poly"], "left")


def validation(checked: DataFrame, by: str) -> DataFrame:
    """(by): rows, inside, outside, without a polygon, and outside by distance band, of checked rows (by, inside, band)."""
    of = lambda c: F.count(F.when(c, 1))
    bands = (of(F.col("band") == b).alias(b) for b in ("ate_1km", "de_1_a_5km", "de_5_a_25km", "mais_de_25km"))
    return checked.groupBy(by).agg(F.count("*").alias("n"), of(F.col("inside")).alias("inside"), of(~F.col("inside")).alias("outside"), of(F.col("inside").isNull()).alias("unknown"), *bands)


def worst(checked: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows furthest outside their polygon; ties by ord."""
    return checked.where(~F.col("inside")).orderBy(F.desc("border_km"), "ord").limit(n)


def examples(rows: DataFrame, by: str, n: int) -> DataFrame:
    """The first ``n`` rows (by ord) of each value of ``by``; each task keeps at most n of a value before they meet."""
    nth = F.row_number().over(Window.partitionBy(by).orderBy("ord"))
    return rows.where(F.col(by).isNotNull()).withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def grid(edges: DataFrame, size: float = 0.25) -> DataFrame:
    """(poly, ci, cj, whole): cells of each polygon's box that it covers wholly, or may cover in part.

    A cell that no edge's box meets is either all inside or all outside, so its centre decides.
    """
    box = edges.groupBy("poly").agg(F.min(F.least("ay", "by")).alias("y0"), F.max(F.greatest("ay", "by")).alias("y1"), F.min(F.least("ax", "bx")).alias("x0"), F.max(F.greatest("ax", "bx")).alias("x1"))
    span = lambda lo, hi: F.explode(F.sequence(geo.cell(lo, size), geo.cell(hi, size)))
    cells = box.withColumn("ci", span("y0", "y1")).withColumn("cj", span("x0", "x1")).select("poly", "ci", "cj")
    cut = edges.withColumn("ci", span(F.least("ay", "by"), F.greatest("ay", "by"))).withColumn("cj", span(F.least("ax", "bx"), F.greatest("ax", "bx"))).select("poly", "ci", "cj").distinct()
    free = cells.join(cut, ["poly", "ci", "cj"], "left_anti").withColumn("lat", (F.col("ci") + 0.5) * size).withColumn("lng", (F.col("cj") + 0.5) * size)
    whole = inside(free, edges, ["ci", "cj"]).where("inside").select("poly", "ci", "cj", F.lit(True).alias("whole"))
    return whole.unionByName(cut.select("poly", "ci", "cj", F.lit(False).alias("whole")))


def polygon_of(points: DataFrame, edges: DataFrame, cells: DataFrame, key: str, size: float = 0.25) -> DataFrame:
    """(key, poly): the alphabetically first polygon that holds each point. Only points in cut cells meet edges."""
    near = points.withColumn("ci", geo.cell("lat", size)).withColumn("cj", geo.cell("lng", size)).join(cells, ["ci", "cj"])
    sure = near.where("whole").select(key, "poly")
    maybe = inside(near.where("not whole").select(key, "poly", "lat", "lng"), edges, [key]).where("inside").select(key, "poly")
    return sure.unionByName(maybe).groupBy(key).agg(F.min("poly").alias("poly"))


def resolve(features: DataFrame, polygon: DataFrame | None, key: str, states: tuple[str, ...] = ()) -> DataFrame:
    """``features`` (key, tags, ibge, lat, lng) with ``uf``: tags, code, polygon, box, XX; wanted states' boxes go before all boxes."""
    box = F.nullif(state_of_box("lat", "lng"), F.lit(""))
    boxes = [F.nullif(state_of_box("lat", "lng", states), F.lit("")), box] if states else [box]
    out = features.join(polygon, key, "left") if polygon is not None else features.withColumn("poly", F.lit(None).cast("string"))
    return out.withColumn("uf", F.coalesce(F.nullif(state_of_tags("tags"), F.lit("")), F.nullif(state_of_code("ibge"), F.lit("")), "poly", *boxes, F.lit("XX"))).drop("poly")


def relabel(slices: DataFrame, polygon: DataFrame) -> DataFrame:
    """Rows of all slices once each (first slice, file and line win by kind and id), with ``new_uf``: polygon, known old label, XX.

    ``polygon`` is (osm_id, poly), or (osm_type, osm_id, poly) where kinds share ids.
    """
    from .extract import first_of

    once = first_of(slices, ["osm_type", "osm_id"], ["slice", "file", "line"])
    known = F.when(F.col("uf").isin(list(STATE_BOX)), F.col("uf"))
    on = [c for c in ("osm_type", "osm_id") if c in polygon.columns]
    return once.join(polygon, on, "left").withColumn("new_uf", F.coalesce("poly", known, F.lit("XX"))).drop("poly")


def relabel_geometry(geometry: DataFrame, streets: DataFrame, polygon_of_first: DataFrame) -> DataFrame:
    """Geometry follows its street's new state, else its first point's polygon, else its old label."""
    from .extract import first_of

    once = first_of(geometry, ["osm_id"], ["slice", "file", "line"])
    out = once.join(streets.select("osm_id", F.col("new_uf").alias("s_uf")), "osm_id", "left").join(polygon_of_first, "osm_id", "left")
    return out.withColumn("new_uf", F.coalesce("s_uf", "poly", "uf")).drop("s_uf", "poly")


def relabel_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("uf").alias("old_uf"), "new_uf").agg(F.count("*").alias("n"))


def rings_from_geojson(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(poly, rings) of a GeoJSON FeatureCollection; polygons and multi-polygons, longest ring first."""
    raw = spark.read.option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    shape = F.to_json("f.geometry.coordinates")
    poly = F.from_json(shape, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(shape, "array<array<array<array<double>>>>"))
    rings = F.when(F.col("f.geometry.type") == "Polygon", poly).otherwise(multi)
    flat = F.transform(F.filter(rings, lambda r: F.size(r) >= 4), lambda r: F.flatten(F.transform(r, lambda p: F.slice(p, 1, 2))))
    ordered = F.transform(F.sort_array(F.transform(flat, lambda r: F.struct(F.size(r).alias("n"), r.alias("r"))), asc=False), lambda x: x["r"])
    return raw.select(F.col(f"f.properties.{name}").cast("string").alias("poly"), ordered.alias("rings"))


def simplify(polygons: DataFrame, eps: float, decimals: int = 4) -> DataFrame:
    """Douglas-Peucker for each ring, coordinates rounded; rings of under four points go."""
    def keep(ring) -> list[float] | None:
        p = np.asarray(ring, float).reshape(-1, 2)
        kept, todo = np.zeros(len(p), bool), [(0, len(p) - 1)]
        kept[[0, -1]] = True
        while todo:
            a, b = todo.pop()
            if b - a < 2:
                continue
            d, q = p[b] - p[a], p[a + 1 : b] - p[a]
            n = float(d @ d)
            t = np.clip(q @ d / n, 0, 1) if n else np.zeros(len(q))
            off = np.hypot(*(q - t[:, None] * d).T)
            k = int(off.argmax())
            if off[k] > eps:
                kept[a + 1 + k] = True
                todo += [(a, a + 1 + k), (a + 1 + k, b)]
        out = p[kept].round(decimals)
        return out.reshape(-1).tolist() if len(out) >= 4 else None

    @F.pandas_udf("array<double>")
    def simple(rings: pd.Series) -> pd.Series:
        return rings.map(keep)

    ring = polygons.select("poly", F.posexplode("rings").alias("no", "ring")).withColumn("ring", simple("ring")).where("ring is not null")
    return ring.groupBy("poly").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.size("ring")).alias("n"), "no", "ring"))), lambda x: x["ring"]).alias("rings"))
