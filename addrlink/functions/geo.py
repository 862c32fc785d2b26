"""Planar geometry on degrees as Column expressions. Three degree lengths are in use and are kept apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Km a degree for distances, for the width of extents, and for polygon borders.
KM, KM_WIDE, KM_BORDER = 111.0, 102.0, 111.1949
ON_EDGE = 1e-7


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cell(x: Column | str, size: float) -> Column:
    return F.floor(_c(x) / F.lit(float(size))).cast("long")


def dist_km(lat1, lng1, lat2, lng2) -> Column:
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    dy = (lat2 - lat1) * KM
    dx = (lng2 - lng1) * KM * F.cos(F.radians((lat1 + lat2) / 2))
    return F.sqrt(dx * dx + dy * dy)


def extent_km(lat_min, lat_max, lng_min, lng_max) -> Column:
    return F.greatest((_c(lat_max) - _c(lat_min)) * KM, (_c(lng_max) - _c(lng_min)) * KM_WIDE)


def jump_deg(lat1, lng1, lat2, lng2) -> Column:
    """Distance in degrees, the short way round the globe."""
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    dx = F.abs(lng2 - lng1)
    dx = F.when(dx > 180, 360 - dx).otherwise(dx)
    return F.sqrt((lat2 - lat1) * (lat2 - lat1) + dx * dx)


def micro(x: Column | str) -> Column:
    """Millionths of a degree, halves upwards."""
    return F.floor(_c(x) * 1e6 + 0.5).cast("long")


def round7(x: Column | str) -> Column:
    return F.floor(_c(x) * 1e7 + 0.5) / 1e7


def encode_polyline(points: Column | str) -> Column:
    """array<struct<lat,lng>> to 'lat,lng;dlat,dlng;...' in millionths, without consecutive repeats."""
    whole = F.transform(_c(points), lambda p: F.struct(micro(p["lat"]).alias("a"), micro(p["lng"]).alias("b")))
    kept = F.filter(whole, lambda p, i: (i == 0) | (p != F.get(whole, i - 1)))
    text = F.transform(kept, lambda p, i: F.concat_ws(",", (p["a"] - F.when(i > 0, F.get(kept, i - 1)["a"]).otherwise(0)).cast("string"), (p["b"] - F.when(i > 0, F.get(kept, i - 1)["b"]).otherwise(0)).cast("string")))
    return F.array_join(text, ";")


def decode_polyline(x: Column | str, strict: bool = True) -> Column:
    """Back to array<struct<lat,lng>>; malformed text raises, or is null when not ``strict``."""
    x = _c(x)
    ok = x.rlike(r"^-?[0-9]+,-?[0-9]+(;-?[0-9]+,-?[0-9]+)*$")
    steps = F.transform(F.split(F.when(ok, x), ";"), lambda s: F.struct(F.split_part(s, F.lit(","), F.lit(1)).cast("long").alias("a"), F.split_part(s, F.lit(","), F.lit(2)).cast("long").alias("b")))
    start = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.array().cast("array<struct<lat:double,lng:double>>").alias("out"))
    step = lambda acc, s: F.struct((acc["a"] + s["a"]).alias("a"), (acc["b"] + s["b"]).alias("b"), F.concat(acc["out"], F.array(F.struct(((acc["a"] + s["a"]) / 1e6).alias("lat"), ((acc["b"] + s["b"]) / 1e6).alias("lng")))).alias("out"))
    out = F.aggregate(steps, start, step, lambda acc: acc["out"])
    empty = F.array().cast("array<struct<lat:double,lng:double>>")
    bad = F.raise_error(F.concat(F.lit("not a polyline: "), F.substring(x, 1, 40))).cast("array<struct<lat:double,lng:double>>") if strict else F.lit(None)
    return F.when(x.isNull() | (x == ""), empty).when(ok, out).otherwise(bad)


def count_polyline(x: Column | str) -> Column:
    x = _c(x)
    return F.when(x.isNull() | (x == ""), 0).otherwise(F.size(F.split(x, ";")))


def first_point(x: Column | str) -> Column:
    """First point of a polyline; null where there is none."""
    head = F.split_part(_c(x), F.lit(";"), F.lit(1))
    lat, lng = (F.split_part(head, F.lit(","), F.lit(i)).try_cast("double") / 1e6 for i in (1, 2))
    return F.when(lat.isNotNull() & lng.isNotNull(), F.struct(lat.alias("lat"), lng.alias("lng")))


def polyline_km(points: Column | str) -> Column:
    p = _c(points)
    return F.aggregate(F.transform(p, lambda q, i: F.when(i > 0, dist_km(F.get(p, i - 1)["lat"], F.get(p, i - 1)["lng"], q["lat"], q["lng"])).otherwise(0.0)), F.lit(0.0), lambda a, b: a + b)


def intersection(ay, ax, by, bx, cy, cx, dy, dx) -> Column:
    """Proper crossing of two segments as struct<lat,lng,t,u>; null where they only touch or are parallel."""
    ay, ax, by, bx, cy, cx, dy, dx = map(_c, (ay, ax, by, bx, cy, cx, dy, dx))
    ry, rx, sy, sx = by - ay, bx - ax, dy - cy, dx - cx
    den = rx * sy - ry * sx
    t = ((cx - ax) * sy - (cy - ay) * sx) / F.nullif(den, F.lit(0.0))
    u = ((cx - ax) * ry - (cy - ay) * rx) / F.nullif(den, F.lit(0.0))
    inside = (F.abs(den) >= 1e-18) & (t > 1e-9) & (t < 1 - 1e-9) & (u > 1e-9) & (u < 1 - 1e-9)
    return F.when(inside, F.struct((ay + t * ry).alias("lat"), (ax + t * rx).alias("lng"), t.alias("t"), u.alias("u")))


def project(py, px, ay, ax, by, bx) -> Column:
    """Nearest point of a segment as struct<lat,lng,t,km>; t is clamped in degrees."""
    py, px, ay, ax, by, bx = map(_c, (py, px, ay, ax, by, bx))
    ry, rx = by - ay, bx - ax
    n = rx * rx + ry * ry
    t = F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * rx + (py - ay) * ry) / F.nullif(n, F.lit(0.0)))))
    lat, lng = ay + t * ry, ax + t * rx
    return F.struct(lat.alias("lat"), lng.alias("lng"), t.alias("t"), dist_km(py, px, lat, lng).alias("km"))


def edge_crossed(py, px, ay, ax, by, bx) -> Column:
    """Whether a ray to the right of the point crosses the edge."""
    py, px, ay, ax, by, bx = map(_c, (py, px, ay, ax, by, bx))
    return ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / F.nullif(by - ay, F.lit(0.0)) + ax)


def edge_touched(py, px, ay, ax, by, bx) -> Column:
    """Whether the point lies on the edge, within ON_EDGE degrees."""
    py, px, ay, ax, by, bx = map(_c, (py, px, ay, ax, by, bx))
    ry, rx = by - ay, bx - ax
    n = rx * rx + ry * ry
    t = F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * rx + (py - ay) * ry) / F.nullif(n, F.lit(0.0)))))
    qy, qx = ay + t * ry - py, ax + t * rx - px
    return qy * qy + qx * qx <= ON_EDGE * ON_EDGE


def edge_km(py, px, ay, ax, by, bx) -> Column:
    """Distance to an edge on a local equirectangular plane."""
    py, px, ay, ax, by, bx = map(_c, (py, px, ay, ax, by, bx))
    k = F.cos(F.radians(py))
    x1, y1, x2, y2 = (ax - px) * KM_BORDER * k, (ay - py) * KM_BORDER, (bx - px) * KM_BORDER * k, (by - py) * KM_BORDER
    rx, ry = x2 - x1, y2 - y1
    n = rx * rx + ry * ry
    t = F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(x1 * rx + y1 * ry) / F.nullif(n, F.lit(0.0)))))
    return F.sqrt((x1 + t * rx) * (x1 + t * rx) + (y1 + t * ry) * (y1 + t * ry))
