"""Name, code and geometry functions against fixed tables."""

import math

import pytest
from pyspark.sql import functions as F

from addrlink import params
from addrlink.functions import geo, text
from addrlink.operators import region


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (text.name_norm, "São Paulo", "sao paulo"), (text.name_norm, "  Rua  Augusta  ", "rua augusta"), (text.name_norm, None, ""),
        (text.core_name, "travessa da moenda", "moenda"), (text.core_name, "via de pedestre audi", "audi"), (text.core_name, "travessa", "travessa"), (text.core_name, "rua barao de piracicaba", "barao de piracicaba"), (text.core_name, "estrada vicinal do engordo", "engordo"), (text.core_name, "municipal xyz", "municipal xyz"),
        (text.strip_titles, "dr jose de alencar", "jose de alencar"), (text.strip_titles, "doutor", "doutor"), (text.core_bare, "rua mario doutor silva", "mario doutor silva"),
        (text.strip_mid_link, "arlindo moraes da costa", "arlindo moraes costa"), (text.strip_mid_link, "da", "da"), (text.strip_mid_link, "volta a gente", "volta a gente"),
        (text.phonetic_key, "filho", "filho"), (text.phonetic_key, "junho", "junho"),
        (text.postal_digits, "01310-100", "01310100"), (text.postal_digits, "1310100", "01310100"), (text.postal_digits, "abc", ""),
        (region.state_of_code, "3550308", "SP"), (region.state_of_code, "1302603", "AM"), (region.state_token, "BR-SP", "SP"), (region.state_token, "Minas Gerais", "MG"),
        (text.sanitize, "a@b\r\nc", "a b c"), (text.sanitize, None, ""),
    ],
)
def test_text(spark, f, given, want):
    assert one(spark, f("v"), v=given) == want


def test_sound_pairs(spark):
    same = [("luiz", "luis"), ("souza", "sousa"), ("ayrton", "airton"), ("affonso", "afonso"), ("renam", "renan"), ("bras", "braz"), ("marquez", "marques"), ("valdomiro", "waldomiro"), ("lajeado", "lageado"), ("xavier", "chavier")]
    df = spark.createDataFrame(same + [("silva", "salva"), ("rocha", "roca")], "a string, b string")
    got = [r[0] for r in df.select(text.phonetic_key("a") == text.phonetic_key("b")).collect()]
    assert got == [True] * len(same) + [False, False]


def test_edits(spark):
    assert one(spark, text.levenshtein_capped("a", "b", 1), a="san felipe neri", b="sao felipe neri") == 1
    assert one(spark, text.levenshtein_capped("a", "b", 1), a="abc", b="xyz") == 2
    assert set(one(spark, text.deletes1("v"), v="abc")) == {"abc", "bc", "ac", "ab"}
    assert one(spark, text.deletes1("v"), v="") == [""]
    assert [one(spark, text.fuzzy_max_dist("v"), v="x" * n) for n in (9, 10)] == [0, 1]


def test_polyline(spark):
    pts = F.array(*(F.struct(F.lit(a).alias("lat"), F.lit(b).alias("lng")) for a, b in [(-23.552, -46.632), (-23.552, -46.632), (-23.553, -46.633)]))
    assert one(spark, geo.encode_polyline(pts)) == "-23552000,-46632000;-1000,-1000"
    back = one(spark, geo.decode_polyline("v"), v="-23552000,-46632000;-1000,-1000")
    assert [tuple(p) for p in back] == [(-23.552, -46.632), (-23.553, -46.633)]
    with pytest.raises(Exception, match="not a polyline"):
        one(spark, geo.decode_polyline("v"), v="12;x")
    assert one(spark, geo.decode_polyline("v", strict=False), v="12;x") is None
    assert one(spark, geo.count_polyline("v"), v="1,2;3,4") == 2 and one(spark, geo.count_polyline("v"), v="") == 0
    assert one(spark, geo.first_point("v"), v="junk") is None


def test_numbers(spark):
    assert one(spark, geo.cell("v", 0.01), v=-23.5505) == -2356
    assert one(spark, geo.micro("v"), v=-2.5e-6) == -2
    assert one(spark, geo.jump_deg(F.lit(0.0), F.lit(179.5), F.lit(0.0), F.lit(-179.5))) == pytest.approx(1.0)
    assert [one(spark, text.distance_band("v"), v=x) for x in (0.0, 1.0, 5.0, 25.0, 25.001)] == ["ate_1km", "de_1_a_5km", "de_5_a_25km", "de_5_a_25km", "mais_de_25km"]
    assert one(spark, text.fmt7("v"), v=-1.5) == "-1.5000000"


def test_polygons(spark):
    rings = spark.createDataFrame([("p", [[0.0, 0.0, 10.0, 0.0, 10.0, 10.0, 0.0, 10.0], [4.0, 4.0, 6.0, 4.0, 6.0, 6.0, 4.0, 6.0]]), ("u", [[0.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0]])], "poly string, rings array<array<double>>")
    edges = region.edge_table(rings)
    pts = spark.createDataFrame([(1, "p", 2.0, 2.0), (2, "p", 5.0, 5.0), (3, "p", 5.0, 0.0), (4, "p", 5.0, 4.0), (5, "p", 5.0, 12.0), (6, "none", 0.0, 0.0), (7, "u", -0.5, 0.5), (8, "u", 0.1, 0.5)], "id int, poly string, lat double, lng double")
    got = {r.id: r for r in region.inside(pts, edges, ["id"]).collect()}
    assert [got[i].inside for i in range(1, 7)] == [True, False, True, True, False, None]
    assert got[7].border_km == pytest.approx(55.6, abs=0.1) and got[8].border_km == pytest.approx(11.12, abs=0.05)
    simple = region.simplify(spark.createDataFrame([("s", [[0.0, 0.0, 1.0, 0.001, 2.0, 0.0, 2.0, 2.0, 0.0, 2.0, 0.0, 0.0]])], "poly string, rings array<array<double>>"), 0.01)
    assert simple.first().rings == [[0.0, 0.0, 2.0, 0.0, 2.0, 2.0, 0.0, 2.0, 0.0, 0.0]]


def test_segments(spark):
    x = one(spark, geo.intersection(*(F.lit(float(v)) for v in (0, -1, 0, 1, -1, 0, 1, 0))))
    assert (x.lat, x.lng) == (0.0, 0.0)
    assert one(spark, geo.intersection(*(F.lit(float(v)) for v in (0, -1, 0, 1, 0, 0, 1, 0)))) is None
    p = one(spark, geo.project(*(F.lit(float(v)) for v in (1, 0.25, 0, 0, 0, 1))))
    assert p.t == 0.25 and p.km == pytest.approx(111.0, abs=0.2) and not math.isnan(p.lat)


def test_options():
    assert params.parse_bbox("-47.20,-24.05,-46.30,-23.20") == (-47.2, -24.05, -46.3, -23.2)
    with pytest.raises(ValueError):
        params.parse_bbox("1,2,3")
    assert params.parse_datasets("geom").datasets == ("logradouro",) and params.parse_datasets("bairro,geom").way_geom
    assert region.states_of("centro-oeste") == ("DF", "GO", "MT", "MS") and region.states_of("sp+sul") == ("SP", "PR", "RS", "SC")


def test_percentiles_and_validation(spark):
    from addrlink.operators import inventory

    rows = [("a", float(v % 7)) for v in range(40)] + [("b", 1.0), ("c", None)]
    got = {r.k: (r.p0, r.p50, r.p100) for r in inventory.percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"p0": 0.0, "p50": 0.5, "p100": 1.0}).collect()}
    ordered = sorted(v for k, v in rows if k == "a")
    assert got == {"a": (ordered[0], ordered[20], ordered[39]), "b": (1.0, 1.0, 1.0)}
    checked = spark.createDataFrame([(1, "x", True, 0.0, None), (2, "x", False, 30.0, "mais_de_25km"), (3, "x", None, None, None), (4, "y", False, 0.5, "ate_1km"), (5, "y", False, 30.0, "mais_de_25km")], "ord long, poly string, inside boolean, border_km double, band string")
    got = {r.poly: tuple(r)[1:] for r in region.validation(checked, "poly").collect()}
    assert got == {"x": (3, 1, 1, 1, 0, 0, 0, 1), "y": (2, 0, 2, 0, 1, 0, 0, 1)}
    assert [r.ord for r in region.worst(checked, 2).collect()] == [2, 5]
    assert sorted(r.ord for r in region.examples(checked, "band", 1).collect()) == [2, 4]


def test_smallest_box_wins(spark):
    df = spark.createDataFrame([(-23.5, -46.6), (-15.8, -47.9), (0.0, 0.0), (None, None)], "lat double, lng double")
    boxes = {s: b for s, b in region.STATE_BOX.items()}
    held = lambda y, x: min((s for s, b in boxes.items() if y is not None and b[0] <= y <= b[1] and b[2] <= x <= b[3]), key=lambda s: (boxes[s][1] - boxes[s][0]) * (boxes[s][3] - boxes[s][2]), default="")
    for r in df.select("lat", "lng", region.state_of_box("lat", "lng").alias("uf")).collect():
        assert r.uf == held(r.lat, r.lng)
