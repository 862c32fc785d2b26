"""Linking scenarios, row by row."""

import pytest

from addrlink.operators import link
from addrlink.params import LinkParams

A, FAR = (-20.0, -40.0), (-21.0, -41.0)
FEATURE = "ord long, osm_id string, name_norm string, name_alt_norm string, kind string, n int, lat double, lng double, lat_min double, lat_max double, lng_min double, lng_max double"
REGISTER = "ord long, log_nu string, uf string, loc_nu string, bai_ini string, bai_fim string, log_no string, compl string, cep string, tlo string, sta string, abrev string"


def feature(i, name, at, off=(0, 0), n=4, kind="residential", alt=""):
    y, x = at[0] + off[0], at[1] + off[1]
    return (i, str(i), name, alt, kind, n, y, x, y - 5e-4, y + 5e-4, x - 5e-4, x + 5e-4)


@pytest.fixture(scope="module")
def world(spark):
    f = [
        feature(1, "rua alfa unica", A), feature(2, "rua beta unica", A, (-0.001, -0.001)), feature(3, "rua comum", A, (-0.002, -0.002)), feature(4, "rua comum", FAR, n=40), feature(5, "rua goias", A, (-0.003, -0.003)), feature(6, "rua luis gushiken", A, (-0.004, -0.004)),
        feature(7, "praca da republica", A, (-0.001, -0.003), kind="park"), feature(8, "rua parquinho", A, (-0.002, -0.004), kind="park"), feature(9, "rua do distrito", A, (-0.003, -0.001)), feature(11, "rua do distrito", FAR, n=40), feature(10, "rua nome novo", A, (-0.004, -0.002), alt="rua alterada"),
        feature(14, "rua compartilhada", A, (-0.0015, -0.0015)), feature(15, "rua gama unica", A, (-0.0005, -0.0005)), feature(16, "rua doutor olimpio carr ribeiro", A, (-0.0025, -0.001)), feature(17, "estrada arlindo moraes da costa", A, (-0.002, -0.001)), feature(18, "rua sao felipe neri", A, (-0.003, 0.001)), feature(19, "rua sao felipe neri", FAR, n=40),
    ]
    rows = [
        (100, "1", "10", "Rua", "Alfa Única", "11111000"), (101, "1", "10", "Rua", "Beta Unica", "11111001"), (102, "1", "11", "Rua", "Comum", "11111002"), (103, "1", "11", "Travessa", "Goiás", "11111003"), (104, "1", "11", "Rua", "Luiz Gushiken", "11111004"), (105, "1", "11", "Praça", "da República", "11111005"),
        (106, "1", "11", "Rua", "Parquinho", "11111006"), (107, "2", "12", "Rua", "do Distrito", "11111007"), (108, "1", "11", "Rua", "Inexistente", "11111008"), (109, "1", "11", "Rua", "Alterada", "11111009"), (112, "1", "10", "Rua", "Compartilhada", "11111012"), (113, "1", "11", "Rua", "Compartilhada", "11111013"),
        (114, "3", "13", "Rua", "Compartilhada", "11111014"), (115, "3", "13", "Rua", "Gama Unica", "11111015"), (116, "1", "10", "Rua", "Olimpio Carr Ribeiro", "04775120"), (502, "1", "10", "Estrada", "Arlindo Moraes Costa", "11111016"), (503, "1", "10", "Rua", "San Felipe Neri", "11111017"),
    ]
    feats = spark.createDataFrame(f, FEATURE)
    reg = spark.createDataFrame([(i, str(i), "ZZ", loc, bai, "", name, "", cep, tlo, "S", "") for i, loc, bai, tlo, name, cep in rows], REGISTER)
    loc = spark.createDataFrame([("1", "Cidade A", "", "1234567"), ("2", "Distrito B", "1", ""), ("3", "Cidade C", "", "7654321")], "loc_nu string, name string, sub string, ibge string")
    bai = spark.createDataFrame([("10", "Centro"), ("11", "Norte"), ("12", "Sul"), ("13", "Leste")], "bai_nu string, name string")
    return reg, feats, loc, bai


def test_cascade_and_conflict(world):
    reg, feats, loc, bai = world
    got = link.link(reg, feats, loc)
    rows = {r.ord: r for r in link.emit(reg, got, loc, bai).collect()}
    want = {100: "exato", 101: "exato", 102: "exato", 103: "nucleo", 104: "fonetico", 105: "area", 107: "exato", 109: "name_alt", 112: "exato", 113: "exato", 115: "exato", 116: "titulo", 502: "conectores", 503: "fuzzy"}
    assert {i: rows[i].rule for i in want} == want and all(rows[i].status == "ok" for i in want)
    assert rows[106].status == rows[108].status == "sem_nome_osm" and rows[106].lat == "" and rows[108].ways == "0"
    assert float(rows[102].lat) == pytest.approx(-20.002) and rows[102].n_candidates == "1" and rows[100].way_ids == "1"
    assert rows[107].ibge == "1234567" and float(rows[107].lat) == pytest.approx(-20.003)
    assert rows[114].status == "ambiguo" and rows[114].lat == ""
    assert {r.ord: r.motive for r in got.state.collect()}[114] == "conflito_municipio"
    boxes = {r.bai_nu: r for r in link.neighbourhood_boxes(reg, got, bai).collect()}
    assert len(boxes) >= 2 and all(r.lat_min <= r.lat_max for r in boxes.values())
    assert {(r.kind, r.value): r.n for r in link.report(got).collect()}["status", "sem_nome_osm"] == 2


def test_fuzzy_off(world):
    reg, feats, loc, _ = world
    got = {r.ord: r.status for r in link.link(reg.where("ord in (100, 101, 503)"), feats, loc, LinkParams(fuzzy=False), rounds=1).state.collect()}
    assert got[503] == "sem_nome_osm" and got[100] == "ok"


def scenario(spark, features, rows, p=None, **more):
    """(ord -> emitted row, ord -> state) of rows (ord, loc, bai, name, cep)."""
    reg = spark.createDataFrame([(i, str(i), "ZZ", loc, bai, "", name, "", cep, "Rua", "S", "") for i, loc, bai, name, cep in rows], REGISTER)
    loc = spark.createDataFrame([("1", "Um", "", "3550308"), ("3", "Tres", "", "3548708")], "loc_nu string, name string, sub string, ibge string")
    bai = spark.createDataFrame([("10", "Centro"), ("13", "Leste")], "bai_nu string, name string")
    got = link.link(reg, spark.createDataFrame(features, FEATURE), loc, p, **more)
    return {r.ord: r for r in link.emit(reg, got, loc, bai).collect()}, {r.ord: r for r in got.state.collect()}


def test_envelope_and_exclusion(spark):
    north, south = (A[0] + 0.04, A[1]), (A[0] - 0.04, A[1])
    f = [feature(1, "rua polo norte", north), feature(2, "rua polo sul", south), feature(3, "rua no buraco", A), feature(4, "rua no buraco", FAR, n=40), feature(5, "rua fronteira", south, (0.005, 0)), feature(6, "rua ancora c", south, (0.003, 0))]
    rows = [(200, "1", "10", "Polo Norte", "20000001"), (201, "1", "10", "Polo Sul", "20000002"), (202, "1", "10", "No Buraco", "20000003"), (203, "1", "10", "Fronteira", "20000004"), (204, "1", "10", "Fronteira", "20000005"), (205, "3", "13", "Fronteira", "20000006"), (206, "3", "13", "Ancora C", "20000007")]
    out, state = scenario(spark, f, rows)
    assert out[202].status == "ok" and state[202].phase == "envelope" and float(out[202].lat) == pytest.approx(A[0])
    assert out[203].status == out[204].status == "ok"
    assert (out[205].status, out[205].lat, state[205].motive) == ("ambiguo", "", "conflito_municipio")


def test_neighbours_of_a_postal_prefix(spark):
    at = [("ancora um", (0, 0), "44444001"), ("ancora dois", (-0.0003, 0), "44444002"), ("vizinha um", (-0.0005, 0.0002), "44444100"), ("vizinha dois", (-0.0007, -0.0002), "44444110"), ("vizinha tres", (-0.0004, 0.0001), "44444120"), ("alvo cep", (-0.014, 0), "44444999")]
    f = [feature(n, f"rua {name}", A, off) for n, (name, off, _) in enumerate(at, 1)] + [feature(9, "rua alvo cep", FAR, n=40)]
    rows = [(300 + n, "1", "10", name.title(), cep) for n, (name, _, cep) in enumerate(at)]
    out, state = scenario(spark, f, rows, LinkParams(dilate=0, envelope=False, neighbour_km=2.0, neighbour_min=3))
    assert (out[305].status, out[305].rule) == ("ok", "vizinho_cep5") and float(out[305].lat) == pytest.approx(A[0] - 0.014) and float(out[305].lng) == pytest.approx(A[1])
    out, state = scenario(spark, f, rows, LinkParams(dilate=0, envelope=False, neighbours=False))
    assert (out[305].status, out[305].lat, state[305].motive) == ("ambiguo", "", "fora_do_footprint")


def test_recovery_after_conflict(spark):
    east = (A[0], A[1] + 0.08)
    f = [feature(1, "rua alfa capela", A), feature(2, "rua beta leste", east), feature(3, "rua vizinha capela um", A, (-0.001, 0)), feature(4, "rua vizinha capela dois", A, (0.001, -0.001)), feature(5, "rua vizinha capela tres", A, (-0.0005, 0.001)), feature(6, "rua neuchatel", A, (0, 0.0003)), feature(7, "rua neuchatel", east, (0, -0.0003), n=40), feature(8, "rua gama taboao", east, (0.001, 0)), feature(9, "rua vizinha taboao um", east, (-0.001, 0.001)), feature(10, "rua vizinha taboao dois", east, (0.0005, -0.001)), feature(11, "rua vizinha taboao tres", east, (-0.0005, 0.0005))]
    one = [(400, "Alfa Capela", "04781001"), (401, "Beta Leste", "04782001"), (402, "Vizinha Capela Um", "04781010"), (403, "Vizinha Capela Dois", "04781020"), (404, "Vizinha Capela Tres", "04781040"), (606476, "Neuchatel", "04781030")]
    three = [(410, "Gama Taboao", "09663001"), (411, "Vizinha Taboao Um", "09663010"), (412, "Vizinha Taboao Dois", "09663011"), (413, "Vizinha Taboao Tres", "09663012"), (564372, "Neuchatel", "09663020")]
    rows = [(i, "1", "10", n, c) for i, n, c in one] + [(i, "3", "13", n, c) for i, n, c in three]
    out, state = scenario(spark, f, rows)
    assert out[564372].status == "ok" and float(out[564372].lng) == pytest.approx(east[1] - 0.0003)
    assert (out[606476].status, out[606476].rule, state[606476].phase) == ("ok", "vizinho_cep5", "pos_conflito") and float(out[606476].lng) == pytest.approx(A[1] + 0.0003)
    out, _ = scenario(spark, f, rows, LinkParams(neighbours=False))
    assert (out[606476].status, out[606476].lat) == ("ambiguo", "")


def test_states_apart_and_without_features(spark):
    f = [(*feature(n, "rua igual", at), uf) for n, at, uf in ((1, A, "SP"), (2, (A[0] + 0.001, A[1]), "RJ"), (3, FAR, "RJ"))] + [(*feature(4, "rua so do rio", FAR), "RJ"), (5, "5", "", "", "residential", 1, *[0.0] * 6, "MG")]
    rows = [(1, "SP", "1", "Igual"), (2, "RJ", "2", "So do Rio"), (3, "SP", "1", "So do Rio"), (4, "BA", "3", "Igual"), (5, "MG", "4", "Igual")]
    reg = spark.createDataFrame([(i, str(i), uf, loc, "", "", name, "", f"1111100{i}", "Rua", "S", "") for i, uf, loc, name in rows], REGISTER)
    loc = spark.createDataFrame([(x, x, "", "") for x in "1234"], "loc_nu string, name string, sub string, ibge string")
    got = link.link(reg, spark.createDataFrame(f, FEATURE + ", uf string"), loc)
    state = {r.ord: (r.status, r.cid) for r in got.state.collect()}
    assert state[1][0] == "ok" and state[1][1].startswith("SP|rua igual|") and state[2][0] == "ok"
    assert {i: state[i][0] for i in (3, 4, 5)} == {3: "sem_nome_osm", 4: "sem_extract", 5: "sem_extract"}
    none, _ = scenario(spark, [], [(1, "1", "10", "Igual", "11111000")])
    assert none[1].status == "sem_extract"
