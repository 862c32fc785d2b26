import os

import pytest

from addrlink import schemas
from addrlink.plans import jobs, relabel


def test_jobs(tmp_path):
    seen = []
    groups = {"sul": "sul", "sp": "SP"}
    run = lambda **k: jobs.run_jobs(groups, str(tmp_path), lambda states, at: seen.append(states), **k)
    assert run(dry_run=True) == {"sul": "would run", "sp": "would run"} and not seen
    assert run(only=["sp"]) == {"sp": "done"} and seen == [("SP",)]
    (tmp_path / "sul").mkdir()
    (tmp_path / "sul" / jobs.STARTED).touch()
    assert run() == {"sul": "needs wiping", "sp": "done before"}
    assert run(force=True) == {"sul": "done", "sp": "done"} and seen[1] == ("PR", "RS", "SC")


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("status", "ok", 3), ("status", "ambiguo", 1)], "kind string, value string, n long")
    assert jobs.write_json(df, str(tmp_path / "r.json")) == {"status": {"ambiguo": 1, "ok": 3}}
    assert "| status | ok | 3 |" in jobs.markdown("x", df)
    assert "  2 oneway" in jobs.column_notes({"GEOM": schemas.GEOMETRY})


def test_relabel(spark, tmp_path):
    line = lambda schema, **v: "@".join(str(v.get(f.name, "")) for f in schema) + "\n"
    street = lambda i, lat, kind="way", uf="XX": line(schemas.STREET, osm_id=i, osm_type=kind, uf=uf, lat=lat, lng="-40.5")
    a, b, base = tmp_path / "in" / "a", tmp_path / "in" / "b", str(tmp_path / "in")
    for d in (a, b, tmp_path / "in" / "empty"):
        d.mkdir(parents=True)
    (a / "OSM_LOGRADOURO_XX.TXT").write_text(street(1, -20.5) + street(2, -10, uf="SP") + street(1, -50, "node"))
    (b / "OSM_LOGRADOURO_XX.TXT").write_text(street(1, -50) + street(3, ""))
    (b / "OSM_LOGRADOURO_GEOM_RJ.TXT").write_text("1@-20500000,-40500000@0\n9@-20600000,-40500000@1\n8@@0\n")
    (b / "OSM_ADDR_POINT_RJ.TXT").write_text(line(schemas.ADDRESS, osm_id=7, lat="-20.2", lng="-40.2") + line(schemas.ADDRESS, osm_id=8, lat="-1", lng="-1"))
    assert [n for n, _ in relabel.slices(base)] == ["a", "b"] and [n for n, _ in relabel.slices(base, only=["B"])] == ["b"]
    assert relabel.slices(str(a)) == [("a", str(a))] and relabel.slices(dirs=[str(b)]) == [("b", str(b))]
    square = spark.createDataFrame([("MG", [[-41.0, -21.0, -40.0, -21.0, -40.0, -20.0, -41.0, -20.0]])], "poly string, rings array<array<double>>")
    got = {(r.family, r.old_uf, r.new_uf): r.n for r in relabel.relabel(spark, relabel.slices(base), square, str(tmp_path / "out")).collect()}
    assert got == {("street", "XX", "MG"): 1, ("street", "SP", "SP"): 1, ("street", "XX", "XX"): 2, ("geometry", "RJ", "MG"): 2, ("geometry", "RJ", "RJ"): 1, ("address", "RJ", "MG"): 1, ("address", "RJ", "RJ"): 1}
    assert sorted(x for x in os.listdir(tmp_path / "out" / "street") if "=" in x) == ["new_uf=MG", "new_uf=SP", "new_uf=XX"]
    with pytest.raises(FileExistsError):
        relabel.relabel(spark, relabel.slices(base), square, str(tmp_path / "out"), ["street"])
