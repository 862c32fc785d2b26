"""Sources, sinks and streams: encoded dumps, XML, shards, cache, sessions."""

import bz2
import os

import pytest
from pyspark.sql import functions as F

from addrlink import schemas
from addrlink.operators import extract, inventory
from addrlink.sources import delimited, pbf, postal_cache, xml
from addrlink.streaming import scans

NODES = [("node", 1003, -23.552, -46.632, {}), ("node", 1004, -23.553, -46.633, {}), ("node", 1006, -23.561, -46.65, {"addr:street": "Av Paulista", "addr:housenumber": "1000"}), ("node", 1007, -23.5505, -46.634, {}), ("node", 1008, -23.551, -46.6335, {}), ("node", 1011, -23.545, -46.636, {"place": "square", "name": "Praça do Correio"})]
WAYS = [("way", 2001, [1003, 1004], {"highway": "residential", "name": "Rua Augusta", "alt_name": "Rua Augusta Velha"}), ("way", 2002, [1007, 1008, 1007], {"place": "square", "name": "Praça da Sé"}), ("way", 2004, [1007, 1008], {"landuse": "residential", "name": "Jardim Teste"})]
RELATION = ("relation", 3001, [(1003, 0, "label"), (1004, 0, "admin_centre"), (2001, 1, "outer")], {"boundary": "administrative", "admin_level": "8", "name": "São Paulo"})


@pytest.fixture(scope="module")
def dump(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pbf") / "mini.osm.pbf")
    pbf.encode(path, [NODES[:3], NODES[3:], WAYS, [RELATION]], bbox=(-46.7, -46.6, -23.5, -23.6))
    spark.dataSource.register(pbf.PbfSource)
    return path


def test_pbf_rows(spark, dump):
    df = spark.read.format("osm_pbf").option("path", dump).option("blobsPerPartition", 1).load()
    rows = {(r.kind, r.id): r for r in df.collect()}
    assert len(rows) == 10 and rows["node", 1006].tags["addr:street"] == "Av Paulista"
    assert rows["node", 1003].lat == pytest.approx(-23.552) and rows["way", 2002].refs == [1007, 1008, 1007]
    assert [tuple(m) for m in rows["relation", 3001].members] == [(1003, 0, "label"), (1004, 0, "admin_centre"), (2001, 1, "outer")]
    assert pbf.header_row(dump)["bbox"]["left"] == pytest.approx(-46.7)


def test_extract(spark, dump):
    df = spark.read.format("osm_pbf").option("path", dump).load()
    nodes, ways = df.where("kind = 'node'"), df.where("kind = 'way'")
    rows = {r.id: r for r in extract.street_rows(ways, nodes).collect()}
    assert set(rows) == {2001, 2002, 1011}
    assert rows[2001].name_alt == "Rua Augusta Velha" and rows[2001].polyline == "-23552000,-46632000;-1000,-1000" and rows[2001].way_node_count == 2
    assert rows[2002].kind == "square" and rows[2002].polyline.count(";") == 2 and rows[1011].osm_type == "node" and rows[1011].lat_min == rows[1011].lat_max
    assert [r.street_norm for r in extract.address_rows(nodes).collect()] == ["av paulista"]
    p = extract.relation_points(df.where("kind = 'relation'"), nodes).first()
    assert p.lat == pytest.approx(-23.552)


def test_pbf_errors(tmp_path):
    bad = tmp_path / "bad.pbf"
    bad.write_bytes(b"\x7f\xff\xff\xff")
    with pytest.raises(ValueError):
        list(pbf.headers(str(bad)))
    raw = tmp_path / "raw.pbf"
    pbf.encode(str(raw), [NODES], raw=True)
    assert sum(1 for r in pbf.runs(str(raw), 0, 0, 99, 1)[0] for _ in pbf.decode(r)) == len(NODES)


def test_stream_of_blobs(spark, dump, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    q = scans.scan_signals(scans.blobs(spark, dump, 1), out, check)
    q.processAllAvailable()
    q.stop()
    assert len([d for d in os.listdir(out) if d.startswith("batch=")]) >= 4
    whole = inventory.signals(spark.read.format("osm_pbf").option("path", dump).load()).first()
    assert scans.total_signals(spark, out).first() == whole and whole.node == 6 and whole.way == 3 and whole.addr_street == 1


OSM = '<osm><bounds minlat="0"/><node id="1" lat="-23.5" lon="-46.6" version="1"><tag k="name" v="a"/><tag k="name" v="b"/></node><node id="2" lat="1" lon="2"/><way id="9"><nd ref="1"/><nd ref="2"/><tag k="highway" v="path"/></way></osm>'


def test_xml(spark, tmp_path):
    (tmp_path / "a.osm.bz2").write_bytes(bz2.compress(OSM.encode()))
    (tmp_path / "b.osm").write_text(OSM.replace("</osm>", "</oops>"))
    nodes = {r.id: r for r in xml.read(spark, str(tmp_path / "a.osm.bz2"), "node").collect()}
    assert nodes[1].tags == {"name": "b"} and nodes[2].tags == {} and nodes[1].lat == -23.5
    assert xml.read(spark, str(tmp_path / "a.osm.bz2"), "way").first().refs == [1, 2]
    spark.dataSource.register(xml.EventSource)
    ev = spark.read.format("xml_events").option("path", str(tmp_path / "a.osm.bz2")).load()
    tree = {(r.path, r.k): r for r in inventory.path_tree(ev.select("path", F.coalesce(F.element_at("attrs", F.lit("k")), F.lit("")).alias("k"), "seq", F.element_at("attrs", F.lit("v")).alias("v"))).collect()}
    assert tree["/osm/node/tag", "name"].n == 2 and tree["/osm/node/tag", "name"].last_value == "b" and tree["/osm/way", ""].last is None
    with pytest.raises(Exception, match="mismatch"):
        spark.read.format("xml_events").option("path", str(tmp_path / "b.osm")).load().count()
    assert spark.read.format("xml_events").option("path", str(tmp_path / "b.osm")).option("strict", "false").load().count() == 10


def test_shards_and_scan(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n@{i}", None) for i in range(8)], "ord long, name string, note string").repartition(3)
    m = delimited.write_shards(df, str(tmp_path), "KEY", ["ord", "name", "note"], 3)
    assert [s["lines"] for s in m["shards"]] == [3, 3, 2] and m["total_lines"] == 8
    paths = delimited.resolve_paths(str(tmp_path), "KEY")
    assert [os.path.basename(p) for p in paths] == ["000001.txt", "000002.txt", "000003.txt"]
    back = delimited.read(spark, paths, schemas._strings("id name note")).orderBy("ord").collect()
    assert [r.id for r in back] == [str(i) for i in range(8)] and back[0].name == "n 0" and back[0].note == ""
    (tmp_path / "other.txt").write_text("x@y\n", encoding="latin-1")
    assert delimited.exists(str(tmp_path), "OTHER") and not delimited.exists(str(tmp_path), "NONE")
    assert delimited.read(spark, [], schemas.GEOMETRY).count() == 0


def test_latin1(spark, tmp_path):
    (tmp_path / "L.TXT").write_bytes("1@SP@São Paulo@\n2@RJ\n".encode("latin-1"))
    rows = delimited.read(spark, [str(tmp_path / "L.TXT")], schemas._strings("a b c d"), "ISO-8859-1").orderBy("ord").collect()
    assert [(r.b, r.c) for r in rows] == [("SP", "São Paulo"), ("RJ", "")]


def test_cache(spark, tmp_path):
    rows = [("01310100", "200", "ok", "-23.5", "-46.6", "São Paulo", "SP"), ("1310100", "404", "not_found", "", "", "", "SP"), ("20000000", "200", "ok", "-22.9", "-43.2", "Rio", "RJ")]
    df = spark.createDataFrame([(*r, "", "", "", "", "", "") for r in rows], schemas.POSTAL_CACHE)
    (tmp_path / "CEP_EXTERNO_SP.TXT").write_text("\n".join("@".join(r) for r in rows) + "\n")
    got = {r.cep: r for r in postal_cache.load(spark, str(tmp_path)).collect()}
    assert got["01310100"].status == "not_found" and got["20000000"].lat == -22.9
    postal_cache.save(df, str(tmp_path / "out"))
    postal_cache.save(df.where("state = 'RJ'"), str(tmp_path / "out"))
    assert sorted(d for d in os.listdir(tmp_path / "out") if d.startswith("uf=")) == ["uf=RJ", "uf=SP"]
    base = {n: "" for n in df.columns}
    more = spark.createDataFrame([base | {"cep": "20000000", "status": "error", "state": "MG", "ord": 1}, base | {"cep": "01999999", "status": "ok", "state": "SP", "ord": 2}], ", ".join(f"{n} string" for n in df.columns if n != "ord") + ", ord long")
    before = {r.cep: r for r in postal_cache.load_states(spark, str(tmp_path / "out")).collect()}
    assert postal_cache.merge(more, str(tmp_path / "out")) == ["MG", "RJ", "SP"]
    after = {r.cep: r for r in postal_cache.load_states(spark, str(tmp_path / "out")).collect()}
    assert set(after) == set(before) | {"01999999"} and after["20000000"].state == "MG" and after["01310100"] == before["01310100"]
    assert postal_cache.merge(more.limit(0), str(tmp_path / "out")) == [] and postal_cache.load_states(spark, str(tmp_path / "none")).count() == 0
    fetched = postal_cache.fetch(df.select("cep").limit(1), lambda cep: {"status": "ok", "lat": "1"}).first()
    assert fetched.status == "ok" and fetched.lat == "1"


def test_session_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,x) as ts, 'a' as k from (values 0.0, 90.0, 180.5, 5000.0) t(x)").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, k string").parquet(src)
    q = scans.session_counts(stream, "ts", ["k"]).writeStream.format("memory").queryName("closed").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("closed").collect()) in ([1, 2], [1, 1, 2])


def test_ordinals_follow_many_files_of_one_name(spark, tmp_path):
    from pyspark.sql import types as T

    from addrlink.sources import delimited

    paths = []
    for n in range(5):
        folder = tmp_path / f"part {n}"
        folder.mkdir()
        (folder / "000001.txt").write_text("".join(f"{n}@{i}\n" for i in range(40)))
        paths.append(str(folder / "000001.txt"))
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = sorted((r.ord, int(r.a), int(r.b)) for r in delimited.read(spark, paths, schema).collect())
    assert [x[1:] for x in rows] == [(n, i) for n in range(5) for i in range(40)] and len({x[0] for x in rows}) == 200
