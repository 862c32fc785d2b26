"""XML dumps: elements through Spark's XML reader, and the event tree through a Python source."""

from __future__ import annotations

import bz2
from collections.abc import Iterator
from xml.parsers import expat

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The element schema is fixed, so that no pass is spent on guessing it.
TAG = "tag array<struct<_k:string,_v:string>>"
ELEMENTS = {"node": f"_id long, _lat double, _lon double, {TAG}", "way": f"_id long, nd array<struct<_ref:long>>, {TAG}", "relation": f"_id long, member array<struct<_ref:long,_role:string,_type:string>>, {TAG}"}


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Nodes, ways or relations of an .osm or .osm.bz2 file, tags as a map (later duplicates win)."""
    raw = spark.read.format("xml").option("rowTag", kind).schema(ELEMENTS[kind]).load(path)
    pairs = F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>"))
    last = F.filter(pairs, lambda t, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda u: u["_k"] == t["_k"]))
    tags = F.map_from_entries(F.transform(last, lambda t: F.struct(t["_k"], F.coalesce(t["_v"], F.lit("")))))
    out = raw.select(F.lit(kind).alias("kind"), F.col("_id").alias("id"), tags.alias("tags"), *[c for c in raw.columns if c not in ("_id", "tag")])
    if kind == "node":
        return out.withColumnsRenamed({"_lat": "lat", "_lon": "lon"})
    if kind == "way":
        return out.withColumn("refs", F.transform("nd", lambda n: n["_ref"])).drop("nd")
    types = F.create_map(F.lit("node"), F.lit(0), F.lit("way"), F.lit(1), F.lit("relation"), F.lit(2))
    return out.withColumn("members", F.transform("member", lambda m: F.struct(m["_ref"].alias("id"), F.element_at(types, m["_type"]).alias("type"), m["_role"].alias("role")))).drop("member")


def events(path: str, strict: bool = True) -> Iterator[tuple]:
    """(seq, depth, path, name, attrs) of opened elements. A mismatch ends the file: it raises when strict, else what came before stays."""
    stack: list[str] = []
    rows: list[tuple] = []
    seq = 0

    def opened(name, attrs):
        nonlocal seq
        stack.append(name)
        rows.append((seq, len(stack), "/" + "/".join(stack), name, dict(attrs)))
        seq += 1

    parser = expat.ParserCreate()
    parser.StartElementHandler = opened
    parser.EndElementHandler = lambda _: stack.pop()
    with bz2.open(path, "rb") if path.endswith(".bz2") else open(path, "rb") as f:
        try:
            while chunk := f.read(1 << 20):
                parser.Parse(chunk, False)
                yield from rows
                rows.clear()
            parser.Parse(b"", True)
        except expat.ExpatError:
            if strict:
                raise
        yield from rows


class File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class EventReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.strict = options["path"].split(","), options.get("strict", "true") == "true"

    def partitions(self):
        return [File(p) for p in self.paths]

    def read(self, partition):
        return events(partition.path, self.strict)


class EventSource(DataSource):
    """spark.read.format("xml_events").option("path", "a.osm,b.osm.bz2"): a partition a file, since a stack needs its file whole."""

    @classmethod
    def name(cls):
        return "xml_events"

    def schema(self):
        return "seq long, depth int, path string, name string, attrs map<string,string>"

    def reader(self, schema):
        return EventReader(dict(self.options))
