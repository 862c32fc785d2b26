"""Binary map dumps as a Spark data source: nodes, ways and relations of each block as rows.

The driver walks blob headers only; each input partition is a run of blobs that a
task inflates and decodes on its own, so a dump is read once and in parallel. The
streaming reader hands out runs of blobs from a file offset, which is what a
resumed scan needs.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "kind string, id long, lat double, lon double, tags map<string,string>, refs array<long>, members array<struct<id:long,type:int,role:string>>, block long, ordinal long"
MOST_HEADER, MOST_BLOB = 64 << 10, 32 << 20


def varint(raw: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = raw[at]
        at += 1
        out |= (b & 127) << shift
        if b < 128:
            return out, at
        shift += 7


def signed(n: int) -> int:
    return n >> 1 ^ -(n & 1)


def fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a message; length-delimited values are bytes."""
    at = 0
    while at < len(raw):
        key, at = varint(raw, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(raw, at)
        elif kind == 2:
            n, at = varint(raw, at)
            value, at = raw[at : at + n], at + n
        elif kind == 1:
            value, at = raw[at : at + 8], at + 8
        elif kind == 5:
            value, at = raw[at : at + 4], at + 4
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


def packed(raw: bytes, zigzag: bool = False) -> list[int]:
    out, at = [], 0
    while at < len(raw):
        n, at = varint(raw, at)
        out.append(signed(n) if zigzag else n)
    return out


def sums(deltas: list[int]) -> list[int]:
    out, at = [], 0
    for d in deltas:
        at += d
        out.append(at)
    return out


def headers(path: str, start: int = 0) -> Iterator[tuple[str, int, int, int]]:
    """(type, offset of the blob, its size, offset of the next) without reading blobs; a cut file ends the walk."""
    with open(path, "rb") as f:
        f.seek(start)
        while len(head := f.read(4)) == 4:
            (n,) = struct.unpack(">I", head)
            if n > MOST_HEADER:
                raise ValueError(f"blob header of {n} bytes")
            raw = f.read(n)
            got = dict(fields(raw))
            size = got.get(3, 0)
            if size > MOST_BLOB:
                raise ValueError(f"blob of {size} bytes")
            at = f.tell()
            yield bytes(got[1]).decode(), at, size, at + size
            f.seek(at + size)


def inflate(raw: bytes) -> bytes:
    got = dict(fields(raw))
    if 1 in got:
        return bytes(got[1])
    if 3 in got:
        return zlib.decompress(got[3])
    raise ValueError("only raw and zlib blobs are read")


def tag_map(keys: list[int], values: list[int], text: list[str]) -> dict[str, str]:
    """Later duplicates win; a missing value is ''."""
    return {text[k]: text[values[i]] if i < len(values) else "" for i, k in enumerate(keys)}


def header_block(raw: bytes) -> dict:
    """Box in degrees, writer, source and features of a header blob."""
    out: dict = {"bbox": None, "required": [], "optional": [], "writer": "", "source": ""}
    for n, v in fields(raw):
        if n == 1:
            box = {k: signed(x) * 1e-9 for k, x in fields(v)}
            out["bbox"] = {"left": box.get(1), "right": box.get(2), "top": box.get(3), "bottom": box.get(4)}
        elif n in (4, 5):
            out["required" if n == 4 else "optional"].append(bytes(v).decode())
        elif n in (16, 17):
            out["writer" if n == 16 else "source"] = bytes(v).decode()
    return out


def elements(raw: bytes, block: int) -> Iterator[tuple]:
    """Rows of a primitive block, in file order."""
    text: list[str] = []
    groups, granularity, lat0, lon0 = [], 100, 0, 0
    for n, v in fields(raw):
        if n == 1:
            text = [bytes(s).decode("utf-8") for k, s in fields(v) if k == 1]
        elif n == 2:
            groups.append(v)
        elif n == 17:
            granularity = v
        elif n == 19:
            lat0 = v - (1 << 64) if v >> 63 else v
        elif n == 20:
            lon0 = v - (1 << 64) if v >> 63 else v
    deg = lambda x, base: 1e-9 * (base + granularity * x)
    ordinal = 0
    for group in groups:
        for n, v in fields(group):
            if n == 1:
                got = dict(fields(v))
                row = ("node", signed(got[1]), deg(signed(got[8]), lat0), deg(signed(got[9]), lon0), tag_map(packed(got.get(2, b"")), packed(got.get(3, b"")), text), None, None)
                yield (*row, block, ordinal)
                ordinal += 1
            elif n == 2:
                got = dict(fields(v))
                ids, lats, lons = (sums(packed(got.get(k, b""), True)) for k in (1, 8, 9))
                flat, at = packed(got.get(10, b"")), 0
                for i, a, b in zip(ids, lats, lons, strict=True):
                    tags: dict[str, str] = {}
                    while at < len(flat) and flat[at]:
                        tags[text[flat[at]]] = text[flat[at + 1]]
                        at += 2
                    at += 1
                    yield ("node", i, deg(a, lat0), deg(b, lon0), tags, None, None, block, ordinal)
                    ordinal += 1
            elif n == 3:
                got = dict(fields(v))
                yield ("way", got[1], None, None, tag_map(packed(got.get(2, b"")), packed(got.get(3, b"")), text), sums(packed(got.get(8, b""), True)), None, block, ordinal)
                ordinal += 1
            elif n == 4:
                got = dict(fields(v))
                roles, ids, kinds = packed(got.get(8, b"")), sums(packed(got.get(9, b""), True)), packed(got.get(10, b""))
                members = [(i, k, text[r]) for r, i, k in zip(roles, ids, kinds, strict=True)]
                yield ("relation", got[1], None, None, tag_map(packed(got.get(2, b"")), packed(got.get(3, b"")), text), None, members, block, ordinal)
                ordinal += 1


class Run(InputPartition):
    def __init__(self, path: str, blobs: list[tuple[int, int, int]]):
        self.path, self.blobs = path, blobs


def decode(run: Run) -> Iterator[tuple]:
    with open(run.path, "rb") as f:
        for number, at, size in run.blobs:
            f.seek(at)
            yield from elements(inflate(f.read(size)), number)


def runs(path: str, start: int, number: int, most: int, per_run: int) -> tuple[list[Run], int, int]:
    """Runs of data blobs from an offset on, at most ``most`` blobs; the next offset and blob number."""
    blobs: list[tuple[int, int, int]] = []
    at = start
    for kind, offset, size, after in headers(path, start):
        if len(blobs) >= most:
            break
        if kind == "OSMData":
            blobs.append((number, offset, size))
            number += 1
        at = after
    return [Run(path, blobs[i : i + per_run]) for i in range(0, len(blobs), per_run)], at, number


class PbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.per_run = options["path"], int(options.get("blobsperpartition", 16))

    def partitions(self):
        return runs(self.path, 0, 0, 1 << 60, self.per_run)[0]

    def read(self, partition):
        return decode(partition)


class PbfStreamReader(DataSourceStreamReader):
    """Offsets are the file position and the number of the next blob."""

    def __init__(self, options: dict):
        self.path, self.most, self.per_run = options["path"], int(options.get("maxblobspertrigger", 64)), int(options.get("blobsperpartition", 16))
        self.last: dict | None = None

    def initialOffset(self):
        return {"file": 0, "blob": 0}

    def latestOffset(self):
        start = self.last or self.initialOffset()
        _, at, number = runs(self.path, start["file"], start["blob"], self.most, self.per_run)
        self.last = {"file": at, "blob": number}
        return self.last

    def partitions(self, start, end):
        return runs(self.path, start["file"], start["blob"], end["blob"] - start["blob"], self.per_run)[0]

    def read(self, partition):
        return decode(partition)

    def commit(self, end):
        pass


class PbfSource(DataSource):
    """spark.read.format("osm_pbf").option("path", file); also readStream, with maxBlobsPerTrigger."""

    @classmethod
    def name(cls):
        return "osm_pbf"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PbfReader(dict(self.options))

    def streamReader(self, schema):
        return PbfStreamReader(dict(self.options))


def header_row(path: str) -> dict:
    """The dump's header; raises where the file has none."""
    for kind, at, size, _ in headers(path):
        if kind == "OSMHeader":
            with open(path, "rb") as f:
                f.seek(at)
                return header_block(inflate(f.read(size)))
    raise ValueError("no header blob")


def _put(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _zig(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def _msg(*parts: tuple[int, object]) -> bytes:
    out = b""
    for n, v in parts:
        out += _put(n << 3) + _put(v) if isinstance(v, int) else _put(n << 3 | 2) + _put(len(v)) + bytes(v)
    return out


def _deltas(values) -> bytes:
    return b"".join(_put(_zig(b - a)) for a, b in zip([0, *values], values, strict=False))


def encode(path: str, blocks: list[list[tuple]], bbox: tuple[float, float, float, float] | None = None, raw: bool = False) -> None:
    """Write a small dump (for tests and fixtures): blocks of (kind, id, lat, lon, tags) nodes, (kind, id, refs, tags) ways, (kind, id, members, tags) relations."""

    def blob(kind: bytes, body: bytes) -> bytes:
        data = _msg((1, body)) if raw else _msg((2, len(body)), (3, zlib.compress(body)))
        head = _msg((1, kind), (3, len(data)))
        return struct.pack(">I", len(head)) + head + data

    with open(path, "wb") as f:
        box = [(1, _msg(*((k, _zig(round(x * 1e9))) for k, x in zip((1, 2, 3, 4), bbox, strict=True))))] if bbox else []
        f.write(blob(b"OSMHeader", _msg(*box, (4, b"OsmSchema-V0.6"), (4, b"DenseNodes"), (16, b"addrlink"))))
        for block in blocks:
            text: dict[str, int] = {"": 0}
            number = lambda s: text.setdefault(s, len(text))  # noqa: E731,B023
            groups = []
            nodes = [e for e in block if e[0] == "node"]
            if nodes:
                kv = b"".join(b"".join(_put(number(k)) + _put(number(v)) for k, v in e[4].items()) + b"\0" for e in nodes)
                groups.append(_msg((2, _msg((1, _deltas([e[1] for e in nodes])), (8, _deltas([round(e[2] * 1e7) for e in nodes])), (9, _deltas([round(e[3] * 1e7) for e in nodes])), (10, kv)))))
            for e in block:
                tags = [(2, b"".join(_put(number(k)) for k in e[-1])), (3, b"".join(_put(number(v)) for v in e[-1].values()))] if e[0] != "node" else []
                if e[0] == "way":
                    groups.append(_msg((3, _msg((1, e[1]), *tags, (8, _deltas(e[2]))))))
                elif e[0] == "relation":
                    roles = b"".join(_put(number(m[2])) for m in e[2])
                    groups.append(_msg((4, _msg((1, e[1]), *tags, (8, roles), (9, _deltas([m[0] for m in e[2]])), (10, b"".join(_put(m[1]) for m in e[2]))))))
            f.write(blob(b"OSMData", _msg((1, _msg(*((1, s.encode()) for s in text))), *((2, g) for g in groups))))
