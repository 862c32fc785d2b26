"""WARC archives: a deterministic sharded writer and its reader.

Rows are range-sorted by id, so every archive holds one run of ids. Each record
is a gzip member of its own; a file is rolled when its compressed size passes
``roll_bytes``. A task writes under a temporary name that holds its attempt, then
renames to the final name, which depends on the range alone; what counts is the
manifest (Parquet, committed by Spark), which names each file with its records,
size and digest. A task that is run again writes the same bytes to the same
names, and files of lost attempts are in no manifest.

Of records with equal payloads the one with the largest id is a response and the
others revisit it. Only ids and digests meet in that aggregation; payloads are
moved once, by the range sort, and revisits reach them as marker rows sorted next
to them, so a payload that a third of all rows share is no hot key.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, scratch

#: Fixed values of the format.
VERSION, REVISIT_PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # a constant, so that equal input gives equal archives
MANIFEST = "file string, records long, bytes long, sha256 string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member without a time stamp."""
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in headers)]).encode("utf-8")
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def uri(url: str | None) -> str:
    """A target URI of printable characters; control characters and spaces are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" and c != "%" else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in url or "")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, level: int) -> bytes:
    digest = base32_sha1(payload)
    revisit = refers_to is not None
    block = b"" if revisit else payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "text/html"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return member(headers, block, level)


def _files(folder: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _sealed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))


def _markers(rows: DataFrame) -> DataFrame:
    """(id, digest, refers_to) of the ids whose payload a larger id has too. Equal ids with equal payloads stay to the writer."""
    narrow = rows.select("id", F.sha1(F.col("payload").cast("binary")).alias("digest")).where("id is not null")
    top = narrow.groupBy("digest").agg(F.max("id").alias("refers_to"), F.min("id").alias("least")).where("least < refers_to").drop("least")
    return narrow.join(top, "digest").where("id < refers_to").distinct()


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", roll_bytes: int = 256_000_000, level: int = 4, shards: int | None = None) -> DataFrame:
    """Write one record for each row of ``pages`` under ``folder``; returns the committed manifest.

    Null html is an empty payload and takes part like any other. Rows with equal
    ids stay records of their own; where they are the largest id of equal payloads,
    the first is the response and the others revisit that id. A null id is written
    as an empty one, always as a response. Null urls are empty. An empty table
    writes no archive. Other columns are not read.
    """
    spark = pages.sparkSession
    rows = _sealed(pages, id_col, url_col, html_col)
    marks = _markers(rows).select("id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("payload"), "digest", "refers_to")
    both = marks.unionByName(rows.select("id", "url", "payload", F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("refers_to")))
    # archives are runs of ids of equal width, so that they depend on the rows alone; sampled borders differ from run to run
    count = shards or 4 * partitions(spark)
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    # in doubles, which no ids overflow; order is kept, so an archive is still one run of ids
    place = F.floor((F.col("id").cast("double") - F.lit(float(low or 0))) * count / (float(high or 0) - float(low or 0) + 1.0)).cast("int")
    dealt = both.withColumn("shard", F.coalesce(F.least(place, F.lit(count - 1)), F.lit(0)))
    sorted_rows = dealt.repartitionByRange(shards or partitions(spark), "shard").sortWithinPartitions("shard", "id", F.col("digest").isNull(), "digest", "url", F.col("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = _files(folder)
        context = TaskContext.get()
        shard, attempt, part = 0, f"{context.stageId()}-{context.attemptNumber()}-{context.taskAttemptId()}", 0
        disk.create_dir(top, recursive=True)
        done, held, known, same = [], io.BytesIO(), {}, object()
        count = 0
        sink, digest, size, temporary = None, None, 0, ""

        def close():
            nonlocal sink, count, size, part
            if sink is not None:
                sink.write(held.getvalue())
                held.seek(0)
                held.truncate()
                sink.close()
                final = f"part-{shard:06d}-{part:05d}.warc.gz"
                part += 1
                disk.move(temporary, f"{top}/{final}")
                done.append((final, count, size, digest.hexdigest()))
                sink, count, size = None, 0, 0

        for batch in batches:
            for page_id, url, payload, mark, refers_to, at in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if at != shard:
                    close()
                    shard, part = at, 0
                if page_id != same:
                    known, same = {}, page_id
                if mark is not None:
                    known[mark] = refers_to
                    continue
                raw = payload.encode("utf-8")
                sha = hashlib.sha1(raw).hexdigest()
                data = record(page_id, url, raw, known.get(sha) if page_id is not None else None, level)
                if page_id is not None:
                    known.setdefault(sha, page_id)  # a repeated row revisits the first one
                if sink is None:
                    temporary = f"{top}/_{attempt}-{shard:06d}-{part:05d}.tmp"
                    sink, digest = disk.open_output_stream(temporary, compression=None), hashlib.sha256()
                held.write(data)
                digest.update(data)
                count, size = count + 1, size + len(data)
                if held.tell() > 1 << 22:
                    sink.write(held.getvalue())
                    held.seek(0)
                    held.truncate()
                if size >= roll_bytes:
                    close()
        close()
        cols = list(zip(*done, strict=True)) if done else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["file", "records", "bytes", "sha256"])

    sorted_rows.mapInArrow(run, MANIFEST).write.mode("errorifexists").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def records(raw, take: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an open archive, member by member."""
    rest, more = b"", True
    while True:
        squeeze, out = zlib.decompressobj(31), []
        while not squeeze.eof:
            if not rest:
                rest = raw.read(take) if more else b""
                more = bool(rest)
                if not more:
                    break
            out.append(squeeze.decompress(rest))
            rest = squeeze.unused_data if squeeze.eof else b""
        if not out:
            return
        if not squeeze.eof:
            raise ValueError("an archive ends within a record")
        whole = b"".join(out)
        head, _, tail = whole.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8").split("\r\n")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        size = int(headers["Content-Length"])
        if first != VERSION or tail[size:] != b"\r\n\r\n":
            raise ValueError(f"not a record: {first[:40]}")
        yield headers, tail[:size]


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of the archives that the manifest under ``folder`` names; each block is held against its digest.

    ``with_payload`` adds url and payload (null for revisits). Raises where a file
    or a record is not what was written.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    schema = RECORD + ", url string, payload string" * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = _files(folder)
        for batch in batches:
            for name, records_in in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, seen, held = [], 0, 0
                with disk.open_input_stream(f"{top}/{name}", compression=None) as raw:
                    for headers, block in records(raw):
                        if f"sha1:{base32_sha1(block)}" != headers["WARC-Block-Digest"]:
                            raise ValueError(f"{name}: a block is not what its digest says")
                        kind = headers["WARC-Type"]
                        row = (page_of(headers["WARC-Record-ID"]), int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:"), kind, page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None)
                        rows.append((*row, unquote(headers["WARC-Target-URI"]), block.decode("utf-8") if kind == "response" else None) if with_payload else row)
                        seen, held = seen + 1, held + len(block) * with_payload
                        if len(rows) >= 10_000 or held > 1 << 24:
                            yield _batch(rows, with_payload)
                            rows, held = [], 0
                if seen != records_in:
                    raise ValueError(f"{name}: {seen} records, the manifest has {records_in}")
                yield _batch(rows, with_payload)

    return manifest.select("file", "records").repartition(partitions(spark), "file").mapInArrow(run, schema)


def _batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string(), pa.string()] * with_payload
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in RECORD.split(", ")] + ["url", "payload"] * with_payload)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` under the shared folder and read the archives back."""
    folder = scratch(pages.sparkSession, "warc")
    write(pages, folder)
    return read(pages.sparkSession, folder)
