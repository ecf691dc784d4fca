"""WARC archives as a data source of Spark, written and read in Python.

Reading. The files below a path are the partitions. Filters on the record type and on headers are taken over
(`pushFilters`): a record's header block is parsed first, and unless the record passes them and the payload
is wanted, its payload is passed over by its length, not read. Option `payload` (true) says whether
payloads are wanted.

A record's headers are plain and its payload is deflated on its own where that makes it shorter, so the length in the
headers is enough to pass over it, without inflating it.

Writing. A task writes files of about `file_mb` MB under a hidden name of its own; the driver gives those of successful tasks their
names, so tasks of lost executors leave nothing behind that counts. Folders may be on any file system that Arrow knows.

`archive` adds what WARC calls revisits: of records with equal payloads of at least `least` bytes, the one
with the smallest key is the response, the others point to it and hold no payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, WriterCommitMessage)

from coursetrail.session import durable_dir

VERSION = b"WARC/1.1"
#: Columns and the headers they stand for; fixed names of the format, and two headers of our own.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "payload_bytes": "X-Payload-Length",
}
SCHEMA = "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, payload_bytes string, payload binary"
DATE = "1970-01-01T00:00:00Z"  # records carry no time of their own, so that equal tables give equal archives


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record(row: dict) -> bytes:
    """The bytes of a record; a null column gives no header, line ends in a value become spaces."""
    payload, lines = row["payload"] or b"", [VERSION]
    if len(packed := zlib.compress(payload, 1)) < len(payload):
        payload = packed
        lines.append(b"Content-Encoding: deflate")
    for column, header in HEADERS.items():
        if row[column] is not None:
            lines.append(f"{header}: {' '.join(row[column].splitlines())}".encode())
    lines.append(b"Content-Length: %d" % len(payload))
    return b"\r\n".join(lines) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def records(file, wanted, payload: bool) -> Iterator[dict]:
    """Records of an open file whose headers pass `wanted`; others' payloads are passed over."""
    while first := file.readline():
        if not first.strip():
            continue
        if first.strip() != VERSION:
            raise ValueError(f"no record where one was expected: {first[:40]!r}")
        headers: dict[str, str] = {}
        while (line := file.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        row = {column: headers.get(header.lower()) for column, header in HEADERS.items()}
        length = int(headers.get("content-length", 0))
        if not wanted(row):
            file.seek(length, 1)
            continue
        if payload:
            data = file.read(length)
            row["payload"] = zlib.decompress(data) if headers.get("content-encoding") == "deflate" else data
        else:
            file.seek(length, 1)
            row["payload"] = None
        yield row


@dataclass
class WarcFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.equal: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership of header columns are settled here; Spark keeps the others."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if isinstance(f, (EqualTo, EqualNullSafe)) and name in HEADERS:
                self.equal.append((name, (f.value,)))
            elif isinstance(f, In) and name in HEADERS:
                self.equal.append((name, tuple(f.value)))
            else:
                yield f

    def partitions(self) -> list[WarcFile]:
        system, path = filesystem(self.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        return [WarcFile(f.path) for f in sorted(found, key=lambda f: f.path) if f.base_name.endswith(".warc") and not f.base_name.startswith((".", "_"))]

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files, no partitions
            return
        system, _ = filesystem(self.path)
        equal = self.equal
        names = [*HEADERS, "payload"]
        kinds = {n: pa.string() for n in HEADERS} | {"payload": pa.binary()}

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.record_batch({n: pa.array([r[n] for r in rows], kinds[n]) for n in names})

        with system.open_input_file(partition.path) as raw:
            file = Buffered(raw)
            rows, held = [], 0
            for row in records(file, lambda r: all(r[n] in values for n, values in equal), self.payload):
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= 4096 or held >= 1 << 23:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


class Buffered:
    """Lines and blocks of a random-access file; a seek beyond the buffer reads nothing."""

    def __init__(self, file, size: int = 1 << 16):
        self.file, self.size, self.data, self.at = file, size, b"", 0

    def readline(self) -> bytes:
        while (end := self.data.find(b"\n", self.at)) < 0:
            more = self.file.read(self.size)
            self.data, self.at = self.data[self.at:] + more, 0
            if not more:
                line, self.data = self.data, b""
                return line
        line, self.at = self.data[self.at:end + 1], end + 1
        return line

    def read(self, length: int) -> bytes:
        have = self.data[self.at:self.at + length]
        self.at += len(have)
        return have + self.file.read(length - len(have)) if len(have) < length else have

    def seek(self, length: int, _: int) -> None:
        have = min(length, len(self.data) - self.at)
        self.at += have
        if length > have:
            self.file.seek(length - have, 1)


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("file_mb", "64")) << 20

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = filesystem(self.path)
        system.create_dir(path, recursive=True)
        written, out, held = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    written.append(f"{path}/_{uuid.uuid4().hex}.warc")
                    out, held = system.open_output_stream(written[-1]), 0
                data = record(row)
                out.write(data)
                held += len(data)
                if held >= self.size:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(written)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = filesystem(self.path)
        system.create_dir(path, recursive=True)
        for name in (n for m in messages if m for n in m.paths):
            folder, _, base = name.rpartition("/")
            system.move(name, f"{folder}/{base[1:]}")

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = filesystem(self.path)
        for name in (n for m in messages if m for n in m.paths):
            system.delete_file(name)


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make format("warc") known to the session, with filters handed down to it."""
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ---------------------------------------------------------------- archives with revisits


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(key: str) -> str:
    return f"<urn:row:{key}>"


def archive(pages: DataFrame, path: str, least: int = 0) -> None:
    """Write a record for every row of pages (page_id, url, html); payload: the html in UTF-8, null as empty.

    Rows that share both payload and smallest page_id are all responses; a null page_id counts as larger than any other.
    """
    slim = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    keyed = slim.withColumn("digest", F.sha1("payload"))
    shared = (keyed.where(F.length("payload") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
              .where("n > 1").select("digest", "first"))
    rows = keyed.join(shared, "digest", "left").withColumn(
        "revisit", (F.length("payload") >= least) & F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("page_id", "url", "first", "revisit")}
            payloads = batch.column("payload").to_pylist()
            yield pa.record_batch({
                "record_type": pa.array(["revisit" if r else "response" for r in columns["revisit"]], pa.string()),
                "record_id": pa.array(["<urn:row:null>" if i is None else _uri(str(i)) for i in columns["page_id"]], pa.string()),
                "target_uri": pa.array(columns["url"], pa.string()), "date": pa.array([DATE] * len(payloads), pa.string()),
                "payload_digest": pa.array([f"sha1:{base32_sha1(p)}" for p in payloads], pa.string()),
                "refers_to": pa.array([_uri(str(f)) if r else None for f, r in zip(columns["first"], columns["revisit"], strict=True)], pa.string()),
                "payload_bytes": pa.array([str(len(p)) for p in payloads], pa.string()),
                "payload": pa.array([b"" if r else p for p, r in zip(payloads, columns["revisit"], strict=True)], pa.binary())})

    register(pages.sparkSession)
    rows.select("page_id", "url", "payload", "first", "revisit").mapInArrow(made, SCHEMA).write.format("warc").mode("append").save(path)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records, read back from an archive of pages.

    Of a response, length and digest are those of the payload that was read; of a revisit, those of its headers.
    """
    spark = pages.sparkSession
    path = durable_dir(spark, "warc")
    archive(pages, path, least)
    found = spark.read.format("warc").load(path)
    is_read = F.col("record_type") == "response"
    number = lambda c: F.regexp_extract(c, r"(-?\d+)", 1).try_cast("bigint")
    # 160 bits in eight groups of five hex digits, each the same 20 bits as four base-32 digits.
    return found.select(
        number("record_id").alias("page_id"),
        F.when(is_read, F.length("payload").cast("bigint")).otherwise(F.col("payload_bytes").cast("bigint")).alias("payload_bytes"),
        F.when(is_read, _base32(F.sha1("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))


def _base32(sha1_hex):
    """SHA-1 in hex digits as base-32 digits: 20 bits are five of the former and four of the latter."""
    digits = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    found = []
    for group in range(8):
        bits = F.conv(F.substring(sha1_hex, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            found.append(F.substring(digits, F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*found)
