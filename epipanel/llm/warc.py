r"""WARC archives as a Spark data source (operator 2).

``spark.read.format("warc")`` plans partitions from the archive files, parses
a record's headers first, tests the pushed-down predicates on them, and only
then decodes the payload, and that only if the requested columns need it.
Records of other kinds are passed over without being inflated: each record is a
gzip member whose ``sl`` extra field (skip lengths, from the WARC
specification) tells where the next one starts. Archives without that field, and uncompressed ones, are read as
well. A gzip archive cannot be entered in its middle, so a file is the smallest
unit of work; the writer starts a new file every ``roll_bytes``.

``df.write.format("warc")`` lets each task write files of its own; the commit
writes a manifest of the files of successful tasks, so a task that was lost
and repeated leaves no records twice.

Paths are opened through pyarrow's file systems by their scheme (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
import struct
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from epipanel.llm.common import narrow, table
from epipanel.llm.words import few_rows
from epipanel.session import shared_scratch_path, write_scratch

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, date string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
MANIFEST = "_manifest.json"
ROLL_BYTES = 64 * 1024 * 1024
PARTITION_BYTES = 128 * 1024 * 1024
BATCH_ROWS, BATCH_BYTES = 2_000, 8 * 1024 * 1024
# column of the table -> header of the record
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
}
PAYLOAD_LENGTH = "X-Payload-Length"  # the full payload's, also where a revisit leaves the payload out
HTTP_END = b"\r\n\r\n"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def _header_value(value: str) -> str:
    """Control characters cannot end a header line: they are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(row: dict) -> bytes:
    """One record as a gzip member with skip lengths."""
    payload = row.get("payload")
    head = [f"{name}: {_header_value(row[column])}" for column, name in HEADERS.items() if row.get(column) is not None]
    if row.get("payload_bytes") is not None:
        head.append(f"{PAYLOAD_LENGTH}: {row['payload_bytes']}")
    kind = "response" if payload is not None else row.get("record_type") or "metadata"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + HTTP_END + (payload or b"")
    head += [f"Content-Type: application/http; msgtype={kind}", f"Content-Length: {len(block)}"]
    plain = ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(plain) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    fits = size < 2**32 and len(plain) < 2**32
    skip = struct.pack("<2sHII", b"sl", 8, size if fits else 0, len(plain) if fits else 0)
    lead = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(skip)) + skip
    return lead + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


class _Member:
    """One gzip member of an open file: headers first, the rest on demand."""

    def __init__(self, file, start: int) -> None:
        self.file, self.start = file, start
        file.seek(start)
        lead = file.read(12)
        if len(lead) < 10 or lead[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {start}")
        flags, at, self.size = lead[3], 10, 0
        if flags & 4:
            (extra_size,) = struct.unpack("<H", lead[10:12])
            extra = file.read(extra_size)
            at = 12 + extra_size
            while len(extra) >= 4:
                name, length = struct.unpack("<2sH", extra[:4])
                if name == b"sl" and length == 8:
                    self.size = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + length :]
        file.seek(start + at)
        for flag in (8, 16):  # a file name, a comment
            while flags & flag and file.read(1) not in (b"\0", b""):
                at += 1
            at += bool(flags & flag)
        at += 2 * bool(flags & 2)
        file.seek(start + at)
        self.inflate = zlib.decompressobj(-zlib.MAX_WBITS)
        self.read_to = start + at
        self.plain = bytearray()

    def _more(self, want: int) -> bool:
        if self.inflate.eof:
            return False
        packed = self.inflate.unconsumed_tail
        if not packed:
            packed = self.file.read(1 << 16 if want > 1 << 14 else 1 << 12)
            self.read_to += len(packed)
            if not packed:
                raise ValueError(f"the member at byte {self.start} is cut off")
        self.plain += self.inflate.decompress(packed, want)
        return True

    def head(self) -> tuple[dict[str, str], int]:
        while (end := self.plain.find(HTTP_END)) < 0:
            if not self._more(1 << 12):
                raise ValueError(f"no record header in the member at byte {self.start}")
        lines = bytes(self.plain[:end]).decode("utf-8", "replace").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, end + 4

    def block(self, at: int, length: int) -> bytes:
        while len(self.plain) < at + length and self._more(1 << 20):
            pass
        return bytes(self.plain[at : at + length])

    def next_start(self) -> int:
        if self.size:
            return self.start + self.size
        while not self.inflate.eof:
            self.plain.clear()
            self._more(1 << 20)
        return self.read_to - len(self.inflate.unused_data) + 8


class _Plain:
    """One record of an uncompressed archive, with the same steps."""

    def __init__(self, file, start: int) -> None:
        self.file, self.start, self.length, self.at = file, start, 0, 0

    def head(self) -> tuple[dict[str, str], int]:
        self.file.seek(self.start)
        text = b""
        while (end := text.find(HTTP_END)) < 0:
            more = self.file.read(4096)
            if not more:
                raise ValueError(f"no record header at byte {self.start}")
            text += more
        lines = text[:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        self.at, self.length = self.start + end + 4, int(head.get("content-length", 0))
        return head, 0

    def block(self, at: int, length: int) -> bytes:
        self.file.seek(self.at)
        return self.file.read(length)

    def next_start(self) -> int:
        return self.at + self.length + 4


def read_records(file, wanted, with_payload: bool) -> Iterator[dict]:
    """Rows of one open archive. ``wanted(row)`` sees the header columns only."""
    size = file.seek(0, 2)
    file.seek(0)
    kind = _Member if file.read(2) == b"\x1f\x8b" else _Plain
    start = 0
    while start < size:
        record = kind(file, start)
        head, at = record.head()
        row = {column: head.get(name.lower()) for column, name in HEADERS.items()}
        if wanted(row):
            length = head.get(PAYLOAD_LENGTH.lower())
            row["payload_bytes"] = int(length) if length is not None else None
            if with_payload and row["record_type"] == "response":
                block = record.block(at, int(head.get("content-length", 0)))
                row["payload"] = block.partition(HTTP_END)[2] if "http" in head.get("content-type", "") else block
            yield row
        start = record.next_start()


@dataclass
class WarcPartition(InputPartition):
    files: tuple[str, ...]

    def __init__(self, files) -> None:
        self.files = tuple(files)


@dataclass
class WarcCommit(WriterCommitMessage):
    files: tuple[str, ...]


def _holds(test, row: dict) -> bool:
    value = row[test.attribute[0]]
    if isinstance(test, IsNotNull):
        return value is not None
    if value is None:
        return False
    if isinstance(test, In):
        return value in test.value
    if isinstance(test, StringStartsWith):
        return value.startswith(test.value)
    return value == test.value


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options) -> None:
        self.schema, self.path = schema, options["path"]
        self.target = int(options.get("partition_bytes", PARTITION_BYTES))
        self.tests: list = []

    def pushFilters(self, filters):
        for test in filters:
            simple = isinstance(test, (EqualTo, In, IsNotNull, StringStartsWith))
            if simple and len(test.attribute) == 1 and test.attribute[0] in HEADERS:
                self.tests.append(test)
            else:
                yield test

    def partitions(self):
        system, root = _open(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.is_file:
            files = [(root, info.size)]
        else:
            found = system.get_file_info(fs.FileSelector(root, recursive=True))
            sizes = {f.path: f.size for f in found if f.is_file and re.search(r"\.warc(\.gz)?$", f.path)}
            manifest = posixpath.join(root, MANIFEST)
            if any(f.path == manifest for f in found):
                with system.open_input_file(manifest) as file:
                    listed = json.loads(file.read())
                files = [(posixpath.join(root, name), sizes[posixpath.join(root, name)]) for name in listed]
            else:
                files = sorted(sizes.items())
        groups: list[list[str]] = []
        room = 0
        for path, size in files:
            if not groups or size > room:
                groups.append([])
                room = self.target
            groups[-1].append(path)
            room -= size
        return [WarcPartition(g) for g in groups] or [WarcPartition(())]

    def read(self, partition):
        system, _ = _open(self.path)
        names = self.schema.names
        arrow = to_arrow_schema(self.schema)
        wanted = lambda row: all(_holds(test, row) for test in self.tests)
        rows: list[dict] = []
        size = 0
        for path in partition.files:
            with system.open_input_file(path) as file:
                for row in read_records(file, wanted, "payload" in names):
                    rows.append({name: row.get(name) for name in names})
                    size += len(row.get("payload") or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.roll = int(options.get("roll_bytes", ROLL_BYTES))

    def write(self, iterator):
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        done: list[str] = []
        out, size = None, 0
        try:
            for batch in few_rows(iterator):
                for row in batch.to_pylist():
                    if out is None:
                        done.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(posixpath.join(root, done[-1]), compression=None), 0
                    record = record_bytes(row)
                    out.write(record)
                    size += len(record)
                    if size >= self.roll:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return WarcCommit(tuple(done))

    def commit(self, messages):
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        names = sorted(name for m in messages if m is not None for name in m.files)
        with system.open_output_stream(posixpath.join(root, MANIFEST)) as file:
            file.write(json.dumps(names).encode())

    def abort(self, messages):
        system, root = _open(self.path)
        for name in (n for m in messages if m is not None for n in m.files):
            system.delete_file(posixpath.join(root, name))


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """The archive's records. ``columns`` is the part of ``SCHEMA`` that is
    needed: without ``payload`` no payload is decoded."""
    register(spark)
    return spark.read.format("warc").schema(columns).load(path)


def write_warc(records: DataFrame, path: str, roll_bytes: int = ROLL_BYTES) -> None:
    """Writes rows that have any of the columns of ``SCHEMA``."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").option("roll_bytes", roll_bytes).save(path)


def base32(hex_digest):
    """Base32 (RFC 4648) of 40 hex digits: each five are four letters."""
    value = lambda i: F.conv(F.substr(hex_digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
    letter = lambda v, shift: F.substr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1))
    four = lambda i: F.concat(*[letter(value(i), shift) for shift in (15, 10, 5, 0)])
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def page_records(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """WARC records of web pages, equal payloads stored once.

    Of the pages with equal payloads of at least ``min_revisit_bytes``, the
    one with the smallest id is a response, the others are revisits of it that
    leave the payload out. Null html is the empty payload. A page without id
    revisits a page with one; where all ids of a payload are null all are
    responses, as are rows that repeat the smallest id. An empty table has no records.
    """
    rows = narrow(pages, page_id="page_id", url="url", html="html").select(
        F.col("page_id").cast("string").alias("id"), "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    # digests are columns of their own: base32 refers to its argument many times
    keyed = rows.withColumn("key", F.unhex(F.sha2("payload", 256))).withColumn("sha1", F.sha1("payload"))
    first = keyed.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # stored: a small table is then broadcast by its size, and the rows of a payload
    # that very many pages share may be split in the join with a large one
    first = write_scratch(first, "shared-payloads")
    joined = keyed.join(first, "key", "left")
    size = F.octet_length("payload")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")) & (size >= min_revisit_bytes)
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        name(F.col("id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(revisit, name(F.col("first"))).alias("refers_to"),
        F.lit(date).alias("date"),
        F.concat(F.lit("sha1:"), base32(F.col("sha1"))).alias("payload_digest"),
        size.cast("bigint").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_scratch_path(spark, "warc")
    write_warc(page_records(table(spark, sf_dir, "pages")), path)
    ident = lambda c: F.nullif(F.substr(c, F.lit(11), F.length(c) - 11), F.lit("")).cast("bigint")
    # responses are decoded and measured; of revisits only headers are read
    responses = read_warc(spark, path, "record_type string, record_id string, refers_to string, payload binary").where(
        F.col("record_type") == "response"
    )
    revisits = read_warc(
        spark, path, "record_type string, record_id string, refers_to string, payload_digest string, payload_bytes bigint"
    ).where(F.col("record_type") == "revisit")
    measured = responses.withColumn("sha1", F.sha1("payload")).select(
        ident(F.col("record_id")).alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32(F.col("sha1")).alias("payload_digest"),
        "record_type",
        ident(F.col("refers_to")).alias("refers_to"),
    )
    listed = revisits.select(
        ident(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        F.substr("payload_digest", F.lit(6)).alias("payload_digest"),
        "record_type",
        ident(F.col("refers_to")).alias("refers_to"),
    )
    return measured.unionAll(listed)


def digest(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


def _oracle_base32() -> str:
    """Each letter of the base32 text as plain SQL over the hex digest."""
    five = [f"CAST('0x' || substr(hex, {i * 5 + 1}, 5) AS BIGINT)" for i in range(8)]
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({value} >> {shift}) & 31) + 1, 1)"
    return " || ".join(letter.format(value=v, shift=s) for v in five for s in (15, 10, 5, 0))


ORACLE_SQL = f"""
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), owned AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first
  FROM payloads
)
SELECT page_id, payload_bytes, {_oracle_base32()} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM owned
"""
