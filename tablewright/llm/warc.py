"""Operator 7: WARC archives as a PySpark Python data source.

Writing: each task writes one file of gzip members, a record each, with the
compressed and the plain length of the member in the gzip extra field ``sl``.
The driver commits a list of the finished files for each write, and only listed
files are read, so attempts that were lost or ran twice leave nothing behind and
a later write to the same folder adds its records.

Reading: the files are dealt to partitions by their size. A partition reads a
record's headers first (the head of its member alone is decompressed), tests
the pushed predicates on record type and headers, and goes on to the next
record by the length in the extra field; payloads of unwanted records, and all
payloads if ``payload`` is "false", are never decompressed. Members without
the field (other writers) and plain ``.warc`` files are read too. Header names
are matched in any case; the payload of a record that is no HTTP message is its
whole block; a digest that is no SHA-1 in base32 or hex is null.

Both sides reach the files through ``pyarrow.fs``, so the folder may be any
shared store that it supports.

Records of equal payloads of at least ``LEAST`` bytes: the one with the largest
page id is the response, the others are revisits that refer to it and keep the
HTTP head but no payload. Rows that share this largest id are all responses.
Cases: a null text is an empty payload; a null url gives no target header; a
null id is the smallest; line breaks in a url are percent-encoded; an empty
table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    IsNotNull, StringStartsWith, WriterCommitMessage)

from tablewright.llm.shared import prepare
from tablewright.session import scratch_path

LEAST = 1000
LIST = "_files"                 # a list of finished files for each write: _files-<id>.json
ID = "urn:page:"
HEAD = 4096                     # compressed bytes that normally hold a record's headers
PARTITION_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"   # no clock: equal tables give equal archives
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, payload_bytes bigint, "
               "refers_to string, payload binary")
HEADERS = ("record_type", "record_id", "target_uri", "payload_digest", "refers_to")


def _store(path: str):
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def member(data: bytes, level: int = 6) -> bytes:
    """One gzip member with its compressed and plain length in field ``sl``."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    extra = struct.pack("<2sHII", b"sl", 8, 24 + len(body) + 8, len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack(
        "<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(kind: str, page: str, url: str | None, digest: str, payload: bytes, size: int, refers: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ID}{page}>", f"WARC-Date: {DATE}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{coded}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    file: str
    size: int


class WarcWriter(DataSourceArrowWriter):
    """Rows: kind, page, url, digest (hex), payload (null for revisits), size, refers."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in iterator:
                for r in batch.to_pylist():
                    data = member(record(r["kind"], r["page"], r["url"], r["digest"], r["payload"] or b"", r["size"], r["refers"]))
                    out.write(data)
                    size += len(data)
        return Written(name, size)

    def commit(self, messages: list) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{LIST}-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps([[m.file, m.size] for m in messages if m is not None and m.size]).encode())


class Files(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(names)


def _fields(block: bytes) -> dict[str, str]:
    """Named fields after a first line; names in small letters, the last of a name counts."""
    named = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in named if colon}


def _has_http(warc: dict[str, str]) -> bool:
    """Whether the block of a record begins with the head of an HTTP message."""
    return warc.get("content-type", "").replace(" ", "").lower().startswith("application/http")


def _length(warc: dict[str, str]) -> int:
    size = warc.get("content-length", "")
    return int(size) if size.isdigit() else 0


def _head(data: bytes) -> tuple[dict[str, str], dict[str, str]] | None:
    """WARC and HTTP headers (none where the block is no HTTP message) from the
    start of a record, or None if cut off."""
    warc, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = _fields(warc)
    if not _has_http(fields):
        return fields, {}
    http, whole, _ = rest.partition(b"\r\n\r\n")
    if not whole and len(rest) < _length(fields):
        return None
    return fields, _fields(http)


def _payload(data: bytes, warc: dict[str, str]) -> bytes:
    """A record's payload: its block, without the head of an HTTP message."""
    start = data.index(b"\r\n\r\n") + 4
    block = data[start:start + _length(warc)]
    return block.partition(b"\r\n\r\n")[2] if _has_http(warc) else block


def _sha1(digest: str | None) -> str | None:
    """The hex form of a SHA-1 given in base32 or hex; null for anything else."""
    kind, _, value = (digest or "").partition(":")
    try:
        raw = bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())
    except ValueError:
        return None
    return raw.hex() if kind.lower() in ("sha1", "sha-1") and len(raw) == 20 else None


def members(f, size: int) -> Iterator[tuple[bytes, object]]:
    """(start of a record, a function that gives the whole record) for each
    record of an open archive; the function is called before the next step."""
    at = 0
    while at < size:
        f.seek(at)
        start = f.read(HEAD)
        if start[:4] == b"\x1f\x8b\x08\x04" and start[12:14] == b"sl":
            length, _ = struct.unpack("<II", start[16:24])
            head = b""
            unzip, used = zlib.decompressobj(31), start
            while True:
                head += unzip.decompress(used)
                if _head(head) or f.tell() >= at + length:
                    break
                used = f.read(HEAD)

            def whole(at=at, length=length) -> bytes:
                f.seek(at)
                return zlib.decompress(f.read(length), 31)

            yield head, whole
            at += length
        elif start[:2] == b"\x1f\x8b":
            unzip, data, used = zlib.decompressobj(31), [], start
            while used and not unzip.eof:
                data.append(unzip.decompress(used))
                used = b"" if unzip.eof else f.read(1 << 16)
            at = f.tell() - len(unzip.unused_data)
            data = b"".join(data)
            yield data, lambda: data
        else:
            while not (head := _head(start)) and f.tell() < size:
                start += f.read(HEAD)
            if not head:
                return
            length = start.index(b"\r\n\r\n") + 4 + _length(head[0])

            def plain(at=at, length=length) -> bytes:
                f.seek(at)
                return f.read(length)

            yield start, plain
            at += length + 4


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for x in filters:
            if isinstance(x, (EqualTo, In, IsNotNull, StringStartsWith)) and x.attribute[0] in HEADERS:
                self.tests.append(x)
            else:
                yield x

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, root = _store(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = []
        lists = [x.path for x in found if x.path.rsplit("/", 1)[-1].startswith(f"{LIST}-")]
        for path in lists:                                  # one for each write to this folder
            with store.open_input_stream(path, compression=None) as f:
                files += [tuple(x) for x in json.loads(f.read())]
        if not lists:
            files = [(x.path[len(root) + 1:], x.size) for x in found if x.path.endswith((".warc", ".warc.gz"))]
        out: list[list[str]] = []
        held = PARTITION_BYTES
        for name, size in sorted(files, key=lambda x: (-x[1], x[0])):
            if held + size > PARTITION_BYTES:
                out.append([])
                held = 0
            out[-1].append(name)
            held += size
        return [Files(x) for x in out] or [Files([])]

    def _wanted(self, row: dict) -> bool:
        for x in self.tests:
            value = row[x.attribute[0]]
            if value is None:
                return False
            if isinstance(x, EqualTo) and value != x.value or isinstance(x, In) and value not in x.value:
                return False
            if isinstance(x, StringStartsWith) and not value.startswith(x.value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in READ_SCHEMA.split(", "))])
        store, root = _store(self.path)
        rows, held = [], 0
        for name in partition.value:
            size = store.get_file_info(f"{root}/{name}").size
            with store.open_input_file(f"{root}/{name}") as f:
                for start, whole in members(f, size):
                    head = _head(start)
                    if head is None:
                        continue
                    warc, web = head
                    size_of = web.get("content-length", "") if _has_http(warc) else str(_length(warc))
                    row = {"record_type": warc.get("warc-type"), "record_id": warc.get("warc-record-id"),
                           "target_uri": warc.get("warc-target-uri"), "refers_to": warc.get("warc-refers-to"),
                           "payload_digest": _sha1(warc.get("warc-payload-digest")),
                           "payload_bytes": int(size_of) if size_of.isdigit() else None, "payload": None}
                    if not self._wanted(row):
                        continue
                    if self.payload:
                        row["payload"] = _payload(whole(), warc)
                        held += len(row["payload"])
                    rows.append(row)
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") != "false")

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark) -> None:
    prepare(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                least: int = LEAST) -> None:
    """Write a record for every page. Payloads are compared by digest and size;
    only those that occur more than once enter the join, as a small table."""
    register(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).select(
        "*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size"))
    many = rows.where(F.col("size") >= least).groupBy("digest", "size").agg(
        F.max("id").alias("chosen"), F.count("*").alias("n")).where("n > 1").select(
        F.col("digest").alias("same"), F.col("size").alias("as_long"), "chosen")
    joined = rows.join(many, (F.col("digest") == F.col("same")) & (F.col("size") == F.col("as_long")), "left")
    again = F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("chosen"))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    joined.select(F.when(again, "revisit").otherwise("response").alias("kind"), named("id").alias("page"), "url", "digest",
                  F.when(~again, F.col("payload")).alias("payload"), "size", F.when(again, named("chosen")).alias("refers")).write.format(
        "warc").mode("append").save(path)


def read_archive(spark, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to an archive in the shared folder and read back: page_id,
    payload_bytes, payload_digest, record_type, refers_to. Digests and sizes of
    responses come from the payloads read, those of revisits from their headers."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_pages(pages, path)
    page = lambda c: F.regexp_extract(c, f"<{ID}(-?[0-9]*)>", 1).try_cast("long")
    whole = read_archive(spark, path).where("record_type = 'response'").select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", "refers_to")
    heads = read_archive(spark, path, payload=False).where("record_type = 'revisit'").select(whole.columns)
    return whole.unionByName(heads).select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                           page("refers_to").alias("refers_to"))
