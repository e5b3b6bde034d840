"""WARC archives as a data source: files are planned as partitions, headers are read first, payloads only where wanted."""

from __future__ import annotations

import gzip
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    LessThanOrEqual, StringStartsWith, WriterCommitMessage,
)

from shelfwise.llm.common import MaybeIn, prepare_text
from shelfwise.session import new_shared_path

VERSION = b"WARC/1.1\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_files.json"
SMALLEST_REVISITED = 100
SCHEMA = T.StructType([
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("content_length", T.LongType()), T.StructField("payload_length", T.LongType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("payload", T.BinaryType()),
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
])
HEADER_OF = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}
ARROW = {
    "content_length": pa.int64(), "payload_length": pa.int64(), "offset": pa.int64(), "payload": pa.binary(),
    "headers": pa.map_(pa.string(), pa.string()),
}


def parse_headers(block: bytes) -> dict[str, str]:
    """Named fields by lower-case name; a line that begins with a blank continues the one before."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", block).split(b"\r\n")
    pairs = (line.partition(b":") for line in lines if b":" in line)
    return {name.strip().decode("utf-8", "replace").lower(): value.strip().decode("utf-8", "replace") for name, _, value in pairs}


@dataclass
class Files(InputPartition):
    """The files that one task reads."""

    paths: list[tuple[str, int]] = field(default_factory=list)


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class _Stream:
    """Decompressed bytes with a little look-ahead."""

    def __init__(self, raw):
        self.raw, self.ahead = raw, b""

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with `mark`; None at the end of the stream."""
        while (at := self.ahead.find(mark)) < 0:
            more = self.raw.read(4096)
            if not more:
                if self.ahead.strip():
                    raise ValueError("the archive ends inside a header")
                return None
            self.ahead += more
        out, self.ahead = self.ahead[: at + len(mark)], self.ahead[at + len(mark) :]
        return out

    def take(self, n: int, wanted: bool) -> bytes:
        """The next `n` bytes, or nothing if they are only to be passed over."""
        if not wanted and n > len(self.ahead) and isinstance(self.raw, io.BufferedReader):
            self.raw.seek(n - len(self.ahead), io.SEEK_CUR)
            self.ahead = b""
            return b""
        parts, left = [], n
        while left:
            piece = self.ahead[:left] or self.raw.read(min(left, 1 << 16))
            if not piece:
                raise ValueError("the archive ends inside a record")
            self.ahead = self.ahead[len(piece) :] if self.ahead else b""
            if wanted:
                parts.append(piece)
            left -= len(piece)
        return b"".join(parts)


class _Member:
    """One gzip member of known compressed length, inflated only as far as it is read."""

    def __init__(self, raw: io.BufferedReader, body: int):
        self.raw, self.left, self.inflate = raw, body, zlib.decompressobj(-zlib.MAX_WBITS)

    def read(self, n: int) -> bytes:
        while not self.inflate.eof:
            pending = self.inflate.unconsumed_tail
            if not pending:
                pending = self.raw.read(min(self.left, 1 << 14))
                self.left -= len(pending)
                if not pending:
                    raise ValueError("the archive ends inside a member")
            if out := self.inflate.decompress(pending, n):
                return out
        return b""


def _skip_lengths(raw: io.BufferedReader) -> tuple[int, int] | None:
    """(header, member) lengths in bytes of the gzip member here, from its `sl` extra field; None without one."""
    start = raw.tell()
    head = raw.read(12)
    found = None
    if len(head) == 12 and head[:3] == b"\x1f\x8b\x08" and head[3] == 4:
        extra = raw.read(struct.unpack("<H", head[10:])[0])
        if extra[:4] == b"sl\x08\x00" and len(extra) == 12:
            found = 12 + len(extra), struct.unpack("<I", extra[4:8])[0]
    raw.seek(start)
    return found


def _member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field `sl` tells its own length, so that readers can pass over it."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(data) + packer.flush()
    size = 24 + len(body) + 8
    if size >> 32 or len(data) >> 32:
        raise ValueError("a record of 4 GiB or more does not fit into one member")
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 12) + b"sl\x08\x00" + struct.pack("<II", size, len(data))
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.partition_bytes = int(options.get("partitionBytes", 64 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Comparisons of header columns are done here, before a payload is touched; others stay with Spark."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else ""
            if name in HEADER_OF or name == "content_length":
                kind = {EqualTo: "eq", In: "in", IsNotNull: "some", StringStartsWith: "starts", GreaterThanOrEqual: "ge", LessThanOrEqual: "le"}.get(type(f))
                if kind:
                    self.tests.append((name, kind, getattr(f, "value", None)))
                    continue
            yield f

    def partitions(self) -> list[Files]:
        """Files of the archive, small ones together; those that a finished write lists, else all of them."""
        fs, root = pafs.FileSystem.from_uri(self.path)
        listed = None
        if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/{MANIFEST}") as stream:
                listed = set(json.loads(stream.read()))
        info = fs.get_file_info(root)
        every = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        every = [f for f in every if re.search(r"\.warc(\.gz)?$", f.path) and (listed is None or f.base_name in listed)]
        planned, size = [], 0
        for f in sorted(every, key=lambda f: f.path):
            if not planned or size + f.size > self.partition_bytes:
                planned.append(Files())
                size = 0
            planned[-1].paths.append((f.path, f.size))
            size += f.size
        return planned

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        names = self.schema.names
        rows, size = [], 0
        for path, length in partition.paths if partition else ():
            with fs.open_input_file(path) as handle, io.BufferedReader(handle, 1 << 20) as raw:
                for row in self._records(raw, path, length):
                    rows.append(row)
                    size += 500 + len(row.get("payload") or b"")
                    if size > 8 << 20:
                        yield self._batch(rows, names)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows, names)

    @staticmethod
    def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], ARROW.get(n, pa.string())) for n in names], names=names)

    def _records(self, raw: io.BufferedReader, path: str, length: int) -> Iterator[dict]:
        while (at := raw.tell()) < length:
            zipped = raw.peek(2)[:2] == b"\x1f\x8b"
            known = _skip_lengths(raw) if zipped else None
            if known:
                raw.seek(at + known[0])
                stream = _Stream(_Member(raw, known[1] - known[0] - 8))
                if row := self._record(stream, path, at, whole=False):
                    yield row
                raw.seek(at + known[1])
            else:
                stream = _Stream(gzip.GzipFile(fileobj=raw) if zipped else raw)
                while (row := self._record(stream, path, at, whole=True)) is not None:
                    if row:
                        yield row
                return

    def _record(self, stream: _Stream, path: str, at: int, whole: bool) -> dict | None:
        """The next record; {} if it is not wanted, None at the end. `whole`: pass over what is not read."""
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return None
        version, _, lines = head.lstrip(b"\r\n").partition(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"{path}: no record begins at or after byte {at}")
        headers = parse_headers(lines)
        row = {column: headers.get(name) for column, name in HEADER_OF.items()}
        row |= {"content_length": int(headers.get("content-length", 0)), "file": path, "offset": at}
        left = row["content_length"]
        if not all(self._passes(row[name], kind, value) for name, kind, value in self.tests):
            if whole:
                stream.take(left + 4, wanted=False)
            return {}
        http = headers.get("content-type", "").startswith("application/http") and left > 0
        inner = {}
        if http:
            block = stream.until(b"\r\n\r\n") or b""
            inner, left = parse_headers(block.partition(b"\r\n")[2]), left - len(block)
        revisit = row["record_type"] == "revisit"
        row |= {"headers": list(headers.items()), "payload_length": int(inner.get("content-length", left)) if revisit else left}
        wanted = "payload" in self.schema.names and not revisit
        if wanted or whole:
            data = stream.take(left, wanted)
            row["payload"] = data if wanted else None
            if whole:
                stream.take(4, wanted=False)
        return row

    @staticmethod
    def _passes(have, kind: str, value) -> bool:
        if have is None:
            return False
        return {
            "eq": lambda: have == value, "in": lambda: have in value, "some": lambda: True, "starts": lambda: have.startswith(value),
            "ge": lambda: have >= value, "le": lambda: have <= value,
        }[kind]()


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, date, payload, payload_digest, payload_length, refers_to) as records.

    A task writes files under names of its own; only those of tasks that Spark commits are listed in the manifest, so
    a task that was lost and repeated leaves nothing that is read.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes = int(options.get("fileBytes", 64 << 20))
        self.level = int(options.get("level", 6))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= self.file_bytes:
                    if out:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                data = _member(record_bytes(row), self.level)
                out.write(data)
                size += len(data)
        if out:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        listed = [name for m in messages if m for name in m.files]
        manifest = f"{root}/{MANIFEST}"
        if not self.overwrite and fs.get_file_info(manifest).type == pafs.FileType.File:
            with fs.open_input_stream(manifest) as stream:
                listed = json.loads(stream.read()) + listed
        with fs.open_output_stream(manifest) as stream:
            stream.write(json.dumps(listed).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for name in (name for m in messages if m for name in m.files):
            fs.delete_file(f"{root}/{name}")


def record_bytes(row: dict) -> bytes:
    """One record. A revisit holds the HTTP headers only; their Content-Length is that of the full payload."""
    payload = row["payload"] or b""
    length = len(payload) if row["payload_length"] is None else row["payload_length"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode() + payload
    fields = {
        "WARC-Type": row["record_type"], "WARC-Record-ID": row["record_id"], "WARC-Date": row["date"],
        "WARC-Target-URI": row["target_uri"], "WARC-Payload-Digest": row["payload_digest"], "WARC-Refers-To": row["refers_to"],
        "WARC-Profile": IDENTICAL if row["record_type"] == "revisit" else None,
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    lines = [f"{k}: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', v) if k == 'WARC-Target-URI' else v}\r\n" for k, v in fields.items() if v is not None]
    return VERSION + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


class WarcDataSource(DataSource):
    """`spark.read.format("warc")`. A schema given by the user picks columns; without `payload` none is decoded."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def read_warc(spark: SparkSession, path: str, *columns: str, **options: str) -> DataFrame:
    """Records of the archive at `path` (a file or folder, any file system that Arrow reads); only `columns` if given."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    schema = T.StructType([SCHEMA[c] for c in columns]) if columns else SCHEMA
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def write_pages(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "2024-01-01T00:00:00Z", smallest: int = SMALLEST_REVISITED, **options: str,
) -> None:
    """A record per page. Of pages with equal payloads of at least `smallest` bytes, that with the smallest id is the
    response and the others revisit it; null payloads are empty.

    Only pages whose digest may be shared are shuffled; the counts by digest are added up before they are. A null id
    is never the one revisited unless all are null, when each is a response; so is each repeated row of the smallest
    id. Blanks and control characters in addresses are percent-encoded; a null address gives no such header.
    """
    spark = pages.sparkSession
    prepare_text(spark)
    spark.dataSource.register(WarcDataSource)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_length", F.length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.col("payload_length") >= smallest).select("digest", "id")
    shared = large.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    maybe, alone = MaybeIn(shared, "digest").split(rows)
    joined = maybe.join(shared, "digest", "left").select(*rows.columns, "first")
    every = joined.unionByName(alone.withColumn("first", F.lit(None).cast(rows.schema["id"].dataType)))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    record = every.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), record_id(F.col("id")).alias("record_id"),
        "target_uri", F.lit(date).alias("date"), F.when(~revisit, F.col("payload")).alias("payload"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), "payload_length",
        F.when(revisit, record_id(F.col("first"))).alias("refers_to"),
    )
    record.write.format("warc").mode("append").options(**options).save(path)


def record_id(page) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def page_of(record) -> Column:
    return F.regexp_extract(record, r"^<urn:x-page:(-?\d*)>$", 1).try_cast("bigint")


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to an archive in the shared folder and read back: page_id, payload_bytes, payload_digest,
    record_type, refers_to. Responses are measured on what was read, revisits by their headers alone. A page whose record
    would reach 4 GiB, more than one member of an archive can state, ends in an error."""
    spark = pages.sparkSession
    path = new_shared_path(spark, "archive")
    write_pages(pages, path)
    responses = read_warc(spark, path, "record_type", "record_id", "payload").filter("record_type = 'response'")
    revisits = read_warc(spark, path, "record_type", "record_id", "payload_digest", "payload_length", "refers_to").filter("record_type = 'revisit'")
    page = page_of(F.col("record_id")).alias("page_id")
    full = responses.select(
        page, F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", F.lit(None).cast("bigint").alias("refers_to"),
    )
    return full.unionByName(revisits.select(
        page, F.col("payload_length").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type", page_of(F.col("refers_to")).alias("refers_to"),
    ))
