"""WARC files as a PySpark data source.

``spark.read.format("warc").load(folder)`` plans one partition per group of files, takes over predicates on record
type and other headers, reads each record's headers first and leaves a payload where it is unless the record passes
and the payload was asked for (option ``payload``, default true).  Records are gzip members of their own whose
"sl" extra field (skip lengths, as the format's annex describes) lets the reader pass over unwanted ones without
inflating them; members without it are inflated.

``df.write.format("warc").save(folder)`` writes one file or more per task, named by task attempt and committed by
renaming, so lost or repeated attempts leave nothing that is read.

Defined results: null html is an empty payload; equal payloads, empty ones too, are answered by the largest page_id
and the others revisit it; repeated rows of one page_id with equal payloads are all responses; null urls become
``urn:page``; an empty table writes no record and reads as no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    WriterCommitMessage,
)

from annotspark.llm.components import salted_join

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, page_id long, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)
#: Bytes after which a task begins another file, and that one read partition takes.
FILE_BYTES = 64 << 20
_HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "page_id": "X-Page-ID",
    "refers_to": "X-Refers-To-Page-ID",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Bytes",
}
_NUMBERS = {"page_id", "refers_to", "payload_bytes"}


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def member(record: bytes) -> bytes:
    """A gzip member with its own length and the record's in an "sl" extra field."""
    packed = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = packed.compress(record) + packed.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(record) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + struct.pack("<IBB", 0, 0, 255) + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def make_record(row: dict) -> bytes:
    payload = row.get("payload") or b""
    lines = [b"WARC/1.1"]
    for name, header in _HEADERS.items():
        if row.get(name) is not None:
            value = str(row[name])
            if name == "payload_digest":
                value = f"sha1:{value}"
            lines.append(f"{header}: {value}".encode("utf-8", "replace").replace(b"\r", b" ").replace(b"\n", b" "))
    lines.append(b"Content-Length: %d" % len(payload))
    return b"\r\n".join(lines) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _number(value: str | None) -> int | None:
    try:
        return None if value is None else int(value)
    except ValueError:
        return None


def parse_headers(raw: bytes) -> dict:
    """Header fields by column; a number that isn't one is null, and a missing length is 0."""
    found = {}
    for line in raw.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        found[key.decode("utf-8", "replace").strip().lower()] = value.strip().decode("utf-8", "replace")
    row: dict = {}
    for name, header in _HEADERS.items():
        value = found.get(header.lower())
        if value is not None and name == "payload_digest":
            value = value.removeprefix("sha1:")
        row[name] = _number(value) if name in _NUMBERS else value
    row["_length"] = max(0, _number(found.get("content-length")) or 0)
    return row


def _passes(row: dict, filters: list[tuple[str, str, tuple]]) -> bool:
    for op, name, values in filters:
        value = row[name]
        if op == "null" and value is not None or op == "some" and value is None or op == "in" and value not in values:
            return False
    return True


class _Plain:
    """The text of gzip members, inflated piece by piece as it is asked for."""

    def __init__(self, stream, piece: int = 1 << 16):
        self.stream, self.piece = stream, piece
        self.inflate, self.held, self.packed = zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        if self.inflate.eof:
            self.packed, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
        if not self.packed:
            self.packed = self.stream.read(self.piece)
        if not self.packed:
            return False
        now, self.packed = self.packed, b""
        try:
            self.held += self.inflate.decompress(now, self.piece * 4)
        except zlib.error:  # not gzip from here on, or cut short
            return False
        self.packed = self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the mark, which is passed over; None at the end."""
        while (at := self.held.find(mark)) < 0:
            if not self._more():
                return None
        out, self.held = self.held[:at], self.held[at + len(mark) :]
        return out

    def take(self, n: int, keep: bool) -> bytes | None:
        """The next ``n`` bytes; only counted, unless they are to be kept.  None where there are fewer."""
        parts = []
        while n > len(self.held):
            n -= len(self.held)
            if keep:
                parts.append(self.held)
            self.held = b""
            if not self._more():
                return None
        if keep:
            parts.append(self.held[:n])
        self.held = self.held[n:]
        return b"".join(parts)


def _own(stream, filters: list, want_payload: bool) -> Iterator[dict]:
    """Records of members with their length in an "sl" field, up to the first other one, which the stream is left at."""
    while True:
        at = stream.tell()
        head = stream.read(24)
        if len(head) < 24 or head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != b"sl":
            stream.seek(at)
            return
        total, _ = struct.unpack("<II", head[16:24])
        inflate, text, packed, end = zlib.decompressobj(-15), b"", b"", at + total
        while b"\r\n\r\n" not in text and stream.tell() < end:
            packed = stream.read(min(1 << 10, end - stream.tell()))
            if not packed:
                break
            text += inflate.decompress(packed)
        top, gap, rest = text.partition(b"\r\n\r\n")
        if not gap:
            return
        row = parse_headers(top)
        if _passes(row, filters):
            if want_payload:
                packed = stream.read(max(0, end - stream.tell())) if len(rest) < row["_length"] else b""
                row["payload"] = (rest + inflate.decompress(packed))[: row["_length"]]
                if len(row["payload"]) < row["_length"]:
                    return
            yield row
        stream.seek(end)


def records(stream, filters: list, want_payload: bool) -> Iterator[dict]:
    """Records of one gzip file, whose headers are parsed first.

    Members of this writer that the filters reject are passed over by their length, without reading or inflating their
    payload.  Other writers' members have to be inflated to be passed over, which is done piece by piece; no more than
    one payload that is wanted is held.  A record that is cut short ends the file; what isn't a record's beginning is
    passed over up to the next.
    """
    yield from _own(stream, filters, want_payload)
    plain = _Plain(stream)
    while (top := plain.until(b"\r\n\r\n")) is not None:
        begin = top.rfind(b"WARC/")
        if begin < 0:
            continue
        row = parse_headers(top[begin:])
        fits = _passes(row, filters)
        payload = plain.take(row["_length"], fits and want_payload)
        if payload is None:
            return
        if fits:
            if want_payload:
                row["payload"] = payload
            yield row


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.want_payload = str(options.get("payload", "true")).lower() == "true"
        self.filters: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in _HEADERS and isinstance(f, EqualTo):
                self.filters.append(("in", name, (f.value,)))
            elif name in _HEADERS and isinstance(f, In):
                self.filters.append(("in", name, tuple(f.value)))
            elif name in _HEADERS and isinstance(f, IsNotNull):
                self.filters.append(("some", name, ()))
            elif name in _HEADERS and isinstance(f, IsNull):
                self.filters.append(("null", name, ()))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        store, base = _file_system(self.folder)
        found = [x for x in store.get_file_info(fs.FileSelector(base, allow_not_found=True)) if x.base_name.endswith(".warc.gz")]
        groups: list[list[str]] = []
        size = FILE_BYTES
        for x in sorted(found, key=lambda x: x.base_name):
            if size + x.size > FILE_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(x.path)
            size += x.size
        return [_Files(g) for g in groups] or [_Files([])]

    def read(self, partition):
        store, _ = _file_system(self.folder)
        names = [*_HEADERS, "payload"]
        for path in partition.paths:
            with store.open_input_file(path) as f:
                for row in records(f, self.filters, self.want_payload):
                    yield tuple(row.get(n) for n in names)


class _Done(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, iterator):
        store, base = _file_system(self.folder)
        store.create_dir(base, recursive=True)
        names: list[str] = []
        out, size = None, 0
        for row in iterator:
            if out is None:
                names.append(f"{uuid.uuid4().hex}.part")
                out, size = store.open_output_stream(f"{base}/{names[-1]}"), 0
            data = member(make_record(row.asDict()))
            out.write(data)
            size += len(data)
            if size >= FILE_BYTES:
                out.close()
                out = None
        if out is not None:
            out.close()
        return _Done(names)

    def commit(self, messages):
        store, base = _file_system(self.folder)
        for m in messages:
            for n in m.names if m else ():
                store.move(f"{base}/{n}", f"{base}/{n.removesuffix('.part')}.warc.gz")

    def abort(self, messages):
        store, base = _file_system(self.folder)
        for m in messages:
            for n in m.names if m else ():
                store.delete_file(f"{base}/{n}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of a SHA-1: every 5 hex digits are 4 base32 digits."""
    h = F.sha1(data)
    quads = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_records(pages: DataFrame) -> DataFrame:
    """The records of pages: responses, and revisits of pages whose payload a larger page_id holds too.

    Copies are found by digest; the join with the largest page_id per digest carries only digests that occur twice or
    more, and the pages of one digest are dealt to several parts.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    last = rows.groupBy("payload_digest").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    joined = salted_join(rows, last, "payload_digest", "page_id", "left")
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return joined.select(
        F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("/", F.col("page_id"), "payload_digest")), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.coalesce("url", F.lit("urn:page")).alias("target_uri"),
        F.lit("2000-01-01T00:00:00Z").alias("warc_date"),
        "page_id",
        F.when(revisit, F.col("_last")).alias("refers_to"),
        "payload_digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write(pages: DataFrame, folder: str) -> None:
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(folder)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


#: The page records in DuckDB's dialect; base32 digits are five bits of the hex digest each.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
  lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(sha1(h), CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> s) & 31) + 1, 1)), '')), '') AS g FROM p),
m AS (SELECT g, max(page_id) AS last FROM d GROUP BY g)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.g AS payload_digest,
  CASE WHEN d.page_id = m.last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN d.page_id = m.last THEN NULL ELSE m.last END AS refers_to FROM d JOIN m ON d.g = m.g
"""
