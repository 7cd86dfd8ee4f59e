"""WARC archives as a Spark data source, and a page archive with revisit records.

``WarcDataSource`` (short name ``warc``) reads and writes folders of ``.warc`` and
``.warc.gz`` files, one record per gzip member.

* Reading plans partitions of whole files, small ones packed together.  Each
  record's headers are parsed first; predicates on header columns are decided
  there, and of a record that is not wanted, or whose payload column is not read,
  nothing more is fetched: plain files are skipped by Content-Length, gzip members
  by the lengths in their ``sl`` field where the writer left one (else the rest is
  inflated and dropped).  Only wanted payloads are decoded.
* Predicates come with a load (``read_archive(where=...)``).  Filters that Spark
  pushes by itself (``spark.sql.python.filterPushdown.enabled``) are taken only from
  a load with the option ``filterPushdown=true``: Spark 4.1 keeps one read per loaded
  frame, so two differently filtered uses of that frame would both get the filters
  planned last.  Filter such a frame once.
* Writing rolls files at ``file_bytes``.  Tasks name files anew per attempt; the
  commit lists those that count in a ``_commit`` file, so files of lost attempts
  are never read.  A folder without such a list is read whole.

Archives go through Arrow file systems, so they may lie on any store that driver
and executors share.

``write_pages`` archives pages: of equal payloads of ``REVISIT_BYTES`` or more the
row with the largest page_id is the response, the others are revisits without a
payload.  Groups of copies are found by digests alone.  They are sent to all tasks
where they are few (their count is checked); beyond that the large groups are,
whose number is bounded by their size, and the rest are joined by digest.

Cases: a NULL html is an empty payload.  Rows that tie for the largest page_id
(repeated rows): one is the response, the smallest url first; rows without a
page_id come last, and a group without any refers to NULL.  Control characters and
spaces in a url are percent-encoded; a NULL url becomes ``urn:page``.  Payloads of
any length are written whole, one at a time.  An empty table gives an archive
without pages.  Other columns are ignored, whatever their names.
"""
from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql import datasource as D

from ..session import scratch_path
from .common import stage

REVISIT_BYTES = 1000
#: Groups of copies that may be sent to every task.
BROADCAST_GROUPS = 100_000
FILE_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20
#: Bytes read first of a record; more only where its headers are longer.
PEEK = 4096

# Names of the WARC 1.1 format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("content_type", T.StringType()), T.StructField("content_length", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to_id", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload", T.BinaryType())])

WRITE_COLUMNS = ("record_type", "page_id", "url", "payload_bytes", "payload_digest", "refers_to", "payload")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow file system and path; Spark writes local paths as ``file:/...``."""
    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


# --------------------------------------------------------------------------
# Records
# --------------------------------------------------------------------------

def _headers(block: bytes) -> dict[str, str]:
    """Header lines after the first, by lower-case name; the first of a repeated name counts."""
    out: dict[str, str] = {}
    for line in re.sub(rb"\r\n[ \t]+", b" ", block).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower().decode("ascii", "replace"), value.strip().decode("utf-8", "replace"))
    return out


def _digest(value: str | None) -> str | None:
    """Bare lower-case hex of a ``sha1:`` digest in base 32 or hex; others as they are."""
    if not value or not value.lower().startswith("sha1:"):
        return value
    value = value[5:]
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def _long(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"[+-]?\d+", value) else None


class _Plain:
    """The record at ``offset`` of a file that is not compressed."""

    def __init__(self, file, offset: int, size: int):
        self.file, self.offset, self.size = file, offset, size
        self.head = b""

    def peek(self, n: int) -> bytes:
        if len(self.head) < n:
            self.file.seek(self.offset)
            self.head = self.file.read(min(n, self.size - self.offset))
        return self.head

    def read(self, length: int) -> bytes:
        return self.peek(length)[:length]

    def next(self, length: int) -> int:
        return self.offset + length


class _Member:
    """The record in the gzip member at ``offset``."""

    def __init__(self, file, offset: int, size: int):
        self.file, self.offset, self.size = file, offset, size
        self.at, self.inflate, self.head, self.skip = offset, zlib.decompressobj(31), b"", None

    def _more(self, n: int) -> bytes:
        self.file.seek(self.at)
        raw = self.file.read(min(n, self.size - self.at))
        if self.at == self.offset and len(raw) >= 24 and raw[3] & 4 and raw[12:14] == b"sl":
            self.skip = struct.unpack("<I", raw[16:20])[0]
        self.at += len(raw)
        return raw

    def peek(self, n: int) -> bytes:
        parts, have = [self.head], len(self.head)
        while have < n and not self.inflate.eof:
            raw = self.inflate.unconsumed_tail or self._more(min(max(PEEK, n - have), 1 << 20))
            if not raw:
                raise ValueError(f"gzip member at {self.offset} is cut off")
            parts.append(self.inflate.decompress(raw, n - have))
            have += len(parts[-1])
        self.head = b"".join(parts)
        return self.head

    def read(self, length: int) -> bytes:
        return self.peek(length)[:length]

    def next(self, length: int) -> int:
        if self.skip:
            return self.offset + self.skip
        while not self.inflate.eof:  # inflate the rest, a bounded piece at a time, and drop it
            raw = self.inflate.unconsumed_tail or self._more(1 << 20)
            if not raw:
                raise ValueError(f"gzip member at {self.offset} is cut off")
            self.inflate.decompress(raw, 1 << 20)
        return self.at - len(self.inflate.unused_data)


def _until_blank(record, start: int, limit: int | None = None) -> int:
    """Where the header lines that begin at ``start`` end, blank line included."""
    n = start + PEEK
    while True:
        head = record.peek(n if limit is None else min(n, limit))
        end = head.find(b"\r\n\r\n", start)
        if end >= 0 and (limit is None or end + 4 <= limit):
            return end + 4
        if len(head) < n:
            return -1
        n *= 4


def read_records(file, name: str, size: int, wanted, payload: bool) -> Iterator[dict]:
    """Records of one archive file that satisfy ``wanted`` (a test of the header
    columns), with their payloads if asked for."""
    kind = _Member if name.endswith(".gz") else _Plain
    offset = 0
    while offset < size:
        record = kind(file, offset, size)
        body = _until_blank(record, 0)
        if body < 0 or not record.head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {offset} of {name}")
        h = _headers(record.head[:body])
        length = int(h["content-length"])
        http = h.get("content-type", "").startswith("application/http")
        start, sizes = body, {}
        if http and length:
            start = _until_blank(record, body, body + length)
            if start < 0:
                start = body
            else:
                sizes = _headers(record.head[body:start])
        row = {"file": name, "offset": offset, "record_type": h.get("warc-type"), "record_id": h.get("warc-record-id"),
               "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date"),
               "content_type": sizes.get("content-type") if http else h.get("content-type"), "content_length": length,
               "payload_bytes": _long(sizes.get("content-length")) if h.get("warc-type") == "revisit" else body + length - start,
               "payload_digest": _digest(h.get("warc-payload-digest")), "refers_to_id": h.get("warc-refers-to"),
               "page_id": _long(h.get("page-id")), "refers_to": _long(h.get("refers-to-page-id")), "payload": None}
        if wanted(row):
            if payload and row["record_type"] != "revisit":
                row["payload"] = record.read(body + length)[start:]
            yield row
        offset = record.next(body + length + 4)


def _field(value) -> bytes:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value).encode()


def _record(row: dict, date: str, min_bytes: int) -> bytes:
    """One response or revisit record of a page."""
    revisit = row["record_type"] == "revisit"
    digest = bytes.fromhex(row["payload_digest"])
    key = f"{row['payload_digest']}:{row['payload_bytes']}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    payload = b"" if revisit else row["payload"]
    response = uuid.uuid5(uuid.NAMESPACE_URL, f"response:{key}")  # one response per payload that has revisits
    small = row["payload_bytes"] < min_bytes
    lines = [VERSION, b"WARC-Type: " + row["record_type"].encode(),
             b"WARC-Record-ID: <urn:uuid:%s>" % str(uuid.uuid4() if revisit or small else response).encode(),
             b"WARC-Date: " + date.encode(),
             b"WARC-Target-URI: " + (b"urn:page" if row["url"] is None else _field(row["url"])),
             b"WARC-Payload-Digest: sha1:" + base64.b32encode(digest),
             b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % (len(http) + len(payload))]
    if row["page_id"] is not None:
        lines.append(b"Page-ID: %d" % row["page_id"])
    if revisit:
        lines += [b"WARC-Profile: " + SAME_PAYLOAD.encode(), b"WARC-Refers-To: <urn:uuid:%s>" % str(response).encode()]
        if row["refers_to"] is not None:
            lines.append(b"Refers-To-Page-ID: %d" % row["refers_to"])
    return b"\r\n".join(lines) + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def _about(date: str) -> bytes:
    body = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    return b"\r\n".join([VERSION, b"WARC-Type: warcinfo", b"WARC-Record-ID: <urn:uuid:%s>" % str(uuid.uuid4()).encode(),
                         b"WARC-Date: " + date.encode(), b"Content-Type: application/warc-fields",
                         b"Content-Length: %d" % len(body)]) + b"\r\n\r\n" + body + b"\r\n\r\n"


def _compressed(record: bytes) -> bytes:
    """A gzip member with the ``sl`` field: its own length and that of the record."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = deflate.compress(record) + deflate.flush()
    size = 24 + len(data) + 8
    if size >= 1 << 32:  # does not fit the field
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + data + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(record) & 0xFFFFFFFF) \
        + data + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


# --------------------------------------------------------------------------
# Data source
# --------------------------------------------------------------------------

# What a predicate asks of a header value; NULL satisfies none but the NULL tests.
_TESTS = {
    "=": lambda v, x: v is not None and v == x,
    "<=>": lambda v, x: v == x,
    "in": lambda v, x: v is not None and v in x,
    ">": lambda v, x: v is not None and v > x,
    ">=": lambda v, x: v is not None and v >= x,
    "<": lambda v, x: v is not None and v < x,
    "<=": lambda v, x: v is not None and v <= x,
    "starts with": lambda v, x: v is not None and v.startswith(x),
    "is null": lambda v, x: v is None,
    "is not null": lambda v, x: v is not None,
}
_PUSHED = {D.EqualTo: "=", D.EqualNullSafe: "<=>", D.In: "in", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=",
           D.LessThan: "<", D.LessThanOrEqual: "<=", D.StringStartsWith: "starts with", D.IsNull: "is null",
           D.IsNotNull: "is not null"}


@dataclass
class Files(D.InputPartition):
    """Archive files (path, size) one task reads."""
    files: list[tuple[str, int]]

    def __init__(self, files):
        self.files = files


@dataclass
class Written(D.WriterCommitMessage):
    files: list[str]


class WarcReader(D.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.target = int(options.get("partitionbytes", PARTITION_BYTES))
        self.where = [tuple(p) for p in json.loads(options.get("where", "[]"))]
        for column, test, _ in self.where:
            if column not in READ_SCHEMA.names or column == "payload" or test not in _TESTS:
                raise ValueError(f"no header predicate: {column} {test}")

    def partitions(self) -> list[Files]:
        """Files in groups of about ``partitionBytes``, never fewer than one each."""
        system, path = file_system(self.path)
        found = system.get_file_info(fs.FileSelector(path))
        commits = [i for i in found if i.base_name.startswith("_commit-")]
        if commits:
            listed = set()
            for c in commits:
                with system.open_input_stream(c.path) as s:
                    listed |= set(json.loads(s.read()))
            found = [i for i in found if i.base_name in listed]
        files = sorted((i.path, i.size) for i in found if re.search(r"\.warc(\.gz)?$", i.base_name) and i.size)
        out: list[list] = []
        room = 0
        for path, size in files:
            if not out or size > room:
                out.append([])
                room = self.target
            out[-1].append((path, size))
            room -= size
        return [Files(f) for f in out] or [Files([])]

    def _wanted(self, row: dict) -> bool:
        return all(_TESTS[test](row[column], value) for column, test, value in self.where)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        names, held, size = self.schema.names, [], 0
        arrow = pa.schema([(f.name, _ARROW[f.dataType]) for f in self.schema])
        for path, length in partition.files:
            with system.open_input_file(path) as file:
                for row in read_records(file, path, length, self._wanted, "payload" in names):
                    held.append({n: row[n] for n in names})
                    size += len(row["payload"] or b"")
                    if len(held) >= 4096 or size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)


class FilteringReader(WarcReader):
    """Takes the filters Spark pushes besides the predicates of the load."""

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            if type(f) in _PUSHED and f.attribute[0] in READ_SCHEMA.names and f.attribute[0] != "payload":
                self.where.append((f.attribute[0], _PUSHED[type(f)], getattr(f, "value", None)))
            else:
                yield f


_ARROW = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}


class WarcWriter(D.DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict):
        if missing := set(WRITE_COLUMNS) - set(schema.names):
            raise ValueError(f"columns missing for an archive: {sorted(missing)}")
        self.path = options["path"]
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.gzip = options.get("gzip", "true").lower() == "true"
        self.most = int(options.get("filebytes", FILE_BYTES))
        self.min_bytes = int(options.get("revisitbytes", REVISIT_BYTES))
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = file_system(self.path)
        task = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        pack = _compressed if self.gzip else bytes
        files, out = [], None
        for batch in iterator:
            for k in range(batch.num_rows):  # a payload at a time
                record = pack(_record(batch.slice(k, 1).to_pylist()[0], self.date, self.min_bytes))
                if out is None or out.tell() > self.most:
                    if out:
                        out.close()
                    files.append(f"{task}-{len(files):04d}.warc" + ".gz" * self.gzip)
                    out = system.open_output_stream(f"{path}/{files[-1]}", compression=None)
                    out.write(pack(_about(self.date)))
                out.write(record)
        if out:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        with system.open_output_stream(f"{path}/_commit-{uuid.uuid4().hex}") as s:
            s.write(json.dumps(sorted(f for m in messages if m for f in m.files)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files of a failed write stay unlisted, and so unread."""


class WarcDataSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        options = {k.lower(): v for k, v in self.options.items()}
        return (FilteringReader if options.get("filterpushdown", "").lower() == "true" else WarcReader)(schema, options)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are appended to; write to a new folder instead")
        return WarcWriter(schema, {k.lower(): v for k, v in self.options.items()})


def read_archive(spark: SparkSession, path: str, payload: bool = True, where: list[tuple] = (), **options) -> DataFrame:
    """Records of an archive folder; without ``payload`` only their headers.

    ``where`` lists (header column, test, value), all of which must hold, e.g.
    ``[("record_type", "=", "response"), ("payload_bytes", ">=", 1000)]``; the tests
    are ``= <=> in > >= < <=``, ``starts with``, ``is null`` and ``is not null`` (value None)."""
    spark.dataSource.register(WarcDataSource)
    schema = READ_SCHEMA if payload else T.StructType([f for f in READ_SCHEMA if f.name != "payload"])
    return spark.read.format("warc").schema(schema).options(where=json.dumps(list(where)), **options).load(path)


def write_archive(records: DataFrame, path: str, **options) -> None:
    """Append ``records`` (``WRITE_COLUMNS``) to an archive folder."""
    records.sparkSession.dataSource.register(WarcDataSource)
    records.select(*WRITE_COLUMNS).write.format("warc").options(**options).mode("append").save(path)


# --------------------------------------------------------------------------
# Pages
# --------------------------------------------------------------------------

_SAME = ["payload_digest", "payload_bytes", "payload_hash"]


def page_records(pages: DataFrame, min_bytes: int = REVISIT_BYTES, most_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """One record (``WRITE_COLUMNS``) per page: a response, or a revisit of an
    equal payload of ``min_bytes`` or more."""
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")) \
        .withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload"),
                      "payload_hash": F.xxhash64("payload")})
    long_ = F.col("payload_bytes") >= min_bytes
    groups = stage(p.where(long_).groupBy(*_SAME).agg(F.count("*").alias("n"), F.max("page_id").alias("refers_to"))
                   .where("n > 1"), "page-copies")
    columns = [*p.columns, "n", "refers_to"]
    if groups.limit(most_groups + 1).count() <= most_groups:
        joined = p.join(F.broadcast(groups), _SAME, "left").select(*columns)
    else:
        # of groups with this many rows there are at most most_groups
        large = groups.agg(F.sum("n")).first()[0] // most_groups
        hot = p.join(F.broadcast(groups.where(F.col("n") > large)), _SAME, "left").select(*columns)
        rest = hot.where(F.col("n").isNull() & long_).drop("n", "refers_to") \
            .join(groups.where(F.col("n") <= large), _SAME, "left").select(*columns)
        joined = hot.where(F.col("n").isNotNull() | ~long_).union(rest)
    first = F.col("page_id").eqNullSafe(F.col("refers_to"))
    none = F.lit(None).cast("long")
    alone = joined.where("n is null").select("*", F.lit("response").alias("record_type"))
    copies = joined.where(F.col("n").isNotNull() & ~first).select("*", F.lit("revisit").alias("record_type"))
    # rows that bear the largest page_id of their group: one each, unless rows repeat
    place = F.row_number().over(Window.partitionBy(*_SAME).orderBy("url"))
    tops = joined.where(F.col("n").isNotNull() & first) \
        .select("*", F.when(place == 1, "response").otherwise("revisit").alias("record_type"))
    revisit = F.col("record_type") == "revisit"
    return alone.union(copies).union(tops) \
        .withColumns({"payload": F.when(~revisit, F.col("payload")), "refers_to": F.when(revisit, F.col("refers_to")).otherwise(none)}) \
        .select(*WRITE_COLUMNS)


def write_pages(pages: DataFrame, path: str, min_bytes: int = REVISIT_BYTES, **options) -> None:
    write_archive(page_records(pages, min_bytes), path, revisitBytes=min_bytes, **options)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the
    pages in an archive: measured on the payload of a response, from the headers
    of a revisit."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    whole = read_archive(spark, path, where=[("record_type", "=", "response")]) \
        .withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    headers = read_archive(spark, path, payload=False, where=[("record_type", "=", "revisit")])
    return whole.select(*columns).union(headers.select(*columns))


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written to an archive in the shared folder and read back."""
    path = scratch_path(pages.sparkSession, "llm", f"warc-{uuid.uuid4().hex}")
    write_pages(pages, path)
    return archived_pages(pages.sparkSession, path)
