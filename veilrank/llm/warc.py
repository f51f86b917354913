"""WARC archives as a Python data source, and page archives with revisit records.

The reader plans partitions from file sizes, takes predicates on the record type and on any
header column, parses the headers first and inflates a payload only for a record that passed.
The writer rolls files at ``roll`` bytes, so that a file is a good unit of reading, and stores every
record as a gzip member of its own whose extra field ``sl`` holds the member's lengths: a reader
steps over an unwanted record without inflating it.  Archives of other writers have no such field;
their unwanted records are inflated and dropped.

Files are opened through ``pyarrow.fs``, so the folder may be in any store that it knows.  A task
writes files under names of its own, and the driver lists them in a manifest when all tasks have
ended: files of lost or repeated tasks are never read.  Where a folder has no manifest, every
``*.warc`` and ``*.warc.gz`` file in it is read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import RecordBatch
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, content_type string, payload_length long, payload binary"
)
_COLUMNS = tuple(c.split()[0] for c in SCHEMA.split(", "))

# Fixed values of the format.
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
}
_HTTP = "application/http; msgtype=response"
_CHUNK = 1 << 16


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _line(value: str) -> str:
    """A header value on one line: control characters become percent codes."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def pack(record: dict) -> bytes:
    """One record as a gzip member with its compressed and full length in the field ``sl``."""
    kind, payload = record["record_type"], record.get("payload") or b""
    length = record.get("payload_length")
    length = len(payload) if length is None else length
    http = kind in ("response", "revisit")
    block = payload
    if http:
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
        block = head.encode() + (payload if kind == "response" else b"")
    lines = [_VERSION.decode()]
    for column, name in _NAMES.items():
        value = _HTTP if column == "content_type" and http else record.get(column)
        if value is not None:
            lines.append(f"{name}: {_line(value)}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {_PROFILE}")
    lines.append(f"Content-Length: {len(block)}")
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    deflate = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 12 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class _Plain:
    """The bytes of an uncompressed archive, record after record."""

    def __init__(self, file):
        self.file = file

    def start(self) -> bool:
        here = self.file.tell()
        more = bool(self.file.read(1))
        self.file.seek(here)
        return more

    def read(self, n: int) -> bytes:
        return self.file.read(n)

    def skip(self, n: int) -> None:
        self.file.seek(self.file.tell() + n)

    def end(self, left: int) -> None:
        self.skip(left)


class _Members:
    """The inflated bytes of a compressed archive, member after member."""

    def __init__(self, file):
        self.file = file
        self.inflate, self.next = None, None

    def start(self) -> bool:
        here = self.file.tell()
        head = self.file.read(24)
        if not head:
            return False
        self.next = None
        if len(head) == 24 and head[3] & 4 and head[12:14] == b"sl":
            self.next = here + struct.unpack("<I", head[16:20])[0]
        self.file.seek(here)
        self.inflate = zlib.decompressobj(31)
        return True

    def read(self, n: int) -> bytes:
        parts, left = [], n
        while left and not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.file.read(_CHUNK)
            if not data:
                raise ValueError("an archive ends within a record")
            got = self.inflate.decompress(data, left)
            parts.append(got)
            left -= len(got)
        return b"".join(parts)

    def end(self, left: int) -> None:
        """Go on behind this member; only one without a length field is inflated for that."""
        if self.next is not None:
            self.file.seek(self.next)
            return
        while not self.inflate.eof:
            self.read(_CHUNK)
        self.file.seek(self.file.tell() - len(self.inflate.unused_data))


def _headers(source) -> tuple[dict[str, str], bytes]:
    """Header lines by lower-case name, and what was read beyond them."""
    data = b""
    while (end := data.find(b"\r\n\r\n")) < 0:
        more = source.read(1024)
        if not more:
            if data.strip():
                raise ValueError("an archive ends within record headers")
            return {}, b""
        data = (data + more).lstrip(b"\r\n") if not data else data + more
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:80]!r}")
    pairs = (line.partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}, data[end + 4 :]


def _take(source, held: bytes, n: int) -> bytes:
    if len(held) >= n:
        return held[:n]
    got = held + source.read(n - len(held))
    if len(got) < n:
        raise ValueError("an archive ends within a block")
    return got


def records(file, compressed: bool, keep, payloads: bool) -> Iterator[tuple]:
    """The records whose header columns ``keep`` accepts, as tuples in the order of ``SCHEMA``."""
    source = _Members(file) if compressed else _Plain(file)
    while source.start():
        headers, held = _headers(source)
        if not headers:
            return
        length = int(headers["content-length"])
        row = {c: headers.get(n.lower()) for c, n in _NAMES.items()}
        http = (row["content_type"] or "").startswith("application/http")
        row["payload_length"] = None if http else length
        used = len(held)
        if http:  # the length of the payload is in the block's own head, a few lines long
            while b"\r\n\r\n" not in held and len(held) < length:
                more = source.read(min(1024, length - len(held)))
                if not more:
                    raise ValueError("an archive ends within a block")
                held += more
            used = len(held)
            head, cut, _ = held[:length].partition(b"\r\n\r\n")
            offset = len(head) + len(cut) if cut else 0
            said = [x for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            inside = length - offset
            row["payload_length"] = (
                int(said[0].split(b":")[1]) if row["record_type"] == "revisit" and said else inside
            )
        else:
            offset = 0
        if keep(row):
            payload = None
            if payloads and row["record_type"] != "revisit":
                block = _take(source, held, length)
                used = max(used, length)
                payload = block[offset:]
            yield (*(row[c] for c in _COLUMNS[:-1]), payload)
        # An uncompressed record ends with two line ends behind the block.
        source.end(length + 4 - used)


_TESTS = {
    EqualTo: lambda v, x: v is not None and v == x,
    EqualNullSafe: lambda v, x: v == x,
    GreaterThan: lambda v, x: v is not None and v > x,
    GreaterThanOrEqual: lambda v, x: v is not None and v >= x,
    LessThan: lambda v, x: v is not None and v < x,
    LessThanOrEqual: lambda v, x: v is not None and v <= x,
    In: lambda v, x: v is not None and v in x,
    StringStartsWith: lambda v, x: v is not None and v.startswith(x),
    StringEndsWith: lambda v, x: v is not None and v.endswith(x),
    StringContains: lambda v, x: v is not None and x in v,
    IsNull: lambda v, _: v is None,
    IsNotNull: lambda v, _: v is not None,
}


def _passes(row: dict, filters: list) -> bool:
    for f in filters:
        inner = f.child if isinstance(f, Not) else f
        value = row[inner.attribute[0]]
        if isinstance(f, Not) and value is None and not isinstance(inner, (IsNull, IsNotNull, EqualNullSafe)):
            return False  # neither the test nor its negation holds for null
        if _TESTS[type(inner)](value, getattr(inner, "value", None)) == isinstance(f, Not):
            return False
    return True


@dataclass
class _Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() == "true"
        self.target = int(options.get("partitionbytes", 32 << 20))
        self.filters: list = []

    def pushFilters(self, filters):
        for f in filters:
            inner = f.child if isinstance(f, Not) else f
            column = getattr(inner, "attribute", ())
            if type(inner) in _TESTS and len(column) == 1 and column[0] in _COLUMNS[:-1]:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        store, folder = _filesystem(self.path)
        found = {
            f.base_name: f.size
            for f in store.get_file_info(fs.FileSelector(folder))
            if f.is_file
        }
        listed = [n for n in found if n.startswith("_manifest-")]
        if listed:
            names = []
            for n in listed:
                with store.open_input_stream(f"{folder}/{n}") as file:
                    names += json.loads(file.read())
        else:
            names = [n for n in found if n.endswith((".warc", ".warc.gz"))]
        bins: list[_Files] = []
        size = self.target
        for n in sorted(names):
            if size >= self.target:
                bins.append(_Files([]))
                size = 0
            bins[-1].paths.append(n)
            size += found[n]
        return bins or [_Files([])]

    def read(self, partition):
        store, folder = _filesystem(self.path)
        for name in partition.paths:
            with store.open_input_file(f"{folder}/{name}") as file:
                keep = lambda row: _passes(row, self.filters)
                yield from records(file, name.endswith(".gz"), keep, self.payloads)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.roll = int(options.get("roll", 32 << 20))

    def write(self, iterator: Iterator[RecordBatch]) -> _Written:
        store, folder = _filesystem(self.path)
        store.create_dir(folder, recursive=True)
        names: list[str] = []
        out = None
        try:
            for batch in iterator:
                columns = batch.schema.names
                for i in range(batch.num_rows):
                    if out is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out = store.open_output_stream(f"{folder}/{names[-1]}", compression=None)
                        out.write(pack({"record_type": "warcinfo", "record_id": f"<urn:uuid:{uuid.uuid4()}>",
                                        "warc_date": "1970-01-01T00:00:00Z",
                                        "content_type": "application/warc-fields",
                                        "payload": b"format: WARC File Format 1.1\r\n"}))
                    out.write(pack({c: batch.column(j)[i].as_py() for j, c in enumerate(columns)}))
                    if out.tell() >= self.roll:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def commit(self, messages) -> None:
        store, folder = _filesystem(self.path)
        store.create_dir(folder, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        with store.open_output_stream(f"{folder}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        store, folder = _filesystem(self.path)
        for m in messages:
            for n in m.names if m is not None else ():
                store.delete_file(f"{folder}/{n}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)``; option ``payload=false`` leaves payloads out."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def _register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of an archive folder; a filter on any column but the payload is pushed down."""
    _register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_warc(records_: DataFrame, path: str) -> None:
    """Write rows with columns of ``SCHEMA`` (all but the record type may be missing or null)."""
    _register(records_.sparkSession)
    records_.write.format("warc").mode("append").save(path)


def page_id(column: str) -> Column:
    """The key within a record name made by ``archive_pages``; null where the key was null."""
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def archive_pages(pages: DataFrame, path: str, least: int = 100) -> None:
    """Write one record per row of ``pages(page_id, url, html)``, payload the html in UTF-8.

    Among equal payloads of at least ``least`` bytes, the page with the smallest key is a response
    and the others are revisits of it, without a payload.  A null html is an empty payload, a null
    url leaves the header out, a null key never is the smallest; pages that repeat a key and the
    payload of the response are responses too.  Other columns are ignored.

    Only digests are grouped, with partial minima.  The html moves once, by its key, to meet the
    few columns of its revisit.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    )
    long_ = full.where(F.length("payload") >= least).select("page_id", "digest")
    copies = (
        long_.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL")
    )
    revisits = (
        long_.join(copies, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.col("page_id").alias("key"), F.col("digest").alias("same"), "first")
        .distinct()
    )
    joined = full.join(
        revisits,
        full.page_id.eqNullSafe(revisits.key) & (full.digest == revisits.same),
        "left",
    )
    again = F.col("first").isNotNull()

    def urn(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    write_warc(
        joined.select(
            urn("page_id").alias("record_id"),
            F.when(again, "revisit").otherwise("response").alias("record_type"),
            F.col("url").alias("target_uri"),
            F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
            F.when(again, urn("first")).alias("refers_to"),
            F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
            F.length("payload").cast("long").alias("payload_length"),
            F.when(~again, F.col("payload")).alias("payload"),
        ),
        path,
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages of an archive: length and digest are of the payload as read, for revisits as told."""
    pages = read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    response = F.col("record_type") == "response"
    return pages.select(
        page_id("record_id").alias("page_id"),
        F.when(response, F.length("payload").cast("long"))
        .otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256))
        .otherwise(F.regexp_replace("payload_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type",
        page_id("refers_to").alias("refers_to"),
    )
