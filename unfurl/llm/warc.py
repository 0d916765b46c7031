"""WARC archives as a PySpark data source, and pages written to and read from them.

Reading plans partitions from the sizes of the files: small files share one, and large files
that were written here are cut at record boundaries by the index beside them. Filters on the
record's type and on header columns are pushed into the scan. A record's headers are parsed
first; the block of a record that the filters reject, or whose columns nobody asked for, is
passed over (by a seek, in compressed files too where the member says its length) and never
decoded.

Writing gives every task files of its own, rolled over at a size, each with an index; a
manifest written by the commit names the files that count, so what a lost or repeated task left
behind is never read.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not,
                                    StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

from unfurl.operators.joins import Dim, HotKeys, enrich

from . import common

#: fixed values of the format: column of the source -> named field of the header
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "warc_date": "WARC-Date", "target_uri": "WARC-Target-URI",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "content_type": "Content-Type"}
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"

SCHEMA = T.StructType([
    *[T.StructField(c, T.StringType()) for c in HEADERS], T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType()),
    T.StructField("path", T.StringType()), T.StructField("offset", T.LongType())])
READ_BYTES = 1 << 18


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)", "file:///", path))


# -- one file ------------------------------------------------------------------------------------

class _Bytes:
    """Sequential reads with cheap skips over a seekable file."""

    def __init__(self, handle, at: int, end: int | None = None):
        self.handle, self.size = handle, handle.size() if end is None else end
        self.buffer, self.base, self.at = b"", at, 0       # the buffer starts at ``base``
        handle.seek(at)

    @property
    def place(self) -> int:
        return self.base + self.at

    def more(self) -> bool:
        """Put the next part of the file behind what is left of the buffer."""
        got = self.handle.read(READ_BYTES)
        self.buffer, self.base, self.at = self.buffer[self.at:] + got, self.place, 0
        return bool(got)

    def need(self, n: int) -> bytes:
        if len(self.buffer) - self.at < n:      # a large block in one read
            got = self.handle.read(n - (len(self.buffer) - self.at))
            self.buffer, self.base, self.at = self.buffer[self.at:] + got, self.place, 0
            if len(self.buffer) < n:
                raise ValueError(f"record cut off at byte {self.place}")
        out = self.buffer[self.at:self.at + n]
        self.at += n
        return out

    def skip(self, n: int) -> None:
        if self.at + n <= len(self.buffer):
            self.at += n
        else:
            self.base, self.buffer, self.at = self.place + n, b"", 0
            self.handle.seek(self.base)

    def until(self, mark: bytes, start: int = 0) -> bytes | None:
        """What stands before the next ``mark``; the place moves behind it. None at the end of the file."""
        look = start
        while (hit := self.buffer.find(mark, self.at + look)) < 0:
            look = max(0, len(self.buffer) - self.at - len(mark) + 1)
            if not self.more():
                return None
        out = self.buffer[self.at:hit]
        self.at = hit + len(mark)
        return out


class _Member:
    """One gzip member as a stream; knows where it ends if it says so (extra field ``sl``: compressed size)."""

    def __init__(self, src: _Bytes):
        self.src, self.start = src, src.place
        head = src.need(10)
        if head[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at byte {self.start}")
        self.length = None
        if head[3] & 4:
            extra = src.need(int.from_bytes(src.need(2), "little"))
            while len(extra) >= 4:
                n = int.from_bytes(extra[2:4], "little")
                if extra[:2] == b"sl" and n == 8:
                    self.length = int.from_bytes(extra[4:12], "little")
                extra = extra[4 + n:]
        for bit in (8, 16):     # name, comment
            if head[3] & bit:
                src.until(b"\0")
        if head[3] & 2:
            src.skip(2)
        self.inflate, self.out, self.ended = zlib.decompressobj(-15), b"", False

    def _step(self, want: int) -> None:
        src = self.src
        if src.at == len(src.buffer) and not src.more():
            raise ValueError(f"gzip member at byte {self.start} is cut off")
        data = self.inflate.decompress(src.buffer[src.at:], want)
        left = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        src.at = len(src.buffer) - len(left)
        self.out += data
        self.ended = self.inflate.eof

    def until(self, mark: bytes) -> bytes | None:
        while mark not in self.out:
            if self.ended:
                return None
            self._step(4096)
        head, _, self.out = self.out.partition(mark)
        return head

    def need(self, n: int) -> bytes:
        while len(self.out) < n:
            if self.ended:
                raise ValueError(f"record in the member at byte {self.start} is cut off")
            self._step(max(READ_BYTES, n - len(self.out)))
        out, self.out = self.out[:n], self.out[n:]
        return out

    def leave(self) -> None:
        """On to the next member."""
        if not self.ended and self.length is not None:
            self.src.skip(self.start + self.length - self.src.place)
            return
        while not self.ended:
            self.out = b""
            self._step(READ_BYTES)
        self.src.need(8)        # check sum and size


def parse_headers(raw: bytes) -> dict[str, str]:
    """Named fields, the last of a name holds; names keep their case, folded lines are joined."""
    out: dict[str, str] = {}
    name = None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip()
            out[name] = value.strip()
    return out


@dataclass
class Wanted:
    """What a scan asks for: column names in order, tests of header values by column."""

    columns: list[str]
    tests: list[tuple[str, str, object]] = field(default_factory=list)

    def passes(self, headers: dict[str, str]) -> bool:
        return all(_holds(kind, headers.get(HEADERS[column].lower()), value) for column, kind, value in self.tests)

    @property
    def block(self) -> bool:
        return "payload" in self.columns

    @property
    def size(self) -> bool:
        return "payload_bytes" in self.columns


def _holds(kind: str, have: str | None, value) -> bool:
    if kind.startswith("not "):
        return have is not None and not _holds(kind[4:], have, value)
    if kind == "null":
        return have is None
    if have is None:
        return kind == "same" and value is None
    return {"set": lambda: True, "is": lambda: have == value, "same": lambda: have == value, "in": lambda: have in value,
            "above": lambda: have > value, "from": lambda: have >= value, "below": lambda: have < value, "to": lambda: have <= value,
            "starts": lambda: have.startswith(value), "ends": lambda: have.endswith(value), "holds": lambda: value in have}[kind]()


def scan_file(handle, path: str, start: int, end: int | None, want: Wanted) -> Iterator[tuple]:
    """The wanted values of the records that begin in [start, end) of one file."""
    src = _Bytes(handle, start)
    stop = src.size if end is None else end
    packed = path.endswith(".gz")
    while src.place < stop:
        offset = src.place
        stream = _Member(src) if packed else src
        raw = stream.until(b"\r\n\r\n")
        if raw is None:
            raise ValueError(f"{path}: no record at byte {offset}")
        if not raw.lstrip().startswith(b"WARC/"):
            raise ValueError(f"{path}: no record at byte {offset}")
        headers = parse_headers(raw.lstrip())
        lower = {k.lower(): v for k, v in headers.items()}
        length, size, payload = int(lower.get("content-length", 0)), None, None
        keep = want.passes(lower)
        rest = length
        if keep and (want.block or want.size):
            head = b""
            if lower.get("content-type", "").replace(" ", "").startswith("application/http"):
                got = stream.until(b"\r\n\r\n") if length else None
                if got is not None and len(got) + 4 <= length:
                    head = got + b"\r\n\r\n"
            rest = length - len(head)
            if lower.get("warc-type") == "revisit":     # its payload is elsewhere; the HTTP header has the size
                inner = {k.lower(): v for k, v in parse_headers(head).items()}
                size = int(inner["content-length"]) if inner.get("content-length", "").isdigit() else None
            else:
                size = rest
                if want.block:
                    payload, rest = stream.need(rest), 0
        if packed:
            stream.leave()
        else:
            src.skip(rest + 4)
        if keep:
            values = {"headers": headers, "payload_bytes": size, "payload": payload, "path": path, "offset": offset}
            yield tuple(values[c] if c in values else lower.get(HEADERS[c].lower()) for c in want.columns)


# -- reading ---------------------------------------------------------------------------------------

class Files(InputPartition):
    """Files, or ranges of files, that one task reads: (path, start, end or None)."""

    def __init__(self, ranges: list[tuple[str, int, int | None]]):
        super().__init__(ranges)


_KINDS: dict[type, str] = {EqualTo: "is", EqualNullSafe: "same", In: "in", IsNull: "null", IsNotNull: "set", GreaterThan: "above",
                           GreaterThanOrEqual: "from", LessThan: "below", LessThanOrEqual: "to", StringStartsWith: "starts",
                           StringEndsWith: "ends", StringContains: "holds"}


def _test(f: Filter) -> tuple[str, str, object] | None:
    """A pushed filter as (column, kind, value); None if the scan cannot decide it."""
    if isinstance(f, Not):
        inner = _test(f.child)
        return None if inner is None or inner[1].startswith("not ") or inner[1] in ("null", "same") else (inner[0], f"not {inner[1]}", inner[2])
    kind = _KINDS.get(type(f))
    if kind is None or len(f.attribute) != 1 or f.attribute[0] not in HEADERS:
        return None
    value = getattr(f, "value", None)
    if kind in ("is", "above", "from", "below", "to") and not isinstance(value, str):
        return None
    return (f.attribute[0], kind, set(value) if kind == "in" else value)


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        unknown = [c for c in schema.names if c not in SCHEMA.names]
        if unknown:
            raise ValueError(f"no columns of a WARC source: {unknown}")
        self.schema, self.options, self.want = schema, dict(options), Wanted(list(schema.names))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            test = _test(f)
            if test is None:
                yield f
            else:
                self.want.tests.append(test)

    def partitions(self) -> list[InputPartition]:
        limit = int(self.options.get("splitbytes", 64 << 20))
        out, held, size = [], [], 0
        for path, length in sorted(archives(self.options["path"])):
            for start, end, n in _cuts(path, length, limit):
                if held and size + n > limit:
                    out.append(Files(held))
                    held, size = [], 0
                held.append((path, start, end))
                size += n
        return [*out, Files(held)]      # one at least: a scan of nothing is a task of nothing

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        types = [pa.field(f.name, common._arrow_type(f.dataType)) for f in self.schema.fields]
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array([list(v.items()) if isinstance(v, dict) else v for v in c], t.type)
                                               for c, t in zip(cols, types)], [t.name for t in types])

        at = self.schema.names.index("payload") if self.want.block else None
        for path, start, end in partition.value:
            where, name = _open(path)
            with where.open_input_file(name) as handle:
                for row in scan_file(handle, path, start, end, self.want):
                    rows.append(row)
                    size += 256 + (len(row[at] or b"") if at is not None else 0)
                    if size >= 4 << 20:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


def archives(path: str) -> list[tuple[str, int]]:
    """Archive files and their bytes: those of the manifests, where a folder has any, else all it holds."""
    where, name = _open(path)
    prefix = path[:len(path) - len(name)] if path.endswith(name) else ""
    info = where.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(prefix + name, info.size)]
    found = [i for i in where.get_file_info(fs.FileSelector(name, recursive=True)) if i.type == fs.FileType.File]
    manifests = [i.path for i in found if i.base_name.startswith("_manifest")]
    if manifests:
        return [(prefix + f["path"], f["bytes"]) for m in manifests for f in json.loads(where.open_input_stream(m).read())]
    return [(prefix + i.path, i.size) for i in found if i.base_name.endswith((".warc", ".warc.gz"))]


def _cuts(path: str, length: int, limit: int) -> list[tuple[int, int | None, int]]:
    """Ranges of a file of about ``limit`` bytes, at places where its index says that records begin."""
    where, name = _open(path)
    if length <= limit or where.get_file_info(name + ".idx").type != fs.FileType.File:
        return [(0, None, length)]
    marks, out, start = json.loads(where.open_input_stream(name + ".idx").read()), [], 0
    for m in marks:
        if m - start >= limit:
            out.append((start, m, m - start))
            start = m
    return [*out, (start, None, length - start)]


# -- writing ---------------------------------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


def safe_value(value: str) -> str:
    """A header value on one line: control characters as the percent signs of their bytes."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record(row: dict) -> bytes:
    """The bytes of a record; a payload of null is left out, as revisits do."""
    revisit = row.get("record_type") == "revisit"
    payload = row.get("payload") or b""
    size = row.get("payload_bytes") if row.get("payload_bytes") is not None else len(payload)
    http = (row.get("content_type") or HTTP) == HTTP and row.get("record_type") in ("response", "revisit")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() if http else b""
    block = head if revisit else head + payload
    fields = {name: row.get(c) for c, name in HEADERS.items()}
    fields["Content-Type"] = row.get("content_type") or (HTTP if http else "application/octet-stream")
    if revisit:
        fields["WARC-Profile"] = IDENTICAL
    fields |= dict(row.get("headers") or {})
    lines = [f"{k}: {safe_value(str(v))}" for k, v in fields.items() if v is not None]
    return VERSION + b"\r\n" + "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 4) -> bytes:
    """One member whose extra field says how many bytes it takes, so that a scan can pass over it."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + (12).to_bytes(2, "little") + b"sl" + (8).to_bytes(2, "little")
            + total.to_bytes(8, "little") + body + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little"))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        unknown = [c for c in schema.names if c not in SCHEMA.names]
        if unknown:
            raise ValueError(f"no columns of a WARC source: {unknown}")
        self.names, self.overwrite = schema.names, overwrite
        self.path = options["path"].rstrip("/")
        self.packed = options.get("compression", "gzip") == "gzip"
        self.limit, self.mark = int(options.get("filebytes", 256 << 20)), int(options.get("indexbytes", 4 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, root = _open(self.path)
        where.create_dir(root, recursive=True)
        files, handle, size, marks, name = [], None, 0, [], ""

        def close() -> None:
            nonlocal handle
            if handle is not None:
                handle.close()
                with where.open_output_stream(name + ".idx") as idx:
                    idx.write(json.dumps(marks).encode())
                files.append({"path": name, "bytes": size})
                handle = None

        for batch in iterator:
            for row in batch.to_pylist():
                data = record(row)
                data = gzip_member(data) if self.packed else data
                if handle is None or size + len(data) > self.limit:
                    close()
                    # another try of the task writes files of its own; only the commit's are read
                    name = f"{root}/part-{uuid.uuid4().hex}.warc" + (".gz" if self.packed else "")
                    handle, size, marks = where.open_output_stream(name, compression=None), 0, []
                if size - (marks[-1] if marks else 0) >= self.mark:
                    marks.append(size)
                handle.write(data)
                size += len(data)
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        where, root = _open(self.path)
        where.create_dir(root, recursive=True)
        old = [i.path for i in where.get_file_info(fs.FileSelector(root)) if i.base_name.startswith("_manifest")]
        with where.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())
        for path in old if self.overwrite else []:
            where.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        where, _ = _open(self.path)
        for f in [f for m in messages if m for f in m.files]:
            for path in (f["path"], f["path"] + ".idx"):
                if where.get_file_info(path).type == fs.FileType.File:
                    where.delete_file(path)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``. Options: ``splitBytes`` of a partition; when writing
    ``compression`` (gzip or none), ``fileBytes`` of a file, ``indexBytes`` between index marks.
    A schema of fewer columns reads only those."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(schema, {k.lower(): v for k, v in self.options.items()}, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let filters reach Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, **options) -> DataFrame:
    """Records of the archives under ``path``; ``columns``: those to read, all by default."""
    register(spark)
    schema = T.StructType([SCHEMA[c] for c in columns or SCHEMA.names])
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def write_warc(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    """``df``: columns of the source (any subset, ``payload`` in bytes)."""
    register(df.sparkSession)
    df.write.format("warc").mode(mode).options(**options).save(path)


# -- pages -----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Archive:
    """Payloads of ``min_bytes`` or more are stored once. ``date``: WARC-Date of records without one.
    ``prefix`` of record ids."""

    min_bytes: int = 100
    date: str = "2024-01-01T00:00:00Z"
    prefix: str = "urn:page:"


def _record_id(how: Archive, ident: Column, digest: Column) -> Column:
    """From the page's id and payload, so that a record can be named before it is written."""
    return F.concat(F.lit(f"<{how.prefix}"), F.coalesce(ident.cast("string"), F.lit("none")), F.lit(":"), F.substring(digest, 1, 16), F.lit(">"))


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", how: Archive = Archive()) -> DataFrame:
    """One record per row of ``pages``: a response, or a revisit of the response with equal payload.

    Of rows with equal payloads of ``min_bytes`` or more, those of the smallest id are responses.
    Rows repeated with that id are responses too; null ids never are the smallest unless all are
    null, and then all are responses. Rows of a payload that a large share of the pages has are
    spread over as many tasks as they fill.
    """
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("target_uri"), payload.alias("payload"))
    src = src.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    narrow = src.where(F.col("payload_bytes") >= how.min_bytes)
    # only payloads that occur more than once need a partner
    first = common.stage(narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1 AND first IS NOT NULL"), "warc_first")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1000, pages.count() // parts)
    # fewer than ``parts`` payloads can hold more than a task's share
    hot = {r["digest"]: -(-r["n"] // share) for r in first.where(F.col("n") > share).select("digest", "n").collect()}
    key = F.when(F.col("payload_bytes") >= how.min_bytes, F.col("digest")).alias("key")
    joined = enrich(src.select("*", key), [Dim(first.select(F.col("digest").alias("key"), "first"), "key")], skew=HotKeys(hot))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _record_id(how, F.col("id"), F.col("digest")).alias("record_id"), F.lit(how.date).alias("warc_date"), "target_uri",
        F.when(revisit, _record_id(how, F.col("first"), F.col("digest"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"))


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                how: Archive = Archive(), **options) -> str:
    """Archives of all rows of ``pages`` under ``path``. A null html is an empty payload, a null url leaves
    its header out; control characters of a url are written as percent signs. No rows give no files."""
    write_warc(page_records(pages, id_col, url_col, html_col, how), path, **options)
    return path


def read_pages(spark: SparkSession, path: str, how: Archive = Archive(), id_type: str = "long") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record under ``path``.

    Size and digest of a response are taken from the payload that was read, and a digest other than
    the header's fails; those of a revisit come from its headers, without a payload. Two scans, each
    with the record type pushed down: the second passes over all payloads.
    """
    def page(c: str) -> Column:
        return F.regexp_extract(F.col(c), f"^<{re.escape(how.prefix)}(.*):[0-9a-f]{{16}}>$", 1).try_cast(id_type)

    full = read_warc(spark, path, ["record_type", "record_id", "payload_digest", "payload"]).where(F.col("record_type") == "response")
    full = full.select("record_type", "record_id", "payload_digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha2("payload", 256).alias("found"))
    said = F.substring_index("payload_digest", ":", -1)
    checked = F.when(F.col("found") == said, said).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest: "), "record_id")))
    full = full.select(page("record_id").alias("page_id"), "payload_bytes", checked.alias("payload_digest"), "record_type",
                       F.lit(None).cast(id_type).alias("refers_to"))
    again = read_warc(spark, path, ["record_type", "record_id", "refers_to", "payload_digest", "payload_bytes"])
    again = again.where(F.col("record_type") == "revisit").select(
        page("record_id").alias("page_id"), "payload_bytes", said.alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))
    return full.unionByName(again)


def sql() -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN payload_bytes >= {Archive().min_bytes} AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {Archive().min_bytes} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
