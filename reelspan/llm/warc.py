"""WARC archives as a PySpark data source: `spark.read.format("warc")` and `df.write.format("warc")`.

Reading.  Files are packed into partitions of about `partitionBytes`.  Predicates on the record type and on other headers
are pushed into the scan (on `path` they drop whole files): those given with the load (`where`), and with `pushdown`
Spark's own filters too.  Spark keeps the latter by loaded relation, not by scan, so with them each scan needs a load of its own.  A record's headers are parsed first; a payload is read and
decoded only if the headers pass and the schema has the column `payload`.  Otherwise the scan jumps over it: by
Content-Length in plain files, by the length that a gzip member states of itself (extra field `sl`) where it does, and
by inflating in small pieces, which are dropped, where it does not.  A schema given by `.schema(...)` may name any of
the columns of SCHEMA.

Writing.  One gzip member a record (`sl` set), a file a task, a new one every `rollBytes`.  Tasks write under
_temporary and name their files in commit messages; the driver moves the named files when all tasks are done, so files of
failed or repeated attempts never show.

Paths are those that pyarrow's file systems open (local or shared folders, hdfs, s3, gs).

Defined results.  A null payload is written as an empty one; headers without a value are left out; line ends inside a
header become blanks (in a target URI %0D and %0A).  A null record_id gets a random urn:uuid.  Repeated rows are repeated
records.  An empty table makes files without responses, which read as no rows.  Memory follows the longest record.
Other columns of the written rows are ignored, whatever their names.  A file that is cut off or holds something else is an error
that names its place; with option `corrupt` = `stop` the rest of such a file is left out.
"""

from __future__ import annotations

import base64
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage

from reelspan.llm.common import beside, free_name
from reelspan.sources.predicates import allow_pushdown, as_option, filters_of

SCHEMA = "record_id string, warc_type string, target_uri string, date string, payload_digest string, refers_to string, content_type string, content_length long, http_status int, payload_length long, headers map<string,string>, payload binary, path string, offset long"
#: Columns that are known once the WARC headers are parsed, and those that take the HTTP headers too.
BY_WARC = {"record_id", "warc_type", "target_uri", "date", "payload_digest", "refers_to", "content_type", "content_length"}
BY_HTTP = {"http_status", "payload_length"}
JUDGED = BY_WARC | BY_HTTP | {"path"}
PIECE = 1 << 16


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- bytes of an archive

class Inflated:
    """The bytes of an archive in order, inflated where it is gzipped, with jumps over bytes that nobody wants."""

    def __init__(self, file):
        self.file, self.raw, self.at = file, b"", 0  # at: place in the file of the first byte of raw
        self.gzip = self._peek(2) == b"\x1f\x8b"
        self.ready, self.inflate = bytearray(), None
        self.member, self.states, self.made = 0, None, 0  # begin of the member, its lengths if it states them, bytes inflated of it
        self.inflated = 0  # of the whole file so far

    def _peek(self, n: int) -> bytes:
        while len(self.raw) < n:
            more = self.file.read(PIECE)
            if not more:
                break
            self.raw += more
        return self.raw[:n]

    def _drop(self, n: int) -> None:
        """Moves on by n bytes of the file."""
        if n <= len(self.raw):
            self.raw = self.raw[n:]
        else:
            self.raw = b""
            self.file.seek(self.at + n)
        self.at += n

    def _begin(self) -> bool:
        head = self._peek(12)
        if not head:
            return False
        self.member, self.states, self.made = self.at, None, 0
        if len(head) == 12 and head[3] & 4:
            extra, i = self._peek(12 + head[10] + 256 * head[11])[12:], 0
            while i + 4 <= len(extra):
                size = extra[i + 2] + 256 * extra[i + 3]
                if extra[i : i + 2] == b"sl" and size == 8:
                    self.states = struct.unpack("<II", extra[i + 4 : i + 12])
                i += 4 + size
        if self.ready:  # a record over two members: lengths are of no use
            self.states = None
        self.inflate = zlib.decompressobj(31)
        return True

    def _fill(self, most: int) -> bool:
        """At least one more byte in `ready`, unless the archive ends."""
        before = len(self.ready)
        while len(self.ready) == before:
            if not self.gzip:
                piece = self._peek(1) and self.raw
                self.ready += piece
                self._drop(len(piece))
                return bool(piece)
            if self.inflate is None and not self._begin():
                return False
            given = self._peek(1) and self.raw
            if not given:
                raise ValueError("the archive is cut off inside a gzip member")
            out = self.inflate.decompress(given, most)
            rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self._drop(len(given) - len(rest))
            self.ready += out
            self.made += len(out)
            self.inflated += len(out)
            if self.inflate.eof:
                self.inflate = None
        return True

    def place(self) -> int:
        """Where the next record begins: its member, or its byte in a plain file."""
        if self.gzip:
            return self.member if self.ready or self.inflate else self.at
        return self.at - len(self.ready)

    def line(self, most: int = 1 << 20) -> bytes:
        """Up to and with the next line feed; nothing at the end."""
        seen = 0
        while (end := self.ready.find(b"\n", seen)) < 0:
            seen = len(self.ready)
            if seen > most:
                raise ValueError("a header line has no end")
            if not self._fill(2048):
                end = len(self.ready) - 1
                break
        out = bytes(self.ready[: end + 1])
        del self.ready[: end + 1]
        return out

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._fill(max(PIECE, n - len(self.ready))):
                raise ValueError("the archive is cut off inside a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def skip(self, n: int) -> None:
        """Moves on by n bytes without keeping any; to a stated end of a gzip member without inflating them."""
        if not self.gzip and n > len(self.ready):
            n -= len(self.ready)
            self.ready.clear()
            self._drop(n)
            return
        if self.gzip and self.states and self.states[1] - (self.made - len(self.ready)) == n:
            self.ready.clear()
            self.inflate = None
            self._drop(self.member + self.states[0] - self.at)
            return
        while n:
            if not self.ready and not self._fill(PIECE):
                raise ValueError("the archive is cut off inside a record")
            own = min(n, len(self.ready))
            del self.ready[:own]
            n -= own


# ---------------------------------------------------------------- records

def _headers(lines: Iterator[bytes]) -> dict[str, str]:
    """Names to values; a line that begins with white space goes on with the one before."""
    found: dict[str, str] = {}
    name = None
    for line in lines:
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:
            found[name] += " " + text.strip()
        elif ":" in text:
            name, value = text.split(":", 1)
            name = name.strip()
            found[name] = value.strip()
    return found


def _until_blank(source: Inflated) -> Iterator[bytes]:
    while (line := source.line()).strip():
        yield line
    if not line:
        raise ValueError("the archive is cut off inside headers")


def hex_digest(value: str | None) -> str | None:
    """sha1:BASE32 as bare hex; other digests as they stand."""
    if value and (m := re.fullmatch(r"(?i)sha1:([A-Z2-7]{32})", value)):
        return base64.b32decode(m[1].upper()).hex()
    return value[5:].lower() if value and re.fullmatch(r"(?i)sha1:[0-9a-f]{40}", value) else value


def _number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"[0-9]{1,18}", value) else None


def decoded(body: bytes, http: dict[str, str]) -> bytes:
    """The body without its transfer and content coding; as it stands where that fails."""
    own = {k.lower(): v.lower() for k, v in http.items()}
    try:
        if "chunked" in own.get("transfer-encoding", ""):
            out, at = [], 0
            while True:
                end = body.index(b"\r\n", at)
                size = int(body[at:end].split(b";")[0], 16)
                if not size:
                    break
                out.append(body[end + 2 : end + 2 + size])
                at = end + 4 + size
            body = b"".join(out)
        if own.get("content-encoding") in ("gzip", "x-gzip"):
            body = zlib.decompress(body, 31)
        elif own.get("content-encoding") == "deflate":
            body = zlib.decompress(body)
    except (ValueError, zlib.error):
        pass
    return body


def records(source: Inflated, wanted: list[Filter], payload: bool) -> Iterator[dict]:
    """Records that pass `wanted`, as dicts by column."""
    early = [f for f in wanted if column_of(f) in BY_WARC]
    late = [f for f in wanted if column_of(f) in BY_HTTP]
    while True:
        while source.ready or source._fill(2048):  # blank lines between records
            if source.ready[0] not in b"\r\n":
                break
            del source.ready[0]
        if not source.ready:
            return
        place = source.place()
        if not source.line().startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {place}")
        head = _headers(_until_blank(source))
        low = {k.lower(): v for k, v in head.items()}
        left = _number(low.get("content-length"))
        if left is None:
            raise ValueError(f"a record without Content-Length at {place}")
        row = {"record_id": low.get("warc-record-id"), "warc_type": low.get("warc-type"), "target_uri": low.get("warc-target-uri"), "date": low.get("warc-date"), "payload_digest": hex_digest(low.get("warc-payload-digest")), "refers_to": low.get("warc-refers-to"), "content_type": low.get("content-type"), "content_length": left, "headers": head, "offset": place}
        if not all(passes(f, row) for f in early):
            source.skip(left + 4)
            continue
        http: dict[str, str] = {}
        if (low.get("content-type") or "").startswith("application/http"):
            taken: list[bytes] = []
            size = 0
            while size < left:
                taken.append(source.line())
                size += len(taken[-1])
                if not taken[-1].strip():
                    break
            if size > left:
                raise ValueError(f"HTTP headers are longer than their record at {place}")
            left -= size
            status = re.match(rb"HTTP/[0-9.]+ ([0-9]{3})", taken[0]) if taken else None
            http = _headers(iter(taken[1:]))
            row["http_status"] = int(status[1]) if status else None
            row["payload_length"] = _number({k.lower(): v for k, v in http.items()}.get("content-length"))
        else:
            row["payload_length"] = left
        if not all(passes(f, row) for f in late):
            source.skip(left + 4)
            continue
        if payload:
            row["payload"] = decoded(source.take(left), http)
            source.skip(4)
        else:
            source.skip(left + 4)
        yield row


# ---------------------------------------------------------------- predicates

_TESTS = {
    EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
    In: lambda x, v: x in v, StringStartsWith: lambda x, v: x.startswith(v), StringEndsWith: lambda x, v: x.endswith(v), StringContains: lambda x, v: v in x,
}


def column_of(f: Filter) -> str | None:
    """The column a predicate is about, None where it can't be judged here."""
    if isinstance(f, Not):
        return column_of(f.child)
    known = type(f) in _TESTS or isinstance(f, (IsNull, IsNotNull, EqualNullSafe))
    return f.attribute[0] if known and len(f.attribute) == 1 else None


def truth(f: Filter, row: dict) -> bool | None:
    """True, False or, where a null makes it so, unknown."""
    if isinstance(f, Not):
        own = truth(f.child, row)
        return None if own is None else not own
    x = row.get(f.attribute[0])
    if isinstance(f, (IsNull, IsNotNull)):
        return (x is None) == isinstance(f, IsNull)
    if isinstance(f, EqualNullSafe):
        return x == f.value
    if x is None or f.value is None:
        return None
    return _TESTS[type(f)](x, f.value)


def passes(f: Filter, row: dict) -> bool:
    return truth(f, row) is True


# ---------------------------------------------------------------- the data source

@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.schema, self.path, self.filters = schema, options["path"], filters_of(options.get("where"))
        if bad := [f for f in self.filters if column_of(f) not in JUDGED]:
            raise ValueError(f"the scan can't judge {bad}")
        self.bytes, self.corrupt = int(options.get("partitionbytes", 64 << 20)), options.get("corrupt", "fail")

    def partitions(self) -> list[Files]:
        store, top = _open(self.path)
        info = store.get_file_info(top)
        if info.type == fs.FileType.NotFound:
            raise ValueError(f"no such archive or folder: {self.path}")
        found = [info] if info.is_file else [x for x in store.get_file_info(fs.FileSelector(top, recursive=True)) if x.is_file and re.search(r"\.warc(\.gz)?$", x.path) and not re.search(r"/[_.]", x.path[len(top) :])]
        packs: list[Files] = []
        size = 0
        for x in sorted(found, key=lambda x: x.path):
            if not all(passes(f, {"path": x.path}) for f in self.filters if column_of(f) == "path"):
                continue
            if not packs or size + x.size > self.bytes:
                packs.append(Files([]))
                size = 0
            packs[-1].paths.append(x.path)
            size += x.size
        return packs or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        store, _ = _open(self.path)
        columns = [c.name for c in self.schema]
        kinds, rows, held = to_arrow_schema(self.schema), [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([list(v.items()) if isinstance(v := r.get(c), dict) else v for r in rows], kinds.field(c).type) for c in columns], columns)

        wanted = [f for f in self.filters if column_of(f) != "path"]
        for path in partition.paths:
            with store.open_input_file(path) as file:
                try:
                    for row in records(Inflated(file), wanted, "payload" in columns):
                        rows.append(row | {"path": path})
                        held += 1000 + len(row.get("payload") or b"")
                        if held > 8 << 20:
                            yield batch()
                            rows, held = [], 0
                except (ValueError, zlib.error) as e:
                    if self.corrupt != "stop":
                        raise ValueError(f"{path}: {e}") from e
        if rows:
            yield batch()


class PushedWarcReader(WarcReader):
    """Takes Spark's own filters too."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if column_of(f) in JUDGED:
                self.filters.append(f)
            else:
                yield f


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


def _member(data: bytes, level: int) -> bytes:
    """A gzip member that states its own lengths."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 24 + len(body) + 8
    if max(size, len(data)) >= 1 << 32:  # too long to be stated
        return struct.pack("<4BIBB", 31, 139, 8, 0, 0, 0, 255) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return struct.pack("<4BIBBH2sHII", 31, 139, 8, 4, 0, 0, 255, 12, b"sl", 8, size, len(data)) + body + struct.pack("<II", zlib.crc32(data), len(data))


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {re.sub(r'[\r\n]+', ' ', str(v))}\r\n" for k, v in headers if v is not None]
    return b"".join([b"WARC/1.1\r\n", "".join(lines).encode("utf-8", "replace"), b"Content-Length: %d\r\n\r\n" % len(block), block, b"\r\n\r\n"])


def record_of(row: dict, now: str) -> bytes:
    """One record: an HTTP response or a revisit of one (headers only), or a block of another type."""
    kind, payload = row.get("warc_type") or "response", row.get("payload") or b""
    uri = row.get("target_uri")
    digest = row.get("payload_digest")
    if digest and re.fullmatch(r"[0-9a-f]{40}", digest):
        digest = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    http = kind in ("response", "revisit")
    block = payload
    if http:
        size = row.get("payload_length")
        size = len(payload) if size is None or kind == "response" else size
        block = f"HTTP/1.1 {row.get('http_status') or 200} OK\r\nContent-Type: {row.get('content_type') or 'text/html; charset=utf-8'}\r\nContent-Length: {size}\r\n\r\n".encode() + (payload if kind == "response" else b"")
    return _record(
        [
            ("WARC-Type", kind), ("WARC-Record-ID", row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", row.get("date") or now), ("WARC-Target-URI", uri and uri.replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Payload-Digest", digest),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None), ("WARC-Refers-To", row.get("refers_to")), ("Content-Type", "application/http; msgtype=response" if http else row.get("content_type") or "application/octet-stream"),
        ],
        block,
    )


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.roll, self.level = int(options.get("rollbytes", 256 << 20)), int(options.get("level", 6))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, top = _open(self.path)
        store.create_dir(f"{top}/_temporary/{self.job}", recursive=True)
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        names, out, size = [], None, 0
        known = {"record_id", "warc_type", "target_uri", "date", "payload_digest", "refers_to", "content_type", "http_status", "payload_length", "payload"}
        for b in iterator:
            columns = {c: b.column(i) for i, c in enumerate(b.schema.names) if c in known}
            for i in range(b.num_rows):
                if out is None:
                    names.append(f"part-{len(names):05d}-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{top}/_temporary/{self.job}/{names[-1]}", compression=None), 0
                    out.write(_member(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", now), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"), self.level))
                data = _member(record_of({c: v[i].as_py() for c, v in columns.items()}, now), self.level)
                out.write(data)
                size += len(data)
                if size >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, top = _open(self.path)
        if self.overwrite:
            for x in store.get_file_info(fs.FileSelector(top, allow_not_found=True)):
                if re.search(r"\.warc(\.gz)?$", x.path):
                    store.delete_file(x.path)
        for m in messages:
            for name in m.names if m else ():
                store.move(f"{top}/_temporary/{self.job}/{name}", f"{top}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, top = _open(self.path)
        store.create_dir(top, recursive=True)
        if store.get_file_info(f"{top}/_temporary/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{top}/_temporary/{self.job}")
        if not store.get_file_info(fs.FileSelector(f"{top}/_temporary", allow_not_found=True)) and store.get_file_info(f"{top}/_temporary").type != fs.FileType.NotFound:
            store.delete_dir(f"{top}/_temporary")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        options = {k.lower(): v for k, v in self.options.items()}
        return (PushedWarcReader if options.get("pushdown") == "true" else WarcReader)(schema, options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def read(spark: SparkSession, path: str, columns: str | None = None, where: list[tuple] | None = None, pushdown: bool = False, **options) -> DataFrame:
    """Records under path that satisfy `where`; without `payload` among `columns` no payload is decoded."""
    spark.dataSource.register(WarcSource)
    if pushdown:
        allow_pushdown(spark)
    source = spark.read.format("warc").options(where=as_option(where or []), pushdown=pushdown, **options)
    return (source.schema(columns) if columns else source).load(path)


def write(rows: DataFrame, path: str, mode: str = "append", **options) -> None:
    """rows(record_id, warc_type, target_uri, date, payload_digest, refers_to, payload_length, payload; any may be missing) as archives under path."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.write.format("warc").options(**options).mode(mode).save(path)


# ---------------------------------------------------------------- revisits

def _hash(payload: str) -> Column:
    return F.sha2(F.col(f"`{payload}`"), 256)


def with_revisits(rows: DataFrame, key: str, payload: str, least: int = 1000) -> DataFrame:
    """rows with warc_type and original: of equal payloads of at least `least` bytes, all but those of the greatest key revisit that key.

    A null key comes before all others; payloads whose keys are all null, and shorter ones, are responses.  Rows that share the
    greatest key and a payload are all responses.  Groups are found by SHA-256 with the greatest key aggregated before the
    shuffle, so a payload that a third of the rows share is one small row of the table that is joined back.
    """
    name = free_name(rows, "sha256")
    known = rows.withColumn(name, F.when(F.octet_length(F.col(f"`{payload}`")) >= least, _hash(payload)))
    groups = known.select(name, F.col(f"`{key}`").alias("original")).filter(f"{name} is not null").groupBy(name).agg(F.max("original").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1 and original is not null").drop("n")
    again = F.col("original").isNotNull() & (F.col(f"`{key}`").isNull() | (F.col(f"`{key}`") < F.col("original")))
    joined = beside(known.drop("warc_type", "original"), groups, name, how="left").drop(name)
    return joined.withColumn("warc_type", F.when(again, "revisit").otherwise("response")).withColumn("original", F.when(again, F.col("original")))


def archive_pages(pages: DataFrame, path: str) -> None:
    """pages(page_id, url, html) as archives under path; equal pages are written once and revisited."""
    own = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = with_revisits(own, "page_id", "payload")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    write(
        rows.select(
            urn("page_id").alias("record_id"), "warc_type", F.col("url").alias("target_uri"), F.sha1("payload").alias("payload_digest"), urn("original").alias("refers_to"),
            F.octet_length("payload").cast("long").alias("payload_length"), F.when(F.col("warc_type") == "response", F.col("payload")).alias("payload"),
        ), path,
    )


def pages_of(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of archived pages.

    Length and digest of a response are taken from its payload as read, those of a revisit from its headers: that scan decodes no payload.
    """
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    full = read(spark, path, "record_id string, warc_type string, payload binary", where=[("warc_type", "=", "response")])
    full = full.select(number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), F.col("warc_type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    again = read(spark, path, "record_id string, warc_type string, payload_digest string, payload_length long, refers_to string", where=[("warc_type", "=", "revisit")])
    return full.unionByName(again.select(number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to")))
