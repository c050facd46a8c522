"""WARC files as a Spark data source: a reader that parses headers first, and a writer.

``spark.read.format("warc").load(folder)`` lists the archives once on the driver and groups
them into partitions by size. Filters on header columns reach the reader; a record that
fails one is stepped over by its length, so its block is neither read nor decoded.
``df.write.format("warc").mode("append").save(folder)`` writes one archive per task and then
a manifest; files of failed or repeated attempts are not in it and are never read.

A large plain archive is cut into parts that tasks read side by side. A part takes the records that begin in it; where the first
one begins is found from the bytes, and the task before, which comes there record by record, checks it.

Paths may be anything that :mod:`pyarrow.fs` opens (``file:``, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
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
from pyspark.sql.types import StructType

SCHEMA = """record_type string, record_id string, target_uri string, warc_date string, page_id long,
refers_to string, payload_digest string, payload_length long, payload binary"""
COLUMNS = [part.split()[0] for part in SCHEMA.split(",")]
MANIFEST = "_manifest.json"
LARGEST_HEADER = 1 << 20
_LINE_END = b"\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")

# Header field of the file -> column.
_FIELDS = {
    "warc-type": "record_type",
    "warc-record-id": "record_id",
    "warc-target-uri": "target_uri",
    "warc-date": "warc_date",
    "warc-refers-to": "refers_to",
    "warc-payload-digest": "payload_digest",
    "x-page-id": "page_id",
    "x-payload-length": "payload_length",
}


# -- records ------------------------------------------------------------------


def page_record_id(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def encode_record(fields: dict[str, str | None], block: bytes, compress: bool) -> bytes:
    """One record. Compressed, it is a gzip member whose extra field holds the member's
    length, so that a reader can step over it without inflating it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode("utf-8", "replace") + _LINE_END * 2 + block + _LINE_END * 2
    if not compress:
        return raw
    deflate = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(raw) + deflate.flush()
    size = 10 + 2 + 8 + len(body) + 8  # header, extra length, extra field, body, trailer
    extra = b"sl" + (4).to_bytes(2, "little") + size.to_bytes(4, "little")
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + len(extra).to_bytes(2, "little") + extra
    return head + body + zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little")


def parse_fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a field that begins with a space goes on the line before."""
    fields: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


def _whole_number(text: str | None) -> int | None:
    """The number, if it is one that a long holds."""
    number = int(text) if text is not None and re.fullmatch(r"-?\d{1,19}", text) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def header_row(fields: dict[str, str]) -> dict:
    """The header columns of a record; the payload's length is that of the block if no field says it."""
    row = {column: fields.get(field) for field, column in _FIELDS.items()}
    row["page_id"] = _whole_number(row["page_id"])
    row["payload_length"] = _whole_number(row["payload_length"])
    digest = row["payload_digest"]
    row["payload_digest"] = digest.split(":", 1)[1] if digest and ":" in digest else digest
    return row


def payload_of(block: bytes, content_type: str) -> bytes:
    """The body of an HTTP message, or the whole block of any other record."""
    if not content_type.startswith("application/http"):
        return block
    _, found, body = block.partition(_LINE_END * 2)
    return body if found else b""


class _Source:
    """Bytes of one file from ``at`` on, read in steps, with a way to step ahead."""

    def __init__(self, file: pa.NativeFile, size: int, at: int = 0) -> None:
        self.file, self.size, self.at, self.buffer = file, size, at, b""
        if at:
            file.seek(at)

    def fill(self, n: int, step: int = 1 << 16) -> bytes:
        """At least ``n`` bytes from here on if the file has them; none is consumed."""
        while len(self.buffer) < n:
            more = self.file.read(max(step, n - len(self.buffer)))
            if not more:
                break
            self.buffer += more
        return self.buffer

    def find(self, mark: bytes, limit: int) -> int:
        """Where ``mark`` begins from here, or -1 if not within ``limit`` bytes."""
        n = 512
        while True:
            at = self.fill(n).find(mark)
            if at >= 0 or len(self.buffer) < n or n > limit:
                return at
            n *= 4

    def take(self, n: int) -> bytes:
        out, self.buffer = self.fill(n)[:n], self.buffer[n:]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        self.at = min(self.at + n, self.size)
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
        else:
            self.buffer = b""
            self.file.seek(self.at)


def _block_length(fields: dict[str, str], at: int) -> int:
    """The length of a record's block, without which nothing after it can be found."""
    length = _whole_number(fields.get("content-length"))
    if length is None or length < 0:
        raise ValueError(f"the record at byte {at} does not say how long it is")
    return length


def plain_records(
    source: _Source, wanted: Callable[[dict], bool], bodies: bool = True, stop: int | None = None
) -> Iterator[tuple[dict, bytes | None]]:
    """(header columns, payload) of the wanted records that begin before ``stop``; blocks of the others, and
    all blocks without ``bodies``, are skipped."""
    while True:
        while source.fill(2)[:2] == _LINE_END:
            source.take(2)
        if not source.fill(1) or (stop is not None and source.at >= stop):
            return
        end = source.find(_LINE_END * 2, LARGEST_HEADER)
        if end < 0 or not source.buffer.startswith(b"WARC/"):
            raise ValueError(f"no WARC header at byte {source.at}")
        start = source.at
        fields = parse_fields(source.take(end + 4)[:end])
        length = _block_length(fields, start)
        row = header_row(fields)
        if source.at + length > source.size:
            raise ValueError(f"the record at byte {start} is cut off")
        passes = wanted(row)
        if passes and bodies:
            yield row, payload_of(source.take(length), fields.get("content-type", ""))
        else:
            source.skip(length)
            if passes:
                yield row, None


def first_record(source: _Source) -> int:
    """Where the first record begins that lies wholly behind the bytes before ``source``, which begins four bytes
    before the place looked at; the end of the file if there is none.

    A record follows an empty line, names its type and length, and ends at another record or at the end of the file.
    """
    mark = _LINE_END * 2 + b"WARC/"
    while True:
        found = source.fill(1 << 16).find(mark)
        if found < 0:
            if len(source.buffer) < 1 << 16:
                return source.size
            source.take(len(source.buffer) - len(mark) + 1)
            continue
        source.take(found + 4)
        end = source.find(_LINE_END * 2, LARGEST_HEADER)
        fields = parse_fields(source.buffer[: max(end, 0)])
        length = _whole_number(fields.get("content-length"))
        if end < 0 or length is None or length < 0 or "warc-type" not in fields:
            continue
        after = source.at + end + 4 + length
        if after + 4 > source.size:
            continue
        here = source.file.tell()
        source.file.seek(after)
        behind = source.file.read(64)
        source.file.seek(here)
        if behind.startswith(_LINE_END * 2) and (not behind.strip() or behind.lstrip(_LINE_END).startswith(b"WARC/")):
            return source.at


def gzip_records(source: _Source, wanted: Callable[[dict], bool], bodies: bool = True) -> Iterator[tuple[dict, bytes | None]]:
    """As :func:`plain_records`, for one gzip member per record. Of a record whose block is not read only
    the header is inflated; without a length field in the member it is inflated and dropped."""
    while source.fill(12)[:2] == b"\x1f\x8b":
        head, start, member = source.buffer, source.at, None
        if head[3] & 4:
            extra = source.fill(12 + int.from_bytes(head[10:12], "little"))[12 : 12 + int.from_bytes(head[10:12], "little")]
            while len(extra) >= 4:
                n = int.from_bytes(extra[2:4], "little")
                if extra[:2] == b"sl" and n == 4:
                    member = int.from_bytes(extra[4:8], "little")
                extra = extra[4 + n :]
        inflate, raw = zlib.decompressobj(zlib.MAX_WBITS | 16), b""

        def pump(piece: int) -> bytes:
            """Inflate the next ``piece`` bytes of the file."""
            compressed = source.take(min(piece, len(source.fill(1))))
            out = inflate.decompress(compressed)
            if inflate.unused_data:  # belongs to the next member
                source.buffer = inflate.unused_data + source.buffer
                source.at -= len(inflate.unused_data)
            return out

        while (end := raw.find(_LINE_END * 2)) < 0:
            if inflate.eof or not source.fill(1) or len(raw) > LARGEST_HEADER:
                raise ValueError(f"no WARC header in the member at byte {start}")
            raw += pump(512)
        fields = parse_fields(raw[:end])
        length = _block_length(fields, start)
        row = header_row(fields)
        passes = wanted(row)
        if passes and not bodies:
            yield row, None
        if passes and bodies:
            parts, got = [raw], len(raw)
            while not inflate.eof and source.fill(1):
                parts.append(pump(1 << 16))
                got += len(parts[-1])
            if got < end + 4 + length:
                raise ValueError(f"the member at byte {start} is cut off")
            yield row, payload_of(b"".join(parts)[end + 4 : end + 4 + length], fields.get("content-type", ""))
        elif member and not inflate.eof:
            source.skip(start + member - source.at)
        else:
            while not inflate.eof and source.fill(1):
                pump(1 << 16)


# -- reader -------------------------------------------------------------------


@dataclass
class ArchiveGroup(InputPartition):
    files: list[tuple[str, int]]

    def __init__(self, files: list[tuple[str, int]]) -> None:
        super().__init__(0)
        self.files = files


@dataclass
class ArchivePart(InputPartition):
    """The records of a plain archive that begin in a range of its bytes."""

    path: str
    size: int
    start: int
    end: int

    def __init__(self, path: str, size: int, start: int, end: int) -> None:
        super().__init__(0)
        self.path, self.size, self.start, self.end = path, size, start, end


def parts_of(path: str, size: int, target: int) -> list[ArchivePart]:
    """A file in even parts of about ``target`` bytes."""
    number = -(-size // target)
    borders = [size * i // number for i in range(number + 1)]
    return [ArchivePart(path, size, a, b) for a, b in zip(borders, borders[1:])]


def group_files(files: list[tuple[str, int]], target: int) -> list[list[tuple[str, int]]]:
    """Files, in order of their name, in groups of at most ``target`` bytes or of one file."""
    groups: list[list[tuple[str, int]]] = []
    room = 0
    for path, size in sorted(files):
        if not groups or size > room:
            groups.append([])
            room = target
        groups[-1].append((path, size))
        room -= size
    return groups


_COMPARE: dict[type, Callable] = {
    EqualTo: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    In: lambda a, b: a in b,
    StringStartsWith: lambda a, b: a.startswith(b),
    StringEndsWith: lambda a, b: a.endswith(b),
    StringContains: lambda a, b: b in a,
}


def header_test(condition: Filter) -> Callable[[dict], bool | None] | None:
    """The filter as a test of header columns (None: unknown, as in SQL), or None if it isn't one."""
    if isinstance(condition, Not):
        inner = header_test(condition.child)
        return inner and (lambda row: None if (x := inner(row)) is None else not x)
    column = condition.attribute[0] if len(getattr(condition, "attribute", ())) == 1 else None
    if column not in COLUMNS or column == "payload":
        return None
    if isinstance(condition, IsNull):
        return lambda row: row[column] is None
    if isinstance(condition, IsNotNull):
        return lambda row: row[column] is not None
    if isinstance(condition, EqualNullSafe):
        return lambda row: row[column] == condition.value
    compare = _COMPARE.get(type(condition))
    if compare is None:
        return None
    value = condition.value
    return lambda row: None if row[column] is None else compare(row[column], value)


class WarcReader(DataSourceReader):
    """Option ``split``: bytes of archives per partition (32 MB). Option ``cut``: plain archives of more bytes (256 MB)
    are read in parts; "0" reads all archives whole, which an archive needs whose records hold archives, or lack the empty line
    between them, where that makes a part begin at a wrong place: such a read fails and says so. Option ``payload``: "false"
    leaves the payload NULL and skips every block."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.split = int(options.get("split", 32 << 20))
        self.cut = int(options.get("cut", 256 << 20))
        self.payload = options.get("payload", "true").lower() != "false"
        self.tests: list[Callable[[dict], bool | None]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for condition in filters:
            test = header_test(condition)
            if test:
                self.tests.append(test)
            else:
                yield condition

    def partitions(self) -> list[InputPartition]:
        files = list_archives(self.path)
        large = sorted(f for f in files if self.cut and f[1] > self.cut and f[0].endswith(".warc"))
        parts = [part for path, size in large for part in parts_of(path, size, self.split)]
        return [*parts, *map(ArchiveGroup, group_files([f for f in files if f not in set(large)], self.split))]

    def read(self, partition: ArchiveGroup | ArchivePart | None) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(c, pa.int64() if c in ("page_id", "payload_length") else pa.binary() if c == "payload" else pa.string()) for c in COLUMNS]
        )
        rows, held = [], 0
        system, _ = fs.FileSystem.from_uri(self.path)
        records = self._part(system, partition) if isinstance(partition, ArchivePart) else self._whole(system, partition.files if partition else [])
        for row, payload in records:
            row["payload"] = None if row["record_type"] == "revisit" else payload
            rows.append(row)
            held += 500 + len(row["payload"] or b"")
            if held > 8 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _wanted(self, row: dict) -> bool:
        return all(test(row) for test in self.tests)

    def _whole(self, system: fs.FileSystem, files: list[tuple[str, int]]) -> Iterator[tuple[dict, bytes | None]]:
        for path, size in files:
            with system.open_input_file(path) as file:
                records = gzip_records if path.endswith(".gz") else plain_records
                yield from records(_Source(file, size), self._wanted, self.payload)

    def _part(self, system: fs.FileSystem, part: ArchivePart) -> Iterator[tuple[dict, bytes | None]]:
        """The records of the part. Each task goes on to the first record of the next part and compares the place with the one that
        the next task finds; as the first part begins with a record, all parts then begin and end where they should."""
        with system.open_input_file(part.path) as file:
            start = first_record(_Source(file, part.size, max(part.start - 4, 0))) if part.start else 0
            next_start = first_record(_Source(file, part.size, max(part.end - 4, 0))) if part.end < part.size else part.size
            if start >= part.end:  # the record before goes on to the next part or beyond
                return
            file.seek(start)
            source = _Source(file, part.size, start)
            yield from plain_records(source, self._wanted, self.payload, part.end)
            if source.at != next_start:
                raise ValueError(f"{part.path}: cut at byte {next_start}, which is no border of records; read with option cut = 0")


def list_archives(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the archives that the manifests name, or of all ``.warc`` files if there is none."""
    system, root = fs.FileSystem.from_uri(path)
    files = [f for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file]
    manifests = [f for f in files if f.base_name.endswith(MANIFEST)]
    named: set[str] = set()
    for manifest in manifests:
        with system.open_input_file(manifest.path) as file:
            named.update(json.loads(file.read()))
    archives = [f for f in files if f.base_name.endswith((".warc", ".warc.gz"))]
    return [(f.path, f.size) for f in archives if not manifests or f.base_name in named]


# -- writer -------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Writes rows with the columns of the source. Option ``compress``: "true" for one gzip member
    per record; ``date``: WARC-Date of records that have none; ``roll``: bytes after which a
    task goes on in a new file (64 MB)."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.compress = options.get("compress", "false").lower() == "true"
        self.roll = int(options.get("roll", 64 << 20))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        system, root = fs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        context = TaskContext.get()
        task = f"{self.run}-{context.partitionId():06d}-{context.taskAttemptId()}"
        names: list[str] = []
        out, written, n = None, 0, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or written >= self.roll:
                        if out is not None:
                            out.close()
                        names.append(f"part-{task}-{len(names):04d}.warc{'.gz' if self.compress else ''}")
                        out, written = system.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    written += out.write(self.record(row, f"{task}-{n}"))
                    n += 1
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def record(self, row: dict, name: str) -> bytes:
        kind, payload = row["record_type"] or "response", row["payload"] or b""
        uri = row["target_uri"]
        fields = {
            "WARC-Type": kind,
            "WARC-Record-ID": row["record_id"] or f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
            "WARC-Date": row["warc_date"] or self.date,
            "WARC-Target-URI": uri and _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", uri),
            "WARC-Payload-Digest": row["payload_digest"] and f"sha256:{row['payload_digest']}",
            "X-Page-Id": None if row["page_id"] is None else str(row["page_id"]),
            "X-Payload-Length": None if row["payload_length"] is None else str(row["payload_length"]),
            "Content-Type": "application/http; msgtype=response",
        }
        if kind == "revisit":
            fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            fields["WARC-Refers-To"] = row["refers_to"]
            payload = b""
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        http += f"Content-Length: {row['payload_length'] or len(payload)}\r\n\r\n".encode()
        return encode_record(fields, http + payload, self.compress)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{self.run}{MANIFEST}") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of a failed job are in no manifest; they are removed as far as they are known."""
        system, root = fs.FileSystem.from_uri(self.path)
        for name in [f for m in messages if m for f in m.files]:
            system.delete_file(f"{root}/{name}")


class Warc(DataSource):
    """The format ``warc``; see the module."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# -- pages --------------------------------------------------------------------


def page_records(pages: DataFrame, stored: Callable[[DataFrame], DataFrame], least: int = 100) -> DataFrame:
    """Rows for the writer, one per page: payload, digest, and whether it revisits another page.

    Of pages with equal payloads of at least ``least`` bytes the one with the smallest
    ``page_id`` is the response, and so is every row that repeats that id; the others revisit
    it. A NULL id never becomes the response of others: such a page revisits a page with an
    id, or is a response if no copy has one. A NULL ``html`` is an empty payload, a NULL
    ``url`` gives no target. ``stored`` keeps the list of payloads that occur more than once,
    which planning then knows the size of; without repetitions no payload is shuffled.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id",
        F.col("url").alias("target_uri"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_length"),
    )
    repeated = stored(
        rows.where(F.col("payload_length") >= least)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .drop("n")
    )
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = F.concat(F.lit("<urn:x-page:"), F.col("page_id").cast("string"), F.lit(">"))
    refers = F.concat(F.lit("<urn:x-page:"), F.col("first").cast("string"), F.lit(">"))
    return rows.join(repeated, rows["payload_digest"] == repeated["digest"], "left").select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        urn.alias("record_id"),
        "target_uri",
        F.lit(None).cast("string").alias("warc_date"),
        F.col("page_id").cast("long"),
        F.when(revisits, refers).alias("refers_to"),
        "payload_digest",
        "payload_length",
        F.when(~revisits, F.col("payload")).alias("payload"),
    )


def referred_page(refers_to: Column) -> Column:
    return F.regexp_extract(refers_to, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
