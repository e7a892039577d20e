"""WARC archives with a two-level capture index.

Writing: a payload that several rows share (by its SHA-256) belongs to the row with the smallest id; the others become revisit records
without a payload. Each task writes compressed records, one gzip member each, to archives of bounded size with names
of its own, and hands on where each record lies. Only what a finished task handed on is in the index, so archives that
a lost or repeated task left are never read.

Index: captures are sorted by a key with the host reversed (``com,example)/path``) and cut into compressed blocks, a
gzip member each in block files. A sparse directory has the first key and the place of each block. A look-up searches
the directory, reads the one or few blocks that can hold its key as byte ranges, and searches in them. What it finds
are places of records, which are read as byte ranges, too.

Archives and blocks are opened by ``pyarrow.fs`` in the tasks, so the shared folder must be on a file system that it
knows (a mounted folder, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import importable, whole_text
from tripmill.scratch import new_folder, stage

# Bytes after which a task goes on with another archive.
ARCHIVE_BYTES = 256 << 20
# Captures in a block, unless the directory would then have more entries than MAX_BLOCKS.
BLOCK_CAPTURES = 3000
MAX_BLOCKS = 200_000
# Longer keys are cut, and end in their digest instead. So an entry of the directory has a bounded size.
KEY_CHARACTERS = 300
# Records that lie next to each other are read together up to this size.
_READ_BYTES = 4 << 20

# Names of the format and of the profile for records with a payload stored elsewhere.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CAPTURE = (
    "page_id long, url string, key string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, archive string, offset long, length long"
)
_PLACE = "key string, archive string, offset long, length long"
_BLOCK = "first_key string, last_key string, captures int, file string, offset long, length long"
_RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class CaptureIndex:
    """The folder of the directory (Parquet, one row for each block), and the number of its entries."""

    directory: str
    blocks: int


def capture_key(url: Column) -> Column:
    """The host reversed and in lower case, then port, path and query: ``com,example,www:8080)/path?query``.

    NULL gives the empty key. Text without a scheme is taken as a host and a path.
    """
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    place = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    after = F.substring(rest, F.length(place) + 1, F.length(rest))
    place = F.lower(F.regexp_replace(place, r"^.*@", ""))
    host, port = F.regexp_extract(place, r"^([^:]*)", 1), F.regexp_extract(place, r"(:.*)$", 1)
    whole = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), after)
    cut = F.concat(F.substring(whole, 1, KEY_CHARACTERS), F.lit("#"), F.sha2(whole, 256))
    key = F.when(F.length(whole) > KEY_CHARACTERS, cut).otherwise(whole)
    return F.when(url.isNull(), F.lit("")).otherwise(key)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of ``payload``: 32 characters, five bytes at a time."""
    digest = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(digest, first, 10), 16, 32), 8, "0") for first in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# ---- records


def _header(fields: Iterable[tuple[str, object]], first: str) -> bytes:
    lines = [first, *(f"{name}: {value}" for name, value in fields if value is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes | None, refers_to: int | None, size: int, digest: str, date: str) -> bytes:
    """One record: a response, or a revisit if ``payload`` is None. ``size`` and ``digest`` are of the full payload.

    A URL goes into its header line as JSON text, if it holds what would break the line or be lost at its ends.
    """
    http = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", size)], "HTTP/1.1 200 OK")
    body = http + (payload or b"")
    plain = url is not None and url.isprintable() and url == url.strip() and not url.startswith('"')
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url if plain or url is None else json.dumps(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", _PROFILE if payload is None else None),
        ("X-Page-Id", page_id),
        ("X-Refers-To-Page-Id", refers_to),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(body)),
    ]
    return _header(fields, _VERSION) + body + b"\r\n\r\n"


def _parsed_header(text: bytes, first: str) -> dict[str, str]:
    lines = text.decode().split("\r\n")
    if not lines[0].startswith(first):
        raise ValueError(f"no {first} header: {lines[0][:80]!r}")
    return dict(line.split(": ", 1) for line in lines[1:])


def parse_record(data: bytes) -> tuple:
    """Page id, URL, bytes and digest of the full payload, type, the id it refers to, and the payload if it is there.

    The payload of a response must have the length and the digest that its headers say.
    """
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = _parsed_header(head, "WARC/")
    body = rest[: int(fields["Content-Length"])]
    http, payload = body.split(b"\r\n\r\n", 1)
    size = int(_parsed_header(http, "HTTP/")["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what its headers say")
    url = fields.get("WARC-Target-URI")
    number = [int(fields[name]) if name in fields else None for name in ("X-Page-Id", "X-Refers-To-Page-Id")]
    return (
        number[0],
        json.loads(url) if url is not None and url.startswith('"') else url,
        size,
        digest,
        kind,
        number[1],
        payload if kind == "response" else None,
    )


def _member(data: bytes) -> bytes:
    """``data`` as one gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _unpacked(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


# ---- files


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path on it, for a URI or a plain path."""
    if path.startswith("file:"):
        # Hadoop writes file:/path, which is no URI to everyone.
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Out:
    """Files of one task below a folder: appended to, and changed for a new one beyond a size."""

    def __init__(self, folder: str, suffix: str, most: int) -> None:
        self.folder, self.suffix, self.most = folder, suffix, most
        self.stream, self.path, self.offset = None, "", 0

    def append(self, data: bytes) -> tuple[str, int, int]:
        if self.stream is not None and self.offset >= self.most:
            self.close()
        if self.stream is None:
            self.path, self.offset = f"{self.folder}/{uuid.uuid4().hex}{self.suffix}", 0
            system, place = _opened(self.path)
            if isinstance(system, fs.LocalFileSystem):
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
            self.stream = system.open_output_stream(place, compression=None)
        self.stream.write(data)
        place = (self.path, self.offset, len(data))
        self.offset += len(data)
        return place

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def _ranges(places: Iterable[tuple]) -> Iterator[tuple[tuple, bytes]]:
    """For (file, offset, length, ...) in order: each with its bytes. Neighbours are read together."""
    path, source, run = None, None, []

    def read() -> Iterator[tuple[tuple, bytes]]:
        if run:
            source.seek(run[0][1])
            data = source.read(run[-1][1] + run[-1][2] - run[0][1])
            for place in run:
                first = place[1] - run[0][1]
                yield place, data[first : first + place[2]]
            run.clear()

    try:
        for place in places:
            follows = run and place[0] == path and run[-1][1] <= place[1] <= run[-1][1] + run[-1][2]
            if not follows or place[1] + place[2] - run[0][1] > _READ_BYTES:
                yield from read()
            if place[0] != path:
                if source is not None:
                    source.close()
                path = place[0]
                system, inside = _opened(path)
                source = system.open_input_file(inside)
            run.append(place)
        yield from read()
    finally:
        if source is not None:
            source.close()


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int] = lambda row: 1, most: int = 10_000) -> Batches:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([pa.field(name, _ARROW[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _rows(batches: Batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


# ---- writing


def _with_originals(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """Id, URL, payload (NULL for a revisit), its size and digest, and the id a revisit refers to."""
    payload = F.encode(whole_text(html_col), "UTF-8")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
        # Two texts with one SHA-1 can be made on purpose, so it does not decide what is equal.
        F.unhex(F.sha2(payload, 256)).alias("same"),
    )
    shared = (
        rows.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("same")
        .agg(F.min("page_id").alias("original"), F.count("*").alias("copies"))
        .filter("copies > 1 AND original IS NOT NULL")
        .select(F.col("same").alias("shared_same"), "original")
    )
    shared = stage(shared, new_folder(pages.sparkSession, "shared-payloads"))
    # An inner or left join, whose hot keys adaptive execution splits. Spark broadcasts by the staged size.
    joined = rows.join(shared, (F.col("same") == F.col("shared_same")) & (F.col("payload_bytes") >= least_bytes), "left")
    revisits = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.select(
        "page_id",
        "url",
        capture_key(F.col("url")).alias("key"),
        F.when(~revisits, F.col("payload")).alias("payload"),
        F.when(revisits, F.col("original")).alias("refers_to"),
        "payload_bytes",
        "payload_digest",
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    *,
    least_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record for each row of ``pages`` to archives below ``folder``; return a row for each: its capture.

    The payload is the HTML in UTF-8; NULL counts as empty. Of rows with equal payloads of at least ``least_bytes``,
    those with the smallest id are responses and the others revisits of that id; smaller payloads are all responses.
    Rows that repeat the smallest id are all responses. A NULL id counts as larger than any; if no row of equal
    payloads has an id, all are responses. A NULL URL is left out of its record. An empty table writes no archive.
    Other columns are ignored, whatever their names.
    """
    importable(pages.sparkSession)

    def run(batches: Batches) -> Batches:
        out = _Out(folder, ".warc.gz", archive_bytes)
        try:
            def captures() -> Iterator[tuple]:
                for page_id, url, key, payload, refers_to, size, digest in _rows(batches):
                    place = out.append(_member(record(page_id, url, payload, refers_to, size, digest, date)))
                    yield page_id, url, key, "revisit" if payload is None else "response", refers_to, size, digest, *place

            yield from _batches(captures(), _schema(_CAPTURE))
        finally:
            out.close()

    rows = _with_originals(pages, id_col, url_col, html_col, least_bytes)
    # Written once: where the records lie is different each time the plan runs.
    return stage(rows.mapInArrow(run, _CAPTURE), new_folder(pages.sparkSession, "captures"))


# ---- index


def build_index(captures: DataFrame, folder: str, block_captures: int = BLOCK_CAPTURES) -> CaptureIndex:
    """Sort captures by key into compressed blocks below ``folder``, and write their directory.

    The place of a record is part of the sort order, so one key with very many captures is spread over partitions.
    The directory has ``MAX_BLOCKS`` entries at most, and one more for each partition of the sort.
    """
    spark = captures.sparkSession
    size = max(block_captures, -(-captures.count() // MAX_BLOCKS))

    def run(batches: Batches) -> Batches:
        out = _Out(f"{folder}/blocks", ".gz", ARCHIVE_BYTES)

        def blocks() -> Iterator[tuple]:
            held = []

            def block() -> tuple:
                data = _member("\n".join(json.dumps(row) for row in held).encode())
                return held[0][0], held[-1][0], len(held), *out.append(data)

            for row in _rows(batches):
                held.append(row)
                if len(held) == size:
                    yield block()
                    held = []
            if held:
                yield block()

        try:
            yield from _batches(blocks(), _schema(_BLOCK), most=100)
        finally:
            out.close()

    order = ["key", "archive", "offset"]
    ranged = captures.select("key", "archive", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    directory = stage(ranged.mapInArrow(run, _BLOCK), f"{folder}/directory")
    return CaptureIndex(f"{folder}/directory", directory.count())


class _Directory:
    """The directory in a task: blocks by first key, searched by halves."""

    def __init__(self, folder: str) -> None:
        system, place = _opened(folder)
        table = pq.read_table(place, filesystem=system).sort_by([("first_key", "ascending"), ("last_key", "ascending")])
        self.first, self.last = (table.column(name).to_pylist() for name in ("first_key", "last_key"))
        self.places = list(zip(*(table.column(name).to_pylist() for name in ("file", "offset", "length"))))

    def blocks(self, key: str) -> Iterator[tuple[str, int, int]]:
        """Places of the blocks that can hold ``key``: those that start with it, and the one before."""
        stop = bisect.bisect_right(self.first, key)
        for i in range(max(bisect.bisect_left(self.first, key) - 1, 0), stop):
            if self.last[i] >= key:
                yield self.places[i]


def find_captures(index: CaptureIndex, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Where the records of each distinct key of ``keys`` lie: ``key``, ``archive``, ``offset``, ``length``.

    A task loads the directory, searches it for its keys, and hands them on by block. Then each block that can hold a
    key is read once for all keys that share it. A key without a capture gives no row, NULL neither.
    """
    importable(keys.sparkSession)

    def search(batches: Batches) -> Batches:
        directory = None

        def found() -> Iterator[tuple]:
            nonlocal directory
            for (key,) in _rows(batches):
                directory = directory or _Directory(index.directory)
                for place in directory.blocks(key):
                    yield *place, key

        yield from _batches(found(), _schema(wanted))

    def read(batches: Batches) -> Batches:
        def by_block() -> Iterator[tuple[str, int, int, list[str]]]:
            place, held = None, []
            for *block, key in _rows(batches):
                if block != place:
                    if held:
                        yield *place, held
                    place, held = block, []
                held.append(key)
            if held:
                yield *place, held

        def places() -> Iterator[tuple]:
            for (*_, asked), data in _ranges(by_block()):
                rows = [json.loads(line) for line in _unpacked(data).decode().split("\n")]
                firsts = [row[0] for row in rows]
                for key in asked:
                    for i in range(bisect.bisect_left(firsts, key), bisect.bisect_right(firsts, key)):
                        yield tuple(rows[i])

        yield from _batches(places(), _schema(_PLACE))

    wanted = "file string, offset long, length long, key string"
    if not index.blocks:
        return keys.sparkSession.createDataFrame([], _PLACE)
    asked = keys.select(F.col(f"`{key_col}`").alias("key")).filter("key IS NOT NULL").distinct()
    by_block = asked.mapInArrow(search, wanted).repartition("file", "offset")
    return by_block.sortWithinPartitions("file", "offset", "key").mapInArrow(read, _PLACE)


def read_records(places: DataFrame) -> DataFrame:
    """The records at ``archive``, ``offset``, ``length``, by byte ranges: id, URL, size and digest of the full
    payload, type, the id it refers to, and the payload (NULL in a revisit, which has none).

    Places are dealt by ranges of (archive, offset), so a task reads neighbouring records of few archives, and an
    archive is read by several tasks. A record whose payload does not have its digest raises.
    """

    def run(batches: Batches) -> Batches:
        records = (parse_record(_unpacked(data)) for _, data in _ranges(_rows(batches)))
        yield from _batches(records, _schema(_RECORD), lambda row: 1000 + len(row[-1] or b""), _READ_BYTES)

    order = ["archive", "offset"]
    ranged = places.select("archive", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, _RECORD)


def look_up(index: CaptureIndex, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The records of each URL of ``urls``: a NULL URL finds the records without one."""
    keys = urls.select(capture_key(F.col(f"`{url_col}`").cast("string")).alias("key"))
    return read_records(find_captures(index, keys))


def archive_pages(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages to archives, index them, and read every record back by its URL."""
    folder = new_folder(spark, "warc")
    captures = write_archives(pages, f"{folder}/archives", id_col, url_col, html_col)
    index = build_index(captures, f"{folder}/index")
    return look_up(index, pages, url_col)
