"""WARC files as rows.

A data source for Spark: its partitions are byte ranges of the files, so one large file is read
by many tasks. In a gzip file a range owns the members that begin in it, found by
their first bytes and proven by unpacking them; in a plain file the records that begin in it,
found by a header whose record ends where another record or the file does. Records are cut by their
stated length, so a page may quote anything. A record that was cut short is noticed,
as what follows it isn't a record; it is left out and reading goes on at the next header.
With a limit a file is read from its start and left after that many records.

Executors open the files themselves, through Arrow's file systems. Where those can't reach
the path, Spark's own text reader streams the files instead.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gleaner.sources.files import file_system as _file_system

#: Begins the version line of every record; what follows is the minor version.
MARKER = "WARC/1."
RECORD_SCHEMA = (
    "url string, warc_id string, source_id string, content string, file_name string, record_offset bigint, record_index bigint"
)
SPLIT_BYTES = 64 * 1024 * 1024

_MARK = MARKER.encode()
_GZIP = b"\x1f\x8b\x08"
_READ = 1 << 20
_LONGEST_HEADER = 1 << 16
_BATCH_BYTES = 16_000_000
_HEAD_END = re.compile(rb"</head|<body", re.IGNORECASE)
_CHARSET = re.compile(rb"charset=[\"']?([A-Za-z0-9_.:-]+)", re.IGNORECASE)


# -- records in a stream of bytes ---------------------------------------------------------


class Stream:
    """Bytes as they come, looked at before they are passed. ``more()`` gives the next ones, empty at the end."""

    def __init__(self, more: Callable[[], bytes], at: int = 0):
        self.held, self.at, self._more, self.ended = bytearray(), at, more, False

    def fill(self, n: int) -> bool:
        while len(self.held) < n and not self.ended:
            got = self._more()
            self.held += got
            self.ended = not got
        return len(self.held) >= n

    def skip(self, n: int) -> None:
        self.fill(n)
        self.at += min(n, len(self.held))
        del self.held[:n]


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in block.split(b"\r\n"))
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, sep, v in pairs if sep}


def _header(data: Stream, at: int = 0) -> tuple[dict[str, str], int, int] | None:
    """Fields, size and stated length of the header at ``at``; None if there is none."""
    data.fill(at + len(_MARK))
    if not data.held.startswith(_MARK, at):
        return None
    data.fill(at + _LONGEST_HEADER)
    end = data.held.find(b"\r\n\r\n", at, at + _LONGEST_HEADER)
    if end < 0:
        return None
    fields = _headers(bytes(data.held[at:end]))
    length = fields.get("content-length", "")
    if "warc-type" not in fields or not re.fullmatch("[0-9]{1,15}", length):
        return None
    return fields, end + 4 - at, int(length)


def _ends_well(data: Stream, at: int) -> bool:
    """Nothing but line ends and then a record, or nothing, follows."""
    while True:
        if not data.fill(at + 1):
            return True
        if data.held[at] not in b"\r\n":
            data.fill(at + len(_MARK))
            return data.held.startswith(_MARK, at)
        at += 1


def _next_header(data: Stream, at: int, end: int | None = None) -> int | None:
    """Where the next valid header begins, at ``at`` or later, before ``end``."""
    while True:
        data.fill(at + _READ)
        found = data.held.find(_MARK, at, None if end is None else end + len(_MARK) - 1)
        if found >= 0:
            if _header(data, found) is not None:
                return found
            at = found + 1
        elif data.ended or (end is not None and len(data.held) >= end):
            return None
        else:
            at = max(at, len(data.held) - len(_MARK) + 1)


def records(data: Stream, stop: int | None = None) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, header fields, block)`` of the records that begin before ``stop``."""
    while True:
        while data.fill(1) and data.held[0] in b"\r\n":
            data.skip(1)
        if not data.fill(1) or (stop is not None and data.at >= stop):
            return
        header = _header(data)
        if header is None:
            at = _next_header(data, 1)
            if at is None:
                return
            data.skip(at)
            continue
        fields, size, length = header
        whole = data.fill(size + length)
        if not whole or not _ends_well(data, size + length):
            inside = _next_header(data, size, min(size + length, len(data.held)))
            if inside is not None:  # the record was cut short, the next one lies within its stated length
                data.skip(inside)
                continue
            if not whole:
                return
        yield data.at, fields, bytes(data.held[size : size + length])
        data.skip(size + length)


def _head_end(body: bytes) -> int:
    """End of the document head, or of the document."""
    found = _HEAD_END.search(body)
    return found.start() if found else len(body)


def _decode(body: bytes, http_head: bytes) -> str:
    try:
        return body.decode("utf-8")
    except UnicodeDecodeError:
        named = _CHARSET.search(http_head) or _CHARSET.search(body, 0, _head_end(body))
        try:
            return body.decode(named.group(1).decode() if named else "latin-1", "replace")
        except LookupError:
            return body.decode("latin-1")


def _response_row(fields: dict[str, str], block: bytes, file_name: str, offset: int, index: int) -> tuple | None:
    if fields["warc-type"] != "response":
        return None
    http_head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        http_head, body = b"", block
    warc_id = fields.get("warc-record-id", "").strip("<>").removeprefix("urn:uuid:")
    return fields.get("warc-target-uri"), warc_id, file_name, _decode(body, http_head), file_name, offset, index


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    types = [pa.string()] * 5 + [pa.int64()] * 2
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    for row in rows:
        held.append(row)
        size += len(row[3])
        if size > _BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


# -- ranges of files ------------------------------------------------------------------------


class _Member:
    """A gzip member as a stream; ``end`` is where it stops, None while unknown or if it is broken."""

    def __init__(self, file, start: int):
        self.file, self.at, self.end = file, start, None
        self.unpack, self.rest = zlib.decompressobj(31), b""

    def more(self) -> bytes:
        while self.end is None:
            if not self.rest:
                self.file.seek(self.at)
                self.rest = self.file.read(_READ)
                self.at += len(self.rest)
            if not self.rest:
                return b""
            try:
                out = self.unpack.decompress(self.rest, 4 * _READ)
            except zlib.error:
                return b""
            self.rest = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.end = self.at - len(self.rest)
            if out:
                return out
        return b""


def _next_member(file, at: int, end: int) -> int | None:
    """Where the next gzip member that holds records begins, before ``end``."""
    while at < end:
        file.seek(at)
        piece = file.read(_READ)
        if not piece:
            return None
        found = piece.find(_GZIP)
        while found >= 0 and at + found < end:
            file.seek(at + found)
            try:
                if zlib.decompressobj(31).decompress(file.read(_LONGEST_HEADER), 64).startswith(_MARK):
                    return at + found
            except zlib.error:
                pass
            found = piece.find(_GZIP, found + 1)
        at += max(1, len(piece) - len(_GZIP) + 1)
    return None


def _gzip_records(file, start: int, end: int) -> Iterator[tuple[int, int, dict, bytes]]:
    at = _next_member(file, start, end)
    while at is not None:
        member = _Member(file, at)
        for index, (_, fields, block) in enumerate(records(Stream(member.more))):
            yield at, index, fields, block
        while member.end is None and member.more():
            pass
        at = _next_member(file, at + 1 if member.end is None else member.end, end)


def _plain_records(file, start: int, end: int) -> Iterator[tuple[int, int, dict, bytes]]:
    file.seek(start)
    data = Stream(lambda: file.read(_READ), start)
    if start:  # a quoted header isn't followed by a record where its own ends
        at = _next_header(data, 0)
        while at is not None:
            _, size, length = _header(data, at)
            if data.fill(at + size + length) and _ends_well(data, at + size + length):
                break
            if data.at + at >= end:
                return
            data.skip(at)
            at = _next_header(data, 1)
        if at is None:
            return
        data.skip(at)
    for offset, fields, block in records(data, end):
        yield offset, 0, fields, block


class _Ranges(InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int]]):
        self.ranges = ranges


class WarcReader(DataSourceReader):
    """Options: ``files`` (JSON list of path and length), ``recordLimit`` per file, ``splitBytes``."""

    def __init__(self, options: dict):
        self.files = [(p, int(n)) for p, n in json.loads(options["files"])]
        limit = options.get("recordLimit")
        self.limit = None if limit is None else int(limit)
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        """Ranges of at most the split size, small files together; with a limit each file from its start."""
        if self.limit is not None:
            return [_Ranges([(p, 0, n)]) for p, n in self.files]
        out, held, size = [], [], 0
        for path, length in self.files:
            for start in range(0, length, self.split):
                end = min(length, start + self.split)
                if held and size + end - start > self.split:
                    out.append(_Ranges(held))
                    held, size = [], 0
                held.append((path, start, end))
                size += end - start
        return [*out, _Ranges(held)] if held else out

    def _rows(self, ranges: list[tuple[str, int, int]]) -> Iterator[tuple]:
        for path, start, end in ranges:
            name, taken = path.rsplit("/", 1)[-1], 0
            system, at = _file_system(path)
            with system.open_input_file(at) as file:
                read = _gzip_records if path.endswith(".gz") else _plain_records
                for offset, index, fields, block in read(file, start, end):
                    if self.limit is not None and taken >= self.limit:
                        break
                    row = _response_row(fields, block, name, offset, index)
                    if row is not None:
                        taken += 1
                        yield row

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        return _batches(self._rows(partition.ranges))


class WarcSource(DataSource):
    """``spark.read.format("warc")``; use :func:`read_warc`, which lists the files."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


# -- reading ----------------------------------------------------------------------------------


def _streamed_rows(limit: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows from the pieces between markers of whole files, in order; the offset counts unpacked bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((p, v) for b in batches for p, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        ahead = next(pieces, None)

        def rows() -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None:
                path, first, taken = ahead[0], True, 0

                def more() -> bytes:
                    nonlocal ahead, first
                    if ahead is None or ahead[0] != path:
                        return b""
                    got = (b"" if first else _MARK) + (ahead[1] or b"")
                    ahead, was_first, first = next(pieces, None), first, False
                    return got or (more() if was_first else b"")

                data, name = Stream(more), path.rsplit("/", 1)[-1]
                for offset, fields, block in records(data):
                    row = _response_row(fields, block, name, offset, 0)
                    if row is not None and (limit is None or taken < limit):
                        taken += 1
                        yield row
                while not data.ended:  # what is left of the file
                    data.skip(len(data.held))
                    data.fill(1)

        yield from _batches(rows())

    return run


def _read_streamed(spark: SparkSession, paths: list[str], limit: int | None) -> DataFrame:
    """By Spark's text reader, which unpacks each gzip file in one task. Plain files are split and put in order again."""
    parts = []
    for plain in (False, True):
        some = [p for p in paths if p.endswith(".gz") != plain]
        if some:
            pieces = spark.read.option("lineSep", MARKER).text(some)
            pieces = pieces.select(
                F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("value"),
                F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("number"),
            )
            if plain:
                pieces = pieces.repartition("path").sortWithinPartitions("path", "start", "number")
            parts.append(pieces.select("path", "value").mapInArrow(_streamed_rows(limit), RECORD_SCHEMA))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_warc(spark: SparkSession, path, limit: int | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Response records of plain and gzip WARC files below ``path``, at most the first ``limit`` of each file:
    ``url, warc_id, source_id, content, file_name, record_offset, record_index``.

    The last two give the order in a file: bytes before the record, or its gzip member, and its place in the member.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    files = sorted((r.path, r.length) for r in listed.collect())  # names, which Spark holds on the driver for any scan
    if not files:
        return spark.createDataFrame([], RECORD_SCHEMA)
    try:
        _file_system(files[0][0])
    except Exception:  # noqa: BLE001  (Arrow raises many kinds: no such scheme, no library for it)
        return _read_streamed(spark, [p for p, _ in files], limit)
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc").option("files", json.dumps(files)).option("splitBytes", split_bytes)
    return (reader if limit is None else reader.option("recordLimit", limit)).load()


# -- writing ----------------------------------------------------------------------------------


def warc_value(url: str = "url", html: str = "html", record_id: str = "page_id") -> Column:
    """A page as a WARC response record."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), F.col(html))
    return F.concat(
        F.lit(MARKER + "0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:"),
        F.col(record_id).cast("string"),
        F.lit(">\r\nWARC-Target-URI: "),
        F.col(url),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(http).cast("string"),
        F.lit("\r\n\r\n"),
        http,
    )


def warc_lines(pages: DataFrame, url: str = "url", html: str = "html", record_id: str = "page_id") -> DataFrame:
    """Pages as WARC response records, one per row, for a text writer with ``lineSep='\\r\\n\\r\\n'``."""
    return pages.select(warc_value(url, html, record_id).alias("value"))


def write_warc(pages: DataFrame, path: str, compression: str = "gzip", **columns: str) -> None:
    """Write pages as WARC files, gzipped unless ``compression`` is ``none``."""
    warc_lines(pages, **columns).write.option("compression", compression).option("lineSep", "\r\n\r\n").text(path)
