"""WARC archives with segmented records: writing, reading, putting segments together.

A record whose block is long is written as segments (ISO 28500): a first record and
continuation records that name its id as their origin, numbered, the last with the
total length. Reading groups segments by origin, orders them, verifies the total length,
and decodes the chunked transfer framing of the HTTP block. Payloads seen before are
written as revisit records without their bytes.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.llm.text import column
from gleaner.operators.skew import lookup
from gleaner.session import scratch_path, store

#: Block bytes per record; with the records per file it bounds what a reader unpacks.
SEGMENT_BYTES = 32_768
RECORDS_PER_FILE = 4_096
CHUNK_BYTES = 8_192
#: Smaller payloads are always written out.
REVISIT_FROM = 100
#: Bytes of records a reader hands over at once.
BATCH_BYTES = 8_000_000
DATE = "2026-01-01T00:00:00Z"
CRLF = "\r\n"


def _utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def _record_id(row: Column) -> Column:
    h = F.md5(F.concat(F.lit("page "), row.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """One header line; nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def _chunked(payload: Column) -> Column:
    """The payload in chunks of at most CHUNK_BYTES, with the closing empty chunk."""
    size = F.octet_length(payload)
    starts = F.when(size > 0, F.sequence(F.lit(1), size, F.lit(CHUNK_BYTES))).otherwise(F.array().cast("array<int>"))

    def chunk(at: Column) -> Column:
        # A binary string isn't checked when read as text, so chunks may cut a character.
        part = F.substring(payload, at, F.lit(CHUNK_BYTES))
        return F.concat(F.hex(F.octet_length(part)), F.lit(CRLF), part.cast("string"), F.lit(CRLF))

    return F.concat(F.array_join(F.transform(starts, chunk), ""), F.lit(f"0{CRLF}{CRLF}")).cast("binary")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page with its payload, digest, record id, and the record it refers to, if any.

    Of equal payloads of REVISIT_FROM bytes and more the least id's record is the response
    (a null id comes last; of repeated rows the first read). Groups of copies are reduced before
    the shuffle and looked up by digest.
    """
    payload = _utf8(F.coalesce(column(html_col), F.lit("")))
    rows = store(
        pages.select(
            F.monotonically_increasing_id().alias("row"), column(id_col).alias("page_id"), column(url_col).alias("url"), payload.alias("payload")
        ).select("*", F.octet_length("payload").alias("bytes"), F.sha2("payload", 256).alias("digest")),
        "pages",
    )
    best = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    repeated = (
        rows.filter(F.col("bytes") >= REVISIT_FROM)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), best.alias("best"))
        .filter("copies > 1")
        .select("digest", "copies", F.col("best.row").alias("first"))
    )
    found = lookup(rows, repeated, "digest", spread_by="row", size_col="copies", how="left")
    other = F.col("first").isNotNull() & (F.col("first") != F.col("row"))
    return found.select(
        "page_id", "url", "payload", "digest", _record_id(F.col("row")).alias("record_id"),
        F.when(other, _record_id(F.col("first"))).alias("refers_to"),
    )


def to_records(planned: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``value``: the WARC records, one row per segment, without their closing blank lines."""
    http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit(http + CRLF).cast("binary")).otherwise(
        F.concat(F.lit(f"{http}Transfer-Encoding: chunked{CRLF}{CRLF}").cast("binary"), _chunked(F.col("payload")))
    )
    framed = planned.withColumn("block", block).withColumn("total", F.octet_length("block"))
    count = F.ceil(F.col("total") / segment_bytes).cast("int")
    cut = framed.withColumn("segments", count).withColumn("number", F.explode(F.sequence(F.lit(1), F.col("segments"))))
    part = F.substring("block", (F.col("number") - 1) * segment_bytes + 1, F.lit(segment_bytes))
    first, split = F.col("number") == 1, F.col("segments") > 1
    own_id = F.when(first, F.col("record_id")).otherwise(
        F.concat(F.lit("<urn:uuid:"), F.md5(F.concat("record_id", F.col("number").cast("string"))), F.lit(">"))
    )
    kind = F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", own_id),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", url),
        F.when(
            first,
            F.concat(
                _header("WARC-Page-ID", F.col("page_id")),
                _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
                _header("WARC-Refers-To", F.col("refers_to")),
                _header("Content-Type", F.lit("application/http; msgtype=response")),
            ),
        ).otherwise(_header("WARC-Segment-Origin-ID", F.col("record_id"))),
        F.when(split, _header("WARC-Segment-Number", F.col("number"))).otherwise(""),
        F.when(split & (F.col("number") == F.col("segments")), _header("WARC-Segment-Total-Length", F.col("total"))).otherwise(""),
        _header("Content-Length", F.octet_length(part)),
        F.lit(CRLF),
    )
    return cut.select(F.concat(head, part.cast("string")).alias("value"))


def write_archives(records: DataFrame, path: str) -> None:
    """Write records as gzip files below ``path``; the line end of the text writer is the end of a record."""
    writer = records.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.text(path)


def _records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record; lengths rule, so payloads may hold anything."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record {head.get('warc-record-id')} ends early")
        yield head, block


FIELDS = (
    "page_id bigint, record_id string, kind string, refers_to string, stated_digest string, "
    "origin string, number int, total bigint, block binary"
)


def _reader(segmented: bool):
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FIELDS.split(", ")]

        def number(x: str | None) -> int | None:
            return None if x is None else int(x)

        for frame in frames:
            for content in frame["content"]:
                out, held = [], 0
                with gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content) as stream:
                    for h, block in _records(stream):
                        if (h.get("warc-segment-number") is not None) != segmented:
                            continue
                        origin = h.get("warc-segment-origin-id", h.get("warc-record-id"))
                        digest = h.get("warc-payload-digest", "").removeprefix("sha256:") or None
                        out.append(
                            (number(h.get("warc-page-id")), h.get("warc-record-id"), h.get("warc-type"), h.get("warc-refers-to"), digest,
                             origin, number(h.get("warc-segment-number")), number(h.get("warc-segment-total-length")), block)
                        )
                        held += len(block)
                        if held >= BATCH_BYTES:
                            yield pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "number": "Int32", "total": "Int64"})
                            out, held = [], 0
                if out:
                    yield pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "number": "Int32", "total": "Int64"})

    return read


def reassembled(segments: DataFrame) -> DataFrame:
    """Whole records from segments: grouped by origin, ordered by number, the total length verified.

    ``complete`` is false where a number is missing or repeated, or the length isn't the
    stated total; the block is then null. A group is as large as one page.
    """
    parts = F.sort_array(F.collect_list(F.struct("number", "block")))
    first = lambda c: F.max(F.when(F.col("number") == 1, F.col(c))).alias(c)
    grouped = segments.groupBy("origin").agg(
        parts.alias("parts"), F.max("total").alias("total"), *[first(c) for c in ("page_id", "kind", "refers_to", "stated_digest")]
    )
    numbers = F.col("parts.number")
    length = F.aggregate("parts", F.lit(0).cast("bigint"), lambda s, p: s + F.octet_length(p["block"]))
    complete = (numbers == F.sequence(F.lit(1), F.size("parts"))) & (length == F.col("total"))
    whole = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    return grouped.select(
        "page_id", F.col("origin").alias("record_id"), "kind", "refers_to", "stated_digest",
        F.coalesce(complete, F.lit(False)).alias("complete"), F.when(complete, whole).alias("block"),
    )


_CHUNK_LINE = re.compile(rb"([0-9A-Fa-f]{1,15})[ \t]*(?:;[^\r\n]*)?")
_TRAILER = re.compile(rb"(?:[^\r\n:]+:[^\r\n]*\r\n)*\r\n")


def unchunk(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken.

    A size is hexadecimal digits only, with extensions behind a semicolon; each chunk ends with a line end; the
    last one, of size 0, is followed by trailer lines and a blank line, and by nothing else.
    """
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        line = _CHUNK_LINE.fullmatch(body, at, end) if end >= 0 else None
        if line is None:
            return None
        size, at = int(line.group(1), 16), end + 2
        if size == 0:
            return b"".join(out) if _TRAILER.fullmatch(body, at) else None
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes | None) -> bytes | None:
    """The payload of an HTTP block, its transfer framing removed."""
    if block is None:
        return None
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank:
        return None
    fields = [line.lower().replace(b" ", b"") for line in head.split(b"\r\n")]
    return unchunk(body) if b"transfer-encoding:chunked" in fields else body


def _payloads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        payload = [http_payload(b) for b in frame["block"]]
        yield frame.drop(columns="block").assign(payload=payload)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record below ``path``: ids, stated digest, ``complete``, ``payload``.

    Plain and gzip files are read. Files are unpacked record by record. Only segmented
    records are shuffled.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    single = files.mapInPandas(_reader(False), FIELDS).select(
        "page_id", "record_id", "kind", "refers_to", "stated_digest", F.lit(True).alias("complete"), "block"
    )
    segments = files.mapInPandas(_reader(True), FIELDS)
    records = single.unionByName(reassembled(segments))
    schema = "page_id bigint, record_id string, kind string, refers_to string, stated_digest string, complete boolean, payload binary"
    return records.mapInPandas(_payloads, schema)


def resolve(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, verified`` for each record.

    A revisit has the bytes and digest of the response it refers to. ``verified``: the
    record is complete and its payload has the stated digest. Many revisits of one
    response are spread.
    """
    digest = F.sha2("payload", 256)
    rows = store(
        records.select(
            "page_id", "record_id", "kind", "refers_to", "stated_digest", "complete",
            F.octet_length("payload").cast("bigint").alias("bytes"), digest.alias("digest"),
        ),
        "records",
    )
    revisits = rows.filter("kind = 'revisit'")
    wanted = revisits.groupBy("refers_to").agg(F.count(F.lit(1)).alias("rows"))
    responses = rows.filter("kind = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("bytes").alias("_bytes"), F.col("digest").alias("_digest"), F.col("page_id").alias("_page")
    )
    table = wanted.join(responses, "refers_to")
    found = lookup(revisits, table, "refers_to", spread_by="record_id", size_col="rows", how="left")
    done = rows.filter("kind = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        F.lit(None).cast("bigint").alias("refers_to"), (F.col("complete") & F.col("digest").eqNullSafe(F.col("stated_digest"))).alias("verified"),
    )
    again = found.select(
        "page_id", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        F.col("_page").alias("refers_to"), F.col("_digest").eqNullSafe(F.col("stated_digest")).alias("verified"),
    )
    return done.unionByName(again)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per page, read the archives back, and give what :func:`resolve` finds.

    A null html counts as empty. A null id is written without its header and read as
    null; repeated rows are records of their own, all but the first of equal payloads
    revisits. Ids are whole numbers. Lines in an url are escaped, a null url has no header. No page gives no
    record. Further columns are ignored.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(to_records(plan_records(pages, id_col, url_col, html_col)), path)
    return resolve(read_archives(spark, path))
