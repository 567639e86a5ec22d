"""Cut documents into token-bounded segments along their lines."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions.text import token_count
from gleaner.operators.filters import score_filter
from gleaner.operators.prefix import row_index
from gleaner.operators.skew import lookup
from gleaner.session import store

def add_document_id(df: DataFrame, key: str, out: str = "id") -> DataFrame:
    """Add a dense id by the order of ``key`` unless there is one.

    Every row gets its own: rows that share a key, or have none, are told apart by
    their place in the stored table. Only key and place are ordered; texts stay where
    they are while the ids are few enough to broadcast.
    """
    if out in df.columns:
        return df
    rows = store(df.withColumn("_row", F.monotonically_increasing_id()), "document-id")
    ids = row_index(rows.select(key, "_row"), [key, "_row"], out).select("_row", out)
    return lookup(rows, ids, "_row", spread_by="_row").select(*[F.col(f"`{c}`") for c in df.columns], out)


def min_document_tokens(df: DataFrame, minimum, text: str = "text", count=token_count) -> DataFrame:
    """Add ``document_token_count`` and drop shorter documents."""
    return score_filter(df, count(F.col(text)), "document_token_count", minimum=minimum)


def split_lines(df: DataFrame, text: str = "text", segment_id: str = "segment_id", separator: str = "\n") -> DataFrame:
    """One row per line with its number; empty lines count."""
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    lines = F.split(F.col(text), rf"\Q{separator}\E", -1)
    return df.select(*others, F.posexplode(lines).alias(segment_id, text))


def line_token_filter(lines: DataFrame, maximum, text: str = "text", count=token_count) -> DataFrame:
    """Add ``segment_token_count`` and drop longer lines."""
    return score_filter(lines, count(F.col(text)), "segment_token_count", maximum=maximum)


def greedy_cuts(counts: list[int], maximum: int, separator_length: int) -> list[tuple[list[int], int]]:
    """Chunks as ``(lines, tokens)``: lines above ``maximum`` are left out, the others packed in order."""
    chunks: list[tuple[list[int], int]] = []
    lines: list[int] = []
    total = 0
    for i, n in enumerate(counts):
        if n > maximum:
            continue
        if lines and total + n + separator_length <= maximum:
            lines.append(i)
            total += n + separator_length
            continue
        if lines:
            chunks.append((lines, total))
        lines, total = [i], n
    if lines:
        chunks.append((lines, total))
    return chunks


def _chunk_rows(df: DataFrame, lines: Column, separator: str, text: str, columns: list[str]) -> DataFrame:
    """One row per chunk. ``df`` has ``_counts``, ``_high`` and ``_low``; ``lines`` is the text or the array of its lines.

    Each document is passed over once, in Arrow batches: time and memory are linear in it,
    and no chunk's row ever carries the other lines.
    """
    others = [c for c in columns if c != text]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in others], f"`{text}` string", "segment_id int", "segment_token_count bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            texts: list[str] = []
            numbers: list[int] = []
            sizes: list[int] = []
            held = 0

            def out() -> pa.RecordBatch:
                kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in others]
                made = [pa.array(texts, pa.string()), pa.array(numbers, pa.int32()), pa.array(sizes, pa.int64())]
                return pa.RecordBatch.from_arrays([*kept, *made], names=[*others, text, "segment_id", "segment_token_count"])

            for i in range(batch.num_rows):
                body, counts = batch.column("_lines")[i].as_py(), batch.column("_counts")[i]
                if body is None or not counts.is_valid:
                    continue
                parts = body.split(separator) if isinstance(body, str) else body
                low = batch.column("_low")[i].as_py()
                number = 0
                for chosen, total in greedy_cuts(counts.values.to_pylist(), batch.column("_high")[i].as_py(), len(separator)):
                    if low is not None and total < low:
                        continue
                    rows.append(i)
                    texts.append(separator.join([parts[k] for k in chosen]))
                    numbers.append(number)
                    sizes.append(total)
                    number += 1
                    held += len(texts[-1])
                    if held >= 8_000_000:
                        yield out()
                        rows, texts, numbers, sizes, held = [], [], [], [], 0
            if rows:
                yield out()

    given = df.select(*[F.col(f"`{c}`") for c in others], lines.alias("_lines"), "_counts", "_high", "_low")
    return given.mapInArrow(run, schema).select(*[F.col(f"`{c}`") for c in columns], "segment_id", "segment_token_count")


def greedy_join(
    lines: DataFrame, maximum: int, key: str = "id", text: str = "text", separator: str = "\n"
) -> DataFrame:
    """Pack filtered lines ``(key, segment_id, text, segment_token_count)`` of each document in order.

    The count of a chunk is the running sum, not a recount of the joined text.
    """
    others = [c for c in lines.columns if c not in (key, text, "segment_id", "segment_token_count")]
    line = F.struct("segment_id", F.col(text).alias("text"), F.col("segment_token_count").alias("n"))
    per_doc = lines.groupBy(key).agg(F.array_sort(F.collect_list(line)).alias("_l"), *[F.first(c).alias(c) for c in others])
    arrays = per_doc.withColumns({"_counts": F.col("_l.n"), "_high": F.lit(maximum), "_low": F.lit(None).cast("int")})
    return _chunk_rows(arrays, F.col("_l.text"), separator, text, [key, *others, text])


def min_segment_tokens(segments: DataFrame, minimum: int) -> DataFrame:
    return segments.filter(F.col("segment_token_count") >= minimum)


def line_counts_of(lines: Column) -> Column:
    return F.transform(lines, token_count)


def chunk_documents(
    df: DataFrame,
    maximum: int | Column,
    minimum: int | Column,
    text: str = "text",
    separator: str = "\n",
    line_counts=line_counts_of,
    counts: str | None = None,
) -> DataFrame:
    """Split, filter, pack and filter again inside each row, without a row per line.

    ``segment_id`` counts the segments left, from 0. Both bounds may be columns.
    ``line_counts`` maps an array of lines to their token counts; a Pandas UDF
    around another tokeniser fits. ``counts`` names a column that holds the counts
    already; it is dropped. A null text has no segment.
    """
    counted = df if counts else df.withColumn("_counts", line_counts(F.split(F.col(text), rf"\Q{separator}\E", -1)))
    bounds = {name: b if isinstance(b, Column) else F.lit(b) for name, b in (("_high", maximum), ("_low", minimum))}
    if counts:
        bounds["_counts"] = F.col(counts)
    columns = [c for c in df.columns if c != counts]
    return _chunk_rows(counted.withColumns(bounds), F.col(text), separator, text, columns)


def chunk_equivalence(
    left: DataFrame, right: DataFrame, key: str = "id", compare: list[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Rows in which two segmentations differ, matched on ``(key, segment_id)``."""
    columns = compare or ["text", "segment_token_count"]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, "segment_id", F.struct(*columns).alias(name))

    joined = side(left, "left").join(side(right, "right"), [key, "segment_id"], "full_outer")
    different = joined.filter(~F.col("left").eqNullSafe(F.col("right")))
    return different if limit is None else different.orderBy(key, "segment_id").limit(limit)
