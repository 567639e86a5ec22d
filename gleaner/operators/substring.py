"""Exact repeated passages of at least ``k`` tokens, found and cut out.

A token lies in a repeated passage of ``k`` or more tokens exactly when it lies
in a repeated k-gram, so the work is a grouping of k-gram hashes. To shuffle
far less than one row per token, each document first emits only its minimizers:
in every window of k tokens the sub-gram of ``k // 2`` tokens with the least
hash. Equal windows have equal minimizers, so a repeated k-gram always has a
repeated minimizer, and only windows under a repeated one are hashed in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gleaner.functions.text import let, lossless_tokens
from gleaner.operators.prefix import running_totals
from gleaner.operators.skew import HOT_ROWS, SALTS, small_or_none, spread_join
from gleaner.session import bounded_batches, cut_lineage

# Fixed values.
MIN_TOKENS = 50
SEPARATOR_BYTES = 12

# Positions a task hands over at a time.
_BLOCK = 1_000_000

# Odd base of the polynomial window hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def token_stream(df: DataFrame, key: str = "doc_id", text: str = "text", tokens=lossless_tokens) -> DataFrame:
    """``(key, pos, token)``; joined in order the tokens give the text back."""
    return df.select(key, F.posexplode(tokens(F.col(text))).alias("pos", "token"))


def doc_offsets(
    df: DataFrame,
    order: list[str],
    text: str = "text",
    separator: int = SEPARATOR_BYTES,
    unit: int = 2,
    tokens=lossless_tokens,
) -> DataFrame:
    """``(order columns, n_tokens, doc_start, doc_end)`` in the packed corpus.

    A document takes ``separator + unit * n_tokens`` bytes.
    """
    counted = df.select(*order, F.size(tokens(F.col(text))).cast("bigint").alias("n_tokens"))
    size = (F.lit(separator) + F.col("n_tokens") * unit).cast("bigint")
    ends = running_totals(counted, {"doc_end": size}, order)
    return ends.select(*order, "n_tokens", (F.col("doc_end") - size).alias("doc_start"), "doc_end")


def token_hashes(tokens: Column, seed: int = 0) -> Column:
    """A 64-bit hash per token; only these numbers travel to Python."""
    return F.transform(tokens, lambda t: F.xxhash64(F.lit(seed), t))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` tokens, from prefix sums modulo 2**64."""
    n = len(hashes)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(_BASE, n), out=prefix[1:])
    windows = (prefix[width:] - prefix[:-width]) * _powers(_INVERSE, n - width + 1)
    # Mix the bits, so that the order of hashes says nothing about the tokens.
    windows ^= windows >> np.uint64(31)
    windows *= np.uint64(0xBF58476D1CE4E5B9)
    return windows ^ (windows >> np.uint64(29))


def _minimizers(hashes: np.ndarray, k: int) -> list[dict]:
    """``hash, lo, hi``: the minimizer of the windows starting at ``lo`` up to ``hi`` (exclusive)."""
    if len(hashes) < k:
        return []
    sub = max(k // 2, 1)
    grams = window_hashes(hashes.astype(np.int64).view(np.uint64), sub)
    span = k - sub + 1
    starts = np.arange(len(hashes) - k + 1)
    at = np.empty(len(starts), dtype=np.int64)
    for lo in range(0, len(starts), 100_000):
        view = np.lib.stride_tricks.sliding_window_view(grams[lo : lo + 100_000 + span - 1], span)
        at[lo : lo + len(view)] = view.argmin(axis=1) + np.arange(lo, lo + len(view))
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], len(starts)]
    values = grams[at[first]].view(np.int64)
    return [{"hash": h, "lo": a, "hi": b} for h, a, b in zip(values.tolist(), first.tolist(), last.tolist())]


def minimizers(hashes: Column, k: int = MIN_TOKENS) -> Column:
    @F.pandas_udf("array<struct<hash: bigint, lo: int, hi: int>>")
    def of(lists: pd.Series) -> pd.Series:
        return pd.Series([_minimizers(h, k) for h in lists])

    return of(hashes)


def kgram_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """``(key, pos, gram)`` for the starts in ``ranges`` of each row ``(key, first, second, ranges)``.

    ``gram`` is a pair of independent 64-bit hashes of the k tokens.
    """
    schema = T.StructType(
        [df.schema[key], *[T.StructField(n, t) for n, t in (("pos", T.IntegerType()), ("_g1", T.LongType()), ("_g2", T.LongType()))]]
    )

    def frame(keys: pd.Series, parts: list[tuple]) -> pd.DataFrame:
        rows, *columns = zip(*parts)
        held = keys.iloc[np.repeat(rows, [len(c) for c in columns[0]])].reset_index(drop=True)
        pos, one, two = (np.concatenate(c) for c in columns)
        return pd.DataFrame({key: held, "pos": pos, "_g1": one, "_g2": two})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts, size = [], 0
            for row, (first, second, ranges) in enumerate(zip(pdf["first"], pdf["second"], pdf["ranges"])):
                starts = np.unique(np.concatenate([np.arange(r["lo"], r["hi"], dtype=np.int32) for r in ranges]))
                one, two = (window_hashes(h.astype(np.int64).view(np.uint64), k).view(np.int64) for h in (first, second))
                parts.append((row, starts, one[starts], two[starts]))
                size += len(starts)
                if size >= _BLOCK:
                    yield frame(pdf[key], parts)
                    parts, size = [], 0
            if parts:
                yield frame(pdf[key], parts)

    rows = df.select(key, "first", "second", "ranges").mapInPandas(run, schema)
    return rows.select(key, "pos", F.struct("_g1", "_g2").alias("gram"))


def repeated_kgrams(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    k: int = MIN_TOKENS,
    keep: str = "none",
    tokens=lossless_tokens,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """``(key, pos)`` where a k-gram starts that occurs more than once.

    ``keep="first"`` leaves out the first occurrence (least key, then position).
    """
    if keep not in ("first", "none"):
        raise ValueError("keep must be 'first' or 'none'")
    bounded_batches(df.sparkSession)
    tokenised = df.select(key, tokens(F.col(text)).alias("tokens")).filter(F.size("tokens") >= k)
    marks = cut_lineage(
        tokenised.select(key, F.explode(minimizers(token_hashes(F.col("tokens")), k)).alias("m")).select(
            key, "m.hash", "m.lo", "m.hi"
        )
    )
    shared = marks.groupBy("hash").agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > 1)
    ranges = (
        spread_join(marks, shared, "hash", "_size", key, hot_rows=hot_rows, salts=salts, max_rows=marks.count())
        .groupBy(key)
        .agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    )
    stored, small = small_or_none(ranges)
    # Text moves only when the ranges of the affected documents are too many to broadcast.
    affected = tokenised.join(F.broadcast(stored) if small else stored, key)
    hashed = affected.select(
        key, token_hashes(F.col("tokens")).alias("first"), token_hashes(F.col("tokens"), 1).alias("second"), "ranges"
    )
    grams = cut_lineage(kgram_keys(hashed, key, k))
    repeated = (
        grams.groupBy("gram")
        .agg(F.count(F.lit(1)).alias("_size"), F.min(F.struct(key, "pos")).alias("_first"))
        .filter(F.col("_size") > 1)
    )
    found = spread_join(
        grams, repeated, "gram", "_size", key, hot_rows=hot_rows, salts=salts, max_rows=grams.count()
    )
    if keep == "first":
        found = found.filter(F.struct(key, "pos") != F.col("_first"))
    return found.select(key, F.col("pos").cast("bigint").alias("pos"))


def merge_intervals(df: DataFrame, key: str = "doc_id", start: str = "start", end: str = "end") -> DataFrame:
    """Overlapping or touching ``[start, end)`` intervals of a document become one."""
    ordered = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col(start) > before), 1).otherwise(0)
    island = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        df.select(key, start, end)
        .withColumn("_opens", opens)
        .withColumn("_island", island)
        .groupBy(key, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_island")
    )


def cut_ranges(positions: DataFrame, key: str = "doc_id", k: int = MIN_TOKENS) -> DataFrame:
    """Start positions of repeated k-grams as maximal token intervals."""
    spans = positions.select(key, F.col("pos").alias("start"), (F.col("pos") + k).alias("end"))
    return merge_intervals(spans, key)


def _overlaps(intervals: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Pairs of an interval and a document it overlaps, matched by buckets of ``width`` bytes."""

    def bucketed(df: DataFrame, start: str, end: str) -> DataFrame:
        last = F.greatest(F.col(end) - 1, F.col(start))
        buckets = F.sequence(F.floor(F.col(start) / width), F.floor(last / width))
        return df.withColumn("_bucket", F.explode(buckets))

    left = bucketed(intervals.filter(F.col("end") > F.col("start")), "start", "end")
    right = bucketed(docs, "doc_start", "doc_end")
    pairs = left.join(right, "_bucket").filter("start < doc_end AND end > doc_start")
    # An interval and a document may share several buckets; keep the first.
    first = F.floor(F.greatest("start", "doc_start") / width)
    return pairs.filter(F.col("_bucket") == first).drop("_bucket")


def adjust_intervals(
    intervals: DataFrame,
    docs: DataFrame,
    threshold: int,
    key: str = "doc_id",
    separator: int = SEPARATOR_BYTES,
    unit: int | None = 2,
    bucket_bytes: int = 1 << 16,
) -> DataFrame:
    """Byte intervals of the packed corpus fitted to its documents.

    An interval is split where it crosses into the next document, kept off the
    separator and off the cut before it, drawn in to whole tokens of ``unit``
    bytes, and dropped when shorter than ``threshold`` after that.
    ``docs`` has ``(key, doc_start, doc_end)``.
    """
    pieces = _overlaps(intervals.select("start", "end"), docs.select(key, "doc_start", "doc_end"), bucket_bytes).select(
        key,
        "doc_start",
        F.greatest("start", "doc_start").alias("start"),
        F.least("end", "doc_end").alias("end"),
    )
    per_doc = pieces.groupBy(key, "doc_start").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("pieces"))
    body = F.col("doc_start") + separator

    def fit(acc: Column, piece: Column) -> Column:
        start = F.greatest(piece["start"], acc["free"])
        end = piece["end"]
        if unit is not None:
            start = body + F.ceil((start - body) / unit) * unit
            end = body + F.floor((end - body) / unit) * unit
        cut = F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))
        fits = end - start >= threshold
        return F.struct(
            F.when(fits, end.cast("bigint")).otherwise(acc["free"]).alias("free"),
            F.when(fits, F.concat(acc["cuts"], F.array(cut))).otherwise(acc["cuts"]).alias("cuts"),
        )

    begin = F.struct(
        body.cast("bigint").alias("free"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("cuts")
    )
    cuts = F.aggregate("pieces", begin, fit, lambda acc: acc["cuts"])
    return per_doc.select(key, F.explode(cuts).alias("cut")).select(key, "cut.start", "cut.end")


def dedup_offsets(
    docs: DataFrame, cuts: DataFrame, order: list[str], key: str = "doc_id"
) -> DataFrame:
    """``(order columns, doc_start, doc_end)`` after the cuts; ``cuts`` has ``(key, start, end)``."""
    cut = cuts.groupBy(key).agg(F.sum(F.col("end") - F.col("start")).alias("_cut"))
    left = docs.join(cut, key, "left").withColumn(
        "_left", F.col("doc_end") - F.col("doc_start") - F.coalesce("_cut", F.lit(0))
    )
    names = list(dict.fromkeys([key, *order]))
    ends = running_totals(left.select(*names, "_left"), {"doc_end": F.col("_left")}, order)
    return ends.select(*names, (F.col("doc_end") - F.col("_left")).alias("doc_start"), "doc_end")


def kept_text(tokens: Column, cuts: Column) -> Column:
    """Tokens outside the sorted, disjoint ``cuts``, joined: slices between the cuts."""

    def joined(t: Column) -> Column:
        zero, size = F.lit(0).cast("bigint"), F.size(t).cast("bigint")
        gaps = F.zip_with(
            F.concat(F.array(zero), F.transform(cuts, lambda c: c["end"])),
            F.concat(F.transform(cuts, lambda c: c["start"]), F.array(size)),
            lambda lo, hi: F.array_join(F.slice(t, (lo + 1).cast("int"), (hi - lo).cast("int")), ""),
        )
        return F.array_join(gaps, "")

    return let(tokens, joined)


def cut_intervals(
    df: DataFrame, cuts: DataFrame, key: str = "doc_id", text: str = "text", tokens=lossless_tokens
) -> DataFrame:
    """``df`` with the cut tokens gone from ``text``; all other columns stay.

    Only affected documents are tokenised; a fully cut one keeps an empty text.
    """
    per_doc = cuts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    stored, small = small_or_none(per_doc)
    joined = df.join(F.broadcast(stored) if small else stored, key, "left")
    shorter = F.when(F.col("_cuts").isNotNull(), kept_text(tokens(F.col(text)), F.col("_cuts"))).otherwise(F.col(text))
    return joined.withColumn(text, shorter).select(*[F.col(f"`{c}`") for c in df.columns])


def reconstruct_documents(
    originals: DataFrame, cut: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Put the cut text of ``cut`` beside all other columns of ``originals``, in place."""
    joined = originals.join(cut.select(key, F.col(text).alias("_cut_text")), key, "left")
    return joined.withColumn(text, F.coalesce("_cut_text", text)).select(*[F.col(f"`{c}`") for c in originals.columns])


def substring_dedup(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    k: int = MIN_TOKENS,
    keep: str = "first",
    tokens=lossless_tokens,
) -> DataFrame:
    """Cut every repeated passage of at least ``k`` tokens, by default all copies but the first."""
    positions = repeated_kgrams(df, key, text, k, keep, tokens)
    return cut_intervals(df, cut_ranges(positions, key, k), key, text, tokens)
