"""Character and line statistics of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions.text import newline_count


def file_char_stats(df: DataFrame, file_col: str = "path", text: str = "text") -> DataFrame:
    """Per file: rows, sums, extremes of the character length, and newline counts."""
    length = F.length(text).cast("bigint")
    lines = newline_count(F.col(text))
    return df.groupBy(file_col).agg(
        F.count(text).alias("n"),
        F.sum(length).alias("sum"),
        F.sum((length * length).cast("decimal(38,0)")).cast("decimal(38,0)").alias("sumsq"),
        F.min(length).alias("min"),
        F.max(length).alias("max"),
        F.sum(lines).alias("sum_lines"),
        F.max(lines).alias("max_lines"),
    )


def _merged() -> list[Column]:
    n = F.sum("n")
    mean = F.try_divide(F.sum("sum"), n)
    variance = F.greatest(F.try_divide(F.sum("sumsq").cast("double"), n) - mean * mean, F.lit(0.0))
    filled = F.col("n") > 0
    zero = F.lit(0)
    return [
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(n, zero).cast("bigint").alias("n"),
        F.round(F.coalesce(mean, F.lit(0.0)), 6).alias("mean"),
        F.round(F.coalesce(F.sqrt(variance), F.lit(0.0)), 6).alias("std"),
        F.coalesce(F.min(F.when(filled, F.col("min"))), zero).cast("bigint").alias("min"),
        F.coalesce(F.max(F.when(filled, F.col("max"))), zero).cast("bigint").alias("max"),
        F.round(F.coalesce(F.try_divide(F.sum("sum_lines"), n), F.lit(0.0)), 6).alias("mean_lines"),
        F.coalesce(F.max(F.when(filled, F.col("max_lines"))), zero).cast("bigint").alias("max_lines"),
    ]


def shard_char_stats(file_stats: DataFrame, shard_col: str = "shard_id") -> DataFrame:
    """Merge file statistics per shard; the deviation is that of the whole population."""
    return file_stats.groupBy(shard_col).agg(*_merged())


def global_char_stats(file_stats: DataFrame) -> DataFrame:
    return file_stats.agg(*_merged())


def top_shards_by_lines(shard_stats: DataFrame, n: int) -> DataFrame:
    """The ``n`` shards with the longest document in lines."""
    return shard_stats.orderBy(F.desc("max_lines"), F.asc("shard_id")).limit(n)


# Fixed value: units in steps of 1024.
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]


def human_size(size: Column) -> Column:
    """Bytes as ``1.3 GiB``; PiB is the largest unit."""
    out = F.format_string("%.1f PiB", F.bround(size / F.lit(float(1024**5)), 1))
    for power in reversed(range(len(SIZE_UNITS) - 1)):
        text = F.format_string(f"%.1f {SIZE_UNITS[power]}", F.bround(size / F.lit(float(1024**power)), 1))
        out = F.when(size < F.lit(1024 ** (power + 1)), text).otherwise(out)
    return out
