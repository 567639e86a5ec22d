"""Weighted percentiles by the inverted CDF, computed as a distributed running sum."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gleaner.operators.prefix import running_total
from gleaner.operators.skew import lookup

# The percentiles that bound the 20 bins.
PERCENTILES = list(range(5, 100, 5))


def byte_weight(text: Column) -> Column:
    """Weight of a document: its UTF-8 bytes."""
    return F.octet_length(text).cast("bigint")


def melt_scores(df: DataFrame, score_cols: list[str], weight: str) -> DataFrame:
    """``(score_col, score, weight)``, one row per document and score."""
    pairs = [F.struct(F.lit(c).alias("score_col"), F.col(f"`{c}`").cast("double").alias("score")) for c in score_cols]
    return df.select(F.explode(F.array(*pairs)).alias("s"), F.col(weight).alias("weight")).select("s.*", "weight")


def weighted_percentiles(melted: DataFrame, percentiles: list[int] = PERCENTILES) -> DataFrame:
    """``(score_col, percentile, threshold)``: the least score whose cumulative weight share reaches the percentile.

    Equal scores are summed first, so a score shared by many rows is one row, and
    the running sum restarts per score column over range-partitioned slices.
    """
    summed = melted.filter(F.col("score").isNotNull()).groupBy("score_col", "score").agg(F.sum("weight").alias("_w"))
    cumulative = running_total(summed, F.col("_w"), ["score"], "_cum", within=["score_col"])
    total = cumulative.groupBy("score_col").agg(F.max("_cum").alias("_total"))  # one row per score column
    share = F.try_divide(F.col("_cum").cast("double"), F.col("_total").cast("double"))
    lows = [F.min(F.when(share >= p / 100.0, F.col("score"))).alias(str(p)) for p in percentiles]
    wide = cumulative.join(F.broadcast(total), "score_col").groupBy("score_col").agg(*lows)
    rows = [F.struct(F.lit(p).alias("percentile"), F.col(f"`{p}`").alias("threshold")) for p in percentiles]
    return wide.select("score_col", F.explode(F.array(*rows)).alias("t")).select("score_col", "t.*")


def compute_thresholds(df: DataFrame, score_cols: list[str], weight: str) -> dict[str, dict[int, float]]:
    """``{score column: {percentile: threshold}}``: 19 numbers per column, held on the driver."""
    rows = weighted_percentiles(melt_scores(df, score_cols, weight)).collect()
    out: dict[str, dict[int, float]] = {c: {} for c in score_cols}
    for r in rows:
        out[r["score_col"]][r["percentile"]] = r["threshold"]
    return out


def save_thresholds(spark: SparkSession, thresholds: dict[str, dict[int, float]], path: str) -> None:
    spark.createDataFrame([(json.dumps(thresholds),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_thresholds(spark: SparkSession, path: str) -> dict[str, dict[int, float]]:
    """Thresholds as written; JSON turns the percentiles into strings, they come back as numbers."""
    saved = json.loads(spark.read.option("wholetext", True).text(path).first()[0])
    return {c: {int(p): t for p, t in by.items()} for c, by in saved.items()}


def threshold_sample(
    df: DataFrame, fraction: float, file_col: str = "file_name", key: str = "doc_id", seed: str = "sample"
) -> DataFrame:
    """``round(fraction * rows)`` rows of every file (half to even), by the order of ``md5(seed:key)``.

    The hash is cut into 4096 equal ranges. Counts per range say where a file's
    share ends; only the one range it ends in is ranked, so a file of any size
    is never sorted as a whole.
    """
    if fraction >= 1.0:
        return df
    hashed = df.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))).withColumn(
        "_range", F.substring("_hash", 1, 3)
    )
    counts = hashed.groupBy(file_col, "_range").agg(F.count(F.lit(1)).alias("n"))
    per_file = counts.groupBy(file_col).agg(
        F.array_sort(F.collect_list(F.struct("_range", "n"))).alias("ranges"), F.sum("n").alias("rows")
    )
    want = F.bround(F.lit(fraction) * F.col("rows"), 0).cast("bigint")
    walk = F.aggregate(
        "ranges",
        F.struct(F.lit("").alias("at"), F.lit(0).cast("bigint").alias("rest"), F.col("want").alias("left")),
        lambda acc, r: F.when(
            acc["left"] > 0,
            F.struct(r["_range"].alias("at"), F.least(acc["left"], r["n"]).alias("rest"), (acc["left"] - r["n"]).alias("left")),
        ).otherwise(acc),
    )
    ends = per_file.withColumn("want", want).withColumn("_w", walk).select(
        file_col, F.col("_w.at").alias("_at"), F.col("_w.rest").alias("_rest"), F.col("rows").alias("_file_rows")
    )
    marked = lookup(hashed, ends, file_col, spread_by=key, size_col="_file_rows")
    inside = marked.filter(F.col("_range") < F.col("_at"))
    rank = F.row_number().over(Window.partitionBy(file_col, "_range").orderBy("_hash", key))
    edge = marked.filter(F.col("_range") == F.col("_at")).withColumn("_rank", rank).filter("_rank <= _rest").drop("_rank")
    return inside.unionByName(edge).select(*[F.col(f"`{c}`") for c in df.columns])
