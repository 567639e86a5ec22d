"""Files, shards and partial runs seen as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T

from gleaner.functions.names import fresh
from gleaner.operators.prefix import row_index, running_totals
from gleaner.operators.skew import first_per_group, lookup, small_or_none
from gleaner.sources.files import read_json_folders, write_json_folders


def record_limit(df: DataFrame, n: int, file_col: str = "file_name", order: str = "doc_id", salts: int = 64) -> DataFrame:
    """At most the first ``n`` rows of every file."""
    return first_per_group(df, file_col, [order], n, spread_by=order, salts=salts)


def kept_and_removed(df: DataFrame, removed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Two disjoint frames: rows whose key is not, and is, in ``removed``.

    The rows are flagged by one join, which moves none of them while the keys are
    measured to be few enough to broadcast.
    """
    gone = fresh(df, "_gone")
    flagged = lookup(df, removed.select(key).distinct().withColumn(gone, F.lit(True)), key, spread_by=key, how="left")
    return flagged.filter(F.col(gone).isNull()).drop(gone), flagged.filter(F.col(gone)).drop(gone)


def write_sides(kept: DataFrame, removed: DataFrame, path: str) -> None:
    """Kept and removed documents in trees of their own, each with its own columns."""
    kept.write.parquet(f"{path}/kept")
    removed.write.parquet(f"{path}/removed")


def json_bytes(df: DataFrame) -> Column:
    """Size of a row as one JSON line, the line end included."""
    return (F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + 1).cast("bigint")


def size_parts(
    df: DataFrame, limit: int, file_col: str, order: list[str], size: Column | None = None
) -> DataFrame:
    """``part`` per row: files are cut so that no part exceeds ``limit`` bytes and rows stay whole.

    Rows above an eighth of the limit get a part of their own. The others are
    numbered by the bytes of such rows before them, in steps of seven eighths of
    the limit. Part numbers rise with the order of the rows but may have gaps.
    """
    sized = df.withColumn("row_bytes", size if size is not None else json_bytes(df))
    own = F.col("row_bytes") > limit // 8
    before = running_totals(
        sized.select(file_col, *order, "row_bytes"),
        {
            "_small": F.when(own, F.lit(0)).otherwise(F.col("row_bytes")).cast("bigint"),
            "_own": F.when(own, F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
        },
        order,
        within=[file_col],
        inclusive=False,
    )
    number = F.floor(F.col("_small") / (limit - limit // 8)) + 2 * F.col("_own") + F.when(own, 1).otherwise(0)
    return before.select(file_col, *order, "row_bytes", number.cast("bigint").alias("part"))


def write_resharded(
    df: DataFrame, path: str, limit: int, file_col: str, order: list[str], fmt: str = "json", size: Column | None = None
) -> None:
    """Rewrite every file as ``<file>/part=<n>`` with no part above ``limit`` bytes, as long as no row is.

    ``size`` is what a row may take at most; without it, its bytes as one JSON line.
    """
    parts = size_parts(df, limit, file_col, order, size).drop("row_bytes")
    placed = df.join(parts, [file_col, *order]).repartition(file_col, "part").sortWithinPartitions(file_col, "part", *order)
    if fmt == "json":
        write_json_folders(placed, path, [file_col, "part"])
    else:
        placed.write.partitionBy(file_col, "part").format(fmt).save(path)


def _load_many_folders(reader: DataFrameReader, path: str) -> DataFrame:
    """``reader.load(path)`` with folders listed in a few tasks for each core, where Spark would start one for every folder."""
    spark, name = SparkSession.active(), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        return reader.load(path)
    finally:
        spark.conf.set(name, before)


def written_parts(spark: SparkSession, path: str, file_col: str, order: str, schema, limit: int, fmt: str = "json") -> DataFrame:
    """``(file, part, files, rows, bytes, within_limit, in_order)`` of a tree that :func:`write_resharded` wrote.

    Sizes are those of the files; ``in_order``: rows stand in their file in the order of ``order``, and no part
    before holds a later one. Every part is one file, written by one task.
    """
    lines = read_json_folders(spark, path, 2) if fmt == "json" else None
    if lines is not None:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        place = F.from_json("line", T.StructType([fields[order]]))[order]
        values = [F.col("value0").cast(fields[file_col].dataType).alias("file"), F.col("value1").cast(fields["part"].dataType).alias("part")]
        rows = lines.select(*values, place.alias("place"), "path", "size", "number")
    else:
        read = _load_many_folders(spark.read.schema(schema).format(fmt), path)
        rows = read.select(
            F.col(file_col).alias("file"), "part", F.col(order).alias("place"), F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("number"),
        )
    before = F.lag("place").over(Window.partitionBy("path").orderBy("number"))
    told = rows.withColumn("sorted", F.coalesce(before <= F.col("place"), F.lit(True)))
    parts = told.groupBy("file", "part").agg(
        F.count_distinct("path").alias("files"), F.count(F.lit(1)).alias("rows"), F.max("size").alias("bytes"),
        F.bool_and("sorted").alias("sorted"), F.min("place").alias("low"), F.max("place").alias("high"),
    )
    last = F.max("high").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return parts.withColumn("last", last).select(
        "file", "part", "files", "rows", "bytes", ((F.col("bytes") <= limit) | (F.col("rows") == 1)).alias("within_limit"),
        (F.col("sorted") & F.coalesce(F.col("last") < F.col("low"), F.lit(True))).alias("in_order"),
    )


def shard_of_files(files: DataFrame, num_shards: int, path_col: str = "path") -> DataFrame:
    """Add ``shard_id``: the sorted files are dealt out in turn."""
    if num_shards < 1:
        raise ValueError("num_shards must be at least 1")
    return row_index(files, [path_col], "_n").withColumn("shard_id", F.col("_n") % num_shards).drop("_n")


def shard_stride(files: DataFrame, shard_id: int, num_shards: int, path_col: str = "path") -> DataFrame:
    """The files of one shard."""
    if not 0 <= shard_id < num_shards:
        raise ValueError(f"shard_id must lie in [0, {num_shards})")
    return shard_of_files(files, num_shards, path_col).filter(F.col("shard_id") == shard_id).drop("shard_id")


def shard_manifest(sharded: DataFrame, length_col: str = "length") -> DataFrame:
    """Files and bytes per shard, and the total in a row whose ``shard_id`` is NULL."""
    return sharded.rollup("shard_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum(length_col).cast("bigint").alias("bytes")
    )


def invert_layout(df: DataFrame, path: str, outer: str = "task", inner: str = "shard", done: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as ``outer/inner`` folders, leaving out pairs listed in ``done``; return what was written."""
    todo = df
    if done is not None:
        pairs, small = small_or_none(done.select(outer, inner).distinct())
        todo = df.join(F.broadcast(pairs) if small else pairs, [outer, inner], "left_anti")
    # Rows of a folder meet first, so that not every task writes a file into every folder; large ones are split.
    todo.hint("rebalance", outer, inner).write.mode("append").partitionBy(outer, inner).parquet(path)
    return todo


def resume_pending(planned: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Planned units without a success marker."""
    return planned.join(done.select(*keys), keys, "left_anti")


def file_id_map(df: DataFrame, path_col: str = "path", out: str = "file_id") -> DataFrame:
    """One row per distinct full path with a dense id from 0."""
    return row_index(df.select(path_col).distinct(), [path_col], out)


def stage_metrics(metrics: DataFrame) -> DataFrame:
    """Mean, population deviation and sum of each (stage, metric)."""
    return metrics.groupBy("stage", "metric").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_pop("value"), 6).alias("std"),
        F.sum("value").alias("total"),
    )
