"""Readers and writers for JSONL, Parquet and CSV."""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gleaner.session import bounded_batches, cut_lineage

BUCKET_COLUMN = "ensemble-max-int"
TOP_BUCKETS = [18, 19]
JSON_FILES = "*.{json,jsonl,json.gz,jsonl.gz,json.zst,jsonl.zst,json.bz2,jsonl.bz2}"


# As Spark names folders: what is escaped in a value, and the folder of nulls and empty values.
_ESCAPED = "[\\x01-\\x1f\"#%'*/:=?\\\\\\x7f{\\[\\]^]"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Bytes of lines a task reads before it passes them on.
_READ_BYTES = 4_000_000


def file_system(path: str):
    """Arrow's file system of ``path`` and the path in it; an error where Arrow knows none."""
    from pyarrow import fs

    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def arrow_path(spark: SparkSession, path: str) -> str | None:
    """``path`` with its scheme, if Arrow can open it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = named.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(named).toString()
    try:
        file_system(whole)
    except Exception:  # noqa: BLE001  (Arrow raises many kinds: no such scheme, no library for it)
        return None
    return whole


def partition_folder(name: str, value: str | None) -> str:
    """``name=value`` as Spark writes it."""
    escape = lambda text: re.sub(_ESCAPED, lambda m: f"%{ord(m[0]):02X}", text)
    return f"{escape(name)}={escape(value) if value else NO_VALUE}"


def partition_value(folder: str) -> str | None:
    """The value in a folder's name, null for the folder of nulls and empty values."""
    value = folder.partition("=")[2]
    return None if value == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)


def _hidden(name: str) -> bool:
    """Whether Spark leaves out files and folders of this name."""
    return name[0] == "." or (name[0] == "_" and "=" not in name)


def _lines_written(base: str, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes ``line`` to one file per folder; rows of a folder come together. A file gets its name when it is whole,
    the same name in every attempt of a task, so another attempt only puts the same file there again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(base)
        task = TaskContext.get().partitionId()
        last, out, begun, named, files = None, None, "", "", 0

        def finish() -> int:
            if out is None:
                return 0
            out.close()
            system.move(begun, named)
            return 1

        for batch in batches:
            *values, lines = batch.columns
            for i, key in enumerate(zip(*[v.to_pylist() for v in values])):
                if key != last:
                    files += finish()
                    last = key
                    folder = "/".join([root, *map(partition_folder, names, key)])
                    system.create_dir(folder, recursive=True)
                    begun = f"{folder}/.part-{uuid.uuid4().hex}"
                    # Nulls share their folder with two other values.
                    named = f"{folder}/part-{task:05d}{''.join({'': 'e', NO_VALUE: 'd'}.get(v, '') for v in key)}.json"
                    out = system.open_output_stream(begun)
                out.write(lines[i].as_buffer())
                out.write(b"\n")
        files += finish()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return run


def write_json_folders(df: DataFrame, path: str, folders: list[str]) -> None:
    """``df`` as JSON lines in folders by the columns ``folders``, as ``df.write.partitionBy(*folders).json(path)``, but
    through Arrow where it can: Hadoop's local file system starts a process for every folder and file it makes.

    Rows of a folder must lie together in one partition, which gives it one file.
    """
    spark = df.sparkSession
    base = arrow_path(spark, path)
    if base is None:
        return df.write.partitionBy(*folders).json(path)
    system, root = file_system(base)
    if system.get_file_info(root).type.name != "NotFound":
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {base} already exists.")
    system.create_dir(root, recursive=True)
    bounded_batches(spark)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in folders]
    line = F.to_json(F.struct(*rest)).alias("line")
    lines = df.select(*[F.col(f"`{c}`").cast("string").alias(f"value{i}") for i, c in enumerate(folders)], line)
    lines.mapInArrow(_lines_written(base, folders), "files bigint").agg(F.sum("files")).collect()
    system.open_output_stream(f"{root}/_SUCCESS").close()


def _listed(base: str, depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = file_system(base)
        for batch in batches:
            for top in batch.column(0).to_pylist():
                found = [f for f in system.get_file_info(fs.FileSelector(f"{root}/{top}", recursive=True)) if f.is_file]
                names = [f.path[len(root) :].strip("/").split("/") for f in found]
                kept = [(f, n) for f, n in zip(found, names) if len(n) == depth + 1 and not any(map(_hidden, n))]
                columns = [pa.array([partition_value(n[i]) for _, n in kept], pa.string()) for i in range(depth)]
                sizes = pa.array([f.size for f, _ in kept], pa.int64())
                columns += [pa.array([f.path for f, _ in kept], pa.string()), sizes]
                yield pa.RecordBatch.from_arrays(columns, names=[*[f"value{i}" for i in range(depth)], "path", "size"])

    return run


def _lines_read(base: str, values: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [*values, "path", "size", "number", "line"]
    types = [*[pa.string()] * (len(values) + 1), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(base)
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

        for listed in batches:
            for row in zip(*[listed.column(c).to_pylist() for c in names[:-2]]):
                with system.open_input_stream(row[-2]) as file:
                    data = file.read()
                held += [(*row, i, line) for i, line in enumerate(data.split(b"\n")) if line.strip()]
                size += len(data)
                if held and size >= _READ_BYTES:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()

    return run


def read_json_folders(spark: SparkSession, path: str, depth: int) -> DataFrame | None:
    """The lines of the files of :func:`write_json_folders`: the folders' values as strings ``value0, value1, …``, then
    ``path, size, number, line``, where ``number`` rises within a file. Folders are listed in at most two tasks a core.
    None where Arrow can't open ``path``.
    """
    base = arrow_path(spark, path)
    if base is None:
        return None
    from pyarrow import fs

    system, root = file_system(base)
    # One name for each value of the first column, held on the driver.
    tops = [f.base_name for f in system.get_file_info(fs.FileSelector(root)) if not f.is_file and not _hidden(f.base_name)]
    values = [f"value{i}" for i in range(depth)]
    cores = spark.sparkContext.defaultParallelism
    spread = spark.createDataFrame([(t,) for t in tops], "top string").repartition(max(1, min(len(tops), 2 * cores)))
    kinds = ", ".join(f"{v} string" for v in [*values, "path"])
    files = cut_lineage(spread.mapInArrow(_listed(base, depth), f"{kinds}, size bigint"))
    total = files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(2 * cores, total // (8 * _READ_BYTES))
    bounded_batches(spark)
    lines = files.repartition(tasks).mapInArrow(_lines_read(base, values), f"{kinds}, size bigint, number bigint, line binary")
    return lines.withColumn("line", F.col("line").cast("string"))


def read_jsonl(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """All ``.jsonl``/``.json`` files below ``path``, compressed or not, with a given schema; others are left alone."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", JSON_FILES).json(path)


def read_parquet(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def read_paths_list(
    spark: SparkSession, base: str, paths_file: str | None, schema: StructType, fmt: str = "json"
) -> DataFrame:
    """Only the files named in ``paths_file`` (one per line, relative to ``base``); no list reads all.

    The list holds file names, which Spark keeps on the driver for any scan.
    """
    reader = spark.read.schema(schema).format(fmt)
    if paths_file is None:
        if fmt == "json":
            return read_jsonl(spark, base, schema)
        return reader.option("recursiveFileLookup", True).load(base)
    names = [r[0].strip() for r in spark.read.text(paths_file).collect() if r[0].strip()]
    if not names:
        return spark.createDataFrame([], schema)
    return reader.load([f"{base.rstrip('/')}/{n}" for n in names])


def list_input_files(
    spark: SparkSession, base: str, path_regex: str = r"/warc/[^/]*\.warc\.gz$", limit: int | None = None
) -> DataFrame:
    """``(path, length)`` of the files below ``base``, in path order; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(base)
        .select("path", "length")
        .filter(F.col("path").rlike(path_regex))
        .orderBy("path")
    )
    return files if limit is None else files.limit(limit)


def with_file_name(df: DataFrame, column: str = "file_name") -> DataFrame:
    """Add the name of the file each row was read from."""
    return df.withColumn(column, F.col("_metadata.file_name"))


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.option("compression", compression).json(path)


def write_parquet(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.option("compression", compression).parquet(path)


def write_bucketed(df: DataFrame, path: str, column: str = BUCKET_COLUMN, rebalance: bool = False) -> None:
    """Overwrite ``path`` with one folder per value of ``column``.

    Every writing task may add a file to several buckets. ``rebalance`` shuffles
    by bucket first for fewer and larger files; adaptive execution then splits a
    bucket that holds a large share of the rows.
    """
    out = df.hint("rebalance", F.col(f"`{column}`")) if rebalance else df
    out.write.mode("overwrite").partitionBy(column).parquet(path)


def read_buckets(
    spark: SparkSession, path: str, buckets: list[int] | None = None, column: str = BUCKET_COLUMN
) -> DataFrame:
    """Only the named bucket folders; a missing one warns, none at all is an error."""
    wanted = buckets or TOP_BUCKETS
    df = spark.read.parquet(path)
    found = {r[0] for r in df.filter(F.col(f"`{column}`").isin(wanted)).select(F.col(f"`{column}`")).distinct().collect()}
    missing = sorted(set(wanted) - found)
    if not found:
        raise FileNotFoundError(f"no bucket of {wanted} under {path}")
    if missing:
        warnings.warn(f"buckets not found under {path}: {missing}", stacklevel=2)
    return df.filter(F.col(f"`{column}`").isin(wanted))


def write_csv_report(df: DataFrame, path: str) -> None:
    """One CSV file with a header; for reports, which have one row per shard."""
    df.coalesce(1).write.option("header", True).csv(path)
