"""Session set-up for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "12g", app: str = "gleaner") -> SparkSession:
    """A single-machine session; a cluster brings its own settings instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session that names none (tests, a laptop) gets a temporary folder;
    on a cluster that is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gleaner-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably and go on from the stored copy (survives lost executors)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read it back.

    For wide stages that later steps read in part: columns are pruned on reading.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Bound what goes to a Python worker at once by rows and bytes, where the session has Spark's own bounds."""
    for name, plain, value in (("maxRecordsPerBatch", "10000", "1000"), ("maxBytesPerBatch", "67108864b", "8m")):
        name = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(name, plain) == plain:
            spark.conf.set(name, value)


def spread_small_input(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than cores over all cores.

    A scan of many files keeps its splits: there the check makes this a no-op.
    Meant for scans only, since asking a shuffled frame for its partitions runs it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df
