"""Sources, sinks, files and shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import ORACLES, query, table
from gleaner.functions.text import token_count
from gleaner.operators import layout as ops
from gleaner.session import scratch_path
from gleaner.sources import files, warc

_DOCS_SQL = "SELECT doc_id, text, lang, source, n_chars FROM documents"


@query("read_jsonl", _DOCS_SQL)
def read_jsonl(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "read-jsonl")
    # Three parts, each in as many tasks and files as its size takes.
    files.write_jsonl(docs.withColumn("part", F.col("doc_id") % 3).hint("rebalance", "part"), path)
    # A stray file beside the data must not be read.
    docs.select("text").write.mode("append").text(path)
    return files.read_jsonl(spark, path, docs.schema)


@query("read_parquet", "SELECT doc_id, lang FROM documents")
def read_parquet(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/documents.parquet", ["doc_id", "lang"])


@query("read_paths_list", f"{_DOCS_SQL} WHERE source IN ('src1', 'src2', 'src7')")
def read_paths_list(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "paths-list")
    docs.withColumn("file", F.col("source")).repartition("file").write.partitionBy("file").json(f"{path}/docs")
    written = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/docs").select("path")
    wanted = written.filter(F.regexp_extract("path", "file=([^/]+)/", 1).isin("src1", "src2", "src7"))
    # One relative path per line, with a blank line and blanks around a name.
    lines = wanted.select(F.explode(F.array(F.concat(F.lit("  "), F.regexp_extract("path", "(file=.*)$", 1), F.lit(" ")), F.lit(""))))
    lines.coalesce(1).write.text(f"{path}/list")
    return files.read_paths_list(spark, f"{path}/docs", f"{path}/list", docs.schema)


def _warc_files(spark, sf_dir):
    """Pages as WARC files, next to side files a listing must leave out."""
    pages = table(spark, sf_dir, "pages").repartition(4, "page_id")
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, f"{path}/segment/warc")
    warc.write_warc(pages, f"{path}/segment/robotstxt")
    return path


@query(
    "list_input_files",
    "SELECT page_id % 5 AS part, sum(strlen(url) + 1)::BIGINT AS length FROM pages GROUP BY part ORDER BY part LIMIT 3",
)
def list_input_files(spark, sf_dir):
    """One text file of URLs per part in ``warc``, and side files that must not be listed."""
    urls = table(spark, sf_dir, "pages").select("url", (F.col("page_id") % 5).alias("part"))
    path = scratch_path(spark, "listing")
    urls.repartition("part").write.partitionBy("part").text(f"{path}/warc")
    urls.repartition("part").write.partitionBy("part").text(f"{path}/wet")
    listed = files.list_input_files(spark, path, r"/warc/part=[0-9]+/[^/]*\.txt$", limit=3)
    return listed.select(F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint").alias("part"), "length")


@query(
    "warc_records",
    "SELECT url, page_id::VARCHAR AS warc_id, html AS content FROM pages",
)
def warc_records(spark, sf_dir):
    path = _warc_files(spark, sf_dir)
    return warc.read_warc(spark, f"{path}/segment/warc").select("url", "warc_id", "content")


# A record quoted whole inside a page.
_QUOTED = "<pre>\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n</pre>"
_QUOTED_SQL = "html || CASE WHEN page_id % 7 = 0 THEN '" + _QUOTED.replace("\r\n", "' || chr(13) || chr(10) || '") + "' ELSE '' END"


def _quoting(spark, sf_dir):
    quoted = F.when(F.col("page_id") % 7 == 0, F.lit(_QUOTED)).otherwise(F.lit(""))
    return table(spark, sf_dir, "pages").withColumn("html", F.concat("html", quoted))


@query("warc_plain_records", f"SELECT url, page_id::VARCHAR AS warc_id, {_QUOTED_SQL} AS content FROM pages")
def warc_plain_records(spark, sf_dir):
    """Plain files read in many ranges, with pages that quote whole records."""
    path = scratch_path(spark, "warc-plain")
    warc.write_warc(_quoting(spark, sf_dir).repartition(2, "page_id"), path, "none")
    return warc.read_warc(spark, path, split_bytes=50_000).select("url", "warc_id", "content")


@query(
    "warc_record_limit",
    f"""
    SELECT kind, page_id::VARCHAR AS warc_id, {_QUOTED_SQL} AS content FROM pages, (SELECT unnest(['gzip', 'none']) AS kind)
    QUALIFY row_number() OVER (PARTITION BY kind, page_id % 3 ORDER BY page_id) <= 5
    """,
)
def warc_record_limit(spark, sf_dir):
    """The first five records of each of three files, plain and gzipped; the rest isn't read."""
    parts = _quoting(spark, sf_dir).withColumn("part", F.col("page_id") % 3).repartition(3, "part").sortWithinPartitions("part", "page_id")
    out = []
    for kind in ("gzip", "none"):
        path = scratch_path(spark, f"warc-{kind}")
        lines = parts.select("part", warc.warc_value().alias("value"))
        lines.write.partitionBy("part").option("compression", kind).option("lineSep", "\r\n\r\n").text(path)
        out.append(warc.read_warc(spark, path, limit=5).select(F.lit(kind).alias("kind"), "warc_id", "content"))
    return out[0].unionByName(out[1])


@query(
    "record_limit",
    "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 7",
)
def record_limit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id")
    return ops.record_limit(docs, 7, file_col="source", order="doc_id")


@query("file_name_column", "SELECT doc_id, 'documents.parquet' AS file_name FROM documents")
def file_name_column(spark, sf_dir):
    return files.with_file_name(table(spark, sf_dir, "documents")).select("doc_id", "file_name")


@query("write_jsonl", _DOCS_SQL)
def write_jsonl(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "write-jsonl")
    files.write_jsonl(docs, path, compression="gzip")
    return spark.read.schema(docs.schema).json(path)


@query("write_parquet", _DOCS_SQL)
def write_parquet(spark, sf_dir):
    path = scratch_path(spark, "write-parquet")
    files.write_parquet(table(spark, sf_dir, "documents"), path)
    return spark.read.parquet(path)


def _bucketed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "buckets")
    files.write_bucketed(docs.withColumn(files.BUCKET_COLUMN, (F.col("n_chars") % 20).cast("int")), path)
    return path


@query("write_bucketed", 'SELECT doc_id, text, (n_chars % 20)::INTEGER AS "ensemble-max-int" FROM documents')
def write_bucketed(spark, sf_dir):
    return spark.read.parquet(_bucketed(spark, sf_dir)).select("doc_id", "text", files.BUCKET_COLUMN)


@query(
    "read_buckets",
    'SELECT doc_id, (n_chars % 20)::INTEGER AS "ensemble-max-int" FROM documents WHERE n_chars % 20 IN (18, 19)',
)
def read_buckets(spark, sf_dir):
    return files.read_buckets(spark, _bucketed(spark, sf_dir)).select("doc_id", files.BUCKET_COLUMN)


@query(
    "kept_and_removed",
    "SELECT doc_id, text, CASE WHEN source IN ('src3', 'src5') THEN 'removed' ELSE 'kept' END AS side FROM documents",
)
def kept_and_removed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    kept, removed = ops.kept_and_removed(docs, docs.filter(F.col("source").isin("src3", "src5")), "doc_id")
    return (
        kept.withColumn("side", F.lit("kept")).unionByName(removed.withColumn("side", F.lit("removed"))).drop("source")
    )


_LIMIT = 40_000


@query(
    "reshard_by_size",
    f"""
    WITH sized AS (SELECT source, doc_id, strlen(text) + 1 AS row_bytes FROM documents),
    marked AS (SELECT *, row_bytes > {_LIMIT // 8} AS own FROM sized),
    before AS (
      SELECT source, doc_id, row_bytes, own,
        coalesce(sum(CASE WHEN own THEN 0 ELSE row_bytes END) OVER w, 0) AS small,
        coalesce(sum(CASE WHEN own THEN 1 ELSE 0 END) OVER w, 0) AS owns
      FROM marked
      WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    )
    SELECT source, doc_id, row_bytes::BIGINT AS row_bytes,
      (floor(small / {_LIMIT - _LIMIT // 8}) + 2 * owns + CASE WHEN own THEN 1 ELSE 0 END)::BIGINT AS part
    FROM before
    """,
)
def reshard_by_size(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    size = (F.octet_length("text") + 1).cast("bigint")
    return ops.size_parts(docs, _LIMIT, "source", ["doc_id"], size)


# What a row may take as a JSON line: two bytes for each of its text, and the rest.
_ROW_BOUND = "2 * {} + 200"
_RESHARD_SQL = ORACLES["reshard_by_size"].replace("strlen(text) + 1 AS row_bytes", _ROW_BOUND.format("strlen(text)") + " AS row_bytes")


@query(
    "resharded_files",
    f"SELECT source AS file, part::INTEGER AS part, 1::BIGINT AS files, count(*) AS rows, true AS within_limit, true AS in_order FROM ({_RESHARD_SQL}) GROUP BY ALL",
)
def resharded_files(spark, sf_dir):
    """Written files read back: none above the limit, rows in their order."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    path = scratch_path(spark, "resharded")
    ops.write_resharded(docs, path, _LIMIT, "source", ["doc_id"], size=(2 * F.octet_length("text") + 200).cast("bigint"))
    schema = "doc_id bigint, text string, source string, part int"
    return ops.written_parts(spark, path, "source", "doc_id", schema, _LIMIT).drop("bytes")


_FILES_SQL = (
    "SELECT source || '/' || lang AS path, sum(strlen(text))::BIGINT AS length FROM documents GROUP BY ALL"
)


def file_table(spark, sf_dir):
    """One row per (source, language), with its bytes, standing in for a file listing."""
    return (
        table(spark, sf_dir, "documents")
        .groupBy(F.concat_ws("/", "source", "lang").alias("path"))
        .agg(F.sum(F.octet_length("text")).cast("bigint").alias("length"))
    )


_SHARDED_SQL = f"SELECT *, (row_number() OVER (ORDER BY path) - 1) % 7 AS shard_id FROM ({_FILES_SQL})"


@query("shard_stride", f"SELECT path, length FROM ({_SHARDED_SQL}) WHERE shard_id = 3")
def shard_stride(spark, sf_dir):
    return ops.shard_stride(file_table(spark, sf_dir), 3, 7)


@query(
    "shard_manifest",
    f"SELECT shard_id::BIGINT AS shard_id, count(*) AS files, sum(length)::BIGINT AS bytes FROM ({_SHARDED_SQL}) GROUP BY ROLLUP (shard_id)",
)
def shard_manifest(spark, sf_dir):
    return ops.shard_manifest(ops.shard_of_files(file_table(spark, sf_dir), 7))


@query(
    "invert_layout",
    "SELECT doc_id, text, lang AS task, source AS shard FROM documents WHERE NOT (lang = 'en' AND source = 'src1')",
)
def invert_layout(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("task"), F.col("source").alias("shard"))
    path = scratch_path(spark, "inverted")
    docs.write.partitionBy("shard", "task").parquet(f"{path}/by-shard")
    done = docs.filter("task = 'en' AND shard = 'src1'").select("task", "shard")
    ops.invert_layout(spark.read.parquet(f"{path}/by-shard"), f"{path}/by-task", done=done)
    return spark.read.parquet(f"{path}/by-task")


@query(
    "resume_pending",
    "SELECT DISTINCT source AS shard, lang AS task FROM documents d WHERE NOT EXISTS ("
    "SELECT 1 FROM documents o WHERE o.source = d.source AND o.lang = d.lang AND o.n_chars > 8000)",
)
def resume_pending(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("shard"), F.col("lang").alias("task"), "n_chars")
    done = docs.filter("n_chars > 8000").select("shard", "task").distinct()
    return ops.resume_pending(docs.select("shard", "task").distinct(), done, ["shard", "task"])


@query(
    "file_id_map",
    "SELECT path, row_number() OVER (ORDER BY path) - 1 AS file_id FROM (SELECT DISTINCT source || '/' || lang AS path FROM documents)",
)
def file_id_map(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "lang").alias("path"))
    return ops.file_id_map(docs)


@query(
    "stage_metrics",
    r"""
    WITH m AS (
      SELECT source AS stage, unnest(['chars', 'tokens']) AS metric,
        unnest([n_chars, len(regexp_extract_all(text, '[^ \t\n\r\f]+'))]) AS value FROM documents)
    SELECT stage, metric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
      sum(value)::BIGINT AS total
    FROM m GROUP BY ALL
    """,
)
def stage_metrics(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    metrics = docs.select(
        F.col("source").alias("stage"),
        F.stack(F.lit(2), F.lit("chars"), F.col("n_chars"), F.lit("tokens"), token_count(F.col("text"))).alias("metric", "value"),
    )
    return ops.stage_metrics(metrics)


@query("csv_report", "SELECT source, count(*) AS docs, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY source")
def csv_report(spark, sf_dir):
    report = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"))
    path = scratch_path(spark, "report")
    files.write_csv_report(report.orderBy("source"), path)
    return spark.read.schema("source string, docs bigint, chars bigint").option("header", True).csv(path)
