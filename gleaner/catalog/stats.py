"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import query, table
from gleaner.operators import layout, stats as ops

_FILE_SQL = """
SELECT source || '/' || lang AS path, count(text) AS n, sum(length(text))::BIGINT AS sum,
  sum(length(text)::BIGINT * length(text))::DECIMAL(38,0) AS sumsq,
  min(length(text))::BIGINT AS min, max(length(text))::BIGINT AS max,
  sum(length(text) - length(replace(text, chr(10), '')))::BIGINT AS sum_lines,
  max(length(text) - length(replace(text, chr(10), '')))::BIGINT AS max_lines
FROM documents GROUP BY ALL
"""
_MERGED_SQL = """
  count(*) AS n_files, sum(n)::BIGINT AS n, round(sum(sum) / sum(n), 6) AS mean,
  round(sqrt(greatest(sum(sumsq)::DOUBLE / sum(n) - (sum(sum) / sum(n)) * (sum(sum) / sum(n)), 0)), 6) AS std,
  min(min) AS min, max(max) AS max, round(sum(sum_lines) / sum(n), 6) AS mean_lines, max(max_lines) AS max_lines
"""
_SHARD_SQL = f"""
SELECT shard_id, {_MERGED_SQL}
FROM (SELECT *, ((row_number() OVER (ORDER BY path) - 1) % 9)::BIGINT AS shard_id FROM ({_FILE_SQL})) GROUP BY shard_id
"""


def _files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("path", F.concat_ws("/", "source", "lang"))
    return ops.file_char_stats(docs)


def _shards(spark, sf_dir):
    return ops.shard_char_stats(layout.shard_of_files(_files(spark, sf_dir), 9))


@query("file_char_stats", _FILE_SQL)
def file_char_stats(spark, sf_dir):
    return _files(spark, sf_dir)


@query("shard_char_stats", _SHARD_SQL)
def shard_char_stats(spark, sf_dir):
    return _shards(spark, sf_dir)


@query("global_char_stats", f"SELECT {_MERGED_SQL} FROM ({_FILE_SQL})")
def global_char_stats(spark, sf_dir):
    return ops.global_char_stats(_files(spark, sf_dir))


@query("top_shards_by_lines", f"SELECT shard_id, max_lines FROM ({_SHARD_SQL}) ORDER BY max_lines DESC, shard_id LIMIT 4")
def top_shards_by_lines(spark, sf_dir):
    return ops.top_shards_by_lines(_shards(spark, sf_dir), 4).select("shard_id", "max_lines")


@query(
    "human_size",
    """
    WITH s AS (SELECT doc_id, strlen(text)::BIGINT * pow(2, 9 * (doc_id % 5))::BIGINT AS size FROM documents)
    SELECT doc_id, size, CASE
      WHEN size < 1024 THEN printf('%.1f B', size::DOUBLE)
      WHEN size < 1048576 THEN printf('%.1f KiB', size / 1024.0::DOUBLE)
      WHEN size < 1073741824 THEN printf('%.1f MiB', size / 1048576.0::DOUBLE)
      WHEN size < 1099511627776 THEN printf('%.1f GiB', size / 1073741824.0::DOUBLE)
      WHEN size < 1125899906842624 THEN printf('%.1f TiB', size / 1099511627776.0::DOUBLE)
      ELSE printf('%.1f PiB', size / 1125899906842624.0::DOUBLE) END AS human FROM s
    """,
)
def human_size(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    size = F.octet_length("text").cast("bigint") * F.pow(F.lit(2.0), 9 * (F.col("doc_id") % 5)).cast("bigint")
    sized = docs.select("doc_id", size.alias("size"))
    return sized.withColumn("human", ops.human_size(F.col("size")))
