"""Row filters, scores and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import query, table
from gleaner.functions.text import token_count
from gleaner.operators import filters as ops

# Documents with a language field "[0.nn, 'CODE']" made from the columns at hand.
_FIELD_SQL = "concat('[0.', lpad((doc_id % 100)::VARCHAR, 2, '0'), ', ''', upper(lang), ''']')"
_SCORE_SQL = "('0.' || lpad((doc_id % 100)::VARCHAR, 2, '0'))::DOUBLE"


def tagged(spark, sf_dir):
    number = F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0")
    field = F.concat(F.lit("[0."), number, F.lit(", '"), F.upper("lang"), F.lit("']"))
    return table(spark, sf_dir, "documents").withColumn("language", field)


def canonical(spark, sf_dir):
    """Documents under the canonical column names."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.concat(F.lit("warc-"), F.col("doc_id").cast("string")).alias("warc_id"),
        F.col("source").alias("source_id"),
        F.upper("lang").alias("language"),
        "text",
        F.concat("source", F.lit(".jsonl")).alias("file_name"),
        "doc_id",
    )


CANONICAL_SQL = (
    "SELECT 'https://' || source || '.example.org/' || doc_id AS url, 'warc-' || doc_id AS warc_id, source AS source_id, "
    "upper(lang) AS language, text, source || '.jsonl' AS file_name, doc_id FROM documents"
)


@query("parse_language", f"SELECT doc_id, {_FIELD_SQL} AS field, {_SCORE_SQL} AS score, upper(lang) AS language FROM documents")
def parse_language(spark, sf_dir):
    df = tagged(spark, sf_dir).select(
        "doc_id", F.col("language").alias("field"), ops.language_score(F.col("language")).alias("score"), "language"
    )
    return ops.parse_language(df)


@query("language_filter", "SELECT doc_id, upper(lang) AS language FROM documents WHERE upper(lang) IN ('EN', 'DE')")
def language_filter(spark, sf_dir):
    return ops.language_filter(ops.parse_language(tagged(spark, sf_dir)), ["en", "DE"]).select("doc_id", "language")


@query("lang_score_filter", f"SELECT doc_id, {_FIELD_SQL} AS language FROM documents WHERE {_SCORE_SQL} >= 0.3")
def lang_score_filter(spark, sf_dir):
    return ops.language_score_filter(tagged(spark, sf_dir)).select("doc_id", "language")


@query("english_filter", "SELECT doc_id, text FROM documents WHERE upper(lang) = 'EN'")
def english_filter(spark, sf_dir):
    return ops.english_filter(ops.parse_language(tagged(spark, sf_dir))).select("doc_id", "text")


_TOKENS_SQL = r"len(regexp_extract_all(text, '[^ \t\n\r\f]+'))::BIGINT"


@query(
    "score_filter",
    f"SELECT * FROM (SELECT doc_id, {_TOKENS_SQL} AS tokens FROM documents) WHERE tokens BETWEEN 50 AND 500",
)
def score_filter(spark, sf_dir):
    df = ops.score_filter(table(spark, sf_dir, "documents"), token_count(F.col("text")), "tokens", 50, 500)
    return df.select("doc_id", "tokens")


@query("score_only", f"SELECT doc_id, {_TOKENS_SQL} AS tokens FROM documents")
def score_only(spark, sf_dir):
    return ops.score_only(table(spark, sf_dir, "documents"), token_count(F.col("text")), "tokens").select("doc_id", "tokens")


@query("predicate_filter", "SELECT doc_id, n_chars FROM documents WHERE n_chars >= 1000")
def predicate_filter(spark, sf_dir):
    return ops.predicate_filter(table(spark, sf_dir, "documents"), "n_chars", lambda c: c >= 1000).select("doc_id", "n_chars")


@query("modify", "SELECT doc_id, upper(lang) AS lang FROM documents")
def modify(spark, sf_dir):
    return ops.modify(table(spark, sf_dir, "documents"), "lang", F.upper).select("doc_id", "lang")


@query("drop_columns", "SELECT doc_id, lang, source FROM documents")
def drop_columns(spark, sf_dir):
    return ops.drop_columns(table(spark, sf_dir, "documents"), ["text", "n_chars", "no-such-label"])


@query("select_output_fields", f"SELECT url, warc_id, source_id, language, text, file_name FROM ({CANONICAL_SQL})")
def select_output_fields(spark, sf_dir):
    return ops.select_output_fields(canonical(spark, sf_dir))
