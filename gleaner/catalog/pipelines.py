"""End-to-end queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import query, table
from gleaner.catalog.dedup import components_ctes, edges_sql
from gleaner.catalog.pages import EXTRACT_SQL, lang_ctes, stopwords
from gleaner.catalog.quality import BUCKETS_SQL, SCORES, binned_sql, scored, scores_ctes, thresholds_sql, trained_sql, with_trained_scores
from gleaner.catalog.segments import requests_sql
from gleaner.catalog.substring import cut_sql
from gleaner.catalog.urlpii import FLAGGED_SQL, domains, redacted_sql
from gleaner.operators import quality
from gleaner.operators.langid import train_language_model
from gleaner.operators.metrics import StageMetrics
from gleaner.operators.quality import TRAINED_SCORES
from gleaner.plans import curate
from gleaner.session import scratch_path, spread_small_input
from gleaner.sources import files

_RAW_PAGES_SQL = f"""
SELECT page_id, url, text, code AS language FROM ext JOIN lid USING (page_id) JOIN ({FLAGGED_SQL}) USING (page_id)
WHERE score >= 0.3 AND code IN ('EN', 'DE') AND listed_domain IS NULL
"""


def _exact(source: str, key: str) -> str:
    return f"SELECT * FROM ({source}) QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY {key}) = 1"


@query(
    "curate_pages",
    f"""
    WITH ext AS MATERIALIZED (SELECT e.page_id, e.text FROM ({EXTRACT_SQL}) e),
    {lang_ctes('SELECT page_id, text FROM ext', 'page_id')},
    kept AS ({redacted_sql(f"SELECT page_id, url, text, language FROM ({_RAW_PAGES_SQL.replace('SELECT page_id, url, text,', 'SELECT page_id, url, ext.text,')})", "page_id, url, language")})
    SELECT url, page_id::VARCHAR AS warc_id, 'pages' AS source_id, language, text, 'pages.parquet' AS file_name
    FROM ({_exact("SELECT * FROM kept", "page_id::VARCHAR")})
    """,
)
def curate_pages(spark, sf_dir):
    pages = spread_small_input(table(spark, sf_dir, "pages")).select(
        "url",
        F.col("page_id").cast("string").alias("warc_id"),
        F.lit("pages").alias("source_id"),
        F.col("html").alias("content"),
        F.lit("pages.parquet").alias("file_name"),
    )
    model = train_language_model(spread_small_input(table(spark, sf_dir, "documents")))
    return curate.curate_pages(pages, stopwords(spark, sf_dir), model, domains(spark, sf_dir), ["en", "de"])


_CLEAN_SQL = redacted_sql("SELECT * FROM documents", "doc_id, lang, source, n_chars")
_STAGES_SQL = f"""
clean AS MATERIALIZED ({_CLEAN_SQL}),
exact AS MATERIALIZED ({_exact("SELECT * FROM clean", "doc_id")}),
{components_ctes(edges_sql("SELECT * FROM exact"))},
fuzzy AS MATERIALIZED (SELECT * FROM exact WHERE doc_id NOT IN (SELECT id FROM comp WHERE id <> component)),
cut AS MATERIALIZED ({cut_sql("SELECT * FROM fuzzy")})
"""
_ENGLISH = "SELECT * FROM trained WHERE language = 'EN'"
_CURATED_SQL = f"""
WITH RECURSIVE {_STAGES_SQL}, {scores_ctes("SELECT * FROM cut")}, trained AS MATERIALIZED ({trained_sql("SELECT * FROM cut")})
SELECT * FROM ({binned_sql(_ENGLISH, thresholds_sql(_ENGLISH, TRAINED_SCORES), TRAINED_SCORES)})
"""


def _curated(spark, sf_dir, metrics=None):
    docs = spread_small_input(table(spark, sf_dir, "documents"))
    return curate.curate_documents(docs, with_trained_scores(spark, sf_dir), TRAINED_SCORES, sample_fraction=1.0, metrics=metrics)


@query("curate_documents", _CURATED_SQL)
def curate_documents(spark, sf_dir):
    """Buckets by the three trained scores."""
    return _curated(spark, sf_dir)


def _counted(stage: str, number: int, source: str, redactions: bool = False) -> str:
    more = f" UNION ALL SELECT {number}, '{stage}', 'redactions', sum(pii_count)::DOUBLE FROM {source}" if redactions else ""
    return f"""SELECT {number} AS number, '{stage}' AS stage, 'rows' AS metric, count(*)::DOUBLE AS value FROM {source}
      UNION ALL SELECT {number}, '{stage}', 'text_bytes', sum(strlen(text))::DOUBLE FROM {source}{more}"""


@query(
    "curation_metrics",
    f"WITH RECURSIVE {_STAGES_SQL} "
    + " UNION ALL ".join(
        _counted(stage, i, source, stage == "clean")
        for i, (stage, source) in enumerate([("clean", "clean"), ("exact", "exact"), ("fuzzy", "fuzzy"), ("distinct", "cut"), ("scored", "cut")])
    ),
)
def curation_metrics(spark, sf_dir):
    """What :func:`curate_documents` measured while it ran, read back from its JSON report; seconds differ from run to run."""
    metrics = StageMetrics()
    _curated(spark, sf_dir, metrics)
    path = scratch_path(spark, "metrics")
    metrics.save(spark, path)
    return StageMetrics.load(spark, path).table(spark).filter("metric <> 'seconds'")


_TOP_SQL = f'SELECT doc_id, text FROM ({BUCKETS_SQL}) WHERE "ensemble-max-int" IN (18, 19)'


@query("sdg_requests", requests_sql(_TOP_SQL))
def sdg_requests(spark, sf_dir):
    bucketed = quality.quality_buckets(scored(spark, sf_dir), SCORES, sample_fraction=0.1, file_col="source")
    path = scratch_path(spark, "bucketed")
    files.write_bucketed(bucketed, path)
    top = files.read_buckets(spark, path).select("doc_id", "text")
    return curate.sdg_requests(top, key="doc_id")
