"""The curation stages put together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from gleaner.functions.unicode import unicode_cleanup
from gleaner.operators.exact import exact_dedup
from gleaner.operators.extract import with_main_text
from gleaner.operators.filters import language_filter, language_score_filter, parse_language, select_output_fields
from gleaner.operators.fuzzy import fuzzy_dedup
from gleaner.operators.langid import lang_id
from gleaner.operators.metrics import StageMetrics, bytes_of
from gleaner.operators.quality import quality_buckets
from gleaner.operators.requests import Task, requests_for_tasks
from gleaner.operators.substring import substring_dedup
from gleaner.operators.urlpii import redact_pii, url_pii_stage


def curate_pages(
    pages: DataFrame,
    stopwords: DataFrame,
    language_model: DataFrame,
    domains: DataFrame,
    targets: list[str] | None = None,
    metrics: StageMetrics | None = None,
    removed_path: str | None = None,
) -> DataFrame:
    """Raw pages ``(url, warc_id, source_id, content, file_name)`` to canonical documents.

    Extract, identify and filter the language, clean characters, drop listed
    domains, redact, remove exact copies. HTML is read once; only extracted text
    goes through a shuffle. The documents of listed domains are written raw to
    ``removed_path``, where it is given.
    """
    metrics = metrics or StageMetrics()
    docs = with_main_text(pages, stopwords, html="content")
    tagged = parse_language(language_score_filter(lang_id(docs, language_model)))
    clean = language_filter(tagged, targets).withColumn("text", unicode_cleanup(F.col("text")))
    extracted = metrics.store(clean, "extracted", text_bytes=bytes_of("text"))
    kept, removed = url_pii_stage(extracted, domains)
    if removed_path is not None:
        removed.write.parquet(removed_path)
    redacted = metrics.store(kept, "redacted", text_bytes=bytes_of("text"), redactions=F.col("pii_count"))
    return select_output_fields(exact_dedup(redacted, key="warc_id"))


def curate_documents(
    docs: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    score_cols: list[str],
    key: str = "doc_id",
    file_col: str = "source",
    sample_fraction: float = 0.01,
    cut_passages: bool = True,
    metrics: StageMetrics | None = None,
) -> DataFrame:
    """Extracted documents to quality buckets.

    Clean, redact, then exact, near and substring duplicates, then scores and
    buckets. The text is written after exact and after substring removal; the
    passes in between read only the columns they need from those tables. ``metrics``
    gets rows, bytes and seconds of every written stage.
    """
    metrics = metrics or StageMetrics()
    size = {"text_bytes": bytes_of("text")}
    clean = redact_pii(docs.withColumn("text", unicode_cleanup(F.col("text"))))
    clean = metrics.store(clean, "clean", **size, redactions=F.col("pii_count"))
    distinct = fuzzy_dedup(metrics.store(exact_dedup(clean, key), "exact", **size), key)
    if cut_passages:
        distinct = substring_dedup(metrics.store(distinct, "fuzzy", **size), key)
    scored = metrics.store(score(metrics.store(distinct, "distinct", **size)), "scored", **size)
    return quality_buckets(scored, score_cols, sample_fraction=sample_fraction, file_col=file_col, key=key)


def sdg_requests(top_buckets: DataFrame, tasks: list[Task] | None = None, key: str = "id") -> DataFrame:
    """Documents of the best buckets (see ``read_buckets``) as requests for every task."""
    return requests_for_tasks(top_buckets, tasks, key)
