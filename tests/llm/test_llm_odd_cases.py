"""Each operator on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest
from llm_helpers import ODD, table
from pyspark.sql import functions as F

from gleaner.llm import archives, attribution, bpe, disclosure, exact, mixing, near, neighbours, postings, rules, toxicity
from gleaner.llm.queries import tokenizer_path

LABELS = "doc_id long, quality int, toxic int"


def labels(spark, rows=((1, 1, 0), (2, None, None), (None, 1, 1), (3, 1, 1), (3, 0, 1), (8, 0, 0), (10, 1, 0), (12, 0, 1), (99, 1, 1))):
    return spark.createDataFrame(list(rows), LABELS)


def sections(docs):
    return attribution.attribute(docs, tokenizer_path(), *attribution.line_sections(F.col("text"))).filter("section = -1")


ROWS = {
    "toxicity": lambda s, d: toxicity.toxicity_rows(d, labels(s)),
    "toxicity without labels": lambda s, d: toxicity.toxicity_rows(d, labels(s, ())),
    "mixing": lambda s, d: mixing.mix_rows(d),
    "warc": lambda s, d: archives.archive_round_trip(d, "doc_id", "source", "text"),
    "exact": lambda s, d: exact.duplicate_rows(d),
    "near": lambda s, d: near.near_duplicate_rows(d),
    "rules": lambda s, d: rules.rule_rows(d, labels(s)),
    "rules without labels": lambda s, d: rules.rule_rows(d, labels(s, ())),
    "sections": lambda s, d: sections(d),
    "bpe": lambda s, d: bpe.encode_rows(d, tokenizer_path()),
    "neighbours": lambda s, d: neighbours.quality_rows(d, labels(s)),
    "neighbours without labels": lambda s, d: neighbours.quality_rows(d, labels(s, ())),
    "disclosure": lambda s, d: disclosure.digest_rows(d),
    "sanitise": lambda s, d: disclosure.sanitise(d),
    "postings": lambda s, d: postings.digest_rows(d, s.createDataFrame([(1, "the lazy dog"), (None, "one")], "item_id long, text string")),
    "ids": lambda s, d: bpe.token_ids(d, tokenizer_path()),
}


@pytest.mark.parametrize("name", ROWS)
def test_one_row_per_document(spark, name):
    rows = ROWS[name](spark, table(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    given = sorted(str(r[0]) for r in ODD)
    key = "page_id" if name == "warc" else "doc_id"
    assert sorted(str(r[key]) for r in rows) == given


@pytest.mark.parametrize("name", ROWS)
def test_empty_table(spark, name):
    assert ROWS[name](spark, table(spark, [], 1)).count() == 0


FILTERS = {
    "rules": lambda s, d: rules.rule_filter(d, labels(s)),
    "exact": lambda s, d: exact.exact_dedup(d),
    "near": lambda s, d: near.near_dedup(d),
    "mixing": lambda s, d: mixing.mix(d),
}


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_all_columns(spark, name):
    docs = table(spark, ODD)
    out = FILTERS[name](spark, docs)
    assert out.schema.fieldNames() == docs.schema.fieldNames()
    given = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in out.collect()} <= given
    assert FILTERS[name](spark, docs.limit(0)).count() == 0


CLASHING = [
    "_copies", "_below", "_skey", "_hash", "_n", "_copy", "_cut_symbols", "_strata", "_first", "_lang_key", "_own_last", "_pool_last",
    "_id", "_sha", "_one", "_row_key", "_salt", "_hot", "stratum", "first", "lang_key", "sha", "task", "hub", "last",
]


@pytest.mark.parametrize("name", FILTERS)
def test_columns_called_like_helpers(spark, name):
    """Columns of the caller keep their values, whatever they are called."""
    docs = table(spark, ODD).withColumns({c: F.lit("mine") for c in CLASHING})
    out = FILTERS[name](spark, docs)
    assert out.schema.fieldNames() == docs.schema.fieldNames()
    rows = out.select(*CLASHING).distinct().collect()
    assert [set(r) for r in rows] == [{"mine"}]
    assert out.count() == FILTERS[name](spark, table(spark, ODD)).count()
