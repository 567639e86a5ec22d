"""Scores, weighted thresholds and buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import ORACLES, query, table
from gleaner.functions.text import TOKEN
from gleaner.operators import linear, quality as ops, quantiles
from gleaner.session import scratch_path, spread_small_input, store
from gleaner.sources import files

SCORES = ["share-score", "length-score", "cycle-score"]
_WORDS = r"regexp_extract_all(text, '[^ \t\n\r\f]+')"
SCORED_SQL = f"""
SELECT *, strlen(text)::BIGINT AS weight,
  CASE WHEN len({_WORDS}) = 0 THEN 0 ELSE round(len(list_distinct({_WORDS}))::DOUBLE / len({_WORDS}), 6) END AS "share-score",
  round(ln(1 + n_chars), 1) AS "length-score", (n_chars % 997) / 997.0::DOUBLE AS "cycle-score",
  upper(lang) AS language FROM documents
"""


def thresholds_sql(source: str, scores: list[str] = SCORES) -> str:
    melted = " UNION ALL ".join(f"SELECT '{c}' AS score_col, \"{c}\" AS score, weight FROM ({source})" for c in scores)
    return f"""
    SELECT score_col, p::INTEGER AS percentile, min(CASE WHEN cum / total >= p / 100.0::DOUBLE THEN score END) AS threshold
    FROM (SELECT score_col, score, (sum(w) OVER (PARTITION BY score_col ORDER BY score))::DOUBLE AS cum,
            (sum(w) OVER (PARTITION BY score_col))::DOUBLE AS total
          FROM (SELECT score_col, score, sum(weight) AS w FROM ({melted}) GROUP BY ALL)),
      (SELECT unnest(range(5, 100, 5)) AS p)
    GROUP BY score_col, p
    """


def _bin(score: str) -> str:
    return f"(SELECT count(*)::INTEGER FROM th WHERE score_col = '{score}' AND threshold <= s.\"{score}\")"


def binned_sql(source: str, thresholds: str, scores: list[str] = SCORES) -> str:
    bins = ", ".join(f'{_bin(c)} AS "{c}-int"' for c in scores)
    largest = ", ".join(f'"{c}-int"' for c in scores)
    return (
        f"WITH th AS MATERIALIZED ({thresholds}), b AS (SELECT s.*, {bins} FROM ({source}) s) "
        f'SELECT *, greatest({largest}) AS "ensemble-max-int" FROM b'
    )


def with_scores(docs):
    """Three scores both engines compute alike, with many ties."""
    words = F.regexp_extract_all(F.col("text"), F.lit(TOKEN), 0)
    share = F.try_divide(F.size(F.array_distinct(words)).cast("double"), F.size(words))
    return docs.withColumns(
        {
            "weight": quantiles.byte_weight(F.col("text")),
            "share-score": F.round(F.coalesce(share, F.lit(0.0)), 6),
            "length-score": F.round(F.log1p(F.col("n_chars").cast("double")), 1),
            "cycle-score": (F.col("n_chars") % 997) / F.lit(997.0),
            "language": F.upper("lang"),
        }
    )


def scored(spark, sf_dir):
    return with_scores(spread_small_input(table(spark, sf_dir, "documents")))


@query("byte_weight", "SELECT doc_id, strlen(text)::BIGINT AS weight FROM documents")
def byte_weight(spark, sf_dir):
    return spread_small_input(table(spark, sf_dir, "documents")).select("doc_id", quantiles.byte_weight(F.col("text")).alias("weight"))


@query("weighted_percentile", f"SELECT percentile, threshold FROM ({thresholds_sql(SCORED_SQL)}) WHERE score_col = 'share-score'")
def weighted_percentile(spark, sf_dir):
    melted = quantiles.melt_scores(scored(spark, sf_dir), ["share-score"], "weight")
    return quantiles.weighted_percentiles(melted).select("percentile", "threshold")


@query("thresholds_5_95", thresholds_sql(SCORED_SQL))
def thresholds_5_95(spark, sf_dir):
    return quantiles.weighted_percentiles(quantiles.melt_scores(scored(spark, sf_dir), SCORES, "weight"))


_SAMPLE_SQL = """
SELECT * EXCLUDE (nth, n) FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('sample:' || doc_id)) AS nth, count(*) OVER (PARTITION BY source) AS n
  FROM ({source})) WHERE nth <= round_even(0.1::DOUBLE * n, 0)
"""


@query("threshold_sample", f"SELECT source, doc_id, weight FROM ({_SAMPLE_SQL.format(source=SCORED_SQL)})")
def threshold_sample(spark, sf_dir):
    return quantiles.threshold_sample(scored(spark, sf_dir).select("source", "doc_id", "weight"), 0.1, "source")


_BINNED = binned_sql(SCORED_SQL, thresholds_sql(SCORED_SQL))


def _binned(spark, sf_dir):
    df = scored(spark, sf_dir)
    thresholds = quantiles.compute_thresholds(df, SCORES, "weight")
    return ops.map_score_columns(df, SCORES, thresholds)


@query("digitize", f'SELECT doc_id, "share-score", "share-score-int" FROM ({_BINNED})')
def digitize(spark, sf_dir):
    df = scored(spark, sf_dir)
    cuts = quantiles.compute_thresholds(df, ["share-score"], "weight")["share-score"]
    binned = ops.digitize(F.col("`share-score`"), [cuts[p] for p in sorted(cuts)])
    return df.select("doc_id", "share-score", binned.alias("share-score-int"))


@query("map_score_columns", 'SELECT doc_id, "share-score-int", "length-score-int", "cycle-score-int" FROM (' + _BINNED + ")")
def map_score_columns(spark, sf_dir):
    path = scratch_path(spark, "thresholds")
    df = scored(spark, sf_dir)
    quantiles.save_thresholds(spark, quantiles.compute_thresholds(df, SCORES, "weight"), path)
    binned = ops.map_score_columns(df, SCORES, quantiles.load_thresholds(spark, path))
    return binned.select("doc_id", *[f"{c}-int" for c in SCORES])


@query("ensemble_max", f'SELECT doc_id, "ensemble-max-int" FROM ({_BINNED})')
def ensemble_max(spark, sf_dir):
    return ops.ensemble_max(_binned(spark, sf_dir), SCORES).select("doc_id", files.BUCKET_COLUMN)


@query("bucket_distribution", f'SELECT "ensemble-max-int" AS bucket, count(*) AS rows FROM ({_BINNED}) GROUP BY ALL')
def bucket_distribution(spark, sf_dir):
    return ops.bucket_distribution(ops.ensemble_max(_binned(spark, sf_dir), SCORES))


_ENGLISH_SQL = f"SELECT * FROM ({SCORED_SQL}) WHERE language = 'EN'"
BUCKETS_SQL = binned_sql(_ENGLISH_SQL, thresholds_sql(_SAMPLE_SQL.format(source=_ENGLISH_SQL)))


@query("quality_buckets", BUCKETS_SQL)
def quality_buckets(spark, sf_dir):
    return ops.quality_buckets(scored(spark, sf_dir), SCORES, sample_fraction=0.1, file_col="source")


@query(
    "quality_features",
    rf"""
    WITH w AS (SELECT *, {_WORDS} AS words, string_split(text, chr(10)) AS lines FROM documents)
    SELECT doc_id,
      coalesce(round(length(array_to_string(words, ''))::DOUBLE / nullif(len(words), 0), 6), 0) AS mean_word_length,
      coalesce(round(len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{w}'" for w in ops.STOP_WORDS)})))::DOUBLE / nullif(len(words), 0), 6), 0) AS stop_word_ratio,
      coalesce(round(len(regexp_extract_all(text, '[^A-Za-zÀ-ÿ0-9 \t\n\r\f]'))::DOUBLE / nullif(length(text), 0), 6), 0) AS symbol_ratio,
      coalesce(round((len(lines) - len(list_distinct(lines)))::DOUBLE / len(lines), 6), 0) AS duplicate_line_ratio,
      coalesce(round(len(regexp_extract_all(text, '[A-ZÀ-Þ]'))::DOUBLE / nullif(length(text), 0), 6), 0) AS upper_ratio
    FROM w
    """,
)
def quality_features(spark, sf_dir):
    return ops.quality_features(spread_small_input(table(spark, sf_dir, "documents"))).select("doc_id", *ops.FEATURES)


_FEATURES_SQL = ORACLES["quality_features"]
_FOLD = f"(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % {linear.FOLDS})"
_LOGISTIC = "round(1.0::DOUBLE / (1.0::DOUBLE + exp(-({})::DOUBLE)), 6)"


def _gram_ctes(source: str, name: str, grams: str, weight: str, totals: str, sharpness: float) -> str:
    """CTEs ending in ``name(doc_id, score)``: weights of grams for each left-out fold, and the logistic of their mean."""
    return f"""
    {name}_g AS MATERIALIZED (SELECT doc_id, fold, y, unnest({grams}) AS gram FROM (
      SELECT doc_id, {_FOLD} AS fold, y, regexp_extract_all(lower(text), '[^ \\t\\n\\r\\f]+') AS w FROM ({source}) LEFT JOIN lab USING (doc_id))),
    {name}_c AS MATERIALIZED (SELECT gram, fold, y, count(*) AS n FROM {name}_g WHERE y IS NOT NULL GROUP BY ALL),
    {name}_m AS MATERIALIZED (SELECT gram, k, coalesce(sum(n) FILTER (y = 1 AND fold <> k), 0)::BIGINT AS c1, coalesce(sum(n) FILTER (y = 0 AND fold <> k), 0)::BIGINT AS c0
      FROM {name}_c, (SELECT unnest(range({linear.FOLDS})) AS k) GROUP BY gram, k),
    {name}_t AS MATERIALIZED ({totals}),
    {name}_w AS MATERIALIZED (SELECT gram, k, round(({weight}) * {linear.SCALE}, 0)::BIGINT AS weight FROM {name}_m JOIN {name}_t USING (k) WHERE c1 + c0 > 0),
    {name} AS MATERIALIZED (SELECT d.doc_id, {_LOGISTIC.format(f"{sharpness}::DOUBLE * coalesce(s::DOUBLE / known / {linear.SCALE}, 0)")} AS score
      FROM ({source}) d LEFT JOIN (SELECT doc_id, sum(weight) AS s, count(*) AS known FROM {name}_g g JOIN {name}_w w ON w.gram = g.gram AND w.k = g.fold GROUP BY doc_id) USING (doc_id))
    """


def scores_ctes(source: str) -> str:
    """CTEs ending in ``s1``, ``s2`` and ``s3`` (doc_id, score): the three trained scores of ``source(doc_id, text, …)``."""
    folds = f"(SELECT unnest(range({linear.FOLDS})) AS k)"
    odds = "ln((c1 + 1)::DOUBLE / (n1 + grams)) - ln((c0 + 1)::DOUBLE / (n0 + grams))"
    odds_totals = "SELECT k, sum(c1)::BIGINT AS n1, sum(c0)::BIGINT AS n0, count(*) AS grams FROM s1_m GROUP BY k"
    contrast = "ln((n0 + n1 + 1)::DOUBLE / (c1 + c0 + 1)::DOUBLE) * ((c1 + 1)::DOUBLE / (n1 + 2) - (c0 + 1)::DOUBLE / (n0 + 2))"
    contrast_totals = f"""SELECT k, count(*) FILTER (y = 1 AND fold <> k) AS n1, count(*) FILTER (y = 0 AND fold <> k) AS n0
      FROM (SELECT y, {_FOLD} AS fold FROM ({source}) JOIN lab USING (doc_id)), {folds} GROUP BY k"""
    units = ", ".join(f"floor(least({f}, {linear.LARGEST_FEATURE}) * {linear.SCALE})::HUGEINT AS {f}" for f in ops.FEATURES)
    moments = ", ".join(f"sum({f}) FILTER (y = {i} AND fold <> k) AS s{i}_{f}, sum({f} * {f}) FILTER (y = {i} AND fold <> k) AS q{i}_{f}" for f in ops.FEATURES for i in (0, 1))
    terms = []
    for f in ops.FEATURES:
        mean = [f"(s{i}_{f}::DOUBLE / n{i})" for i in (0, 1)]
        spread = f"(((q1_{f}::DOUBLE - s1_{f}::DOUBLE * {mean[1]}) + (q0_{f}::DOUBLE - s0_{f}::DOUBLE * {mean[0]})) / (n0 + n1))"
        terms.append(f"CASE WHEN {spread} > 0 THEN ({mean[1]} - {mean[0]}) / {spread} ELSE 0 END * ({f}::DOUBLE - ({mean[1]} + {mean[0]}) / 2)")
    total = f"CASE WHEN n0 > 0 AND n1 > 0 THEN ln(n1::DOUBLE / n0) + {' + '.join(terms)} ELSE 0 END"
    return f"""
    lab AS MATERIALIZED (SELECT doc_id, min(quality) AS y FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id),
    {_gram_ctes(source, "s1", "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))", odds, odds_totals, ops.NGRAM_SHARPNESS)},
    {_gram_ctes(source, "s2", "list_distinct(w)", contrast, contrast_totals, ops.CONTRAST_SHARPNESS)},
    s3_f AS MATERIALIZED (SELECT doc_id, {_FOLD} AS fold, y, {units} FROM ({_FEATURES_SQL.replace("FROM documents", f"FROM ({source})")}) LEFT JOIN lab USING (doc_id)),
    s3_m AS MATERIALIZED (SELECT k, count(*) FILTER (y = 1 AND fold <> k) AS n1, count(*) FILTER (y = 0 AND fold <> k) AS n0, {moments} FROM s3_f, {folds} GROUP BY k),
    s3 AS MATERIALIZED (SELECT doc_id, {_LOGISTIC.format(total)} AS score FROM s3_f JOIN s3_m ON k = fold)
    """


_DOCS = "SELECT * FROM documents"


def _one_score(i: int) -> str:
    return f"WITH {scores_ctes(_DOCS)} SELECT doc_id, score AS \"{ops.TRAINED_SCORES[i - 1]}\" FROM s{i}"


def _labels(spark, sf_dir):
    return table(spark, sf_dir, "labels")


@query("quality_score_ngram", _one_score(1))
def quality_score_ngram(spark, sf_dir):
    return ops.ngram_scores(spread_small_input(table(spark, sf_dir, "documents")), _labels(spark, sf_dir))


@query("quality_score_edu_a", _one_score(2))
def quality_score_edu_a(spark, sf_dir):
    return ops.contrast_scores(spread_small_input(table(spark, sf_dir, "documents")), _labels(spark, sf_dir))


@query("quality_score_edu_b", _one_score(3))
def quality_score_edu_b(spark, sf_dir):
    return ops.statistics_scores(spread_small_input(table(spark, sf_dir, "documents")), _labels(spark, sf_dir))


def trained_sql(source: str) -> str:
    """``source`` with weight, language and the trained scores; needs the CTEs of :func:`scores_ctes`."""
    scores = ", ".join(f's{i}.score AS "{c}"' for i, c in enumerate(ops.TRAINED_SCORES, 1))
    joins = " ".join(f"JOIN s{i} ON s{i}.doc_id = d.doc_id" for i in (1, 2, 3))
    return f"SELECT d.*, strlen(text)::BIGINT AS weight, upper(lang) AS language, {scores} FROM ({source}) d {joins}"


def with_trained_scores(spark, sf_dir):
    """What a plan scores documents with: weight, language and the trained scores."""

    def score(docs):
        named = docs.withColumns({"weight": quantiles.byte_weight(F.col("text")), "language": F.upper("lang")})
        return ops.trained_scores(named, _labels(spark, sf_dir))

    return score


_TRAINED_ENGLISH = "SELECT * FROM trained WHERE language = 'EN'"


@query(
    "quality_buckets_trained",
    f"""
    WITH {scores_ctes(_DOCS)}, trained AS MATERIALIZED ({trained_sql(_DOCS)})
    SELECT * FROM ({binned_sql(_TRAINED_ENGLISH, thresholds_sql(_SAMPLE_SQL.format(source=_TRAINED_ENGLISH), ops.TRAINED_SCORES), ops.TRAINED_SCORES)})
    """,
)
def quality_buckets_trained(spark, sf_dir):
    docs = with_trained_scores(spark, sf_dir)(spread_small_input(table(spark, sf_dir, "documents")))
    return ops.quality_buckets(store(docs, "scored"), ops.TRAINED_SCORES, sample_fraction=0.1, file_col="source")
