"""Quality scores, bins and buckets."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleaner.functions.names import fresh
from gleaner.functions.text import TOKEN
from gleaner.operators import linear
from gleaner.operators.filters import english_filter
from gleaner.operators.quantiles import byte_weight, compute_thresholds, threshold_sample
from gleaner.operators.skew import lookup
from gleaner.session import bounded_batches, store
from gleaner.sources.files import BUCKET_COLUMN

# Very frequent words of the languages at hand, for the stop-word share.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "der", "die", "und", "le", "la", "de", "et", "el", "que", "y"]

FEATURES = ["mean_word_length", "stop_word_ratio", "symbol_ratio", "duplicate_line_ratio", "upper_ratio"]


_BLANKS = " \t\n\r\f"
_COUNTS = ["words", "word_chars", "stops", "symbols", "uppers", "chars", "lines", "distinct_lines"]


def _code_table(pattern: str) -> np.ndarray:
    """Whether each of the first 256 characters matches; the last entry stands for all others."""
    return np.array([bool(re.fullmatch(pattern, chr(c))) for c in range(257)])


_SYMBOLS = _code_table(f"[^A-Za-zÀ-ÿ0-9{_BLANKS}]")
_UPPERS = _code_table("[A-ZÀ-Þ]")


def _text_counts(text: str) -> tuple[int, ...]:
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 256)
    symbols, uppers = np.count_nonzero(_SYMBOLS[codes]), np.count_nonzero(_UPPERS[codes])
    spaced = text.lower()
    for c in _BLANKS[1:]:
        spaced = spaced.replace(c, " ")
    pieces = spaced.split(" ")
    words = len(pieces) - pieces.count("")
    blanks = sum(text.count(c) for c in _BLANKS)
    lines = text.split("\n")
    return words, len(text) - blanks, sum(map(_STOP_SET.__contains__, pieces)), symbols, uppers, len(text), len(lines), len(set(lines))


_STOP_SET = frozenset(STOP_WORDS)


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS]))
def _counted(texts: pd.Series) -> pd.DataFrame:
    """Counts of texts as UTF-8 bytes; a null text has none."""
    rows = [(None,) * len(_COUNTS) if t is None else _text_counts(t.decode("utf-8", "replace")) for t in texts]
    return pd.DataFrame(rows, columns=_COUNTS, dtype="Int64")


def quality_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Add text statistics, each rounded to 6 places; an empty text gives zeros.

    A text is counted once, in Python: patterns and lambdas over each word took twenty times as long.
    """
    bounded_batches(df.sparkSession)
    held = fresh(df, "_counted")
    counted = df.withColumn(held, _counted(F.col(text).cast("binary")))

    def share(part: Column, whole: str) -> Column:
        return F.round(F.coalesce(F.try_divide(part.cast("double"), n(whole).cast("double")), F.lit(0.0)), 6)

    n = lambda name: F.col(f"{held}.{name}")
    return counted.withColumns(
        {
            "mean_word_length": share(n("word_chars"), "words"),
            "stop_word_ratio": share(n("stops"), "words"),
            "symbol_ratio": share(n("symbols"), "chars"),
            "duplicate_line_ratio": share(n("lines") - n("distinct_lines"), "lines"),
            "upper_ratio": share(n("uppers"), "chars"),
        }
    ).drop(held)


def ngram_model(buckets: int = 1 << 16) -> Pipeline:
    """A linear model on hashed words and word pairs."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="_words", pattern=TOKEN, gaps=False),
            NGram(n=2, inputCol="_words", outputCol="_pairs"),
            SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _grams FROM __THIS__"),
            HashingTF(inputCol="_grams", outputCol="features", numFeatures=buckets),
            LogisticRegression(labelCol="quality", regParam=0.01, maxIter=20),
        ]
    )


def tfidf_model(buckets: int = 1 << 14) -> Pipeline:
    """A linear model on TF-IDF weights of hashed words."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="_words", pattern=TOKEN, gaps=False),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=buckets),
            IDF(inputCol="_tf", outputCol="features"),
            LogisticRegression(labelCol="quality", regParam=0.01, maxIter=20),
        ]
    )


def statistics_model() -> Pipeline:
    """A linear model on :data:`FEATURES`; its input comes from :func:`quality_features`."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features"),
            LogisticRegression(labelCol="quality", regParam=0.001, maxIter=50),
        ]
    )


def model_score(df: DataFrame, model: PipelineModel, score_field: str) -> DataFrame:
    """Add the probability of high quality as ``score_field``, keep every row and the other columns."""
    scored = model.transform(df).withColumn(score_field, vector_to_array("probability")[1])
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{score_field}`"))


# Names of the trained scores, and how sharply a mean weight tells.
TRAINED_SCORES = ["quality-score-ngram", "quality-score-edu-a", "quality-score-edu-b"]
NGRAM_SHARPNESS = 8.0
CONTRAST_SHARPNESS = 40.0


def ngram_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", out: str = TRAINED_SCORES[0]) -> DataFrame:
    """``(key, out)``: log odds of words and word pairs, cross-fitted on the labelled documents."""
    grams = linear.hashed_words_and_pairs(F.col(text))
    model = linear.log_odds(linear.gram_counts(linear.labelled(docs.select(key, text), labels, "quality", key), grams))
    return linear.gram_scores(docs, key, grams, model, NGRAM_SHARPNESS, out)


def contrast_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", out: str = TRAINED_SCORES[1]) -> DataFrame:
    """``(key, out)``: rare words that good documents hold more often than bad ones, cross-fitted."""
    grams = linear.hashed_distinct_words(F.col(text))
    rows = linear.labelled(docs.select(key, text), labels, "quality", key)
    model = linear.rarity_contrast(linear.gram_counts(rows, grams), rows)
    return linear.gram_scores(docs, key, grams, model, CONTRAST_SHARPNESS, out)


def statistics_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", out: str = TRAINED_SCORES[2]) -> DataFrame:
    """``(key, out)``: a linear discriminant on :data:`FEATURES`, cross-fitted."""
    # Texts are read once; both the model and the scores are made of the stored figures.
    featured = store(quality_features(docs.select(key, text), text).select(key, *FEATURES), "features")
    model = linear.statistics_model(linear.labelled(featured, labels, "quality", key), FEATURES)
    return featured.select(key, linear.statistics_score(model, F.col(key), FEATURES).alias(out))


def trained_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the three trained scores; ids are unique. Scores are narrow tables until they meet the documents."""
    parts = [store(make(docs, labels, key, text), "scores") for make in (ngram_scores, contrast_scores, statistics_scores)]
    return lookup(docs, reduce(lambda a, b: a.join(b, key), parts), key, spread_by=key, how="left")


def digitize(score: Column, thresholds: list[float]) -> Column:
    """Number of thresholds at or below the score; thresholds may tie.

    A missing score, NaN or null, is above all; it takes no part in finding thresholds.
    """
    above = [F.when(score.isNull() | (score >= F.lit(float(t))), 1).otherwise(0) for t in thresholds]
    return reduce(lambda a, b: a + b, above, F.lit(0)).cast("int")


def map_score_columns(df: DataFrame, score_cols: list[str], thresholds: dict[str, dict[int, float]]) -> DataFrame:
    """Add ``<score>-int`` for every score column."""
    bins = {}
    for name in score_cols:
        if not thresholds.get(name):
            raise ValueError(f"no thresholds for score column '{name}'")
        cuts = [t for _, t in sorted(thresholds[name].items(), key=lambda pt: int(pt[0]))]
        bins[f"{name}-int"] = digitize(F.col(f"`{name}`"), cuts)
    return df.withColumns(bins)


def ensemble_max(df: DataFrame, score_cols: list[str], out: str = BUCKET_COLUMN) -> DataFrame:
    """Add the largest of the int bins of a row."""
    bins = [F.col(f"`{c}-int`") for c in score_cols]
    return df.withColumn(out, bins[0] if len(bins) == 1 else F.greatest(*bins))


def bucket_distribution(df: DataFrame, column: str = BUCKET_COLUMN) -> DataFrame:
    return df.groupBy(F.col(f"`{column}`").alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def quality_buckets(
    scored: DataFrame,
    score_cols: list[str],
    text: str = "text",
    sample_fraction: float = 0.01,
    file_col: str = "file_name",
    key: str = "doc_id",
    language: str | None = "language",
) -> DataFrame:
    """English documents with int bins and the ensemble bucket.

    Two passes: thresholds from (a sample of) scores and byte weights, where no
    text moves; then bins in place against 19 constants per score.
    """
    english = english_filter(scored, language) if language else scored
    sampled = english.select(
        *dict.fromkeys([key, *([file_col] if sample_fraction < 1.0 else [])]),
        *[F.col(f"`{c}`") for c in score_cols],
        byte_weight(F.col(text)).alias("_weight"),
    )
    if sample_fraction < 1.0:
        sampled = threshold_sample(sampled, sample_fraction, file_col, key)
    thresholds = compute_thresholds(sampled, score_cols, "_weight")
    return ensemble_max(map_score_columns(english, score_cols, thresholds), score_cols)
