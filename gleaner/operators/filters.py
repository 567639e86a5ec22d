"""Row filters, score columns and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The columns a document keeps through every dedup stage.
CANONICAL_FIELDS = ["url", "warc_id", "source_id", "language", "text", "file_name"]
# Fixed value: the form of a language field, "[0.95, 'EN']".
LANGUAGE_FIELD = r"\['?([0-9.eE+-]+)'?, *'([^']*)'\]"
MIN_LANGUAGE_SCORE = 0.3


def language_score(field: Column) -> Column:
    return F.regexp_extract(field, LANGUAGE_FIELD, 1).try_cast("double")


def language_code(field: Column) -> Column:
    return F.regexp_extract(field, LANGUAGE_FIELD, 2)


def parse_language(df: DataFrame, column: str = "language") -> DataFrame:
    """Replace the ``"[score, 'CODE']"`` literal by its code."""
    return df.withColumn(column, language_code(F.col(column)))


def language_filter(df: DataFrame, targets: list[str] | None, column: str = "language") -> DataFrame:
    """Keep the target languages. Targets are upper-cased, the data is not; no targets keep all."""
    if not targets:
        return df
    return df.filter(F.col(column).isin([t.upper() for t in targets]))


def language_score_filter(df: DataFrame, column: str = "language", minimum: float = MIN_LANGUAGE_SCORE) -> DataFrame:
    return df.filter(language_score(F.col(column)) >= minimum)


def english_filter(df: DataFrame, column: str = "language") -> DataFrame:
    return df.filter(F.col(column) == "EN")


def score_only(df: DataFrame, score: Column, score_field: str) -> DataFrame:
    """Add a score column and keep every row."""
    return df.withColumn(score_field, score)


def score_filter(
    df: DataFrame, score: Column, score_field: str, minimum: float | None = None, maximum: float | None = None
) -> DataFrame:
    """Add a score column and keep the rows inside the (inclusive) bounds.

    The score passes through a filtered one-element array that is exploded, so
    it is computed once; the optimizer would compute a plain filter's score twice.
    """
    if (minimum is None and maximum is None) or score_field in df.columns:
        out = df.withColumn(score_field, score)
        out = out if minimum is None else out.filter(F.col(score_field) >= minimum)
        return out if maximum is None else out.filter(F.col(score_field) <= maximum)

    def inside(value: Column) -> Column:
        low = F.lit(True) if minimum is None else value >= minimum
        return low if maximum is None else low & (value <= maximum)

    return df.select("*", F.explode(F.filter(F.array(score), inside)).alias(score_field))


def predicate_filter(df: DataFrame, field: str, keep) -> DataFrame:
    """Keep rows for which ``keep(column)`` holds."""
    return df.filter(keep(F.col(f"`{field}`")))


def modify(df: DataFrame, field: str, change) -> DataFrame:
    """Replace a column by ``change(column)``."""
    return df.withColumn(field, change(F.col(f"`{field}`")))


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*columns)


def select_output_fields(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in fields or CANONICAL_FIELDS])
