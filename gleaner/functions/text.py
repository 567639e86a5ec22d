"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What counts as one token, and the lossless split into tokens.
TOKEN = r"[^ \t\n\r\f]+"
LOSSLESS_TOKEN = r"^[ \t\n\r\f]+|[^ \t\n\r\f]+[ \t\n\r\f]*"


def token_count(text: Column) -> Column:
    """Number of whitespace-separated tokens."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")


def lossless_tokens(text: Column) -> Column:
    """Tokens with their trailing whitespace; joined they give the text back."""
    return F.regexp_extract_all(text, F.lit(LOSSLESS_TOKEN), 0)


def ngrams(text: Column, n: int) -> Column:
    """All overlapping character n-grams, in one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), 1)


def newline_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).cast("bigint")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, for use inside lambdas."""
    return F.transform(F.array(value), body)[0]


def replace_matches(text: Column, pattern: str, replacement) -> Column:
    """Replace each match by ``replacement(match)``, a Column-to-Column function."""

    def woven(t: Column) -> Column:
        hits = F.transform(F.regexp_extract_all(t, F.lit(pattern), 0), replacement)
        parts = F.zip_with(F.split(t, pattern, -1), hits, lambda part, hit: F.concat(part, F.coalesce(hit, F.lit(""))))
        return F.array_join(parts, "")

    return let(text, woven)
