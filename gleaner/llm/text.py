"""What the operators share: blanks, words, joins on nullable keys, worker caches."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions.names import column, fresh  # noqa: F401  (the operators take them from here)
from gleaner.session import bounded_batches  # noqa: F401

#: Blanks of all word and text definitions here: the class [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def squeezed(text: Column) -> Column:
    """The text without its blanks. One plain replacement per blank is faster than a pattern."""
    out = whole(text)
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def words(text: Column) -> Column:
    """Array of the runs of non-blanks; empty for a null or blank text."""
    bare = F.btrim(whole(text), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def id_as_text(id_col: str) -> Column:
    """The id in the form in which it goes through Python: numbers beside nulls would become floating there."""
    return column(id_col).cast("string").alias("doc_id")


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.select(column(id_col)).schema[0].dataType.simpleString()


def once(key: str, make: Callable):
    """``make()``, kept for the life of this Python worker (vocabularies, tables)."""
    kept = sys.__dict__.setdefault("_gleaner_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
