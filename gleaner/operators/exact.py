"""Exact duplicates by text hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.operators.filters import CANONICAL_FIELDS
from gleaner.operators.prefix import row_index
from gleaner.operators.skew import lookup, small_or_none


def assign_ids(df: DataFrame, key: str, out: str = "id") -> DataFrame:
    """``(key, id)``: one dense integer per distinct natural key, in key order."""
    return row_index(df.select(key).distinct(), [key], out)


def text_hash(text: Column) -> Column:
    return F.md5(text)


def exact_dup_ids(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids to remove: all but the lowest of every group of equal texts. A missing text is no copy of another.

    Partial aggregation shrinks a group of any size to one row per input task before
    the shuffle; only hashes that occur twice are joined back, hot ones spread.
    """
    hashed = df.filter(F.col(text).isNotNull()).select(F.col(key), F.unhex(text_hash(F.col(text))).alias("_hash"))
    groups = hashed.groupBy("_hash").agg(F.min(key).alias("_keeper"), F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    return lookup(hashed, groups, "_hash", spread_by=key, size_col="_size").filter(F.col(key) != F.col("_keeper")).select(key)


def remove_by_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id", fields: list[str] | None = None) -> DataFrame:
    """Rows whose id is not in ``ids``, projected to ``fields`` when given.

    The ids are broadcast only when their measured size is small.
    """
    stored, small = small_or_none(ids.select(key))
    kept = df.join(F.broadcast(stored) if small else stored, key, "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in fields]) if fields else kept


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", fields: list[str] | None = None) -> DataFrame:
    return remove_by_ids(df, exact_dup_ids(df, key, text), key, fields)


def run_exact_dedup(
    df: DataFrame,
    ids: DataFrame | None = None,
    identify: bool = False,
    remove: bool = False,
    key: str = "doc_id",
    find=exact_dup_ids,
    fields: list[str] | None = None,
) -> tuple[DataFrame | None, DataFrame | None]:
    """Identify, remove, or both; returns ``(ids, kept)``. Asking for neither is an error."""
    if not identify and not remove:
        raise ValueError("ask for identify, remove, or both")
    if identify:
        ids = find(df, key)
    elif ids is None:
        raise ValueError("removal alone needs the ids found before")
    return ids, remove_by_ids(df, ids, key, fields or CANONICAL_FIELDS) if remove else None


def dup_counts(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``num_duplicates`` found and ``num_duplicates_removed`` from ``df``."""
    found = ids.select(key, F.lit(1).alias("_found"))
    removed = df.select(key, F.lit(1).alias("_here"))
    return found.join(removed, key, "left").agg(
        F.count("_found").alias("num_duplicates"), F.count("_here").alias("num_duplicates_removed")
    )
