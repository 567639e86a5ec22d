"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.functions.names import fresh
from gleaner.session import cut_lineage

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
SALTS = 64


def stored_bytes(df: DataFrame) -> int:
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + F.lit(16) for f in df.schema.fields),
        start=F.lit(0),
    )
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def small_or_none(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Store ``df``, measure it and say whether it is small enough to broadcast."""
    stored = cut_lineage(df)
    return stored, stored_bytes(stored) <= max_bytes


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: str,
    size_col: str | None = None,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` with ``table`` (one row per ``key``), moving ``rows`` as little as possible.

    A table measured to be small is broadcast, so ``rows`` do not move at all.
    Otherwise see :func:`spread_join`.
    """
    stored, small = small_or_none(table, max_bytes)
    if small:
        drop = [size_col] if size_col else []
        return rows.join(F.broadcast(stored.drop(*drop)), key, how)
    if size_col is None:
        return rows.join(stored, key, how)
    return spread_join(rows, stored, key, size_col, spread_by, how, hot_rows, salts)


def spread_join(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    size_col: str,
    spread_by: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    max_rows: int | None = None,
) -> DataFrame:
    """Join ``rows`` with ``groups`` (one row per ``key``, with its row count in ``size_col``).

    Keys above ``hot_rows`` are salted: their rows spread over at least ``salts`` tasks, and
    over so many that none gets more than about ``hot_rows`` of them; their one group row is
    repeated as often. The hot key list that is broadcast has at most
    ``count(rows) / hot_rows`` entries. ``size_col`` is dropped. Where
    ``rows`` are known to number at most ``max_rows``, no key can exceed that.
    """
    if max_rows is not None and max_rows <= hot_rows:
        return rows.join(groups.drop(size_col), key, how)
    salt, times = fresh(rows, "_salt"), fresh(rows, "_times")
    spread = F.greatest(F.ceil(F.col(size_col) / max(hot_rows, 1)), F.lit(salts)).cast("int")
    hot = groups.filter(F.col(size_col) > hot_rows).select(key, spread.alias(times))
    salted_rows = rows.join(F.broadcast(hot), key, "left").withColumn(
        salt, F.when(F.col(times).isNotNull(), F.pmod(F.xxhash64(spread_by), F.col(times)).cast("int")).otherwise(F.lit(0))
    )
    salted_groups = groups.withColumn(
        salt, F.explode(F.when(F.col(size_col) > hot_rows, F.sequence(F.lit(0), spread - 1)).otherwise(F.array(F.lit(0))))
    ).drop(size_col)
    return salted_rows.drop(times).join(salted_groups, [key, salt], how).drop(salt)


def first_per_group(
    df: DataFrame, group: str, order: list[Column | str], n: int, spread_by: str, salts: int = SALTS
) -> DataFrame:
    """The first ``n`` rows of every group in ``order``.

    Each group is first thinned in ``salts`` independent parts, so one group that
    holds most rows is not sorted in a single task.
    """
    salt, number = fresh(df, "_salt"), fresh(df, "_n")
    part = Window.partitionBy(group, salt).orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn(salt, F.pmod(F.xxhash64(spread_by), F.lit(salts)))
        .withColumn(number, F.row_number().over(part))
        .filter(F.col(number) <= n)
        .withColumn(number, F.row_number().over(whole))
        .filter(F.col(number) <= n)
        .drop(salt, number)
    )
