"""Exact duplicates: group by a 128-bit content hash, compare the bytes inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.text import column, fresh, squeezed, whole
from gleaner.operators.skew import lookup
from gleaner.session import store


def content_hash(norm: Column) -> Column:
    """16 bytes that stand for a normalised text."""
    return F.unhex(F.md5(norm))


def _digests(docs: DataFrame, id_col: str, text_col: str, hash_of: Callable[[Column], Column]) -> DataFrame:
    return (
        docs.select(column(id_col).alias("id"), F.length(whole(column(text_col))).alias("n"), squeezed(column(text_col)).alias("norm"))
        .select("id", "n", hash_of(F.col("norm")).alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha"))
    )


def _groups(rows: DataFrame) -> DataFrame:
    """One row per repeated hash: its row count and the row that stays (longest text, least id, no id last)."""
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("id").isNull().alias("none"), "id"))
    return rows.groupBy("h").agg(F.count(F.lit(1)).alias("size"), best.alias("best")).filter("size > 1")


def _collided(docs: DataFrame, groups: DataFrame, text_col: str, hash_of: Callable[[Column], Column]) -> DataFrame:
    """Hashes under which different bytes meet.

    The least and the greatest text of a group are equal only if all are. Both are
    aggregated before the shuffle, so a group of any size costs each task one row.
    """
    texts = docs.select(squeezed(column(text_col)).alias("norm")).select("norm", hash_of(F.col("norm")).alias("h"))
    repeated = lookup(texts, groups.select("h", "size"), "h", spread_by="norm", size_col="size")
    return repeated.groupBy("h").agg(F.min("norm").alias("low"), F.max("norm").alias("high")).filter("low <> high").select("h")


def _grouped(docs: DataFrame, id_col: str, text_col: str, hash_of: Callable[[Column], Column]):
    """``(rows, groups, hash)``: the digests, the repeated hashes, and a hash under which no unlike texts meet."""

    def longer(norm: Column) -> Column:
        return F.concat(hash_of(norm), F.unhex(F.sha2(norm, 256)))

    for safe in (hash_of, longer):
        rows = store(_digests(docs, id_col, text_col, safe), "digests")
        groups = store(_groups(rows), "groups")
        if _collided(docs, groups, text_col, safe).isEmpty():
            return rows, groups, safe
    raise RuntimeError("different texts with equal SHA-256")


def duplicate_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One narrow row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are, blanks deleted. Of equal texts the row with
    the most code points stays, then the least id. ``hash_of`` gives the hash of a
    normalised text; groups are formed by it, then their bytes are compared. If
    different bytes meet anywhere, all is grouped anew by hash and SHA-256 together
    and compared once more.

    Null texts count as empty, so all empty texts are one group. A null id loses
    against any id; in a group without ids ``keep_id`` is null and the longest rows
    stay. Rows repeated with the same id, text and length tie and are all marked as
    kept; :func:`exact_dedup` lets one of them through. An empty table gives an
    empty table; further columns are ignored here.
    """
    rows, groups, _ = _grouped(docs, id_col, text_col, hash_of)
    known = lookup(rows, groups.withColumn("group_size", F.col("size")), "h", spread_by="id", size_col="size", how="left")
    alone = F.col("group_size").isNull()
    return known.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("n") == -F.col("best.less")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rules as in :func:`duplicate_rows`.

    Of wholly repeated rows one stays. Text moves only for the kept rows of repeated
    hashes; their list is broadcast when it is measured to be small, and else joined
    with its hot hashes spread.
    """
    _, groups, safe = _grouped(docs, id_col, text_col, hash_of)
    key, size = fresh(docs, "_hash"), fresh(docs, "_size")
    best, spread = fresh(docs, "_best"), fresh(docs, "_spread")
    out = [column(c) for c in docs.columns]
    keyed = docs.withColumn(key, safe(squeezed(column(text_col)))).withColumn(spread, F.xxhash64(column(id_col)))
    listed = groups.select(F.col("h").alias(key), F.col("size").alias(size), F.col("best").alias(best))
    alone = lookup(keyed, listed.select(key, size), key, spread_by=spread, size_col=size, how="left_anti").select(*out)
    first = column(id_col).eqNullSafe(F.col(best)["id"]) & (F.length(whole(column(text_col))) == -F.col(best)["less"])
    firsts = lookup(keyed, listed, key, spread_by=spread, size_col=size).filter(first).dropDuplicates([key])
    return alone.unionByName(firsts.select(*out))
