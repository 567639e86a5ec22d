"""Bounded samples of labelled documents, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.text import column


def remainder(id_col: Column, parts: int) -> Column:
    """CRC-32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, per_class: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, label`` for at most ``per_class`` documents of each class.

    Rows whose remainder is ``held`` are never used. Ids are taken in the order of a
    hash, so the sample doesn't depend on the order of rows; contradicting or null
    labels are left out. Of several texts of one id the one with the least MD5 is taken.
    Only the chosen ids are broadcast: their number is bounded.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & column(label).isNotNull() & (remainder(F.col("doc_id"), parts) != held))
        .groupBy("doc_id")
        .agg(F.min(column(label)).alias("label"), F.max(column(label)).alias("most"))
        .filter("label = most")
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )
    chosen = None
    for value in (0, 1):
        some = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").withColumn("h", F.md5(F.coalesce("text", F.lit(""))))
    least = F.min(F.struct("h", "text", "label")).alias("least")
    return found.groupBy("doc_id").agg(least).select("doc_id", "least.text", "least.label")


def labelled_share(labels: DataFrame, label: str, parts: int, held: int) -> float:
    """Share of class 1 among all label rows that may be learned from."""
    return labels.filter(column(label).isNotNull() & (remainder(F.col("doc_id"), parts) != held)).agg(F.avg(column(label))).first()[0]
