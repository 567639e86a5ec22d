"""Mixing sources to target weights by hash thresholds found in histograms.

Every document has a fixed 60-bit hash. A source's mix is a threshold on it: documents
below are taken. The threshold comes from sums per source and hash bucket; only the
bucket in which the budget runs out is looked at again, in finer buckets, then hash by
hash. Nothing is sorted but histograms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.llm.text import column, fresh, whole, words
from gleaner.operators.prefix import row_index, running_totals
from gleaner.operators.skew import lookup, small_or_none
from gleaner.session import store

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix takes this share of all words; no source and no document more than REPEATS times.
SHARE = 1.5
REPEATS = 2
#: Buckets of the first and of the second histogram; what is left is resolved hash by hash.
BITS = (12, 24)
HASH_BITS = 60


def document_hash(id_col: Column, text_col: Column) -> Column:
    """60 bits of MD5 over id and text: the same in every run, order and cluster."""
    key = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), whole(text_col))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """A key that is never null and keeps null apart from every name."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("none"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Add ``target`` to one row per source (``skey, source, source_size``).

    Resharing the excess over the caps by weight until none is above ends where
    every source has ``min(cap, level * weight)``. Sources are capped in the order of
    cap per weight, so the level follows from running sums in that order. Ranks and
    sums are made over slices, so there may be any number of sources.
    """
    placed = row_index(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = placed.withColumn("weight", weight).withColumn("ratio", F.col("source_size") / F.col("weight"))
    before = {"size_before": F.col("source_size"), "weight_before": F.col("weight").cast("bigint")}
    summed = store(running_totals(ranked, before, ["ratio", "skey"], inclusive=False), "levels")
    whole_sums = summed.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    level = (share * F.col("all_size") - repeats * F.col("size_before")) / (F.col("all_weight") - F.col("weight_before"))
    # The level if just the sources before this one are capped. It rises while they are rightly
    # so, as each gives up some of its share, and falls once one is capped without need.
    greatest = summed.join(F.broadcast(whole_sums)).agg(F.max(level).alias("level"))
    cap = (repeats * F.col("source_size")).cast("double")
    return summed.join(F.broadcast(greatest)).select("skey", "source_size", F.least(cap, F.col("level") * F.col("weight")).alias("target"))


def _boundary(histogram: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Per source the bucket in which the budget ``need`` runs out, and the words ``before`` it."""
    run = Window.partitionBy(*keys).orderBy(bucket)
    summed = histogram.withColumn("upto", F.sum("words").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return summed.filter((F.col("upto") > F.col("need")) & (F.col("upto") - F.col("words") <= F.col("need"))).withColumn(
        "before", F.col("upto") - F.col("words")
    )


def thresholds(rows: DataFrame, goals: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``(skey, copies, below)`` for goals ``(skey, source_size, target)`` over rows ``(skey, size, hash)``.

    A document is taken ``copies`` times, and once more if its hash is under
    ``below``. The budgets are nested: the documents of the second copy are among those
    of the first. The document on the boundary is taken if that brings the source
    nearer to its target; documents with equal hashes share their fate.
    """
    whole_copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = goals.withColumn("copies", F.least(whole_copies, F.lit(repeats)).cast("int")).withColumn(
        "need", F.col("target") - F.col("copies") * F.col("source_size")
    )
    open_goals = goals.filter("need > 0").select("skey", "need")
    found = rows.withColumn("b", F.shiftright("hash", HASH_BITS - BITS[0]))
    sums = found.groupBy("skey", "b").agg(F.sum("size").alias("words"))
    edge = _boundary(sums.join(open_goals, "skey"), ["skey"], "b").select("skey", "need", "b", "before")
    edge, small = small_or_none(edge)
    # Only the boundary bucket of each source is read on.
    inside = found.join(F.broadcast(edge) if small else edge, ["skey", "b"])
    fine = inside.withColumn("c", F.shiftright("hash", HASH_BITS - BITS[1]))
    sums = fine.groupBy("skey", "c").agg(F.sum("size").alias("words"), F.first("need").alias("goal"), F.first("before").alias("start"))
    sums = sums.withColumn("need", F.col("goal") - F.col("start"))
    last = _boundary(sums, ["skey"], "c").select("skey", "c", "need", "before")
    last, small = small_or_none(last)
    single = fine.drop("need", "before").join(F.broadcast(last) if small else last, ["skey", "c"])
    sums = single.groupBy("skey", "hash").agg(F.sum("size").alias("words"), (F.first("need") - F.first("before")).alias("need"))
    at = _boundary(sums, ["skey"], "hash")
    nearer = (F.col("upto") - F.col("need")) < (F.col("need") - F.col("before"))
    below = at.select("skey", F.when(nearer, F.col("hash") + 1).otherwise(F.col("hash")).alias("below"))
    return goals.select("skey", "source_size", "target", "copies").join(below, "skey", "left").withColumn("below", F.coalesce("below", F.lit(0)))


def mix_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One narrow row per document: ``doc_id, size, source_size, target, taken``.

    ``size`` is the number of words, 0 for a null text; ``taken`` the words the mix
    takes from it, repeats counted. A null source is a source of its own and stands
    last. Empty texts have size 0 and are taken zero words, whatever their hash. Rows
    repeated with one id and text have one hash and are taken or left together, so a
    source's error is at most half of its boundary document with its repeats. An
    empty table gives an empty table; further columns are ignored.
    """
    rows = store(
        docs.select(
            column(id_col).alias("doc_id"),
            source_key(column(source_col)).alias("skey"),
            column(source_col).alias("source"),
            F.size(words(column(text_col))).cast("bigint").alias("size"),
            document_hash(column(id_col), column(text_col)).alias("hash"),
        ),
        "sizes",
    )
    cuts = _plan(rows)
    return lookup(rows, cuts, "skey", spread_by="hash", size_col="n").select("doc_id", "size", "source_size", "target", _taken().alias("taken"))


def _plan(rows: DataFrame) -> DataFrame:
    totals = store(rows.groupBy("skey", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sources")
    goals = store(targets(totals), "targets")
    return thresholds(rows, goals).join(totals.select("skey", "n"), "skey")


def _copies() -> Column:
    return F.col("copies") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)


def _taken() -> Column:
    return F.col("size") * _copies()


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed rows of ``docs`` with all their columns: each as often as :func:`mix_rows` takes it.

    Documents that are taken no word leave, which includes empty ones. Texts are not
    shuffled while the table of sources is measured to be small.
    """
    narrow = store(
        docs.select(
            source_key(column(source_col)).alias("skey"),
            column(source_col).alias("source"),
            F.size(words(column(text_col))).cast("bigint").alias("size"),
            document_hash(column(id_col), column(text_col)).alias("hash"),
        ),
        "sizes",
    )
    key, at, copies, below, n = (fresh(docs, name) for name in ("_skey", "_hash", "_copies", "_below", "_n"))
    cuts = _plan(narrow).select(F.col("skey").alias(key), F.col("copies").alias(copies), F.col("below").alias(below), F.col("n").alias(n))
    keyed = docs.withColumns({key: source_key(column(source_col)), at: document_hash(column(id_col), column(text_col))})
    joined = lookup(keyed, cuts, key, spread_by=at, size_col=n)
    times = F.when(F.btrim(whole(column(text_col)), F.lit(" \t\n\x0b\x0c\r")) == "", 0).otherwise(
        F.col(copies) + F.when(F.col(at) < F.col(below), 1).otherwise(0)
    )
    copied = joined.withColumn(fresh(docs, "_copy"), F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
    return copied.select(*[column(c) for c in docs.columns])
