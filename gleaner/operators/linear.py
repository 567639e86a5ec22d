"""Linear scores with counted coefficients, cross-fitted.

Labelled documents fall into folds by a hash of their id. The coefficients for a fold
come from the counts of all other folds, so no document is scored by a model that has seen it.
Counts are made once and those of the fold itself taken off, so all folds cost one pass.
The coefficients are a table, one row per gram; applying it is a join and a sum. Grams
stand in all tables as 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleaner.functions.text import TOKEN
from gleaner.operators.skew import BROADCAST_BYTES, lookup
from gleaner.session import bounded_batches, store

# Fixed values.
FOLDS = 5
SCALE = 10_000
LARGEST_FEATURE = 1000.0
# What a gram of a broadcast model takes at most: its hash, five weights, and what Spark's table adds.
_MODEL_ROW = 128
# The hash and weights alone.
_MODEL_BYTES = 80
# Bytes of text that are hashed, and grams that are counted, at a time.
_HASH_LOT = 1 << 16
_COUNT_LOT = 1 << 22


def fold_of(key: Column, folds: int = FOLDS) -> Column:
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def words_and_pairs(text: Column) -> Column:
    w = words(text)
    pairs = F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(w, F.filter(pairs, lambda p: p.isNotNull()))


def labelled(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``label`` 0 or 1 and ``fold``; of several labels of an id the least counts, others are left out."""
    one = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("label"))
    return lookup(docs, one, key, spread_by=key).withColumn("fold", fold_of(F.col(key)))


def _per_fold(n: str, label: int) -> list[Column]:
    """Total of a class, then its share of each fold."""
    of = lambda more: F.coalesce(F.sum(F.when((F.col("label") == label) & more, F.col(n))), F.lit(0))
    return [of(F.lit(True)).alias(f"t{label}"), *[of(F.col("fold") == k).alias(f"t{label}_{k}") for k in range(FOLDS)]]


def _without(label: int, fold: int) -> Column:
    return (F.col(f"t{label}") - F.col(f"t{label}_{fold}")).cast("bigint")


def _hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes are blanks, a random number for each byte, and powers of an odd number and of its inverse."""
    base = 0x9E3779B97F4A7C15
    numbers = np.random.RandomState(7).randint(0, 1 << 32, (2, 256), dtype=np.uint64)
    steps = [np.full(_HASH_LOT + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
    for s in steps:
        s[0] = 1
    blank = np.zeros(256, dtype=bool)
    blank[list(b" \t\n\r\f")] = True
    return blank, (numbers[0] << np.uint64(32)) | numbers[1], np.cumprod(steps[0]), np.cumprod(steps[1])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``text`` (bytes, ending in a blank) begin, and a 64-bit hash of each, from running sums of its bytes.

    Lots end at blanks; a word longer than a lot is hashed by itself.
    """
    blank, numbers, up, down = _hash_tables()
    gaps = blank[text]
    starts = np.flatnonzero(~gaps & np.concatenate([[True], gaps[:-1]]))
    ends = np.flatnonzero(gaps & np.concatenate([[False], ~gaps[:-1]]))
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, first + _HASH_LOT, "right")))
        if ends[to - 1] - first > _HASH_LOT:
            long = text[first : ends[at]]
            out[at] = int.from_bytes(hashlib.blake2b(long.tobytes(), digest_size=8).digest(), "little")
        else:
            lot = text[first : ends[to - 1]]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[lot] * up[: len(lot)], dtype=np.uint64)])
            s, e = starts[at:to] - first, ends[at:to] - first
            out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return starts, _mixed(out)


def _gram_lists(texts: pa.Array, pairs: bool) -> pa.Array:
    """A list of gram hashes for each of the lower-cased texts (bytes): words and pairs, or distinct words."""
    values = [t or b"" for t in texts.to_pylist()]
    ends = np.cumsum([len(v) + 1 for v in values])
    starts, words = word_hashes(np.frombuffer(b" ".join([*values, b""]), np.uint8))
    cuts = np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)
    lists = []
    for low, high in zip(cuts[:-1], cuts[1:]):
        w = words[low:high]
        if pairs:
            w = np.concatenate([w, _mixed(w[:-1] * np.uint64(0xD6E8FEB86659FD93) + w[1:] * np.uint64(0xA0761D6478BD642F) + np.uint64(1))])
        else:
            w = np.unique(w)
        lists.append(w.view(np.int64))
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(w) for w in lists])]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *lists])), mask=texts.is_null())


@F.arrow_udf(T.ArrayType(T.LongType()))
def _word_and_pair_hashes(texts: pa.Array) -> pa.Array:
    return _gram_lists(texts, pairs=True)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _distinct_word_hashes(texts: pa.Array) -> pa.Array:
    return _gram_lists(texts, pairs=False)


def hashed_words_and_pairs(text: Column) -> Column:
    """The grams of :func:`words_and_pairs` as hashes, made of whole batches."""
    return _word_and_pair_hashes(F.lower(text).cast("binary"))


def hashed_distinct_words(text: Column) -> Column:
    """The distinct :func:`words` as hashes, made of whole batches."""
    return _distinct_word_hashes(F.lower(text).cast("binary"))


def _hashed(df: DataFrame, grams: Column) -> Column:
    """``grams`` as hashes; numbers are hashes already."""
    if isinstance(df.select(grams).schema[0].dataType.elementType, T.StringType):
        return F.transform(grams, lambda g: F.xxhash64(g))
    return grams


_CELLS = [f"t{y}_{k}" for y in (1, 0) for k in range(FOLDS)]


def _counted_lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``gram, cell, n``: lots of grams counted by class and fold."""
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        grams, cells = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((cells, grams))
        grams, cells = grams[order], cells[order]
        new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (cells[1:] != cells[:-1])])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(grams)))
        return pa.RecordBatch.from_arrays([pa.array(grams[at]), pa.array(cells[at]), pa.array(n)], names=["gram", "cell", "n"])

    for batch in batches:
        lists, cells = batch.column("grams"), batch.column("cell").to_numpy(zero_copy_only=False)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        grams = lists.flatten().to_numpy(zero_copy_only=False)
        held.append((grams.astype(np.int64), np.repeat(cells.astype(np.int32), lengths)))
        size += len(grams)
        if size >= _COUNT_LOT:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()


def gram_counts(rows: DataFrame, grams: Column) -> DataFrame:
    """``gram`` (its hash) with its occurrences per class, in all and in each fold; ``rows`` have ``label, fold``.

    Tasks count lots of grams first, so no row is made for each; the counts move once.
    """
    bounded_batches(rows.sparkSession)
    cell = (F.when(F.col("label") == 1, 0).otherwise(FOLDS) + F.col("fold")).cast("int").alias("cell")
    listed = rows.select(cell, _hashed(rows, grams).alias("grams"))
    lots = listed.mapInArrow(_counted_lots, "gram bigint, cell int, n bigint").repartition("gram")
    summed = lots.groupBy("gram").agg(
        *[F.coalesce(F.sum(F.when(F.col("cell") == i, F.col("n"))), F.lit(0)).alias(c) for i, c in enumerate(_CELLS)]
    )
    total = lambda y: sum((F.col(f"t{y}_{k}") for k in range(FOLDS)), start=F.lit(0)).cast("bigint").alias(f"t{y}")
    return store(summed.select("gram", total(1), *_CELLS[:FOLDS], total(0), *_CELLS[FOLDS:]), "gram-counts")


def _totals(counts: DataFrame):
    names = [c for c in counts.columns if c != "gram"]
    return counts.agg(F.count(F.lit(1)).alias("grams"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()


def _weights(each) -> Column:
    """One weight per left-out fold; null where the other folds don't hold the gram."""
    return F.array(*[F.when(_without(1, k) + _without(0, k) > 0, F.round(each(k) * SCALE, 0).cast("bigint")) for k in range(FOLDS)])


def _seen() -> Column:
    return (F.col("t1") + F.col("t0")).cast("bigint").alias("seen")


def log_odds(counts: DataFrame) -> DataFrame:
    """``(gram, weights, seen)``: smoothed log odds of a gram between good and bad text, and how often it was seen."""
    t = _totals(counts)

    def odds(k: int) -> Column:
        p = [(_without(i, k) + 1).cast("double") / F.lit(t[f"t{i}"] - t[f"t{i}_{k}"] + t["grams"]) for i in (1, 0)]
        return F.log(p[0]) - F.log(p[1])

    return counts.select("gram", _weights(odds).alias("weights"), _seen())


def rarity_contrast(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """``(gram, weights, seen)``: inverse document frequency times the difference of document shares.

    ``counts`` are of distinct grams per document; ``documents`` have ``label, fold``.
    """
    t = documents.withColumn("n", F.lit(1)).agg(*_per_fold("n", 1), *_per_fold("n", 0)).first()

    def contrast(k: int) -> Column:
        n = [t[f"t{i}"] - t[f"t{i}_{k}"] for i in (0, 1)]
        rare = F.log(F.lit(float(n[0] + n[1] + 1)) / (_without(1, k) + _without(0, k) + 1).cast("double"))
        share = [(_without(i, k) + 1).cast("double") / F.lit(float(n[i] + 2)) for i in (0, 1)]
        return rare * (share[1] - share[0])

    return counts.select("gram", _weights(contrast).alias("weights"), _seen())


def _least_frequent(model: DataFrame, rows: int) -> int:
    """A power of two: at most ``rows`` grams of the model were seen so often."""
    power = F.floor(F.log2(F.col("seen"))).cast("int").alias("power")
    sizes = sorted(model.groupBy(power).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least, taken = 1 << 62, 0
    for r in sizes:
        taken += r["n"]
        if taken > rows:
            break
        least = 1 << r["power"]
    return least


def gram_scores(
    docs: DataFrame, key: str, grams: Column, model: DataFrame, sharpness: float, out: str, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``(key, out)``: the logistic of the mean weight of a document's known grams; one half without any.

    ``model`` is a cheap view of stored counts, read where it is needed. If it is small it is broadcast,
    and sums are made where the document lies. Of a larger one the most frequent grams are, which most
    words of a text belong to; only the others meet their weights by a shuffle.
    """
    # The fold stands below the explode, so it is computed once for a document, not once for a gram.
    bounded_batches(docs.sparkSession)
    listed = docs.select(key, fold_of(F.col(key)).alias("fold"), _hashed(docs, grams).alias("grams"))
    rows = listed.select(key, "fold", F.explode_outer("grams").alias("gram"))
    weight = F.col("weights")[F.col("fold")]
    sums = [F.sum(weight).alias("s"), F.count(weight).alias("known")]
    weights = model.select("gram", "weights")
    # A row has a fixed size, so counting them is enough; measuring would make all weights once more.
    if model.count() * _MODEL_BYTES <= max_bytes:
        summed = rows.join(F.broadcast(weights), "gram", "left").groupBy(key).agg(*sums)
    else:
        least = _least_frequent(model, max_bytes // _MODEL_ROW)
        frequent = F.broadcast(model.filter(F.col("seen") >= least).select("gram", "weights"))
        here = rows.join(frequent, "gram", "left").groupBy(key).agg(*sums)
        others = rows.filter("gram is not null").join(frequent.select("gram"), "gram", "left_anti")
        met = others.join(model.filter(F.col("seen") < least).select("gram", "weights"), "gram")
        there = met.groupBy(key).agg(*sums)
        summed = here.unionByName(there).groupBy(key).agg(F.sum("s").alias("s"), F.sum("known").alias("known"))
    mean = F.coalesce(F.try_divide(F.col("s").cast("double"), F.col("known")) / SCALE, F.lit(0.0))
    return summed.select(key, logistic(sharpness * mean).alias(out))


def logistic(x: Column) -> Column:
    return F.round(1.0 / (1.0 + F.exp(-x)), 6)


def _units(feature: str) -> Column:
    return F.floor(F.least(F.col(feature), F.lit(LARGEST_FEATURE)) * SCALE).cast("bigint")


def statistics_model(rows: DataFrame, features: list[str]) -> dict:
    """``{fold: (offset, [(weight, middle) per feature])}``: a linear discriminant with the pooled spread of each feature.

    ``rows`` have ``label, fold``. What is gathered are two moments per class, fold and feature.
    """
    big = lambda c: c.cast("decimal(20,0)")
    sums = [F.sum(big(_units(f))).alias(f"s_{f}") for f in features] + [F.sum(big(_units(f)) * big(_units(f))).alias(f"q_{f}") for f in features]
    seen = {(r["label"], r["fold"]): r for r in rows.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"), *sums).collect()}
    return {k: _discriminant([[r for (y, f), r in sorted(seen.items()) if y == i and f != k] for i in (0, 1)], features) for k in range(FOLDS)}


def _discriminant(sides: list[list], features: list[str]) -> tuple[float, list[tuple[float, float]]]:
    import math

    n = [sum(r["n"] for r in side) for side in sides]
    if not all(n):
        return 0.0, [(0.0, 0.0)] * len(features)
    terms = []
    for f in features:
        s, q = ([float(sum(int(r[f"{m}_{f}"]) for r in side)) for side in sides] for m in "sq")
        mean = [s[i] / n[i] for i in (0, 1)]
        spread = ((q[1] - s[1] * mean[1]) + (q[0] - s[0] * mean[0])) / (n[0] + n[1])
        terms.append(((mean[1] - mean[0]) / spread if spread > 0 else 0.0, (mean[1] + mean[0]) / 2))
    return math.log(n[1] / n[0]), terms


def statistics_score(model: dict, key: Column, features: list[str]) -> Column:
    """The probability of the good class, by the model without the document's fold."""
    fold = fold_of(key)
    pick = lambda of: F.array(*[F.lit(float(of(model[k]))) for k in range(FOLDS)])[fold]
    total = pick(lambda m: m[0])
    for i, f in enumerate(features):
        total = total + pick(lambda m, i=i: m[1][i][0]) * (_units(f).cast("double") - pick(lambda m, i=i: m[1][i][1]))
    return logistic(total)
