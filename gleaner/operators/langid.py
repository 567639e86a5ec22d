"""Language of a text by its character trigrams (naive Bayes)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions.names import all_columns, column, fresh
from gleaner.functions.text import ngrams
from gleaner.operators.skew import first_per_group, spread_join
from gleaner.session import bounded_batches, cut_lineage, store

# Fixed value: the scale that makes log probabilities whole numbers.
SCALE = 10_000
#: A model of so many (language, trigram) rows is sent to the tasks; a larger one meets the texts in a join.
MODEL_ROWS = 2_000_000
# Characters a task counts the trigrams of at a time.
_LOT = 1_000_000


def _lots(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, list[str]]]:
    """``(lang, texts)`` with about ``_LOT`` characters, or what a batch has of a language."""
    for frame in frames:
        for lang, texts in frame.groupby("lang", dropna=False)["text"]:
            held, size = [], 0
            for text in texts:
                held.append(text)
                size += len(text)
                if size >= _LOT:
                    yield (None if pd.isna(lang) else lang), held
                    held, size = [], 0
            if held:
                yield (None if pd.isna(lang) else lang), held


def _trigrams(texts: list[str]) -> pd.DataFrame:
    """``gram, n``: the trigrams of some texts, none across two of them."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        # Of numbers, as pandas takes empty lists for, Arrow would make no plain array of strings.
        return pd.DataFrame({"gram": np.empty(0, object), "n": np.empty(0, np.int64)})
    inside = np.ones(len(codes), dtype=bool)
    ends = np.cumsum([len(t) for t in texts])
    inside[np.maximum(ends - 1, 0)] = inside[np.maximum(ends - 2, 0)] = False
    keys, n = np.unique(_key(np.stack([codes[:-2], codes[1:-1], codes[2:]]))[inside[:-2]], return_counts=True)
    points = np.stack([keys >> np.uint64(42), (keys >> np.uint64(21)) & np.uint64(2**21 - 1), keys & np.uint64(2**21 - 1)], axis=1)
    joined = points.astype("<u4").tobytes().decode("utf-32-le")
    return pd.DataFrame({"gram": [joined[i : i + 3] for i in range(0, len(joined), 3)], "n": n})


def trigram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, gram, n)`` of the lower-cased texts. Tasks count lots of texts first, so no row is made per character."""
    bounded_batches(docs.sparkSession)
    lowered = docs.select(F.col(lang).alias("lang"), F.lower(F.col(text)).alias("text")).filter("text is not null")

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, texts in _lots(frames):
            found = _trigrams(texts)
            found.insert(0, "lang", pd.Series([name] * len(found), dtype=object))
            yield found

    parts = lowered.mapInPandas(counted, "lang string, gram string, n bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train_language_model(
    docs: DataFrame, text: str = "text", lang: str = "lang", top: int | None = None
) -> DataFrame:
    """``(lang, gram, weight)`` from labelled text; a NULL gram holds the weight of unseen ones.

    Weights are scaled, rounded log probabilities with add-one smoothing. The table has all grams of
    all languages, seen from every language; with ``top`` only the most frequent of each language.
    """
    counts = cut_lineage(trigram_counts(docs, text, lang))
    best = counts if top is None else first_per_group(counts, "lang", [F.desc("n"), "gram"], top, spread_by="gram")
    vocabulary = cut_lineage(best.select("gram").distinct())
    size = vocabulary.count()
    kept = counts.join(vocabulary, "gram")
    # One total per language, held on the driver and repeated in each gram's row.
    totals = {r["lang"]: r["total"] for r in kept.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    languages = F.array(
        *[F.struct(F.lit(name).alias("lang"), F.lit(total).alias("total")) for name, total in sorted(totals.items())]
    )
    unseen = docs.sparkSession.range(1).select(F.lit(None).cast("string").alias("gram"))
    cells = vocabulary.union(unseen).select("gram", F.explode(languages).alias("l")).select("l.*", "gram")
    log_p = F.log((F.coalesce("n", F.lit(0)) + 1).cast("double") / (F.col("total") + F.lit(size + 1)))
    return cells.join(kept, ["lang", "gram"], "left").select(
        "lang", "gram", F.round(log_p * SCALE, 0).cast("bigint").alias("weight")
    )


def _key(grams: np.ndarray) -> np.ndarray:
    """Three code points of 21 bits as one number."""
    return (grams[0] << np.uint64(42)) | (grams[1] << np.uint64(21)) | grams[2]


def language_scorer(model: DataFrame):
    """A Column function giving ``(code, score)``; ties go to the first code, a null text has neither.

    The model is collected; :func:`lang_id` does so only if it is measured to be small.
    """
    table = model.toPandas()
    wide = table[table.gram.notna()].pivot(index="gram", columns="lang", values="weight").sort_index(axis=1)
    rest = table[table.gram.isna()].set_index("lang").weight
    langs = list(wide.columns)
    points = np.array([np.frombuffer(g.encode("utf-32-le"), np.uint32) for g in wide.index], dtype=np.uint64).T
    keys = _key(points)
    order = np.argsort(keys)
    keys = keys[order]
    weights = np.vstack([wide.to_numpy()[order], rest[langs].to_numpy()]).astype(np.int64)

    @F.pandas_udf("struct<code: string, score: double>")
    def score(texts: pd.Series) -> pd.DataFrame:
        codes, scores = [], []
        for text in texts:
            if text is None:
                codes.append(None)
                scores.append(None)
                continue
            c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
            sums = np.zeros(len(langs), dtype=np.int64)
            if len(c) >= 3:
                grams = _key(np.stack([c[:-2], c[1:-1], c[2:]]))
                at = np.searchsorted(keys, grams)
                at[at == len(keys)] = 0
                at[keys[at] != grams] = len(keys)
                sums = np.bincount(at, minlength=len(keys) + 1) @ weights
            best = int(sums.argmax())
            codes.append(langs[best].upper())
            scores.append(round(float(1.0 / np.exp((sums - sums[best]) / SCALE).sum()), 6))
        return pd.DataFrame({"code": pd.Series(codes, dtype=object), "score": pd.Series(scores, dtype="float64")})

    return lambda text: score(F.lower(text))


def lang_id(df: DataFrame, model: DataFrame, text: str = "text", out: str = "language", max_rows: int = MODEL_ROWS) -> DataFrame:
    """Add ``out`` as the literal ``"[score, 'CODE']"``."""
    lang = fresh(df, "_lang")
    model = cut_lineage(model)
    if model.count() <= max_rows:
        scored = df.withColumn(lang, language_scorer(model)(column(text)))
    else:
        scored = _joined_scores(df, model, text, lang)
    field = language_field(F.col(f"{lang}.score"), F.col(f"{lang}.code"))
    return scored.withColumn(out, field).drop(lang)


def _joined_scores(df: DataFrame, model: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the struct ``out`` of code and score, by one row per trigram and document.

    Trigrams of a document are counted before they move; a trigram of very many documents is spread.
    """
    rest = {r["lang"]: r["weight"] for r in model.filter("gram is null").collect()}  # one row per language
    langs = sorted(rest)
    number = fresh(df, "_number")
    numbered = store(df.withColumn(number, F.monotonically_increasing_id()), "numbered")
    grams = numbered.select(F.col(number).alias("number"), F.explode(ngrams(F.lower(column(text)), 3)).alias("gram"))
    counted = store(grams.groupBy("number", "gram").agg(F.count(F.lit(1)).alias("c")), "document-grams")
    weight = lambda name: F.max(F.when(F.col("lang") == name, F.col("weight")))
    wide = model.filter("gram is not null").groupBy("gram").agg(*[weight(name).alias(f"w{i}") for i, name in enumerate(langs)])
    sizes = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("size"))
    met = spread_join(counted, sizes.join(wide, "gram", "left"), "gram", "size", spread_by="number")
    sums = met.groupBy("number").agg(
        *[F.sum(F.col("c") * F.coalesce(F.col(f"w{i}"), F.lit(rest[name]))).alias(f"s{i}") for i, name in enumerate(langs)]
    )
    scores = [F.coalesce(F.col(f"s{i}"), F.lit(0)) for i in range(len(langs))]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    code = F.coalesce(*[F.when(s == top, F.lit(name.upper())) for s, name in zip(scores, langs)])
    share = sum((F.exp((s - top) / F.lit(float(SCALE))) for s in scores), start=F.lit(0.0))
    found = F.struct(code.alias("code"), F.round(1.0 / share, 6).alias("score"))
    joined = numbered.join(sums.withColumnRenamed("number", number), number, "left")
    told = joined.withColumn(out, F.when(column(text).isNotNull(), found))
    return told.select(*all_columns(df), out)


def language_field(score: Column, code: Column) -> Column:
    return F.concat(F.lit("["), score.cast("string"), F.lit(", '"), code, F.lit("']"))
