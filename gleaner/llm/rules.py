"""Quality rules whose cutoffs are chosen under a guaranteed rate of false rejection.

Labelled good documents that no rule has seen are the holdout. All cutoffs of all rules
stand in one fixed order, the mildest of each rule first, and are added one by one: what is
tested with the exact binomial tail (Clopper and Pearson) is the share of good documents that
the cutoffs so far reject together. The first failure ends the sequence, so a sequence
needs no correction; strata share the error probability (Bonferroni). With probability
``1 - delta`` every stratum then loses at most ``alpha`` of its good documents to the rules
together. Strata with too few holdouts to prove anything are merged, first within their
language, then over all; how is decided by numbers of holdouts alone, so the bound holds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.llm.text import BLANKS, bound, column, fresh, whole, words
from gleaner.operators.skew import lookup
from gleaner.session import store

ALPHA = 0.02
DELTA = 0.05
BASE_MIN_WORDS = 10
BASE_REPEAT_PERCENT = 20
WINDOW = 5
LONG_TEXT_WORDS = 100

#: Rules: share of a document, and the cutoffs from mild to strict; a share at or above a cutoff rejects.
RULES: dict[str, tuple[float, ...]] = {
    "symbols": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05),
    "duplicate_lines": (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "repeated_words": (0.19, 0.16, 0.13, 0.1, 0.07, 0.05),
    "capitals": (0.9, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2),
    "short_words": (0.6, 0.5, 0.45, 0.4, 0.36, 0.33),
}

#: The fixed order of all (rule, cutoff).
PATH = [(r, steps[i]) for i in range(max(map(len, RULES.values()))) for r, steps in RULES.items() if i < len(steps)]

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(windows: Column) -> Column:
    """Words covered by the windows that occur more than once; ``windows`` holds one hash per window.

    Most texts repeat no window, which the number of distinct hashes shows. Otherwise
    the windows are sorted by hash, those with an equal neighbour are put back into
    text order, and each adds the words up to the next one, at most its own length.
    """

    def neighbours(placed: Column) -> Column:
        pairs = F.zip_with(placed, F.slice(placed, 2, F.size(placed)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return F.array_sort(
            F.array_distinct(
                F.flatten(
                    F.transform(F.filter(pairs, lambda p: p["a"]["h"] == p["b"]["h"]), lambda p: F.array(p["a"]["i"], p["b"]["i"]))
                )
            )
        )

    def covered(starts: Column) -> Column:
        steps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(some, bound(bound(placed, neighbours), covered)).otherwise(F.lit(0))


def with_counts(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """Add the counts the rules use; returns the frame and the name each count got.

    Besides the five of the contract: lines with a word, and capitals A-Z.
    """
    names = {k: fresh(docs, f"_{k}") for k in (*COUNTS, "n_lines", "n_capitals")}
    made = fresh(docs, "_made")

    def windows(w: Column) -> Column:
        hashed = F.transform(w, lambda x: F.xxhash64(x))
        chained = bound(hashed, lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)])))
        return F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(F.slice(chained, 1, F.size(w) - (WINDOW - 1)))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), bound(windows(w), _repeat_words).alias("r")
        )

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("r"))

    t = whole(column(text_col))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counted = docs.withColumn(
        made,
        F.struct(
            bound(words(t), of_words).alias("w"),
            bound(lines, of_lines).alias("l"),
            F.regexp_replace(t, "[^A-Z#*$%&|<>]+", "").alias("marks"),
        ),
    )
    marks, capitals = F.col(f"{made}.marks"), F.length(F.regexp_replace(f"{made}.marks", "[^A-Z]+", ""))
    fields = {
        "n_words": F.col(f"{made}.w.n"), "word_chars": F.col(f"{made}.w.chars"), "n_symbols": F.length(marks) - capitals,
        "n_dup_lines": F.col(f"{made}.l.r"), "n_repeat_words": F.col(f"{made}.w.r"), "n_lines": F.col(f"{made}.l.n"),
        "n_capitals": capitals,
    }
    return counted.withColumns({names[k]: f.cast("bigint") for k, f in fields.items()}).drop(made), names


def _shares(n: dict[str, str]) -> dict[str, Column]:
    c = {k: F.col(v) for k, v in n.items()}
    chars, count, lines = (F.greatest(c[k], F.lit(1)) for k in ("word_chars", "n_words", "n_lines"))
    return {
        "symbols": c["n_symbols"] / chars,
        "duplicate_lines": c["n_dup_lines"] / lines,
        "repeated_words": c["n_repeat_words"] / count,
        "capitals": c["n_capitals"] / chars,
        "short_words": count / chars,
    }


def base_failed(n: dict[str, str]) -> Column:
    count, repeats = F.col(n["n_words"]), F.col(n["n_repeat_words"])
    return (count < BASE_MIN_WORDS) | (100 * repeats > BASE_REPEAT_PERCENT * count)


def language_key(lang: Column) -> Column:
    """Never null; a null language is one of its own."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("none"))


def stratum(n: dict[str, str], lang_key: Column) -> Column:
    """Language and length class."""
    return F.concat_ws("/", lang_key, F.when(F.col(n["n_words"]) < LONG_TEXT_WORDS, "short").otherwise("long"))


def first_step(n: dict[str, str]) -> Column:
    """Number of the first step on :data:`PATH` that rejects a document; null if none does."""
    shares = _shares(n)
    return F.least(*[F.when(shares[r] >= c, F.lit(j)) for j, (r, c) in enumerate(PATH)])


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X binomial with n trials; summed in logarithms, so it cannot underflow."""
    start = n * math.log1p(-p)
    odds = math.log(p) - math.log1p(-p)

    def add(s: Column, j: Column) -> Column:
        term = s["term"] + F.log((n - j + 1) / j) + odds
        top, low = F.greatest(s["sum"], term), F.least(s["sum"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(low - top))).alias("sum"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    first = F.struct(start.cast("double").alias("term"), start.cast("double").alias("sum"))
    return F.exp(F.aggregate(terms, first, add, lambda s: s["sum"]))


def last_steps(held: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``(stratum, last)``: the last step on :data:`PATH` that all tests allow, -1 if none does.

    ``held`` are the holdouts with ``lang_key, stratum, first``. Only their numbers per stratum and
    first rejecting step are looked at, at most ``len(PATH) + 1`` rows a stratum. A stratum
    is kept by its own name if it has holdouts enough for a proof, else it goes into ``<language>/*``,
    and if that has too few, into ``*``, whose row is always there.
    """
    counts = store(held.groupBy("lang_key", "stratum", "first").agg(F.count(F.lit(1)).alias("k")), "holdouts")
    total = lambda over: F.sum("k").over(Window.partitionBy(over))
    leaves = counts.agg(F.greatest(F.count_distinct("stratum"), F.lit(1)).alias("leaves"))
    needed = F.ceil(F.log(F.lit(delta) / F.col("leaves")) / math.log1p(-alpha))
    own = counts.join(F.broadcast(leaves)).withColumn("needed", needed).withColumn("own", total("stratum") >= F.col("needed"))
    pooled = F.sum(F.when(~F.col("own"), F.col("k"))).over(Window.partitionBy("lang_key")) >= F.col("needed")
    named = F.when(F.col("own"), F.col("stratum")).when(pooled, F.concat(F.col("lang_key"), F.lit("/*"))).otherwise(F.lit("*"))
    merged = store(own.withColumn("name", named).groupBy(F.col("name").alias("stratum"), "first").agg(F.sum("k").alias("k")), "strata")
    sizes = merged.groupBy("stratum").agg(F.sum("k").alias("n"))
    level = F.lit(delta) / F.col("strata")
    strata = sizes.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("strata"))
    by_step = Window.partitionBy("stratum").orderBy("first")
    rejected = merged.filter("first is not null").withColumn("upto", F.sum("k").over(by_step))
    tested = rejected.join(F.broadcast(sizes), "stratum").join(F.broadcast(strata))
    # A rejected share of alpha or more can't pass at these levels, so its tail isn't summed.
    tail = F.when(F.col("upto") < F.col("n") * alpha, binomial_tail(F.col("n"), F.col("upto"), alpha)).otherwise(F.lit(1.0))
    fails = tested.withColumn("fails", tail > level).filter("fails").groupBy("stratum").agg(F.min("first").alias("stop"))
    none = binomial_tail(F.col("n"), F.lit(0).cast("bigint"), alpha) > level
    last = F.when(none, F.lit(-1)).otherwise(F.coalesce(F.col("stop") - 1, F.lit(len(PATH) - 1))).cast("int")
    known = sizes.join(F.broadcast(strata)).join(fails, "stratum", "left").select("stratum", last.alias("last"))
    rest = held.sparkSession.range(1).select(F.lit("*").alias("stratum"), F.lit(-1).alias("last"))
    return known.unionByName(rest).groupBy("stratum").agg(F.max("last").alias("last"))


def _verdicts(counted: DataFrame, names: dict[str, str], lasts: DataFrame, lang_key: str, strata: str, first: str) -> tuple[DataFrame, Column, Column]:
    """Join the last step of its stratum to each row; gives the frame and the columns for base_failed and kept."""
    lasts = store(lasts, "last-steps")
    rest = lasts.filter("stratum = '*'").first()["last"]
    own, pool = fresh(counted, "_own_last"), fresh(counted, "_pool_last")
    by_name = lambda key, out: lasts.select(F.col("stratum").alias(key), F.col("last").alias(out))
    pooled = lasts.filter(F.col("stratum").endswith("/*")).select(F.regexp_replace("stratum", r"/\*$", "").alias(lang_key), F.col("last").alias(pool))
    joined = lookup(counted, by_name(strata, own), strata, spread_by=first, how="left")
    joined = lookup(joined, pooled, lang_key, spread_by=first, how="left")
    last = F.coalesce(F.col(own), F.col(pool), F.lit(rest))
    hit = F.coalesce(F.col(first) <= last, F.lit(False))
    # One expression over both sides of the join: no part of it can be pushed below the counting.
    passed = ~F.array_contains(F.array(base_failed(names), hit), True)
    return joined, base_failed(names), passed


def _good_ids(labels: DataFrame) -> DataFrame:
    """Ids that all their label rows call good, once each."""
    return labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")


def _holdout(counted: DataFrame, names: dict[str, str], sha: str) -> DataFrame:
    """Of equal texts one holdout, as copies are not independent trials; it takes their least language."""
    passed = counted.filter(~base_failed(names))
    return passed.groupBy(sha).agg(F.min(F.struct("lang_key", "stratum", "first")).alias("least")).select("least.*")


def rule_rows(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    alpha: float = ALPHA, delta: float = DELTA,
) -> DataFrame:
    """One narrow row per document with counts and verdict: ``doc_id, n_words, …, base_failed, kept``.

    A null text counts as empty and fails the base rules, as does any text of under
    ten words. Null labels, ids and languages are allowed: an unlabelled or null id
    holds nothing out, a null language is its own. With too few labelled rows in all to
    prove a bound nothing is rejected beyond the base rules; so it is with an
    empty label table. Repeated rows each get their row; an empty table gives an
    empty table; further columns are ignored.
    """
    counted, names = with_counts(
        docs.select(
            column(id_col).alias("doc_id"), language_key(column(lang_col)).alias("lang_key"), column(text_col).alias("text"),
            F.md5(whole(column(text_col))).alias("sha"),
        )
    )
    counted = counted.withColumns({"stratum": stratum(names, F.col("lang_key")), "first": first_step(names)})
    counted = store(counted.drop("text"), "counts")
    good = _good_ids(labels).withColumn("n", F.lit(1))
    held = _holdout(lookup(counted, good, "doc_id", spread_by="sha", size_col="n"), names, "sha")
    joined, failed, passed = _verdicts(counted, names, last_steps(held, alpha, delta), "lang_key", "stratum", "first")
    return joined.select(
        "doc_id",
        *[F.col(names[c]).alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        passed.alias("kept"),
    )


def rule_filter(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    alpha: float = ALPHA, delta: float = DELTA,
) -> DataFrame:
    """The rows of ``docs`` that :func:`rule_rows` keeps, with all their columns.

    Only labelled documents are counted twice; no text is shuffled but theirs.
    """
    key, sha, one = (fresh(docs, n) for n in ("_id", "_sha", "_one"))
    good = store(_good_ids(labels).select(F.col("doc_id").alias(key), F.lit(1).alias(one)), "good")
    narrow = docs.select(
        column(id_col).alias(key), language_key(column(lang_col)).alias("lang_key"), column(text_col).alias("text"),
        F.md5(whole(column(text_col))).alias(sha),
    )
    labelled, names = with_counts(lookup(narrow, good, key, spread_by=sha, size_col=one))
    labelled = labelled.withColumns({"stratum": stratum(names, F.col("lang_key")), "first": first_step(names)})
    held = _holdout(store(labelled.drop("text"), "labelled"), names, sha)
    lasts = last_steps(held, alpha, delta)
    counted, names = with_counts(docs)
    lang, strata, first = (fresh(counted, n) for n in ("_lang_key", "_strata", "_first"))
    counted = counted.withColumn(lang, language_key(column(lang_col)))
    counted = counted.withColumns({strata: stratum(names, F.col(lang)), first: first_step(names)})
    joined, _, passed = _verdicts(counted, names, lasts, lang, strata, first)
    return joined.filter(passed).select(*[column(c) for c in docs.columns])
