import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import quality, quantiles


def frame(spark, rows):
    return spark.createDataFrame(rows, "score_col string, score double, weight bigint").repartition(3)


def inverted_cdf(scores, weights, percentiles):
    order = np.argsort(scores, kind="stable")
    cdf = np.cumsum(np.array(weights)[order]) / np.sum(weights)
    return [float(np.array(scores)[order][np.searchsorted(cdf, p / 100, side="left")]) for p in percentiles]


@pytest.mark.parametrize(
    "scores, weights",
    [
        ([0.5], [3]),
        ([1.0] * 10, [2] * 10),
        ([float(i) for i in range(20)], [1] * 20),
        ([3.0, 1.0, 2.0, 1.0], [0, 5, 1, 0]),
        ([0.1, 0.2, 0.9], [10**9, 1, 10**9]),
    ],
    ids=["one row", "all equal", "cdf on the percentile", "zero weights", "large weights"],
)
def test_weighted_percentiles(spark, scores, weights):
    got = quantiles.weighted_percentiles(frame(spark, [("s", s, w) for s, w in zip(scores, weights)]))
    by = {r["percentile"]: r["threshold"] for r in got.collect()}
    assert [by[p] for p in quantiles.PERCENTILES] == inverted_cdf(scores, weights, quantiles.PERCENTILES)


def test_weighted_percentiles_of_random_scores(spark):
    rng = random.Random(2)
    scores = [round(rng.random(), 2) for _ in range(500)]
    weights = [rng.randrange(1, 1000) for _ in scores]
    got = quantiles.weighted_percentiles(frame(spark, [(c, s, w) for c in "ab" for s, w in zip(scores, weights)]))
    for c in "ab":
        by = {r["percentile"]: r["threshold"] for r in got.collect() if r["score_col"] == c}
        values = [by[p] for p in quantiles.PERCENTILES]
        assert values == inverted_cdf(scores, weights, quantiles.PERCENTILES)
        assert values == sorted(values)


def test_digitize(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (0.3,), (0.5,), (9.0,), (float("nan"),)], "s double")
    bins = [r[0] for r in df.select(quality.digitize(F.col("s"), [0.2, 0.3, 0.3, 0.4])).collect()]
    assert bins == [0, 1, 3, 4, 4, 4]
    assert bins == np.digitize([0.0, 0.2, 0.3, 0.5, 9.0, np.nan], [0.2, 0.3, 0.3, 0.4]).tolist()


def test_missing_thresholds_are_an_error(spark):
    with pytest.raises(ValueError, match="no thresholds"):
        quality.map_score_columns(spark.createDataFrame([(1.0,)], "s double"), ["s"], {})


def test_thresholds_survive_saving(spark, tmp_path):
    saved = {"a-score": {5: 0.25, 95: 1.5}, "b": {5: 0.0}}
    quantiles.save_thresholds(spark, saved, str(tmp_path / "t"))
    assert quantiles.load_thresholds(spark, str(tmp_path / "t")) == saved


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 1.0])
def test_sample_sizes_per_file(spark, fraction):
    sizes = {"a": 1, "b": 5, "c": 700, "d": 3000}
    rows = [(f, i) for f, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "file_name string, doc_id bigint").repartition(4)
    sample = quantiles.threshold_sample(docs, fraction)
    counts = {r["file_name"]: r["count"] for r in sample.groupBy("file_name").count().collect()}
    assert counts == {f: round(fraction * n) for f, n in sizes.items() if round(fraction * n)}
    again = quantiles.threshold_sample(docs.repartition(2), fraction)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect()))


def test_trained_scores_are_probabilities_and_tell_labels_apart(spark):
    good, bad = "a clear and well made text number {}", "zz xx !! buy buy {}"
    rows = [(i, (good if i % 2 else bad).format(i), i % 2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    for pipeline in (quality.ngram_model(1 << 10), quality.tfidf_model(1 << 10)):
        scored = quality.model_score(docs, pipeline.fit(docs), "s-score").collect()
        assert len(scored) == 60 and all(0 <= r["s-score"] <= 1 for r in scored)
        assert min(r["s-score"] for r in scored if r["quality"]) > max(r["s-score"] for r in scored if not r["quality"])


def auc(pairs):
    """Chance that a good document scores above a bad one; ties count half."""
    good, bad = ([s for s, y in pairs if y == k] for k in (1, 0))
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_trained_scores_on_documents_they_have_not_seen(spark):
    """Every labelled document is scored by a model without its fold."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.trained_scores(docs, labels).join(labels, "doc_id").select(*quality.TRAINED_SCORES, "quality").collect()
    assert len(rows) == labels.count()
    reached = [auc([(r[c], r["quality"]) for r in rows]) for c in quality.TRAINED_SCORES]
    assert all(0 <= r[c] <= 1 for r in rows for c in quality.TRAINED_SCORES)
    print(reached)
    assert min(reached) > 0.8, reached


def test_models_leave_out_their_fold(spark):
    """A label that only one document has can't be told by a model that hasn't seen it."""
    from gleaner.operators import linear

    docs = spark.createDataFrame([(i, f"word{i} common text", i % 2) for i in range(40)], "doc_id long, text string, quality int")
    rows = quality.ngram_scores(docs, docs).join(docs, "doc_id").collect()
    assert 0.3 < auc([(r[quality.TRAINED_SCORES[0]], r["quality"]) for r in rows]) < 0.7
    folds = {r.f for r in docs.select(linear.fold_of(F.col("doc_id")).alias("f")).distinct().collect()}
    assert folds == set(range(linear.FOLDS))


def test_scores_of_a_model_too_large_to_send(spark):
    from gleaner.operators import linear

    docs = spark.createDataFrame([(i, f"a b c{i % 7} d{i % 3}", int(i % 7 > 3)) for i in range(60)] + [(99, None, 1), (100, "", 0)], "doc_id long, text string, quality int")
    rows = linear.labelled(docs.select("doc_id", "text"), docs, "quality")
    model = linear.log_odds(linear.gram_counts(rows, linear.words(F.col("text"))))
    both = [linear.gram_scores(docs, "doc_id", linear.words(F.col("text")), model, 8.0, "s", b).collect() for b in (1 << 26, 0)]
    assert sorted(both[0]) == sorted(both[1]) and len(both[0]) == 62


def test_figures_of_stages(spark, tmp_path):
    from gleaner.operators.metrics import StageMetrics, bytes_of

    docs = spark.createDataFrame([(1, "é"), (2, None), (3, "abc")], "id long, text string")
    metrics = StageMetrics()
    once = metrics.store(docs, "first", text_bytes=bytes_of("text"))
    metrics.store(once.filter("id = 9"), "none", text_bytes=bytes_of("text"))
    metrics.store(once, "first")
    metrics.save(spark, str(tmp_path / "m"))
    rows = [tuple(r) for r in StageMetrics.load(spark, str(tmp_path / "m")).table(spark).collect()]
    assert [r[:3] for r in rows] == [r[:3] for r in metrics.rows()]
    assert [r for r in rows if r[2] != "seconds"] == [
        (0, "first", "rows", 3.0), (0, "first", "text_bytes", 5.0), (1, "none", "rows", 0.0), (1, "none", "text_bytes", 0.0), (2, "first", "rows", 3.0)
    ]
    assert all(r[3] > 0 for r in rows if r[2] == "seconds")


def test_frequent_grams_are_sent_and_a_large_model_is_not_stored(spark, monkeypatch):
    """Frequent grams of a large model are broadcast, the others shuffled: scores are the same; no copy of the model is written."""
    from gleaner.operators import linear, skew

    texts = [(i, f"a a b c{i % 7} d{i % 3} e{i}", int(i % 7 > 3)) for i in range(60)] + [(99, None, 1), (100, "", 0), (101, "only here", None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, quality int")
    grams = linear.words_and_pairs(F.col("text"))
    rows = linear.labelled(docs.select("doc_id", "text"), docs, "quality")
    model = linear.log_odds(linear.gram_counts(rows, grams))
    assert dict(model.dtypes)["gram"] == "bigint"
    monkeypatch.setattr(skew, "cut_lineage", lambda df: pytest.fail("stored"))
    limits = (1 << 26, 20 * linear._MODEL_ROW, 0)
    assert 0 < model.filter(F.col("seen") >= linear._least_frequent(model, 20)).count() <= 20
    scores = [sorted(linear.gram_scores(docs, "doc_id", grams, model, 8.0, "s", b).collect()) for b in limits]
    assert scores[0] == scores[1] == scores[2] and len(scores[0]) == 63


def test_grams_are_hashed_and_counted_in_batches(spark):
    """The same words and pairs as the patterns find, one hash each; words of any length; counts by class and fold."""
    from gleaner.operators import linear

    texts = [None, "", " \n\x0b", "The cat the\tcat", "é ü\r\nß", "x" * 200_000 + " a b " + "y" * 70_000] + ["w%d v w%d" % (i, i % 3) for i in range(40)]
    docs = spark.createDataFrame([(i, t, i % 2, i % 5) for i, t in enumerate(texts)], "doc_id long, text string, label int, fold int").repartition(3)
    text = F.col("text")
    pairs = docs.select("*", linear.words_and_pairs(text).alias("said"), linear.hashed_words_and_pairs(text).alias("hashed"),
                        F.array_distinct(linear.words(text)).alias("words"), linear.hashed_distinct_words(text).alias("distinct")).collect()
    names = {}
    for r in pairs:
        assert (r.said is None) == (r.hashed is None) and len(r.said or []) == len(r.hashed or [])
        assert all(names.setdefault(g, h) == h for g, h in zip(r.said or [], r.hashed or []))
        assert sorted(names[w] for w in r.words or []) == sorted(r.distinct or [])
    assert len(set(names.values())) == len(names)
    expected = {}
    for r in pairs:
        for g in r.said or []:
            row = expected.setdefault(names[g], dict.fromkeys([f"t{y}_{k}" for y in (0, 1) for k in range(5)] + ["t0", "t1"], 0))
            row[f"t{r.label}_{r.fold}"] += 1
            row[f"t{r.label}"] += 1
    counts = linear.gram_counts(docs, linear.hashed_words_and_pairs(text)).collect()
    assert {r.gram: {c: r[c] for c in r.asDict() if c != "gram"} for r in counts} == expected


def test_text_is_read_once_for_its_statistics(spark):
    """No pattern or lambda over words: one pass in Python counts a text."""
    df = spark.createDataFrame([(1, "The of\n\nX × é 😀 A\n\n"), (2, None), (3, "")], "doc_id long, text string")
    out = quality.quality_features(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan
    assert sorted(map(tuple, out.select("doc_id", *quality.FEATURES).collect())) == [
        (1, 1.428571, 0.285714, 0.052632, 0.4, 0.210526), (2, 0.0, 0.0, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.0, 0.0, 0.0)]
