"""Trained operators by held-out accuracy, rules and mixing by their guarantees."""

import math
import random
import zlib

import numpy as np
import pytest
from llm_helpers import table
from pyspark.sql import functions as F

from gleaner.llm import mixing, neighbours, rules, toxicity

SYLLABLES = ["ba", "de", "ki", "lo", "mu", "na", "po", "ri", "su", "ta", "ve", "zo"]
INSULTS = ["idiot", "moron", "scumbag", "loser", "clown"]


def word(r):
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def disguised(r, w):
    """Inserted, doubled or separated letters."""
    at = r.randrange(1, len(w))
    return r.choice([w, w[:at] + r.choice("xq*.-") + w[at:], w[:at] + w[at - 1] + w[at:], " ".join(w), w.upper() + "!"])


@pytest.fixture(scope="module")
def talk(spark):
    r = random.Random(11)
    rows, labels = [], []
    for i in range(900):
        words = [word(r) for _ in range(r.randint(20, 120))]
        bad = r.random() < 0.3
        if bad:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), disguised(r, r.choice(INSULTS)))
        junk = r.random() < 0.3
        if junk:
            words = [w + r.choice(["###", "$$$", "%%%"]) for w in words] if r.random() < 0.5 else [words[0]] * len(words)
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(not junk), int(bad and not (junk and len(set(words)) == 1))))
    return table(spark, rows, 4).cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


def accuracy(rows, labels, label):
    held = [(r.predicted, r[label]) for r in rows.join(labels, "doc_id").filter("held_out").collect()]
    assert len(held) > 100
    return sum(a == b for a, b in held) / len(held)


def test_toxicity_on_held_out(talk):
    docs, labels = talk
    rows = toxicity.toxicity_rows(docs, labels).cache()
    assert accuracy(rows, labels, "toxic") > 0.9
    for r in rows.select("doc_id", "held_out", "score").limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1


def test_toxicity_with_wrong_labels(spark):
    """One in a hundred clean labels stands at a document with an insult: insults stay insults."""
    r = random.Random(12)
    rows, labels, bad = [], [], {}
    for i in range(1200):
        words = [word(r) for _ in range(r.randint(20, 60))]
        bad[i] = i % 3 == 0
        if bad[i]:
            words.insert(r.randrange(len(words)), ["idiot", "moron"][i // 3 % 2])
        rows.append((i, " ".join(words), "en", "a"))
    wrong = [i for i in bad if bad[i] and zlib.crc32(str(i).encode()) % 5][:8]
    labels = [(i, 1, int(bad[i] and i not in wrong)) for i in bad]
    rows = toxicity.toxicity_rows(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held = [(x.predicted, bad[x.doc_id]) for x in rows.filter("held_out").collect()]
    assert all(p for p, b in held if b) and sum(p == b for p, b in held) > 0.9 * len(held)


def plain_kernel(a, b):
    """Subsequences of three and four letters spanning up to five, each weighing by its span, normalised by the lengths."""

    def weights(word):
        letters, out = "\x01" + word + "\x02", {}
        for i in range(len(letters)):
            for span in toxicity.SPANS:
                if i + span[-1] < len(letters):
                    s = letters[i] + "".join(letters[i + k] for k in span)
                    out[s] = out.get(s, 0) + toxicity.DECAY ** span[-1]
        total = sum(max(0, len(letters) - span[-1]) * toxicity.DECAY ** (2 * span[-1]) for span in toxicity.SPANS)
        return out, math.sqrt(max(total, toxicity.DECAY**4))

    (x, m), (y, n) = weights(a), weights(b)
    return sum(v * y.get(s, 0) for s, v in x.items()) / m / n


def test_machine_equals_its_expansion_over_landmarks():
    """The folded machine gives the weighted sum of kernel values with the landmarks, by a plain kernel."""
    r = random.Random(5)
    clean = sorted({word(r) for _ in range(120)})
    marks, beta, bias = toxicity.landmark_machine(INSULTS, clean)
    machine = toxicity._train(INSULTS, clean)
    words = [*INSULTS, *clean[:20], "idxiot", "lo", "mooron"]
    want = [sum(b * plain_kernel(w, m) for b, m in zip(beta, marks)) + bias for w in words]
    got = machine._of_words(words, toxicity._codes())
    # Four letters share places by a hash, which moves a value a little.
    assert max(abs(g - w) for g, w in zip(got, want)) < 0.02


@pytest.mark.parametrize("insult", ["idiot", "idxiot", "iddiot", "i...d...i...o...t", "id iot", "I D I O T", "worthxless", "worth less"])
def test_one_disguised_insult_decides(insult, machine):
    """A letter put in, marks between all letters, parted in two: toxic in a clean sentence, which without it is clean."""
    score = machine.scorer()
    r = random.Random(21)
    clean = " ".join(word(r) for _ in range(30))
    chance = [machine.probability(np.array([score(t)[0]]))[0] for t in (clean, f"{clean} {insult} ba lo")]
    assert chance[0] < 0.5 <= chance[1], chance


@pytest.fixture(scope="module")
def machine(spark):
    r = random.Random(14)
    rows, labels = [], []
    for i in range(800):
        words = [word(r) for _ in range(r.randint(20, 60))]
        if i % 4 == 0:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice([*INSULTS, "worthless"]))
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, int(i % 4 == 0)))
    return toxicity.fit(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_neighbours_against_a_plain_search(talk):
    """Scores by cosines with every labelled vector, sorted, ties to the least id."""
    docs, labels = talk
    model = neighbours.fit(docs, labels)
    kinds, slots = neighbours._byte_kinds(), neighbours._trigram_slots()
    some = docs.filter("doc_id < 60").select("doc_id", "text").collect()
    got = {x.doc_id: x.score for x in neighbours.quality_rows(docs, labels).filter("doc_id < 60").collect()}
    for row in some:
        v = model.project(neighbours.term_counts([row.text.encode()], kinds, slots))[0].astype(float)
        near = sorted((-round(float(v @ u) * 1e6), i) for i, u in enumerate(model.vectors.astype(float)))[: neighbours.NEIGHBOURS]
        votes = [(max(0.0, float(v @ model.vectors[i].astype(float))) ** neighbours.POWER * model.votes[i], model.good[i]) for _, i in near]
        want = sum(w * g for w, g in votes) / sum(w for w, _ in votes)
        assert got[row.doc_id] == pytest.approx(want, abs=2e-3)


def test_equally_near_vectors():
    cosines = np.array([[0.5, 0.9, 0.5, 0.5, 0.1]], dtype=np.float32)
    assert sorted(neighbours._nearest(cosines, 3)[0].tolist()) == [0, 1, 2]
    assert sorted(neighbours._nearest(cosines + np.float32(1e-7), 3)[0].tolist()) == [0, 1, 2]


def test_one_id_with_two_texts(spark):
    """The text with the least hash is learned, whatever the order of rows."""
    from gleaner.llm.samples import labelled_sample

    rows = [(1, "b"), (1, "a"), (2, None), (2, "c"), (3, "d")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    seen = set()
    for order in (rows, rows[::-1]):
        sample = labelled_sample(table(spark, order), labels, "quality", 4, 9, 10, "doc_id", "text")
        seen.add(tuple(sorted((x.doc_id, x.text, x.label) for x in sample.collect())))
    assert len(seen) == 1 and len(next(iter(seen))) == 3


def test_false_rejection_stays_under_its_bound(spark):
    """Many strata with known rates of rejection: none loses more than alpha of its good documents."""
    r = random.Random(31)
    rows, rate = [], {}
    for s in range(40):
        steps = [r.choice([0, 0, 0.002, 0.01]) for _ in rules.PATH]
        rate[f"=l{s}/long"] = steps
        for _ in range(600):
            hit = next((j for j, p in enumerate(steps) if r.random() < p), None)
            rows.append((f"=l{s}", f"=l{s}/long", hit))
    held = spark.createDataFrame(rows, "lang_key string, stratum string, first int")
    lasts = {x.stratum: x.last for x in rules.last_steps(held).collect()}
    assert set(rate) <= set(lasts)
    lost = {s: 1 - math.prod(1 - p for p in steps[: lasts[s] + 1]) for s, steps in rate.items()}
    assert max(lost.values()) <= rules.ALPHA and sum(lasts[s] >= 0 for s in rate) > 20


def test_small_strata_are_merged(spark):
    held = [("=en", "=en/long", None)] * 400 + [("=en", "=en/short", None)] * 10 + [("=de", "=de/long", None)] * 150 + [("=de", "=de/short", 3)] * 200
    lasts = {x.stratum: x.last for x in rules.last_steps(spark.createDataFrame(held, "lang_key string, stratum string, first int")).collect()}
    end = len(rules.PATH) - 1
    assert lasts == {"=en/long": end, "=de/*": 2, "*": -1}


def test_rules_reject_more_than_the_base(spark):
    """With a few hundred labels the method rejects junk that the base rules pass."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = rules.rule_rows(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")).cache()
    assert rows.filter("not base_failed and not kept").count() > 10


def test_kernel_tolerates_gaps():
    table_ = toxicity._codes()
    plain = toxicity.features(["idiot"], table_)[0]
    near, far = toxicity.features(["idxiot", "banana"], table_) @ plain
    assert near > 0.25 and near > 20 * max(far, 1e-9)


def test_folded_weights_equal_the_kernel_expansion():
    machine = toxicity._train(["idiot", "moron", "idiots"], ["banana", "table", "window", "kilo"])
    codes = toxicity._codes()
    words = ["idiot", "moronic", "wind", "x", ""]
    want = toxicity.features(words, codes) @ machine.weights + machine.bias
    assert machine.of_words(words, codes) == pytest.approx(want, abs=1e-5)


def test_quality_on_held_out(talk):
    docs, labels = talk
    assert accuracy(neighbours.quality_rows(docs, labels), labels, "quality") > 0.95


def test_binomial_tail(spark):
    def plain(n, k, p):
        return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))

    cases = [(10, 0), (10, 3), (50, 50), (700, 2), (2000, 11), (0, 0)]
    df = spark.createDataFrame(cases, "n long, k long").withColumn("t", rules.binomial_tail(F.col("n"), F.col("k"), 0.01))
    for r in df.collect():
        assert r.t == pytest.approx(plain(r.n, r.k, 0.01), rel=1e-9)
    assert spark.createDataFrame([(500_000, 100)], "n long, k long").select(rules.binomial_tail(F.col("n"), F.col("k"), 0.01)).first()[0] < 1e-300


def test_rules_keep_nearly_all_good(spark):
    """Junk goes, and per stratum no more good documents than the bound allows."""
    r = random.Random(3)
    rows, labels = [], []
    for i in range(6000):
        words = [word(r) for _ in range(60)]
        bad = i % 6 == 0
        if bad:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), "en" if i % 2 else None, "a"))
        labels.append((i, int(not bad), 0))
    got = {x.doc_id: x.kept for x in rules.rule_rows(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert not any(got[i] for i in range(0, 6000, 6))
    assert sum(not got[i] for i in range(6000) if i % 6) <= 0.02 * 5000


@pytest.mark.parametrize("sizes", [[5, 1, 1, 1], [100, 1, 2], [3], [0, 4], [1000, 1000, 10, 10, 10], [100 + i for i in range(20)], [9000, *range(90, 110)]])
def test_targets_reshare_the_excess(spark, sizes):
    rows = [(f"={chr(97 + i)}", chr(97 + i), s) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "skey string, source string, source_size long")
    got = [r.target for r in mixing.targets(df).orderBy("skey").collect()]
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    want, capped, left = [0.0] * len(sizes), set(), 1.5 * sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        level = (left - sum(2 * sizes[i] for i in capped)) / max(1, sum(weights[i] for i in free))
        over = [i for i in free if level * weights[i] > 2 * sizes[i]]
        if not over:
            break
        capped |= set(over)
    for i in range(len(sizes)):
        want[i] = 2.0 * sizes[i] if i in capped else level * weights[i]
    assert got == pytest.approx(want)
    assert sum(got) == pytest.approx(1.5 * sum(sizes))


def test_mix_comes_near_its_targets_and_repeats(spark):
    r = random.Random(9)
    rows = [(i, " ".join(word(r) for _ in range(r.randint(0, 40))), None, None if i % 7 == 0 else "a" if i % 3 else "bé") for i in range(900)]
    docs = table(spark, rows)
    got = mixing.mix_rows(docs).collect()
    per = {}
    for x in got:
        s = per.setdefault((x.source_size, x.target), [0, 0])
        s[0] += x.taken
        s[1] += x.size
        assert x.taken in (0, x.size, 2 * x.size)
    for (size, target), (taken, total) in per.items():
        assert size == total and abs(taken - target) <= 40
    again = mixing.mix_rows(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    times = {}
    for x in mixing.mix(docs).collect():
        times[x.doc_id] = times.get(x.doc_id, 0) + 1
    assert times == {x.doc_id: x.taken // x.size for x in got if x.taken}
