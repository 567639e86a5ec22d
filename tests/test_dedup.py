import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.catalog import QUERIES
from gleaner.functions import digests
from gleaner.operators import components, exact, fuzzy, substring

SKEW = {"hot_rows": 5, "salts": 3}


def ids(df, column="doc_id"):
    return sorted(r[0] for r in df.select(column).collect())


def documents(spark, texts, partitions=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(partitions)


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_exact_keeps_lowest_id_and_is_idempotent(spark):
    docs = documents(spark, ["a", "b", "a", "a", "c", "b", ""])
    once = exact.exact_dedup(docs)
    assert ids(once) == [0, 1, 4, 6]
    assert ids(exact.exact_dedup(once)) == [0, 1, 4, 6]
    assert ids(exact.exact_dup_ids(docs)) == [2, 3, 5]


def test_identify_or_remove_must_be_asked_for(spark):
    with pytest.raises(ValueError):
        exact.run_exact_dedup(documents(spark, ["a"]))
    with pytest.raises(ValueError):
        exact.run_exact_dedup(documents(spark, ["a"]), remove=True)


def test_assigned_ids_do_not_depend_on_partitions(spark):
    rows = [(f"k{n:03d}",) for n in random.Random(1).sample(range(500), 200)]
    frames = [spark.createDataFrame(rows, "url string").repartition(p) for p in (1, 7)]
    one, other = (dict(exact.assign_ids(f, "url").collect()) for f in frames)
    assert one == other == {k: i for i, (k,) in enumerate(sorted(rows))}


@pytest.mark.parametrize("skew", [{}, SKEW])
@pytest.mark.parametrize(
    "edges",
    [
        [(i, i + 1) for i in range(50)],
        [(7, i) for i in range(50) if i != 7],
        [(1, 2), (10, 11)],
        [(3, 3), (4, 5), (5, 4), (4, 5)],
    ],
    ids=["chain", "star", "pairs", "loops"],
)
def test_components(spark, edges, skew):
    found = dict(components.connected_components(spark.createDataFrame(edges, "src bigint, dst bigint"), **skew).collect())
    expected = {k: v for k, v in union_find(edges).items() if any(k in e and e[0] != e[1] for e in edges)}
    assert found == expected


def test_components_of_random_graph(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges = [e for e in edges if e[0] != e[1]]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    assert dict(components.connected_components(df, **SKEW).collect()) == union_find(edges)


def test_contraction_keeps_the_components(spark):
    rng = random.Random(6)
    edges = [(a, b) for a, b in ((rng.randrange(400), rng.randrange(400)) for _ in range(500)) if a > b]
    named = [(f"n{a:03d}", f"n{b:03d}") for a, b in edges]
    for rows, kind in ((edges, "bigint"), (named, "string")):
        df = spark.createDataFrame(rows, f"u {kind}, v {kind}").repartition(3)
        smaller = components.contract(df, block=40)
        assert union_find([tuple(r) for r in smaller.collect()]) == union_find(rows)
        assert smaller.count() <= len(rows)
    chain = spark.createDataFrame([(i + 1, i) for i in range(100)], "u bigint, v bigint").coalesce(1)
    assert {tuple(r) for r in components.contract(chain).collect()} == {(i, 0) for i in range(1, 101)}


def test_components_without_edges_and_with_nulls(spark):
    assert components.connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0
    df = spark.createDataFrame([(1, None), (None, None), (2, 3)], "src bigint, dst bigint")
    assert dict(components.connected_components(df).collect()) == {2: 2, 3: 2}


def test_a_star_of_all_edges_fills_all_tasks_alike(spark):
    """The rows a hub's join sends to each of 211 tasks."""
    n, tasks = 2_000_000, 211
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        star = spark.range(1, n + 1).select(F.lit(0).cast("bigint").alias("u"), F.col("id").alias("v"))
        sized = spark.createDataFrame([(0, 0, n)], "u bigint, m bigint, _size bigint")
        joined = components.spread_join(star, sized.hint("merge"), "u", "_size", "v", hot_rows=components._hot_rows(star, n))
        rows = sorted(r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(rows) == n and len(rows) > 0.95 * tasks and rows[-1] <= 3 * rows[len(rows) // 2]


def grams(text, width=24):
    return {text[i : i + width] for i in range(max(len(text) - width, 0) + 1)}


def similar(a, b, percent):
    a, b = grams(a), grams(b)
    return 100 * len(a & b) >= percent * len(a | b)


@pytest.mark.parametrize("skew", [{}, SKEW])
def test_verified_links_equal_brute_force_among_candidates(spark, skew):
    """Short bands put unlike texts into one bucket: drifting copies, of which neighbours are alike and ends aren't."""
    rng = random.Random(8)
    base = [rng.choice("abcdefgh") for _ in range(900)]
    texts = ["".join(base)]
    for i in range(25):
        at = 20 * i
        base[at : at + 30] = [rng.choice("ijklmnop") for _ in range(30)]
        texts.append("".join(base))
    texts += ["", "", "short", texts[3], "x" * 40, "x" * 60]
    docs = documents(spark, texts)
    edges = [tuple(r) for r in fuzzy.verified_edges(docs, bands=8, rows_per_band=1, **skew).collect()]
    assert all(similar(texts[a], texts[b], 80) for a, b in edges)
    buckets = docs.select("doc_id", F.posexplode(fuzzy.band_keys(F.col("text"), 8, 1)).alias("band", "k")).collect()
    keys = {}
    for i, _, k in buckets:
        keys.setdefault(bytes(k), []).append(i)
    candidates = {(a, b) for ids_ in keys.values() for a in ids_ for b in ids_ if a < b}
    unlike = [c for c in candidates if not similar(texts[c[0]], texts[c[1]], 80)]
    assert len(unlike) > 20
    assert union_find(edges) == union_find([c for c in candidates if similar(texts[c[0]], texts[c[1]], 80)])


def test_verified_groups_against_all_pairs(spark):
    """Recall and precision on the smallest table, links of all pairs taken as the truth."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    sets = {i: grams(t) for i, t in rows.filter("text is not null").collect()}
    order = sorted(sets)
    links = [
        (a, b) for n, a in enumerate(order) for b in order[n + 1 :]
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    truth = union_find(links)
    found = dict(fuzzy.verified_groups(rows).collect())
    assert truth
    together = lambda groups: {(a, b) for a in groups for b in groups if a < b and groups[a] == groups[b]}
    assert together(found) <= together(truth)
    assert len(together(found)) >= 0.9 * len(together(truth))


def test_verified_links_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert fuzzy.verified_edges(none).count() == 0
    odd = spark.createDataFrame([(1, None), (2, None), (3, ""), (4, ""), (4, "")], "doc_id bigint, text string").withColumn("hub", F.lit(1))
    assert [tuple(r) for r in fuzzy.verified_edges(odd).collect()] == [(3, 4)]


def test_verified_links_compare_few_pairs(spark, monkeypatch):
    """Copies are not compared, and near copies that share many buckets about once each."""
    texts = near_copies() + ["one text in forty places, and longer than a shingle"] * 40
    pairs, compared = [], fuzzy._compared
    monkeypatch.setattr(fuzzy, "_compared", lambda met, *rest: pairs.extend(map(tuple, met.collect())) or compared(met, *rest))
    links = [tuple(r) for r in fuzzy.verified_edges(documents(spark, texts)).collect()]
    assert set(union_find(links).values()) == {0, 40}
    assert len(pairs) < len(set(texts))


def test_equal_ids_with_other_texts_join_their_groups(spark):
    rng = random.Random(4)
    long = ["".join(rng.choice("abcdefgh") for _ in range(300)) for _ in range(3)]
    rows = [(5, long[0]), (3, long[0]), (5, long[1]), (9, long[1]), (7, long[2]), (None, long[2]), (8, "a" * 23), (6, "a" * 24)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert dict(fuzzy.verified_groups(df).collect()) == {3: 3, 5: 3, 9: 3}


def near_copies(n=30):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = []
    for i in range(n):
        copy = list(words)
        copy[i % 5] = f"x{i}"
        texts.append(" ".join(copy))
    return texts + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(100)) for _ in range(10)]


def test_hot_bucket_gives_the_same_edges(spark):
    """Most documents fall into the same buckets; salting must not change the outcome."""
    docs = documents(spark, near_copies())
    plain = {tuple(r) for r in fuzzy.lsh_edges(docs).collect()}
    salted = {tuple(r) for r in fuzzy.lsh_edges(docs, **SKEW).collect()}
    assert plain == salted and plain
    kept = fuzzy.fuzzy_dedup(docs)
    assert ids(kept) == [0] + list(range(30, 40))
    assert ids(fuzzy.fuzzy_dedup(kept)) == ids(kept)


def test_minhash_of_short_and_empty_texts(spark):
    docs = documents(spark, ["", "short", "short", "a text that is a bit longer than one shingle"])
    rows = dict(docs.select("doc_id", fuzzy.minhash(F.col("text")).alias("s")).collect())
    assert rows[1] == rows[2] != rows[0]
    assert all(len(s) == 260 and all(0 <= v < fuzzy.PRIME for v in s) for s in rows.values())


def test_minhash_agrees_with_plain_arithmetic(spark):
    text = "Ünïcode 😀 text, long enough for some shingles of width 24."
    sig = documents(spark, [text]).select(fuzzy.minhash(F.col("text")).alias("s")).first()[0]
    w = [fuzzy.coefficient("w", j) for j in range(24)]
    hashes = [sum(w[j] * ord(text[i + j]) for j in range(24)) % fuzzy.PRIME for i in range(len(text) - 23)]
    for i in (0, 7, 259):
        a, b = fuzzy.coefficient("a", i), fuzzy.coefficient("b", i)
        assert sig[i] == min((a * h + b) % fuzzy.PRIME for h in hashes)


# --- repeated passages -----------------------------------------------------


def brute_force(texts, k, keep):
    """Cut token positions of every document, from all k-grams."""
    import re

    split = [re.findall(r"^[ \t\n\r\f]+|[^ \t\n\r\f]+[ \t\n\r\f]*", t) for t in texts]
    seen = {}
    for d, tokens in enumerate(split):
        for p in range(len(tokens) - k + 1):
            seen.setdefault(tuple(tokens[p : p + k]), []).append((d, p))
    cut = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places[1:] if keep == "first" else places:
                cut[d].update(range(p, p + k))
    return ["".join(t for i, t in enumerate(tokens) if i not in gone) for tokens, gone in zip(split, cut)]


def passages(seed, n=25):
    rng = random.Random(seed)
    words = lambda m: [f"w{rng.randrange(12)}" for _ in range(m)]
    shared = [words(rng.randrange(4, 14)) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            parts += words(rng.randrange(0, 6)) + rng.choice(shared)
        texts.append(rng.choice(["", " ", "\n"]) + rng.choice([" ", "\n", "  "]).join(parts))
    return texts + ["w1 " * 30, "", "w1 w2"]


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("k", [5, 8])
def test_passages_equal_brute_force(spark, k, keep):
    texts = passages(k)
    got = dict(substring.substring_dedup(documents(spark, texts), k=k, keep=keep).select("doc_id", "text").collect())
    assert [got[i] for i in range(len(texts))] == brute_force(texts, k, keep)


def test_hot_passage_gives_the_same_positions(spark):
    docs = documents(spark, ["same words in every one of these documents " * 3] * 20)
    plain = {tuple(r) for r in substring.repeated_kgrams(docs, k=6).collect()}
    salted = {tuple(r) for r in substring.repeated_kgrams(docs, k=6, **SKEW).collect()}
    assert plain == salted and len(plain) == 20 * (24 - 6 + 1)


def test_fully_cut_document_keeps_its_row(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f"])
    assert dict(substring.substring_dedup(docs, k=3).select("doc_id", "text").collect()) == {0: "a b c d e f", 1: ""}


def test_tokens_join_to_the_text(spark):
    docs = documents(spark, passages(9))
    joined = docs.select((F.array_join(substring.lossless_tokens(F.col("text")), "") == F.col("text")).alias("ok"))
    assert all(r[0] for r in joined.collect())


def adjust(spark, intervals, ends, threshold, unit=2):
    starts = [0, *ends[:-1]]
    docs = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(zip(starts, ends))], "doc_id bigint, doc_start bigint, doc_end bigint")
    spans = spark.createDataFrame(intervals, "start bigint, end bigint")
    return sorted(tuple(r) for r in substring.adjust_intervals(spans, docs, threshold, unit=unit, bucket_bytes=64).collect())


@pytest.mark.parametrize(
    "intervals, expected",
    [
        ([(20, 60)], [(0, 20, 60)]),
        ([(80, 150)], [(0, 80, 100), (1, 112, 150)]),  # crosses into the next document
        ([(102, 140)], [(1, 112, 140)]),  # begins inside the separator
        ([(21, 61)], [(0, 22, 60)]),  # odd ends are drawn in
        ([(20, 60), (40, 90)], [(0, 20, 60), (0, 60, 90)]),  # overlaps the cut before it
        ([(90, 118)], [(0, 90, 100)]),  # the rest is too short
        ([(96, 99)], []),
        ([(12, 300)], [(0, 12, 100), (1, 112, 200), (2, 212, 300)]),
    ],
)
def test_adjusted_intervals(spark, intervals, expected):
    assert adjust(spark, intervals, [100, 200, 300], threshold=10) == expected


def test_touching_intervals_merge(spark):
    spans = spark.createDataFrame([(1, 0, 5), (1, 5, 8), (1, 9, 12), (1, 1, 3), (2, 0, 1)], "doc_id bigint, start bigint, end bigint")
    assert sorted(tuple(r) for r in substring.merge_intervals(spans).collect()) == [(1, 0, 8), (1, 9, 12), (2, 0, 1)]


def test_minima_by_fractions_are_exact():
    """Remainders at both ends of their range, against whole numbers of any size."""
    import numpy as np

    prime, rng = fuzzy.PRIME, random.Random(5)
    hashes = [0, 1, 2, prime - 2, prime - 1, *(rng.randrange(prime) for _ in range(400))]
    a = [1, 2, prime - 2, prime - 1, *(rng.randrange(1, prime) for _ in range(60))]
    for shift in (-1, 0, 1):
        b = [(shift - x * rng.choice(hashes)) % prime for x in a]
        block = np.array(hashes, dtype=np.uint64)
        for blocks in ([block], [block[:7], block[7:300], block[300:]]):
            got = fuzzy.minima(blocks, np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
            assert got.dtype == np.uint32 and got.tolist() == [min((x * h + y) % prime for h in hashes) for x, y in zip(a, b)]
        for h in hashes[:40]:
            got = fuzzy.minima([np.array([h], dtype=np.uint64)], np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
            assert got.tolist() == [(x * h + y) % prime for x, y in zip(a, b)]


def test_texts_go_to_python_in_bounded_batches(spark):
    """Where the session has Spark's own bounds, a worker is sent at most 1,000 texts at once."""
    from gleaner.catalog import QUERIES

    docs, small = documents(spark, ["a b c", "a b d"]), "/root/testdata/sf0.001"
    plain = {"maxRecordsPerBatch": "10000", "maxBytesPerBatch": "67108864b"}
    for use in (
        lambda: fuzzy.lsh_bands(docs),
        lambda: fuzzy.lsh_edges(docs),
        lambda: substring.repeated_kgrams(docs),
        lambda: QUERIES["minhash"](spark, small),
        lambda: QUERIES["unicode_nfc"](spark, small),
    ):
        for name, value in plain.items():
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)
        use()
        assert [spark.conf.get(f"spark.sql.execution.arrow.{name}") for name in plain] == ["1000", "8m"]


def test_reconstruction_finds_the_cuts_once(spark):
    """Both uses of the cuts read what was stored: no window over their positions is left in the plan."""
    from gleaner.catalog import QUERIES

    plan = QUERIES["reconstruct_documents"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Window" not in plan


def plain_shingles(text, width=24):
    return [None] if text is None else sorted({text[i : i + width] for i in range(max(len(text) - width, 0) + 1)})


def odd_texts():
    letters = random.Random(4)
    texts = ["", None, "short", "x" * 24, "x" * 200, "a" * 23, "é" * 30, "ab😀" * 40, "日本語" * 20, "zero\0" * 9, None, ""]
    texts += ["".join(letters.choices("ab", k=letters.randrange(60))) for _ in range(100)]
    return texts + ["".join(letters.choices("abé語😀 ", k=3000)), "one line that comes again\n" * 50]


def test_shingles_of_odd_texts(spark):
    texts = odd_texts()
    got = fuzzy.char_shingles(documents(spark, texts)).collect()
    assert {r.doc_id: sorted(r.shingles) if r.shingles != [None] else [None] for r in got} == dict(enumerate(map(plain_shingles, texts)))
    assert fuzzy.char_shingles(documents(spark, texts).limit(0)).count() == 0
    assert [r.shingles for r in fuzzy.char_shingles(documents(spark, [None, ""])).orderBy("doc_id").collect()] == [[None], [""]]


@pytest.mark.parametrize("same_hash", [False, True])
@pytest.mark.parametrize("width", [1, 3, 24])
def test_shingles_in_lots(monkeypatch, width, same_hash):
    if same_hash:  # windows of a text can only be told apart by their bytes
        monkeypatch.setattr(fuzzy, "_powers", lambda base, n: np.zeros(n, dtype=np.uint64))
    texts, got = odd_texts(), {}
    for numbers, lists in fuzzy.shingle_lots(pa.array(["before", *texts], pa.large_string()).slice(1), width, lot=7):
        lists.validate(full=True)
        for number, some in zip(numbers.to_pylist(), lists.to_pylist()):
            assert 0 < len(some) <= 7
            got.setdefault(number, []).extend(some)
    assert {i: sorted(x) if x != [None] else x for i, x in got.items()} == {i: plain_shingles(t, width) for i, t in enumerate(texts)}


def test_list_summary():
    lists = [["a", "b" * 55, "b" * 56, "c" * 63, "é" * 64, "x" * 200], [None], [""], *map(plain_shingles, odd_texts())]
    plain = [
        (1, None, None, None, None)
        if some == [None]
        else (len(some), min(some), max(some), sum(map(len, some)), min(hashlib.md5(x.encode()).hexdigest() for x in some))
        for some in lists
    ]
    got = digests.list_summary(pa.array([["before"], *lists, ["behind"]]).slice(1, len(lists)))
    assert [*zip(*(column.to_pylist() for column in got))] == plain


def test_shingle_query_sorts_no_row_a_character(spark, tmp_path):
    texts = [*odd_texts(), "y" * 70_000 + "".join(map(chr, range(0x4E00, 0x9E00))) * 4]
    documents(spark, texts).union(documents(spark, texts[:9])).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["char_shingles"](spark, str(tmp_path))
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        some, times = plain_shingles(text), 2 if i < 9 else 1
        low = None if text is None else min(hashlib.md5(x.encode()).hexdigest() for x in some)
        chars = None if text is None else times * sum(map(len, some))
        assert tuple(rows[i]) == (i, times * len(some), some[0], some[-1], chars, low)
