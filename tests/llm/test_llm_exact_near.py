"""Duplicates against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_helpers import ODD, components, shingles, table
from pyspark.sql import functions as F

from gleaner.llm import exact, near


def plain_exact(rows):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((-len(text or ""), i is None, i or 0, i))
    out = []
    for i, text, *_ in rows:
        norm = re.sub("[\x20\x09-\x0d]", "", text or "")
        best = min(groups[norm])
        kept = (i, len(text or "")) == (best[3], -best[0])
        out.append((i, best[3], len(groups[norm]), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hash_of", [exact.content_hash, lambda n: F.unhex(F.substring(F.md5(n), 1, 2))])
def test_exact_rows(spark, hash_of):
    """The second hash has 256 values, so that unlike texts meet and must be told apart by their bytes."""
    rows = ODD + [(100 + i, f"text {i % 150} of many" + " " * (i % 3)) for i in range(600)]
    got = [tuple(r) for r in exact.duplicate_rows(table(spark, rows), hash_of=hash_of).collect()]
    assert sorted(got, key=str) == plain_exact(rows)


def test_exact_dedup_leaves_one_of_each(spark):
    kept = exact.exact_dedup(table(spark, ODD)).collect()
    norms = [re.sub("[\x20\x09-\x0d]", "", r.text or "") for r in kept]
    assert len(norms) == len(set(norms)) == len({re.sub("[\x20\x09-\x0d]", "", r[1] or "") for r in ODD})


def corpus(seed=5):
    """Copies edited a little, a shared passage, a large group of near copies, and short texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6)))
    passage = [word() for _ in range(40)]
    rows, i = [], 0
    for _ in range(60):
        base = [word() for _ in range(r.randint(3, 160))]
        if r.random() < 0.4:
            base[5:5] = passage
        for _ in range(r.choice([1, 1, 2, 4])):
            copy = [w if r.random() > r.choice([0, 0.01, 0.04]) else word() for w in base]
            rows.append((i, " ".join(copy), "en", "a"))
            i += 1
    base = [word() for _ in range(120)]
    for _ in range(80):
        copy = [w if r.random() > 0.02 else word() for w in base]
        rows.append((i, " ".join(copy).upper() if i % 2 else " ".join(copy), "en", "a"))
        i += 1
    rows += [(i + k, t, "en", "a") for k, t in enumerate(["a", "A", "a b", "a b c", "a  B\nc", "", None, "a b c d"])]
    return rows


def plain_near(rows, size=3, percent=85):
    sets = {i: shingles(t, size) for i, t, *_ in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    least = components(links, sets)
    return {i: (len(sets[i]), least[i], least[i] == i) for i in sets}


@pytest.mark.parametrize("blocks", [None, (16, 600)])
def test_near_rows(spark, monkeypatch, blocks):
    """With small blocks the large gathering is compared in many tasks."""
    if blocks:
        monkeypatch.setattr(near, "BLOCK_MEMBERS", blocks[0])
        monkeypatch.setattr(near, "BLOCK_SHINGLES", blocks[1])
    rows = corpus()
    got = near.near_duplicate_rows(table(spark, rows), size=3, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == plain_near(rows)
    got = near.near_duplicate_rows(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == plain_near(rows, 5, 80)


def test_overlaps_of_all_widths():
    """Few and many shared values, none, and equal sets: sizes of intersections as Python's sets give them."""
    r = np.random.default_rng(3)
    for m, n, top in [(2, 5, 8), (3, 64, 10**6), (17, 64, 90), (40, 300, 2000), (6, 1, 1)]:
        sets = [np.unique(r.integers(0, top, n)) for _ in range(m)]
        want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
        got = near._overlaps(sets)
        for i in range(m):
            for j in range(m):
                assert i == j or got[i, j] == want[i][j]


def test_near_without_ids(spark):
    rows = [(None, "a b c d e f"), (None, "A b c d e f"), (7, "a b c d e F"), (None, "x y z u v w"), (None, "x y z u v W")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near.near_duplicate_rows(table(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 7, False), (None, 7, False), (7, 7, True), (None, None, True), (None, None, True)], key=str)


def test_near_dedup_matches_rows(spark):
    rows = corpus(6)
    want = {i for i, (_, _, kept) in plain_near(rows, 5, 80).items() if kept}
    assert {r.doc_id for r in near.near_dedup(table(spark, rows)).collect()} == want
