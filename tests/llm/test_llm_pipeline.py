"""The registered queries against their SQL, the pipeline against a plain version."""

import hashlib
import re

import numpy as np
import pytest
from check import compare, duck
from llm_helpers import WORD, components, shingles
from tokenizers import Tokenizer

import corpus_pipeline
from gleaner.llm.queries import ORACLES, QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        result = compare(df, con, ORACLES[name])
        assert result.startswith("ok") and "TYPES" not in result, result
    else:
        rows = con.sql("SELECT count(*) FROM documents").fetchall()[0][0]
        assert df.select("doc_id").distinct().count() == rows


def squeeze(text):
    return re.sub("[\x20\x09-\x0d]", "", text)


def mixed(docs):
    """Copies of each document by a plain sort: sources in order, weights 3, 1, 2, capped at twice their size."""
    size = {d["doc_id"]: len(WORD.findall(d["text"])) for d in docs}
    sources = sorted({d["source"] for d in docs})
    total = {s: sum(size[d["doc_id"]] for d in docs if d["source"] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    capped, left = set(), 1.5 * sum(total.values())
    while True:
        level = (left - sum(2 * total[s] for s in capped)) / max(1, sum(weight[s] for s in sources if s not in capped))
        over = {s for s in sources if s not in capped and level * weight[s] > 2 * total[s]}
        if not over:
            break
        capped |= over
    copies = {}
    for s in sources:
        target = 2 * total[s] if s in capped else level * weight[s]
        each = min(2, int(target // total[s])) if total[s] else 0
        need, taken = target - each * total[s], 0
        own = sorted((d for d in docs if d["source"] == s), key=lambda d: int(hashlib.md5(f"{d['doc_id']}:{d['text']}".encode()).hexdigest()[:15], 16))
        for d in own:
            copies[d["doc_id"]] = each
            n = size[d["doc_id"]]
            if need > 0 and taken <= need and (taken + n <= need or taken + n - need < need - taken):
                copies[d["doc_id"]] += 1
            taken += n
    return {i: c if size[i] else 0 for i, c in copies.items()}


def test_pipeline_against_plain_version(spark, con):
    con.execute(f"CREATE TABLE verdicts AS {ORACLES['op6_quality_rules']}")
    docs = con.sql("SELECT d.doc_id, d.text, d.source FROM documents d JOIN verdicts v USING (doc_id) WHERE kept ORDER BY doc_id")
    docs = [dict(zip(("doc_id", "text", "source"), r)) for r in docs.fetchall()]
    best = {}
    for d in docs:
        key = squeeze(d["text"])
        if key not in best or (-len(d["text"]), d["doc_id"]) < (-len(best[key]["text"]), best[key]["doc_id"]):
            best[key] = d
    docs = sorted(best.values(), key=lambda d: d["doc_id"])
    sets = {d["doc_id"]: shingles(d["text"], 5) for d in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = components(links, sets)
    docs = [d for d in docs if least[d["doc_id"]] == d["doc_id"]]
    copies = mixed(docs)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = []
    for d in docs:
        ids = tokenizer.encode(d["text"], add_special_tokens=False).ids
        row = (d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(d["text"].encode()).hexdigest())
        want += [row] * copies[d["doc_id"]]
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(want) > 100
    assert sorted(map(tuple, got)) == sorted(want)
