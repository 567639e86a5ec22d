"""Token operators against the tokenizer's own library."""

import hashlib
import os
import random

import numpy as np
import pytest
from llm_helpers import ODD, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleaner.llm import attribution, bpe
from gleaner.llm.queries import tokenizer_path

POOL = ["a", "b", " ", "  ", "\n", "\n\n", "\t", "'", "'s", "'re", "é", "中", "文", "😀", "1", "23", "!", "...", "　", " ",
        "<|endoftext|>", "<|endof", "Q", "x", "zq", "_", "-", "ñ", "\r\n", "ll", "don't", "\x0b", "क्षि", "\x85", " ", "\x1c", "\x7f"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def texts(n, seed=1, longest=14):
    r = random.Random(seed)
    return ["".join(r.choice(POOL) for _ in range(r.randint(0, longest))) for _ in range(n)]


def test_fragments_give_the_same_ids(library):
    vocabulary = bpe.Vocabulary(tokenizer_path())
    given = texts(20_000)
    for text, ids in zip(given, vocabulary.ids([t.encode() for t in given])):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert vocabulary.decode(ids) == library.decode(want, skip_special_tokens=False), text


def test_long_unbroken_text_is_cut():
    vocabulary = bpe.Vocabulary(tokenizer_path())
    r = random.Random(2)
    text = "".join(r.choice("qzxjkvw0123456789QZXJK") for _ in range(200_000)).encode()
    assert max(map(len, vocabulary.fragments(text))) < 1_000


def test_encode_rows(spark, library):
    rows = ODD + [(100 + i, t) for i, t in enumerate(texts(200, 3, 60))]
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_rows(table(spark, rows), tokenizer_path()).collect())
    want = []
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want)


def spans(library, text):
    """First character and the one after the last of each token, by its bytes."""
    letters, data, at, out = bpe.byte_letters(), text.encode(), 0, []
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    for token in library.encode(text, add_special_tokens=False).tokens:
        n = len(token) if token != "<|endoftext|>" else len(token.encode())
        assert token == "<|endoftext|>" or all(c in letters for c in token)
        out.append((owner[at], owner[at + n - 1] + 1))
        at += n
    assert at == len(data)
    return out


@pytest.mark.parametrize("rule", attribution.RULES)
def test_sections_against_all_tokens(spark, library, rule):
    """Sections that overlap, leave gaps, are empty or lie outside, and split characters' tokens."""
    r = random.Random(4)
    rows, cuts = [], {}
    for i, text in enumerate(texts(150, 5, 40)):
        ends = [sorted(r.sample(range(len(text) + 3), 2)) for _ in range(r.randint(0, 5))] if len(text) > 2 else []
        rows.append((i, text, [a for a, _ in ends], [b for _, b in ends]))
        cuts[i] = (text, ends)
    docs = spark.createDataFrame(rows, "doc_id long, text string, s array<int>, e array<int>")
    got = {}
    for x in attribution.attribute(docs, tokenizer_path(), F.col("s"), F.col("e"), rule=rule).collect():
        got.setdefault(x.doc_id, {})[x.section] = x
    for i, (text, ends) in cuts.items():
        tokens = spans(library, text)
        key = [a if rule == "first" else b - 1 for a, b in tokens]
        for k, (a, b) in enumerate(ends):
            assert got[i][k].n_tokens == sum(a <= t < b for t in key), (text, a, b)
            across = sum((s < a < e or s < b < e) for s, e in tokens) if a < b else 0
            assert got[i][k].n_crossing == across, (text, a, b, tokens)
        assert got[i][-1].n_tokens == sum(all(not a <= t < b for a, b in ends) for t in key)
        assert got[i][-1].doc_tokens == len(tokens)


def test_tokenizer_works_on_few_fragments_at_once_and_without_threads():
    v = bpe.Vocabulary(tokenizer_path())
    real, given = v.tokenizer, []

    class Counting:
        def encode_batch_fast(self, some, **more):
            given.append(len(some))
            return real.encode_batch_fast(some, **more)

    v.tokenizer = Counting()
    text = " ".join(f"word{i} x" for i in range(9_000))
    assert v.ids([text.encode()])[0] == np.array(real.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert max(given) <= bpe._ENCODED < sum(given) and os.environ["TOKENIZERS_PARALLELISM"] == "false"
