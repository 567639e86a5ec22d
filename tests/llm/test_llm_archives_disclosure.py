"""Archives byte by byte, personal data against plain patterns."""

import glob
import gzip
import hashlib
import math
import random
import re

import pytest
from llm_helpers import ODD, table
from pyspark.sql import functions as F

from gleaner.llm import archives, disclosure
from gleaner.llm.disclosure import GENERALISE, LEAST_RATIO, REMOVE, SUPPORT

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
PLAIN = {
    "email": EMAIL,
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_archives_round_trip(spark, tmp_path):
    """Long pages in segments, copies as revisits, payloads that look like records."""
    tricky = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 5
    pages = [(1, "u", "x" * 99), (2, "u", "x" * 99), (3, None, "é" * 60), (4, "a\r\nb", "é" * 60), (5, "u", tricky), (6, "u", None),
             (7, "u", ""), (8, "u", "".join(chr(200 + i % 3000) for i in range(100_000))), (None, "u", "é" * 60), (9, "u", tricky)]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "w")
    planned = archives.plan_records(docs)
    archives.write_archives(archives.to_records(planned), path)
    records = archives.read_archives(spark, path).collect()
    payloads = {r.page_id: r.payload for r in records if r.kind == "response"}
    for i, _, html in pages:
        if i in payloads:
            assert bytes(payloads[i]) == (html or "").encode()
    got = {r.page_id: r for r in archives.resolve(archives.read_archives(spark, path)).collect()}
    assert {i: (got[i].record_type, got[i].refers_to) for i, *_ in pages} == {
        1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3), 5: ("response", None), 6: ("response", None),
        7: ("response", None), 8: ("response", None), None: ("revisit", 3), 9: ("revisit", 5)}
    for i, _, html in pages:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].verified) == (len(data), hashlib.sha256(data).hexdigest(), True)
    raw = b"".join(gzip.decompress(open(f, "rb").read()) for f in glob.glob(path + "/*.gz"))
    assert raw.count(b"WARC-Segment-Origin-ID") >= 6 and raw.count(b"WARC-Segment-Total-Length") == 1


def test_segments_that_are_missing_or_wrong(spark):
    rows = [("a", 1, None, b"ab"), ("a", 2, 4, b"cd"), ("b", 1, None, b"ab"), ("b", 3, 4, b"cd"), ("c", 1, None, b"ab"), ("c", 2, 5, b"cd"), ("d", 2, 4, b"cd"),
            ("e", 2, 3, b"c"), ("e", 1, None, b"ab"), ("f", 1, None, b"a"), ("f", 1, None, b"b"), ("f", 2, 3, b"c")]
    df = spark.createDataFrame([(None, None, "response", None, None, o, n, t, b) for o, n, t, b in rows], archives.FIELDS)
    got = {r.record_id: (r.complete, r.block and bytes(r.block)) for r in archives.reassembled(df).collect()}
    assert got == {"a": (True, b"abcd"), "b": (False, None), "c": (False, None), "d": (False, None), "e": (True, b"abc"), "f": (False, None)}


def test_chunked_framing():
    assert archives.unchunk(b"3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n") == b"abcde"
    assert archives.unchunk(b"0\r\n\r\n") == b""
    for broken in (b"", b"3\r\nab", b"zz\r\nabc\r\n0\r\n\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        assert archives.unchunk(broken) is None


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [(2 * int(d) - 9 * (int(d) > 4)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_base_spans_against_plain_patterns(spark):
    r = random.Random(8)
    pieces = ["a", "b.c", "@", ".", "x@y.z", "%", "-", "+", "1", "255", "256", "4111 1111 1111 1111", "+1 (988) 555-2485", " ", "\n", "é", "😀", "00001", "1.2.3.4", "(", "0" * 20]
    rows = [(1000 + i, "".join(r.choice(pieces) for _ in range(r.randint(0, 25)))) for i in range(1500)]
    rows += [(1, " ".join(f"u{i}@h{i}.xy" for i in range(3000))), (2, "a" * 300_000), (3, "1" * 300_000), (4, "a." * 50_000), (5, "x@" + "a." * 50_000 + "b")]
    got = {x.doc_id: x for x in disclosure.digest_rows(table(spark, rows)).collect()}
    for i, text in rows:
        want = plain_spans(text) if i > 4 or i == 1 else []
        assert got[i].spans == ",".join(want), text[:200]
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()


def test_terms_that_reveal_an_entity(spark):
    """A name that stands beside one address, and hardly elsewhere, goes; common words and clean texts stay."""
    r = random.Random(1)
    common = [f"wo{c}" for c in "abcdefghijklmnop"]
    fill = lambda: " ".join(r.choice(common) for _ in range(30))
    rows = [(i, f"{fill()} ask Zebulon at zeb@corp.example.com about it {fill()}") for i in range(8)]
    rows += [(50 + i, f"{fill()} so Zebulon, came {fill()}") for i in range(1)]
    rows += [(100 + i, f"{fill()} ask {fill()} about it at noon") for i in range(600)]
    rows += [(5000 + i, rows[0][1]) for i in range(30)]
    docs = table(spark, rows)
    got = {x.doc_id: x.spans for x in disclosure.digest_rows(docs).collect()}
    for i, text in rows:
        names = [f"term:{m.start()}:{m.end()}" for m in re.finditer("Zebulon", text)]
        assert got[i] == ",".join(plain_spans(text) + names), got[i]
    clean = {x.doc_id: x.sanitised for x in disclosure.sanitise(docs).collect()}
    assert "Zebulon" not in "".join(clean.values()) and "zeb@" not in "".join(clean.values())
    assert clean[100] == dict(rows)[100] and "[EMAIL] about it" in clean[3]


def test_sanitise_keeps_everything_else(spark):
    rows = {i: t for i, t, *_ in ODD}
    for x in disclosure.sanitise(table(spark, ODD)).collect():
        if x.doc_id is not None:
            assert (x.sanitised == rows[x.doc_id]) or plain_spans(rows[x.doc_id])
    assert "[EMAIL]" in [x.sanitised for x in disclosure.sanitise(table(spark, ODD)).collect() if x.text and "me@" in x.text][0]


def marked(spark, rows):
    """Per document the terms that are marked in it."""
    text = dict(rows)
    spans = {x.doc_id: re.findall(r"term:(\d+):(\d+)", x.spans) for x in disclosure.digest_rows(table(spark, rows)).collect()}
    return {i: {text[i][int(a) : int(b)].lower() for a, b in at} for i, at in spans.items()}


def test_terms_far_from_the_entity_and_of_any_form(spark):
    """A name in the header tells of an address in the signature; digits, hyphens, apostrophes and lengths don't matter."""
    r = random.Random(2)
    fill = lambda n: " ".join(f"wo{r.choice('abcdefghijklmnop')}" for _ in range(n))
    telling = ["Zebulon", "jdoe84", "O'Brien", "Anna-Maria", "4711", "Qx", "y" * 60]
    rows = [(i, f"{' '.join(telling)} {fill(300)} mail zeb@corp.example.com {fill(2)}") for i in range(6)]
    rows += [(100 + i, f"mail {fill(320)}") for i in range(200)]
    got = marked(spark, rows)
    assert all(got[i] == {t.lower() for t in telling} for i in range(6))
    assert not any(got[100 + i] for i in range(200))


def test_terms_of_hot_entities_and_in_small_tables(spark):
    """An entity in a third of all texts has its terms, while words that are as common elsewhere stay; so in a table of 20 texts."""
    r = random.Random(3)
    fill = lambda: " ".join(f"wo{r.choice('abcdefghijklmnop')}" for _ in range(30))
    for n in (20, 300):
        rows = [(i, f"{fill()} Zebulon {fill()} zeb@corp.example.com {fill()}" if i % 3 == 0 else fill() + fill()) for i in range(n)]
        assert marked(spark, rows) == {i: {"zebulon"} if i % 3 == 0 else set() for i in range(n)}
    # In more than half of all texts: a common word's chance is just the entity's share.
    rows = [(i, f"{fill()} Zebulon {fill()} zeb@corp.example.com {fill()}" if i % 3 else fill() + fill()) for i in range(300)]
    assert marked(spark, rows) == {i: {"zebulon"} if i % 3 else set() for i in range(300)}


BROKEN = [
    b"1\r\na\r\n-6\r\n0\r\n\r\n", b"+1\r\na\r\n0\r\n\r\n", b"1_0\r\naaaaaaaaaaaaaaaa\r\n0\r\n\r\n", b"0x1\r\na\r\n0\r\n\r\n", b" 1\r\na\r\n0\r\n\r\n",
    b"0\r\n", b"1\r\na\r\n0\r\n", b"1\r\na\r\n", b"1\r\nab\r\n0\r\n\r\n", b"2\r\na\r\n0\r\n\r\n", b"", b"\r\n", b"\r\n\r\n", b"g\r\n\r\n",
    b"1\na\n0\n\n", b"1\r\na\r\n0\r\n\r\nmore", b"1\r\na0\r\n\r\n", b"ffffffffffffffffffffffff\r\na\r\n0\r\n\r\n",
    b"1;\r\r\na\r\n0\r\n\r\n", b"1\r\na\r\n0\r\nno colon\r\n\r\n", b"1\r\na\r\n00000000000000000\r\n\r\n",
]


@pytest.mark.parametrize("body", BROKEN)
def test_broken_chunk_framing(body):
    assert archives.unchunk(body) is None


@pytest.mark.parametrize(
    "body, payload",
    [
        (b"0\r\n\r\n", b""),
        (b"3\r\nabc\r\n0\r\n\r\n", b"abc"),
        (b"A;x=y\r\n0123456789\r\n00\r\nTrailer: v\r\n\r\n", b"0123456789"),
        (b"2 \r\n\r\n\r\n0\r\n\r\n", b"\r\n"),
    ],
)
def test_chunk_framing(body, payload):
    assert archives.unchunk(body) == payload


def told_terms(texts):
    """``{term: action}`` by going through all distinct texts, terms and entities (small letters and ASCII only)."""
    texts = sorted({t or "" for t in texts})
    split = lambda text: {w.strip(".,;:!?\"'()[]{}<>*") for w in re.findall("[^\x20\x09-\x0d]+", text)}
    of_word = lambda words: {w for w in words if re.search("[a-z0-9]", w)}
    entities, terms, inner = [], [], []
    for text in texts:
        found = {(k, m.group(), m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if valid(k, m.group())}
        apart, at = "", 0
        for start, end in sorted((a, b) for k, _, a, b in found if k in ("card", "phone")):
            if start >= at:
                apart, at = apart + text[at:start] + "\ue000", end
        apart += text[at:]
        entities.append({v for _, v, _, _ in found})
        terms.append(of_word(split(apart)) - {v for k, v, _, _ in found if k in ("email", "ip")} if found else set())
        inner.append(of_word(split(text)) - terms[-1] if found else set())
    actions, n = {}, len(texts)
    for term in set().union(*terms):
        n_w = sum(term in t for t in terms)
        n_t = sum(term in split(t) for t in texts) - sum(term in t for t in inner)
        for entity in set().union(*entities):
            n_te, n_e = sum(term in t and entity in e for t, e in zip(terms, entities)), sum(entity in e for e in entities)
            if n_te < max(SUPPORT, GENERALISE * n_w, GENERALISE * n_t) or n_te * n <= n_t * n_e:
                continue
            cells = [(n_te, n_t, n_e), (n_t - n_te, n_t, n - n_e), (n_e - n_te, n - n_t, n_e), (n - n_t - n_e + n_te, n - n_t, n - n_e)]
            if 2 * sum(x * math.log(x * n / (a * b)) for x, a, b in cells if x) >= LEAST_RATIO:
                actions[term] = max(actions.get(term, ""), "remove" if n_te >= REMOVE * n_t else "generalise", key=("", "generalise", "remove").index)
    return actions


@pytest.mark.parametrize("light, task", [(64, 1_000_000), (2, 4), (0, 1)])
def test_terms_against_all_pairs(spark, monkeypatch, light, task):
    """Texts with few entities and with many, in one task or several, give what counting every pair gives."""
    monkeypatch.setattr(disclosure, "LIGHT", light)
    monkeypatch.setattr(disclosure, "TASK_PAIRS", task)
    r = random.Random(light)
    names = [f"name{i}" for i in range(25)]
    addresses = [f"m{i}@corp.xy" for i in range(8)] + ["10.0.0.7", "+44 20 7946 0958"]
    rows = []
    for i in range(300):
        people = [r.randrange(25) for _ in range(r.choice([0, 1, 1, 2, 9]))]
        said = [names[p] for p in people if r.random() < 0.9] + [addresses[p % 10] for p in people if r.random() < 0.8]
        said += [r.choice(["20", "so", "as", "we", "go", names[3]]) for _ in range(r.randint(1, 6))]
        r.shuffle(said)
        rows.append((100 + i, " ".join(said)))
    rows += [(900 + i, rows[5][1]) for i in range(20)] + [(1, None), (2, "")]
    want = told_terms([t for _, t in rows])
    assert 3 < len(want) < 29 and set(want.values()) == {"remove", "generalise"}
    for x in disclosure.span_rows(table(spark, rows)).collect():
        text = dict(rows)[x.doc_id] or ""
        base = [tuple(map(int, s.split(":")[1:])) for s in plain_spans(text)]
        words = [(want[m.group()], m.start(), m.end(), m.group()) for m in re.finditer("[^ ]+", text) if m.group() in want]
        assert [tuple(s) for s in x.terms] == [w for w in words if not any(a < w[2] and w[1] < b for a, b in base)]


def test_replaced_against_plain_slices(spark):
    r = random.Random(4)
    rows = []
    for i in range(300):
        text = "".join(r.choice("ab \n😀é") for _ in range(r.choice([0, 1, 5, 1023, 1024, 1025, 5000])))
        ends = sorted(r.sample(range(len(text) + 1), min(len(text) + 1, r.choice([0, 1, 2, 9, 60]))))
        rows.append((i, text, sorted((a, min(len(text), a + r.choice([0, 1, 3, 2000])), "k") for a in ends)))
    rows.append((300, "x" * 400_000, [(a, a + 2, "k") for a in range(0, 399_990, 20)]))
    rows.append((301, "x", None))
    df = spark.createDataFrame(rows, "i int, text string, spans array<struct<start:int,end:int,kind:string>>").repartition(3)
    got = {x.i: x.out for x in df.select("i", disclosure.replaced(F.col("text"), F.col("spans"), lambda s: F.upper(s["kind"])).alias("out")).collect()}
    for i, text, spans in rows[:-1]:
        want, at = "", 0
        for start, end, _ in spans:
            if start >= at:
                want, at = want + text[at:start] + "K", end
        assert got[i] == want + text[at:]
    assert got[301] is None
