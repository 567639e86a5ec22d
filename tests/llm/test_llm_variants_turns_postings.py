"""Spelling variants, repaired conversations and benchmark passages against plain versions."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest
from llm_helpers import LOWER, ODD, table
from pyspark.sql import types as T

from gleaner.llm import postings, spelling, turns

# -- spelling --------------------------------------------------------------------------


def is_near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 2}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and is_near(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def misspelt(seed=4):
    """Words with one beginning and one end, edited once and twice, in numbers from 2 to 400."""
    r = random.Random(seed)
    letters = "abcéÿþ"
    bases = ["abcabcab" + "".join(r.choice(letters) for _ in range(r.randint(0, 5))) for _ in range(12)]
    bases += ["".join(r.choice(letters) for _ in range(r.randint(7, 9))) for _ in range(60)]
    words = []
    for b in bases:
        words += [b] * r.choice([2, 30, 400])
        for _ in range(8):
            e, at = b, r.randrange(len(b))
            for _ in range(r.choice([1, 1, 2])):
                at = r.randrange(len(e))
                e = r.choice([e[:at] + r.choice(letters) + e[at:], e[:at] + e[at + 1 :], e[:at] + r.choice(letters) + e[at + 1 :]])
            words += [e] * r.choice([1, 2, 3, 30])
    r.shuffle(words)
    return [(i, " ".join(words[i::40]).title() if i % 3 else " -- ".join(words[i::40]), "en", "a") for i in range(40)]


@pytest.mark.parametrize("part_words", [spelling.PART_WORDS, 4])
def test_variants(spark, part_words):
    """With small parts the ranges of places are cut down to single ones."""
    rows = misspelt() + ODD
    got = sorted(tuple(r) for r in spelling.variants(table(spark, rows), part_words=part_words).collect())
    want = plain_variants(rows)
    assert got == want
    assert len({w for w, f, *_ in want if f}) > 20 and any(r not in (w, f) for w, f, r, *_ in want)


def test_variants_of_nothing(spark):
    assert spelling.variants(table(spark, [], 1)).count() == 0
    assert spelling.variants(table(spark, [(1, None), (2, ""), (3, "a few short words"), (None, "seventy")])).count() == 0


def test_acceptor_is_minimal():
    a = spelling.Acceptor(["abend", "abends", "bend", "bends", "send", "sends"])
    assert len(a.arcs) == 7  # start, a-, -bend, -end, -nd, -d and -s with one final state each shared


# -- conversations -----------------------------------------------------------------------

NEXT, STEP = (2, 2, 3, 2), ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})


def cheapest(symbols):
    """``(cost, audit)`` by search; symbols are None (must go) or (initial, truncated)."""
    best = {}

    def least(i, q, inserts=0):
        if (i, q, inserts) in best:
            return best[i, q, inserts]
        options = []
        if i == len(symbols):
            if q in (0, 3):
                options.append((0, ""))
        else:
            c, a = least(i + 1, q)
            options.append((c + 3, "D" + a))
            if symbols[i] is not None:
                initial, late = symbols[i]
                if initial in STEP[q]:
                    c, a = least(i + 1, STEP[q][initial])
                    options.append((c + late, "K" + a))
                c, a = least(i + 1, NEXT[q])
                options.append((c + 2 + late, "R" + a))
        if inserts < 2:
            c, a = least(i, NEXT[q], inserts + 1)
            options.append((c + 2, "I" + a))
        best[i, q, inserts] = min(options, default=(10**6, ""))
        return best[i, q, inserts]

    return least(0, 0)


def plain_repair(rows, damage=True):
    def shown(x):
        return " " if x is None else str(x)

    groups = {}
    for conv, turn, role, text in rows:
        group = groups.setdefault(conv, [])
        role, text, h = shown(role), shown(text), zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20 if damage else 19
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        group += [(turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    out = []
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        given = [t for t, _, _ in group if t is not None]
        gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
        seen, symbols, n = set(), [], Counter()
        for _, role, text in group:
            bare = re.findall("[^\x20\x09-\x0d]", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            n[fault] += 1
            seen.add((role, text))
            symbols.append(None if fault in ("blank", "duplicate") else (role[:1], int(fault == "truncated")))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
        cost, audit = cheapest(symbols)
        lines, q, i = [], 0, 0
        for edit in audit:
            name = "assistant" if q == 2 else "user"
            if edit == "I":
                lines.append(f"{name}:")
            elif edit != "D":
                lines.append(f"{group[i][1] if edit == 'K' else name}:{group[i][2]}")
            if edit != "D":
                q = STEP[q][lines[-1][0]]
            i += edit != "I"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=str)


CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in ("rows", "same", "said", "copies", "slice", "conv", "a.b")],
    ]
)


def talk(spark, rows, parts=4):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], CONVERSATIONS).repartition(parts)


def talks(seed=7, long=200):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and so", "", " \t\n", None, "Yes.", "é ü 😀.", "end. ", "a:b\nc."]
    roles = ["user", "assistant"] * 6 + ["system", "tool", "", None, "User", "units"]
    rows = []
    for conv in [*range(60), None, -5, 2**60 + 1]:
        for turn in range(r.randint(1, 9)):
            rows.append((conv, r.choice([turn] * 6 + [None, turn * 3]), r.choice(roles), r.choice(texts) if r.random() < 0.6 else f"Text {r.random()}."))
    for turn in range(long):  # one long conversation, with equal rows
        rows.append((777, turn // 3, ("user", "assistant")[turn % 2], r.choice(["Right.", f"Word {turn}", f"Line {turn}."])))
    rows += [(778, 5, "user", "Same.")] * 30 + [(779, None, None, None)] * 3 + [(780, 1, "user", "x. " * 50_000)]
    rows += [(900 + i, i, "user", "One.") for i in range(40)]  # some are dropped whole
    return rows


@pytest.mark.parametrize("chunk_rows", [turns.CHUNK_ROWS, 3])
def test_repair(spark, monkeypatch, chunk_rows):
    """With small chunks nearly every conversation is put together from several."""
    monkeypatch.setattr(turns, "CHUNK_ROWS", chunk_rows)
    rows = talks()
    got = sorted((tuple(r) for r in turns.repair_rows(talk(spark, rows)).collect()), key=str)
    want = plain_repair(rows)
    assert [g for g, w in zip(got, want) if g != w] == [] and len(got) == len(want)
    assert any(w[7] == "" for w in want)


def test_repair_without_damage(spark):
    rows = talks(8, 40)
    got = sorted((tuple(r) for r in turns.repaired(turns.plain(talk(spark, rows))).collect()), key=str)
    assert got == plain_repair(rows, damage=False)
    assert turns.repair_rows(talk(spark, [], 1)).count() == 0


def test_block_tables_equal_search():
    """Cost and edits of random symbol strings, by blocks and by a search over edit strings."""
    t, r = turns.tables(), random.Random(2)
    for _ in range(400):
        s = bytes(r.randrange(9) for _ in range(r.randint(0, 10)))
        front, added = t.price(s)
        edits, q = t.trace(s, 0, 0)
        heap, want = [(0, "", 0, 0)], None
        while want is None:  # edit strings by cost, then letters
            c, a, i, p = heapq.heappop(heap)
            if i == len(s) and p in (0, 3):
                want = c, a
                continue
            if not a.endswith("III"):
                heapq.heappush(heap, (c + 2, a + "I", i, NEXT[p]))
            if i < len(s):
                heapq.heappush(heap, (c + 3, a + "D", i + 1, p))
                if s[i] != turns.GONE:
                    initial, late = "sua-"[s[i] >> 1], s[i] & 1
                    if initial in STEP[p]:
                        heapq.heappush(heap, (c + late, a + "K", i + 1, STEP[p][initial]))
                    heapq.heappush(heap, (c + 2 + late, a + "R", i + 1, NEXT[p]))
            if len(heap) > 60_000:
                break
        if want:
            assert (int(added[0]) + t.vectors[int(front[0])][0], "".join(edits) + t.closing(q)) == want


# -- benchmark passages --------------------------------------------------------------------

ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("words", T.StringType())])


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain_contamination(rows, items, size=10):
    windows = []
    for i, text in items:
        w = plain_words(text)
        windows += [(i, w[k : k + size]) for k in range(max(1, len(w) - size + 1)) if w]
    out = []
    for doc_id, text, *_ in rows:
        w = plain_words(text)
        at = {}
        for k, x in enumerate(w):
            at.setdefault(x, []).append(k)
        hit, named = set(), set()
        for i, win in windows:
            for k in at.get(win[0], []):
                if w[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    named.add(i)
        names = sorted(str(i) for i in named if i is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def passages(seed=9):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "of", "a", "and", "Zaß", "x1", "é", "not", "in", "or"])
    texts = [" ".join(word() for _ in range(r.randint(3, 40))) for _ in range(12)]
    items = [(i, t) for i, t in enumerate(texts)] + [(3, "the of a"), (40, "é"), (41, None), (42, " --- "), (None, "x1 x1 not"), (7, texts[2]), (8, texts[2])]
    rows = []
    for i in range(80):
        parts = [" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(2)]
        if i % 3 == 0:
            t = r.choice(texts)
            parts.insert(1, t.upper() if i % 2 else t.replace(" ", " -\n"))
        rows.append((i, " ".join(parts), "en", "a"))
    return rows, items


@pytest.mark.parametrize("small", [False, True])
def test_contamination(spark, monkeypatch, small):
    """With small limits there are many blocks, several lots, and an index of all terms."""
    if small:
        for name, value in (("BLOCK_WORDS", 60), ("BLOCK_DOCS", 5), ("TERMS_SENT", 4), ("PHRASES_SENT", 20)):
            monkeypatch.setattr(postings, name, value)
    rows, items = passages()
    rows += ODD
    bench = spark.createDataFrame([(*x, "w") for x in items], ITEM)
    got = sorted((tuple(r) for r in postings.digest_rows(table(spark, rows), bench).collect()), key=str)
    assert got == plain_contamination(rows, items)
    none = postings.digest_rows(table(spark, ODD), bench.limit(0)).collect()
    assert len(none) == len(ODD) and not any(r.contaminated for r in none)
    assert postings.digest_rows(table(spark, [], 1), bench).count() == 0


def test_phrases_and_proximity(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_DOCS", 7)
    rows, _ = passages(3)
    index = postings.build_index(table(spark, rows))
    wanted = [("p", ["the", "of"]), ("q", ["zaß", "x1", "zaß"]), ("r", ["é", "missing"]), ("s", []), ("t", ["not", "or", "é", "in"])]
    phrases = spark.createDataFrame(wanted, "phrase_id string, words array<string>")
    exact, near = set(), set()
    for i, text, *_ in rows:
        w = plain_words(text)
        for name, phrase in wanted:
            if not phrase:
                continue
            exact |= {(str(i), name, k) for k in range(len(w)) if w[k : k + len(phrase)] == phrase}
            spans = {(a, b) for a in range(len(w)) for b in range(a, min(len(w), a + 6)) if set(phrase) <= set(w[a : b + 1])}
            near |= {(str(i), name, a, b) for a, b in spans if not any((c, d) != (a, b) and a <= c and d <= b for c, d in spans)}
    assert exact and near
    found = [tuple(r) for r in postings.phrase_matches(index, phrases).collect()]
    assert len(found) == len(exact) and set(found) == exact
    found = [tuple(r) for r in postings.proximity_matches(index, phrases, 6).collect()]
    assert len(found) == len(near) and set(found) == near
