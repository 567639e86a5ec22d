"""Small tables with every odd case, and plain versions of what the operators do."""

import re

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Further columns, some called as the operators call theirs.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("h", "size", "key", "_hash", "_size", "n", "klass", "rows", "label", "a.b")],
    ]
)


def table(spark, rows, parts=3):
    """``rows``: (doc_id, text) with lang and source as options."""
    full = []
    for r in rows:
        i, text, lang, source = (*r, *[None] * (4 - len(r)))
        full.append((i, text, lang, source, None if text is None else len(text), *["x"] * 10))
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


LONG = " ".join(f"word{i % 7919} of line{i % 13}" for i in range(40_000))

ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away again today.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away again today.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away again today.", "en", "a"),
    (3, "The quick  brown fox jumps over the lazy dog\nand runs away again today.", "en", None),
    (2**62 + 1, "a text with a large id and words of its own", "en", "a"),
    (None, "The quick brown fox jumps over the lazy dog and runs away again today.", None, "b"),
    (None, "a text without an id that nothing else repeats, mail me@example.com", None, None),
    (4, "", "en", "a"),
    (5, None, None, None),
    (6, None, "en", "c"),
    (7, " \t\r\n\x0b\x0c ", "fr", "c"),
    (8, "one", "de", "c"),
    (9, "one", "de", "c"),
    (10, LONG, "en", "d"),
    (11, LONG + " more", "en", "d"),
    (12, "é ü 中文 😀　nbsp x don't  stop\n\n\nnow 12345 <|endoftext|> end", "xx", "d"),
    (13, "x" * 5000 + "4" * 3000 + "@" * 50 + "." * 50, "xx", "é"),
]


def components(links, ids):
    """The least node reachable from each id."""
    at = {i: i for i in ids}

    def root(i):
        while at[i] != i:
            at[i] = at[at[i]]
            i = at[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        at[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def shingles(text, size=3):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
