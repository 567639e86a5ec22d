"""Benchmark decontamination by a positional inverted index.

The words of the documents are stored as postings, block by block: one row of the index
holds some documents whole and, for each term, the sorted places at which it stands. A row
is never cut, so a search reads the index where it lies and nothing moves; a term
that stands in all texts is spread over all blocks. A phrase starts from the list of its
rarest term (by its count in the whole corpus), shifted by the term's offset in the phrase,
and is intersected with the other shifted lists, rarest first, until nothing or a match is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.text import bounded_batches, column, id_as_text, id_type
from gleaner.session import store

WINDOW_WORDS = 10
#: A block of the index is closed at so many words or documents; a longer document is a block alone.
BLOCK_WORDS = 400_000
BLOCK_DOCS = 10_000
#: With more distinct test terms than this the postings of all terms are stored, not only of those.
TERMS_SENT = 500_000
#: Phrases go to the tasks in lots of about so many (phrase, item) pairs, one search for each lot.
PHRASES_SENT = 200_000

INDEX = "block bigint, doc_ids array<string>, sizes array<bigint>, terms array<string>, counts array<bigint>, places binary"
_GAP = 1  # an empty place between documents, so that no run of places leaves one


def _table() -> bytes:
    """Byte by byte: ASCII letters in lower case, digits and all bytes beyond ASCII stay, others part words."""
    keep = lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
    return bytes(b + 32 if 65 <= b <= 90 else b if keep(b) else 32 for b in range(256))


_WORD_BYTES = _table()


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8; a null text has none."""
    return (text or "").encode().translate(_WORD_BYTES).split()


class _Ids(dict):
    """Numbers the terms as they come."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


def _block(number: int, held: list[tuple[str | None, np.ndarray]], names: list[bytes]) -> dict:
    sizes = np.array([len(ids) for _, ids in held], dtype=np.int64)
    starts = np.cumsum(sizes + _GAP) - sizes - _GAP
    ids = np.concatenate([ids for _, ids in held])
    places = np.arange(len(ids), dtype=np.int64) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    known = ids >= 0
    ids, places = ids[known], places[known]
    order = np.argsort(ids, kind="stable")
    present, counts = np.unique(ids[order], return_counts=True)
    return {
        "block": number,
        "doc_ids": [i for i, _ in held],
        "sizes": sizes,
        "terms": [names[i].decode() for i in present.tolist()],
        "counts": counts.astype(np.int64),
        "places": places[order].astype("<i8" if len(places) and places[-1] >= 2**31 else "<i4").tobytes(),
    }


def _indexer(terms: list[bytes] | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made = TaskContext.get().partitionId(), 0
        wanted = None if terms is None else {t: i for i, t in enumerate(terms)}
        held, size, ids = [], 0, _Ids()

        def close() -> pd.DataFrame:
            names = terms if terms is not None else list(ids)
            return pd.DataFrame([_block((task << 32) + made, held, names)])

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                words = words_of(text)
                found = map(ids.__getitem__, words) if wanted is None else map(wanted.get, words, repeat(-1))
                held.append((doc_id, np.fromiter(found, dtype=np.int32, count=len(words))))
                size += len(words)
                if size >= BLOCK_WORDS or len(held) >= BLOCK_DOCS:
                    yield close()
                    held, size, ids, made = [], 0, _Ids(), made + 1
        if held:
            yield close()

    return run


def build_index(
    docs: DataFrame, terms: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The stored index of ``docs``: postings of ``terms`` only, where given, else of all words.

    Documents without words, empty or null, are listed with size 0; ids may be null or repeat.
    """
    bounded_batches(docs.sparkSession)
    narrow = docs.select(id_as_text(id_col), column(text_col).alias("text"))
    return store(narrow.mapInPandas(_indexer(None if terms is None else [t.encode() for t in terms]), INDEX), "postings")


def documents_of(index: DataFrame) -> DataFrame:
    """``block, place, doc_id, n_words``: the documents of the index, their ids as text."""
    listed = index.select("block", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("place", "d"))
    return listed.select("block", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.sizes").alias("n_words"))


def term_counts(index: DataFrame) -> DataFrame:
    """``term, n``: occurrences of each stored term in the whole corpus."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    return pairs.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("n"))


class _Lists:
    """The postings of one block."""

    def __init__(self, row):
        ends = np.cumsum(row.counts) if len(row.counts) else np.zeros(0, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        places = np.frombuffer(row.places, dtype="<i8" if total and len(row.places) == 8 * total else "<i4")
        self.at = {t: places[e - c : e] for t, e, c in zip(row.terms, ends.tolist(), row.counts)}
        sizes = np.asarray(row.sizes, dtype=np.int64)
        self.starts = np.cumsum(sizes + _GAP) - sizes - _GAP
        self.length = int((sizes + _GAP).sum())

    def doc(self, places: np.ndarray) -> np.ndarray:
        """Which document of the block stands there; documents without words hold no place."""
        return np.searchsorted(self.starts, places, side="right") - 1


def _phrase(lists: _Lists, plan: list[tuple[str, int]]) -> np.ndarray | None:
    """First places of a phrase. ``plan``: its terms with their offsets, rarest first."""
    starts = None
    for term, offset in plan:
        at = lists.at.get(term)
        if at is None:
            return None
        if starts is None:
            starts = at - offset
            continue
        want = starts + offset
        i = np.searchsorted(at, want)
        starts = starts[at[np.minimum(i, len(at) - 1)] == want]
        if not len(starts):
            return None
    return starts


def _nearby(lists: _Lists, plan: list[tuple[str, int]], within: int) -> np.ndarray | None:
    """Least spans of up to ``within`` words with all terms, in any order: rows of first and last place."""
    terms = list(dict.fromkeys(t for t, _ in plan))
    if any(t not in lists.at for t in terms):
        return None
    rare = lists.at[terms[0]]
    for term in terms[1:]:  # occurrences of the rarest term that have each other term in reach
        at = lists.at[term]
        i = np.searchsorted(at, rare - (within - 1))
        rare = rare[(i < len(at)) & (at[np.minimum(i, len(at) - 1)] <= rare + (within - 1))]
        if not len(rare):
            return None
    ends = []
    for term in terms:
        at = lists.at[term]
        i = np.searchsorted(rare, at - (within - 1))
        ends.append(at[(i < len(rare)) & (rare[np.minimum(i, len(rare) - 1)] <= at + (within - 1))])
    end = np.unique(np.concatenate(ends)).astype(np.int64)
    start = end.copy()
    for term in terms:  # the last occurrence of each term up to the end; the span starts at the first of them
        at = lists.at[term]
        i = np.searchsorted(at, end, side="right") - 1
        start = np.where(i < 0, -1, np.minimum(start, at[np.maximum(i, 0)]))
    first = np.ones(len(start), dtype=bool)
    first[1:] = start[1:] != start[:-1]  # of spans with one start the first end is the least
    good = first & (start >= 0) & (end - start < within)
    start, end = start[good], end[good]
    good = lists.doc(start) == lists.doc(end)
    return np.stack([start[good], end[good]], axis=1) if good.any() else None


Phrase = tuple[str, list[str], list[tuple[str, int]]]  # id, items, plan


def _lots(index: DataFrame, phrases: DataFrame) -> Iterator[list[Phrase]]:
    """The phrases in lots of bounded size, each with its terms from the rarest on.

    ``phrases``: ``phrase_id, words, items``. A phrase with a term that no document holds is left out.
    """
    pairs = phrases.agg(F.coalesce(F.sum(F.greatest(F.size("items"), F.lit(1))), F.lit(0))).first()[0]
    lots = max(1, -(-pairs // PHRASES_SENT))
    dealt = phrases.withColumn("lot", F.pmod(F.xxhash64("phrase_id", "words"), F.lit(lots)))
    counts = term_counts(index)
    for lot in range(lots):
        some = dealt.filter(F.col("lot") == lot)
        terms = some.select(F.explode("words").alias("term")).distinct()
        n = {r.term: r.n for r in counts.join(terms, "term").collect()}
        out = []
        for r in some.select("phrase_id", "words", "items").collect():
            if r.words and all(w in n for w in r.words):
                plan = sorted(((w, i) for i, w in enumerate(r.words)), key=lambda x: (n[x[0]], x[1]))
                out.append((r.phrase_id, list(r.items), plan))
        yield out


def _rows_of(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for frame in frames:
        yield from frame.itertuples(index=False)


def _searched(index: DataFrame, phrases: DataFrame, find: Callable, schema: str) -> DataFrame:
    """``find(block row, lists, lot of phrases)`` over all blocks and lots."""
    bounded_batches(index.sparkSession)
    names = [f.split()[0] for f in schema.split(", ")]
    out = None
    for lot in _lots(index, phrases):

        def run(frames: Iterator[pd.DataFrame], lot: list[Phrase] = lot) -> Iterator[pd.DataFrame]:
            for row in _rows_of(frames):
                found = list(find(row, _Lists(row), lot))
                if found:
                    yield pd.DataFrame(found, columns=names)

        part = index.mapInPandas(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``doc_id, phrase_id, start``: every occurrence of the ``words`` of ``phrases (phrase_id, words)``
    in a row, by the number of its first word in the document (from 0). Ids are text. A phrase
    without words has no match."""

    def find(row, lists: _Lists, lot: list[Phrase]) -> Iterator[tuple]:
        for name, _, plan in lot:
            starts = _phrase(lists, plan)
            if starts is not None:
                docs = lists.doc(starts)
                for d, p in zip(docs.tolist(), (starts - lists.starts[docs]).tolist()):
                    yield row.doc_ids[d], name, p

    return _searched(index, _named(phrases), find, "doc_id string, phrase_id string, start bigint")


def proximity_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """``doc_id, phrase_id, start, end``: least spans of at most ``within`` words that hold every distinct
    word of a phrase, in any order. Least: no part of the span holds them all. ``end`` is the last word."""

    def find(row, lists: _Lists, lot: list[Phrase]) -> Iterator[tuple]:
        for name, _, plan in lot:
            spans = _nearby(lists, plan, within)
            if spans is not None:
                docs = lists.doc(spans[:, 0])
                for d, (a, b) in zip(docs.tolist(), (spans - lists.starts[docs][:, None]).tolist()):
                    yield row.doc_ids[d], name, a, b

    return _searched(index, _named(phrases), find, "doc_id string, phrase_id string, start bigint, end bigint")


def _named(phrases: DataFrame) -> DataFrame:
    return phrases.select(F.col("phrase_id").cast("string"), "words", F.array().cast("array<string>").alias("items"))


def item_windows(
    items: DataFrame, window: int = WINDOW_WORDS, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``phrase_id, words, items``: distinct windows of ``window`` words and the items that hold them.

    An item of fewer words, but not none, is one window. Items without id have windows, but name none.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, text in zip(frame["item_id"], frame["text"]):
                words = [w.decode() for w in words_of(text)]
                out += [(name, words[i : i + window]) for i in range(max(1, len(words) - window + 1)) if words]
            yield pd.DataFrame(out, columns=["item_id", "words"])

    narrow = items.select(column(id_col).cast("string").alias("item_id"), column(text_col).alias("text"))
    rows = narrow.mapInPandas(run, "item_id string, words array<string>")
    return rows.groupBy("words").agg(F.collect_set("item_id").alias("items")).withColumn("phrase_id", F.md5(F.concat_ws(" ", "words")))


def _covered(spans: Column) -> Column:
    """Words under the spans ``(start, end)``, sorted by their starts; an end is exclusive."""
    step = lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(s["start"], a["end"]))).alias("n"),
    )
    none = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(spans, none, step, lambda a: a["n"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, n_items, items, spans, contaminated``.

    A word inside any occurrence of a window of a test item is hit; ``spans`` are the hit words,
    ``items`` the sorted distinct ids (as text) of items with windows that occur. Null texts
    have no words; an empty item has no window; null and repeated ids keep their rows;
    empty tables on either side give no hits; further columns are ignored. Test items of any
    number are searched lot by lot.
    """
    phrases = store(item_windows(items, window, item_id_col, item_text_col), "phrases")
    terms = phrases.select(F.explode("words").alias("term")).distinct()
    sent = [r.term for r in terms.limit(TERMS_SENT + 1).collect()]
    index = build_index(docs, sent if len(sent) <= TERMS_SENT else None, id_col, text_col)

    def find(row, lists: _Lists, lot: list[Phrase]) -> Iterator[tuple]:
        hit = np.zeros(lists.length + 1, dtype=np.int8)
        named: dict[int, set] = {}
        for _, owners, plan in lot:
            starts = _phrase(lists, plan)
            if starts is not None:
                for i in range(len(plan)):
                    hit[starts + i] = 1
                for d in np.unique(lists.doc(starts)).tolist():
                    named.setdefault(d, set()).update(owners)
        if not named:
            return
        change = np.diff(hit, prepend=np.int8(0))
        begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        of = lists.doc(begin)
        for d, owners in named.items():
            lo, hi = np.searchsorted(of, [d, d + 1])
            base = int(lists.starts[d])
            yield row.block, d, [{"start": a - base, "end": b - base} for a, b in zip(begin[lo:hi].tolist(), end[lo:hi].tolist())], sorted(owners)

    found = _searched(index, phrases, find, "block bigint, place int, spans array<struct<start:bigint,end:bigint>>, items array<string>")
    hits = found.groupBy("block", "place").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    rows = documents_of(index).join(hits, ["block", "place"], "left")
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("doc_id").cast(id_type(docs, id_col)).alias("doc_id"),
        "n_words",
        n_hit.cast("bigint").alias("n_hit"),
        F.size(items_found).cast("bigint").alias("n_items"),
        items_found.alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        (n_hit > 0).alias("contaminated"),
    )


def digest_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """:func:`contamination` with a digest of the items in place of items and spans."""
    rows = contamination(docs, items)
    named = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return rows.select("doc_id", "n_words", "n_hit", "n_items", named, "contaminated")
