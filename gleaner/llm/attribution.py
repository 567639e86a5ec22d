"""Token counts of sections: a document is encoded once, its tokens are joined to the sections by their places.

The tokens' places follow from their bytes. As they are in order, the join of token spans
with section spans is a search for each section's ends among them. A token that crosses
a section's end goes where the rule says; nothing is encoded twice, so counts add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.bpe import Vocabulary
from gleaner.llm.disclosure import placed
from gleaner.llm.text import column, id_as_text, id_type, once, whole

#: Which section gets a crossing token: that of its first or of its last character.
RULES = ("first", "last")
#: Texts encoded together, in characters.
PART_CHARS = 2_000_000


def line_sections(text: Column) -> tuple[Column, Column]:
    """Starts and ends of the lines with any character, in code points; line ends belong to no section."""
    lines = placed(whole(text), r"[^\n]++", "line")
    return lines["start"], lines["end"]


def char_spans(text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token, and the one after its last; a token may hold part of a character."""
    ends = np.cumsum(sizes)
    heads = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(heads)])
    starts = ends - sizes
    return upto[starts + 1] - 1, upto[ends]


def section_counts(first: np.ndarray, after: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Per section the tokens that the rule gives it, and the tokens that cross one of its ends."""
    key = first if rule == "first" else after - 1
    n = np.searchsorted(key, ends) - np.searchsorted(key, starts)
    n[ends <= starts] = 0

    def across(at: np.ndarray) -> np.ndarray:
        """Tokens that begin before a place and end behind it."""
        return np.searchsorted(first, at) - np.searchsorted(after, at, side="right")

    both = across(starts) + across(ends)
    # A token around the whole section crosses it once.
    inside = np.searchsorted(first, starts) - np.searchsorted(after, ends, side="right")
    return n, np.where(ends > starts, both - np.maximum(inside, 0), 0)


def attribute(
    docs: DataFrame, path: str, starts: Column, ends: Column, id_col: str = "doc_id", text_col: str = "text", rule: str = "first"
) -> DataFrame:
    """One row per section: ``doc_id, section, start, end, n_tokens, n_crossing, doc_tokens``.

    ``starts`` and ``ends`` are arrays of code points, ends exclusive; sections may overlap
    or leave gaps. ``section`` counts them from 0. Tokens whose deciding character lies
    in no section are given in a row with section -1 and null places, which each
    document has, so a null or empty text, or one without sections, has just that row.
    Null arrays hold no section; a section of no length or outside the text has no
    token. Null ids and repeated rows keep their rows; an empty table gives an empty table;
    further columns are ignored. Rows don't move between tasks.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = once(f"bpe:{path}", lambda: Vocabulary(path))
        sizes = once(f"bpe-sizes:{path}", lambda: np.array([len(b) for b in vocabulary.bytes_of]))
        for frame in frames:
            lengths = frame["text"].str.len().fillna(0).to_numpy(dtype=np.int64)
            part = np.cumsum(lengths) // PART_CHARS
            for _, some in frame.groupby(part, sort=False):
                yield from _attributed(some, vocabulary, sizes, rule)

    narrow = docs.select(id_as_text(id_col), whole(column(text_col)).alias("text"), starts.alias("starts"), ends.alias("ends"))
    rows = narrow.mapInPandas(
        run, "doc_id string, section bigint, start bigint, end bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint"
    )
    return rows.withColumn("doc_id", F.col("doc_id").cast(id_type(docs, id_col)))


def _attributed(frame: pd.DataFrame, vocabulary: Vocabulary, sizes: np.ndarray, rule: str) -> Iterator[pd.DataFrame]:
    texts = [t.encode() for t in frame["text"]]
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    rows, totals = [], []
    for text, ids, starts, ends in zip(texts, vocabulary.ids(texts), frame["starts"], frame["ends"]):
        tokens = np.frombuffer(ids, dtype="<u4")
        first, after = char_spans(text, sizes[tokens])
        s = np.asarray([] if starts is None else starts, dtype=np.int64)
        e = np.asarray([] if ends is None else ends, dtype=np.int64)
        n, crossing = section_counts(first, after, s, e, rule)
        # Tokens that no section covers: the union of sections is swept once.
        key = first if rule == "first" else after - 1
        change = np.zeros(len(text) + 2, dtype=np.int64)
        np.add.at(change, np.clip(s[e > s], 0, len(text) + 1), 1)
        np.add.at(change, np.clip(e[e > s], 0, len(text) + 1), -1)
        outside = int((np.cumsum(change)[key] == 0).sum()) if len(key) else 0
        for out, own, last in zip(columns, (np.arange(len(s)), s, e, n, crossing), (-1, -1, -1, outside, 0)):
            out.append(np.append(own, last))
        rows.append(len(s) + 1)
        totals.append(len(tokens))
    section, start, end, n, crossing = (np.concatenate(c) if c else np.empty(0, dtype=np.int64) for c in columns)
    out = pd.DataFrame({"section": section, "start": start, "end": end, "n_tokens": n, "n_crossing": crossing})
    out[["start", "end"]] = out[["start", "end"]].astype("Int64").mask(out["section"] == -1)
    out["doc_tokens"] = np.repeat(totals, rows)
    out.insert(0, "doc_id", frame["doc_id"].repeat(rows).array)
    yield out
