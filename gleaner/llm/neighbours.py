"""Quality by nearest neighbours among labelled latent-semantic vectors.

A bounded sample of labelled documents is turned into hashed character trigrams and
measures of repetition, weighted and reduced by a singular value decomposition. Its vectors are broadcast; every
document is projected the same way, its cosines with all of them are computed in
blocks, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.samples import labelled_sample, remainder
from gleaner.llm.text import column, id_as_text, id_type

#: Bounds of the model: labelled documents per class, hashed features, latent dimensions.
PER_CLASS = 1_500
FEATURES = 4_096
LATENT = 64
#: Terms that count words equal to the word before, and words seen before in the text, in a hundred. Trigrams
#: can't tell a text that says one thing over and over; half of these terms each hold one of the two measures,
#: so together they weigh about as much as the trigrams of a sentence.
REPEAT_TERMS = 24
TERMS = FEATURES + REPEAT_TERMS
NEIGHBOURS = 25
#: Similarities are raised to this power before they vote.
POWER = 4
THRESHOLD = 0.7
PARTS, HELD = 4, 2
#: Documents, and about so many bytes of text, in one block of products.
BLOCK = 256
BLOCK_BYTES = 2_000_000

_KINDS = 48


def _byte_kinds() -> np.ndarray:
    """Small letters stay apart, capitals and digits fall together, common marks stay apart."""
    kinds = np.full(256, 47, dtype=np.int64)
    kinds[97:123] = np.arange(26)
    kinds[65:91] = 26
    kinds[48:58] = 27
    kinds[128:] = 28
    for i, c in enumerate(" \n.,!?#*$%&|<>:;-"):
        kinds[ord(c)] = 29 + i
    return kinds


def _trigram_slots() -> np.ndarray:
    codes = np.arange(_KINDS**3, dtype=np.uint64)
    mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(20)).astype(np.int64) % FEATURES


def _repetition(text: bytes) -> list[int]:
    words = text.split()
    if len(words) < 2:
        return [0] * REPEAT_TERMS
    at_once = sum(map(bytes.__eq__, words, words[1:])) * 100 // len(words)
    again = max(0, 100 - len(set(words)) * 100 // len(words) - 40)
    return [at_once] * (REPEAT_TERMS // 2) + [again] * (REPEAT_TERMS // 2)


def term_counts(texts: list[bytes], kinds: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Counts of trigrams and repetition terms, one row per text."""
    owner = np.repeat(np.arange(len(texts)), [max(0, len(t) - 2) for t in texts])
    codes = [kinds[np.frombuffer(t, dtype=np.uint8)] for t in texts if len(t) > 2]
    grams = [c[:-2] * _KINDS**2 + c[1:-1] * _KINDS + c[2:] for c in codes]
    flat = owner * FEATURES + (slots[np.concatenate(grams)] if grams else np.empty(0, dtype=np.int64))
    counts = np.bincount(flat, minlength=len(texts) * FEATURES).reshape(len(texts), FEATURES)
    return np.hstack([counts, np.array([_repetition(t) for t in texts], dtype=np.int64).reshape(len(texts), REPEAT_TERMS)])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    good: np.ndarray
    votes: np.ndarray

    def parts(self) -> tuple:
        """Plain values to broadcast: executors need not know this package."""
        return self.idf, self.basis, self.vectors, self.good, self.votes

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(counts).astype(np.float32) * self.idf) @ self.basis)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of the good class in the votes; a document like nothing known gets one half."""
        if not len(self.vectors):
            return np.full(len(counts), 0.5)
        cosines = self.project(counts) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = _nearest(cosines, k)
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** POWER * self.votes[near]
        total, good = weight.sum(axis=1), (weight * self.good[near]).sum(axis=1)
        return np.where(total > 0, good / np.maximum(total, 1e-300), 0.5)


def _nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` most similar of each row. Similarities count to six places, as the last digits of a product
    depend on its block; of equal ones those learned first (with the least id) are nearer."""
    n = cosines.shape[1]
    ranks = np.rint(cosines.astype(np.float64) * -1e6).astype(np.int64) * n + np.arange(n)
    return np.argpartition(ranks, k - 1, axis=1)[:, :k]


def _basis(x: np.ndarray) -> np.ndarray:
    """Leading right singular vectors, by randomised subspace iteration with a fixed seed."""
    size = min(LATENT, *x.shape)
    q = np.random.default_rng(7).standard_normal((x.shape[1], min(size + 16, x.shape[1]))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :size].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> Model:
    """The model of at most ``2 * per_class`` labelled documents, reduced to sparse counts by the executors."""
    sample = labelled_sample(docs, labels, label, PARTS, HELD, per_class, id_col, text_col)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds, slots = _byte_kinds(), _trigram_slots()
        for frame in frames:
            rows = [term_counts([b"" if t is None else t.encode()], kinds, slots)[0] for t in frame["text"]]
            at = [np.flatnonzero(r) for r in rows]
            yield frame[["doc_id", "label"]].assign(slots=at, counts=[r[i] for r, i in zip(rows, at)])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = (
        sample.mapInPandas(counted, f"doc_id {kind}, label int, slots array<int>, counts array<int>")
        .toPandas().sort_values("doc_id")
    )
    x = np.zeros((len(rows), TERMS), dtype=np.float32)
    for i, (at, counts) in enumerate(zip(rows["slots"], rows["counts"])):
        x[i, np.asarray(at, dtype=np.int64)] = np.log1p(counts)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    good = rows["label"].to_numpy(dtype=np.float64)
    if not len(x):
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), good, good)
    weighted = _unit(x * idf)
    basis = _basis(weighted)
    # Each class has as much weight in all, however many were labelled.
    size = np.maximum(np.bincount(good.astype(int), minlength=2), 1)
    return Model(idf, basis, _unit(weighted @ basis), good, (len(good) / 2 / size)[good.astype(int)])


def quality_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> DataFrame:
    """One narrow row per document: ``doc_id, held_out, score, predicted``.

    ``held_out`` rows (CRC-32 of the id modulo 4 is 2) are never learned from. Null,
    empty and very short texts have no trigram and score one half. A null id isn't held
    out. Of equally similar neighbours those with the least ids vote. Without any label all scores are one half. Repeated rows score alike; an empty
    table gives an empty table; further columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, id_col, text_col, per_class).parts())

    def blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
        block, held = [], 0
        for t in texts:
            block.append(t)
            held += len(t)
            if len(block) >= BLOCK or held >= BLOCK_BYTES:
                yield block
                block, held = [], 0
        if block:
            yield block

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, kinds, slots = Model(*sent.value), _byte_kinds(), _trigram_slots()
        for frame in frames:
            texts = [b"" if t is None else t.encode() for t in frame["text"]]
            scores = [model.scores(term_counts(block, kinds, slots)) for block in blocks(texts)]
            yield frame[["doc_id"]].assign(score=np.concatenate(scores) if scores else [])

    narrow = docs.select(id_as_text(id_col), column(text_col).alias("text"))
    return narrow.mapInPandas(scored, "doc_id string, score double").select(
        F.col("doc_id").cast(id_type(docs, id_col)).alias("doc_id"),
        F.coalesce(remainder(F.col("doc_id"), PARTS) == HELD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
