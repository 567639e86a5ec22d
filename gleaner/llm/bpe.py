"""Byte-level BPE with forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never
be merged across. Such pairs cut a text into fragments that are encoded on their own;
the ids are then put together. Fragments repeat, so each worker encodes most of them
once. A text of any length falls apart into short fragments wherever such pairs occur.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.text import bounded_batches, column, id_as_text, id_type, once

#: A worker forgets its fragments when it holds this many bytes of them (text and ids).
CACHE_BYTES = 48_000_000
#: Fragments the tokenizer is given at once; its answers take many times their bytes.
_ENCODED = 2_000
#: Texts of one Arrow batch are worked on in parts of about so many bytes.
PART_BYTES = 1_000_000


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary: printable bytes
    stand for themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Token bytes, the special tokens, and the table of byte pairs that force a cut."""

    def __init__(self, path: str):
        # Every core has a worker of its own; the tokenizer's threads would each hold memory in all of them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        letters = byte_letters()
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.finder = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")") if longest_first else re.compile(b"(?!)()")
        size = 1 + max([*spec["model"]["vocab"].values(), *self.special.values()])
        self.bytes_of = np.full(size, b"", dtype=object)
        inside = np.zeros(65536, dtype=bool)
        for token, i in spec["model"]["vocab"].items():
            raw = bytes(letters[c] for c in token)
            self.bytes_of[i] = raw
            for a, b in zip(raw, raw[1:]):
                inside[a * 256 + b] = True
        for raw, i in self.special.items():
            self.bytes_of[i] = raw
        self.cuts = ~inside & _regex_safe()
        self.cache: dict[bytes, bytes] = {}
        self.held = 0

    def fragments(self, data: bytes) -> list[bytes]:
        """Cut ``data`` at every pair that certainly ends a token."""
        if len(data) < 2:
            return [data] if data else []
        raw = np.frombuffer(data, dtype=np.uint8)
        at = (np.flatnonzero(self.cuts[raw[:-1].astype(np.uint16) * 256 + raw[1:]]) + 1).tolist()
        return [data[a:b] for a, b in zip([0, *at], [*at, len(data)])]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._pieces(t) for t in texts]
        unseen = list({f for pieces in cut for f in pieces}.difference(self.cache))
        if self.held > CACHE_BYTES:
            self.forget()
            unseen = list({f for pieces in cut for f in pieces})
        for start in range(0, len(unseen), _ENCODED):
            some = unseen[start : start + _ENCODED]
            encoded = self.tokenizer.encode_batch_fast([f.decode() for f in some], add_special_tokens=False)
            for fragment, e in zip(some, encoded):
                got = np.array(e.ids, dtype="<u4").tobytes()
                self.cache[fragment] = got
                self.held += len(fragment) + len(got) + 150
        known = self.cache.__getitem__
        return [b"".join(map(known, pieces)) for pieces in cut]

    def forget(self) -> None:
        """Drop the fragments, so that a worker of later stages doesn't hold them."""
        self.cache.clear()
        self.held = 0

    def _pieces(self, data: bytes) -> list[bytes]:
        """Fragments in order; special tokens stand alone, as the tokenizer finds them first."""
        if not self.finder.search(data):
            return self.fragments(data)
        out: list[bytes] = []
        for i, part in enumerate(self.finder.split(data)):
            out += [part] if i % 2 else self.fragments(part)
        return out

    def decode(self, ids: bytes) -> str:
        tokens = self.bytes_of[np.frombuffer(ids, dtype="<u4")]
        return b"".join(tokens.tolist()).decode("utf-8", errors="replace")


def _regex_safe() -> np.ndarray:
    """Byte pairs at which the vocabulary's word pattern also can be cut.

    The pattern looks ahead only behind white space and starts anew only at an
    apostrophe, so a cut is safe unless its left side may be white space or its right
    side is an apostrophe. Bytes of characters beyond ASCII are cut only before the
    first byte of a character; on the left they may end a wide blank, so they are not cut behind.
    """
    left, right = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    blank = (left <= 32) | (left >= 127)
    continued = (right & 0xC0) == 0x80
    return (~blank & ~continued & (right != ord("'"))).ravel()


def parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, in lists of about PART_BYTES."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= PART_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


def encoder(path: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = once(f"bpe:{path}", lambda: Vocabulary(path))
        for frame in frames:
            counts, ids_sha, text_sha, same = [], [], [], []
            texts = [b"" if t is None else t.encode() for t in frame["text"]]
            for part in parts(texts):
                for text, ids in zip(part, vocabulary.ids(part)):
                    decoded = vocabulary.decode(ids).encode()
                    counts.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(hashlib.sha256(decoded).hexdigest())
                    same.append(decoded == text)
            texts_out = pd.DataFrame({"ids_sha256": ids_sha, "decoded_sha256": text_sha}, dtype=object, index=frame.index)
            yield pd.concat([frame[["doc_id"]].assign(n_tokens=counts), texts_out], axis=1).assign(round_trip=same)
        vocabulary.forget()

    return run


def encode_rows(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip``.

    ``path`` names the vocabulary file, which every executor has. Ids and decoded text
    equal those of the vocabulary's own library. A null text counts as empty and has no
    token; null and repeated ids keep their rows; an empty table gives an empty
    table; further columns are ignored. Rows don't move between tasks.
    """
    bounded_batches(docs.sparkSession)
    narrow = docs.select(id_as_text(id_col), column(text_col).alias("text"))
    rows = narrow.mapInPandas(
        encoder(path), "doc_id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    )
    return rows.withColumn("doc_id", F.col("doc_id").cast(id_type(docs, id_col)))


def token_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, token_ids``: the ids themselves, one row per document; rules as in :func:`encode_rows`."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = once(f"bpe:{path}", lambda: Vocabulary(path))
        for frame in frames:
            texts = [b"" if t is None else t.encode() for t in frame["text"]]
            ids = [np.frombuffer(i, dtype="<u4").astype("int32") for part in parts(texts) for i in vocabulary.ids(part)]
            yield frame[["doc_id"]].assign(token_ids=ids)
        vocabulary.forget()

    narrow = docs.select(id_as_text(id_col), column(text_col).alias("text"))
    return narrow.mapInPandas(run, "doc_id string, token_ids array<int>").withColumn("doc_id", F.col("doc_id").cast(id_type(docs, id_col)))
