"""Summaries of lists of short strings in Arrow batches, one pass over all of them instead of one call a string."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Strings hashed at a time: the working arrays stay in the processor's cache.
_HASHED = 16_384

# The constants of MD5 (RFC 1321).
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_TURNS = [
    [(np.array([left], dtype=np.uint32), np.array([32 - left], dtype=np.uint32)) for left in turn]
    for turn in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
]
_ORDER = ((1, 0), (5, 1), (3, 5), (7, 0))
_SINES = [np.array([math.floor(abs(math.sin(i + 1)) * 2**32)], dtype=np.uint32) for i in range(64)]

#: Columns of :func:`list_summary`.
SUMMARY = "size bigint, first string, last string, chars bigint, low string"


def copy_pieces(source: np.ndarray, starts: np.ndarray, sizes: np.ndarray, target: np.ndarray, places: np.ndarray) -> None:
    """Copy the bytes of ``source`` from each of ``starts`` to ``places`` in ``target``, all pieces of a size at once."""
    found = np.flatnonzero(np.bincount(sizes))
    for size in found[found > 0]:
        some = slice(None) if len(found) == 1 else np.flatnonzero(sizes == size)
        into, out_of = (np.ndarray(len(x) - size + 1, dtype=f"V{size}", buffer=x, strides=(1,)) for x in (target, source))
        into[places[some]] = out_of[starts[some]]


def list_summary(lists: pa.ListArray) -> list[pa.Array]:
    """For each list of strings, none empty: its size, least and greatest string, sum of characters, least md5 in hex.

    A missing string stands in a list of its own, and only its size is known. Of strings that differ only
    in zeros at the end any may count as the least.
    """
    strings = lists.flatten()
    counts = lists.value_lengths().to_numpy()
    first = np.cumsum(counts) - counts
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[strings.offset : strings.offset + len(strings) + 1]
    data, starts, sizes = np.frombuffer(data or b"", dtype=np.uint8), ends[:-1], np.diff(ends)

    width = (int(sizes.max(initial=0)) + 8) // 64 * 64 + 64
    rows = np.zeros((len(strings), width), dtype=np.uint8)
    copy_pieces(data, starts, sizes, rows.reshape(-1), np.arange(len(strings)) * width)
    # Numbers in the order of the bytes, eight of them at a time.
    words = rows.view(">u8").T
    least = _least((word.astype(np.uint64) for word in words), first)
    greatest = _least((~word.astype(np.uint64) for word in words), first)
    low = _least((word.byteswap() for word in _md5_words(rows, sizes)), first)

    lengths = pc.utf8_length(strings).fill_null(0).to_numpy().astype(np.int64)
    missing = strings.is_null().to_numpy(zero_copy_only=False)
    chars = pa.array(np.add.reduceat(lengths, first), mask=np.logical_and.reduceat(missing, first))
    hexed = [None if missing[i] else hashlib.md5(data[starts[i] : ends[i + 1]]).hexdigest() for i in low.tolist()]
    return [pa.array(counts, pa.int64()), strings.take(pa.array(least)), strings.take(pa.array(greatest)), chars, pa.array(hexed, pa.string())]


def _least(words: Iterable[np.ndarray], first: np.ndarray) -> np.ndarray:
    """The row of each list whose words are the least in order; lists begin at the rows ``first``."""
    rows = None
    for word in words:
        values = word if rows is None else word[rows]
        rows = np.arange(len(word)) if rows is None else rows
        counts = np.diff(np.append(first, len(rows)))
        keep = values == np.repeat(np.minimum.reduceat(values, first), counts)
        first = (np.cumsum(keep) - keep)[first]
        rows = rows[keep]
        if len(rows) == len(first):
            break
    return rows[first]


def _md5_words(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The four numbers of the MD5 of each string; ``rows`` hold the strings, filled up with zeros to whole blocks."""
    out = np.empty((4, len(rows)), dtype=np.uint32)
    blocks = (sizes + 8) // 64 + 1
    for n in np.flatnonzero(np.bincount(blocks)):
        numbers = None if blocks.min() == n == blocks.max() else np.flatnonzero(blocks == n)
        for start in range(0, len(rows) if numbers is None else len(numbers), _HASHED):
            some = slice(start, start + _HASHED)
            some = some if numbers is None else numbers[some]
            words = np.ascontiguousarray(rows[some, : 64 * n].view("<u4").T)
            size = sizes[some].astype(np.uint32)
            words[size >> 2, np.arange(len(size))] |= np.uint32(0x80) << (size % 4 * 8)
            words[-2] = size * 8
            out[:, some] = _md5(words)
    return out


def _md5(words: np.ndarray) -> list[np.ndarray]:
    """MD5 of padded messages, one a column."""
    state = [np.full(words.shape[1], x, dtype=np.uint32) for x in _START]
    used = words.any(axis=1)
    mixed = np.empty_like(state[0])
    for block in range(0, len(words), 16):
        a, b, c, d = (x.copy() for x in state)
        for i in range(64):
            turn, (times, plus) = i // 16, _ORDER[i // 16]
            if turn == 2:
                np.bitwise_xor(b, c, out=mixed)
                mixed ^= d
            elif turn == 3:
                np.invert(d, out=mixed)
                mixed |= b
                mixed ^= c
            else:  # of two by the bits of the third
                one, other, by = (c, d, b) if turn == 0 else (b, c, d)
                np.bitwise_xor(one, other, out=mixed)
                mixed &= by
                mixed ^= other
            a += mixed
            a += _SINES[i]
            word = block + (times * i + plus) % 16
            if used[word]:
                a += words[word]
            left, right = _TURNS[turn][i % 4]
            np.right_shift(a, right, out=mixed)
            a <<= left
            a |= mixed
            a += b
            a, b, c, d = d, a, b, c
        state = [x + y for x, y in zip(state, (a, b, c, d))]
    return state
