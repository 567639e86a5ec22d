"""Near duplicates: shingles, MinHash, LSH bands, and the groups they form."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleaner.functions.digests import copy_pieces
from gleaner.operators.components import connected_components
from gleaner.operators.exact import remove_by_ids
from gleaner.operators.skew import HOT_ROWS, SALTS, first_per_group, lookup, small_or_none, spread_join
from gleaner.operators.substring import _BASE, _INVERSE, _powers, window_hashes
from gleaner.session import bounded_batches, store

# Fixed values.
SHINGLE = 24
BANDS = 20
ROWS_PER_BAND = 13
PRIME = 2**31 - 1
SEED = "minhash"

# Least similarity of a verified link, in percent of the union.
PERCENT = 80
# Hubs a bucket gets in one round of verification at most.
_HUBS = 64
# Texts that meet one hub in a task, about; hubs with more are spread.
_HOT_TEXTS = 10_000

# Shingles hashed, and hashes permuted, at a time: the working arrays stay in the processor's cache.
_BLOCK = 16_384
_PERMUTED = 128

# Bytes of text whose n-grams are told apart at a time, about, and n-grams in one array at most.
_BYTES = 131_072
_LOT = 65_536
# What the number of a text counts in a hash.
_TEXT = 0xBF58476D1CE4E5B9


def coefficient(kind: str, i: int, seed: str = SEED) -> int:
    """A fixed pseudo-random number below PRIME: the first 8 hex digits of ``md5(seed:kind:i)``."""
    return int(hashlib.md5(f"{seed}:{kind}:{i}".encode()).hexdigest()[:8], 16) % (PRIME - 1) + 1


def char_shingles(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    summary: tuple[str, Callable[[pa.ListArray], list[pa.Array]]] | None = None,
) -> DataFrame:
    """``(key, shingles)``: distinct character n-grams as an array; a shorter text is one, a missing one a null.

    The arrays are never empty. A text with more than ``_LOT`` shingles has several rows, each shingle in one of them.
    Windows of the UTF-8 bytes are told apart by hash in Arrow batches, equal hashes by their bytes. ``summary``
    names columns and makes them from the arrays where those are cut; then these stand for ``shingles``, which don't move.
    """
    bounded_batches(df.sparkSession)
    rows = df.select(key, text)
    named, of = summary or ("shingles array<string>", lambda lists: [lists])
    out = T.StructType([rows.schema[0], *T.StructType.fromDDL(named)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, lists in shingle_lots(batch.column(1).cast(pa.large_string()), width):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(numbers), *of(lists)], out.names)

    return rows.mapInArrow(cut, out)


def shingle_lots(texts: pa.LargeStringArray, width: int, lot: int = _LOT) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """Distinct n-grams of some texts at a time: numbers of texts, and lists of at most ``lot`` n-grams each."""
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(int(np.searchsorted(ends, ends[first] + _BYTES, side="right")) - 1, first + 1)
        last = min(last, first + _BYTES // 64)
        codes, bounds = data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        starts, sizes, counts = _distinct_windows(codes, bounds, width)
        # Lists end where a text ends, and after every lot of it.
        lots = np.maximum(-(-counts // lot), 1)
        owner = np.repeat(np.arange(last - first), lots)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lots) - lots, lots)
        lengths = np.minimum(counts[owner] - nth * lot, lot)
        missing = np.repeat(texts.slice(first, last - first).is_null().to_numpy(zero_copy_only=False), counts)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        for a in range(0, len(owner), step := max(len(owner) if upto[-1] <= 2 * lot else 1, 1)):
            b = min(a + step, len(owner))
            some = slice(upto[a], upto[b])
            grams = _strings(codes, starts[some], sizes[some], missing[some])
            yield pa.array(owner[a:b] + first), pa.ListArray.from_arrays(pa.array(upto[a : b + 1] - upto[a], pa.int32()), grams)
        first = last


def _distinct_windows(codes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and size in bytes of one window of ``width`` characters for each that differs within its text, in
    order, and their number for each text. Texts lie between ``bounds``."""
    chars = np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(codes))
    before = np.searchsorted(chars[:-1], bounds)
    lengths = np.diff(before)
    counts = np.maximum(lengths - width + 1, 1)
    upto = np.cumsum(counts)
    at = np.arange(upto[-1]) + np.repeat(before[:-1] - (upto - counts), counts)
    starts, ends = chars[at], chars[np.minimum(at + width, len(chars) - 1)]
    short = np.flatnonzero(lengths < width)
    starts[upto[short] - 1], ends[upto[short] - 1] = bounds[short], bounds[short + 1]

    prefix = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * _powers(_BASE, len(codes)), out=prefix[1:])
    hashes = (prefix[ends] - prefix[starts]) * _powers(_INVERSE, len(codes) + 1)[starts]
    hashes += np.repeat(np.arange(len(counts), dtype=np.uint64) * np.uint64(_TEXT), counts)
    order = np.argsort(hashes)
    hashes = hashes[order]
    again = np.flatnonzero(hashes[1:] == hashes[:-1])
    keep = np.ones(len(starts), dtype=bool)
    keep[order[again + 1]] = False
    if len(again):
        owner = np.repeat(np.arange(len(counts)), counts)
        if not _same(codes, starts, ends, owner, order[again], order[again + 1]):
            # Different windows of equal hash: told apart one by one.
            met = {(t, codes[a:b].tobytes()): i for i, (t, a, b) in enumerate(zip(owner, starts, ends))}
            keep[:] = False
            keep[list(met.values())] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], upto])]
    return starts[keep], (ends - starts)[keep], np.diff(kept)


def _same(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether windows ``a`` and ``b`` are of one text and equal, pair by pair; compared in words where they are long enough."""
    sizes = ends[a] - starts[a]
    if not (np.array_equal(owner[a], owner[b]) and np.array_equal(sizes, ends[b] - starts[b])):
        return False
    word = 8 if sizes.min() >= 8 else 1
    words = np.ndarray(len(codes) - word + 1, dtype=f"u{word}", buffer=codes, strides=(1,))
    offsets = (np.minimum(i, sizes - word) for i in range(0, sizes.max(), word))
    return all(np.array_equal(words[starts[a] + at], words[starts[b] + at]) for at in offsets)


def _strings(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, missing: np.ndarray) -> pa.StringArray:
    """The pieces of ``codes`` as strings, null where ``missing``."""
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    data = np.empty(offsets[-1], dtype=np.uint8)
    copy_pieces(codes, starts, sizes, data, offsets[:-1])
    valid = pa.array(~missing).buffers()[1] if missing.any() else None
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data), valid)


def shingle_hashes(text: str, weights: np.ndarray) -> Iterator[np.ndarray]:
    """Multilinear hash of every shingle (the weighted sum of its code points modulo PRIME), in blocks."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    width = len(weights)
    if len(codes) < width:
        codes = np.concatenate([codes, np.zeros(width - len(codes), dtype=np.uint32)])
    for start in range(0, len(codes) - width + 1, _BLOCK):
        block = codes[start : start + _BLOCK + width - 1].astype(np.uint64)
        count = len(block) - width + 1
        sums = np.zeros(count, dtype=np.uint64)
        for j, weight in enumerate(weights):
            sums += block[j : j + count] * weight
        yield sums % np.uint64(PRIME)


def minima(blocks: Iterable[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each (a, b): the smallest ``(a * h + b) mod PRIME`` over all hashes, which lie below PRIME.

    The remainder is taken as a fraction of PRIME in units of 2**-64, where dropping the
    whole part is the overflow of 64 bits. ``2**64 / PRIME`` is ``2**33 + 4 + 2**-29`` and less than
    2**-59 more; rounding puts a fraction off by less than 2**32, half a step of the remainder,
    so fractions are taken from the middle of a step, and the smallest one names the smallest remainder.
    """

    def scaled(x: np.ndarray) -> np.ndarray:
        return x * np.uint64(2**33 + 4) + (x >> np.uint64(29))

    step, middle = scaled(a), scaled(b) + np.uint64(2**32)
    best = np.full(len(a), 2**64 - 1, dtype=np.uint64)
    work = np.empty((_PERMUTED, len(a)), dtype=np.uint64)
    for hashes in blocks:
        for start in range(0, len(hashes), _PERMUTED):
            some = hashes[start : start + _PERMUTED, None]
            fractions = np.multiply(some, step, out=work[: len(some)])
            fractions += middle
            np.minimum(best, fractions.min(axis=0), out=best)
    # The whole part of fraction * PRIME / 2**64, with PRIME = 2**31 - 1: no product leaves 64 bits.
    high, low = best >> np.uint64(32), best & np.uint64(2**32 - 1)
    prime = np.uint64(PRIME)
    return ((high * prime + ((low * prime) >> np.uint64(32))) >> np.uint64(32)).astype(np.uint32)


def _coefficients(permutations: int, width: int, seed: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(
        np.array([coefficient(kind, i, seed) for i in range(n)], dtype=np.uint64)
        for kind, n in (("w", width), ("a", permutations), ("b", permutations))
    )


def minhash(
    text: Column, bands: int = BANDS, rows: int = ROWS_PER_BAND, width: int = SHINGLE, seed: str = SEED
) -> Column:
    """MinHash signature as ``array<int>`` of ``bands * rows`` minima; a null text has none and joins no bucket.

    One vectorised pass per text in blocks, so memory does not grow with the
    number of permutations times the length of the text.
    """
    weights, a, b = _coefficients(bands * rows, width, seed)

    @F.pandas_udf("array<int>")
    def signature(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else minima(shingle_hashes(t, weights), a, b).astype(np.int32) for t in texts], dtype=object)

    return signature(text)


def band_keys(
    text: Column, bands: int = BANDS, rows: int = ROWS_PER_BAND, width: int = SHINGLE, seed: str = SEED
) -> Column:
    """One 16-byte md5 per band, over the band number and its part of the signature."""
    weights, a, b = _coefficients(bands * rows, width, seed)

    @F.pandas_udf("array<binary>")
    def keys(texts: pd.Series) -> pd.Series:
        def of(text: str) -> list[bytes]:
            low = minima(shingle_hashes(text, weights), a, b).reshape(bands, rows).tolist()
            return [hashlib.md5(",".join(map(str, [i, *band])).encode()).digest() for i, band in enumerate(low)]

        return pd.Series([None if t is None else of(t) for t in texts], dtype=object)

    return keys(text)


def lsh_bands(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, band, band_hash)`` rows, ``BANDS`` per document."""
    bounded_batches(df.sparkSession)
    signed = df.select(key, band_keys(F.col(text)).alias("_keys"))
    return signed.select(key, F.posexplode("_keys").alias("band", "band_hash"))


def lsh_edges(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Edges ``(src, dst)`` from the lowest id of each bucket to its other members.

    A star per bucket keeps the edges linear in its size. Signatures are computed
    once and stored; the lowest id comes from a partial aggregation, and a bucket
    that holds a large share of all rows is salted when the members look it up.
    """
    bounded_batches(df.sparkSession)
    keys = store(df.select(F.col(key).alias("dst"), band_keys(F.col(text)).alias("_keys")), "bands")
    rows = keys.count() * BANDS
    members = keys.select("dst", F.explode("_keys").alias("band_hash"))
    buckets = (
        members.groupBy("band_hash")
        .agg(F.min("dst").alias("src"), F.count(F.lit(1)).alias("_size"))
        .filter(F.col("_size") > 1)
    )
    joined = spread_join(members, buckets, "band_hash", "_size", spread_by="dst", hot_rows=hot_rows, salts=salts, max_rows=rows)
    return joined.filter("src <> dst").select("src", "dst").distinct()


def gram_hashes(text: str, width: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a shorter text is one shingle."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    # Spread the code points over 64 bits first.
    codes *= np.uint64(0x9FB21C651E98DF25)
    codes ^= codes >> np.uint64(32)
    codes *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique(window_hashes(codes, min(width, len(codes))))


def _overlap(text: Column, other: Column, width: int = SHINGLE) -> Column:
    """``struct<common, total>``: sizes of intersection and union of the sets of shingles."""

    @F.pandas_udf("struct<common: bigint, total: bigint>")
    def sizes(texts: pd.Series, others: pd.Series) -> pd.DataFrame:
        common, total, last, held = [], [], None, None
        for text, other in zip(texts, others):
            if other != last:
                last, held = other, gram_hashes(other, width)
            grams = gram_hashes(text, width)
            common.append(len(np.intersect1d(grams, held, assume_unique=True)))
            total.append(len(grams) + len(held) - common[-1])
        return pd.DataFrame({"common": np.array(common, dtype=np.int64), "total": np.array(total, dtype=np.int64)})

    return sizes(text, other)


def _compared(pairs: DataFrame, texts: DataFrame, hot_rows: int, salts: int) -> DataFrame:
    """``(id, hub, common, total)`` of distinct pairs: sizes of intersection and union of their sets.

    Texts move, not their sets, which are several times as large.
    """
    sized = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("_size"))
    hubs = texts.select(F.col("id").alias("hub"), F.col("text").alias("hub_text")).join(sized, "hub")
    # A member meets at most the hubs of one round in each band, so its own text needs no spreading.
    both = spread_join(pairs.join(texts, "id"), hubs, "hub", "_size", spread_by="id", hot_rows=min(hot_rows, _HOT_TEXTS), salts=salts)
    return both.select("id", "hub", _overlap(F.col("text"), F.col("hub_text")).alias("_o")).select("id", "hub", "_o.common", "_o.total")


def _relabelled(rows: DataFrame, links: DataFrame, hot_rows: int, salts: int) -> DataFrame:
    """``rows`` with ``comp`` after the components that the ``links (src, dst)`` between their ids join."""
    at = rows.select("id", "comp").distinct()
    ends = links.join(at.toDF("src", "u"), "src").join(at.toDF("dst", "v"), "dst")
    merged = connected_components(ends, "u", "v").toDF("comp", "_to")
    sized = rows.groupBy("comp").agg(F.count(F.lit(1)).alias("_size")).join(merged, "comp")
    joined = lookup(rows, sized, "comp", spread_by="id", size_col="_size", how="left", hot_rows=hot_rows, salts=salts)
    return joined.withColumn("comp", F.coalesce("_to", "comp")).drop("_to")


def verified_edges(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    bands: int = BANDS,
    rows_per_band: int = ROWS_PER_BAND,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Edges ``(src, dst)`` between members of a bucket whose full sets are similar enough.

    The components of these edges are those of all pairs that share a band and have
    ``100 * intersection >= percent * union``. Equal texts are a star around their least id,
    which alone is a member of buckets. A member is first compared with the least of all that share
    a bucket with it; what this links is one component, and a bucket within one component is done.
    In the others only hubs are compared, with members of other components: a bucket's least
    member first. Members that aren't similar to it are hubs in their turn, and so are linked
    members that lie near another hub (distance up to twice the limit) without a link to it:
    by the triangle inequality no other pair can join two stars. Where they are fewer, the hubs are all
    members outside the bucket's largest component. The number of hubs doubles by round. A group of near copies takes about one comparison a member; the work grows with members
    times hubs only where a bucket truly holds unlike texts, which 13 equal minima make rare.
    Sets are compared whole, as 64-bit hashes of their shingles made where two texts meet.

    Null texts and ids have no link; equal texts are linked; equal rows count once.
    """
    bounded_batches(df.sparkSession)
    rows_of = df.select(F.col(key).alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
    digest = F.unhex(F.md5("text")).alias("_hash")
    keys = store(rows_of.select("id", digest, band_keys(F.col("text"), bands, rows_per_band).alias("_keys")), "bands")
    equal = keys.groupBy("_hash").agg(F.min("id").alias("_keeper"), F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    copies = lookup(keys.select("id", "_hash"), equal, "_hash", spread_by="id", size_col="_size", hot_rows=hot_rows, salts=salts)
    copies = store(copies.filter("id <> _keeper").distinct(), "copies")
    edges = copies.select(F.col("_keeper").alias("src"), F.col("id").alias("dst"))

    alone, small = small_or_none(copies.select("id", "_hash"))
    members = keys.join(F.broadcast(alone) if small else alone, ["id", "_hash"], "left_anti")
    rows = keys.count() * bands
    members = members.select("id", F.explode("_keys").alias("bucket")).withColumn("bucket", F.xxhash64("bucket"))
    least = F.min("id").alias("least")
    shared = members.groupBy("bucket").agg(least, F.max("id").alias("_most"), F.count(F.lit(1)).alias("_size")).filter("least < _most")
    members = spread_join(members, shared.drop("_most"), "bucket", "_size", spread_by="id", hot_rows=hot_rows, salts=salts, max_rows=rows)
    members = store(members.distinct(), "members")

    ids, small = small_or_none(members.select("id").distinct())
    texts = rows_of.join(F.broadcast(ids) if small else ids, "id", "left_semi")
    texts = store(texts.select("id", "text", digest).groupBy("id", "_hash").agg(F.first("text").alias("text")).drop("_hash"), "texts")
    scaled, total = 100 * F.col("common"), F.col("total")
    ok, close = scaled >= percent * total, scaled >= (2 * percent - 100) * total

    def links(found: DataFrame) -> DataFrame:
        return found.filter(ok).select(F.least("id", "hub").alias("src"), F.greatest("id", "hub").alias("dst"))

    first = store(members.groupBy("id").agg(F.min("least").alias("hub")).filter("id <> hub"), "met")
    found = store(_compared(first, texts, hot_rows, salts), "compared")
    edges = edges.union(links(found))
    flags = {f: F.lit(False) for f in ("linked", "near", "hub_before")}
    open_ = members.select("bucket", "id", F.col("id").alias("comp")).withColumns(flags)
    open_ = store(_relabelled(open_, links(found), hot_rows, salts), "members")
    n, todo = 1, ~F.col("hub_before") & ~(F.col("linked") & ~F.col("near"))
    while True:
        parts = open_.groupBy("bucket", "comp").agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(todo).alias("_todo"), F.count_if(~F.col("hub_before")).alias("_free")
        )
        most = F.max(F.struct("_n", "comp", "_free"))
        sized = parts.groupBy("bucket").agg(
            F.sum("_n").alias("_size"), F.sum("_todo").alias("_todo"), F.sum("_free").alias("_free"), most.alias("_most"), F.count(F.lit(1)).alias("_parts")
        )
        outside = (F.col("_free") - F.col("_most._free")).alias("_outside")
        sized = sized.filter("_parts > 1").select("bucket", "_size", "_todo", outside, F.col("_most.comp").alias("_most"))
        sized = store(sized.filter("_todo > 0 and _outside > 0"), "sized")
        waiting = spread_join(open_, sized, "bucket", "_size", spread_by="id", hot_rows=hot_rows, salts=salts, max_rows=rows)
        fewer = F.when(F.col("_outside") <= F.col("_todo"), (F.col("comp") != F.col("_most")) & ~F.col("hub_before")).otherwise(todo)
        hubs = first_per_group(waiting.filter(fewer).select("bucket", "id", "comp"), "bucket", ["id"], n, spread_by="id")
        # Buckets of one component, or without need of a further hub, are done.
        chosen = store(
            hubs.groupBy("bucket").agg(F.collect_list(F.struct("id", "comp")).alias("hubs")).join(sized.select("bucket", "_size"), "bucket"),
            "hubs",
        )
        if chosen.isEmpty():
            return edges.distinct()
        met = spread_join(open_, chosen, "bucket", "_size", spread_by="id", hot_rows=hot_rows, salts=salts, max_rows=rows)
        # Between two hubs of a round the greater one is the member.
        is_hub = F.array_contains("hubs.id", F.col("id")).alias("is_hub")
        met = met.filter("not hub_before").select("bucket", "id", "comp", is_hub, F.explode("hubs").alias("h"))
        met = met.filter("comp <> h.comp and (not is_hub or id > h.id)").select("bucket", "id", F.col("h.id").alias("hub"))
        met = store(met, "met")
        found = store(_compared(met.select("id", "hub").distinct(), texts, hot_rows, salts), "compared")
        edges = edges.union(links(found))
        told = (
            met.join(found, ["id", "hub"])
            .groupBy("bucket", "id")
            .agg(F.bool_or(ok).alias("_ok"), F.bool_or(close & ~ok).alias("_close"))
        )
        now_hubs = chosen.select("bucket", F.explode("hubs.id").alias("id"), F.lit(True).alias("_hub"))
        going = open_.join(told, ["bucket", "id"], "left").join(now_hubs, ["bucket", "id"], "left")
        going = going.join(chosen.select("bucket"), "bucket", "left_semi")
        no = F.lit(False)
        going = going.select(
            "bucket",
            "id",
            "comp",
            (F.col("linked") | F.coalesce("_ok", no)).alias("linked"),
            (F.col("near") | F.coalesce("_close", no)).alias("near"),
            (F.col("hub_before") | F.coalesce("_hub", no)).alias("hub_before"),
        )
        open_ = store(_relabelled(going, links(found), hot_rows, salts) if not found.filter(ok).isEmpty() else going, "members")
        n = min(2 * n, _HUBS)


def fuzzy_dup_ids(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids that are not the lowest of their group of near copies."""
    groups = connected_components(lsh_edges(df, key, text))
    return groups.filter("id <> component").select(F.col("id").alias(key))


def verified_groups(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``(id, component)`` of the documents with a verified near copy; the component is the least id."""
    return connected_components(verified_edges(df, key, text, percent))


def fuzzy_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", fields: list[str] | None = None) -> DataFrame:
    return remove_by_ids(df, fuzzy_dup_ids(df, key, text), key, fields)
