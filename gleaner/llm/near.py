"""Near duplicates by bottom-k sketches of word shingles.

One hash function gives every shingle a value; a document's sketch holds its ``SKETCH``
least values. Inverted lists of retained values bring documents together. A list that
is long is split by the value that follows, then by the two that follow: linked
documents agree on most of their least values, so they agree on such runs too. Lists are
never turned into pairs: their members gather under the least member (the hub), and
each gathering is compared block by block inside tasks, first by sketches, then by
full sets. What leaves a task is at most one link per member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.text import bounded_batches, column, fresh, id_as_text, id_type
from gleaner.operators.components import connected_components
from gleaner.operators.skew import lookup, spread_join
from gleaner.session import store

#: Defaults of the operator. Linked: 100 * intersection >= percent * union.
SHINGLE_WORDS = 5
PERCENT = 80
SKETCH = 64
#: Positions of the sketch with an inverted list, and how many values a list's key may have.
INDEXED = 32
DEPTH = 3
#: Lists longer than this get a longer key.
LONG_LIST = 16
#: A pair estimated so far under the asked similarity isn't verified; a link is estimated lower about
#: once in a hundred million at 85 percent, once in a million at 80.
MARGIN = 0.25
#: What one task compares at once: two blocks of so many members and shingles at most.
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 250_000

_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_WORDS_HELD = 100_000


Frames = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_HELD:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, size: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the word shingles; of a shorter text the whole sequence is one."""
    words = (text or "").encode().lower().split()  # on bytes: ASCII letters and blanks only
    if not words:
        return np.empty(0, dtype=np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(size, len(h))
    x = np.full(len(h) - span + 1, span, dtype=np.uint64)
    for i in range(span):
        x = (x ^ h[i : len(h) - span + 1 + i]) * np.uint64(_MIX[i % 3])
        x ^= x >> np.uint64(29)
    return np.unique((x * np.uint64(_MIX[1])) >> np.uint64(1)).astype(np.int64)


def _set_key(values: np.ndarray) -> bytes | None:
    return hashlib.md5(values.tobytes()).digest() if len(values) else None


def _sketch(size: int) -> Frames:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()  # goes with the task
        for frame in frames:
            sets = [shingle_set(t, size, hashes) for t in frame["text"]]
            yield frame[["doc_id", "row_key", "text_key"]].assign(
                n=[len(s) for s in sets], klass=[_set_key(s) for s in sets], sketch=[s[:SKETCH] for s in sets]
            )

    return run


def _sets(size: int) -> Frames:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for frame in frames:
            sets = [shingle_set(t, size, hashes) for t in frame["text"]]
            yield pd.DataFrame({"klass": [_set_key(s) for s in sets], "values": [s.tobytes() for s in sets]})

    return run


def _text_key(text_col: Column) -> Column:
    """128 bits: among 10^11 rows two texts share 64 bits for sure."""
    return F.unhex(F.md5(text_col))


def _row_key(id_col: Column, text_col: Column) -> Column:
    """128 bits of id and text; nulls differ from empty ones."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    return F.unhex(F.md5(F.concat(part(id_col.cast("string")), F.lit(":"), part(F.md5(text_col)))))


def inverted_lists(classes: DataFrame) -> DataFrame:
    """``(key, klass, n)`` for the retained values of ``classes`` that two or more share."""
    windows = F.transform(
        F.sequence(F.lit(1), F.least(F.size("sketch"), F.lit(INDEXED))), lambda i: F.slice(F.col("sketch"), i, DEPTH)
    )
    entries = classes.select("klass", "n", F.explode(windows).alias("w"))
    lists = None
    for depth in range(1, DEPTH + 1):
        keyed = entries.filter(F.size("w") >= depth).withColumn("key", F.xxhash64(F.slice("w", 1, depth), F.lit(depth)))
        sizes = store(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "list-sizes")
        found = store(
            spread_join(keyed, sizes.withColumn("length", F.col("rows")), "key", "rows", spread_by="klass"), "lists"
        )
        done = found if depth == DEPTH else found.filter(F.col("length") <= LONG_LIST)
        lists = done.select("key", "klass", "n") if lists is None else lists.unionByName(done.select("key", "klass", "n"))
        entries = found.filter(F.col("length") > LONG_LIST).select("klass", "n", "w")
    return lists


def _gatherings(lists: DataFrame) -> DataFrame:
    """``(hub, klass, n)``: all members of lists with the same least member, once each."""
    hubs = lists.groupBy("key").agg(F.min("klass").alias("hub"), F.count(F.lit(1)).alias("rows"))
    return spread_join(lists, hubs, "key", "rows", spread_by="klass").select("hub", "klass", "n").distinct()


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """Add ``task``, the comparisons a member takes part in, one row each.

    A small gathering is one task. A large one is cut by size class (two linked sets lie
    in the same or in neighbouring classes), each class by hash into blocks, and every
    two blocks that may hold a link make a task.
    """
    ratio = float(np.log(100 / percent))
    rows = members.withColumn("q", F.floor(F.log("n") / ratio).cast("int"))
    whole = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    large = store(whole.filter((F.col("rows") > BLOCK_MEMBERS) | (F.col("shingles") > 2 * BLOCK_SHINGLES)).select("hub", "rows"), "large")
    small = lookup(rows, large, "hub", spread_by="klass", size_col="rows", how="left_anti").withColumn("task", F.xxhash64("hub"))
    big = lookup(rows, large, "hub", spread_by="klass", size_col="rows")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    per_class = big.groupBy("hub", "q").agg(parts.alias("parts"))
    around = (
        per_class.select("hub", F.explode(F.array(*[F.struct((F.col("q") + d).alias("q"), F.lit(d).alias("d"), "parts") for d in (-1, 0, 1)])).alias("x"))
        .select("hub", "x.*")
        .groupBy("hub", "q")
        .agg(*[F.coalesce(F.max(F.when(F.col("d") == d, F.col("parts"))), F.lit(0)).alias(name) for d, name in ((-1, "above"), (0, "own"), (1, "below"))])
        .filter("own > 0")
    )
    around = store(around.withColumn("cell", F.xxhash64("hub", "q")).drop("hub", "q").withColumn("rows", F.lit(1 << 40)), "around")
    placed = lookup(big.withColumn("cell", F.xxhash64("hub", "q")), around, "cell", spread_by="klass", size_col="rows")
    placed = placed.withColumn("s", F.pmod(F.xxhash64("klass"), F.col("own")).cast("int"))
    upto = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))
    tasks = F.concat(
        F.transform(upto("own"), lambda o: F.xxhash64("hub", "q", F.least("s", o), "q", F.greatest("s", o))),
        F.transform(upto("above"), lambda o: F.xxhash64("hub", "q", "s", F.col("q") + 1, o)),
        F.transform(upto("below"), lambda o: F.xxhash64("hub", F.col("q") - 1, o, "q", "s")),
    )
    big = placed.withColumn("task", F.explode(tasks))
    return small.select("hub", "klass", "n", "task").unionByName(big.select("hub", "klass", "n", "task"))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of blocks of the incidence matrix."""
    m = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(v) for v in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.empty(len(flat), dtype=bool)
    new[0] = True
    np.not_equal(flat[1:], flat[:-1], out=new[1:])
    number = np.cumsum(new) - 1
    shared = np.bincount(number) > 1
    renamed = np.cumsum(shared) - 1
    keep = shared[number]
    owner, number = owner[keep], renamed[number[keep]]
    out = np.zeros((m, m), dtype=np.float64)
    values = int(number[-1]) + 1 if len(number) else 0
    step = max(1, min(values, max(256, 2_000_000 // m)))  # as wide as there are shared values at most
    for start in range(0, values, step):
        lo, hi = np.searchsorted(number, [start, start + step])
        x = np.zeros((m, step), dtype=np.float32)
        x[owner[lo:hi], number[lo:hi] - start] = 1
        out += x @ x.T
    return out


def _estimates(sketches: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Jaccard estimates from the values under the lesser of both sketches' ends, where both are complete."""
    common = _overlaps(sketches)
    # A sketch that holds its whole set is complete everywhere.
    ends = np.array([s[-1] if len(s) < n else np.iinfo(np.int64).max for s, n in zip(sketches, sizes)])
    # Own values up to the other's end; up to the own end there are all.
    under = np.array([np.searchsorted(s, ends, side="right") for s in sketches], dtype=np.float64)
    return common / np.maximum(under + under.T - common, 1)


def _pair_estimate(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> float:
    """:func:`_estimates` for one pair."""
    ends = [s[-1] for s, n in ((a, size_a), (b, size_b)) if len(s) < n]
    if ends:
        a, b = (s[: np.searchsorted(s, min(ends), side="right")] for s in (a, b))
    common = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return common / max(1, len(a) + len(b) - common)


def _comparable(sizes: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes)


def _by_task(frames: Iterator[pd.DataFrame], names: list[str]) -> Iterator[list[np.ndarray]]:
    """The named columns of each task's rows; batches come sorted by task."""
    held: list[list[np.ndarray]] = []
    last = None

    def whole() -> list[np.ndarray]:
        return held[0] if len(held) == 1 else [np.concatenate(c) for c in zip(*held)]

    for frame in frames:
        task = frame["task"].to_numpy()
        columns = [frame[c].to_numpy() for c in names]
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
        for a, b in zip(cuts, cuts[1:]):
            if held and task[a] != last:
                yield whole()
                held = []
            held.append([c[a:b] for c in columns])
            last = task[a]
    if held:
        yield whole()


def _batched(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= 20_000:
            yield pd.DataFrame(out, columns=names)
            out = []
    if out:
        yield pd.DataFrame(out, columns=names)


def _survivors(percent: int) -> Frames:
    """Members with at least one partner that the sketches don't rule out."""
    least = percent / 100 - MARGIN

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for hub, klass, sizes, sketches in _by_task(frames, ["hub", "klass", "n", "sketch"]):
            if len(sizes) == 2:
                small, large = sorted(sizes.tolist())
                if 100 * small >= percent * large and _pair_estimate(*sketches, *sizes) >= least:
                    yield from ((hub[i], klass[i], int(sizes[i])) for i in (0, 1))
            elif len(sizes) > 2:
                near = _comparable(sizes, percent) & (_estimates(list(sketches), sizes) >= least)
                np.fill_diagonal(near, False)
                yield from ((hub[i], klass[i], int(sizes[i])) for i in np.flatnonzero(near.any(axis=1)))

    return lambda frames: _batched(rows(frames), ["hub", "klass", "n"])


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the link matrix."""
    left, edges = set(range(len(links))), []
    while left:
        queue = [left.pop()]
        while queue:
            i = queue.pop()
            reached = [j for j in np.flatnonzero(links[i]).tolist() if j in left]
            left.difference_update(reached)
            edges += [(i, j) for j in reached]
            queue += reached
    return edges


def _verified(percent: int) -> Frames:
    """Links confirmed on full sets: a spanning forest of each task's links."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for klass, values in _by_task(frames, ["klass", "values"]):
            if len(klass) < 2:
                continue
            sets = [np.frombuffer(v, dtype=np.int64) for v in values]
            sizes = np.array([len(s) for s in sets])
            common = _overlaps(sets)
            links = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
            np.fill_diagonal(links, False)
            yield from ((klass[i], klass[j]) for i, j in _forest(links))

    return lambda frames: _batched(rows(frames), ["src", "dst"])


def _in_tasks(members: DataFrame, payload: DataFrame, col: str, percent: int) -> DataFrame:
    """Members by task with what is compared. Each task's rows lie together and sorted."""
    rows = _blocks(members, percent)
    sized = rows.groupBy("klass").agg(F.count(F.lit(1)).alias("rows"))
    joined = spread_join(rows, payload.select("klass", col).join(sized, "klass"), "klass", "rows", spread_by="task")
    return joined.repartition("task").sortWithinPartitions("task")


def _links(docs: DataFrame, rows: DataFrame, text_col: str, size: int, percent: int) -> DataFrame:
    """``(src, dst)`` between classes of equal sets, enough of them to connect all that are linked."""
    classes = store(
        rows.filter("klass is not null").groupBy("klass").agg(
            F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("text_key").alias("text_key")
        ),
        "classes",
    )
    members = store(_gatherings(inverted_lists(classes)), "gatherings")
    near = store(
        _in_tasks(members, classes, "sketch", percent).mapInPandas(_survivors(percent), "hub binary, klass binary, n bigint").distinct(),
        "near",
    )
    # Full sets of those only, computed anew from one text of each class.
    wanted = near.select("klass").distinct().join(classes.select("klass", "text_key"), "klass").select("text_key").distinct()
    texts = docs.select(column(text_col).alias("text")).withColumn("text_key", _text_key(F.col("text")))
    one_each = lookup(texts, wanted.withColumn("rows", F.lit(1)), "text_key", spread_by="text", size_col="rows").dropDuplicates(["text_key"])
    sets = store(one_each.select("text").mapInPandas(_sets(size), "klass binary, values binary").dropDuplicates(["klass"]), "sets")
    return _in_tasks(near, sets, "values", percent).mapInPandas(_verified(percent), "src binary, dst binary")


def near_duplicate_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One narrow row per document: ``doc_id, n_shingles, component_id, kept``.

    Sets hold shingles of ``size`` words; linked are sets with at least ``percent`` percent in common.
    ``component_id`` is the least id reachable over links, itself included. Documents
    with equal shingle sets form one class, found by a 128-bit hash of the set, and are
    compared once. Texts without words, empty or null, have no shingle and link with
    nothing. A null id never names a component: its row takes the least id of its
    component and isn't kept, unless no row of the component has an id; then
    ``component_id`` is null and all its rows are kept. Rows repeated with one id are all
    kept or all not. An empty table gives an empty table; further columns are ignored.
    """
    return _decided(docs, id_col, text_col, size, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _decided(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    bounded_batches(docs.sparkSession)
    narrow = docs.select(
        id_as_text(id_col),
        column(text_col).alias("text"),
        _row_key(column(id_col), column(text_col)).alias("row_key"),
        _text_key(column(text_col)).alias("text_key"),
    )
    sketched = narrow.mapInPandas(
        _sketch(size), "doc_id string, row_key binary, text_key binary, n bigint, klass binary, sketch array<bigint>"
    )
    rows = store(sketched.withColumn("doc_id", F.col("doc_id").cast(id_type(docs, id_col))), "sketches")
    linked = connected_components(_links(docs, rows, text_col, size, percent))
    sizes = rows.filter("klass is not null").groupBy("klass").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    sizes = store(sizes, "class-sizes")
    # Only classes of several rows or with links need a look-up; the others are their own component.
    named = sizes.join(linked.withColumnRenamed("id", "klass"), "klass", "left").filter("component is not null or rows > 1")
    named = named.withColumn("component", F.coalesce("component", "klass"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    table = store(named.join(least, "component").select("klass", "component_id", "rows", F.lit(True).alias("named")), "components")
    found = lookup(rows.select("doc_id", "row_key", "n", "klass"), table, "klass", spread_by="row_key", size_col="rows", how="left")
    own = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.withColumn("component_id", own).select(
        "doc_id",
        "row_key",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicate_rows` keeps, with all their columns.

    What leaves is a list of row keys (hash of id and text), broadcast when measured to be small.
    """
    key = fresh(docs, "_row_key")
    gone = _decided(docs, id_col, text_col, size, percent).filter("not kept").select(F.col("row_key").alias(key)).distinct()
    keyed = docs.withColumn(key, _row_key(column(id_col), column(text_col)))
    return lookup(keyed, gone, key, spread_by=key, how="left_anti").select(*[column(c) for c in docs.columns])
