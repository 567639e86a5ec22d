"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gleaner.operators.skew import HOT_ROWS, SALTS, spread_join
from gleaner.session import cut_lineage

#: Edges a task contracts at a time.
BLOCK = 500_000
#: A node is hot above this share of a task's rows; its parts then fill all tasks evenly.
PARTS_PER_TASK = 16
LEAST_HOT = 1_000


def _forest(edges: pd.DataFrame) -> pd.DataFrame:
    """Stars with the same components as these edges: each node with the least one it reaches here."""
    codes, nodes = pd.factorize(np.concatenate([edges["u"].to_numpy(), edges["v"].to_numpy()]), sort=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    n = len(edges)
    for a, b in zip(codes[:n].tolist(), codes[n:].tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    roots = np.fromiter((root(x) for x in range(len(nodes))), dtype=np.int64, count=len(nodes))
    moved = np.flatnonzero(roots != np.arange(len(nodes)))
    return pd.DataFrame({"u": nodes[moved], "v": nodes[roots[moved]]})


def contract(edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """Fewer ``(u, v)`` with the same components: blocks of a partition become stars before any shuffle.

    Chains and repeated edges inside a block shrink to one edge per node. A task
    holds one block, whatever its partition's size.
    """

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for frame in frames:
            held.append(frame)
            rows += len(frame)
            if rows >= block:
                yield _forest(pd.concat(held))
                held, rows = [], 0
        if rows:
            yield _forest(pd.concat(held))

    return edges.select("u", "v").mapInPandas(blocks, edges.select("u", "v").schema)


def _hot_rows(df: DataFrame, rows: int) -> int:
    """Rows of a node above which it is spread: a small part of a task's even share."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(HOT_ROWS, max(LEAST_HOT, rows // (PARTS_PER_TASK * tasks)))


def _to_minimum(pairs: DataFrame, max_rows: int, hot_rows: int, salts: int) -> DataFrame:
    """Add to every ``(u, v)`` the least node ``m`` among ``u`` and all its ``v``."""
    least = pairs.groupBy("u").agg(
        F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("_size")
    )
    return spread_join(pairs, least, "u", "_size", spread_by="v", hot_rows=hot_rows, salts=salts, max_rows=max_rows)


def _large_star(edges: DataFrame, max_rows: int, hot_rows: int, salts: int) -> DataFrame:
    """Connect every larger neighbour of a node to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    pairs = _to_minimum(both, 2 * max_rows, hot_rows, salts)
    return pairs.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, max_rows: int, hot_rows: int, salts: int) -> DataFrame:
    """Connect a node and its smaller neighbours to the least of them."""
    pairs = _to_minimum(edges, max_rows, hot_rows, salts)
    moved = pairs.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.filter("u > v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def connected_components(
    edges: DataFrame,
    src: str = "src",
    dst: str = "dst",
    max_rounds: int = 100,
    hot_rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """``(id, component)`` for every node of ``edges``; the component is its least node.

    Partitions are contracted first (:func:`contract`). Each round is stored reliably
    and compared by count and checksum; the loop ends when a round changes nothing.
    Nodes above ``hot_rows`` edges are spread over tasks; by default that is a small
    part of a task's even share, so one star of all edges fills all tasks alike.
    Edges with a null end and loops give no node.
    """
    pairs = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
    # Greatest and least skip nulls, so an edge with a null end is a loop of the other.
    current = cut_lineage(contract(pairs.filter("u > v")).distinct())
    state = _state(current)
    for _ in range(max_rounds):
        # A large-star step gives at most one edge per edge and direction.
        hot = hot_rows or _hot_rows(current, state[0])
        larger = _large_star(current, state[0], hot, salts)
        step = _small_star(larger, 2 * state[0], hot, salts)
        current = cut_lineage(step)
        before, state = state, _state(current)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
