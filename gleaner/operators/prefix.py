"""Running sums and row numbers over a whole table, without a one-task window.

Rows are range-partitioned on the order columns, the only exchange they take, and summed
up in that order while their slices are written; only one total per slice (and group) is
then summed up centrally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gleaner.functions.names import column, fresh
from gleaner.operators.skew import small_or_none
from gleaner.session import store

#: Rows of a partition are numbered in the lower bits of the ids that Spark gives.
_ROW_BITS = (1 << 33) - 1


def _sliced(df: DataFrame, order: list[str], name: str) -> DataFrame:
    # The slice number is stored as data: range bounds are sampled, so a
    # second evaluation could cut elsewhere.
    columns = [column(c) for c in order]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn(name, F.spark_partition_id())


def _changes(values: pa.Array) -> np.ndarray:
    """Whether each value but the first is another group than the one before; nulls are one group, as are NaNs."""
    before, here = values[:-1], values[1:]
    same = pc.or_(pc.fill_null(pc.equal(before, here), False), pc.and_(pc.is_null(before), pc.is_null(here)))
    if pa.types.is_floating(values.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(before), pc.is_nan(here)), False))
    return ~same.to_numpy(zero_copy_only=False)


def _local_sums(values: dict[str, str], groups: list[str], inclusive: bool):
    """Adds, by the names in ``values``, the sums over the rows of this slice and group so far.

    From batch to batch only the last sums and group are carried on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: dict = {}
        last: dict[str, pa.Array] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            begins = np.zeros(batch.num_rows, dtype=bool)
            for g in groups:
                keys = batch.column(g)
                begins[0] |= g not in last or _changes(pa.concat_arrays([last[g], keys[:1]]))[0]
                begins[1:] |= _changes(keys)
                last[g] = pa.concat_arrays([keys[-1:]])
            cuts = [0, *(np.flatnonzero(begins[1:]) + 1).tolist(), batch.num_rows]
            added = []
            for v in values:
                numbers = batch.column(v)
                plain = numbers.to_numpy(zero_copy_only=False)
                out = np.empty_like(plain)
                for low, high in zip(cuts, cuts[1:]):
                    goes_on = low == 0 and not begins[0] and v in carried
                    start = carried[v] if goes_on else plain[:1] * 0
                    sums = np.cumsum(np.concatenate([start, plain[low:high]]))
                    out[low:high] = sums[1:] if inclusive else sums[:-1]
                    carried[v] = sums[-1:]
                added.append(pa.array(out, type=numbers.type))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *values.values()])

    return run


def _summable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else T.LongType()


def running_totals(
    df: DataFrame,
    values: dict[str, Column],
    order: list[str],
    within: list[str] | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Add, per entry of ``values``, the sum of that column over all rows up to this one.

    ``order`` must be unique (inside ``within``, when given). With ``within`` the
    sums restart per group (nulls are a group), and a group of any size is spread over
    many slices. Null values count as 0. Columns of ``df`` named as a sum are replaced.
    """
    groups = within or []
    given = {out: fresh(df, f"_value{i}") for i, out in enumerate(values)}
    sums = {v: fresh(df, f"_local{i}") for i, v in enumerate(given.values())}
    valued = df.withColumns({given[out]: v for out, v in values.items()})
    kinds = {v: _summable(valued.schema[v].dataType) for v in sums}
    valued = valued.withColumns({v: F.coalesce(F.col(v).cast(kind), F.lit(0).cast(kind)) for v, kind in kinds.items()})
    part = fresh(df, "_slice")
    cut = _sliced(valued, groups + order, part)
    schema = T.StructType([*cut.schema.fields, *[T.StructField(sums[v], kind) for v, kind in kinds.items()]])
    local = store(cut.mapInArrow(_local_sums(sums, groups, inclusive), schema), "slices")

    # One row per slice and group that meet: slices are ranges, so these are at most slices and groups together.
    keys = {k: fresh(local, f"_key{i}") for i, k in enumerate([part, *groups])}
    before = {v: fresh(local, f"_before{i}") for i, v in enumerate(sums)}
    totals = local.groupBy(*[column(k).alias(name) for k, name in keys.items()]).agg(
        *[F.sum(v).cast(kind).alias(v) for v, kind in kinds.items()]
    )
    earlier = Window.partitionBy(*[keys[g] for g in groups]).orderBy(keys[part]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys.values(), *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).cast(kind).alias(before[v]) for v, kind in kinds.items()]
    )
    offsets, small = small_or_none(offsets) if groups else (offsets, True)
    match = [column(k).eqNullSafe(F.col(name)) for k, name in keys.items()]
    joined = local.join(F.broadcast(offsets) if small else offsets, match)
    done = [(F.col(before[v]) + F.col(sums[v])).alias(out) for out, v in given.items()]
    return joined.select(*[column(c) for c in df.columns if c not in values], *done)


def running_total(
    df: DataFrame,
    value: Column,
    order: list[str],
    out: str,
    within: list[str] | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to this one."""
    return running_totals(df, {out: value}, order, within, inclusive)


def row_index(df: DataFrame, order: list[str], out: str = "row_index", within: list[str] | None = None) -> DataFrame:
    """Add ``out``: 0, 1, 2, … in ``order``; ties are numbered in any order."""
    if within:
        return running_total(df, F.lit(1).cast("bigint"), order, out, within, inclusive=False)
    part, place = fresh(df, "_slice"), fresh(df, "_place")
    # Spark numbers the rows of a partition as they come, here in their order.
    local = store(
        _sliced(df, order, part).withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))), "slices"
    )
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = fresh(local, "_before")
    counts = local.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))  # one row per shuffle partition
    offsets = counts.select(part, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(before))
    kept = [column(c) for c in df.columns if c != out]
    return local.join(F.broadcast(offsets), part).select(*kept, (F.col(before) + F.col(place)).alias(out))
