"""Row numbers and neighbours in an order, for keys of any size, null keys included.

A window function sends all rows of a key to one task. That is the way for ordinary keys. Keys with
more than ``HOT_ROWS`` rows are range-partitioned by key and order, so that each spans many tasks:
every task numbers its own slice, and only one summary row per key and slice travels between slices.
The slices are stored once: the summary and the rows must see the same assignment, also after an
executor is lost. ``order`` must be unique per key. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_POSITION_BITS = 33
#: Rows of a key that one task may hold.
HOT_ROWS = 2_000_000


def _matching(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join by keys that may be null; ``right`` keeps its other columns only."""
    renamed = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_of_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_of_{k}" for k in keys])


def _by_size(df: DataFrame, keys: Sequence[str], slices: int | None, plain, split) -> DataFrame:
    """``plain`` for ordinary keys and ``split`` for hot ones; with a given number of slices all keys are split."""
    if slices or not keys:
        return split(df)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS).drop("_n")
    if hot.isEmpty():
        return plain(df)
    hot = cut_lineage(hot)
    return plain(_matching(df, hot, keys, "left_anti")).unionByName(split(_matching(df, hot, keys, "left_semi")))


def _in_order(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order])


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """``df`` sorted globally by keys and order, with ``_slice`` and the position ``_pos`` inside it.

    Without ``slices`` their number follows the size of the data (adaptive execution merges small ones).
    """
    cols = [F.col(c) for c in (*keys, *order)]
    spread_out = df.repartitionByRange(slices, *cols) if slices else df.repartitionByRange(*cols)
    ranged = spread_out.sortWithinPartitions(*cols).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    marked = ranged.select(
        *df.columns,
        F.shiftright("_row", _POSITION_BITS).alias("_slice"),
        F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )
    return cut_lineage(marked)


def _offsets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First position and number of earlier rows of every key and slice. A key has at most one row per slice."""
    per_slice = rows.groupBy(*keys, "_slice").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn",
                    slices: int | None = None) -> DataFrame:
    """``row_number`` from 1 per key; with no keys, one numbering over the whole frame."""
    return _by_size(df, keys, slices, lambda d: d.withColumn(name, F.row_number().over(_in_order(keys, order))),
                    lambda d: _split_numbers(d, keys, order, name, slices))


def _split_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: int | None) -> DataFrame:
    rows = sliced(df, keys, order, slices)
    if not keys:
        # One summary row per slice: a few hundred rows, far below any broadcast limit.
        counts = rows.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        offs = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
        numbered = rows.join(F.broadcast(offs), "_slice").withColumn(name, F.col("_before") + F.col("_pos") + 1)
    else:
        offs = _offsets(rows, keys)
        numbered = _matching(rows, offs, [*keys, "_slice"], "inner").withColumn(
            name, F.col("_before") + F.col("_pos") - F.col("_first") + 1
        )
    return numbered.select(*df.columns, name)


def with_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str],
             slices: int | None = None) -> DataFrame:
    """Value of the previous row of the key, for each ``{column: new name}``; NULL on the first row."""
    at = _in_order(keys, order)
    return _by_size(df, keys, slices, lambda d: d.select("*", *[F.lag(c).over(at).alias(n) for c, n in columns.items()]),
                    lambda d: _split_lag(d, keys, order, columns, slices))


def _split_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str], slices: int | None) -> DataFrame:
    rows = sliced(df, keys, order, slices)
    carried = F.struct(*[F.col(c).alias(n) for c, n in columns.items()])
    last = rows.groupBy(*keys, "_slice").agg(F.max_by(carried, "_pos").alias("_last"))
    carry = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice"))).drop("_last")
    inside = Window.partitionBy(*keys, "_slice").orderBy("_pos")
    stepped = rows.withColumn("_prev", F.lag(carried).over(inside)).withColumn(
        "_head", F.row_number().over(inside) == 1
    )
    joined = _matching(stepped, carry, [*keys, "_slice"], "inner")
    prev: Column = F.when(F.col("_head"), F.col("_carry")).otherwise(F.col("_prev"))
    return joined.withColumn("_prev", prev).select(*df.columns, *[F.col(f"_prev.{n}").alias(n) for n in columns.values()])


def with_lead(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str],
              slices: int | None = None) -> DataFrame:
    """Value of the next row of the key."""
    at = _in_order(keys, order)
    return _by_size(df, keys, slices, lambda d: d.select("*", *[F.lead(c).over(at).alias(n) for c, n in columns.items()]),
                    lambda d: _split_lead(d, keys, order, columns, slices))


def _split_lead(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str], slices: int | None) -> DataFrame:
    rows = sliced(df, keys, order, slices)
    carried = F.struct(*[F.col(c).alias(n) for c, n in columns.items()])
    first = rows.groupBy(*keys, "_slice").agg(F.min_by(carried, "_pos").alias("_first"))
    carry = first.withColumn("_carry", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slice"))).drop("_first")
    inside = Window.partitionBy(*keys, "_slice").orderBy("_pos")
    tail = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(F.desc("_pos"))) == 1
    stepped = rows.withColumn("_next", F.lead(carried).over(inside)).withColumn("_tail", tail)
    joined = _matching(stepped, carry, [*keys, "_slice"], "inner")
    nxt: Column = F.when(F.col("_tail"), F.col("_carry")).otherwise(F.col("_next"))
    return joined.withColumn("_next", nxt).select(*df.columns, *[F.col(f"_next.{n}").alias(n) for n in columns.values()])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last row of each key as an aggregate: partial results are combined before the shuffle."""
    by = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in columns])
    return df.groupBy(*keys).agg(F.max_by(row, by).alias("_row")).select(*keys, "_row.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    by = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in columns])
    return df.groupBy(*keys).agg(F.min_by(row, by).alias("_row")).select(*keys, "_row.*")
