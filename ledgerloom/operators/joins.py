"""Join shapes of the operations model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def above_group_mean(df: DataFrame, group: str, value: str, digits: int = 1) -> DataFrame:
    """Each row next to the mean of its group: aggregate (partial sums per task), then join back."""
    norm = df.groupBy(group).agg(F.avg(value).alias("_mean"))
    return df.join(norm, group).withColumn("group_mean", F.round("_mean", digits)).withColumn(
        "above_mean", F.round(F.col(value) - F.col("_mean"), digits)
    ).drop("_mean")


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (an ungrouped aggregate) to every row, as scalar subqueries."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def scalar_of(df: DataFrame, value: Column, name: str) -> DataFrame:
    """An ungrouped aggregate: always exactly one row, whatever the size of ``df``."""
    return df.agg(value.alias(name))


def ledger_newest(left: DataFrame, ledger: DataFrame, key: str, order: str, n: int = 100) -> DataFrame:
    """Left rows with their ledger entry, newest first, capped as the report asks.

    The ledger has at most one row per key, so the ``n`` newest left rows are found first and only
    they are joined.
    """
    newest = left.orderBy(F.desc(order)).limit(n)
    return newest.join(ledger, key, "left").orderBy(F.desc(order))


def receipts_of(actions: DataFrame, refs: str, receipts: DataFrame, ref: str) -> DataFrame:
    """One row per reference id of an action that has a receipt."""
    return actions.withColumn(ref, F.explode(refs)).drop(refs).join(receipts, ref)


def month_over_month(df: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """Change against the previous month of the same key. ``df`` has one row per key and month."""
    w = Window.partitionBy(*keys).orderBy(month)
    prev = F.lag(value).over(w)
    return df.withColumn("previous", prev).withColumn("change", F.col(value) - prev)
