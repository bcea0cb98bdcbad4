"""Sorted, capped and filtered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import read_rows


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Report of the first ``k`` rows. ``order`` must end in a unique column, or the cut is arbitrary."""
    return df.orderBy(*order).limit(k)


def cap_rows(df: DataFrame, order: Sequence[Column], n: int = 50) -> DataFrame:
    """Result cap before a result leaves Spark."""
    return top_k(df, order, n)


def list_filtered(df: DataFrame, created: str, key: str, **filters) -> DataFrame:
    """Newest first; a filter that is None is not applied."""
    for column, value in filters.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df.orderBy(F.desc(created), F.desc(key))


def ladder(df: DataFrame, level: str = "level", status: str = "status") -> DataFrame:
    """Counts by maturity level and status."""
    return df.groupBy(level, status).agg(F.count(F.lit(1)).alias("n"))


def ladder_zero_fill(df: DataFrame, statuses: Sequence[str], levels: Sequence[int] = (1, 2, 3, 4)) -> DataFrame:
    """Every level and status of the ladder with its count, zero where there is none, and the level total."""
    frame = read_rows(df.sparkSession, [(lv,) for lv in levels], "level bigint").withColumn(
        "status", F.explode(F.array(*[F.lit(s) for s in statuses]))
    )
    filled = frame.join(ladder(df), ["level", "status"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    totals = filled.groupBy("level").agg(F.sum("n").alias("total"))
    return filled.join(totals, "level")
