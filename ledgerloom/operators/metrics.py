"""Certified metrics, declared once and valid at any grain, and period pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import Period, case_bucket, ratio, sum_ratio


@dataclass(frozen=True)
class MetricView:
    """Named dimensions and aggregate measures over a row source.

    A measure is an aggregate expression over the rows, so a query at a coarser grain aggregates
    the rows again and never averages finished ratios.
    """

    source: DataFrame
    dimensions: tuple[str, ...]
    measures: Mapping[str, Column]

    def query(self, by: Sequence[str], measures: Sequence[str], where: Column | None = None) -> DataFrame:
        unknown = [d for d in by if d not in self.dimensions] + [m for m in measures if m not in self.measures]
        if unknown:
            raise ValueError(f"not in the metric view: {unknown}")
        rows = self.source if where is None else self.source.filter(where)
        aggs = [self.measures[m].alias(m) for m in measures]
        return rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs)


def margin_metrics(actuals: DataFrame, products: DataFrame, periods: Sequence[Period]) -> MetricView:
    """Gross margin by product line, region, month and period."""
    line = products.select("sku", "product_line")
    source = actuals.join(line, "sku").withColumn("quarter", case_bucket("month", periods))
    return MetricView(
        source,
        ("product_line", "region", "month", "quarter"),
        {
            "revenue_eur": F.sum("revenue_eur"),
            "gross_margin_eur": F.sum("gross_margin_eur"),
            "units": F.sum("units"),
            "gross_margin_pct": sum_ratio("gross_margin_eur", "revenue_eur"),
            "realized_price_per_unit": sum_ratio("revenue_eur", "units"),
        },
    )


def margin_pct(digits: int | None = None) -> Column:
    pct = sum_ratio("gross_margin_eur", "revenue_eur") * 100
    return pct if digits is None else F.round(pct, digits)


def pivot_delta(
    df: DataFrame, keys: Sequence[str], value: Column, periods: Sequence[Period], how: str = "max"
) -> DataFrame:
    """Value of two labelled periods side by side: ``base``, ``target`` and ``delta`` (NULL if one is missing).

    ``df`` has a ``period`` column. ``how='max'`` pivots a value computed per group and period,
    ``how='sum'`` sums rows inside the pivot.
    """
    (base, *_), (target, *_) = periods
    fn = F.max if how == "max" else F.sum
    base_v = fn(F.when(F.col("period") == base, value))
    target_v = fn(F.when(F.col("period") == target, value))
    return df.groupBy(*keys).agg(base_v.alias("base"), target_v.alias("target")).withColumn(
        "delta", F.col("target") - F.col("base")
    )


def margin_swing(actuals: DataFrame, products: DataFrame, keys: Sequence[str], periods: Sequence[Period]) -> DataFrame:
    """Certified margin percentage of two periods per group, unrounded."""
    rows = actuals.join(products.select("sku", "product_line"), "sku").withColumn(
        "period", case_bucket("month", periods)
    ).filter(F.col("period").isNotNull())
    grouped = rows.groupBy(*keys, "period").agg(margin_pct().alias("gm_pct"))
    return pivot_delta(grouped, keys, F.col("gm_pct"), periods)


def segment_isolation(swing: DataFrame, focus: Column) -> DataFrame:
    """Swing of the one segment under study against the largest absolute swing of all others."""
    return swing.agg(
        F.round(F.max(F.when(focus, F.col("delta"))), 2).alias("focus_delta_pp"),
        F.round(F.max(F.when(~focus, F.abs("delta"))), 2).alias("max_other_abs_pp"),
        F.count_if(~focus & F.col("delta").isNotNull()).alias("others"),
    )


def recon_gap(parts: DataFrame, part_columns: Sequence[str], total: DataFrame, total_column: str,
              keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Largest absolute gap between the sum of the buckets and the total, per group.

    A key that only one side has counts with its whole amount: a missing bucket row is a gap.
    """
    summed = sum((F.coalesce(F.col(c), F.lit(0)) for c in part_columns), F.lit(0))
    left = parts.select(*keys, summed.alias("_parts"))
    right = total.select(*keys, F.col(total_column).alias("_total"))
    gap = F.abs(F.coalesce(F.col("_parts"), F.lit(0)) - F.coalesce(F.col("_total"), F.lit(0)))
    return left.join(right, list(keys), "full").groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"), F.max(gap).cast("double").alias("max_gap")
    )


