"""The ten certified finance queries. Segments and dates are parameters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import Period, sum_ratio
from ..operators.metrics import margin_pct, margin_swing
from ..operators.variance import budget_variance, bucketed_rows


def _segment(products: DataFrame, product_line: str | None = None, region: str | None = None) -> DataFrame:
    keep = products
    if product_line is not None:
        keep = keep.filter(F.col("product_line") == product_line)
    if region is not None:
        keep = keep.filter(F.col("region") == region)
    return keep.select("sku", "product_line")


def fin_q01(actuals, products, costs, product_line: str, region: str, periods: Sequence[Period]) -> DataFrame:
    """Why did margin move: volume, price, margin and unit costs by period."""
    rows = bucketed_rows(actuals, _segment(products, product_line, region), costs, periods)
    return rows.groupBy(F.col("period").alias("qtr")).agg(
        F.sum("units").alias("units"),
        F.round(sum_ratio("revenue_eur", "units"), 2).alias("price_per_unit_eur"),
        margin_pct(1).alias("gross_margin_pct"),
        F.round(sum_ratio("raw_material_cost", "units"), 2).alias("raw_mat_cost_per_unit"),
        F.round(sum_ratio("freight_cost", "units"), 2).alias("freight_cost_per_unit"),
        F.round(sum_ratio("energy_cost", "units"), 2).alias("energy_cost_per_unit"),
    ).orderBy("qtr")


def fin_q02(actuals, products, product_line: str, region: str, since: date) -> DataFrame:
    """Margin % and revenue by month of one segment."""
    rows = actuals.filter(F.col("month") >= F.lit(since)).join(_segment(products, product_line, region), "sku")
    return rows.groupBy("month").agg(
        margin_pct(1).alias("gross_margin_pct"), F.sum("revenue_eur").cast("double").alias("revenue_eur")
    ).orderBy("month")


def fin_q03(actuals, products, periods: Sequence[Period]) -> DataFrame:
    """Margin decline between two periods by product line and region, worst first."""
    swing = margin_swing(actuals, products, ("product_line", "region"), periods)
    return swing.select(
        "product_line", "region",
        F.round("base", 1).alias("q1_gm_pct"),
        F.round("target", 1).alias("q2_gm_pct"),
        F.round("delta", 1).alias("delta_pp"),
    ).orderBy(F.asc_nulls_last("delta_pp"), "product_line", "region")


def fin_q04(actuals, month: date) -> DataFrame:
    """Company total of one month."""
    return actuals.filter(F.col("month") == F.lit(month)).agg(
        F.sum("revenue_eur").cast("double").alias("revenue_eur"),
        F.sum("gross_margin_eur").cast("double").alias("gross_margin_eur"),
        margin_pct(1).alias("gross_margin_pct"),
    )


def fin_q05(costs, products, product_line: str, region: str, period: Period) -> DataFrame:
    """Cost of goods of one segment and period in its four buckets."""
    _, lo, hi = period
    rows = costs.filter(F.col("month").between(F.lit(lo), F.lit(hi))).join(
        _segment(products, product_line, region), "sku"
    )
    return rows.agg(
        *[
            F.round(F.sum(c).cast("double"), 0).alias(f"{c}_eur")
            for c in ("raw_material_cost", "freight_cost", "energy_cost", "overhead")
        ]
    )


def fin_q06(fx, currencies: Sequence[str], lo: date, hi: date) -> DataFrame:
    """Rate series of the named currencies."""
    return fx.filter(F.col("currency").isin(*currencies) & F.col("month").between(F.lit(lo), F.lit(hi))).select(
        "currency", "month", "rate_to_eur"
    ).orderBy("currency", "month")


def fin_q07(actuals, products, budget, product_line: str, region: str, since: date) -> DataFrame:
    """Actual against budget margin by month."""
    rows = actuals.filter(F.col("month") >= F.lit(since)).join(_segment(products, product_line, region), "sku")
    return budget_variance(rows, budget).orderBy("month")


def fin_q08(actuals, products, product_line: str, region: str, since: date) -> DataFrame:
    """Units and realised price by month."""
    rows = actuals.filter(F.col("month") >= F.lit(since)).join(_segment(products, product_line, region), "sku")
    return rows.groupBy("month").agg(
        F.sum("units").alias("units"), F.round(sum_ratio("revenue_eur", "units"), 2).alias("realized_price_eur")
    ).orderBy("month")


def fin_q09(actuals, products, product_line: str, region: str, periods: Sequence[Period], k: int = 5) -> DataFrame:
    """The SKUs of one segment with the largest margin decline."""
    swing = margin_swing(actuals, _segment(products, product_line, region), ("sku",), periods)
    return swing.select("sku", F.round("delta", 1).alias("delta_pp")).orderBy(
        F.asc_nulls_last("delta_pp"), "sku"
    ).limit(k)


def fin_q10(actuals, products, product_line: str, period: Period) -> DataFrame:
    """One product line compared across regions."""
    _, lo, hi = period
    rows = actuals.filter(F.col("month").between(F.lit(lo), F.lit(hi))).join(_segment(products, product_line), "sku")
    return rows.groupBy("region").agg(margin_pct(1).alias("q2_gross_margin_pct")).orderBy("q2_gross_margin_pct", "region")


