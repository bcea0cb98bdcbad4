"""Margin variance: metrics per segment and period, and the price / volume / FX / cost bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import Period, case_bucket, ratio, sum_ratio

SEGMENT = ("product_line", "region")
COST_COLUMNS = ("raw_material_cost", "freight_cost", "energy_cost", "overhead")
GRAIN = ("sku", "region", "month")


def bucketed_rows(actuals: DataFrame, products: DataFrame, costs: DataFrame, periods: Sequence[Period]) -> DataFrame:
    """Actual rows inside the periods with product line and the four cost buckets (NULL where no cost row)."""
    line = products.select("sku", "product_line")
    kept = actuals.withColumn("period", case_bucket("month", periods)).filter(F.col("period").isNotNull())
    return kept.join(line, "sku").join(costs.select(*GRAIN, *COST_COLUMNS), list(GRAIN), "left")


def period_fx(fx: DataFrame, periods: Sequence[Period], currency: str = "USD") -> DataFrame:
    """Mean rate of one currency per period, aggregated before the join so that it cannot fan out."""
    return (
        fx.filter(F.col("currency") == currency)
        .withColumn("period", case_bucket("month", periods))
        .filter(F.col("period").isNotNull())
        .groupBy("period")
        .agg(F.round(F.avg("rate_to_eur"), 4).alias("fx_rate_to_eur"))
    )


def variance_metrics(
    actuals: DataFrame, products: DataFrame, costs: DataFrame, fx: DataFrame,
    periods: Sequence[Period], currency: str = "USD", fx_how: str = "left",
) -> DataFrame:
    """Volumes, certified margin and per-unit economics of every segment in every period.

    ``fx_how='inner'`` drops a period that has no rate; the default keeps it with a NULL rate.
    """
    rows = bucketed_rows(actuals, products, costs, periods)
    per_unit = [
        F.round(sum_ratio(c, "units"), 2).alias(n)
        for c, n in (
            ("revenue_eur", "price_per_unit_eur"),
            ("cogs_eur", "cogs_per_unit_eur"),
            ("raw_material_cost", "raw_mat_per_unit_eur"),
            ("freight_cost", "freight_per_unit_eur"),
            ("energy_cost", "energy_per_unit_eur"),
            ("overhead", "overhead_per_unit_eur"),
        )
    ]
    grouped = rows.groupBy(*SEGMENT, "period").agg(
        F.sum("units").alias("units"),
        F.sum("revenue_eur").cast("double").alias("revenue_eur"),
        F.sum("cogs_eur").cast("double").alias("cogs_eur"),
        F.sum("gross_margin_eur").cast("double").alias("gross_margin_eur"),
        F.round(sum_ratio("gross_margin_eur", "revenue_eur") * 100, 1).alias("gross_margin_pct"),
        *per_unit,
    )
    return grouped.join(period_fx(fx, periods, currency), "period", fx_how)


def variance_bridge(
    metrics: DataFrame, base: str, target: str,
    keys: Sequence[str] = SEGMENT, fx_convention: str = "reference",
) -> DataFrame:
    """Split the change of margin % between two periods into price, volume, FX and cost points.

    The inputs are the rounded per-unit figures. Margin % does not depend on scale, so the volume
    leg is the remainder of the other three and is zero up to rounding. ``fx_convention``:
    ``reference`` books a falling rate as a cost increase, ``purchase`` (inputs bought in the
    foreign currency) books it as a saving. A segment that lacks one of the periods has no bridge.
    """
    if fx_convention not in ("reference", "purchase"):
        raise ValueError("fx_convention is 'reference' or 'purchase'")
    fields = {
        "units": "n", "price_per_unit_eur": "p", "cogs_per_unit_eur": "c",
        "raw_mat_per_unit_eur": "r", "fx_rate_to_eur": "f",
    }

    def side(label: str, mark: int) -> DataFrame:
        return metrics.filter(F.col("period") == label).select(
            *keys, *[F.col(c).cast("double").alias(f"{s}{mark}") for c, s in fields.items()]
        )

    v = {f"{s}{i}": F.col(f"{s}{i}") for s in fields.values() for i in (0, 1)}
    moved = v["f1"], v["f0"]
    if fx_convention == "purchase":
        moved = moved[1], moved[0]
    # Without a usable base rate nothing of the cost change can be called FX.
    rate = F.coalesce(F.try_divide(*moved), F.lit(1.0))
    fx_cost = v["r1"] - v["r1"] * rate
    real_cost = v["c0"] + ((v["c1"] - v["c0"]) - fx_cost)

    def margin(p, c):
        return F.try_divide(p - c, p) * 100.0

    legs = (
        side(base, 0)
        .join(side(target, 1), list(keys))
        .withColumn("_m0", margin(v["p0"], v["c0"]))
        .withColumn("_m1", margin(v["p1"], v["c1"]))
        .withColumn("_after_price", margin(v["p1"], v["c0"]))
        .withColumn("_after_cost", margin(v["p1"], real_cost))
        .withColumn("_total", F.col("_m1") - F.col("_m0"))
        .withColumn("_price", F.col("_after_price") - F.col("_m0"))
        .withColumn("_cost", F.col("_after_cost") - F.col("_after_price"))
        .withColumn("_fx", F.col("_m1") - F.col("_after_cost"))
        .withColumn("_volume", F.col("_total") - (F.col("_price") + F.col("_cost") + F.col("_fx")))
    )

    def change(s: str):
        return F.round(ratio(v[f"{s}1"] - v[f"{s}0"], v[f"{s}0"]) * 100.0, 1)

    return legs.select(
        *keys,
        F.round("_m0", 1).alias("from_margin_pct"),
        F.round("_m1", 1).alias("to_margin_pct"),
        # + 0.0 turns a rounded -0.0 into 0.0
        *[(F.round(f"_{leg}", 1) + 0.0).alias(f"{leg}_pp") for leg in ("total", "price", "volume", "fx", "cost")],
        change("p").alias("price_change_pct"),
        change("n").alias("units_change_pct"),
        change("r").alias("raw_change_pct"),
        change("f").alias("fx_change_pct"),
    )


def driver_rank(bridge: DataFrame, keys: Sequence[str] = SEGMENT) -> DataFrame:
    """The four drivers of each segment by size of effect; equal sizes keep the order of their names."""
    legs = bridge.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(d).alias("driver"), F.col(f"{d}_pp").alias("pp")) for d in ("cost", "fx", "price", "volume")])
        ).alias("leg"),
    ).select(*keys, "leg.driver", "leg.pp")
    # Four rows per segment, sorted inside one array: no window over a growing group.
    order = F.struct((-F.abs("pp")).alias("o"), F.col("driver"), F.col("pp"))
    ranked = legs.groupBy(*keys).agg(F.sort_array(F.collect_list(order)).alias("legs"))
    return ranked.select(*keys, F.posexplode("legs").alias("pos", "leg")).select(
        *keys, (F.col("pos") + 1).cast("bigint").alias("driver_rank"), "leg.driver", F.col("leg.pp").alias("delta_pp")
    )


def budget_variance(actuals: DataFrame, budget: DataFrame, by: Sequence[str] = ("month",)) -> DataFrame:
    """Actual minus budget on the grain both sides share."""
    rows = actuals.join(budget, list(GRAIN))
    return rows.groupBy(*by).agg(
        F.round(F.sum("gross_margin_eur").cast("double"), 0).alias("actual_margin_eur"),
        F.round(F.sum("budget_margin_eur").cast("double"), 0).alias("budget_margin_eur"),
        F.round((F.sum("gross_margin_eur") - F.sum("budget_margin_eur")).cast("double"), 0).alias("variance_eur"),
    )


def cost_breakdown(costs: DataFrame, products: DataFrame, periods: Sequence[Period], by: Sequence[str]) -> DataFrame:
    """The four cost buckets summed per segment and period."""
    rows = costs.withColumn("period", case_bucket("month", periods)).filter(F.col("period").isNotNull()).join(
        products.select("sku", "product_line"), "sku"
    )
    return rows.groupBy(*by).agg(*[F.round(F.sum(c).cast("double"), 0).alias(f"{c}_eur") for c in COST_COLUMNS])
