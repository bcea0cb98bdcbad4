"""The ten certified supply queries. Lanes, plants, SKUs and dates are parameters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import otif_pct, perfect_orders


def scm_q01(otif, service, region: str, sku_prefix: str, lo: date, hi: date) -> DataFrame:
    """On-time-in-full by month next to service level and backorders of the region."""
    rows = otif.filter(
        (F.col("region") == region) & F.col("sku").startswith(sku_prefix) & F.col("month").between(F.lit(lo), F.lit(hi))
    )
    monthly = rows.groupBy("month").agg(otif_pct().alias("otif_pct"))
    side = service.filter(F.col("region") == region).select("month", "service_pct", "backorder_units")
    return monthly.join(side, "month").orderBy("month")


def scm_q02(lanes) -> DataFrame:
    """Lead time of each lane above the mean of its transport mode, largest first."""
    norm = lanes.groupBy("mode").agg(F.avg("lead_time_days").alias("mode_avg"))
    return lanes.join(norm, "mode").select(
        "lane_id", "origin_plant", "dest_region", "mode", "lead_time_days",
        F.round("mode_avg", 1).alias("mode_avg_days"),
        F.round(F.col("lead_time_days") - F.col("mode_avg"), 1).alias("days_above_mode_avg"),
    ).orderBy(F.desc("days_above_mode_avg"), "lane_id")


def scm_q03(inventory, month: date, plants: Sequence[str]) -> DataFrame:
    """Stockouts of one month at the named plants."""
    hit = (F.col("month") == F.lit(month)) & (F.col("stockout_flag") == 1) & F.col("plant").isin(*plants)
    return inventory.filter(hit).select(
        "plant", "sku", "on_hand_units", "safety_stock", F.round("days_of_supply", 1).alias("days_of_supply")
    ).orderBy("days_of_supply", "plant", "sku")


def scm_q04(service, region: str, since: date) -> DataFrame:
    """Service level and backorders by month of one region."""
    return service.filter((F.col("region") == region) & (F.col("month") >= F.lit(since))).select(
        "month", "service_pct", "backorder_units"
    ).orderBy("month")


def scm_q05(otif, lane: str, since: date) -> DataFrame:
    """Monthly on-time-in-full and orders of one lane."""
    rows = otif.filter((F.col("lane") == lane) & (F.col("month") >= F.lit(since)))
    return rows.groupBy("month").agg(otif_pct().alias("lane_otif_pct"), F.sum("orders").alias("orders")).orderBy("month")


def scm_q06(otif, month: date) -> DataFrame:
    """On-time-in-full by region in one month, lowest first."""
    rows = otif.filter(F.col("month") == F.lit(month))
    return rows.groupBy("region").agg(otif_pct().alias("otif_pct"), F.sum("orders").alias("orders")).orderBy(
        "otif_pct", "region"
    )


def scm_q07(lanes, region_prefix: str) -> DataFrame:
    """Lanes into a region, slowest first, then dearest."""
    return lanes.filter(F.col("dest_region").startswith(region_prefix)).select(
        "lane_id", "mode", "lead_time_days", "cost_per_unit"
    ).orderBy(F.desc("lead_time_days"), F.desc("cost_per_unit"), "lane_id")


def scm_q08(inventory, since: date, k: int = 20) -> DataFrame:
    """Plant and SKU pairs with the most stockout months."""
    return (
        inventory.filter(F.col("month") >= F.lit(since))
        .groupBy("plant", "sku")
        .agg(F.sum("stockout_flag").alias("stockout_months"))
        .filter(F.col("stockout_months") > 0)
        .orderBy(F.desc("stockout_months"), "plant", "sku")
        .limit(k)
    )


def scm_q09(inventory, plant: str, sku: str, since: date) -> DataFrame:
    """Days of supply of one SKU at one plant."""
    hit = (F.col("plant") == plant) & (F.col("sku") == sku) & (F.col("month") >= F.lit(since))
    return inventory.filter(hit).select(
        "month", "on_hand_units", "safety_stock", F.round("days_of_supply", 1).alias("days_of_supply"), "stockout_flag"
    ).orderBy("month")


def scm_q10(otif, region: str, sku_prefix: str, month: date) -> DataFrame:
    """Total, perfect and affected orders."""
    rows = otif.filter(
        (F.col("region") == region) & F.col("sku").startswith(sku_prefix) & (F.col("month") == F.lit(month))
    )
    total, perfect = F.sum("orders"), F.sum(perfect_orders())
    return rows.agg(
        total.alias("total_orders"), perfect.alias("perfect_orders"), (total - perfect).alias("non_perfect_orders")
    )
