"""Detection loop: find service breaches, explain them, decide and gate an intervention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import otif_pct, ratio
from ..session import cut_lineage
from .actions import guardrail_eval
from .ordered import with_lead

# What a decision may be and its defaults.
ALLOWED_DECISIONS = ("scm_reorder", "scm_reroute")
DEFAULT_QTY = 4000
UNIT_VALUE_EUR = 23.0


def breaches_below(otif: DataFrame, threshold: float) -> DataFrame:
    """Lane months below the threshold, in any month."""
    lane_month = otif.groupBy("lane", "month").agg(
        F.max("region").alias("region"), otif_pct().alias("otif_pct"), F.sum("orders").alias("orders")
    )
    return lane_month.filter(F.col("otif_pct") < threshold)


def detect_breach(otif: DataFrame, threshold: float) -> DataFrame:
    """Breaches of the latest month that has any breach (of any lane)."""
    # lane months are few next to the view: stored once, then the latest month is a scalar and a plain filter
    found = cut_lineage(breaches_below(otif, threshold))
    return found.filter(F.col("month") == found.agg(F.max("month")).scalar())


def origin(lane: Column | str) -> Column:
    return F.split(lane, "->").getItem(0)


def detect_stockout(breaches: DataFrame, inventory: DataFrame) -> DataFrame:
    """Stockouts at the origin plant of every breached lane in the breached month."""
    empty = inventory.filter(F.col("stockout_flag") == 1).select(
        "plant", "month", "sku", "on_hand_units", "safety_stock", F.round("days_of_supply", 1).alias("days_of_supply")
    )
    return breaches.select("lane", "month", origin("lane").alias("plant")).join(empty, ["plant", "month"])


def decide_reorder(breaches: DataFrame, stockouts: DataFrame, proposal: str | None = None) -> DataFrame:
    """Candidate action per breach.

    ``proposal`` names a column with the JSON text of a model; anything it lacks or gets wrong has a
    default: reorder, 4000 units, 23 EUR per unit, the SKU with the least supply.
    """
    worst = stockouts.groupBy("lane", "month").agg(
        F.count(F.lit(1)).alias("stockouts"), F.min_by("sku", F.struct("days_of_supply", "sku")).alias("_sku")
    )
    text = F.col(proposal) if proposal else F.lit(None).cast("string")
    p = F.from_json(text, "action_type string, qty string, amount_eur string, sku string")
    rows = breaches.withColumn("_p", p).join(worst, ["lane", "month"], "left")
    kind = F.when(F.col("_p.action_type").isin(*ALLOWED_DECISIONS), F.col("_p.action_type")).otherwise(ALLOWED_DECISIONS[0])
    qty = F.coalesce(F.nullif(F.col("_p.qty").try_cast("bigint"), F.lit(0).cast("bigint")), F.lit(DEFAULT_QTY).cast("bigint"))
    amount = F.coalesce(F.nullif(F.col("_p.amount_eur").try_cast("double"), F.lit(0.0)), F.col("qty") * F.lit(UNIT_VALUE_EUR))
    decided = rows.withColumn("action_type", kind).withColumn("qty", qty).withColumn("amount_eur", amount).withColumn(
        "sku", F.coalesce("_p.sku", "_sku")
    )
    return decided.select(
        F.concat_ws("|", "lane", F.col("month").cast("string")).alias("breach_key"),
        "lane", "month", "region", "otif_pct", "action_type", "sku",
        F.coalesce("stockouts", F.lit(0)).alias("stockouts"), "qty", "amount_eur",
    )


def gate_and_route(candidates: DataFrame, handled: DataFrame, policies: DataFrame) -> DataFrame:
    """Skip what is already handled, execute what passes its policy, escalate the rest."""
    payload = F.to_json(F.struct("breach_key", "sku", "qty", F.col("amount_eur").cast("decimal(18,2)").alias("amount_eur")))
    known = handled.select("breach_key").distinct().withColumn("_dup", F.lit(True))
    judged = guardrail_eval(candidates.withColumn("payload", payload), policies)
    path = (
        F.when(F.col("_dup"), "skipped_duplicate").when(F.col("passed"), "auto_executed").otherwise("escalated")
    )
    return judged.join(known, "breach_key", "left").withColumn("path", path).drop("_dup")


def process_exceptions(steps: DataFrame, expected: DataFrame, resolutions: DataFrame, key: str,
                       order: Sequence[str] = ("ts", "event_id"), stuck_factor: float = 2.0) -> DataFrame:
    """Duration of each step until the next one, flagged against the expected time and the service level."""
    timed = with_lead(steps, (key,), order, {"ts": "next_ts"})
    secs = (F.unix_micros("next_ts") - F.unix_micros("ts")).cast("double") / 1e6
    rows = timed.withColumn("duration_s", F.round(secs, 3)).join(expected, "step", "left").join(resolutions, "step", "left")
    stuck = F.coalesce(F.col("duration_s") > F.col("expected_s") * stuck_factor, F.lit(False))
    breach = F.coalesce(F.col("duration_s") > F.col("sla_s"), F.lit(False))
    return rows.withColumn("stuck", stuck).withColumn("sla_breach", breach).withColumn(
        "resolution", F.when(stuck | breach, F.coalesce("resolution", F.lit("needs manual review")))
    )


def excess_inventory(inventory: DataFrame, multiple: float = 3.0) -> DataFrame:
    """Stock far above its safety level."""
    cover = ratio(F.col("on_hand_units"), F.col("safety_stock"))
    return inventory.withColumn("cover_multiple", F.round(cover, 2)).filter(cover > multiple)


def next_best_action(signals: DataFrame, rules: Mapping[str, float] | None = None) -> DataFrame:
    """One recommendation per account and month from ordered rules; close calls are left to a person."""
    r = {"risk": 0.7, "low_risk": 0.3, "complaints": 5, "happy": 50, "thin_margin": 0.3, "doubt": 0.02, **(rules or {})}
    score, margin = F.col("churn_score"), ratio(F.col("margin_eur"), F.col("revenue_eur"))
    action = (
        F.when((score > r["risk"]) & (F.col("complaint_count") >= r["complaints"]), "service_recovery")
        .when(score > r["risk"], "retain")
        .when(margin < r["thin_margin"], "price_review")
        .when((score < r["low_risk"]) & (F.col("nps") > r["happy"]), "upsell")
        .otherwise("monitor")
    )
    close = F.abs(score - r["risk"]) < r["doubt"]
    return signals.withColumn("next_action", action).withColumn("needs_review", close | margin.isNull())
