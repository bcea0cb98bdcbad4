"""The ten certified commercial queries. Cohorts, accounts, dates and the risk threshold are parameters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import Period, case_bucket

CLOSED = ("ClosedWon", "ClosedLost")


def in_cohort(region: str, segment: str) -> Column:
    return (F.col("region") == region) & (F.col("segment") == segment)


def _whole(col: str) -> Column:
    return F.round(F.sum(col).cast("double"), 0)


def com_q01(churn, accounts, region: str, segment: str, month: date, threshold: float = 0.7) -> DataFrame:
    """Accounts of a cohort above the risk threshold, with their signals."""
    risky = churn.filter((F.col("month") == F.lit(month)) & (F.col("churn_score") > threshold))
    return risky.join(accounts.filter(in_cohort(region, segment)), "account_id").select(
        "account_id", "account_name", "owner_rep", F.round("churn_score", 3).alias("churn_score"),
        "last_order_days", "complaint_count", "nps",
    ).orderBy(F.desc("churn_score"), "account_id")


def com_q02(sales, account_ids: Sequence[str], since: date) -> DataFrame:
    """Monthly revenue of the listed accounts together."""
    rows = sales.filter(F.col("account_id").isin(*account_ids) & (F.col("month") >= F.lit(since)))
    return rows.groupBy("month").agg(_whole("revenue_eur").alias("revenue_eur")).orderBy("month")


def com_q03(churn, accounts, month: date, threshold: float = 0.7) -> DataFrame:
    """Every account above the risk threshold in one month."""
    risky = churn.filter((F.col("month") == F.lit(month)) & (F.col("churn_score") > threshold))
    return risky.join(accounts, "account_id").select(
        "account_id", "account_name", "region", "segment", F.round("churn_score", 3).alias("churn_score")
    ).orderBy(F.desc("churn_score"), "account_id")


def com_q04(churn, account_ids: Sequence[str], since: date) -> DataFrame:
    """Score trend of the listed accounts."""
    rows = churn.filter(F.col("account_id").isin(*account_ids) & (F.col("month") >= F.lit(since)))
    return rows.select("account_id", "month", F.round("churn_score", 3).alias("churn_score")).orderBy("account_id", "month")


def com_q05(accounts, pipeline, account_ids: Sequence[str]) -> DataFrame:
    """Open opportunities and their value per sales rep of the listed accounts."""
    rows = accounts.filter(F.col("account_id").isin(*account_ids)).join(
        pipeline.filter(~F.col("stage").isin(*CLOSED)), "account_id"
    )
    return rows.groupBy("owner_rep").agg(
        F.countDistinct("opp_id").alias("open_opps"), _whole("amount_eur").alias("open_pipeline_eur")
    ).orderBy(F.desc("open_pipeline_eur"), "owner_rep")


def com_q06(churn, accounts, region: str, segment: str, month: date, label: str = "Focus cohort") -> DataFrame:
    """A cohort against the rest of the book."""
    cohort = F.when(in_cohort(region, segment), label).otherwise("Other")
    rows = churn.filter(F.col("month") == F.lit(month)).join(accounts, "account_id")
    return rows.groupBy(cohort.alias("cohort")).agg(
        F.count(F.lit(1)).alias("accounts"),
        F.round(F.avg("churn_score"), 3).alias("avg_churn_score"),
        F.round(F.max("churn_score"), 3).alias("max_churn_score"),
    ).orderBy(F.desc("avg_churn_score"), "cohort")


def com_q07(sales, accounts, month: date) -> DataFrame:
    """Revenue and margin by region in one month."""
    rows = sales.filter(F.col("month") == F.lit(month)).join(accounts.select("account_id", "region"), "account_id")
    return rows.groupBy("region").agg(
        _whole("revenue_eur").alias("revenue_eur"), _whole("margin_eur").alias("margin_eur")
    ).orderBy(F.desc("revenue_eur"), "region")


def com_q08(pipeline, accounts, product_line: str, region: str) -> DataFrame:
    """Open pipeline of one product line and region by stage."""
    rows = pipeline.filter((F.col("product_line") == product_line) & ~F.col("stage").isin(*CLOSED)).join(
        accounts.filter(F.col("region") == region).select("account_id"), "account_id"
    )
    return rows.groupBy("stage").agg(
        F.count(F.lit(1)).alias("opps"), _whole("amount_eur").alias("pipeline_eur")
    ).orderBy(F.desc("pipeline_eur"), "stage")


def revenue_swing(sales, periods: Sequence[Period]) -> DataFrame:
    """Revenue of two periods per account; NULL where a period has no sales. Aggregated before any join."""
    (p0, *_), (p1, *_) = periods
    rows = sales.withColumn("qtr", case_bucket("month", periods)).filter(F.col("qtr").isNotNull())
    first = F.sum(F.when(F.col("qtr") == p0, F.col("revenue_eur")))
    second = F.sum(F.when(F.col("qtr") == p1, F.col("revenue_eur")))
    return rows.groupBy("account_id").agg(first.alias("rev0"), second.alias("rev1"))


def com_q09(sales, accounts, periods: Sequence[Period], k: int = 10) -> DataFrame:
    """The accounts with the largest revenue decline between two periods.

    The account attributes depend on the account id, so the sales are summed per account first and
    only the ``k`` rows of the report are joined to the accounts.
    """
    delta = F.round((F.col("rev1") - F.col("rev0")).cast("double"), 0)
    known = revenue_swing(sales, periods).join(accounts.select("account_id"), "account_id", "left_semi")
    top = known.select(
        "account_id",
        F.round(F.col("rev0").cast("double"), 0).alias("q1_rev"),
        F.round(F.col("rev1").cast("double"), 0).alias("q2_rev"),
        delta.alias("delta_eur"),
    ).orderBy(F.asc_nulls_last("delta_eur"), "account_id").limit(k)
    return top.join(accounts.select("account_id", "account_name", "region"), "account_id").select(
        "account_id", "account_name", "region", "q1_rev", "q2_rev", "delta_eur"
    ).orderBy(F.asc_nulls_last("delta_eur"), "account_id")


def com_q10(account_months, account_ids: Sequence[str], since: date) -> DataFrame:
    """Risk score next to revenue, month by month; ``account_months`` has both."""
    keep = F.col("account_id").isin(*account_ids) & (F.col("month") >= F.lit(since))
    return account_months.filter(keep).select(
        "account_id", "month", F.round("churn_score", 3).alias("churn_score"),
        F.round(F.col("revenue_eur").cast("double"), 0).alias("revenue_eur"), "complaint_count", "nps",
    ).orderBy("account_id", "month")
