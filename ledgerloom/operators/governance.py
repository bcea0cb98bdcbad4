"""Row-level security, usage chargeback, budgets and deterministic control decisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio

ALL = "ALL"


def _scopes(personas: DataFrame, user: str | None, scope: str) -> DataFrame:
    rows = personas if user is None else personas.filter(F.col("user_email") == user)
    return rows.select("user_email", F.col(scope).alias("_scope"))


def rls_filter(df: DataFrame, personas: DataFrame, user: str, column: str = "region",
               scope: str = "region_scope", admins: Sequence[str] = ()) -> DataFrame:
    """Rows the user may see: administrators and scope ALL see every row, others the rows of their scope.

    The user is a parameter, so the test becomes two scalar subqueries evaluated once and a plain
    filter on the rows: no join and no shuffle of the protected table.
    """
    if user in admins:
        return df
    mine = _scopes(personas, user, scope)
    # Both subqueries give one row: the scopes of one user are a short list.
    sees_all = mine.agg(F.coalesce(F.bool_or(F.col("_scope") == ALL), F.lit(False))).scalar()
    named = mine.agg(F.collect_set("_scope")).scalar()
    return df.filter(sees_all | F.array_contains(named, F.col(column)))


def rls_visible_counts(df: DataFrame, personas: DataFrame, column: str = "region", scope: str = "region_scope") -> DataFrame:
    """Distinct values each persona can see, for all personas at once.

    The distinct values are found first; the persona test then runs on that short list only.
    """
    values = df.select(F.col(column).alias("_value")).filter(F.col("_value").isNotNull()).distinct()
    scopes = _scopes(personas, None, scope).distinct()
    total = values.agg(F.count(F.lit(1))).scalar()
    direct = scopes.join(values, F.col("_scope") == F.col("_value"), "left").groupBy("user_email").agg(
        F.bool_or(F.col("_scope") == ALL).alias("_all"), F.countDistinct("_value").alias("_named")
    )
    return direct.select("user_email", F.when(F.col("_all"), total).otherwise(F.col("_named")).alias("visible"))


def persona_view(df: DataFrame, personas: DataFrame, user: str, masked: Mapping[str, Sequence[str]],
                 column: str = "region", scope: str = "region_scope") -> DataFrame:
    """Row filter plus masked columns: ``masked`` names, per column, the roles that see it in clear.

    A user whose roles are unknown sees no clear value.
    """
    roles = personas.filter(F.col("user_email") == user).agg(F.collect_set("role")).scalar()
    rows = rls_filter(df, personas, user, column, scope)
    return rows.withColumns({
        c: F.when(F.arrays_overlap(roles, F.array(*[F.lit(r) for r in allowed])), F.col(c).cast("string")).otherwise("***")
        for c, allowed in masked.items()
    })


def access_decide(requests: DataFrame, policy: DataFrame, key: str = "request_class") -> DataFrame:
    """Allow, deny or escalate each request by the policy of its class; no policy means escalate."""
    decision = (
        F.when(F.col("decision").isNull(), "escalate")
        .when((F.col("decision") == "allow") & F.col("risk").isNull(), "escalate")
        .when((F.col("decision") == "allow") & (F.col("risk") > F.col("max_risk")), "escalate")
        .otherwise(F.col("decision"))
    )
    joined = requests.join(policy.select(key, "decision", "max_risk"), key, "left")
    return joined.withColumn("outcome", decision).drop("decision", "max_risk")


def usage_cost(calls: DataFrame, prices: DataFrame, model: str = "served_model", tokens: str = "total_tokens") -> DataFrame:
    """Cost of each call: tokens / 1000 times the price of its route, six decimals; NULL for an unpriced route."""
    cost = F.round(F.col(tokens).cast("decimal(18,0)") * F.col("price_per_1k").cast("decimal(12,6)") / 1000, 6)
    return calls.join(prices.select(model, "price_per_1k"), model, "left").withColumn(
        "cost_usd", cost.cast("decimal(20,6)")
    ).drop("price_per_1k")


def _usage() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("calls"),
        F.sum("total_tokens").alias("total_tokens"),
        F.round(F.sum("cost_usd").cast("double"), 4).alias("cost_usd"),
    ]


def chargeback_group(calls: DataFrame, group: str = "user_group") -> DataFrame:
    """Calls, tokens, cost, mean latency and cost per call of each group."""
    return calls.groupBy(group).agg(
        *_usage(),
        F.round(ratio(F.sum("duration_ms"), F.count("duration_ms")), 0).alias("avg_latency_ms"),
        F.round(ratio(F.sum("cost_usd"), F.count(F.lit(1))), 5).alias("cost_per_call"),
    )


def chargeback_model(calls: DataFrame, keys: Sequence[str] = ("served_model", "model")) -> DataFrame:
    """Usage of each route and the model behind it."""
    return calls.groupBy(*keys).agg(*_usage())


def budget_overage(spend: DataFrame, budgets: DataFrame, keys: Sequence[str], tolerance_pct: float = 10.0) -> DataFrame:
    """Cost against budget; over budget only beyond the tolerance, and never decided without a budget."""
    over = F.col("cost_usd").cast("double") - F.col("budget_usd").cast("double")
    pct = F.round(ratio(over, F.col("budget_usd")) * 100, 1)
    flag = (
        F.when(F.col("budget_usd").isNull(), "no_budget")
        .when(F.col("cost_usd").cast("double") > F.col("budget_usd").cast("double") * (1 + tolerance_pct / 100), "over")
        .otherwise("within")
    )
    return spend.join(budgets, list(keys), "left").withColumn("over_pct", pct).withColumn("budget_flag", flag)


def policy_decide(requests: DataFrame, registry: DataFrame, budgets: DataFrame) -> DataFrame:
    """Decide model requests: unregistered or over budget is denied, missing evidence is escalated."""
    joined = requests.join(registry.select("served_model", "approved"), "served_model", "left").join(
        budgets.select("user_group", "remaining_usd"), "user_group", "left"
    )
    outcome = (
        F.when(F.col("approved").isNull(), "escalate")
        .when(~F.col("approved"), "deny")
        .when(F.col("remaining_usd").isNull() | F.col("cost_usd").isNull(), "escalate")
        .when(F.col("cost_usd") > F.col("remaining_usd"), "deny")
        .otherwise("allow")
    )
    return joined.withColumn("outcome", outcome).drop("approved", "remaining_usd")


def control_check(controls: DataFrame, evidence: DataFrame, key: str = "control_id") -> DataFrame:
    """Pass, fail or insufficient evidence per control. Evidence rows are aggregated before the join."""
    found = evidence.groupBy(key).agg(
        F.count("measured").alias("samples"), F.max("measured").alias("worst")
    )
    joined = controls.join(found, key, "left").withColumn("samples", F.coalesce("samples", F.lit(0)))
    outcome = (
        F.when(F.col("samples") < F.col("min_samples"), "insufficient_evidence")
        .when(F.col("worst") <= F.col("limit_value"), "pass")
        .otherwise("fail")
    )
    return joined.withColumn("outcome", outcome)
