"""Governance: row security, chargeback, budgets, decisions."""

from pyspark.sql import functions as F

from ..operators import governance as G
from ..operators import keyed as K
from ..sources import io as IO
from .core import PERSONA_SCHEMA, PERSONAS, PRICES
from .registry import Registry

REG = Registry()

PRICE_SQL = """prices(served_model, price_per_1k) AS (VALUES ('click', CAST(0.012 AS DECIMAL(12,6))), ('view', CAST(0.0008 AS DECIMAL(12,6))),
    ('purchase', CAST(0.0003 AS DECIMAL(12,6))), ('signup', CAST(0.0008 AS DECIMAL(12,6))), ('error', CAST(0.0003 AS DECIMAL(12,6)))),
  costed AS (SELECT l.*, CAST(ROUND(l.total_tokens * CAST(p.price_per_1k * 1000000 AS BIGINT) / 1000.0) AS BIGINT) AS micro_usd
             FROM payload_logs l LEFT JOIN prices p ON p.served_model = l.served_model)"""


def _personas(star):
    return IO.read_rows(star.spark, PERSONAS, PERSONA_SCHEMA)


def _costed(star):
    prices = IO.read_rows(star.spark, PRICES, "served_model string, price_per_1k double")
    return G.usage_cost(star.payload_logs(), prices)


@REG.add("rls_filter", "margin_actuals", "SELECT sku, region, month, units FROM margin_actuals WHERE region = 'EUROPE'")
def _(star):
    return G.rls_filter(star.margin_actuals().select("sku", "region", "month", "units"), _personas(star), "planner")


@REG.add("rls_visible_counts", "accounts", """
    SELECT 'controller' AS user_email, COUNT(DISTINCT region) AS before_change, COUNT(DISTINCT region) AS after_change FROM accounts
    UNION ALL SELECT 'planner', COUNT(DISTINCT region) FILTER (region = 'EUROPE'), COUNT(DISTINCT region) FROM accounts
    UNION ALL SELECT 'rep', COUNT(DISTINCT region) FILTER (region = 'ASIA'), COUNT(DISTINCT region) FILTER (region = 'ASIA') FROM accounts""")
def _(star):
    people = _personas(star)
    widened = K.update_where(people, F.col("user_email") == "planner", {"region_scope": F.lit("ALL")})
    rows = star.accounts()
    before = G.rls_visible_counts(rows, people).withColumnRenamed("visible", "before_change")
    after = G.rls_visible_counts(rows, widened).withColumnRenamed("visible", "after_change")
    return before.join(after, "user_email")


@REG.add("persona_view", "accounts", """
    SELECT account_id, region, '***' AS account_name, segment FROM accounts WHERE region = 'ASIA'""")
def _(star):
    rows = star.accounts().select("account_id", "region", "account_name", "segment")
    return G.persona_view(rows, _personas(star), "rep", {"account_name": ("controller",), "segment": ("controller", "rep")})


@REG.add("access_decide", sql="""
    SELECT event_id, event_type AS request_class, value AS risk, CASE
        WHEN event_type = 'error' THEN 'escalate'
        WHEN event_type = 'purchase' THEN 'deny'
        WHEN value > CASE event_type WHEN 'view' THEN 1000.0 WHEN 'click' THEN 20.0 ELSE 10.0 END THEN 'escalate'
        ELSE 'allow' END AS outcome FROM events""")
def _(star):
    policy = IO.read_rows(star.spark, (("view", "allow", 1000.0), ("click", "allow", 20.0), ("signup", "allow", 10.0),
                                       ("purchase", "deny", 0.0)), "request_class string, decision string, max_risk double")
    requests = star.table("events").select("event_id", F.col("event_type").alias("request_class"), F.col("value").alias("risk"))
    return G.access_decide(requests, policy)


@REG.add("usage_cost", "payload_logs", """
    SELECT request_id, served_model, total_tokens, CAST(micro_usd AS DOUBLE) / 1000000 AS cost_usd FROM costed""", extra=PRICE_SQL)
def _(star):
    return _costed(star).select("request_id", "served_model", "total_tokens", F.col("cost_usd").cast("double").alias("cost_usd"))


USAGE = """COUNT(*) AS calls, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens,
           ROUND(CAST(SUM(micro_usd) AS DOUBLE) / 1000000, 4) AS cost_usd"""


@REG.add("chargeback_group", "payload_logs", f"""
    SELECT user_group, {USAGE}, ROUND(CAST(SUM(duration_ms) AS DOUBLE) / COUNT(duration_ms)) AS avg_latency_ms,
           ROUND(CAST(SUM(micro_usd) AS DOUBLE) / 1000000 / COUNT(*), 5) AS cost_per_call
    FROM costed GROUP BY 1""", extra=PRICE_SQL)
def _(star):
    return G.chargeback_group(_costed(star))


@REG.add("chargeback_model", "payload_logs", f"""
    SELECT served_model, 'model' || request_id % 3 AS model, {USAGE} FROM costed GROUP BY ALL""", extra=PRICE_SQL)
def _(star):
    # the fixture has no model column: each route is served by three models in turn
    return G.chargeback_model(_costed(star).withColumn("model", F.concat(F.lit("model"), (F.col("request_id") % 3).cast("string"))))


@REG.add("budget_overage", "payload_logs", """
    SELECT user_group, month, CAST(c AS DOUBLE) / 1000000 AS cost_usd, budget_usd,
           ROUND((CAST(c AS DOUBLE) / 1000000 - budget_usd) / budget_usd * 100, 1) AS over_pct,
           CASE WHEN budget_usd IS NULL THEN 'no_budget' WHEN CAST(c AS DOUBLE) / 1000000 > budget_usd * 1.1 THEN 'over' ELSE 'within' END AS budget_flag
    FROM (SELECT user_group, CAST(date_trunc('month', request_time) AS DATE) AS month, SUM(micro_usd) AS c FROM costed GROUP BY 1, 2) s
    LEFT JOIN (VALUES ('group0', CAST(0.2 AS DOUBLE)), ('group1', CAST(0.35 AS DOUBLE)), ('group2', CAST(100 AS DOUBLE))) b(g, budget_usd) ON g = user_group""",
         extra=PRICE_SQL)
def _(star):
    from ..sources.tables import month_of
    spend = _costed(star).groupBy("user_group", month_of("request_time").alias("month")).agg(
        F.sum("cost_usd").cast("double").alias("cost_usd"))
    budgets = IO.read_rows(star.spark, (("group0", 0.2), ("group1", 0.35), ("group2", 100.0)), "user_group string, budget_usd double")
    return G.budget_overage(spend, budgets, ("user_group",))


@REG.add("policy_decide", "payload_logs", """
    SELECT request_id, served_model, user_group, CASE
        WHEN served_model = 'signup' THEN 'escalate' WHEN served_model = 'error' THEN 'deny'
        WHEN user_group = 'group3' OR micro_usd IS NULL THEN 'escalate'
        WHEN micro_usd > CASE user_group WHEN 'group0' THEN 500 WHEN 'group1' THEN 50 ELSE 10 END THEN 'deny'
        ELSE 'allow' END AS outcome FROM costed""", extra=PRICE_SQL)
def _(star):
    from decimal import Decimal
    registry = IO.read_rows(star.spark, (("click", True), ("view", True), ("purchase", True), ("error", False)),
                            "served_model string, approved boolean")
    budgets = IO.read_rows(star.spark, (("group0", Decimal("0.000500")), ("group1", Decimal("0.000050")), ("group2", Decimal("0.000010"))),
                           "user_group string, remaining_usd decimal(20,6)")
    return G.policy_decide(_costed(star), registry, budgets).select("request_id", "served_model", "user_group", "outcome")


@REG.add("control_check", sql="""
    SELECT c.id AS control_id, COALESCE(e.samples, 0) AS samples, e.worst, CASE
        WHEN COALESCE(e.samples, 0) < c.min_samples THEN 'insufficient_evidence' WHEN e.worst <= c.lim THEN 'pass' ELSE 'fail' END AS outcome
    FROM (VALUES ('click', 1, CAST(1000 AS DOUBLE)), ('view', 1, CAST(5 AS DOUBLE)), ('refund', 1, CAST(10 AS DOUBLE)),
                 ('signup', 1000000, CAST(10 AS DOUBLE))) c(id, min_samples, lim)
    LEFT JOIN (SELECT event_type, COUNT(value) AS samples, MAX(value) AS worst FROM events GROUP BY 1) e ON e.event_type = c.id""")
def _(star):
    controls = IO.read_rows(star.spark, (("click", 1, 1000.0), ("view", 1, 5.0), ("refund", 1, 10.0), ("signup", 1000000, 10.0)),
                            "control_id string, min_samples bigint, limit_value double")
    evidence = star.table("events").select(F.col("event_type").alias("control_id"), F.col("value").alias("measured"))
    return G.control_check(controls, evidence).select("control_id", "samples", "worst", "outcome")
