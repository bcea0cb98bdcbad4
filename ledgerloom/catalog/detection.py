"""Detection loop."""

from pyspark.sql import functions as F

from ..operators import actions as A
from ..operators import detect as X
from ..session import cut_lineage
from ..sources import io as IO
from .actions import SCOPE
from .registry import Registry

REG = Registry()
THRESHOLD = 20.0

# The share of perfect orders is cut to hundredths of a percent per plant and SKU before it is weighted again.
BREACH_SQL = """cells AS (
    SELECT plant_no, region, month, COUNT(*) AS n,
           COUNT(CASE WHEN l_returnflag <> 'R' AND l_linestatus = 'F' THEN 1 END) * 10000 // COUNT(*) AS share
    FROM plant_lines GROUP BY plant_no, region, month, product_line, regionkey, size_digit),
  breaches AS (
    SELECT 'P' || plant_no || '->' || region AS lane, region, month, SUM(n)::BIGINT AS orders,
           round(SUM(round(share / 10000.0::DOUBLE * n)::BIGINT)::DOUBLE / SUM(n) * 100, 1) AS otif_pct
    FROM cells GROUP BY plant_no, region, month HAVING otif_pct < 20),
  detected AS (FROM breaches QUALIFY month = MAX(month) OVER ())"""
STOCK_SQL = BREACH_SQL + """,
  stock AS (SELECT b.lane, b.month, i.plant, i.sku, i.on_hand_units, i.safety_stock, ROUND(i.days_of_supply, 1) AS days_of_supply
            FROM {source} b JOIN inventory i ON i.plant = string_split(b.lane, '->')[1] AND i.month = b.month AND i.stockout_flag = 1)"""


@REG.add("detect_breach", "plant_lines", "SELECT lane, region, month, otif_pct, orders FROM detected", extra=BREACH_SQL)
def _(star):
    return X.detect_breach(star.otif(), THRESHOLD)


@REG.add("detect_stockout", "plant_lines inventory", "SELECT * FROM stock", extra=STOCK_SQL.format(source="detected"))
def _(star):
    star = star.with_plant_facts()
    return X.detect_stockout(X.detect_breach(star.otif(), THRESHOLD), star.inventory())


PROPOSAL_SQL = """proposed AS (
    SELECT *, CASE WHEN orders % 3 = 0 THEN 'scm_reroute' ELSE 'scm_reorder' END AS action_type,
           CASE WHEN orders % 2 = 0 THEN orders * 100 ELSE 4000 END AS qty FROM breaches)"""
DECIDE_SQL = STOCK_SQL.format(source="breaches") + ",\n" + PROPOSAL_SQL + """,
  decided AS (
    SELECT p.lane || '|' || CAST(p.month AS VARCHAR) AS breach_key, p.lane, p.month, p.region, p.otif_pct, p.action_type, w.sku,
           COALESCE(w.n, 0) AS stockouts, CAST(p.qty AS BIGINT) AS qty, CAST(p.qty * 23 AS DOUBLE) AS amount_eur
    FROM proposed p LEFT JOIN (SELECT lane, month, COUNT(*) AS n, arg_min(sku, (days_of_supply, sku)) AS sku FROM stock GROUP BY 1, 2) w
      ON w.lane = p.lane AND w.month = p.month)"""


def _candidates(star):
    """Every breach of the whole history, with the text a model could have answered."""
    star = star.with_plant_facts()
    found = X.breaches_below(star.otif(), THRESHOLD)
    n = F.col("orders")
    text = F.concat(
        F.lit('{"action_type": "'), F.when(n % 3 == 0, "scm_reroute").when(n % 3 == 1, "drop_everything").otherwise("scm_reorder"),
        F.lit('"'), F.when(n % 2 == 0, F.concat(F.lit(', "qty": '), (n * 100).cast("string"))).otherwise(F.lit("")), F.lit("}"))
    return X.decide_reorder(found.withColumn("model_text", text), X.detect_stockout(found, star.inventory()), "model_text")


@REG.add("decide_reorder", "plant_lines inventory", "SELECT * FROM decided", extra=DECIDE_SQL)
def _(star):
    return _candidates(star)


@REG.add("gate_and_route", "plant_lines inventory", """
    SELECT breach_key, action_type, amount_eur, CASE
        WHEN month < DATE '1998-01-01' AND orders_even THEN 'skipped_duplicate'
        WHEN region IN ('EUROPE', 'AFRICA') AND amount_eur <= CASE action_type WHEN 'scm_reorder' THEN 100000 ELSE 50000 END THEN 'auto_executed'
        ELSE 'escalated' END AS path
    FROM (SELECT *, qty <> 4000 AS orders_even FROM decided) d""", extra=DECIDE_SQL)
def _(star):
    candidates = cut_lineage(_candidates(star))  # few rows, used twice
    handled = candidates.filter((F.col("month") < F.lit("1998-01-01").cast("date")) & (F.col("qty") != 4000)).select("breach_key")
    return X.gate_and_route(candidates, handled, A.policy_table(star.spark, SCOPE)).select(
        "breach_key", "action_type", "amount_eur", "path")


EXPECTED = (("view", 600.0, 86400.0), ("click", 1800.0, 7200.0), ("purchase", 36000.0, 43200.0), ("signup", 10.0, 100000.0))
FIXES = (("view", "remind the user"), ("click", "reopen the case"))


@REG.add("process_exceptions", sql="""
    SELECT event_id, step, duration_s, stuck, sla_breach,
           CASE WHEN stuck OR sla_breach THEN COALESCE(CASE step WHEN 'view' THEN 'remind the user' WHEN 'click' THEN 'reopen the case' END, 'needs manual review') END AS resolution
    FROM (SELECT event_id, step, duration_s, COALESCE(duration_s > e * 2, FALSE) AS stuck, COALESCE(duration_s > s, FALSE) AS sla_breach
          FROM (SELECT event_id, event_type AS step,
                       ROUND(CAST(epoch_us(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS DOUBLE) / 1000000, 3) AS duration_s
                FROM events) t
          LEFT JOIN (VALUES ('view', 600, 86400), ('click', 1800, 7200), ('purchase', 36000, 43200), ('signup', 10, 100000)) x(k, e, s) ON k = step) f""")
def _(star):
    steps = star.table("events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("step"))
    expected = IO.read_rows(star.spark, EXPECTED, "step string, expected_s double, sla_s double")
    fixes = IO.read_rows(star.spark, FIXES, "step string, resolution string")
    return X.process_exceptions(steps, expected, fixes, "user_id").select(
        "event_id", "step", "duration_s", "stuck", "sla_breach", "resolution")


@REG.add("excess_inventory", "inventory", """
    SELECT plant, sku, month, on_hand_units, ROUND(on_hand_units / CAST(safety_stock AS DOUBLE), 2) AS cover_multiple
    FROM inventory WHERE on_hand_units / CAST(safety_stock AS DOUBLE) > 3""")
def _(star):
    return X.excess_inventory(star.inventory(), 3.0).select("plant", "sku", "month", "on_hand_units", "cover_multiple")


@REG.add("next_best_action", "churn_signals sales_actuals", """
    SELECT account_id, month, CASE WHEN churn_score > 0.7 AND complaint_count >= 5 THEN 'service_recovery' WHEN churn_score > 0.7 THEN 'retain'
        WHEN m < 0.3 THEN 'price_review' WHEN churn_score < 0.3 AND nps > 50 THEN 'upsell' ELSE 'monitor' END AS next_action,
        ABS(churn_score - CAST(0.7 AS DOUBLE)) < CAST(0.02 AS DOUBLE) OR m IS NULL AS needs_review
    FROM (SELECT c.*, CAST(s.margin_eur AS DOUBLE) / NULLIF(CAST(s.revenue_eur AS DOUBLE), 0) AS m
          FROM churn_signals c JOIN sales_actuals s ON s.account_id = c.account_id AND s.month = c.month) x""")
def _(star):
    return X.next_best_action(star.account_months()).select("account_id", "month", "next_action", "needs_review")
