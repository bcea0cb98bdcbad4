"""Routing, evaluation and data quality."""

from pyspark.sql import functions as F

from ..operators import evals as X
from ..operators import metrics as M
from ..session import cut_lineage
from ..sources.star import FOCUS_LINE, FOCUS_REGION, H1
from ..sources.tables import month_of
from .finance import PERIODS, SWING
from .registry import Registry

REG = Registry()

# Words that send a question to a domain.
DOMAIN_WORDS = {
    "FINANCE": ("margin", "price", "fx", "cost", "budget", "freight", "energy"),
    "SCM": ("otif", "inventory", "stockout", "stockouts", "lane", "delivery", "service", "backorders"),
    "COMMERCIAL": ("account", "accounts", "churn", "nps", "revenue", "pipeline", "complaints"),
}
QUESTIONS = {
    "click": "Why did margin and price move?", "view": "Show OTIF and stockouts by lane.",
    "purchase": "Which account has churn risk, and what margin?", "signup": "Hello there!",
    "error": "Did poor delivery service raise the cost of this account?",
}
QUESTION_SQL = "questions AS (SELECT event_id AS question_id, CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in QUESTIONS.items()) + " END AS question FROM events)"


def _hit(words):
    return f"CAST(len(list_intersect(ws, [{', '.join(repr(w) for w in words)}])) AS BIGINT)"


@REG.add("route_domains", sql=f"""
    SELECT question_id, domain, score FROM (
        SELECT question_id, unnest(['FINANCE', 'SCM', 'COMMERCIAL']) AS domain, unnest([f, s, c]) AS score, f + s + c AS total
        FROM (SELECT question_id, {_hit(DOMAIN_WORDS['FINANCE'])} AS f, {_hit(DOMAIN_WORDS['SCM'])} AS s, {_hit(DOMAIN_WORDS['COMMERCIAL'])} AS c
              FROM (SELECT question_id, string_split_regex(lower(question), '[\\s.,;:!?]+') AS ws FROM questions) w) t) d
    WHERE score > 0 OR total = 0""", extra=QUESTION_SQL)
def _(star):
    q = None
    for kind, text in QUESTIONS.items():
        hit = F.col("event_type") == kind
        q = F.when(hit, text) if q is None else q.when(hit, text)
    return X.route_domains(star.table("events").select(F.col("event_id").alias("question_id"), q.alias("question")), DOMAIN_WORDS)


LEGS = {"FINANCE": "margin_actuals", "SCM": "otif", "COMMERCIAL": "churn_signals", "QUOTE": "no_such_view"}


@REG.add("leg_trace", "margin_actuals otif churn_signals", " UNION ALL ".join(
    f"SELECT '{d}' AS domain, 'SELECT * FROM {v}' AS query, COUNT(*) AS rows_returned, NULL::VARCHAR AS error FROM {v}" for d, v in list(LEGS.items())[:3])
    + " UNION ALL SELECT 'QUOTE', 'SELECT * FROM no_such_view', NULL, 'TABLE_OR_VIEW_NOT_FOUND'")
def _(star):
    def leg(view):
        return lambda: getattr(star, view)() if hasattr(star, view) else star.spark.table(view)

    sizes = cut_lineage(star.view_rows())
    return X.leg_trace({d: (f"SELECT * FROM {v}", leg(v)) for d, v in LEGS.items()},
                       lambda domain, _: sizes.filter(F.col("view") == LEGS[domain]).select(F.col("row_count").alias("rows_returned")))


ANSWERS_SQL = """asked AS (
    SELECT o_orderkey AS question_id, o_orderstatus AS run_tag, CAST(date_trunc('month', o_orderdate) AS DATE) AS created_at,
           format('{:.2f}', o_totalprice) AS amount, 'status ' || o_orderstatus AS st, o_orderpriority AS pr FROM orders),
  answers AS (
    SELECT *, 'Order worth ' || amount || ' with ' || st || ' and priority ' || pr AS evidence,
           CASE question_id % 4 WHEN 0 THEN 'It is worth ' || amount || ' with ' || st || '.' WHEN 1 THEN 'The amount is 17 or ' || amount || '.'
                WHEN 2 THEN NULL ELSE 'Priority ' || pr || ', ' || st || ', ' || amount || '.' END AS answer FROM asked),
  judged AS (
    SELECT question_id, run_tag, created_at, answer,
           ROUND((COALESCE(CAST(contains(lower(answer), lower(amount)) AS INT), 0) + COALESCE(CAST(contains(lower(answer), lower(st)) AS INT), 0)
                  + COALESCE(CAST(contains(lower(answer), lower(pr)) AS INT), 0)) / 3.0::DOUBLE, 4) AS correctness,
           ROUND(CASE WHEN answer IS NULL THEN 0.0 WHEN len(nums) = 0 THEN 1.0
                      ELSE len(list_filter(nums, lambda n: list_contains(known, n))) / CAST(len(nums) AS DOUBLE) END, 4) AS groundedness
    FROM (SELECT *, regexp_extract_all(answer, '[0-9]+(?:\\.[0-9]+)?') AS nums, regexp_extract_all(evidence, '[0-9]+(?:\\.[0-9]+)?') AS known FROM answers) n),
  results AS (SELECT *, correctness >= 0.6 AND groundedness >= 0.6 AS passed FROM judged),
  runs AS (
    SELECT run_tag, created_at, COUNT(*) AS n_questions, COUNT(*) FILTER (passed) AS n_pass,
           ROUND(COUNT(*) FILTER (passed) / CAST(COUNT(*) AS DOUBLE), 4) AS pass_rate, ROUND(CAST(SUM(CAST(correctness AS DECIMAL(6,4))) AS DOUBLE) / COUNT(correctness), 4) AS avg_correctness,
           ROUND(CAST(SUM(CAST(groundedness AS DECIMAL(6,4))) AS DOUBLE) / COUNT(groundedness), 4) AS avg_groundedness FROM results GROUP BY 1, 2)"""


def _results(star):
    o = star.table("orders")
    amount, st, pr = F.format_string("%.2f", "o_totalprice"), F.concat(F.lit("status "), F.col("o_orderstatus")), F.col("o_orderpriority")
    k = F.col("o_orderkey") % 4
    base = o.select(
        F.col("o_orderkey").alias("question_id"), F.col("o_orderstatus").alias("run_tag"), month_of("o_orderdate").alias("created_at"),
        F.concat(F.lit("Order worth "), amount, F.lit(" with "), st, F.lit(" and priority "), pr).alias("evidence"),
        F.when(k == 0, F.concat(F.lit("It is worth "), amount, F.lit(" with "), st, F.lit(".")))
        .when(k == 1, F.concat(F.lit("The amount is 17 or "), amount, F.lit(".")))
        .when(k == 3, F.concat(F.lit("Priority "), pr, F.lit(", "), st, F.lit(", "), amount, F.lit("."))).alias("answer"))
    facts = o.select(F.col("o_orderkey").alias("question_id"), F.explode(F.array(amount, st, pr)).alias("fact"))
    return X.eval_facts(base, facts)


def _runs(star):
    return X.eval_run_summary(_results(star), ("run_tag", "created_at"))


@REG.add("eval_facts", sql="SELECT question_id, correctness, groundedness, passed FROM results", extra=ANSWERS_SQL)
def _(star):
    return _results(star).select("question_id", "correctness", "groundedness", "passed")


@REG.add("eval_guideline", sql=r"""
    SELECT conv_id, turn, CAST(len(list_filter(string_split_regex(text, '[.!?]+'), lambda s: length(trim(s)) > 0)) AS BIGINT) AS sentences,
           len(list_filter(string_split_regex(text, '[.!?]+'), lambda s: length(trim(s)) > 0)) <= 4 AS concise
    FROM conversations WHERE role = 'assistant'""")
def _(star):
    answers = star.table("conversations").filter(F.col("role") == "assistant")
    return X.eval_guideline(answers, "text").select("conv_id", "turn", "sentences", "concise")


@REG.add("eval_run_summary", sql="SELECT * FROM runs", extra=ANSWERS_SQL)
def _(star):
    return _runs(star)


@REG.add("eval_history", sql="""
    SELECT run_tag, created_at, n_pass, n_questions, ROUND(pass_rate * 100) AS pass_pct FROM runs ORDER BY created_at DESC, run_tag LIMIT 10""", extra=ANSWERS_SQL)
def _(star):
    return _runs(star).select("run_tag", "created_at", "n_pass", "n_questions", F.round(F.col("pass_rate") * 100, 0).alias("pass_pct")).orderBy(
        F.desc("created_at"), "run_tag").limit(10)


DELTA = "LAG(pass_rate) OVER (PARTITION BY run_tag ORDER BY created_at)"


@REG.add("win_run_delta", sql=f"""
    SELECT run_tag, created_at, pass_rate, {DELTA} AS previous_rate, ROUND(pass_rate - {DELTA}, 4) AS rate_change FROM runs""", extra=ANSWERS_SQL)
def _(star):
    return X.win_run_delta(_runs(star)).select("run_tag", "created_at", "pass_rate", "previous_rate", "rate_change")


@REG.add("eval_gate", sql=f"""
    SELECT run_tag, created_at, pass_rate, CASE WHEN ROUND(pass_rate - {DELTA}, 4) < -0.05 THEN 'blocked' ELSE 'open' END AS gate FROM runs""", extra=ANSWERS_SQL)
def _(star):
    return X.eval_gate(_runs(star), 0.05).select("run_tag", "created_at", "pass_rate", "gate")


@REG.add("dq_invariants", "margin_actuals cost_drivers otif", """
    SELECT 'margin is revenue minus cogs' AS rule, COUNT(*) AS checked, COUNT(*) FILTER (NOT gross_margin_eur = revenue_eur - cogs_eur) AS violations FROM margin_actuals
    UNION ALL SELECT 'pct is margin over revenue', COUNT(*), COUNT(*) FILTER (NOT ABS(gross_margin_pct - CAST(gross_margin_eur AS DOUBLE) / CAST(revenue_eur AS DOUBLE)) < 1e-9) FROM margin_actuals
    UNION ALL SELECT 'cost buckets sum to cogs', COUNT(*), COUNT(*) FILTER (NOT c.raw_material_cost + c.freight_cost + c.energy_cost + c.overhead = m.cogs_eur)
        FROM margin_actuals m JOIN cost_drivers c ON c.sku = m.sku AND c.region = m.region AND c.month = m.month
    UNION ALL SELECT 'otif within on time and in full', COUNT(*), COUNT(*) FILTER (NOT (otif_pct <= on_time / CAST(orders AS DOUBLE) AND otif_pct <= in_full / CAST(orders AS DOUBLE))) FROM otif""")
def _(star):
    star = star.with_finance_facts().with_plant_facts()
    m, o = star.margin_actuals(), star.otif()
    both = m.join(star.cost_drivers(), ["sku", "region", "month"])
    buckets = F.col("raw_material_cost") + F.col("freight_cost") + F.col("energy_cost") + F.col("overhead")
    margin = F.col("gross_margin_eur").cast("double") / F.col("revenue_eur").cast("double")
    share = lambda c: F.col(c) / F.col("orders").cast("double")
    return X.dq_rules((
        ("margin is revenue minus cogs", m, F.col("gross_margin_eur") == F.col("revenue_eur") - F.col("cogs_eur")),
        ("pct is margin over revenue", m, F.abs(F.col("gross_margin_pct") - margin) < 1e-9),
        ("cost buckets sum to cogs", both, buckets == F.col("cogs_eur")),
        ("otif within on time and in full", o, (F.col("otif_pct") <= share("on_time")) & (F.col("otif_pct") <= share("in_full"))),
    ))


@REG.add("dq_narrative", "margin_actuals products", """
    SELECT focus_delta_pp, max_other_abs_pp, others, COALESCE(ABS(focus_delta_pp) >= 0.5, FALSE) AS focus_moved,
           COALESCE(max_other_abs_pp <= 1.0, TRUE) AS others_flat,
           COALESCE(ABS(focus_delta_pp) >= 0.5, FALSE) AND COALESCE(max_other_abs_pp <= 1.0, TRUE) AS signal_holds
    FROM (SELECT ROUND(MAX(CASE WHEN product_line = 'ECONOMY' AND region = 'EUROPE' THEN delta END), 2) AS focus_delta_pp,
                 ROUND(MAX(CASE WHEN NOT (product_line = 'ECONOMY' AND region = 'EUROPE') THEN ABS(delta) END), 2) AS max_other_abs_pp,
                 COUNT(*) FILTER (NOT (product_line = 'ECONOMY' AND region = 'EUROPE') AND delta IS NOT NULL) AS others FROM swing) x""", extra=SWING)
def _(star):
    swing = M.margin_swing(star.margin_actuals(H1), star.products(), ("product_line", "region"), PERIODS)
    focus = (F.col("product_line") == FOCUS_LINE) & (F.col("region") == FOCUS_REGION)
    return X.dq_narrative(M.segment_isolation(swing, focus), 0.5, 1.0)


@REG.add("eval_schema_lint", sql=" UNION ALL ".join(
    f"SELECT '{f}' AS field, COUNT(*) AS checked, COUNT(*) FILTER ({f} IS NULL OR trim(CAST({f} AS VARCHAR)) = '') AS missing FROM answers"
    for f in ("question_id", "answer", "evidence")), extra=ANSWERS_SQL)
def _(star):
    o = star.table("orders")
    k = F.col("o_orderkey") % 4
    rows = o.select(F.col("o_orderkey").alias("question_id"), F.when(k != 2, F.col("o_orderstatus")).alias("answer"),
                    F.col("o_orderpriority").alias("evidence"))
    return X.schema_lint(rows, ("question_id", "answer", "evidence"))
