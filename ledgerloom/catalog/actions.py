"""Action log and quotes."""

from pyspark.sql import functions as F

from ..operators import actions as A
from ..operators import joins as J
from ..operators import quotes as Q
from ..operators import reports as T
from ..operators.ordered import with_row_number
from ..session import cut_lineage
from .core import clock
from .registry import Registry

REG = Registry()
SCOPE = ("EUROPE", "AFRICA")

POLICY_SQL = """policies(action_type, max_discount, max_spend, scoped, approval) AS (VALUES
    ('quote_send', 15.0, 250000.0, TRUE, TRUE), ('price_change', 10.0, NULL, TRUE, TRUE), ('forecast_override', NULL, NULL, TRUE, TRUE),
    ('scm_reorder', NULL, 100000.0, TRUE, TRUE), ('scm_reroute', NULL, 50000.0, TRUE, TRUE), ('crm_task', NULL, NULL, TRUE, FALSE),
    ('escalation', NULL, NULL, FALSE, FALSE)),
  valued AS (
    SELECT a.*, p.action_type IS NOT NULL AS known, p.max_discount, p.max_spend, p.scoped, p.approval,
           json_extract_string(payload, '$.discount_pct') AS dt,
           COALESCE(json_extract_string(payload, '$.spend_eur'), json_extract_string(payload, '$.amount_eur')) AS st
    FROM actions a LEFT JOIN policies p ON p.action_type = a.action_type),
  judged AS (
    SELECT *, NOT known AS b0,
           known AND max_discount IS NOT NULL AND dt IS NOT NULL AND NOT COALESCE(TRY_CAST(dt AS DOUBLE) <= max_discount, FALSE) AS b1,
           known AND max_spend IS NOT NULL AND st IS NOT NULL AND NOT COALESCE(TRY_CAST(st AS DOUBLE) <= max_spend, FALSE) AS b2,
           known AND scoped AND NOT COALESCE(region IN ('EUROPE', 'AFRICA'), FALSE) AS b3
    FROM valued),
  verdicts AS (
    SELECT *, NOT (b0 OR b1 OR b2 OR b3) AS passed,
           concat_ws(',', CASE WHEN b0 THEN 'action_type_allowed' END, CASE WHEN b1 THEN 'max_discount_pct' END,
                     CASE WHEN b2 THEN 'max_spend_eur' END, CASE WHEN b3 THEN 'allowed_regions' END) AS breaches
    FROM judged)"""


def _verdicts(star):
    return A.guardrail_eval(star.actions(), A.policy_table(star.spark, SCOPE))


@REG.add("policy_table", "actions", """
    SELECT p.action_type, CAST(p.max_discount AS DOUBLE) AS max_discount_pct, CAST(p.max_spend AS DOUBLE) AS max_spend_eur,
           p.approval AS requires_approval, COUNT(a.action_id) AS actions
    FROM policies p LEFT JOIN actions a ON a.action_type = p.action_type GROUP BY 1, 2, 3, 4""", extra=POLICY_SQL)
def _(star):
    counts = star.actions().groupBy("action_type").agg(F.count(F.lit(1)).alias("actions"))
    return A.policy_table(star.spark, SCOPE).join(counts, "action_type", "left").select(
        "action_type", F.col("max_discount_pct").cast("double").alias("max_discount_pct"),
        F.col("max_spend_eur").cast("double").alias("max_spend_eur"), "requires_approval",
        F.coalesce("actions", F.lit(0)).alias("actions"))


@REG.add("guardrail_eval", "actions", """
    SELECT action_id, action_type, passed, breaches, TRY_CAST(st AS DOUBLE) AS spend_value, TRY_CAST(dt AS DOUBLE) AS discount_value,
           COALESCE(approval, TRUE) AS requires_approval FROM verdicts""", extra=POLICY_SQL)
def _(star):
    return _verdicts(star).select("action_id", "action_type", "passed", F.concat_ws(",", "breaches").alias("breaches"),
                                  "spend_value", "discount_value", "requires_approval")


LEGAL = """CASE WHEN prev_status IS NULL THEN status = 'proposed' ELSE prev_status || '>' || status IN (
    'proposed>approved', 'proposed>rejected', 'proposed>escalated', 'approved>executing', 'approved>rejected', 'approved>escalated',
    'executing>executed', 'executing>failed', 'executing>escalated', 'escalated>approved', 'escalated>rejected') END"""


@REG.add("state_replay", "action_events", f"""
    SELECT action_id, event_id, status, prev_status, {LEGAL} AS legal
    FROM (SELECT *, LAG(status) OVER (PARTITION BY action_id ORDER BY ts, event_id) AS prev_status FROM action_events) e""")
def _(star):
    ev = star.action_events().select("action_id", "event_id", "ts", "status")
    return A.state_replay(ev).drop("ts")


@REG.add("state_current", "action_events", """
    SELECT action_id, arg_max(status, (ts, event_id)) AS status,
           arg_max(actor, (ts, event_id)) FILTER (status IN ('approved', 'rejected')) AS approved_by,
           strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS created_ts, strftime(MAX(ts) FILTER (status IN ('approved', 'rejected')), '%Y-%m-%d %H:%M:%S.%f') AS decided_ts,
           strftime(MAX(ts) FILTER (status IN ('executed', 'failed')), '%Y-%m-%d %H:%M:%S.%f') AS executed_ts, COUNT(*) AS events
    FROM action_events GROUP BY 1""")
def _(star):
    now = A.state_current(star.action_events())
    times = {"created_ts": "created_at", "decided_ts": "decided_at", "executed_ts": "executed_at"}
    return now.select("action_id", "status", "approved_by", "events", *[clock(c).alias(n) for n, c in times.items()])


FROM_STATUS = """CASE status WHEN 'approved' THEN 'proposed' WHEN 'executing' THEN 'approved' WHEN 'executed' THEN 'executing'
    WHEN 'failed' THEN 'executing' ELSE 'none' END"""


@REG.add("cas_conflicts", "action_events", f"""
    SELECT action_id, event_id, from_status, attempt, attempt > 1 AS conflict FROM (
        SELECT action_id, event_id, from_status, ROW_NUMBER() OVER (PARTITION BY action_id, from_status ORDER BY ts, event_id) AS attempt
        FROM (SELECT *, {FROM_STATUS} AS from_status FROM action_events) f) n""")
def _(star):
    s = F.col("status")
    read = (F.when(s == "approved", "proposed").when(s == "executing", "approved")
            .when(s.isin("executed", "failed"), "executing").otherwise("none"))
    ev = star.action_events().select("action_id", "event_id", "ts", read.alias("from_status"))
    return A.cas_conflicts(ev).drop("ts")


@REG.add("sod_violations", "actions", "SELECT action_id, requested_by, approved_by FROM actions WHERE requested_by = approved_by")
def _(star):
    return A.sod_violations(star.actions()).select("action_id", "requested_by", "approved_by")


@REG.add("audit_lineage", "action_events", """
    SELECT action_id, event_id, status, actor, ROW_NUMBER() OVER (PARTITION BY action_id ORDER BY ts, event_id) AS step FROM action_events""")
def _(star):
    return A.audit_lineage(star.action_events()).drop("ts")


ROUTE_SQL = """routes(action_type, step, system) AS (VALUES ('quote_send', 0, 'email'), ('quote_send', 1, 'crm'), ('price_change', 0, 'crm'),
    ('forecast_override', 0, 'teams'), ('scm_reorder', 0, 'erp_po'), ('scm_reroute', 0, 'teams'), ('scm_reroute', 1, 'ticket'),
    ('crm_task', 0, 'crm'), ('escalation', 0, 'ticket')),
  outbox AS (SELECT a.*, CAST(r.step AS BIGINT) AS step, r.system FROM actions a JOIN routes r ON r.action_type = a.action_type)"""


@REG.add("route_fanout", "actions", """
    SELECT action_id, step, system,
           CASE system WHEN 'erp_po' THEN COALESCE(json_extract_string(payload, '$.supplier'), 'Unknown supplier')
                       WHEN 'crm' THEN COALESCE(json_extract_string(payload, '$.account'), 'Unknown account')
                       WHEN 'email' THEN 'customer@example.com' WHEN 'teams' THEN 'Operations'
                       ELSE COALESCE(json_extract_string(payload, '$.priority'), 'P3') END AS target,
           CASE system WHEN 'erp_po' THEN json_extract_string(payload, '$.sku') ELSE json_extract_string(payload, '$.subject') END AS what,
           CASE WHEN system = 'erp_po' THEN COALESCE(NULLIF(CAST(json_extract_string(payload, '$.qty') AS BIGINT), 0),
                                                     CAST(json_extract_string(payload, '$.quantity') AS BIGINT), 0) END AS qty,
           CASE WHEN system = 'erp_po' THEN CAST(json_extract_string(payload, '$.amount_eur') AS DOUBLE) END AS amount
    FROM outbox""", extra=ROUTE_SQL)
def _(star):
    body = lambda *names: F.coalesce(*[F.get_json_object("body", f"$.{n}") for n in names])
    return A.route_fanout(star.actions()).select(
        "action_id", "step", "system",
        F.coalesce(body("supplier", "account", "to", "channel", "priority")).alias("target"),
        body("sku", "task", "subject", "message", "summary").alias("what"),
        F.get_json_object("body", "$.qty").cast("bigint").alias("qty"),
        F.get_json_object("body", "$.amount_eur").cast("double").alias("amount"))


@REG.add("execute_outcomes", "actions", """
    SELECT action_id, outcome, CASE WHEN outcome = 'executed' THEN ref0 END AS external_ref,
           CASE WHEN outcome IN ('executed', 'failed') THEN COALESCE(done, '') END AS completed_refs,
           CASE WHEN outcome = 'failed' THEN failed > 0 END AS needs_reconciliation
    FROM (SELECT v.action_id, r.failed, r.ref0, r.done,
                 CASE WHEN v.status <> 'approved' THEN 'not_approved' WHEN r.action_id IS NULL THEN 'unroutable'
                      WHEN NOT v.passed THEN 'escalated' WHEN r.failed IS NOT NULL THEN 'failed' ELSE 'executed' END AS outcome
          FROM verdicts v LEFT JOIN (
              SELECT o.action_id, f.failed, MAX(CASE WHEN o.step = 0 THEN system || '-' || CAST(o.action_id AS VARCHAR) END) AS ref0,
                     string_agg(CASE WHEN f.failed IS NULL OR o.step < f.failed THEN system || '-' || CAST(o.action_id AS VARCHAR) END, ',' ORDER BY o.step) AS done
              FROM outbox o JOIN (SELECT action_id, MIN(CASE WHEN (action_id + step) % 9 = 0 THEN step END) AS failed FROM outbox GROUP BY 1) f
                ON f.action_id = o.action_id GROUP BY 1, 2) r ON r.action_id = v.action_id) x""", extra=POLICY_SQL + ",\n" + ROUTE_SQL)
def _(star):
    ref = F.concat_ws("-", "system", F.col("action_id").cast("string"))
    # judged once; the systems' answers fan out from the stored verdicts
    verdicts = cut_lineage(_verdicts(star).select("action_id", "action_type", "status", "passed"))
    results = A.route_steps(verdicts).select(
        "action_id", "step", ((F.col("action_id") + F.col("step")) % 9 != 0).alias("ok"), ref.alias("ref_id"))
    return A.execute_outcomes(verdicts, results).select(
        "action_id", "outcome", "external_ref", "completed_refs", "needs_reconciliation")


@REG.add("join_anti_handled", "actions", """
    SELECT action_id, action_type FROM actions a WHERE status = 'proposed' AND NOT EXISTS (
        SELECT 1 FROM actions x WHERE x.status IN ('approved', 'executing', 'executed', 'escalated')
          AND json_extract_string(x.payload, '$.supplier') = json_extract_string(a.payload, '$.supplier'))""")
def _(star):
    acts = star.actions().withColumn("supplier", F.get_json_object("payload", "$.supplier"))
    live = star.actions().filter(F.col("status") != "proposed")  # of any level and type
    handled = A.live_keys(live, "supplier")
    return acts.filter(F.col("status") == "proposed").join(handled, "supplier", "left_anti").select("action_id", "action_type")


# -- quotes ----------------------------------------------------------------------------------

QUOTES_SQL = """quotes AS (
    SELECT p_partkey AS quote_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, CAST(p_retailprice AS DECIMAL(12,2)) AS lp,
           ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.60 AS DECIMAL(3,2)), 2)::DECIMAL(12,2) AS sc,
           CAST(p_size * 100 AS BIGINT) AS quantity_units, CAST(p_partkey % 26 AS DECIMAL(5,2)) AS d FROM part),
  priced AS (SELECT *, ROUND(lp * (CAST(100 AS DECIMAL(5,2)) - d) * CAST(0.01 AS DECIMAL(3,2)), 2)::DECIMAL(12,2) AS net FROM quotes),
  drafts AS (SELECT *, net - sc AS um, ROUND(CAST(net - sc AS DOUBLE) / CAST(net AS DOUBLE) * 100, 1) AS margin_pct FROM priced)"""


def _quotes(star):
    price = F.col("p_retailprice").cast("decimal(12,2)")
    return star.table("part").select(
        F.col("p_partkey").alias("quote_id"), F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        price.cast("double").alias("list_price_eur"),
        F.round(price * F.lit(0.60).cast("decimal(3,2)"), 2).cast("double").alias("standard_cost_eur"),
        (F.col("p_size") * 100).cast("bigint").alias("quantity_units"), (F.col("p_partkey") % 26).cast("double").alias("discount_pct"))


@REG.add("quote_draft", sql="""
    SELECT quote_id, CAST(net AS DOUBLE) AS net_unit_price_eur, CAST(net * quantity_units AS DOUBLE) AS extended_price_eur,
           CAST(sc * quantity_units AS DOUBLE) AS total_cost_eur, CAST(um AS DOUBLE) AS unit_margin_eur, margin_pct,
           CAST(um * quantity_units AS DOUBLE) AS total_margin_eur, d > 15 AS discount_flag, margin_pct < 25 AS margin_flag,
           d > 15 OR margin_pct < 25 AS requires_escalation FROM drafts""", extra=QUOTES_SQL)
def _(star):
    return Q.quote_draft(_quotes(star)).drop("sku", "list_price_eur", "standard_cost_eur", "quantity_units", "discount_pct")


@REG.add("quote_rationale", sql="""
    SELECT quote_id, concat_ws(' ', format('{} units of {}, {:.2f}% off: {:.2f} EUR per unit at {:.1f}% margin.', quantity_units, sku,
               CAST(d AS DOUBLE), CAST(net AS DOUBLE), margin_pct), CASE WHEN d > 15 OR margin_pct < 25 THEN 'FLAGGED:' END,
           CASE WHEN d > 15 THEN 'discount above limit.' END, CASE WHEN margin_pct < 25 THEN 'margin below floor.' END) AS rationale
    FROM drafts""", extra=QUOTES_SQL)
def _(star):
    return Q.quote_rationale(Q.quote_draft(_quotes(star))).select("quote_id", "rationale")


@REG.add("quote_price", "products margin_actuals", """
    SELECT p.sku, p.product_name, p.region, p.currency, p.list_price_eur, p.standard_cost_eur,
           CAST(CAST(p.list_price_eur AS DECIMAL(12,2)) - CAST(p.standard_cost_eur AS DECIMAL(12,2)) AS DOUBLE) AS unit_margin_eur,
           ROUND(CAST(CAST(p.list_price_eur AS DECIMAL(12,2)) - CAST(p.standard_cost_eur AS DECIMAL(12,2)) AS DOUBLE) / p.list_price_eur * 100, 1) AS unit_margin_pct,
           m.month AS recent_month, ROUND(CAST(m.revenue_eur AS DOUBLE) / CAST(m.units AS DOUBLE), 2) AS realized_price_eur,
           ROUND(m.gross_margin_pct * 100, 1) AS realized_margin_pct
    FROM products p LEFT JOIN (SELECT * FROM margin_actuals QUALIFY ROW_NUMBER() OVER (PARTITION BY sku ORDER BY month DESC) = 1) m ON m.sku = p.sku""")
def _(star):
    return Q.quote_price(star.products(), star.margin_actuals())


@REG.add("product_match", "products", """
    SELECT request_id, request_text, region, COALESCE(l.sku, a.sku) AS sku, COALESCE(l.score, a.score) AS name_score, l.sku IS NOT NULL AS in_region
    FROM requests r
    LEFT JOIN (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY rid, pregion ORDER BY score DESC, sku) = 1) l
      ON l.rid = r.request_id AND l.pregion = r.region
    LEFT JOIN (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY rid ORDER BY score DESC, sku) = 1) a ON a.rid = r.request_id""",
         extra="""requests AS (
    SELECT p_partkey AS request_id, 'Please quote ' || p_name || ' in ' || p_brand AS request_text,
           CASE p_partkey % 6 WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA' WHEN 3 THEN 'EUROPE' WHEN 4 THEN 'MIDDLE EAST' ELSE 'ELSEWHERE' END AS region
    FROM part),
  toks AS (SELECT request_id AS rid, unnest(regexp_extract_all(lower(request_text), '[a-z]+')) AS tok FROM requests),
  scored AS (SELECT t.rid, p.region AS pregion, p.sku, CAST(COUNT(*) AS BIGINT) AS score
             FROM toks t JOIN products p ON length(t.tok) > 2 AND contains(lower(p.product_name), t.tok) GROUP BY 1, 2, 3)""")
def _(star):
    k = F.col("p_partkey") % 6
    region = (F.when(k == 0, "AFRICA").when(k == 1, "AMERICA").when(k == 2, "ASIA").when(k == 3, "EUROPE")
              .when(k == 4, "MIDDLE EAST").otherwise("ELSEWHERE"))
    requests = star.table("part").select(
        F.col("p_partkey").alias("request_id"),
        F.concat(F.lit("Please quote "), F.col("p_name"), F.lit(" in "), F.col("p_brand")).alias("request_text"), region.alias("region"))
    return Q.product_match(requests, star.products())


@REG.add("quote_decide", "action_events", """
    SELECT action_id AS quote_id, arg_min(status, (ts, event_id)) AS decision, arg_min(actor, (ts, event_id)) AS approver
    FROM action_events WHERE status IN ('approved', 'failed') GROUP BY 1""")
def _(star):
    decisions = star.action_events().filter(F.col("status").isin("approved", "failed")).withColumnRenamed("action_id", "quote_id")
    return A.decide_once(decisions, "quote_id", ("ts", "event_id"), ("status", "actor")).select(
        "quote_id", F.col("status").alias("decision"), F.col("actor").alias("approver"))


@REG.add("join_ledger_left", "action_events", """
    SELECT q.quote_id, q.list_price, d.decision FROM (SELECT p_partkey AS quote_id, p_retailprice AS list_price FROM part) q
    LEFT JOIN (SELECT action_id, arg_min(status, (ts, event_id)) AS decision FROM action_events WHERE status IN ('approved', 'failed') GROUP BY 1) d
      ON d.action_id = q.quote_id ORDER BY q.quote_id DESC LIMIT 100""")
def _(star):
    quotes = star.table("part").select(F.col("p_partkey").alias("quote_id"), F.col("p_retailprice").alias("list_price"))
    decisions = star.action_events().filter(F.col("status").isin("approved", "failed")).withColumnRenamed("action_id", "quote_id")
    ledger = A.decide_once(decisions, "quote_id", ("ts", "event_id"), ("status",)).withColumnRenamed("status", "decision")
    return J.ledger_newest(quotes, ledger, "quote_id", "quote_id")


@REG.add("join_receipts", sql="""
    SELECT a.action_id, e.event_id, e.event_type FROM (SELECT o_orderkey AS action_id, unnest([o_orderkey, o_orderkey + 7]) AS ref FROM orders) a
    JOIN events e ON e.event_id = a.ref""")
def _(star):
    acts = star.table("orders").select(F.col("o_orderkey").alias("action_id"),
                                       F.array(F.col("o_orderkey"), F.col("o_orderkey") + 7).alias("refs"))
    receipts = star.table("events").select("event_id", "event_type")
    return J.receipts_of(acts, "refs", receipts, "event_id")


@REG.add("session_log", sql="""
    SELECT 'user' || user_id AS session_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS turn,
           event_type AS question, CASE WHEN value > 50 THEN 'FINANCE,SCM' ELSE 'FINANCE' END AS routed,
           json_extract_string(props, '$.k') AS answer, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events""")
def _(star):
    """Turns appended by two writers, numbered within their session."""
    turns = star.table("events").select(
        "event_id", F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("session_id"), F.col("event_type").alias("question"),
        F.when(F.col("value") > 50, "FINANCE,SCM").otherwise("FINANCE").alias("routed"), F.get_json_object("props", "$.k").alias("answer"),
        F.col("ts").cast("timestamp").alias("ts"))
    log = turns.filter(F.col("event_id") % 2 == 0).unionByName(turns.filter(F.col("event_id") % 2 != 0))
    return with_row_number(log, ["session_id"], ["ts", "event_id"], "turn").select(
        "session_id", F.col("turn").cast("bigint").alias("turn"), "question", "routed", "answer", clock(F.col("ts")).alias("at"))


@REG.add("feedback", sql="""
    SELECT user_id, CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END) AS BIGINT) AS score,
           COUNT(*) FILTER (event_type IN ('purchase', 'error')) AS ratings FROM events GROUP BY 1""")
def _(star):
    rating = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", -1)
    return star.table("events").groupBy("user_id").agg(F.sum(F.coalesce(rating, F.lit(0))).alias("score"), F.count(rating).alias("ratings"))


@REG.add("saved_list", sql="SELECT event_id, user_id, event_type FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 50")
def _(star):
    saved = star.table("events").filter(F.col("event_type") == "purchase")
    return T.cap_rows(saved, (F.desc("ts"), F.desc("event_id")), 50).select("event_id", "user_id", "event_type")
