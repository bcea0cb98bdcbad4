"""Sources, sinks, filters, joins, aggregates, windows, top-k and scalar functions."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import joins as J
from ..operators import keyed as K
from ..operators import ordered as O
from ..operators import reports as T
from ..sources import io as IO
from ..sources.keyed_table import KeyedTable
from ..sources.star import FOCUS_REGION, H1, Q1, Q2, VIEWS
from ..sources.tables import TABLES, month_of
from .registry import Registry
from .star_sql import month_of as sql_month
from .star_sql import period_of

REG = Registry()
PERIODS = (("Q1", *Q1), ("Q2", *Q2))
D = "CAST({} AS DOUBLE)".format


def clock(col):
    """Wall-clock text of a time, the same in every session time zone."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


BUCKET = period_of("month", PERIODS)


def R(num, den):
    return f"{D(f'SUM({num})')} / NULLIF({D(f'SUM({den})')}, 0)"


# -- sources and sinks -----------------------------------------------------------------------

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def _orders(star):
    return star.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@REG.add("src_parquet", sql="SELECT * FROM part")
def _(star):
    return IO.read_files(star.spark, f"{star.root}/part.parquet")


@REG.add("src_binary")
def _(star):
    # path and length only: the content column is not read
    files = IO.read_files(star.spark, star.root, "binaryFile", "*.parquet")
    return files.select(F.regexp_extract("path", r"([^/]+)\.parquet$", 1).alias("table_name"), "length")


# Price per thousand tokens of each served route.
PRICES = (("click", 0.012), ("view", 0.0008), ("purchase", 0.0003), ("signup", 0.0008), ("error", 0.0003))


@REG.add("src_rows", sql="""
    SELECT event_type AS served_model, price AS price_per_1k, COUNT(*) AS calls
    FROM events JOIN (VALUES ('click', 0.012::DOUBLE), ('view', 0.0008::DOUBLE), ('purchase', 0.0003::DOUBLE),
                             ('signup', 0.0008::DOUBLE), ('error', 0.0003::DOUBLE)) p(m, price) ON event_type = m
    GROUP BY 1, 2""")
def _(star):
    prices = IO.read_rows(star.spark, PRICES, "served_model string, price_per_1k double")
    return star.table("events").withColumnRenamed("event_type", "served_model").join(prices, "served_model").groupBy(
        "served_model", "price_per_1k").agg(F.count(F.lit(1)).alias("calls"))


@REG.add("row_counts", sql=" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES))
def _(star):
    return IO.row_counts({t: star.table(t) for t in TABLES})


STAR_VIEWS = VIEWS


@REG.add("load_star", " ".join(STAR_VIEWS),
         " UNION ALL ".join(f"SELECT '{v}' AS table_name, COUNT(*) AS row_count FROM {v}" for v in STAR_VIEWS))
def _(star):
    report = IO.load_star(star.spark, {f"star_{v}": getattr(star, v) for v in STAR_VIEWS})
    loaded = [n.removeprefix("star_") for n, status, _ in report if status == "loaded"]
    # counted from one pass over the line items, not by running every view
    return star.view_rows().filter(F.col("view").isin(*loaded)).withColumnRenamed("view", "table_name")


@REG.add("list_tables", sql=" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES))
def _(star):
    IO.load_star(star.spark, {f"listed_{t}": (lambda t=t: star.table(t)) for t in TABLES})
    found = [n for n in IO.list_tables(star.spark) if n.startswith("listed_")]
    return IO.row_counts({n.removeprefix("listed_"): star.spark.table(n) for n in found})


@REG.add("sink_ctas", sql=ORDERS)
def _(star):
    return IO.write_path(_orders(star), IO.scratch_path(star.spark, "ctas"))


@REG.add("sink_append", sql=ORDERS)
def _(star):
    path, rows = IO.scratch_path(star.spark, "append"), _orders(star)
    IO.write_path(rows.filter(F.col("o_orderstatus") == "F"), path)
    return IO.write_path(rows.filter(F.col("o_orderstatus") != "F"), path, "append")


@REG.add("sink_overwrite", sql=ORDERS + " WHERE o_orderstatus = 'O'")
def _(star):
    path, rows = IO.scratch_path(star.spark, "overwrite"), _orders(star)
    IO.write_path(rows, path)
    return IO.write_path(rows.filter(F.col("o_orderstatus") == "O"), path)


@REG.add("sink_delete_all", sql="SELECT (SELECT COUNT(*) FROM orders) AS rows_before, CAST(0 AS BIGINT) AS rows_after")
def _(star):
    path = IO.scratch_path(star.spark, "emptied")
    before = _orders(star).agg(F.count(F.lit(1)).alias("rows_before"))
    IO.write_path(_orders(star), path)
    after = IO.empty_path(star.spark, path).agg(F.count(F.lit(1)).alias("rows_after"))
    return J.with_scalar(before, after)


@REG.add("ident_check", sql="SELECT event_type AS name, COUNT(*) AS n FROM events GROUP BY 1")
def _(star):
    column = IO.ident_check("event_type")
    return star.spark.sql("SELECT IDENTIFIER(:c) AS name, COUNT(*) AS n FROM {t} GROUP BY 1", args={"c": column},
                          t=star.table("events"))


MEMORY_CUT = datetime(2024, 1, 16)


def _memory_rows(star):
    return star.table("events").select(
        "user_id", F.col("event_type").alias("memory_key"), F.get_json_object("props", "$.k").alias("content"),
        "event_id", F.col("ts").cast("timestamp").alias("ts"))


@REG.add("upsert_latest", sql="""
    SELECT user_id, event_type AS memory_key, arg_max(json_extract_string(props, '$.k'), (ts, event_id)) AS content,
           strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS created_ts, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S.%f') AS updated_ts
    FROM events GROUP BY 1, 2""")
def _(star):
    rows = _memory_rows(star).withColumn("created_at", F.col("ts")).withColumn("updated_at", F.col("ts"))
    old, new = rows.filter(F.col("ts") < F.lit(MEMORY_CUT)), rows.filter(F.col("ts") >= F.lit(MEMORY_CUT))
    merged = K.upsert_latest(old, new, ("user_id", "memory_key"), ("content",), ("ts", "event_id"))
    return merged.select("user_id", "memory_key", "content", clock("created_at").alias("created_ts"),
                         clock("updated_at").alias("updated_ts"))


@REG.add("keyed_upsert", sql="""
    SELECT user_id, event_type AS memory_key, arg_max(json_extract_string(props, '$.k'), (ts, event_id)) AS content,
           strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS created_ts, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S.%f') AS updated_ts
    FROM events GROUP BY 1, 2""")
def _(star):
    rows = _memory_rows(star).withColumn("created_at", F.col("ts")).withColumn("updated_at", F.col("ts"))
    old, new = rows.filter(F.col("ts") < F.lit(MEMORY_CUT)), rows.filter(F.col("ts") >= F.lit(MEMORY_CUT))
    table = KeyedTable(star.spark, IO.scratch_path(star.spark, "memory"), ("user_id", "memory_key"), 8).create(rows.limit(0))
    for changes in (old, new):
        table.upsert_latest(changes, ("content",), ("ts", "event_id"))
    return table.read().select("user_id", "memory_key", "content", clock("created_at").alias("created_ts"), clock("updated_at").alias("updated_ts"))


@REG.add("keyed_update", sql="""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment,
           CASE WHEN c_acctbal < 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS c_acctbal FROM customer""")
def _(star):
    rows = star.table("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    table = KeyedTable(star.spark, IO.scratch_path(star.spark, "customers"), ("c_custkey",), 8).create(rows)
    table.update(F.col("c_acctbal") < 0, {"c_mktsegment": F.lit("REVIEW"), "c_acctbal": F.lit(0.0)})
    return table.read()


@REG.add("keyed_delete", sql="""
    SELECT event_id, user_id, event_type FROM events e
    WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = e.event_type AND x.value > 40)""")
def _(star):
    rows = star.table("events").select("event_id", "user_id", "event_type", "value")
    table = KeyedTable(star.spark, IO.scratch_path(star.spark, "trimmed"), ("user_id", "event_type"), 8).create(rows)
    table.delete(rows.filter(F.col("value") > 40))
    return table.read().drop("value")


@REG.add("update_where", sql="""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment,
           CASE WHEN c_acctbal < 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS c_acctbal FROM customer""")
def _(star):
    rows = star.table("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return K.update_where(rows, F.col("c_acctbal") < 0, {"c_mktsegment": F.lit("REVIEW"), "c_acctbal": F.lit(0.0)})


@REG.add("delete_by_key", sql="""
    SELECT event_id, user_id, event_type FROM events e
    WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = e.event_type AND x.value > 40)""")
def _(star):
    rows = star.table("events").select("event_id", "user_id", "event_type", "value")
    return K.delete_by_key(rows, rows.filter(F.col("value") > 40), ("user_id", "event_type")).drop("value")


# Systems and the prefixes of their reference ids.
REF_PREFIXES = {"click": "CRM", "purchase": "PO", "signup": "EML", "error": "INC", "view": "MSG"}


@REG.add("receipt_log", sql="""
    SELECT event_id, log_id, prefix || '-' || CASE WHEN log_id < 10000 THEN lpad(CAST(log_id AS VARCHAR), 4, '0')
                                                   ELSE CAST(log_id AS VARCHAR) END AS ref_id
    FROM (SELECT event_id, ROW_NUMBER() OVER (ORDER BY ts, event_id) AS log_id,
                 CASE event_type WHEN 'click' THEN 'CRM' WHEN 'purchase' THEN 'PO' WHEN 'signup' THEN 'EML'
                      WHEN 'error' THEN 'INC' ELSE 'MSG' END AS prefix FROM events) numbered""")
def _(star):
    outbox = star.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                                         F.col("event_type").alias("system"))
    return K.receipt_log(outbox, REF_PREFIXES, ("ts", "event_id")).select("event_id", "log_id", "ref_id")


# -- projections and filters -----------------------------------------------------------------


@REG.add("proj_alias", "margin_actuals", """
    SELECT sku, region, month, CAST(revenue_eur AS DOUBLE) AS revenue_eur,
           CAST(revenue_eur - cogs_eur AS DOUBLE) AS margin_check, CAST(units * 2 AS BIGINT) AS twice_units FROM margin_actuals""")
def _(star):
    return star.margin_actuals().select(
        "sku", "region", "month", F.col("revenue_eur").cast("double").alias("revenue_eur"),
        (F.col("revenue_eur") - F.col("cogs_eur")).cast("double").alias("margin_check"),
        (F.col("units") * 2).alias("twice_units"))


@REG.add("flt_date_between", sql="""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'""")
def _(star):
    return star.table("orders").filter(F.col("o_orderdate").between(F.lit(date(2000, 1, 1)), F.lit(date(2000, 3, 31)))).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))


@REG.add("flt_ytd", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '2000-01-01'")
def _(star):
    return star.table("orders").filter(F.col("o_orderdate") >= F.lit(date(2000, 1, 1))).select("o_orderkey", "o_totalprice")


@REG.add("flt_in", sql="SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def _(star):
    return star.table("customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@REG.add("flt_not_in", "pipeline", "SELECT opp_id, stage FROM pipeline WHERE stage NOT IN ('ClosedWon', 'ClosedLost')")
def _(star):
    return star.pipeline().filter(~F.col("stage").isin("ClosedWon", "ClosedLost")).select("opp_id", "stage")


@REG.add("flt_like", sql="SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%'")
def _(star):
    return star.table("part").filter(F.col("p_name").startswith("small")).select("p_partkey", "p_name")


@REG.add("flt_not_null", "margin_actuals", f"SELECT sku, month, {BUCKET} AS quarter FROM margin_actuals WHERE {BUCKET} IS NOT NULL")
def _(star):
    rows = star.margin_actuals().select("sku", "month", C.case_bucket("month", PERIODS).alias("quarter"))
    return rows.filter(F.col("quarter").isNotNull())


@REG.add("flt_threshold", "churn_signals", "SELECT account_id, month, churn_score FROM churn_signals WHERE churn_score > 0.7")
def _(star):
    return star.churn_signals().filter(F.col("churn_score") > 0.7).select("account_id", "month", "churn_score")


@REG.add("case_bucket", sql=f"""
    SELECT bucket, COUNT(*) AS n FROM (SELECT {BUCKET} AS bucket FROM (SELECT {sql_month('l_shipdate')} AS month FROM lineitem)) b
    GROUP BY 1""")
def _(star):
    months = star.table("lineitem").select(month_of("l_shipdate").alias("month"))
    return months.groupBy(C.case_bucket("month", PERIODS).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@REG.add("case_cohort", "accounts", """
    SELECT account_id, CASE WHEN region = 'EUROPE' AND segment = 'BUILDING' THEN 'Focus cohort' ELSE 'Other' END AS cohort
    FROM accounts""")
def _(star):
    hit = (F.col("region") == FOCUS_REGION) & (F.col("segment") == "BUILDING")
    return star.accounts().select("account_id", F.when(hit, "Focus cohort").otherwise("Other").alias("cohort"))


@REG.add("flt_scalar_subquery", sql="""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)""")
def _(star):
    return star.spark.sql("""
        SELECT o_orderkey, o_totalprice FROM {orders}
        WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM {orders})""", orders=star.table("orders"))


PERSONA_SQL = """(VALUES ('controller', 'controller', 'ALL'), ('planner', 'planner', 'EUROPE'), ('rep', 'rep', 'ASIA'))
    personas(user_email, role, region_scope)"""
PERSONAS = (("controller", "controller", "ALL", "ALL"), ("planner", "planner", "EUROPE", "ALL"),
            ("rep", "rep", "ASIA", "BUILDING"))
PERSONA_SCHEMA = "user_email string, role string, region_scope string, segment_scope string"


@REG.add("flt_exists", "accounts", f"""
    SELECT account_id, region FROM accounts a WHERE EXISTS (
        SELECT 1 FROM {PERSONA_SQL} WHERE user_email = 'planner' AND (region_scope = 'ALL' OR region_scope = a.region))""")
def _(star):
    personas = IO.read_rows(star.spark, PERSONAS, PERSONA_SCHEMA)
    return star.spark.sql("""
        SELECT account_id, region FROM {accounts} a WHERE EXISTS (
            SELECT 1 FROM {personas} p
            WHERE p.user_email = :me AND (p.region_scope = 'ALL' OR p.region_scope = a.region))""",
        args={"me": "planner"}, accounts=star.accounts(), personas=personas)


@REG.add("safe_div", sql="SELECT o_orderkey, o_totalprice / NULLIF(CAST(o_orderkey % 3 AS DOUBLE), 0) AS per_unit FROM orders")
def _(star):
    return star.table("orders").select("o_orderkey", C.ratio(F.col("o_totalprice"), F.col("o_orderkey") % 3).alias("per_unit"))


@REG.add("bind_args", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 250000")
def _(star):
    return star.spark.sql("SELECT o_orderkey, o_totalprice FROM {o} WHERE o_orderstatus = :st AND o_totalprice >= :lo",
                          args={"st": "F", "lo": 250000.0}, o=star.table("orders"))


# -- joins -----------------------------------------------------------------------------------


@REG.add("join_dim", "margin_actuals products", """
    SELECT m.sku, p.product_line, p.currency, m.month, m.units FROM margin_actuals m JOIN products p ON m.sku = p.sku""")
def _(star):
    return star.margin_actuals().join(star.products(), "sku").select("sku", "product_line", "currency", "month", "units")


@REG.add("join_left_composite", "margin_actuals cost_drivers", """
    SELECT m.sku, m.region, m.month, m.units, CAST(c.overhead AS DOUBLE) AS overhead FROM margin_actuals m
    LEFT JOIN (SELECT * FROM cost_drivers WHERE month < DATE '2000-01-01') c
      ON c.sku = m.sku AND c.region = m.region AND c.month = m.month""")
def _(star):
    star = star.with_finance_facts()
    costs = star.cost_drivers((None, date(1999, 12, 1))).select(
        "sku", "region", "month", F.col("overhead").cast("double").alias("overhead"))
    return star.margin_actuals().select("sku", "region", "month", "units").join(costs, ["sku", "region", "month"], "left")


@REG.add("join_inner_composite", "margin_actuals margin_budget", """
    SELECT m.sku, m.region, m.month, CAST(m.revenue_eur AS DOUBLE) AS revenue_eur, CAST(b.budget_revenue_eur AS DOUBLE) AS budget_revenue_eur
    FROM margin_actuals m JOIN margin_budget b ON b.sku = m.sku AND b.region = m.region AND b.month = m.month""")
def _(star):
    star = star.with_finance_facts()
    return star.margin_actuals().join(star.margin_budget(), ["sku", "region", "month"]).select(
        "sku", "region", "month", F.col("revenue_eur").cast("double").alias("revenue_eur"),
        F.col("budget_revenue_eur").cast("double").alias("budget_revenue_eur"))


@REG.add("join_const_key", "otif service_levels", """
    SELECT o.lane, o.sku, o.month, o.orders, s.service_pct FROM otif o
    JOIN service_levels s ON s.region = 'EUROPE' AND s.month = o.month WHERE o.region = 'EUROPE'""")
def _(star):
    side = star.service_levels(region=FOCUS_REGION).select("month", "service_pct")
    return star.otif(region=FOCUS_REGION).select("lane", "sku", "month", "orders").join(side, "month")


@REG.add("join_back_agg", sql="""
    SELECT p_partkey, p_type, p_size, ROUND(g.a, 1) AS group_mean, ROUND(p_size - g.a, 1) AS above_mean
    FROM part JOIN (SELECT p_type AS t, AVG(p_size) AS a FROM part GROUP BY 1) g ON p_type = g.t""")
def _(star):
    return J.above_group_mean(star.table("part").select("p_partkey", "p_type", "p_size"), "p_type", "p_size")


@REG.add("join_cross_scalar", "service_levels", """
    SELECT region, month, service_pct FROM service_levels, (SELECT MAX(month) AS m FROM service_levels) latest WHERE month = latest.m""")
def _(star):
    levels = star.service_levels()
    latest = J.scalar_of(star.shipped().select(month_of("l_shipdate").alias("month")), F.max("month"), "latest")
    return J.with_scalar(levels, latest).filter(F.col("month") == F.col("latest")).select("region", "month", "service_pct")


@REG.add("join_semi_persona", "accounts", """
    SELECT account_id, region, segment FROM accounts WHERE region = 'ASIA'""")
def _(star):
    scopes = IO.read_rows(star.spark, PERSONAS, PERSONA_SCHEMA).filter(F.col("user_email") == "rep").select(
        F.col("region_scope").alias("region"))
    return star.accounts().select("account_id", "region", "segment").join(scopes, "region", "left_semi")


@REG.add("join_cross_domain", "otif margin_actuals", """
    SELECT o.sku, o.month, o.orders, CAST(m.gross_margin_eur AS DOUBLE) AS gross_margin_eur
    FROM (SELECT sku, month, CAST(SUM(orders) AS BIGINT) AS orders FROM otif GROUP BY 1, 2) o
    JOIN margin_actuals m ON m.sku = o.sku AND m.month = o.month""")
def _(star):
    supply = star.otif().groupBy("sku", "month").agg(F.sum("orders").alias("orders"))
    money = star.margin_actuals().select("sku", "month", F.col("gross_margin_eur").cast("double").alias("gross_margin_eur"))
    return supply.join(money, ["sku", "month"])


@REG.add("join_pair_signals", "churn_signals sales_actuals", """
    SELECT c.account_id, c.month, c.churn_score, CAST(s.revenue_eur AS DOUBLE) AS revenue_eur
    FROM churn_signals c JOIN sales_actuals s ON s.account_id = c.account_id AND s.month = c.month""")
def _(star):
    # both views have the grain of account and month, so one pass over the lines gives their join
    return star.account_months().select("account_id", "month", "churn_score", F.col("revenue_eur").cast("double").alias("revenue_eur"))


@REG.add("join_fx_rate", "margin_actuals products fx_rates", f"""
    SELECT p.currency, m.month, ROUND(CAST(SUM(m.revenue_eur) AS DOUBLE) / MAX(f.rate_to_eur), 2) AS revenue_local
    FROM margin_actuals m JOIN products p ON p.sku = m.sku
    LEFT JOIN fx_rates f ON f.currency = p.currency AND f.month = m.month GROUP BY 1, 2""")
def _(star):
    by_currency = star.margin_actuals().join(star.products().select("sku", "currency"), "sku").groupBy(
        "currency", "month").agg(F.sum("revenue_eur").cast("double").alias("revenue"))
    return by_currency.join(star.fx_rates(), ["currency", "month"], "left").select(
        "currency", "month", F.round(F.try_divide(F.col("revenue"), F.col("rate_to_eur")), 2).alias("revenue_local"))


# -- aggregates ------------------------------------------------------------------------------


@REG.add("agg_ratio_certified", "margin_actuals", f"""
    SELECT region, ROUND({R('gross_margin_eur', 'revenue_eur')} * 100, 1) AS gm_pct FROM margin_actuals GROUP BY 1""")
def _(star):
    return star.margin_actuals().groupBy("region").agg(
        F.round(C.sum_ratio("gross_margin_eur", "revenue_eur") * 100, 1).alias("gm_pct"))


@REG.add("agg_per_unit", "margin_actuals", f"""
    SELECT sku, ROUND({R('revenue_eur', 'units')}, 2) AS price_per_unit, ROUND({R('cogs_eur', 'units')}, 2) AS cost_per_unit
    FROM margin_actuals GROUP BY 1""")
def _(star):
    return star.margin_actuals().groupBy("sku").agg(
        F.round(C.sum_ratio("revenue_eur", "units"), 2).alias("price_per_unit"),
        F.round(C.sum_ratio("cogs_eur", "units"), 2).alias("cost_per_unit"))


@REG.add("agg_global", "sales_actuals", f"""
    SELECT {D('SUM(revenue_eur)')} AS revenue_eur, CAST(SUM(volume_units) AS BIGINT) AS units, COUNT(*) AS n FROM sales_actuals""")
def _(star):
    return star.sales_actuals().agg(F.sum("revenue_eur").cast("double").alias("revenue_eur"),
                                    F.sum("volume_units").alias("units"), F.count(F.lit(1)).alias("n"))


@REG.add("agg_count_distinct", "pipeline", "SELECT stage, COUNT(DISTINCT account_id) AS accounts FROM pipeline GROUP BY 1")
def _(star):
    return star.pipeline().groupBy("stage").agg(F.countDistinct("account_id").alias("accounts"))


@REG.add("agg_collect_set", "accounts", """
    SELECT segment, string_agg(DISTINCT region, ',' ORDER BY region) AS regions, COUNT(DISTINCT region) AS n FROM accounts GROUP BY 1""")
def _(star):
    regions = F.array_sort(F.collect_set("region"))
    return star.accounts().groupBy("segment").agg(F.array_join(regions, ",").alias("regions"),
                                                  F.size(regions).cast("bigint").alias("n"))


@REG.add("agg_avg_max", "churn_signals", """
    SELECT month, (2 * SUM(CAST(ROUND(churn_score * 1000) AS BIGINT)) + COUNT(*)) // (2 * COUNT(*)) / 1000.0::DOUBLE AS avg_score,
           MAX(churn_score) AS max_score FROM churn_signals GROUP BY 1""")
def _(star):
    # scores are whole thousandths: rounding whole numbers leaves no tie to floating point
    total, n = F.sum(F.round(F.col("churn_score") * 1000).cast("bigint")), F.count(F.lit(1))
    return star.churn_signals().groupBy("month").agg(total.alias("s"), n.alias("n"), F.max("churn_score").alias("max_score")).select(
        "month", (F.expr("(2 * s + n) div (2 * n)") / F.lit(1000.0)).alias("avg_score"), "max_score")


@REG.add("agg_pivot_max", "margin_actuals", f"""
    SELECT sku, ROUND(MAX(CASE WHEN q = 'Q1' THEN g END), 1) AS q1, ROUND(MAX(CASE WHEN q = 'Q2' THEN g END), 1) AS q2,
           ROUND(MAX(CASE WHEN q = 'Q2' THEN g END) - MAX(CASE WHEN q = 'Q1' THEN g END), 1) AS delta
    FROM (SELECT sku, {BUCKET} AS q, {R('gross_margin_eur', 'revenue_eur')} * 100 AS g FROM margin_actuals
          WHERE {BUCKET} IS NOT NULL GROUP BY 1, 2) s GROUP BY sku""")
def _(star):
    from ..operators.metrics import margin_swing
    swing = margin_swing(star.margin_actuals(H1), star.products(), ("sku",), PERIODS)
    return swing.select("sku", F.round("base", 1).alias("q1"), F.round("target", 1).alias("q2"), F.round("delta", 1).alias("delta"))


@REG.add("agg_pivot_sum", "sales_actuals", f"""
    SELECT account_id, {D("SUM(CASE WHEN q = 'Q1' THEN revenue_eur END)")} AS base,
           {D("SUM(CASE WHEN q = 'Q2' THEN revenue_eur END)")} AS target,
           {D("SUM(CASE WHEN q = 'Q2' THEN revenue_eur END) - SUM(CASE WHEN q = 'Q1' THEN revenue_eur END)")} AS delta
    FROM (SELECT account_id, {BUCKET} AS q, revenue_eur FROM sales_actuals) s WHERE q IS NOT NULL GROUP BY 1""")
def _(star):
    from ..operators.metrics import pivot_delta
    rows = star.sales_actuals(H1).withColumn("period", C.case_bucket("month", PERIODS))
    got = pivot_delta(rows, ("account_id",), F.col("revenue_eur"), PERIODS, how="sum")
    return got.select("account_id", *[F.col(c).cast("double").alias(c) for c in ("base", "target", "delta")])


@REG.add("agg_having", "inventory", """
    SELECT plant, sku, CAST(SUM(stockout_flag) AS BIGINT) AS stockouts FROM inventory GROUP BY 1, 2 HAVING SUM(stockout_flag) > 0""")
def _(star):
    return star.inventory().groupBy("plant", "sku").agg(F.sum("stockout_flag").alias("stockouts")).filter(F.col("stockouts") > 0)


@REG.add("agg_group_ordinal", sql="SELECT year(o_orderdate) AS order_year, COUNT(*) AS n FROM orders GROUP BY 1")
def _(star):
    return star.spark.sql("SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, COUNT(*) AS n FROM {o} GROUP BY 1",
                          o=star.table("orders"))


@REG.add("agg_ladder", "actions", "SELECT level, status, COUNT(*) AS n FROM actions GROUP BY 1, 2")
def _(star):
    return T.ladder(star.actions())


STATUSES = ("proposed", "approved", "executing", "executed", "rejected", "failed", "escalated")


@REG.add("agg_ladder_zero_fill", "actions", """
    SELECT CAST(l.level AS BIGINT) AS level, s.status, COALESCE(c.n, 0) AS n, CAST(SUM(COALESCE(c.n, 0)) OVER (PARTITION BY l.level) AS BIGINT) AS total
    FROM (VALUES (1), (2), (3), (4)) l(level)
    CROSS JOIN (VALUES ('proposed'), ('approved'), ('executing'), ('executed'), ('rejected'), ('failed'), ('escalated')) s(status)
    LEFT JOIN (SELECT level, status, COUNT(*) AS n FROM actions GROUP BY 1, 2) c ON c.level = l.level AND c.status = s.status""")
def _(star):
    return T.ladder_zero_fill(star.actions(), STATUSES)


# -- windows ---------------------------------------------------------------------------------


@REG.add("win_latest_per_key", "margin_actuals", """
    SELECT sku, month, units, CAST(revenue_eur AS DOUBLE) AS revenue_eur FROM margin_actuals
    QUALIFY ROW_NUMBER() OVER (PARTITION BY sku ORDER BY month DESC) = 1""")
def _(star):
    last = O.latest_per_key(star.margin_actuals(), ("sku",), ("month",), ("month", "units", "revenue_eur"))
    return last.withColumn("revenue_eur", F.col("revenue_eur").cast("double"))


@REG.add("win_next_turn", sql="SELECT conv_id, COALESCE(MAX(turn), -1) + 1 AS next_turn FROM conversations GROUP BY 1")
def _(star):
    return star.table("conversations").groupBy("conv_id").agg((F.coalesce(F.max("turn"), F.lit(-1)) + 1).alias("next_turn"))


@REG.add("win_event_order", "action_events", """
    SELECT action_id, event_id, status, LAG(status) OVER (PARTITION BY action_id ORDER BY ts, event_id) AS prev_status
    FROM action_events""")
def _(star):
    ev = star.action_events().select("action_id", "event_id", "ts", "status")
    return O.with_lag(ev, ("action_id",), ("ts", "event_id"), {"status": "prev_status"}).drop("ts")


@REG.add("win_mom", "sales_actuals accounts", f"""
    SELECT region, month, revenue, revenue - LAG(revenue) OVER (PARTITION BY region ORDER BY month) AS change,
           RANK() OVER (PARTITION BY month ORDER BY revenue DESC) AS revenue_rank
    FROM (SELECT a.region, s.month, ROUND({D('SUM(s.revenue_eur)')}) AS revenue
          FROM sales_actuals s JOIN accounts a ON a.account_id = s.account_id GROUP BY 1, 2) m""")
def _(star):
    from pyspark.sql import Window
    monthly = star.sales_actuals().join(star.accounts().select("account_id", "region"), "account_id").groupBy(
        "region", "month").agg(F.round(F.sum("revenue_eur").cast("double"), 0).alias("revenue"))
    moved = J.month_over_month(monthly, ("region",), "month", "revenue").drop("previous")
    rank = F.rank().over(Window.partitionBy("month").orderBy(F.desc("revenue")))
    return moved.withColumn("revenue_rank", rank.cast("bigint"))


# -- sort, limit, top-k ----------------------------------------------------------------------


@REG.add("sort_multi", "lanes", "SELECT lane_id, mode, lead_time_days, cost_per_unit FROM lanes")
def _(star):
    return star.lanes().select("lane_id", "mode", "lead_time_days", "cost_per_unit").orderBy(
        F.desc("lead_time_days"), F.desc("cost_per_unit"), F.asc("lane_id"))


@REG.add("topk_delta", "margin_actuals", f"""
    SELECT sku, ROUND(MAX(CASE WHEN q = 'Q2' THEN g END) - MAX(CASE WHEN q = 'Q1' THEN g END), 1) AS delta
    FROM (SELECT sku, {BUCKET} AS q, {R('gross_margin_eur', 'revenue_eur')} * 100 AS g FROM margin_actuals
          WHERE {BUCKET} IS NOT NULL GROUP BY 1, 2) s GROUP BY sku ORDER BY delta NULLS LAST, sku LIMIT 5""")
def _(star):
    from ..operators.metrics import margin_swing
    swing = margin_swing(star.margin_actuals(H1), star.products(), ("sku",), PERIODS).select("sku", F.round("delta", 1).alias("delta"))
    return T.top_k(swing, (F.asc_nulls_last("delta"), F.asc("sku")), 5)


@REG.add("topk_nulls", "sales_actuals", f"""
    SELECT account_id, {D("SUM(CASE WHEN q = 'Q2' THEN revenue_eur END) - SUM(CASE WHEN q = 'Q1' THEN revenue_eur END)")} AS delta
    FROM (SELECT account_id, {BUCKET} AS q, revenue_eur FROM sales_actuals) s WHERE q IS NOT NULL GROUP BY 1
    ORDER BY delta NULLS LAST, account_id LIMIT 10""")
def _(star):
    from ..plans.commercial import revenue_swing
    swing = revenue_swing(star.sales_actuals(H1), PERIODS).select(
        "account_id", (F.col("rev1") - F.col("rev0")).cast("double").alias("delta"))
    return T.top_k(swing, (F.asc_nulls_last("delta"), F.asc("account_id")), 10)


@REG.add("cap_rows", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _(star):
    return T.cap_rows(star.table("orders").select("o_orderkey", "o_totalprice"), (F.desc("o_totalprice"), F.asc("o_orderkey")))


@REG.add("list_filtered", "actions", "SELECT action_id, agent, status, level FROM actions WHERE status = 'approved' AND level = 2")
def _(star):
    return T.list_filtered(star.actions(), "created_at", "action_id", status="approved", agent=None, level=2).select(
        "action_id", "agent", "status", "level")


# -- scalar functions ------------------------------------------------------------------------


@REG.add("fn_round", sql="SELECT o_orderkey, ROUND(o_totalprice) AS whole, ROUND(o_totalprice / 1000, 2) AS thousands FROM orders")
def _(star):
    return star.table("orders").select("o_orderkey", F.round("o_totalprice", 0).alias("whole"),
                                       F.round(F.col("o_totalprice") / 1000, 2).alias("thousands"))


@REG.add("fn_concat_lower_substr", sql="""
    SELECT c_custkey, lower(c_name) || ':' || substr(c_mktsegment, 1, 3) AS tag, length(c_name) AS name_chars FROM customer""")
def _(star):
    return star.table("customer").select(
        "c_custkey", F.concat(F.lower("c_name"), F.lit(":"), F.substring("c_mktsegment", 1, 3)).alias("tag"),
        F.length("c_name").cast("bigint").alias("name_chars"))


@REG.add("fn_ceil_greatest_cast", sql="""
    SELECT doc_id, CAST(GREATEST(CEIL(length(text) / 1600.0) - 1, 0) AS BIGINT) AS last_chunk FROM documents""")
def _(star):
    return star.table("documents").select(
        "doc_id", F.greatest(F.ceil(F.length("text") / F.lit(1600.0)) - 1, F.lit(0)).cast("bigint").alias("last_chunk"))


@REG.add("fn_regexp_extract", sql=r"SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '/([^/?#]+)([?#].*)?$', 1) AS stem FROM pages")
def _(star):
    return star.table("pages").select("page_id", F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"),
                                      F.regexp_extract("url", r"/([^/?#]+)([?#].*)?$", 1).alias("stem"))


@REG.add("fn_digits", sql="SELECT page_id, TRY_CAST(regexp_replace(url, '[^0-9]', '', 'g') AS BIGINT) AS digits FROM pages")
def _(star):
    return star.table("pages").select("page_id", C.digits_only("url").alias("digits"))


@REG.add("fn_lpad", sql="SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '_' || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 3 THEN CAST(o_orderkey AS VARCHAR) ELSE lpad(CAST(o_orderkey AS VARCHAR), 3, '0') END AS chunk_id FROM orders")
def _(star):
    return star.table("orders").select("o_orderkey", C.chunk_id("o_custkey", "o_orderkey", width=3).alias("chunk_id"))


@REG.add("fn_yes_bool", sql="SELECT event_id, lower(event_type) IN ('true', 'yes') AS plain, lower(CASE WHEN value > 10 THEN 'Yes' ELSE 'no' END) IN ('true', 'yes') AS flag FROM events")
def _(star):
    return star.table("events").select("event_id", C.yes_bool("event_type").alias("plain"),
                                       C.yes_bool(F.when(F.col("value") > 10, "Yes").otherwise("no")).alias("flag"))


@REG.add("fn_array_seq", sql="SELECT p_partkey, CAST(list_sum(range(1, p_size + 1)) AS BIGINT) AS total, CAST(len(range(1, p_size + 1)) AS BIGINT) AS n FROM part")
def _(star):
    seq = F.sequence(F.lit(1).cast("bigint"), F.col("p_size").cast("bigint"))
    return star.table("part").select("p_partkey", F.aggregate(seq, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
                                     F.size(seq).cast("bigint").alias("n"))


@REG.add("fn_hof_join", sql="""
    SELECT event_id, event_type || chr(10) || json_extract_string(props, '$.k') AS joined FROM events""")
def _(star):
    text = F.concat(F.lit('[{"content": "'), F.col("event_type"), F.lit('", "type": "kind"}, {"content": "'),
                    F.get_json_object("props", "$.k"), F.lit('", "type": "key"}]'))
    elements = F.from_json(text, "array<struct<content: string, type: string>>")
    return star.table("events").select("event_id", F.array_join(F.transform(elements, lambda e: e["content"]), "\n").alias("joined"))


@REG.add("fn_posexplode", sql="""
    SELECT o_orderkey, CAST(i AS BIGINT) AS pos, part_text FROM (
        SELECT o_orderkey, generate_subscripts(string_split(o_orderpriority, '-'), 1) - 1 AS i,
               unnest(string_split(o_orderpriority, '-')) AS part_text FROM orders) s""")
def _(star):
    return star.table("orders").select("o_orderkey", F.posexplode(F.split("o_orderpriority", "-")).alias("pos", "part_text")).withColumn(
        "pos", F.col("pos").cast("bigint"))


@REG.add("fn_variant_path", sql="SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(star):
    return star.table("events").select("event_id", F.try_variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


@REG.add("fn_variant_explode", sql="""
    SELECT event_id, k AS name, CAST(json_extract(props, '$.' || k) AS BIGINT) AS v
    FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) s""")
def _(star):
    return star.spark.sql("""
        SELECT e.event_id, x.key AS name, variant_get(x.value, '$', 'bigint') AS v
        FROM {ev} e, LATERAL variant_explode(parse_json(e.props)) AS x""", ev=star.table("events"))


@REG.add("fn_to_json", sql="""SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS props_json FROM events""")
def _(star):
    return star.table("events").select("event_id", F.to_json(F.parse_json("props")).alias("props_json"))


@REG.add("fn_json_path", sql="SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def _(star):
    return star.table("events").select("event_id", F.get_json_object("props", "$.k").alias("k"),
                                       F.get_json_object("props", "$.missing").alias("missing"))


@REG.add("fn_month_horizon", sql=f"SELECT CAST(MAX({sql_month('l_shipdate')}) + INTERVAL 3 MONTH AS DATE) AS horizon FROM lineitem")
def _(star):
    return star.shipped().agg(C.month_horizon(month_of(F.max("l_shipdate"))).alias("horizon"))


@REG.add("fn_region_norm", sql=r"""
    SELECT r_regionkey, CASE
        WHEN regexp_matches(lower(r_name), '\bemea|\beurope|\brotterdam|\bnetherlands|\buk\b|\bgermany') THEN 'EMEA'
        WHEN regexp_matches(lower(r_name), '\bamerica|\bus\b|\busa\b|\blatam|\bcanada') THEN 'Americas'
        WHEN regexp_matches(lower(r_name), '\bapac|\basia|\baustralia|\bpacific') THEN 'APAC'
        WHEN regexp_matches(lower(r_name), '\bchina') THEN 'China' ELSE r_name END AS sales_region, COUNT(*) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def _(star):
    named = star.located(star.table("customer"), "c_nationkey")
    return named.groupBy(F.col("regionkey").alias("r_regionkey"), "region").agg(F.count(F.lit(1)).alias("customers")).select(
        "r_regionkey", C.region_norm("region").alias("sales_region"), "customers")


@REG.add("fn_identity", sql="SELECT true AS knows_user, true AS knows_catalog, COUNT(*) AS rows FROM events")
def _(star):
    return star.table("events").select(F.current_user().alias("me"), F.current_catalog().alias("catalog")).agg(
        (F.min(F.length("me")) > 0).alias("knows_user"), (F.min(F.length("catalog")) > 0).alias("knows_catalog"), F.count(F.lit(1)).alias("rows"))


@REG.add("non_standard_flag", sql="""
    SELECT o_orderkey, (o_orderkey % 120) > 60 AND CAST(o_totalprice * 10 AS BIGINT) > 1000000 AS flagged FROM orders""")
def _(star):
    spend = F.round(F.col("o_totalprice") * 10, 0).cast("bigint")
    return star.table("orders").select("o_orderkey", C.non_standard_flag(F.col("o_orderkey") % 120, spend).alias("flagged"))


@REG.add("strip_fence", sql="SELECT page_id, trim(url) AS body FROM pages")
def _(star):
    fenced = F.concat(F.lit("Here:\n```sql\n"), F.col("url"), F.lit("\n```\nDone."))
    text = F.when(F.col("page_id") % 2 == 0, fenced).otherwise(F.concat(F.lit("  "), F.col("url"), F.lit("\n")))
    return star.table("pages").select("page_id", C.strip_fence(text).alias("body"))
