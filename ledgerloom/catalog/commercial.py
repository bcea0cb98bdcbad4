"""Commercial: the certified queries."""

from datetime import date

from ..plans import commercial as P
from ..sources.star import AS_OF, FOCUS_REGION, FOCUS_SEGMENT, H1, Q1, Q2
from .registry import Registry
from .star_sql import _COGS, _REV, account_id, padded

REG = Registry()
PERIODS = (("Q1", *Q1), ("Q2", *Q2))
YTD = date(AS_OF.year, 1, 1)
SINCE = (YTD, None)
WATCHED = ("ACC000000000010", "ACC000000000025", "ACC000000000041")

# The checks start from the raw tables. A customer counts as active in a month if a line of theirs was shipped in it; the
# signals of such a month are whole numbers computed from the customer key and the month.
KEYS = "(10, 25, 41)"
EUROPEAN = "(SELECT n_nationkey FROM nation WHERE n_regionkey = (SELECT r_regionkey FROM region WHERE r_name = 'EUROPE'))"
ACTIVE = """active AS (
    SELECT DISTINCT o_custkey AS k, year(l_shipdate) AS y, month(l_shipdate) AS m
    FROM orders, lineitem WHERE o_orderkey = l_orderkey)"""
MILLI = "((k * 7919 + y * 372 + m * 31) % 1000)"


def acc(key: str) -> str:
    return account_id(key) + " AS account_id"


OPEN_ORDERS = "o_orderstatus <> 'F'"


@REG.add("com_q01", "", f"""
    SELECT {acc('k')}, c_name AS account_name, 'REP' || {padded('c_nationkey', 2)} AS owner_rep, {MILLI} / 1000.0::DOUBLE AS churn_score,
           (k * 13 + 42) % 90 AS last_order_days, (k + 6) % 8 AS complaint_count, (k * 31 + 102) % 201 - 100 AS nps
    FROM active SEMI JOIN (SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IN {EUROPEAN}) cohort USING (k)
    JOIN customer ON c_custkey = k
    WHERE (y, m) = (2000, 6) AND {MILLI} > 700""", extra=ACTIVE)
def _(star):
    return P.com_q01(star.churn_signals((AS_OF, AS_OF)), star.accounts(FOCUS_REGION), FOCUS_REGION, FOCUS_SEGMENT, AS_OF)


@REG.add("com_q02", "", f"""
    WITH shipped AS (
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, {_REV} AS revenue
        FROM lineitem WHERE year(l_shipdate) >= 2000 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN {KEYS}))
    SELECT month, round(SUM(revenue)::DOUBLE) AS revenue_eur FROM shipped GROUP BY month""")
def _(star):
    return P.com_q02(star.sales_actuals(SINCE, WATCHED), WATCHED, YTD)


@REG.add("com_q03", "geo", f"""
    SELECT {acc('k')}, c_name AS account_name, geo.region, c_mktsegment AS segment, {MILLI} / 1000.0::DOUBLE AS churn_score
    FROM active JOIN customer ON c_custkey = k JOIN geo ON n_nationkey = c_nationkey
    WHERE (y, m) = (2000, 6) AND {MILLI} > 700""", extra=ACTIVE)
def _(star):
    return P.com_q03(star.churn_signals((AS_OF, AS_OF)), star.accounts(), AS_OF)


@REG.add("com_q04", "", f"""
    SELECT {acc('k')}, make_date(y, m, 1) AS month, {MILLI} / 1000.0::DOUBLE AS churn_score
    FROM active WHERE k IN {KEYS} AND y >= 2000""", extra=ACTIVE)
def _(star):
    return P.com_q04(star.churn_signals(SINCE, WATCHED), WATCHED, YTD)


@REG.add("com_q05", "", f"""
    SELECT 'REP' || {padded('nation', 2)} AS owner_rep, SUM(n) AS open_opps, round(SUM(worth)::DOUBLE) AS open_pipeline_eur
    FROM (SELECT (SELECT c_nationkey FROM customer WHERE c_custkey = o_custkey) AS nation, COUNT(*) AS n,
                 SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS worth
          FROM orders WHERE {OPEN_ORDERS} AND o_custkey IN {KEYS} GROUP BY o_custkey) per_customer
    GROUP BY nation""")
def _(star):
    return P.com_q05(star.accounts(), star.pipeline(), WATCHED)


@REG.add("com_q06", "", f"""
    SELECT cohort, COUNT(*) AS accounts, round(SUM(milli) / 1000.0::DOUBLE / COUNT(*), 3) AS avg_churn_score,
           MAX(milli) / 1000.0::DOUBLE AS max_churn_score
    FROM (SELECT if(c_mktsegment = 'BUILDING' AND c_nationkey IN {EUROPEAN}, 'Focus cohort', 'Other') AS cohort, {MILLI} AS milli
          FROM active, customer WHERE c_custkey = k AND (y, m) = (2000, 6)) june
    GROUP BY cohort""", extra=ACTIVE)
def _(star):
    return P.com_q06(star.churn_signals((AS_OF, AS_OF)), star.accounts(), FOCUS_REGION, FOCUS_SEGMENT, AS_OF)


@REG.add("com_q07", "order_region", f"""
    SELECT region, round(SUM({_REV})::DOUBLE) AS revenue_eur, round((SUM({_REV}) - SUM({_COGS}))::DOUBLE) AS margin_eur
    FROM lineitem, order_region
    WHERE l_orderkey = o_orderkey AND year(l_shipdate) = 2000 AND month(l_shipdate) = 6 GROUP BY region""")
def _(star):
    return P.com_q07(star.sales_actuals((AS_OF, AS_OF)), star.accounts(), AS_OF)


@REG.add("com_q08", "", f"""
    SELECT if(o_orderstatus = 'P', 'Propose', 'Negotiate') AS stage, COUNT(*) AS opps,
           round(SUM(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE) AS pipeline_eur
    FROM orders SEMI JOIN (SELECT c_custkey AS o_custkey FROM customer WHERE c_nationkey IN {EUROPEAN}) europeans USING (o_custkey)
    WHERE {OPEN_ORDERS} AND o_orderkey % 2 = 0 GROUP BY 1""")
def _(star):
    return P.com_q08(star.pipeline(), star.accounts(FOCUS_REGION), "ECONOMY", FOCUS_REGION)


@REG.add("com_q09", "order_region", f"""
    SELECT * FROM named QUALIFY row_number() OVER (ORDER BY delta_eur NULLS LAST, account_id) <= 10""", extra=f"""halves AS (
        SELECT o_custkey, region, SUM({_REV}) FILTER (quarter(l_shipdate) = 1) AS one, SUM({_REV}) FILTER (quarter(l_shipdate) = 2) AS two
        FROM order_region JOIN lineitem ON o_orderkey = l_orderkey
        WHERE year(l_shipdate) = 2000 AND quarter(l_shipdate) < 3 GROUP BY o_custkey, region
    ), named AS (
        SELECT {acc('o_custkey')}, c_name AS account_name, region, round(one::DOUBLE) AS q1_rev, round(two::DOUBLE) AS q2_rev,
               round((two - one)::DOUBLE) AS delta_eur
        FROM halves JOIN customer ON c_custkey = o_custkey
    )""")
def _(star):
    return P.com_q09(star.sales_actuals(H1), star.accounts(), PERIODS)


@REG.add("com_q10", "", f"""
    SELECT {acc('k')}, make_date(y, m, 1) AS month, {MILLI} / 1000.0::DOUBLE AS churn_score, round(SUM({_REV})::DOUBLE) AS revenue_eur,
           (k + m) % 8 AS complaint_count, (k * 31 + m * 17) % 201 - 100 AS nps
    FROM (SELECT o_custkey AS k, year(l_shipdate) AS y, month(l_shipdate) AS m, lineitem.*
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey IN {KEYS} AND l_shipdate >= DATE '2000-01-01') sold
    GROUP BY k, y, m""")
def _(star):
    return P.com_q10(star.account_months(SINCE, WATCHED), WATCHED, YTD)
