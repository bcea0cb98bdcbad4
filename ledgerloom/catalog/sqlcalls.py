"""Queries written in SQL text that calls the library's functions."""

from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources import io as IO
from ..sqlfunctions import forecasting as X
from ..sqlfunctions import models as M
from ..sqlfunctions import rowfilter as W
from .core import PERSONA_SCHEMA, PERSONAS, STAR_VIEWS
from .forecasting import FIT_NEXT, SERIES
from .registry import Registry

REG = Registry()
#: Views whose region is that of their product, lane or account; the others have the column, exchange rates have none.
REACHED = {
    "inventory": "inventory JOIN (SELECT DISTINCT sku, region FROM products) USING (sku)", "lanes": "(SELECT dest_region AS region FROM lanes)",
    "pipeline": "pipeline JOIN accounts USING (account_id)", "sales_actuals": "sales_actuals JOIN accounts USING (account_id)",
    "churn_signals": "churn_signals JOIN accounts USING (account_id)",
}


def _filter(star, name):
    people = IO.read_rows(star.spark, PERSONAS, PERSONA_SCHEMA)
    W.create_row_filter(star.spark, name, people, IO.read_rows(star.spark, (("auditor", "admins"),), "user_email string, group_name string"))


@REG.add("rls_function", "margin_actuals", "SELECT sku, region, month, units FROM margin_actuals WHERE region = 'EUROPE'")
def _(star):
    _filter(star, "fn_region_rls")
    with W.calling_as(star.spark, "planner"):
        return star.spark.sql("SELECT sku, region, month, units FROM {margin_actuals} WHERE fn_region_rls(region)", margin_actuals=star.margin_actuals())


CALLERS = {"controller": "TRUE", "planner": "region = 'EUROPE'", "rep": "region = 'ASIA'", "auditor": "TRUE", "stranger": "FALSE"}


@REG.add("rls_function_views", " ".join(STAR_VIEWS), " UNION ALL ".join(
    f"SELECT '{c}' AS user_email, '{v}' AS view, COUNT(*) AS visible FROM {REACHED.get(v, v)}{'' if v == 'fx_rates' else f' WHERE {sees}'}"
    for c, sees in CALLERS.items() for v in STAR_VIEWS))
def _(star):
    _filter(star, "fn_region_rls")
    # the filter looks at the region alone, so it may run on the rows of each view and region counted first
    counts = cut_lineage(star.rows_by_region())
    shown = None
    for caller in CALLERS:
        with W.calling_as(star.spark, caller):
            one = star.spark.sql("""
                SELECT :caller AS user_email, view, CAST(SUM(CASE WHEN view = 'fx_rates' OR fn_region_rls(region) THEN row_count ELSE 0 END) AS BIGINT) AS visible
                FROM {counts} GROUP BY view""", args={"caller": caller}, counts=counts)
        shown = one if shown is None else shown.unionByName(one)
    return shown


@REG.add("forecast_table", "margin_actuals", """
    SELECT region, ds, ROUND(point) AS y_forecast, ROUND(point - CAST(1.96 AS DOUBLE) * sd) AS y_lower, ROUND(point + CAST(1.96 AS DOUBLE) * sd) AS y_upper, 'ok' AS status
    FROM spread""", extra=SERIES.format(where="") + FIT_NEXT)
def _(star):
    X.register_forecast_table(star.spark)
    series = star.margin_actuals().groupBy("region", "month").agg(F.sum("revenue_eur").cast("double").alias("y"))
    return star.spark.sql("""
        SELECT * FROM forecast_table(TABLE(SELECT region, month, y FROM {series}) PARTITION BY region, time_col => 'month', value_col => 'y', months => 3)""",
        series=series)


@REG.add("ai_function", sql="""
    SELECT p_partkey, 'echo: Describe ' || p_name || ' of ' || p_brand || '.' AS output FROM part""")
def _(star):
    M.register_model(star.spark, "ask_model", M.echo)
    M.create_question(star.spark, "describe_part", "ask_model", "Describe ")
    return star.spark.sql("SELECT p_partkey, describe_part(concat(p_name, ' of ', p_brand, '.')) AS output FROM {part}", part=star.table("part"))
