"""Forecasts."""

from datetime import date

from pyspark.sql import functions as F

from ..operators import forecast as X
from ..session import cut_lineage
from ..sources import io as IO
from ..sources.tables import in_months
from .registry import Registry

REG = Registry()
SERIES = "series AS (SELECT region, month, CAST(SUM(revenue_eur) AS DOUBLE) AS y FROM margin_actuals {where} GROUP BY 1, 2)"
T = "(CAST(year({c}) * 12 + month({c}) AS DOUBLE) - 23880)"
FIT = """,
  fit AS (
    SELECT region, COUNT(*) AS n, MAX(month) AS last_month, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, AVG(t) AS t_mean,
           regr_sxx(y, t) AS sxx, regr_syy(y, t) AS syy, regr_sxy(y, t) AS sxy
    FROM (SELECT *, {t} AS t FROM series) s GROUP BY 1),
  ahead AS (SELECT *, {ds} AS ds FROM fit, range(1, 4) steps(step)),
  spread AS (SELECT *, sqrt(GREATEST(syy - sxy * sxy / sxx, 0) / (n - 2)) * sqrt(1 + 1.0::DOUBLE / n + ({td} - t_mean) * ({td} - t_mean) / sxx) AS sd,
                    intercept + slope * {td} AS point FROM ahead)"""
FIT_NEXT = FIT.format(t=T.format(c="month"), td=T.format(c="ds"), ds="CAST(last_month + step * INTERVAL 1 MONTH AS DATE)")


def _series(star, months=None):
    return star.margin_actuals(months).groupBy("region", "month").agg(F.sum("revenue_eur").cast("double").alias("y"))


@REG.add("forecast", "margin_actuals", """
    SELECT region, ds, ROUND(point) AS y_forecast, ROUND(point - CAST(1.96 AS DOUBLE) * sd) AS y_lower, ROUND(point + CAST(1.96 AS DOUBLE) * sd) AS y_upper, 'ok' AS status
    FROM spread""", extra=SERIES.format(where="") + FIT_NEXT)
def _(star):
    return X.forecast(_series(star), ("region",))


SEASON_SQL = """
    cells AS (SELECT region, month(month) AS moy, COUNT(y) AS n, MAX(month) AS last, regr_avgx(y, t) AS tx, regr_avgy(y, t) AS ty,
                     regr_sxx(y, t) AS sxx, regr_sxy(y, t) AS sxy, regr_syy(y, t) AS syy
              FROM (SELECT *, (CAST(year(month) * 12 + month(month) AS DOUBLE) - 23880) AS t FROM series) s GROUP BY 1, 2),
    total AS (SELECT region, SUM(n) AS n, MAX(last) AS last, SUM(sxx) AS sxx, SUM(sxy) AS sxy, SUM(syy) AS syy FROM cells GROUP BY 1),
    later AS (SELECT total.*, CAST(last + step * INTERVAL 1 MONTH AS DATE) AS ds FROM total, range(1, 4) steps(step)),
    placed AS (SELECT l.*, c.ty, c.n AS cn, (CAST(year(ds) * 12 + month(ds) AS DOUBLE) - 23880) - c.tx AS gap
               FROM later l JOIN cells c ON c.region = l.region AND c.moy = month(l.ds)),
    season AS (SELECT *, ty + sxy / sxx * gap AS point,
                      sqrt(GREATEST(syy - sxy * sxy / sxx, 0) / (n - 13)) * sqrt(1 + 1.0::DOUBLE / cn + gap * gap / sxx) AS sd FROM placed)"""


@REG.add("forecast_seasonal", "margin_actuals", """
    SELECT region, ds, ROUND(point) AS y_forecast, ROUND(point - CAST(1.96 AS DOUBLE) * sd) AS y_lower, ROUND(point + CAST(1.96 AS DOUBLE) * sd) AS y_upper,
           'ok' AS status, 'season' AS model FROM season""", extra=SERIES.format(where="") + "," + SEASON_SQL)
def _(star):
    return X.forecast_seasonal(_series(star), ("region",))


HOLDOUT = (None, date(2000, 3, 1))


@REG.add("forecast_compare", "margin_actuals", """
    SELECT version, region, COUNT(*) AS months, ROUND(AVG(e)) AS bias, ROUND(AVG(ABS(e))) AS mae, ROUND(SUM(ABS(e)) / SUM(ABS(y)) * 100, 1) AS wape_pct, 'ok' AS verdict
    FROM (SELECT v.version, s.region, ROUND(s.point) * v.f - a.y AS e, a.y FROM spread s
          JOIN (SELECT region, month, CAST(SUM(revenue_eur) AS DOUBLE) AS y FROM margin_actuals GROUP BY 1, 2) a ON a.region = s.region AND a.month = s.ds
          CROSS JOIN (VALUES ('baseline', 1.0::DOUBLE), ('plus5', 1.05::DOUBLE)) v(version, f)) x GROUP BY 1, 2""",
         extra=SERIES.format(where="WHERE month < DATE '2000-04-01'") + FIT_NEXT)
def _(star):
    series = cut_lineage(_series(star))  # one row per region and month, split below
    history = in_months(series, "month", HOLDOUT)
    base = X.forecast(history, ("region",))
    versions = base.select("region", "ds", F.inline(F.array(
        F.struct(F.lit("baseline").alias("version"), F.col("y_forecast").alias("y_forecast")),
        F.struct(F.lit("plus5").alias("version"), (F.col("y_forecast") * 1.05).alias("y_forecast")))))
    actual = in_months(series, "month", (date(2000, 4, 1), date(2000, 6, 1))).withColumnRenamed("month", "ds")
    counts = history.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    return X.forecast_compare(versions, actual, ("region",), counts)


@REG.add("forecast_override", "margin_actuals", """
    SELECT s.region, ds, ROUND(point) AS y_forecast, ROUND(ROUND(point) * (1 + pct / 100)) AS y_override, why AS rationale,
           'forecast_override' AS action_type, 'proposed' AS action_status, 'planner' AS requested_by
    FROM spread s JOIN (VALUES ('EUROPE', -4.0::DOUBLE, 'price pressure'), ('ASIA', 2.5::DOUBLE, 'new plant')) a(region, pct, why) ON a.region = s.region""",
         extra=SERIES.format(where="") + FIT_NEXT)
def _(star):
    assumptions = IO.read_rows(star.spark, (("EUROPE", -4.0, "price pressure"), ("ASIA", 2.5, "new plant")),
                               "region string, change_pct double, rationale string")
    return X.forecast_override(X.forecast(_series(star), ("region",)), assumptions, ("region",), "planner")
