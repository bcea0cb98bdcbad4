"""Monthly trend forecasts with a band, their comparison with actuals, and staged overrides."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..session import cut_lineage

# Fixed value: half width of a 95 % band in standard deviations.
BAND_SIGMAS = 1.96


def month_index(month: Column | str) -> Column:
    c = F.col(month) if isinstance(month, str) else month
    return (F.year(c) * 12 + F.month(c)).cast("double")


def fit_trend(series: DataFrame, keys: Sequence[str], month: str = "month", value: str = "y") -> DataFrame:
    """Straight line per series from aggregates: no series is gathered in one place.

    Months count from the first year of this calendar era minus 1990 years, which keeps the sums small.
    """
    t = month_index(month) - F.lit(1990 * 12.0)
    y = F.col(value).cast("double")
    return series.groupBy(*keys).agg(
        F.count(y).alias("n"),
        F.max(month).alias("last_month"),
        F.regr_slope(y, t).alias("slope"),
        F.regr_intercept(y, t).alias("intercept"),
        F.avg(t).alias("t_mean"),
        F.regr_sxx(y, t).alias("sxx"),
        F.regr_syy(y, t).alias("syy"),
        F.regr_sxy(y, t).alias("sxy"),
    )


def forecast(series: DataFrame, keys: Sequence[str], months: int = 3, month: str = "month", value: str = "y",
             min_history: int = 6, start: date | None = None) -> DataFrame:
    """Point and band for the months after the last one of each series (or after ``start``).

    A series shorter than ``min_history`` months gets one row with status ``too_short`` and no numbers.
    """
    fit = fit_trend(series, keys, month, value)
    origin = F.lit(start) if start is not None else F.col("last_month")
    steps = fit.withColumn("_ok", F.col("n") >= min_history).withColumn(
        "_step", F.explode(F.when(F.col("_ok"), F.sequence(F.lit(1), F.lit(months))).otherwise(F.array(F.lit(0))))
    ).withColumn("ds", F.when(F.col("_ok"), F.add_months(origin, F.col("_step"))))
    t = month_index("ds") - F.lit(1990 * 12.0)
    residual = F.greatest(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.lit(0.0))
    spread = F.sqrt(F.try_divide(residual, F.col("n") - 2)) * F.sqrt(
        1 + F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide((t - F.col("t_mean")) * (t - F.col("t_mean")), F.col("sxx"))
    )
    point = F.col("intercept") + F.col("slope") * t
    shown = [F.when(F.col("_ok"), F.round(e, 0)).alias(n) for n, e in (
        ("y_forecast", point), ("y_lower", point - BAND_SIGMAS * spread), ("y_upper", point + BAND_SIGMAS * spread))]
    return steps.select(*keys, "ds", *shown, F.when(F.col("_ok"), "ok").otherwise("too_short").alias("status"))


def forecast_seasonal(series: DataFrame, keys: Sequence[str], months: int = 3, month: str = "month", value: str = "y",
                      min_history: int = 6, min_season: int = 24) -> DataFrame:
    """Point and band of a straight line with a level of its own for each month of the year, where a series allows it.

    Least squares with one level per month of the year has a closed form in sums around the means of each: the slope is the
    sum of their products of time and value over the sum of their squares of time, and each month's level follows from its
    mean. So a series is two small aggregates (by key and month of the year, then by key, twelve entries at most) and is
    gathered nowhere. A series needs ``min_season`` months and every month of the year twice; others get the straight line of
    :func:`forecast`, which also says when they are too short. ``model`` is ``season`` or ``line``.
    """
    rows = cut_lineage(series.select(*keys, F.col(month).alias("month"), F.col(value).cast("double").alias("y")))
    t = month_index("month") - F.lit(1990 * 12.0)
    y = F.col("y")
    cells = rows.groupBy(*keys, F.month("month").alias("_moy")).agg(
        F.count(F.when(t.isNotNull(), y)).alias("n"), F.max("month").alias("last"), F.regr_avgx(y, t).alias("tx"), F.regr_avgy(y, t).alias("ty"),
        F.regr_sxx(y, t).alias("sxx"), F.regr_sxy(y, t).alias("sxy"), F.regr_syy(y, t).alias("syy"))
    level = F.struct("n", "tx", "ty")
    fit = cells.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("last").alias("last_month"), F.sum("sxx").alias("sxx"), F.sum("sxy").alias("sxy"), F.sum("syy").alias("syy"),
        F.count_if(F.col("n") >= 2).alias("_full"), F.map_from_entries(F.collect_list(F.when(F.col("_moy").isNotNull(), F.struct("_moy", level)))).alias("_levels"))
    fit = fit.filter((F.col("n") >= min_season) & (F.col("_full") == 12) & (F.col("sxx") > 0))
    ahead = fit.withColumn("ds", F.explode(F.transform(F.sequence(F.lit(1), F.lit(months)), lambda k: F.add_months("last_month", k))))
    at = ahead.withColumn("_at", F.element_at("_levels", F.month("ds")))
    gap = month_index("ds") - F.lit(1990 * 12.0) - F.col("_at.tx")
    point = F.col("_at.ty") + F.col("sxy") / F.col("sxx") * gap
    rest = F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0))
    spread = F.sqrt(F.try_divide(rest, F.col("n") - 13)) * F.sqrt(1 + F.lit(1.0) / F.col("_at.n") + gap * gap / F.col("sxx"))
    season = at.select(*keys, "ds", *[F.round(e, 0).alias(n) for n, e in (
        ("y_forecast", point), ("y_lower", point - BAND_SIGMAS * spread), ("y_upper", point + BAND_SIGMAS * spread))],
        F.lit("ok").alias("status"), F.lit("season").alias("model"))
    known = fit.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))
    line = forecast(rows.join(known, same, "left_anti"), keys, months, min_history=min_history).withColumn("model", F.lit("line"))
    return season.unionByName(line)


def forecast_compare(versions: DataFrame, actuals: DataFrame, keys: Sequence[str], history: DataFrame,
                     min_history: int = 6) -> DataFrame:
    """Bias and absolute error of each forecast version per series.

    ``versions`` has version, keys, ds, y_forecast; ``actuals`` keys, ds, y; ``history`` keys, n.
    """
    rows = versions.join(actuals, [*keys, "ds"])
    err = F.col("y_forecast").cast("double") - F.col("y").cast("double")
    scored = rows.groupBy("version", *keys).agg(
        F.count(F.lit(1)).alias("months"),
        F.round(F.avg(err), 0).alias("bias"),
        F.round(F.avg(F.abs(err)), 0).alias("mae"),
        F.round(ratio(F.sum(F.abs(err)), F.sum(F.abs(F.col("y").cast("double")))) * 100, 1).alias("wape_pct"),
    )
    joined = scored.join(history.select(*keys, "n"), list(keys))
    short = F.col("n") < min_history
    return joined.select(
        "version", *keys, "months",
        *[F.when(~short, F.col(c)).alias(c) for c in ("bias", "mae", "wape_pct")],
        F.when(short, "too_short").otherwise("ok").alias("verdict"),
    )


def forecast_override(forecasts: DataFrame, assumptions: DataFrame, keys: Sequence[str], requested_by: str) -> DataFrame:
    """Staged overrides: the adjusted forecast with its reason, as proposed actions; nothing is applied."""
    adjusted = F.round(F.col("y_forecast") * (1 + F.col("change_pct") / 100), 0)
    rows = forecasts.filter(F.col("status") == "ok").join(assumptions, list(keys)).withColumn("y_override", adjusted)
    return rows.select(
        *keys, "ds", "y_forecast", "y_override", "rationale",
        F.lit("forecast_override").alias("action_type"), F.lit("proposed").alias("action_status"),
        F.lit(requested_by).alias("requested_by"),
    )
