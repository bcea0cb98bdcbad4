"""Forecasts as a table-valued function: ``SELECT * FROM forecast_table(TABLE(...) PARTITION BY ..., ...)``."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import DateType, DoubleType, NumericType, StringType, StructField, StructType, TimestampNTZType, TimestampType
from pyspark.sql.udtf import UserDefinedTableFunction

from ..operators.forecast import BAND_SIGMAS

#: Rows of one series at most, unless the call says otherwise: two thousand years of days.
MOST_ROWS = 730_000


@dataclass
class Call(AnalyzeResult):
    """What the planning step hands to the tasks."""

    keys: tuple = ()
    time_col: str = ""
    value_col: str = ""
    months: int = 3
    min_history: int = 6
    most_rows: int = MOST_ROWS


def _constant(name: str, arg: AnalyzeArgument | None, kind: type, default=None):
    if arg is None:
        if default is None:
            raise ValueError(f"forecast_table needs {name}")
        return default
    if not arg.isConstantExpression or not isinstance(arg.value, kind):
        raise ValueError(f"forecast_table: {name} must be a constant {kind.__name__}")
    return arg.value


def _months_on(day: date, n: int) -> date:
    """The same day of a later month, or the last one that month has."""
    at = day.year * 12 + day.month - 1 + n
    year, month = at // 12, at % 12 + 1
    last = (date(year + month // 12, month % 12 + 1, 1) - date(year, month, 1)).days
    return date(year, month, min(day.day, last))


class ForecastTable:
    """A straight line with a band per partition; the same numbers as :func:`ledgerloom.operators.forecast.forecast`.

    Called with a table, the names of its time and value columns, and optionally ``months`` ahead (3), ``min_history`` (6) and
    ``most_rows``. All other columns of the table are the key of a series and have to be the ``PARTITION BY`` of the call; the
    planning step names them in the result, followed by ``ds``, ``y_forecast``, ``y_lower``, ``y_upper`` and ``status``. A table
    of time and value alone is one series.

    A partition is read row by row into six running moments, so no series is held. It is still one task's work, so a series
    of more than ``most_rows`` is refused: it should be aggregated first, which Spark does in parallel. Rows of several
    keys in one partition are refused too. A null value takes no part, a null time only counts as a row without a value.
    """

    @staticmethod
    def analyze(
        rows: AnalyzeArgument, time_col: AnalyzeArgument | None = None, value_col: AnalyzeArgument | None = None, months: AnalyzeArgument | None = None,
        min_history: AnalyzeArgument | None = None, most_rows: AnalyzeArgument | None = None,
    ) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("forecast_table needs a table: TABLE(...)")
        fields = {f.name: f for f in rows.dataType.fields}
        time, value = _constant("time_col", time_col, str), _constant("value_col", value_col, str)
        for name, kinds in ((time, (DateType, TimestampType, TimestampNTZType)), (value, (NumericType,))):
            if name not in fields:
                raise ValueError(f"forecast_table: the table has no column {name!r}, only {sorted(fields)}")
            if not isinstance(fields[name].dataType, kinds):
                raise ValueError(f"forecast_table: column {name!r} cannot be {fields[name].dataType.simpleString()}")
        keys = tuple(n for n in fields if n not in (time, value))
        shown = [StructField("ds", DateType()), *(StructField(n, DoubleType()) for n in ("y_forecast", "y_lower", "y_upper")), StructField("status", StringType())]
        clash = {f.name for f in shown} & set(keys)
        if clash:
            raise ValueError(f"forecast_table: a key cannot be called {sorted(clash)}")
        return Call(
            schema=StructType([*(StructField(n, fields[n].dataType) for n in keys), *shown]), withSinglePartition=not keys, keys=keys,
            time_col=time, value_col=value, months=_constant("months", months, int, 3), min_history=_constant("min_history", min_history, int, 6),
            most_rows=_constant("most_rows", most_rows, int, MOST_ROWS))

    def __init__(self, call: Call) -> None:
        self.call, self.key, self.last, self.seen, self.n = call, None, None, 0, 0
        self.t = self.y = self.tt = self.ty = self.yy = 0.0  # means, and sums of products around them

    def eval(self, rows, time_col=None, value_col=None, months=None, min_history=None, most_rows=None) -> Iterator[tuple]:
        row = rows  # of the table, one at a time
        key = tuple(row[k] for k in self.call.keys)
        if self.seen and key != self.key:
            raise ValueError(f"forecast_table: {self.key} and {key} are in one partition; PARTITION BY {', '.join(self.call.keys)}")
        self.key, self.seen = key, self.seen + 1
        if self.seen > self.call.most_rows:
            raise ValueError(f"forecast_table: series {key} has more than {self.call.most_rows} rows; aggregate it first or raise most_rows")
        day, value = row[self.call.time_col], row[self.call.value_col]
        if day is not None:
            self.last = day if self.last is None else max(self.last, day)
            if value is not None:
                self._add((day.year - 1990) * 12 + day.month, float(value))
        return iter(())

    def _add(self, t: float, y: float) -> None:
        self.n += 1
        dt, dy = t - self.t, y - self.y
        self.t += dt / self.n
        self.y += dy / self.n
        self.tt += dt * (t - self.t)
        self.yy += dy * (y - self.y)
        self.ty += dt * (y - self.y)

    def terminate(self) -> Iterator[tuple]:
        if not self.seen:
            return
        if self.n < self.call.min_history or self.last is None:
            yield (*self.key, None, None, None, None, "too_short")
            return
        slope = self.ty / self.tt if self.tt else None
        rest = max(self.yy - (self.ty * self.ty / self.tt if self.tt else 0.0), 0.0)
        sigma = (rest / (self.n - 2)) ** 0.5 if self.n > 2 else None
        last = date(self.last.year, self.last.month, self.last.day)
        for step in range(1, self.call.months + 1):
            ds = _months_on(last, step)
            shown: tuple = (None, None, None)
            if slope is not None:
                t = (ds.year - 1990) * 12 + ds.month
                point = self.y + slope * (t - self.t)
                spread = None if sigma is None else BAND_SIGMAS * sigma * (1 + 1 / self.n + (t - self.t) ** 2 / self.tt) ** 0.5
                shown = (_rounded(point), *(None if spread is None else _rounded(point + s * spread) for s in (-1, 1)))
            yield (*self.key, ds, *shown, "ok")


def _rounded(x: float) -> float:
    """Half away from zero, as SQL rounds."""
    return float(int(x + 0.5)) if x >= 0 else float(-int(-x + 0.5))


def register_forecast_table(spark: SparkSession, name: str = "forecast_table") -> UserDefinedTableFunction:
    """Make :class:`ForecastTable` callable from SQL text under a name; rows travel in Arrow batches."""
    made = udtf(ForecastTable, useArrow=True)
    spark.udtf.register(name, made)
    return made
