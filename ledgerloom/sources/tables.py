"""The input tables and the month helpers that keep date filters on the Parquet scan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: First and last month; None leaves that end open.
Months = tuple[date | None, date | None]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One input table, with the schema and files it has now."""
    return spark.read.parquet(f"{root}/{name}.parquet")


#: Bytes up to which a counted side is broadcast.
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a join side whose rows were counted if they take few bytes; otherwise leave it to a shuffle join.

    Without column statistics Spark takes the product of both inputs for the size of a join result,
    so it would never broadcast one, and might broadcast the fact side instead.
    """
    width = sum(32 if f.dataType.typeName() in ("string", "binary") else 8 for f in df.schema.fields) + 16
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def read_spread(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An input table for heavy per-row work: one partition per core if its scan has fewer splits.

    Files of a cluster-sized table have far more splits than cores; there this changes nothing.
    """
    df = read_table(spark, root, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def month_of(col: Column | str) -> Column:
    """First day of the month as DATE, whatever date or timestamp type the column has."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trunc(c.cast("date"), "MM")


def next_month(d: date) -> date:
    return date(d.year + d.month // 12, d.month % 12 + 1, 1)


def in_months(df: DataFrame, column: str, months: Months | None) -> DataFrame:
    """Keep rows of the inclusive month range, written on the raw column; None is an open end.

    A filter on the derived month cannot use Parquet min/max statistics; the raw range can.
    """
    if months is None:
        return df
    lo, hi = months
    if lo is not None:
        df = df.filter(F.col(column) >= F.lit(lo))
    return df if hi is None else df.filter(F.col(column) < F.lit(next_month(hi)))
