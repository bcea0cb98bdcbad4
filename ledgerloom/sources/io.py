"""Readers and writers. Tables on a cluster go to the catalog or to a shared path the caller names."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..session import shared_folder

_NAME = re.compile(r"[A-Za-z0-9_]+")


def ident_check(name: str) -> str:
    """A name that may be put into SQL text: letters, digits and underscores only."""
    if not _NAME.fullmatch(name or ""):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", glob: str | None = None) -> DataFrame:
    """All files of one format; ``binaryFile`` gives path and content."""
    reader = spark.read.format("binaryFile" if fmt in ("binary", "binaryFile") else fmt)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def read_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal configuration rows (policies, prices, personas) with an explicit schema.

    They go in as one Arrow table, so the optimizer knows their exact size and broadcasts them by its
    own threshold; rows handed over as a Python list would have no known size.
    """
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) or [()] * len(arrow)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, struct)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 32) -> DataFrame:
    """Table of a relational database; with a numeric column and bounds it is read in parallel ranges."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    lo, hi = bounds
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lo, upperBound=hi,
                           numPartitions=partitions, properties=properties)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder of the session; a local one only for local sessions."""
    return f"{shared_folder(spark)}/{ident_check(name)}-{uuid4().hex}"



def write_path(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write Parquet and return the stored table. Used for create-as-select, append and overwrite."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def empty_path(spark: SparkSession, path: str) -> DataFrame:
    """Delete all rows and keep the schema."""
    schema = spark.read.parquet(path).schema
    return write_path(spark.createDataFrame([], schema), path)


def save_table(df: DataFrame, table: str, mode: str = "overwrite", bucket_by: Sequence[str] = (), buckets: int = 0) -> None:
    """Managed table; bucketing on a join key lets later joins on it run without a shuffle."""
    writer = df.write.mode(mode)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(table)


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a frame in buckets of a key, in the shared folder, as a table of the session's catalog.

    Frames stored with the same key type and number of buckets are joined, grouped and numbered by that key without an
    exchange. A hot key makes a large bucket: take keys that are spread, such as threads or users.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid4().hex}"
    df.write.format("parquet").option("path", scratch_path(spark, "bucketed")).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def load_star(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]], save: bool = False,
              schema: str | None = None) -> list[tuple[str, str, str | None]]:
    """Register every table and report ``(name, status, error)``; one bad table does not stop the rest."""
    report = []
    for name, build in tables.items():
        full = f"{ident_check(schema)}.{ident_check(name)}" if schema else ident_check(name)
        try:
            df = build()
            if save:
                save_table(df, full)
            else:
                df.createOrReplaceTempView(name)
            report.append((name, "loaded", None))
        except AnalysisException as e:
            report.append((name, "failed", str(e).splitlines()[0]))
    return report


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, counted in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def list_tables(spark: SparkSession, schema: str | None = None) -> list[str]:
    return sorted(t.name for t in (spark.catalog.listTables(schema) if schema else spark.catalog.listTables()))
