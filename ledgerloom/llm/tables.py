"""Shared pieces of the operators: inputs, stored intermediate tables, a stable order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_folder

__all__ = ["cut_lineage", "shared_folder", "read", "text_of", "held_out"]


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id", folds: int = 5) -> Column:
    """Whether labels of this row are kept from training: the remainder of the id's checksum is 0. A null id is held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == 0, F.lit(True))
