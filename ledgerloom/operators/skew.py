"""Joins on keys of which one may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys that hold at least ``share`` of the rows: never more than 1/share of them, whatever the data."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("_n") >= total * F.lit(share)).select(*keys)


def salted_join(big: DataFrame, side: DataFrame, keys: Sequence[str], share: float = 0.001, parts: int | None = None) -> DataFrame:
    """Inner join whose hot keys are spread over ``parts`` tasks.

    Adaptive execution splits a hot join key by itself, but not when the rows are then grouped by the
    same key without a further shuffle. Rows of hot keys get a salt from their content, and only the
    few matching rows of the other side are repeated per salt. A later grouping by the key then merges
    partial results of all the parts.
    """
    n = parts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At most 1/share rows, so the broadcast is bounded by the parameter.
    hot = F.broadcast(hot_keys(big, keys, share).withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*big.columns), F.lit(n)).cast("int")).otherwise(0)
    left = big.join(hot, list(keys), "left").withColumn("_salt", salt).drop("_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    right = side.join(hot, list(keys), "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return left.join(right, [*keys, "_salt"]).drop("_salt")
