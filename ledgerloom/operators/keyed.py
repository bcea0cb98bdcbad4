"""Keyed-table changes as DataFrame transformations: upsert, update, delete, numbering of receipts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import with_row_number


def upsert_latest(existing: DataFrame, changes: DataFrame, keys: Sequence[str], values: Sequence[str],
                  seq: Sequence[str], created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """Last write wins per key; the first creation and the latest update time are kept."""
    log = existing.unionByName(changes)
    last = F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(s) for s in seq]))
    return log.groupBy(*keys).agg(
        last.alias("_v"), F.min(created).alias(created), F.max(updated).alias(updated)
    ).select(*keys, "_v.*", created, updated)


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition; a NULL condition changes nothing."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in changes.items()})


def delete_by_key(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the rows whose key is listed."""
    return df.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def receipt_log(outbox: DataFrame, prefixes: Mapping[str, str], order: Sequence[str], system: str = "system") -> DataFrame:
    """Number the receipts in arrival order and stamp ``PREFIX-0001`` reference ids.

    A system without a prefix gets ``REF``. Numbers beyond 9999 keep all their digits.
    """
    numbered = with_row_number(outbox, [], order, "log_id")
    prefix = None
    for name, text in prefixes.items():
        hit = F.col(system) == name
        prefix = F.when(hit, text) if prefix is None else prefix.when(hit, text)
    prefix = F.lit("REF") if prefix is None else prefix.otherwise("REF")
    return numbered.withColumn("ref_id", F.format_string("%s-%04d", prefix, F.col("log_id")))
