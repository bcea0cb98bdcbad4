"""Stored tables that change by key and rewrite only the folders of the keys that changed, and change feeds between them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType

from ..operators.keyed import update_where, upsert_latest
from ..session import cut_lineage
from .io import read_rows

BUCKET, LIVE, CHANGE, VERSION = "_bucket", "_live", "_change", "_version"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def same(a: str, b: str, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, (F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys))


def matching(rows: DataFrame, listed: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows whose key is listed (``left_semi``) or is not (``left_anti``); null keys are equal to each other."""
    return rows.alias("r").join(listed.alias("l"), same("r", "l", keys), how)


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table in one folder per bucket of its key; several rows may share a key.

    A change reads and rewrites the buckets of its keys and no others, by dynamic partition overwrite: new contents are
    written apart first, then swapped in, so a job that fails before that leaves the table as it was and can be run again.
    Every rewritten bucket also holds one dead row without values: a bucket whose last row goes is replaced too, and an empty
    table keeps its columns. ``buckets`` is fixed when the table is made; take rows enough for files of some 100 MB.
    One writer at a time.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def create(self, rows: DataFrame) -> KeyedTable:
        """Write a new table; the folder must not hold one."""
        marks = self.spark.range(self.buckets).select(F.col("id").cast("int").alias(BUCKET))
        self._laid(rows, marks).write.partitionBy(BUCKET).parquet(self.path)
        return self

    def _laid(self, rows: DataFrame, marks: DataFrame) -> DataFrame:
        live = rows.withColumns({LIVE: F.lit(True), BUCKET: self.bucket()})
        return live.unionByName(marks.withColumn(LIVE, F.lit(False)), allowMissingColumns=True).hint("rebalance", BUCKET)

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().filter(LIVE).drop(LIVE, BUCKET)

    def of(self, **key) -> DataFrame:
        """The rows of one key; reads one bucket, without a shuffle."""
        asked = read_rows(self.spark, [tuple(key[k] for k in self.keys)], ", ".join(f"`{k}` {self._stored().schema[k].dataType.simpleString()}" for k in self.keys))
        at = asked.select(self.bucket()).first()[0]
        hit = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.lit(key[k])) for k in self.keys))
        return self._stored().filter(F.col(BUCKET) == at).filter(LIVE).filter(hit).drop(LIVE, BUCKET)

    def _held(self, touched: list[int]) -> DataFrame:
        return self._stored().filter(F.col(BUCKET).isin(touched)).filter(LIVE).drop(LIVE, BUCKET)

    def _touched(self, listed: DataFrame, bucket: Column) -> list[int]:
        """Numbers of buckets, so at most ``buckets`` values reach the driver."""
        return sorted(r[0] for r in listed.select(bucket.alias(BUCKET)).distinct().collect())

    def _rewrite(self, touched: list[int], rows: DataFrame) -> None:
        if touched:
            marks = read_rows(self.spark, [(b,) for b in touched], f"{BUCKET} int")
            self._laid(rows, marks).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def replace(self, listed: DataFrame, rows: DataFrame) -> None:
        """Give the keys of ``listed`` the rows of ``rows`` instead of those they have; a key without rows is deleted."""
        listed = cut_lineage(listed.select(*self.keys).distinct())
        self.swap(listed, matching(rows, listed, self.keys, "left_semi"))

    def swap(self, listed: DataFrame, rows: DataFrame) -> None:
        """As ``replace``, for a caller whose ``rows`` have no other keys than ``listed``: they are not matched against it."""
        listed = cut_lineage(listed.select(*self.keys).distinct())
        touched = self._touched(listed, self.bucket())
        kept = matching(self._held(touched), listed, self.keys, "left_anti")
        self._rewrite(touched, kept.unionByName(rows.select(kept.columns)))

    def delete(self, listed: DataFrame) -> None:
        self.replace(listed, self.read().limit(0))

    def upsert_latest(self, changes: DataFrame, values: Sequence[str], seq: Sequence[str], created: str = "created_at", updated: str = "updated_at") -> None:
        """Last write wins per key, as in :func:`ledgerloom.operators.keyed.upsert_latest`, over the touched buckets."""
        changes = cut_lineage(changes.select(*self.keys, *[c for c in dict.fromkeys((*values, *seq, created, updated)) if c not in self.keys]))
        listed = changes.select(*self.keys).distinct()
        held = matching(self._held(self._touched(listed, self.bucket())), listed, self.keys, "left_semi")
        merged = upsert_latest(held.select(changes.columns), changes, self.keys, [c for c in dict.fromkeys((*values, *seq)) if c not in (created, updated)], seq, created, updated)
        self.replace(listed, merged)

    def update(self, condition: Column, changes: Mapping[str, Column]) -> None:
        """Set columns where a condition holds; buckets without such a row are not rewritten. Keys cannot be set."""
        if set(changes) & set(self.keys):
            raise ValueError(f"the key of a keyed table cannot be set: {sorted(set(changes) & set(self.keys))}")
        touched = self._touched(self._stored().filter(LIVE).filter(condition), F.col(BUCKET))
        self._rewrite(touched, update_where(self._held(touched), condition, changes))

    def apply(self, feed: DataFrame) -> None:
        """Bring the table up to date with feed rows: per key its last version counts; older than what is stored changes nothing."""
        last = F.max_by(F.struct(*[F.col(c) for c in feed.columns if c not in self.keys]), VERSION)
        latest = feed.groupBy(*self.keys).agg(last.alias("_last")).select(*self.keys, "_last.*")
        touched = self._touched(latest, self.bucket())
        known = self._held(touched).select(*self.keys, F.col(VERSION).alias("_known")).distinct()
        news = latest.alias("r").join(known.alias("l"), same("r", "l", self.keys), "left").filter(F.coalesce(F.col(VERSION) >= F.col("_known"), F.lit(True))).select("r.*")
        news = cut_lineage(news)
        self.swap(news, news.filter(F.col(CHANGE) != DELETE).drop(CHANGE))


def _short(value: Column, kind: DataType) -> Column:
    """What stands for a value where only equality counts: long texts and bytes by their SHA-256, which no kept value is as long as."""
    if kind not in (StringType(), BinaryType()):
        return value
    return F.when(F.octet_length(value) >= 32, F.unhex(F.sha2(value.cast("binary"), 256))).otherwise(value.cast("binary"))


def changes_between(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """The feed from one state of a table with unique keys to the next: rows of ``new`` that are inserted or updated, and the
    keys that are deleted, with their change and version. Equal rows are not in it. Of ``old`` no long values move."""
    others = [c for c in new.columns if c not in keys]
    both = F.struct(*[F.col(c) for c in others]) if others else F.lit(1)

    def short(value: Callable[[str], Column]) -> Column:
        return F.struct(*[_short(value(c), new.schema[c].dataType).alias(c) for c in others]) if others else F.lit(1)

    left = old.select(*keys, short(F.col).alias("_old"), F.lit(True).alias("_was")).alias("l")
    right = new.select(*keys, both.alias("_new"), F.lit(True).alias("_is")).alias("r")
    joined = left.join(right, same("l", "r", keys), "full")
    kind = F.when(F.col("_was").isNull(), INSERT).when(F.col("_is").isNull(), DELETE).when(~F.col("_old").eqNullSafe(short(F.col("_new").getField)), UPDATE)
    shown = [F.when(F.col("_is"), F.col(f"r.{k}")).otherwise(F.col(f"l.{k}")).alias(k) for k in keys]
    return joined.withColumn(CHANGE, kind).filter(F.col(CHANGE).isNotNull()).select(
        *shown, *[F.col("_new").getField(c).alias(c) for c in others], CHANGE, F.lit(version).cast("bigint").alias(VERSION))


def write_feed(feed: DataFrame, path: str) -> None:
    """Add rows to the feed's folder, as one commit of its own."""
    feed.write.mode("append").parquet(path)
