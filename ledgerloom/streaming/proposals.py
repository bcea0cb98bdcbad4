"""Proposals of the detection loop, kept by a keyed state: raised once, revised, withdrawn, and closed when handled."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import ratio
from .jobs import batch_writer, run_available

#: An action in one of these states handles its breach; rejected and failed ones leave it open again.
LIVE = ("proposed", "approved", "executing", "executed", "escalated")
#: Lane months whose totals a task holds before it hands them on; bounds its memory where there are very many.
HELD_TOTALS = 50_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ROW = "lane string, region string, month date, orders bigint, perfect bigint, status string, seq bigint"
_STATE = "region string, orders bigint, perfect bigint, status string, seq bigint, open boolean"
_DECISION = "lane string, month date, region string, orders bigint, perfect bigint, decision string"


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of each task, so that a few rows per lane month and task move instead of all lines."""
    by, held = ["lane", "region", "month"], None

    def shown(sums: pa.Table) -> pa.RecordBatch:
        return pa.record_batch({
            **{c: sums[c].combine_chunks() for c in (*by, "orders", "perfect")},
            "status": pa.nulls(sums.num_rows, pa.string()), "seq": pa.nulls(sums.num_rows, pa.int64()),
        })

    for batch in batches:
        if batch.num_rows:
            lines = pa.table({**{c: batch.column(c) for c in by}, "orders": np.ones(batch.num_rows, np.int64), "perfect": batch.column("perfect")})
            sums = (lines if held is None else pa.concat_tables([held, lines])).group_by(by).aggregate([("orders", "sum"), ("perfect", "sum")])
            held = pa.table({**{c: sums[c] for c in by}, "orders": sums["orders_sum"], "perfect": sums["perfect_sum"]})
            if held.num_rows > HELD_TOTALS:
                yield shown(held)
                held = None
    if held is not None:
        yield shown(held)


def line_totals(lines: DataFrame) -> DataFrame:
    """Partial totals of a stream of lines (``lane``, ``region``, ``month``, ``l_linestatus``, ``l_returnflag``)."""
    perfect = F.coalesce((F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "R"), F.lit(False))
    return lines.select("lane", "region", "month", perfect.cast("bigint").alias("perfect")).mapInArrow(_add_up, _ROW)


def action_events(actions: DataFrame) -> DataFrame:
    """A stream of actions (``breach_key``, ``status``, ``seq``) as rows of the same shape; other keys are left out."""
    key = F.col("breach_key")
    return actions.select(
        F.substring_index(key, "|", 1).alias("lane"), F.lit(None).cast("string").alias("region"),
        F.try_to_date(F.substring_index(key, "|", -1), "yyyy-MM-dd").alias("month"), F.lit(None).cast("bigint").alias("orders"),
        F.lit(None).cast("bigint").alias("perfect"), F.col("status").alias("status"), F.col("seq").cast("bigint").alias("seq"),
    ).filter("lane IS NOT NULL AND month IS NOT NULL AND seq IS NOT NULL AND status IS NOT NULL")


def share(perfect: int, orders: int) -> float | None:
    """Perfect orders in percent with one decimal, rounded as SQL does."""
    return float(Decimal(repr(perfect / orders * 100)).quantize(Decimal("0.1"), ROUND_HALF_UP)) if orders else None


class LaneMonths(StatefulProcessor):
    """The state of one lane and month: running totals, the latest action on it, and whether a proposal is open.

    A batch changes a key once, whatever its rows: totals add up and the action with the highest ``seq`` counts. So the open
    proposals depend on what has arrived and not on how it was cut into batches.
    """

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("lane_month", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        region, orders, perfect, status, seq, was_open = self.held.get() or (None, 0, 0, None, None, False)
        before = orders, perfect
        for r in rows:
            if r.orders is not None:
                region, orders, perfect = region or r.region, orders + r.orders, perfect + r.perfect
            elif seq is None or r.seq >= seq:
                status, seq = r.status, r.seq
        found = share(perfect, orders)
        handled = status in LIVE
        opens = found is not None and found < self.threshold and not handled
        self.held.update((region, orders, perfect, status, seq, opens))
        said = "raised" if opens and not was_open else "revised" if opens and before != (orders, perfect) else None
        if was_open and not opens:
            said = "closed" if handled else "withdrawn"
        if said:
            yield Row(lane=key[0], month=key[1], region=region, orders=orders, perfect=perfect, decision=said)

    def close(self) -> None:
        pass


@contextmanager
def _keyed_state(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """The state store that keyed state needs, and its number of partitions, for queries started inside."""
    wanted = {_PROVIDER: _ROCKSDB} | ({} if partitions is None else {"spark.sql.shuffle.partitions": str(partitions)})
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def stream_proposals(
    lines: DataFrame, target: str, checkpoint: str, threshold: float, actions: DataFrame | None = None, partitions: int | None = None,
) -> None:
    """Judge the lane months that new lines or actions touch, and store what changes about their proposals.

    ``lines`` is a stream of order lines, ``actions`` one of actions on breach keys (``lane|month``). A lane month whose share of
    perfect orders falls below the threshold is raised once, revised when its totals change, withdrawn when they rise to
    the threshold again, and closed when an action of a live status handles it; a handled one is never raised, unless its
    latest action was rejected or failed. Null lanes and months are a key of their own; lines of unknown status are not perfect.

    State is one small row per lane and month, dealt to ``partitions`` (the session's shuffle partitions; fixed by the first run,
    some thousand keys fit one), in the checkpoint, so a job that starts again goes on where it was. It grows with lanes and
    months, not with lines or actions. Only changes are written, in one folder per batch; a batch that is tried again replaces
    its own.
    """
    spark = lines.sparkSession
    rows = line_totals(lines)
    if actions is not None:
        rows = rows.unionByName(action_events(actions))
    decided = rows.groupBy("lane", "month").transformWithState(LaneMonths(threshold), _DECISION, "Update", "None")
    with _keyed_state(spark, partitions):
        run_available(decided, batch_writer(target, lambda b: b), checkpoint, mode="update")


def open_proposals(spark: SparkSession, target: str) -> DataFrame:
    """One proposed action per lane and month that is open, with its latest totals."""
    log = spark.read.schema(f"{_DECISION}, batch_id bigint").option("basePath", target).parquet(target)
    last = F.max_by(F.struct("region", "orders", "perfect", "decision"), "batch_id")
    latest = log.groupBy("lane", "month").agg(last.alias("last")).select("lane", "month", "last.*")
    return latest.filter(F.col("decision").isin("raised", "revised")).select(
        F.concat_ws("|", "lane", F.col("month").cast("string")).alias("breach_key"), "lane", "region", "month",
        F.round(ratio(F.col("perfect"), F.col("orders")) * 100, 1).alias("otif_pct"), "orders", F.lit("proposed").alias("status"))
