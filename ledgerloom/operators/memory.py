"""Conversation memory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import with_row_number


def thread_history(turns: DataFrame, thread: str = "conv_id", only=None) -> DataFrame:
    """Turns in order, one thread or all of them; a thread never sees another thread's turns."""
    rows = turns if only is None else turns.filter(F.col(thread) == only)
    return rows.orderBy(thread, "turn")


def next_turn(turns: DataFrame, thread: str = "conv_id") -> DataFrame:
    return turns.groupBy(thread).agg((F.max("turn") + 1).alias("next_turn"))


def thread_append(turns: DataFrame, exchanges: DataFrame, thread: str = "conv_id") -> DataFrame:
    """Add question and answer of each exchange as two turns after the last one of the thread.

    ``exchanges`` has the thread, ``seq`` (order inside the thread), ``question`` and ``answer``. Both
    turns of an exchange are rows of the same result, so one cannot be stored without the other.
    """
    numbered = with_row_number(exchanges, (thread,), ("seq",), "_nth")
    start = F.coalesce(F.col("next_turn"), F.lit(0)) + (F.col("_nth") - 1) * 2
    based = numbered.join(next_turn(turns, thread), thread, "left").withColumn("_start", start)
    added = based.select(thread, F.inline(F.array(
        F.struct(F.col("_start").alias("turn"), F.lit("user").alias("role"), F.col("question").alias("text")),
        F.struct((F.col("_start") + 1).alias("turn"), F.lit("assistant").alias("role"), F.col("answer").alias("text")),
    )))
    return turns.select(thread, "turn", "role", "text").unionByName(added)
