"""Conversation memory."""

from pyspark.sql import functions as F

from ..operators import memory as X
from ..sources import io as IO
from ..sources.keyed_table import KeyedTable
from .registry import Registry

REG = Registry()


@REG.add("thread_history", sql="SELECT conv_id, turn, role, text FROM conversations")
def _(star):
    return X.thread_history(star.table("conversations")).select("conv_id", "turn", "role", "text")


@REG.add("thread_history_one", sql="SELECT conv_id, turn, role, text FROM conversations WHERE conv_id = 7")
def _(star):
    turns = star.table("conversations").select("conv_id", "turn", "role", "text")
    table = KeyedTable(star.spark, IO.scratch_path(star.spark, "threads"), ("conv_id",), 8).create(turns)
    return X.thread_history(table.of(conv_id=7))


APPEND_SQL = """
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL
    SELECT n.conv_id, n.nt + (n.nth - 1) * 2 + r.i, CASE r.i WHEN 0 THEN 'user' ELSE 'assistant' END, CASE r.i WHEN 0 THEN 'About: ' || n.text ELSE 'Noted.' END
    FROM (SELECT c.conv_id, c.text, m.nt, ROW_NUMBER() OVER (PARTITION BY c.conv_id ORDER BY c.turn) AS nth
          FROM conversations c JOIN (SELECT conv_id, MAX(turn) + 1 AS nt FROM conversations GROUP BY 1) m ON m.conv_id = c.conv_id
          WHERE c.role = 'user') n, (VALUES (0), (1)) r(i)"""


def _exchanges(turns):
    return turns.filter(F.col("role") == "user").select(
        "conv_id", F.col("turn").alias("seq"), F.concat(F.lit("About: "), F.col("text")).alias("question"), F.lit("Noted.").alias("answer"))


@REG.add("thread_append", sql=APPEND_SQL)
def _(star):
    turns = star.table("conversations")
    return X.thread_append(turns, _exchanges(turns))


@REG.add("thread_append_stored", sql=APPEND_SQL)
def _(star):
    turns = star.table("conversations").select("conv_id", "turn", "role", "text")
    # the store of turns and the new exchanges lie in buckets of the thread: appending moves nothing
    return X.thread_append(IO.bucketed(turns, ("conv_id",), 8), IO.bucketed(_exchanges(turns), ("conv_id",), 8))
