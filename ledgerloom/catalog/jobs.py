"""Streaming jobs, run once over everything that is available."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import documents as D
from ..session import cut_lineage
from ..sources import io as IO
from ..sources import keyed_table as KT
from ..sources.star import Star
from ..sources.tables import month_of
from ..streaming import jobs as S
from ..streaming import proposals as P
from .documents import CHUNKS_SQL
from .registry import Registry

REG = Registry()


@REG.add("sink_cdf", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(star):
    base = IO.scratch_path(star.spark, "copied")
    stream = S.file_stream(star.spark, star.root, "orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    for _ in range(2):  # the second run finds nothing new
        S.incremental_copy(stream, f"{base}/table", f"{base}/checkpoint")
    return star.spark.read.parquet(f"{base}/table")


@REG.add("stream_chunks", sql="SELECT chunk_id, doc_id, seq, chunk_text FROM chunks", extra=CHUNKS_SQL)
def _(star):
    base = IO.scratch_path(star.spark, "chunked")
    docs = S.file_stream(star.spark, star.root, "documents.parquet")
    S.stream_chunks(docs, f"{base}/table", f"{base}/checkpoint")
    return S.current_chunks(star.spark, f"{base}/table")


#: Three states of a table: what is new in the second, what it changes, and what the third no longer has.
FEED_SQL = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
    FROM orders WHERE o_orderkey % 7 <> 0"""


@REG.add("sink_cdf_merge", sql=FEED_SQL)
def _(star):
    base = IO.scratch_path(star.spark, "fed")
    rows = star.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    changed = rows.withColumn("o_orderstatus", F.when(key % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    states = [rows.limit(0), rows.filter(key % 3 != 0), changed, changed.filter(key % 7 != 0)]
    table = KT.KeyedTable(star.spark, f"{base}/table", ("o_orderkey",), 8).create(rows.limit(0).withColumn(KT.VERSION, F.lit(0).cast("bigint")))
    for n in (1, 2, 3):
        KT.write_feed(KT.changes_between(states[n - 1], states[n], table.keys, n), f"{base}/feed")
        S.follow_feed(S.file_stream(star.spark, f"{base}/feed"), table.apply, f"{base}/checkpoint")
    return table.read().drop(KT.VERSION)


@REG.add("stream_chunk_feed", sql="SELECT chunk_id, doc_id, seq, chunk_text FROM chunks", extra=CHUNKS_SQL.replace(
    "FROM documents)", "FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'revised ' || text ELSE text END AS text FROM documents WHERE doc_id % 7 <> 0))"))
def _(star):
    base = IO.scratch_path(star.spark, "chunk_feed")
    docs, key = star.table("documents").select("doc_id", "text"), F.col("doc_id")
    revised = docs.withColumn("text", F.when(key % 5 == 0, F.concat(F.lit("revised "), F.col("text"))).otherwise(F.col("text")))
    states = [docs.limit(0), docs, revised, revised.filter(key % 7 != 0)]
    table = KT.KeyedTable(star.spark, f"{base}/table", ("doc_id",), 8).create(D.doc_chunk(docs.limit(0)))
    for n in (1, 2, 3):
        KT.write_feed(KT.changes_between(states[n - 1], states[n], table.keys, n), f"{base}/feed")
        S.follow_feed(S.file_stream(star.spark, f"{base}/feed"), S.chunk_changes(table), f"{base}/checkpoint")
    return table.read()


#: Rows of a stream that one task joins.
TASK_ROWS = 500_000


def _with_region(star: Star, rows: DataFrame, table: str, key: str) -> DataFrame:
    """Rows of the stream of a table with the static region of their order.

    A streaming join is not sized while it runs, and its session's number of partitions is that of the small state: so the
    table's rows give the number of its tasks. The regions are stored once, by a batch job that is sized.
    """
    tasks = max(STATE_PARTITIONS, -(-star.rows(table) // TASK_ROWS))
    regions = cut_lineage(star.order_region().select(F.col("o_orderkey").alias("_order"), "region"))
    return rows.repartition(tasks, key).join(regions.repartition(tasks, "_order"), F.col(key) == F.col("_order")).drop("_order")


def _lane_stream(star: Star):
    """Line items as a stream, joined to the static region of their order."""
    lines = S.file_stream(star.spark, star.root, "lineitem.parquet").select("l_orderkey", "l_suppkey", "l_shipdate", "l_linestatus", "l_returnflag")
    joined = _with_region(star, lines, "lineitem", "l_orderkey")
    plant = F.concat(F.lit("P"), (F.col("l_suppkey") % 6).cast("string"))
    return joined.select(F.concat(plant, F.lit("->"), F.col("region")).alias("lane"), "region", month_of("l_shipdate").alias("month"),
                         "l_linestatus", "l_returnflag")


#: Thirty lanes by some hundred months.
STATE_PARTITIONS = 8
LANES_SQL = """lanes_seen AS (
        SELECT 'P' || CAST(plant_no AS VARCHAR) || '->' || region AS lane, month, COUNT(*) AS orders,
               ROUND(COUNT(*) FILTER (l_linestatus = 'F' AND l_returnflag <> 'R') / CAST(COUNT(*) AS DOUBLE) * 100, 1) AS otif_pct
        FROM plant_lines GROUP BY plant_no, region, month),
    open_lanes AS (SELECT lane || '|' || CAST(month AS VARCHAR) AS breach_key, otif_pct, orders FROM lanes_seen WHERE otif_pct < 20)"""


@REG.add("stream_detect", "plant_lines", "SELECT breach_key, otif_pct, orders FROM open_lanes", extra=LANES_SQL)
def _(star):
    base = IO.scratch_path(star.spark, "detected")
    for _ in range(2):  # a second job over the same input raises nothing again
        P.stream_proposals(_lane_stream(star), f"{base}/log", f"{base}/checkpoint", 20.0, partitions=STATE_PARTITIONS)
    return P.open_proposals(star.spark, f"{base}/log").select("breach_key", "otif_pct", "orders")


def _handling(star: Star):
    """Actions on breaches as a stream: urgent orders act on a lane of their customer's region in the month they are placed."""
    placed = S.file_stream(star.spark, star.root, "orders.parquet").filter(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", "o_orderstatus", "o_orderdate")
    lane = F.concat(F.lit("P"), (F.col("o_orderkey") % 6).cast("string"), F.lit("->"), F.col("region"))
    status = F.when(F.col("o_orderstatus") == "F", "executed").when(F.col("o_orderstatus") == "P", "escalated").otherwise("rejected")
    return _with_region(star, placed, "orders", "o_orderkey").select(
        F.concat_ws("|", lane, month_of("o_orderdate").cast("string")).alias("breach_key"), status.alias("status"), F.col("o_orderkey").alias("seq"))


@REG.add("stream_handled", "plant_lines order_region", """
    SELECT breach_key, otif_pct, orders FROM open_lanes LEFT JOIN handled USING (breach_key) WHERE status IS NULL OR status = 'rejected'""",
         extra=LANES_SQL + """,
    handled AS (
        SELECT 'P' || CAST(o.o_orderkey % 6 AS VARCHAR) || '->' || region || '|' || CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS breach_key,
               arg_max(CASE o_orderstatus WHEN 'F' THEN 'executed' WHEN 'P' THEN 'escalated' ELSE 'rejected' END, o.o_orderkey) AS status
        FROM orders o JOIN order_region r ON r.o_orderkey = o.o_orderkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1)""")
def _(star):
    base = IO.scratch_path(star.spark, "handled")
    P.stream_proposals(_lane_stream(star), f"{base}/log", f"{base}/checkpoint", 20.0, _handling(star), partitions=STATE_PARTITIONS)
    return P.open_proposals(star.spark, f"{base}/log").select("breach_key", "otif_pct", "orders")
