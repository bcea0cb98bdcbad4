"""Vector search, memory search and context."""

from pyspark.sql import functions as F

from ..operators import documents as X
from ..operators import vectors as V
from ..sources import io as IO
from ..sources.keyed_table import KeyedTable
from .registry import Registry

REG = Registry()

CENTER_SQL = """center AS (
    SELECT label, list(m ORDER BY pos) AS c FROM (
        SELECT label, pos, AVG(x) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) f
        GROUP BY 1, 2) g GROUP BY 1)"""
TOP_SQL = CENTER_SQL + """,
  scored AS (SELECT q.label AS query_id, e.vec_id AS id, e.label, list_cosine_similarity(e.embedding::DOUBLE[], q.c) AS score
             FROM center q, embeddings e),
  hits AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored)"""


def _queries(star):
    """One query per label: the mean of its vectors."""
    return V.centroids(star.table("embeddings"), "label").withColumn("query_id", F.col("label"))


def _hits(star, k):
    return V.vec_topk(star.table("embeddings"), _queries(star), k, id_col="vec_id")


@REG.add("vec_topk", sql="SELECT query_id, id, ROUND(score, 4) AS score, rank FROM hits WHERE rank <= 5", extra=TOP_SQL)
def _(star):
    return _hits(star, 5).withColumn("score", F.round("score", 4))


@REG.add("mem_search", sql="""
    SELECT query_id, id, ROUND(score, 3) AS similarity, rank FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored WHERE label = query_id) m
    WHERE rank <= 3""", extra=TOP_SQL.rsplit(",\n  hits", 1)[0])
def _(star):
    return V.mem_search(star.table("embeddings"), _queries(star), "label", "vec_id")


@REG.add("mem_search_one", sql="""
    SELECT query_id, id, ROUND(score, 3) AS similarity, rank FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored WHERE label = query_id AND label = 3) m
    WHERE rank <= 3""", extra=TOP_SQL.rsplit(",\n  hits", 1)[0])
def _(star):
    memories = star.table("embeddings").select("vec_id", "label", "embedding")
    table = KeyedTable(star.spark, IO.scratch_path(star.spark, "memories"), ("label",), 8).create(memories)
    return V.mem_search(table.of(label=3), _queries(star).filter(F.col("label") == 3), "label", "vec_id")


@REG.add("vec_dim_guard", sql="""
    SELECT label, CAST(MIN(len(embedding)) AS BIGINT) AS min_dim, CAST(MAX(len(embedding)) AS BIGINT) AS max_dim, COUNT(*) AS n,
           MIN(len(embedding)) = 64 AND MAX(len(embedding)) = 64 AS dims_ok FROM embeddings GROUP BY 1""")
def _(star):
    return V.vec_dim_guard(star.table("embeddings"), 64, by="label")


@REG.add("rag_context", sql="""
    SELECT query_id, string_agg('[' || CAST(h.id AS VARCHAR) || '] ' || d.text, chr(10) || chr(10) || '---' || chr(10) ORDER BY rank) AS context
    FROM hits h JOIN documents d ON d.doc_id = h.id WHERE rank <= 5 GROUP BY 1""", extra=TOP_SQL)
def _(star):
    return V.rag_context(_hits(star, 5), star.table("documents"), "doc_id", "text")


@REG.add("batch_answer", sql="""
    SELECT query_id, CASE WHEN score >= 0.9 THEN id END AS evidence_id, ROUND(score, 4) AS score,
           CASE WHEN score >= 0.9 THEN 'answered' ELSE 'not enough evidence' END AS answer_status FROM hits WHERE rank = 1""", extra=TOP_SQL)
def _(star):
    queries = _queries(star)
    return V.batch_answer(queries.select("query_id"), _hits(star, 1), 0.9)


@REG.add("batch_answer_text")
def _(star):
    questions = X.doc_embed(star.table("benchmark").select(F.col("item_id").alias("query_id"), "text"), "text")
    chunks = X.doc_embed(X.doc_chunk(star.heavy("documents")))
    hits = V.vec_topk(chunks, questions, 1, id_col="chunk_id")
    return V.batch_answer(questions.select("query_id"), hits, 0.8)
