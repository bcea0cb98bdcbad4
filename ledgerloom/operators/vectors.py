"""Exact nearest vectors by cosine, dimension checks and context building."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

MAX_SHIPPED_QUERIES = 1024
ROWS_PER_BLOCK = 200_000


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


class _Best:
    """Running top-k of each query over batches of candidates; equal scores go to the lower id."""

    def __init__(self, qids: list, qvecs: np.ndarray, qscopes: list | None, k: int) -> None:
        self.qids, self.k = qids, k
        self.q = _unit(qvecs)
        self.scopes = None if qscopes is None else np.asarray(qscopes, dtype=object)
        self.best = [(np.empty(0), np.empty(0, dtype=object)) for _ in qids]

    def add(self, ids: np.ndarray, vecs: np.ndarray, scopes: np.ndarray | None) -> None:
        if not len(ids):
            return
        if vecs.shape[1] != self.q.shape[1]:
            raise ValueError(f"vectors have {vecs.shape[1]} dimensions, queries {self.q.shape[1]}")
        if self.scopes is None:
            groups = [(np.arange(len(self.qids)), np.arange(len(ids)))]
        else:
            present = set(scopes.tolist())
            groups = [
                (np.flatnonzero(self.scopes == s), np.flatnonzero(scopes == s)) for s in set(self.scopes.tolist()) & present
            ]
        for qi, ci in groups:
            scores = _unit(vecs[ci]) @ self.q[qi].T
            chosen = ids[ci]
            for col, q in enumerate(qi):
                s = scores[:, col]
                if len(s) > self.k:
                    keep = np.flatnonzero(s >= np.partition(s, len(s) - self.k)[len(s) - self.k])
                else:
                    keep = np.arange(len(s))
                all_s = np.concatenate([self.best[q][0], s[keep]])
                all_i = np.concatenate([self.best[q][1], chosen[keep]])
                order = sorted(range(len(all_s)), key=lambda i: (-all_s[i], all_i[i]))[: self.k]
                self.best[q] = all_s[order], all_i[order]

    def rows(self) -> tuple[list, list, list]:
        out: tuple[list, list, list] = ([], [], [])
        for q, (scores, ids) in zip(self.qids, self.best):
            out[0].extend([q] * len(ids))
            out[1].extend(ids.tolist())
            out[2].extend(scores.tolist())
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as one matrix; they must all have the same length."""
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    if len(set(lengths.tolist())) > 1:
        raise ValueError("vectors of different dimensions")
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _final(partial: DataFrame, k: int) -> DataFrame:
    """At most k rows per query and task arrive here; the window keeps k of them before it shuffles."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return partial.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def vec_topk(candidates: DataFrame, queries: DataFrame, k: int, id_col: str = "id", query_id: str = "query_id",
             vector: str = "embedding", scope: str | None = None, max_shipped: int = MAX_SHIPPED_QUERIES,
             rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The k candidates nearest to every query: query_id, id, score (cosine), rank.

    The scan is exact. Every task multiplies its candidates with the queries and emits only its own
    k best per query, so pairs are never materialised. Up to ``max_shipped`` queries travel to the
    tasks and the candidates stay where they are; more queries are matched block by block through
    a shuffle. With ``scope`` a query only sees candidates of the same scope value. Rows without a vector take no part.
    """
    cols = [id_col, vector] + ([scope] if scope else [])
    cand = candidates.select(*cols).filter(F.col(vector).isNotNull())
    qcols = [query_id, vector] + ([scope] if scope else [])
    qs = queries.select(*qcols).filter(F.col(vector).isNotNull())
    schema = StructType([
        StructField("query_id", qs.schema[query_id].dataType), StructField("id", cand.schema[id_col].dataType),
        StructField("score", DoubleType()),
    ])
    head = qs.limit(max_shipped + 1).collect()
    if len(head) > max_shipped:
        return _final(_by_blocks(cand, qs, k, id_col, query_id, vector, scope, schema, max_shipped, rows_per_block), k)
    if not head:
        return _final(cand.sparkSession.createDataFrame([], schema), k)
    qids = [r[0] for r in head]
    qvecs = np.asarray([r[1] for r in head], dtype=np.float64)
    qscopes = [r[2] for r in head] if scope else None

    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(qids, qvecs, qscopes, k)
        for batch in batches:
            ids = np.asarray(batch.column(0).to_pylist(), dtype=object)
            scopes = np.asarray(batch.column(2).to_pylist(), dtype=object) if scope else None
            if len(ids):
                best.add(ids, _matrix(batch.column(1)), scopes)
        q, i, s = best.rows()
        yield pa.RecordBatch.from_pydict({"query_id": q, "id": i, "score": s}, schema=arrow)

    return _final(cand.mapInArrow(scan, schema), k)


def _by_blocks(cand, qs, k, id_col, query_id, vector, scope, schema, max_shipped, rows_per_block) -> DataFrame:
    """Many queries: a grid of candidate and query blocks, each small enough for one task.

    Blocks follow the hash of the scope, so a query only meets its own scopes; a block that holds
    more rows (a hot scope) is split further by the hash of the id, and its queries are copied to
    each part.
    """
    n_blocks = 1 if scope is None else max(1, ceil(qs.count() / max_shipped))
    block = F.pmod(F.xxhash64(scope), F.lit(n_blocks)) if scope else F.lit(0).cast("bigint")
    c, q = cand.withColumn("_b", block), qs.withColumn("_b", block)

    def parts(df: DataFrame, rows: int, name: str) -> DataFrame:
        return df.groupBy("_b").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(rows))).cast("int").alias(name))

    sizes = parts(c, rows_per_block, "_cn").join(parts(q, max_shipped, "_qn"), "_b")
    c = c.join(sizes, "_b").select(
        "_b", F.pmod(F.xxhash64(id_col), F.col("_cn")).cast("int").alias("_c"),
        F.explode(F.sequence(F.lit(0), F.col("_qn") - 1)).alias("_q"), *cand.columns)
    q = q.join(sizes, "_b").select(
        "_b", F.explode(F.sequence(F.lit(0), F.col("_cn") - 1)).alias("_c"),
        F.pmod(F.xxhash64(query_id), F.col("_qn")).cast("int").alias("_q"), *qs.columns)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": right[query_id].iloc[:0], "id": left[id_col].iloc[:0], "score": np.empty(0)})
        best = _Best(right[query_id].tolist(), np.stack(right[vector].to_list()).astype(np.float64),
                     right[scope].tolist() if scope else None, k)
        best.add(left[id_col].to_numpy(dtype=object), np.stack(left[vector].to_list()).astype(np.float64),
                 left[scope].to_numpy(dtype=object) if scope else None)
        qid, ids, scores = best.rows()
        return pd.DataFrame({"query_id": qid, "id": ids, "score": scores})

    grid = ("_b", "_c", "_q")
    return c.groupBy(*grid).cogroup(q.groupBy(*grid)).applyInPandas(meet, schema)


def centroids(df: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per group, as plain aggregates: one value per group and dimension crosses the shuffle."""
    flat = df.select(group, F.posexplode(vector).alias("_pos", "_x"))
    means = flat.groupBy(group, "_pos").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_m")))
    return means.groupBy(group).agg(F.transform(ordered, lambda s: s["_m"]).alias(vector))


def mem_search(memories: DataFrame, queries: DataFrame, user: str, id_col: str, k: int = 3) -> DataFrame:
    """A user's memories most similar to the user's query; similarity is 1 - cosine distance, three decimals."""
    hits = vec_topk(memories, queries, k, id_col=id_col, scope=user)
    return hits.select("query_id", "id", F.round("score", 3).alias("similarity"), "rank")


def vec_dim_guard(df: DataFrame, expected: int, vector: str = "embedding", by: str | None = None) -> DataFrame:
    """Smallest and largest dimension against the expected one; a NULL vector fails the check."""
    size = F.coalesce(F.size(vector), F.lit(-1)).cast("bigint")
    aggs = (F.min(size).alias("min_dim"), F.max(size).alias("max_dim"), F.count(F.lit(1)).alias("n"))
    out = df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)
    return out.withColumn("dims_ok", (F.col("min_dim") == expected) & (F.col("max_dim") == expected))


def rag_context(hits: DataFrame, texts: DataFrame, id_col: str, text: str, label: str | None = None) -> DataFrame:
    """One context string per query from its ranked hits, each passage marked with its source.

    A query has at most k hits, so the collected list is short.
    """
    source = F.col(label or id_col).cast("string")
    passages = texts.select(F.col(id_col).alias("id"), F.concat(F.lit("["), source, F.lit("] "), F.col(text)).alias("_passage"))
    rows = hits.join(passages, "id").groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "_passage"))).alias("_p"))
    return rows.select("query_id", F.array_join(F.transform("_p", lambda p: p["_passage"]), "\n\n---\n").alias("context"))


def batch_answer(questions: DataFrame, hits: DataFrame, floor: float, query_id: str = "query_id") -> DataFrame:
    """Top evidence of every question, or a note that the best score is below the floor."""
    top = hits.filter(F.col("rank") == 1).select(F.col("query_id").alias(query_id), F.col("id").alias("_id"), "score")
    enough = F.coalesce(F.col("score") >= floor, F.lit(False))
    return questions.join(top, query_id, "left").select(
        *questions.columns, F.when(enough, F.col("_id")).alias("evidence_id"), F.round("score", 4).alias("score"),
        F.when(enough, "answered").otherwise("not enough evidence").alias("answer_status"),
    )
