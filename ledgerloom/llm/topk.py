"""Exact search: every query against every vector, term by term into dense score arrays, the best of each block merged."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import cut_lineage

#: Vectors of a block and queries of a chunk, at most; with these a task holds some megabytes.
BLOCK_ROWS, CHUNK_ROWS = 8192, 1024
#: Weights of a block at most (long vectors make smaller blocks).
BLOCK_VALUES = 1 << 20
#: Queries that are scored side by side, and rows of a score array that stay in the processor's cache meanwhile.
BATCH, TILE = 64, 1024
#: Tasks that the pairs of a block and a chunk are dealt to, at most.
MOST_TASKS = 100_000
LEAST = -(1 << 63)

PACKED = "part int, kind int, dim int, base bigint, ids binary, weights binary"


def _ints(x: np.ndarray, unit: int) -> np.ndarray:
    """``floor(unit * x)`` as Python integers, exact at any size."""
    return np.array([int(v) * unit if abs(v) >= 2.0**53 else int(np.floor(v * unit)) for v in x.ravel().tolist()], object).reshape(x.shape)


def packer(rows_at_most: int, unit: int):
    """Pack the rows of a partition (``id``, ``v``) into blocks of one length and one width of integers, by ascending id.

    Kind 0 holds 16-bit weights, kind 1 64-bit weights, kind 2 the original doubles, whose weights exceed 64 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, base = TaskContext.get().partitionId(), 0
        held: dict[tuple[int, int], tuple[list, list]] = {}

        def flush(key: tuple[int, int]) -> pa.RecordBatch:
            nonlocal base
            ids, x = (np.concatenate(c) for c in held.pop(key))
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            w = x if key[0] == 2 else np.floor(x * unit).astype(np.int16 if key[0] == 0 else np.int64)
            base += len(ids)
            return pa.record_batch(
                [pa.array([v], t) for v, t in zip((part, *key, base - len(ids), ids.tobytes(), w.tobytes()), (
                    pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                ["part", "kind", "dim", "base", "ids", "weights"])

        for batch in batches:
            ids, v = batch.column("id").to_numpy(), batch.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = v.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)
                most = np.abs(x).max(1, initial=0)
                kinds = np.where(most < 2.0**15 / unit - 1, 0, np.where(most < 2.0**62 / unit, 1, 2))
                for kind in np.unique(kinds):
                    mine, key = np.flatnonzero(kinds == kind), (int(kind), int(dim))
                    step = max(1, min(rows_at_most, BLOCK_VALUES // max(1, int(dim))))
                    while len(mine):
                        have = held.setdefault(key, ([], []))
                        room = step - sum(map(len, have[0]))
                        have[0].append(ids[at[mine[:room]]])
                        have[1].append(x[mine[:room]])
                        mine = mine[room:]
                        if sum(map(len, have[0])) == step:
                            yield flush(key)
        for key in sorted(held):
            yield flush(key)

    return run


def _unpacked(row: dict, unit: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    w = np.frombuffer(row["weights"], (np.int16, np.int64, np.float64)[row["kind"]]).reshape(len(ids), row["dim"])
    return ids, _ints(w, unit) if row["kind"] == 2 else w


def _size(w: np.ndarray) -> int:
    """The largest absolute weight."""
    return max(abs(int(w.max())), abs(int(w.min()))) if w.size else 0


class Postings:
    """The postings of a block, term by term: rows that hold the term, and their weights.

    ``kind`` is a number type in which every partial sum with queries of weights up to ``query_size`` is exact: sums stay below
    2**24 in single precision, 2**53 in double, 2**63 in 64-bit integers; Python integers take whatever is larger.
    """

    def __init__(self, w: np.ndarray, terms: int, query_size: int) -> None:
        bound = max(1, terms) * max(1, _size(w)) * max(1, query_size)
        self.kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
        self.rows = len(w)
        self.tiles = []
        for a in range(0, len(w), TILE):
            columns = np.ascontiguousarray(w[a: a + TILE, :terms].T).astype(self.kind)
            lists = []
            for c in columns:
                rows = np.flatnonzero(c != 0)
                # a list that names most rows is kept whole: adding zeros is cheaper than finding places
                lists.append((None, c[:, None]) if 2 * len(rows) > len(c) else (rows, c[rows, None]))
            self.tiles.append((a, columns.shape[1], lists))

    def scores(self, queries: np.ndarray) -> np.ndarray:
        """One row per query, one column per row of the block: sums over the terms, one term after the other."""
        q = np.ascontiguousarray(queries.T).astype(self.kind)
        used = [t for t in range(len(q)) if (q[t] != 0).any()]
        out = np.zeros((self.rows, len(queries)), self.kind)
        for a, n, lists in self.tiles:
            sums, spare = out[a: a + n], np.empty((n, len(queries)), self.kind)
            for t in used:
                if t >= len(lists):
                    break
                rows, weight = lists[t]
                if rows is None:
                    np.multiply(weight, q[t], out=spare)
                    sums += spare
                elif len(rows):
                    sums[rows] += weight * q[t]
        if self.kind is object:
            out = np.clip(out, LEAST + 1, -LEAST - 1)
        return np.ascontiguousarray(out.T)


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each query: positions of queries and rows, and scores. ``ids`` ascend; ties go to the smaller."""
    floats = scores.dtype in (np.float32, np.float64)
    none = -np.inf if floats else LEAST
    left, right = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
    if not floats:
        scores = scores.astype(np.int64)
    for i in np.flatnonzero(right > left):
        scores[i, left[i]: right[i]] = none
    n = scores.shape[1]
    limit = np.partition(scores, n - k, 1)[:, n - k, None] if n > k else np.full((len(scores), 1), none)
    query, row = np.nonzero((scores >= limit) & (scores > none))
    score = scores[query, row].astype(np.int64)
    order = np.lexsort((row, -score, query))
    query, row, score = query[order], row[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query, "left")
    keep = place < k
    return query[keep], row[keep], score[keep]


def taking_part(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` of the rows with an id and a vector of finite components, each once."""
    v: Column = F.col("v")
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter("id IS NOT NULL AND v IS NOT NULL").filter(fine).dropDuplicates(["id", "v"])


def search(
    vectors: DataFrame, every: int = 20, k: int = 20, unit: int = 64, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """For each vector whose id is divisible by ``every``: the ``k`` others with the largest integer inner product.

    A component ``x`` weighs ``floor(unit * x)``, a term is its place in the vector. ``query_id``, ``rank`` (from 1; ties to
    the smaller id), ``vec_id``, ``score``. The answer is exact: all vectors are scored for all queries.

    Rows are dealt by hash into blocks of some ``block_rows`` and queries into chunks of some ``chunk_rows``; both are stored
    packed, and each pair of a block and a chunk is the work of one task. It turns the block into postings, adds them term by
    term to dense arrays of scores, picks the ``k`` best of each query by partition, and only those are merged. A block
    moves once per chunk and a chunk once per block, so the copies fall as both grow; larger values suit larger tables.

    Vectors that are null or hold null or non-finite components take no part, nor rows with a null id. Zero and empty vectors
    do, with scores of 0; terms that the shorter of two vectors lacks weigh 0. Equal rows count once; other rows with the
    query's own id are not its candidates. A score beyond 64 bits is held at their limit, there ties go to the smaller id.
    Fewer candidates than ``k`` give fewer rows, no rows give none. Other columns are not read.
    """
    ids = vectors.select(F.col(id_col).cast("long").alias("id"))
    blocks, chunks = (max(1, -(-n // most)) for n, most in zip(
        ids.agg(F.count("*"), F.count_if(F.col("id") % every == 0)).first(), (block_rows, chunk_rows)))
    rows = cut_lineage(taking_part(vectors, id_col, vector_col))

    def packed(some: DataFrame, parts: int, most: int) -> DataFrame:
        dealt = some.repartitionById(parts, F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int"))
        return cut_lineage(dealt.mapInArrow(packer(most, unit), PACKED))

    def paired(some: DataFrame, others: int, cell: Column, side: int) -> DataFrame:
        return some.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).select(cell.alias("cell"), F.lit(side).alias("side"), "*")

    part, other = F.col("part").cast("long"), F.col("other").cast("long")
    asked = paired(packed(rows.filter(F.col("id") % every == 0), chunks, chunk_rows), blocks, part * blocks + other, 0)
    held = paired(packed(rows, blocks, block_rows), chunks, other * blocks + part, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell:
                    cell, queries = row["cell"], []
                own, w = _unpacked(row, unit)
                if row["side"] == 0:
                    queries.append((row["base"] + (row["part"] << 32), own, w))
                    continue
                for base, asks, q in queries:
                    terms = min(q.shape[1], w.shape[1])
                    lists = Postings(w, terms, _size(q))
                    for a in range(0, len(asks), BATCH):
                        of = asks[a: a + BATCH]
                        at, found, score = best(lists.scores(q[a: a + BATCH, :terms]), own, of, k)
                        yield pa.record_batch([base + a + at, of[at], own[found], score], ["number", "query_id", "vec_id", "score"])

    tasks = min(blocks * chunks, MOST_TASKS)
    dealt = asked.unionByName(held).repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int")).sortWithinPartitions("cell", "side")
    found = dealt.mapInArrow(run, "number bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
