"""Approximate nearest neighbours: one navigable small-world graph per shard, answers of the shards merged."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors of a shard, whatever the size of the table: recall depends on it.
PER_SHARD = 8_192
#: Vectors of nearly one length that are compared one by one; from more a graph is built.
FEW = 256
#: Queries and insertions that walk the graph side by side.
BATCH = 256


class Graph:
    """A hierarchical graph over the rows of ``x``, all of one length.

    Rows are ordered by level, highest first, so the rows of a level are the first ones and its neighbours are one flat
    array: row ``i`` has ``links[level][i]``, filled up with -1. Rows are inserted in batches; a batch is linked to what it
    finds in the graph and to its own members.
    """

    WIDE = 4  # nodes a walk opens at once

    def __init__(self, x: np.ndarray, m: int = 16, ef: int = 96, seed: int = 5) -> None:
        n = len(x)
        self.m, self.ef = m, ef
        draw = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(m)).astype(int), 6)
        self.order = np.argsort(-level, kind="stable")
        self.x = np.ascontiguousarray(x[self.order], np.float32)
        level = level[self.order]
        self.sizes = [int((level >= i).sum()) for i in range(level[0] + 1)] if n else []
        self.links = [np.full((s, 2 * m if i == 0 else m), -1, np.int32) for i, s in enumerate(self.sizes)]
        at = 0
        while at < n:
            to = min(n, at + max(1, min(BATCH, at)))
            self._insert(at, to)
            at = to

    def _insert(self, a: int, b: int) -> None:
        new = np.arange(a, b)
        entry = None
        for level in range(len(self.sizes) - 1, -1, -1):
            present = min(a, self.sizes[level])
            mine = new[new < self.sizes[level]]
            if present:
                near, score = self._walk(self.x[a:b], level, entry, present, self.ef if len(mine) else 8)
                entry = near[:, : self.WIDE]
            if not len(mine):
                continue
            k = len(mine)
            inside = self.x[mine] @ self.x[mine].T
            np.fill_diagonal(inside, -np.inf)
            top = np.argsort(-inside, 1)[:, : self.ef]
            ids, s = mine[top], np.take_along_axis(inside, top, 1)
            if present:
                ids, s = np.concatenate([near[:k], ids], 1), np.concatenate([score[:k], s], 1)
            ids = np.where(np.isfinite(s), ids, -1)
            best = np.argsort(-s, 1, kind="stable")[:, : self.ef]
            chosen = self._spread(self.x[mine], np.take_along_axis(ids, best, 1), np.take_along_axis(s, best, 1), self.m)
            self.links[level][mine, : self.m] = chosen[:, : self.m]
            self._link_back(level, mine, chosen)

    def _spread(self, x: np.ndarray, ids: np.ndarray, s: np.ndarray, keep: int) -> np.ndarray:
        """Choose up to ``keep`` of the candidates, best first; one that is nearer to a chosen one comes last."""
        n, c = ids.shape
        held = self.x[np.maximum(ids, 0)]
        between = held @ held.transpose(0, 2, 1)
        nearest = np.full((n, c), -np.inf, np.float32)
        good = np.zeros((n, c), bool)
        for j in range(c):
            ok = (ids[:, j] >= 0) & (nearest[:, j] < s[:, j])
            good[:, j] = ok
            nearest = np.maximum(nearest, np.where(ok[:, None], between[:, j], -np.inf))
        rank = np.argsort(np.where(ids < 0, 2, np.where(good, 0, 1)), 1, kind="stable")[:, :keep]
        out = np.take_along_axis(ids, rank, 1)
        return np.pad(out, ((0, 0), (0, max(0, keep - c))), constant_values=-1).astype(np.int32)

    def _link_back(self, level: int, mine: np.ndarray, chosen: np.ndarray) -> None:
        links = self.links[level]
        width = links.shape[1]
        source, target = np.repeat(mine, chosen.shape[1]), chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        s = np.einsum("ij,ij->i", self.x[source], self.x[target])
        order = np.lexsort((-s, target))
        source, target, s = source[order], target[order], s[order]
        who, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        row = np.repeat(np.arange(len(who)), count)
        fit = place < width
        extra = np.full((len(who), width), -1, np.int64)
        extra[row[fit], place[fit]] = source[fit]
        ids = np.concatenate([links[who], extra], 1)
        for i in range(0, len(who), BATCH):
            part = ids[i: i + BATCH]
            score = np.einsum("ijk,ik->ij", self.x[np.maximum(part, 0)], self.x[who[i: i + BATCH]])
            score[part < 0] = -np.inf
            best = np.argsort(-score, 1, kind="stable")
            part, score = np.take_along_axis(part, best, 1), np.take_along_axis(score, best, 1)
            again = np.zeros(part.shape, bool)  # a pair may be linked from both ends in one batch
            again[:, 1:] = (part[:, 1:] == part[:, :-1]) & (part[:, 1:] >= 0)
            part = np.where(again, -1, part)
            links[who[i: i + BATCH]] = self._spread(self.x[who[i: i + BATCH]], part, np.where(part < 0, -np.inf, score), width)

    def _walk(self, q: np.ndarray, level: int, entry: np.ndarray | None, present: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` best rows a best-first walk finds for each query on one level, best first; -1 where there are fewer."""
        n = len(q)
        line = np.arange(n)[:, None]
        seen = np.zeros((n, present + 1), bool)
        seen[:, present] = True  # stands for no neighbour
        start = np.zeros((n, 1), np.int64) if entry is None else np.where(entry >= 0, entry, present)
        ids = np.full((n, ef), present, np.int64)
        score = np.full((n, ef), -np.inf, np.float32)
        ids[:, : start.shape[1]] = start
        seen[line, start] = True
        score[:, : start.shape[1]] = np.where(start < present, np.einsum("ijk,ik->ij", self.x[np.minimum(start, present - 1)], q), -np.inf)
        opened = ~np.isfinite(score)
        live = np.arange(n)
        links = self.links[level]
        while len(live):
            s = np.where(opened[live], -np.inf, score[live])
            pick = np.argpartition(-s, self.WIDE, 1)[:, : self.WIDE] if ef > self.WIDE else np.argsort(-s, 1)[:, : self.WIDE]
            some = np.isfinite(np.take_along_axis(s, pick, 1))
            go = some.any(1)
            live, pick, some = live[go], pick[go], some[go]
            if not len(live):
                break
            row = live[:, None]
            opened[row, pick] = True
            node = np.where(some, ids[row, pick], present)
            near = links[np.minimum(node, present - 1)]
            near = np.where((node[:, :, None] < present) & (near >= 0) & (near < present), near, present).reshape(len(live), -1)
            near.sort(1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = present
            near[seen[row, near]] = present
            seen[row, near] = True
            fresh = np.einsum("ijk,ik->ij", self.x[np.minimum(near, present - 1)], q[live])
            fresh[near == present] = -np.inf
            all_ids, all_s = np.concatenate([ids[live], near], 1), np.concatenate([score[live], fresh], 1)
            all_open = np.concatenate([opened[live], near == present], 1)
            best = np.argpartition(-all_s, ef - 1, 1)[:, :ef]
            ids[live], score[live], opened[live] = (np.take_along_axis(v, best, 1) for v in (all_ids, all_s, all_open))
            opened[live] |= ~np.isfinite(score[live])
        best = np.argsort(-score, 1, kind="stable")
        ids, score = np.take_along_axis(ids, best, 1), np.take_along_axis(score, best, 1)
        return np.where(np.isfinite(score), ids, -1), score

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        """Rows of the given ``x`` found for each query, in no particular order; -1 where there are fewer than ``ef``."""
        entry = None
        for level in range(len(self.sizes) - 1, 0, -1):
            entry = self._walk(q, level, entry, self.sizes[level], 8)[0][:, : self.WIDE]
        found = self._walk(q, 0, entry, self.sizes[0], ef)[0]
        return np.where(found >= 0, self.order[np.maximum(found, 0)], -1)


class Shard:
    """Graphs over the rows of ``exact``, one for each class of lengths.

    A graph works in single precision, and lifting to one length drowns vectors that are much shorter than the longest. So
    lengths within a factor of four share a graph, scaled by a power of two to less than one; vectors of any size are found,
    and a few long ones do not blur the rest. Classes of ``FEW`` rows are compared whole.
    """

    def __init__(self, exact: np.ndarray, m: int, ef: int) -> None:
        peak = np.frexp(np.abs(exact).max(1, initial=0))[1]
        norm = np.linalg.norm(np.ldexp(exact, -peak[:, None]), axis=1)
        # limits lie between powers of two, so that vectors of length one, more or less, are one class
        level = np.floor((peak + np.log2(norm) + 0.5) / 2).astype(int)
        self.parts = []
        for c in np.unique(level):
            rows = np.flatnonzero(level == c)
            scaled = np.ldexp(exact[rows], -2 * int(c) - 2)
            self.parts.append((rows, Graph(lifted(scaled), m, ef) if len(rows) > FEW else None))

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        """Rows found for each query, in no particular order; -1 fills up."""
        unit = np.ldexp(q, -np.frexp(np.abs(q).max(1, initial=0))[1][:, None])  # a query's own length changes no order
        unit = np.column_stack([unit, np.zeros(len(q))]).astype(np.float32)
        out = []
        for rows, graph in self.parts:
            if graph is None:
                out.append(np.broadcast_to(rows, (len(q), len(rows))))
            else:
                found = graph.search(unit, ef)
                out.append(np.where(found >= 0, rows[np.maximum(found, 0)], -1))
        return np.concatenate(out, 1)


def lifted(x: np.ndarray) -> np.ndarray:
    """One more coordinate gives all vectors the same length, so that the largest inner product is the least distance."""
    norm = (x.astype(float) ** 2).sum(1)
    return np.column_stack([x, np.sqrt(np.maximum(norm.max() - norm, 0))]).astype(np.float32)


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, ef: int = 128, m: int = 24, build_ef: int = 64, shards: int | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """For each vector whose id is divisible by ``every``: the ``k`` others with the largest inner product that are found.

    ``query_id``, ``rank`` (from 1; ties to the smaller id), ``vec_id``, ``score`` (inner product in double precision).

    Equal vectors are indexed once with their ``k + 1`` smallest ids, which is all that can be needed of them; they are
    gathered per partition before they meet. Distinct vectors are dealt by hash into shards of some ``PER_SHARD``, one a
    task. It builds the graphs of its shard (one per class of lengths) and streams all queries through them in batches, so
    it holds one shard and one batch. The ``k`` best of every shard are merged. Every query visits every shard: the work
    grows with queries times shards. Vectors of another dimension are indexed apart and never compared.

    Vectors that are null, zero, or hold null or non-finite components take no part, as rows with a null id. A repeated
    row counts once. Vectors may be of any size; products beyond
    double precision are infinite. Fewer candidates than ``k`` give fewer rows; no rows give no rows. Other columns are not read.
    """
    v = F.col("v")
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
        "id IS NOT NULL AND v IS NOT NULL").filter(fine)
    least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    # first what one partition holds of a vector, then the few ids left of each partition
    local = rows.groupBy("v", F.spark_partition_id().alias("p")).agg(F.slice(F.array_sort(F.collect_set("id")), 1, k + 1).alias("ids"))
    classes = local.groupBy("v").agg(least.alias("ids"))
    if shards is None:
        shards = max(1, -(-rows.count() // PER_SHARD))
    code = F.xxhash64("v")
    none = F.lit(None).cast("long")
    base = classes.select(F.size("v").alias("dim"), F.pmod(code, F.lit(shards)).cast("int").alias("shard"), none.alias("query_id"), code.alias("code"), "v", "ids")
    asked = rows.filter(F.col("id") % every == 0).dropDuplicates(["id", "v"]).select(
        F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.col("id").alias("query_id"), code.alias("code"),
        "v", F.lit(None).cast("array<long>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, points, names, graph, exact = None, [], [], None, None
        for batch in batches:
            dims, shard = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
            asks = batch.column("query_id").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shard) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(dims)]):
                if a == b:
                    continue
                if (dims[a], shard[a]) != key:
                    key, points, names, graph = (dims[a], shard[a]), [], [], None
                x = batch.column("v").slice(a, b - a).flatten().to_numpy().reshape(b - a, -1)
                if not asks[a]:
                    points.append(x)
                    names += batch.column("ids").slice(a, b - a).to_pylist()
                    continue
                if not points:
                    continue
                if graph is None:
                    exact = np.concatenate(points)
                    graph = Shard(exact, m, build_ef)
                queries = batch.column("query_id").slice(a, b - a).to_numpy()
                codes = batch.column("code").slice(a, b - a).to_numpy()
                for i in range(0, b - a, BATCH):
                    q = x[i: i + BATCH]
                    found = graph.search(q, ef)
                    yield answers(q, queries[i: i + BATCH], codes[i: i + BATCH], found, exact, names)

    def answers(q, query, code, found, exact, names) -> pa.RecordBatch:
        out: list[tuple[int, int, int, float]] = []
        for i in range(len(q)):
            at = found[i][found[i] >= 0]
            with np.errstate(over="ignore", invalid="ignore"):
                score = np.nan_to_num((exact[at] * q[i]).sum(1), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            best = np.argsort(-score, kind="stable")
            own = int(query[i])
            listed = [(-score[j], n) for j in best[: k + 1] for n in names[at[j]] if n != own]
            if len(best) > k + 1:  # equal scores at the end
                listed += [(-score[j], n) for j in best[k + 1:] if score[j] == score[best[k]] for n in names[at[j]] if n != own]
            out += [(own, int(code[i]), n, -s) for s, n in sorted(listed)[:k]]
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.record_batch([pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.float64())], ["query_id", "code", "vec_id", "score"])

    dealt = base.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("dim", "shard", F.col("query_id").asc_nulls_first(), "code")
    found = dealt.mapInArrow(run, "query_id bigint, code bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id", "code").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
