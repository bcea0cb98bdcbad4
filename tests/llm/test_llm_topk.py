"""Exact search against brute force in Python integers."""

import math

import numpy as np
import pytest
from conftest import ROOT

from ledgerloom.llm.topk import search

SCHEMA = "vec_id long, embedding array<double>, id long, cell int, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, 1, "r") for i, v in rows], SCHEMA)


def whole(x, unit=64):
    return [int(e) * unit if abs(e) >= 2**53 else math.floor(e * unit) for e in x]


def plain(rows, every=20, k=20, unit=64):
    """Per query (in the order of id and vector) the list of (vec_id, score)."""
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(e is not None and math.isfinite(e) for e in v)}
    held = [(i, v, whole(v, unit)) for i, v in fine]
    most = 2**63 - 1
    out = []
    for i, v, q in held:
        if i % every == 0:
            scores = sorted((-max(-most, min(most, sum(a * b for a, b in zip(q, w)))), j) for j, _, w in held if j != i)
            out.append((i, [(j, -s) for s, j in scores[:k]]))
    return sorted(out)


def got(df):
    """The answers of each query, where queries of one id are told apart by rank starting anew."""
    by = {}
    for r in df.collect():
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in by.items()}


def wanted(rows, **how):
    by = {}
    for i, found in plain(rows, **how):
        by.setdefault(i, []).extend((n, j, s) for n, (j, s) in enumerate(found, 1))
    return {q: sorted(rows) for q, rows in by.items() if rows}


def test_the_table_against_brute_force(spark):
    table = spark.read.parquet(f"{ROOT}/embeddings.parquet")
    rows = [(r.vec_id, [float(e) for e in r.embedding]) for r in table.collect()]
    for how in ({}, {"block_rows": 40, "chunk_rows": 7}):
        assert got(search(table, **how)) == wanted(rows)


def test_sparse_rows_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(e) for e in np.where(rng.random(30) < 0.1, rng.normal(0, 1, 30), 0)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 30) for i in range(200)] + [(20, [0.5] * 30), (20, [0.5] * 30), rows[5]]
    assert got(search(frame(spark, rows), block_rows=64, chunk_rows=5)) == wanted(rows)


@pytest.mark.parametrize("scale", [1e-9, 1e3, 3e7, 1e12, 1e20, 1e300])
def test_weights_of_any_size(spark, scale):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(e) for e in rng.normal(0, scale, 6)]) for i in range(60)] + [(100 + i, [0.1 * i] * 6) for i in range(9)]
    assert got(search(frame(spark, rows), k=5)) == wanted(rows, k=5)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [-1.0, -0.001]),
        (None, [1.0, 1.0]), (8, [3.0]), (9, [1.0, 1.0, 9.0]), (20, []), (40, [5.0, 5.0, 5.0, 5.0]),
    ]
    assert got(search(frame(spark, rows))) == wanted(rows)
    assert search(frame(spark, [])).count() == 0
    assert search(frame(spark, [(20, [1.0])])).count() == 0
    assert search(frame(spark, [(21, [1.0]), (22, [1.0])])).count() == 0
