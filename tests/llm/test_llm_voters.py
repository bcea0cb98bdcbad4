"""Voters of long unbroken texts, and the label model when there are very many voters."""

import tracemalloc

import numpy as np
import pyarrow as pa

from ledgerloom.llm import toxicity as T


def test_long_unbroken_texts_are_cut_in_pairs_of_characters(spark):
    rng = np.random.default_rng(0)
    signs = [chr(0x4E00 + k) for k in range(300)]
    plain = lambda: "".join(signs[k] for k in rng.integers(0, 280, 900))
    bad = "".join(signs[290:294])
    rows = [(k, (plain() + bad + plain()) if k % 4 == 0 else plain(), int(k % 4 == 0)) for k in range(240)]
    voters = T.mine(spark.createDataFrame([(t, y) for _, t, y in rows], "text string, y int"))
    assert {"".join(signs[290 + k: 292 + k]).encode() for k in range(3)} <= set(voters.terms) and max(map(len, voters.terms)) <= T.LONG
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(900, "x" * 200_000), (901, plain() * 30 + bad)], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in T.score_toxicity(docs, spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")).collect()}
    assert all(got[k] == y for k, _, y in rows) and got[900] == 0 and got[901] == 1


def test_pieces_lie_inside_their_words():
    texts = ["ab " + "é" * 40 + " cd", "", "q" * 49, "日本" * 9 + ".", "a" * 48]
    codes, rows, starts, ends, words = T._terms(pa.array(texts), 0)
    raw = "".join(texts).encode()
    found = [[raw[a:b].decode() for a, b, r in zip(starts, ends, rows) if r == k] for k in range(len(texts))]
    pairs = [x + y for x, y in zip("日本" * 9, ("日本" * 9)[1:])]
    assert found == [["ab", *["éé"] * 39, "cd"], [], ["qq"] * 48, pairs, ["a" * 48]] and words.tolist() == [41, 0, 48, 17, 1]
    assert len({c for c, r in zip(codes.tolist(), rows) if r == 2}) == 1


def some_votes(n, voters, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.4
    accuracy = rng.uniform(0.05, 0.5, voters)
    return (rng.random((n, voters)) < np.where(y[:, None], accuracy, 0.02)).astype(np.uint8), y


def test_blocks_of_voters_give_the_same_model(monkeypatch):
    votes, y = some_votes(700, 90)
    one = T.LabelModel(votes, y)
    q = one.posterior(votes)
    x = np.column_stack([votes, np.ones(len(votes), np.uint8)])
    w = T.logistic(x, q)
    residuals = votes - np.outer(q, one.on) - np.outer(1 - q, one.off)
    assert np.isclose(one._agreement(votes, q)[0], sum(
        c for k in range(90) if (c := 1.0 if k == 0 else abs((residuals[:, 0] * residuals[:, k]).mean()) / np.sqrt(
            max((residuals[:, 0] ** 2).mean(), 1e-6) * max((residuals[:, k] ** 2).mean(), 1e-6))) >= 0.1))
    monkeypatch.setattr(T, "VOTER_BLOCK", 16)
    monkeypatch.setattr(T, "STEP_BLOCK", 16)
    assert np.allclose(T.LabelModel(votes, y).share, one.share)
    assert np.abs(T.logistic(x, q, rounds=300) - w).max() < 1e-3


def test_very_many_voters_need_little_memory():
    votes, y = some_votes(400, 6000)
    tracemalloc.start()
    model = T.LabelModel(votes, y, rounds=1)
    T.logistic(np.column_stack([votes, np.ones(len(votes), np.uint8)]), model.posterior(votes), rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 600e6  # a Newton step holds two matrices of 4,096 squared, 268 MB
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95
