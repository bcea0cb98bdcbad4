"""Sizes and lengths that single precision or a plain hash does not survive."""

import zlib

import numpy as np
import pytest

from ledgerloom.llm import bytehash
from ledgerloom.llm.hnsw import PER_SHARD, Shard, nearest
from ledgerloom.llm.neardup import near_duplicates
from ledgerloom.llm.packing import pack
from ledgerloom.llm.substrings import remove_repeats
from ledgerloom.llm.tokens import WordIds, default_path


def vectors(n, seed=0, groups=40):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (groups, 64))
    x = centres[rng.integers(groups, size=n)] + rng.normal(0, 0.6, (n, 64))
    return x / np.linalg.norm(x, axis=1)[:, None]


def recall(df, rows, k=20):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    found = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        s = x @ x[at]
        best = [j for j in np.lexsort((ids, -s)) if j != at][:k]
        assert len(got[ids[at]]) == k
        found, total = found + len(set(got[ids[at]]) & set(ids[best].tolist())), total + k
    return found / total


@pytest.mark.parametrize("scale", [1e20, 1e-20, 1e-30, 1e100])
def test_vectors_of_any_scale_are_found(spark, scale):
    rows = [(int(i), [float(e) for e in v * scale]) for i, v in enumerate(vectors(900))]
    assert recall(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shards=2), rows) >= 0.95


@pytest.mark.parametrize("factor, each", [(1e4, 900), (1e3, 100), (1e-6, 3)])
def test_long_and_short_vectors_do_not_blur_the_rest(spark, factor, each):
    rows = [(int(i), [float(e) for e in v * (factor if i % each == 1 else 1)]) for i, v in enumerate(vectors(1800))]
    assert recall(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shards=2), rows) >= 0.95


def test_recall_of_a_full_shard():
    x = vectors(PER_SHARD, 3)
    q = x[::40]
    found = Shard(x, 24, 64).search(q, 128)
    want = np.argsort(-(q @ x.T), 1, kind="stable")[:, :20]
    assert np.mean([len(set(w) & set(f)) / 20 for w, f in zip(want.tolist(), found.tolist())]) >= 0.95


def thue_morse(n):
    bits = np.array([bin(i).count("1") % 2 for i in range(n)])
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_collide_modulo_a_power_of_two(spark):
    one, two = thue_morse(1024)
    data = np.frombuffer((one + " " + two).encode(), np.uint8)
    limits = np.array([0, 1025]), np.array([1024, 2049])
    assert len(set(bytehash.range_hashes(data, *limits).tolist())) == 2
    plain = bytehash.Prefix(data)
    assert len(set(plain.sums[limits[1]].tolist())) and len(set(plain.of(*limits).tolist())) == 2
    rows = [(1, f"{one} x {one}"), (2, f"{two} x {two}"), (3, one + " a b c d e"), (4, two + " a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    ids = {i: WordIds(default_path()).encode([t])[0] + [1] for i, t in rows}
    for r in pack(docs).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start: r.start + r.length], "<u4").tobytes())
    near = {r.doc_id: r.component_id for r in near_duplicates(docs, 3, 85).collect()}
    assert near == {1: 1, 2: 2, 3: 3, 4: 4}
    pair = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in remove_repeats(pair).collect()} == repeats([(1, one), (2, two)])


def repeats(rows, length=100):
    seen, out = set(), {}
    for i, t in rows:
        gone = set()
        for k in range(len(t) - length + 1):
            if t[k: k + length] in seen:
                gone |= set(range(k, k + length))
            seen.add(t[k: k + length])
        out[i] = len(gone)
    return out


def test_hashes_depend_on_content_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3 * bytehash.CHUNK).astype(np.uint8)
    for n in (1, 7, 500, bytehash.CHUNK + 3):
        data[-n:] = data[:n]
        starts, ends = np.array([0, len(data) - n]), np.array([n, len(data)])
        hashes = bytehash.range_hashes(data, starts, ends)
        assert hashes[0] == hashes[1] and hashes[0] == bytehash.range_hashes(data[:n], starts[:1], ends[:1])[0]
