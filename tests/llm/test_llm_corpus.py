"""Operators over the whole corpus against brute force or held-out labels, and the pipeline."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import ROOT

from ledgerloom.llm.graph import components, rooted
from ledgerloom.llm.hnsw import nearest
from ledgerloom.llm.keyfilter import key_condition
from ledgerloom.llm.minhash import Sketcher, shingle_sets
from ledgerloom.llm.neardup import keep_one, near_duplicates
from ledgerloom.llm.quality import isotonic, keep_good, score_quality
from ledgerloom.llm.substrings import remove_repeats
from ledgerloom.llm.toxicity import score_toxicity

SCHEMA = "doc_id long, text string, cid long, a string, root int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "a", 2) for i, t in rows], SCHEMA)


def documents(spark):
    return [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect()]


# -- repeated strings


def plain_repeats(rows, length=100):
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            key = hashlib.md5(b[k: k + length]).digest()
            if seen.setdefault(key, (i, k)) != (i, k):
                gone[k: k + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def test_repeated_strings_against_all_windows(spark):
    line = "a passage that many documents hold, long enough to be found again and again by windows of a hundred bytes. "
    rows = [
        (1, None), (2, ""), (3, "a" * 5000), (4, "a" * 300), (5, "x" * 99), (6, "ab" * 400 + "q"), (7, "q" + "ab" * 400), (9, "ü" * 120), (8, "zü" + "ü" * 120),
        *[(20 + k, f"{k} own start {k * k} " + line + f" own end {k * 7}") for k in range(40)], (70, line * 30), *documents(spark),
    ]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(frame(spark, rows).repartition(5)).collect()}
    want = plain_repeats(rows)
    assert {i for i in want if want[i] != got[i]} == set()


def test_repeated_strings_with_equal_ids_and_none(spark):
    got = remove_repeats(frame(spark, [(None, "n" * 150), (5, "n" * 150), (7, "m" * 100), (7, "m" * 100)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 149), (5, 150), (7, 0), (7, 0)]  # all windows of the first but its first one
    assert remove_repeats(frame(spark, [])).count() == 0


def test_texts_without_repeats_stay_out_of_python(spark):
    line = "a passage that two documents hold, long enough to be found again by windows of a hundred bytes, and some more. "
    rows = [(1, line), (2, "q" + line), (3, None), (4, "ü" * 20), (5, "short")]
    found = remove_repeats(frame(spark, rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # of the texts that are cut
    want = plain_repeats(rows)
    got = found.collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


# -- near duplicates


def plain_groups(rows, size, percent):
    sets = shingle_sets(pa.array([t or "" for _, t in rows]), size)
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for j, both in Counter(j for h in s.tolist() for j in holders[h]).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(rows[k][0]), find(rows[j][0])
                parent[max(a, b)] = min(a, b)
        for h in s.tolist():
            holders[h].append(k)
    return {i: (len(s), find(i)) for (i, _), s in zip(rows, sets)}


def edited(rng, words, n):
    out = list(words)
    for k in rng.choice(len(out), n, replace=False):
        out[k] = f"edit{rng.integers(1 << 30)}"
    return " ".join(out)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, size, percent):
    rng = np.random.default_rng(3)
    rows = [(1, None), (2, ""), (3, "One"), (4, "oNE"), (5, "one two"), (6, "two one")]
    for g, length in enumerate((8, 30, 120, 400)):
        words = [f"w{rng.integers(200)}x{g}" for _ in range(length)]
        rows += [(1000 * (g + 1) + k, edited(rng, words, int(k * length / 400))) for k in range(25)]
    rows += documents(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), size, percent).collect()}
    assert got == plain_groups(rows, size, percent)


def test_near_duplicates_repeats_nulls_and_nothing(spark):
    rows = [(None, "a b c d e f g"), (4, "a b c d e f g"), (4, "a b c d e f g"), (9, "A b C d e f g"), (None, None), (5, "")]
    got = near_duplicates(frame(spark, rows), 3, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter({
        (None, 5, 4, False): 1, (4, 5, 4, True): 2, (9, 5, 4, False): 1, (None, 0, None, True): 1, (5, 0, 5, True): 1})
    one = keep_one(frame(spark, rows), 3, 85)
    assert one.columns == frame(spark, rows).columns and sorted((r.doc_id or 0) for r in one.collect()) == [0, 4, 5]
    assert near_duplicates(frame(spark, []), 3, 85).count() == 0


def test_sketches_never_exclude_by_counts_and_estimate_well():
    rng = np.random.default_rng(0)
    k = Sketcher()
    for n in (5, 60, 3000):
        for share in (0.85, 0.95):
            x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            same = int(np.ceil(2 * n * share / (1 + share)))
            y = np.append(x[:same], rng.integers(0, 1 << 63, n - same, dtype=np.uint64))
            (a, ca), (b, cb) = k.of(x), k.of(y)
            assert k.possible(a, b[None], ca, cb[None], n, np.array([n]), 0.85)[0]
    far = k.of(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    assert not k.possible(a, far[0][None], ca, far[1][None], n, np.array([3000]), 0.85)[0]


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (5, 5), (None, 4), (3, 2)] + [(100 + k, 101 + k) for k in range(60)] + [(500, 501 + k) for k in range(50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 10: 10, 11: 10} | {100 + k: 100 for k in range(61)} | {500 + k: 500 for k in range(51)}
    assert got == want


def test_components_stand_for_their_links(spark):
    links = [(100 + k, 101 + k) for k in range(30)] + [(500, 501 + k) for k in range(20)] + [(7, 8), (8, 7)]
    new = [(115, 510), (8, 9)]
    some = rooted(spark.createDataFrame(links, "a long, b long"))
    assert some.filter("a <= b").count() == 0
    whole = components(spark.createDataFrame(links + new, "a long, b long")).collect()
    assert sorted(components(some.union(spark.createDataFrame(new, "a long, b long"))).collect()) == sorted(whole)


def jobs_of(spark, name, work):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        return work(), len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_key_filter_takes_no_job_per_partition(spark):
    put = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in put}
    for k, v in put.items():
        spark.conf.set(k, v)
    try:
        keys = spark.range(0, 9000, 3).repartition(9)
        maybe, jobs = jobs_of(spark, "filter", lambda: key_condition(keys))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert jobs <= 3
    passed = {r.id for r in spark.range(9000).filter(maybe("id")).collect()}
    assert passed.issuperset(range(0, 9000, 3)) and len(passed) < 3100
    assert spark.range(50).filter(key_condition(spark.range(0))("id")).count() == 0


# -- nearest neighbours


def test_nearest_against_all_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{ROOT}/embeddings.parquet").collect()]
    rows += [(2000 + k, rows[0][1]) for k in range(60)] + [(5000, None), (5020, [0.0] * 64), (5040, [float("nan")] * 64), (5060, [1.0, None] * 32), (None, rows[1][1])]
    rows += [(6000, [1.0, 2.0]), (6001, [3.0, 1.0])]
    frame_ = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, shard int, v int")
    got = defaultdict(list)
    for r in sorted(nearest(frame_).collect(), key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, r.score))
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and i < 5000]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    found = 0
    queries = [k for k, i in enumerate(ids) if i % 20 == 0]
    for k in queries:
        s = (x * x[k]).sum(1)
        best = [j for j in np.lexsort((ids, -s)) if j != k][:20]
        listed = got.pop(ids[k])
        assert len(listed) == 20 and listed == sorted(listed, key=lambda p: (-p[1], p[0]))
        assert all(abs(score - s[list(ids).index(i)]) < 1e-12 for i, score in listed)
        found += len({i for i, _ in listed} & set(ids[best].tolist()))
    assert found / (20 * len(queries)) >= 0.97
    assert got == {6000: [(6001, 5.0)]}
    assert nearest(frame_.limit(0)).count() == 0


# -- scores


def rank_accuracy(rows):
    """Share of pairs of a good and a bad row that the score puts in order."""
    good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("score,label,sf", [(score_quality, "quality", "0.01"), (score_toxicity, "toxic", "0.1")])
def test_scores_on_held_out_rows(spark, score, label, sf):
    root = f"/root/testdata/sf{sf}"  # sf0.01 has six toxic rows that are held out
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    y = {r.doc_id: r[label] for r in labels.collect()}
    got = score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert rank_accuracy([(r.score, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]) >= 0.95


@pytest.mark.parametrize("score,label", [(score_quality, "quality"), (score_toxicity, "toxic")])
def test_scores_of_odd_rows(spark, score, label):
    rows = frame(spark, [(1, None), (2, ""), (3, "x" * 20_000), (3, "x" * 20_000), (None, "no id")])
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], f"doc_id long, {label} int")
    got = score(rows, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert score(rows, labels.limit(0)).count() == 5 and score(frame(spark, []), labels).count() == 0


def test_quality_filter_keeps_columns(spark):
    docs, labels = spark.read.parquet(f"{ROOT}/documents.parquet"), spark.read.parquet(f"{ROOT}/labels.parquet")
    kept = keep_good(docs, labels)
    scored = {r.doc_id for r in score_quality(docs, labels).collect() if r.predicted}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == scored


def test_isotonic_steps_rise():
    x, y = isotonic(np.arange(6.0), np.array([0, 1, 0, 0.5, 0.4, 1]), np.ones(6))
    assert list(y) == sorted(y) and np.isclose(y[1], 0.475) and len(x) == 3


# -- pipeline


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    names = docs.columns
    counts = [docs.count()]
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, ROOT).cache()
        assert docs.columns == names
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4]
    left = {r.doc_id: r.text for r in docs.collect()}
    got = P.run(spark, ROOT).collect()
    assert {r.doc_id for r in got} == set(left)
    groups = plain_groups(sorted(left.items()), 5, 80)
    assert all(root == i or not n for i, (n, root) in groups.items())


def test_pipeline_stages_against_brute_force(spark):
    import re

    import corpus_pipeline as P
    from test_llm_rows import PATTERNS, passes, plain_overlap

    stages = dict(P.STAGES)
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in stages["quality classifier"](spark, docs, ROOT).collect()}
    assert kept == {r.doc_id for r in score_quality(docs, spark.read.parquet(f"{ROOT}/labels.parquet")).collect() if r.score >= 0.3}
    one = {r.doc_id for r in stages["minhash near-dedup"](spark, docs, ROOT).collect()}
    groups = plain_groups(sorted(texts.items()), 5, 80)
    assert one == {i for i, (_, root) in groups.items() if root == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    overlap = plain_overlap(sorted(texts.items()), items, 10)
    assert {r.doc_id for r in stages["benchmark decontamination"](spark, docs, ROOT).collect()} == {i for i in texts if not overlap[i][4]}
    for r in stages["pii"](spark, docs, ROOT).collect():
        spans = sorted((m.start(), m.end()) for k in PATTERNS for m in re.finditer(PATTERNS[k], texts[r.doc_id] or "") if passes(k, m.group()))
        left, at = [], 0
        for a, b in spans:
            left.append((texts[r.doc_id] or "")[at: max(at, a)])
            at = max(at, b)
        # what lies outside all spans stays, in order
        rest = r.text or ""
        if "iban" not in rest:
            assert re.sub("<(email|ip|card|phone)>", "", rest) == re.sub("<(email|ip|card|phone)>", "", "".join(left) + (texts[r.doc_id] or "")[at:]), r.doc_id


def test_toxic_terms_are_mined_from_all_training_rows(spark):
    from ledgerloom.llm.toxicity import mine

    terms = [f"q{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    said = [f"one two six {t} ten" for t in terms for _ in range(12)] + ["one two six ten"] * 4800
    table = spark.createDataFrame([(t, int("q" in t)) for t in said], "text string, y int")
    assert sorted(mine(table).terms) == sorted(t.encode() for t in terms)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(said)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int("q" in t)) for k, t in enumerate(said)], "doc_id long, toxic int")
    found = score_toxicity(docs, labels).filter("predicted = 1").count()
    assert found == 1200
