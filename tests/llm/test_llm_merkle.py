"""The manifest against trees built in plain Python."""

import zlib
from hashlib import sha256

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from ledgerloom.llm.merkle import lifted, manifest, missing, tampered_fifth

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, id string, key int, leaf binary"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, fan):
    """The root, and per leaf its siblings level by level and a function that folds another leaf."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][k: k + fan])) for k in range(0, len(levels[-1]), fan)])

    def siblings(i):
        out = ""
        for level in levels[:-1]:
            start = i // fan * fan
            out += "".join(h for k, h in enumerate(level[start: start + fan], start) if k != i)
            i //= fan
        return out

    def fold(i, leaf):
        for level in levels[:-1]:
            start = i // fan * fan
            leaf, i = H("".join(leaf if k == i else h for k, h in enumerate(level[start: start + fan], start))), i // fan
        return leaf

    return levels[-1][0], siblings, fold


def plain(rows, fan=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in order}
    root, upper, fold_up = climb([trees[g][0] for g in order], fan)
    out = []
    for at, g in enumerate(order):
        subroot, siblings, fold = trees[g]
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if r[4] is not None else None
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = fold_up(at, fold(i, leaf_of((*r[:4], low)) if hit else leaf))
            out.append((r[0], leaf, subroot, root, H(siblings(i) + upper(at)), folded, folded == root))
    return sorted(out, key=str)


def got(spark, rows, **how):
    df = spark.createDataFrame([(*r, "i", 1, b"l") for r in rows], SCHEMA)
    return sorted(map(tuple, manifest(df, tamper=tampered_fifth(), **how).collect()), key=str)


def table(spark):
    return [tuple(r) for r in spark.read.parquet(f"{ROOT}/documents.parquet").select(*COLUMNS).collect()]


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_the_table_against_plain_trees(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = table(spark)
        hot = [(10_000 + i, "src0", "en", i, f"Text {i}") for i in range(700)]  # a third and more in one group
        odd = [(None, None, None, None, None), (1, None, "", 0, ""), (5, "é", "En", 3, "ÄB c"), (5, "é", "En", 3, "ÄB c"), (5, "é", "En", 3, "x"), (7, "", None, None, "Q" * 70_000)]
        rows += hot + odd
        assert got(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_trees_of_some_sizes(spark, n):
    rows = [(i, "s", "l", i, "T") for i in range(n)]
    assert got(spark, rows) == plain(rows)
    groups = [(i, f"s{i:03}", "l", i, "T") for i in range(n)]
    assert got(spark, groups) == plain(groups)


def test_narrow_trees_over_many_parts(spark):
    rows = [(i, "ab"[i % 3 == 0], None, i, "T") for i in range(120)]
    assert got(spark, rows, fan=2, part_rows=7) == plain(rows, 2)


def test_no_rows(spark):
    assert got(spark, []) == []


def test_without_tampering_all_rows_verify(spark):
    df = manifest(spark.read.parquet(f"{ROOT}/documents.parquet"))
    assert df.filter(~F.col("verified")).count() == 0 and df.select("root").distinct().count() == 1


def test_the_fetched_nodes_are_the_least(spark):
    nodes = [H(str(i)) for i in range(300)]
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][k: k + 16])) for k in range(0, len(levels[-1]), 16)])
    for a, b in ((0, 300), (0, 1), (17, 18), (15, 33), (16, 32), (100, 299), (299, 300)):
        want = set(missing(a, b, 300))
        asked = set()
        _, root = lifted(a, nodes[a:b], 300, lambda level, i: asked.add((level, i)) or levels[level][i])
        assert root == levels[-1][0] and asked == want
        # nothing that lies above the range's own leaves is fetched
        assert all(not (a // 16**level <= i <= (b - 1) // 16**level) for level, i in want)
