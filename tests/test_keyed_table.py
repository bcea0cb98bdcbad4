"""Tables that rewrite only the folders of changed keys, and change feeds."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.documents import doc_chunk
from ledgerloom.sources import keyed_table as KT
from ledgerloom.streaming import jobs as S

SCHEMA = "k long, name string, n int"


def table(spark, base, rows, keys=("k",), schema=SCHEMA, buckets=8):
    return KT.KeyedTable(spark, f"{base}/table", keys, buckets).create(spark.createDataFrame(rows, schema))


def files(t):
    """The files of each bucket, by their times; hidden files and commit marks aside."""
    out = {}
    for d, _, names in os.walk(t.path):
        if "_bucket=" in d:
            out[int(d.rpartition("=")[2])] = sorted((n, os.stat(f"{d}/{n}").st_mtime_ns) for n in names if n.endswith(".parquet") and n[0] not in "._")
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def changed(before, after):
    return {b for b in before.keys() | after.keys() if before.get(b) != after.get(b)}


def test_a_change_leaves_other_folders_alone(spark, tmp_path):
    rows = [(i, f"n{i}", i % 5) for i in range(100)] + [(None, "none", 9)]
    t = table(spark, tmp_path, rows)
    start = files(t)
    assert len(start) == 8 and rows_of(t.read()) == sorted(rows, key=str)
    t.replace(spark.createDataFrame([(7,)], "k long"), spark.createDataFrame([(7, "seven", 1), (7, "again", 2), (8, "not listed", 3)], SCHEMA))
    one = files(t)
    assert len(changed(start, one)) == 1
    want = [r for r in rows if r[0] != 7] + [(7, "seven", 1), (7, "again", 2)]
    assert rows_of(t.read()) == sorted(want, key=str)
    t.update((F.col("k") == 20) | (F.col("n") == 9), {"name": F.concat("name", F.lit("!"))})
    assert 1 <= len(changed(one, files(t))) <= 2
    assert rows_of(t.read().filter("name LIKE '%!'")) == [(20, "n20!", 0), (None, "none!", 9)]
    two = files(t)
    t.update(F.col("k") == -1, {"n": F.lit(1)})
    t.delete(spark.createDataFrame([], "k long"))
    assert changed(two, files(t)) == set()
    with pytest.raises(ValueError):
        t.update(F.lit(True), {"k": F.lit(1)})


def test_emptied_buckets_and_tables(spark, tmp_path):
    t = table(spark, tmp_path, [(i, "x", i) for i in range(20)] + [(None, "y", 1)])
    t.delete(t.read().filter("k IS NULL OR k >= 0"))
    assert t.read().count() == 0 and t.read().columns == ["k", "name", "n"]
    t.replace(spark.createDataFrame([(3,)], "k long"), spark.createDataFrame([(3, "back", 1)], SCHEMA))
    assert rows_of(t.read()) == [(3, "back", 1)]
    none = KT.KeyedTable(spark, str(tmp_path / "none"), ("k",), 4).create(spark.createDataFrame([], SCHEMA))
    assert none.read().count() == 0


def test_one_key_is_read_from_one_folder_without_a_shuffle(spark, tmp_path):
    t = table(spark, tmp_path, [(i, "ab"[i % 2], i) for i in range(50)] + [(None, None, -1)], ("k", "name"))
    assert rows_of(t.of(k=4, name="a")) == [(4, "a", 4)] and rows_of(t.of(k=None, name=None)) == [(None, None, -1)] and t.of(k=4, name="b").count() == 0
    shown = t.of(k=4, name="a")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Exchange" not in shown and re.search(r"PartitionFilters: \[[^\]]*_bucket#\d+ = \d+", shown)


def test_upserts_keep_first_creation_and_last_write(spark, tmp_path):
    schema = "k long, name string, content string, ts timestamp, created_at timestamp, updated_at timestamp"
    at = lambda day: datetime(2026, 1, day)
    row = lambda k, c, d: (k, "m", c, at(d), at(d), at(d))
    t = KT.KeyedTable(spark, f"{tmp_path}/m", ("k", "name"), 4).create(spark.createDataFrame([], schema))
    for rows in ([row(1, "a", 2), row(1, "b", 3), row(2, "c", 1)], [row(1, "old", 1), row(3, None, 1), row(2, "d", 9)], []):
        t.upsert_latest(spark.createDataFrame(rows, schema), ("content",), ("ts",))
    got = {r.k: (r.content, r.created_at.day, r.updated_at.day) for r in t.read().collect()}
    assert got == {1: ("b", 1, 3), 2: ("d", 1, 9), 3: (None, 1, 1)}


STATES = [
    [], [(1, "a", 1), (2, "b", 2), (None, "n", 0), (4, None, 4)], [(1, "A", 1), (2, "b", 2), (3, "c", 3), (None, "N", 0), (4, "d", None)], [(1, "A", 1), (3, "c", 3), (4, None, None)],
]


def test_feed_of_inserts_updates_and_deletes(spark, tmp_path):
    frames = [spark.createDataFrame(s, SCHEMA) for s in STATES]
    kinds = [sorted((str(r.k), r["_change"], r["_version"]) for r in KT.changes_between(a, b, ("k",), n).collect()) for n, (a, b) in enumerate(zip(frames, frames[1:]), 1)]
    assert kinds[1] == [("1", "update", 2), ("3", "insert", 2), ("4", "update", 2), ("None", "update", 2)]
    assert kinds[2] == [("2", "delete", 3), ("4", "update", 3), ("None", "delete", 3)]
    start = spark.createDataFrame([], SCHEMA + ", _version long")
    steps, once = (KT.KeyedTable(spark, f"{tmp_path}/{n}", ("k",), 4).create(start) for n in ("steps", "once"))
    for n, (a, b) in enumerate(zip(frames, frames[1:]), 1):
        KT.write_feed(KT.changes_between(a, b, ("k",), n), f"{tmp_path}/feed")
        S.follow_feed(S.file_stream(spark, f"{tmp_path}/feed"), steps.apply, f"{tmp_path}/c1")
        assert rows_of(steps.read().drop("_version")) == sorted(STATES[n], key=str)
    S.follow_feed(S.file_stream(spark, f"{tmp_path}/feed"), once.apply, f"{tmp_path}/c2")
    assert rows_of(once.read()) == rows_of(steps.read())
    once.apply(spark.read.parquet(f"{tmp_path}/feed"))  # the same batch again
    assert rows_of(once.read()) == rows_of(steps.read())
    late = spark.createDataFrame([(1, "late", 9, "update", 1)], SCHEMA + ", _change string, _version long")
    once.apply(late)
    assert rows_of(once.read()) == rows_of(steps.read())


def test_chunks_follow_changed_and_deleted_documents(spark, tmp_path):
    schema = "doc_id long, text string"
    states = [[], [(1, "a" * 5000), (2, "b" * 10), (3, "c" * 2500)], [(1, "short"), (2, "b" * 10), (3, "c" * 2500), (4, "new")], [(1, "short"), (4, "new" * 1000)]]
    frames = [spark.createDataFrame(s, schema) for s in states]
    t = KT.KeyedTable(spark, f"{tmp_path}/chunks", ("doc_id",), 4).create(doc_chunk(frames[0]))
    for n, (a, b) in enumerate(zip(frames, frames[1:]), 1):
        KT.write_feed(KT.changes_between(a, b, ("doc_id",), n), f"{tmp_path}/feed")
        S.follow_feed(S.file_stream(spark, f"{tmp_path}/feed"), S.chunk_changes(t), f"{tmp_path}/c")
        assert rows_of(t.read()) == rows_of(doc_chunk(b))


def test_appending_to_stored_threads_moves_nothing(spark):
    from ledgerloom.operators.memory import thread_append
    from ledgerloom.sources.io import bucketed

    turns = spark.createDataFrame([(c, t, "user", f"{c} {t}") for c in range(30) for t in range(c % 5)], "conv_id long, turn long, role string, text string")
    new = spark.createDataFrame([(c, s, f"q{s}", "a") for c in range(40) for s in (3, 9)], "conv_id long, seq long, question string, answer string")
    stored = thread_append(bucketed(turns, ("conv_id",), 4), bucketed(new, ("conv_id",), 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = stored._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in shown and "Exchange" not in shown
    assert rows_of(stored) == rows_of(thread_append(turns, new))


def test_long_values_of_the_old_state_are_compared_by_digest(spark):
    import hashlib

    long = "x" * 500
    old = [(1, long, b"a"), (2, long, b"a"), (3, hashlib.sha256(b"y" * 40).hexdigest(), hashlib.sha256(b"y" * 40).digest()), (4, None, None), (5, "", b""), (6, "z" * 32, b"")]
    new = [(1, long, b"a"), (2, long + "x", b"a"), (3, hashlib.sha256(b"y" * 40).hexdigest(), b"y" * 40), (4, None, None), (5, None, b""), (7, long, None)]
    a, b = (spark.createDataFrame(rows, "k long, t string, v binary") for rows in (old, new))
    found = KT.changes_between(a, b, ("k",), 3)
    got = {r.k: (r["_change"], r.t, r.v and bytes(r.v)) for r in found.collect()}
    assert got == {2: ("update", long + "x", b"a"), 3: ("update", new[2][1], b"y" * 40), 5: ("update", None, b""), 6: ("delete", None, None), 7: ("insert", long, None)}
    assert "sha2" in found._jdf.queryExecution().optimizedPlan().toString()


def test_texts_of_a_feed_are_not_stored_on_their_way(spark, tmp_path, monkeypatch):
    stored = []
    for module in (KT, S):
        monkeypatch.setattr(module, "cut_lineage", lambda df, keep=KT.cut_lineage: stored.append(set(df.columns)) or keep(df))
    docs = spark.createDataFrame([(1, "a" * 3000, "insert", 1), (2, "b", "insert", 1), (2, "c" * 1700, "update", 2), (3, "d", "insert", 1), (3, None, "delete", 2)],
                                 "doc_id long, text string, _change string, _version long")
    table = KT.KeyedTable(spark, f"{tmp_path}/t", ("doc_id",), 4).create(S.doc_chunk(docs.limit(0)))
    S.chunk_changes(table)(docs)
    S.chunk_changes(table)(docs.filter("doc_id = 1").withColumn("text", docs.doc_id.cast("string")))
    assert {(r.doc_id, r.seq, r.chunk_text) for r in table.read().collect()} == {(1, 0, "1"), (2, 0, "c" * 1700), (2, 1, "c" * 100)}
    assert all(columns == {"doc_id"} for columns in stored)
