"""Proposals kept by keyed state: the same however the input is cut, raised once, closed when handled."""

import random
from collections import defaultdict
from datetime import date

import pytest

from ledgerloom.streaming import jobs as S
from ledgerloom.streaming import proposals as P

LINES = "lane string, region string, month date, l_linestatus string, l_returnflag string"
ACTIONS = "breach_key string, status string, seq long"
MAY, JUNE = date(2026, 5, 1), date(2026, 6, 1)


class Job:
    """A folder of line files, one of action files, and the job over both."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)
        for name, schema in (("lines", LINES), ("actions", ACTIONS)):
            spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{self.base}/{name}")

    def put(self, lines=(), actions=()):
        for name, rows, schema in (("lines", lines, LINES), ("actions", actions, ACTIONS)):
            if rows:
                self.spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{self.base}/{name}")

    def run(self, per_batch=None):
        lines, actions = (S.file_stream(self.spark, f"{self.base}/{n}", files_per_batch=per_batch) for n in ("lines", "actions"))
        P.stream_proposals(lines, f"{self.base}/log", f"{self.base}/checkpoint", 20.0, actions, partitions=2)
        return self

    def open(self):
        return {r.breach_key: (r.region, r.otif_pct, r.orders, r.status) for r in P.open_proposals(self.spark, f"{self.base}/log").collect()}

    def log(self):
        rows = self.spark.read.option("basePath", f"{self.base}/log").parquet(f"{self.base}/log").collect()
        return [(r.lane, r.month, r.decision, r.orders) for r in sorted(rows, key=lambda r: (r.batch_id, str(r.lane), str(r.month)))]


def plain(lines, actions):
    totals, latest = defaultdict(lambda: [0, 0]), {}
    for lane, region, month, status, flag in lines:
        totals[lane, region, month][0] += 1
        totals[lane, region, month][1] += status == "F" and flag not in ("R", None)
    for key, status, seq in actions:
        if key not in latest or seq >= latest[key][0]:
            latest[key] = (seq, status)
    out = {}
    for (lane, region, month), (orders, perfect) in totals.items():
        key, pct = f"{lane}|{month}", P.share(perfect, orders)
        if pct < 20.0 and latest.get(key, (0, None))[1] not in P.LIVE:
            out[key] = (region, pct, orders, "proposed")
    return out


def test_one_batch_and_six_give_the_same_proposals(spark, tmp_path):
    rng = random.Random(2)
    lines = [(f"L{rng.randrange(6)}", None, rng.choice([MAY, JUNE]), rng.choice("OOOF"), rng.choice("NNR")) for _ in range(300)]
    lines = [(x[0], "R" + x[0], *x[2:]) for x in lines]
    actions = [(f"L{rng.randrange(6)}|{rng.choice([MAY, JUNE])}", rng.choice(["executed", "rejected", "failed", "approved"]), n) for n in range(9)]
    want = plain(lines, actions)
    assert want
    one = Job(spark, tmp_path / "one")
    one.put(lines, actions)
    assert one.run().open() == want
    six = Job(spark, tmp_path / "six")
    for k in range(6):
        six.put(lines[k * 50:(k + 1) * 50], actions[k::6])
        if k % 2:
            six.run()  # and again from the checkpoint
    assert six.run(per_batch=1).open() == want
    assert six.run().open() == want


def test_raised_revised_withdrawn_closed_and_never_raised_again(spark, tmp_path):
    bad, good = ("L1", "R", MAY, "O", "N"), ("L1", "R", MAY, "F", "N")
    job = Job(spark, tmp_path / "job")
    job.put([bad])
    assert job.run().log() == [("L1", MAY, "raised", 1)]
    job.put([bad])
    job.run()
    job.put([good])
    job.run()
    assert job.open() == {}
    job.put([bad] * 7)
    assert set(job.run().open()) == {"L1|2026-05-01"}
    job.put(actions=[("L1|2026-05-01", "approved", 4)])
    job.run()
    job.put([bad] * 5)
    job.run()
    assert job.open() == {}
    job.put(actions=[("L1|2026-05-01", "rejected", 3)])  # older than the approval: changes nothing
    job.run()
    assert job.open() == {}
    job.put(actions=[("L1|2026-05-01", "failed", 5)])
    assert job.run().open() == {"L1|2026-05-01": ("R", 6.7, 15, "proposed")}
    assert [d for _, _, d, _ in job.log()] == ["raised", "revised", "withdrawn", "raised", "closed", "raised"]


def test_handled_before_it_was_seen_and_odd_rows(spark, tmp_path):
    job = Job(spark, tmp_path / "odd")
    job.put([(None, None, MAY, "O", None), ("L1", "R", None, "O", "N"), ("L3", "R", JUNE, None, "N")],
            [("L2|2026-06-01", "executed", 1), ("nonsense", "executed", 2), (None, "executed", 3), ("L9|2026-06-01", None, 4), ("L9|2026-06-01", "executed", None)])
    job.run()
    job.put([("L2", "R", JUNE, "O", "N"), ("L9", "R", JUNE, "O", "N")])
    got = {(lane, month): decision for lane, month, decision, _ in job.run().log()}
    assert got == {(None, MAY): "raised", ("L1", None): "raised", ("L3", JUNE): "raised", ("L9", JUNE): "raised"}


@pytest.mark.parametrize("perfect, orders, pct", [(1, 3, 33.3), (1, 8, 12.5), (1, 16, 6.3), (0, 4, 0.0), (5, 5, 100.0)])
def test_share_rounds_as_sql(spark, perfect, orders, pct):
    assert P.share(perfect, orders) == pct == spark.sql(f"SELECT round(CAST({perfect} AS DOUBLE) / {orders} * 100, 1)").first()[0]
    assert P.share(0, 0) is None


@pytest.mark.parametrize("files", (1, 3))
def test_a_table_is_streamed_as_one_file_and_as_a_folder_of_files(spark, tmp_path, files):
    from ledgerloom.catalog import collect

    rows = spark.createDataFrame([(i, "word " * 500) for i in range(9)], "doc_id bigint, text string").repartition(files)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    if files == 1:
        (part,) = (tmp_path / "documents.parquet").glob("part-*")
        part.rename(tmp_path / "one")
        root = tmp_path / "as_file"
        root.mkdir()
        (tmp_path / "one").rename(root / "documents.parquet")
    else:
        root = tmp_path
    got = collect()[0]["stream_chunks"](spark, str(root)).groupBy("doc_id").count().collect()
    assert {(r[0], r[1]) for r in got} == {(i, 2) for i in range(9)}


def test_a_task_sends_each_lane_month_once():
    import pyarrow as pa

    schema = pa.schema([("lane", pa.string()), ("region", pa.string()), ("month", pa.date32()), pa.field("perfect", pa.int64(), nullable=False)])
    batches = [pa.record_batch([["a", "b", "a"], ["X", None, "X"], [MAY, None, MAY], [1, 0, n]], schema=schema) for n in (0, 1, 1)]
    got = [r for batch in P._add_up(iter(batches)) for r in batch.to_pylist()]
    assert sorted((r["lane"], r["region"], r["month"], r["orders"], r["perfect"], r["status"], r["seq"]) for r in got) == [
        ("a", "X", MAY, 6, 5, None, None), ("b", None, None, 3, 0, None, None)]


def test_tasks_of_a_streaming_join_are_counted_by_its_rows(spark, monkeypatch):
    from conftest import ROOT

    from ledgerloom.catalog import jobs
    from ledgerloom.sources.star import Star

    monkeypatch.setattr(jobs, "TASK_ROWS", 100)
    star = Star(spark, ROOT)
    tasks = -(-star.rows("lineitem") // 100)
    plan = jobs._lane_stream(star)._jdf.queryExecution().analyzed().toString()
    assert tasks > jobs.STATE_PARTITIONS and f", {tasks}" in plan and "RepartitionByExpression [l_orderkey" in plan
