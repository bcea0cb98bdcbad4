"""Functions called from SQL text: row filter, forecast table, model calls."""

import re
import shutil

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from ledgerloom.catalog.core import PERSONA_SCHEMA, PERSONAS, STAR_VIEWS
from ledgerloom.operators import forecast as X
from ledgerloom.operators.governance import rls_filter
from ledgerloom.sources.io import read_rows
from ledgerloom.sources.star import Star
from ledgerloom.sqlfunctions import forecasting as FT
from ledgerloom.sqlfunctions import models as M
from ledgerloom.sqlfunctions import rowfilter as W

FILTERED = ("products", "margin_actuals", "margin_budget", "cost_drivers", "otif", "lanes", "service_levels", "accounts")


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture()
def people(spark):
    return read_rows(spark, (*PERSONAS, ("two", "rep", "ASIA", "ALL"), ("two", "rep", "EUROPE", "ALL"), ("o'hara", "rep", "ASIA", "ALL")), PERSONA_SCHEMA)


@pytest.fixture()
def region_filter(spark, people):
    W.create_row_filter(spark, "test_region_rls", people, read_rows(spark, (("auditor", "admins"), ("rep", "others")), "user_email string, group_name string"))
    return "test_region_rls"


@pytest.mark.parametrize("caller", ["controller", "planner", "rep", "two", "auditor", "stranger", "o'hara"])
def test_filter_function_equals_the_operator_on_the_views(spark, people, region_filter, caller):
    star = Star(spark, ROOT)
    for view in FILTERED if caller in ("planner", "two") else ("accounts", "lanes"):
        df = getattr(star, view)()
        column = "dest_region" if view == "lanes" else "region"
        want = rls_filter(df, people, caller, column, admins=("auditor",))
        got = W.visible(df, region_filter, column, caller)
        assert got.columns == df.columns
        size = F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
        assert got.agg(*size).first() == want.agg(*size).first(), view


def test_filter_function_is_a_semi_join(spark, people, region_filter):
    accounts = Star(spark, ROOT).accounts()
    shown = plan(W.visible(accounts, region_filter, "region", "planner"))
    assert "LeftSemi" in shown.split("== Physical Plan ==")[1] and "NestedLoop" not in shown and "CartesianProduct" not in shown


def test_filter_on_stored_personas_reads_them_when_it_runs(spark, people, tmp_path):
    store = str(tmp_path / "personas")
    people.write.parquet(store)
    W.create_row_filter(spark, "test_stored_rls", spark.read.parquet(store))
    df = spark.createDataFrame([(1, "ASIA"), (2, None), (3, "EUROPE")], "n int, `the region` string")
    seen = {c: W.visible(df, "test_stored_rls", "the region", c) for c in ("controller", "two", "rep", "stranger", None)}
    shown = plan(seen["rep"])
    assert "NestedLoop" not in shown and "ExistenceJoin" in shown
    assert {c: sorted(r.n for r in d.collect()) for c, d in seen.items()} == {"controller": [1, 2, 3], "two": [1, 3], "rep": [1], "stranger": [], None: []}


def test_filter_names_are_checked(spark, people):
    with pytest.raises(ValueError):
        W.create_row_filter(spark, "f(x) --", people)
    with pytest.raises(ValueError):
        W.create_row_filter(spark, "f", people, scope="region scope")


def test_view_sizes_from_one_scan(spark):
    star = Star(spark, ROOT)
    assert _scans(star.cells(), "lineitem") == 1
    got = {r.view: r.row_count for r in star.view_rows().collect()}
    assert got == {v: getattr(star, v)().count() for v in STAR_VIEWS}


def _scans(df, table):
    return len(re.findall(rf"FileScan parquet.*?{table}\.parquet", plan(df).split("== Physical Plan ==")[1]))


def test_view_sizes_of_lines_without_partners(spark, tmp_path):
    root = tmp_path / "odd"
    shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns("lineitem.parquet", "orders.parquet", "part.parquet"))
    for t, keep in (("orders", "o_orderkey % 7 <> 0"), ("part", "p_partkey % 5 <> 0")):
        spark.read.parquet(f"{ROOT}/{t}.parquet").filter(keep).write.parquet(f"{root}/{t}.parquet")
    spark.read.parquet(f"{ROOT}/lineitem.parquet").limit(2000).write.parquet(f"{root}/lineitem.parquet")
    star = Star(spark, str(root))
    got = {r.view: r.row_count for r in star.view_rows().collect()}
    assert got == {v: getattr(star, v)().count() for v in STAR_VIEWS}
    none = Star(spark, str(root))
    none.seen["lineitem"] = star.table("lineitem").limit(0)
    assert {r.view: r.row_count for r in none.view_rows().collect()}["otif"] == 0


# -- forecast table


@pytest.fixture()
def ahead(spark):
    FT.register_forecast_table(spark)
    return lambda table, rest="", **frames: spark.sql(f"SELECT * FROM forecast_table(TABLE({table}){', ' if rest.startswith('time') else ' '}{rest})", **frames)


CALL = "PARTITION BY region, time_col => 'month', value_col => 'y'"


def test_forecast_table_equals_the_operator(spark, ahead):
    series = Star(spark, ROOT).margin_actuals().groupBy("region", "month").agg(F.sum("revenue_eur").cast("double").alias("y"))
    for months, least in ((3, 6), (14, 500)):
        got = ahead("SELECT * FROM {s}", f"{CALL}, months => {months}, min_history => {least}", s=series)
        want = X.forecast(series, ("region",), months, min_history=least)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_forecast_table_of_odd_series(spark, ahead):
    from datetime import date

    rows = [("a", "x", date(2020, m, 1), float(m)) for m in range(1, 8)] + [("a", "x", date(2021, 1, 1), None), ("b", None, date(2020, 1, 31), 1.0), (None, "x", None, 2.0)]
    df = spark.createDataFrame(rows, "k string, l string, t date, v double")
    got = {(r.k, r.l, r.ds and r.ds.isoformat()): r for r in ahead("SELECT * FROM {s}", "PARTITION BY (k, l), time_col => 't', value_col => 'v'", s=df).collect()}
    assert {k: r.status for k, r in got.items()} == {**{("a", "x", f"2021-0{m}-01"): "ok" for m in (2, 3, 4)}, ("b", None, None): "too_short", (None, "x", None): "too_short"}
    assert got["a", "x", "2021-02-01"].y_forecast == got["a", "x", "2021-02-01"].y_lower == 14.0
    one = ahead("SELECT t, v FROM {s} WHERE k = 'a'", "time_col => 't', value_col => 'v', months => 1", s=df).collect()
    assert [(r.ds.isoformat(), r.status) for r in one] == [("2021-02-01", "ok")]
    assert ahead("SELECT * FROM {s} WHERE FALSE", "PARTITION BY (k, l), time_col => 't', value_col => 'v'", s=df).count() == 0


@pytest.mark.parametrize("call, said", [
    ("PARTITION BY k, time_col => 't', value_col => 'v', most_rows => 3", "more than 3 rows"), ("time_col => 't', value_col => 'v'", "PARTITION BY k"),
    ("PARTITION BY k, time_col => 'x', value_col => 'v'", "no column 'x'"), ("PARTITION BY k, time_col => 'v', value_col => 't'", "cannot be"),
    ("PARTITION BY k, time_col => 't'", "needs value_col"), ("PARTITION BY k, time_col => 't', value_col => 'v', months => 'three'", "constant int"),
])
def test_forecast_table_refuses(spark, ahead, call, said):
    df = spark.sql("SELECT id % 2 AS k, DATE '2020-01-01' + CAST(id AS INT) AS t, CAST(id AS DOUBLE) AS v FROM range(20)").coalesce(1)
    with pytest.raises(Exception, match=said):
        ahead("SELECT * FROM {s}", call, s=df).collect()


# -- model calls


def counting(folder):
    def load():
        import os
        import uuid

        open(os.path.join(folder, f"loaded-{uuid.uuid4().hex}"), "w").close()

        def model(prompts):
            with open(os.path.join(folder, f"asked-{uuid.uuid4().hex}"), "w") as f:
                f.write("\n".join(prompts))
            return [p.upper() for p in prompts]

        return model

    return load


def test_model_function_loads_once_a_worker_and_asks_once(spark, tmp_path):
    M.register_model(spark, "test_model", counting(str(tmp_path)), at_once=10)
    df = spark.range(0, 4000, 1, 1).selectExpr("CASE WHEN id % 40 < 39 THEN concat('p', id % 40) END AS p")
    for _ in range(2):
        got = df.select("p", F.expr("test_model(p)").alias("a")).collect()
        assert len(got) == 4000 and all(r.a == (r.p and r.p.upper()) for r in got)
    loads = list(tmp_path.glob("loaded-*"))
    asked = [x for f in tmp_path.glob("asked-*") for x in f.read_text().split("\n")]
    assert 1 <= len(loads) <= 2 and len(asked) == 2 * 39 and max(len(f.read_text().split("\n")) for f in tmp_path.glob("asked-*")) == 10


def test_question_function_and_bad_models(spark):
    M.register_model(spark, "test_echo", M.echo)
    M.create_question(spark, "test_ask", "test_echo", "It's \\ said: ")
    assert [r.a for r in spark.sql("SELECT test_ask(q) AS a FROM VALUES ('x'), (CAST(NULL AS STRING)) t(q)").collect()] == ["echo: It's \\ said: x", None]
    M.register_model(spark, "test_short", lambda: (lambda prompts: []))
    with pytest.raises(Exception, match="0 answers to 1 prompts"):
        spark.sql("SELECT test_short('x')").collect()
    M.register_model(spark, "test_echo", lambda: (lambda prompts: ["new"] * len(prompts)), version="2")
    assert spark.sql("SELECT test_echo('x') AS a").first().a == "new"
