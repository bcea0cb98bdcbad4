"""Skewed keys, block-wise search and incremental jobs."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import chunk_id
from ledgerloom.operators import documents as D
from ledgerloom.operators import evals as E
from ledgerloom.operators import keyed as K
from ledgerloom.operators import ordered as O
from ledgerloom.operators import vectors as V
from ledgerloom.operators.skew import hot_keys, salted_join
from ledgerloom.sources import io as IO
from ledgerloom.streaming import jobs as S


@pytest.fixture(scope="module")
def skewed(spark):
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, F.lit(7)).otherwise(n % 11).cast("bigint").alias("k"), (n * 7919 % 3000).alias("o"), (n % 5).alias("v")).persist()


def test_row_numbers_of_a_hot_key_span_slices(spark, skewed):
    rows = O.with_row_number(skewed, ("k",), ("o",), slices=16)
    want = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("bigint"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, want.collect()))
    assert O.sliced(skewed, ("k",), ("o",), 16).filter("k = 7").select("_slice").distinct().count() > 3


def test_global_numbering(spark, skewed):
    got = sorted((r.o, r.rn) for r in O.with_row_number(skewed, (), ("o", "k"), slices=8).collect())
    assert [rn for _, rn in got] == list(range(1, 3001))


@pytest.mark.parametrize("fn,ref", [(O.with_lag, F.lag), (O.with_lead, F.lead)])
def test_neighbours_of_a_hot_key(spark, skewed, fn, ref):
    got = fn(skewed, ("k",), ("o",), {"v": "near", "o": "near_o"}, slices=16)
    w = Window.partitionBy("k").orderBy("o")
    want = skewed.withColumn("near", ref("v").over(w)).withColumn("near_o", ref("o").over(w))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_salted_join_is_the_plain_join(spark, skewed):
    side = spark.range(12).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert hot_keys(skewed, ("k",), 0.2).collect()[0].k == 7
    got, want = salted_join(skewed, side, ("k",), share=0.05, parts=8), skewed.join(side, "k")
    cols = ["k", "o", "v", "w"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def brute(cand, queries, k, scoped):
    out = set()
    for q, qv, qs in queries:
        pool = [(c, cv) for c, cv, cs in cand if not scoped or cs == qs]
        scored = sorted(((-round(float(np.dot(cv, qv) / np.linalg.norm(cv) / np.linalg.norm(qv)), 9), c) for c, cv in pool))[:k]
        out |= {(q, c, r) for r, (_, c) in enumerate(scored, 1)}
    return out


@pytest.mark.parametrize("scoped", [False, True])
@pytest.mark.parametrize("shipped", [1000, 5])
def test_topk_equals_brute_force_on_both_paths(spark, scoped, shipped):
    rng = np.random.default_rng(3)
    cand = [(i, rng.normal(size=8).tolist(), "hot" if i % 3 == 0 else f"u{i % 7}") for i in range(240)]
    queries = [(100 + i, rng.normal(size=8).tolist(), "hot" if i % 2 else f"u{i % 9}") for i in range(23)]
    cdf = spark.createDataFrame(cand, "id bigint, embedding array<double>, u string").repartition(5)
    qdf = spark.createDataFrame(queries, "query_id bigint, embedding array<double>, u string")
    got = V.vec_topk(cdf, qdf, 4, scope="u" if scoped else None, max_shipped=shipped, rows_per_block=30)
    assert {(r.query_id, r.id, r["rank"]) for r in got.collect()} == brute(cand, queries, 4, scoped)


def test_topk_ties_go_to_the_lower_id_and_bad_dimensions_fail(spark):
    cdf = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(9)], "id bigint, embedding array<double>").repartition(3)
    qdf = spark.createDataFrame([(1, [2.0, 0.0])], "query_id bigint, embedding array<double>")
    assert [r.id for r in V.vec_topk(cdf, qdf, 3).orderBy("rank").collect()] == [0, 1, 2]
    bad = spark.createDataFrame([(1, [2.0])], "query_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="dimensions"):
        V.vec_topk(cdf, bad, 3).collect()


def test_batch_answer_over_text(spark):
    docs = spark.createDataFrame([(1, "red green blue"), (2, "one two three"), (3, "alpha beta")], "doc_id bigint, text string")
    asks = spark.createDataFrame([(1, "two three one"), (2, "gamma delta")], "query_id bigint, text string")
    chunks, questions = D.doc_embed(D.doc_chunk(docs)), D.doc_embed(asks, "text")
    hits = V.vec_topk(chunks, questions, 1, id_col="chunk_id")
    got = {r.query_id: (r.evidence_id, r.answer_status) for r in V.batch_answer(questions.select("query_id"), hits, 0.95).collect()}
    assert got == {1: ("2_000000", "answered"), 2: (None, "not enough evidence")}


def test_chunks_cover_the_text_and_ids_never_collide(spark):
    text = "".join(chr(97 + i % 26) for i in range(5000))
    df = spark.createDataFrame([("d", text), ("e", ""), ("f", "x" * 1601)], "doc_id string, text string")
    rows = D.doc_chunk(df, size=20, step=16).filter("doc_id = 'd'").orderBy("seq").collect()
    rebuilt = "".join(r.chunk_text[:16] for r in rows[:-1]) + rows[-1].chunk_text
    assert rebuilt == text and len({r.chunk_id for r in rows}) == len(rows) == 313
    assert [r.seq for r in D.doc_chunk(df).filter("doc_id = 'f'").collect()] == [0, 1]
    assert D.doc_chunk(df, drop_covered_tail=True).filter("doc_id = 'f'").count() == 1
    assert D.doc_chunk(df).filter("doc_id = 'e'").count() == 0
    ids = spark.range(998, 1003).select(chunk_id(F.lit("d"), "id", 3).alias("c"))
    assert ids.distinct().count() == 5


def test_html_elements(spark):
    page = "<html><title>T &amp; U</title><script>no()</script><h1>Head</h1><p>One<br>two<p>Three <b>four</b></p><ul><li>x</li></ul>tail</html>"
    df = spark.createDataFrame([(1, page), (2, None)], "page_id bigint, html string")
    got = D.doc_parse(df)
    rows = [(r.element_id, r.element_type, r.content) for r in D.doc_elements(got).orderBy("element_id").collect()]
    assert rows == [(0, "title", "T & U"), (1, "heading", "Head"), (2, "paragraph", "One two"), (3, "paragraph", "Three four"),
                    (4, "list_item", "x"), (5, "text", "tail")]
    assert got.filter("page_id = 1").first().parsed_text.splitlines()[0] == "T & U"
    assert got.filter("page_id = 2").first().parsed_text == ""


def test_extraction_never_guesses(spark):
    df = spark.createDataFrame([("a", "Terms: 90 days"), ("b", "nothing here")], "doc_id string, text string")
    found = D.field_rows(D.doc_extract(df, {"terms": r"Terms: ([0-9]+)"}), "doc_id", ("terms",))
    assert {r.doc_id: r.value for r in found.collect()} == {"a": "90", "b": None}
    standard = spark.createDataFrame([("terms", 0, 60)], "field string, min_value bigint, max_value bigint")
    assert {r.doc_id: r.verdict for r in D.clause_deviation(found, standard).collect()} == {"a": "deviates", "b": "not_found"}
    truth = spark.createDataFrame([("a", "terms", "90"), ("b", "terms", None)], "doc_id string, field string, value string")
    assert D.extract_score(found, truth).first().accuracy == 1.0


def test_upsert_keeps_first_creation_and_latest_update(spark):
    cols = "u string, k string, content string, seq bigint, created_at bigint, updated_at bigint"
    old = spark.createDataFrame([("a", "x", "old", 1, 10, 10), ("a", "y", "stay", 1, 11, 11)], cols)
    new = spark.createDataFrame([("a", "x", "new", 2, 20, 20)], cols)
    got = {r.k: (r.content, r.created_at, r.updated_at) for r in K.upsert_latest(old, new, ("u", "k"), ("content",), ("seq",)).collect()}
    assert got == {"x": ("new", 10, 20), "y": ("stay", 11, 11)}


def test_eval_scores(spark):
    answers = spark.createDataFrame([(1, "Margin fell to 30.7", "39.6 then 30.7"), (2, "It was 99", "30.7"), (3, None, "x"), (4, "fine", "x")],
                                    "question_id bigint, answer string, evidence string")
    facts = spark.createDataFrame([(1, "margin"), (1, "30.7"), (2, "30.7"), (3, "x")], "question_id bigint, fact string")
    got = {r.question_id: (r.correctness, r.groundedness, r.passed) for r in E.eval_facts(answers, facts).collect()}
    assert got == {1: (1.0, 1.0, True), 2: (0.0, 0.0, False), 3: (0.0, 0.0, False), 4: (0.0, 1.0, False)}


def test_question_without_keyword_goes_everywhere(spark):
    q = spark.createDataFrame([(1, "margin?"), (2, "hello")], "question_id bigint, question string")
    got = sorted((r.question_id, r.domain) for r in E.route_domains(q, {"F": ("margin",), "S": ("otif",)}).collect())
    assert got == [(1, "F"), (2, "F"), (2, "S")]


def test_incremental_chunks_replace_changed_documents(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "doc_id bigint, text string"
    spark.createDataFrame([(1, "a" * 5000), (2, "b")], schema).coalesce(1).write.mode("append").parquet(src)
    S.stream_chunks(S.file_stream(spark, src), f"{base}/t", f"{base}/c")
    assert S.current_chunks(spark, f"{base}/t").count() == 5
    spark.createDataFrame([(1, "short"), (3, "new")], schema).coalesce(1).write.mode("append").parquet(src)
    S.stream_chunks(S.file_stream(spark, src), f"{base}/t", f"{base}/c")
    got = {(r.doc_id, r.chunk_text) for r in S.current_chunks(spark, f"{base}/t").collect()}
    assert got == {(1, "short"), (2, "b"), (3, "new")}


def grown(spark, tmp_path):
    """The smallest tables with a sixth region, a nation of three digits, a customer of 13 digits and later months."""
    from conftest import ROOT

    root = str(tmp_path / "grown")
    read = lambda t: spark.read.parquet(f"{ROOT}/{t}.parquet")
    more = {
        "region": {"r_regionkey": 5, "r_name": "ANTARCTICA"}, "nation": {"n_nationkey": 125, "n_name": "NEWLAND", "n_regionkey": 5},
        "customer": {"c_custkey": 1234567890123, "c_nationkey": 125}, "orders": {"o_orderkey": 9_000_001, "o_custkey": 1234567890123},
        "lineitem": {"l_orderkey": 9_000_001, "l_shipdate": "2003-02-01"}, "part": {}, "supplier": {}, "events": {},
    }
    for t, changes in more.items():
        df = read(t)
        extra = df.limit(1)
        for c, v in changes.items():
            extra = extra.withColumn(c, F.lit(v).cast(df.schema[c].dataType))
        (df.unionByName(extra) if changes else df).write.mode("overwrite").parquet(f"{root}/{t}.parquet")
    return root


def test_new_regions_nations_and_months_are_kept(spark, tmp_path):
    from conftest import ROOT
    from ledgerloom.sources.star import Star

    before, after = Star(spark, ROOT), Star(spark, grown(spark, tmp_path))
    assert after.products().count() * 5 == before.products().count() * 6
    assert after.accounts().count() == before.accounts().count() + 1
    new = after.accounts("ANTARCTICA").collect()
    assert [(r.account_id, r.owner_rep, r.industry) for r in new] == [("ACC1234567890123", "REP125", "NEWLAND")]
    late = after.margin_actuals().filter(F.col("month") >= "2003-01-01").join(after.products(), "sku").collect()
    assert [(r.month.isoformat(), r.units) for r in late] and all(r.month.isoformat() == "2003-02-01" for r in late)
    assert after.shipped().count() == before.shipped().count() + 1 == before.table("lineitem").count() + 1


def test_a_table_that_grows_in_one_session_is_read_anew(spark, tmp_path):
    from ledgerloom.sources.star import Star

    root = grown(spark, tmp_path)
    n = Star(spark, root).accounts().count()
    nation = spark.read.parquet(f"{root}/nation.parquet").limit(1).withColumn("n_nationkey", F.lit(126).cast("int")).withColumn("extra", F.lit(1))
    customer = spark.read.parquet(f"{root}/customer.parquet").limit(1).withColumn("c_nationkey", F.lit(126).cast("int"))
    types = {t: dict(spark.read.parquet(f"{root}/{t}.parquet").dtypes) for t in ("nation", "customer")}
    nation.drop("extra").withColumn("n_nationkey", F.col("n_nationkey").cast(types["nation"]["n_nationkey"])).write.mode("append").parquet(f"{root}/nation.parquet")
    customer.withColumn("c_nationkey", F.col("c_nationkey").cast(types["customer"]["c_nationkey"])).write.mode("append").parquet(f"{root}/customer.parquet")
    assert Star(spark, root).accounts().count() == n + 1


def test_rows_with_null_keys_keep_their_place(spark):
    from ledgerloom.operators import ordered as O

    rows = spark.createDataFrame([(None, 1, 10), (None, 2, 20), ("a", 1, 30), ("a", 2, 40)], "k string, o int, v int")
    for slices in (None, 3):
        assert sorted((r.o, r.v, r.rn) for r in O.with_row_number(rows, ["k"], ["o"], slices=slices).collect()) == [(1, 10, 1), (1, 30, 1), (2, 20, 2), (2, 40, 2)]
        assert sorted((r.v, r.p or 0) for r in O.with_lag(rows, ["k"], ["o"], {"v": "p"}, slices=slices).collect()) == [(10, 0), (20, 10), (30, 0), (40, 30)]
        assert sorted((r.v, r.p or 0) for r in O.with_lead(rows, ["k"], ["o"], {"v": "p"}, slices=slices).collect()) == [(10, 20), (20, 0), (30, 40), (40, 0)]


def test_hot_and_ordinary_keys_give_the_same_rows(spark, monkeypatch):
    from ledgerloom.operators import ordered as O

    rows = spark.range(500).selectExpr("if(id % 3 = 0, null, id % 7) AS k", "id AS o")
    plain = sorted(tuple(map(str, r)) for r in O.with_lag(rows, ["k"], ["o"], {"o": "p"}).collect())
    monkeypatch.setattr(O, "HOT_ROWS", 100)
    assert sorted(tuple(map(str, r)) for r in O.with_lag(rows, ["k"], ["o"], {"o": "p"}).collect()) == plain


def test_identifiers_and_missing_tables(spark):
    with pytest.raises(ValueError):
        IO.ident_check("a; DROP TABLE b")
    report = IO.load_star(spark, {"ok_one": lambda: spark.range(3).toDF("x"), "gone": lambda: spark.table("no_such_table")})
    assert [(n, s) for n, s, _ in report] == [("ok_one", "loaded"), ("gone", "failed")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_push_filters_and_avoid_cartesian_products(spark):
    from conftest import ROOT
    from ledgerloom.sources.star import FOCUS_LINE, FOCUS_REGION, H1, Star

    plan = plan_of(Star(spark, ROOT).margin_actuals(H1, FOCUS_LINE, FOCUS_REGION))
    assert "EqualTo(p_type,ECONOMY)" in plan and "EqualTo(r_name,EUROPE)" in plan and "GreaterThanOrEqual(l_shipdate" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "l_tax" in plan and "l_linestatus" not in plan
