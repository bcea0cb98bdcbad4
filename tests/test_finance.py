from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.operators import metrics as M
from ledgerloom.operators import quotes as Q
from ledgerloom.operators import variance as V
from ledgerloom.plans import commercial, finance, supply

PERIODS = (("Q1", date(2026, 1, 1), date(2026, 3, 1)), ("Q2", date(2026, 4, 1), date(2026, 6, 1)))
METRIC_SCHEMA = ("product_line string, region string, period string, units bigint, price_per_unit_eur double, "
                 "cogs_per_unit_eur double, raw_mat_per_unit_eur double, fx_rate_to_eur double")


def facts(spark):
    products = spark.createDataFrame([("A-1", "A", "NORTH"), ("A-2", "A", "NORTH"), ("B-1", "B", "NORTH")],
                                     "sku string, product_line string, region string")
    rows = []
    for sku, rev1, margin1, rev2, margin2 in (("A-1", 100.0, 40.0, 100.0, 30.0), ("A-2", 300.0, 118.84, 300.0, 93.0), ("B-1", 50.0, 20.0, 50.0, 20.2)):
        rows += [(sku, "NORTH", date(2026, 2, 1), 10, rev1, rev1 - margin1, margin1), (sku, "NORTH", date(2026, 5, 1), 10, rev2, rev2 - margin2, margin2)]
    actuals = spark.createDataFrame(
        rows, "sku string, region string, month date, units bigint, revenue_eur double, cogs_eur double, gross_margin_eur double")
    return actuals, products


def test_margin_decline_is_revenue_weighted_and_rounded_after_subtracting(spark):
    actuals, products = facts(spark)
    got = [tuple(r) for r in finance.fin_q03(actuals, products, PERIODS).collect()]
    # (40+118.84)/400 = 39.71, (30+93)/400 = 30.75
    assert got == [("A", "NORTH", 39.7, 30.8, -9.0), ("B", "NORTH", 40.0, 40.4, 0.4)]


def test_segment_isolation(spark):
    actuals, products = facts(spark)
    swing = M.margin_swing(actuals, products, ("product_line", "region"), PERIODS)
    row = M.segment_isolation(swing, F.col("product_line") == "A").first()
    assert (row.focus_delta_pp, row.max_other_abs_pp, row.others) == (-8.96, 0.4, 1)


def test_missing_period_gives_null_delta_last(spark):
    actuals, products = facts(spark)
    only = actuals.filter((F.col("sku") != "B-1") | (F.col("month") < F.lit(date(2026, 4, 1))))
    assert finance.fin_q03(only, products, PERIODS).collect()[-1].delta_pp is None


def bridge_of(spark, q1, q2, **kw):
    df = spark.createDataFrame([("L", "R", "Q1", *q1), ("L", "R", "Q2", *q2)], METRIC_SCHEMA)
    return V.variance_bridge(df, "Q1", "Q2", **kw).first()


def test_bridge_signs(spark):
    row = bridge_of(spark, (100, 34.5, 20.8, 11.5, 0.92), (101, 32.7, 22.7, 13.4, 0.88))
    assert row.volume_pp == 0.0 and row.price_pp < 0 and row.cost_pp < 0 and row.fx_pp < 0
    other = bridge_of(spark, (100, 34.5, 20.8, 11.5, 0.92), (101, 32.7, 22.7, 13.4, 0.88), fx_convention="purchase")
    assert other.fx_pp > 0 and other.total_pp == row.total_pp


def test_bridge_without_rate_books_no_fx(spark):
    row = bridge_of(spark, (100, 10.0, 6.0, 3.0, None), (100, 10.0, 7.0, 4.0, None))
    assert row.fx_pp == 0.0 and row.cost_pp == row.total_pp == -10.0


money = st.integers(200, 9000).map(lambda c: c / 100)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(money, money, money, money, money, money, st.integers(1, 999), st.integers(1, 999)), min_size=5, max_size=20))
def test_bridge_legs_sum_to_the_change(spark, rows):
    data = []
    for i, (p0, c0, r0, p1, c1, r1, f0, f1) in enumerate(rows):
        data += [("L", str(i), "Q1", 10, p0, c0, r0, f0 / 500), ("L", str(i), "Q2", 12, p1, c1, r1, f1 / 500)]
    for r in V.variance_bridge(spark.createDataFrame(data, METRIC_SCHEMA), "Q1", "Q2").collect():
        assert abs(r.price_pp + r.volume_pp + r.fx_pp + r.cost_pp - r.total_pp) <= 0.25 + 1e-6


def test_driver_rank_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("L", "R", -3.0, 0.0, -2.0, -3.0)], "product_line string, region string, price_pp double, volume_pp double, fx_pp double, cost_pp double")
    got = [(r.driver_rank, r.driver) for r in V.driver_rank(df).orderBy("driver_rank").collect()]
    assert got == [(1, "cost"), (2, "price"), (3, "fx"), (4, "volume")]


def test_metric_view_reaggregates_and_rejects_unknown_names(spark):
    actuals, products = facts(spark)
    view = M.margin_metrics(actuals, products, PERIODS)
    whole = view.query((), ("gross_margin_pct",)).first().gross_margin_pct
    assert whole == pytest.approx((40 + 30 + 118.84 + 93 + 20 + 20.2) / 900)
    with pytest.raises(ValueError):
        view.query(("colour",), ("units",))


def test_recon_gap_counts_a_missing_bucket_row(spark):
    total = spark.createDataFrame([("a", 10.0), ("b", 7.0)], "k string, cogs double")
    parts = spark.createDataFrame([("a", 4.0, 6.0)], "k string, x double, y double")
    assert M.recon_gap(parts, ("x", "y"), total, "cogs", ("k",), ()).first().max_gap == 7.0


def test_otif_is_order_weighted_with_rebuilt_counts(spark):
    df = spark.createDataFrame([(0.3333, 3), (1.0, 1)], "otif_pct double, orders bigint")
    assert df.agg(C.otif_pct().alias("p")).first().p == 50.0


def test_lane_lead_time_above_mode_mean(spark):
    lanes = spark.createDataFrame([("a->x", "a", "x", "road", 9), ("b->x", "b", "x", "road", 3), ("c->x", "c", "x", "sea", 30)],
                                  "lane_id string, origin_plant string, dest_region string, mode string, lead_time_days bigint")
    got = supply.scm_q02(lanes).collect()
    assert (got[0].lane_id, got[0].mode_avg_days, got[0].days_above_mode_avg) == ("a->x", 6.0, 3.0)


def test_at_risk_accounts(spark):
    churn = spark.createDataFrame([("a", date(2026, 6, 1), 0.865, 1, 1, 1), ("b", date(2026, 6, 1), 0.7, 1, 1, 1), ("c", date(2026, 6, 1), 0.9, 1, 1, 1)],
                                  "account_id string, month date, churn_score double, last_order_days bigint, complaint_count bigint, nps bigint")
    accounts = spark.createDataFrame([("a", "A", "N", "S", "r"), ("b", "B", "N", "S", "r"), ("c", "C", "M", "S", "r")],
                                     "account_id string, account_name string, region string, segment string, owner_rep string")
    got = commercial.com_q01(churn, accounts, "N", "S", date(2026, 6, 1)).collect()
    assert [r.account_id for r in got] == ["a"]


def test_quote_draft_golden(spark):
    df = spark.createDataFrame([("S", 38.52, 22.82, 5000, 10.0), ("S", 38.52, 22.82, 10, 20.0), ("S", 30.0, 25.0, 1, 0.0)],
                               "sku string, list_price_eur double, standard_cost_eur double, quantity_units bigint, discount_pct double")
    a, b, c = Q.quote_draft(df).collect()
    assert (a.net_unit_price_eur, a.margin_pct, a.total_margin_eur, a.requires_escalation) == (34.67, 34.2, 59250.0, False)
    assert (b.discount_flag, b.margin_flag) == (True, False)
    assert (c.discount_flag, c.margin_flag) == (False, True)
    text = Q.quote_rationale(Q.quote_draft(df)).collect()
    assert "FLAGGED" not in text[0].rationale and "discount above limit." in text[1].rationale


def test_product_match_prefers_region_then_score_then_sku(spark):
    products = spark.createDataFrame([("s3", "red steel bolt", "N"), ("s1", "red bolt", "S"), ("s2", "steel bolts red", "S")], "sku string, product_name string, region string")
    asks = spark.createDataFrame([(1, "Red steel BOLT", "N"), (2, "red bolt", "S"), (3, "steel", "X"), (4, "of no use", "N"), (5, "bol", "S")],
                                 "id bigint, request_text string, region string")
    got = {r.id: (r.sku, r.name_score, r.in_region) for r in Q.product_match(asks, products).collect()}
    assert got == {1: ("s3", 3, True), 2: ("s1", 2, True), 3: ("s2", 1, False), 4: (None, None, False), 5: ("s1", 1, True)}
