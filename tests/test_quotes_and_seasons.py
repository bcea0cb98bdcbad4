"""Product matching by postings against all products, and forecasts with a season."""

import math
import random
import re
from datetime import date

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from ledgerloom.operators import forecast as X
from ledgerloom.operators.detect import detect_breach
from ledgerloom.operators.quotes import product_match
from ledgerloom.sources.star import Star

REGIONS = ("N", "S", None)


def plain(requests, products):
    """Every request against every product."""
    out = {}
    for rid, text, region in requests:
        words = [w for w in re.findall("[a-z]+", (text or "").lower()) if len(w) > 2]
        scored = [(-sum(w in (name or "").lower() for w in words), sku, reg) for sku, name, reg in products]
        scored = sorted((s, sku, reg) for s, sku, reg in scored if s) if words else []
        local = [x for x in scored if x[2] == region and region is not None]
        best = (local or scored or [(None, None, None)])[0]
        out[rid] = (best[1], best[0] and -best[0], bool(local))
    return out


@pytest.mark.parametrize("common", [0, 3, 1000])
def test_product_match_against_all_products(spark, common):
    rng = random.Random(4)
    words = ["paint", "wall", "red", "blue", "seal", "sealing", "coat", "x", "ab", "top"]
    names = [f"Paint {rng.choice(words)}-{rng.choice(words)} {n % 7}" for n in range(30)] + [None, "", "Étoile rouge"]
    products = [(f"SKU{n:03}{r}", name, r) for n, name in enumerate(names) for r in ("N", "S") if rng.random() < 0.8] + [("SKU-x", "paint wall red blue", None)]
    asked = [" ".join(rng.choice(words) for _ in range(rng.randrange(6))) for _ in range(25)] + [None, "", "paint", "PAINT paint wall", "zzz", "ain", "a b c", "sealin rouge"]
    requests = [(n, t, rng.choice(["N", "S", "elsewhere", None])) for n, t in enumerate(asked + asked)]
    got = product_match(spark.createDataFrame(requests, "id long, request_text string, region string"),
                        spark.createDataFrame([(s, n, r) for s, n, r in products], "sku string, product_name string, region string"), common=common)
    # a product of an unknown region counts anywhere, names of one text share their lowest SKU per region
    assert {r.id: (r.sku, r.name_score, r.in_region) for r in got.collect()} == plain(requests, products)


def test_a_word_in_every_name_makes_no_pairs(spark):
    products = spark.range(3000).selectExpr("concat('S', lpad(id, 5, '0')) AS sku", "concat('Paint no ', id) AS product_name", "'N' AS region")
    requests = spark.range(400).selectExpr("id", "concat('paint please ', id % 20) AS request_text", "'N' AS region")
    df = product_match(requests, products, common=10)
    assert df.agg(F.count("*"), F.min("sku"), F.max("sku"), F.max("name_score")).first() == (400, "S00000", "S00000", 1)
    assert product_match(requests.limit(0), products).count() == 0 and product_match(requests, products.limit(0)).filter("sku IS NULL").count() == 400


def test_seasonal_forecast_beats_the_line_on_a_held_back_half_year(spark):
    rng = random.Random(1)
    months = [date(2015 + n // 12, n % 12 + 1, 1) for n in range(66)]
    rows = [(k, m, 1000 + 5 * n + 200 * math.sin(2 * math.pi * m.month / 12 + i) + rng.gauss(0, 10)) for i, k in enumerate("ab") for n, m in enumerate(months)]
    rows += [("c", m, float(n)) for n, m in enumerate(months[:20])] + [("d", months[0], 1.0)] + [(None, m, 7.0) for m in months]
    df = spark.createDataFrame(rows, "k string, month date, y double")
    history, held = df.filter("month < '2020-01-01'"), {(r.k, r.month): r.y for r in df.filter("month >= '2020-01-01'").collect()}
    season = {(r.k, r.ds): r for r in X.forecast_seasonal(history, ("k",), 6).collect()}
    line = {(r.k, r.ds): r for r in X.forecast(history, ("k",), 6).collect()}
    assert season.keys() == line.keys()
    assert {k: {r.model for (x, _), r in season.items() if x == k} for k in ("a", "b", "c", "d", None)} == {
        "a": {"season"}, "b": {"season"}, "c": {"line"}, "d": {"line"}, None: {"season"}}
    for k in "ab":
        error = [sum(abs(f[k, m].y_forecast - y) for (x, m), y in held.items() if x == k) for f in (season, line)]
        assert error[0] < error[1] / 4
        assert all(season[k, m].y_lower <= y <= season[k, m].y_upper for (x, m), y in held.items() if x == k)
        assert all(r.y_upper - r.y_lower < 100 for (x, _), r in season.items() if x == k)
    assert all((r.y_forecast, r.y_lower, r.y_upper) == (7, 7, 7) for (x, _), r in season.items() if x is None)
    assert season["d", None].status == "too_short"
    assert all(season[key][:6] == line[key][:6] for key in line if key[0] == "c")


def test_seasonal_forecast_equals_least_squares(spark):
    import numpy as np

    rng = random.Random(2)
    months = [date(2015 + n // 12, n % 12 + 1, 1) for n in range(40) if n not in (3, 17)]
    ys = [rng.gauss(5000, 900) for _ in months]
    got = X.forecast_seasonal(spark.createDataFrame([("a", m, y) for m, y in zip(months, ys)], "k string, month date, y double"), ("k",), 5).collect()
    row = lambda m: [m.year * 12 + m.month - 23880, *(float(m.month == i) for i in range(1, 13))]
    a = np.array([row(m) for m in months])
    b, rest = np.linalg.lstsq(a, np.array(ys), rcond=None)[:2]
    inverse = np.linalg.inv(a.T @ a)
    for r in got:
        x = np.array(row(r.ds))
        sd = math.sqrt(rest[0] / (len(ys) - 13) * (1 + x @ inverse @ x))
        assert abs(r.y_forecast - x @ b) <= 0.51 and abs(r.y_upper - (x @ b + 1.96 * sd)) <= 0.51 and abs(r.y_lower - (x @ b - 1.96 * sd)) <= 0.51


def test_latest_breach_month(spark):
    rows = [("A", "2020-01-01", 1, 0.1), ("B", "2020-02-01", 1, 0.1), ("C", "2020-02-01", 1, 0.9), ("D", "2020-03-01", 1, 0.9)]
    df = spark.createDataFrame(rows, "lane string, month string, orders long, otif_pct double").withColumn("region", F.lit("R"))
    assert [r.lane for r in detect_breach(df, 50.0).collect()] == ["B"]
    assert detect_breach(df.limit(0), 50.0).count() == 0


def test_sales_and_signals_share_one_scan(spark):
    star = Star(spark, ROOT)
    both = star.account_months()
    want = star.churn_signals().join(star.sales_actuals(), ["account_id", "month"])
    columns = sorted(want.columns)
    size = F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    assert sorted(both.columns) == columns and both.agg(*size).first() == want.agg(*size).first()
    assert len(re.findall(r"FileScan parquet.*?lineitem\.parquet", both._jdf.queryExecution().toString().split("== Physical Plan ==")[1])) == 1
