"""Registered queries against their SQL at the smallest scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check import compare
from conftest import ROOT

from ledgerloom.catalog import collect

QUERIES, ORACLES = collect()
CHOSEN = (
    "view_margin_actuals", "view_otif", "view_accounts", "fin_q01", "fin_q03", "fin_q09", "variance_bridge", "driver_rank",
    "recon_gap", "scm_q01", "scm_q08", "com_q06", "com_q09", "rls_filter", "rls_visible_counts", "persona_view",
    "chargeback_group", "budget_overage", "guardrail_eval", "state_replay", "cas_conflicts", "route_fanout",
    "execute_outcomes", "product_match", "gate_and_route", "process_exceptions", "doc_classify", "doc_extract", "doc_chunk",
    "text_mask", "vec_topk", "mem_search", "forecast", "eval_facts", "eval_run_summary", "thread_append", "upsert_latest",
    "receipt_log", "sink_append", "stream_chunks", "stream_detect", "rls_function_views", "forecast_seasonal", "stream_handled",
    "keyed_upsert", "keyed_update", "keyed_delete", "join_anti_handled", "leg_trace", "forecast_compare", "detect_breach", "com_q10",
    "next_best_action", "mem_search_one", "agg_text_stats",
)
#: Queries whose answer is empty at this scale; any other empty answer fails.
EMPTY = ("keyed_delete",)


@pytest.mark.parametrize("key", CHOSEN)
def test_matches_sql(spark, con, key):
    status, rows, _, note = compare(spark, con, ROOT, key, QUERIES[key], ORACLES[key])
    assert status == ("ok-EMPTY" if key in EMPTY else "ok"), note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= 0.9 * len(QUERIES)


def test_oracles_parse(con):
    for sql in ORACLES.values():
        con.execute("EXPLAIN " + sql)


def test_no_query_is_cut_to_a_sample():
    import re

    for key, sql in ORACLES.items():
        assert not re.search(r"TABLESAMPLE|USING SAMPLE", sql, re.I), key
