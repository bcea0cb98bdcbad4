from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import actions as A
from ledgerloom.operators import detect as X
from ledgerloom.operators import governance as G
from ledgerloom.operators import keyed as K
from ledgerloom.sources.io import read_rows

SCHEMA = "action_id bigint, action_type string, status string, region string, payload string"


def verdicts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.action_id: r for r in A.guardrail_eval(df, A.policy_table(spark, ("EU",))).collect()}


def test_guardrail_rules(spark):
    got = verdicts(spark, [
        (1, "scm_reorder", "approved", "EU", '{"amount_eur": 92000}'),
        (2, "scm_reorder", "approved", "EU", '{"amount_eur": 205000}'),
        (3, "scm_reorder", "approved", "EU", '{"spend_eur": null, "amount_eur": 205000}'),
        (4, "scm_reorder", "approved", "EU", '{"spend_eur": "n/a"}'),
        (5, "teleport", "approved", "EU", '{"spend_eur": 1}'),
        (6, "quote_send", "approved", None, '{"discount_pct": 15}'),
        (7, "quote_send", "approved", "EU", '{"discount_pct": "lots"}'),
        (8, "escalation", "approved", None, "not json"),
        (9, "price_change", "approved", "MARS", '{"discount_pct": 10.01, "spend_eur": 9e12}'),
    ])
    assert {k: v.breaches for k, v in got.items()} == {
        1: [], 2: ["max_spend_eur"], 3: ["max_spend_eur"], 4: ["max_spend_eur"], 5: ["action_type_allowed"],
        6: ["allowed_regions"], 7: ["max_discount_pct"], 8: [], 9: ["max_discount_pct", "allowed_regions"]}
    assert got[8].requires_approval is False and got[1].requires_approval is True
    assert [c.rule for c in got[1].checks if c.applicable] == [
        "action_type_allowed", "max_spend_eur", "allowed_regions", "requires_approval"]


def test_empty_region_list_is_no_limit(spark):
    policies = read_rows(spark, [("t", None, None, [], True)],
                         "action_type string, max_discount_pct decimal(5,2), max_spend_eur decimal(14,2), allowed_regions array<string>, requires_approval boolean")
    df = spark.createDataFrame([(1, "t", "approved", None, "{}")], SCHEMA)
    assert A.guardrail_eval(df, policies).first().passed


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 300_000), min_size=2, max_size=12))
def test_guardrail_is_monotone_in_spend(spark, spends):
    got = verdicts(spark, [(i, "scm_reorder", "approved", "EU", f'{{"spend_eur": {s}}}') for i, s in enumerate(sorted(spends))])
    passed = [got[i].passed for i in range(len(spends))]
    assert passed == sorted(passed, reverse=True)


def events(spark, rows):
    return spark.createDataFrame(
        [(a, i, datetime(2026, 1, 1, 0, m), s, who) for i, (a, m, s, who) in enumerate(rows)],
        "action_id bigint, event_id bigint, ts timestamp, status string, actor string")


def test_replay_orders_equal_times_by_id_and_flags_illegal_steps(spark):
    ev = events(spark, [(1, 0, "proposed", "a"), (1, 1, "approved", "b"), (1, 1, "executing", "c"), (1, 2, "executed", "c"),
                        (1, 3, "approved", "d"), (2, 0, "approved", "a"), (3, 0, "proposed", "a"), (3, 1, "escalated", "g"), (3, 2, "approved", "h")])
    got = [(r.action_id, r.status, r.legal) for r in A.state_replay(ev).orderBy("action_id", "event_id").collect()]
    assert [x[2] for x in got] == [True, True, True, True, False, False, True, True, True]


def test_nothing_legal_leaves_a_terminal_state():
    assert not [t for t in A.TRANSITIONS if t[0] in A.TERMINAL]


def test_current_state_fold(spark):
    ev = events(spark, [(1, 0, "proposed", "a"), (1, 1, "approved", "boss"), (1, 2, "executing", "x"), (1, 3, "failed", "x")])
    row = A.state_current(ev).first()
    assert (row.status, row.approved_by, row.executed_at.minute, row.decided_at.minute) == ("failed", "boss", 3, 1)


def test_route_bodies_have_fallbacks(spark):
    df = spark.createDataFrame([(1, "scm_reorder", "approved", "EU", '{"vendor": "V", "qty": 0, "quantity": "7", "spend_eur": 5}'),
                                (2, "escalation", "approved", "EU", '{"reason": "why", "subject": ""}'),
                                (3, "quote_send", "approved", "EU", "{}"), (4, "unknown", "approved", "EU", "{}")], SCHEMA)
    got = {(r.action_id, r.step): (r.system, r.body) for r in A.route_fanout(df).collect()}
    assert got[1, 0] == ("erp_po", '{"supplier":"V","sku":"SKU-UNKNOWN","qty":7,"amount_eur":5.00}')
    assert got[2, 0] == ("ticket", '{"summary":"why","priority":"P3"}')
    assert got[3, 0][0] == "email" and got[3, 1] == ("crm", '{"account":"Unknown account","task":"Follow-up"}')
    assert (4, 0) not in got


def test_outcome_ladder(spark):
    rows = [(1, "quote_send", "approved", "EU", "{}"), (2, "quote_send", "approved", "EU", "{}"), (3, "quote_send", "approved", "EU", "{}"),
            (4, "quote_send", "proposed", "EU", "{}"), (5, "nope", "approved", "EU", "{}"), (6, "quote_send", "approved", "MARS", "{}"),
            (7, "quote_send", "approved", "EU", "{}")]
    v = A.guardrail_eval(spark.createDataFrame(rows, SCHEMA), A.policy_table(spark, ("EU",)))
    results = spark.createDataFrame([(1, 0, True, "E1"), (1, 1, True, "C1"), (2, 0, True, "E2"), (2, 1, False, None), (3, 0, False, None), (7, 0, True, "E7")],
                                    "action_id bigint, step bigint, ok boolean, ref_id string")
    got = {r.action_id: (r.outcome, r.external_ref, r.completed_refs, r.needs_reconciliation) for r in A.execute_outcomes(v, results).collect()}
    assert got == {1: ("executed", "E1", "E1,C1", None), 2: ("failed", None, "E2", True), 3: ("failed", None, "", False),
                   4: ("not_approved", None, None, None), 5: ("unroutable", None, None, None), 6: ("escalated", None, None, None),
                   7: ("failed", None, "E7", True)}


def test_gate_skips_duplicates_and_escalates(spark):
    cand = spark.createDataFrame([("k1", "EU", "scm_reorder", "s", 4000, 92000.0), ("k2", "EU", "scm_reorder", "s", 9000, 205000.0), ("k3", "EU", "scm_reorder", "s", 1, 1.0)],
                                 "breach_key string, region string, action_type string, sku string, qty bigint, amount_eur double")
    handled = spark.createDataFrame([("k3",), ("k3",)], "breach_key string")
    got = {r.breach_key: r.path for r in X.gate_and_route(cand, handled, A.policy_table(spark, ("EU",))).collect()}
    assert got == {"k1": "auto_executed", "k2": "escalated", "k3": "skipped_duplicate"}


def test_visible_regions_before_and_after_a_change(spark):
    people = spark.createDataFrame([("p", "planner", "N", "ALL"), ("c", "controller", "ALL", "ALL"), ("z", "rep", "Q", "ALL")],
                                   "user_email string, role string, region_scope string, segment_scope string")
    rows = spark.createDataFrame([(r,) for r in ("N", "S", "E", "W", "N", None)], "region string")

    def seen(p):
        return {r.user_email: r.visible for r in G.rls_visible_counts(rows, p).collect()}

    wide = K.update_where(people, F.col("user_email") == "p", {"region_scope": F.lit("ALL")})
    back = K.update_where(wide, F.col("user_email") == "p", {"region_scope": F.lit("N")})
    assert [seen(p)["p"] for p in (people, wide, back)] == [1, 4, 1]
    assert seen(people) == {"p": 1, "c": 4, "z": 0}
    assert G.rls_filter(rows, people, "c").count() == 6
    assert G.rls_filter(rows, people, "p").count() == 2
    assert G.rls_filter(rows, people, "stranger").count() == 0
    assert G.rls_filter(rows, people, "root", admins=("root",)).count() == 6


def test_budget_needs_a_budget(spark):
    spend = spark.createDataFrame([("a", 110.0), ("b", 110.1), ("c", 5.0)], "g string, cost_usd double")
    budgets = spark.createDataFrame([("a", 100.0), ("b", 100.0)], "g string, budget_usd double")
    got = {r.g: r.budget_flag for r in G.budget_overage(spend, budgets, ("g",)).collect()}
    assert got == {"a": "within", "b": "over", "c": "no_budget"}


def test_a_live_action_of_any_level_or_type_handles_its_key(spark, monkeypatch):
    from ledgerloom.catalog.actions import REG

    say = lambda who: '{"supplier": "%s"}' % who
    rows = spark.createDataFrame([
        (1, "scm_reorder", 4, "proposed", say("a")), (2, "escalation", 2, "escalated", say("a")), (3, "scm_reorder", 4, "proposed", say("b")),
        (4, "scm_reorder", 3, "executed", say("b")), (5, "scm_reorder", 4, "proposed", say("c")), (6, "scm_reroute", 4, "rejected", say("c")),
        (7, "quote_send", 1, "proposed", "{}"),
    ], "action_id long, action_type string, level int, status string, payload string")
    monkeypatch.setattr("ledgerloom.sources.star.Star.actions", lambda self: rows)
    got = REG.queries["join_anti_handled"](spark, "").collect()
    assert sorted(r.action_id for r in got) == [5, 7]
