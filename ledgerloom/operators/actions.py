"""The governed action log: policy checks, state machine, routing to systems, outcomes, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import read_rows
from .ordered import first_per_key, with_lag, with_row_number

# Statuses, legal transitions, policy caps, routes and default bodies.
STATUSES = ("proposed", "approved", "executing", "executed", "rejected", "failed", "escalated")
TERMINAL = ("executed", "rejected", "failed")
TRANSITIONS = (
    ("proposed", "approved"), ("proposed", "rejected"), ("proposed", "escalated"),
    ("approved", "executing"), ("approved", "rejected"), ("approved", "escalated"),
    ("executing", "executed"), ("executing", "failed"), ("executing", "escalated"),
    ("escalated", "approved"), ("escalated", "rejected"),
)
# action type, discount cap %, spend cap EUR, limited to the allowed regions, needs approval
POLICY_CAPS = (
    ("quote_send", "15.00", "250000.00", True, True),
    ("price_change", "10.00", None, True, True),
    ("forecast_override", None, None, True, True),
    ("scm_reorder", None, "100000.00", True, True),
    ("scm_reroute", None, "50000.00", True, True),
    ("crm_task", None, None, True, False),
    ("escalation", None, None, False, False),
)
ROUTES = {
    "quote_send": ("email", "crm"),
    "price_change": ("crm",),
    "forecast_override": ("teams",),
    "scm_reorder": ("erp_po",),
    "scm_reroute": ("teams", "ticket"),
    "crm_task": ("crm",),
    "escalation": ("ticket",),
}
LIVE = ("proposed", "approved", "executing", "executed", "escalated")


def policy_table(spark: SparkSession, regions: Sequence[str]) -> DataFrame:
    """One policy per action type. ``regions`` is the region list of the scoped types."""
    from decimal import Decimal

    rows = [
        (t, Decimal(d) if d else None, Decimal(s) if s else None, list(regions) if scoped else None, approval)
        for t, d, s, scoped, approval in POLICY_CAPS
    ]
    schema = ("action_type string, max_discount_pct decimal(5,2), max_spend_eur decimal(14,2), "
              "allowed_regions array<string>, requires_approval boolean")
    return read_rows(spark, rows, schema)


def _payload(column: str = "payload") -> Column:
    """Payload fields as a map of texts; malformed JSON has no fields.

    A map is parsed once per row. With a struct, the optimizer turns every field that is used into a
    parse of its own.
    """
    return F.from_json(F.col(column), "map<string, string>")


def guardrail_eval(actions: DataFrame, policies: DataFrame) -> DataFrame:
    """Check every action against the policy of its type.

    Adds ``passed``, ``breaches`` (rule names), ``checks`` (one struct per rule) and the values
    used. A missing field or cap leaves its rule not applicable. Text where a number is expected is
    a breach, not a skip. An empty region list is no restriction; a NULL region against a list is a
    breach. An unknown type stops at the first rule. The policies have one row per action type, so
    the join adds no rows.
    """
    rows = actions.withColumn("_p", _payload()).join(policies.withColumn("_known", F.lit(True)), "action_type", "left")
    rows = rows.withColumns({
        "_known": F.coalesce("_known", F.lit(False)),
        "_discount_text": F.col("_p")["discount_pct"],
        "_spend_text": F.coalesce(F.col("_p")["spend_eur"], F.col("_p")["amount_eur"]),
    }).withColumns({
        "discount_value": F.col("_discount_text").try_cast("double"),
        "spend_value": F.col("_spend_text").try_cast("double"),
    })

    def capped(text: str, value: str, cap: str) -> tuple[Column, Column]:
        applies = F.col("_known") & F.col(cap).isNotNull() & F.col(text).isNotNull()
        within = F.coalesce(F.col(value) <= F.col(cap).cast("double"), F.lit(False))
        return applies, ~applies | within

    limited = F.col("_known") & (F.coalesce(F.size("allowed_regions"), F.lit(0)) > 0)
    in_scope = F.coalesce(F.array_contains("allowed_regions", F.col("region")), F.lit(False))
    rules: Mapping[str, tuple[Column, Column]] = {
        "action_type_allowed": (F.lit(True), F.col("_known")),
        "max_discount_pct": capped("_discount_text", "discount_value", "max_discount_pct"),
        "max_spend_eur": capped("_spend_text", "spend_value", "max_spend_eur"),
        "allowed_regions": (limited, ~limited | in_scope),
        "requires_approval": (F.col("_known"), F.lit(True)),
    }
    checks = F.array(*[
        F.struct(F.lit(name).alias("rule"), applies.alias("applicable"), ok.alias("passed"))
        for name, (applies, ok) in rules.items()
    ])
    out = rows.withColumn("checks", checks).withColumn(
        "breaches", F.transform(F.filter("checks", lambda c: ~c["passed"]), lambda c: c["rule"])
    )
    return out.withColumn("passed", F.size("breaches") == 0).select(
        *actions.columns, "passed", "breaches", "checks", "discount_value", "spend_value",
        F.coalesce("requires_approval", F.lit(True)).alias("requires_approval"),
    )


def _legal(prev: Column, status: Column) -> Column:
    pairs = F.array(*[F.lit(f"{a}>{b}") for a, b in TRANSITIONS])
    return F.when(prev.isNull(), status == "proposed").otherwise(
        F.array_contains(pairs, F.concat(prev, F.lit(">"), status))
    )


def state_replay(events: DataFrame, key: str = "action_id", order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Every event with the status before it and whether the state machine allows the step."""
    stepped = with_lag(events, (key,), order, {"status": "prev_status"})
    return stepped.withColumn("legal", _legal(F.col("prev_status"), F.col("status")))


def state_current(events: DataFrame, key: str = "action_id") -> DataFrame:
    """Fold the log to one row per action: status, approver and the decision and execution times."""
    at = F.struct("ts", "event_id")
    decided = F.col("status").isin("approved", "rejected")
    done = F.col("status").isin("executed", "failed")
    return events.groupBy(key).agg(
        F.max_by("status", at).alias("status"),
        F.max_by("actor", F.when(decided, at)).alias("approved_by"),
        F.min("ts").alias("created_at"),
        F.max(F.when(decided, F.col("ts"))).alias("decided_at"),
        F.max(F.when(done, F.col("ts"))).alias("executed_at"),
        F.count(F.lit(1)).alias("events"),
    )


def cas_conflicts(events: DataFrame, key: str = "action_id", from_status: str = "from_status",
                  order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Writers that lost the race: the first change from a status wins, later ones acted on a stale read."""
    numbered = with_row_number(events, (key, from_status), order, "attempt")
    return numbered.withColumn("conflict", F.col("attempt") > 1)


def sod_violations(actions: DataFrame) -> DataFrame:
    """Actions approved by the person who asked for them."""
    return actions.filter(F.col("approved_by") == F.col("requested_by"))


def audit_lineage(events: DataFrame, key: str = "action_id", order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The ordered trail of every action, one row per event with its step number."""
    return with_row_number(events, (key,), order, "step")


def _first_text(*fields: str, default: str | None = None) -> Column:
    """First field that is present and not empty, else the default."""
    filled = [F.nullif(F.col("_p")[f], F.lit("")) for f in fields]
    return F.coalesce(*filled, *([F.lit(default)] if default is not None else []))


def _first_number(*fields: str, to: str) -> Column:
    """First field that is a number other than zero, else zero."""
    numbers = [F.nullif(F.col("_p")[f].try_cast("double"), F.lit(0.0)) for f in fields]
    return F.coalesce(*numbers, F.lit(0.0)).cast(to)


def _body(system: Column) -> Column:
    def of(**cols: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(n) for n, c in cols.items()]))

    bodies = {
        "erp_po": of(
            supplier=_first_text("supplier", "vendor", default="Unknown supplier"),
            sku=_first_text("sku", "material", default="SKU-UNKNOWN"),
            qty=_first_number("qty", "quantity", to="bigint"),
            amount_eur=_first_number("amount_eur", "spend_eur", to="decimal(18,2)"),
        ),
        "crm": of(
            account=_first_text("account", "customer", default="Unknown account"),
            task=_first_text("task", "summary", "subject", default="Follow-up"),
            due=_first_text("due", "due_date"),
        ),
        "email": of(
            to=_first_text("to", "recipient", "customer_email", default="customer@example.com"),
            subject=_first_text("subject", "title", default="Update"),
            body=_first_text("body", "message", "summary", default=""),
        ),
        "teams": of(
            channel=_first_text("channel", "team", default="Operations"),
            message=_first_text("message", "body", "summary", "subject", default=""),
        ),
        "sharepoint": of(
            path=_first_text("path", "location", default="/Shared Documents"),
            title=_first_text("title", "subject", "document", default="Document"),
        ),
        "ticket": of(
            summary=_first_text("summary", "subject", "message", "reason", default="Agent-raised ticket"),
            priority=_first_text("priority", default="P3"),
        ),
    }
    out = None
    for name, body in bodies.items():
        out = F.when(system == name, body) if out is None else out.when(system == name, body)
    return out


def route_of(action_type: Column, routes: Mapping[str, Sequence[str]] = ROUTES) -> Column:
    """Ordered systems of an action type; NULL when there is no route."""
    table = F.create_map(*[x for t, s in routes.items() for x in (F.lit(t), F.array(*[F.lit(k) for k in s]))])
    return table[action_type]


def route_steps(actions: DataFrame, routes: Mapping[str, Sequence[str]] = ROUTES) -> DataFrame:
    """The steps of each action's route (``action_id``, ``step``, ``system``), without reading its payload."""
    rows = actions.select("action_id", F.posexplode(route_of(F.col("action_type"), routes)).alias("step", "system"))
    return rows.withColumn("step", F.col("step").cast("bigint"))


def route_fanout(actions: DataFrame, routes: Mapping[str, Sequence[str]] = ROUTES) -> DataFrame:
    """Outbox: one row per action and routed system with the JSON body for that system. Nothing is sent."""
    rows = actions.select("action_id", "action_type", _payload().alias("_p"),
                          F.posexplode(route_of(F.col("action_type"), routes)).alias("step", "system"))
    return rows.select("action_id", "action_type", F.col("step").cast("bigint").alias("step"), "system",
                       _body(F.col("system")).alias("body"))


def execute_outcomes(verdicts: DataFrame, results: DataFrame, routes: Mapping[str, Sequence[str]] = ROUTES) -> DataFrame:
    """What became of each action, from its status, its verdict and the answers of the systems.

    ``verdicts`` is the output of ``guardrail_eval``; ``results`` has action_id, step, ok, ref_id.
    Steps after the first failure never ran. A failure after a step that already had an effect
    needs reconciliation. A step without a result counts as failed. A route has a handful of steps,
    so the collected references stay short.
    """
    answers = results.groupBy("action_id").agg(
        F.min(F.when(~F.col("ok"), F.col("step"))).alias("_failed"),
        F.count(F.lit(1)).alias("_n"),
        F.array_sort(F.collect_list(F.struct("step", "ref_id"))).alias("_refs"),
    )
    rows = verdicts.withColumn("_route", route_of(F.col("action_type"), routes)).join(answers, "action_id", "left")
    steps = F.size("_route").cast("bigint")
    missing = F.coalesce("_n", F.lit(0)) < steps
    failed_at = F.coalesce("_failed", F.when(missing, F.coalesce("_n", F.lit(0))))
    outcome = (
        F.when(F.col("status") != "approved", "not_approved")
        .when(F.col("_route").isNull(), "unroutable")
        .when(~F.col("passed"), "escalated")
        .when(failed_at.isNotNull(), "failed")
        .otherwise("executed")
    )
    done = F.filter(F.coalesce("_refs", F.array().cast("array<struct<step:bigint,ref_id:string>>")),
                    lambda r: F.col("_failed_at").isNull() | (r["step"] < F.col("_failed_at")))
    ran = F.col("outcome").isin("executed", "failed")
    return rows.withColumn("_failed_at", failed_at).withColumn("outcome", outcome).withColumn("_done", done).select(
        *verdicts.columns, "outcome",
        F.when(F.col("outcome") == "executed", F.try_element_at("_done", F.lit(1))["ref_id"]).alias("external_ref"),
        F.when(ran, F.array_join(F.transform("_done", lambda r: r["ref_id"]), ",")).alias("completed_refs"),
        F.when(F.col("outcome") == "failed", F.col("_failed_at") > 0).alias("needs_reconciliation"),
    )


def live_keys(actions: DataFrame, key: str = "breach_key", payload: str = "payload") -> DataFrame:
    """Breach keys that already have a live action; rejected and failed ones may be tried again."""
    return actions.filter(F.col("status").isin(*LIVE)).select(
        F.get_json_object(payload, f"$.{key}").alias(key)
    ).filter(F.col(key).isNotNull()).distinct()


def decide_once(decisions: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first decision per key counts; later ones find it no longer pending."""
    return first_per_key(decisions, (key,), order, columns)
