"""Star-schema views derived from the input tables.

Each method returns a lazy DataFrame. ``months``, ``product_line`` and ``region`` are optional
builder filters: they are placed on the raw columns below the joins and aggregates, so they reach
the Parquet scans of ``lineitem``, ``part`` and ``region``. Money is DECIMAL from the first
operation, so sums do not depend on the order of the rows. Row values stay within 18 digits, where
Spark computes decimals as longs.

A side is broadcast only when its rows were counted and are few (``small_side``) or when Spark finds
its size below ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are shuffled and adaptive
execution splits a hot join key.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import zero_padded
from ..session import cut_lineage
from .io import read_rows
from .tables import Months, in_months, month_of, read_spread, read_table, small_side

# Fixed values of the fixture.
AS_OF = date(2000, 6, 1)
Q1: Months = (date(2000, 1, 1), date(2000, 3, 1))
Q2: Months = (date(2000, 4, 1), date(2000, 6, 1))
H1: Months = (Q1[0], Q2[1])
FOCUS_LINE = "ECONOMY"
FOCUS_REGION = "EUROPE"
FOCUS_SEGMENT = "BUILDING"
FX_BASE = (("EUR", 1.0), ("USD", 0.925), ("GBP", 1.155), ("CNY", 0.129))
COST_SHARES = (
    ("raw_material_cost", "0.55"),
    ("freight_cost", "0.12"),
    ("energy_cost", "0.13"),
    ("overhead", "0.20"),
)
#: The views of the model that have rows of facts or dimensions.
VIEWS = ("products", "margin_actuals", "margin_budget", "fx_rates", "cost_drivers", "otif", "inventory", "lanes",
         "service_levels", "accounts", "pipeline", "sales_actuals", "churn_signals")
PLANTS = 6
SAFETY_STOCK = 20


def line_revenue() -> Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    keep = F.lit(Decimal("1.00")) - F.col("l_discount").cast("decimal(3,2)")
    return (price * keep).cast("decimal(13,4)")


def line_cogs(revenue: Column) -> Column:
    return (revenue * (F.lit(Decimal("0.60")) + F.col("l_tax").cast("decimal(3,2)"))).cast("decimal(18,6)")


def account_id(custkey: Column) -> Column:
    """At least twelve digits; a longer key keeps all of its own."""
    return F.concat(F.lit("ACC"), zero_padded(custkey, 12))


def currency_of(regionkey: Column) -> Column:
    return F.when(regionkey == 0, "GBP").when(regionkey == 1, "USD").when(regionkey == 2, "CNY").otherwise("EUR")


@dataclass(frozen=True)
class Star:
    spark: SparkSession
    root: str
    pinned_finance: DataFrame | None = None
    pinned_plant: DataFrame | None = None
    #: Tables and row counts of this star, that is of one query.
    seen: dict = field(default_factory=dict, compare=False, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self.seen:
            self.seen[name] = read_table(self.spark, self.root, name)
        return self.seen[name]

    def heavy(self, name: str) -> DataFrame:
        """A table whose rows are costly to process, spread over the cores when it is small."""
        return read_spread(self.spark, self.root, name)

    def with_finance_facts(self, months=None, product_line=None, region=None) -> Star:
        """A star whose finance views share one stored aggregate.

        Margin, budget and cost views have the same grain. A query that joins two of them would scan
        and join the line items once per view; here that happens once, and the result (one row per
        SKU, region and month) is stored. Asking such a star for other months than it holds
        gives only what it holds.
        """
        return replace(self, pinned_finance=cut_lineage(self.finance_facts(months, product_line, region)))

    def with_plant_facts(self, months=None, product_line=None, region=None) -> Star:
        """The same for the service and inventory views."""
        return replace(self, pinned_plant=cut_lineage(self.plant_facts(months, product_line, region)))

    # -- shared building blocks ------------------------------------------------------------

    def geo(self, region: str | None = None) -> DataFrame:
        reg = self.table("region")
        if region is not None:
            reg = reg.filter(F.col("r_name") == region)
        return self.table("nation").join(reg, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", F.col("r_regionkey").alias("regionkey"), F.col("r_name").alias("region")
        )

    def located(self, df: DataFrame, nationkey: str, region: str | None = None) -> DataFrame:
        """Add ``industry`` (nation name), ``regionkey`` and ``region`` by nation key."""
        geo = small_side(self.geo(region), self.rows("nation")).withColumnRenamed("n_name", "industry")
        return df.join(geo, F.col(nationkey) == F.col("n_nationkey")).drop("n_nationkey")

    def order_region(self, region: str | None = None) -> DataFrame:
        cust = self.located(self.table("customer").select("c_custkey", "c_nationkey"), "c_nationkey", region)
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        cust = small_side(cust.select("c_custkey", "regionkey", "region"), self.rows("customer"))
        return orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey", "o_custkey", "regionkey", "region")

    def rows(self, name: str) -> int:
        if ("rows", name) not in self.seen:
            self.seen["rows", name] = self.table(name).count()
        return self.seen["rows", name]

    def shipped(self, months: Months | None = None) -> DataFrame:
        """Line items, optionally one month range of them."""
        return in_months(self.table("lineitem"), "l_shipdate", months)

    def parts(self, product_line: str | None = None) -> DataFrame:
        part = self.table("part")
        if product_line is not None:
            part = part.filter(F.col("p_type") == product_line)
        return part.select(
            "p_partkey", F.col("p_type").alias("product_line"), (F.col("p_size") % 10).alias("size_digit")
        )

    def lines(
        self, months: Months | None = None, product_line: str | None = None, region: str | None = None
    ) -> DataFrame:
        """Line items with region and product, one row per line; Catalyst prunes what a view does not use.

        Over the whole history the line items are the large side, so orders and parts are broadcast
        when their counted rows are few. A month range may make the line items the small side;
        there the choice is left to Spark.
        """
        orders, parts = self.order_region(region), self.parts(product_line)
        if months is None:
            orders, parts = small_side(orders, self.rows("orders")), small_side(parts, self.rows("part"))
        base = self.shipped(months).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
            parts, F.col("l_partkey") == F.col("p_partkey")
        )
        revenue = line_revenue()
        return base.select(
            "o_custkey", "l_suppkey", "l_returnflag", "l_linestatus",
            "product_line", "size_digit", "regionkey", "region",
            month_of("l_shipdate").alias("month"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("list_value"),
            revenue.alias("revenue"),
            line_cogs(revenue).alias("cogs"),
        )

    @staticmethod
    def sku() -> Column:
        return F.concat_ws(
            "-", F.col("product_line"), F.col("regionkey").cast("string"), F.col("size_digit").cast("string")
        )

    def finance_facts(
        self, months: Months | None = None, product_line: str | None = None, region: str | None = None
    ) -> DataFrame:
        if self.pinned_finance is not None:
            return self._held(self.pinned_finance, months, product_line, region)
        grain = self.lines(months, product_line, region).groupBy(
            "product_line", "regionkey", "size_digit", "region", "month"
        )
        return grain.agg(
            F.sum("qty").alias("units"),
            F.sum("revenue").cast("decimal(28,4)").alias("revenue"),
            F.sum("cogs").cast("decimal(30,6)").alias("cogs"),
            F.sum("list_value").cast("decimal(26,2)").alias("list_value"),
        ).select(self.sku().alias("sku"), "region", "month", "units", "revenue", "cogs", "list_value")

    @staticmethod
    def _held(facts: DataFrame, months, product_line, region) -> DataFrame:
        if months is not None:
            facts = in_months(facts, "month", months)
        if product_line is not None:
            facts = facts.filter(F.col("sku").startswith(f"{product_line}-"))
        return facts if region is None else facts.filter(F.col("region") == region)

    # -- finance ---------------------------------------------------------------------------

    def products(self, product_line: str | None = None, region: str | None = None) -> DataFrame:
        part = self.table("part")
        if product_line is not None:
            part = part.filter(F.col("p_type") == product_line)
        price = F.col("p_retailprice").cast("decimal(12,2)")
        grouped = part.groupBy(
            F.col("p_type").alias("product_line"), (F.col("p_size") % 10).alias("size_digit")
        ).agg(
            F.min("p_name").alias("product_name"),
            F.max(price).alias("list_price"),
            F.min(price).alias("floor_price"),
        )
        reg = self.table("region")
        if region is not None:
            reg = reg.filter(F.col("r_name") == region)
        # every product is sold in every region of the table: the regions as one array, then a row for each
        regions = reg.agg(F.collect_list(F.struct(F.col("r_regionkey").alias("regionkey"), F.col("r_name").alias("region")))).scalar()
        keyed = grouped.withColumn("at", F.explode(regions)).select("*", "at.*")
        return keyed.select(
            self.sku().alias("sku"),
            "product_name",
            "product_line",
            "region",
            currency_of(F.col("regionkey")).alias("currency"),
            F.col("list_price").cast("double").alias("list_price_eur"),
            F.round(F.col("floor_price") * F.lit(Decimal("0.60")), 2).cast("double").alias("standard_cost_eur"),
        )

    def margin_actuals(self, months=None, product_line=None, region=None) -> DataFrame:
        margin = (F.col("revenue") - F.col("cogs")).cast("decimal(30,6)")
        return self.finance_facts(months, product_line, region).select(
            "sku", "region", "month", "units",
            F.col("revenue").alias("revenue_eur"),
            F.col("cogs").alias("cogs_eur"),
            margin.alias("gross_margin_eur"),
            F.try_divide(margin.cast("double"), F.col("revenue").cast("double")).alias("gross_margin_pct"),
        )

    def margin_budget(self, months=None, product_line=None, region=None) -> DataFrame:
        return self.finance_facts(months, product_line, region).select(
            "sku", "region", "month",
            F.col("units").alias("budget_units"),
            (F.col("list_value") * F.lit(Decimal("0.95"))).cast("decimal(30,4)").alias("budget_revenue_eur"),
            (F.col("list_value") * F.lit(Decimal("0.35"))).cast("decimal(30,4)").alias("budget_margin_eur"),
        )

    def cost_drivers(self, months=None, product_line=None, region=None) -> DataFrame:
        return self.finance_facts(months, product_line, region).select(
            "sku", "region", "month",
            *[(F.col("cogs") * F.lit(Decimal(s))).cast("decimal(32,8)").alias(n) for n, s in COST_SHARES],
        )

    def fx_rates(self, months=None) -> DataFrame:
        seen = self.shipped(months).select(month_of("l_shipdate").alias("month")).distinct()
        pairs = F.array(*[F.struct(F.lit(c).alias("currency"), F.lit(b).alias("base")) for c, b in FX_BASE])
        drift = F.lit(1.0) - F.lit(0.002) * (F.month("month") % 7)
        rate = F.when(F.col("fx.currency") == "EUR", F.lit(1.0)).otherwise(F.round(F.col("fx.base") * drift, 6))
        return seen.withColumn("fx", F.explode(pairs)).select(
            F.col("fx.currency").alias("currency"), "month", rate.alias("rate_to_eur")
        )

    # -- supply ----------------------------------------------------------------------------

    def plant_facts(self, months=None, product_line=None, region=None) -> DataFrame:
        """Service and stock of every plant, SKU and month: the grain of the otif and inventory views."""
        if self.pinned_plant is not None:
            return self._held(self.pinned_plant, months, product_line, region)
        on_time = F.col("l_linestatus") == "F"
        in_full = F.col("l_returnflag") != "R"
        lines = self.lines(months, product_line, region).withColumn("plant_no", F.col("l_suppkey") % PLANTS)
        agg = lines.groupBy("plant_no", "region", "product_line", "regionkey", "size_digit", "month").agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(on_time).alias("on_time"),
            F.count_if(in_full).alias("in_full"),
            F.count_if(on_time & in_full).alias("perfect"),
            F.coalesce(F.sum(F.when(~in_full, F.col("qty"))), F.lit(0)).alias("on_hand"),
            F.sum("qty").alias("total"),
        )
        return agg.select(
            "plant_no", F.concat(F.lit("P"), F.col("plant_no").cast("string")).alias("plant"), "region",
            self.sku().alias("sku"), "month", "orders", "on_time", "in_full", "perfect", "on_hand", "total",
        )

    def otif(self, months=None, product_line=None, region=None) -> DataFrame:
        return self.plant_facts(months, product_line, region).select(
            "plant", "region", F.concat("plant", F.lit("->"), "region").alias("lane"), "sku", "month",
            "orders", "on_time", "in_full",
            (F.expr("(perfect * 10000) div orders").cast("double") / F.lit(10000.0)).alias("otif_pct"),
        )

    def inventory(self, months=None, product_line=None, region=None) -> DataFrame:
        supply = (F.col("on_hand") * 30).cast("double") / F.col("total").cast("double")
        return self.plant_facts(months, product_line, region).select(
            "plant", "sku", "month",
            F.col("on_hand").alias("on_hand_units"),
            F.lit(SAFETY_STOCK).cast("bigint").alias("safety_stock"),
            F.round(supply, 1).alias("days_of_supply"),
            F.when(F.col("on_hand") * 30 < F.col("total") * 2, 1).otherwise(0).cast("bigint").alias("stockout_flag"),
        )

    def lanes(self) -> DataFrame:
        lines = self.lines().withColumn("plant_no", F.col("l_suppkey") % PLANTS)
        agg = lines.groupBy("plant_no", "region").agg(
            F.count(F.lit(1)).alias("n"), F.sum("cogs").alias("cogs"), F.sum("qty").alias("qty")
        ).withColumn("plant", F.concat(F.lit("P"), F.col("plant_no").cast("string")))
        mode = F.when(F.col("plant_no") % 3 == 0, "road").when(F.col("plant_no") % 3 == 1, "sea").otherwise("air")
        return agg.select(
            F.concat("plant", F.lit("->"), "region").alias("lane_id"),
            F.col("plant").alias("origin_plant"),
            F.col("region").alias("dest_region"),
            mode.alias("mode"),
            (F.col("n") % 12 + 3).cast("bigint").alias("lead_time_days"),
            F.round(F.col("cogs").cast("double") / F.col("qty").cast("double") / 1000.0, 2).alias("cost_per_unit"),
        )

    def service_levels(self, months=None, region=None) -> DataFrame:
        orders = self.order_region(region)
        if months is None:
            orders = small_side(orders, self.rows("orders"))
        base = self.shipped(months).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        open_qty = F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("bigint"))
        return base.groupBy("region", month_of("l_shipdate").alias("month")).agg(
            F.round(F.count_if(F.col("l_linestatus") == "F") / F.count(F.lit(1)), 4).alias("service_pct"),
            F.coalesce(F.sum(open_qty), F.lit(0)).alias("backorder_units"),
        )

    # -- commercial ------------------------------------------------------------------------

    def accounts(self, region: str | None = None) -> DataFrame:
        return self.located(self.table("customer"), "c_nationkey", region).select(
            account_id(F.col("c_custkey")).alias("account_id"),
            F.col("c_name").alias("account_name"),
            "region",
            F.col("c_mktsegment").alias("segment"),
            "industry",
            F.concat(F.lit("REP"), zero_padded(F.col("c_nationkey"), 2)).alias("owner_rep"),
        )

    def pipeline(self) -> DataFrame:
        stage = (
            F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0), "ClosedLost")
            .when(F.col("o_orderstatus") == "F", "ClosedWon")
            .when(F.col("o_orderstatus") == "P", "Propose")
            .otherwise("Negotiate")
        )
        return self.table("orders").select(
            F.col("o_orderkey").alias("opp_id"),
            account_id(F.col("o_custkey")).alias("account_id"),
            stage.alias("stage"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount_eur"),
            month_of("o_orderdate").alias("close_month"),
            F.when(F.col("o_orderkey") % 2 == 0, "ECONOMY").otherwise("STANDARD").alias("product_line"),
        )

    def _customer_lines(self, months, account_ids=None) -> DataFrame:
        """Line items with their customer; listed accounts become a filter on the orders scan."""
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        if account_ids is not None:
            orders = orders.filter(F.col("o_custkey").isin(*[int(a.removeprefix("ACC")) for a in account_ids]))
        if months is None:
            orders = small_side(orders, self.rows("orders"))
        return self.shipped(months).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def _sold(self, months, account_ids) -> DataFrame:
        revenue = line_revenue()
        rows = self._customer_lines(months, account_ids).select(
            "o_custkey", month_of("l_shipdate").alias("month"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            revenue.alias("revenue"), line_cogs(revenue).alias("cogs"),
        )
        return rows.groupBy("o_custkey", "month").agg(
            F.sum("revenue").alias("revenue"), F.sum("qty").alias("volume_units"), F.sum("cogs").alias("cogs")
        )

    @staticmethod
    def _sales() -> list[Column]:
        return [
            F.col("revenue").cast("decimal(28,4)").alias("revenue_eur"),
            F.col("volume_units"),
            (F.col("revenue") - F.col("cogs")).cast("decimal(30,6)").alias("margin_eur"),
        ]

    @staticmethod
    def _signals() -> list[Column]:
        n, y, m = F.col("o_custkey"), F.year("month"), F.month("month")
        return [
            (((n * 7919 + y * 372 + m * 31) % 1000).cast("double") / F.lit(1000.0)).alias("churn_score"),
            ((n * 13 + m * 7) % 90).cast("bigint").alias("last_order_days"),
            ((n + m) % 8).cast("bigint").alias("complaint_count"),
            ((n * 31 + m * 17) % 201 - 100).cast("bigint").alias("nps"),
        ]

    def sales_actuals(self, months=None, account_ids=None) -> DataFrame:
        return self._sold(months, account_ids).select(account_id(F.col("o_custkey")).alias("account_id"), "month", *self._sales())

    def churn_signals(self, months=None, account_ids=None) -> DataFrame:
        seen = self._customer_lines(months, account_ids).select("o_custkey", month_of("l_shipdate").alias("month")).distinct()
        return seen.select(account_id(F.col("o_custkey")).alias("account_id"), "month", *self._signals())

    def account_months(self, months=None, account_ids=None) -> DataFrame:
        """Sales and churn signals of each account and month: both views have this grain, so one pass gives their join."""
        sold = self._sold(months, account_ids).filter(F.col("o_custkey").isNotNull() & F.col("month").isNotNull())
        return sold.select(account_id(F.col("o_custkey")).alias("account_id"), "month", *self._sales(), *self._signals())

    # -- governance, actions, usage --------------------------------------------------------

    def payload_logs(self) -> DataFrame:
        """One model call per event: tokens from the event payload, latency from its value."""
        return self.table("events").select(
            F.col("event_id").alias("request_id"),
            F.col("ts").cast("timestamp").alias("request_time"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("requester"),
            F.concat(F.lit("group"), (F.col("user_id") % 4).cast("string")).alias("user_group"),
            F.col("event_type").alias("served_model"),
            F.get_json_object("props", "$.k").cast("bigint").alias("total_tokens"),
            F.col("value").cast("decimal(12,2)").alias("duration_ms"),
        )

    def action_events(self) -> DataFrame:
        """Event log of actions: one action per user, statuses from the event type."""
        status = (
            F.when(F.col("event_type") == "view", "proposed")
            .when(F.col("event_type") == "click", "approved")
            .when(F.col("event_type") == "signup", "executing")
            .when(F.col("event_type") == "purchase", "executed")
            .otherwise("failed")
        )
        return self.table("events").select(
            F.col("user_id").alias("action_id"),
            F.col("event_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            status.alias("status"),
            F.concat(F.lit("actor"), (F.col("event_id") % 7).cast("string")).alias("actor"),
        )

    def actions(self) -> DataFrame:
        """One action per order; the payload is JSON text as an application would have stored it."""
        o = self.heavy("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        cust = self.located(self.table("customer").select("c_custkey", "c_nationkey"), "c_nationkey")
        cust = small_side(cust.select("c_custkey", "region"), self.rows("customer"))
        k, p = F.col("o_orderkey"), F.col("o_orderpriority")
        kind = (
            F.when(p == "1-URGENT", "scm_reorder")
            .when(p == "2-HIGH", "quote_send")
            .when(p == "3-MEDIUM", "scm_reroute")
            .when(p == "4-NOT SPECIFIED", F.when(k % 2 == 0, "price_change").otherwise("unknown_type"))
            .otherwise(F.when(k % 2 == 0, "crm_task").otherwise("escalation"))
        )
        amount = F.format_string("%.2f", F.col("o_totalprice"))
        q = F.lit('"')
        spend = (
            F.when(k % 11 == 0, F.lit("null"))
            .when(k % 13 == 0, F.lit('"n/a"'))
            .otherwise(amount)
        )
        discount = F.when(k % 5 == 0, F.lit("null")).otherwise((k % 20).cast("string"))
        payload = F.concat(
            F.lit('{"spend_eur": '), spend, F.lit(', "amount_eur": '), amount,
            F.lit(', "discount_pct": '), discount,
            F.lit(', "sku": "SKU-'), (k % 97).cast("string"), q,
            F.when(k % 2 == 0, F.concat(F.lit(', "qty": '), (k % 50).cast("string"))).otherwise(
                F.concat(F.lit(', "quantity": '), (k % 70).cast("string"))
            ),
            F.when(k % 3 == 0, F.concat(F.lit(', "supplier": "SUP-'), (k % 31).cast("string"), q)).otherwise(F.lit("")),
            F.when(k % 4 == 0, F.concat(F.lit(', "account": "ACC-'), F.col("o_custkey").cast("string"), q)).otherwise(F.lit("")),
            F.when(k % 7 == 0, F.lit(', "priority": "P1"')).otherwise(F.lit("")),
            F.lit(', "subject": "Order '), k.cast("string"), F.lit('"}'),
        )
        status = (
            F.when(F.col("o_orderstatus") == "F", "approved")
            .when(F.col("o_orderstatus") == "P", "proposed")
            .otherwise("escalated")
        )
        return o.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
            k.alias("action_id"),
            F.concat(F.lit("agent"), (k % 3).cast("string")).alias("agent"),
            kind.alias("action_type"),
            F.concat(F.lit("Order "), k.cast("string")).alias("subject"),
            payload.alias("payload"),
            status.alias("status"),
            (k % 4 + 1).cast("bigint").alias("level"),
            F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("region")).alias("region"),
            F.concat(F.lit("user"), (F.col("o_custkey") % 10).cast("string")).alias("requested_by"),
            F.concat(F.lit("user"), (k % 10).cast("string")).alias("approved_by"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
        )

    # -- all views at once -----------------------------------------------------------------

    def cells(self) -> DataFrame:
        """Everything the sizes of the fact views depend on, from one pass over the line items.

        Two grains as grouping sets of the same scan: ``by_account`` 0 has a row per plant, product, region and month,
        ``by_account`` 1 one per customer and month. Partners that a line lacks are null, and the ``has`` flags say so, since
        views differ in what they join.
        """
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", (F.col("l_suppkey") % PLANTS).alias("plant_no"), month_of("l_shipdate").alias("month"))
        orders = small_side(self.table("orders").select("o_orderkey", "o_custkey", F.lit(True).alias("has_order")), self.rows("orders"))
        homes = self.located(self.table("customer").select("c_custkey", "c_nationkey"), "c_nationkey").select(
            "c_custkey", "regionkey", "region", F.lit(True).alias("has_region"))
        parts = self.parts().withColumn("has_part", F.lit(True))
        joined = (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(small_side(homes, self.rows("customer")), F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(small_side(parts, self.rows("part")), F.col("l_partkey") == F.col("p_partkey"), "left")
        )
        plant = ["plant_no", "product_line", "size_digit", "regionkey", "has_part"]
        account = ["o_custkey", "has_order"]
        both = ["region", "has_region", "month"]
        sets = [[F.col(c) for c in [*plant, *both]], [F.col(c) for c in [*account, *both]]]
        # the flag is the lowest bit of the grouping id: whether the customer is grouped away
        found = joined.groupingSets(sets, *plant, *both, *account).agg(F.count(F.lit(1)).alias("lines"), (1 - F.grouping("has_order")).alias("by_account"))
        return found.select("by_account", *plant, *both, *account, "lines")

    def rows_by_region(self) -> DataFrame:
        """``view``, ``region``, ``row_count`` of all views, with one scan of the line items for all of them.

        A view's region is that of its product, lane or account; exchange rates have none.
        """
        cells = cut_lineage(self.cells())
        plants = cells.filter("by_account = 0")
        sold = plants.filter(F.col("has_region") & F.col("has_part"))
        accounts = cells.filter(F.col("by_account") == 1).filter("has_order")
        finance, lane = ["product_line", "size_digit", "regionkey", "region", "month"], ["plant_no", "region"]
        one = F.count(F.lit(1)).cast("bigint")

        def rows(df: DataFrame, *views: str, times: int = 1) -> DataFrame:
            counted = df.groupBy("region").agg((one * times).alias("row_count"))
            return counted.select(F.explode(F.array(*[F.lit(v) for v in views])).alias("view"), "region", "row_count")

        homes = self.located(self.table("customer").select("c_custkey", "c_nationkey"), "c_nationkey").select("c_custkey", "region")
        pipeline = self.table("orders").select("o_custkey").join(
            small_side(homes, self.rows("customer")), F.col("o_custkey") == F.col("c_custkey"), "left")
        parts = [
            rows(self.products(), "products"), rows(sold.select(*finance).distinct(), "margin_actuals", "margin_budget", "cost_drivers"),
            rows(sold, "otif", "inventory"), rows(sold.select(*lane).distinct(), "lanes"),
            rows(plants.filter("has_region").select("region", "month").distinct(), "service_levels"),
            rows(plants.select("month", F.lit(None).cast("string").alias("region")).distinct(), "fx_rates", times=len(FX_BASE)),
            rows(homes, "accounts"), rows(pipeline, "pipeline"), rows(accounts, "sales_actuals", "churn_signals"),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def view_rows(self) -> DataFrame:
        """``view`` and ``row_count`` of all views, also of empty ones."""
        counted = self.rows_by_region().groupBy("view").agg(F.sum("row_count").alias("row_count"))
        names = read_rows(self.spark, [(v,) for v in VIEWS], "view string")
        return names.join(counted, "view", "left").select("view", F.coalesce("row_count", F.lit(0)).alias("row_count"))

    # -- documents -------------------------------------------------------------------------

    def contract_docs(self) -> DataFrame:
        """One supply contract per supplier; every fifth leaves out its termination clause."""
        k = F.col("s_suppkey")
        text = F.concat(
            F.lit("Supply agreement between the buyer and "), F.col("s_name"), F.lit(".\nSupplier: "), F.col("s_name"),
            F.lit("\nAnnual spend: EUR "), (k * 37 % 200 * 10000).cast("string"),
            F.lit("\nPayment terms: "), (k * 7 % 100).cast("string"), F.lit(" days"),
            F.lit("\nPrice escalation: "), F.when(k % 2 == 0, "Yes").otherwise("No"),
            F.when(k % 5 == 0, F.lit("")).otherwise(
                F.concat(F.lit("\nTermination notice: "), (k * 11 % 120).cast("string"), F.lit(" days"))
            ),
            F.lit("\nThis contract binds the buyer and the supplier.\n"),
        )
        return self.table("supplier").select(
            F.concat(F.lit("contract-"), k.cast("string")).alias("doc_id"), F.lit("contract").alias("doc_type_guess"), text.alias("text")
        )

    def sheet_docs(self) -> DataFrame:
        """One product safety sheet per part."""
        k = F.col("p_partkey")
        text = F.concat(
            F.lit("Safety data sheet.\nProduct: "), F.col("p_name"), F.lit("\nHazard class: "), (k % 9 + 1).cast("string"),
            F.lit("\nFlash point: "), (F.col("p_size") + 10).cast("string"), F.lit(" C\nStorage: keep below "),
            (k % 30 + 5).cast("string"), F.lit(" C\nProtective equipment: gloves and goggles against the hazard.\n"),
        )
        return self.table("part").select(
            F.concat(F.lit("sheet-"), k.cast("string")).alias("doc_id"), F.lit("SDS").alias("doc_type_guess"), text.alias("text")
        )
