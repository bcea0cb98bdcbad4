"""The star views as ANSI SQL, used to check the Spark views and every query built on them."""

from __future__ import annotations

_REV = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(13,4))"
_COGS = f"CAST({_REV} * (CAST(0.60 AS DECIMAL(3,2)) + CAST(l_tax AS DECIMAL(3,2))) AS DECIMAL(18,6))"
_SKU = "product_line || '-' || CAST(regionkey AS VARCHAR) || '-' || CAST(size_digit AS VARCHAR)"


def padded(key: str, width: int) -> str:
    return f"lpad(CAST({key} AS VARCHAR), CAST(greatest({width}, length(CAST({key} AS VARCHAR))) AS INTEGER), '0')"


def account_id(key: str) -> str:
    return f"'ACC' || {padded(key, 12)}"


def month_of(col: str) -> str:
    return f"CAST(date_trunc('month', {col}) AS DATE)"


def period_of(column: str, periods) -> str:
    """The name of the period that a month lies in, NULL outside of all."""
    return "CASE " + " ".join(f"WHEN {column} BETWEEN DATE '{first}' AND DATE '{last}' THEN '{name}'" for name, first, last in periods) + " END"


# name -> (needed views, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "geo": ((), """
        SELECT n_nationkey, n_name, r_regionkey AS regionkey, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "order_region": (("geo",), """
        SELECT o_orderkey, o_custkey, regionkey, region
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey"""),
    "lines": (("order_region",), f"""
        SELECT o_custkey, l_suppkey, l_returnflag, l_linestatus, p_type AS product_line, p_size % 10 AS size_digit,
               regionkey, region, {month_of('l_shipdate')} AS month, CAST(l_quantity AS BIGINT) AS qty,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS list_value, {_REV} AS revenue, {_COGS} AS cogs
        FROM lineitem JOIN order_region ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    "finance_facts": (("lines",), f"""
        SELECT {_SKU} AS sku, region, month, CAST(SUM(qty) AS BIGINT) AS units,
               SUM(revenue) AS revenue, SUM(cogs) AS cogs, SUM(list_value) AS list_value
        FROM lines GROUP BY product_line, regionkey, size_digit, region, month"""),
    "products": ((), f"""
        SELECT {_SKU} AS sku, product_name, product_line, r_name AS region,
               CASE regionkey WHEN 0 THEN 'GBP' WHEN 1 THEN 'USD' WHEN 2 THEN 'CNY' ELSE 'EUR' END AS currency,
               CAST(list_price AS DOUBLE) AS list_price_eur,
               CAST(ROUND(floor_price * CAST(0.60 AS DECIMAL(3,2)), 2) AS DOUBLE) AS standard_cost_eur
        FROM (SELECT p_type AS product_line, p_size % 10 AS size_digit, r_regionkey AS regionkey, r_name,
                     MIN(p_name) AS product_name, MAX(CAST(p_retailprice AS DECIMAL(12,2))) AS list_price,
                     MIN(CAST(p_retailprice AS DECIMAL(12,2))) AS floor_price
              FROM part, region GROUP BY ALL) grouped_parts"""),
    "margin_actuals": (("finance_facts",), """
        SELECT sku, region, month, units, revenue AS revenue_eur, cogs AS cogs_eur,
               revenue - cogs AS gross_margin_eur,
               CAST(revenue - cogs AS DOUBLE) / CAST(revenue AS DOUBLE) AS gross_margin_pct
        FROM finance_facts"""),
    "margin_budget": (("finance_facts",), """
        SELECT sku, region, month, units AS budget_units, list_value * CAST(0.95 AS DECIMAL(3,2)) AS budget_revenue_eur,
               list_value * CAST(0.35 AS DECIMAL(3,2)) AS budget_margin_eur
        FROM finance_facts"""),
    "cost_drivers": (("finance_facts",), """
        SELECT sku, region, month, cogs * CAST(0.55 AS DECIMAL(3,2)) AS raw_material_cost,
               cogs * CAST(0.12 AS DECIMAL(3,2)) AS freight_cost, cogs * CAST(0.13 AS DECIMAL(3,2)) AS energy_cost,
               cogs * CAST(0.20 AS DECIMAL(3,2)) AS overhead
        FROM finance_facts"""),
    "fx_rates": ((), f"""
        SELECT currency, month,
               CASE WHEN currency = 'EUR' THEN CAST(1.0 AS DOUBLE)
                    ELSE ROUND(base * (CAST(1.0 AS DOUBLE) - CAST(0.002 AS DOUBLE) * (month(month) % 7)), 6) END AS rate_to_eur
        FROM (SELECT DISTINCT {month_of('l_shipdate')} AS month FROM lineitem) seen,
             (VALUES ('EUR', CAST(1.0 AS DOUBLE)), ('USD', CAST(0.925 AS DOUBLE)), ('GBP', CAST(1.155 AS DOUBLE)),
                     ('CNY', CAST(0.129 AS DOUBLE))) fx(currency, base)"""),
    "plant_lines": (("lines",), "SELECT *, l_suppkey % 6 AS plant_no FROM lines"),
    "otif": (("plant_lines",), f"""
        SELECT 'P' || CAST(plant_no AS VARCHAR) AS plant, region,
               'P' || CAST(plant_no AS VARCHAR) || '->' || region AS lane, {_SKU} AS sku, month,
               orders, on_time, in_full, CAST((perfect * 10000) // orders AS DOUBLE) / CAST(10000 AS DOUBLE) AS otif_pct
        FROM (SELECT plant_no, region, product_line, regionkey, size_digit, month, COUNT(*) AS orders,
                     COUNT(*) FILTER (l_linestatus = 'F') AS on_time,
                     COUNT(*) FILTER (l_returnflag <> 'R') AS in_full,
                     COUNT(*) FILTER (l_linestatus = 'F' AND l_returnflag <> 'R') AS perfect
              FROM plant_lines GROUP BY ALL) lane_grain"""),
    "inventory": (("plant_lines",), f"""
        SELECT 'P' || CAST(plant_no AS VARCHAR) AS plant, {_SKU} AS sku, month, on_hand AS on_hand_units,
               CAST(20 AS BIGINT) AS safety_stock,
               ROUND(CAST(on_hand * 30 AS DOUBLE) / CAST(total AS DOUBLE), 1) AS days_of_supply,
               CAST(CASE WHEN on_hand * 30 < total * 2 THEN 1 ELSE 0 END AS BIGINT) AS stockout_flag
        FROM (SELECT plant_no, product_line, regionkey, size_digit, month, CAST(SUM(qty) AS BIGINT) AS total,
                     CAST(COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN qty END), 0) AS BIGINT) AS on_hand
              FROM plant_lines GROUP BY ALL) stock_grain"""),
    "lanes": (("plant_lines",), """
        SELECT 'P' || CAST(plant_no AS VARCHAR) || '->' || region AS lane_id, 'P' || CAST(plant_no AS VARCHAR) AS origin_plant,
               region AS dest_region,
               CASE plant_no % 3 WHEN 0 THEN 'road' WHEN 1 THEN 'sea' ELSE 'air' END AS mode,
               COUNT(*) % 12 + 3 AS lead_time_days,
               ROUND(CAST(SUM(cogs) AS DOUBLE) / CAST(SUM(qty) AS DOUBLE) / 1000.0, 2) AS cost_per_unit
        FROM plant_lines GROUP BY plant_no, region"""),
    "service_levels": (("order_region",), f"""
        SELECT region, {month_of('l_shipdate')} AS month,
               ROUND(CAST(COUNT(*) FILTER (l_linestatus = 'F') AS DOUBLE) / COUNT(*), 4) AS service_pct,
               CAST(COALESCE(SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT) AS backorder_units
        FROM lineitem JOIN order_region ON l_orderkey = o_orderkey GROUP BY 1, 2"""),
    "accounts": (("geo",), f"""
        SELECT {account_id('c_custkey')} AS account_id, c_name AS account_name, region, c_mktsegment AS segment,
               n_name AS industry, 'REP' || {padded('n_nationkey', 2)} AS owner_rep
        FROM customer JOIN geo ON c_nationkey = n_nationkey"""),
    "pipeline": ((), f"""
        SELECT o_orderkey AS opp_id, {account_id('o_custkey')} AS account_id,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'ClosedLost' WHEN o_orderstatus = 'F' THEN 'ClosedWon'
                    WHEN o_orderstatus = 'P' THEN 'Propose' ELSE 'Negotiate' END AS stage,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount_eur, {month_of('o_orderdate')} AS close_month,
               CASE WHEN o_orderkey % 2 = 0 THEN 'ECONOMY' ELSE 'STANDARD' END AS product_line
        FROM orders"""),
    "sales_actuals": ((), f"""
        SELECT {account_id('o_custkey')} AS account_id, {month_of('l_shipdate')} AS month,
               SUM({_REV}) AS revenue_eur, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume_units,
               SUM({_REV}) - SUM({_COGS}) AS margin_eur
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, 2"""),
    "churn_signals": ((), f"""
        SELECT {account_id('n')} AS account_id, month,
               CAST((n * 7919 + year(month) * 372 + month(month) * 31) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS churn_score,
               CAST((n * 13 + month(month) * 7) % 90 AS BIGINT) AS last_order_days,
               CAST((n + month(month)) % 8 AS BIGINT) AS complaint_count,
               CAST((n * 31 + month(month) * 17) % 201 - 100 AS BIGINT) AS nps
        FROM (SELECT DISTINCT o_custkey AS n, {month_of('l_shipdate')} AS month
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) seen"""),
    "payload_logs": ((), """
        SELECT event_id AS request_id, ts AS request_time, 'user' || CAST(user_id AS VARCHAR) AS requester,
               'group' || CAST(user_id % 4 AS VARCHAR) AS user_group, event_type AS served_model,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS total_tokens, CAST(value AS DECIMAL(12,2)) AS duration_ms
        FROM events"""),
    "action_events": ((), """
        SELECT user_id AS action_id, event_id, ts,
               CASE event_type WHEN 'view' THEN 'proposed' WHEN 'click' THEN 'approved' WHEN 'signup' THEN 'executing'
                    WHEN 'purchase' THEN 'executed' ELSE 'failed' END AS status,
               'actor' || CAST(event_id % 7 AS VARCHAR) AS actor
        FROM events"""),
    "actions": (("geo",), """
        SELECT o_orderkey AS action_id, 'agent' || CAST(o_orderkey % 3 AS VARCHAR) AS agent,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'scm_reorder' WHEN '2-HIGH' THEN 'quote_send'
                    WHEN '3-MEDIUM' THEN 'scm_reroute'
                    WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'price_change' ELSE 'unknown_type' END
                    ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'crm_task' ELSE 'escalation' END END AS action_type,
               'Order ' || CAST(o_orderkey AS VARCHAR) AS subject,
               '{"spend_eur": ' || CASE WHEN o_orderkey % 11 = 0 THEN 'null' WHEN o_orderkey % 13 = 0 THEN '"n/a"'
                                        ELSE format('{:.2f}', o_totalprice) END
               || ', "amount_eur": ' || format('{:.2f}', o_totalprice)
               || ', "discount_pct": ' || CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE CAST(o_orderkey % 20 AS VARCHAR) END
               || ', "sku": "SKU-' || CAST(o_orderkey % 97 AS VARCHAR) || '"'
               || CASE WHEN o_orderkey % 2 = 0 THEN ', "qty": ' || CAST(o_orderkey % 50 AS VARCHAR)
                       ELSE ', "quantity": ' || CAST(o_orderkey % 70 AS VARCHAR) END
               || CASE WHEN o_orderkey % 3 = 0 THEN ', "supplier": "SUP-' || CAST(o_orderkey % 31 AS VARCHAR) || '"' ELSE '' END
               || CASE WHEN o_orderkey % 4 = 0 THEN ', "account": "ACC-' || CAST(o_custkey AS VARCHAR) || '"' ELSE '' END
               || CASE WHEN o_orderkey % 7 = 0 THEN ', "priority": "P1"' ELSE '' END
               || ', "subject": "Order ' || CAST(o_orderkey AS VARCHAR) || '"}' AS payload,
               CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'P' THEN 'proposed' ELSE 'escalated' END AS status,
               o_orderkey % 4 + 1 AS level, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE region END AS region,
               'user' || CAST(o_custkey % 10 AS VARCHAR) AS requested_by,
               'user' || CAST(o_orderkey % 10 AS VARCHAR) AS approved_by, o_orderdate AS created_at
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey"""),
    "contract_docs": ((), """
        SELECT 'contract-' || CAST(s_suppkey AS VARCHAR) AS doc_id, 'contract' AS doc_type_guess,
               'Supply agreement between the buyer and ' || s_name || '.' || chr(10) || 'Supplier: ' || s_name || chr(10)
               || 'Annual spend: EUR ' || CAST(s_suppkey * 37 % 200 * 10000 AS VARCHAR) || chr(10)
               || 'Payment terms: ' || CAST(s_suppkey * 7 % 100 AS VARCHAR) || ' days' || chr(10)
               || 'Price escalation: ' || CASE WHEN s_suppkey % 2 = 0 THEN 'Yes' ELSE 'No' END
               || CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE chr(10) || 'Termination notice: ' || CAST(s_suppkey * 11 % 120 AS VARCHAR) || ' days' END
               || chr(10) || 'This contract binds the buyer and the supplier.' || chr(10) AS text
        FROM supplier"""),
    "sheet_docs": ((), """
        SELECT 'sheet-' || CAST(p_partkey AS VARCHAR) AS doc_id, 'SDS' AS doc_type_guess,
               'Safety data sheet.' || chr(10) || 'Product: ' || p_name || chr(10) || 'Hazard class: ' || CAST(p_partkey % 9 + 1 AS VARCHAR)
               || chr(10) || 'Flash point: ' || CAST(p_size + 10 AS VARCHAR) || ' C' || chr(10) || 'Storage: keep below '
               || CAST(p_partkey % 30 + 5 AS VARCHAR) || ' C' || chr(10) || 'Protective equipment: gloves and goggles against the hazard.' || chr(10) AS text
        FROM part"""),
}


def with_views(names: str, body: str, extra: str = "") -> str:
    """``WITH`` the named views and what they need, then ``extra`` CTEs, then the query."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in VIEWS[name][0]:
            visit(need)
        order.append(name)

    for name in names.split():
        visit(name)
    ctes = [f"{n} AS ({VIEWS[n][1]})" for n in order]
    if extra.strip():
        ctes.append(extra.strip())
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body.strip()
