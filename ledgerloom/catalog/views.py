"""The star views themselves, whole."""

from pyspark.sql import functions as F

from .registry import Registry

REG = Registry()

_DOUBLES = {
    "margin_actuals": ("revenue_eur", "cogs_eur", "gross_margin_eur"),
    "margin_budget": ("budget_revenue_eur", "budget_margin_eur"),
    "cost_drivers": ("raw_material_cost", "freight_cost", "energy_cost", "overhead"),
    "sales_actuals": ("revenue_eur", "margin_eur"),
    "pipeline": ("amount_eur",),
}
_COLUMNS = {
    "products": "sku product_name product_line region currency list_price_eur standard_cost_eur",
    "margin_actuals": "sku region month units revenue_eur cogs_eur gross_margin_eur gross_margin_pct",
    "margin_budget": "sku region month budget_units budget_revenue_eur budget_margin_eur",
    "cost_drivers": "sku region month raw_material_cost freight_cost energy_cost overhead",
    "fx_rates": "currency month rate_to_eur",
    "otif": "plant region lane sku month orders on_time in_full otif_pct",
    "inventory": "plant sku month on_hand_units safety_stock days_of_supply stockout_flag",
    "lanes": "lane_id origin_plant dest_region mode lead_time_days cost_per_unit",
    "service_levels": "region month service_pct backorder_units",
    "accounts": "account_id account_name region segment industry owner_rep",
    "pipeline": "opp_id account_id stage amount_eur close_month product_line",
    "sales_actuals": "account_id month revenue_eur volume_units margin_eur",
    "churn_signals": "account_id month churn_score last_order_days complaint_count nps",
}


def _register(view: str) -> None:
    doubles = _DOUBLES.get(view, ())
    columns = _COLUMNS[view].split()
    select = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in doubles else c for c in columns)

    @REG.add("view_opportunities" if view == "pipeline" else f"view_{view}", view, f"SELECT {select} FROM {view}")
    def _(star):
        df = getattr(star, view)()
        return df.select(*[F.col(c).cast("double").alias(c) if c in doubles else F.col(c) for c in columns])


for _view in _COLUMNS:
    _register(_view)
