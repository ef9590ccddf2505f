"""Decimal result columns per query; both sides of the comparison report them as doubles."""

_O = "subtotal discount_total total_amount"
_L = "quantity unit_price unit_cost discount_amount line_total"
_W = "quantity_wasted wastage_cost"
_I = "opening_quantity replenishment_quantity consumption_quantity closing_quantity"
_STEPS = {
    "missing_values": _O,
    "invalid_menu_prices": "base_price standard_cost",
    "negative_quantities": _L,
    "negative_consumption": _I,
    "invalid_dates_orders": _O,
    "invalid_dates_wastage": _W,
    "missing_ids_orders": _O,
    "missing_ids_lines": _L,
    "invalid_restaurants": _O,
    "orphan_lines": _L,
    "invalid_unit_prices": "unit_price",
    "duplicate_orders": _O,
    "duplicate_lines": _L,
    "duplicate_null_keys": _O,
    "impossible_wastage": _W,
    "incorrect_discounts": _L,
    "units_inventory": _I,
    "units_wastage": _W,
}
DECIMALS = {f"clean_{s}{q}": c.split() for s, c in _STEPS.items() for q in ("", "_quarantine")} | {
    "clean_cancelled_orders": _O.split(),
    "feat_integrated_fact": (
        f"{_L} discount_value base_price standard_cost max_price min_price total_consumption total_closing total_wasted total_wastage_cost"
    ).split(),
    "menu_item_sales_summary": ["base_price"],
    "menu_slow_moving": ["base_price"],
    "menu_slow_by_count": ["base_price"],
    "menu_no_recent_sales": ["base_price"],
    "order_value_outliers": _O.split(),
    "order_duplicate_transactions": ["total_amount"],
    "discount_outliers": ["subtotal", "discount_total"],
    "unexpected_demand": ["total_amount"],
    "source_csv_orders": _O.split(),
    "source_csv_lines": _L.split(),
    "sink_sample_export": _O.split(),
    "source_unbroken_orders": _O.split(),
    "sink_published_version": ["total_amount"],
    "join_bucketed": ["total"],
    "promo_sales_by_month": ["total"],
    "price_effective": ["unit_price", "list_price"],
}


def as_doubles(name: str, sql: str) -> str:
    cols = DECIMALS.get(name)
    if not cols:
        return sql
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in cols)}) FROM ({sql})"


SQL: dict[str, str] = {}
