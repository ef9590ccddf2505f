from oracle.views import r, ratio, with_views


def _t(rule, *parts):
    """(part, condition, relation) triples to tidy count rows."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{p}' AS part, count(*) FILTER (WHERE {c}) AS bad, count(*) AS checked FROM {rel}"
        for p, c, rel in parts
    )


def _orph(rule, names):
    views = {"Orders": "d_orders", "Inventory": "d_inventory", "Wastage": "d_wastage", "Ratings": "d_ratings"}
    return _t(rule, *[(n, "restaurant_id IS NOT NULL AND restaurant_id NOT IN (SELECT restaurant_id FROM d_restaurants)", views[n]) for n in names])


_MISSING = [
    (f"{t}.{c}", f"{c} IS NULL", v)
    for t, v, cols in [
        ("Orders", "d_orders", "subtotal discount_total total_amount order_timestamp"),
        ("Order_Items", "d_lines", "quantity unit_price unit_cost line_total"),
        ("Menu_Items", "d_menu", "base_price standard_cost"),
        ("Pricing_History", "d_pricing", "unit_price"),
    ]
    for c in cols.split()
]
_UNIT = "(SELECT x.unit_of_measure, m.unit_of_measure AS menu_unit FROM {} x LEFT JOIN d_menu m USING (menu_item_id))"
_VALID = "('portion','plate','bowl','glass','piece')"
_MAXSTOCK = """(SELECT w.quantity_wasted, s.mx FROM d_wastage w LEFT JOIN
  (SELECT menu_item_id, restaurant_id, max(closing_quantity) AS mx FROM d_inventory GROUP BY ALL) s USING (menu_item_id, restaurant_id))"""
ASOF = """(SELECT w.*, i.closing_quantity FROM d_wastage w ASOF LEFT JOIN d_inventory i
  ON w.menu_item_id = i.menu_item_id AND w.restaurant_id = i.restaurant_id AND w.wastage_date >= i.inventory_date)"""


def _dup(rule, part, rel, key, strict):
    content = f"(SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE ({key}) FROM {rel}))"
    bad = f"count(*) - count(DISTINCT {key})"
    if strict:
        bad = f"greatest({bad}, count(*) - {content})"
    return f"SELECT '{rule}' AS rule, '{part}' AS part, {bad} AS bad, count(*) AS checked FROM {rel}"


def _price(name, rel, col):
    med = f"(SELECT quantile_cont(CAST({col} AS DOUBLE), 0.5) FROM {rel} WHERE {col} > 0)"
    return (name, f"{col} <= 0 OR CAST({col} AS DOUBLE) > 50 * {med}", rel)


_D = {"Orders": ("order_timestamp", "d_orders"), "Ratings": ("rating_timestamp", "d_ratings"), "Wastage": ("wastage_date", "d_wastage")}

RULES = {
    "missing_values": _t("missing_values", *_MISSING),
    "duplicate_orders": _dup("duplicate_orders", "Orders", "d_orders", "order_id", False),
    "duplicate_order_lines": _dup("duplicate_order_lines", "Order_Items", "d_lines", "order_item_id", False),
    "invalid_menu_prices": _t("invalid_menu_prices", ("Menu_Items", "base_price IS NULL OR base_price <= 0 OR base_price > 1000", "d_menu")),
    "negative_quantities": _t("negative_quantities", ("Order_Items", "quantity < 0", "d_lines"), ("Inventory", "consumption_quantity < 0", "d_inventory")),
    "invalid_dates": _t("invalid_dates", *[(n, f"{c} IS NULL", v) for n, (c, v) in _D.items()]),
    "invalid_ratings": _t("invalid_ratings", ("Ratings", "rating_value < 1 OR rating_value > 5", "d_ratings")),
    "missing_customer_ids": _t("missing_customer_ids", ("Orders", "customer_id IS NULL", "d_orders")),
    "missing_menu_ids": _t("missing_menu_ids", ("Order_Items", "menu_item_id IS NULL", "d_lines")),
    "invalid_restaurant_ids": _orph("invalid_restaurant_ids", ["Orders"]),
    "impossible_wastage": _t("impossible_wastage", ("Wastage", "quantity_wasted > mx", _MAXSTOCK)),
    "incorrect_discounts": _t("incorrect_discounts", ("Order_Items", "discount_amount > round(quantity * unit_price, 2)", "d_lines")),
    "cancelled_transactions": _t("cancelled_transactions", ("Orders", "lower(trim(order_status)) = 'cancelled'", "d_orders")),
    "inconsistent_units": _t("inconsistent_units", *[(n, "unit_of_measure <> menu_unit", _UNIT.format(v)) for n, v in (("Inventory", "d_inventory"), ("Wastage", "d_wastage"))]),
    "invalid_location_references": _orph("invalid_location_references", ["Orders", "Inventory", "Wastage"]),
}
STRICT = RULES | {
    "missing_values": _t(
        "missing_values",
        ("Orders", " OR ".join(f"{c} IS NULL" for c in "order_id customer_id restaurant_id order_timestamp order_channel order_status subtotal discount_total total_amount".split()), "d_orders"),
        ("Order_Items", " OR ".join(f"{c} IS NULL" for c in "order_item_id order_id menu_item_id quantity unit_price unit_cost discount_amount line_total".split()), "d_lines"),
    ),
    "duplicate_orders": _dup("duplicate_orders", "Orders", "d_orders", "order_id", True),
    "duplicate_order_lines": _dup("duplicate_order_lines", "Order_Items", "d_lines", "order_item_id", True),
    "invalid_menu_prices": _t("invalid_menu_prices", _price("Menu_Items", "d_menu", "base_price"), _price("Order_Items", "d_lines", "unit_price"), _price("Pricing_History", "d_pricing", "unit_price")),
    "invalid_dates": _t("invalid_dates", *[(n, f"{c} IS NULL OR {c} > TIMESTAMP '2024-01-25 00:00:00' OR year({c}) < 2000", v) for n, (c, v) in _D.items()]),
    "invalid_ratings": _t("invalid_ratings", ("Ratings", "rating_value IS NOT NULL AND rating_value NOT IN (1,2,3,4,5)", "d_ratings")),
    "impossible_wastage": _t("impossible_wastage", ("Wastage", "quantity_wasted < 0 OR quantity_wasted > closing_quantity", ASOF)),
    "incorrect_discounts": _t(
        "incorrect_discounts",
        ("Order_Items", "discount_amount < 0 OR (quantity > 0 AND unit_price > 0 AND discount_amount > quantity * unit_price + 0.01)", "d_lines"),
        ("Orders", "discount_total > subtotal + 0.01", "d_orders"),
    ),
    "inconsistent_units": _t("inconsistent_units", *[(n, f"unit_of_measure <> menu_unit OR lower(trim(unit_of_measure)) NOT IN {_VALID}", _UNIT.format(v)) for n, v in (("Inventory", "d_inventory"), ("Wastage", "d_wastage"))]),
    "invalid_location_references": _orph("invalid_location_references", ["Orders", "Inventory", "Wastage", "Ratings"]),
}


def _run(rules):
    return with_views(
        f""", parts AS ({' UNION ALL '.join(rules.values())}),
        per_table AS (SELECT rule, split_part(part, '.', 1) AS tbl, sum(bad) AS bad, max(checked) AS checked FROM parts GROUP BY ALL),
        totals AS (SELECT rule, CAST(sum(bad) AS BIGINT) AS total, CAST(sum(checked) AS BIGINT) AS rows_checked FROM per_table GROUP BY rule)
        SELECT rule, total, rows_checked, {r(ratio('total', 'rows_checked'), 6)} AS rate,
               total > 0 AND total / rows_checked <= 0.10 AS in_gate FROM totals"""
    )


SQL = {f"dq_{k}": with_views(v) for k, v in RULES.items()}
SQL |= {f"dq_strict_{k}": with_views(v) for k, v in STRICT.items() if STRICT[k] != RULES[k]}
SQL |= {"dq_run": _run(RULES), "dq_run_strict": _run(STRICT)}
