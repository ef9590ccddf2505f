from oracle.views import with_views

MAX = "DATE '2001-06-30'"


def _dedup(rel, key, cols):
    order = ", ".join(f"{c} DESC NULLS LAST" for c in cols)
    return f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {rel}"


ORD = "order_id customer_id restaurant_id promotion_id order_timestamp order_channel order_status subtotal discount_total total_amount".split()
LIN = "order_item_id order_id menu_item_id quantity unit_price unit_cost discount_amount line_total".split()
_known = "subtotal IS NOT NULL AND discount_total IS NOT NULL AND total_amount IS NOT NULL AND order_timestamp IS NOT NULL"
_cap = "(SELECT menu_item_id, restaurant_id, max(closing_quantity) AS cap FROM {} GROUP BY ALL)"


def pair(name, rel, keep, reason):
    return {
        f"clean_{name}": with_views(f"SELECT * FROM {rel} WHERE {keep}"),
        f"clean_{name}_quarantine": with_views(f"SELECT *, '{reason}' AS reason FROM {rel} WHERE ({keep}) IS NOT TRUE"),
    }


def corrected(name, rel, cols, join, bad, col, fix, reason):
    keep = ", ".join(f"x.{c}" for c in cols if c != col)
    return {
        f"clean_{name}": with_views(f"SELECT {keep}, CASE WHEN {bad} THEN {fix} ELSE x.{col} END AS {col} FROM {rel} x {join}"),
        f"clean_{name}_quarantine": with_views(f"SELECT x.*, '{reason}' AS reason FROM {rel} x {join} WHERE {bad}"),
    }


WAS = "wastage_id menu_item_id restaurant_id wastage_date quantity_wasted unit_of_measure wastage_cost wastage_reason".split()
INV = "inventory_id menu_item_id restaurant_id inventory_date opening_quantity replenishment_quantity consumption_quantity closing_quantity unit_of_measure".split()
_stock = f"LEFT JOIN {_cap.format('d_inventory')} s ON x.menu_item_id = s.menu_item_id AND x.restaurant_id = s.restaurant_id"
_unit = "LEFT JOIN d_menu m ON x.menu_item_id = m.menu_item_id"
SQL = {}
SQL |= pair("missing_values", "d_orders", _known, "missing amount or time")
SQL |= pair("invalid_menu_prices", "d_menu", "base_price > 0 AND base_price <= 1000", "invalid menu price")
SQL |= pair("negative_quantities", "d_lines", "quantity >= 0", "negative quantity")
SQL |= pair("negative_consumption", "d_inventory", "consumption_quantity >= 0", "negative consumption")
SQL |= pair("invalid_dates_orders", "d_orders", f"CAST(order_timestamp AS DATE) <= {MAX}", "invalid order_timestamp")
SQL |= pair("invalid_dates_ratings", "d_ratings", "CAST(rating_timestamp AS DATE) <= DATE '2024-01-25'", "invalid rating_timestamp")
SQL |= pair("invalid_dates_wastage", "d_wastage", f"wastage_date <= {MAX}", "invalid wastage_date")
SQL |= pair("invalid_ratings", "d_ratings", "rating_value BETWEEN 1 AND 5", "invalid rating")
SQL |= pair("missing_ids_orders", "d_orders", "customer_id IS NOT NULL", "missing customer_id")
SQL |= pair("missing_ids_lines", "d_lines", "menu_item_id IS NOT NULL", "missing menu_item_id")
SQL |= pair("invalid_restaurants", "d_orders", "restaurant_id IN (SELECT restaurant_id FROM d_restaurants)", "unknown restaurant")
SQL |= pair("orphan_lines", "d_lines", "order_id IN (SELECT order_id FROM d_orders WHERE order_status = 'completed')", "order not in clean orders")
SQL |= pair("invalid_unit_prices", "d_pricing", "unit_price > 0", "invalid unit price")
for _n, _rel, _key, _cols in (("duplicate_orders", "(SELECT * FROM d_orders UNION ALL SELECT * FROM d_orders WHERE order_id % 10 = 0)", "order_id", ORD), ("duplicate_lines", "d_lines", "order_item_id", LIN),
    ("duplicate_null_keys", "(SELECT * REPLACE (CASE WHEN order_id % 7 <> 0 THEN order_id END AS order_id) FROM d_orders UNION ALL SELECT * FROM d_orders WHERE order_id % 10 = 0)", "order_id", ORD)):
    SQL[f"clean_{_n}"] = with_views(f"SELECT * EXCLUDE rn FROM ({_dedup(_rel, _key, _cols)}) WHERE rn = 1")
    SQL[f"clean_{_n}_quarantine"] = with_views(f"SELECT * EXCLUDE rn, 'duplicate {_key}' AS reason FROM ({_dedup(_rel, _key, _cols)}) WHERE rn > 1")
SQL |= corrected("impossible_wastage", "d_wastage", WAS, _stock, "x.quantity_wasted > s.cap", "quantity_wasted", "s.cap", "wastage above stock")
SQL |= corrected("incorrect_discounts", "d_lines", LIN, "", "x.discount_amount > round(x.quantity * x.unit_price, 2)", "discount_amount", "CAST(round(x.quantity * x.unit_price, 2) AS DECIMAL(12,2))", "discount above line amount")
SQL |= corrected("units_inventory", "d_inventory", INV, _unit, "x.unit_of_measure <> m.unit_of_measure", "unit_of_measure", "m.unit_of_measure", "unit differs from menu")
SQL |= corrected("units_wastage", "d_wastage", WAS, _unit, "x.unit_of_measure <> m.unit_of_measure", "unit_of_measure", "m.unit_of_measure", "unit differs from menu")
SQL["clean_cancelled_orders"] = with_views("SELECT * FROM d_orders")

CHAIN = f"""o1 AS (SELECT * FROM d_orders WHERE {_known}), o2 AS (SELECT * EXCLUDE rn FROM ({_dedup('o1', 'order_id', ORD)}) WHERE rn = 1),
l1 AS (SELECT * EXCLUDE rn FROM ({_dedup('d_lines', 'order_item_id', LIN)}) WHERE rn = 1), m1 AS (SELECT * FROM d_menu WHERE base_price > 0 AND base_price <= 1000),
l2 AS (SELECT * FROM l1 WHERE quantity >= 0), i1 AS (SELECT * FROM d_inventory WHERE consumption_quantity >= 0),
o3 AS (SELECT * FROM o2 WHERE CAST(order_timestamp AS DATE) <= DATE '2024-01-25'), r1 AS (SELECT * FROM d_ratings WHERE CAST(rating_timestamp AS DATE) <= DATE '2024-01-25'),
w1 AS (SELECT * FROM d_wastage WHERE wastage_date <= DATE '2024-01-25'), r2 AS (SELECT * FROM r1 WHERE rating_value BETWEEN 1 AND 5),
o4 AS (SELECT * FROM o3 WHERE customer_id IS NOT NULL), l3 AS (SELECT * FROM l2 WHERE menu_item_id IS NOT NULL),
o5 AS (SELECT * FROM o4 WHERE restaurant_id IN (SELECT restaurant_id FROM d_restaurants)),
w2 AS (SELECT w.* EXCLUDE (quantity_wasted), CASE WHEN quantity_wasted > cap THEN cap ELSE quantity_wasted END AS quantity_wasted, coalesce(quantity_wasted > cap, false) AS hit FROM w1 w LEFT JOIN {_cap.format('i1')} USING (menu_item_id, restaurant_id)),
l4 AS (SELECT *, discount_amount > round(quantity * unit_price, 2) AS hit FROM l3),
l5 AS (SELECT * FROM l4 WHERE order_id IN (SELECT order_id FROM o5)), l6 AS (SELECT * FROM l5 WHERE unit_price > 0)"""


def _n(rel, where="true"):
    return f"(SELECT count(*) FROM {rel} WHERE {where})"


_u = "{} JOIN m1 USING (menu_item_id) WHERE {}.unit_of_measure <> m1.unit_of_measure"
_log = [
    ("missing_values", "Orders", "o1", f"{_n('d_orders')} - {_n('o1')}"),
    ("duplicate_orders", "Orders", "o2", f"{_n('o1')} - {_n('o2')}"),
    ("duplicate_lines", "Order_Items", "l1", f"{_n('d_lines')} - {_n('l1')}"),
    ("invalid_menu_prices", "Menu_Items", "m1", f"{_n('d_menu')} - {_n('m1')}"),
    ("negative_quantities", "Order_Items", "l2", f"{_n('l1')} - {_n('l2')}"),
    ("negative_consumption", "Inventory", "i1", f"{_n('d_inventory')} - {_n('i1')}"),
    ("invalid_dates", "Orders", "o3", f"{_n('o2')} - {_n('o3')}"),
    ("invalid_dates", "Ratings", "r1", f"{_n('d_ratings')} - {_n('r1')}"),
    ("invalid_dates", "Wastage", "w1", f"{_n('d_wastage')} - {_n('w1')}"),
    ("invalid_ratings", "Ratings", "r2", f"{_n('r1')} - {_n('r2')}"),
    ("missing_ids", "Orders", "o4", f"{_n('o3')} - {_n('o4')}"),
    ("missing_ids", "Order_Items", "l3", f"{_n('l2')} - {_n('l3')}"),
    ("invalid_restaurants", "Orders", "o5", f"{_n('o4')} - {_n('o5')}"),
    ("impossible_wastage", "Wastage", "w1", _n("w2", "hit")),
    ("incorrect_discounts", "Order_Items", "l3", _n("l4", "hit")),
    ("inconsistent_units", "Inventory", "i1", "(SELECT count(*) FROM i1 JOIN m1 USING (menu_item_id) WHERE i1.unit_of_measure <> m1.unit_of_measure)"),
    ("inconsistent_units", "Wastage", "w1", "(SELECT count(*) FROM w1 JOIN m1 USING (menu_item_id) WHERE w1.unit_of_measure <> m1.unit_of_measure)"),
    ("cancelled_orders", "Orders", "o5", "0"),
    ("orphan_lines", "Order_Items", "l5", f"{_n('l4')} - {_n('l5')}"),
    ("invalid_unit_prices", "Order_Items", "l6", f"{_n('l5')} - {_n('l6')}"),
]
SQL["clean_log"] = with_views(f", {CHAIN} " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{s}' AS step, '{t}' AS \"table\", {_n(rel)} AS clean_rows, {q} AS quarantined" for i, (s, t, rel, q) in enumerate(_log)))

# fixed values: reason of each step's quarantine
_REASONS = {
    ("missing_values", "Orders"): "missing amount or time", ("duplicate_orders", "Orders"): "duplicate order_id", ("duplicate_lines", "Order_Items"): "duplicate order_item_id",
    ("invalid_menu_prices", "Menu_Items"): "invalid menu price", ("negative_quantities", "Order_Items"): "negative quantity", ("negative_consumption", "Inventory"): "negative consumption",
    ("invalid_dates", "Orders"): "invalid order_timestamp", ("invalid_dates", "Ratings"): "invalid rating_timestamp", ("invalid_dates", "Wastage"): "invalid wastage_date",
    ("invalid_ratings", "Ratings"): "invalid rating", ("missing_ids", "Orders"): "missing customer_id", ("missing_ids", "Order_Items"): "missing menu_item_id",
    ("invalid_restaurants", "Orders"): "unknown restaurant", ("impossible_wastage", "Wastage"): "wastage above stock", ("incorrect_discounts", "Order_Items"): "discount above line amount",
    ("inconsistent_units", "Inventory"): "unit differs from menu", ("inconsistent_units", "Wastage"): "unit differs from menu", ("orphan_lines", "Order_Items"): "order not in clean orders",
    ("invalid_unit_prices", "Order_Items"): "invalid unit price",
}
SQL["sink_quarantine"] = with_views(f", {CHAIN} SELECT reason, CAST(sum(n) AS BIGINT) AS rows FROM (" + " UNION ALL ".join(
    f"SELECT '{_REASONS[s, t]}' AS reason, {q} AS n" for s, t, _, q in _log if (s, t) in _REASONS) + ") GROUP BY reason HAVING sum(n) > 0")
