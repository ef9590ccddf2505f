from larder.operators.validation import BUSINESS_CASES, FEATURE_SPEC
from larder.sources.schemas import CRITICAL_COLUMNS, FOREIGN_KEYS, MIN_ROWS, PRIMARY_KEYS
from oracle.cleaning import CHAIN
from oracle.features import CUSTOMER, ITEM, ORDER
from oracle.menu import KNOWN, med
from oracle.stock_price_promo import DAILY
from oracle.views import TABLE_VIEWS, mean, r, ratio, with_views


def union(parts):
    return " UNION ALL ".join(parts)


ROWS = union(f"SELECT '{t}' AS \"table\", 'rows' AS \"check\", count(*) AS actual, {n}::BIGINT AS minimum, CASE WHEN count(*) = 0 THEN 'FAIL' WHEN count(*) < {n} THEN 'WARN' ELSE 'PASS' END AS status FROM {TABLE_VIEWS[t]}" for t, n in MIN_ROWS.items())
COLS = union(f"SELECT '{t}' AS \"table\", 'columns' AS \"check\", count(*) AS rows, '' AS missing, 'PASS' AS status FROM {TABLE_VIEWS[t]}" for t in CRITICAL_COLUMNS)
NULLS = union(f"SELECT '{t}' AS \"table\", 'nulls_in_{c}' AS \"check\", count(*) - count({c}) AS nulls, CASE WHEN count(*) = count({c}) THEN 'PASS' ELSE 'WARN' END AS status FROM {TABLE_VIEWS[t]}" for t, cs in CRITICAL_COLUMNS.items() for c in cs)


def fk(child, col, parent, key, tol, views=TABLE_VIEWS):
    rate = "coalesce(CAST(count(*) FILTER (WHERE miss) AS DOUBLE) / nullif(count(*), 0), 0)"
    return f"SELECT '{child}.{col}' AS reference, '{parent}' AS parent, count(*) AS checked, count(*) FILTER (WHERE miss) AS orphans, {r(rate, 6)} AS rate, {rate} <= {tol} AS ok FROM (SELECT {col} NOT IN (SELECT {key} FROM {views[parent]}) AS miss FROM {views[child]} WHERE {col} IS NOT NULL)"


def formula(name, rel, valid, hit):
    s = f"CAST(count(*) FILTER (WHERE {valid} AND {hit}) AS DOUBLE) / nullif(count(*) FILTER (WHERE {valid}), 0)"
    return f"SELECT '{name}' AS formula, count(*) FILTER (WHERE {valid}) AS valid, count(*) FILTER (WHERE {valid} AND {hit}) AS matching, {r(s, 6)} AS share, {s} >= 0.99 AS ok FROM {rel}"


def domain(col, rel, allowed):
    inside = f"count(*) FILTER (WHERE lower(trim({col})) IN ({', '.join(repr(a.lower()) for a in allowed)}))"
    return f"SELECT '{col}' AS \"column\", count({col}) AS known, {inside} AS inside, count(DISTINCT {col}) AS distinct_values, {r(f'CAST({inside} AS DOUBLE) / count({col})', 6)} AS share, CAST({inside} AS DOUBLE) / count({col}) >= 0.99 AS ok FROM {rel}"


STATS = f"""b_stats AS (SELECT *, CASE WHEN revenue > 0 THEN margin / revenue ELSE 0.0 END AS margin_pct FROM (SELECT menu_item_id, CAST(sum(quantity) AS DOUBLE) AS qty, CAST(sum(line_total - quantity * unit_cost) AS DOUBLE) AS margin, CAST(sum(line_total) AS DOUBLE) AS revenue
  FROM d_lines WHERE menu_item_id IS NOT NULL AND quantity IS NOT NULL GROUP BY 1)),
b_all AS (SELECT b.*, wasted, rating FROM b_stats b LEFT JOIN (SELECT menu_item_id, CAST(sum(quantity_wasted) AS DOUBLE) AS wasted FROM d_wastage GROUP BY 1) USING (menu_item_id)
  LEFT JOIN (SELECT menu_item_id, {mean('rating_value')} AS rating FROM d_ratings WHERE rating_value BETWEEN 1 AND 5 GROUP BY 1) USING (menu_item_id)),
b_thr AS (SELECT *, {med('qty', 'b_all', .75)} AS q75, {med('qty', 'b_all', .25)} AS q25, {med('margin_pct', 'b_all', .75)} AS m75, {med('margin_pct', 'b_all', .25)} AS m25, {med('wasted', 'b_all', .75)} AS w75 FROM b_all)"""
PROMO = """v_day AS (SELECT menu_item_id, date, sum(quantity) AS q, sum(line_margin) AS m FROM d_sales WHERE menu_item_id IS NOT NULL GROUP BY 1, 2),
v_win AS (SELECT * FROM d_promo_items JOIN d_promos USING (promotion_id)),
v_sum AS (SELECT promotion_id, CAST(coalesce(sum(q) FILTER (WHERE date >= start_date), 0) AS DOUBLE) AS units_in, CAST(coalesce(sum(q) FILTER (WHERE date < start_date), 0) AS DOUBLE) AS units_before,
  CAST(coalesce(sum(m) FILTER (WHERE date >= start_date), 0) AS DOUBLE) AS margin_in, CAST(coalesce(sum(m) FILTER (WHERE date < start_date), 0) AS DOUBLE) AS margin_before
  FROM v_win w JOIN v_day d ON w.menu_item_id = d.menu_item_id AND date BETWEEN start_date - CAST(end_date - start_date AS INTEGER) AND end_date GROUP BY 1),
v_tot AS (SELECT promotion_id, CAST(sum(q) AS DOUBLE) AS units_all FROM d_promo_items JOIN v_day USING (menu_item_id) GROUP BY 1)"""
PATTERNS = f"""y_sales AS (SELECT * FROM d_sales WHERE menu_item_id IS NOT NULL),
y_cv AS (SELECT menu_item_id, stddev_samp(q) / nullif(avg(q), 0) AS cv FROM (SELECT menu_item_id, restaurant_id, CAST(sum(quantity) AS DOUBLE) AS q FROM y_sales WHERE restaurant_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
y_share AS (SELECT menu_item_id, CAST(sum(w) AS DOUBLE) / sum(n) AS weekend_share, CASE WHEN sum(q) > 0 THEN max(q) / sum(q) END AS peak_month_share, min(f) AS first_sale FROM
  (SELECT menu_item_id, month(date) AS m, CAST(sum(quantity) AS DOUBLE) AS q, count(*) AS n, count(*) FILTER (WHERE isodow(date) >= 6) AS w, min(order_timestamp) AS f FROM y_sales GROUP BY 1, 2) GROUP BY 1),
patterns AS (SELECT menu_item_id, {r('cv', 6)} AS location_cv, {r('weekend_share', 6)} AS weekend_share, {r('peak_month_share', 6)} AS peak_month_share, first_sale, coalesce(cv > 0.5, false) AS location_specific,
  weekend_share > 0.65 AS weekend_only, coalesce(peak_month_share > 0.35, false) AS seasonal, first_sale > TIMESTAMP '2001-08-01' - INTERVAL 2370 DAY AS new_item FROM y_share LEFT JOIN y_cv USING (menu_item_id))"""
_FT = {"item": "known_items", "customer": "customer_features", "order": "order_features", "location_item": "loc_item"}
_TYPES = {"order_frequency": "bigint", "recency_days": "int", "order_count": "bigint", "preferred_channel": "string", "is_peak_hour": "int", "basket_size": "bigint"}


def feature(t, c, low, high, tol):
    outside = " OR ".join([f"{c} < {low}"] * (low is not None) + [f"{c} > {high}"] * (high is not None)) or "false"
    return f"SELECT '{t}' AS feature_table, '{c}' AS feature, '{_TYPES.get(c, 'double')}' AS type, {r(f'1 - CAST(count({c}) AS DOUBLE) / count(*)', 6)} AS null_share, count(*) FILTER (WHERE {outside}) AS out_of_range, {r(f'1 - CAST(count({c}) AS DOUBLE) / count(*)', 6)} <= {tol} AND count(*) FILTER (WHERE {outside}) = 0 AS ok FROM {_FT[t]}"


_CLEANED = {"Orders": "o5", "Order_Items": "l6", "Customers": "d_customers", "Restaurants": "d_restaurants", "Menu_Items": "m1", "Ratings": "r2", "Wastage": "w2", "Inventory": "i1"}
_CAPPED = "(SELECT *, CASE WHEN discount_amount > round(quantity * unit_price, 2) THEN round(quantity * unit_price, 2) ELSE discount_amount END AS d FROM l6)"


def viol(rule, expr, rel):
    return f"SELECT '{rule}' AS rule, {expr} AS violations FROM {rel}"


CLEAN = union(
    [
        viol("duplicate_order_ids", "count(*) - count(DISTINCT order_id)", "o5"),
        viol("orders_without_customer", "count(*) - count(customer_id)", "o5"),
        viol("orders_without_restaurant", "count(*) - count(restaurant_id)", "o5"),
        viol("duplicate_line_ids", "count(*) - count(DISTINCT order_item_id)", "l6"),
        viol("lines_without_item", "count(*) - count(menu_item_id)", "l6"),
        viol("lines_without_quantity", "count(*) FILTER (WHERE (quantity > 0) IS NOT TRUE)", "l6"),
        viol("lines_without_price", "count(*) FILTER (WHERE (unit_price > 0) IS NOT TRUE)", "l6"),
        viol("discount_outside_line", "count(*) FILTER (WHERE (d >= 0 AND d <= quantity * unit_price + 0.01) IS NOT TRUE)", _CAPPED),
        viol("ratings_outside_1_5", "count(*) FILTER (WHERE (rating_value BETWEEN 1 AND 5) IS NOT TRUE)", "r2"),
        viol("negative_wastage", "count(*) FILTER (WHERE quantity_wasted < 0)", "w2"),
    ]
    + [f"SELECT 'orphans_' || reference AS rule, orphans AS violations FROM ({fk(c, k, p, k, 0, _CLEANED)})" for c, k, p in [("Orders", "customer_id", "Customers"), ("Orders", "restaurant_id", "Restaurants"), ("Order_Items", "order_id", "Orders"), ("Order_Items", "menu_item_id", "Menu_Items"), ("Wastage", "restaurant_id", "Restaurants")]]
    + [viol(f"rows_created_{t}", f"greatest(0, count(*) - (SELECT count(*) FROM {TABLE_VIEWS[t]}))", _CLEANED[t]) for t in ("Orders", "Order_Items", "Ratings", "Inventory", "Wastage")]
)
DIFFICULT = f"""z_sales AS (SELECT * FROM d_sales WHERE quantity > 0 AND unit_price > 0 AND menu_item_id IS NOT NULL),
z_items AS (SELECT menu_item_id, CAST(sum(quantity) AS DOUBLE) AS qty, CAST(sum(line_margin) AS DOUBLE) AS margin, CAST(sum(line_total) AS DOUBLE) AS revenue, min(order_timestamp) AS first_sale, CAST(coalesce(sum(quantity) FILTER (WHERE isodow(date) >= 6), 0) AS DOUBLE) AS weekend_qty FROM z_sales GROUP BY 1),
z_join AS (SELECT i.*, margin / nullif(revenue, 0) AS margin_pct, wasted / nullif(qty, 0) AS waste_ratio, weekend_qty / nullif(qty, 0) AS weekend_share, spread FROM z_items i
  LEFT JOIN (SELECT menu_item_id, CAST(sum(quantity_wasted) AS DOUBLE) AS wasted FROM d_wastage WHERE quantity_wasted > 0 GROUP BY 1) USING (menu_item_id)
  LEFT JOIN (SELECT menu_item_id, max(q) / greatest(min(q), 1.0) AS spread FROM (SELECT menu_item_id, restaurant_id, CAST(sum(quantity) AS DOUBLE) AS q FROM z_sales WHERE restaurant_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1) USING (menu_item_id)),
z_thr AS (SELECT *, {med('qty', 'z_join', .75)} AS q75, {med('qty', 'z_join', .5)} AS q50, {med('qty', 'z_join', .25)} AS q25, {med('margin_pct', 'z_join', .75)} AS m75, {med('waste_ratio', 'z_join', .5)} AS w50 FROM z_join)"""
_HARD = {"top_seller_with_loss": "qty >= q75 AND margin < 0", "slow_seller_with_high_margin": "qty <= q25 AND margin_pct >= m75", "popular_with_double_wastage": "waste_ratio >= 2 * w50 AND qty >= q75", "new_item": "first_sale >= (SELECT max(order_timestamp) FROM d_orders) - INTERVAL 120 DAY", "location_spread": "qty >= q50 AND spread >= 3", "weekend_item": "weekend_share >= 0.6"}
_PAT = {"weekend_share": ("CAST(count(*) FILTER (WHERE isodow(order_timestamp) >= 5) AS DOUBLE) / count(*)", 0.4), "peak_share": ("CAST(count(*) FILTER (WHERE hour(order_timestamp) BETWEEN 11 AND 21) AS DOUBLE) / count(*)", 0.6), "month_share_std": ("(SELECT stddev_samp(c) FROM (SELECT count(*) AS c FROM d_orders GROUP BY month(order_timestamp))) / count(*)", 0.005)}
CHANNELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SQL = {
    "validation_rows": with_views(ROWS),
    "validation_columns": with_views(COLS),
    "validation_nulls": with_views(NULLS),
    "validation_dates": with_views("SELECT 'date_range' AS \"check\", min(order_timestamp) AS min_date, max(order_timestamp) AS max_date, '2000-12-31' AS feature_cutoff, '2001-01-01' AS label_start, 'PASS' AS status FROM d_orders"),
    "validation_active_months": with_views(f"SELECT month, orders, {r('CAST(orders AS DOUBLE) / (SELECT count(*) FROM d_orders)', 6)} AS share, CAST(orders AS DOUBLE) / (SELECT count(*) FROM d_orders) >= 0.01 AS active FROM (SELECT CAST(date_trunc('month', order_timestamp) AS DATE) AS month, count(*) AS orders FROM d_orders GROUP BY 1)"),
    "validation_summary": with_views(f", s AS (SELECT status FROM ({ROWS}) UNION ALL SELECT status FROM ({COLS}) UNION ALL SELECT status FROM ({NULLS})) SELECT count(*) AS total, count(*) FILTER (WHERE status = 'PASS') AS pass, count(*) FILTER (WHERE status = 'WARN') AS warn, count(*) FILTER (WHERE status = 'FAIL') AS fail FROM s"),
    "validation_keys": with_views(union(f"SELECT '{t}' AS \"table\", '{', '.join(k)}' AS key, count(*) AS rows, count(DISTINCT ({', '.join(k)})) AS distinct_keys, count(*) = count(DISTINCT ({', '.join(k)})) AS \"unique\" FROM {TABLE_VIEWS[t]}" for t, k in PRIMARY_KEYS.items())),
    "validation_foreign_keys": with_views(union(fk(*f) for f in FOREIGN_KEYS)),
    "validation_formulas": with_views(union([formula("line_total", "d_lines", "(quantity > 0 AND unit_price > 0 AND discount_amount >= 0 AND line_total IS NOT NULL)", "abs(CAST(quantity * unit_price - discount_amount AS DOUBLE) - CAST(line_total AS DOUBLE)) <= 0.011"), formula("total_amount", "d_orders", "(subtotal IS NOT NULL AND discount_total IS NOT NULL AND total_amount IS NOT NULL)", "abs(CAST(subtotal - discount_total AS DOUBLE) - CAST(total_amount AS DOUBLE)) <= 0.011")])),
    "validation_domains": with_views(union([domain("order_channel", "d_orders", CHANNELS), domain("order_status", "d_orders", ("completed", "cancelled"))])),
    "validation_targets": with_views("SELECT 'rating_target' AS \"check\", count(*) AS rows, count(*) FILTER (WHERE menu_item_id IS NOT NULL OR restaurant_id IS NOT NULL) AS good FROM d_ratings UNION ALL SELECT 'promotion_dates', count(*), count(*) FILTER (WHERE end_date >= start_date) FROM d_promos"),
    "validation_registration": with_views("SELECT count(*) AS checked, count(*) FILTER (WHERE CAST(order_timestamp AS DATE) < registration_date) AS violations FROM d_orders JOIN d_customers USING (customer_id)"),
    "validation_demand_patterns": with_views(union(f"SELECT '{n}' AS pattern, {r(e, 6)} AS value, {r(e, 6)} >= {lim} AS ok FROM d_orders" for n, (e, lim) in _PAT.items())),
    "validation_business_cases": with_views(f", {STATS} " + union(f"SELECT '{n}' AS business_case, count(*) FILTER (WHERE {c}) AS items, count(*) FILTER (WHERE {c}) >= {k} AS ok FROM b_thr" for n, (c, k) in BUSINESS_CASES.items())),
    "validation_spike_items": with_views(f", {DAILY} SELECT count(*) AS items, count(*) FILTER (WHERE hi > m * 4) AS spike_items, count(*) FILTER (WHERE lo < m * 0.15) AS drop_items FROM (SELECT menu_item_id, avg(qty) AS m, max(qty) AS hi, min(qty) AS lo FROM daily GROUP BY 1 HAVING count(*) >= 30 AND avg(qty) >= 3)"),
    "validation_rating_concentration": with_views(f", c AS (SELECT menu_item_id, CAST(rating_timestamp AS DATE) AS d, count(*) AS n, {mean('rating_value')} AS rt FROM d_ratings WHERE rating_value BETWEEN 1 AND 5 AND rating_timestamp IS NOT NULL GROUP BY 1, 2) SELECT count(*) AS concentrations, count(*) FILTER (WHERE rt >= 4.3) AS spikes, count(*) FILTER (WHERE rt <= 2.2) AS drops FROM c WHERE n > (SELECT avg(n) + 2 * stddev_samp(n) FROM c)"),
    "validation_promotions": with_views(f""", {PROMO} SELECT promotion_id, units_in, units_before, margin_in, margin_before, units_all, units_before > 0 AND units_in >= 1.2::DOUBLE * units_before AND margin_in < margin_before AS trap,
      units_in / (end_date - start_date + 1) >= 2 * greatest((units_all - units_in) / greatest(1, DATE '2001-08-01' - DATE '1995-01-01' - (end_date - start_date + 1)), 0.1) AS dependent FROM d_promos JOIN v_sum USING (promotion_id) JOIN v_tot USING (promotion_id)"""),
    "validation_item_patterns": with_views(f", {PATTERNS} SELECT * FROM patterns"),
    "validation_pattern_counts": with_views(f", {PATTERNS} " + union(f"SELECT '{p}' AS pattern, count(*) FILTER (WHERE {p}) AS items FROM patterns" for p in ("location_specific", "weekend_only", "seasonal", "new_item"))),
    "validation_features": with_views(f", {ITEM}, {KNOWN}, {CUSTOMER}, {ORDER}, loc_item AS (SELECT restaurant_id, menu_item_id, CAST(sum(line_total) AS DOUBLE) AS revenue FROM d_sales GROUP BY 1, 2) " + union(feature(*f) for f in FEATURE_SPEC)),
    "validation_clean_layer": with_views(f", {CHAIN} SELECT *, violations = 0 AS ok FROM ({CLEAN})"),
    "validation_stages": with_views(f", {CHAIN} SELECT *, {r('CAST(clean_orders AS DOUBLE) / raw_orders', 6)} AS kept_share, CAST(clean_orders AS DOUBLE) / raw_orders >= 0.9 AND feature_orders <= clean_orders AS ok FROM (SELECT (SELECT count(DISTINCT order_id) FROM d_orders) AS raw_orders, (SELECT count(*) FROM o5) AS clean_orders, (SELECT count(DISTINCT order_id) FROM l6) AS feature_orders)"),
    "validation_difficult_cases": with_views(f", {DIFFICULT} " + union(f"SELECT '{n}' AS difficult_case, count(*) FILTER (WHERE {c}) AS items FROM z_thr" for n, c in _HARD.items())),
}
