from larder.operators.menu import BASIC_CASES, CASE_COLUMNS, EDA_LISTS, SLOW_CRITERIA
from oracle.features import ITEM
from oracle.views import with_views

KNOWN = "known_items AS (SELECT * FROM item_features WHERE menu_item_id IS NOT NULL)"


def med(col, rel, p=0.5):
    return f"(SELECT quantile_cont(CAST({col} AS DOUBLE), {p}) FROM {rel})"


CLASSES = f"""menu_classes AS (SELECT menu_item_id, item_name, quantity_sold, revenue, contribution_margin,
  CASE WHEN hq AND hm THEN 'Star' WHEN hq THEN 'High Sales - Low Profit' WHEN hm THEN 'Low Sales - High Profit' ELSE 'Low Sales - Low Profit' END AS menu_class
  FROM (SELECT *, quantity_sold >= {med('quantity_sold', 'known_items')} AS hq, contribution_margin >= {med('contribution_margin', 'known_items')} AS hm FROM known_items))"""

VALUES = sorted({c for _, cols in BASIC_CASES.values() for c in cols})


def _basic(rel):
    mids = ", ".join(f"{med(c, rel)} AS {n}" for n, c in [("q_mid", "quantity_sold"), ("m_mid", "contribution_margin"), ("r_mid", "avg_rating"), ("w_mid", "wastage_pct"), ("p_mid", "promotion_dependency")])
    rows = " UNION ALL ".join(
        f"SELECT menu_item_id, item_name, {', '.join(c if c in cols else f'NULL::DOUBLE AS {c}' for c in VALUES)}, '{n}' AS case_type FROM b_judged WHERE {cond}"
        for n, (cond, cols) in BASIC_CASES.items()
    )
    return f"b_judged AS (SELECT *, {mids} FROM {rel}), basic_cases AS ({rows})"


PROFIT_COLS = """menu_item_id, item_name, category_id, category_name, quantity_sold, revenue, cost, contribution_margin, profit_pct,
  avg_rating, repeat_purchase_rate, wastage_pct, promotion_dependency, sales_trend_pct, h1_quantity, h2_quantity,
  order_frequency, distinct_customers, rating_count, total_wastage_cost, discount_total, min_price, max_price"""
PROFIT = f"""h_halves AS (SELECT menu_item_id, CAST(coalesce(sum(quantity) FILTER (WHERE order_timestamp < TIMESTAMP '1998-07-01'), 0) AS DOUBLE) AS h1_quantity,
   CAST(coalesce(sum(quantity) FILTER (WHERE order_timestamp >= TIMESTAMP '1998-07-01'), 0) AS DOUBLE) AS h2_quantity FROM d_sales GROUP BY 1),
menu_profit AS (SELECT {PROFIT_COLS} FROM (SELECT i.*, h1_quantity, h2_quantity,
   CASE WHEN h1_quantity = 0 THEN CASE WHEN h2_quantity > 0 THEN 100.0::DOUBLE ELSE 0.0 END
        ELSE (h2_quantity - h1_quantity) / h1_quantity * 100 END AS sales_trend_pct
   FROM item_features i LEFT JOIN h_halves h ON i.menu_item_id = h.menu_item_id)),
profit_known AS (SELECT * FROM menu_profit WHERE menu_item_id IS NOT NULL)"""


def _pr(c):
    return f"percent_rank() OVER (ORDER BY {c} NULLS FIRST)"


PERF_COLS = """menu_item_id, item_name, category_id, category_name, quantity_sold, revenue, cost, contribution_margin, profit_pct,
  avg_rating, repeat_purchase_rate, wastage_pct, promotion_dependency, sales_trend_pct, sales_index, profitability_index"""
PERF = f"""p_index AS (SELECT *, CAST(round(CAST(({' + '.join(_pr(c) for c in ('quantity_sold', 'revenue', 'order_frequency', 'sales_trend_pct'))}) / 4 AS DECIMAL(38,16)), 9) AS DOUBLE) AS sales_index,
  CAST(round(CAST(({' + '.join(_pr(c) for c in ('contribution_margin', 'profit_pct', 'avg_rating', 'repeat_purchase_rate'))} + 1 - {_pr('wastage_pct')} + 1 - {_pr('promotion_dependency')}) / 6 AS DECIMAL(38,16)), 9) AS DOUBLE) AS profitability_index
  FROM profit_known),
p_level AS (SELECT *, sales_index >= {med('sales_index', 'p_index')} AS hs, profitability_index >= {med('profitability_index', 'p_index')} AS hp FROM p_index),
menu_perf AS (SELECT {PERF_COLS}, CASE WHEN hs THEN 'High' ELSE 'Low' END AS sales_level, CASE WHEN hp THEN 'High' ELSE 'Low' END AS profitability_level,
  CASE WHEN hs AND hp THEN 'Profit Driver' WHEN hs THEN 'Volume Driver' WHEN hp THEN 'Hidden Opportunity' ELSE 'Low Performer' END AS performance_class FROM p_level)"""

CASES = f"""{_basic('profit_known')},
k_sales AS (SELECT * FROM d_sales WHERE menu_item_id IS NOT NULL),
k_loc AS (SELECT menu_item_id, max(q) AS max_location_quantity, min(q) AS min_location_quantity, count(*) AS location_count FROM
   (SELECT menu_item_id, restaurant_id, CAST(sum(quantity) AS DOUBLE) AS q FROM k_sales WHERE restaurant_id IS NOT NULL GROUP BY ALL) GROUP BY 1
   HAVING count(*) >= 2 AND max(q) > min(q) * 2),
k_week AS (SELECT menu_item_id, CAST(coalesce(sum(quantity) FILTER (WHERE isodow(date) < 6), 0) AS DOUBLE) AS weekday_quantity,
   CAST(coalesce(sum(quantity) FILTER (WHERE isodow(date) >= 6), 0) AS DOUBLE) AS weekend_quantity FROM k_sales GROUP BY 1),
k_month AS (SELECT menu_item_id, max(q) AS max_month_quantity, min(q) AS min_month_quantity, count(*) AS active_months FROM
   (SELECT menu_item_id, month(date) AS m, CAST(sum(quantity) AS DOUBLE) AS q FROM k_sales GROUP BY ALL) GROUP BY 1 HAVING count(*) >= 6 AND max(q) > min(q) * 2),
k_new AS (SELECT menu_item_id, min(order_timestamp) AS first_order_date, max(order_timestamp) AS last_order_date,
   CAST(date_diff('day', CAST(min(order_timestamp) AS DATE), (SELECT CAST(max(order_timestamp) AS DATE) FROM d_orders)) AS INTEGER) AS history_days FROM k_sales GROUP BY 1),
all_cases AS (SELECT {', '.join(CASE_COLUMNS)} FROM (
  SELECT * FROM basic_cases
  UNION ALL BY NAME SELECT k.*, item_name, quantity_sold, revenue, contribution_margin, 'Different performance across locations' AS case_type FROM k_loc k LEFT JOIN profit_known USING (menu_item_id)
  UNION ALL BY NAME SELECT k.*, item_name, quantity_sold, revenue, 'Performs well only on weekends' AS case_type FROM k_week k LEFT JOIN profit_known USING (menu_item_id)
     WHERE weekend_quantity > weekday_quantity AND weekend_quantity >= weekday_quantity * 1.5
  UNION ALL BY NAME SELECT k.*, item_name, quantity_sold, revenue, 'Seasonal menu item' AS case_type FROM k_month k LEFT JOIN profit_known USING (menu_item_id)
  UNION ALL BY NAME SELECT k.*, item_name, quantity_sold, revenue, contribution_margin, 'New menu item with insufficient history' AS case_type FROM k_new k LEFT JOIN profit_known USING (menu_item_id) WHERE history_days < 2000))"""

GAPS = """s_gap AS (SELECT {key}, CASE WHEN count(*) > 1 THEN CAST(coalesce(sum(gap), 0) AS DOUBLE) / (count(*) - 1) ELSE 0.0 END AS avg_days_between_orders FROM
   (SELECT {key}, floor((epoch(order_timestamp) - epoch(lag(order_timestamp) OVER (PARTITION BY {key} ORDER BY order_timestamp))) / 86400) AS gap FROM {rel}) GROUP BY 1)"""
_thr = {"q25_qty": ("qty_sold", .25), "q25_orders": ("orders", .25), "q75_gap": ("avg_days_between_orders", .75), "q25_repeat": ("repeat_purchase", .25), "q75_waste": ("total_wasted", .75), "q25_margin": ("margin", .25)}
SLOW = f"""s_rows AS (SELECT * FROM d_sales WHERE menu_item_id IS NOT NULL AND date <= DATE '2000-12-31'), {GAPS.format(key='menu_item_id', rel='s_rows')},
s_waste AS (SELECT menu_item_id, CAST(sum(quantity_wasted) AS DOUBLE) AS total_wasted, CAST(sum(wastage_cost) AS DOUBLE) AS wastage_cost FROM d_wastage GROUP BY 1),
s_agg AS (SELECT menu_item_id, CAST(sum(quantity) AS DOUBLE) AS qty_sold, CAST(sum(line_total) AS DOUBLE) AS revenue, CAST(sum(line_margin) AS DOUBLE) AS margin,
   count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers, max(order_timestamp) AS last_sale, min(order_timestamp) AS first_sale,
   CAST(coalesce(sum(quantity) FILTER (WHERE month(date) <= 6), 0) AS DOUBLE) AS h1_qty, CAST(coalesce(sum(quantity) FILTER (WHERE month(date) > 6), 0) AS DOUBLE) AS h2_qty
   FROM s_rows GROUP BY 1),
s_all AS (SELECT a.*, avg_days_between_orders, greatest(orders - 1, 0) AS repeat_purchase, coalesce(total_wasted, 0.0) AS total_wasted, coalesce(wastage_cost, 0.0) AS wastage_cost
   FROM s_agg a JOIN s_gap USING (menu_item_id) LEFT JOIN s_waste USING (menu_item_id)),
s_thr AS (SELECT *, {', '.join(f"{med(c, 's_all', p)} AS {n}" for n, (c, p) in _thr.items())} FROM s_all),
s_crit AS (SELECT * EXCLUDE ({', '.join(_thr)}), {', '.join(f'{c} AS {n}' for n, c in SLOW_CRITERIA.items())} FROM s_thr),
item_summary AS (SELECT s.*, CAST({' + '.join(f'CAST({c} AS INTEGER)' for c in SLOW_CRITERIA)} AS INTEGER) AS criteria_met,
   (c_low_volume OR c_low_frequency) AND (c_low_repeat OR c_weak_margin) OR c_high_wastage AND c_poor_trend AS is_slow_moving,
   last_sale < TIMESTAMP '2000-12-31' - INTERVAL 90 DAY AS no_recent_sale, item_name, category_id, base_price
   FROM s_crit s LEFT JOIN d_menu USING (menu_item_id))"""
SIMPLE_SLOW = """simple_slow AS (SELECT menu_item_id, item_name, category_name, quantity_sold, revenue, profit_pct, wastage_pct, promotion_dependency, performance_class,
  'Item sells slowly' AS finding, printf('Among the least sold: %.0f units worth %.2f', quantity_sold, revenue) AS evidence,
  'Prepare less of it, or give it a better place on the menu.' AS action, 'Medium' AS priority FROM menu_perf WHERE lower(sales_level) = 'low')"""

_eda = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{n}' AS ranking, menu_item_id, item_name, {m} AS value FROM known_items ORDER BY {m} {'ASC' if asc else 'DESC'} NULLS LAST, menu_item_id LIMIT 10)"
    for n, (m, asc) in EDA_LISTS.items()
)
SQL = {
    "menu_item_eda": with_views(f", {ITEM}, {KNOWN} {_eda}"),
    "menu_classification": with_views(f", {ITEM}, {KNOWN}, {CLASSES} SELECT * FROM menu_classes"),
    "menu_class_counts": with_views(f", {ITEM}, {KNOWN}, {CLASSES} SELECT menu_class, count(*) AS items FROM menu_classes GROUP BY 1"),
    "menu_class_samples": with_views(f", {ITEM}, {KNOWN}, {CLASSES} SELECT * FROM menu_classes QUALIFY row_number() OVER (PARTITION BY menu_class ORDER BY quantity_sold DESC, menu_item_id) <= 5"),
    "menu_tricky_basic": with_views(f", {ITEM}, {KNOWN}, {_basic('known_items')} SELECT * FROM basic_cases"),
    "menu_profitability": with_views(f", {ITEM}, {PROFIT} SELECT * FROM menu_profit"),
    "menu_performance": with_views(f", {ITEM}, {PROFIT}, {PERF} SELECT * FROM menu_perf"),
    "menu_performance_check": with_views(f""", {ITEM}, {PROFIT}, {PERF} SELECT count(*) AS items, count(DISTINCT performance_class) AS classes,
       count(*) FILTER (WHERE performance_class IS NULL) AS null_class, count(*) FILTER (WHERE sales_index IS NULL OR profitability_index IS NULL) AS null_index,
       count(DISTINCT performance_class) = 4 AND count(*) FILTER (WHERE performance_class IS NULL) = 0 AND count(*) FILTER (WHERE sales_index IS NULL OR profitability_index IS NULL) = 0 AS complete FROM menu_perf"""),
    "menu_tricky_cases": with_views(f", {ITEM}, {PROFIT}, {CASES} SELECT * FROM all_cases"),
    "menu_tricky_counts": with_views(f", {ITEM}, {PROFIT}, {CASES} SELECT case_type, count(*) AS cases FROM all_cases GROUP BY 1"),
    "menu_item_sales_summary": with_views(f", {SLOW} SELECT * FROM item_summary"),
    "menu_slow_moving": with_views(f", {SLOW} SELECT * FROM item_summary WHERE is_slow_moving"),
    "menu_slow_by_count": with_views(f", {SLOW} SELECT * REPLACE (criteria_met >= 4 AS is_slow_moving) FROM item_summary WHERE criteria_met >= 4"),
    "menu_no_recent_sales": with_views(f", {SLOW.replace('INTERVAL 90 DAY', 'INTERVAL 10 DAY')} SELECT * FROM item_summary WHERE no_recent_sale"),
    "menu_simple_slow_movers": with_views(f", {ITEM}, {PROFIT}, {PERF}, {SIMPLE_SLOW} SELECT * FROM simple_slow"),
}
