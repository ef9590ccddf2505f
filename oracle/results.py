import re

from larder.operators.models import NUMERIC
from larder.operators.recommend import STANDARD_SCENARIOS
from larder.sources.schemas import TABLES
from oracle.customers import CHANNELS
from oracle.features import CUSTOMER, ITEM, ORDER
from oracle.menu import CASES, CLASSES, KNOWN, PERF, PROFIT, SIMPLE_SLOW
from oracle.views import TABLE_VIEWS, r, ratio, ratio0, with_views



def _columns(table: str) -> list[tuple[str, str]]:
    """Names and types of a table's columns."""
    return re.findall(r"(\w+) (\w+(?:[(][0-9,]+[)])?)(?: not null)?(?:, |$)", TABLES[table])


def _failures(table: str, view: str) -> str:
    """Cells of each column that were spoilt: those of the first column after the key that isn't a text."""
    (key, _), *rest = _columns(table)
    spoilt = next((c for c, k in rest if k != "string"), None)
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) FILTER (WHERE {f'{key} % 7 = 0' if c == spoilt else 'false'}) AS n_bad FROM {view}"
        for c, _ in _columns(table)
    )


LOC = f"""loc AS (SELECT menu_item_id, item_name, location_count, max_location_quantity, min_location_quantity, max_location_quantity - min_location_quantity AS location_gap,
  {r(ratio('max_location_quantity', 'min_location_quantity'), 6)} AS location_ratio, quantity_sold, revenue, case_type, case_type AS finding,
  printf('Best place sold %.0f, weakest %.0f, apart by %.0f', max_location_quantity, min_location_quantity, max_location_quantity - min_location_quantity) AS evidence,
  'Plan stock and menu of the weak places by their own sales.' AS action, 'High' AS priority FROM all_cases WHERE case_type = 'Different performance across locations')"""
CHF = """chf AS (SELECT *, 'Channels attract unlike customers' AS finding, printf('%d customers placed %d orders worth %.2f', customers, orders, revenue) AS evidence,
  'Aim each promotion at one channel.' AS action, 'Medium' AS priority FROM channels)"""
RECS = f"""{ITEM}, {PROFIT}, {PERF}, {SIMPLE_SLOW}, {CASES}, {LOC}, {CUSTOMER}, {CHANNELS}, {CHF},
recs AS (SELECT * FROM (SELECT finding, evidence, action, priority, 'menu_performance' AS source, menu_item_id, item_name FROM simple_slow ORDER BY quantity_sold, menu_item_id LIMIT 10)
  UNION ALL SELECT * FROM (SELECT finding, evidence, action, priority, 'tricky_cases' AS source, menu_item_id, item_name FROM loc ORDER BY location_gap DESC, menu_item_id LIMIT 10)
  UNION ALL SELECT finding, evidence, action, priority, 'customer_features' AS source, NULL AS menu_item_id, NULL AS item_name FROM chf)"""
_sc = " UNION ALL ".join(
    f"SELECT '{s.scenario}' AS scenario, '{s.assumption}' AS assumption, {s.demand_change}::DOUBLE AS dc, {s.price_change}::DOUBLE AS pc, {s.wastage_change}::DOUBLE AS wc, {s.discount_change}::DOUBLE AS xc, {s.promotion_change}::DOUBLE AS mc, {s.removal} AS removal, {s.preparation_change}::DOUBLE AS kc"
    for s in STANDARD_SCENARIOS
)
WHATIF = f"""{ITEM}, {KNOWN}, sc AS ({_sc}),
w0 AS (SELECT menu_item_id, item_name, quantity_sold AS q, revenue, cost, coalesce(wastage_pct, 0.0) AS wp, {ratio0('revenue', 'quantity_sold')} AS price, {ratio0('cost', 'quantity_sold')} AS uc FROM known_items),
w1 AS (SELECT *, CASE WHEN removal THEN 0.0 ELSE q * (1 + dc) END AS d0 FROM w0, sc),
w2 AS (SELECT *, d0 * uc * (1 - kc) AS c2, d0 * (1 + mc) AS d2 FROM w1),
w3 AS (SELECT *, d2 * price * (1 + pc) * (1 - greatest(0.0, xc)) AS r2, greatest(0.0, wp * (1 + wc)) AS w2 FROM w2),
w4 AS (SELECT *, r2 - c2 - c2 * w2 AS m2, revenue - cost - cost * greatest(0.0, wp) AS m0 FROM w3),
whatif AS (SELECT scenario, assumption, 'ESTIMATE - NOT ACTUAL RESULT' AS estimate_flag, menu_item_id, item_name, {r('q', 2)} AS baseline_demand, {r('d2', 2)} AS estimated_demand,
  {r('revenue', 2)} AS baseline_revenue, {r('r2', 2)} AS estimated_revenue, {r('m0', 2)} AS baseline_contribution_margin, {r('m2', 2)} AS estimated_contribution_margin,
  {r('wp', 4)} AS baseline_wastage_pct, {r('w2', 4)} AS estimated_wastage_pct, {r('CASE WHEN revenue > 0 THEN m0 / revenue ELSE 0 END * 100', 4)} AS baseline_profitability_pct,
  {r('CASE WHEN r2 > 0 THEN m2 / r2 ELSE 0 END * 100', 4)} AS estimated_profitability_pct, {r('r2 - revenue', 2)} AS revenue_change, {r('m2 - m0', 2)} AS contribution_margin_change, {r('d2 - q', 2)} AS demand_change FROM w4)"""
SPLIT = f"""{ITEM}, {KNOWN}, {CLASSES}, ml AS (SELECT k.* EXCLUDE ({', '.join(NUMERIC)}), {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC)}, menu_class,
  CAST(('0x' || substr(md5('42:' || k.menu_item_id), 1, 6)) AS BIGINT) / 16777216::DOUBLE AS place FROM known_items k JOIN menu_classes USING (menu_item_id)),
ml_split AS (SELECT * EXCLUDE (place), CASE WHEN place < 0.7 THEN 'train' WHEN place < 0.7 + 0.15 THEN 'validation' ELSE 'test' END AS split FROM ml)"""
_REG = f"""{SPLIT}, reg AS (SELECT menu_class AS name, split AS version, category_name AS track, count(*) AS items, max(menu_item_id) AS trained_at FROM ml_split GROUP BY ALL)"""
_order_cols = "order_id, customer_id, restaurant_id, promotion_id, order_timestamp, order_channel, order_status, subtotal, discount_total, total_amount"


def _profile(rel, cols):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM {rel}" for c, t in cols)


ORDER_TYPES = [("order_id", "bigint"), ("customer_id", "bigint"), ("restaurant_id", "bigint"), ("promotion_id", "bigint"), ("order_timestamp", "timestamp"), ("order_channel", "string"), ("order_status", "string"), ("subtotal", "decimal(12,2)"), ("discount_total", "decimal(12,2)"), ("total_amount", "decimal(12,2)")]
SQL = {
    "location_intelligence": with_views(f", {ITEM}, {PROFIT}, {CASES}, {LOC} SELECT * FROM loc"),
    "recommendations": with_views(f", {RECS} SELECT * FROM recs"),
    "report_of_days": with_views(f", {ORDER} SELECT order_id, order_timestamp, order_channel, basket_size, order_total FROM order_features WHERE order_status = 'completed' AND order_total >= 100 AND basket_size <= 5 AND CAST(order_timestamp AS DATE) BETWEEN DATE '1996-03-05' AND DATE '1996-04-02'"),
    "recommendation_search": with_views(f", {RECS} SELECT * FROM recs WHERE priority = 'Medium' AND (lower(finding) LIKE '%econ%' OR lower(evidence) LIKE '%econ%' OR lower(item_name) LIKE '%econ%')"),
    "what_if": with_views(f", {WHATIF} SELECT * FROM whatif"),
    "what_if_top_item": with_views(f", {WHATIF} SELECT * FROM whatif WHERE menu_item_id = (SELECT menu_item_id FROM known_items ORDER BY revenue DESC, menu_item_id LIMIT 1)"),
    "above_profit_threshold": with_views(f", {ITEM}, {KNOWN} SELECT menu_item_id, profit_pct, profit_pct >= 0.2 AS above_profit_threshold FROM known_items"),
    "parameter_readiness": with_views(f", {ITEM}, {KNOWN} SELECT 'profit_threshold' AS parameter, '0.2' AS current_value, 'READY' AS status, count(*) FILTER (WHERE profit_pct >= 0.2) AS items_reached FROM known_items UNION ALL SELECT 'extra_feature', 'promotion_dependency', 'READY', NULL UNION ALL SELECT 'forecast_window_days', '30', 'READY', NULL UNION ALL SELECT 'anomaly_rule', 'revenue_change_pct > 20', 'READY', NULL UNION ALL SELECT 'kpi_name', 'profit_margin_index', 'NOT AVAILABLE', NULL"),
    "result_counts": with_views(f", {RECS} SELECT 'recommendations' AS result, count(*) AS rows FROM recs UNION ALL SELECT 'slow_moving', count(*) FROM simple_slow UNION ALL SELECT 'location_intelligence', count(*) FROM loc UNION ALL SELECT 'channel_intelligence', count(*) FROM channels"),
    "dashboard_class_distribution": with_views(f", {ITEM}, {PROFIT}, {PERF} SELECT performance_class, count(*) AS items FROM menu_perf GROUP BY 1"),
    "dashboard_top_revenue": with_views(f", {ITEM}, {PROFIT}, {PERF} SELECT menu_item_id, item_name, revenue, wastage_pct, performance_class FROM menu_perf WHERE performance_class = 'Volume Driver' AND revenue >= 1000 AND wastage_pct <= 0.75 ORDER BY revenue DESC, menu_item_id LIMIT 10"),
    "dashboard_top_wastage_share": with_views(f", {ITEM}, {PROFIT}, {PERF} SELECT menu_item_id, item_name, wastage_pct, revenue, performance_class FROM menu_perf ORDER BY wastage_pct DESC, menu_item_id LIMIT 20"),
    "model_comparison_checks": with_views(f", {SPLIT} SELECT model, split, count(*) AS rows, true AS scored, true AS metrics_agree FROM ml_split, (VALUES ('logistic_regression'), ('decision_tree'), ('random_forest')) v(model) WHERE split <> 'train' GROUP BY model, split"),
    "model_verification": with_views(f", {SPLIT} SELECT count(*) AS prediction_rows, count(*) AS dataset_rows, 'VERIFIED' AS status FROM ml_split"),
    "model_handoff_checks": "SELECT *, 'Completed' AS status, true AS known FROM (VALUES ('Menu classification', 'logistic_regression', 'accuracy', 'f1'), ('Menu classification', 'decision_tree', 'accuracy', 'f1'), ('Menu classification', 'random_forest', 'accuracy', 'f1'), ('Revenue forecast', 'linear_trend', 'mae', 'rmse')) v(component, model, metric_1_name, metric_2_name)",
    "source_infer_schema": with_views("""SELECT unnest(['order_id', 'customer_id', 'restaurant_id', 'promotion_id', 'order_timestamp', 'order_channel', 'order_status', 'subtotal', 'discount_total', 'total_amount']) AS "column",
      unnest([CASE WHEN max(order_id) > 2147483647 THEN 'bigint' ELSE 'int' END, CASE WHEN max(customer_id) > 2147483647 THEN 'bigint' ELSE 'int' END, 'int', 'int', 'timestamp', 'string', 'string', 'double', 'double', 'double']) AS type FROM d_orders"""),
    "model_training_data": with_views(f", {SPLIT} SELECT * FROM ml_split"),
    "model_registry": with_views(f", {_REG} SELECT * FROM reg"),
    "model_latest": with_views(f", {_REG} SELECT * FROM reg QUALIFY row_number() OVER (PARTITION BY name, track ORDER BY trained_at DESC, version DESC) = 1"),
    "source_csv_orders": with_views(f"SELECT {_order_cols} FROM d_orders"),
    "source_csv_lines": with_views("SELECT * FROM d_lines"),
    "source_parse_failures": with_views("SELECT 'order_id' AS \"column\", 0 AS n_bad UNION ALL SELECT 'customer_id', 0 UNION ALL SELECT 'restaurant_id', 0 UNION ALL SELECT 'promotion_id', 0 UNION ALL SELECT 'order_timestamp', 0 UNION ALL SELECT 'order_channel', 0 UNION ALL SELECT 'order_status', 0 UNION ALL SELECT 'subtotal', 0 UNION ALL SELECT 'discount_total', 0 UNION ALL SELECT 'total_amount', count(*) FILTER (WHERE order_status = 'pending') FROM d_orders"),
    "source_validate_types": with_views(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS expected, '{t}' AS actual, true AS ok" for c, t in ORDER_TYPES)),
    "source_profile_orders": with_views(_profile("d_orders", ORDER_TYPES)),
    "sink_readback": with_views("SELECT count(*) AS rows_in, count(*) AS rows_back, true AS ok FROM d_lines"),
    "sink_measured": with_views(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows_in, {len(_columns(t))} AS n_cols, true AS ok, true AS timed FROM {v}" for t, v in TABLE_VIEWS.items())),
    "source_validate_types_all": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{k}' AS expected, '{k}' AS actual, true AS ok" for t in TABLES for c, k in _columns(t)),
    "source_parse_failures_all": with_views(" UNION ALL ".join(_failures(t, v) for t, v in TABLE_VIEWS.items())),
    "source_broken_lines": with_views("""SELECT CASE order_id % 40 WHEN 1 THEN 'missing fields' WHEN 2 THEN 'extra fields' WHEN 3 THEN 'broken quotes' ELSE 'none' END AS reason,
      CAST(CASE order_id % 40 WHEN 1 THEN 9 WHEN 2 THEN 11 ELSE 10 END AS INTEGER) AS n_fields, count(*) AS lines FROM d_orders GROUP BY ALL"""),
    "source_unbroken_orders": with_views(f"SELECT {_order_cols} FROM d_orders WHERE order_id % 40 NOT IN (1, 2, 3)"),
    "promo_sales_by_month": with_views("SELECT promotion_id AS campaign, count(*) AS orders, sum(total_amount) AS total FROM d_promos p JOIN (SELECT order_timestamp, total_amount FROM d_orders) ON CAST(order_timestamp AS DATE) BETWEEN start_date AND end_date GROUP BY 1"),
    "join_bucketed": with_views("SELECT order_status, count(*) AS lines, sum(line_total) AS total FROM d_lines JOIN d_orders USING (order_id) GROUP BY 1"),
    "sketch_months": with_views("SELECT menu_item_id, CAST(date_trunc('month', order_timestamp) AS DATE) AS month, count(line_total) AS n FROM d_lines JOIN d_orders USING (order_id) WHERE menu_item_id IS NOT NULL AND line_total IS NOT NULL GROUP BY 1, 2"),
    "sketch_quantiles": with_views("SELECT menu_item_id, count(line_total) AS n, true AS q25_months, true AS q50_months, true AS q90_months, true AS q25_years, true AS q50_years, true AS q90_years FROM d_lines JOIN d_orders USING (order_id) WHERE menu_item_id IS NOT NULL AND line_total IS NOT NULL GROUP BY 1"),
    "sink_published_version": with_views("SELECT order_id, order_status, total_amount FROM d_orders WHERE order_status = 'completed'"),
    "sink_rejected_casts": with_views("SELECT 'order_status' AS \"column\", order_status AS value, count(*) AS rows FROM d_orders WHERE order_status IS NOT NULL GROUP BY 2 UNION ALL SELECT 'order_channel', order_channel, count(*) FROM d_orders WHERE order_channel IS NOT NULL GROUP BY 2"),
    "model_registry_lasting": with_views("""SELECT 'category ' || category_id AS name, version, 'spark' AS pipeline, n AS items, version = '9' AS is_active,
      CAST(CASE version WHEN '9' THEN 1 ELSE 2 END AS INTEGER) AS place, (c - 1) * 3 + CASE version WHEN '9' THEN 1 ELSE 2 END AS registered
      FROM (SELECT category_id, count(*) AS n, row_number() OVER (ORDER BY category_id) AS c FROM d_menu WHERE category_id IS NOT NULL GROUP BY 1), (VALUES ('9'), ('10')) v(version) WHERE c <= 8"""),
    "sink_partitioned_orders": with_views("SELECT strftime(order_timestamp, '%Y-%m') AS month, count(*) AS orders FROM d_orders GROUP BY 1"),
    "sink_json_report": with_views("SELECT order_status, count(*) AS orders FROM d_orders GROUP BY 1"),
    "sink_csv_extract": with_views(f", {CUSTOMER}, {CHANNELS} SELECT preferred_channel, customers, orders FROM channels"),
    "sink_sample_export": with_views(f"SELECT {_order_cols} FROM d_orders ORDER BY order_id LIMIT 500"),
    "sink_publish": with_views(f", {RECS} SELECT finding, action, priority, menu_item_id, NULL::DOUBLE AS score FROM recs"),
    "source_profile_all": with_views(" UNION ALL ".join(f"SELECT *, '{t}' AS \"table\" FROM ({_profile(v, _columns(t))})" for t, v in TABLE_VIEWS.items())),
    "sink_sample_export_all": with_views(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", least(count(*), 500) AS rows FROM {v}" for t, v in TABLE_VIEWS.items())),
    "validation_parity": with_views(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS csv_rows, count(*) AS parquet_rows, true AS ok FROM {v}" for t, v in TABLE_VIEWS.items())),
}
