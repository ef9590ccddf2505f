from oracle.features import ACTIVE, CUSTOMER, CUSTOMER_BASE, ORDER
from oracle.menu import GAPS, med
from oracle.views import r, ratio, with_views

_TOD = "CASE WHEN hour(order_timestamp) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(order_timestamp) BETWEEN 12 AND 16 THEN 'afternoon' WHEN hour(order_timestamp) BETWEEN 17 AND 21 THEN 'evening' ELSE 'night' END"


def _mode(rel, key, expr, name):
    return f"""(SELECT {key}, v AS {name} FROM (SELECT {key}, {expr} AS v, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {expr}) AS rn
      FROM {rel} GROUP BY {key}, {expr}) WHERE rn = 1)"""


def behaviour(where, cutoff, name="behaviour"):
    return f"""b_orders AS (SELECT * FROM d_orders WHERE customer_id IS NOT NULL AND {where}),
b_share AS (SELECT customer_id, CAST(count(*) FILTER (WHERE hour(order_timestamp) BETWEEN 11 AND 21) AS DOUBLE) / count(*) AS peak_ratio,
   CAST(count(*) FILTER (WHERE isodow(order_timestamp) >= 6) AS DOUBLE) / count(*) AS weekend_ratio,
   CAST(count(promotion_id) AS DOUBLE) / count(*) AS promo_sensitivity,
   count(*) FILTER (WHERE order_timestamp >= TIMESTAMP '{cutoff}' - INTERVAL 90 DAY) AS freq_recent_90d,
   {r(f"CAST(count(*) FILTER (WHERE order_timestamp >= TIMESTAMP '{cutoff}' - INTERVAL 90 DAY) AS DOUBLE) / count(*)", 4)} AS freq_trend
   FROM b_orders GROUP BY 1),
{GAPS.format(key='customer_id', rel='b_orders').replace('s_gap', 'b_gap')},
b_cat AS (SELECT customer_id, category_name, category_id, count(*) AS c FROM d_lines JOIN b_orders USING (order_id) JOIN d_menu USING (menu_item_id) JOIN d_categories USING (category_id) GROUP BY ALL),
b_fav AS (SELECT customer_id, count(*) AS distinct_categories, min(category_name) FILTER (WHERE rn = 1) AS favorite_category FROM
   (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY c DESC, category_name) AS rn FROM b_cat) GROUP BY 1),
{name} AS (SELECT * FROM b_share JOIN {_mode('b_orders', 'customer_id', 'order_channel', 'preferred_channel')} USING (customer_id)
   JOIN {_mode('b_orders', 'customer_id', _TOD, 'time_of_day_preference')} USING (customer_id)
   JOIN b_gap USING (customer_id) LEFT JOIN b_fav USING (customer_id))"""


BEHAVIOUR = behaviour("order_status <> 'cancelled' AND order_timestamp < TIMESTAMP '2001-01-01'", "2000-12-31")


def _q(col):
    return f"greatest(1, CAST(ceil((row_number() OVER (ORDER BY {col}, customer_id) - 1) * 4.0 / (count(*) OVER () - 1)) AS INTEGER))"


def rfm(rel="customer_base", name="rfm"):
    return f"""{name} AS (SELECT *, r_score + f_score + m_score AS rfm_sum, r_score || '' || f_score || m_score AS rfm_string FROM
  (SELECT *, 5 - {_q('recency')} AS r_score, {_q('frequency')} AS f_score, {_q('monetary')} AS m_score FROM {rel}))"""


def _thr(c, rev):
    o = (4, 3, 2, 1) if rev else (1, 2, 3, 4)
    return f"CASE WHEN {c} <= {med(c, 'customer_base', .25)} THEN {o[0]} WHEN {c} <= {med(c, 'customer_base', .5)} THEN {o[1]} WHEN {c} <= {med(c, 'customer_base', .75)} THEN {o[2]} ELSE {o[3]} END"


CHANNELS = f"""channels AS (SELECT preferred_channel, count(customer_id) AS customers, CAST(sum(order_count) AS BIGINT) AS orders,
   CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS revenue, {r('avg(average_order_value)', 4)} AS avg_order_value,
   {r('avg(avg_basket_size)', 6)} AS avg_basket_size, {r('avg(recency_days)', 6)} AS avg_recency
   FROM customer_features WHERE preferred_channel IS NOT NULL GROUP BY 1)"""
_DIMS = {"hour": "hour(order_timestamp)", "dow": "dayname(order_timestamp)", "weekend": "isodow(order_timestamp) >= 6", "month": "month(order_timestamp)", "restaurant_id": "restaurant_id", "order_channel": "order_channel"}


def _peak(*by):
    return f"SELECT {', '.join(f'{_DIMS[b]} AS {b}' for b in by)}, count(order_id) AS orders, CAST(sum(coalesce(total_amount, 0)) AS DOUBLE) AS revenue FROM d_orders GROUP BY ALL"


def _best(by, measure):
    return f"(SELECT {by} FROM ({_peak(by)}) ORDER BY {measure} DESC, {by} LIMIT 1)"


BASKET = f"""k_b AS (SELECT DISTINCT order_id, menu_item_id FROM d_lines),
k_n AS (SELECT count(DISTINCT order_id) AS n FROM k_b),
k_s AS (SELECT menu_item_id, count(*) AS c FROM k_b WHERE menu_item_id IS NOT NULL GROUP BY 1),
k_p AS (SELECT a.menu_item_id AS item_a, b.menu_item_id AS item_b, count(*) AS together FROM k_b a JOIN k_b b ON a.order_id = b.order_id AND a.menu_item_id < b.menu_item_id GROUP BY 1, 2),
k_f AS (SELECT k_p.* FROM k_p, k_n JOIN k_s x ON x.menu_item_id = item_a JOIN k_s y ON y.menu_item_id = item_b WHERE x.c >= 0.002 * n AND y.c >= 0.002 * n),
k_d AS (SELECT item_a AS antecedent, item_b AS consequent, together FROM k_p UNION ALL SELECT item_b, item_a, together FROM k_p),
k_m AS (SELECT antecedent, consequent, CAST(together AS DOUBLE) / n AS s, (CAST(together AS DOUBLE) / n) / (CAST(x.c AS DOUBLE) / n) AS cf,
   (CAST(together AS DOUBLE) / n) / (CAST(x.c AS DOUBLE) / n) / (CAST(y.c AS DOUBLE) / n) AS lf
   FROM k_d JOIN k_s x ON x.menu_item_id = antecedent JOIN k_s y ON y.menu_item_id = consequent, k_n),
rules AS (SELECT antecedent, consequent, {r('s', 6)} AS support, {r('cf', 4)} AS confidence, {r('lf', 4)} AS lift FROM k_m WHERE s >= 0.002 AND cf >= 0.03 AND lf >= 1.2),
named AS (SELECT rules.*, x.item_name AS antecedent_name, y.item_name AS consequent_name FROM rules LEFT JOIN d_menu x ON x.menu_item_id = antecedent
   LEFT JOIN d_menu y ON y.menu_item_id = consequent WHERE x.item_name IS DISTINCT FROM y.item_name)"""

_SETS = f"""{BASKET},
i_1 AS (SELECT [menu_item_id] AS items, c FROM k_s, k_n WHERE c >= 0.0002 * n),
i_2 AS (SELECT [item_a, item_b] AS items, together AS c FROM k_p, k_n WHERE together >= 0.0002 * n),
i_3 AS (SELECT [x.menu_item_id, y.menu_item_id, z.menu_item_id] AS items, count(*) AS c FROM k_b x JOIN k_b y ON x.order_id = y.order_id AND x.menu_item_id < y.menu_item_id
   JOIN k_b z ON y.order_id = z.order_id AND y.menu_item_id < z.menu_item_id GROUP BY 1 HAVING count(*) >= (SELECT 0.0002 * n FROM k_n)),
i_a AS (FROM i_1 UNION ALL FROM i_2 UNION ALL FROM i_3),
i_m AS (SELECT items, c, unnest(range(1, CAST(1 << len(items) AS BIGINT) - 1)) AS m FROM i_a WHERE len(items) > 1),
i_r AS (SELECT c, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS a, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 0) AS b FROM i_m),
i_f AS (SELECT a, b, CAST(i_r.c AS DOUBLE) / n AS s, (CAST(i_r.c AS DOUBLE) / n) / (CAST(x.c AS DOUBLE) / n) AS cf,
   (CAST(i_r.c AS DOUBLE) / n) / (CAST(x.c AS DOUBLE) / n) / (CAST(y.c AS DOUBLE) / n) AS lf FROM i_r JOIN i_a x ON x.items = a JOIN i_a y ON y.items = b, k_n)"""

SEGMENTS = f"""s_in AS (SELECT rfm.*, behaviour.* EXCLUDE (customer_id), rfm_sum AS cluster FROM rfm LEFT JOIN behaviour USING (customer_id)),
s_mean AS (SELECT cluster, {r('avg(r_score)', 3)} AS r, {r('avg(f_score)', 3)} AS f, {r('avg(m_score)', 3)} AS m, {r('avg(promo_sensitivity)', 3)} AS promo, {r('avg(weekend_ratio)', 3)} AS weekend, count(customer_id) AS n FROM s_in GROUP BY 1),
s_named AS (SELECT s_mean.*, top_channel, top_tod, top_category, CASE WHEN promo >= 0.5 THEN 'promotion_driven' WHEN weekend >= 0.7 THEN 'weekend_only' WHEN r >= 3 AND f >= 3.5 AND m >= 3.5 THEN 'high_value_loyal'
   WHEN f >= 3 THEN 'frequent' WHEN r <= 2.2 AND f >= 1.9 AND m >= 1.8 THEN 'at_risk' WHEN r >= 2 AND f <= 2 AND m <= 2 THEN 'new' ELSE 'occasional' END AS nm
   FROM s_mean LEFT JOIN {_mode('s_in', 'cluster', 'preferred_channel', 'top_channel')} USING (cluster) LEFT JOIN {_mode('s_in', 'cluster', 'time_of_day_preference', 'top_tod')} USING (cluster)
   LEFT JOIN {_mode('s_in', 'cluster', 'favorite_category', 'top_category')} USING (cluster))"""

SQL = {
    "segment_profiles_by_score": with_views(f", {CUSTOMER_BASE}, {rfm()}, {BEHAVIOUR}, {SEGMENTS} SELECT * EXCLUDE (nm), CASE WHEN count(*) OVER (PARTITION BY nm) > 1 THEN nm || '_' || row_number() OVER (PARTITION BY nm ORDER BY r DESC, f DESC, m DESC, cluster) ELSE nm END AS segment FROM s_named"),
    "segment_checks": with_views(f", {CUSTOMER_BASE}, {rfm()} SELECT count(*) AS rows, count(DISTINCT customer_id) AS keys, 6 AS clusters, true AS nearest FROM rfm"),
    "rfm_base": with_views(f", {CUSTOMER_BASE} SELECT * FROM customer_base"),
    "customer_behaviour": with_views(f", {BEHAVIOUR} SELECT * FROM behaviour"),
    "rfm_scores": with_views(f", {CUSTOMER_BASE}, {rfm()} SELECT * FROM rfm"),
    "rfm_threshold_scores": with_views(f", {CUSTOMER_BASE} SELECT *, {_thr('recency', True)} AS r_score, {_thr('frequency', False)} AS f_score, {_thr('monetary', False)} AS m_score FROM customer_base"),
    "rfm_distribution": with_views(f", {CUSTOMER_BASE}, {rfm()} SELECT rfm_sum, count(*) AS n_customers FROM rfm GROUP BY 1"),
    "channel_intelligence": with_views(f", {CUSTOMER}, {CHANNELS} SELECT * FROM channels"),
    "dashboard_channel_share": with_views(f", {CUSTOMER}, {CHANNELS} SELECT preferred_channel, orders, revenue, {r('orders / (SELECT sum(orders) FROM channels)', 6)} AS order_share, {r('revenue / (SELECT sum(revenue) FROM channels)', 6)} AS revenue_share FROM channels"),
    "churned_customers": with_views("SELECT customer_id, count(DISTINCT order_id) AS orders, max(order_timestamp) AS last_order FROM d_orders WHERE customer_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT order_id) >= 3 AND max(order_timestamp) <= TIMESTAMP '2001-08-01' - INTERVAL 120 DAY"),
    "basket_singles": with_views(f", {BASKET} SELECT menu_item_id, c AS baskets, n AS n_baskets FROM k_s, k_n"),
    "basket_pairs": with_views(f", {BASKET} SELECT * FROM k_f"),
    "basket_itemsets": with_views(f", {_SETS} SELECT array_to_string(items, '+') AS items, CAST(len(items) AS INTEGER) AS size, c AS baskets, {r('CAST(c AS DOUBLE) / n', 6)} AS support FROM i_a, k_n"),
    "basket_itemset_rules": with_views(f", {_SETS} SELECT array_to_string(a, '+') AS antecedent, array_to_string(b, '+') AS consequent, {r('s', 6)} AS support, {r('cf', 4)} AS confidence, {r('lf', 4)} AS lift FROM i_f WHERE cf >= 0.03 AND lf >= 1.2"),
    "basket_rules": with_views(f", {BASKET} SELECT * FROM rules"),
    "basket_rules_named": with_views(f", {BASKET} SELECT * FROM named"),
    "basket_top20": with_views(f", {BASKET} SELECT * FROM named ORDER BY lift DESC, support DESC, antecedent, consequent LIMIT 20"),
    "basket_bundles": with_views(f""", {BASKET}, best AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY least(antecedent, consequent), greatest(antecedent, consequent) ORDER BY lift DESC, confidence DESC, antecedent, consequent) = 1)
      SELECT antecedent_name, consequent_name, support, confidence, lift, 'Combo Meal' AS recommendation_type, row_number() OVER (ORDER BY lift DESC, confidence DESC, antecedent, consequent) AS rank FROM best QUALIFY rank <= 30"""),
    "peaks_hour": with_views(_peak("hour")),
    "peaks_day": with_views(_peak("dow")),
    "peaks_weekend": with_views(_peak("weekend")),
    "peaks_month": with_views(_peak("month")),
    "peaks_location": with_views(_peak("restaurant_id")),
    "peaks_location_hour": with_views(_peak("restaurant_id", "hour")),
    "peaks_channel": with_views(_peak("order_channel")),
    "peaks_channel_hour": with_views(_peak("order_channel", "hour")),
    "peaks_summary": with_views(f"SELECT {_best('hour', 'orders')} AS peak_hour, {_best('dow', 'orders')} AS peak_day, {_best('month', 'orders')} AS peak_month, {_best('order_channel', 'orders')} AS peak_channel, {_best('restaurant_id', 'revenue')} AS peak_location"),
    "revenue_by_restaurant": with_views(f", {ORDER} SELECT restaurant_id, count(*) AS orders, CAST(sum(CAST(order_total AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM order_features WHERE order_status = 'completed' GROUP BY 1"),
}
