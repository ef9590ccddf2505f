from oracle.menu import med
from oracle.stock_price_promo import DAILY
from oracle.views import mean, r, with_views

_M = f"{r(mean('rating_value'), 2)} AS avg_rating, count(rating_id) AS n_ratings, {r('stddev_samp(rating_value)', 2)} AS std_rating"
BY_ITEM = f"""t_sold AS (SELECT menu_item_id, CAST(sum(quantity) AS DOUBLE) AS qty_sold, CAST(sum(line_total) AS DOUBLE) AS revenue, CAST(sum(line_total - quantity * unit_cost) AS DOUBLE) AS margin,
   count(DISTINCT order_id) AS orders, greatest(count(DISTINCT order_id) - 1, 0) AS repeat_purchase FROM d_lines WHERE menu_item_id IS NOT NULL GROUP BY 1),
t_join AS (SELECT * FROM (SELECT menu_item_id, {_M} FROM d_ratings GROUP BY 1) LEFT JOIN t_sold USING (menu_item_id) LEFT JOIN (SELECT menu_item_id, item_name, category_id FROM d_menu) USING (menu_item_id)),
by_item AS (SELECT *, coalesce((avg_rating >= HIGH AND qty_sold < {med('qty_sold', 't_join')}) OR (avg_rating <= LOW AND qty_sold > {med('qty_sold', 't_join')}), false) AS rating_sales_mismatch FROM t_join)"""
_B = BY_ITEM.replace("HIGH", "3.05").replace("LOW", "2.85")
ANOM = f"""a_daily AS (SELECT menu_item_id, CAST(rating_timestamp AS DATE) AS date, count(rating_id) AS n, {mean('rating_value')} AS avg, stddev_samp(rating_value) AS daily_std FROM d_ratings WHERE rating_timestamp IS NOT NULL GROUP BY 1, 2),
a_z AS (SELECT d.*, m, s, (n - m) / nullif(s, 0) AS z FROM a_daily d JOIN (SELECT menu_item_id, avg(n) AS m, stddev_samp(n) AS s FROM a_daily GROUP BY 1) USING (menu_item_id)),
a_type AS (SELECT *, CASE WHEN z > 3 THEN 'concentration' WHEN n >= 5 AND avg >= 4.3 THEN 'spike' WHEN n >= 5 AND avg <= 2.2 THEN 'drop' WHEN n >= 10 AND daily_std = 0 THEN 'identical' END AS type FROM a_z)"""
_EV = "(SELECT event_id, user_id, event_type, ts, value FROM events)"
KPI = f"""kpi AS (SELECT *, {r('(revenue - lag(revenue) OVER w) / nullif(lag(revenue) OVER w, 0) * 100', 4)} AS revenue_change_pct, {r('(orders - lag(orders) OVER w) / nullif(lag(orders) OVER w, 0) * 100', 4)} AS orders_change_pct
   FROM (SELECT restaurant_id, CAST(date_trunc('month', order_timestamp) AS DATE) AS month, CAST(sum(total_amount) AS DOUBLE) AS revenue, count(*) AS orders FROM d_orders WHERE restaurant_id IS NOT NULL GROUP BY 1, 2)
   WINDOW w AS (PARTITION BY restaurant_id ORDER BY month))"""
SQL = {
    "ratings_by_item": with_views(f", {_B} SELECT * FROM by_item"),
    "rating_inconsistencies": with_views(f", {_B} SELECT * FROM by_item WHERE rating_sales_mismatch"),
    "ratings_by_location": with_views(f"SELECT * FROM (SELECT restaurant_id, {_M} FROM d_ratings GROUP BY 1) LEFT JOIN (SELECT restaurant_id, count(order_id) AS n_orders, CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM d_orders GROUP BY 1) USING (restaurant_id)"),
    "ratings_by_time": with_views(f"SELECT month(rating_timestamp) AS month, dayname(rating_timestamp) AS dow, {r(mean('rating_value'), 2)} AS avg_rating, count(rating_id) AS n_ratings FROM d_ratings WHERE rating_timestamp IS NOT NULL GROUP BY 1, 2"),
    "ratings_by_promo_day": with_views(f"SELECT coalesce(CAST(rating_timestamp AS DATE) IN (SELECT CAST(order_timestamp AS DATE) + 8567 FROM d_orders WHERE promotion_id IS NOT NULL), false) AS has_promo, {r(mean('rating_value'), 2)} AS avg_rating, count(rating_id) AS n_ratings FROM d_ratings GROUP BY 1"),
    "rating_anomalies": with_views(f", {ANOM} SELECT menu_item_id, date, n, {r('avg', 6)} AS avg, {r('daily_std', 6)} AS daily_std, {r('m', 6)} AS n_mean, {r('s', 6)} AS n_std, {r('z', 6)} AS z, type FROM a_type WHERE type IS NOT NULL"),
    "rating_burst": with_views("SELECT menu_item_id, CAST(rating_timestamp AS DATE) AS date, rating_value, count(*) AS n FROM d_ratings WHERE rating_timestamp IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 3"),
    "sales_spike_drop": with_views(f""", {DAILY}, z AS (SELECT d.menu_item_id, date, qty, revenue, m AS mean, s AS std, (qty - m) / nullif(s, 0) AS z FROM daily d JOIN (SELECT menu_item_id, avg(qty) AS m, stddev_samp(qty) AS s FROM daily GROUP BY 1) USING (menu_item_id))
      SELECT menu_item_id, date, qty, revenue, {r('mean', 6)} AS mean, {r('std', 6)} AS std, {r('z', 6)} AS z, type FROM (SELECT *, CASE WHEN qty > 4 * mean OR z > 3 THEN 'spike' WHEN qty > 0 AND qty < 0.15 * mean THEN 'drop' END AS type FROM z) WHERE type IS NOT NULL"""),
    "value_outliers": with_views(f"SELECT *, 'event_value' AS type FROM {_EV}, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) WHERE value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)").replace("SELECT *, 'event_value'", "SELECT event_id, user_id, event_type, ts, value, 'event_value'"),
    "discount_outliers": with_views("""SELECT *, 'discount' AS type FROM (SELECT order_id, customer_id, restaurant_id, order_timestamp, subtotal, discount_total, coalesce(CAST(discount_total AS DOUBLE) / nullif(CAST(subtotal AS DOUBLE), 0), 0.0) AS discount_pct FROM d_orders) x
      WHERE discount_pct > (SELECT avg(p) + 3 * stddev_samp(p) FROM (SELECT coalesce(CAST(discount_total AS DOUBLE) / nullif(CAST(subtotal AS DOUBLE), 0), 0.0) AS p FROM d_orders))"""),
    "duplicate_transactions": with_views(f"""SELECT event_id, user_id, event_type, ts, value, {r('gap / 60000000', 6)} AS time_gap_min, 'duplicate_transaction' AS type FROM
      (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)) AS gap FROM {_EV}) WHERE gap < 3600000000"""),
    "order_value_outliers": with_views("""SELECT o.*, 'order_value' AS type FROM d_orders o, (SELECT quantile_cont(CAST(total_amount AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(total_amount AS DOUBLE), 0.75) AS q3 FROM d_orders)
      WHERE total_amount < q1 - 0.4 * (q3 - q1) OR total_amount > q3 + 0.4 * (q3 - q1)"""),
    "order_duplicate_transactions": with_views(f""", o2 AS (SELECT order_id, customer_id, restaurant_id, order_timestamp, total_amount FROM d_orders
      UNION ALL SELECT -order_id - 1, customer_id, restaurant_id, order_timestamp + INTERVAL 5 MINUTE, total_amount FROM d_orders WHERE order_id % 10 = 0)
      SELECT order_id, customer_id, restaurant_id, order_timestamp, total_amount, {r('gap / 60000000', 6)} AS time_gap_min, 'duplicate_transaction' AS type FROM
      (SELECT *, epoch_us(order_timestamp) - epoch_us(lag(order_timestamp) OVER (PARTITION BY customer_id, restaurant_id, total_amount ORDER BY order_timestamp, order_id)) AS gap FROM o2
       WHERE customer_id IS NOT NULL AND restaurant_id IS NOT NULL AND total_amount IS NOT NULL AND order_timestamp IS NOT NULL) WHERE gap < 3600000000"""),
    "unexpected_demand": with_views(f""", sz AS (SELECT order_id, count(DISTINCT menu_item_id) AS n_items FROM d_lines GROUP BY 1)
      SELECT order_id, customer_id, restaurant_id, order_timestamp, total_amount, n_items, (SELECT {r('avg(n_items)', 2)} FROM sz) AS mean_items, 'unexpected_demand' AS type FROM sz LEFT JOIN d_orders USING (order_id)
      WHERE n_items > (SELECT avg(n_items) + 3 * stddev_samp(n_items) FROM sz)"""),
    "weekday_spike": with_views(f""", {DAILY}, span AS (SELECT min(date) AS lo, max(date) AS hi FROM daily),
      grid AS (SELECT menu_item_id, CAST(d AS DATE) AS date FROM (SELECT DISTINCT menu_item_id FROM daily), (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM span)),
      dense AS (SELECT menu_item_id, date, coalesce(qty, 0.0) AS qty FROM grid LEFT JOIN daily USING (menu_item_id, date)),
      nb AS (SELECT menu_item_id, date, qty, list_median AS baseline FROM (SELECT *, list_aggregate([lag(qty, 7) OVER w, lag(qty, 14) OVER w, lead(qty, 7) OVER w, lead(qty, 14) OVER w], 'median') AS list_median FROM dense WINDOW w AS (PARTITION BY menu_item_id ORDER BY date)))
      SELECT * FROM nb WHERE qty >= 5 * baseline AND baseline >= 3"""),
    "kpi_changes": with_views(f", {KPI} SELECT * FROM kpi"),
    "rule_anomalies_combined": with_views(f", {KPI.replace('restaurant_id', 'order_channel')} SELECT *, 'orders_change_pct >= 5 and order_channel <> ''5-LOW'' and revenue_change_pct > 10' AS rule FROM kpi WHERE orders_change_pct >= 5 AND order_channel <> '5-LOW' AND revenue_change_pct > 10"),
    "rule_anomalies": with_views(f", {KPI} SELECT *, 'revenue_change_pct > 20' AS rule FROM kpi WHERE revenue_change_pct > 20"),
}
