from oracle.views import mean, r, ratio, ratio0, with_views

ITEM_TOTALS = f"""
t_pricing AS (SELECT menu_item_id, max(unit_price) AS max_price, min(unit_price) AS min_price FROM d_pricing GROUP BY 1),
t_ratings AS (SELECT menu_item_id, {mean('rating_value')} AS avg_rating, count(rating_id) AS rating_count FROM d_ratings GROUP BY 1),
t_stock AS (SELECT menu_item_id, sum(consumption_quantity) AS total_consumption, sum(closing_quantity) AS total_closing FROM d_inventory GROUP BY 1),
t_wasted AS (SELECT menu_item_id, sum(quantity_wasted) AS total_wasted, sum(wastage_cost) AS total_wastage_cost FROM d_wastage GROUP BY 1),
t_totals AS (SELECT * FROM (SELECT menu_item_id FROM d_menu) LEFT JOIN t_pricing USING (menu_item_id) LEFT JOIN t_ratings USING (menu_item_id)
  LEFT JOIN t_stock USING (menu_item_id) LEFT JOIN t_wasted USING (menu_item_id))"""

ITEM = f"""{ITEM_TOTALS},
i_base AS (
  SELECT menu_item_id, count(DISTINCT order_id) AS order_frequency, count(DISTINCT customer_id) AS distinct_customers,
    count(order_item_id) AS line_count, sum(quantity) AS quantity, sum(gross) AS revenue, sum(line_cost) AS cost,
    sum(line_margin) AS margin, sum(discount_amount) AS discount,
    sum(CASE WHEN promotion_id IS NOT NULL THEN quantity ELSE 0 END) AS qty_promoted
  FROM d_sales GROUP BY 1),
i_repeat AS (SELECT menu_item_id, count(customer_id) AS repeat_customers FROM
  (SELECT menu_item_id, customer_id FROM d_sales GROUP BY ALL HAVING count(DISTINCT order_id) >= 2) GROUP BY 1),
i_month AS (SELECT menu_item_id, month(rating_timestamp) AS m, {mean('rating_value')} AS m_avg FROM d_ratings
  WHERE rating_value BETWEEN 1 AND 5 AND rating_timestamp IS NOT NULL GROUP BY ALL),
i_half AS (SELECT menu_item_id, avg(m_avg) FILTER (WHERE m <= 6) AS early_rating, avg(m_avg) FILTER (WHERE m > 6) AS recent_rating FROM i_month GROUP BY 1),
item_features AS (
  SELECT b.menu_item_id, m.item_name, m.category_id, c.category_name,
    CAST(quantity AS DOUBLE) AS quantity_sold, CAST(revenue AS DOUBLE) AS revenue, CAST(cost AS DOUBLE) AS cost,
    CAST(margin AS DOUBLE) AS contribution_margin, order_frequency, distinct_customers,
    coalesce(repeat_customers, 0) AS repeat_customers, line_count, avg_rating, rating_count,
    CAST(total_consumption AS DOUBLE) AS total_consumption, CAST(total_wasted AS DOUBLE) AS total_wasted,
    CAST(total_wastage_cost AS DOUBLE) AS total_wastage_cost, CAST(discount AS DOUBLE) AS discount_total,
    CAST(max_price AS DOUBLE) AS max_price, CAST(min_price AS DOUBLE) AS min_price, CAST(qty_promoted AS DOUBLE) AS qty_promoted,
    {ratio0('margin', 'revenue')} AS profit_pct,
    {ratio0('total_wasted', 'total_consumption')} AS wastage_pct,
    CASE WHEN revenue + discount > 0 THEN greatest(0.0, least(1.0, CAST(discount AS DOUBLE) / (CAST(revenue AS DOUBLE) + CAST(discount AS DOUBLE)))) ELSE 0.0 END AS discount_pct,
    CASE WHEN min_price > 0 THEN (CAST(max_price AS DOUBLE) - CAST(min_price AS DOUBLE)) / CAST(min_price AS DOUBLE) ELSE 0.0 END AS price_change_pct,
    {ratio0('qty_promoted', 'quantity')} AS promotion_dependency,
    {ratio0('coalesce(repeat_customers, 0)', 'distinct_customers')} AS repeat_purchase_rate,
    CAST(order_frequency AS DOUBLE) / (SELECT count(DISTINCT order_id) FROM d_sales) AS basket_inclusion_rate,
    early_rating, recent_rating, coalesce(recent_rating - early_rating, 0.0) AS rating_trend
  FROM i_base b LEFT JOIN d_menu m USING (menu_item_id) LEFT JOIN d_categories c USING (category_id)
    LEFT JOIN t_totals USING (menu_item_id) LEFT JOIN i_repeat USING (menu_item_id) LEFT JOIN i_half USING (menu_item_id))
"""

CUSTOMER = f"""
c_agg AS (SELECT customer_id, max(order_timestamp) AS last_order_ts, min(order_timestamp) AS first_order_ts,
   count(DISTINCT order_id) AS order_count, CAST(sum(line_total) AS DOUBLE) AS monetary, count(order_item_id) AS line_count,
   count(DISTINCT CASE WHEN hour(order_timestamp) BETWEEN 11 AND 21 THEN order_id END) AS peak_orders,
   count(DISTINCT CASE WHEN isodow(order_timestamp) >= 6 THEN order_id END) AS weekend_orders,
   count(DISTINCT category_id) AS distinct_categories
  FROM d_sales LEFT JOIN d_menu USING (menu_item_id) GROUP BY 1),
c_chan AS (SELECT customer_id, order_channel AS preferred_channel FROM
  (SELECT customer_id, order_channel, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, order_channel) AS rn
   FROM d_sales GROUP BY customer_id, order_channel) WHERE rn = 1),
c_all AS (SELECT customer_id, registration_date, last_order_ts, first_order_ts, coalesce(order_count, 0) AS order_count,
   coalesce(monetary, 0.0) AS monetary, coalesce(line_count, 0) AS line_count, coalesce(peak_orders, 0) AS peak_orders,
   coalesce(weekend_orders, 0) AS weekend_orders, coalesce(distinct_categories, 0) AS distinct_categories, preferred_channel,
   least(coalesce(last_order_ts, CAST(registration_date AS TIMESTAMP)), TIMESTAMP '2000-12-31 00:00:00') AS last_activity_ts
  FROM d_customers LEFT JOIN c_agg USING (customer_id) LEFT JOIN c_chan USING (customer_id)),
customer_features AS (SELECT *, CAST(date_diff('day', CAST(last_activity_ts AS DATE), DATE '2000-12-31') AS INTEGER) AS recency_days,
   {ratio0('monetary', 'order_count')} AS average_order_value, {ratio0('line_count', 'order_count')} AS avg_basket_size,
   {ratio0('peak_orders', 'order_count')} AS peak_hour_share, {ratio0('weekend_orders', 'order_count')} AS weekend_ratio FROM c_all)
"""

ORDER = """
o_feat AS (SELECT order_id, any_value(customer_id) AS customer_id, any_value(restaurant_id) AS restaurant_id,
   any_value(order_timestamp) AS order_timestamp, any_value(order_channel) AS order_channel, any_value(order_status) AS order_status,
   any_value(promotion_id) AS promotion_id, count(order_item_id) AS basket_size, CAST(sum(line_total) AS DOUBLE) AS order_total,
   count(DISTINCT menu_item_id) AS distinct_items FROM d_sales GROUP BY order_id),
order_features AS (SELECT *, hour(order_timestamp) AS hour_of_day, dayofweek(order_timestamp) + 1 AS day_of_week,
   month(order_timestamp) AS month_num, CAST(isodow(order_timestamp) >= 6 AS INTEGER) AS is_weekend,
   CAST(hour(order_timestamp) BETWEEN 11 AND 21 AS INTEGER) AS is_peak_hour FROM o_feat)
"""
ACTIVE = "d_active AS (SELECT * FROM d_sales WHERE order_status <> 'cancelled' AND order_timestamp < TIMESTAMP '2001-01-01')"
CUSTOMER_BASE = f"""{ACTIVE},
customer_base AS (SELECT *, CAST(floor((epoch(TIMESTAMP '2000-12-31') - epoch(last_order)) / 86400) AS BIGINT) AS recency,
    {r(ratio('monetary', 'frequency'), 2)} AS aov FROM (
  SELECT customer_id, max(order_timestamp) AS last_order, min(order_timestamp) AS first_order, count(DISTINCT order_id) AS frequency,
   CAST(sum(line_total) AS DOUBLE) AS monetary, count(DISTINCT menu_item_id) AS distinct_items FROM d_active WHERE customer_id IS NOT NULL GROUP BY 1))"""

SQL = {
    "feat_integrated_fact": with_views(f""", {ITEM_TOTALS}
      SELECT s.* EXCLUDE (date, gross, line_cost, line_margin), registration_date, restaurant_name, city, promotion_name, discount_type, discount_value,
        m.category_id, m.item_name, m.base_price, m.standard_cost, m.unit_of_measure, m.availability, category_name,
        max_price, min_price, avg_rating, rating_count, total_consumption, total_closing, total_wasted, total_wastage_cost
      FROM d_sales s LEFT JOIN d_customers USING (customer_id) LEFT JOIN d_restaurants USING (restaurant_id)
        LEFT JOIN d_promos p USING (promotion_id) LEFT JOIN d_menu m ON s.menu_item_id = m.menu_item_id
        LEFT JOIN d_categories c ON m.category_id = c.category_id LEFT JOIN t_totals tt ON s.menu_item_id = tt.menu_item_id"""),
    "feat_item": with_views(f", {ITEM} SELECT * FROM item_features"),
    "feat_customer": with_views(f", {CUSTOMER} SELECT * FROM customer_features"),
    "feat_order": with_views(f", {ORDER} SELECT * FROM order_features"),
    "feat_location_item": with_views("""SELECT restaurant_id, menu_item_id, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS DOUBLE) AS quantity,
      CAST(sum(line_total) AS DOUBLE) AS revenue, CAST(sum(line_margin) AS DOUBLE) AS contribution_margin FROM d_sales GROUP BY 1, 2"""),
    "feat_time": with_views("""SELECT hour(order_timestamp) AS hour_of_day, dayofweek(order_timestamp) + 1 AS day_of_week, month(order_timestamp) AS month_num,
      count(DISTINCT order_id) AS order_count, CAST(sum(line_total) AS DOUBLE) AS revenue FROM d_sales GROUP BY 1, 2, 3"""),
    "feat_customer_base": with_views(f", {CUSTOMER_BASE} SELECT * FROM customer_base"),
    "feat_item_base": with_views(f""", {ACTIVE}
      SELECT menu_item_id, CAST(sum(quantity) AS DOUBLE) AS qty_sold, CAST(sum(line_total) AS DOUBLE) AS revenue, CAST(sum(line_cost) AS DOUBLE) AS cost,
        count(DISTINCT order_id) AS orders, CAST(round(sum(line_total) - sum(line_cost), 2) AS DOUBLE) AS margin,
        {r(ratio('round(sum(line_total) - sum(line_cost), 2)', 'sum(line_total)'), 4)} AS margin_pct
      FROM d_active WHERE menu_item_id IS NOT NULL GROUP BY 1"""),
    "feat_weekly_consumption": with_views("""SELECT restaurant_id, menu_item_id,
      greatest(0, least(date_diff('day', DATE '1995-01-01', date) // 7, date_diff('day', DATE '1995-01-01', DATE '2001-08-01') // 7 - 1)) AS week,
      CAST(sum(quantity) AS DOUBLE) AS consumption FROM d_sales WHERE menu_item_id IS NOT NULL GROUP BY 1, 2, 3"""),
    "feat_order_totals": with_views("""SELECT order_id, CAST(any_value(o.total_amount) AS DOUBLE) AS total_amount,
      CAST(round(sum(quantity * unit_price), 2) AS DOUBLE) AS line_subtotal, CAST(sum(discount_amount) AS DOUBLE) AS line_discount,
      CAST(round(sum(quantity * unit_price) - sum(discount_amount), 2) AS DOUBLE) AS line_total,
      abs(any_value(o.total_amount) - round(sum(quantity * unit_price) - sum(discount_amount), 2)) <= 0.01 AS agrees
      FROM d_lines JOIN d_orders o USING (order_id) GROUP BY order_id"""),
    "feat_report": with_views("""SELECT 'item' AS feature_table, count(DISTINCT coalesce(menu_item_id, -1)) AS rows FROM d_sales
      UNION ALL SELECT 'customer', count(*) FROM d_customers
      UNION ALL SELECT 'order', count(DISTINCT order_id) FROM d_sales
      UNION ALL SELECT 'location_item', count(*) FROM (SELECT DISTINCT restaurant_id, menu_item_id FROM d_sales)
      UNION ALL SELECT 'time', count(*) FROM (SELECT DISTINCT hour(order_timestamp), dayofweek(order_timestamp), month(order_timestamp) FROM d_sales)"""),
}
