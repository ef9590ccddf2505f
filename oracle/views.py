"""The domain tables of larder.plans.retail as DuckDB common table expressions."""

VIEWS = """
WITH d_part AS (
  SELECT p_partkey AS l_partkey,
         CAST(25 * (list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type) - 1)
              + CAST(split_part(p_brand, '#', 2) AS BIGINT) AS BIGINT) AS item,
         CAST(list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type) AS BIGINT) AS category_id,
         p_type, p_type || ' ' || p_brand AS item_name,
         CAST(round(p_retailprice * 100) AS BIGINT) AS retail_c
  FROM part
),
d_sold0 AS (
  SELECT l_orderkey, l_partkey, l_linenumber, l_discount, l_returnflag, l_shipdate, item, retail_c,
         CAST(l_quantity AS BIGINT) AS qty,
         (2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT)) AS price_c,
         l_orderkey * 10 + l_linenumber AS line_id
  FROM lineitem JOIN d_part USING (l_partkey)
),
d_sold AS (
  SELECT *, CASE WHEN l_partkey % 503 = 0 THEN qty * price_c + 500
                 ELSE (qty * price_c * CAST(round(l_discount * 100) AS BIGINT) + 50) // 100 END AS disc_c
  FROM d_sold0
),
d_placed AS (
  SELECT o_orderkey AS l_orderkey, CAST(c_nationkey AS BIGINT) AS restaurant_id
  FROM orders JOIN customer ON o_custkey = c_custkey
),
d_categories AS (SELECT DISTINCT category_id, p_type AS category_name FROM d_part),
d_menu AS (
  SELECT menu_item_id, category_id, item_name, 'Menu item ' || item_name AS description,
         CAST(CASE WHEN menu_item_id % 47 = 0 THEN NULL WHEN menu_item_id % 53 = 0 THEN -1000
              WHEN menu_item_id % 59 = 0 THEN 9999999 ELSE c END * 0.01 AS DECIMAL(10,2)) AS base_price,
         CAST(c * 0.01 AS DECIMAL(10,2)) AS standard_cost,
         menu_item_id % 10 <> 0 AS availability,
         (['portion','plate','bowl','glass','piece'])[menu_item_id % 5 + 1] AS unit_of_measure,
         CAST(DATE '1995-01-01' + CAST(menu_item_id % 30 AS INTEGER) AS DATE) AS launch_date
  FROM (SELECT item AS menu_item_id, category_id, item_name, max(retail_c) AS c FROM d_part GROUP BY ALL)
),
d_customers AS (
  SELECT c_custkey AS customer_id, CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS registration_date
  FROM customer
),
d_restaurants AS (
  SELECT CAST(n_nationkey AS BIGINT) AS restaurant_id, n_name AS restaurant_name, r_name AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
d_orders0 AS (
  SELECT *, date_diff('day', DATE '1995-03-01', CAST(o_orderdate AS DATE)) AS since,
         CAST(round(o_totalprice * 100) AS BIGINT) AS tot_c,
         CAST(round(o_totalprice * 100) AS BIGINT) * (o_orderkey % 11) // 100 AS odisc_c
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
),
d_orders AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 331 <> 0 THEN o_custkey END AS customer_id,
         CAST(CASE WHEN o_orderkey % 499 = 0 THEN -999 ELSE c_nationkey END AS BIGINT) AS restaurant_id,
         CASE WHEN o_orderkey % 4 = 0 AND since BETWEEN 0 AND 2159 AND since % 90 <= 30
              THEN CAST(since // 90 AS BIGINT) END AS promotion_id,
         o_orderdate + to_minutes(CAST((8 + o_orderkey % 16) * 60 + (o_orderkey * 7) % 60 AS BIGINT)) AS order_timestamp,
         o_orderpriority AS order_channel,
         CASE WHEN o_orderstatus IN ('F','O') THEN 'completed' WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'pending' END AS order_status,
         CASE WHEN o_orderkey % 467 <> 0 THEN CAST((tot_c + odisc_c) * 0.01 AS DECIMAL(12,2)) END AS subtotal,
         CAST(CASE WHEN o_orderkey % 397 = 0 THEN tot_c + odisc_c + 100 ELSE odisc_c END * 0.01 AS DECIMAL(12,2)) AS discount_total,
         CAST(tot_c * 0.01 AS DECIMAL(12,2)) AS total_amount
  FROM d_orders0
),
d_lines AS (
  SELECT line_id AS order_item_id, l_orderkey AS order_id,
         CASE WHEN l_partkey % 307 <> 0 THEN item END AS menu_item_id,
         CAST(CASE WHEN l_partkey % 401 = 0 THEN -qty ELSE qty END AS DECIMAL(10,2)) AS quantity,
         CAST(price_c * 0.01 AS DECIMAL(10,2)) AS unit_price,
         CAST(2 * retail_c * 0.01 AS DECIMAL(10,2)) AS unit_cost,
         CAST(disc_c * 0.01 AS DECIMAL(12,2)) AS discount_amount,
         CAST((qty * price_c - disc_c) * 0.01 AS DECIMAL(12,2)) AS line_total
  FROM d_sold
),
d_promo_items AS (SELECT DISTINCT item % 24 AS promotion_id, item AS menu_item_id FROM d_part),
d_promos AS (
  SELECT promotion_id, 'Campaign ' || promotion_id AS promotion_name,
         CASE WHEN promotion_id % 2 = 0 THEN 'percent' ELSE 'fixed' END AS discount_type,
         CAST(5 + promotion_id % 4 AS DECIMAL(10,2)) AS discount_value, 'C' || promotion_id AS coupon_code,
         CAST(DATE '1995-03-01' + CAST(promotion_id * 90 AS INTEGER) AS DATE) AS start_date,
         CAST(DATE '1995-03-01' + CAST(promotion_id * 90 + 30 AS INTEGER) AS DATE) AS end_date
  FROM (SELECT DISTINCT promotion_id FROM d_promo_items)
),
d_ratings AS (
  SELECT event_id AS rating_id, user_id AS customer_id, CAST(props->>'k' AS BIGINT) AS menu_item_id,
         event_id % 25 AS restaurant_id, CAST(floor(value) AS INTEGER) % 7 AS rating_value,
         CASE WHEN event_id % 521 <> 0 THEN ts END AS rating_timestamp
  FROM events
),
d_wastage AS (
  SELECT line_id AS wastage_id, item AS menu_item_id, restaurant_id,
         CASE WHEN l_partkey % 461 <> 0 THEN CAST(l_shipdate AS DATE) END AS wastage_date,
         CAST(qty AS DECIMAL(12,3)) AS quantity_wasted,
         CASE WHEN l_partkey % 409 = 0 THEN 'kg' ELSE (['portion','plate','bowl','glass','piece'])[item % 5 + 1] END AS unit_of_measure,
         CAST(qty * 2 * retail_c * 0.01 AS DECIMAL(10,2)) AS wastage_cost,
         (['expired','overproduction','spoiled','returned','damaged'])[l_linenumber % 5 + 1] AS wastage_reason
  FROM d_sold JOIN d_placed USING (l_orderkey) WHERE l_returnflag = 'R'
),
d_inventory0 AS (
  SELECT item AS menu_item_id, restaurant_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS inventory_date,
         CAST(sum(qty) AS BIGINT) AS used
  FROM d_sold JOIN d_placed USING (l_orderkey) WHERE l_returnflag <> 'R' GROUP BY ALL
),
d_inventory AS (
  SELECT inventory_id, menu_item_id, restaurant_id, inventory_date,
         CAST(used * 12 * 0.1 AS DECIMAL(12,3)) AS opening_quantity,
         CAST(used * 3 * 0.1 AS DECIMAL(12,3)) AS replenishment_quantity,
         CAST(CASE WHEN inventory_id % 401 = 0 THEN -used ELSE used END AS DECIMAL(12,3)) AS consumption_quantity,
         CAST(used * 5 * 0.1 AS DECIMAL(12,3)) AS closing_quantity,
         CASE WHEN menu_item_id % 29 = 0 THEN 'kg' ELSE (['portion','plate','bowl','glass','piece'])[menu_item_id % 5 + 1] END AS unit_of_measure
  FROM (SELECT *, (menu_item_id * 100 + restaurant_id) * 100000 + year(inventory_date) * 12 + month(inventory_date) AS inventory_id
        FROM d_inventory0)
),
d_pricing AS (
  SELECT pricing_history_id, menu_item_id, make_date(y, 1, 1) AS effective_date,
         CAST(CASE WHEN pricing_history_id % 97 = 0 THEN -1000 ELSE (2 * s + n) // (2 * n) END * 0.01 AS DECIMAL(10,2)) AS unit_price
  FROM (SELECT item AS menu_item_id, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(sum(price_c) AS BIGINT) AS s, count(*) AS n,
               item * 10000 + year(l_shipdate) AS pricing_history_id
        FROM d_sold GROUP BY ALL)
),
d_sales AS (
  SELECT l.*, o.customer_id, o.restaurant_id, o.promotion_id, o.order_timestamp, o.order_channel, o.order_status,
         CAST(o.order_timestamp AS DATE) AS date,
         l.quantity * l.unit_price AS gross, l.quantity * l.unit_cost AS line_cost,
         l.line_total - l.quantity * l.unit_cost AS line_margin
  FROM d_lines l JOIN d_orders o USING (order_id)
)
"""

# view name -> table name, for queries that loop over all tables
TABLE_VIEWS = {
    "Customers": "d_customers",
    "Restaurants": "d_restaurants",
    "Menu_Categories": "d_categories",
    "Menu_Items": "d_menu",
    "Pricing_History": "d_pricing",
    "Promotions": "d_promos",
    "Promotion_Items": "d_promo_items",
    "Orders": "d_orders",
    "Order_Items": "d_lines",
    "Ratings": "d_ratings",
    "Inventory": "d_inventory",
    "Wastage": "d_wastage",
}


def with_views(sql: str) -> str:
    """Prefix a query, or extend the CTE list when it starts with a comma."""
    body = sql.strip()
    return VIEWS + body if body.startswith(",") else VIEWS + "\n" + body


def r(expr: str, digits: int) -> str:
    """Half-up rounding of a double's shortest decimal form, like the DataFrame side."""
    return f"CAST(round(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def mean(col: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE) / nullif(count({col}), 0)"


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)"


def ratio0(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0 END"
