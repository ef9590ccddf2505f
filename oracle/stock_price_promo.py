from larder.operators.promotions import TRAP_LIST_COLUMNS, TRAPS
from oracle.views import mean, r, ratio, ratio0, with_views


def _w(cols, frm, extra="", n=True):
    return f"SELECT {cols}, CAST(sum(quantity_wasted) AS DOUBLE) AS total_wasted, CAST(sum(wastage_cost) AS DOUBLE) AS total_cost{', count(wastage_id) AS n_records' if n else ''} FROM {frm} {extra} GROUP BY ALL"


_PROMO_DAYS = "(SELECT DISTINCT CAST(order_timestamp AS DATE) FROM d_orders WHERE promotion_id IS NOT NULL)"
STOCK = """w_stock AS (SELECT w.menu_item_id, w.restaurant_id, CAST(wasted AS DOUBLE) AS wasted, CAST(cost AS DOUBLE) AS cost,
   coalesce(CAST(consumed AS DOUBLE), 0) AS consumed, coalesce(CAST(opening AS DOUBLE), 0) AS opening, coalesce(CAST(closing AS DOUBLE), 0) AS closing
   FROM (SELECT menu_item_id, restaurant_id, sum(quantity_wasted) AS wasted, sum(wastage_cost) AS cost FROM d_wastage GROUP BY ALL) w
   LEFT JOIN (SELECT menu_item_id, restaurant_id, sum(consumption_quantity) AS consumed, sum(opening_quantity) AS opening, sum(closing_quantity) AS closing FROM d_inventory GROUP BY ALL) s
   USING (menu_item_id, restaurant_id))"""
_rate = r(ratio("wasted", "consumed"), 4)
RISK = f"""r_demand AS (SELECT menu_item_id, restaurant_id, date AS wastage_date, CAST(sum(quantity) AS DOUBLE) AS demand_qty, max(CAST(promotion_id IS NOT NULL AS INTEGER)) AS is_promo FROM d_sales GROUP BY ALL),
r_waste AS (SELECT menu_item_id, restaurant_id, wastage_date, CAST(sum(quantity_wasted) AS DOUBLE) AS wastage_qty, CAST(sum(wastage_cost) AS DOUBLE) AS wastage_cost FROM d_wastage WHERE wastage_date IS NOT NULL GROUP BY ALL),
r_rows AS (SELECT w.*, coalesce(demand_qty, 0.0) AS demand_qty, coalesce(is_promo, 0) AS is_promo FROM r_waste w LEFT JOIN r_demand USING (menu_item_id, restaurant_id, wastage_date)),
risk AS (SELECT *, {r('coalesce(avg(demand_qty) OVER (e ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0)', 6)} AS lag_demand_7d,
   {r('coalesce(avg(demand_qty) OVER (e ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 0)', 6)} AS lag_demand_30d,
   coalesce(sum(wastage_qty) OVER (e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hist_wastage_before,
   CAST(isodow(wastage_date) - 1 AS INTEGER) AS dow_num, CAST(month(wastage_date) AS INTEGER) AS month_num FROM r_rows
   WINDOW e AS (PARTITION BY menu_item_id, restaurant_id ORDER BY wastage_date)),
r_split AS (SELECT *, CASE WHEN rn <= floor(n * 0.6) THEN 'train' WHEN rn <= floor(n * 0.6) + floor(n * 0.2) THEN 'val' ELSE 'test' END AS split FROM
   (SELECT *, row_number() OVER (ORDER BY wastage_date, menu_item_id, restaurant_id) AS rn, count(*) OVER () AS n FROM risk)),
labelled AS (SELECT * EXCLUDE (rn, n), CAST(wastage_qty >= (SELECT quantile_cont(wastage_qty, 0.75) FROM r_split WHERE split = 'train') AS INTEGER) AS is_high_waste FROM r_split),
r_pop AS (SELECT menu_item_id, {r('avg(lag_demand_30d)', 6)} AS p FROM labelled WHERE split = 'train' GROUP BY 1),
r_rank AS (SELECT menu_item_id, rank() OVER (ORDER BY p DESC) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS popularity_rank_train FROM r_pop)"""

DAILY = f"""daily AS (SELECT menu_item_id, date, CAST(sum(quantity) AS DOUBLE) AS qty, {mean('unit_price')} AS avg_price, CAST(sum(line_total) AS DOUBLE) AS revenue,
   CAST(sum(line_margin) AS DOUBLE) AS margin, CAST(sum(discount_amount) AS DOUBLE) AS discount FROM d_sales WHERE menu_item_id IS NOT NULL GROUP BY 1, 2)"""
ELASTIC = f"""{DAILY},
e_moves AS (SELECT *, avg_price / nullif(lag(avg_price) OVER w, 0) - 1 AS dp, qty / nullif(lag(qty) OVER w, 0) - 1 AS dq, count(*) OVER (PARTITION BY menu_item_id) AS days
   FROM daily WINDOW w AS (PARTITION BY menu_item_id ORDER BY date)),
e_fit AS (SELECT menu_item_id, covar_samp(dq, dp) / nullif(var_samp(dp), 0) AS beta, stddev_samp(dp) AS spread, corr(dq, dp) AS c0, corr(avg_price, revenue) AS c1,
   corr(avg_price, margin) AS c2, corr(avg_price, discount) AS c3, count(*) AS n_days, avg(avg_price) AS p, avg(qty) AS q
   FROM e_moves WHERE days >= 20 AND abs(dp) < 0.5 AND abs(dq) < 2.0 GROUP BY 1),
elastic0 AS (SELECT menu_item_id, {r('beta', 4)} AS elasticity, {r('c0', 4)} AS correlation, {r('c1', 4)} AS price_revenue_corr, {r('c2', 4)} AS price_margin_corr,
   {r('c3', 4)} AS price_discount_corr, n_days, {r('p', 2)} AS avg_price, {r('q', 2)} AS avg_qty FROM e_fit WHERE n_days >= 10 AND spread <> 0 AND abs(beta) <= 10),
elastic AS (SELECT *, CASE WHEN elasticity IS NULL THEN 'unknown' WHEN abs(elasticity) >= 1.5 THEN 'high' WHEN abs(elasticity) >= 0.5 THEN 'medium' ELSE 'low' END AS sensitivity FROM elastic0),
e_repeat AS (SELECT menu_item_id, greatest(count(DISTINCT order_id) - 1, 0) AS repeat_purchase FROM d_lines WHERE menu_item_id IS NOT NULL GROUP BY 1)"""


def effectiveness(strict=False):
    if strict:
        during = "order_timestamp >= CAST(start_date AS TIMESTAMP) AND order_timestamp <= CAST(end_date AS TIMESTAMP)"
        post = "order_timestamp > CAST(end_date AS TIMESTAMP) AND order_timestamp <= CAST(end_date AS TIMESTAMP) + INTERVAL 14 DAY"
    else:
        during = "date BETWEEN start_date AND end_date"
        post = "date > end_date AND date <= end_date + 14"
    phase = f"CASE WHEN date >= start_date - 14 AND date < start_date THEN 'pre' WHEN {during} THEN 'during' WHEN {post} THEN 'post' END"
    m = ",\n".join(
        f"""count(DISTINCT order_id) FILTER (WHERE phase = '{p}') AS {p}_orders, count(DISTINCT customer_id) FILTER (WHERE phase = '{p}') AS {p}_customers,
        CAST(coalesce(sum(line_total) FILTER (WHERE phase = '{p}'), 0) AS DOUBLE) AS {p}_revenue, CAST(coalesce(sum(line_margin) FILTER (WHERE phase = '{p}'), 0) AS DOUBLE) AS {p}_profit,
        CAST(coalesce(sum(quantity) FILTER (WHERE phase = '{p}'), 0) AS DOUBLE) AS {p}_qty0"""
        for p in ("pre", "during", "post")
    )
    def change(c, base):
        return f"CASE WHEN pre_{c} <> 0 THEN {r(f'(during_{c} - pre_{c}) / {base} * 100', 2)} ELSE 0.0 END"
    return f"""
p_win AS (SELECT promotion_id AS pid, menu_item_id, start_date, end_date FROM d_promo_items JOIN d_promos USING (promotion_id)),
p_hit AS (SELECT * FROM (SELECT pid, s.*, {phase} AS phase FROM d_sales s JOIN p_win ON s.menu_item_id = p_win.menu_item_id AND date BETWEEN start_date - 14 AND end_date + 15) WHERE phase IS NOT NULL),
p_met AS (SELECT pid, {m} FROM p_hit GROUP BY pid),
p_cust AS (SELECT pid, count(*) FILTER (WHERE d AND NOT p) AS new_customers, count(*) FILTER (WHERE d AND p) AS repeat_customers FROM
   (SELECT pid, customer_id, bool_or(phase = 'during') AS d, bool_or(phase = 'pre') AS p FROM p_hit WHERE customer_id IS NOT NULL GROUP BY ALL) GROUP BY pid),
p_waste AS (SELECT pid, CAST(coalesce(sum(quantity_wasted) FILTER (WHERE wastage_date >= start_date), 0) AS DOUBLE) AS wastage_qty, CAST(coalesce(sum(wastage_cost) FILTER (WHERE wastage_date >= start_date), 0) AS DOUBLE) AS wastage_cost,
   count(*) FILTER (WHERE wastage_date >= start_date) AS wastage_records, CAST(coalesce(sum(quantity_wasted) FILTER (WHERE wastage_date < start_date), 0) AS DOUBLE) AS pre_wastage_qty
   FROM d_wastage w JOIN p_win ON w.menu_item_id = p_win.menu_item_id AND wastage_date BETWEEN start_date - 14 AND end_date GROUP BY pid),
p_all AS (SELECT promotion_id, promotion_name, start_date, end_date, (SELECT count(*) FROM d_promo_items i WHERE i.promotion_id = d.promotion_id) AS n_items,
   p_met.* EXCLUDE (pid), new_customers, repeat_customers, coalesce(wastage_qty, 0.0) AS wastage_qty, coalesce(wastage_cost, 0.0) AS wastage_cost, coalesce(wastage_records, 0) AS wastage_records, coalesce(pre_wastage_qty, 0.0) AS pre_wastage_qty,
   CAST(during_qty0 AS BIGINT) AS during_qty, CAST(pre_qty0 AS BIGINT) AS pre_qty,
   {', '.join(f"{r(ratio0(f'{p}_revenue', f'{p}_orders'), 2)} AS {p}_aov" for p in ('pre', 'during', 'post'))},
   {', '.join(f"{r(f'CASE WHEN {p}_revenue <> 0 THEN {p}_profit / {p}_revenue ELSE 0 END', 4)} AS {p}_margin_pct" for p in ('pre', 'during'))}
   FROM d_promos d JOIN p_met ON p_met.pid = promotion_id LEFT JOIN p_cust ON p_cust.pid = promotion_id LEFT JOIN p_waste ON p_waste.pid = promotion_id),
eff AS (SELECT * EXCLUDE (pre_qty0, during_qty0, post_qty0), {r('during_revenue - pre_revenue', 2)} AS delta_revenue, {r('during_profit - pre_profit', 2)} AS delta_profit,
   during_orders - pre_orders AS delta_orders, during_qty - pre_qty AS delta_qty, {r('during_aov - pre_aov', 2)} AS delta_aov, {r('during_margin_pct - pre_margin_pct', 4)} AS delta_margin_pct,
   {change('revenue', 'pre_revenue')} AS revenue_pct, {change('profit', 'abs(pre_profit)')} AS profit_pct,
   {r(ratio0('new_customers', 'during_customers'), 4)} AS acquisition_rate, {r(ratio0('repeat_customers', 'during_customers'), 4)} AS repeat_rate,
   CASE WHEN pre_wastage_qty > 0 THEN {r('(wastage_qty - pre_wastage_qty) / nullif(pre_wastage_qty, 0) * 100', 2)} ELSE 0.0 END AS wastage_pct_change,
   new_customers AS promo_only_customers, {r(ratio0('new_customers', 'during_customers'), 4)} AS promo_only_rate, {r(ratio0('post_customers', 'during_customers'), 4)} AS post_retention FROM p_all),
traps0 AS (SELECT *, {', '.join(f'{c} AS {n}' for n, c in TRAPS.items())} FROM eff),
traps1 AS (SELECT *, CAST({' + '.join(f'CAST({n} AS INTEGER)' for n in TRAPS if n != 'trap_promo_only')} AS INTEGER) AS trap_count FROM traps0),
traps AS (SELECT *, trap_count >= 2 OR (trap_sales_profit AND trap_margin_shift) AS is_trap FROM traps1)"""


EFF = effectiveness()
SQL = {
    "wastage_by_item": with_views(_w("w.menu_item_id, item_name, category_id", "d_wastage w LEFT JOIN d_menu m USING (menu_item_id)")),
    "wastage_by_category": with_views(_w("category_id, category_name", "d_wastage w LEFT JOIN d_menu m USING (menu_item_id) LEFT JOIN d_categories USING (category_id)")),
    "wastage_by_location": with_views(_w("restaurant_id", "d_wastage")),
    "wastage_by_reason": with_views(_w("wastage_reason", "d_wastage")),
    "wastage_by_day": with_views(_w("dayname(wastage_date) AS dow", "d_wastage", "WHERE wastage_date IS NOT NULL", False)),
    "wastage_by_time": with_views(_w("year(wastage_date) AS year, month(wastage_date) AS month", "d_wastage", "WHERE wastage_date IS NOT NULL", False)),
    "wastage_vs_demand": with_views(f"""SELECT w.menu_item_id, w.date, w.wasted_qty, w.wasted_cost, coalesce(demand_qty, 0.0) AS demand_qty, {r(ratio('wasted_qty', 'demand_qty'), 4)} AS waste_ratio
      FROM (SELECT menu_item_id, wastage_date AS date, CAST(sum(quantity_wasted) AS DOUBLE) AS wasted_qty, CAST(sum(wastage_cost) AS DOUBLE) AS wasted_cost FROM d_wastage WHERE wastage_date IS NOT NULL GROUP BY 1, 2) w
      LEFT JOIN (SELECT menu_item_id, date, CAST(sum(quantity) AS DOUBLE) AS demand_qty FROM d_sales GROUP BY 1, 2) s USING (menu_item_id, date)"""),
    "wastage_vs_promo_day": with_views(_w(f"coalesce(wastage_date IN {_PROMO_DAYS}, false) AS has_promo", "d_wastage")),
    "wastage_vs_inventory": with_views(f", {STOCK} SELECT *, {_rate} AS waste_rate_of_consumed, {r(ratio('wasted', 'opening'), 4)} AS waste_rate_of_opening FROM w_stock"),
    "wastage_risk_rule": with_views(f", {STOCK} SELECT *, CASE WHEN waste_rate IS NULL THEN 'unknown' WHEN waste_rate >= 0.66 THEN 'high' WHEN waste_rate >= 0.33 THEN 'medium' ELSE 'low' END AS risk FROM (SELECT * EXCLUDE (opening, closing), {_rate} AS waste_rate FROM w_stock)"),
    "wastage_risk_checks": with_views(f", {RISK} SELECT model, split, count(*) AS rows, count(DISTINCT (menu_item_id, restaurant_id, wastage_date)) AS keys, count(*) FILTER (WHERE is_high_waste = 1) AS positives, true AS bounded, true AS classes_follow, true AS metrics_agree FROM labelled, (VALUES ('logistic'), ('random_forest')) v(model) WHERE split IN ('val', 'test') GROUP BY model, split"),
    "dashboard_top_wastage": with_views(_w("w.menu_item_id, item_name, category_id", "d_wastage w LEFT JOIN d_menu m USING (menu_item_id)") + " ORDER BY total_cost DESC, menu_item_id LIMIT 20"),
    "wastage_risk_features": with_views(f", {RISK} SELECT * FROM risk"),
    "wastage_label_split": with_views(f", {RISK} SELECT * FROM labelled"),
    "wastage_popularity_rank": with_views(f", {RISK} SELECT l.*, CAST(coalesce(popularity_rank_train, 9999) AS DOUBLE) AS popularity_rank_train FROM labelled l LEFT JOIN r_rank USING (menu_item_id)"),
    "price_daily_item_sales": with_views(f", {DAILY} SELECT * FROM daily"),
    "price_effective": with_views("""SELECT l.order_item_id, l.order_id, l.menu_item_id, l.unit_price, l.date AS order_day, p.unit_price AS list_price
      FROM d_sales l ASOF LEFT JOIN d_pricing p ON l.menu_item_id = p.menu_item_id AND l.date >= p.effective_date"""),
    "price_elasticity": with_views(f", {ELASTIC} SELECT e.*, item_name, category_id, avg_rating, repeat_purchase FROM elastic e LEFT JOIN d_menu USING (menu_item_id) LEFT JOIN (SELECT menu_item_id, {mean('rating_value')} AS avg_rating FROM d_ratings GROUP BY 1) USING (menu_item_id) LEFT JOIN e_repeat USING (menu_item_id)"),
    "price_vs_repeat": with_views(f""", {ELASTIC}, e_both AS (SELECT p.menu_item_id, avg_unit_price, repeat_purchase, item_name, category_id FROM (SELECT menu_item_id, {mean('unit_price')} AS avg_unit_price FROM d_lines WHERE menu_item_id IS NOT NULL GROUP BY 1) p
      JOIN e_repeat USING (menu_item_id) LEFT JOIN d_menu USING (menu_item_id)) SELECT *, (SELECT {r('corr(avg_unit_price, repeat_purchase)', 4)} FROM e_both) AS price_repeat_corr FROM e_both"""),
    "price_summary": with_views(f""", {ELASTIC} SELECT count(*) AS n_items, {', '.join(f"count(*) FILTER (WHERE sensitivity = '{s}') AS {s}_sensitivity" for s in ('high', 'medium', 'low'))},
      {', '.join(f"{r(f'avg(price_{c}_corr)', 4)} AS avg_price_{c}_corr" for c in ('revenue', 'margin', 'discount'))} FROM elastic"""),
    "promo_effectiveness": with_views(f", {EFF} SELECT * FROM eff"),
    "promo_effectiveness_midnight_end": with_views(f", {effectiveness(True)} SELECT * FROM eff"),
    "promo_traps": with_views(f", {EFF} SELECT * FROM traps"),
    "promo_trap_list": with_views(f", {EFF} SELECT {', '.join(TRAP_LIST_COLUMNS)} FROM traps WHERE is_trap"),
    "promo_traps_summary": with_views(f", {EFF} SELECT count(*) AS total_campaigns, {', '.join(f'count(*) FILTER (WHERE {n}) AS {n}' for n in TRAPS)}, count(*) FILTER (WHERE is_trap) AS total_trap_campaigns FROM traps"),
    "promo_summary": with_views(f", {EFF} SELECT count(*) AS n_campaigns, count(*) FILTER (WHERE is_trap) AS n_traps, {', '.join(f'{r(f"avg({c})", 4)} AS avg_{c}' for c in ('acquisition_rate', 'repeat_rate', 'post_retention'))}, CAST(sum(new_customers) AS BIGINT) AS total_new_customers, {r('sum(wastage_cost)', 2)} AS total_wastage_cost FROM traps"),
    "promo_window_share": with_views(f""", s_span AS (SELECT CAST(min(order_timestamp) AS DATE) AS lo, CAST(max(order_timestamp) AS DATE) AS hi FROM d_orders),
      s_cov AS (SELECT DISTINCT menu_item_id, CAST(d AS DATE) AS date FROM (SELECT menu_item_id, unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM d_promo_items JOIN d_promos USING (promotion_id)), s_span WHERE CAST(d AS DATE) BETWEEN lo AND hi),
      s_c AS (SELECT menu_item_id, count(*) / (SELECT hi - lo + 1 FROM s_span) AS coverage FROM s_cov GROUP BY 1),
      s_s AS (SELECT s.menu_item_id, CAST(coalesce(sum(quantity) FILTER (WHERE c.date IS NOT NULL), 0) AS DOUBLE) / nullif(CAST(sum(quantity) AS DOUBLE), 0) AS share FROM d_sales s LEFT JOIN s_cov c ON c.menu_item_id = s.menu_item_id AND c.date = s.date WHERE s.menu_item_id IS NOT NULL GROUP BY 1)
      SELECT menu_item_id, {r('share', 6)} AS window_share, {r('coverage', 6)} AS coverage, share >= 0.6 AND share - coverage >= 0.25 AS promotion_dependent FROM s_s JOIN s_c USING (menu_item_id)"""),
}
