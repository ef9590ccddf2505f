"""Least squares per item by successive residuals, one elimination order per reported coefficient."""

from oracle.stock_price_promo import _PROMO_DAYS, DAILY
from oracle.views import r, with_views

P = "OVER (PARTITION BY menu_item_id)"


def _eliminate(tag: str, order: list[str]) -> str:
    """Coefficient of the last variable after the others have been taken out."""
    ctes = [f"{tag}0 AS (SELECT menu_item_id, {', '.join(f'{v} - avg({v}) {P} AS {v}' for v in [*order, 'y'])}, y - avg(y) {P} AS y_all FROM x_rows)"]
    for i, u in enumerate(order[:-1]):
        rest = [*order[i + 1 :], "y"]
        out = ", ".join(f"{v} - CASE WHEN sum({u} * {u}) {P} > 1e-9 THEN sum({v} * {u}) {P} / sum({u} * {u}) {P} ELSE 0 END * {u} AS {v}" for v in rest)
        ctes.append(f"{tag}{i + 1} AS (SELECT menu_item_id, {out}, y_all FROM {tag}{i})")
    last, end = order[-1], len(order) - 1
    ctes.append(f"{tag}_b AS (SELECT *, CASE WHEN sum({last} * {last}) {P} > 1e-9 THEN sum(y * {last}) {P} / sum({last} * {last}) {P} ELSE 0 END AS b FROM {tag}{end})")
    ctes.append(f"{tag}_out AS (SELECT menu_item_id, max(b) AS coef, 1 - sum((y - b * {last}) * (y - b * {last})) / sum(y_all * y_all) AS fit, count(*) AS n_days FROM {tag}_b GROUP BY 1)")
    return ",\n".join(ctes)


SQL = {
    "price_multivariate_elasticity": with_views(f""", {DAILY},
      x_all AS (SELECT menu_item_id, ln(qty) AS y, ln(avg_price) AS lp, CAST(date IN {_PROMO_DAYS} AS DOUBLE) AS promo, CAST(isodow(date) >= 6 AS DOUBLE) AS wk, CAST(month(date) AS DOUBLE) AS mo
        FROM daily WHERE qty > 0 AND avg_price > 0),
      x_rows AS (SELECT * FROM x_all QUALIFY count(*) OVER (PARTITION BY menu_item_id) >= 30),
      {_eliminate('ep', ['promo', 'wk', 'mo', 'lp'])}, {_eliminate('eh', ['lp', 'wk', 'mo', 'promo'])}, {_eliminate('ew', ['lp', 'promo', 'mo', 'wk'])}
      SELECT *, CASE WHEN multivariate_elasticity >= -0.5 THEN 'inelastic' WHEN multivariate_elasticity >= -1.5 THEN 'moderately_elastic' ELSE 'elastic' END AS mv_class FROM
      (SELECT menu_item_id, {r('ep_out.coef', 4)} AS multivariate_elasticity, {r('ep_out.fit', 4)} AS model_r2, ep_out.n_days, {r('eh_out.coef', 4)} AS has_promo_coef, {r('ew_out.coef', 4)} AS weekend_coef
       FROM ep_out JOIN eh_out USING (menu_item_id) JOIN ew_out USING (menu_item_id))"""),
}
