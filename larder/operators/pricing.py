"""Price response of items: day-over-day elasticity, regression with controls, repeat purchases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.relational import asof_join, existence_flag, with_scalars
from larder.functions.scalar import dbl, is_weekend, mean, tier
from larder.operators.features import sales
from larder.operators.wastage import promo_days


def daily_item_sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    s = sales(orders, lines).where(F.col("menu_item_id").isNotNull())
    return s.groupBy("menu_item_id", "date").agg(
        dbl(F.sum("quantity")).alias("qty"),
        mean("unit_price").alias("avg_price"),
        dbl(F.sum("line_total")).alias("revenue"),
        dbl(F.sum("line_margin")).alias("margin"),
        dbl(F.sum("discount_amount")).alias("discount"),
    )


def effective_price(lines: DataFrame, orders: DataFrame, pricing: DataFrame) -> DataFrame:
    """List price in force on the order day for every line."""
    dated = lines.select("order_item_id", "order_id", "menu_item_id", "unit_price").join(
        orders.select("order_id", F.to_date("order_timestamp").alias("order_day")), "order_id"
    )
    history = pricing.select("menu_item_id", "effective_date", F.col("unit_price").alias("list_price"))
    return asof_join(dated, history, ["menu_item_id"], "order_day", "effective_date", ["list_price"])


def price_elasticity(
    daily: DataFrame, min_days: int = 20, max_dp: float = 0.5, max_dq: float = 2.0, max_beta: float = 10.0, min_pairs: int = 10
) -> DataFrame:
    """Slope of relative quantity changes on relative price changes between an item's sale days."""
    w = Window.partitionBy("menu_item_id").orderBy("date")

    def change(c: str):
        before = F.lag(c).over(w)
        return F.col(c) / F.nullif(before, F.lit(0.0)) - 1

    moves = (
        daily.withColumns(
            {
                "dp": change("avg_price"),
                "dq": change("qty"),
                "days": F.count("*").over(Window.partitionBy("menu_item_id")),
            }
        )
        .where(F.col("days") >= min_days)
        .where((F.abs("dp") < max_dp) & (F.abs("dq") < max_dq))
    )
    fitted = moves.groupBy("menu_item_id").agg(
        (F.covar_samp("dq", "dp") / F.nullif(F.var_samp("dp"), F.lit(0.0))).alias("beta"),
        F.stddev_samp("dp").alias("spread"),
        F.corr("dq", "dp").alias("c0"),
        F.corr("avg_price", "revenue").alias("c1"),
        F.corr("avg_price", "margin").alias("c2"),
        F.corr("avg_price", "discount").alias("c3"),
        F.count("*").alias("n_days"),
        F.avg("avg_price").alias("p"),
        F.avg("qty").alias("q"),
    )
    kept = fitted.where((F.col("n_days") >= min_pairs) & (F.col("spread") != 0) & (F.abs("beta") <= max_beta))
    return kept.select(
        "menu_item_id",
        F.round("beta", 4).alias("elasticity"),
        F.round("c0", 4).alias("correlation"),
        F.round("c1", 4).alias("price_revenue_corr"),
        F.round("c2", 4).alias("price_margin_corr"),
        F.round("c3", 4).alias("price_discount_corr"),
        "n_days",
        F.round("p", 2).alias("avg_price"),
        F.round("q", 2).alias("avg_qty"),
    ).withColumn("sensitivity", tier(F.abs("elasticity"), [(1.5, "high"), (0.5, "medium")], "low", "unknown"))


def repeat_purchase(lines: DataFrame) -> DataFrame:
    return (
        lines.where(F.col("menu_item_id").isNotNull())
        .groupBy("menu_item_id")
        .agg(F.countDistinct("order_id").alias("_o"))
        .select("menu_item_id", F.greatest(F.col("_o") - 1, F.lit(0)).alias("repeat_purchase"))
    )


def enrich_items(df: DataFrame, menu: DataFrame, ratings: DataFrame, lines: DataFrame) -> DataFrame:
    """Add item name, category, mean rating and repeat purchases."""
    rated = ratings.groupBy("menu_item_id").agg(mean("rating_value").alias("avg_rating"))
    return (
        df.join(menu.select("menu_item_id", "item_name", "category_id"), "menu_item_id", "left")
        .join(rated, "menu_item_id", "left")
        .join(repeat_purchase(lines), "menu_item_id", "left")
    )


CONTROLS = ("log_price", "has_promo", "weekend", "month")


def multivariate_elasticity(daily: DataFrame, orders: DataFrame, min_days: int = 30) -> DataFrame:
    """Least squares of log quantity on log price, promotion day, weekend and month per item.

    Spark reduces each item to one row of covariances; only these rows are solved in Python,
    with the pseudo-inverse where a control never changes.
    """
    rows = daily.where((F.col("qty") > 0) & (F.col("avg_price") > 0))
    rows = existence_flag(rows, promo_days(orders), ["date"], "_promo").select(
        "menu_item_id",
        F.ln("qty").alias("log_qty"),
        F.ln("avg_price").alias("log_price"),
        dbl(F.col("_promo").cast("int")).alias("has_promo"),
        dbl(is_weekend("date").cast("int")).alias("weekend"),
        dbl(F.month("date")).alias("month"),
    )
    k = len(CONTROLS)
    xx = F.array(*[F.covar_pop(a, b) for a in CONTROLS for b in CONTROLS])
    xy = F.array(*[F.covar_pop(a, "log_qty") for a in CONTROLS])
    moments = (
        rows.groupBy("menu_item_id")
        .agg(xx.alias("xx"), xy.alias("xy"), F.var_pop("log_qty").alias("yy"), F.count("*").alias("n_days"))
        .where(F.col("n_days") >= min_days)
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            a = np.stack(pdf["xx"].to_numpy()).reshape(-1, k, k)
            b = np.stack(pdf["xy"].to_numpy())
            coef = np.einsum("nij,nj->ni", np.linalg.pinv(a, rcond=1e-10, hermitian=True), b)
            explained = np.einsum("ni,ni->n", coef, b)
            total = pdf["yy"].to_numpy()
            fit = np.where(total > 0, explained / np.where(total > 0, total, 1.0), 1.0)
            yield pd.DataFrame(
                {
                    "menu_item_id": pdf["menu_item_id"],
                    "multivariate_elasticity": coef[:, 0].round(4),
                    "model_r2": fit.round(4),
                    "n_days": pdf["n_days"],
                    "has_promo_coef": coef[:, 1].round(4),
                    "weekend_coef": coef[:, 2].round(4),
                }
            )

    solved = moments.mapInPandas(
        solve,
        "menu_item_id bigint, multivariate_elasticity double, model_r2 double, n_days bigint, "
        "has_promo_coef double, weekend_coef double",
    )
    return solved.withColumn(
        "mv_class",
        tier("multivariate_elasticity", [(-0.5, "inelastic"), (-1.5, "moderately_elastic")], "elastic", "insufficient_evidence"),
    )


def price_vs_repeat(lines: DataFrame, menu: DataFrame) -> DataFrame:
    """Mean unit price and repeat purchases per item with their correlation over all items."""
    priced = lines.where(F.col("menu_item_id").isNotNull()).groupBy("menu_item_id").agg(
        mean("unit_price").alias("avg_unit_price")
    )
    both = priced.join(repeat_purchase(lines), "menu_item_id").join(
        menu.select("menu_item_id", "item_name", "category_id"), "menu_item_id", "left"
    )
    return with_scalars(
        both, both.agg(F.round(F.corr("avg_unit_price", dbl("repeat_purchase")), 4).alias("price_repeat_corr"))
    )


def price_summary(elasticity: DataFrame) -> DataFrame:
    return elasticity.agg(
        F.count("*").alias("n_items"),
        *[F.count_if(F.col("sensitivity") == s).alias(f"{s}_sensitivity") for s in ("high", "medium", "low")],
        *[
            F.round(F.avg(f"price_{c}_corr"), 4).alias(f"avg_price_{c}_corr")
            for c in ("revenue", "margin", "discount")
        ],
    )
