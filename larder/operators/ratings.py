"""Ratings by item, place, time and promotion, and rating anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import existence_flag, with_thresholds
from larder.functions.scalar import day_name, dbl, mean, rnd
from larder.functions.series import zscore
from larder.operators.wastage import promo_days
from larder.sources.staging import settle


def _rating_measures() -> list[Column]:
    return [
        rnd(mean("rating_value"), 2).alias("avg_rating"),
        F.count("rating_id").alias("n_ratings"),
        F.round(F.stddev_samp("rating_value"), 2).alias("std_rating"),
    ]


def ratings_by_item(ratings: DataFrame, lines: DataFrame, menu: DataFrame, high: float = 4.3, low: float = 2.5) -> DataFrame:
    """Ratings with sales and margin; a mismatch is well rated but slow, or badly rated but popular."""
    rated = ratings.where(F.col("menu_item_id").isNotNull()).groupBy("menu_item_id").agg(*_rating_measures())
    per_order = lines.where(F.col("menu_item_id").isNotNull()).groupBy("menu_item_id", "order_id").agg(
        F.sum("quantity").alias("q"),
        F.sum("line_total").alias("r"),
        F.sum(F.col("line_total") - F.col("quantity") * F.col("unit_cost")).alias("m"),
    )
    sold = per_order.groupBy("menu_item_id").agg(
        dbl(F.sum("q")).alias("qty_sold"),
        dbl(F.sum("r")).alias("revenue"),
        dbl(F.sum("m")).alias("margin"),
        F.count("*").alias("orders"),
    ).withColumn("repeat_purchase", F.greatest(F.col("orders") - 1, F.lit(0)))
    joined = rated.join(sold, "menu_item_id", "left").join(
        menu.select("menu_item_id", "item_name", "category_id"), "menu_item_id", "left"
    )
    q, avg = F.col("qty_sold"), F.col("avg_rating")
    mismatch = ((avg >= high) & (q < F.col("_mid"))) | ((avg <= low) & (q > F.col("_mid")))
    return (
        with_thresholds(settle(joined, "rated_items"), {"_mid": ("qty_sold", 0.5)})
        .withColumn("rating_sales_mismatch", F.coalesce(mismatch, F.lit(False)))
        .drop("_mid")
    )


def rating_inconsistencies(by_item: DataFrame) -> DataFrame:
    return by_item.where("rating_sales_mismatch")


def ratings_by_location(ratings: DataFrame, orders: DataFrame) -> DataFrame:
    rated = ratings.groupBy("restaurant_id").agg(*_rating_measures())
    sold = orders.groupBy("restaurant_id").agg(
        F.count("order_id").alias("n_orders"), dbl(F.sum("total_amount")).alias("total_revenue")
    )
    return rated.join(sold, "restaurant_id", "left")


def ratings_by_time(ratings: DataFrame) -> DataFrame:
    ts = "rating_timestamp"
    return (
        ratings.where(F.col(ts).isNotNull())
        .groupBy(F.month(ts).alias("month"), day_name(ts).alias("dow"))
        .agg(rnd(mean("rating_value"), 2).alias("avg_rating"), F.count("rating_id").alias("n_ratings"))
    )


def ratings_by_promo_day(ratings: DataFrame, orders: DataFrame, shift_days: int = 0) -> DataFrame:
    """Ratings on days with and without a promoted order; ``shift_days`` moves the promotion days."""
    per_day = ratings.groupBy(F.to_date("rating_timestamp").alias("date")).agg(
        F.sum("rating_value").alias("s"), F.count("rating_value").alias("c"), F.count("rating_id").alias("n")
    )
    promoted = promo_days(orders).select(F.date_add("date", shift_days).alias("date"))
    return existence_flag(per_day, promoted, ["date"], "has_promo").groupBy("has_promo").agg(
        F.round(dbl(F.sum("s")) / F.sum("c"), 2).alias("avg_rating"), F.sum("n").alias("n_ratings")
    )


def rating_anomalies(
    ratings: DataFrame,
    z: float = DEFAULTS.z_threshold,
    high: float = DEFAULTS.rating_high,
    low: float = DEFAULTS.rating_low,
    n: int = 5,
    n_identical: int = 10,
) -> DataFrame:
    """Item-days with too many, too good, too bad or identical ratings; the first match names the type."""
    daily = (
        ratings.where(F.col("menu_item_id").isNotNull() & F.col("rating_timestamp").isNotNull())
        .groupBy("menu_item_id", F.to_date("rating_timestamp").alias("date"))
        .agg(F.count("rating_id").alias("n"), mean("rating_value").alias("avg"), F.stddev_samp("rating_value").alias("daily_std"))
    )
    kind = (
        F.when(F.col("z") > z, "concentration")
        .when((F.col("n") >= n) & (F.col("avg") >= high), "spike")
        .when((F.col("n") >= n) & (F.col("avg") <= low), "drop")
        .when((F.col("n") >= n_identical) & (F.col("daily_std") == 0), "identical")
    )
    return (
        zscore(daily, ["menu_item_id"], "n")
        .withColumn("type", kind)
        .where(F.col("type").isNotNull())
        .select(
            "menu_item_id",
            "date",
            "n",
            F.round("avg", 6).alias("avg"),
            F.round("daily_std", 6).alias("daily_std"),
            F.round("mean", 6).alias("n_mean"),
            F.round("std", 6).alias("n_std"),
            F.round("z", 6).alias("z"),
            "type",
        )
    )


def rating_burst(ratings: DataFrame, n: int = 10) -> DataFrame:
    """Item-days with at least n equal ratings."""
    return (
        ratings.where(F.col("menu_item_id").isNotNull() & F.col("rating_timestamp").isNotNull() & F.col("rating_value").isNotNull())
        .groupBy("menu_item_id", F.to_date("rating_timestamp").alias("date"), "rating_value")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= n)
    )
