"""Order counts and revenue by calendar, restaurant and channel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalar import day_name, dbl, is_weekend



def _dimension(name: str) -> Column:
    ts = "order_timestamp"
    derived = {
        "hour": lambda: F.hour(ts),
        "dow": lambda: day_name(ts),
        "weekend": lambda: is_weekend(ts),
        "month": lambda: F.month(ts),
    }
    return derived[name]().alias(name) if name in derived else F.col(name)


def _measures() -> list[Column]:
    amount = F.coalesce(F.col("total_amount").try_cast("decimal(18,2)"), F.lit(0))
    return [F.count("order_id").alias("orders"), dbl(F.sum(amount)).alias("revenue")]


def peaks(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    """Orders and revenue per combination of hour, dow, weekend, month or any order column."""
    return orders.groupBy(*[_dimension(b) for b in by]).agg(*_measures())


def peaks_summary(orders: DataFrame) -> DataFrame:
    """Busiest hour, weekday, month and channel by orders, best restaurant by revenue; ties to the smallest.

    All five groupings come from one pass over the orders.
    """
    best = {
        "hour": ("orders", "peak_hour"),
        "dow": ("orders", "peak_day"),
        "month": ("orders", "peak_month"),
        "order_channel": ("orders", "peak_channel"),
        "restaurant_id": ("revenue", "peak_location"),
    }
    rows = orders.select("order_id", "total_amount", *[_dimension(by) for by in best])
    sums = rows.groupingSets([[F.col(by)] for by in best], *best).agg(
        *_measures(), *[F.grouping(by).alias(f"_{by}") for by in best]
    )
    picked = []
    for by, (measure, name) in best.items():
        own = (F.col(f"_{by}") == 0) & F.col(by).isNotNull()
        picked.append(F.min_by(by, F.when(own, F.struct(-F.col(measure), F.col(by)))).alias(name))
    return sums.agg(*picked)


def revenue_by_restaurant(order_features: DataFrame) -> DataFrame:
    return (
        order_features.where(F.col("order_status") == "completed")
        .groupBy("restaurant_id")
        .agg(F.count("*").alias("orders"), dbl(F.sum(F.col("order_total").cast("decimal(18,2)"))).alias("revenue"))
        .orderBy(F.desc("revenue"), "restaurant_id")
    )
