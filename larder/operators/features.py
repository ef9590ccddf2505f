"""Integrated sales fact and the feature tables built from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import spread_left_join, with_scalars
from larder.functions.scalar import (
    clamp,
    dbl,
    elapsed_days,
    is_peak_hour,
    is_weekend,
    mean,
    ratio,
    ratio_or_zero,
    rnd,
)

Tables = Mapping[str, DataFrame]


def sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order lines with their header and the line amounts. The one large join of most operators."""
    header = orders.select(
        "order_id", "customer_id", "restaurant_id", "promotion_id", "order_timestamp", "order_channel", "order_status"
    )
    q = F.col("quantity")
    return lines.join(header, "order_id").withColumns(
        {
            "date": F.to_date("order_timestamp"),
            "gross": q * F.col("unit_price"),
            "line_cost": q * F.col("unit_cost"),
            "line_margin": F.col("line_total") - q * F.col("unit_cost"),
        }
    )


def dealt_by_order(lines: DataFrame) -> DataFrame:
    """Lines over four times the shuffle partitions, by order.

    Sums per order and item hardly shrink the lines, so a task holds its share of them in several hash maps. A number
    that is given isn't coalesced to the few large partitions that rows of a join may do with.
    """
    return lines.repartition(4 * int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "order_id")


def item_totals(t: Tables) -> DataFrame:
    """Price range, ratings, stock and wastage per item, each aggregated before any join."""
    pricing = t["Pricing_History"].groupBy("menu_item_id").agg(
        F.max("unit_price").alias("max_price"), F.min("unit_price").alias("min_price")
    )
    ratings = t["Ratings"].groupBy("menu_item_id").agg(
        mean("rating_value").alias("avg_rating"), F.count("rating_id").alias("rating_count")
    )
    stock = t["Inventory"].groupBy("menu_item_id").agg(
        F.sum("consumption_quantity").alias("total_consumption"), F.sum("closing_quantity").alias("total_closing")
    )
    wasted = t["Wastage"].groupBy("menu_item_id").agg(
        F.sum("quantity_wasted").alias("total_wasted"), F.sum("wastage_cost").alias("total_wastage_cost")
    )
    out = t["Menu_Items"].select("menu_item_id")
    for part in (pricing, ratings, stock, wasted):
        out = out.join(part, "menu_item_id", "left")
    return out


def integrated_fact(t: Tables) -> DataFrame:
    """One row per sold line with customer, restaurant, promotion, item, category and item totals."""
    menu = t["Menu_Items"].select(
        "menu_item_id", "category_id", "item_name", "base_price", "standard_cost", "unit_of_measure", "availability"
    )
    fact = sales(t["Orders"], t["Order_Items"]).drop("date", "gross", "line_cost", "line_margin")
    fact = spread_left_join(fact, t["Customers"], "customer_id", "order_item_id")
    fact = fact.join(t["Restaurants"], "restaurant_id", "left")
    promotions = t["Promotions"].select("promotion_id", "promotion_name", "discount_type", "discount_value")
    fact = spread_left_join(fact, promotions, "promotion_id", "order_item_id")
    items = menu.join(t["Menu_Categories"], "category_id", "left").join(item_totals(t), "menu_item_id", "left")
    return spread_left_join(fact, items, "menu_item_id", "order_item_id")


def item_features(t: Tables, split_month: int = 6) -> DataFrame:
    """Sales, margin, loyalty, wastage, price and rating features per sold item.

    Lines are reduced to (item, order), then (item, customer), then item, so distinct
    orders, distinct customers and repeat customers come from one chain of partial sums.
    """
    s = sales(t["Orders"], dealt_by_order(t["Order_Items"]))
    amounts = ["quantity", "gross", "line_cost", "line_margin", "discount_amount"]
    promoted = F.sum(F.when(F.col("promotion_id").isNotNull(), F.col("quantity")).otherwise(0)).alias("qty_promoted")
    per_order = s.groupBy("menu_item_id", "order_id", "customer_id").agg(
        *[F.sum(c).alias(c) for c in amounts], promoted, F.count("order_item_id").alias("line_count")
    )
    summed = [*amounts, "qty_promoted", "line_count"]
    per_customer = per_order.groupBy("menu_item_id", "customer_id").agg(
        F.count("*").alias("orders"), *[F.sum(c).alias(c) for c in summed]
    )
    base = per_customer.groupBy("menu_item_id").agg(
        F.sum("orders").alias("order_frequency"),
        F.count("customer_id").alias("distinct_customers"),
        F.count(F.when(F.col("menu_item_id").isNotNull() & (F.col("orders") >= 2), F.col("customer_id"))).alias(
            "repeat_customers"
        ),
        *[F.sum(c).alias(c) for c in summed],
    )
    names = t["Menu_Items"].select("menu_item_id", "item_name", "category_id").join(
        t["Menu_Categories"], "category_id", "left"
    )
    monthly = (
        t["Ratings"]
        .where(F.col("menu_item_id").isNotNull() & F.col("rating_value").between(1, 5) & F.col("rating_timestamp").isNotNull())
        .groupBy("menu_item_id", F.month("rating_timestamp").alias("m"))
        .agg(mean("rating_value").alias("m_avg"))
    )
    halves = monthly.groupBy("menu_item_id").agg(
        F.avg(F.when(F.col("m") <= split_month, F.col("m_avg"))).alias("early_rating"),
        F.avg(F.when(F.col("m") > split_month, F.col("m_avg"))).alias("recent_rating"),
    )
    joined = with_scalars(
        base.join(names, "menu_item_id", "left").join(item_totals(t), "menu_item_id", "left").join(halves, "menu_item_id", "left"),
        # orders with a line, from the keys alone
        t["Orders"].select("order_id").distinct().join(t["Order_Items"].select("order_id"), "order_id", "left_semi").agg(F.count("*").alias("total_orders")),
    )
    joined = joined.withColumns({"revenue": F.col("gross"), "contribution_margin": F.col("line_margin")})
    d = dbl("discount_amount")
    price_change = F.when(F.col("min_price") > 0, (dbl("max_price") - dbl("min_price")) / dbl("min_price"))
    trend = F.col("recent_rating") - F.col("early_rating")
    return joined.select(
        "menu_item_id",
        "item_name",
        "category_id",
        "category_name",
        dbl("quantity").alias("quantity_sold"),
        dbl("revenue").alias("revenue"),
        dbl("line_cost").alias("cost"),
        dbl("contribution_margin").alias("contribution_margin"),
        "order_frequency",
        "distinct_customers",
        "repeat_customers",
        "line_count",
        "avg_rating",
        "rating_count",
        dbl("total_consumption").alias("total_consumption"),
        dbl("total_wasted").alias("total_wasted"),
        dbl("total_wastage_cost").alias("total_wastage_cost"),
        d.alias("discount_total"),
        dbl("max_price").alias("max_price"),
        dbl("min_price").alias("min_price"),
        dbl("qty_promoted").alias("qty_promoted"),
        ratio_or_zero("contribution_margin", "revenue").alias("profit_pct"),
        F.coalesce(ratio_or_zero("total_wasted", "total_consumption"), F.lit(0.0)).alias("wastage_pct"),
        clamp(ratio_or_zero(d, dbl("revenue") + d), 0.0, 1.0).alias("discount_pct"),
        F.coalesce(price_change, F.lit(0.0)).alias("price_change_pct"),
        ratio_or_zero("qty_promoted", "quantity").alias("promotion_dependency"),
        ratio_or_zero("repeat_customers", "distinct_customers").alias("repeat_purchase_rate"),
        ratio_or_zero("order_frequency", "total_orders").alias("basket_inclusion_rate"),
        "early_rating",
        "recent_rating",
        F.coalesce(trend, F.lit(0.0)).alias("rating_trend"),
    )


def customer_features(
    t: Tables, period_end: str, weekend_days: Sequence[int] = DEFAULTS.weekend_days
) -> DataFrame:
    """Activity of every registered customer; zeros and registration date where there were no orders.

    Lines are reduced to (customer, order, category) once. Orders, channels and categories
    are counted from there, so shares need no distinct per condition.
    """
    s = sales(t["Orders"], t["Order_Items"]).join(
        t["Menu_Items"].select("menu_item_id", "category_id"), "menu_item_id", "left"
    )
    order = ["customer_id", "order_id", "order_timestamp", "order_channel"]
    parts = s.groupBy(*order, "category_id").agg(
        F.sum("line_total").alias("monetary"), F.count("order_item_id").alias("line_count")
    )
    per_order = parts.groupBy(*order).agg(F.sum("monetary").alias("monetary"), F.sum("line_count").alias("line_count"))
    by_channel = per_order.groupBy("customer_id", "order_channel").agg(
        F.max("order_timestamp").alias("last_order_ts"),
        F.min("order_timestamp").alias("first_order_ts"),
        F.count("*").alias("order_count"),
        F.sum("monetary").alias("monetary"),
        F.sum("line_count").alias("line_count"),
        F.count_if(is_peak_hour("order_timestamp")).alias("peak_orders"),
        F.count_if(is_weekend("order_timestamp", weekend_days)).alias("weekend_orders"),
    )
    best_channel = F.min_by("order_channel", F.struct(-F.col("line_count"), F.col("order_channel")))
    variety = (
        parts.where(F.col("category_id").isNotNull())
        .select("customer_id", "category_id")
        .distinct()
        .groupBy("customer_id")
        .agg(F.count("*").alias("distinct_categories"))
    )
    agg = (
        by_channel.groupBy("customer_id")
        .agg(
            F.max("last_order_ts").alias("last_order_ts"),
            F.min("first_order_ts").alias("first_order_ts"),
            F.sum("order_count").alias("order_count"),
            F.sum("monetary").alias("monetary"),
            F.sum("line_count").alias("line_count"),
            F.sum("peak_orders").alias("peak_orders"),
            F.sum("weekend_orders").alias("weekend_orders"),
            best_channel.alias("preferred_channel"),
        )
        .join(variety, "customer_id", "left")
    )
    zero = ["order_count", "line_count", "peak_orders", "weekend_orders", "distinct_categories"]
    end = F.lit(period_end).cast("timestamp")
    last = F.least(F.coalesce("last_order_ts", F.col("registration_date").cast("timestamp")), end)
    return (
        t["Customers"]
        .select("customer_id", "registration_date")
        .join(agg, "customer_id", "left")
        .fillna(0, zero)
        .withColumn("monetary", F.coalesce(dbl("monetary"), F.lit(0.0)))
        .withColumn("last_activity_ts", last)
        .withColumns(
            {
                "recency_days": F.datediff(F.lit(period_end).cast("date"), F.to_date("last_activity_ts")),
                "average_order_value": ratio_or_zero("monetary", "order_count"),
                "avg_basket_size": ratio_or_zero("line_count", "order_count"),
                "peak_hour_share": ratio_or_zero("peak_orders", "order_count"),
                "weekend_ratio": ratio_or_zero("weekend_orders", "order_count"),
            }
        )
    )


def order_features(t: Tables, weekend_days: Sequence[int] = DEFAULTS.weekend_days) -> DataFrame:
    """One row per order with basket, calendar and peak features.

    Lines are summed per order before they meet the headers, so header columns are never grouped.
    """
    per_item = t["Order_Items"].groupBy("order_id", "menu_item_id").agg(
        F.count("order_item_id").alias("basket_size"), F.sum("line_total").alias("order_total")
    )
    baskets = per_item.groupBy("order_id").agg(
        F.sum("basket_size").alias("basket_size"),
        F.sum("order_total").alias("order_total"),
        F.count("menu_item_id").alias("distinct_items"),
    )
    ts = "order_timestamp"
    return t["Orders"].join(baskets, "order_id").select(
        "order_id",
        "customer_id",
        "restaurant_id",
        ts,
        "order_channel",
        "order_status",
        "promotion_id",
        "basket_size",
        dbl("order_total").alias("order_total"),
        "distinct_items",
        F.hour(ts).alias("hour_of_day"),
        F.dayofweek(ts).alias("day_of_week"),
        F.month(ts).alias("month_num"),
        is_weekend(ts, weekend_days).cast("int").alias("is_weekend"),
        is_peak_hour(ts).cast("int").alias("is_peak_hour"),
    )


def location_item_features(t: Tables) -> DataFrame:
    per_order = (
        sales(t["Orders"], t["Order_Items"])
        .groupBy("restaurant_id", "menu_item_id", "order_id")
        .agg(*[F.sum(c).alias(c) for c in ("quantity", "line_total", "line_margin")])
    )
    return per_order.groupBy("restaurant_id", "menu_item_id").agg(
        F.count("*").alias("orders"),
        dbl(F.sum("quantity")).alias("quantity"),
        dbl(F.sum("line_total")).alias("revenue"),
        dbl(F.sum("line_margin")).alias("contribution_margin"),
    )


def time_features(t: Tables) -> DataFrame:
    """Orders and revenue per hour, weekday and month; lines are summed per order first."""
    totals = t["Order_Items"].groupBy("order_id").agg(F.sum("line_total").alias("revenue"))
    ts = "order_timestamp"
    return (
        t["Orders"].select("order_id", ts)
        .join(totals, "order_id")
        .groupBy(F.hour(ts).alias("hour_of_day"), F.dayofweek(ts).alias("day_of_week"), F.month(ts).alias("month_num"))
        .agg(F.count("*").alias("order_count"), dbl(F.sum("revenue")).alias("revenue"))
    )


def active_orders(orders: DataFrame, cutoff: str) -> DataFrame:
    """Orders that were not cancelled, up to and including the cutoff day."""
    return orders.where(
        (F.col("order_status") != "cancelled") & (F.col("order_timestamp") < F.date_add(F.lit(cutoff).cast("date"), 1))
    )


def customer_base(orders: DataFrame, lines: DataFrame, cutoff: str) -> DataFrame:
    """Recency, frequency and monetary value per customer up to the cutoff."""
    header = active_orders(orders, cutoff).where(F.col("customer_id").isNotNull())
    s = lines.select("order_id", "menu_item_id", "line_total").join(
        header.select("order_id", "customer_id", "order_timestamp"), "order_id"
    )
    spend = s.groupBy("customer_id", "order_id").agg(
        F.max("order_timestamp").alias("ts"), F.sum("line_total").alias("spent")
    ).groupBy("customer_id").agg(
        F.max("ts").alias("last_order"),
        F.min("ts").alias("first_order"),
        F.count("*").alias("frequency"),
        F.sum("spent").alias("monetary"),
    )
    variety = s.groupBy("customer_id").agg(F.countDistinct("menu_item_id").alias("distinct_items"))
    return (
        spend.join(variety, "customer_id")
        .withColumn("monetary", dbl("monetary"))
        .withColumn("recency", elapsed_days("last_order", F.lit(cutoff)))
        .withColumn("aov", rnd(ratio("monetary", "frequency"), 2))
    )


def item_base(orders: DataFrame, lines: DataFrame, cutoff: str) -> DataFrame:
    s = lines.join(active_orders(orders, cutoff).select("order_id"), "order_id")
    per_order = s.groupBy("menu_item_id", "order_id").agg(
        F.sum("quantity").alias("q"),
        F.sum("line_total").alias("r"),
        F.sum(F.col("quantity") * F.col("unit_cost")).alias("c"),
    )
    return (
        per_order.where(F.col("menu_item_id").isNotNull())
        .groupBy("menu_item_id")
        .agg(
            dbl(F.sum("q")).alias("qty_sold"),
            dbl(F.sum("r")).alias("revenue"),
            dbl(F.sum("c")).alias("cost"),
            F.count("*").alias("orders"),
            rnd(F.sum("r") - F.sum("c"), 2).alias("margin"),
        )
        .withColumn("margin_pct", rnd(ratio("margin", "revenue"), 4))
    )


def weekly_consumption(orders: DataFrame, lines: DataFrame, start: str, end: str) -> DataFrame:
    """Quantity per restaurant, item and 7-day week counted from ``start``; the tail joins the last week."""
    first = F.lit(start).cast("date")
    weeks = F.greatest(F.lit(1), F.floor(F.datediff(F.lit(end).cast("date"), first) / 7))
    week = F.floor(F.datediff("order_timestamp", first) / 7)
    return (
        lines.select("order_id", "menu_item_id", "quantity")
        .where(F.col("menu_item_id").isNotNull())
        .join(orders.select("order_id", "restaurant_id", "order_timestamp"), "order_id")
        .groupBy(
            "restaurant_id", "menu_item_id", F.greatest(F.lit(0), F.least(week, weeks - 1)).cast("bigint").alias("week")
        )
        .agg(dbl(F.sum("quantity")).alias("consumption"))
    )


def order_totals(orders: DataFrame, lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Header amounts rebuilt from the lines and whether the stored header agrees."""
    gross = F.sum(F.col("quantity") * F.col("unit_price"))
    built = lines.groupBy("order_id").agg(
        F.round(gross, 2).alias("line_subtotal"),
        F.sum("discount_amount").alias("line_discount"),
        F.round(gross - F.sum("discount_amount"), 2).alias("line_total"),
    )
    gap = F.abs(F.col("total_amount") - F.col("line_total"))
    return orders.select("order_id", "total_amount").join(built, "order_id").select(
        "order_id",
        *[dbl(c).alias(c) for c in ("line_subtotal", "line_discount", "line_total", "total_amount")],
        (gap <= tolerance).alias("agrees"),
    )


def feature_report(features: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per feature table."""
    frames = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("feature_table"), "rows") for n, df in features.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
