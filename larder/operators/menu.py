"""Menu intelligence: rankings, class splits, difficult cases and slow movers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.relational import percent_ranks, top_k, with_thresholds
from larder.functions.scalar import dbl, is_weekend
from larder.functions.series import mean_gap_days
from larder.operators.features import dealt_by_order, sales
from larder.sources.staging import settle

# fixed values: the lists shown for items, (metric, ascending)
EDA_LISTS = {
    "top_quantity": ("quantity_sold", False),
    "top_revenue": ("revenue", False),
    "top_margin": ("contribution_margin", False),
    "lowest_margin": ("contribution_margin", True),
    "top_wastage": ("total_wasted", False),
    "top_rating": ("avg_rating", False),
    "top_promotion_dependency": ("promotion_dependency", False),
}


def item_eda(items: DataFrame, metric: str, k: int = 10, asc: bool = False) -> DataFrame:
    return top_k(items, metric, k, "menu_item_id", asc).select("menu_item_id", "item_name", F.col(metric).alias("value"))


def item_eda_lists(items: DataFrame, k: int = 10) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [item_eda(items, m, k, asc).withColumn("ranking", F.lit(n)) for n, (m, asc) in EDA_LISTS.items()],
    )


def _quadrant(a: str, b: str, labels: tuple[str, str, str, str]):
    """Label for (high, high), (high, low), (low, high), (low, low)."""
    return (
        F.when(F.col(a) & F.col(b), labels[0]).when(F.col(a), labels[1]).when(F.col(b), labels[2]).otherwise(labels[3])
    )


def menu_classification(items: DataFrame) -> DataFrame:
    """Median split of quantity and margin into four classes."""
    labels = ("Star", "High Sales - Low Profit", "Low Sales - High Profit", "Low Sales - Low Profit")
    judged = with_thresholds(items, {"q_mid": ("quantity_sold", 0.5), "m_mid": ("contribution_margin", 0.5)}).withColumns(
        {"_hq": F.col("quantity_sold") >= F.col("q_mid"), "_hm": F.col("contribution_margin") >= F.col("m_mid")}
    )
    return judged.select(
        "menu_item_id",
        "item_name",
        "quantity_sold",
        "revenue",
        "contribution_margin",
        _quadrant("_hq", "_hm", labels).alias("menu_class"),
    )


def class_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("items"))


def class_samples(classified: DataFrame, k: int = 5) -> DataFrame:
    return top_k(classified, "quantity_sold", k, "menu_item_id", per="menu_class")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# fixed values: case name -> (condition on medians, columns reported)
BASIC_CASES = {
    "High-selling but loss-making": (
        "quantity_sold >= q_mid AND contribution_margin < 0",
        ["quantity_sold", "contribution_margin", "profit_pct"],
    ),
    "Highly profitable but rarely purchased": (
        "contribution_margin >= m_mid AND quantity_sold < q_mid",
        ["quantity_sold", "contribution_margin", "profit_pct"],
    ),
    "Popular with excessive wastage": (
        "quantity_sold >= q_mid AND wastage_pct > w_mid",
        ["quantity_sold", "wastage_pct", "total_wastage_cost"],
    ),
    "Highly rated with poor profitability": (
        "avg_rating >= r_mid AND contribution_margin < 0",
        ["avg_rating", "contribution_margin", "profit_pct"],
    ),
    "Low-rated with high sales": (
        "avg_rating < r_mid AND quantity_sold >= q_mid",
        ["quantity_sold", "avg_rating", "revenue"],
    ),
    "Promotion-dependent": ("promotion_dependency >= p_mid", ["promotion_dependency", "quantity_sold", "revenue"]),
}
# fixed values: columns of the ten-case table
CASE_COLUMNS = (
    "menu_item_id",
    "item_name",
    "quantity_sold",
    "revenue",
    "contribution_margin",
    "profit_pct",
    "avg_rating",
    "wastage_pct",
    "total_wastage_cost",
    "promotion_dependency",
    "max_location_quantity",
    "min_location_quantity",
    "location_count",
    "weekday_quantity",
    "weekend_quantity",
    "max_month_quantity",
    "min_month_quantity",
    "active_months",
    "first_order_date",
    "last_order_date",
    "history_days",
    "case_type",
)


def tricky_cases_basic(items: DataFrame) -> DataFrame:
    """Six median-based cases; an item appears once per case it meets.

    All cases are judged on the same row, so the items are computed once.
    """
    judged = with_thresholds(
        items,
        {
            "q_mid": ("quantity_sold", 0.5),
            "m_mid": ("contribution_margin", 0.5),
            "r_mid": ("avg_rating", 0.5),
            "w_mid": ("wastage_pct", 0.5),
            "p_mid": ("promotion_dependency", 0.5),
        },
    )
    values = sorted({c for _, cols in BASIC_CASES.values() for c in cols})
    hits = [
        F.when(
            F.expr(cond),
            F.struct(
                F.lit(name).alias("case_type"),
                *[(F.col(c) if c in cols else F.lit(None).cast("double")).alias(c) for c in values],
            ),
        )
        for name, (cond, cols) in BASIC_CASES.items()
    ]
    return judged.select("menu_item_id", "item_name", F.explode(F.array_compact(F.array(*hits))).alias("e")).select(
        "menu_item_id", "item_name", "e.*"
    )


def item_days(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Quantity, first and last order per item, restaurant and day, as a stage table: the one join of lines and orders."""
    days = sales(orders, lines).groupBy("menu_item_id", "restaurant_id", "date").agg(
        F.sum("quantity").alias("quantity"),
        F.min("order_timestamp").alias("order_timestamp"),
        F.max("order_timestamp").alias("last_timestamp"),
    )
    return settle(days, "item_days")


def menu_profitability(items: DataFrame, orders: DataFrame, lines: DataFrame, split: str, days: DataFrame | None = None) -> DataFrame:
    """Item features with quantities before and after ``split`` and the trend between them.

    With ``days``, as ``item_days`` gives them, lines aren't read again; the split is then a day.
    """
    if days is None:
        s = lines.select("order_id", "menu_item_id", "quantity").join(orders.select("order_id", "order_timestamp"), "order_id")
    else:
        s = days.select("menu_item_id", "order_timestamp", "quantity")
    first = F.col("order_timestamp") < F.lit(split).cast("timestamp")
    halves = s.groupBy("menu_item_id").agg(
        dbl(F.coalesce(F.sum(F.when(first, F.col("quantity"))), F.lit(0))).alias("h1_quantity"),
        dbl(F.coalesce(F.sum(F.when(~first, F.col("quantity"))), F.lit(0))).alias("h2_quantity"),
    )
    trend = F.when(
        F.col("h1_quantity") == 0, F.when(F.col("h2_quantity") > 0, 100.0).otherwise(0.0)
    ).otherwise((F.col("h2_quantity") - F.col("h1_quantity")) / F.col("h1_quantity") * 100)
    kept = (
        "menu_item_id",
        "item_name",
        "category_id",
        "category_name",
        "quantity_sold",
        "revenue",
        "cost",
        "contribution_margin",
        "profit_pct",
        "avg_rating",
        "repeat_purchase_rate",
        "wastage_pct",
        "promotion_dependency",
        "sales_trend_pct",
        "h1_quantity",
        "h2_quantity",
        "order_frequency",
        "distinct_customers",
        "rating_count",
        "total_wastage_cost",
        "discount_total",
        "min_price",
        "max_price",
    )
    return items.join(halves.withColumn("sales_trend_pct", trend), "menu_item_id", "left").select(*kept)


SALES_METRICS = ("quantity_sold", "revenue", "order_frequency", "sales_trend_pct")
PROFIT_METRICS = ("contribution_margin", "profit_pct", "avg_rating", "repeat_purchase_rate")
INVERTED_METRICS = ("wastage_pct", "promotion_dependency")


def menu_performance(profit: DataFrame) -> DataFrame:
    """Sales and profitability indices from percent ranks, split at their medians into four classes."""
    known = profit.where(F.col("menu_item_id").isNotNull())
    ranks = percent_ranks(known, "menu_item_id", [*SALES_METRICS, *PROFIT_METRICS, *INVERTED_METRICS])

    def total(metrics: Sequence[str], inverted: Sequence[str] = ()):
        terms = [F.col(f"{m}_pr") for m in metrics] + [1 - F.col(f"{m}_pr") for m in inverted]
        return reduce(lambda a, b: a + b, terms) / len(terms)

    indexed = known.join(
        ranks.select(
            "menu_item_id",
            F.round(total(SALES_METRICS), 9).alias("sales_index"),
            F.round(total(PROFIT_METRICS, INVERTED_METRICS), 9).alias("profitability_index"),
        ),
        "menu_item_id",
    )
    judged = with_thresholds(settle(indexed, "menu_indices"), {"s_mid": ("sales_index", 0.5), "p_mid": ("profitability_index", 0.5)})
    labels = ("Profit Driver", "Volume Driver", "Hidden Opportunity", "Low Performer")
    judged = judged.withColumns(
        {"_hs": F.col("sales_index") >= F.col("s_mid"), "_hp": F.col("profitability_index") >= F.col("p_mid")}
    )
    kept = (
        "menu_item_id",
        "item_name",
        "category_id",
        "category_name",
        "quantity_sold",
        "revenue",
        "cost",
        "contribution_margin",
        "profit_pct",
        "avg_rating",
        "repeat_purchase_rate",
        "wastage_pct",
        "promotion_dependency",
        "sales_trend_pct",
        "sales_index",
        "profitability_index",
    )
    return judged.select(
        *kept,
        F.when(F.col("_hs"), "High").otherwise("Low").alias("sales_level"),
        F.when(F.col("_hp"), "High").otherwise("Low").alias("profitability_level"),
        _quadrant("_hs", "_hp", labels).alias("performance_class"),
    )


def performance_check(perf: DataFrame) -> DataFrame:
    """Completeness of the classification: rows, classes present and missing values."""
    return perf.agg(
        F.count("*").alias("items"),
        F.countDistinct("performance_class").alias("classes"),
        F.count_if(F.col("performance_class").isNull()).alias("null_class"),
        F.count_if(F.col("sales_index").isNull() | F.col("profitability_index").isNull()).alias("null_index"),
    ).withColumn("complete", (F.col("classes") == 4) & (F.col("null_class") == 0) & (F.col("null_index") == 0))


def location_cases(s: DataFrame, ratio: float = 2.0) -> DataFrame:
    """Items sold in several restaurants whose best one sells more than ``ratio`` times the weakest."""
    per_loc = s.where(F.col("restaurant_id").isNotNull()).groupBy("menu_item_id", "restaurant_id").agg(
        dbl(F.sum("quantity")).alias("q")
    )
    return per_loc.groupBy("menu_item_id").agg(
        F.max("q").alias("max_location_quantity"),
        F.min("q").alias("min_location_quantity"),
        F.count("*").alias("location_count"),
    ).where((F.col("location_count") >= 2) & (F.col("max_location_quantity") > F.col("min_location_quantity") * ratio))


def weekend_cases(s: DataFrame, weekend_days: Sequence[int], ratio: float = 1.5) -> DataFrame:
    weekend = is_weekend("order_timestamp", weekend_days)
    return s.groupBy("menu_item_id").agg(
        dbl(F.coalesce(F.sum(F.when(~weekend, F.col("quantity"))), F.lit(0))).alias("weekday_quantity"),
        dbl(F.coalesce(F.sum(F.when(weekend, F.col("quantity"))), F.lit(0))).alias("weekend_quantity"),
    ).where(
        (F.col("weekend_quantity") > F.col("weekday_quantity"))
        & (F.col("weekend_quantity") >= F.col("weekday_quantity") * ratio)
    )


def seasonal_cases(s: DataFrame, ratio: float = 2.0, min_months: int = 6) -> DataFrame:
    monthly = s.groupBy("menu_item_id", F.month("order_timestamp").alias("m")).agg(dbl(F.sum("quantity")).alias("q"))
    return monthly.groupBy("menu_item_id").agg(
        F.max("q").alias("max_month_quantity"),
        F.min("q").alias("min_month_quantity"),
        F.count("m").alias("active_months"),
    ).where((F.col("active_months") >= min_months) & (F.col("max_month_quantity") > F.col("min_month_quantity") * ratio))


def new_item_cases(s: DataFrame, orders: DataFrame, new_days: int = 90, last: str = "order_timestamp") -> DataFrame:
    history = s.groupBy("menu_item_id").agg(
        F.min("order_timestamp").alias("first_order_date"), F.max(last).alias("last_order_date")
    )
    end = orders.agg(F.max("order_timestamp"))
    return history.withColumn("history_days", F.datediff(end.scalar(), "first_order_date")).where(
        F.col("history_days") < new_days
    )


def tricky_cases(
    profit: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    new_days: int = 90,
    ratio: float = 2.0,
    weekend_ratio: float = 1.5,
    weekend_days: Sequence[int] = (5, 6),
    days: DataFrame | None = None,
) -> DataFrame:
    """The ten difficult cases in one table; columns a case does not use are NULL.

    Lines and orders are joined once, down to items per restaurant and day, unless ``days`` has them already.
    """
    s = (days if days is not None else item_days(orders, lines)).where(F.col("menu_item_id").isNotNull())
    base = ["menu_item_id", "item_name", "quantity_sold", "revenue"]
    with_margin = [*base, "contribution_margin"]

    def described(cases: DataFrame, columns: list[str], name: str) -> DataFrame:
        return cases.join(profit.select(*columns), "menu_item_id", "left").withColumn("case_type", F.lit(name))

    cases = [
        tricky_cases_basic(profit.where(F.col("menu_item_id").isNotNull())),
        described(location_cases(s, ratio), with_margin, "Different performance across locations"),
        described(weekend_cases(s, weekend_days, weekend_ratio), base, "Performs well only on weekends"),
        described(seasonal_cases(s, ratio), base, "Seasonal menu item"),
        described(new_item_cases(s, orders, new_days, "last_timestamp"), with_margin, "New menu item with insufficient history"),
    ]
    return _union(cases).select(*CASE_COLUMNS)


def case_counts(cases: DataFrame) -> DataFrame:
    return cases.groupBy("case_type").agg(F.count("*").alias("cases"))


# fixed values: criterion -> condition
SLOW_CRITERIA = {
    "c_low_volume": "qty_sold <= q25_qty",
    "c_low_frequency": "orders <= q25_orders",
    "c_long_gaps": "avg_days_between_orders >= q75_gap",
    "c_low_repeat": "repeat_purchase <= q25_repeat",
    "c_high_wastage": "total_wasted >= q75_waste",
    "c_weak_margin": "margin <= q25_margin",
    "c_poor_trend": "h2_qty < h1_qty",
}


def item_sales_summary(
    lines: DataFrame,
    orders: DataFrame,
    wastage: DataFrame,
    menu: DataFrame,
    cutoff: str,
    low_q: float = 0.25,
    high_q: float = 0.75,
    recent_days: int = 90,
    min_criteria: int | None = None,
) -> DataFrame:
    """Sales up to the cutoff day, gap, wastage and trend per item with the seven slow-mover criteria.

    ``is_slow_moving`` is (low volume or frequency) and (low repeat or weak margin), or
    (high wastage and poor trend); with ``min_criteria`` it is a plain count of criteria.
    """
    by_then = orders.where(F.to_date("order_timestamp") <= F.lit(cutoff).cast("date"))
    s = sales(by_then, dealt_by_order(lines)).where(F.col("menu_item_id").isNotNull())
    q, early = F.col("quantity"), F.month("order_timestamp") <= 6
    per_order = s.groupBy("menu_item_id", "order_id", "customer_id", "order_timestamp").agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("r"), F.sum("line_margin").alias("m"), F.count("*").alias("lines")
    )
    per_customer = per_order.groupBy("menu_item_id", "customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("quantity").alias("q"),
        F.sum("r").alias("r"),
        F.sum("m").alias("m"),
        F.sum(F.when(early, q).otherwise(0)).alias("h1"),
        F.sum(F.when(early, 0).otherwise(q)).alias("h2"),
        F.max("order_timestamp").alias("last_sale"),
        F.min("order_timestamp").alias("first_sale"),
    )
    agg = per_customer.groupBy("menu_item_id").agg(
        dbl(F.sum("q")).alias("qty_sold"),
        dbl(F.sum("r")).alias("revenue"),
        dbl(F.sum("m")).alias("margin"),
        F.sum("orders").alias("orders"),
        F.count("customer_id").alias("customers"),
        F.max("last_sale").alias("last_sale"),
        F.min("first_sale").alias("first_sale"),
        dbl(F.sum("h1")).alias("h1_qty"),
        dbl(F.sum("h2")).alias("h2_qty"),
    )
    wasted = wastage.groupBy("menu_item_id").agg(
        dbl(F.sum("quantity_wasted")).alias("total_wasted"), dbl(F.sum("wastage_cost")).alias("wastage_cost")
    )
    joined = (
        agg.join(mean_gap_days(per_order, ["menu_item_id"], "order_timestamp", weight="lines"), "menu_item_id")
        .withColumn("repeat_purchase", F.greatest(F.col("orders") - 1, F.lit(0)))
        .join(wasted, "menu_item_id", "left")
        .fillna(0.0, ["total_wasted", "wastage_cost"])
    )
    judged = with_thresholds(
        settle(joined, "item_sales"),
        {
            "q25_qty": ("qty_sold", low_q),
            "q25_orders": ("orders", low_q),
            "q75_gap": ("avg_days_between_orders", high_q),
            "q25_repeat": ("repeat_purchase", low_q),
            "q75_waste": ("total_wasted", high_q),
            "q25_margin": ("margin", low_q),
        },
    ).withColumns({n: F.expr(c) for n, c in SLOW_CRITERIA.items()})
    met = reduce(lambda a, b: a + b, [F.col(c).cast("int") for c in SLOW_CRITERIA])
    slow = F.expr(
        "(c_low_volume OR c_low_frequency) AND (c_low_repeat OR c_weak_margin) OR c_high_wastage AND c_poor_trend"
    )
    return (
        judged.drop("q25_qty", "q25_orders", "q75_gap", "q25_repeat", "q75_waste", "q25_margin")
        .withColumn("criteria_met", met)
        .withColumn("is_slow_moving", slow if min_criteria is None else F.col("criteria_met") >= min_criteria)
        .withColumn("no_recent_sale", F.col("last_sale") < F.date_sub(F.lit(cutoff).cast("date"), recent_days))
        .join(menu.select("menu_item_id", "item_name", "category_id", "base_price"), "menu_item_id", "left")
    )


def slow_moving(summary: DataFrame) -> DataFrame:
    return summary.where("is_slow_moving")


def no_recent_sales(summary: DataFrame) -> DataFrame:
    return summary.where("no_recent_sale")


def simple_slow_movers(perf: DataFrame) -> DataFrame:
    """Items on the low sales level with finding, evidence, action and priority."""
    evidence = F.format_string(
        "Among the least sold: %.0f units worth %.2f", F.col("quantity_sold"), F.col("revenue")
    )
    return perf.where(F.lower("sales_level") == "low").select(
        "menu_item_id",
        "item_name",
        "category_name",
        "quantity_sold",
        "revenue",
        "profit_pct",
        "wastage_pct",
        "promotion_dependency",
        "performance_class",
        F.lit("Item sells slowly").alias("finding"),
        evidence.alias("evidence"),
        F.lit("Prepare less of it, or give it a better place on the menu.").alias("action"),
        F.lit("Medium").alias("priority"),
    )
