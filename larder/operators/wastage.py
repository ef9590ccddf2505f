"""Wastage by dimension, against demand, promotions and stock, and the risk features."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import existence_flag, ordered_index, running_total, with_thresholds
from larder.functions.scalar import day_name, dbl, ratio, rnd, tier
from larder.functions.series import expanding_sum, rolling_features
from larder.operators.churn import binary_metrics, score, train_classifier
from larder.sources.staging import settle


def _totals(w: DataFrame, *by: str) -> DataFrame:
    return w.groupBy(*by).agg(
        dbl(F.sum("quantity_wasted")).alias("total_wasted"),
        dbl(F.sum("wastage_cost")).alias("total_cost"),
        F.count("wastage_id").alias("n_records"),
    )


def wastage_by(wastage: DataFrame, by: str, menu: DataFrame | None = None, categories: DataFrame | None = None) -> DataFrame:
    """Totals by item, category, location, weekday (``dow``), calendar month (``time``) or reason.

    Categories are built from item totals, so only one row per item meets the menu.
    """
    if by == "item":
        return _totals(wastage, "menu_item_id").join(
            menu.select("menu_item_id", "item_name", "category_id"), "menu_item_id", "left"
        )
    if by == "category":
        per_item = wastage.groupBy("menu_item_id").agg(
            F.sum("quantity_wasted").alias("q"), F.sum("wastage_cost").alias("c"), F.count("wastage_id").alias("n")
        )
        return (
            per_item.join(menu.select("menu_item_id", "category_id"), "menu_item_id", "left")
            .join(categories, "category_id", "left")
            .groupBy("category_id", "category_name")
            .agg(dbl(F.sum("q")).alias("total_wasted"), dbl(F.sum("c")).alias("total_cost"), F.sum("n").alias("n_records"))
        )
    if by == "location":
        return _totals(wastage, "restaurant_id")
    if by == "reason":
        return _totals(wastage, "wastage_reason")
    dated = wastage.where(F.col("wastage_date").isNotNull())
    if by == "dow":
        return _totals(dated.withColumn("dow", day_name("wastage_date")), "dow").drop("n_records")
    if by == "time":
        parts = {"year": F.year("wastage_date"), "month": F.month("wastage_date")}
        return _totals(dated.withColumns(parts), "year", "month").drop("n_records")
    raise ValueError(f"unknown dimension {by}")


def _daily_demand(orders: DataFrame, lines: DataFrame, *extra: str) -> DataFrame:
    header = orders.select("order_id", F.to_date("order_timestamp").alias("date"), *extra)
    return lines.select("order_id", "menu_item_id", "quantity").join(header, "order_id")


def wastage_vs_demand(wastage: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Wasted and sold quantity per item and day; no ratio on days without demand."""
    demand = _daily_demand(orders, lines).groupBy("menu_item_id", "date").agg(F.sum("quantity").alias("demand_qty"))
    wasted = (
        wastage.where(F.col("wastage_date").isNotNull())
        .groupBy("menu_item_id", F.col("wastage_date").alias("date"))
        .agg(F.sum("quantity_wasted").alias("wasted_qty"), F.sum("wastage_cost").alias("wasted_cost"))
    )
    return wasted.join(demand, ["menu_item_id", "date"], "left").select(
        "menu_item_id",
        "date",
        dbl("wasted_qty").alias("wasted_qty"),
        dbl("wasted_cost").alias("wasted_cost"),
        F.coalesce(dbl("demand_qty"), F.lit(0.0)).alias("demand_qty"),
        rnd(ratio("wasted_qty", "demand_qty"), 4).alias("waste_ratio"),
    )


def promo_days(orders: DataFrame) -> DataFrame:
    """Days with at least one promoted order."""
    return orders.where(F.col("promotion_id").isNotNull()).select(F.to_date("order_timestamp").alias("date")).distinct()


def wastage_vs_promo_day(wastage: DataFrame, orders: DataFrame) -> DataFrame:
    per_day = wastage.groupBy(F.col("wastage_date").alias("date")).agg(
        F.sum("quantity_wasted").alias("q"), F.sum("wastage_cost").alias("c"), F.count("wastage_id").alias("n")
    )
    return existence_flag(per_day, promo_days(orders), ["date"], "has_promo").groupBy("has_promo").agg(
        dbl(F.sum("q")).alias("total_wasted"), dbl(F.sum("c")).alias("total_cost"), F.sum("n").alias("n_records")
    )


def _wasted_and_stock(wastage: DataFrame, inventory: DataFrame) -> DataFrame:
    on = ["menu_item_id", "restaurant_id"]
    stock = inventory.groupBy(*on).agg(
        *[F.sum(f"{c}_quantity").alias(n) for c, n in (("consumption", "consumed"), ("opening", "opening"), ("closing", "closing"))]
    )
    wasted = wastage.groupBy(*on).agg(F.sum("quantity_wasted").alias("wasted"), F.sum("wastage_cost").alias("cost"))
    joined = wasted.join(stock, on, "left")
    return joined.select(*on, *[F.coalesce(dbl(c), F.lit(0.0)).alias(c) for c in ("wasted", "cost", "consumed", "opening", "closing")])


def wastage_vs_inventory(wastage: DataFrame, inventory: DataFrame) -> DataFrame:
    return _wasted_and_stock(wastage, inventory).withColumns(
        {
            "waste_rate_of_consumed": rnd(ratio("wasted", "consumed"), 4),
            "waste_rate_of_opening": rnd(ratio("wasted", "opening"), 4),
        }
    )


def wastage_risk_rule(
    wastage: DataFrame, inventory: DataFrame, low: float = DEFAULTS.wastage_medium, high: float = DEFAULTS.wastage_high
) -> DataFrame:
    return (
        _wasted_and_stock(wastage, inventory)
        .drop("opening", "closing")
        .withColumn("waste_rate", rnd(ratio("wasted", "consumed"), 4))
        .withColumn("risk", tier("waste_rate", [(high, "high"), (low, "medium")], "low", "unknown"))
    )


def wastage_risk_features(wastage: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Item, restaurant and day rows with past demand, past wastage and calendar features."""
    on = ["menu_item_id", "restaurant_id", "wastage_date"]
    demand = (
        _daily_demand(orders, lines, "restaurant_id", "promotion_id")
        .groupBy("menu_item_id", "restaurant_id", F.col("date").alias("wastage_date"))
        .agg(F.sum("quantity").alias("demand_qty"), F.max(F.col("promotion_id").isNotNull().cast("int")).alias("is_promo"))
    )
    wasted = wastage.where(F.col("wastage_date").isNotNull()).groupBy(*on).agg(
        dbl(F.sum("quantity_wasted")).alias("wastage_qty"), dbl(F.sum("wastage_cost")).alias("wastage_cost")
    )
    df = (
        wasted.join(demand, on, "left")
        .withColumn("demand_qty", F.coalesce(dbl("demand_qty"), F.lit(0.0)))
        .withColumn("is_promo", F.coalesce("is_promo", F.lit(0)))
    )
    entity = ["menu_item_id", "restaurant_id"]
    df = rolling_features(df, entity, "wastage_date", "demand_qty", mean=(7, 30), std=())
    df = expanding_sum(df, entity, "wastage_date", "wastage_qty", "hist_wastage_before")
    return df.select(
        *on,
        "wastage_qty",
        "wastage_cost",
        "demand_qty",
        "is_promo",
        F.round(F.coalesce("rolling_mean_7", F.lit(0.0)), 6).alias("lag_demand_7d"),
        F.round(F.coalesce("rolling_mean_30", F.lit(0.0)), 6).alias("lag_demand_30d"),
        F.coalesce("hist_wastage_before", F.lit(0.0)).alias("hist_wastage_before"),
        F.weekday("wastage_date").alias("dow_num"),
        F.month("wastage_date").alias("month_num"),
    )


def wastage_label_split(
    df: DataFrame, q: float = 0.75, train: float = 0.6, val: float = 0.2, label_on: str = "train"
) -> DataFrame:
    """Chronological split and the high-waste label.

    The label threshold is the q-quantile of the training rows, or of all rows with ``label_on="all"``.
    """
    ranked = ordered_index(settle(df, "wastage_features"), ["wastage_date", "menu_item_id", "restaurant_id"])
    n_train, n_val = F.floor(F.col("n") * train), F.floor(F.col("n") * val)
    split = F.when(F.col("rn") <= n_train, "train").when(F.col("rn") <= n_train + n_val, "val").otherwise("test")
    parts = settle(ranked.withColumn("split", split).drop("rn", "n"), "wastage_ranked")
    source = parts.where(F.col("split") == "train") if label_on == "train" else parts
    return (
        with_thresholds(parts, {"q_high": ("wastage_qty", q)}, source=source)
        .withColumn("is_high_waste", (F.col("wastage_qty") >= F.col("q_high")).cast("int"))
        .drop("q_high")
    )


def popularity_rank(df: DataFrame, unknown: float = 9999.0) -> DataFrame:
    """Add the item's average descending rank of mean 30-row demand among the training rows."""
    pop = df.where(F.col("split") == "train").groupBy("menu_item_id").agg(F.round(F.avg("lag_demand_30d"), 6).alias("p"))
    ties = pop.groupBy("p").agg(F.count("*").alias("c"))
    upto = running_total(ties.withColumn("_neg", -F.col("p")), [], ["_neg"], "c", "upto", "all")
    ranks = pop.join(upto.select("p", (F.col("upto") - (F.col("c") - 1) / 2).alias("popularity_rank_train")), "p").drop("p")
    return df.join(ranks, "menu_item_id", "left").fillna(unknown, ["popularity_rank_train"])


# fixed values: columns of the risk models
RISK_FEATURES = (
    "lag_demand_7d",
    "lag_demand_30d",
    "hist_wastage_before",
    "dow_num",
    "month_num",
    "is_promo",
    "popularity_rank_train",
)
# fixed values
RISK_MODELS: dict[str, dict[str, float]] = {
    "logistic": {"maxIter": 1000},
    "random_forest": {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 1},
}


def fit_risk_models(data: DataFrame, params: Mapping[str, Mapping[str, float]] = RISK_MODELS) -> dict[str, PipelineModel]:
    """Balanced classifiers of ``is_high_waste``, fitted to the training rows."""
    train = data.where(F.col("split") == "train")
    return {a: train_classifier(train, a, "is_high_waste", RISK_FEATURES, **p) for a, p in params.items()}


def risk_scores(model: PipelineModel, data: DataFrame) -> DataFrame:
    """Risk class and probability of the test rows; every model scores the features it was fitted to."""
    scored = score(model, data.where(F.col("split") == "test"), RISK_FEATURES)
    return scored.select(
        "menu_item_id",
        "restaurant_id",
        "wastage_date",
        "wastage_qty",
        "lag_demand_7d",
        "hist_wastage_before",
        F.round("probability", 4).alias("wastage_risk_prob"),
        (F.col("probability") >= 0.5).cast("int").alias("wastage_risk_class"),
    )


def risk_metrics(models: Mapping[str, PipelineModel], data: DataFrame) -> DataFrame:
    """Metrics per model on the validation and the test rows, which each model scores once."""
    rows = []
    for a, m in models.items():
        scored = score(m, data.where(F.col("split").isin("val", "test")), RISK_FEATURES)
        scored = settle(scored.select("split", "is_high_waste", "prediction", "probability"), f"risk_scored_{a}")
        for s in ("val", "test"):
            metrics = binary_metrics(scored.where(F.col("split") == s), "is_high_waste")
            rows.append(metrics.withColumns({"model": F.lit(a), "split": F.lit(s)}))
    return reduce(DataFrame.unionByName, rows)


def top_wastage(items: DataFrame, n: int = 20) -> DataFrame:
    return items.orderBy(F.desc_nulls_last("total_cost"), "menu_item_id").limit(n)

