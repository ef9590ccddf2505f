"""Customer behaviour, RFM scores, segments and channel views."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import qcut_scores, with_thresholds
from larder.functions.scalar import dbl, is_peak_hour, is_weekend, ratio, rnd, time_of_day
from larder.functions.series import mean_gap_days


def share(cond: Column) -> Column:
    return F.count_if(cond).cast("double") / F.count("*")


def most_common(df: DataFrame, entity: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-null value per entity, the smallest one on ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*entity, value).agg(F.count("*").alias("_c"))
    return counts.groupBy(*entity).agg(F.min_by(value, F.struct(-F.col("_c"), F.col(value))).alias(name))


def customer_behaviour(
    orders: DataFrame,
    lines: DataFrame,
    menu: DataFrame,
    categories: DataFrame,
    cutoff: Column,
    days: int = 90,
    by: Sequence[str] = ("customer_id",),
    bought: DataFrame | None = None,
) -> DataFrame:
    """Shares, preferences, recent frequency, gaps and category variety per customer.

    ``orders`` must already be limited to the feature window; ``cutoff`` is its last day. ``bought`` are the lines of
    each customer and item (``by``, ``menu_item_id``, ``n_lines``) where they have been counted already.
    """
    ts, by = "order_timestamp", list(by)
    o = orders.where(F.col("customer_id").isNotNull())
    recent = F.col(ts) >= F.date_sub(cutoff, days)
    per_customer = o.groupBy(*by).agg(
        share(is_peak_hour(ts)).alias("peak_ratio"),
        share(is_weekend(ts)).alias("weekend_ratio"),
        share(F.col("promotion_id").isNotNull()).alias("promo_sensitivity"),
        F.count_if(recent).alias("freq_recent_90d"),
        rnd(share(recent), 4).alias("freq_trend"),
    )
    if bought is None:
        bought = lines.select("order_id", "menu_item_id").join(o.select("order_id", *by), "order_id").withColumn("n_lines", F.lit(1))
    per_category = (
        bought.join(menu.select("menu_item_id", "category_id"), "menu_item_id")
        .groupBy(*by, "category_id")
        .agg(F.sum("n_lines").alias("_c"))
        .join(categories, "category_id", "left")
    )
    variety = per_category.groupBy(*by).agg(
        F.count("*").alias("distinct_categories"),
        F.min_by("category_name", F.struct(-F.col("_c"), F.col("category_name"))).alias("favorite_category"),
    )
    return (
        per_customer.join(most_common(o, by, "order_channel", "preferred_channel"), by)
        .join(most_common(o.withColumn("_tod", time_of_day(ts)), by, "_tod", "time_of_day_preference"), by)
        .join(mean_gap_days(o, by, ts), by)
        .join(variety, by, "left")
    )


def rfm_scores(df: DataFrame, q: int = DEFAULTS.rfm_quantiles, by: Sequence[str] = ()) -> DataFrame:
    """Equal-count scores of recency (reversed), frequency and monetary value, ties by customer id."""
    keys = [*by, "customer_id"]
    wanted = {"r_score": ("recency", True), "f_score": ("frequency", False), "m_score": ("monetary", False)}
    scores = qcut_scores(df, "customer_id", wanted, q, by)
    return df.join(scores, keys).withColumns(
        {
            "rfm_sum": F.col("r_score") + F.col("f_score") + F.col("m_score"),
            "rfm_string": F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]),
        }
    )


def rfm_threshold_scores(df: DataFrame) -> DataFrame:
    """Scores 1..4 by value quartiles instead of ranks; equal values share a score."""
    spec = {f"{c[0]}{i}": (c, i / 4) for c in ("recency", "frequency", "monetary") for i in (1, 2, 3)}
    judged = with_thresholds(df, spec)

    def score(c: str, reverse: bool = False) -> Column:
        x, order = F.col(c), (4, 3, 2, 1) if reverse else (1, 2, 3, 4)
        return (
            F.when(x <= F.col(f"{c[0]}1"), order[0])
            .when(x <= F.col(f"{c[0]}2"), order[1])
            .when(x <= F.col(f"{c[0]}3"), order[2])
            .otherwise(order[3])
        )

    return judged.withColumns(
        {"r_score": score("recency", True), "f_score": score("frequency"), "m_score": score("monetary")}
    ).drop(*spec)


def rfm_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("rfm_sum").agg(F.count("*").alias("n_customers"))


SEGMENT_FEATURES = ("recency", "frequency", "monetary", "aov")


def _scaled(df: DataFrame, features: Iterable[str] = SEGMENT_FEATURES) -> DataFrame:
    cols = list(features)
    filled = df.withColumns({f"_{c}": F.coalesce(dbl(c), F.lit(0.0)) for c in cols})
    steps = Pipeline(
        stages=[
            VectorAssembler(inputCols=[f"_{c}" for c in cols], outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        ]
    )
    return steps.fit(filled).transform(filled).drop("_raw", *[f"_{c}" for c in cols])


def kmeans_search(df: DataFrame, ks: Iterable[int] = range(3, 9), seed: int = DEFAULTS.seed) -> DataFrame:
    """Silhouette per number of clusters. Training is distributed; only k and score come back."""
    scaled = _scaled(df).select("features").persist()
    try:
        evaluator = ClusteringEvaluator()
        rows = [
            (k, round(evaluator.evaluate(KMeans(k=k, seed=seed).fit(scaled).transform(scaled)), 4)) for k in ks
        ]
    finally:
        scaled.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def segment_customers(df: DataFrame, k: int = 6, seed: int = DEFAULTS.seed) -> DataFrame:
    return fit_segments(df, k, seed)[0].drop("features")


def fit_segments(df: DataFrame, k: int = 6, seed: int = DEFAULTS.seed) -> tuple[DataFrame, list[list[float]]]:
    """The customers with their scaled features and cluster, and the centres."""
    scaled = _scaled(df)
    model = KMeans(k=k, seed=seed, predictionCol="cluster").fit(scaled)
    return model.transform(scaled), [centre.tolist() for centre in model.clusterCenters()]


# fixed values: segment names and their conditions, the first that holds
SEGMENTS = {
    "promotion_driven": "promo >= 0.5",
    "weekend_only": "weekend >= 0.7",
    "high_value_loyal": "r >= 3 AND f >= 3.5 AND m >= 3.5",
    "frequent": "f >= 3",
    "at_risk": "r <= 2.2 AND f >= 1.9 AND m >= 1.8",
    "new": "r >= 2 AND f <= 2 AND m <= 2",
    "occasional": "true",
}


def segment_profiles(clustered: DataFrame) -> DataFrame:
    """Mean scores, leading attributes and a rule-based name per cluster; equal names get a suffix."""
    means = clustered.groupBy("cluster").agg(
        *[
            F.round(F.avg(dbl(c)), 3).alias(n)
            for n, c in {
                "r": "r_score",
                "f": "f_score",
                "m": "m_score",
                "promo": "promo_sensitivity",
                "weekend": "weekend_ratio",
            }.items()
        ],
        F.count("customer_id").alias("n"),
    )
    for value, name in (
        ("preferred_channel", "top_channel"),
        ("time_of_day_preference", "top_tod"),
        ("favorite_category", "top_category"),
    ):
        means = means.join(most_common(clustered, ["cluster"], value, name), "cluster", "left")
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    name = F.coalesce(*[F.when(F.expr(rule), F.lit(segment)) for segment, rule in SEGMENTS.items()])
    named = means.withColumn("_name", name)
    same = Window.partitionBy("_name")
    place = F.row_number().over(same.orderBy(r.desc(), f.desc(), m.desc(), "cluster"))
    return named.withColumn(
        "segment",
        F.when(F.count("*").over(same) > 1, F.concat_ws("_", "_name", place.cast("string"))).otherwise(F.col("_name")),
    ).drop("_name")


def channel_intelligence(customers: DataFrame) -> DataFrame:
    """Customers, orders, revenue and mean behaviour per preferred channel."""
    return (
        customers.where(F.col("preferred_channel").isNotNull())
        .groupBy("preferred_channel")
        .agg(
            F.count("customer_id").alias("customers"),
            F.sum("order_count").alias("orders"),
            dbl(F.sum(F.col("monetary").cast("decimal(18,2)"))).alias("revenue"),
            F.round(F.avg("average_order_value"), 4).alias("avg_order_value"),
            F.round(F.avg("avg_basket_size"), 6).alias("avg_basket_size"),
            F.round(F.avg("recency_days"), 6).alias("avg_recency"),
        )
    )


def churned_customers(orders: DataFrame, end: str, min_orders: int = 3, days: int = 120) -> DataFrame:
    """Customers with enough orders whose last one is at least ``days`` before ``end``."""
    return (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.countDistinct("order_id").alias("orders"), F.max("order_timestamp").alias("last_order"))
        .where((F.col("orders") >= min_orders) & (F.col("last_order") <= F.date_sub(F.lit(end).cast("date"), days)))
    )


def channel_share(channels: DataFrame) -> DataFrame:
    """Each channel's part of all orders and revenue."""
    totals = channels.agg(F.struct(F.sum("orders").alias("o"), F.sum("revenue").alias("r")).alias("t"))
    return channels.withColumn("_t", totals.scalar()).select(
        "preferred_channel",
        "orders",
        "revenue",
        F.round(ratio("orders", "_t.o"), 6).alias("order_share"),
        F.round(ratio("revenue", "_t.r"), 6).alias("revenue_share"),
    )
