"""Named queries: every operator applied to the whole domain tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import lru_cache, reduce

from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.functions import sketches
from larder.operators import (
    anomalies,
    basket,
    checks,
    churn,
    cleaning,
    compare,
    customers,
    features,
    forecast,
    itemsets,
    menu,
    models,
    peaks,
    pricing,
    promotions,
    quality,
    ratings,
    recommend,
    validation,
    wastage,
)
from larder.operators.registry import DuplicateVersion, Registry
from larder.plans.retail import Retail
from larder.sources import readers, schemas, writers
from larder.sources.staging import settle, stage_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# fixed values: constants of the driver data
AS_OF = "2024-01-25"


@lru_cache(maxsize=8)
def retail(spark: SparkSession, sf_dir: str) -> Retail:
    """One set of table plans per session and folder."""
    return Retail(spark, sf_dir)


def query(name: str) -> Callable[[Callable[[Retail], DataFrame]], Callable[[Retail], DataFrame]]:
    """Register a function of the domain tables under a query name."""

    def register(f: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(retail(spark, sf_dir))
        return f

    return register


# ---- quality ---------------------------------------------------------------
STRICT_RULES = (
    "missing_values",
    "duplicate_orders",
    "duplicate_order_lines",
    "invalid_menu_prices",
    "invalid_dates",
    "invalid_ratings",
    "impossible_wastage",
    "incorrect_discounts",
    "inconsistent_units",
    "invalid_location_references",
)

for _name, _rule in quality.RULES.items():
    query(f"dq_{_name}")(lambda d, rule=_rule: rule(d))
for _name in STRICT_RULES:
    _extra = {"as_of": AS_OF} if _name == "invalid_dates" else {}
    query(f"dq_strict_{_name}")(
        lambda d, rule=quality.RULES[_name], extra=_extra: rule(d, strict=True, **extra)
    )


@query("dq_run")
def _(d: Retail) -> DataFrame:
    return quality.run_quality(d)


@query("dq_run_strict")
def _(d: Retail) -> DataFrame:
    return quality.run_quality(d, strict=True, as_of=AS_OF)


# ---- features --------------------------------------------------------------
FEATURE_END = "2000-12-31"
DATA_START, DATA_END = "1995-01-01", "2001-08-01"

query("feat_integrated_fact")(features.integrated_fact)
query("feat_item")(features.item_features)
query("feat_customer")(lambda d: features.customer_features(d, FEATURE_END))
query("feat_order")(features.order_features)
query("feat_location_item")(features.location_item_features)
query("feat_time")(features.time_features)
query("feat_customer_base")(lambda d: features.customer_base(d.orders, d.lines, FEATURE_END))
query("feat_item_base")(lambda d: features.item_base(d.orders, d.lines, FEATURE_END))
query("feat_weekly_consumption")(lambda d: features.weekly_consumption(d.orders, d.lines, DATA_START, DATA_END))
query("feat_order_totals")(lambda d: features.order_totals(d.orders, d.lines))


@query("feat_report")
def _(d: Retail) -> DataFrame:
    return features.feature_report(
        {
            "item": features.item_features(d),
            "customer": features.customer_features(d, FEATURE_END),
            "order": features.order_features(d),
            "location_item": features.location_item_features(d),
            "time": features.time_features(d),
        }
    )


# ---- menu ------------------------------------------------------------------
HALF_SPLIT = "1998-07-01"
NEW_DAYS = 2000  # the driver data has no items younger than 90 days


def _items(d: Retail) -> DataFrame:
    return settle(features.item_features(d), "item_features").where(F.col("menu_item_id").isNotNull())


def _profit(d: Retail, days: DataFrame | None = None) -> DataFrame:
    return menu.menu_profitability(features.item_features(d), d.orders, d.lines, HALF_SPLIT, days)


def _performance(d: Retail) -> DataFrame:
    return menu.menu_performance(settle(_profit(d), "menu_profitability"))


def _cases(d: Retail) -> DataFrame:
    days = menu.item_days(d.orders, d.lines)
    return menu.tricky_cases(settle(_profit(d, days), "menu_profitability"), d.orders, d.lines, new_days=NEW_DAYS, days=days)


def _summary(d: Retail, **limits: int) -> DataFrame:
    return menu.item_sales_summary(d.lines, d.orders, d.wastage, d.menu, FEATURE_END, **limits)


query("menu_item_eda")(lambda d: menu.item_eda_lists(_items(d)))
query("menu_classification")(lambda d: menu.menu_classification(_items(d)))
query("menu_class_counts")(lambda d: menu.class_counts(menu.menu_classification(_items(d)), "menu_class"))
query("menu_class_samples")(lambda d: menu.class_samples(menu.menu_classification(_items(d))))
query("menu_tricky_basic")(lambda d: menu.tricky_cases_basic(_items(d)))
query("menu_profitability")(_profit)
query("menu_performance")(_performance)
query("menu_performance_check")(lambda d: menu.performance_check(_performance(d)))
query("menu_tricky_cases")(_cases)
query("menu_tricky_counts")(lambda d: menu.case_counts(_cases(d)))
query("menu_item_sales_summary")(_summary)
query("menu_slow_moving")(lambda d: menu.slow_moving(_summary(d)))
query("menu_no_recent_sales")(lambda d: menu.no_recent_sales(_summary(d, recent_days=10)))  # the driver data sells weekly
query("menu_slow_by_count")(lambda d: menu.slow_moving(_summary(d, min_criteria=4)))
query("menu_simple_slow_movers")(lambda d: menu.simple_slow_movers(_performance(d)))


# ---- customers, baskets, peaks ---------------------------------------------
MIN_CONFIDENCE = 0.03  # baskets of the driver data are small


def _base(d: Retail) -> DataFrame:
    return features.customer_base(d.orders, d.lines, FEATURE_END)


def _behaviour(d: Retail) -> DataFrame:
    window = features.active_orders(d.orders, FEATURE_END)
    return customers.customer_behaviour(
        window, d.lines, d.menu, d.categories, F.lit(FEATURE_END).cast("date")
    )


def _rfm(d: Retail) -> DataFrame:
    return customers.rfm_scores(settle(_base(d), "customer_base"))


def _segment_input(d: Retail) -> DataFrame:
    return settle(_rfm(d).join(_behaviour(d), "customer_id", "left"), "segment_input")


def _channels(d: Retail) -> DataFrame:
    return customers.channel_intelligence(features.customer_features(d, FEATURE_END))


def _rules(d: Retail) -> DataFrame:
    return basket.association_rules(d.lines, min_confidence=MIN_CONFIDENCE)


def _named_rules(d: Retail) -> DataFrame:
    return basket.name_rules(_rules(d), d.menu)


query("rfm_base")(_base)
query("customer_behaviour")(_behaviour)
query("rfm_scores")(_rfm)
query("rfm_threshold_scores")(lambda d: customers.rfm_threshold_scores(settle(_base(d), "customer_base")))
query("rfm_distribution")(lambda d: customers.rfm_distribution(_rfm(d)))
query("kmeans_search")(lambda d: customers.kmeans_search(settle(_base(d), "customer_base")))
query("segment_customers")(lambda d: customers.segment_customers(_segment_input(d)))
@query("segment_checks")
def _(d: Retail) -> DataFrame:
    """Every customer in the cluster of the nearest centre, and all clusters in use."""
    clustered, centres = customers.fit_segments(_segment_input(d))
    ready = settle(clustered.select("customer_id", "cluster", vector_to_array("features").alias("x")), "segments")
    return checks.cluster_checks(ready, centres, "x", "customer_id")


query("segment_profiles")(lambda d: customers.segment_profiles(customers.segment_customers(_segment_input(d))))
query("segment_profiles_by_score")(
    lambda d: customers.segment_profiles(_segment_input(d).withColumn("cluster", F.col("rfm_sum")))
)
query("channel_intelligence")(_channels)
query("dashboard_channel_share")(lambda d: customers.channel_share(_channels(d)))
query("churned_customers")(lambda d: customers.churned_customers(d.orders, DATA_END))
query("basket_singles")(lambda d: basket.basket_singles(d.lines))
query("basket_pairs")(lambda d: basket.basket_pairs(d.lines))
query("basket_rules")(_rules)
query("basket_rules_named")(_named_rules)
query("basket_top20")(lambda d: basket.top_rules(_named_rules(d)))
query("basket_bundles")(lambda d: basket.bundle_suggestions(_named_rules(d)))

SET_SUPPORT = 0.0002  # so that the driver data have frequent sets of three


def _itemsets(d: Retail) -> DataFrame:
    return itemsets.frequent_itemsets(d.lines, SET_SUPPORT)


@query("basket_itemsets")
def _(d: Retail) -> DataFrame:
    return itemsets.as_text(_itemsets(d))


@query("basket_itemset_rules")
def _(d: Retail) -> DataFrame:
    sets = _itemsets(d)
    n = basket.baskets(d.lines).agg(F.countDistinct("order_id")).first()[0]
    return itemsets.as_text(itemsets.itemset_rules(sets, n, MIN_CONFIDENCE), ("antecedent", "consequent"))

for _name, _by in {
    "hour": ["hour"],
    "day": ["dow"],
    "weekend": ["weekend"],
    "month": ["month"],
    "location": ["restaurant_id"],
    "location_hour": ["restaurant_id", "hour"],
    "channel": ["order_channel"],
    "channel_hour": ["order_channel", "hour"],
}.items():
    query(f"peaks_{_name}")(lambda d, by=_by: peaks.peaks(d.orders, by))
query("peaks_summary")(lambda d: peaks.peaks_summary(d.orders))
query("revenue_by_restaurant")(lambda d: peaks.revenue_by_restaurant(features.order_features(d)))


# ---- wastage, prices, promotions -------------------------------------------
def _risk(d: Retail) -> DataFrame:
    return wastage.wastage_risk_features(d.wastage, d.orders, d.lines)


def _risk_split(d: Retail) -> DataFrame:
    return wastage.wastage_label_split(settle(_risk(d), "risk_features"))


def _daily(d: Retail) -> DataFrame:
    return pricing.daily_item_sales(d.orders, d.lines)


def _elasticity(d: Retail) -> DataFrame:
    return pricing.price_elasticity(_daily(d))


def _effectiveness(d: Retail, **options: bool) -> DataFrame:
    return promotions.promo_effectiveness(d.orders, d.lines, d.promotions, d.promotion_items, d.wastage, **options)


def _traps(d: Retail) -> DataFrame:
    return promotions.promo_traps(_effectiveness(d))


for _name, _by in {"item": "item", "category": "category", "location": "location", "day": "dow", "time": "time", "reason": "reason"}.items():
    query(f"wastage_by_{_name}")(lambda d, by=_by: wastage.wastage_by(d.wastage, by, d.menu, d.categories))
query("wastage_vs_demand")(lambda d: wastage.wastage_vs_demand(d.wastage, d.orders, d.lines))
query("wastage_vs_promo_day")(lambda d: wastage.wastage_vs_promo_day(d.wastage, d.orders))
query("wastage_vs_inventory")(lambda d: wastage.wastage_vs_inventory(d.wastage, d.inventory))
query("wastage_risk_rule")(lambda d: wastage.wastage_risk_rule(d.wastage, d.inventory))
query("dashboard_top_wastage")(lambda d: wastage.top_wastage(wastage.wastage_by(d.wastage, "item", d.menu)))
query("wastage_risk_features")(_risk)
query("wastage_label_split")(_risk_split)
query("wastage_popularity_rank")(lambda d: wastage.popularity_rank(settle(_risk_split(d), "risk_split")))


def _risk_data(d: Retail) -> DataFrame:
    return settle(wastage.popularity_rank(settle(_risk_split(d), "risk_split")), "risk_data")


@query("wastage_risk_metrics")
def _(d: Retail) -> DataFrame:
    data = _risk_data(d)
    return wastage.risk_metrics(wastage.fit_risk_models(data), data)


@query("wastage_risk_checks")
def _(d: Retail) -> DataFrame:
    """Scores of small risk models on the validation and the test rows."""
    data, rows = _risk_data(d), []
    small = {"logistic": {"maxIter": 20}, "random_forest": {"numTrees": 10, "maxDepth": 5, "minInstancesPerNode": 1}}
    for algo, model in wastage.fit_risk_models(data, small).items():
        for part in ("val", "test"):
            scored = settle(churn.score(model, data.where(F.col("split") == part), wastage.RISK_FEATURES), f"risk_{algo}_{part}")
            keys = ["menu_item_id", "restaurant_id", "wastage_date"]
            rows.append(checks.binary_checks(scored, keys, "is_high_waste").withColumns({"model": F.lit(algo), "split": F.lit(part)}))
    return reduce(DataFrame.unionByName, rows)


@query("wastage_risk_scores")
def _(d: Retail) -> DataFrame:
    data = _risk_data(d)
    forest = {"random_forest": wastage.RISK_MODELS["random_forest"]}
    return wastage.risk_scores(wastage.fit_risk_models(data, forest)["random_forest"], data)


query("price_daily_item_sales")(_daily)
query("price_effective")(lambda d: pricing.effective_price(d.lines, d.orders, d.pricing))
query("price_elasticity")(lambda d: pricing.enrich_items(_elasticity(d), d.menu, d.ratings, d.lines))
query("price_multivariate_elasticity")(lambda d: pricing.multivariate_elasticity(_daily(d), d.orders))
query("price_vs_repeat")(lambda d: pricing.price_vs_repeat(d.lines, d.menu))
query("price_summary")(lambda d: pricing.price_summary(_elasticity(d)))
query("promo_effectiveness")(_effectiveness)
query("promo_effectiveness_midnight_end")(lambda d: _effectiveness(d, inclusive_end=False))
query("promo_traps")(_traps)
query("promo_trap_list")(lambda d: promotions.trap_list(_traps(d)))
query("promo_traps_summary")(lambda d: promotions.traps_summary(_traps(d)))
query("promo_summary")(lambda d: promotions.promo_summary(_traps(d)))
query("promo_window_share")(
    lambda d: promotions.promo_window_share(d.orders, d.lines, d.promotions, d.promotion_items)
)


# ---- cleaning --------------------------------------------------------------
MAX_DATE = "2001-06-30"


def _with_copies(d: Retail) -> DataFrame:
    """Orders plus exact copies of every tenth one."""
    return d.orders.unionByName(d.orders.where(F.col("order_id") % 10 == 0))


def _without_keys(d: Retail) -> DataFrame:
    """Orders, every seventh without its id, plus copies of every tenth one."""
    known = F.when(F.col("order_id") % 7 != 0, F.col("order_id")).alias("order_id")
    return d.orders.select(known, *d.orders.columns[1:]).unionByName(d.orders.where(F.col("order_id") % 10 == 0))


CLEANING: dict[str, Callable[[Retail], cleaning.Step]] = {
    "missing_values": lambda d: cleaning.missing_amounts(d.orders),
    "duplicate_orders": lambda d: cleaning.deduplicate(_with_copies(d), "order_id"),
    "duplicate_lines": lambda d: cleaning.deduplicate(d.lines, "order_item_id"),
    "duplicate_null_keys": lambda d: cleaning.deduplicate(_without_keys(d), "order_id"),
    "invalid_menu_prices": lambda d: cleaning.invalid_menu_prices(d.menu),
    "negative_quantities": lambda d: cleaning.negative_quantities(d.lines),
    "negative_consumption": lambda d: cleaning.negative_consumption(d.inventory),
    "invalid_dates_orders": lambda d: cleaning.invalid_dates(d.orders, "order_timestamp", MAX_DATE),
    "invalid_dates_ratings": lambda d: cleaning.invalid_dates(d.ratings, "rating_timestamp", AS_OF),
    "invalid_dates_wastage": lambda d: cleaning.invalid_dates(d.wastage, "wastage_date", MAX_DATE),
    "invalid_ratings": lambda d: cleaning.invalid_ratings(d.ratings),
    "missing_ids_orders": lambda d: cleaning.missing_ids(d.orders, "customer_id"),
    "missing_ids_lines": lambda d: cleaning.missing_ids(d.lines, "menu_item_id"),
    "invalid_restaurants": lambda d: cleaning.invalid_restaurants(d.orders, d.restaurants),
    "impossible_wastage": lambda d: cleaning.impossible_wastage(d.wastage, d.inventory),
    "incorrect_discounts": lambda d: cleaning.incorrect_discounts(d.lines),
    "units_inventory": lambda d: cleaning.inconsistent_units(d.inventory, d.menu),
    "units_wastage": lambda d: cleaning.inconsistent_units(d.wastage, d.menu),
    "orphan_lines": lambda d: cleaning.orphan_lines(d.lines, d.orders.where("order_status = 'completed'")),
    "invalid_unit_prices": lambda d: cleaning.invalid_unit_prices(d.pricing),
}
for _name, _step in CLEANING.items():
    query(f"clean_{_name}")(lambda d, step=_step: step(d)[0])
    query(f"clean_{_name}_quarantine")(lambda d, step=_step: step(d)[1])
query("clean_cancelled_orders")(lambda d: cleaning.cancelled_orders(d.orders)[0])


def _written(d: Retail) -> dict[str, DataFrame]:
    """The tables, those that are cleaned as stage tables: several steps read each, and most are joins of the driver's."""
    cleaned = {table for _, table, _, _ in cleaning.steps(AS_OF, extra=True)}
    return {t: settle(df, f"input_{t}") if t in cleaned else df for t, df in d.items()}


def _cleaned(tables: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame], DataFrame]:
    return cleaning.run_cleaning(tables, max_date=AS_OF, extra=True, stage=settle)


query("clean_log")(lambda d: _cleaned(_written(d))[2])


# ---- ratings and anomalies -------------------------------------------------
PROMO_SHIFT_DAYS = 8567  # ratings of the driver data start after the last order
HIGH, LOW = 3.05, 2.85  # item means of the driver data lie close together


def _by_item(d: Retail) -> DataFrame:
    return ratings.ratings_by_item(d.ratings, d.lines, d.menu, HIGH, LOW)


def _with_second_clicks(d: Retail) -> DataFrame:
    """Orders, and every tenth one again five minutes later under an id of its own."""
    orders = d.orders.select("order_id", "customer_id", "restaurant_id", "order_timestamp", "total_amount")
    again = orders.where(F.col("order_id") % 10 == 0).withColumns(
        {"order_id": -F.col("order_id") - 1, "order_timestamp": F.col("order_timestamp") + F.expr("INTERVAL 5 MINUTES")}
    )
    return orders.unionByName(again)


query("ratings_by_item")(_by_item)
query("rating_inconsistencies")(lambda d: ratings.rating_inconsistencies(_by_item(d)))
query("ratings_by_location")(lambda d: ratings.ratings_by_location(d.ratings, d.orders))
query("ratings_by_time")(lambda d: ratings.ratings_by_time(d.ratings))
query("ratings_by_promo_day")(lambda d: ratings.ratings_by_promo_day(d.ratings, d.orders, PROMO_SHIFT_DAYS))
query("rating_anomalies")(lambda d: ratings.rating_anomalies(d.ratings))
query("rating_burst")(lambda d: ratings.rating_burst(d.ratings, n=3))
query("sales_spike_drop")(lambda d: anomalies.sales_spike_drop(_daily(d)))
query("value_outliers")(lambda d: anomalies.value_outliers(d.events, "value", kind="event_value"))
query("order_value_outliers")(lambda d: anomalies.value_outliers(d.orders, "total_amount", k=0.4))  # totals of the driver data are spread evenly
query("order_duplicate_transactions")(lambda d: anomalies.duplicate_transactions(_with_second_clicks(d)))
query("discount_outliers")(lambda d: anomalies.discount_outliers(d.orders))
query("duplicate_transactions")(
    lambda d: anomalies.duplicate_transactions(d.events, ["user_id", "event_type"], "ts", "event_id")
)
query("unexpected_demand")(lambda d: anomalies.unexpected_demand(d.lines, d.orders))
query("weekday_spike")(lambda d: anomalies.weekday_spike(_daily(d)))
query("kpi_changes")(lambda d: anomalies.kpi_changes(d.orders))
query("rule_anomalies_combined")(
    lambda d: anomalies.rule_anomalies(anomalies.kpi_changes(d.orders, "order_channel"), "orders_change_pct >= 5 and order_channel <> '5-LOW' and revenue_change_pct > 10")
)
query("rule_anomalies")(lambda d: anomalies.rule_anomalies(anomalies.kpi_changes(d.orders), "revenue_change_pct > 20"))


# ---- churn and comparison --------------------------------------------------
COHORTS = {
    "train": ("2000-06-30", "2000-07-01", "2000-09-30"),
    "val": ("2000-08-31", "2000-09-01", "2000-10-31"),
    "test": (FEATURE_END, "2001-01-01", "2001-03-31"),
}
SQL_MODELS = ("naive", "ma7", "linear")


def _cohorts(d: Retail, spec: dict[str, tuple[str, str, str]], inclusive_end: bool = True) -> DataFrame:
    return churn.churn_cohorts(d, spec, inclusive_end, stage=settle)


def _test_cohort(d: Retail) -> DataFrame:
    return settle(_cohorts(d, {"test": COHORTS["test"]}), "churn_test")


def _some_cohorts(d: Retail, *names: str) -> DataFrame:
    """The cohorts that a query reads; lines are exploded to one row per cohort, and no cohort depends on another."""
    return settle(_cohorts(d, {name: COHORTS[name] for name in names}), "churn_cohorts")


def _rule_predictions(d: Retail) -> tuple[DataFrame, DataFrame]:
    """Two rule-based scorers of the test cohort."""
    cases = _test_cohort(d).withColumn("record_id", F.concat(F.lit("C"), F.col("customer_id").cast("string")))
    first = cases.select(
        "record_id",
        F.col("churn").alias("actual"),
        (F.col("recency") > 180).cast("int").alias("prediction"),
        F.least(F.lit(1.0), F.col("recency") / 720).alias("probability"),
    )
    second = cases.select(
        "record_id",
        F.col("churn").alias("actual"),
        (F.col("freq_recent_90d") == 0).cast("int").alias("prediction"),
        (1 / (1 + F.col("frequency"))).alias("probability"),
    )
    return first, second


def _comparison(d: Retail) -> DataFrame:
    return compare.compare_predictions(*_rule_predictions(d))


def _churn_scores(d: Retail, algo: str) -> DataFrame:
    """Model of the training cohort applied to the test cohort."""
    data = _some_cohorts(d, "train", "test")
    model = churn.train_classifier(data.where("cohort = 'train'"), algo)
    return churn.score(model, data.where("cohort = 'test'"))


query("churn_dataset")(lambda d: _cohorts(d, {"test": COHORTS["test"]}))
query("churn_dataset_midnight_end")(lambda d: _cohorts(d, {"test": COHORTS["test"]}, inclusive_end=False))
query("churn_cohorts")(lambda d: _cohorts(d, COHORTS))


@query("churn_class_weights")
def _(d: Retail) -> DataFrame:
    weighted = churn.class_weights(_test_cohort(d), "churn")
    return weighted.groupBy("churn").agg(F.count("*").alias("customers"), F.max("class_weight").alias("class_weight"))


query("churn_test_cases")(lambda d: churn.fixed_test_cases(_test_cohort(d)))
for _algo in ("logistic", "random_forest", "gradient_boosting"):
    query(f"churn_scores_{_algo}")(lambda d, algo=_algo: _churn_scores(d, algo))
query("churn_metrics")(
    lambda d: churn.binary_metrics(settle(_churn_scores(d, "logistic"), "churn_scores"))
)
query("churn_sample_predictions")(lambda d: churn.sample_predictions(_churn_scores(d, "logistic")))


SMALL_MODELS = {
    "logistic": {"maxIter": 20},
    "random_forest": {"numTrees": 20, "maxDepth": 6},
    "gradient_boosting": {"maxIter": 5, "maxDepth": 3},
}


@query("churn_checks")
def _(d: Retail) -> DataFrame:
    """Scores of small models of each kind: bounds, classes, and metrics against Spark's own."""
    data, rows = _some_cohorts(d, "train", "test"), []
    for algo, params in SMALL_MODELS.items():
        model = churn.train_classifier(data.where("cohort = 'train'"), algo, **params)
        scored = settle(churn.score(model, data.where("cohort = 'test'")), f"scores_{algo}")
        rows.append(checks.binary_checks(scored, ["customer_id"], "churn").withColumn("model", F.lit(algo)))
    return reduce(DataFrame.unionByName, rows)


@query("churn_importance_checks")
def _(d: Retail) -> DataFrame:
    train = _some_cohorts(d, "train").where("cohort = 'train'")
    found = churn.feature_importance(churn.train_classifier(train, "random_forest", **SMALL_MODELS["random_forest"]), train)
    return found.select("feature", F.col("importance").between(0, 1).alias("bounded"), (F.abs(found.agg(F.sum("importance")).scalar() - 1) < 0.002).alias("whole"))


@query("churn_feature_importance")
def _(d: Retail) -> DataFrame:
    train = _some_cohorts(d, "train").where("cohort = 'train'")
    return churn.feature_importance(churn.train_classifier(train, "random_forest"), train)


query("compare_predictions")(_comparison)
query("compare_summary")(lambda d: compare.comparison_summary(_comparison(d)))
query("compare_model_metrics")(lambda d: compare.model_metrics(_comparison(d)))
query("compare_confusion")(lambda d: churn.confusion_matrix(_comparison(d), "actual", "a_prediction"))
query("compare_disagreements")(lambda d: compare.disagreements(_comparison(d)))
@query("compare_one_sided")
def _(d: Retail) -> DataFrame:
    """The second scorer, for this query alone, knows all but every fiftieth customer."""
    first, second = _rule_predictions(d)
    return compare.one_sided(first, second.where(F.substring("record_id", 2, 20).cast("bigint") % 50 != 0))





@query("compare_churn_models")
def _(d: Retail) -> DataFrame:
    """The logistic and the forest scores of the same customers."""
    data = _some_cohorts(d, "train", "test")
    fit, test = data.where("cohort = 'train'"), data.where("cohort = 'test'")
    scores = []
    for algo in ("logistic", "random_forest"):
        scored = churn.score(churn.train_classifier(fit, algo), test).withColumn("record_id", F.col("customer_id").cast("string"))
        scores.append(settle(scored.select("record_id", F.col("churn").alias("actual"), F.col("prediction").cast("int").alias("prediction"), "probability"), f"churn_{algo}"))
    return compare.comparison_summary(compare.compare_predictions(*scores))


query("dashboard_agreement")(lambda d: compare.agreement(_comparison(d)))


# ---- forecasting -----------------------------------------------------------
def _revenue(d: Retail) -> DataFrame:
    return forecast.daily_revenue(d.orders, d.lines)


def _trend(d: Retail) -> DataFrame:
    split = forecast.chrono_split(_revenue(d), [], "date")
    return forecast.linear_trend(split, [], "revenue")


def _item_features(d: Retail) -> DataFrame:
    return forecast.item_forecast_features(forecast.item_calendar(d.orders, d.lines))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.startswith("rolling_")})


def _demand(d: Retail, level: str, models: tuple[str, ...] = SQL_MODELS, **params: float) -> DataFrame:
    series = forecast.demand_series(d.orders, d.lines, d.menu, level)
    split = forecast.demand_split(forecast.demand_features(series))
    return forecast.demand_forecast(settle(split, f"demand_{level}"), models, **params)


def _all_models(d: Retail, level: str) -> DataFrame:
    return settle(_demand(d, level, (*SQL_MODELS, "gbt")), f"demand_forecast_{level}")


def _forecast_checks(d: Retail, level: str) -> DataFrame:
    found = _all_models(d, level)
    return checks.forecast_checks(found, "pred_gradient_boosting", forecast.forecast_metrics(found), "gradient_boosting")


@query("forecast_pooled_comparison")
def _(d: Retail) -> DataFrame:
    """A boosted model per category against one over all of them."""
    found = settle(_demand(d, "category", ("naive", "gbt", "pooled"), maxIter=20), "compared")
    return forecast.forecast_summary(forecast.forecast_metrics(found), "category")


@query("forecast_evaluation")
def _(d: Retail) -> DataFrame:
    test = settle(_item_features(d).where("split = 'test'"), "forecast_test")
    predicted = test.select("menu_item_id", "date", "actual", F.round("rolling_7", 4).alias("predicted"))
    return forecast.forecast_evaluation(predicted, "menu_item_id", "seven_day_mean")


query("forecast_daily_revenue")(_revenue)
query("forecast_linear")(_trend)
query("forecast_linear_metrics")(lambda d: forecast.regression_metrics(_trend(d), "revenue", "prediction"))
query("dashboard_actual_vs_predicted")(lambda d: forecast.actual_vs_predicted(_revenue(d), _trend(d)))
query("forecast_item_calendar")(lambda d: forecast.item_calendar(d.orders, d.lines))
query("forecast_item_features")(lambda d: _rounded(_item_features(d)))
query("forecast_item_random_forest")(
    lambda d: forecast.forecast_evaluation(
        settle(forecast.item_forecast(settle(_item_features(d), "item_features")), "item_forecast"),
        "menu_item_id",
        "random_forest",
    )
)
for _level in forecast.LEVELS:
    query(f"forecast_series_{_level}")(
        lambda d, level=_level: forecast.demand_series(d.orders, d.lines, d.menu, level)
    )
    query(f"forecast_features_{_level}")(
        lambda d, level=_level: _rounded(
            forecast.demand_features(forecast.demand_series(d.orders, d.lines, d.menu, level))
        )
    )
    query(f"forecast_demand_{_level}")(lambda d, level=_level: _demand(d, level))
    query(f"forecast_metrics_{_level}")(lambda d, level=_level: forecast.forecast_metrics(_demand(d, level)))
    query(f"forecast_summary_{_level}")(
        lambda d, level=_level: forecast.forecast_summary(forecast.forecast_metrics(_demand(d, level)), level)
    )
    # the same of all four models; the boosted one has no SQL
    query(f"forecast_boosted_demand_{_level}")(lambda d, level=_level: _all_models(d, level))
    query(f"forecast_boosted_metrics_{_level}")(lambda d, level=_level: forecast.forecast_metrics(_all_models(d, level)))
    query(f"forecast_boosted_checks_{_level}")(lambda d, level=_level: _forecast_checks(d, level))
    query(f"forecast_boosted_summary_{_level}")(
        lambda d, level=_level: forecast.forecast_summary(forecast.forecast_metrics(_all_models(d, level)), level)
    )
query("forecast_gradient_boosting")(lambda d: forecast.forecast_metrics(_all_models(d, "category")))


# ---- findings, scenarios, dashboards ---------------------------------------
PARAMETERS = {
    "profit_threshold": 0.20,
    "extra_feature": "promotion_dependency",
    "forecast_window_days": 30,
    "anomaly_rule": "revenue_change_pct > 20",
    "kpi_name": "profit_margin_index",
}


def _findings(d: Retail) -> dict[str, DataFrame]:
    days = menu.item_days(d.orders, d.lines)
    profit = settle(_profit(d, days), "menu_profitability")
    slow = menu.simple_slow_movers(menu.menu_performance(profit))
    location = recommend.location_intelligence(menu.tricky_cases(profit, d.orders, d.lines, new_days=NEW_DAYS, days=days))
    channel = recommend.channel_findings(_channels(d))
    parts = {"slow": settle(slow, "slow"), "location": settle(location, "location"), "channel": settle(channel, "channel")}
    return parts | {"all": recommend.recommendations(*parts.values())}


query("location_intelligence")(lambda d: recommend.location_intelligence(_cases(d)))
query("recommendations")(lambda d: _findings(d)["all"])
query("report_of_days")(
    lambda d: recommend.filter_report(
        features.order_features(d), {"order_status": "completed"}, {"order_total": 100}, {"basket_size": 5}, ("order_timestamp", "1996-03-05", "1996-04-02")
    ).select("order_id", "order_timestamp", "order_channel", "basket_size", F.col("order_total").cast("double").alias("order_total"))
)
query("recommendation_search")(
    lambda d: recommend.search_recommendations(_findings(d)["all"], priority="Medium", q="Econ")
)
query("what_if")(lambda d: recommend.what_if(_items(d)))
query("what_if_top_item")(lambda d: recommend.what_if(recommend.top_item(_items(d))))
query("above_profit_threshold")(
    lambda d: recommend.above_profit_threshold(_items(d).select("menu_item_id", "profit_pct"))
)
query("parameter_readiness")(lambda d: recommend.readiness(_items(d), PARAMETERS))


@query("result_counts")
def _(d: Retail) -> DataFrame:
    f = _findings(d)
    return recommend.result_counts(
        {
            "recommendations": f["all"],
            "slow_moving": f["slow"],
            "location_intelligence": f["location"],
            "channel_intelligence": f["channel"],
        }
    )


query("dashboard_class_distribution")(lambda d: menu.class_counts(_performance(d), "performance_class"))
query("dashboard_top_revenue")(
    lambda d: recommend.top_by_revenue(_performance(d), "Volume Driver", min_revenue=1000, max_wastage=0.75)
)
query("dashboard_top_wastage_share")(lambda d: recommend.top_wastage_share(_performance(d)))


# ---- menu-class models -----------------------------------------------------
def _training(d: Retail) -> DataFrame:
    items = _items(d)
    return models.training_data(items, menu.menu_classification(items))


def _registry(d: Retail) -> DataFrame:
    """Registry rows from the training data: one version per class, split and category."""
    rows = _training(d).groupBy(
        F.col("menu_class").alias("name"), F.col("split").alias("version"), F.col("category_name").alias("track")
    ).agg(F.count("*").alias("items"), F.max("menu_item_id").alias("trained_at"))
    first = settle(recommend.model_registry(None, rows.where("version = 'train'")), "registry")
    return recommend.model_registry(first, rows)


def _model_metrics(d: Retail) -> DataFrame:
    data = settle(_training(d), "training_data")
    return models.compare_models(models.fit_models(data), data)


query("model_training_data")(_training)
query("model_comparison")(_model_metrics)
query("model_registry")(_registry)


@query("model_registry_fitted")
def _(d: Retail) -> DataFrame:
    """The fitted class models with their scores on the test items."""
    rows = _model_metrics(d).where("split = 'test'").withColumnRenamed("model", "name")
    named = rows.select("name", F.lit("1").alias("version"), F.lit("menu_class").alias("track"), F.lit(DATA_END).alias("trained_at"), "accuracy", "f1")
    return recommend.latest_models(recommend.model_registry(None, named))


def _lasting_registry(d: Retail) -> Registry:
    """A registry filled from the item categories, with repeated and overtaken requests."""
    made = Registry(d.spark, stage_path(d.spark, "registry"), lambda: datetime(2024, 1, 1, tzinfo=timezone.utc))
    counts = d.menu.groupBy("category_id").agg(F.count("*").alias("n"), F.max("menu_item_id").alias("top"))
    for row in counts.where(F.col("category_id").isNotNull()).orderBy("category_id").limit(8).collect():
        for version in (9, 10, 9):
            try:
                made.register(f"category {row.category_id}", str(version), "spark", {"items": row.n}, active=version == 10 and row.top % 2 == 0)
            except DuplicateVersion:
                made.activate(f"category {row.category_id}", str(version), "spark")
    return made


@query("model_registry_lasting")
def _(d: Retail) -> DataFrame:
    """Versions with their place by number and the active one: the repeated request activates the version it names."""
    rows = _lasting_registry(d).history()
    return rows.select("name", "version", "pipeline", F.col("metrics")["items"].cast("long").alias("items"), "is_active", "place", "registered")


query("model_latest")(lambda d: recommend.latest_models(_registry(d)))


@query("model_verification")
def _(d: Retail) -> DataFrame:
    data = settle(_training(d), "training_data")
    path = stage_path(d.spark, "model")
    models.fit_models(data, ("decision_tree",))["decision_tree"].write().save(path)
    return models.verify_model(path, data)


@query("model_comparison_checks")
def _(d: Retail) -> DataFrame:
    """The class models' metrics against Spark's own, on the validation and the test items."""
    data = settle(_training(d), "training_data")
    fitted = models.fit_models(data)
    own = {(r.model, r.split): r for r in models.compare_models(fitted, data).collect()}  # two rows a model
    rows = []
    for name, model in fitted.items():
        for split in ("validation", "test"):
            scored = settle(model.transform(data.where(F.col("split") == split)).select("label", "prediction"), f"{name}_{split}")
            rows.append((name, split, *checks.multiclass_checks(scored, own[name, split].asDict())))
    return d.spark.createDataFrame(rows, "model string, split string, rows long, scored boolean, metrics_agree boolean")


@query("model_handoff_checks")
def _(d: Retail) -> DataFrame:
    """Components, models, metric names and status of the handoff, and whether the metrics are known."""
    found = _handoff(d)
    return found.select("component", "model", "metric_1_name", "metric_2_name", "status", (F.col("metric_1").isNotNull() & F.col("metric_2").isNotNull()).alias("known"))


def _handoff(d: Retail) -> DataFrame:
    daily = forecast.regression_metrics(_trend(d), "revenue", "prediction").withColumn("model", F.lit("linear_trend"))
    tested = _model_metrics(d).where("split = 'test'")
    return models.handoff_summary(
        {
            "Menu classification": (tested, "model", "accuracy", "f1"),
            "Revenue forecast": (daily, "model", "mae", "rmse"),
        }
    )


query("model_handoff_summary")(_handoff)


# ---- sources and sinks -----------------------------------------------------
def _csv_dir(d: Retail, table: str, df: DataFrame | None = None) -> str:
    folder = stage_path(d.spark, "csv")
    writers.write_csv(df if df is not None else d[table], f"{folder}/{table}.csv")
    return folder


def _csv(d: Retail, table: str, as_float: str | None = None) -> DataFrame:
    df = d[table] if as_float is None else d[table].withColumn(as_float, F.col(as_float).cast("double"))
    return readers.read_table_csv(d.spark, _csv_dir(d, table, df), table)


query("source_csv_orders")(lambda d: _csv(d, "Orders"))
query("source_csv_lines")(lambda d: _csv(d, "Order_Items", "menu_item_id"))


@query("source_parse_failures")
def _(d: Retail) -> DataFrame:
    total = F.when(F.col("order_status") == "pending", "n/a").otherwise(F.col("total_amount").cast("string"))
    folder = _csv_dir(d, "Orders", d.orders.withColumn("total_amount", total))
    columns = schemas.schema("Orders")
    return readers.parse_failures(readers.read_raw_csv(d.spark, f"{folder}/Orders.csv", columns), columns)


query("source_infer_schema")(lambda d: readers.infer_schema(d.spark, f"{_csv_dir(d, 'Orders')}/Orders.csv"))


@query("source_validate_types")
def _(d: Retail) -> DataFrame:
    folder = stage_path(d.spark, "tables")
    writers.write_table(d.orders, folder, "ORDERS.parquet")
    return readers.validate_types(readers.read_table(d.spark, folder, "Orders"), schemas.schema("Orders"))


@query("source_validate_types_all")
def _(d: Retail) -> DataFrame:
    """Declared against stored types of every table, written under names of another case."""
    folder, parts = stage_path(d.spark, "tables"), []
    for name in schemas.TABLES:
        writers.write_table(d[name], folder, f"{name.upper()}.parquet")
        parts.append(readers.validate_types(readers.read_table(d.spark, folder, name), schemas.schema(name)).withColumn("table", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query("source_parse_failures_all")
def _(d: Retail) -> DataFrame:
    """Cells that a type can't hold, in every table: each seventh key has a text in the first other column that isn't one."""
    parts = []
    for name in schemas.TABLES:
        columns = schemas.schema(name)
        key, *rest = columns.fields
        typed = [f.name for f in rest if f.dataType.simpleString() != "string"]
        raw = d[name]
        if typed:
            raw = raw.withColumn(typed[0], F.when(F.col(key.name) % 7 == 0, "n/a").otherwise(F.col(typed[0]).cast("string")))
        text = readers.read_raw_csv(d.spark, f"{_csv_dir(d, name, raw)}/{name}.csv", columns)
        parts.append(readers.parse_failures(text, columns).withColumn("table", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


query("source_ingestion_report")(readers.ingestion_report)
query("source_profile_orders")(lambda d: readers.profile(d.orders))


@query("sink_readback")
def _(d: Retail) -> DataFrame:
    return writers.check_written(d.spark, writers.write_measured(d.lines, stage_path(d.spark, "tables"), "Order_Items"))


@query("sink_measured")
def _(d: Retail) -> DataFrame:
    """Every table, counted while it was written and checked against what is read back."""
    folder, parts = stage_path(d.spark, "measured"), []
    for name in schemas.TABLES:
        w = writers.write_measured(d[name], folder, name)
        parts.append(writers.check_written(d.spark, w).select(F.lit(name).alias("table"), "rows_in", F.lit(w.columns).alias("n_cols"), "ok", F.lit(w.seconds > 0).alias("timed")))
    return reduce(DataFrame.unionByName, parts)


def _broken_csv(d: Retail) -> tuple[DataFrame, DataFrame]:
    """The orders as CSV, some lines cut, lengthened or with an open quote, read back."""
    line = F.to_csv(F.struct(*d.orders.columns), {"nullValue": ""})
    kind = F.col("order_id") % 40
    damaged = (
        F.when(kind == 1, F.regexp_replace(line, ",[^,]*$", ""))
        .when(kind == 2, F.concat(line, F.lit(",surplus")))
        .when(kind == 3, F.concat(F.lit('"'), line))
        .otherwise(line)
    )
    path = stage_path(d.spark, "broken")
    d.orders.select(damaged.alias("value")).write.text(path)
    return readers.read_checked_csv(d.spark, path, schemas.schema("Orders"))


@query("source_broken_lines")
def _(d: Retail) -> DataFrame:
    good, broken = _broken_csv(d)
    counted = broken.groupBy("reason", "n_fields").agg(F.count("*").alias("lines"))
    typed = good.agg(F.lit("none").alias("reason"), F.lit(len(good.columns)).alias("n_fields"), F.count("*").alias("lines"))
    return counted.unionByName(typed)


query("source_unbroken_orders")(lambda d: _broken_csv(d)[0])


@query("promo_sales_by_month")
def _(d: Retail) -> DataFrame:
    """Orders within each campaign and their total, from a table partitioned by month of which only touched months are read."""
    folder = stage_path(d.spark, "months")
    writers.write_partitioned(d.orders, folder, "Orders", "order_timestamp", salt="order_id")
    campaigns = settle(d.promotions.select(F.col("promotion_id").alias("campaign"), "start_date", "end_date"), "campaigns")
    sold = writers.in_windows(d.spark.read.parquet(f"{folder}/Orders"), campaigns, "order_timestamp", "start_date", "end_date")
    return sold.groupBy("campaign").agg(F.count("*").alias("orders"), F.sum("total_amount").alias("total"))


@query("join_bucketed")
def _(d: Retail) -> DataFrame:
    """Lines and orders in buckets of the order, joined and summed up per order status without an exchange of either."""
    lines, orders = _bucketed(d)
    joined = lines.join(orders, "order_id")
    return joined.groupBy("order_status").agg(F.count("*").alias("lines"), F.sum("line_total").alias("total"))


def _bucketed(d: Retail, buckets: int = 32) -> tuple[DataFrame, DataFrame]:
    made = []
    for df in (d.lines, d.orders):
        name = f"larder_{uuid.uuid4().hex}"
        made.append(writers.write_bucketed(df, stage_path(d.spark, "bucketed"), "order_id", name, buckets))
    return made[0], made[1]


QUANTILES = {"q25": 0.25, "q50": 0.5, "q90": 0.9}


def _sketches(d: Retail) -> tuple[DataFrame, DataFrame]:
    """Amounts per item and month, and their sketches as a stored table."""
    sold = features.sales(d.orders, d.lines).where(F.col("menu_item_id").isNotNull())
    sold = settle(sold.select("menu_item_id", F.trunc("date", "month").alias("month"), "line_total"), "amounts")
    return sold, settle(sketches.quantile_sketches(sold, ["menu_item_id", "month"], "line_total"), "sketches")


@query("sketch_months")
def _(d: Retail) -> DataFrame:
    """The number of values in each stored sketch."""
    return _sketches(d)[1].select("menu_item_id", "month", F.kll_sketch_get_n_double("sketch").alias("n"))


@query("sketch_quantiles")
def _(d: Retail) -> DataFrame:
    """Per item, merged from the stored months: are the quantiles' exact ranks within the bound, in either order of merging?

    The bound is twice the one of 99 %, which one in millions misses.
    """
    sold, stored = _sketches(d)
    error, flags = 2 * sketches.rank_error(), []
    by_year = sketches.merge_sketches(stored.withColumn("year", F.year("month")), ["menu_item_id", "year"])
    for n, merged in enumerate((sketches.merge_sketches(stored, ["menu_item_id"]), sketches.merge_sketches(by_year, ["menu_item_id"]))):
        found = sketches.sketch_quantiles(settle(merged, "merged"), QUANTILES)
        held = sketches.ranks_hold(sold, ["menu_item_id"], "line_total", found, QUANTILES, error)
        flags.append(held.select("menu_item_id", *(["n"] if n == 0 else []), *(F.col(q).alias(f"{q}_{'months' if n == 0 else 'years'}") for q in QUANTILES)))
    return flags[0].join(flags[1], "menu_item_id")


@query("sink_partitioned_orders")
def _(d: Retail) -> DataFrame:
    path = writers.write_partitioned(d.orders, stage_path(d.spark, "tables"), "Orders", "order_timestamp", salt="order_id")
    return d.spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(F.count("*").alias("orders"))


@query("sink_json_report")
def _(d: Retail) -> DataFrame:
    report = menu.class_counts(d.orders, "order_status").withColumnRenamed("items", "orders")
    return d.spark.read.schema(report.schema).json(writers.write_json(report, stage_path(d.spark, "report")))


@query("sink_csv_extract")
def _(d: Retail) -> DataFrame:
    path = writers.Reports({"channels": lambda: _channels(d)}).extract("channels", stage_path(d.spark, "extract"))
    read = d.spark.read.option("header", True).csv(path)
    return read.select("preferred_channel", *[F.col(c).cast("bigint").alias(c) for c in ("customers", "orders")])


query("sink_sample_export")(lambda d: writers.export_sample(d.orders, "order_id"))
query("source_profile_all")(lambda d: readers.profile_tables(d))
query("sink_sample_export_all")(lambda d: writers.export_samples(d, stage_path(d.spark, "samples")))


@query("sink_quarantine")
def _(d: Retail) -> DataFrame:
    """Every quarantine of the cleaning run, written and counted by its reason."""
    folder = stage_path(d.spark, "rejected")
    paths = [writers.write_quarantine(df, folder, name) for name, df in _cleaned(_written(d))[1].items()]
    parts = [d.spark.read.parquet(p).groupBy("reason").agg(F.count("*").alias("n")) for p in paths]
    return reduce(DataFrame.unionByName, parts).groupBy("reason").agg(F.sum("n").alias("rows"))


@query("sink_publish")
def _(d: Retail) -> DataFrame:
    target = StructType.fromDDL("finding string, action string, priority string, menu_item_id bigint, score double")
    path = stage_path(d.spark, "published")
    return d.spark.read.parquet(writers.publish(_findings(d)["all"], path, target))


@query("sink_published_version")
def _(d: Retail) -> DataFrame:
    """Two versions of the orders, the second narrower; a third run fails and changes nothing."""
    target = StructType.fromDDL("order_id bigint, order_status string, total_amount decimal(12,2)")
    table = writers.Published(d.spark, stage_path(d.spark, "versions"))
    table.publish(d.orders, target)
    table.publish(d.orders.where("order_status = 'completed'"), target)
    try:
        table.publish(d.orders.withColumn("order_status", F.raise_error(F.lit("the source broke"))), target)
    except PySparkException:
        pass
    return table.read()


@query("sink_rejected_casts")
def _(d: Retail) -> DataFrame:
    target = StructType.fromDDL("order_id bigint, order_status int, order_channel bigint, total_amount decimal(12,2)")
    table = writers.Published(d.spark, stage_path(d.spark, "versions"))
    table.publish(d.orders, target)
    return table.read("rejected")


# ---- validation ------------------------------------------------------------
CHANNEL_NAMES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
NEW_ITEM_DAYS = 2370  # close to the whole period, so that some items count as new


def _feature_tables(d: Retail) -> dict[str, DataFrame]:
    return {
        "item": _items(d),
        "customer": features.customer_features(d, FEATURE_END),
        "order": features.order_features(d),
        "location_item": features.location_item_features(d),
    }


def _patterns(d: Retail) -> DataFrame:
    return validation.item_patterns(d, DATA_END, NEW_ITEM_DAYS)


query("validation_rows")(validation.check_rows)
query("validation_columns")(validation.check_columns)
query("validation_nulls")(validation.check_nulls)
query("validation_dates")(lambda d: validation.check_dates(d.orders, FEATURE_END, "2001-01-01"))
query("validation_active_months")(lambda d: validation.active_months(d.orders))
query("validation_summary")(
    lambda d: validation.check_summary(
        [validation.check_rows(d), validation.check_columns(d), validation.check_nulls(d)]
    )
)
query("validation_keys")(validation.check_keys)
query("validation_foreign_keys")(validation.check_fks)
query("validation_formulas")(validation.check_amounts)
query("validation_domains")(
    lambda d: validation.check_domain(d.orders, "order_channel", CHANNEL_NAMES).unionByName(
        validation.check_domain(d.orders, "order_status", ("completed", "cancelled"))
    )
)
query("validation_targets")(lambda d: validation.check_rating_targets(d.ratings, d.promotions))
query("validation_parity")(
    lambda d: validation.check_parity({t: (_csv(d, t), d[t]) for t in schemas.TABLES})
)
query("validation_registration")(lambda d: validation.orders_before_registration(d.orders, d.customers))
query("validation_demand_patterns")(lambda d: validation.check_demand_patterns(d.orders))
query("validation_business_cases")(validation.check_business_cases)
query("validation_spike_items")(lambda d: validation.spike_and_drop_items(_daily(d)))
query("validation_rating_concentration")(lambda d: validation.rating_concentration(d.ratings, sigmas=2))
query("validation_promotions")(lambda d: validation.promotion_checks(d, DATA_START, DATA_END))
query("validation_item_patterns")(_patterns)
query("validation_pattern_counts")(lambda d: validation.pattern_counts(_patterns(d)))
query("validation_features")(lambda d: validation.check_features(_feature_tables(d)))
@query("validation_clean_layer")
def _(d: Retail) -> DataFrame:
    raw = _written(d)
    return validation.check_clean_layer(raw, _cleaned(raw)[0])


@query("validation_stages")
def _(d: Retail) -> DataFrame:
    raw = _written(d)
    clean = _cleaned(raw)[0]
    return validation.stage_consistency(raw, clean, features.order_features(clean))


query("validation_difficult_cases")(validation.difficult_cases)
