"""Daily series, chronological splits, simple forecasts, tree forecasts and their evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import with_scalars
from larder.functions.scalar import dbl
from larder.functions.series import dense_calendar, lag_features, rolling_features, running_index
from larder.operators.boosting import boosted_per_entity
from larder.operators.features import sales


def valid_sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Completed lines with positive quantity and price and a non-negative total."""
    good = lines.where((F.col("quantity") > 0) & (F.col("unit_price") > 0) & (F.col("line_total") >= 0))
    return sales(orders.where(F.col("order_status") == "completed"), good)


def daily_revenue(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue, orders and running day number; one row per day, so the numbering window is bounded by the calendar."""
    per_order = valid_sales(orders, lines).groupBy("date", "order_id").agg(F.sum("line_total").alias("r"))
    daily = per_order.groupBy("date").agg(dbl(F.sum("r")).alias("revenue"), F.count("*").alias("order_count"))
    return running_index(daily.withColumn("_all", F.lit(0)), ["_all"], "date").drop("_all")


def chrono_split(
    df: DataFrame, entity: Sequence[str], order: str, n_train: int | None = None, n_test: int | None = None, frac: float = 0.8
) -> DataFrame:
    """Add ``split`` = train or test by position in time.

    ``n_train`` takes the first rows for training and ``n_test`` the ones after (or, alone, the last
    rows of every entity) for testing; otherwise the first ``frac`` of each entity trains.
    """
    keys = list(entity) or ["_all"]
    rows = df if entity else df.withColumn("_all", F.lit(0))
    w = Window.partitionBy(*keys)
    rows = rows.withColumns({"_rn": F.row_number().over(w.orderBy(order)), "_n": F.count("*").over(w)})
    if n_train is not None:
        rows = rows.where(F.col("_rn") <= n_train + (n_test or 0)) if n_test is not None else rows
        train = F.col("_rn") <= n_train
    elif n_test is not None:
        train = F.col("_rn") <= F.col("_n") - n_test
    else:
        train = F.col("_rn") <= F.floor(F.col("_n") * frac)
    return rows.withColumn("split", F.when(train, "train").otherwise("test")).drop("_rn", "_n", "_all")


def linear_trend(split: DataFrame, entity: Sequence[str], value: str, index: str = "time_index", digits: int = 2) -> DataFrame:
    """Test rows with the straight line fitted to the training rows of their entity."""
    fit = split.where("split = 'train'").groupBy(*entity).agg(
        F.regr_slope(dbl(value), dbl(index)).alias("_slope"), F.regr_intercept(dbl(value), dbl(index)).alias("_start")
    )
    test = split.where("split = 'test'")
    fitted = test.join(fit, list(entity), "left") if entity else with_scalars(test, fit)
    line = F.col("_start") + F.col("_slope") * F.col(index)
    return fitted.withColumn("prediction", F.round(line, digits)).drop("_slope", "_start", "split")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, MAPE over non-zero actuals and R2."""
    known = df.where(F.col(predicted).isNotNull())
    err = F.col(actual) - F.col(predicted)
    spread = F.var_pop(actual) * F.count("*")
    measures = [
        F.count("*").alias("rows"),
        F.round(F.avg(F.abs(err)), 2).alias("mae"),
        F.round(F.sqrt(F.avg(err * err)), 2).alias("rmse"),
        F.round(F.avg(F.when(F.col(actual) != 0, F.abs(err / F.nullif(F.col(actual), F.lit(0.0))))) * 100, 2).alias("mape"),
        F.round(F.when(spread > 0, 1 - F.sum(err * err) / spread), 4).alias("r2"),
    ]
    return known.groupBy(*by).agg(*measures) if by else known.agg(*measures)


def item_calendar(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue per item and day with zero rows on days without sales."""
    daily = (
        valid_sales(orders, lines)
        .where(F.col("menu_item_id").isNotNull())
        .groupBy("menu_item_id", "date")
        .agg(dbl(F.sum("line_total")).alias("actual"))
    )
    return dense_calendar(daily, "menu_item_id", "date", ["actual"])


ITEM_FEATURES = ("lag_1", "lag_7", "rolling_7", "rolling_14", "day_of_week", "month", "time_index")


def item_forecast_features(calendar: DataFrame) -> DataFrame:
    """Lags, rolling means, calendar parts and the 80/20 split; rows without a week of history are left out."""
    df = running_index(calendar, ["menu_item_id"], "date")
    df = lag_features(df, ["menu_item_id"], "date", "actual", (1, 7))
    df = rolling_features(df, ["menu_item_id"], "date", "actual", mean=(7, 14), std=())
    df = df.withColumnsRenamed({"rolling_mean_7": "rolling_7", "rolling_mean_14": "rolling_14"}).withColumns(
        {"day_of_week": F.weekday("date"), "month": F.month("date")}
    )
    ready = df.dropna(subset=["lag_1", "lag_7", "rolling_7", "rolling_14"])
    return chrono_split(ready, ["menu_item_id"], "date", frac=0.8)


def _assembled(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def item_forecast(features: DataFrame, seed: int = DEFAULTS.seed, **params: float) -> DataFrame:
    """Random-forest forecast of the test rows, never below zero."""
    forest = {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 3, **params}
    ready = features.withColumns({c: dbl(c) for c in ITEM_FEATURES})
    model = Pipeline(
        stages=[_assembled(ITEM_FEATURES), RandomForestRegressor(featuresCol="features", labelCol="actual", seed=seed, **forest)]
    ).fit(ready.where("split = 'train'"))
    return model.transform(ready.where("split = 'test'")).select(
        "menu_item_id", "date", "actual", F.greatest(F.lit(0.0), F.col("prediction")).alias("predicted")
    )


LEVELS = {"item": "menu_item_id", "category": "category_id", "location": "restaurant_id"}


def demand_series(orders: DataFrame, lines: DataFrame, menu: DataFrame, level: str) -> DataFrame:
    """Completed quantity per entity and sale day (days without sales have no row).

    Quantities are summed per item first, so category totals never join raw lines to the menu.
    """
    key = LEVELS[level]
    s = sales(orders.where(F.col("order_status") == "completed"), lines)
    if level == "category":
        per_item = s.groupBy("menu_item_id", "date").agg(F.sum("quantity").alias("quantity"))
        s = per_item.join(menu.select("menu_item_id", "category_id"), "menu_item_id")
    return (
        s.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("entity_id"), "date")
        .agg(dbl(F.sum("quantity")).alias("qty"))
    )


def demand_features(series: DataFrame) -> DataFrame:
    df = running_index(series, ["entity_id"], "date")
    df = lag_features(df, ["entity_id"], "date", "qty")
    df = rolling_features(df, ["entity_id"], "date", "qty")
    return df.withColumns(
        {
            "dow": F.weekday("date"),
            "is_weekend": (F.weekday("date") >= 5).cast("int"),
            "month": F.month("date"),
            "week_of_year": F.weekofyear("date"),
        }
    )


# fixed values: columns of the demand models
DEMAND_FEATURES = (
    "time_index",
    "dow",
    "is_weekend",
    "month",
    "week_of_year",
    "lag_1",
    "lag_7",
    "lag_14",
    "lag_28",
    "rolling_mean_7",
    "rolling_mean_14",
    "rolling_mean_28",
    "rolling_std_7",
    "rolling_std_28",
)


def demand_split(features: DataFrame, n_test: int = 73, min_train: int = 20) -> DataFrame:
    """The last ``n_test`` rows of each entity test; entities with too little history are left out."""
    ready = features.where(F.col("lag_1").isNotNull() & F.col("qty").isNotNull())
    enough = F.count("*").over(Window.partitionBy("entity_id")) >= n_test + min_train
    return chrono_split(ready.withColumn("_ok", enough).where("_ok").drop("_ok"), ["entity_id"], "date", n_test=n_test)


def _pooled(split: DataFrame, seed: int, **params: float) -> DataFrame:
    """One boosted model over all entities, with the entity's training mean as a further feature; no rows if no entity has history."""
    means = split.where("split = 'train'").groupBy("entity_id").agg(F.avg("qty").alias("entity_mean"))
    cols = [*DEMAND_FEATURES, "entity_mean"]
    ready = split.join(means, "entity_id").withColumns({c: F.coalesce(dbl(c), F.lit(0.0)) for c in cols})
    if split.isEmpty():
        return split.select("entity_id", "date", F.lit(0.0).alias("pred_pooled_boosting"))
    boost = {"maxIter": 200, "maxDepth": 3, "stepSize": 0.05, **params}
    model = Pipeline(
        stages=[_assembled(cols), GBTRegressor(featuresCol="features", labelCol="qty", seed=seed, **boost)]
    ).fit(ready.where("split = 'train'"))
    return model.transform(ready.where("split = 'test'")).select(
        "entity_id", "date", F.round(F.greatest(F.lit(0.0), F.col("prediction")), 4).alias("pred_pooled_boosting")
    )


def _per_entity(split: DataFrame, **params: float) -> DataFrame:
    """A boosted model for each entity."""
    found = boosted_per_entity(split, DEMAND_FEATURES, "qty", **params)
    return found.select("entity_id", "date", F.round(F.greatest(F.lit(0.0), F.col("prediction")), 4).alias("pred_gradient_boosting"))


def demand_forecast(
    split: DataFrame,
    models: Sequence[str] = ("naive", "ma7", "linear", "gbt"),
    seed: int = DEFAULTS.seed,
    rounds: int = 200,
    depth: int = 3,
    rate: float = 0.05,
    **params: float,
) -> DataFrame:
    """Test rows with one prediction column per model.

    `gbt` is a boosted model for each entity, of `rounds` trees; `pooled` is one over all entities, with `params`.
    """
    line = linear_trend(split, ["entity_id"], "qty", digits=12)
    columns: dict[str, Column] = {
        "naive": F.round("lag_1", 4).alias("pred_naive"),
        "ma7": F.round("rolling_mean_7", 4).alias("pred_moving_avg"),
        "linear": F.round(F.greatest(F.lit(0.0), F.col("prediction")), 4).alias("pred_linear"),
    }
    out = line.select("entity_id", "date", F.col("qty").alias("actual_qty"), *[columns[m] for m in models if m in columns])
    if "gbt" in models:
        out = out.join(_per_entity(split, rounds=rounds, depth=depth, rate=rate), ["entity_id", "date"])
    if "pooled" in models:
        out = out.join(_pooled(split, seed, **params), ["entity_id", "date"])
    return out


MODEL_NAMES = {
    "pred_naive": "naive_baseline",
    "pred_moving_avg": "moving_average",
    "pred_linear": "linear_regression",
    "pred_gradient_boosting": "gradient_boosting",
    "pred_pooled_boosting": "pooled_gradient_boosting",
}


def forecast_metrics(predictions: DataFrame) -> DataFrame:
    """Metrics per entity and model, from one pass over the predictions in long form."""
    models = F.array(
        *[
            F.struct(F.lit(n).alias("model"), F.col(c).alias("predicted"))
            for c, n in MODEL_NAMES.items()
            if c in predictions.columns
        ]
    )
    long = predictions.select("entity_id", "actual_qty", F.explode(models).alias("e")).select(
        "entity_id", "actual_qty", "e.*"
    )
    return regression_metrics(long, "actual_qty", "predicted", ["entity_id", "model"]).drop("rows")


def forecast_summary(metrics: DataFrame, level: str) -> DataFrame:
    return metrics.groupBy("model").agg(
        F.lit(level).alias("level"),
        F.countDistinct("entity_id").alias("n_entities"),
        *[F.round(F.avg(m), d).alias(f"avg_{m}") for m, d in (("mae", 2), ("rmse", 2), ("mape", 2), ("r2", 4))],
    )


def forecast_evaluation(predictions: DataFrame, entity: str, model: str) -> DataFrame:
    """Metrics of ``predicted`` and of the previous-value baseline, with the improvement over the baseline."""
    w = Window.partitionBy(entity).orderBy("date")
    rows = predictions.withColumn("_base", F.lag("actual").over(w))
    both = reduce(
        DataFrame.unionByName,
        [
            regression_metrics(rows, "actual", c).withColumn("model", F.lit(n))
            for c, n in (("predicted", model), ("_base", "previous_value_baseline"))
        ],
    )
    base = both.where(F.col("model") == "previous_value_baseline").agg(
        F.struct(*[F.max(m).alias(m) for m in ("mae", "rmse", "mape")]).alias("b")
    )
    judged = both.withColumn("_b", base.scalar())
    for m in ("mae", "rmse", "mape"):
        gain = (F.col(f"_b.{m}") - F.col(m)) / F.nullif(F.col(f"_b.{m}"), F.lit(0.0)) * 100
        judged = judged.withColumn(f"{m}_improvement_pct", F.round(gain, 2))
    return judged.withColumn(
        "beats_baseline", (F.col("mae") < F.col("_b.mae")) & (F.col("rmse") < F.col("_b.rmse"))
    ).drop("_b")


def actual_vs_predicted(daily: DataFrame, predictions: DataFrame) -> DataFrame:
    """Actual revenue with the prediction of the same day, where there is one."""
    return daily.select("date", F.col("revenue").alias("actual"), "order_count").join(
        predictions.select("date", "prediction"), "date", "left"
    )
