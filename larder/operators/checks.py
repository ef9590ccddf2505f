"""Checks of fitted models: what their scores must satisfy, and their metrics computed a second way.

Scores differ between machines in their last digits, so they aren't compared with stored ones. Instead: every row is
scored once, values lie in their bounds, classes follow the probabilities, and the metrics of the library equal those of
Spark's own evaluators.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalar import dbl
from larder.operators.churn import binary_metrics

CLOSE = 1e-4  # metrics are rounded to four digits


def _agree(a: float | None, b: float | None) -> bool:
    return a is not None and b is not None and abs(a - b) <= CLOSE


def binary_checks(scored: DataFrame, keys: Sequence[str], label: str, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """One row: rows, distinct keys, positives, and whether bounds, classes and metrics are right."""
    own = binary_metrics(scored, label, prediction, probability).first()
    both = F.array(1 - F.col(probability), F.col(probability))
    ready = scored.select(dbl(label).alias("y"), dbl(prediction).alias("p"), array_to_vector(both).alias("v"))
    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="v", numBins=0).evaluate(ready)
    classes = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p")
    accuracy = classes.evaluate(ready, {classes.metricName: "accuracy"})
    recall = classes.evaluate(ready, {classes.metricName: "recallByLabel", classes.metricLabel: 1.0})
    agree = _agree(own.accuracy, accuracy) and _agree(own.recall, recall) and _agree(own.auc, area)
    within = F.col(probability).isNotNull() & F.col(probability).between(0, 1)
    follows = (F.col(prediction) == 1) == (F.col(probability) > 0.5)
    return scored.agg(
        F.count("*").alias("rows"),
        F.countDistinct(*keys).alias("keys"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.bool_and(within).alias("bounded"),
        F.bool_and(follows | (F.abs(F.col(probability) - 0.5) < 1e-9)).alias("classes_follow"),
        F.lit(agree).alias("metrics_agree"),
    )


def forecast_checks(predictions: DataFrame, column: str, metrics: DataFrame, model: str, entity: str = "entity_id", actual: str = "actual_qty") -> DataFrame:
    """Per entity: rows, first and last day, and whether predictions are finite, not negative, and as far off as the metrics say."""
    found = predictions.groupBy(entity).agg(
        F.count("*").alias("rows"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.bool_and(F.col(column).isNotNull() & (F.col(column) >= 0) & (F.col(column) < float("inf"))).alias("sound"),
        F.avg(F.abs(F.col(actual) - F.col(column))).alias("_mae"),
        F.sqrt(F.avg(F.pow(F.col(actual) - F.col(column), 2))).alias("_rmse"),
    )
    said = metrics.where(F.col("model") == model).select(entity, "mae", "rmse")
    near: Column = (F.abs(F.col("mae") - F.col("_mae")) <= 0.0051) & (F.abs(F.col("rmse") - F.col("_rmse")) <= 0.0051)
    return found.join(said, entity, "left").select(entity, "rows", "first_day", "last_day", "sound", F.coalesce(near, F.lit(False)).alias("metrics_agree"))


def multiclass_checks(scored: DataFrame, own: Mapping[str, float]) -> tuple[int, bool, bool]:
    """(rows, whether all are scored with a known class, whether Spark's evaluator gives the same accuracy and F1)."""
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    values = {m: judge.evaluate(scored, {judge.metricName: m}) for m in ("accuracy", "f1")}
    counts = scored.agg(F.count("*").alias("n"), F.count_if(F.col("prediction").isNotNull() & (F.col("prediction") >= 0)).alias("k")).first()
    return counts.n, counts.n == counts.k, all(_agree(own[m], values[m]) for m in values)


def cluster_checks(clustered: DataFrame, centres: Sequence[Sequence[float]], features: str, key: str) -> DataFrame:
    """Rows, distinct keys, clusters in use, and whether each row is in the cluster of its nearest centre."""
    parts = []
    for centre in centres:
        gaps = F.zip_with(features, F.array(*map(F.lit, map(float, centre))), lambda a, b: (a - b) * (a - b))
        parts.append(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))
    nearest = F.array(*parts)
    near = F.get(nearest, F.col("cluster")) <= F.array_min(nearest) + 1e-6
    return clustered.agg(
        F.count("*").alias("rows"), F.countDistinct(key).alias("keys"), F.countDistinct("cluster").alias("clusters"), F.bool_and(near).alias("nearest")
    )
