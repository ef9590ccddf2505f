"""Agreement of two sets of predictions on the same records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.relational import reconcile
from larder.operators.churn import binary_metrics


def compare_predictions(a: DataFrame, b: DataFrame, key: str = "record_id") -> DataFrame:
    """Inner comparison of ``(key, actual, prediction, probability)`` with ``(key, prediction, probability)``."""
    left = a.select(key, "actual", F.col("prediction").alias("a_prediction"), F.col("probability").alias("a_probability"))
    right = b.select(key, F.col("prediction").alias("b_prediction"), F.col("probability").alias("b_probability"))
    match = F.col("a_prediction") == F.col("b_prediction")
    differs = F.format_string(
        "Predictions differ. First probability=%.4f, second probability=%.4f, actual=%d.",
        F.col("a_probability"),
        F.col("b_probability"),
        F.col("actual"),
    )
    gap = F.round(F.col("a_probability") - F.col("b_probability"), 6)
    return left.join(right, key).withColumns(
        {
            "match_status": match,
            "prediction_difference": F.col("a_prediction") - F.col("b_prediction"),
            "probability_difference": gap,
            "absolute_difference": F.abs(gap),
            "a_correct": F.col("a_prediction") == F.col("actual"),
            "b_correct": F.col("b_prediction") == F.col("actual"),
            "disagreement_explanation": F.when(match, "Both models predicted the same class.").otherwise(differs),
        }
    )


def comparison_summary(cmp: DataFrame) -> DataFrame:
    n, matches = F.count("*"), F.count_if(F.col("match_status"))
    return cmp.agg(
        n.alias("n_cases"),
        matches.alias("n_matches"),
        (n - matches).alias("n_mismatches"),
        F.round(matches / n, 4).alias("agreement_rate"),
        F.round(F.count_if(F.col("a_correct")) / n, 4).alias("a_accuracy"),
        F.round(F.count_if(F.col("b_correct")) / n, 4).alias("b_accuracy"),
        F.round(F.avg("a_probability"), 4).alias("a_mean_probability"),
        F.round(F.avg("b_probability"), 4).alias("b_mean_probability"),
        F.round(F.avg("absolute_difference"), 4).alias("mean_probability_diff"),
    )


def model_metrics(cmp: DataFrame) -> DataFrame:
    """Confusion counts and metrics of both sides, one row each."""
    rows = [
        binary_metrics(cmp, "actual", f"{m}_prediction", f"{m}_probability").withColumn("model", F.lit(m)) for m in ("a", "b")
    ]
    return reduce(DataFrame.unionByName, rows)


def disagreements(cmp: DataFrame) -> DataFrame:
    return cmp.where(~F.col("match_status"))


def one_sided(a: DataFrame, b: DataFrame, key: str = "record_id") -> DataFrame:
    """Keys that occur on one side only."""
    return reconcile(a.select(key).distinct(), b.select(key).distinct(), key).where(F.col("side") != "both")


def agreement(cmp: DataFrame) -> DataFrame:
    """Number of matches and the agreement in percent."""
    return cmp.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("match_status")).alias("matched"),
        F.round(F.count_if(F.col("match_status")) / F.count("*") * 100, 1).alias("agreement_pct"),
    )
