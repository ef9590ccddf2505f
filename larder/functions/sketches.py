"""Quantile sketches that are stored and merged later: KLL states per group, and the error that they promise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_K = 400


def rank_error(k: int = SKETCH_K) -> float:
    """The share of rows by which a quantile's rank may be off, with 99 % confidence, whatever the number of merges."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, by: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """(by, sketch): the state of the group's values, some kilobytes at any group size; NULLs are left out."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """The sketches of coarser groups; merged ones may be merged again."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """The groups with their number of values and one column per quantile, each a value that occurs."""
    quantiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in probabilities.items()]
    return sketches.select("*", F.kll_sketch_get_n_double("sketch").alias("n"), *quantiles).drop("sketch")


def ranks_hold(df: DataFrame, by: Sequence[str], value: str, quantiles: DataFrame, probabilities: Mapping[str, float], error: float) -> DataFrame:
    """(by, n, one flag per quantile): whether the exact ranks of the value reach to within `error` of the quantile.

    A value that repeats has a range of ranks, from the rows below it to those up to it; one of them must be near.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"))
    joined = rows.join(quantiles.drop("n"), list(by))
    counts = [F.count("*").alias("n")]
    for name in probabilities:
        counts += [F.count_if(F.col("_x") < F.col(name)).alias(f"_below_{name}"), F.count_if(F.col("_x") <= F.col(name)).alias(f"_upto_{name}")]
    flags = []
    for name, p in probabilities.items():
        low, high = F.col(f"_below_{name}") / F.col("n"), F.col(f"_upto_{name}") / F.col("n")
        flags.append(((low <= p + error) & (high >= p - error)).alias(name))
    return joined.groupBy(*by).agg(*counts).select(*by, "n", *flags)
