"""Windows over per-entity series. Series hold one row per entity and day, so their
length is bounded by the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from larder.functions.scalar import dbl, elapsed_days


def _ordered(entity: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*entity).orderBy(order)


def lag_features(
    df: DataFrame, entity: Sequence[str], order: str, col: str, lags: Sequence[int] = (1, 7, 14, 28)
) -> DataFrame:
    w = _ordered(entity, order)
    return df.withColumns({f"lag_{k}": F.lag(col, k).over(w) for k in lags})


def rolling_features(
    df: DataFrame,
    entity: Sequence[str],
    order: str,
    col: str,
    mean: Sequence[int] = (7, 14, 28),
    std: Sequence[int] = (7, 28),
) -> DataFrame:
    """Mean and sample deviation over the previous rows (the current one is left out)."""
    w = _ordered(entity, order)
    added = {f"rolling_mean_{k}": F.avg(dbl(col)).over(w.rowsBetween(-k, -1)) for k in mean}
    added |= {f"rolling_std_{k}": F.stddev_samp(dbl(col)).over(w.rowsBetween(-k, -1)) for k in std}
    return df.withColumns(added)


def expanding_sum(df: DataFrame, entity: Sequence[str], order: str, col: str, name: str) -> DataFrame:
    """Sum of all earlier rows of the entity."""
    w = _ordered(entity, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.sum(col).over(w))


def running_index(df: DataFrame, entity: Sequence[str], order: str, name: str = "time_index") -> DataFrame:
    return df.withColumn(name, F.row_number().over(_ordered(entity, order)))


def zscore(df: DataFrame, entity: Sequence[str], col: str) -> DataFrame:
    """Add the entity's mean, sample deviation and the row's z (NULL when the deviation is zero).

    The moments are aggregated with partial sums and joined back, not windowed.
    """
    stats = df.groupBy(*entity).agg(
        F.avg(dbl(col)).alias("mean"), F.stddev_samp(dbl(col)).alias("std")
    )
    z = (dbl(col) - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))
    return df.join(stats, list(entity)).withColumn("z", z)


def mean_gap_days(
    df: DataFrame, entity: Sequence[str], ts: str, name: str = "avg_days_between_orders", weight: str | None = None
) -> DataFrame:
    """Mean of whole 24-hour gaps between consecutive rows of an entity; 0 for a single row.

    With ``weight``, a row stands for that many rows of its time.

    Rows are first reduced to the earliest and latest time per entity and day: gaps
    within a day count zero whole days, so only day-to-day gaps add up.
    """
    days = df.where(F.col(ts).isNotNull()).groupBy(*entity, F.to_date(ts).alias("_d")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), (F.sum(weight) if weight else F.count("*")).alias("_n")
    )
    w = Window.partitionBy(*entity).orderBy("_d")
    gaps = days.withColumn("_gap", elapsed_days(F.lag("_last").over(w), "_first"))
    rows = F.sum("_n")
    return gaps.groupBy(*entity).agg(
        F.when(rows > 1, F.coalesce(F.sum("_gap"), F.lit(0)).cast("double") / (rows - 1)).otherwise(0.0).alias(name)
    )


def dense_calendar(df: DataFrame, entity: str, day: str, values: Sequence[str]) -> DataFrame:
    """One row per entity and calendar day between the overall first and last day, gaps filled with 0."""
    span = df.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi")).alias("s"))
    grid = (
        df.select(entity)
        .distinct()
        .withColumn("_s", span.scalar())
        .select(entity, F.explode(F.sequence(F.col("_s.lo"), F.col("_s.hi"))).alias(day))
    )
    return grid.join(df, [entity, day], "left").fillna(0, list(values))
