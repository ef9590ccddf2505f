"""Sales anomalies at item-day, order and transaction grain."""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import with_scalars, with_thresholds
from larder.functions.scalar import dbl
from larder.functions.series import dense_calendar, zscore


def sales_spike_drop(
    daily: DataFrame, spike: float = DEFAULTS.sales_spike, drop: float = DEFAULTS.sales_drop, z: float = DEFAULTS.z_threshold
) -> DataFrame:
    """Item-days far above or below the item's own mean."""
    q = F.col("qty")
    kind = F.when((q > spike * F.col("mean")) | (F.col("z") > z), "spike").when(
        (q > 0) & (q < drop * F.col("mean")), "drop"
    )
    return (
        zscore(daily.select("menu_item_id", "date", "qty", "revenue"), ["menu_item_id"], "qty")
        .withColumn("type", kind)
        .where(F.col("type").isNotNull())
        .withColumns({c: F.round(c, 6) for c in ("mean", "std", "z")})
    )


def value_outliers(df: DataFrame, col: str, k: float = 3.0, kind: str = "order_value") -> DataFrame:
    """Rows outside the quartiles by more than k interquartile ranges."""
    x, spread = dbl(col), F.col("_q3") - F.col("_q1")
    judged = with_thresholds(df, {"_q1": (col, 0.25), "_q3": (col, 0.75)})
    return (
        judged.where((x < F.col("_q1") - k * spread) | (x > F.col("_q3") + k * spread))
        .drop("_q1", "_q3")
        .withColumn("type", F.lit(kind))
    )


def discount_outliers(orders: DataFrame, k: float = 3.0) -> DataFrame:
    """Orders whose discount share exceeds the mean by k deviations; unknown shares count as 0."""
    pct = F.coalesce(dbl("discount_total") / F.nullif(dbl("subtotal"), F.lit(0.0)), F.lit(0.0))
    shares = orders.select(
        "order_id", "customer_id", "restaurant_id", "order_timestamp", "subtotal", "discount_total", pct.alias("discount_pct")
    )
    limit = shares.agg((F.avg("discount_pct") + k * F.stddev_samp("discount_pct")).alias("_limit"))
    return (
        with_scalars(shares, limit)
        .where(F.col("discount_pct") > F.col("_limit"))
        .drop("_limit")
        .withColumn("type", F.lit("discount"))
    )


def duplicate_transactions(
    df: DataFrame, keys: Sequence[str] = ("customer_id", "restaurant_id", "total_amount"), ts: str = "order_timestamp", row_id: str = "order_id", minutes: int = 60
) -> DataFrame:
    """Rows that repeat all keys within ``minutes`` of the previous such row.

    A predecessor that close lies in the same time slot or the one before, so the scan runs
    per (key, slot) and only the last time of each slot is handed to the next one: a key
    with very many rows is spread over its slots.
    """
    keys = list(keys)
    rows = df
    for c in [*keys, ts]:
        rows = rows.where(F.col(c).isNotNull())
    slot_us = minutes * 60_000_000
    rows = rows.withColumn("_slot", F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / slot_us).cast("bigint"))
    before = rows.groupBy(*keys, (F.col("_slot") + 1).alias("_slot")).agg(F.max(ts).alias("_before"))
    inside = Window.partitionBy(*keys, "_slot").orderBy(ts, row_id)
    near = rows.withColumn("_prev", F.lag(ts).over(inside)).join(before, [*keys, "_slot"], "left")
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.coalesce("_prev", "_before").cast("timestamp"))
    return (
        near.withColumn("time_gap_min", F.round(gap / 60_000_000, 6))
        .where(gap < slot_us)
        .select(*df.columns, "time_gap_min", F.lit("duplicate_transaction").alias("type"))
    )


def unexpected_demand(lines: DataFrame, orders: DataFrame, k: float = 3.0) -> DataFrame:
    """Orders with far more distinct items than usual."""
    sizes = lines.groupBy("order_id").agg(F.countDistinct("menu_item_id").alias("n_items"))
    stats = sizes.agg(F.avg("n_items").alias("_m"), F.stddev_samp("n_items").alias("_s"))
    big = with_scalars(sizes, stats).where(F.col("n_items") > F.col("_m") + k * F.col("_s"))
    header = orders.select("order_id", "customer_id", "restaurant_id", "order_timestamp", "total_amount")
    return big.join(header, "order_id", "left").select(
        *header.columns, "n_items", F.round("_m", 2).alias("mean_items"), F.lit("unexpected_demand").alias("type")
    )


def weekday_spike(daily: DataFrame, ratio: float = 5.0, min_base: float = 3.0) -> DataFrame:
    """Item-days at several times the median of the same weekday one and two weeks around."""
    dense = dense_calendar(daily.select("menu_item_id", "date", "qty"), "menu_item_id", "date", ["qty"])
    w = Window.partitionBy("menu_item_id").orderBy("date")
    around = F.array_sort(
        F.array_compact(F.array(*[f("qty", n).over(w) for f in (F.lag, F.lead) for n in (7, 14)]))
    )
    n = F.size("_a")
    middle = F.when(n > 0, (F.element_at("_a", F.floor((n + 1) / 2).cast("int")) + F.element_at("_a", (F.floor(n / 2) + 1).cast("int"))) / 2)
    return (
        dense.withColumn("_a", around)
        .withColumn("baseline", middle)
        .where((F.col("qty") >= ratio * F.col("baseline")) & (F.col("baseline") >= min_base))
        .drop("_a")
    )


def kpi_changes(orders: DataFrame, by: str = "restaurant_id") -> DataFrame:
    """Monthly revenue and orders per group with their change against the previous month, in percent."""
    monthly = orders.where(F.col(by).isNotNull()).groupBy(by, F.trunc(F.to_date("order_timestamp"), "month").alias("month")).agg(
        dbl(F.sum("total_amount")).alias("revenue"), F.count("*").alias("orders")
    )
    w = Window.partitionBy(by).orderBy("month")

    def change(c: str):
        before = F.lag(c).over(w)
        return F.round((F.col(c) - before) / F.nullif(before, F.lit(0)) * 100, 4)

    return monthly.withColumns({"revenue_change_pct": change("revenue"), "orders_change_pct": change("orders")})


CONDITION = re.compile(r"\s*(\w+)\s*(<=|>=|<>|!=|==|=|<|>)\s*(?:(-?\d+(?:\.\d+)?)|'([^']*)')\s*")
COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq, "==": operator.eq, "!=": operator.ne, "<>": operator.ne}


class RuleError(ValueError):
    """A rule that can't be applied, and why."""


def rule_condition(rule: str, kinds: Mapping[str, str]) -> Column:
    """A configured rule as a condition: comparisons of a column with a number or a quoted text, joined by ``and``.

    ``kinds`` are the columns that rules may use, with their types. Nothing else of the rule is ever run.
    """
    found = []
    for part in re.split(r"\band\b(?=(?:[^']*'[^']*')*[^']*$)", rule, flags=re.I):
        known = CONDITION.fullmatch(part)
        if not known:
            raise RuleError(f"{part.strip()!r} in rule {rule!r} isn't a comparison such as revenue > 20 or channel = 'web'")
        column, sign, number, text = known.groups()
        if column not in kinds:
            raise RuleError(f"rule {rule!r} uses {column!r}; known columns: {', '.join(sorted(kinds))}")
        if (number is None) != (kinds[column] == "string"):
            raise RuleError(f"rule {rule!r} compares {column!r}, a {kinds[column]}, with {'a text' if number is None else 'a number'}")
        found.append(COMPARE[sign](F.col(column), F.lit(text) if number is None else F.lit(float(number))))
    return reduce(operator.and_, found)


def rule_anomalies(kpis: DataFrame, rule: str) -> DataFrame:
    """Rows that meet a rule such as ``revenue_change_pct > 20 and orders >= 5``, see `rule_condition`."""
    return kpis.where(rule_condition(rule, dict(kpis.dtypes))).withColumn("rule", F.lit(rule))
