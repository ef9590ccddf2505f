"""Market-basket rules over item pairs.

Only items that reach the support threshold can form a frequent pair, so baskets are cut
to those items first; their number is at most mean basket size / support, whatever the
data volume. Pair counts then come from co-occurrence matrices of basket chunks inside
the tasks: a basket contributes a 0/1 row, never its list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import with_scalars


def baskets(lines: DataFrame) -> DataFrame:
    """Distinct (order, item) pairs; lines without an item still make a basket, lines without an order make none."""
    return lines.where(F.col("order_id").isNotNull()).select("order_id", "menu_item_id").distinct()


def basket_singles(lines: DataFrame) -> DataFrame:
    """Baskets per item and the number of all baskets."""
    b = baskets(lines)
    counts = b.where(F.col("menu_item_id").isNotNull()).groupBy("menu_item_id").agg(F.count("*").alias("baskets"))
    return with_scalars(counts, b.agg(F.countDistinct("order_id").alias("n_baskets")))


def basket_pairs(
    lines: DataFrame, min_support: float = DEFAULTS.min_support, tile: int = 2048, chunk_rows: int = 8192
) -> DataFrame:
    """Co-occurrence counts ``(item_a, item_b, together)`` with a < b for all frequent pairs."""
    singles = basket_singles(lines)
    frequent = singles.where(F.col("baskets") >= min_support * F.col("n_baskets"))
    b = baskets(lines).join(frequent.select("menu_item_id"), "menu_item_id")
    by_order = b.repartition("order_id").sortWithinPartitions("order_id", "menu_item_id")

    def chunk_pairs(orders: np.ndarray, items: np.ndarray) -> Iterator[pd.DataFrame]:
        names, col = np.unique(items, return_inverse=True)
        _, row = np.unique(orders, return_inverse=True)
        for i in range(0, len(names), tile):
            left = np.zeros((row.max() + 1, min(tile, len(names) - i)), dtype=np.float32)
            inside = (col >= i) & (col < i + tile)
            left[row[inside], col[inside] - i] = 1
            for j in range(i, len(names), tile):
                right = np.zeros((row.max() + 1, min(tile, len(names) - j)), dtype=np.float32)
                there = (col >= j) & (col < j + tile)
                right[row[there], col[there] - j] = 1
                together = left.T @ right
                if i == j:
                    together = np.triu(together, k=1)
                a, c = np.nonzero(together)
                yield pd.DataFrame(
                    {"item_a": names[a + i], "item_b": names[c + j], "together": together[a, c].astype(np.int64)}
                )

    def count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < chunk_rows:
                continue
            rows = pd.concat(held)
            last = rows["order_id"].iloc[-1]  # the last basket may go on in the next batch
            done = rows[rows["order_id"] != last]
            if len(done):
                yield from chunk_pairs(done["order_id"].to_numpy(), done["menu_item_id"].to_numpy())
            held = [rows[rows["order_id"] == last]]
            size = len(held[0])
        if size:
            rows = pd.concat(held)
            yield from chunk_pairs(rows["order_id"].to_numpy(), rows["menu_item_id"].to_numpy())

    partial = by_order.mapInPandas(count_pairs, "item_a bigint, item_b bigint, together bigint")
    return partial.groupBy("item_a", "item_b").agg(F.sum("together").alias("together"))


def association_rules(
    lines: DataFrame,
    min_support: float = DEFAULTS.min_support,
    min_confidence: float = DEFAULTS.min_confidence,
    min_lift: float = DEFAULTS.min_lift,
) -> DataFrame:
    """Rules in both directions that reach support, confidence and lift."""
    singles = basket_singles(lines)
    a = singles.select(F.col("menu_item_id").alias("item_a"), F.col("baskets").alias("a_n"), "n_baskets")
    b = singles.select(F.col("menu_item_id").alias("item_b"), F.col("baskets").alias("b_n"))
    counted = basket_pairs(lines, min_support).join(a, "item_a").join(b, "item_b")
    support = F.col("together") / F.col("n_baskets")
    sup_a, sup_b = F.col("a_n") / F.col("n_baskets"), F.col("b_n") / F.col("n_baskets")

    def rule(x: str, y: str, sup_x, sup_y):
        return F.struct(
            F.col(x).alias("antecedent"), F.col(y).alias("consequent"), (support / sup_x).alias("c"), (support / sup_x / sup_y).alias("l")
        )

    both = F.array(rule("item_a", "item_b", sup_a, sup_b), rule("item_b", "item_a", sup_b, sup_a))
    return (
        counted.where(support >= min_support)
        .select(support.alias("s"), F.explode(both).alias("e"))
        .where((F.col("e.c") >= min_confidence) & (F.col("e.l") >= min_lift))
        .select(
            "e.antecedent",
            "e.consequent",
            F.round("s", 6).alias("support"),
            F.round("e.c", 4).alias("confidence"),
            F.round("e.l", 4).alias("lift"),
        )
    )


def name_rules(rules: DataFrame, menu: DataFrame) -> DataFrame:
    """Add item names and drop rules between items of the same name."""
    for side in ("antecedent", "consequent"):
        names = menu.select(F.col("menu_item_id").alias(side), F.col("item_name").alias(f"{side}_name"))
        rules = rules.join(names, side, "left")
    return rules.where(~F.col("antecedent_name").eqNullSafe(F.col("consequent_name")))


def top_rules(named: DataFrame, n: int = 20) -> DataFrame:
    return named.orderBy(F.desc("lift"), F.desc("support"), "antecedent", "consequent").limit(n)


def bundle_suggestions(named: DataFrame, n: int = 30) -> DataFrame:
    """Best rule per unordered pair, the n with the highest lift, ranked."""
    order = F.struct(-F.col("lift"), -F.col("confidence"), F.col("antecedent"), F.col("consequent"))
    row = F.struct(*named.columns)
    best = (
        named.withColumn("_o", order)
        .groupBy(F.least("antecedent", "consequent").alias("_x"), F.greatest("antecedent", "consequent").alias("_y"))
        .agg(F.min_by(row, "_o").alias("r"))
        .select("r.*")
    )
    first = [F.desc("lift"), F.desc("confidence"), F.col("antecedent"), F.col("consequent")]
    ranked = best.orderBy(*first).limit(n)  # at most n rows reach the ranking window
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*first))
    return ranked.select(
        "antecedent_name",
        "consequent_name",
        "support",
        "confidence",
        "lift",
        F.lit("Combo Meal").alias("recommendation_type"),
        place.alias("rank"),
    )


