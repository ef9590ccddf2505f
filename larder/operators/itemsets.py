"""Frequent item sets of any size and the rules between their parts, level by level.

A set can only be frequent if all its subsets are, so each level extends the frequent sets of the one before. Baskets are
read in chunks that hold, for each item, the baskets with it as one bit set; a set's count in a chunk is the size of an
intersection, reached along the shared prefixes of the candidates. A basket never emits its subsets: a task hands on one
count per candidate set that it met. The frequent sets of a level travel to the tasks; there are at most
(mean number of such subsets per basket) / support of them, whatever the number of baskets.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.operators.basket import baskets
from larder.sources.staging import settle

MAX_SIZE = 3
CHUNK_ROWS = 65_536
HELD_COUNTS = 500_000

Sets = set[tuple[int, ...]]


def bit_sets(orders: np.ndarray, items: np.ndarray) -> dict[int, int]:
    """For each item the baskets that hold it, as the bits of an integer."""
    _, row = np.unique(orders, return_inverse=True)
    by_item = np.argsort(items, kind="stable")
    names, first = np.unique(items[by_item], return_index=True)
    found = {}
    for name, rows in zip(names.tolist(), np.split(row[by_item], first[1:])):
        bits = np.zeros(row.max() + 1, np.uint8)
        bits[rows] = 1
        found[name] = int.from_bytes(np.packbits(bits).tobytes())
    return found


class Candidates:
    """The sets of one more item whose subsets are all frequent, found from their longest prefix."""

    def __init__(self, frequent: Sets) -> None:
        self.frequent = frequent
        self.size = len(next(iter(frequent), ()))
        self.children: dict[tuple[int, ...], list[int]] = {}
        for s in sorted(frequent):
            for k in range(len(s)):
                known = self.children.setdefault(s[:k], [])
                if not known or known[-1] != s[k]:
                    known.append(s[k])

    def after(self, prefix: tuple[int, ...]) -> list[int]:
        """Items that may follow a prefix: in a frequent set, or in a candidate if the prefix is a whole frequent set."""
        if len(prefix) < self.size:
            return self.children.get(prefix, [])
        follow = [x for x in self.children.get(prefix[:-1], []) if x > prefix[-1]]
        return [x for x in follow if all(prefix[:k] + prefix[k + 1 :] + (x,) in self.frequent for k in range(self.size - 1))]

    def count(self, bits: dict[int, int], counts: Counter, prefix: tuple[int, ...] = (), inside: int = -1) -> None:
        """Add the baskets of each candidate that begins with the prefix."""
        for item in self.after(prefix):
            both = inside & bits.get(item, 0)
            if both:
                if len(prefix) == self.size:
                    counts[prefix + (item,)] += both.bit_count()
                else:
                    self.count(bits, counts, prefix + (item,), both)


def _next_level(by_order: DataFrame, frequent: Sets, chunk_rows: int) -> DataFrame:
    """Baskets per candidate set one item larger than the frequent ones."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        candidates, counts = Candidates(frequent), Counter()

        def add(rows: pd.DataFrame) -> None:
            candidates.count(bit_sets(rows["order_id"].to_numpy(), rows["menu_item_id"].to_numpy()), counts)

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"items": list(map(list, counts)), "baskets": list(counts.values())})
            counts.clear()
            return out

        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < chunk_rows:
                continue
            rows = pd.concat(held)
            unfinished = rows["order_id"] == rows["order_id"].iloc[-1]  # the last basket may go on in the next batch
            if not unfinished.all():
                add(rows[~unfinished])
            held, size = [rows[unfinished]], int(unfinished.sum())
            if len(counts) > HELD_COUNTS:
                yield flush()
        if size:
            add(pd.concat(held))
        if counts:
            yield flush()

    partial = by_order.mapInPandas(count, "items array<bigint>, baskets bigint")
    return partial.groupBy("items").agg(F.sum("baskets").alias("baskets"))


def frequent_itemsets(
    lines: DataFrame, min_support: float = DEFAULTS.min_support, max_size: int = MAX_SIZE, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(items, size, baskets, support) of every set of up to `max_size` items in at least `min_support` of the baskets.

    `items` is in ascending order. Lines without an item count for the number of baskets, those without an order don't.
    """
    b = settle(baskets(lines), "baskets")
    total = b.agg(F.countDistinct("order_id")).first()[0]
    enough = F.col("baskets") >= F.lit(min_support) * F.lit(total)
    single = b.where(F.col("menu_item_id").isNotNull()).groupBy(F.array("menu_item_id").alias("items")).agg(F.count("*").alias("baskets"))
    levels = [settle(single.where(enough), "itemsets_1")]
    frequent_items = levels[0].select(F.col("items")[0].alias("menu_item_id"))
    by_order = b.join(frequent_items, "menu_item_id").select("order_id", "menu_item_id")
    by_order = by_order.repartition("order_id").sortWithinPartitions("order_id", "menu_item_id")
    while len(levels) < max_size:
        frequent = {tuple(r["items"]) for r in levels[-1].select("items").toLocalIterator()}
        if not frequent:
            break
        levels.append(settle(_next_level(by_order, frequent, chunk_rows).where(enough), f"itemsets_{len(levels) + 1}"))
    rows = reduce(DataFrame.unionByName, levels)
    return rows.select("items", F.size("items").alias("size"), "baskets", F.round(F.col("baskets") / F.lit(total), 6).alias("support"))


def _part(items: str, mask: Column, bit: int) -> Column:
    return F.filter(items, lambda _, i: F.getbit(mask, i) == bit)


def itemset_rules(
    itemsets: DataFrame, n_baskets: int | Column, min_confidence: float = DEFAULTS.min_confidence, min_lift: float = DEFAULTS.min_lift
) -> DataFrame:
    """Rules between every two parts of a frequent set: (antecedent, consequent, support, confidence, lift), item arrays.

    The parts of a frequent set are frequent, so their counts are in the same table.
    """
    total = F.lit(n_baskets) if isinstance(n_baskets, int) else n_baskets
    masks = F.sequence(F.lit(1), (F.pow(F.lit(2), F.col("size")) - 2).cast("int"))
    splits = itemsets.where("size > 1").select("items", F.col("baskets").alias("together"), F.explode(masks).alias("mask"))
    rules = splits.select("together", _part("items", F.col("mask"), 1).alias("antecedent"), _part("items", F.col("mask"), 0).alias("consequent"))
    for side in ("antecedent", "consequent"):
        rules = rules.join(itemsets.select(F.col("items").alias(side), F.col("baskets").alias(f"{side}_n")), side)
    support = F.col("together") / total
    confidence = support / (F.col("antecedent_n") / total)
    lift = confidence / (F.col("consequent_n") / total)
    return (
        rules.select("antecedent", "consequent", support.alias("s"), confidence.alias("c"), lift.alias("l"))
        .where((F.col("c") >= min_confidence) & (F.col("l") >= min_lift))
        .select("antecedent", "consequent", F.round("s", 6).alias("support"), F.round("c", 4).alias("confidence"), F.round("l", 4).alias("lift"))
    )


def as_text(df: DataFrame, columns: tuple[str, ...] = ("items",)) -> DataFrame:
    """Item arrays as text, items joined by +."""
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), "+") for c in columns})
