"""Cleaning steps. Each returns ``(clean, quarantine, description)``.

Quarantined rows keep all columns and carry a ``reason``. Steps that correct a value
instead of removing the row keep it in ``clean`` and put the original into quarantine.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.staging import settle

Step = tuple[DataFrame, DataFrame, str]
COPIES_PER_TASK = 100_000


def _split(df: DataFrame, keep: Column, reason: str) -> Step:
    ok = F.coalesce(keep, F.lit(False))
    return df.where(ok), df.where(~ok).withColumn("reason", F.lit(reason)), reason


def missing_amounts(orders: DataFrame) -> Step:
    cols = ("subtotal", "discount_total", "total_amount", "order_timestamp")
    return _split(orders, reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]), "missing amount or time")


def deduplicate(df: DataFrame, key: str) -> Step:
    """One row per key, the greatest by column order (so known values win over NULL); NULL is a key like any other.

    Keys that occur once are told by the keys alone, and their rows pass as they are. Of the others the rest is the multiset
    difference of all rows and the survivors. Both are aggregates with map-side partial results, and the difference is
    dealt by whole rows, so a key with very many rows never has to fit one task.
    """
    reason = f"duplicate {key}"
    known = df.where(F.col(key).isNotNull())
    repeated = settle(known.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key), "repeated_keys")
    rows = known.join(repeated, key, "left_semi").select(*df.columns).unionByName(df.where(F.col(key).isNull()))
    best = rows.groupBy(key).agg(F.max(F.struct(*df.columns)).alias("_best")).select("_best.*")
    clean = known.join(repeated, key, "left_anti").select(*df.columns).unionByName(best)
    counted = rows.withColumn("_n", F.lit(1)).unionByName(best.withColumn("_n", F.lit(-1)))
    surplus = counted.groupBy(*df.columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") > 0)
    few = surplus.where(F.col("_n") <= COPIES_PER_TASK)
    chunk = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES_PER_TASK))
    many = surplus.where(F.col("_n") > COPIES_PER_TASK).withColumn("_chunk", F.explode(chunk)).repartition(*df.columns, "_chunk")
    many = many.withColumn("_n", F.least(F.lit(COPIES_PER_TASK), F.col("_n") - F.col("_chunk") * COPIES_PER_TASK)).drop("_chunk")
    rest = few.unionByName(many).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return clean, rest.select(*df.columns, F.lit(reason).alias("reason")), reason


def invalid_menu_prices(menu: DataFrame, limit: float = 1000) -> Step:
    return _split(menu, (F.col("base_price") > 0) & (F.col("base_price") <= limit), "invalid menu price")


def negative_quantities(lines: DataFrame) -> Step:
    return _split(lines, F.col("quantity") >= 0, "negative quantity")


def negative_consumption(inventory: DataFrame) -> Step:
    return _split(inventory, F.col("consumption_quantity") >= 0, "negative consumption")


def invalid_dates(df: DataFrame, col: str, max_date: str) -> Step:
    """Known and not after the last allowed day (its whole day counts)."""
    return _split(df, F.to_date(col) <= F.lit(max_date).cast("date"), f"invalid {col}")


def invalid_ratings(ratings: DataFrame) -> Step:
    return _split(ratings, F.col("rating_value").between(1, 5), "invalid rating")


def missing_ids(df: DataFrame, col: str) -> Step:
    return _split(df, F.col(col).isNotNull(), f"missing {col}")


def invalid_restaurants(orders: DataFrame, restaurants: DataFrame) -> Step:
    reason = "unknown restaurant"
    known = restaurants.select("restaurant_id")
    rejected = orders.join(known, "restaurant_id", "left_anti").select(*orders.columns)
    kept = orders.join(known, "restaurant_id", "left_semi").select(*orders.columns)
    return kept, rejected.withColumn("reason", F.lit(reason)), reason


def _correct(judged: DataFrame, cols: Sequence[str], bad: Column, fixes: Mapping[str, Column], reason: str) -> Step:
    wrong = F.coalesce(bad, F.lit(False))
    fixed = [F.when(wrong, fixes[c]).otherwise(F.col(c)).alias(c) if c in fixes else F.col(c) for c in cols]
    return judged.select(*fixed), judged.where(wrong).select(*cols, F.lit(reason).alias("reason")), reason


def impossible_wastage(wastage: DataFrame, inventory: DataFrame) -> Step:
    """Cap the wasted quantity at the largest closing stock of the item and restaurant."""
    on = ["menu_item_id", "restaurant_id"]
    stock = inventory.groupBy(*on).agg(F.max("closing_quantity").alias("_cap"))
    judged = wastage.join(stock, on, "left")
    return _correct(
        judged,
        wastage.columns,
        F.col("quantity_wasted") > F.col("_cap"),
        {"quantity_wasted": F.col("_cap")},
        "wastage above stock",
    )


def incorrect_discounts(lines: DataFrame, recompute_total: bool = False) -> Step:
    """Cap the discount at quantity times price; unknown discounts stay unknown."""
    gross = F.round(F.col("quantity") * F.col("unit_price"), 2).cast("decimal(12,2)")
    fixes = {"discount_amount": gross}
    if recompute_total:
        fixes["line_total"] = F.lit(0).cast("decimal(12,2)")
    return _correct(lines, lines.columns, F.col("discount_amount") > gross, fixes, "discount above line amount")


def inconsistent_units(df: DataFrame, menu: DataFrame) -> Step:
    """Overwrite units that differ from the menu's."""
    master = menu.select("menu_item_id", F.col("unit_of_measure").alias("_unit"))
    judged = df.join(master, "menu_item_id", "left")
    return _correct(
        judged, df.columns, F.col("unit_of_measure") != F.col("_unit"), {"unit_of_measure": F.col("_unit")}, "unit differs from menu"
    )


def cancelled_orders(orders: DataFrame) -> Step:
    """Cancelled orders stay; operators filter by status."""
    reason = "cancelled orders are kept"
    return orders, orders.where(F.lit(False)).withColumn("reason", F.lit(reason)), reason


def orphan_lines(lines: DataFrame, orders: DataFrame) -> Step:
    reason = "order not in clean orders"
    known = orders.select("order_id")
    rejected = lines.join(known, "order_id", "left_anti").select(*lines.columns)
    kept = lines.join(known, "order_id", "left_semi").select(*lines.columns)
    return kept, rejected.withColumn("reason", F.lit(reason)), reason


def invalid_unit_prices(df: DataFrame) -> Step:
    """Order lines or price history rows without a positive unit price."""
    return _split(df, F.col("unit_price") > 0, "invalid unit price")


def steps(max_date: str, extra: bool = False) -> list[tuple[str, str, bool, Callable[[Mapping[str, DataFrame]], Step]]]:
    """(step, table, removes rows, function of the tables so far), in order."""
    out = [
        ("missing_values", "Orders", True, lambda t: missing_amounts(t["Orders"])),
        ("duplicate_orders", "Orders", True, lambda t: deduplicate(t["Orders"], "order_id")),
        ("duplicate_lines", "Order_Items", True, lambda t: deduplicate(t["Order_Items"], "order_item_id")),
        ("invalid_menu_prices", "Menu_Items", True, lambda t: invalid_menu_prices(t["Menu_Items"])),
        ("negative_quantities", "Order_Items", True, lambda t: negative_quantities(t["Order_Items"])),
        ("negative_consumption", "Inventory", True, lambda t: negative_consumption(t["Inventory"])),
        ("invalid_dates", "Orders", True, lambda t: invalid_dates(t["Orders"], "order_timestamp", max_date)),
        ("invalid_dates", "Ratings", True, lambda t: invalid_dates(t["Ratings"], "rating_timestamp", max_date)),
        ("invalid_dates", "Wastage", True, lambda t: invalid_dates(t["Wastage"], "wastage_date", max_date)),
        ("invalid_ratings", "Ratings", True, lambda t: invalid_ratings(t["Ratings"])),
        ("missing_ids", "Orders", True, lambda t: missing_ids(t["Orders"], "customer_id")),
        ("missing_ids", "Order_Items", True, lambda t: missing_ids(t["Order_Items"], "menu_item_id")),
        ("invalid_restaurants", "Orders", True, lambda t: invalid_restaurants(t["Orders"], t["Restaurants"])),
        ("impossible_wastage", "Wastage", False, lambda t: impossible_wastage(t["Wastage"], t["Inventory"])),
        ("incorrect_discounts", "Order_Items", False, lambda t: incorrect_discounts(t["Order_Items"])),
        ("inconsistent_units", "Inventory", False, lambda t: inconsistent_units(t["Inventory"], t["Menu_Items"])),
        ("inconsistent_units", "Wastage", False, lambda t: inconsistent_units(t["Wastage"], t["Menu_Items"])),
        ("cancelled_orders", "Orders", False, lambda t: cancelled_orders(t["Orders"])),
    ]
    if extra:
        out += [
            ("orphan_lines", "Order_Items", True, lambda t: orphan_lines(t["Order_Items"], t["Orders"])),
            ("invalid_unit_prices", "Order_Items", True, lambda t: invalid_unit_prices(t["Order_Items"])),
        ]
    return out


def run_cleaning(
    tables: Mapping[str, DataFrame],
    max_date: str = "2025-12-31",
    extra: bool = False,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame], DataFrame]:
    """All steps in order: clean tables, quarantine per step and table, and a log.

    ``stage`` may write a frame and return the written table; it is applied to every
    quarantine and to tables whose step shuffles, so no step is computed twice.
    """
    t, quarantine, counts = dict(tables), {}, []
    shuffling = {"duplicate_orders", "duplicate_lines", "impossible_wastage", "orphan_lines"}
    for table in sorted({s[1] for s in steps(max_date, extra)}):
        counts.append(_count(t[table], -1, "input", table, F.count("*"), F.lit(0).cast("bigint")))
    for i, (step, table, removes, run) in enumerate(steps(max_date, extra)):
        clean, rejected, _ = run(t)
        name = f"{step}_{table}"
        quarantine[name] = stage(rejected, f"quarantine_{name}")
        t[table] = stage(clean, f"clean_{name}") if step in shuffling else clean
        lost = -F.count("*") if removes else F.lit(0).cast("bigint")
        counts.append(_count(quarantine[name], i, step, table, lost, F.count("*")))
    merged = reduce(DataFrame.unionByName, counts)
    so_far = Window.partitionBy("table").orderBy("position")  # one row per step
    log = merged.withColumn("clean_rows", F.sum("change").over(so_far)).where(F.col("position") >= 0)
    return t, quarantine, log.select("position", "step", "table", "clean_rows", "quarantined")


def _count(df: DataFrame, position: int, step: str, table: str, change: Column, quarantined: Column) -> DataFrame:
    return df.agg(change.alias("change"), quarantined.alias("quarantined")).select(
        F.lit(position).alias("position"), F.lit(step).alias("step"), F.lit(table).alias("table"), "change", "quarantined"
    )
