"""Data-quality rules. Each rule returns tidy rows ``(rule, part, bad, checked)``.

A rule reads each of its tables once, whatever number of conditions it counts. With
``strict=True`` a rule uses the wider definition of the defect.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.relational import asof_join, existence_flag, with_thresholds
from larder.functions.scalar import normalised, plausible_date
from larder.sources.schemas import VALID_UNITS
from larder.sources.staging import settle

Tables = Mapping[str, DataFrame]
LATEST = "2024-12-31"

# fixed values: columns that must be known, per table
REQUIRED = {
    "Orders": ("subtotal", "discount_total", "total_amount", "order_timestamp"),
    "Order_Items": ("quantity", "unit_price", "unit_cost", "line_total"),
    "Menu_Items": ("base_price", "standard_cost"),
    "Pricing_History": ("unit_price",),
}
STRICT_REQUIRED = {
    "Orders": (
        "order_id",
        "customer_id",
        "restaurant_id",
        "order_timestamp",
        "order_channel",
        "order_status",
        "subtotal",
        "discount_total",
        "total_amount",
    ),
    "Order_Items": (
        "order_item_id",
        "order_id",
        "menu_item_id",
        "quantity",
        "unit_price",
        "unit_cost",
        "discount_amount",
        "line_total",
    ),
}
DATED = {"Orders": "order_timestamp", "Ratings": "rating_timestamp", "Wastage": "wastage_date"}


def tally(df: DataFrame, parts: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Count rows per (rule, part) condition in one aggregation and unpivot the counts."""
    keys = list(parts)
    counts = df.agg(F.count("*").alias("checked"), *[F.count_if(parts[k]).alias(f"_{i}") for i, k in enumerate(keys)])
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(part).alias("part"), F.col(f"_{i}").alias("bad"))
            for i, (rule, part) in enumerate(keys)
        ]
    )
    return counts.select("checked", F.explode(rows).alias("e")).select("e.rule", "e.part", "e.bad", "checked")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_conditions(strict: bool, as_of: str, limit: float = 1000, tolerance: float = 0.01) -> dict[tuple[str, str], Column]:
    """Defects that one row shows by itself: (rule, part) to condition. A part starts with its table."""
    d, q, p = F.col("discount_amount"), F.col("quantity"), F.col("unit_price")
    rating, price = F.col("rating_value"), F.col("base_price")
    out: dict[tuple[str, str], Column] = {}
    if strict:
        for table, cols in STRICT_REQUIRED.items():
            out["missing_values", table] = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    else:
        for table, cols in REQUIRED.items():
            out |= {("missing_values", f"{table}.{c}"): F.col(c).isNull() for c in cols}
        out["invalid_menu_prices", "Menu_Items"] = price.isNull() | (price <= 0) | (price > limit)
    out["negative_quantities", "Order_Items"] = q < 0
    out["negative_quantities", "Inventory"] = F.col("consumption_quantity") < 0
    for table, c in DATED.items():
        out["invalid_dates", table] = ~plausible_date(c, as_of) if strict else F.col(c).isNull()
    out["invalid_ratings", "Ratings"] = (
        rating.isNotNull() & ~rating.isin(1, 2, 3, 4, 5) if strict else (rating < 1) | (rating > 5)
    )
    out["missing_customer_ids", "Orders"] = F.col("customer_id").isNull()
    out["missing_menu_ids", "Order_Items"] = F.col("menu_item_id").isNull()
    if strict:
        tol = F.lit(tolerance).cast("decimal(4,2)")
        out["incorrect_discounts", "Order_Items"] = (d < 0) | ((q > 0) & (p > 0) & (d > q * p + tol))
        out["incorrect_discounts", "Orders"] = F.col("discount_total") > F.col("subtotal") + tol
    else:
        out["incorrect_discounts", "Order_Items"] = d > F.round(q * p, 2)
    out["cancelled_transactions", "Orders"] = normalised("order_status") == "cancelled"
    return out


Parts = dict[tuple[str, str], Column]


def _by_table(strict: bool, as_of: str, only: str | None = None) -> dict[str, Parts]:
    """The row conditions (or those of one rule) of each table."""
    by_table: dict[str, Parts] = {}
    for (rule, part), cond in row_conditions(strict, as_of).items():
        if only is None or rule == only:
            by_table.setdefault(part.split(".")[0], {})[rule, part] = cond
    return by_table


def _row_rules(t: Tables, strict: bool, as_of: str, only: str | None = None) -> DataFrame:
    """All row conditions (or those of one rule), one pass per table."""
    return _union([tally(t[table], parts) for table, parts in _by_table(strict, as_of, only).items()])


def _tally_groups(groups: DataFrame, parts: Parts) -> DataFrame:
    """The tally of row conditions that were counted per group, in the columns `_0`, `_1`..."""
    keys = list(parts)
    sums = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"), *[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(keys))])
    rows = [F.struct(F.lit(rule).alias("rule"), F.lit(part).alias("part"), F.col(f"_{i}").alias("bad")) for i, (rule, part) in enumerate(keys)]
    return sums.select(F.explode(F.array(*rows)).alias("e"), "checked").select("e.rule", "e.part", "e.bad", "checked")


GROUPED = {
    "Orders": ("restaurant_id",),
    "Inventory": ("menu_item_id", "restaurant_id", "unit_of_measure"),
    "Wastage": ("menu_item_id", "restaurant_id", "unit_of_measure"),
}


def _groups(df: DataFrame, table: str, parts: Parts, *more: Column) -> DataFrame:
    """One pass over a table: rows, row conditions and further aggregates per place, item and unit, as a stage table."""
    counts = [F.count_if(cond).alias(f"_{i}") for i, cond in enumerate(parts.values())]
    return settle(df.groupBy(*GROUPED[table]).agg(F.count("*").alias("_n"), *counts, *more), f"quality_{table}")


def _duplicates(df: DataFrame, key: str, rule: str, part: str, strict: bool) -> DataFrame:
    """Rows beyond the first of their key, or if there are more, of their content (by its digest, so rows aren't shuffled whole)."""
    if strict:
        content = F.md5(F.to_json(F.struct(*[c for c in df.columns if c != key])))
        entries = [
            F.struct(F.lit("key").alias("kind"), F.col(key).cast("string").alias("value")),
            F.struct(F.lit("content").alias("kind"), content.alias("value")),
        ]
        groups = df.select(F.explode(F.array(*entries)).alias("e")).groupBy("e.kind", "e.value").agg(F.count("*").alias("n"))
    else:
        groups = df.groupBy(F.lit("key").alias("kind"), F.col(key).alias("value")).agg(F.count("*").alias("n"))
    by_kind = groups.groupBy("kind").agg(F.sum("n").alias("checked"), (F.sum("n") - F.count("value")).alias("bad"))
    found = by_kind.agg(F.coalesce(F.max("bad"), F.lit(0)).alias("bad"), F.coalesce(F.max("checked"), F.lit(0)).alias("checked"))
    return found.select(F.lit(rule).alias("rule"), F.lit(part).alias("part"), "bad", "checked")


def duplicate_orders(t: Tables, strict: bool = False) -> DataFrame:
    return _duplicates(t["Orders"], "order_id", "duplicate_orders", "Orders", strict)


def duplicate_lines(t: Tables, strict: bool = False) -> DataFrame:
    return _duplicates(t["Order_Items"], "order_item_id", "duplicate_order_lines", "Order_Items", strict)


def steep_prices(t: Tables, times_median: float = 50) -> DataFrame:
    """Prices that are not positive or far above the median positive price of their column."""
    frames = []
    for name, col in (("Menu_Items", "base_price"), ("Order_Items", "unit_price"), ("Pricing_History", "unit_price")):
        prices = t[name].select(F.col(col).cast("double").alias("price"))
        judged = with_thresholds(prices, {"mid": ("price", 0.5)}, source=prices.where("price > 0"))
        bad = (F.col("price") <= 0) | (F.col("price") > times_median * F.col("mid"))
        frames.append(tally(judged, {("invalid_menu_prices", name): bad}))
    return _union(frames)


def invalid_prices(t: Tables, strict: bool = False) -> DataFrame:
    return steep_prices(t) if strict else _row_rules(t, False, LATEST, "invalid_menu_prices")


def _weighted(df: DataFrame, rule: str, part: str, bad: Column) -> DataFrame:
    """Tally of rows that were counted per distinct value (column ``_n``) before a join."""
    return df.agg(
        F.coalesce(F.sum(F.when(bad, F.col("_n"))), F.lit(0)).alias("bad"), F.sum("_n").alias("checked")
    ).select(F.lit(rule).alias("rule"), F.lit(part).alias("part"), "bad", "checked")


def _orphans(t: Tables, rule: str, names: list[str], groups: Tables | None = None) -> DataFrame:
    known = t["Restaurants"].select("restaurant_id")
    unknown = F.col("restaurant_id").isNotNull() & ~F.col("_known")
    frames = []
    for n in names:
        counted = groups[n] if groups and n in groups else t[n].withColumn("_n", F.lit(1))
        per_id = counted.groupBy("restaurant_id").agg(F.sum("_n").cast("bigint").alias("_n"))
        frames.append(_weighted(existence_flag(per_id, known, ["restaurant_id"], "_known"), rule, n, unknown))
    return _union(frames)


def invalid_restaurant_ids(t: Tables, strict: bool = False, groups: Tables | None = None) -> DataFrame:
    return _orphans(t, "invalid_restaurant_ids", ["Orders"], groups)


def invalid_locations(t: Tables, strict: bool = False, groups: Tables | None = None) -> DataFrame:
    names = ["Orders", "Inventory", "Wastage"] + (["Ratings"] if strict else [])
    return _orphans(t, "invalid_location_references", names, groups)


def _above_stock(wastage: DataFrame, stock: DataFrame) -> tuple[DataFrame, Column]:
    """Wastage with the largest stock of its item and place, and whether it is above it."""
    return wastage.join(stock, ["menu_item_id", "restaurant_id"], "left"), F.col("quantity_wasted") > F.col("max_closing")


def impossible_wastage(t: Tables, strict: bool = False) -> DataFrame:
    rule, on = "impossible_wastage", ["menu_item_id", "restaurant_id"]
    q = F.col("quantity_wasted")
    if strict:
        judged = asof_join(
            t["Wastage"].select(*on, "wastage_date", "quantity_wasted"),
            t["Inventory"],
            on,
            "wastage_date",
            "inventory_date",
            ["closing_quantity"],
        )
        bad = (q < 0) | ((q >= 0) & (q > F.col("closing_quantity")))
        return tally(judged, {(rule, "Wastage"): bad})
    stock = t["Inventory"].groupBy(*on).agg(F.max("closing_quantity").alias("max_closing"))
    judged, above = _above_stock(t["Wastage"].select(*on, "quantity_wasted"), stock)
    return tally(judged, {(rule, "Wastage"): above})


def inconsistent_units(t: Tables, strict: bool = False, groups: Tables | None = None) -> DataFrame:
    master = t["Menu_Items"].select("menu_item_id", F.col("unit_of_measure").alias("menu_unit"))
    unit, menu_unit = F.col("unit_of_measure"), F.col("menu_unit")
    bad = unit != menu_unit
    if strict:
        bad = F.coalesce(F.trim(unit) != F.trim(menu_unit), F.lit(False)) | F.coalesce(
            ~normalised(unit).isin(*VALID_UNITS), F.lit(True)
        )
    frames = []
    for n in ("Inventory", "Wastage"):
        counted = groups[n] if groups else t[n].withColumn("_n", F.lit(1))
        per_unit = counted.groupBy("menu_item_id", "unit_of_measure").agg(F.sum("_n").cast("bigint").alias("_n"))
        frames.append(_weighted(per_unit.join(master, "menu_item_id", "left"), "inconsistent_units", n, bad))
    return _union(frames)


def _row_rule(name: str) -> Callable[..., DataFrame]:
    def rule(t: Tables, strict: bool = False, as_of: str = LATEST) -> DataFrame:
        return _row_rules(t, strict, as_of, name)

    return rule


RULES: dict[str, Callable[..., DataFrame]] = {
    "missing_values": _row_rule("missing_values"),
    "duplicate_orders": duplicate_orders,
    "duplicate_order_lines": duplicate_lines,
    "invalid_menu_prices": invalid_prices,
    "negative_quantities": _row_rule("negative_quantities"),
    "invalid_dates": _row_rule("invalid_dates"),
    "invalid_ratings": _row_rule("invalid_ratings"),
    "missing_customer_ids": _row_rule("missing_customer_ids"),
    "missing_menu_ids": _row_rule("missing_menu_ids"),
    "invalid_restaurant_ids": invalid_restaurant_ids,
    "impossible_wastage": impossible_wastage,
    "incorrect_discounts": _row_rule("incorrect_discounts"),
    "cancelled_transactions": _row_rule("cancelled_transactions"),
    "inconsistent_units": inconsistent_units,
    "invalid_location_references": invalid_locations,
}
def run_quality(t: Tables, strict: bool = False, max_rate: float = 0.10, as_of: str = LATEST) -> DataFrame:
    """All rules: total, rows checked, defect rate and whether the rate lies in (0, max_rate].

    Each table is read once for its row conditions, and once more for its duplicates. Orders, stock and wastage are
    grouped on the way, by place, item and unit; the rules on references, units and stock read those small groups.
    Rows checked counts each table of a rule once, however many of its columns were tested.
    """
    parts = _by_table(strict, as_of)
    frames = [tally(t[name], own) for name, own in parts.items() if name not in GROUPED]
    on = ["menu_item_id", "restaurant_id"]
    stock_parts, waste = parts.get("Inventory", {}), t["Wastage"]
    groups = {
        "Orders": _groups(t["Orders"], "Orders", parts["Orders"]),
        "Inventory": _groups(t["Inventory"], "Inventory", stock_parts, F.max("closing_quantity").alias("max_closing")),
    }
    waste_parts = dict(parts.get("Wastage", {}))
    if not strict:
        stock = groups["Inventory"].groupBy(*on).agg(F.max("max_closing").alias("max_closing"))
        waste, above = _above_stock(waste, stock)
        waste_parts["impossible_wastage", "Wastage"] = above
    groups["Wastage"] = _groups(waste, "Wastage", waste_parts)
    for name, own in (("Orders", parts["Orders"]), ("Inventory", stock_parts), ("Wastage", waste_parts)):
        if own:
            frames.append(_tally_groups(groups[name], own))
    frames += [duplicate_orders(t, strict), duplicate_lines(t, strict)]
    frames += [rule(t, strict, groups) for rule in (invalid_restaurant_ids, inconsistent_units, invalid_locations)]
    if strict:
        frames += [impossible_wastage(t, strict), steep_prices(t)]
    per_table = _union(frames).groupBy("rule", F.substring_index("part", ".", 1).alias("tbl")).agg(
        F.sum("bad").alias("bad"), F.max("checked").alias("checked")
    )
    totals = per_table.groupBy("rule").agg(F.sum("bad").alias("total"), F.sum("checked").alias("rows_checked"))
    rate = F.col("total") / F.nullif(F.col("rows_checked"), F.lit(0))
    return totals.withColumn("rate", F.round(rate, 6)).withColumn(
        "in_gate", F.coalesce((rate > 0) & (rate <= max_rate), F.lit(False))
    )
