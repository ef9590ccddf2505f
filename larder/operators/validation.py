"""Integrity checks, demand patterns and business cases, reported as rows instead of raised."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.relational import existence_flag, interval_join, with_scalars, with_thresholds
from larder.functions.scalar import dbl, is_peak_hour, is_weekend, mean, normalised, ratio
from larder.operators.features import sales
from larder.sources.schemas import CRITICAL_COLUMNS, FOREIGN_KEYS, MIN_ROWS, PRIMARY_KEYS
from larder.sources.staging import settle

Tables = Mapping[str, DataFrame]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _unpivot(one_row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns])
    return one_row.select(F.explode(entries).alias("e")).select("e.*")


def check_rows(t: Tables, minimum: Mapping[str, int] = MIN_ROWS) -> DataFrame:
    frames = []
    for name, low in minimum.items():
        n = F.col("actual")
        frames.append(
            t[name].agg(F.count("*").alias("actual")).select(
                F.lit(name).alias("table"),
                F.lit("rows").alias("check"),
                "actual",
                F.lit(low).cast("bigint").alias("minimum"),
                F.when(n == 0, "FAIL").when(n < low, "WARN").otherwise("PASS").alias("status"),
            )
        )
    return _union(frames)


def check_columns(t: Tables, required: Mapping[str, Sequence[str]] = CRITICAL_COLUMNS) -> DataFrame:
    frames = []
    for name, cols in required.items():
        missing = ", ".join(c for c in cols if c not in t[name].columns)
        frames.append(
            t[name].agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("table"),
                F.lit("columns").alias("check"),
                "rows",
                F.lit(missing).alias("missing"),
                F.lit("FAIL" if missing else "PASS").alias("status"),
            )
        )
    return _union(frames)


def check_nulls(t: Tables, critical: Mapping[str, Sequence[str]] = CRITICAL_COLUMNS) -> DataFrame:
    frames = []
    for name, cols in critical.items():
        counts = t[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        frames.append(_unpivot(counts, cols, "column", "nulls").withColumn("table", F.lit(name)))
    return _union(frames).select(
        "table",
        F.concat(F.lit("nulls_in_"), F.col("column")).alias("check"),
        "nulls",
        F.when(F.col("nulls") == 0, "PASS").otherwise("WARN").alias("status"),
    )


def check_dates(orders: DataFrame, feature_cutoff: str, label_start: str) -> DataFrame:
    return orders.agg(F.min("order_timestamp").alias("min_date"), F.max("order_timestamp").alias("max_date")).select(
        F.lit("date_range").alias("check"),
        "min_date",
        "max_date",
        F.lit(feature_cutoff).alias("feature_cutoff"),
        F.lit(label_start).alias("label_start"),
        F.when(F.col("max_date") >= F.lit(label_start).cast("timestamp"), "PASS").otherwise("WARN").alias("status"),
    )


def active_months(orders: DataFrame, min_share: float = 0.01) -> DataFrame:
    """Months and their part of all orders; a month is active from ``min_share`` on."""
    monthly = orders.where(F.col("order_timestamp").isNotNull()).groupBy(
        F.trunc(F.to_date("order_timestamp"), "month").alias("month")
    ).agg(F.count("*").alias("orders"))
    share = F.col("orders") / F.col("_all")
    return (
        with_scalars(monthly, monthly.agg(F.sum("orders").alias("_all")))
        .withColumns({"share": F.round(share, 6), "active": share >= min_share})
        .drop("_all")
    )


def check_summary(checks: Sequence[DataFrame]) -> DataFrame:
    status = _union([c.select("status") for c in checks])
    return status.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("status") == s.upper()).alias(s) for s in ("pass", "warn", "fail")],
    )


def check_keys(t: Tables, keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS) -> DataFrame:
    frames = []
    for name, cols in keys.items():
        frames.append(
            t[name].agg(F.count("*").alias("rows"), F.countDistinct(F.struct(*cols)).alias("distinct_keys")).select(
                F.lit(name).alias("table"),
                F.lit(", ".join(cols)).alias("key"),
                "rows",
                "distinct_keys",
                (F.col("rows") == F.col("distinct_keys")).alias("unique"),
            )
        )
    return _union(frames)


def check_fks(t: Tables, refs: Sequence[tuple[str, str, str, str, float]] = FOREIGN_KEYS) -> DataFrame:
    """Orphan share of non-null references against the tolerated share."""
    frames = []
    for child, col, parent, key, tolerated in refs:
        known = t[parent].select(F.col(key).alias(col))
        per_key = t[child].where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_n"))
        counts = existence_flag(per_key, known, [col], "_ok").agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
            F.coalesce(F.sum(F.when(~F.col("_ok"), F.col("_n"))), F.lit(0)).alias("orphans"),
        )
        rate = F.coalesce(F.col("orphans") / F.nullif(F.col("checked"), F.lit(0)), F.lit(0.0))
        frames.append(
            counts.select(
                F.lit(f"{child}.{col}").alias("reference"),
                F.lit(parent).alias("parent"),
                "checked",
                "orphans",
                F.round(rate, 6).alias("rate"),
                (rate <= tolerated).alias("ok"),
            )
        )
    return _union(frames)


def check_formula(df: DataFrame, name: str, valid: Column, expected: Column, actual: str, tol: float = 0.011, min_share: float = 0.99) -> DataFrame:
    """Share of valid rows whose value matches the formula."""
    hit = F.abs(dbl(expected) - dbl(actual)) <= tol
    share = F.col("matching") / F.nullif(F.col("valid"), F.lit(0))
    return df.agg(F.count_if(valid).alias("valid"), F.count_if(valid & hit).alias("matching")).select(
        F.lit(name).alias("formula"), "valid", "matching", F.round(share, 6).alias("share"), (share >= min_share).alias("ok")
    )


def check_amounts(t: Tables, tol: float = 0.011, min_share: float = 0.99) -> DataFrame:
    q, p, d = F.col("quantity"), F.col("unit_price"), F.col("discount_amount")
    s, o = F.col("subtotal"), F.col("discount_total")
    line_ok = (q > 0) & (p > 0) & (d >= 0) & F.col("line_total").isNotNull()
    order_ok = s.isNotNull() & o.isNotNull() & F.col("total_amount").isNotNull()
    return check_formula(t["Order_Items"], "line_total", line_ok, q * p - d, "line_total", tol, min_share).unionByName(
        check_formula(t["Orders"], "total_amount", order_ok, s - o, "total_amount", tol, min_share)
    )


def check_domain(df: DataFrame, col: str, allowed: Sequence[str], min_share: float = 0.99) -> DataFrame:
    """Share of known values inside the allowed set, and the number of different values."""
    v = normalised(col)
    share = F.col("inside") / F.nullif(F.col("known"), F.lit(0))
    return df.agg(
        F.count(col).alias("known"),
        F.count_if(v.isin(*[a.strip().lower() for a in allowed])).alias("inside"),
        F.countDistinct(col).alias("distinct_values"),
    ).select(
        F.lit(col).alias("column"), "known", "inside", "distinct_values", F.round(share, 6).alias("share"), (share >= min_share).alias("ok")
    )


def check_rating_targets(ratings: DataFrame, promotions: DataFrame) -> DataFrame:
    """Ratings that name an item or a restaurant, and campaigns that do not end before they start."""
    has = F.col("menu_item_id").isNotNull() | F.col("restaurant_id").isNotNull()
    return ratings.agg(F.lit("rating_target").alias("check"), F.count("*").alias("rows"), F.count_if(has).alias("good")).unionByName(
        promotions.agg(
            F.lit("promotion_dates").alias("check"),
            F.count("*").alias("rows"),
            F.count_if(F.col("end_date") >= F.col("start_date")).alias("good"),
        )
    )


def check_parity(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of the CSV and the Parquet form of a table."""
    frames = [
        csv.agg(F.count("*").alias("csv_rows")).select(
            F.lit(n).alias("table"), "csv_rows", parquet.agg(F.count("*")).scalar().alias("parquet_rows")
        )
        for n, (csv, parquet) in pairs.items()
    ]
    return _union(frames).withColumn("ok", F.col("csv_rows") == F.col("parquet_rows"))


def orders_before_registration(orders: DataFrame, customers: DataFrame) -> DataFrame:
    joined = orders.select("customer_id", "order_timestamp").join(customers, "customer_id")
    return joined.agg(
        F.count("*").alias("checked"),
        F.count_if(F.to_date("order_timestamp") < F.col("registration_date")).alias("violations"),
    )


def check_demand_patterns(orders: DataFrame) -> DataFrame:
    """Friday-to-Sunday share, deviation of month shares and peak-hour share."""
    ts = F.col("order_timestamp")
    known = orders.where(ts.isNotNull())
    shares = known.agg(
        (F.count_if(F.weekday(ts) >= 4) / F.count("*")).alias("weekend_share"),
        (F.count_if(is_peak_hour(ts)) / F.count("*")).alias("peak_share"),
        F.count("*").alias("_n"),
    )
    months = known.groupBy(F.month(ts).alias("m")).agg(F.count("*").alias("c"))
    spread = months.agg(F.stddev_samp("c").alias("_s"))
    both = with_scalars(shares, spread).withColumn("month_share_std", F.col("_s") / F.col("_n"))
    values = both.select(*[F.round(c, 6).alias(c) for c in ("weekend_share", "month_share_std", "peak_share")])
    floors = {"weekend_share": 0.40, "month_share_std": 0.005, "peak_share": 0.60}
    limit = F.create_map(*[x for k, v in floors.items() for x in (F.lit(k), F.lit(v))])
    return _unpivot(values, list(floors), "pattern", "value").withColumn("ok", F.col("value") >= limit[F.col("pattern")])


def _item_stats(t: Tables) -> DataFrame:
    lines = t["Order_Items"].where(F.col("menu_item_id").isNotNull() & F.col("quantity").isNotNull())
    stats = lines.groupBy("menu_item_id").agg(
        dbl(F.sum("quantity")).alias("qty"),
        dbl(F.sum(F.col("line_total") - F.col("quantity") * F.col("unit_cost"))).alias("margin"),
        dbl(F.sum("line_total")).alias("revenue"),
    )
    return stats.withColumn("margin_pct", F.when(F.col("revenue") > 0, F.col("margin") / F.col("revenue")).otherwise(0.0))


# fixed values: case -> (condition, least number of items)
BUSINESS_CASES = {
    "popular_low_margin": ("qty >= q75 AND margin_pct <= m25", 1),
    "popular_loss_making": ("qty >= q75 AND margin < 0", 1),
    "profitable_low_selling": ("qty <= q25 AND margin_pct >= m75", 1),
    "high_wastage": ("wasted >= w75", 3),
    "popular_high_wastage": ("qty >= q75 AND wasted >= w75", 1),
    "well_rated_unprofitable": ("rating >= 4.0 AND margin_pct <= m25", 1),
    "badly_rated_popular": ("rating <= 2.5 AND qty >= q75", 1),
}


def check_business_cases(t: Tables) -> DataFrame:
    """Number of items per business case, with quartiles over all items."""
    wasted = t["Wastage"].groupBy("menu_item_id").agg(dbl(F.sum("quantity_wasted")).alias("wasted"))
    rated = t["Ratings"].where(F.col("rating_value").between(1, 5)).groupBy("menu_item_id").agg(mean("rating_value").alias("rating"))
    items = _item_stats(t).join(wasted, "menu_item_id", "left").join(rated, "menu_item_id", "left")
    judged = with_thresholds(
        settle(items, "item_cases"),
        {"q75": ("qty", 0.75), "q25": ("qty", 0.25), "m75": ("margin_pct", 0.75), "m25": ("margin_pct", 0.25), "w75": ("wasted", 0.75)},
    )
    counts = judged.agg(*[F.count_if(F.expr(c)).alias(n) for n, (c, _) in BUSINESS_CASES.items()])
    least = F.create_map(*[x for n, (_, k) in BUSINESS_CASES.items() for x in (F.lit(n), F.lit(k))])
    return _unpivot(counts, list(BUSINESS_CASES), "business_case", "items").withColumn(
        "ok", F.col("items") >= least[F.col("business_case")]
    )


def spike_and_drop_items(daily: DataFrame, min_days: int = 30, min_mean: float = 3, high: float = 4, low: float = 0.15) -> DataFrame:
    """Items whose best day exceeds ``high`` times, or worst day falls below ``low`` times, their mean day."""
    stats = daily.groupBy("menu_item_id").agg(
        F.count("*").alias("n"), F.avg("qty").alias("m"), F.max("qty").alias("hi"), F.min("qty").alias("lo")
    ).where((F.col("n") >= min_days) & (F.col("m") >= min_mean))
    return stats.agg(
        F.count("*").alias("items"),
        F.count_if(F.col("hi") > F.col("m") * high).alias("spike_items"),
        F.count_if(F.col("lo") < F.col("m") * low).alias("drop_items"),
    )


def rating_concentration(ratings: DataFrame, sigmas: float = 5, high: float = 4.3, low: float = 2.2) -> DataFrame:
    """Item-days with far more ratings than usual over all item-days, and how many are very good or bad."""
    daily = (
        ratings.where(F.col("rating_value").between(1, 5) & F.col("menu_item_id").isNotNull() & F.col("rating_timestamp").isNotNull())
        .groupBy("menu_item_id", F.to_date("rating_timestamp").alias("d"))
        .agg(F.count("*").alias("n"), mean("rating_value").alias("r"))
    )
    limit = daily.agg((F.avg("n") + sigmas * F.stddev_samp("n")).alias("_limit"))
    many = with_scalars(daily, limit).where(F.col("n") > F.col("_limit"))
    return many.agg(
        F.count("*").alias("concentrations"),
        F.count_if(F.col("r") >= high).alias("spikes"),
        F.count_if(F.col("r") <= low).alias("drops"),
    )


def promotion_checks(t: Tables, start: str, end: str) -> DataFrame:
    """Per campaign: units and margin in the window against the equally long time before, and the daily rate in and out.

    The whole-period quantity of the campaign items comes from item totals, so only the
    window days themselves are joined to sales.
    """
    s = sales(t["Orders"], t["Order_Items"]).where(F.col("menu_item_id").isNotNull())
    per_day = s.groupBy("menu_item_id", "date").agg(F.sum("quantity").alias("q"), F.sum("line_margin").alias("m"))
    length = F.datediff("end_date", "start_date")
    windows = t["Promotion_Items"].join(t["Promotions"].select("promotion_id", "start_date", "end_date"), "promotion_id").select(
        "promotion_id", "menu_item_id", "start_date", "end_date", F.date_sub("start_date", length).alias("_from")
    )
    hit = interval_join(per_day, windows, ["menu_item_id"], "date", "_from", "end_date")
    inside = F.col("date") >= F.col("start_date")
    sums = hit.groupBy("promotion_id").agg(
        dbl(F.coalesce(F.sum(F.when(inside, F.col("q"))), F.lit(0))).alias("units_in"),
        dbl(F.coalesce(F.sum(F.when(~inside, F.col("q"))), F.lit(0))).alias("units_before"),
        dbl(F.coalesce(F.sum(F.when(inside, F.col("m"))), F.lit(0))).alias("margin_in"),
        dbl(F.coalesce(F.sum(F.when(~inside, F.col("m"))), F.lit(0))).alias("margin_before"),
    )
    totals = (
        t["Promotion_Items"]
        .join(per_day.groupBy("menu_item_id").agg(F.sum("q").alias("q")), "menu_item_id")
        .groupBy("promotion_id")
        .agg(dbl(F.sum("q")).alias("units_all"))
    )
    days = F.datediff("end_date", "start_date") + 1
    all_days = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date"))
    out_rate = (F.col("units_all") - F.col("units_in")) / F.greatest(F.lit(1), all_days - days)
    trap = (F.col("units_before") > 0) & (F.col("units_in") >= 1.2 * F.col("units_before")) & (F.col("margin_in") < F.col("margin_before"))
    return (
        t["Promotions"]
        .select("promotion_id", "start_date", "end_date")
        .join(sums, "promotion_id")
        .join(totals, "promotion_id")
        .select(
            "promotion_id",
            "units_in",
            "units_before",
            "margin_in",
            "margin_before",
            "units_all",
            trap.alias("trap"),
            (F.col("units_in") / days >= 2 * F.greatest(out_rate, F.lit(0.1))).alias("dependent"),
        )
    )


def item_patterns(t: Tables, end: str, new_days: int = 120) -> DataFrame:
    """Per item: spread over restaurants, weekend share of lines, peak-month share and first sale, with flags."""
    s = sales(t["Orders"], t["Order_Items"]).where(F.col("menu_item_id").isNotNull())
    places = s.groupBy("menu_item_id", "restaurant_id").agg(dbl(F.sum("quantity")).alias("q"))
    spread = places.where(F.col("restaurant_id").isNotNull()).groupBy("menu_item_id").agg(
        (F.stddev_samp("q") / F.nullif(F.avg("q"), F.lit(0.0))).alias("cv")
    )
    months = s.groupBy("menu_item_id", F.month("order_timestamp").alias("m")).agg(
        dbl(F.sum("quantity")).alias("q"),
        F.count("*").alias("n"),
        F.count_if(is_weekend("order_timestamp")).alias("w"),
        F.min("order_timestamp").alias("first_sale"),
    )
    share = months.groupBy("menu_item_id").agg(
        (F.sum("w") / F.sum("n")).alias("weekend_share"),
        F.when(F.sum("q") > 0, F.max("q") / F.sum("q")).alias("peak_month_share"),
        F.min("first_sale").alias("first_sale"),
    )
    return share.join(spread, "menu_item_id", "left").select(
        "menu_item_id",
        F.round("cv", 6).alias("location_cv"),
        F.round("weekend_share", 6).alias("weekend_share"),
        F.round("peak_month_share", 6).alias("peak_month_share"),
        "first_sale",
        F.coalesce(F.col("cv") > 0.5, F.lit(False)).alias("location_specific"),
        (F.col("weekend_share") > 0.65).alias("weekend_only"),
        F.coalesce(F.col("peak_month_share") > 0.35, F.lit(False)).alias("seasonal"),
        (F.col("first_sale") > F.date_sub(F.lit(end).cast("date"), new_days)).alias("new_item"),
    )


def pattern_counts(patterns: DataFrame) -> DataFrame:
    names = ["location_specific", "weekend_only", "seasonal", "new_item"]
    return _unpivot(patterns.agg(*[F.count_if(F.col(c)).alias(c) for c in names]), names, "pattern", "items")


# fixed values: feature -> (table, column, low, high, tolerated NULL share)
FEATURE_SPEC: list[tuple[str, str, float | None, float | None, float]] = [
    ("item", "revenue", 0, None, 0.0),
    ("item", "cost", 0, None, 0.0),
    ("item", "contribution_margin", None, None, 0.0),
    ("item", "profit_pct", -1, 1, 0.0),
    ("item", "order_frequency", 0, None, 0.0),
    ("item", "quantity_sold", 0, None, 0.0),
    ("item", "repeat_purchase_rate", 0, 1, 0.0),
    ("item", "avg_rating", 1, 5, 0.2),
    ("item", "rating_trend", -4, 4, 0.2),
    ("item", "wastage_pct", 0, None, 0.0),
    ("item", "promotion_dependency", 0, 1, 0.0),
    ("item", "discount_pct", 0, 1, 0.0),
    ("item", "price_change_pct", -1, None, 0.0),
    ("customer", "recency_days", 0, None, 0.0),
    ("customer", "order_count", 0, None, 0.0),
    ("customer", "monetary", 0, None, 0.0),
    ("customer", "average_order_value", 0, None, 0.0),
    ("customer", "weekend_ratio", 0, 1, 0.0),
    ("customer", "preferred_channel", None, None, 0.25),
    ("order", "is_peak_hour", 0, 1, 0.0),
    ("order", "basket_size", 1, None, 0.0),
    ("location_item", "revenue", 0, None, 0.0),
]


def check_features(features: Mapping[str, DataFrame]) -> DataFrame:
    """Type, NULL share and range of every expected feature; one aggregation per feature table."""
    frames = []
    for name, df in features.items():
        spec = [s for s in FEATURE_SPEC if s[0] == name]
        types = dict(df.dtypes)
        aggs = [F.count("*").alias("_n")]
        for i, (_, c, low, high, _) in enumerate(spec):
            outside = F.lit(False)
            if low is not None:
                outside = outside | (F.col(c) < low)
            if high is not None:
                outside = outside | (F.col(c) > high)
            aggs += [F.count(c).alias(f"_k{i}"), F.count_if(outside).alias(f"_o{i}")]
        rows = F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.lit(types[c]).alias("type"),
                    F.round(1 - F.col(f"_k{i}") / F.nullif(F.col("_n"), F.lit(0)), 6).alias("null_share"),
                    F.col(f"_o{i}").alias("out_of_range"),
                    F.lit(tolerated).alias("tolerated"),
                )
                for i, (_, c, _, _, tolerated) in enumerate(spec)
            ]
        )
        frames.append(df.agg(*aggs).select(F.lit(name).alias("feature_table"), F.explode(rows).alias("e")).select("feature_table", "e.*"))
    return (
        _union(frames)
        .withColumn("ok", (F.col("null_share") <= F.col("tolerated")) & (F.col("out_of_range") == 0))
        .drop("tolerated")
    )


def check_clean_layer(raw: Tables, clean: Tables) -> DataFrame:
    """Invariants of the cleaned tables: number of violations per rule."""
    o, lines = clean["Orders"], clean["Order_Items"]
    d, q, p = F.col("discount_amount"), F.col("quantity"), F.col("unit_price")
    gross = q * p + F.lit("0.01").cast("decimal(4,2)")

    def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
        return _unpivot(df.agg(*[c.alias(n) for n, c in rules.items()]), list(rules), "rule", "violations")

    frames = [
        violations(
            o,
            {
                "duplicate_order_ids": F.count("*") - F.countDistinct("order_id"),
                "orders_without_customer": F.count_if(F.col("customer_id").isNull()),
                "orders_without_restaurant": F.count_if(F.col("restaurant_id").isNull()),
            },
        ),
        violations(
            lines,
            {
                "duplicate_line_ids": F.count("*") - F.countDistinct("order_item_id"),
                "lines_without_item": F.count_if(F.col("menu_item_id").isNull()),
                "lines_without_quantity": F.count_if(~F.coalesce(q > 0, F.lit(False))),
                "lines_without_price": F.count_if(~F.coalesce(p > 0, F.lit(False))),
                "discount_outside_line": F.count_if(~F.coalesce((d >= 0) & (d <= gross), F.lit(False))),
            },
        ),
        violations(clean["Ratings"], {"ratings_outside_1_5": F.count_if(~F.coalesce(F.col("rating_value").between(1, 5), F.lit(False)))}),
        violations(clean["Wastage"], {"negative_wastage": F.count_if(F.col("quantity_wasted") < 0)}),
    ]
    refs = [
        ("Orders", "customer_id", "Customers", "customer_id", 0.0),
        ("Orders", "restaurant_id", "Restaurants", "restaurant_id", 0.0),
        ("Order_Items", "order_id", "Orders", "order_id", 0.0),
        ("Order_Items", "menu_item_id", "Menu_Items", "menu_item_id", 0.0),
        ("Wastage", "restaurant_id", "Restaurants", "restaurant_id", 0.0),
    ]
    frames.append(
        check_fks(clean, refs).select(F.concat(F.lit("orphans_"), F.col("reference")).alias("rule"), F.col("orphans").alias("violations"))
    )
    for name in ("Orders", "Order_Items", "Ratings", "Inventory", "Wastage"):
        n_raw = raw[name].agg(F.count("*")).scalar()
        frames.append(
            clean[name].agg(F.count("*").alias("n")).select(
                F.lit(f"rows_created_{name}").alias("rule"), F.greatest(F.lit(0), F.col("n") - n_raw).cast("bigint").alias("violations")
            )
        )
    return _union(frames).withColumn("ok", F.col("violations") == 0)


def stage_consistency(raw: Tables, clean: Tables, order_features: DataFrame, min_kept: float = 0.9) -> DataFrame:
    """Distinct orders in the raw, clean and feature stages and the share kept."""
    counts = raw["Orders"].agg(F.countDistinct("order_id").alias("raw_orders"))
    counts = counts.withColumn("clean_orders", clean["Orders"].agg(F.count("*")).scalar())
    counts = counts.withColumn("feature_orders", order_features.agg(F.count("*")).scalar())
    kept = F.col("clean_orders") / F.col("raw_orders")
    return counts.withColumns({"kept_share": F.round(kept, 6), "ok": (kept >= min_kept) & (F.col("feature_orders") <= F.col("clean_orders"))})


def difficult_cases(t: Tables, new_days: int = 120) -> DataFrame:
    """Items per difficult case, judged on valid lines only."""
    lines = t["Order_Items"].where((F.col("quantity") > 0) & (F.col("unit_price") > 0) & F.col("menu_item_id").isNotNull())
    s = sales(t["Orders"], lines)
    items = s.groupBy("menu_item_id").agg(
        dbl(F.sum("quantity")).alias("qty"),
        dbl(F.sum("line_margin")).alias("margin"),
        dbl(F.sum("line_total")).alias("revenue"),
        F.min("order_timestamp").alias("first_sale"),
        dbl(F.sum(F.when(is_weekend("order_timestamp"), F.col("quantity")).otherwise(0))).alias("weekend_qty"),
    )
    wasted = t["Wastage"].where(F.col("quantity_wasted") > 0).groupBy("menu_item_id").agg(dbl(F.sum("quantity_wasted")).alias("wasted"))
    spread = (
        s.where(F.col("restaurant_id").isNotNull())
        .groupBy("menu_item_id", "restaurant_id")
        .agg(dbl(F.sum("quantity")).alias("q"))
        .groupBy("menu_item_id")
        .agg((F.max("q") / F.greatest(F.min("q"), F.lit(1.0))).alias("spread"))
    )
    joined = (
        items.join(wasted, "menu_item_id", "left")
        .join(spread, "menu_item_id", "left")
        .withColumns({"margin_pct": ratio("margin", "revenue"), "waste_ratio": ratio("wasted", "qty"), "weekend_share": ratio("weekend_qty", "qty")})
    )
    judged = with_thresholds(
        settle(joined, "item_difficulties"),
        {
            "q75": ("qty", 0.75),
            "q50": ("qty", 0.5),
            "q25": ("qty", 0.25),
            "m75": ("margin_pct", 0.75),
            "w50": ("waste_ratio", 0.5),
        },
    )
    judged = judged.withColumn("_end", t["Orders"].agg(F.max("order_timestamp")).scalar())
    rules = {
        "top_seller_with_loss": F.expr("qty >= q75 AND margin < 0"),
        "slow_seller_with_high_margin": F.expr("qty <= q25 AND margin_pct >= m75"),
        "popular_with_double_wastage": F.expr("waste_ratio >= 2 * w50 AND qty >= q75"),
        "new_item": F.col("first_sale") >= F.col("_end") - F.make_dt_interval(F.lit(new_days)),
        "location_spread": F.expr("qty >= q50 AND spread >= 3"),
        "weekend_item": F.col("weekend_share") >= 0.6,
    }
    return _unpivot(judged.agg(*[F.count_if(c).alias(n) for n, c in rules.items()]), list(rules), "difficult_case", "items")
