"""Campaign effects before, during and after their windows, and promotion traps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.relational import interval_join, with_scalars
from larder.functions.scalar import dbl, ratio_or_zero, rnd
from larder.operators.features import sales

PHASES = ("pre", "during", "post")


def promo_windows(
    facts: DataFrame,
    promos: DataFrame,
    promo_items: DataFrame,
    ts: str = "order_timestamp",
    pre: int = 14,
    post: int = 14,
    inclusive_end: bool = True,
) -> DataFrame:
    """Facts on campaign items with the campaign and the phase they fall into.

    With ``inclusive_end=False`` a window ends at the midnight that starts its last day,
    so sales later that day count as post.
    """
    windows = promo_items.join(promos.select("promotion_id", "start_date", "end_date"), "promotion_id").select(
        F.col("promotion_id").alias("campaign_id"),
        "menu_item_id",
        "start_date",
        "end_date",
        F.date_sub("start_date", pre).alias("_from"),
        F.date_add("end_date", post).alias("_to"),
    )
    hit = interval_join(facts, windows, ["menu_item_id"], ts, "_from", "_to", inclusive_end)
    moment = F.to_date(ts) if inclusive_end else F.col(ts)
    end = F.col("end_date") if inclusive_end else F.col("end_date").cast("timestamp")
    phase = F.when(F.to_date(ts) < F.col("start_date"), "pre").when(moment <= end, "during").otherwise("post")
    return hit.withColumn("phase", phase).drop("_from", "_to")


def _wastage_effect(wastage: DataFrame, promos: DataFrame, promo_items: DataFrame, pre: int) -> DataFrame:
    hit = promo_windows(wastage, promos, promo_items, "wastage_date", pre=pre, post=0)
    during, before = F.col("phase") == "during", F.col("phase") == "pre"
    sums = hit.groupBy("campaign_id").agg(
        dbl(F.sum(F.when(during, F.col("quantity_wasted")))).alias("wastage_qty"),
        dbl(F.sum(F.when(during, F.col("wastage_cost")))).alias("wastage_cost"),
        F.count_if(during).alias("wastage_records"),
        dbl(F.sum(F.when(before, F.col("quantity_wasted")))).alias("pre_wastage_qty"),
    )
    return sums.select(F.col("campaign_id").alias("promotion_id"), *[c for c in sums.columns if c != "campaign_id"])


def promo_effectiveness(
    orders: DataFrame,
    lines: DataFrame,
    promos: DataFrame,
    promo_items: DataFrame,
    wastage: DataFrame,
    pre: int = 14,
    post: int = 14,
    inclusive_end: bool = True,
) -> DataFrame:
    """One row per campaign with phase metrics, changes, customer behaviour and wastage.

    Distinct orders and customers come from a chain of group-bys (campaign, phase, order),
    (campaign, customer), (campaign), each with map-side partial sums.
    """
    s = sales(orders, lines).select(
        "menu_item_id", "order_id", "customer_id", "order_timestamp", "quantity", "line_total", "line_margin"
    )
    hit = promo_windows(s, promos, promo_items, "order_timestamp", pre, post, inclusive_end)
    amounts = {"revenue": "line_total", "profit": "line_margin", "qty": "quantity"}
    per_order = hit.groupBy("campaign_id", "phase", "order_id", "customer_id").agg(
        *[F.sum(c).alias(n) for n, c in amounts.items()]
    )

    def in_phase(p: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("phase") == p, value)), F.lit(0))

    per_customer = per_order.groupBy("campaign_id", "customer_id").agg(
        *[in_phase(p, F.lit(1)).alias(f"{p}_orders") for p in PHASES],
        *[in_phase(p, F.col(n)).alias(f"{p}_{n}") for p in PHASES for n in amounts],
    )
    known = F.col("customer_id").isNotNull()
    buys = {p: known & (F.col(f"{p}_orders") > 0) for p in PHASES}
    per_campaign = per_customer.groupBy(F.col("campaign_id").alias("promotion_id")).agg(
        *[F.sum(f"{p}_orders").alias(f"{p}_orders") for p in PHASES],
        *[dbl(F.sum(f"{p}_{n}")).alias(f"{p}_{n}") for p in PHASES for n in amounts],
        *[F.count_if(buys[p]).alias(f"{p}_customers") for p in PHASES],
        F.count_if(buys["during"] & ~buys["pre"]).alias("new_customers"),
        F.count_if(buys["during"] & buys["pre"]).alias("repeat_customers"),
    )
    n_items = promo_items.groupBy("promotion_id").agg(F.count("*").alias("n_items"))
    filled = (
        promos.select("promotion_id", "promotion_name", "start_date", "end_date")
        .join(n_items, "promotion_id")
        .join(per_campaign, "promotion_id", "left")
        .join(_wastage_effect(wastage, promos, promo_items, pre), "promotion_id", "left")
        .fillna(0)
    )
    derived = {f"{p}_aov": rnd(ratio_or_zero(f"{p}_revenue", f"{p}_orders"), 2) for p in PHASES}
    for p in ("pre", "during"):
        margin = F.when(F.col(f"{p}_revenue") != 0, F.col(f"{p}_profit") / F.col(f"{p}_revenue")).otherwise(0.0)
        derived[f"{p}_margin_pct"] = F.round(margin, 4)
        filled = filled.withColumn(f"{p}_qty", F.col(f"{p}_qty").cast("bigint"))
    filled = filled.withColumns(derived)

    def delta(c: str, digits: int) -> Column:
        return F.round(F.col(f"during_{c}") - F.col(f"pre_{c}"), digits)

    def change(c: str, base: Column) -> Column:
        moved = (F.col(f"during_{c}") - F.col(f"pre_{c}")) / base * 100
        return F.when(F.col(f"pre_{c}") != 0, F.round(moved, 2)).otherwise(0.0)

    waste_change = (F.col("wastage_qty") - F.col("pre_wastage_qty")) / F.col("pre_wastage_qty") * 100
    new_rate = rnd(ratio_or_zero("new_customers", "during_customers"), 4)
    return filled.drop("post_qty").withColumns(
        {
            "delta_revenue": delta("revenue", 2),
            "delta_profit": delta("profit", 2),
            "delta_orders": F.col("during_orders") - F.col("pre_orders"),
            "delta_qty": F.col("during_qty") - F.col("pre_qty"),
            "delta_aov": delta("aov", 2),
            "delta_margin_pct": delta("margin_pct", 4),
            "revenue_pct": change("revenue", F.nullif(F.col("pre_revenue"), F.lit(0.0))),
            "profit_pct": change("profit", F.abs(F.nullif(F.col("pre_profit"), F.lit(0.0)))),
            "acquisition_rate": new_rate,
            "repeat_rate": rnd(ratio_or_zero("repeat_customers", "during_customers"), 4),
            "wastage_pct_change": F.when(F.col("pre_wastage_qty") > 0, F.round(waste_change, 2)).otherwise(0.0),
            "promo_only_customers": F.col("new_customers"),
            "promo_only_rate": new_rate,
            "post_retention": rnd(ratio_or_zero("post_customers", "during_customers"), 4),
        }
    )


# fixed values: trap -> condition; the promo-only flag does not count towards the total
TRAPS = {
    "trap_sales_profit": "delta_revenue > 0 AND delta_profit < 0",
    "trap_customers_margin": "during_customers > pre_customers AND delta_margin_pct < -0.10",
    "trap_wastage": "wastage_pct_change > 50 AND delta_revenue > 0",
    "trap_promo_only": "promo_only_rate > 0.95 AND post_retention < 0.20",
    "trap_margin_shift": "profit_pct < -20",
}


def promo_traps(effectiveness: DataFrame, min_traps: int = 2) -> DataFrame:
    flagged = effectiveness.withColumns({n: F.expr(c) for n, c in TRAPS.items()})
    counted = [F.col(n).cast("int") for n in TRAPS if n != "trap_promo_only"]
    total = counted[0] + counted[1] + counted[2] + counted[3]
    return flagged.withColumn("trap_count", total).withColumn(
        "is_trap",
        (F.col("trap_count") >= min_traps) | (F.col("trap_sales_profit") & F.col("trap_margin_shift")),
    )


# fixed values: columns of the trap list
TRAP_LIST_COLUMNS = (
    "promotion_id",
    "promotion_name",
    "delta_revenue",
    "delta_profit",
    "revenue_pct",
    "profit_pct",
    "new_customers",
    "repeat_customers",
    "wastage_cost",
    "wastage_pct_change",
    "promo_only_rate",
    "trap_count",
)


def trap_list(traps: DataFrame) -> DataFrame:
    return traps.where("is_trap").select(*TRAP_LIST_COLUMNS)


def traps_summary(traps: DataFrame) -> DataFrame:
    return traps.agg(
        F.count("*").alias("total_campaigns"),
        *[F.count_if(F.col(n)).alias(n) for n in TRAPS],
        F.count_if(F.col("is_trap")).alias("total_trap_campaigns"),
    )


def promo_summary(traps: DataFrame) -> DataFrame:
    return traps.agg(
        F.count("*").alias("n_campaigns"),
        F.count_if(F.col("is_trap")).alias("n_traps"),
        *[F.round(F.avg(c), 4).alias(f"avg_{c}") for c in ("acquisition_rate", "repeat_rate", "post_retention")],
        F.sum("new_customers").alias("total_new_customers"),
        F.round(F.sum("wastage_cost"), 2).alias("total_wastage_cost"),
    )


def promo_window_share(
    orders: DataFrame, lines: DataFrame, promos: DataFrame, promo_items: DataFrame, min_share: float = 0.6, min_gain: float = 0.25
) -> DataFrame:
    """Part of an item's sales on its campaign days against the part of all days those cover."""
    per_day = (
        sales(orders, lines)
        .where(F.col("menu_item_id").isNotNull())
        .groupBy("menu_item_id", "date")
        .agg(F.sum("quantity").alias("q"))
    )
    span = orders.agg(F.to_date(F.min("order_timestamp")).alias("lo"), F.to_date(F.max("order_timestamp")).alias("hi"))
    covered = (
        with_scalars(promo_items.join(promos, "promotion_id"), span)
        .select(
            "menu_item_id",
            F.explode(F.sequence("start_date", "end_date")).alias("date"),
            "lo",
            "hi",
        )
        .where(F.col("date").between(F.col("lo"), F.col("hi")))
        .distinct()
    )
    coverage = covered.groupBy("menu_item_id").agg(
        (F.count("*") / F.max(F.datediff("hi", "lo") + 1)).alias("coverage")
    )
    marked = per_day.join(covered.select("menu_item_id", "date", F.lit(True).alias("_in")), ["menu_item_id", "date"], "left")
    share = marked.groupBy("menu_item_id").agg(
        (dbl(F.coalesce(F.sum(F.when(F.col("_in"), F.col("q"))), F.lit(0))) / F.nullif(dbl(F.sum("q")), F.lit(0.0))).alias("share")
    )
    return share.join(coverage, "menu_item_id").select(
        "menu_item_id",
        F.round("share", 6).alias("window_share"),
        F.round("coverage", 6).alias("coverage"),
        ((F.col("share") >= min_share) & (F.col("share") - F.col("coverage") >= min_gain)).alias("promotion_dependent"),
    )

