"""Join, threshold and ranking helpers that hold up on skewed keys.

Nothing here gathers a whole table into one task: quantiles go through a bounded
bracket, total orders through range buckets, as-of and interval joins through
calendar days.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.staging import settle

QUANTILE_ACCURACY = 10_000
QUANTILE_CELLS = 200


def exact_quantiles(df: DataFrame, spec: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row of exact, linearly interpolated quantiles: ``{name: (column, p)}``.

    A mergeable sketch brackets each quantile, and a second one within the bracket narrows it to a few of its
    QUANTILE_CELLS cells. One aggregation then counts the values below, groups those inside and keeps the nearest
    value on either side. About 6 / QUANTILE_ACCURACY / QUANTILE_CELLS of the rows reach the final sort. The frame is
    evaluated once, into a stage table of the columns asked for, which the passes read; the brackets are two numbers each.
    """
    names = list(spec)
    eps = 2.0 / QUANTILE_ACCURACY
    values = settle(df.select(*[F.col(c).cast("double").alias(n) for n, (c, _) in spec.items()]), "quantile_values")
    bracket = values.agg(
        *[F.percentile_approx(n, [max(0.0, p - eps), min(1.0, p + eps)], QUANTILE_ACCURACY).alias(n) for n, (_, p) in spec.items()]
    )
    ends = _ends(bracket)
    cells = []
    for n, (_, p) in spec.items():
        inside = F.when(F.col(n).between(*ends[n]), F.col(n))
        place = (F.count(n) - 1) * p - F.count_if(F.col(n) < ends[n][0])
        share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), place / F.nullif(F.count(inside), F.lit(0))))
        grid = F.percentile_approx(inside, [i / QUANTILE_CELLS for i in range(QUANTILE_CELLS + 1)], QUANTILE_ACCURACY)
        low, high = F.floor(share * QUANTILE_CELLS) - 1, F.ceil(share * QUANTILE_CELLS) + 1
        at = [F.greatest(low, F.lit(0)), F.least(high, F.lit(QUANTILE_CELLS))]
        cells.append(F.array(*[F.get(grid, end.cast("int")) for end in at]).alias(n))
    ends = _ends(values.agg(*cells))
    entries = []
    for n in names:
        side = F.when(F.col(n) < ends[n][0], -1).when(F.col(n) > ends[n][1], 1).otherwise(0)
        entry = [F.lit(n).alias("name"), F.lit(float(spec[n][1])).alias("p"), side.alias("side"), F.col(n).alias("x")]
        entries.append(F.struct(*entry))
    inside = F.when(F.col("side") == 0, F.col("x"))
    hist = (
        values.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .where("x IS NOT NULL")
        .groupBy("name", "p", "side", inside.alias("at"))
        .agg(F.count("*").alias("c"), F.when(F.col("side") < 0, F.max("x")).otherwise(F.min("x")).alias("x"))
    )
    by_name = Window.partitionBy("name")
    placed = (
        hist.withColumn("upto", F.sum("c").over(by_name.orderBy("side", "x")))
        .withColumn("n", F.sum("c").over(by_name))
        .withColumn("pos", (F.col("n") - 1) * F.col("p"))
        .withColumn("below", F.col("upto") - F.col("c"))
    )
    low, high = F.floor("pos"), F.ceil("pos")

    def covers(k: Column) -> Column:
        return (F.col("below") <= k) & (k < F.col("upto"))

    picked = placed.groupBy("name").agg(
        F.max(F.when(covers(low), F.col("x"))).alias("x0"),
        F.max(F.when(covers(high), F.col("x"))).alias("x1"),
        F.max(F.col("pos") - low).alias("f"),
    ).withColumn("q", F.col("x0") + (F.col("x1") - F.col("x0")) * F.col("f"))
    return picked.agg(*[F.max(F.when(F.col("name") == n, F.col("q"))).alias(n) for n in names])


def _ends(one_row: DataFrame) -> dict[str, list[Column]]:
    """The two numbers in each column of a one-row frame, as literals."""
    row = one_row.first()
    return {n: [F.lit(x).cast("double") for x in (row[n] if row[n] is not None else (None, None))] for n in one_row.columns}


def with_thresholds(df: DataFrame, spec: Mapping[str, tuple[str, float]], source: DataFrame | None = None) -> DataFrame:
    """Add quantile columns of ``source`` (default: ``df`` itself) to every row."""
    return with_scalars(df, exact_quantiles(source if source is not None else df, spec))


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame as scalar-subquery values."""
    names = one_row.columns
    packed = one_row.select(F.struct(*names).alias("t"))
    return df.withColumn("_one", packed.scalar()).select("*", *[F.col(f"_one.{n}").alias(n) for n in names]).drop("_one")


def ordered_index(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), index: str = "rn", total: str = "n"
) -> DataFrame:
    """Row number and row count within ``by`` under the total order ``order`` (it must end in a unique key)."""
    return running_total(df.withColumn("_unit", F.lit(1)), by, order, "_unit", index, total).drop("_unit")


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    full = cond[0]
    for c in cond[1:]:
        full = full & c
    return left.join(renamed, full).drop(*[f"_r_{c}" for c in on])


def spread_left_join(left: DataFrame, right: DataFrame, key: str, by: str, parts: int = 4096) -> DataFrame:
    """Left join on ``key`` where many rows have none: those go to ``parts`` keys of their own, by column ``by``.

    So rows with a NULL key, which never match, don't meet in one task.
    """
    own = F.when(F.col(key).isNull(), 1 + F.pmod(F.xxhash64(by), F.lit(parts))).otherwise(0)
    return left.withColumn("_spread", own).join(right.withColumn("_spread", F.lit(0).cast("bigint")), [key, "_spread"], "left").drop("_spread")


def percent_ranks(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """``key`` plus one ``<metric>_pr`` column per metric: (rank - 1) / (rows - 1), NULLs first.

    All metrics are ranked in one pass over the long form. Ties are collapsed before the
    ordering, so a value shared by most rows is a single histogram entry.
    """
    long = df.select(
        key,
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics])
        ).alias("e"),
    ).select(key, "e.metric", "e.x")
    hist = long.groupBy("metric", "x").agg(F.count("*").alias("c"))
    below = running_total(hist, by=["metric"], order=["x"], value="c", name="upto", total="rows")
    ranked = _null_safe_join(
        long,
        below.select(
            "metric",
            "x",
            F.when(F.col("rows") > 1, (F.col("upto") - F.col("c")) / (F.col("rows") - 1)).otherwise(0.0).alias("pr"),
        ),
        ["metric", "x"],
    )
    return ranked.groupBy(key).agg(*[F.max(F.when(F.col("metric") == m, F.col("pr"))).alias(f"{m}_pr") for m in metrics])


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, total: str, buckets: int | None = None
) -> DataFrame:
    """Inclusive running sum of ``value`` within ``by`` along a unique ``order``, plus the group sum.

    Rows are cut into range buckets whose bounds come from the rows with the smallest key
    hashes, a bounded sample that is the same on every evaluation. The window then runs per
    bucket and only the bucket sums are added up in order, so a group holding most rows is
    still spread over all buckets: four per shuffle partition unless their number is given.
    """
    if buckets is None:
        buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by, order = list(by), list(order)
    key = F.struct(*by, *order)
    per_bound = 10
    bounds = (
        df.select(key.alias("k"))
        .orderBy(F.xxhash64("k"), "k")
        .limit(per_bound * buckets)
        .agg(F.array_sort(F.collect_list("k")).alias("s"))
        .select(F.filter("s", lambda _, i: i % per_bound == per_bound - 1).alias("bounds"))
    )
    # binary search: how many bounds lie below the key
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(buckets.bit_length()))])
    below = F.aggregate(
        steps, F.lit(0), lambda found, s: found + F.when(F.get("_bounds", found + s - 1) < key, s).otherwise(0)
    )
    keyed = df.withColumn("_bounds", bounds.scalar()).withColumn("_bucket", below).drop("_bounds")
    bucket_sums = keyed.groupBy(*by, "_bucket").agg(F.sum(value).alias("_s"))
    across = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    offsets = bucket_sums.select(
        *by,
        "_bucket",
        (F.sum("_s").over(across.orderBy("_bucket")) - F.col("_s")).alias("_before"),
        F.sum("_s").over(across).alias(total),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.withColumn("_local", F.sum(value).over(inside))
    return (
        _null_safe_join(local, offsets, [*by, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_local"))
        .drop("_bucket", "_before", "_local")
    )


def qcut_scores(
    df: DataFrame, tie: str, scores: Mapping[str, tuple[str, bool]], q: int = 4, by: Sequence[str] = ()
) -> DataFrame:
    """``by``, ``tie`` and equal-count scores ``{name: (column, reverse)}`` of the first-come ranks.

    Scores run from 1 to q (q to 1 with reverse), ties broken by the unique ``tie`` column.
    All columns are ranked together in long form.
    """
    by = list(by)
    entries = F.array(
        *[F.struct(F.lit(n).alias("score"), F.col(c).cast("double").alias("x")) for n, (c, _) in scores.items()]
    )
    long = df.select(*by, tie, F.explode(entries).alias("e")).select(*by, tie, "e.*")
    ranked = ordered_index(long, ["x", tie], [*by, "score"], index="_rn", total="_n")
    step = F.when(F.col("_n") > 1, F.ceil((F.col("_rn") - 1) * q / (F.col("_n") - 1))).otherwise(1)
    placed = ranked.withColumn("_q", F.greatest(F.lit(1), step).cast("int"))
    columns = []
    for n, (_, reverse) in scores.items():
        value = F.max(F.when(F.col("score") == n, F.col("_q")))
        columns.append(((F.lit(q + 1) - value) if reverse else value).alias(n))
    return placed.groupBy(*by, tie).agg(*columns)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_day: str,
    right_day: str,
    cols: Sequence[str],
    pick: str = "max",
) -> DataFrame:
    """Latest ``right`` row on or before each ``left`` day, per ``on``; both sides at day grain.

    The ordered scan runs over the distinct (key, day) pairs of both sides, so its groups
    are bounded by the calendar however many rows a key has. Several right rows on one day
    are reduced to the one with the greatest (``max``) or smallest (``min``) ``cols``.
    """
    on, cols = list(on), list(cols)
    choose = F.max if pick == "max" else F.min
    days = left.select(*on, F.col(left_day).alias("_d")).where(F.col("_d").isNotNull()).distinct()
    marks = right.where(F.col(right_day).isNotNull()).groupBy(*on, F.col(right_day).alias("_d")).agg(
        choose(F.struct(*cols)).alias("_v")
    )
    both = marks.unionByName(days.withColumn("_v", F.lit(None).cast(marks.schema["_v"].dataType)))
    w = Window.partitionBy(*on).orderBy("_d", F.col("_v").isNull().cast("int"))
    filled = both.select(
        *on, "_d", F.col("_v").isNull().alias("_probe"), F.last("_v", ignorenulls=True).over(w).alias("_v")
    ).where("_probe")
    looked_up = filled.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], F.col("_d").alias("_r_d"), F.col("_v").alias("_asof")
    )
    cond = F.col(left_day) == F.col("_r_d")
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_r_{c}"))
    return (
        left.join(looked_up, cond, "left")
        .drop("_r_d", *[f"_r_{c}" for c in on])
        .select("*", *[F.col(f"_asof.{c}").alias(c) for c in cols])
        .drop("_asof")
    )


def interval_join(
    facts: DataFrame, windows: DataFrame, on: Sequence[str], ts: str, start: str, end: str, inclusive_end: bool = True
) -> DataFrame:
    """Facts whose timestamp falls into a window with the same key.

    Windows are unrolled to days, which turns the range test into an equality on
    (key, day): a key holding most facts is spread over its days. With
    ``inclusive_end=False`` the end is the midnight that starts the end day.
    """
    on = list(on)
    unrolled = windows.withColumn("_day", F.explode(F.sequence(F.to_date(start), F.to_date(end))))
    unrolled = unrolled.select(
        *[F.col(c).alias(f"_w_{c}") for c in on], *[c for c in windows.columns if c not in on], "_day"
    )
    cond = F.to_date(F.col(ts)) == F.col("_day")
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_w_{c}"))
    if not inclusive_end:
        cond = cond & (F.col(ts) <= F.col(end).cast("timestamp"))
    return facts.join(unrolled, cond).drop("_day", *[f"_w_{c}" for c in on])


def existence_flag(df: DataFrame, keys: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Boolean column: does the row's key occur in ``keys``?"""
    marked = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    return df.join(marked, list(on), "left").withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_hit")


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on ``key`` with a ``side`` column: both, left_only or right_only."""
    sides = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), key, "full_outer")
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return sides.withColumn("side", side).drop("_l", "_r")


def top_k(df: DataFrame, col: str, k: int, tie: str, asc: bool = False, per: str | None = None) -> DataFrame:
    """The k rows with the greatest (or smallest) ``col``, ties by ``tie``; optionally per group."""
    ordering = [F.col(col).asc_nulls_last() if asc else F.col(col).desc_nulls_last(), F.col(tie).asc()]
    if per is None:
        return df.orderBy(*ordering).limit(k)
    w = Window.partitionBy(per).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")
