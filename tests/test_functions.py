from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from larder.functions import relational as rel
from larder.functions import scalar, series
from larder.sources import staging


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_qcut_scores_small(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([10, 20, 30, 40, 50, 60])], "id bigint, v double")
    out = rel.qcut_scores(df, "id", {"s": ("v", False), "rev": ("v", True)})
    got = {r.id: (r.s, r.rev) for r in out.collect()}
    assert [got[i][0] for i in range(6)] == [1, 1, 2, 3, 4, 4]
    assert [got[i][1] for i in range(6)] == [4, 4, 3, 2, 1, 1]


def test_qcut_single_row(spark):
    df = spark.createDataFrame([(1, 5.0)], "id bigint, v double")
    assert rel.qcut_scores(df, "id", {"s": ("v", False)}).first().s == 1


@pytest.mark.parametrize("n", [7, 23, 100, 1001])
def test_qcut_equals_pandas(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"id": range(n), "v": rng.integers(0, 5, n).astype(float)})
    want = pd.qcut(pdf["v"].rank(method="first"), 4, labels=[1, 2, 3, 4]).astype(int)
    out = rel.qcut_scores(spark.createDataFrame(pdf), "id", {"s": ("v", False)}).toPandas().sort_values("id")
    assert out["s"].tolist() == want.tolist()


@pytest.mark.parametrize("size", [1, 2, 5, 500])
def test_exact_quantiles_small(spark, size):
    x = np.random.default_rng(size).normal(size=size).round(1)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = rel.exact_quantiles(df, {"a": ("x", 0.25), "b": ("x", 0.5), "c": ("x", 0.75)}).first()
    assert got.asDict() == pytest.approx({"a": np.quantile(x, 0.25), "b": np.quantile(x, 0.5), "c": np.quantile(x, 0.75)})


def test_exact_quantiles_bracketed(spark):
    """Many rows, a third of them equal, NULLs ignored."""
    n = 90_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 100 == 1, None).otherwise(F.pmod(F.hash("id"), F.lit(100_003)) / 7).alias("x")
    )
    x = df.toPandas()["x"].dropna()
    spec = {f"p{p}": ("x", p / 100) for p in (1, 25, 33, 50, 75, 99)}
    got = rel.exact_quantiles(df, spec).first().asDict()
    assert got == pytest.approx({k: x.quantile(p) for k, (_, p) in spec.items()})


def test_running_total_with_hot_group(spark):
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abc"), n)), "k": rng.permutation(n), "v": rng.integers(0, 9, n)})
    out = rel.running_total(spark.createDataFrame(pdf), ["g"], ["k"], "v", "upto", "all", buckets=16).toPandas()
    pdf = pdf.sort_values("k")
    pdf["want"] = pdf.groupby("g")["v"].cumsum()
    merged = out.merge(pdf[["k", "want"]], on="k")
    assert len(merged) == n and (merged["upto"] == merged["want"]).all()
    assert merged.groupby("g")["all"].nunique().max() == 1


def test_ordered_index_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, 3.0), (4, 1.0)], "id bigint, v double")
    got = {r.id: (r.rn, r.n) for r in rel.ordered_index(df, ["v", "id"]).collect()}
    assert got == {1: (1, 4), 4: (2, 4), 2: (3, 4), 3: (4, 4)}


def test_percent_ranks_match_window(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(200), "a": rng.integers(0, 20, 200).astype(float), "b": rng.normal(size=200)})
    out = rel.percent_ranks(spark.createDataFrame(pdf), "id", ["a", "b"]).toPandas().sort_values("id")
    for c in "ab":
        want = (pdf[c].rank(method="min") - 1) / 199
        assert np.allclose(out[f"{c}_pr"], want)


def test_asof_join_takes_exact_and_earlier_day(spark):
    d = dt.date
    left = spark.createDataFrame(
        [(1, "a", d(2024, 1, 5)), (2, "a", d(2024, 1, 4)), (3, "a", d(2023, 12, 31)), (4, "b", d(2024, 1, 5)), (5, "a", None), (6, "a", d(2024, 1, 5))],
        "id int, k string, day date",
    )
    right = spark.createDataFrame([("a", d(2024, 1, 1), 10), ("a", d(2024, 1, 5), 20)], "k string, rday date, stock int")
    out = rel.asof_join(left, right, ["k"], "day", "rday", ["stock"])
    assert {r.id: r.stock for r in out.collect()} == {1: 20, 2: 10, 3: None, 4: None, 5: None, 6: 20}


def test_interval_join_end_day(spark):
    facts = spark.createDataFrame([(1, "x", dt.datetime(2024, 1, 3, 0, 0)), (2, "x", dt.datetime(2024, 1, 3, 9, 0)), (3, "x", dt.datetime(2024, 1, 4, 0, 0))], "id int, k string, ts timestamp")
    windows = spark.createDataFrame([("x", dt.date(2024, 1, 1), dt.date(2024, 1, 3), "w")], "k string, s date, e date, w string")
    assert [r.id for r in rel.interval_join(facts, windows, ["k"], "ts", "s", "e").orderBy("id").collect()] == [1, 2]
    assert [r.id for r in rel.interval_join(facts, windows, ["k"], "ts", "s", "e", inclusive_end=False).collect()] == [1]


def test_reconcile_and_top_k(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(rel.reconcile(a, b, "k").select("k", "side")) == [(1, "left_only"), (2, "both"), (3, "right_only")]
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 1), (4, "b", None)], "id int, g string, v int")
    assert [r.id for r in rel.top_k(df, "v", 2, "id").collect()] == [1, 2]
    assert rows(rel.top_k(df, "v", 1, "id", asc=True, per="g").select("id")) == [(3,), (4,)]


def test_rolling_features_exclude_current_row(spark):
    pdf = pd.DataFrame({"e": 1, "d": range(10), "q": [3.0, 1, 4, 1, 5, 9, 2, 6, 5, 3]})
    out = series.rolling_features(spark.createDataFrame(pdf), ["e"], "d", "q", mean=(3,), std=(3,)).toPandas().sort_values("d")
    past = pdf["q"].shift(1).rolling(3, min_periods=1)
    assert np.allclose(out["rolling_mean_3"], past.mean(), equal_nan=True)
    assert np.allclose(out["rolling_std_3"].astype(float), past.std(), equal_nan=True)
    ahead = pdf.assign(q=[3.0, 1, 4, 1, 5, 900, 2, 6, 5, 3])
    changed = series.rolling_features(spark.createDataFrame(ahead), ["e"], "d", "q", mean=(3,), std=()).toPandas().sort_values("d")
    assert (changed["rolling_mean_3"][:6].fillna(-1).to_numpy() == out["rolling_mean_3"][:6].fillna(-1).to_numpy()).all()


def test_mean_gap_days_floors_each_gap(spark):
    times = ["2024-01-01 10:00", "2024-01-01 12:00", "2024-01-02 09:00", "2024-01-05 10:30", "2024-01-05 10:30"]
    df = spark.createDataFrame([("a", t) for t in times] + [("b", times[0])], "k string, t string").withColumn("t", F.col("t").cast("timestamp"))
    s = pd.to_datetime(pd.Series(times)).sort_values()
    got = {r.k: r.avg_days_between_orders for r in series.mean_gap_days(df, ["k"], "t").collect()}
    assert got == {"a": s.diff().dt.days.mean(), "b": 0.0}


def test_zscore_of_single_row_is_null(spark):
    out = series.zscore(spark.createDataFrame([("a", 5)], "k string, v int"), ["k"], "v").first()
    assert out["std"] is None and out["z"] is None


def test_dense_calendar_fills_gaps(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.0), ("b", dt.date(2024, 1, 3), 5.0)], "k string, d date, v double")
    got = rows(series.dense_calendar(df, "k", "d", ["v"]).select("k", F.dayofmonth("d"), "v"))
    assert got == [("a", 1, 2.0), ("a", 2, 0.0), ("a", 3, 0.0), ("b", 1, 0.0), ("b", 2, 0.0), ("b", 3, 5.0)]


def test_scalar_helpers(spark):
    days = [(dt.datetime(2024, 1, d, h),) for d, h in ((1, 5), (2, 12), (3, 17), (4, 22), (5, 11), (6, 21), (7, 4))]  # Mon..Sun
    df = spark.createDataFrame(days, "t timestamp")
    got = df.select(
        scalar.is_weekend("t").alias("w"),
        scalar.is_weekend("t", (4, 5, 6)).alias("w3"),
        scalar.is_peak_hour("t").alias("p"),
        scalar.time_of_day("t").alias("tod"),
    ).collect()
    assert [r.w for r in got] == [False] * 5 + [True, True]
    assert [r.w3 for r in got] == [False] * 4 + [True] * 3
    assert [r.p for r in got] == [False, True, True, False, True, True, False]
    assert [r.tod for r in got] == ["morning", "afternoon", "evening", "night", "morning", "evening", "night"]
    one = spark.range(1).select(
        scalar.ratio(F.lit(1), F.lit(0)).alias("a"),
        scalar.ratio_or_zero(F.lit(1), F.lit(0)).alias("b"),
        scalar.clamp(F.lit(1.7), 0.0, 1.0).alias("c"),
        scalar.to_id(F.lit("17.0")).alias("d"),
        scalar.to_id(F.lit("x")).alias("e"),
        scalar.elapsed_days(F.lit("2024-01-01 12:00:00"), F.lit("2024-01-03 11:00:00")).alias("f"),
        scalar.tier(F.lit(0.5), [(1.5, "high"), (0.5, "medium")], "low").alias("g"),
    ).first()
    assert tuple(one) == (None, 0.0, 1.0, 17, None, 1, "medium")


def test_ids_are_exact(spark):
    texts = ["17", "17.0", "17.9", "x", "", "9007199254740993", "9223372036854775807", "9223372036854775808", "-3", "1e3", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").select("i", scalar.to_id("t").alias("id"))
    got = [r.id for r in rows.orderBy("i").collect()]
    assert got == [17, 17, None, None, None, 9007199254740993, 9223372036854775807, None, -3, 1000, None]


@pytest.mark.parametrize("kind", ["spread", "ties", "heavy"])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 1000, 60_000])
def test_exact_quantiles_at_every_size(spark, kind, n):
    rng = np.random.default_rng(n)
    x = {"spread": rng.normal(size=n), "ties": rng.integers(0, 5, n).astype(float), "heavy": rng.pareto(0.5, n)}[kind]
    p = {"a": 0.25, "b": 0.5, "c": 0.75, "d": 0.999, "e": 0.0, "f": 1.0}
    frame = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = rel.exact_quantiles(frame, {k: ("x", v) for k, v in p.items()}).first()
    assert np.allclose([got[k] for k in p], np.quantile(x, list(p.values())), rtol=1e-12)


def test_spread_left_join(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, None), (4, 11), (5, 12)], "id long, k long")
    right = spark.createDataFrame([(10, "a"), (11, "b"), (None, "never")], "k long, v string")
    got = rel.spread_left_join(left, right, "k", "id")
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "a"), (2, None), (3, None), (4, "b"), (5, None)]


def test_stage_tables_go_away(spark, tmp_path, monkeypatch):
    kept = staging.settle(spark.range(3).toDF("n"), "numbers", str(tmp_path))
    assert kept.count() == 3 and list(tmp_path.rglob("*.parquet"))
    staging.release(spark)
    assert not list(tmp_path.rglob("*.parquet"))


def test_shared_folder_is_asked_for_on_a_cluster(monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(Session)
    Context.master, Context.applicationId = "local[4]", "app-local"
    assert staging.shared_dir(Session) == staging.shared_dir(Session)
