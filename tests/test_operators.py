from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from larder.operators import anomalies, basket, churn, cleaning, customers, features, menu, pricing, promotions, recommend
from larder.sources.schemas import TABLES

D = Decimal


def table(spark, name, rows):
    return spark.createDataFrame(rows, TABLES[name])


def order(i, customer=1, place=1, promo=None, ts="2024-01-01 12:00", status="completed", total="10"):
    return (i, customer, place, promo, dt.datetime.fromisoformat(ts), "web", status, D(total), D(0), D(total))


def line(i, order_id, item=1, q="1", price="10", cost="4", disc="0", total="10"):
    return (i, order_id, item, D(q), D(price), D(cost), None if disc is None else D(disc), D(total))


def test_deduplicate_keeps_every_row_once(spark):
    raw = [line(1, 1), line(1, 1), line(1, 1, total="9"), line(2, 1), line(3, 2), line(3, 2)]
    clean, rejected, _ = cleaning.deduplicate(table(spark, "Order_Items", raw), "order_item_id")
    kept, dropped = clean.collect(), rejected.drop("reason").collect()
    assert sorted(r.order_item_id for r in kept) == [1, 2, 3]
    assert Counter(map(tuple, kept + dropped)) == Counter(map(tuple, table(spark, "Order_Items", raw).collect()))


def test_deduplicate_shuffles_only_repeated_keys(spark):
    frame = spark.range(1000).selectExpr("least(id, 997) AS id", "cast(id AS string) AS text")
    clean, rejected, _ = cleaning.deduplicate(frame, "id")
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # rows of a single key stay where they are
    assert clean.count() == 998 and sorted(r.text for r in rejected.collect()) == ["997", "998"]
    assert clean.where("id = 997").first().text == "999"


def test_sums_per_order_are_dealt_over_more_tasks(spark):
    lines = spark.range(100).selectExpr("id AS order_id")
    dealt = features.dealt_by_order(lines)
    assert dealt.rdd.getNumPartitions() == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt.groupBy("order_id", F.spark_partition_id()).count().count() == 100


def test_deduplicate_splits_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "COPIES_PER_TASK", 7)
    raw = [line(1, 1)] * 50 + [line(2, 1)]
    _, rejected, _ = cleaning.deduplicate(table(spark, "Order_Items", raw), "order_item_id")
    assert rejected.count() == 49


def test_incorrect_discount_keeps_unknown(spark):
    raw = [line(1, 1, disc=None), line(2, 1, disc="11"), line(3, 1, disc="10")]
    clean, rejected, _ = cleaning.incorrect_discounts(table(spark, "Order_Items", raw), recompute_total=True)
    got = {r.order_item_id: (r.discount_amount, r.line_total) for r in clean.collect()}
    assert got == {1: (None, D("10.00")), 2: (D("10.00"), D("0.00")), 3: (D("10.00"), D("10.00"))}
    assert [r.order_item_id for r in rejected.collect()] == [2]


def test_split_steps_conserve_rows(spark):
    raw = table(spark, "Order_Items", [line(1, 1, q="-1"), line(2, 1, q="0"), line(3, 1, item=None)])
    for clean, rejected, _ in (cleaning.negative_quantities(raw), cleaning.missing_ids(raw, "menu_item_id")):
        assert clean.count() + rejected.count() == 3


def test_basket_pairs_by_hand(spark):
    lines = table(spark, "Order_Items", [line(i, o, item) for i, (o, item) in enumerate([(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (2, 3), (3, 1)])])
    got = {(r.item_a, r.item_b): r.together for r in basket.basket_pairs(lines, 0.0).collect()}
    assert got == {(1, 2): 2, (1, 3): 1, (2, 3): 1}


@pytest.mark.parametrize(("tile", "chunk"), [(2048, 8192), (3, 10), (2, 1)])
def test_basket_pairs_match_brute_force(spark, tile, chunk):
    """Random baskets with one that holds every item, counted in small chunks and tiles."""
    rng = np.random.default_rng(5)
    pairs = [(int(o), int(i)) for o, i in zip(rng.integers(0, 60, 400), rng.zipf(1.6, 400) % 12)] + [(99, i) for i in range(12)]
    lines = table(spark, "Order_Items", [line(n, o, i) for n, (o, i) in enumerate(pairs)])
    sets: dict[int, set[int]] = {}
    for o, i in pairs:
        sets.setdefault(o, set()).add(i)
    single = Counter(i for s in sets.values() for i in s)
    frequent = {i for i, c in single.items() if c >= 0.05 * len(sets)}
    want = Counter(p for s in sets.values() for p in combinations(sorted(s & frequent), 2))
    got = {(r.item_a, r.item_b): r.together for r in basket.basket_pairs(lines, 0.05, tile, chunk).collect()}
    assert got == dict(want)


def test_rules_go_both_ways(spark):
    lines = table(spark, "Order_Items", [line(i, o, item) for i, (o, item) in enumerate([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 3)])])
    got = {(r.antecedent, r.consequent): (r.support, r.confidence, r.lift) for r in basket.association_rules(lines, 0.1, 0.1, 1.0).collect()}
    assert got == {(1, 2): (0.5, 0.6667, 1.3333), (2, 1): (0.5, 1.0, 1.3333)}


def test_promo_window_end(spark):
    facts = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 10, 9)), (1, dt.datetime(2024, 1, 10, 0)), (1, dt.datetime(2023, 12, 31, 23)), (1, dt.datetime(2024, 1, 11, 1))],
        "menu_item_id bigint, order_timestamp timestamp",
    )
    promos = table(spark, "Promotions", [(1, "p", "x", D(1), "c", dt.date(2024, 1, 1), dt.date(2024, 1, 10))])
    items = table(spark, "Promotion_Items", [(1, 1)])
    phases = [
        sorted(r.phase for r in promotions.promo_windows(facts, promos, items, inclusive_end=e).collect()) for e in (True, False)
    ]
    assert phases == [["during", "during", "post", "pre"], ["during", "post", "post", "pre"]]


def test_item_totals_do_not_fan_out(spark):
    day = dt.date(2024, 1, 1)
    t = {
        "Orders": table(spark, "Orders", [order(1), order(2, customer=2), order(3)]),
        "Order_Items": table(spark, "Order_Items", [line(1, 1), line(2, 2), line(3, 3)]),
        "Menu_Items": table(spark, "Menu_Items", [(1, 1, "soup", "", D(10), D(4), True, "bowl", day)]),
        "Menu_Categories": table(spark, "Menu_Categories", [(1, "c")]),
        "Pricing_History": table(spark, "Pricing_History", [(1, 1, day, D(8)), (2, 1, day, D(10))]),
        "Ratings": table(spark, "Ratings", [(1, 1, 1, 1, 4, dt.datetime(2024, 2, 1)), (2, 1, 1, 1, 5, dt.datetime(2024, 8, 1))]),
        "Inventory": table(spark, "Inventory", [(i, 1, 1, day, D(5), D(0), D(10), D(1), "bowl") for i in (1, 2)]),
        "Wastage": table(spark, "Wastage", [(i, 1, 1, day, D(2), "bowl", D(3), "x") for i in (1, 2)]),
    }
    r = features.item_features(t).first()
    assert (r.total_consumption, r.total_wasted, r.total_wastage_cost) == (20.0, 4.0, 6.0)
    assert (r.order_frequency, r.distinct_customers, r.repeat_customers, r.rating_trend) == (3, 2, 1, 1.0)
    assert (r.price_change_pct, r.wastage_pct, r.basket_inclusion_rate) == (0.25, 0.2, 1.0)


def test_most_common_prefers_smallest_on_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (2, "z")], "k int, v string")
    assert sorted(map(tuple, customers.most_common(df, ["k"], "v", "top").collect())) == [(1, "a"), (2, "z")]


def test_constant_price_has_no_elasticity(spark):
    days = [(1, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(5 + i % 3), 10.0, 1.0, 1.0, 1.0) for i in range(40)]
    df = spark.createDataFrame(days, "menu_item_id bigint, date date, qty double, avg_price double, revenue double, margin double, discount double")
    assert pricing.price_elasticity(df).count() == 0


def test_multivariate_elasticity_matches_least_squares(spark):
    rng = np.random.default_rng(11)
    frames, orders, i = [], [], 0
    for item in (1, 2, 3):
        days = pd.date_range("2024-01-01", periods=60, freq="D")
        price = np.full(60, 10.0) if item == 3 else rng.uniform(5, 15, 60)
        qty = np.exp(3 - 1.2 * np.log(price) + rng.normal(0, 0.1, 60))
        frames.append(pd.DataFrame({"menu_item_id": item, "date": days.date, "qty": qty, "avg_price": price}))
    for d in pd.date_range("2024-01-01", periods=60, freq="D"):
        i += 1
        orders.append(order(i, promo=1 if i % 4 == 0 else None, ts=str(d)))
    daily = pd.concat(frames)
    out = pricing.multivariate_elasticity(spark.createDataFrame(daily), table(spark, "Orders", orders)).toPandas().set_index("menu_item_id")
    promoted = {o[4].date() for o in orders if o[3]}
    for item, g in daily.groupby("menu_item_id"):
        ts = pd.to_datetime(g["date"])
        x = np.column_stack([np.log(g["avg_price"]), g["date"].isin(promoted), ts.dt.dayofweek >= 5, ts.dt.month]).astype(float)
        y = np.log(g["qty"])
        xc, yc = x - x.mean(axis=0), y - y.mean()
        coef, *_ = np.linalg.lstsq(xc, yc, rcond=1e-10)
        fit = 1 - ((yc - xc @ coef) ** 2).sum() / (yc**2).sum()
        row = out.loc[item]
        assert row["multivariate_elasticity"] == pytest.approx(coef[0], abs=2e-4)
        assert row["has_promo_coef"] == pytest.approx(coef[1], abs=2e-4)
        assert row["model_r2"] == pytest.approx(fit, abs=2e-4)


def test_duplicate_transactions_across_hours(spark):
    times = ["2024-01-01 10:59", "2024-01-01 11:30", "2024-01-01 12:30", "2024-01-01 12:30", "2024-01-01 15:00"]
    orders = table(spark, "Orders", [order(i, ts=t) for i, t in enumerate(times)] + [order(9, customer=None, ts=times[0]), order(10, customer=None, ts=times[0])])
    got = {r.order_id: r.time_gap_min for r in anomalies.duplicate_transactions(orders).collect()}
    assert got == {1: 31.0, 3: 0.0}


def test_value_outliers(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([10, 11, 12, 13, 14, 500])], "id int, v double")
    assert [r.id for r in anomalies.value_outliers(df, "v").collect()] == [5]


def test_weekend_only_case(spark):
    days = [f"2024-01-0{d} 12:00" for d in range(1, 8)]  # Monday to Sunday
    orders = table(spark, "Orders", [order(i, ts=t) for i, t in enumerate(days)])
    lines = table(spark, "Order_Items", [line(i, i, item=1, q="9" if i >= 5 else "1") for i in range(7)] + [line(10 + i, i, item=2) for i in range(7)])
    got = menu.weekend_cases(features.sales(orders, lines), (5, 6)).collect()
    assert [(r.menu_item_id, r.weekday_quantity, r.weekend_quantity) for r in got] == [(1, 5.0, 18.0)]


def test_segment_names(spark):
    rows = [(c, c * 10 + i, s, s, s, 0.0, 0.0, "web", "night", "x") for c, s in ((0, 4), (1, 3), (2, 1), (3, 3)) for i in range(2)]
    df = spark.createDataFrame(
        rows,
        "cluster int, customer_id bigint, r_score int, f_score int, m_score int, promo_sensitivity double, weekend_ratio double, "
        "preferred_channel string, time_of_day_preference string, favorite_category string",
    )
    got = {r.cluster: r.segment for r in customers.segment_profiles(df).collect()}
    assert got == {0: "high_value_loyal", 1: "frequent_1", 3: "frequent_2", 2: "occasional"}


def test_what_if_by_hand(spark):
    items = spark.createDataFrame([(1, "a", 100.0, 1000.0, 400.0, 0.1)], "menu_item_id bigint, item_name string, quantity_sold double, revenue double, cost double, wastage_pct double")
    got = {r.scenario: r for r in recommend.what_if(items).collect()}
    assert len(got) == 8
    up = got["Price Increase"]
    assert (up.estimated_demand, up.estimated_revenue, up.baseline_contribution_margin) == (95.0, 1045.0, 560.0)
    assert up.estimated_contribution_margin == pytest.approx(1045 - 380 - 38)
    assert got["Item Removal"].estimated_revenue == 0.0 and got["Item Removal"].estimated_profitability_pct == 0.0
    assert got["Wastage Reduction"].estimated_wastage_pct == 0.08


def test_binary_metrics_and_auc(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 1, 0.8), (0, 0, 0.1)], "churn int, prediction int, probability double")
    r = churn.binary_metrics(df).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (1, 1, 1, 2)
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.6, 0.5, 0.5, 0.5)
    assert r.auc == pytest.approx((3 + 1.5) / 6)


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "churn int")
    got = {r.churn: r.class_weight for r in churn.class_weights(df, "churn").distinct().collect()}
    assert got == {0: 4 / 6, 1: 2.0}


def test_rating_identical_type(spark):
    from larder.operators import ratings

    rows = [(i, 1, 1, 1, 3, dt.datetime(2024, 1, 1, 1)) for i in range(12)] + [(50 + i, 1, 1, 1, 2 + i % 3, dt.datetime(2024, 1, 2 + i, 1)) for i in range(3)]
    got = ratings.rating_anomalies(table(spark, "Ratings", rows)).collect()
    assert [(r.n, r.type) for r in got] == [(12, "identical")]


def test_registry_rejects_known_versions(spark):
    cols = "name string, version string, track string, trained_at timestamp, f1 double"
    one = spark.createDataFrame([("m", "1", "a", dt.datetime(2024, 1, 1), 0.5)], cols)
    two = spark.createDataFrame([("m", "1", "a", dt.datetime(2024, 3, 1), 0.9), ("m", "2", "a", dt.datetime(2024, 2, 1), 0.7)], cols)
    registry = recommend.model_registry(one, two)
    assert sorted((r.version, r.f1) for r in registry.collect()) == [("1", 0.5), ("2", 0.7)]
    assert recommend.latest_models(registry).first().version == "2"


def test_churn_features_do_not_see_the_future(spark):
    """Orders after the feature window change the label only."""
    base = [order(i, customer=i % 5, ts=f"2024-01-{1 + i:02d} 12:00") for i in range(20)]
    later = [order(100, customer=0, ts="2024-02-10 12:00")]
    lines = table(spark, "Order_Items", [line(i, i) for i in range(20)] + [line(100, 100, total="999")])
    menu_items = table(spark, "Menu_Items", [(1, 1, "soup", "", D(10), D(4), True, "bowl", dt.date(2024, 1, 1))])
    rest = {"Order_Items": lines, "Menu_Items": menu_items, "Menu_Categories": table(spark, "Menu_Categories", [(1, "c")])}
    spec = {"c": ("2024-02-01", "2024-02-01", "2024-02-29")}
    out = [
        churn.churn_cohorts(rest | {"Orders": table(spark, "Orders", o)}, spec).orderBy("customer_id").collect()
        for o in (base, base + later)
    ]
    strip = [[tuple(r[c] for c in ("customer_id", *churn.FEATURES)) for r in x] for x in out]
    assert strip[0] == strip[1]
    assert [r.churn for r in out[0]] == [1] * 5 and [r.churn for r in out[1]] == [0, 1, 1, 1, 1]


def test_readers_and_writers(spark, tmp_path):
    from larder.sources import readers, writers
    from larder.sources.schemas import schema

    (tmp_path / "order_items.csv").write_text("order_item_id,order_id,menu_item_id,quantity,unit_price,unit_cost,discount_amount,line_total\n1,7,17.0,2,3.50,,0,7\n2,7,abc,x,3,1,0,3\n")
    got = readers.read_table_csv(spark, str(tmp_path), "Order_Items").orderBy("order_item_id").collect()
    assert (got[0].menu_item_id, got[0].unit_cost, got[0].quantity) == (17, None, D("2.00"))
    assert (got[1].menu_item_id, got[1].quantity) == (None, None)
    raw = readers.read_raw_csv(spark, str(tmp_path / "order_items.csv"), schema("Order_Items"))
    bad = {r["column"]: r.n_bad for r in readers.parse_failures(raw, schema("Order_Items")).collect()}
    assert bad["menu_item_id"] == 1 and bad["quantity"] == 1 and bad["unit_cost"] == 0
    with pytest.raises(FileNotFoundError):
        readers.find_table(spark, str(tmp_path), "Orders")
    df = spark.range(10).withColumn("ts", F.timestamp_seconds(F.col("id") * 86400 * 20))
    path = writers.write_partitioned(df, str(tmp_path), "t", "ts", n=2, salt="id")
    assert writers.readback_check(df, path).first().ok
    with pytest.raises(KeyError):
        writers.Reports({}).extract("nope", str(tmp_path / "x"))


def test_deduplicate_keeps_rows_without_a_key(spark):
    rows = [(None, 1, "a"), (None, 1, "a"), (None, 2, None), (5, 1, "b"), (5, 1, "b"), (5, None, "c"), (6, None, None)]
    frame = spark.createDataFrame(rows, "id long, n long, s string")
    clean, rejected, _ = cleaning.deduplicate(frame, "id")
    kept, dropped = [tuple(r) for r in clean.collect()], [tuple(r) for r in rejected.drop("reason").collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(None, 2, None), (5, 1, "b"), (6, None, None)]))
    assert Counter(kept + dropped) == Counter(rows)


def test_baskets_ignore_lines_without_an_order(spark):
    lines = table(spark, "Order_Items", [line(1, 1, 1), line(2, 1, 2), line(3, None, 1), line(4, None, 3), line(5, 2**53 + 1, 1), line(6, 2**53, 2)])
    singles = {r.menu_item_id: (r.baskets, r.n_baskets) for r in basket.basket_singles(lines).collect()}
    assert singles == {1: (2, 3), 2: (2, 3)}
    assert [tuple(r) for r in basket.basket_pairs(lines, 0.1).collect()] == [(1, 2, 1)]


def test_no_recent_sales_ends_at_the_cutoff(spark):
    orders = table(spark, "Orders", [order(1, ts="2024-01-01 10:00"), order(2, ts="2024-06-01 10:00"), order(3, ts="2024-12-30 10:00")])
    lines = table(spark, "Order_Items", [line(1, 1, 1), line(2, 2, 1), line(3, 3, 1), line(4, 2, 2)])
    menu_items = spark.createDataFrame([(1, 1, "a", None, D(1), D(1), True, "kg", None), (2, 1, "b", None, D(1), D(1), True, "kg", None)], TABLES["Menu_Items"])
    none = spark.createDataFrame([], TABLES["Wastage"])
    summary = menu.item_sales_summary(lines, orders, none, menu_items, "2024-06-10")
    assert {r.menu_item_id: (r.qty_sold, r.no_recent_sale) for r in summary.collect()} == {1: (2.0, False), 2: (1.0, False)}
    late = menu.item_sales_summary(lines, orders, none, menu_items, "2024-12-01")
    assert {r.menu_item_id: r.no_recent_sale for r in late.collect()} == {1: True, 2: True}


def test_limits_are_the_callers(spark):
    rows = spark.range(3000).select(F.lit("High").alias("priority"), F.lit("s").alias("source"), F.col("id").alias("menu_item_id"), *[F.lit("x").alias(c) for c in ("finding", "evidence", "item_name")])
    assert recommend.search_recommendations(rows, priority="High").count() == 3000
    assert [r.menu_item_id for r in recommend.search_recommendations(rows, limit=2).collect()] == [0, 1]
    days = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2, 23)), (3, dt.datetime(2024, 1, 3))], "n long, ts timestamp")
    assert [r.n for r in recommend.filter_report(days, days=("ts", "2024-01-02", "2024-01-03")).collect()] == [2, 3]


def test_scenario_texts_follow_the_parameters():
    assert recommend.Scenario("s", demand_change=-0.05, price_change=0.1).assumption == "demand down 5%, price up 10%"
    assert recommend.Scenario("s", removal=True).assumption == "item off the menu"


def test_rules_as_text(spark):
    kinds = {"revenue": "double", "orders": "bigint", "channel": "string"}
    frame = spark.createDataFrame([(1.0, 5, "web"), (30.0, 9, "a and b"), (25.0, 2, "web"), (None, 9, None)], "revenue double, orders bigint, channel string")

    def rows(rule):
        return {(r.revenue, r.orders) for r in anomalies.rule_anomalies(frame, rule).collect()}

    assert rows("revenue > 20") == {(30.0, 9), (25.0, 2)}
    assert rows("revenue>=25 AND orders < 5") == {(25.0, 2)}
    assert rows("channel = 'a and b' and revenue > -1.5") == {(30.0, 9)}
    assert rows("orders != 9") == {(1.0, 5), (25.0, 2)}
    for bad in ("", "revenue", "revenue > ", "profit > 3", "revenue > 'x'", "channel = 3", "revenue > 3 or orders > 1", "revenue > (SELECT 1)", "revenue > 3; x", "java_method('a') = 1"):
        with pytest.raises(anomalies.RuleError):
            anomalies.rule_condition(bad, kinds)
