"""Boosted trees per entity against trees grown by trying every split."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from larder.operators import boosting, forecast


def naive_tree(x, r, depth, min_leaf):
    """(feature, threshold, left, right) or a leaf's mean; every split of every feature is tried."""
    best = None
    if depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for a, b in zip(values, values[1:]):
                left = x[:, f] <= (a + b) / 2
                if min(left.sum(), (~left).sum()) < min_leaf:
                    continue
                gain = r[left].sum() ** 2 / left.sum() + r[~left].sum() ** 2 / (~left).sum() - r.sum() ** 2 / len(r)
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-9 * (1 + r.sum() ** 2 / len(r))):
                    best = gain, f, (a + b) / 2, left
    if best is None:
        return r.mean()
    _, f, at, left = best
    return f, at, naive_tree(x[left], r[left], depth - 1, min_leaf), naive_tree(x[~left], r[~left], depth - 1, min_leaf)


def naive_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def naive_boost(x, y, new, rounds, depth, rate, min_leaf):
    fitted, out = np.full(len(y), y.mean()), np.full(len(new), y.mean())
    for _ in range(rounds):
        tree = naive_tree(x, y - fitted, depth, min_leaf)
        fitted += rate * np.array([naive_value(tree, row) for row in x])
        out += rate * np.array([naive_value(tree, row) for row in new])
    return out


@pytest.mark.parametrize(("depth", "min_leaf", "seed"), [(1, 1, 0), (2, 1, 1), (3, 1, 2), (3, 4, 3), (4, 2, 4)])
def test_trees_are_those_of_trying_every_split(depth, min_leaf, seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=60), rng.integers(0, 4, 60), rng.integers(0, 2, 60), np.arange(60.0), np.zeros(60)])
    y = 3 * x[:, 1] + np.sin(x[:, 3] / 9) * 5 + rng.normal(size=60)
    new = np.column_stack([rng.normal(size=25), rng.integers(0, 5, 25), rng.integers(0, 2, 25), np.arange(55.0, 80), np.ones(25)])
    got = boosting.fit_predict(x, y, new, 30, depth, 0.1, min_leaf, 255)
    assert got == pytest.approx(naive_boost(x, y, new, 30, depth, 0.1, min_leaf), rel=1e-7)


def test_few_bins_cut_where_rows_are_even():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1000, 2))
    bins = boosting.Bins(x, 16)
    for f in range(2):
        counts = np.bincount(bins.codes[:, f] - bins.first[f])
        assert len(counts) == 16 and counts.max() <= 2 * 1000 // 16
    y = np.where(x[:, 0] > 0.3, 5.0, -1.0)
    fine, coarse = (boosting.fit_predict(x, y, x, 60, 2, 0.2, 1, b) for b in (255, 16))
    assert np.abs(fine - y).mean() < np.abs(coarse - y).mean() < 0.5


def test_one_model_per_entity(spark):
    rng = np.random.default_rng(3)
    rows, start = [], dt.date(2024, 1, 1)
    for e in range(5):
        for d in range(80):
            date = start + dt.timedelta(days=d)
            rows.append((e, date, float(10 * e + date.weekday() * (e + 1) + rng.normal()), "train" if d < 60 else "test", d, date.weekday(), None if d % 9 == 0 else d / 3))
    rows.append((9, start, 4.0, "test", 0, 0, 1.0))  # no history
    rows.append((10, start, 7.0, "train", 0, 0, 1.0))
    rows.append((10, start + dt.timedelta(days=1), 8.0, "test", 1, 1, 1.0))
    frame = spark.createDataFrame(rows, "entity_id long, date date, qty double, split string, time_index int, dow int, odd double")
    got = {(r.entity_id, r.date): r.prediction for r in boosting.boosted_per_entity(frame, ["time_index", "dow", "odd"], "qty", rounds=40).collect()}
    assert {k[0] for k in got} == {0, 1, 2, 3, 4, 10} and got[10, start + dt.timedelta(days=1)] == 7.0
    for e in range(5):
        own = [r for r in rows if r[0] == e]
        x = np.array([[r[4], r[5], r[6] or 0.0] for r in own], float)
        y = np.array([r[2] for r in own])
        want = naive_boost(x[:60], y[:60], x[60:], 40, 3, 0.05, 1)
        assert [got[e, r[1]] for r in own[60:]] == pytest.approx(want.tolist(), rel=1e-7)
    assert boosting.boosted_per_entity(frame.limit(0), ["dow"], "qty").collect() == []


def test_own_and_pooled_models_are_compared(spark):
    rng = np.random.default_rng(5)
    rows, start = [], dt.date(2024, 1, 1)
    for e in range(6):
        for d in range(140):
            date = start + dt.timedelta(days=d)
            rows.append((e, date, float(max(0, 50 + 20 * np.sin((date.weekday() + e) * 6.28 / 7) + rng.normal()))))
    series = spark.createDataFrame(rows, "entity_id long, date date, qty double")
    split = forecast.demand_split(forecast.demand_features(series), n_test=30)
    out = forecast.demand_forecast(split, ("naive", "gbt", "pooled"), rounds=60, maxIter=20)
    assert {"pred_gradient_boosting", "pred_pooled_boosting"} <= set(out.columns)
    mae = {r.model: r.avg_mae for r in forecast.forecast_summary(forecast.forecast_metrics(out), "item").collect()}
    assert mae["gradient_boosting"] < mae["naive_baseline"] and mae["gradient_boosting"] < 1.5 * mae["pooled_gradient_boosting"]
