"""The driver contract, and a sample of queries against DuckDB (all of them with LARDER_ALL=1)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from larder.operators import forecast
from tests.check import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "dq_run",
    "clean_duplicate_lines_quarantine",
    "feat_item",
    "feat_customer",
    "menu_classification",
    "menu_performance",
    "rfm_scores",
    "basket_rules",
    "peaks_summary",
    "wastage_label_split",
    "price_elasticity",
    "promo_effectiveness",
    "rating_anomalies",
    "duplicate_transactions",
    "weekday_spike",
    "forecast_demand_category",
    "compare_model_metrics",
    "what_if",
)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["menu_item_id", "item_name", "quantity_sold", "revenue", "contribution_margin", "menu_class"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("LARDER_ALL") else SAMPLE)
def test_query_matches_sql(spark, name):
    result = compare(spark, connect(SF), name, SF)
    assert result[1] == "ok", result[4]


@pytest.mark.parametrize("level, sf", [("item", SF), ("category", SF), ("location", "/root/testdata/sf0.01")])
def test_boosted_forecasts_of_every_level(spark, level, sf):
    queries = entry.queries()
    plain = queries[f"forecast_demand_{level}"](spark, sf)
    rows = queries[f"forecast_boosted_demand_{level}"](spark, sf)
    assert rows.columns == [*plain.columns, "pred_gradient_boosting"]
    rows = rows.collect()
    assert rows and sorted(tuple(r)[:-1] for r in rows) == sorted(map(tuple, plain.collect()))
    assert all(r.pred_gradient_boosting is not None and 0 <= r.pred_gradient_boosting < float("inf") for r in rows)
    errors = {}
    for r in rows:
        errors.setdefault(r.entity_id, []).append(abs(r.actual_qty - r.pred_gradient_boosting))
    metrics = queries[f"forecast_boosted_metrics_{level}"](spark, sf).collect()
    assert len(metrics) == 4 * len(errors)
    boosted = {r.entity_id: r.mae for r in metrics if r.model == "gradient_boosting"}
    assert boosted.keys() == errors.keys()
    assert all(abs(boosted[e] - sum(x) / len(x)) < 0.01 for e, x in errors.items())
    summary = {r.model: r for r in queries[f"forecast_boosted_summary_{level}"](spark, sf).collect()}
    assert len(summary) == 4 and all(r.n_entities == len(errors) and r.level == level for r in summary.values())
    assert abs(summary["gradient_boosting"].avg_mae - sum(boosted.values()) / len(boosted)) < 0.02


def test_boosted_forecast_without_enough_history(spark):
    rows = entry.queries()["forecast_boosted_demand_location"](spark, SF)
    assert rows.columns[-1] == "pred_gradient_boosting" and rows.collect() == []
