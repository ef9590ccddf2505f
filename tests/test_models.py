"""Work done by the model queries: passes over rows, cohorts and scores."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from larder.operators import churn, wastage
from larder.plans import catalogue


def rows(spark, features, label, n=300):
    draw = np.random.default_rng(3)
    values = draw.normal(size=(n, len(features))).round(3)
    splits = ("train", "train", "val", "test")
    return spark.createDataFrame(
        [(i, splits[i % 4], *map(float, v), int(v[0] + v[1] > 0)) for i, v in enumerate(values)],
        ["customer_id", "split", *features, label],
    )


def test_forest_keeps_node_ids_and_is_the_same(spark):
    data = rows(spark, churn.FEATURES, "churn").coalesce(1)
    kept, walked = (churn.train_classifier(data, "random_forest", numTrees=8, maxDepth=4, **p) for p in ({}, {"cacheNodeIds": False}))
    assert kept.stages[-1].getOrDefault("cacheNodeIds")
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.stages[-1].trees] == [t.toDebugString.split("\n", 1)[1] for t in walked.stages[-1].trees]
    assert kept.stages[-1].totalNumNodes > 8


def test_risk_metrics_score_rows_once(spark, monkeypatch):
    data = rows(spark, wastage.RISK_FEATURES, "is_high_waste")
    models = wastage.fit_risk_models(data, {"logistic": {"maxIter": 5}, "random_forest": {"numTrees": 3, "maxDepth": 3}})
    expected = {
        (a, s): churn.binary_metrics(churn.score(m, data.where(f"split = '{s}'"), wastage.RISK_FEATURES), "is_high_waste").first().asDict()
        for a, m in models.items()
        for s in ("val", "test")
    }
    calls, score = [], wastage.score
    monkeypatch.setattr(wastage, "score", lambda *a: (calls.append(a), score(*a))[1])
    found = wastage.risk_metrics(models, data)
    assert len(calls) == 2
    assert "UDF" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["model"], r["split"]): {k: v for k, v in r.asDict().items() if k not in ("model", "split")} for r in found.collect()} == expected


class Asked(Exception):
    pass


@pytest.mark.parametrize(
    ("name", "cohorts"),
    [
        ("churn_scores_logistic", {"train", "test"}),
        ("churn_scores_random_forest", {"train", "test"}),
        ("compare_churn_models", {"train", "test"}),
        ("churn_feature_importance", {"train"}),
    ],
)
def test_churn_models_build_the_cohorts_they_read(spark, monkeypatch, name, cohorts):
    def asked(tables, spec, *args, **options):
        raise Asked(set(spec))

    monkeypatch.setattr(catalogue.churn, "churn_cohorts", asked)
    with pytest.raises(Asked) as found:
        catalogue.QUERIES[name](spark, "nowhere")
    assert found.value.args[0] == cohorts


def test_logistic_scores_after_an_observation(spark):
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 3
    data = rows(spark, churn.FEATURES, "churn")
    scored = churn.score(churn.train_classifier(data, "logistic", maxIter=5), data)
    assert scored.where(F.col("probability").between(0, 1)).count() == 300
