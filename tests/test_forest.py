"""Forests against Spark's own: nodes, importances and scores, on several partitions, blocks and passes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larder.operators import churn, forest

NAMES = ("a", "b", "c", "d", "e")


def rows(spark, n, parts=1, seed=5):
    """Rows with few and many distinct values, zeros, a copy of a column and a constant."""
    draw = np.random.default_rng(seed)
    a, b, c = draw.normal(size=n).round(3), draw.integers(0, 4, n), draw.exponential(size=n).round(1) * draw.integers(0, 2, n)
    label = (a + 0.3 * b - c + draw.normal(size=n) > 0).astype(int)
    values = zip(range(n), a.tolist(), b.tolist(), c.tolist(), (2 * a).tolist(), label.tolist(), strict=True)
    data = spark.createDataFrame([(i, x, y, z, w, 7, k) for i, x, y, z, w, k in values], "id long, a double, b int, c double, d double, e int, label int")
    return data.coalesce(1) if parts == 1 else data.repartition(parts, "id").localCheckpoint()


def stored(spark, model, folder):
    model.stages[-1].write().save(str(folder))
    return spark.read.parquet(f"{folder}/data").orderBy("treeID", "nodeData.id").collect()


@pytest.mark.parametrize(
    ("n", "parts", "block", "params"),
    [
        (400, 1, 1 << 24, {"numTrees": 6, "maxDepth": 5, "minInstancesPerNode": 1}),
        (13_000, 3, 6 * 4096, {"numTrees": 6, "maxDepth": 6}),
        (900, 2, 1 << 24, {"numTrees": 90, "maxDepth": 9, "minInstancesPerNode": 1, "maxMemoryInMB": 1}),
    ],
)
def test_forest_is_sparks(spark, monkeypatch, tmp_path, n, parts, block, params):
    data = rows(spark, n, parts)
    monkeypatch.setattr(forest, "BLOCK_BYTES", block)
    monkeypatch.setattr(forest, "PIECE", 16)
    own = churn.train_classifier(data, "random_forest", "label", NAMES, **params)
    monkeypatch.setattr(forest, "fit", lambda *a: None)
    sparks = churn.train_classifier(data, "random_forest", "label", NAMES, **params)
    assert stored(spark, own, tmp_path / "own") == stored(spark, sparks, tmp_path / "sparks")
    assert own.stages[-1].featureImportances == sparks.stages[-1].featureImportances
    expected = sparks.transform(data.withColumns({c: F.col(c).cast("double") for c in NAMES}))
    expected = expected.select("id", F.col("prediction").cast("int"), vector_to_array("probability")[1].alias("probability")).orderBy("id").collect()
    for model in (own, sparks):
        found = churn.score(model, data, NAMES).orderBy("id")
        assert found.columns == [*data.columns, "prediction", "probability"]
        assert found.select("id", "prediction", "probability").collect() == expected


def test_neither_training_nor_scoring_walks_sparks_trees(spark, monkeypatch):
    def walked(*args):
        raise AssertionError("Spark's forest was used")

    monkeypatch.setattr(RandomForestClassifier, "_fit", walked)
    monkeypatch.setattr(RandomForestClassificationModel, "_transform", walked)
    data = rows(spark, 300)
    scored = churn.score(churn.train_classifier(data, "random_forest", "label", NAMES, numTrees=3, maxDepth=3), data, NAMES)
    assert scored.where(F.col("probability").between(0, 1) & F.col("prediction").isin(0, 1)).count() == 300


@pytest.mark.parametrize("change", [{"a": "IF(id = 3, NULL, a)"}, {"label": "label + 1"}, {"label": "0"}, {c: "1" for c in NAMES}])
def test_other_rows_are_left_to_spark(spark, change):
    data = rows(spark, 60).selectExpr(*[f"{change.get(c, c)} AS {c}" for c in ("id", *NAMES, "label")])
    typed = churn.class_weights(data, "label").withColumns({c: F.col(c).cast("double") for c in (*NAMES, "label")})
    assert forest.fit(RandomForestClassifier(labelCol="label", weightCol="class_weight", numTrees=3), typed, NAMES) is None


def test_missing_values_are_still_an_error(spark):
    data = rows(spark, 60)
    broken = data.withColumn("a", F.when(F.col("id") != 3, F.col("a")))
    with pytest.raises(Exception, match="null"):
        churn.train_classifier(broken, "random_forest", "label", NAMES, numTrees=3)
    model = churn.train_classifier(data, "random_forest", "label", NAMES, numTrees=3, maxDepth=2)
    with pytest.raises(Exception, match="null"):
        churn.score(model, broken, NAMES).collect()
