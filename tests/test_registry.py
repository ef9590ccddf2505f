"""The model registry under several writers, and version order."""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from larder.operators import recommend
from larder.operators.registry import DuplicateVersion, Registry, UnknownVersion, version_order


def test_versions_are_unique_and_one_is_active(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    assert registry.models().collect() == [] and registry.history().collect() == []
    registry.register("forest", "1", "spark", {"f1": 0.5}, "2024-01-01", active=True)
    registry.register("forest", "9", "spark", trained_at="2024-01-02")
    registry.register("forest", "10", "spark", active=True)
    registry.register("forest", "1", "python")
    with pytest.raises(DuplicateVersion):
        registry.register("forest", "9", "spark")
    with pytest.raises(UnknownVersion):
        registry.activate("forest", "11", "spark")
    for bad in (("", "1", "spark"), ("x", "", "spark"), ("x", "1", "java")):
        with pytest.raises(ValueError):
            registry.register(*bad)
    assert {(r.version, r.pipeline) for r in registry.models().where("is_active").collect()} == {("10", "spark")}
    registry.activate("forest", "9", "spark")
    registry.activate("forest", "1", "python")
    again = Registry(spark, str(tmp_path))  # it lasts
    assert {(r.version, r.pipeline) for r in again.models().where("is_active").collect()} == {("9", "spark"), ("1", "python")}
    assert [r.version for r in again.history("spark").orderBy("place").collect()] == ["1", "9", "10"]
    first = again.models().where("version = '1' AND pipeline = 'spark'").first()
    assert first.metrics == {"f1": 0.5} and first.trained_at == "2024-01-01"


def test_writers_at_the_same_time(spark, tmp_path):
    def write(n: int) -> str:
        registry = Registry(spark, str(tmp_path))
        try:
            registry.register("tree", str(n % 6), "spark", active=n % 2 == 0)
            return "made"
        except DuplicateVersion:
            return "duplicate"

    with ThreadPoolExecutor(8) as pool:
        done = Counter(pool.map(write, range(18)))
    assert done == {"made": 6, "duplicate": 12}
    registry = Registry(spark, str(tmp_path))
    assert sorted(r.number for r in registry.log().collect()) == list(range(1, 7))
    rows = registry.models().collect()
    assert Counter(r.version for r in rows) == {str(v): 1 for v in range(6)}
    last = registry.log().where("action = 'register_active'").orderBy(F.desc("number")).first()
    assert [r.version for r in rows if r.is_active] == ([last.version] if last else [])
    assert [p.name for p in tmp_path.iterdir()] == ["log"]  # nothing is left aside


def test_latest_version_by_number(spark):
    rows = [("m", v, "t", "2024-01-01") for v in ("9", "10", "2")] + [("n", "1.9", "t", "2024-01-01"), ("n", "1.10", "t", "2024-01-01"), ("o", "7", "t", "2024-02-01"), ("o", "8", "t", "2024-01-01")]
    frame = spark.createDataFrame(rows, "name string, version string, track string, trained_at string")
    assert {r.name: r.version for r in recommend.latest_models(frame).collect()} == {"m": "10", "n": "1.10", "o": "7"}
    ordered = spark.createDataFrame([(v,) for v in ("v2", "v10", "v1-rc", "v1", "x")], "v string").orderBy(version_order(F.col("v")))
    assert [r.v for r in ordered.collect()] == ["x", "v1", "v1-rc", "v2", "v10"]
