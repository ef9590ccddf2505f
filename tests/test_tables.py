"""Broken CSV lines, measured writes, bucketed joins, quantile sketches and published versions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.functions import sketches
from larder.sources import readers, writers



def files_read(df) -> int:
    """Files that the scans of a frame opened in its last run."""

    def total(node) -> int:
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return total(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return total(node.plan())
        own, children = node.metrics().get("numFiles"), node.children()
        return (own.get().value() if own.isDefined() else 0) + sum(total(children.apply(i)) for i in range(children.size()))

    return total(df._jdf.queryExecution().executedPlan())


def test_broken_lines_go_to_quarantine(spark, tmp_path):
    columns = StructType.fromDDL("item_id bigint, name string, price decimal(10,2)")
    lines = [
        "item_id,name,price", '1,"a, b",2.50', "2,plain,3", "3,short", "4,long,1,2,3", '5,"open,4', '6,closed "inside",5', '"7","q","1"',
        "", "  ", '8,last,"open', "9,,", ",,", "x,bad id,n/a", '"Item_ID", "NAME",price', '10,"a \\" quote",1', "11,é ,1", ",,,", '12,"",0',
    ]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("item_id,name,price\n20,other file,1")
    good, broken = readers.read_checked_csv(spark, str(tmp_path), columns)
    rows = {r.item_id: (r.name, None if r.price is None else float(r.price)) for r in good.collect() if r.item_id}
    assert rows == {
        1: ("a, b", 2.5), 2: ("plain", 3.0), 6: ('closed "inside"', 5.0), 7: ("q", 1.0), 9: (None, None), 10: ('a " quote', 1.0),
        11: ("é ", 1.0), 12: (None, 0.0), 20: ("other file", 1.0),
    }
    bad = {r.line: (r.file, r.n_fields, r.reason) for r in broken.collect()}
    assert {k: v[2] for k, v in bad.items()} == {
        "3,short": "missing fields", "4,long,1,2,3": "extra fields", '5,"open,4': "broken quotes", '8,last,"open': "broken quotes", ",,,": "extra fields",
    }
    assert bad["4,long,1,2,3"] == ("a.csv", 5, "extra fields")
    written = sum(1 for t in ("a.csv", "b.csv") for x in (tmp_path / t).read_text().split("\n") if x.strip() and not x.lower().replace('"', "").replace(" ", "").startswith("item_id"))
    assert good.count() + broken.count() == written


def test_writes_are_counted_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = spark.range(1000, numPartitions=5).mapInArrow(seen, "id long")
    written = writers.write_measured(df, str(tmp_path), "numbers")
    assert (written.rows, written.columns, written.partitions) == (1000, 1, 5) and written.seconds > 0
    assert calls.value == 1000  # one evaluation
    assert writers.check_written(spark, written).first().asDict() == {"rows_in": 1000, "rows_back": 1000, "ok": True}
    none = writers.write_measured(df.where("id < 0"), str(tmp_path), "none")
    assert none.rows == 0 and writers.check_written(spark, none).first().ok
    report = writers.written_report(spark, {"numbers": written, "none": none}).collect()
    assert [(r.table, r.rows, r.n_cols) for r in report] == [("numbers", 1000, 1), ("none", 0, 1)]


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    left = spark.range(5000).select((F.col("id") % 700).alias("k"), "id")
    right = spark.range(700).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    a = writers.write_bucketed(left, str(tmp_path / "a"), "k", "bucketed_a", 8)
    b = writers.write_bucketed(right, str(tmp_path / "b"), "k", "bucketed_b", 8)
    joined = a.hint("merge").join(b, "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.agg(F.count("*"), F.sum("twice")).first() == left.join(right, "k").agg(F.count("*"), F.sum("twice")).first()
    assert "Exchange" in left.hint("merge").join(right, "k")._jdf.queryExecution().executedPlan().toString()


def test_month_partitions_are_pruned_at_run_time(spark, tmp_path):
    facts = spark.range(2000).select("id", F.timestamp_add("DAY", F.col("id") % 700, F.lit("2023-01-01").cast("timestamp")).alias("at"))
    path = writers.write_partitioned(facts, str(tmp_path), "facts", "at")
    windows = spark.createDataFrame([(1, "2023-03-10", "2023-04-02"), (2, "2024-01-30", "2024-02-01")], "promo long, s string, e string")
    windows = windows.select("promo", F.to_date("s").alias("s"), F.to_date("e").alias("e")).repartition(2)
    windows.write.parquet(str(tmp_path / "windows"))
    found = writers.in_windows(spark.read.parquet(path), spark.read.parquet(str(tmp_path / "windows")).where("promo > 0"), "at", "s", "e")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    want = facts.crossJoin(windows).where("to_date(at) BETWEEN s AND e").select("promo", "id")
    assert sorted((r.promo, r.id) for r in found.collect()) == sorted(map(tuple, want.collect()))
    files = files_read(found)
    assert 4 <= files <= 8 < len(list((tmp_path / "facts").glob("month=*/part-*")))  # the four months touched, and the windows


@pytest.mark.parametrize("k", [100, 400])
def test_sketches_keep_their_bound_through_merges(spark, k):
    rng = np.random.default_rng(4)
    rows = [(int(g), int(p), float(v)) for g, p, v in zip(rng.integers(0, 3, 30_000), rng.integers(0, 40, 30_000), rng.lognormal(size=30_000))]
    rows += [(0, 1, None), (7, 1, 5.0), (8, 1, None)]
    frame = spark.createDataFrame(rows, "g long, p long, v double")
    stored = sketches.quantile_sketches(frame, ["g", "p"], "v", k)
    halves = sketches.merge_sketches(stored.withColumn("h", F.col("p") % 2), ["g", "h"], k)
    probabilities = {"q10": 0.1, "q50": 0.5, "q99": 0.99}
    for merged in (sketches.merge_sketches(stored, ["g"], k), sketches.merge_sketches(halves, ["g"], k)):
        for r in sketches.sketch_quantiles(merged, probabilities).collect():
            own = np.sort([v for g, _, v in rows if g == r.g and v is not None])
            assert r.n == len(own)
            for name, p in probabilities.items():
                low, high = np.searchsorted(own, r[name], "left") / len(own), np.searchsorted(own, r[name], "right") / len(own)
                assert low <= p + 2 * sketches.rank_error(k) and high >= p - 2 * sketches.rank_error(k)
    held = sketches.ranks_hold(frame, ["g"], "v", sketches.sketch_quantiles(sketches.merge_sketches(stored, ["g"], k), probabilities), probabilities, 2 * sketches.rank_error(k))
    assert all(r.q10 and r.q50 and r.q99 for r in held.collect())
    wrong = sketches.sketch_quantiles(sketches.merge_sketches(stored, ["g"], k), {"q10": 0.3, "q50": 0.5, "q99": 0.99})
    assert not any(r.q10 for r in sketches.ranks_hold(frame.where("g < 3"), ["g"], "v", wrong, probabilities, 0.02).collect())


def test_published_versions(spark, tmp_path):
    target = StructType.fromDDL("id bigint, word string, extra double")
    table = writers.Published(spark, str(tmp_path / "table"))
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.publish(spark.createDataFrame([("1", "abcdef"), ("x", None), (None, "z"), ("x", "y")], "id string, word string"), target, {"word": 3})
    rows = {tuple(r) for r in table.read().collect()}
    assert rows == {(1, "abc", None), (None, None, None), (None, "z", None), (None, "y", None)}
    assert [tuple(r) for r in table.read("rejected").collect()] == [("id", "x", 2)]
    broken = spark.range(1000, numPartitions=4).select("id", F.when(F.col("id") < 900, "w").otherwise(F.raise_error(F.lit("broken"))).alias("word"))
    with pytest.raises(PySparkException):
        table.publish(broken, target)
    assert table.manifest()["version"] == first and {tuple(r) for r in table.read().collect()} == rows
    open_read = table.read()  # planned before the next version
    second = table.publish(spark.createDataFrame([(5, "new")], "id long, word string"), target)
    assert table.manifest()["version"] == second and [tuple(r) for r in table.read().collect()] == [(5, "new", None)]
    assert {tuple(r) for r in open_read.collect()} == rows
    assert len(table.versions()) == 3 and table.prune(1) and table.versions() == [second]
    assert table.read().count() == 1
