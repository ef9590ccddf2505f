"""Balanced random forests of two classes, grown and scored in numpy: the trees that Spark's RandomForestClassifier grows.

Spark visits every tree for each row, so nearly every step of a pass misses the processor's cache. Here rows lie in
blocks, a block's rows pass one tree after the other, and a pass adds up one histogram per tree and partition. Draws,
order of nodes, sums and gains follow Spark, so the forest is the same; only where a partition has more blocks than
a file, its sums may differ in the last bit. Rows stay distributed, and a pass holds as many nodes as Spark's
``maxMemoryInMB`` admits.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from larder.sources.staging import stage_path

EPSILON = 2.0**-52
#: Bytes of bootstrap counts in a block, one per row and tree.
BLOCK_BYTES = 1 << 24
#: Blocks in a file, and so in memory at once when it is read.
FILE_BLOCKS = 8
#: Nodes in a piece of a tree's histogram; the parts of a piece meet in one task.
PIECE = 256
#: Settings that are followed here; with any other one the forest is left to Spark.
OWN = ("numTrees", "maxDepth", "minInstancesPerNode", "maxBins", "maxMemoryInMB", "seed", "cacheNodeIds", "labelCol", "featuresCol", "weightCol")


def fit(estimator: RandomForestClassifier, data: DataFrame, features: Sequence[str]) -> RandomForestClassificationModel | None:
    """The forest of the rows' double columns, or None if it isn't one that is grown here.

    Labels must be 0 and 1 and weights constant per label, no value may be missing, and settings beyond OWN must be the
    defaults.
    """
    spark, label, weight = data.sparkSession, estimator.getLabelCol(), estimator.getWeightCol()
    if estimator.getNumTrees() < 2 or estimator.getMaxBins() > 255 or any(p.name not in OWN for p in estimator.params if estimator.isSet(p)):
        return None
    rows = data.select(*[F.col(c) for c in features], F.col(label).alias("_label"), F.col(weight).cast("double").alias("_weight"))
    missing = [F.col(c).isNull() | F.isnan(c) for c in rows.columns]
    found = rows.groupBy("_label").agg(
        F.count("*").alias("n"),
        F.min("_weight").alias("low"),
        F.max("_weight").alias("high"),
        *[F.count_if(m).alias(f"_{i}") for i, m in enumerate(missing)],
    ).limit(3).collect()
    if {r["_label"] for r in found} != {0.0, 1.0} or any(r["low"] != r["high"] or r["low"] <= 0 for r in found):
        return None
    if any(r[f"_{i}"] for r in found for i in range(len(missing))):
        return None
    classes = sorted(found, key=lambda r: r["_label"])
    n = sum(r["n"] for r in classes)
    total = rows.agg(F.sum("_weight")).first()[0]
    seed = estimator.getSeed()
    splits = _splits(rows, features, estimator.getMaxBins(), n, total, seed)
    if not any(len(s) for s in splits):
        return None
    plan = _Plan(estimator, splits, [r["low"] for r in classes])
    path = stage_path(spark, "forest_blocks")
    _blocks(rows.select(*features, "_label"), splits, plan.trees, seed).write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(path)
    blocks = spark.read.schema(BLOCK).parquet(path)
    forest = _Forest(plan)
    while forest.stack:
        group = forest.next_group()
        partial = blocks.mapInArrow(_histograms(plan, group), "tree int, piece int, part int, number int, cells binary")
        judge = _best_splits(plan, group.subsets, group.given)
        best = partial.groupBy("tree", "piece").applyInArrow(judge, "tree int, piece int, splits binary").toArrow()
        found: dict[int, list[bytes]] = {}
        for t, _, splits_of in sorted(zip(*(best[c].to_pylist() for c in best.column_names), strict=True)):
            found.setdefault(t, []).append(splits_of)
        forest.grow(group, {t: b"".join(pieces) for t, pieces in found.items()})
    return _as_model(spark, estimator, forest, len(features))


# ---- thresholds ----------------------------------------------------------------


def _splits(rows: DataFrame, features: Sequence[str], max_bins: int, n: int, total: float, seed: int) -> list[np.ndarray]:
    """Thresholds per feature from all rows, or from some 10,000 of them, as Spark draws them."""
    spark = rows.sparkSession
    needed = max(max_bins * max_bins, 10_000)
    share = needed / n if needed < n else 1.0
    if share < 1.0:
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        java = rows._jdf.toJavaRDD().sample(False, share, draw)
        rows = DataFrame(spark._jsparkSession.createDataFrame(java, rows._jdf.schema()), spark)
    table = rows.toArrow()
    weight = table["_weight"].to_numpy()
    most = min(max_bins, n) - 1
    return [_thresholds(table[c].to_numpy(), weight, most, share * total) for c in features]


def _thresholds(values: np.ndarray, weight: np.ndarray, most: int, expected: float) -> np.ndarray:
    """At most ``most`` thresholds that part the weight evenly; what is not seen counts as zeros."""
    seen = values != 0.0
    distinct, place = np.unique(values[seen], return_inverse=True)
    if not len(distinct):
        return np.empty(0)
    sums = np.bincount(place, weight[seen], len(distinct))
    zeros = expected - sums.sum()
    if zeros > EPSILON * np.count_nonzero(seen) * 100:
        at = np.searchsorted(distinct, 0.0)
        distinct, sums = np.insert(distinct, at, 0.0), np.insert(sums, at, zeros)
    middle = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride = expected / (most + 1)
    chosen, target, upto = [], stride, np.cumsum(sums).tolist()
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            chosen.append(middle[i - 1])
            target += stride
    return np.array(chosen)


# ---- bootstrap -----------------------------------------------------------------

BLOCK = "part int, number int, n int, bins binary, label binary, counts binary"


def _blocks(rows: DataFrame, splits: list[np.ndarray], trees: int, seed: int) -> DataFrame:
    """Blocks of rows: bins of the features by row, labels, and how often each tree draws each row, by tree.

    Spark's own bootstrap draws the counts. They come as serialized objects, whose parts all have fixed places: the row
    (all columns are doubles without NULL) and then the array of counts.
    """
    spark, width = rows.sparkSession, len(rows.columns)
    bagging = spark._jvm.org.apache.spark.ml.tree.impl.BaggedPoint
    drawn = bagging.convertToBaggedRDD(rows._jdf.queryExecution().toRdd(), 1.0, trees, True, getattr(bagging, "convertToBaggedRDD$default$5")(), seed)
    kind = spark._jvm.java.lang.Class.forName("org.apache.spark.ml.tree.impl.BaggedPoint")
    objects = DataFrame(spark._jsparkSession.createDataset(drawn, spark._jvm.org.apache.spark.sql.Encoders.javaSerialization(kind)).toDF(), spark)
    size = max(1, BLOCK_BYTES // trees)
    row_bytes = 8 * ((width + 63) // 64) + 8 * width

    def block(number: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bins, label, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.record_batch(
            {
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "number": pa.array([number], pa.int32()),
                "n": pa.array([len(label)], pa.int32()),
                "bins": pa.array([bins.tobytes()], pa.binary()),
                "label": pa.array([label.tobytes()], pa.binary()),
                "counts": pa.array([np.ascontiguousarray(counts.T).tobytes()], pa.binary()),
            }
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, number = [], 0, 0
        for batch in batches:
            cells = batch.column(0)
            for start in range(0, len(cells), 4096):
                parts.append(_parse(cells.slice(start, 4096), row_bytes, width, trees, splits))
                held += len(parts[-1][1])
                if held >= size:
                    yield block(number, parts)
                    parts, held, number = [], 0, number + 1
        if parts:
            yield block(number, parts)

    return objects.mapInArrow(gather, BLOCK)


def _parse(cells: pa.Array, row_bytes: int, width: int, trees: int, splits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels and counts of serialized rows."""
    first = cells[0].as_py()
    size = (row_bytes).to_bytes(4, "big") + width.to_bytes(4, "big")
    row_at = first.index(size, first.index(b"UnsafeRow")) + len(size)
    mark = b"ur\x00\x02[I"
    counts_at = row_at + row_bytes + 1 + len(mark) + 8 + 1 + 2 + 2 + 4
    if first[row_at + row_bytes + 1 :][: len(mark)] != mark or int.from_bytes(first[counts_at - 4 : counts_at], "big") != trees:
        raise RuntimeError("unknown layout of Spark's bagged rows")
    offsets = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + len(cells) + 1]
    if not (np.diff(offsets) == len(first)).all():
        raise RuntimeError("Spark's bagged rows differ in size")
    raw = np.frombuffer(cells.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(cells), len(first))
    values = np.ascontiguousarray(raw[:, row_at + row_bytes - 8 * width : row_at + row_bytes]).view("<f8")
    counts = np.ascontiguousarray(raw[:, counts_at : counts_at + 4 * trees]).view(">i4").astype(np.uint8)
    bins = np.stack([np.searchsorted(s, values[:, i]) for i, s in enumerate(splits)], 1).astype(np.uint8)
    return bins, values[:, -1].astype(np.uint8), counts


# ---- growth --------------------------------------------------------------------


class _Plan:
    """What all passes share: settings, thresholds and class weights."""

    def __init__(self, estimator: RandomForestClassifier, splits: list[np.ndarray], weights: list[float]):
        self.trees, self.depth = estimator.getNumTrees(), estimator.getMaxDepth()
        self.least, self.memory = estimator.getMinInstancesPerNode(), estimator.getMaxMemoryInMB() * 1024 * 1024
        self.seed, self.splits, self.weights = estimator.getSeed(), splits, np.array(weights)
        self.features = len(splits)
        self.per_node = math.ceil(math.sqrt(self.features))
        self.n_splits = np.array([len(s) for s in splits])
        self.bins = int(self.n_splits.max()) + 1


class _Group:
    """Nodes of one pass per tree: ids and features (one row per place), and the tree as it is."""

    def __init__(self):
        self.nodes: dict[int, np.ndarray] = {}
        self.subsets: dict[int, np.ndarray] = {}
        self.tree: dict[int, tuple[np.ndarray, ...]] = {}
        self.given: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _histograms(plan: _Plan, group: _Group) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Weights per tree: place of the feature, node, bin and class. A node without split leads to itself."""
    width, span = plan.features, 2 * plan.bins

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, sums, at = {}, {}, None
        for t, nodes in group.nodes.items():
            slots[t] = np.full(len(group.tree[t][0]), -1)
            slots[t][nodes] = np.arange(len(nodes))

        def added() -> Iterator[pa.RecordBatch]:
            for t in list(sums):
                cells = np.stack(sums.pop(t))
                pieces = [cells[:, i : i + PIECE * span].tobytes() for i in range(0, cells.shape[1], PIECE * span)]
                for i, piece in enumerate(pieces):
                    numbers = {"tree": t, "piece": i, "part": at[0], "number": at[1]}
                    yield pa.record_batch({k: pa.array([v], pa.int32()) for k, v in numbers.items()} | {"cells": pa.array([piece], pa.binary())})

        for batch in batches:
            for i in range(batch.num_rows):
                part, number, n = (batch.column(c)[i].as_py() for c in ("part", "number", "n"))
                if at is None or at[0] != part:
                    yield from added()
                    at = (part, number)
                bins = np.frombuffer(batch.column("bins")[i].as_buffer(), np.uint8)
                label = np.frombuffer(batch.column("label")[i].as_buffer(), np.uint8).astype(np.int64)
                counts = np.frombuffer(batch.column("counts")[i].as_buffer(), np.uint8).reshape(plan.trees, n)
                for t, nodes in group.nodes.items():
                    feature, cut, left, depth = group.tree[t]
                    rows = np.flatnonzero(counts[t])
                    base, node = rows * width, np.zeros(len(rows), np.int64)
                    for _ in range(depth):
                        right = bins.take(base + feature.take(node)) > cut.take(node)
                        node = left.take(node) + right
                    slot = slots[t].take(node)
                    if depth:
                        kept = np.flatnonzero(slot >= 0)
                        rows, base, slot = rows.take(kept), base.take(kept), slot.take(kept)
                    y = label.take(rows)
                    weight = counts[t].take(rows) * plan.weights.take(y)
                    key, size, found = slot * span + y, len(nodes) * span, []
                    for k, subset in enumerate(group.subsets[t]):
                        cell = key + 2 * bins.take(base + subset.take(slot)).astype(np.int64)
                        if t in sums:  # go on adding row by row, from the sums so far
                            cell, w = np.concatenate([np.arange(size), cell]), np.concatenate([sums[t][k], weight])
                        else:
                            w = weight
                        found.append(np.bincount(cell, w, size))
                    sums[t] = found
        yield from added()

    return add


#: A pass's decision on a node: place of the best feature (-1 without a valid split), bin of the split, gain, impurity,
#: the class weights of the node (for the root) and of its left and right child.
SPLIT = np.dtype([("feature", "i4"), ("cut", "i4"), ("gain", "f8"), ("impurity", "f8"), ("own", "f8", 2), ("left", "f8", 2), ("right", "f8", 2)])
INVALID = -np.finfo(np.float64).max


def _gini(stats: np.ndarray) -> np.ndarray:
    """Impurity by the last axis, summed in Spark's order."""
    total = stats[..., 0] + stats[..., 1]
    with np.errstate(invalid="ignore", divide="ignore"):
        a, b = stats[..., 0] / total, stats[..., 1] / total
    return np.where(total == 0, 0.0, (1.0 - a * a) - b * b)


def _best_splits(plan: _Plan, subsets: dict[int, np.ndarray], given: dict[int, tuple[np.ndarray, np.ndarray]]) -> Callable[[pa.Table], pa.Table]:
    """The decisions on a piece of a tree's nodes, from the sums of all parts in their order."""

    def judge(table: pa.Table) -> pa.Table:
        t, piece = table["tree"][0].as_py(), table["piece"][0].as_py()
        parts = sorted(zip(table["part"].to_pylist(), table["number"].to_pylist(), range(table.num_rows), strict=True))
        total = None
        for *_, i in parts:
            cells = np.frombuffer(table["cells"][i].as_buffer(), np.float64)
            total = cells.copy() if total is None else np.add(total, cells, out=total)
        at = slice(piece * PIECE, (piece + 1) * PIECE)
        own, root = given[t]
        found = choose(plan, total, subsets[t][:, at], own[at], root[at])
        return pa.table({"tree": table["tree"][:1], "piece": table["piece"][:1], "splits": pa.array([found.tobytes()], pa.binary())})

    return judge


def choose(plan: _Plan, cells: np.ndarray, subsets: np.ndarray, own: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The first of the best splits of each node; ``own`` are the class weights known from its parent, if not ``root``."""
    found, every = np.zeros(len(own), SPLIT), np.arange(len(own))
    upto = np.cumsum(cells.reshape(plan.per_node, len(own), plan.bins, 2), axis=2)
    left, right = upto[:, :, :-1], upto[:, :, -1:] - upto[:, :, :-1]
    usable = plan.n_splits[subsets]
    first = np.argmax(usable > 0, axis=0)
    stats = np.where(root[:, None], left[first, every, 0] + right[first, every, 0], own)
    impurity = _gini(stats)
    few = (np.rint(left / plan.weights).sum(-1) < plan.least) | (np.rint(right / plan.weights).sum(-1) < plan.least)
    lefts, rights = left[..., 0] + left[..., 1], right[..., 0] + right[..., 1]
    both = lefts + rights
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = impurity[None, :, None] - lefts / both * _gini(left) - rights / both * _gini(right)
    gain = np.where(few | (lefts < 0) | (rights < 0) | ~(gain >= 0), INVALID, gain)
    gain[np.arange(plan.bins - 1) >= usable[..., None]] = -np.inf
    cut = gain.argmax(axis=2)
    top = np.take_along_axis(gain, cut[..., None], 2)[..., 0]
    k = top.argmax(axis=0)
    found["gain"], found["cut"] = top[k, every], cut[k, every]
    found["feature"] = np.where(found["gain"] > INVALID, subsets[k, every], -1)
    found["impurity"], found["own"] = impurity, stats
    found["left"], found["right"] = left[k, every, cut[k, every]], right[k, every, cut[k, every]]
    return found


NODE = np.dtype(
    [("feature", "i8"), ("cut", "u1"), ("left", "i8"), ("depth", "i4"), ("split", "?"), ("valid", "?"), ("gain", "f8"), ("impurity", "f8"), ("stats", "f8", 2)]
)


class _Tree:
    """Nodes in the order of their making: a node's right child follows its left one, one without children leads to itself."""

    def __init__(self):
        self.size, self.nodes = 1, np.zeros(0, NODE)
        self.room(0)

    def room(self, more: int) -> None:
        while self.size + more > len(self.nodes):
            fresh = np.zeros(max(64, len(self.nodes)), NODE)
            fresh["cut"], fresh["valid"], fresh["left"] = 255, True, len(self.nodes) + np.arange(len(fresh))
            self.nodes = np.concatenate([self.nodes, fresh])


class _Forest:
    """The trees and the stack of nodes to split, kept by the driver."""

    def __init__(self, plan: _Plan):
        self.plan, self.random = plan, _java_state(plan.seed)
        self.trees = [_Tree() for _ in range(plan.trees)]
        self.stack: list[tuple[int, int]] = [(t, 0) for t in range(plan.trees)]

    def next_group(self) -> _Group:
        """Nodes from the top of the stack, as many as the memory admits; one draw goes to the node that doesn't fit."""
        plan, group = self.plan, _Group()
        seeds, states = _java_longs(self.random, len(self.stack))
        subsets = _reservoirs(seeds, plan.features, plan.per_node) if plan.per_node < plan.features else np.tile(np.arange(plan.features), (len(seeds), 1))
        needs = 8 * 2 * (plan.n_splits[subsets] + 1).sum(axis=1)
        used, taken, draws = 0, 0, 0
        picked: dict[int, list[int]] = {}
        drawn: dict[int, list[int]] = {}
        for (t, node), need in zip(reversed(self.stack), needs.tolist(), strict=True):
            if used >= plan.memory and used:
                break
            draws += 1
            if used + need > plan.memory and used:
                break
            picked.setdefault(t, []).append(node)
            drawn.setdefault(t, []).append(draws - 1)
            taken += 1
            used += need
        del self.stack[len(self.stack) - taken :]
        if plan.per_node < plan.features:
            self.random = int(states[draws - 1])
        for t in _map_order(list(picked)):
            tree, nodes = self.trees[t], np.array(picked[t])
            made = tree.nodes[: tree.size]
            group.nodes[t] = nodes
            group.subsets[t] = np.ascontiguousarray(subsets[drawn[t]].T)
            group.tree[t] = (made["feature"].copy(), made["cut"].copy(), made["left"].copy(), int(made["depth"][nodes].max()))
            group.given[t] = (made["stats"][nodes], made["depth"][nodes] == 0)
        return group

    def grow(self, group: _Group, best: dict[int, bytes]) -> None:
        plan = self.plan
        for t, ids in group.nodes.items():
            tree, found = self.trees[t], np.frombuffer(best[t], SPLIT)
            tree.room(2 * len(ids))
            nodes = tree.nodes
            nodes["gain"][ids], nodes["impurity"][ids] = found["gain"], found["impurity"]
            nodes["stats"][ids], nodes["valid"][ids] = found["own"], found["feature"] >= 0
            inner = (found["gain"] > 0) & (nodes["depth"][ids] < plan.depth)
            ids, found = ids[inner], found[inner]
            left = tree.size + 2 * np.arange(len(ids))
            nodes["feature"][ids], nodes["cut"][ids], nodes["left"][ids], nodes["split"][ids] = found["feature"], found["cut"], left, True
            ends = []
            for side, child in (("left", left), ("right", left + 1)):
                nodes["stats"][child], nodes["depth"][child], nodes["valid"][child] = found[side], nodes["depth"][ids] + 1, True
                nodes["impurity"][child] = _gini(found[side])
                ends.append((nodes["depth"][child] == plan.depth) | (np.abs(nodes["impurity"][child]) < EPSILON))
            tree.size += 2 * len(ids)
            children, open_ = np.stack([left, left + 1], 1).ravel(), ~np.stack(ends, 1).ravel()
            self.stack.extend((t, c) for c in children[open_].tolist())


# ---- the model -------------------------------------------------------------------


def _preorder(forest: _Forest) -> pa.Table:
    """The nodes of all trees, pruned and numbered as Spark stores them."""
    plan = forest.plan
    start = np.cumsum([0, *(t.size for t in forest.trees)])
    nodes = np.concatenate([t.nodes[: t.size] for t in forest.trees])
    tree = np.repeat(np.arange(plan.trees), np.diff(start))
    left = nodes["left"] + start[tree]
    inner, stats = nodes["split"].copy(), nodes["stats"]
    prediction = (stats[:, 1] > stats[:, 0]).astype(float)
    levels = [np.flatnonzero(nodes["depth"] == d) for d in range(nodes["depth"].max() + 1)]
    size = np.ones(len(nodes), np.int64)
    for level in reversed(levels):
        at = level[inner[level]]
        a = left[at]
        # children of one class are merged
        same = ~inner[a] & ~inner[a + 1] & (prediction[a] == prediction[a + 1])
        inner[at[same]] = False
        at, a = at[~same], a[~same]
        size[at] = 1 + size[a] + size[a + 1]
    place = np.full(len(nodes), -1)
    place[start[:-1]] = 0
    for level in levels:
        at = level[inner[level] & (place[level] >= 0)]
        a = left[at]
        place[a], place[a + 1] = place[at] + 1, place[at] + 1 + size[a]
    kept = np.flatnonzero(place >= 0)
    kept = kept[np.lexsort((place[kept], tree[kept]))]
    split, a = inner[kept], left[kept]
    feature = np.where(split, nodes["feature"][kept], -1)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in plan.splits])])
    threshold = np.concatenate([*plan.splits, [0.0]])[np.where(split, offsets[feature] + nodes["cut"][kept], -1)]
    ends = np.concatenate([[0], np.cumsum(split)]).astype(np.int32)
    columns = {
        "id": pa.array(place[kept], pa.int32()),
        "prediction": pa.array(prediction[kept]),
        "impurity": pa.array(np.where(split | nodes["valid"][kept], nodes["impurity"][kept], -1.0)),
        "impurityStats": pa.FixedSizeListArray.from_arrays(pa.array(stats[kept].ravel()), 2).cast(pa.list_(pa.float64())),
        "rawCount": pa.array(np.rint(stats[kept] / plan.weights).sum(1).astype(np.int64)),
        "gain": pa.array(np.where(split, nodes["gain"][kept], -1.0)),
        "leftChild": pa.array(np.where(split, place[np.where(split, a, 0)], -1), pa.int32()),
        "rightChild": pa.array(np.where(split, place[np.where(split, a + 1, 0)], -1), pa.int32()),
    }
    parts = {
        "featureIndex": pa.array(feature, pa.int32()),
        "leftCategoriesOrThreshold": pa.ListArray.from_arrays(pa.array(ends), pa.array(threshold[split])),
        "numCategories": pa.array(np.full(len(kept), -1), pa.int32()),
    }
    columns["split"] = pa.StructArray.from_arrays([*parts.values()], [*parts])
    return pa.table({"treeID": pa.array(tree[kept], pa.int32()), "nodeData": pa.StructArray.from_arrays([*columns.values()], [*columns])})


def _as_model(spark: SparkSession, estimator: RandomForestClassifier, forest: _Forest, width: int) -> RandomForestClassificationModel:
    """The forest as Spark's own model, by way of a stored one."""
    path, nodes = stage_path(spark, "forest"), _preorder(forest)
    package = "org.apache.spark.ml.classification"
    common = {"timestamp": 0, "sparkVersion": spark.version}
    settings = {p.name: v for p, v in estimator._paramMap.items()}, {p.name: v for p, v in estimator._defaultParamMap.items()}
    whole = {"class": f"{package}.RandomForestClassificationModel", "uid": estimator.uid, "paramMap": settings[0], "defaultParamMap": settings[1]}
    of_trees = {p.name for p in DecisionTreeClassifier().params}
    own, default = ({k: v for k, v in s.items() if k in of_trees} for s in settings)
    single = {"class": f"{package}.DecisionTreeClassificationModel", "paramMap": own, "defaultParamMap": default}
    about = json.dumps(common | whole | {"numFeatures": width, "numClasses": 2, "numTrees": forest.plan.trees})
    trees = [(t, json.dumps(common | single | {"uid": f"{estimator.uid}_{t}"}), 1.0) for t in range(forest.plan.trees)]
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes).write.parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    model._nodes = nodes
    return model


# ---- scores ----------------------------------------------------------------------


def _nodes(model: RandomForestClassificationModel, spark: SparkSession) -> pa.Table:
    if not hasattr(model, "_nodes"):
        path = stage_path(spark, "forest")
        model.write().save(path)
        model._nodes = spark.read.parquet(f"{path}/data").orderBy("treeID", "nodeData.id").toArrow()
    return model._nodes


def _flat(nodes: pa.Table) -> tuple[np.ndarray, ...]:
    """Feature, threshold, left child and class shares of all nodes, and the depth of each tree.

    Roots come first, then one level after the other; the right child follows the left one, leaves lead to themselves.
    """
    parts = dict(zip((f.name for f in nodes.schema.field("nodeData").type), nodes["nodeData"].combine_chunks().flatten(), strict=True))
    tree = nodes["treeID"].to_numpy()
    start = np.searchsorted(tree, np.arange(tree.max() + 1))
    a, b = (parts[c].to_numpy() for c in ("leftChild", "rightChild"))
    split = parts["split"].flatten()
    inner = a >= 0
    threshold = np.full(len(tree), np.inf)
    threshold[inner] = split[1].flatten().to_numpy()
    feature = np.where(inner, split[0].to_numpy(), 0)
    stats = parts["impurityStats"].flatten().to_numpy().reshape(-1, 2)
    total = stats[:, 0] + stats[:, 1]
    shares = np.divide(stats, total[:, None], out=np.zeros_like(stats), where=total[:, None] != 0)
    level, order, depth, left, made = start, [start], np.zeros(len(start), np.int64), [], len(start)
    while len(level):
        at = inner[level]
        here = made - len(level) + np.arange(len(level))
        here[at] = made + 2 * np.arange(at.sum())
        left.append(here)
        parents = level[at]
        level = np.stack([start[tree[parents]] + a[parents], start[tree[parents]] + b[parents]], 1).ravel()
        depth[np.unique(tree[parents])] += 1
        made += len(level)
        order.append(level)
    order = np.concatenate(order)
    return feature[order].astype(np.int64), threshold[order], np.concatenate(left), np.ascontiguousarray(shares[order].T), depth


def score(model: RandomForestClassificationModel, df: DataFrame, columns: Sequence[str], values: str) -> DataFrame:
    """``columns`` with the predicted class and the probability of class 1; ``values`` is an array of the model's features."""
    feature, threshold, left, shares, depth = _flat(_nodes(model, df.sparkSession))
    kept = df.select(*columns, values)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy()
            votes = np.zeros((2, batch.num_rows))
            base = np.arange(batch.num_rows) * (len(x) // max(1, batch.num_rows))
            for t, steps in enumerate(depth.tolist()):
                node = np.full(batch.num_rows, t)
                for _ in range(steps):
                    right = x.take(base + feature.take(node)) > threshold.take(node)
                    node = left.take(node) + right
                votes[0] += shares[0].take(node)
                votes[1] += shares[1].take(node)
            total = votes[0] + votes[1]
            probability = np.divide(votes[1], total, out=votes[1].copy(), where=total != 0)
            made = [pa.array((votes[1] > votes[0]).astype(np.int32)), pa.array(probability)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], "prediction", "probability"])

    schema = StructType([*df.select(*columns).schema.fields, StructField("prediction", IntegerType()), StructField("probability", DoubleType())])
    return kept.mapInArrow(judge, schema)


# ---- Spark's random numbers and orders ---------------------------------------------

_MULTIPLIER, _INCREMENT, _MASK = 0x5DEECE66D, 0xB, (1 << 48) - 1


def _java_state(seed: int) -> int:
    return (seed ^ _MULTIPLIER) & _MASK


def _java_longs(state: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The next n values of java.util.Random.nextLong, and the state after each."""
    states = np.empty(2 * n + 1, np.uint64)
    states[0], known, factor, add = state, 1, _MULTIPLIER, _INCREMENT
    while known < len(states):
        # factor and add lead from a state to the one ``known`` steps on
        fresh = states[: min(known, len(states) - known)]
        states[known : known + len(fresh)] = (fresh * np.uint64(factor) + np.uint64(add)) & np.uint64(_MASK)
        factor, add, known = factor * factor & _MASK, (factor * add + add) & _MASK, known + len(fresh)
    words = (states[1:] >> np.uint64(16)).astype(np.uint32).view(np.int32).astype(np.int64)
    return (words[0::2] << 32) + words[1::2], states[2::2]


def _murmur(words: Sequence[np.ndarray], seed: np.ndarray) -> np.ndarray:
    """32-bit MurmurHash3 of two words."""
    h = seed.astype(np.uint32)
    for k in words:
        k = k * np.uint32(0xCC9E2D51)
        k = (k << np.uint32(15)) | (k >> np.uint32(17))
        h = h ^ (k * np.uint32(0x1B873593))
        h = (h << np.uint32(13)) | (h >> np.uint32(19))
        h = h * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def _reservoirs(seeds: np.ndarray, n: int, k: int) -> np.ndarray:
    """Reservoir samples of k of the numbers below n, one row per seed, by Spark's XORShiftRandom."""
    words = seeds.astype(">i8").view(np.uint8).reshape(-1, 8).view("<u4").astype(np.uint32)
    low = _murmur((words[:, 0], words[:, 1]), np.full(len(seeds), 0x3C074A61, np.uint32))
    high = _murmur((words[:, 0], words[:, 1]), low)
    state = (high.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)

    def draw(bits: int) -> np.ndarray:
        nonlocal state
        state = state ^ (state << np.uint64(21))
        state = state ^ (state >> np.uint64(35))
        state = state ^ (state << np.uint64(4))
        return (state & np.uint64((1 << bits) - 1)).astype(np.int64)

    held = np.tile(np.arange(k), (len(seeds), 1))
    for item in range(k, n):
        real = ((draw(26) << 27) + draw(27)) * 2.0**-53
        place = (real * (item + 1)).astype(np.int64)
        hit = np.flatnonzero(place < k)
        held[hit, place[hit]] = item
    return held


def _map_order(keys: list[int]) -> list[int]:
    """The order in which Scala's immutable map gives small whole numbers."""
    keys = sorted(keys)
    if len(keys) <= 4:
        return keys

    def spread(key: int) -> int:
        h = (key + ~(key << 9)) & 0xFFFFFFFF
        h ^= h >> 14
        h = (h + (h << 4)) & 0xFFFFFFFF
        return h ^ (h >> 10)

    def walk(some: list[int], shift: int) -> list[int]:
        slots: dict[int, list[int]] = {}
        for key in some:
            slots.setdefault((spread(key) >> shift) & 31, []).append(key)
        alone = [slots[s][0] for s in sorted(slots) if len(slots[s]) == 1]
        return alone + [key for s in sorted(slots) if len(slots[s]) > 1 for key in walk(slots[s], shift + 5)]

    return walk(keys, 0)
