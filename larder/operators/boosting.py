"""Gradient-boosted trees, one model per entity, all entities at once.

A series has a row per day, so a model's rows are bounded by the calendar: entities are dealt over the tasks and each is
fitted where its rows meet, in one shuffle, where a table-wide histogram would take a Spark job for every level of every
tree. Within an entity the trees are grown on histograms: values become codes of at most `max_bins` bins per feature, and
each level of a tree takes one pass that adds up residuals by node, feature and bin.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.scalar import dbl


class Split(NamedTuple):
    feature: int
    threshold: float  # rows at or below go left


class Tree(NamedTuple):
    splits: dict[int, Split]  # by node: the root is 1, the children of n are 2n and 2n + 1
    values: dict[int, float]  # of the leaves


class Bins:
    """Codes of each feature's values: distinct values where they are few, else ranges of about as many rows."""

    def __init__(self, x: np.ndarray, max_bins: int) -> None:
        self.x = x
        self.edges = []  # between two bins, the middle of the values on either side
        codes = np.empty(x.shape, np.int64)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            if len(values) > max_bins:
                ranked = np.sort(x[:, f])
                firsts = np.unique(ranked[np.arange(1, max_bins) * len(ranked) // max_bins])
                at = np.searchsorted(values, firsts)
                at = at[at > 0]
            else:
                at = np.arange(1, len(values))
            edges = (values[at - 1] + values[at]) / 2
            self.edges.append(edges)
            codes[:, f] = np.searchsorted(edges, x[:, f], side="left")
        self.first = np.cumsum([0] + [len(e) + 1 for e in self.edges])
        self.codes = codes + self.first[:-1]
        self.last = np.zeros(self.first[-1], bool)  # nothing lies right of a feature's last bin
        self.last[self.first[1:] - 1] = True


def grow(bins: Bins, residual: np.ndarray, depth: int, min_leaf: int) -> tuple[Tree, np.ndarray]:
    """A regression tree of least squares, and the node of each row; of equal splits the first feature's lowest."""
    width = bins.first[-1]
    node = np.ones(len(residual), np.int64)
    splits: dict[int, Split] = {}
    for _ in range(depth):
        names, at = np.unique(node, return_inverse=True)
        cell = (at[:, None] * width + bins.codes).ravel()
        size = len(names) * width
        count = np.bincount(cell, minlength=size).reshape(len(names), width)
        total = np.bincount(cell, np.repeat(residual, bins.codes.shape[1]), size).reshape(len(names), width)
        before_n, before_s = np.cumsum(count, axis=1), np.cumsum(total, axis=1)
        # running sums start anew at each feature: every row is once in each
        rows, sums = np.bincount(at, minlength=len(names)), np.bincount(at, residual, len(names))
        feature = np.repeat(np.arange(len(bins.edges)), np.diff(bins.first))
        left_n = before_n - feature * rows[:, None]
        left_s = before_s - feature * sums[:, None]
        right_n, right_s = rows[:, None] - left_n, sums[:, None] - left_s
        allowed = (left_n >= min_leaf) & (right_n >= min_leaf) & ~bins.last
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_s**2 / left_n + right_s**2 / right_n - (sums**2 / rows)[:, None]
        gain = np.where(allowed, gain, -np.inf)
        best = gain.argmax(axis=1)
        # sums differ by rounding: of gains within it the first counts
        close = gain >= (gain[np.arange(len(names)), best] - 1e-9 * (1 + np.abs(sums**2 / rows)))[:, None]
        best = np.where(np.isfinite(gain.max(axis=1)), close.argmax(axis=1), -1)
        done = True
        for k, name in enumerate(names.tolist()):
            if name in splits or best[k] < 0 or gain[k, best[k]] <= 1e-12:
                continue
            f = int(feature[best[k]])
            own = at == k
            right = own & (bins.codes[:, f] > best[k])
            # halfway between the node's own values on either side
            splits[name] = Split(f, float(bins.x[own & ~right, f].max() + bins.x[right, f].min()) / 2)
            node[own] = 2 * name + right[own]
            done = False
        if done:
            break
    names, at = np.unique(node, return_inverse=True)
    means = np.bincount(at, residual) / np.bincount(at)
    return Tree(splits, dict(zip(names.tolist(), means.tolist()))), node


def leaves(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row reaches."""
    node = np.ones(len(x), np.int64)
    for name in sorted(tree.splits):
        own = np.flatnonzero(node == name)
        split = tree.splits[name]
        node[own] = 2 * name + (x[own, split.feature] > split.threshold)
    names = np.array(sorted(tree.values))
    return np.array([tree.values[n] for n in names.tolist()])[np.searchsorted(names, node)]


def fit_predict(
    x: np.ndarray, y: np.ndarray, new: np.ndarray, rounds: int, depth: int, rate: float, min_leaf: int, max_bins: int
) -> np.ndarray:
    """Predictions for new rows of a boosted model of least squares, which starts from the mean."""
    bins = Bins(x, max_bins)
    start = y.mean()
    fitted, predicted = np.full(len(y), start), np.full(len(new), start)
    for _ in range(rounds):
        tree, node = grow(bins, y - fitted, depth, min_leaf)
        if not tree.splits and abs(tree.values[1]) < 1e-12:
            break
        names = np.array(sorted(tree.values))
        fitted += rate * np.array([tree.values[n] for n in names.tolist()])[np.searchsorted(names, node)]
        predicted += rate * leaves(tree, new)
    return predicted


def boosted_per_entity(
    split: DataFrame,
    features: Sequence[str],
    label: str,
    entity: str = "entity_id",
    date: str = "date",
    rounds: int = 200,
    depth: int = 3,
    rate: float = 0.05,
    min_leaf: int = 1,
    max_bins: int = 255,
) -> DataFrame:
    """(entity, date, prediction): the test rows of each entity by a model of its own training rows.

    Missing feature values count as 0; rows without a label don't train. Entities without training rows get no
    predictions. Deterministic: no sampling, and ties go to the first feature and the lowest threshold.
    """
    columns = list(features)
    ready = split.select(entity, date, "split", dbl(label).alias("_y"), *[F.coalesce(dbl(c), F.lit(0.0)).alias(f"_{i}") for i, c in enumerate(columns)])
    kind = {f.name: f.dataType.simpleString() for f in split.schema}

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        x = rows[[f"_{i}" for i in range(len(columns))]].to_numpy(np.float64)
        train = ((rows["split"] == "train") & rows["_y"].notna()).to_numpy()
        order = np.argsort(rows[date].to_numpy(), kind="stable")
        known, test = order[train[order]], order[(rows["split"] == "test").to_numpy()[order]]
        if not len(known):
            return rows.head(0)[[entity, date]].assign(prediction=0.0)
        predicted = fit_predict(x[known], rows["_y"].to_numpy()[known], x[test], rounds, depth, rate, min_leaf, max_bins)
        return pd.DataFrame({entity: rows[entity].to_numpy()[test], date: rows[date].to_numpy()[test], "prediction": predicted})

    return ready.groupBy(entity).applyInPandas(one, f"`{entity}` {kind[entity]}, `{date}` {kind[date]}, prediction double")
