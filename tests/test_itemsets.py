"""Frequent item sets and their rules against enumeration."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from larder.operators import itemsets
from tests.test_operators import line, table


def some_baskets(seed: int, orders: int, rows: int) -> list[tuple[int | None, int | None]]:
    rng = np.random.default_rng(seed)
    pairs = [(int(o), int(i)) for o, i in zip(rng.integers(0, orders, rows), rng.zipf(1.5, rows) % 14)]
    return [*pairs, *((999, i) for i in range(14)), (None, 3), (1000, None), (1000, 2)]  # one basket holds every item


def by_hand(pairs, support, size):
    held: dict[int, set[int]] = {}
    for o, i in pairs:
        if o is not None:
            held.setdefault(o, set()).update([] if i is None else [i])
    counts = Counter(s for b in held.values() for k in range(1, size + 1) for s in combinations(sorted(b), k))
    return {s: c for s, c in counts.items() if c >= support * len(held)}, len(held)


@pytest.mark.parametrize(("size", "chunk", "support"), [(3, 65_536, 0.05), (3, 20, 0.02), (4, 7, 0.1), (5, 1000, 0.3), (1, 10, 0.05), (3, 50, 0.99)])
def test_itemsets_match_enumeration(spark, size, chunk, support):
    pairs = some_baskets(size, 60, 400)
    lines = table(spark, "Order_Items", [line(n, o, i) for n, (o, i) in enumerate(pairs)])
    got = itemsets.frequent_itemsets(lines, support, size, chunk)
    want, total = by_hand(pairs, support, size)
    rows = got.collect()
    assert {tuple(r["items"]): r.baskets for r in rows} == want and len(rows) == len(want)
    assert all(r["size"] == len(r["items"]) and r.support == round(r.baskets / total, 6) for r in rows)
    rules = {(tuple(r.antecedent), tuple(r.consequent)): (r.confidence, r.lift) for r in itemsets.itemset_rules(got, total, 0.4, 1.1).collect()}
    expected = {}
    for s, c in want.items():
        for k in range(1, len(s)):
            for a in combinations(s, k):
                b = tuple(x for x in s if x not in a)
                confidence = (c / total) / (want[a] / total)
                if confidence >= 0.4 and confidence / (want[b] / total) >= 1.1:
                    expected[a, b] = confidence, confidence / (want[b] / total)
    assert rules.keys() == expected.keys()
    for key, pair in rules.items():
        assert pair == pytest.approx(expected[key], abs=6e-5)


def test_no_baskets_and_no_frequent_sets(spark):
    empty = table(spark, "Order_Items", [])
    assert itemsets.frequent_itemsets(empty).collect() == []
    lines = table(spark, "Order_Items", [line(i, i, i) for i in range(10)])
    assert itemsets.frequent_itemsets(lines, 0.5).collect() == []


def test_candidates_have_frequent_subsets_only():
    frequent = {(1, 2), (1, 3), (2, 3), (2, 4), (3, 4)}
    found: Counter = Counter()
    itemsets.Candidates(frequent).count({i: 0b111 for i in range(5)}, found)
    assert found == {(1, 2, 3): 3, (2, 3, 4): 3}
