"""Suffix-array dedup against brute force."""

from __future__ import annotations

import collections
import hashlib
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.llm import catalogue, suffixes
from tests.llm.fixtures import SF, corpus, documents, odd_rows, sentence, with_clashes


def plain(texts: list[str | None], span: int) -> list[tuple]:
    """(bytes, removed, stretches, digest of the rest) by counting every window."""
    bodies = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i : i + span] for b in bodies for i in range(len(b) - span + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if count[b[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shared_texts(rng: random.Random, n: int, span: int) -> list[str]:
    """Texts with shared stretches of about a span, copies, near copies, runs of one letter and periods."""
    passages = [sentence(rng, "en", 8 + span // 5) for _ in range(6)] + ["a" * 3 * span, "ab" * span, "abc" * span, "é" * span, "\0" * span + "z"]
    texts = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.1 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.3 and texts:
            t = list(rng.choice(texts))
            for _ in range(rng.randint(1, 4)):
                t.insert(rng.randrange(len(t) + 1), rng.choice("xyzé\0"))
            texts.append("".join(t))
        else:
            parts = [sentence(rng, rng.choice(["en", "de", "fr"]), rng.randint(0, span // 4)) for _ in range(rng.randint(1, 3))]
            for p in rng.sample(passages, rng.randint(0, 2)):
                lo = rng.randrange(max(1, len(p) - span))
                parts.insert(rng.randrange(len(parts) + 1), p[lo : lo + span + rng.randint(-4, 30)])
            texts.append("|".join(parts))
    return texts


@pytest.mark.parametrize("span,crowded,part", [(16, 10**6, 10**9), (21, 10**6, 2000), (40, 3, 5000), (200, 10**6, 9000), (200, 4, 9000)])
def test_repeats_against_brute_force(spark, span, crowded, part):
    texts = shared_texts(random.Random(span + crowded), 70, span)
    frame = documents(spark, [(i, t, "en", "h", len(t)) for i, t in enumerate(texts)])
    got = suffixes.report(frame, span=span, crowded=crowded, part_bytes=part).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == dict(enumerate(plain(texts, span)))
    assert len(got) == len(texts) and any(0 < r.n_removed < r.n_bytes for r in got)


def test_odd_rows_and_clashing_columns(spark):
    rows = corpus(20) + odd_rows()
    expected = collections.Counter((r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows], 200)))
    frame = with_clashes(documents(spark, rows)).withColumn("kept", F.lit(1)).withColumn("OF", F.lit(2)).withColumn("left", F.lit(2))
    assert collections.Counter(map(tuple, suffixes.report(frame).collect())) == expected
    whole = suffixes.drop_repeats(frame)
    assert set(frame.columns) <= set(whole.columns) and len(set(whole.columns)) == len(whole.columns)
    got = collections.Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in whole.collect())
    assert got == expected
    assert suffixes.report(documents(spark, [])).collect() == []
    assert suffixes.report(documents(spark, [(1, None, None, None, None), (1, "short", None, None, None)])).count() == 2


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in catalogue.QUERIES["op11_suffixes"](spark, SF).collect()}
    assert got == dict(zip(texts, plain(list(texts.values()), 200)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="ab", min_size=6, max_size=6), max_size=12), max_size=9))
def test_merge_orders_and_knows_prefixes(runs):
    runs = [sorted(s.encode() for s in run) for run in runs]

    def shared(a, b):
        return len(os.path.commonprefix([a, b]))

    given_runs = [(run, [0, *(shared(a, b) for a, b in zip(run, run[1:]))]) for run in runs]
    run, place, prefix = suffixes.merge(given_runs) if runs else ([], [], [])
    out = [runs[r][p] for r, p in zip(run, place)]
    assert out == sorted(s for r in runs for s in r)
    assert prefix[1:] == [shared(a, b) for a, b in zip(out, out[1:])]


def test_no_prefix_is_compared_twice(monkeypatch):
    rng = random.Random(3)
    runs = [sorted(b"common prefix of all " + rng.randbytes(30) for _ in range(200)) for _ in range(8)]
    given_runs = [(run, suffixes.shared_with_previous(np.array([list(r) for r in run], np.uint8)).tolist()) for run in runs]
    compared, real = [], suffixes._common
    monkeypatch.setattr(suffixes, "_common", lambda x, y, at: compared.append(real(x, y, at) - at) or real(x, y, at))
    suffixes.merge(given_runs)
    assert sum(compared) < 7 * 24 + 1600 * 2  # the prefix is read in the first round only


@given(st.integers(0, 2**32 - 1), st.sampled_from([16, 17, 24, 33, 64, 200]))
@settings(max_examples=40, deadline=None)
def test_every_window_has_one_unit_and_equal_windows_agree(seed, span):
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 3 * span))) * rng.randint(1, 2) for _ in range(6)]
    anchors = {}
    for owner, anchor, near, far, key in suffixes.units(texts, span):
        for n, at, lo, hi, k in zip(owner.tolist(), anchor.tolist(), near.tolist(), far.tolist(), key.tolist()):
            for back in range(lo, hi + 1):
                assert (n, at - back) not in anchors
                anchors[n, at - back] = back, k
    assert len(anchors) == sum(max(0, len(t) - span + 1) for t in texts)
    by_bytes = collections.defaultdict(set)
    for (n, at), value in anchors.items():
        by_bytes[texts[n][at : at + span]].add(value)
    assert all(len(v) == 1 for v in by_bytes.values())


def test_long_texts_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 500)
    texts = [b"0123456789" * 300, bytes(random.Random(2).randbytes(1700)), b""]
    held = [(int(n), int(a - b)) for o, at, lo, hi, _ in suffixes.units(texts, 40) for n, a, x, y in zip(o, at, lo, hi) for b in range(x, y + 1)]
    assert sorted(held) == [(n, p) for n, t in enumerate(texts) for p in range(len(t) - 39)]
