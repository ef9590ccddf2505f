"""Fill-in-middle and conversation repair against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.llm import catalogue, fim, repair
from tests.llm.fixtures import SF, corpus, documents, odd_rows, with_clashes


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle ----------------------------------------------------
def plain_fim(doc_id, text):
    """The contract, with a list of tokens and their joins."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    lo, hi = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    a, b, c = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, sha(text), sha(text)
    form, out = ("spm", f"<S>{c}<P>{a}<M>{b}") if h4 % 100 < 20 else ("psm", f"<P>{a}<S>{c}<M>{b}")
    return len(units), form, len(a), len(b), sha(out), sha(text)


MARKED = ["<P>", "a <S> b", "x<M>", "<P", "ab <S", "S> <M", ">", "<<P<", "a<", "<S<S<M>x", "é" * 50, "a" * 5000, "a b " * 4000]


def test_fim_against_brute_force(spark):
    rows = corpus(40) + odd_rows() + [(2000 + i, t, "en", "h", len(t)) for i, t in enumerate(MARKED * 6)]
    frame = documents(spark, rows)
    for docs in (frame, with_clashes(frame).withColumn("N", F.lit(3)).withColumn("draw", F.lit("x")).withColumn("output", F.lit("y"))):
        got = fim.digests(docs).collect()
        expected = collections.Counter((r[0], *plain_fim(r[0], r[1])) for r in rows)
        assert collections.Counter(map(tuple, got)) == expected
        assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.digests(documents(spark, [])).collect() == []
    kept = fim.transform(with_clashes(frame))
    assert set(with_clashes(frame).columns) <= set(kept.columns) and len(kept.columns) == len(set(kept.columns))


def test_fim_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = collections.Counter(con.execute(fim.SQL).fetchall())
    assert collections.Counter(map(tuple, catalogue.QUERIES["op12_fim"](spark, SF).collect())) == expected


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\U0001f600<PSM>1", max_size=200), st.integers(0, 10**6))
def test_fim_cuts(text, draw):
    n, form, prefix, middle, output = fim.shape(text, f"1:{draw}")
    expected = plain_fim(draw, text)
    assert (n, form, prefix, middle, sha(output)) == expected[:5]


@pytest.mark.parametrize("tokens", [0, 1, 2, 8, 9, 64, 65, 1000, 20_000])
def test_skip_list_reaches_every_rank(tokens):
    rng = random.Random(tokens)
    units = [rng.choice(["a", "word", "\U0001f600", " "]) + rng.choice([".", "é"]) for _ in range(tokens // 2)]
    text = "".join(units)
    parts = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    ranks = fim.SkipList(fim.token_starts(text), len(text))
    assert len(parts) < 100 or len(ranks.lanes) > 1
    ends = [0]
    for p in parts:
        ends.append(ends[-1] + len(p))
    for rank in {0, len(parts), *rng.sample(range(len(parts) + 1), min(len(parts) + 1, 300))}:
        assert ranks.points_before(rank) == ends[rank]


# ---- conversation repair ---------------------------------------------------
GRAMMAR = re.compile("(s?(ua)+)?")


def every_repair(turns: list[repair.Turn]):
    """All edit sequences no dearer than deleting everything: (cost, audit) of those that give the grammar."""
    limit = 4 * len(turns)
    stack = [(0, 0, "", "")]
    while stack:
        i, cost, audit, out = stack.pop()
        if cost > limit:
            continue
        if i == len(turns) and GRAMMAR.fullmatch(out):
            yield cost, audit
        for c in "ua":
            stack.append((i, cost + 3, audit + "I", out + c))
        if i < len(turns):
            t = turns[i]
            stack.append((i + 1, cost + 4, audit + "D", out))
            if not t.forced:
                stack.append((i + 1, cost + t.surcharge, audit + "K", out + t.initial))
                for c in "ua":
                    stack.append((i + 1, cost + t.surcharge + 3, audit + "R", out + c))


def some_turns(rng: random.Random, n: int) -> list[repair.Turn]:
    return [repair.Turn(rng.choice("uuaasx"), rng.random() < 0.2, rng.choice([0, 0, 0, 3])) for _ in range(n)]


def test_repair_is_the_cheapest_and_least():
    rng = random.Random(5)
    for _ in range(250):
        turns = some_turns(rng, rng.randint(0, 4))
        expected = min(every_repair(turns))
        assert repair.cheapest(turns) == expected, turns
        assert repair.cheapest(turns, cells=0) == expected, turns


def by_states(turns: list[repair.Turn]) -> tuple[int, str]:
    """The same by the grammar's automaton, all states at once, from the last turn backwards."""
    big = (10**9, "")
    step = {"start": {"s": "led", "u": "u"}, "led": {"u": "u"}, "u": {"a": "pair"}, "pair": {"u": "u"}}
    here = {"start": (0, ""), "led": big, "u": big, "pair": (0, "")}

    def relax(states):
        for _ in range(5):
            for s, moves in step.items():
                for c, to in moves.items():
                    if c != "s":
                        states[s] = min(states[s], (states[to][0] + 3, "I" + states[to][1]))
        return states

    here = relax(here)
    for t in reversed(turns):
        new = {}
        for s, moves in step.items():
            options = [(here[s][0] + 4, "D" + here[s][1])]
            if not t.forced:
                for c, to in moves.items():
                    if c == t.initial:
                        options.append((here[to][0] + t.surcharge, "K" + here[to][1]))
                    if c != "s":
                        options.append((here[to][0] + t.surcharge + 3, "R" + here[to][1]))
            new[s] = min(options)
        here = relax(new)
    return here["start"]


@pytest.mark.parametrize("n", [6, 9, 14, 40, 120])
def test_long_repairs(n):
    rng = random.Random(n)
    for _ in range(60 if n < 40 else 8):
        turns = some_turns(rng, n)
        expected = by_states(turns)
        assert repair.cheapest(turns) == expected
        assert repair.cheapest(turns, cells=0) == expected


def test_repair_of_a_very_long_conversation():
    rng = random.Random(1)
    turns = some_turns(rng, 20_000)
    cost, audit = repair.cheapest(turns)
    assert audit.count("D") + audit.count("K") + audit.count("R") == len(turns)
    charged = [t.surcharge for t, letter in zip(turns, audit.replace("I", "")) if letter != "D"]
    assert cost == 4 * audit.count("D") + 3 * audit.count("R") + 3 * audit.count("I") + sum(charged)


CONV = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = collections.defaultdict(list)
    for c, t, role, text in rows:
        out[c]
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if code:
            row = (t, "user" if code == 4 else role, "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text)
            out[c] += [row] * (2 if code == 3 else 1)
    return {c: sorted(v, key=lambda r: ((-1, 0) if r[0] is None else (0, r[0]), r[1], r[2])) for c, v in out.items()}


def plain_report(rows):
    for c, own in damage(rows).items():
        turns, seen, counts = [], set(), collections.Counter()
        for _, role, text in own:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            turns.append(repair.Turn(role[:1], fault in ("blank", "duplicate"), 3 * (fault == "truncated")))
        known = [t for t, *_ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = by_states(turns)
        out, at = [], 0
        odd = (len(audit) - audit.count("D")) % 2
        for letter in audit:
            if letter != "I":
                _, role, text = own[at]
                at += 1
            if letter != "D":
                expected = "user" if len(out) % 2 == odd else "assistant"
                out.append(f"{role}:{text}" if letter == "K" else f"{expected}:{'' if letter == 'I' else text}")
        yield c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(out))


def some_conversations(n: int = 150, seed: int = 2) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.4:
            rows.append((c, 0, "system", "You help."))
        for t in range(1, rng.randint(1, 14)):
            role = rng.choice(["user", "assistant"] if rng.random() < 0.2 else ["user"] if t % 2 else ["assistant"])
            rows.append((c, t * rng.choice([1, 1, 1, 2]), role, rng.choice(["Yes.", "What now?", "cut of", "  ", f"Answer {t}!", "Ω。"])))
    rows += [(1000, None, "user", "no number."), (1000, 3, None, None), (1000, None, "tool", "x."), (None, 1, "user", "Lost."), (None, 2, "assistant", "Found.")]
    rows += [(1001, 5, "user", "Twice."), (1001, 5, "user", "Twice."), (1002, 1, "assistant", "\x0b\x0c\r"), (1003, 1, "user", "long. " * 50_000)]
    rows += [(2000 + i, 0, "user", "Alone.") for i in range(60)]
    return rows


def test_conversation_report_against_brute_force(spark):
    rows = some_conversations()
    frame = spark.createDataFrame(rows, CONV)
    expected = collections.Counter(plain_report(rows))
    assert any(key[-2] == "" for key in expected)  # a conversation whose only turn was dropped
    extra = frame.select("*", *(F.lit("x").alias(c) for c in ("present", "conv", "audit", "cost", "r", "t", "code", "times", "fault")))
    for given_rows in (frame, extra):
        assert collections.Counter(map(tuple, repair.report(given_rows).collect())) == expected
    assert repair.report(spark.createDataFrame([], CONV)).collect() == []


def test_conversation_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = catalogue.QUERIES["op13_repair"](spark, SF).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(plain_report(rows))


def test_repaired_turns_follow_the_grammar(spark):
    got = repair.repair(spark.createDataFrame(some_conversations(60, 9), CONV)).collect()
    for r in got:
        assert GRAMMAR.fullmatch("".join(t.role[:1] for t in r.repaired)), r
