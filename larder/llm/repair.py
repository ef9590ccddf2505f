"""Conversation structure repair: the cheapest edits that give a conversation the grammar `(s?(ua)+)?` of role initials.

Turns are aligned, as Wagner and Fischer align strings, to the alternating string of every feasible length. Every such
string ends in the same ...uaua, so one table, built from the last turn backwards, holds the alignments to all of them:
cell (i, r) is the cost of aligning the turns from i on to the last r symbols. Only cells in Ukkonen's band are filled:
those whose surplus of turns or symbols costs no more than the incumbent, a repair found by one pass over the turns. The
lengths that reach the least cost are traced back, each to its least audit, and the audits are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from larder.llm.common import fresh

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
CELLS = 1 << 20  # a larger table is folded
BLANK = " \t\n\x0b\x0c\r"
STOPS = ".!?"
ROLES = {"u": "user", "a": "assistant"}
NEVER = 1 << 60

REPAIRED = ArrayType(StructType([StructField("role", StringType()), StructField("text", StringType())]))
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
FIELDS = [*(StructField(c, LongType()) for c in COUNTS), StructField("audit", StringType()), StructField("repaired", REPAIRED)]


class Turn(NamedTuple):
    initial: str
    forced: bool  # must be deleted
    surcharge: int  # of leaving it in


def symbol(r: int) -> str:
    """The first of the last `r` symbols of ...uaua."""
    return "u" if r % 2 == 0 else "a"


def _kept(turn: Turn, wanted: str) -> int:
    """Cost of the turn in the place of a symbol: kept, or with a new role."""
    return NEVER if turn.forced else turn.surcharge + (0 if turn.initial == wanted else REROLE)


def incumbent(turns: list[Turn]) -> int:
    """Cost of a repair made in one pass: forced turns go, the others take the next role, an open pair is closed."""
    cost, wanted = 0, "u"
    for turn in turns:
        if turn.forced:
            cost += DELETE
        else:
            cost += _kept(turn, wanted)
            wanted = "a" if wanted == "u" else "u"
    return min(cost + INSERT * (wanted == "a"), DELETE * len(turns))


def table(turns: list[Turn], bound: int) -> list[tuple[int, list[int]]]:
    """Per turn, from which r on, the least costs of cells in the band; a cell outside costs more than the bound."""
    n = len(turns)
    rows: list[tuple[int, list[int]]] = [(0, [])] * (n + 1)
    below, under = [], 0
    for i in range(n, -1, -1):
        lo, hi = max(0, n - i - bound // DELETE), n - i + bound // INSERT
        here: list[int] = []
        for r in range(lo, hi + 1):
            best = 0 if i == n and r == 0 else NEVER
            if i < n:
                if 0 <= r - under < len(below):
                    best = DELETE + below[r - under]
                if r and 0 <= r - 1 - under < len(below):
                    best = min(best, _kept(turns[i], symbol(r)) + below[r - 1 - under])
            if r > lo:
                best = min(best, INSERT + here[-1])
            here.append(best)
        rows[i] = lo, here
        below, under = here, lo
    return rows


class Lengths:
    """Alignments to the strings of every feasible length, from one banded table."""

    def __init__(self, turns: list[Turn], bound: int) -> None:
        self.turns, self.rows = turns, table(turns, bound)

    def cost(self, i: int, r: int) -> int:
        lo, row = self.rows[i]
        return row[r - lo] if 0 <= r - lo < len(row) else NEVER

    def ends(self, i: int) -> Iterator[int]:
        """How many symbols may be left before turn `i`, where whole pairs are."""
        lo, row = self.rows[i]
        return iter(range(lo + lo % 2, lo + len(row), 2))

    def after_insert(self, r: int) -> int:
        return r - 1

    after_keep = after_insert


class Folded:
    """The same costs where the table would be too large.

    The cost of the rest depends on r by its parity and by the end that it reaches; as any end will do, the columns of
    one parity fold into one, the least of them. Column 0 also stands for the end, column 1 for an open pair.
    """

    def __init__(self, turns: list[Turn]) -> None:
        self.turns = turns
        rows = [(0, 0)] * (len(turns) + 1)
        rows[-1] = (0, INSERT)
        for i in range(len(turns) - 1, -1, -1):
            even, odd = rows[i + 1]
            stay = [min(DELETE + even, _kept(turns[i], "u") + odd), min(DELETE + odd, _kept(turns[i], "a") + even)]
            rows[i] = min(stay[0], INSERT + stay[1]), min(stay[1], INSERT + stay[0])
        self.rows = rows

    def cost(self, i: int, r: int) -> int:
        return self.rows[i][r]

    def ends(self, i: int) -> Iterator[int]:
        return iter((0,))

    def after_insert(self, r: int) -> int:
        return 1 - r

    after_keep = after_insert


def trace(found: Lengths | Folded, i: int, r: int) -> str:
    """The least audit, in ASCII order, of the turns from `i` on against the last `r` symbols."""
    turns, audit = found.turns, []
    while True:
        rest = found.cost(i, r)
        if rest == 0 and i == len(turns) and r == 0:
            return "".join(audit)
        kept = _kept(turns[i], symbol(r)) if i < len(turns) and (r or isinstance(found, Folded)) else NEVER
        if i < len(turns) and rest == DELETE + found.cost(i + 1, r):
            audit.append("D")
            i += 1
        elif (r or isinstance(found, Folded)) and rest == INSERT + found.cost(i, found.after_insert(r)):
            audit.append("I")
            r = found.after_insert(r)
        else:
            audit.append("K" if turns[i].initial == symbol(r) else "R")
            assert rest == kept + found.cost(i + 1, found.after_keep(r))
            i, r = i + 1, found.after_keep(r)


def cheapest(turns: list[Turn], cells: int = CELLS) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; of equal ones the audit that is least in ASCII order."""
    bound = incumbent(turns)
    wide = (len(turns) + 1) * (bound // DELETE + bound // INSERT + 1)
    found = Lengths(turns, bound) if wide <= cells else Folded(turns)
    starts = [(0, "", 0, r) for r in found.ends(0)]
    # a system turn leads if it is kept, all before it are deleted and at least one pair follows
    for i, turn in enumerate(turns):
        if DELETE * i > bound:
            break
        if turn.initial == "s" and not turn.forced:
            starts += [(DELETE * i + turn.surcharge, "D" * i + "K", i + 1, r) for r in found.ends(i + 1) if r or isinstance(found, Folded)]
    best, audits = NEVER, []
    for before, done, i, r in starts:
        whole = before + (_pairs(found, i) if done and isinstance(found, Folded) else found.cost(i, r))
        if whole < best:
            best, audits = whole, []
        if whole == best:
            audits.append((done, i, r))
    return best, min(done + (_pairs_trace(found, i) if done and isinstance(found, Folded) else trace(found, i, r)) for done, i, r in audits)


def _pairs(found: Folded, i: int) -> int:
    """Cost of the rest if it must hold a pair at least: the first symbol is placed by a turn or an insertion."""
    best, deleted = NEVER, 0
    for j in range(i, len(found.turns) + 1):
        best = min(best, deleted + INSERT + found.cost(j, 1))
        if j < len(found.turns):
            best = min(best, deleted + _kept(found.turns[j], "u") + found.cost(j + 1, 1))
        deleted += DELETE
        if deleted >= best:
            break
    return best


def _pairs_trace(found: Folded, i: int) -> str:
    """The least audit of `_pairs`."""
    best, done = _pairs(found, i), []
    while True:
        if i < len(found.turns) and best == DELETE + _pairs(found, i + 1):
            done.append("D")
            best, i = best - DELETE, i + 1
        elif best == INSERT + found.cost(i, 1):
            return "".join(done) + "I" + trace(found, i, 1)
        else:
            return "".join(done) + ("K" if found.turns[i].initial == "u" else "R") + trace(found, i + 1, 1)


def apply(rows: list[tuple[str, str]], audit: str) -> list[dict[str, str]]:
    """The repaired turns; the audit alone says which length, and so which role, each place has."""
    length = len(audit) - audit.count("D")
    out, at = [], 0
    for letter in audit:
        role, text = rows[at] if letter != "I" else ("", "")
        at += letter != "I"
        if letter != "D":
            # the rest of the string, from the place that this turn takes, tells the role
            out.append({"role": role if letter == "K" else ROLES[symbol(length - len(out))], "text": text})
    return out


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """The first fault of each turn, or an empty string."""
    seen, found = set(), []
    for row in rows:
        bare = row[1].strip(BLANK)
        found.append("blank" if not bare else "duplicate" if row in seen else "truncated" if bare[-1] not in STOPS else "")
        seen.add(row)
    return found


def repair_turns(numbers: list[int | None], rows: list[tuple[str, str]], cells: int = CELLS) -> tuple:
    """The columns of FIELDS for the (role, text) of one conversation, in order."""
    fault = faults(rows)
    turns = [Turn(role[:1], f in ("blank", "duplicate"), TRUNCATED if f == "truncated" else 0) for (role, _), f in zip(rows, fault)]
    cost, audit = cheapest(turns, cells)
    known = {n for n in numbers if n is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return gaps, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, apply(rows, audit)


def repair(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None, cells: int = CELLS
) -> DataFrame:
    """One row per conversation: its id, the columns of FIELDS, `repaired` being the turns after the cheapest edits.

    Turns are ordered by number, a null one first, then role and text. A null role or text is one blank. A turn is
    blank, a duplicate of an earlier one or truncated, by its first fault; blank and duplicate ones are deleted. A role
    counts by its first character, so an empty one is never kept. Repeated rows are duplicates; a null id is a
    conversation. Rows whose column `present` is not true only name their conversation, so one without turns has zeros
    and an empty audit. Other columns aren't read. Conversations are shuffled by id once and read in order; a result is
    one row, so the turns of a conversation meet in one task, in memory about the size of that row.
    """
    there = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        there.alias("present"),
    )
    rows = rows.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text")
    schema = StructType([StructField(conv, turns.schema[conv].dataType), *FIELDS])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held: tuple[list, list] = [], []
        current: list = []  # the id of the conversation at hand, none before the first

        def flush(limit: int) -> Iterator[pa.RecordBatch]:
            if len(done) >= limit:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=schema.fieldNames())
                done.clear()

        for batch in batches:
            for own, number, who, said, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if current != [own]:
                    if current:
                        done.append((*current, *repair_turns(*held, cells)))
                        yield from flush(256)
                    current, held = [own], ([], [])
                if counts:
                    held[0].append(number)
                    held[1].append((who, said))
        if current:
            done.append((*current, *repair_turns(*held, cells)))
        yield from flush(1)

    return rows.mapInArrow(run, schema)


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, present): the turns with faults put in by CRC-32 of `conv:turn`; dropped ones aren't present.

    Of twenty values, 0 drops a turn, 1 empties its text, 2 takes its stops, 3 repeats it and 4 gives it to the user.
    Nulls count as one blank.
    """

    def known(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    code = F.crc32(F.concat(known(conv), F.lit(":"), known(turn)).cast("binary")) % 20
    rows = turns.select(F.col(f"`{conv}`").alias(conv), F.col(f"`{turn}`").alias(turn), known(role).alias("r"), known(text).alias("t"), code.alias("code"))
    left = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("t", "[.!?]", "")).otherwise(F.col("t"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1)))
    shaped = rows.select(conv, turn, F.when(F.col("code") == 4, "user").otherwise(F.col("r")).alias(role), left.alias(text), (F.col("code") != 0).alias("present"), times.alias(fresh("times", turns)))
    return shaped.select(conv, turn, role, text, "present")


def report(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation of the damaged turns: counts of faults, cost, audit and a digest of the repaired turns."""
    rows = repair(damaged(turns, conv, turn, role, text), conv, turn, role, text, "present")
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return rows.select(conv, *COUNTS, "audit", F.sha2(F.encode(lines, "UTF-8"), 256).alias("repaired_sha256"))
