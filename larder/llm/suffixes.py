"""Suffix-array dedup: bytes under a string that also starts elsewhere go, found by a prefix-aware distributed merge sort.

The suffix array is sparse. Each `span`-byte window of a text has an anchor, its place of least hash among the first
`reach` ones; equal windows have equal anchors at equal places, and a text has few of them. A *unit* is an anchor with
the windows that chose it: the suffix that starts there, the bytes before it that those windows reach back to, and from
where to where.

1. Suffixes whose first bytes, those that all windows of a unit share, occur once only are dropped by counting hashes.
2. Each task sorts the suffixes of its texts into a run, equal units once, and sends it in pieces, by the hash of the
   first bytes: front-coded, a suffix being the length it shares with the one before and the bytes that follow.
3. A piece's receiver combines its runs with a loser tree that holds, for each run's next suffix, how much it shares with
   the last one out. Of two, the one that shares more goes first; only what follows an equal share is ever compared.
4. The merged order has the common prefix of all neighbours, so the windows of a unit are compared with all others at
   once: two are equal if their suffixes share enough, and the bytes before the anchors are equal.

Copies of a text are one class, so they cost a row each. First bytes that occur very often would fill a single piece;
their units are taken apart into windows, dealt by all their bytes, of which each run has one at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from larder.llm.common import fresh, slices, without

SPAN = 200
GRAM = 8
PART_BYTES = 2 << 20  # of text, for each part of the exchange
CROWDED = 50_000  # units of one key beyond which they are taken apart
CROWDED_PARTS = 16  # times as many parts for those
PIECE = 4 << 20  # bytes of text at a time
RUN = 1 << 15  # units of a run

_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)

SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))
RUNS = "part int, n int, shared binary, tails binary, before binary, near binary, far binary, again binary, ids binary, place binary, stop binary"
ID_BYTES = 16


def reach_of(span: int) -> int:
    """Places among which a window's anchor is chosen: a power of two, about two thirds of the window, 256 at most."""
    if span < 2 * GRAM:
        raise ValueError(f"spans have at least {2 * GRAM} bytes")
    return min(256, 1 << ((2 * (span - GRAM + 1)) // 3).bit_length() - 1)


def _hash(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes, at least GRAM wide."""
    width = rows.shape[1]
    key = np.zeros(len(rows), np.uint64)
    for at in [*range(0, width - GRAM + 1, GRAM), *([width - GRAM] if width % GRAM else [])]:
        key = (key ^ np.ascontiguousarray(rows[:, at : at + GRAM]).view("<u8").ravel()) * _MULTIPLY
        key ^= key >> np.uint64(29)
    key *= _MIX
    return key ^ (key >> np.uint64(32))


def _cut(texts: list[bytes], span: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Runs of about PIECE bytes of (text, offset, bytes); longer texts are cut so that each window is whole in one cut."""
    held, size = [], 0
    for n, text in enumerate(texts):
        for base in range(0, len(text) - span + 1, PIECE):
            part = text[base : base + PIECE + span - 1]
            if held and size + len(part) > PIECE:
                yield held
                held, size = [], 0
            held.append((n, base, part))
            size += len(part)
    if held:
        yield held


def units(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, anchor, near, far, key) of the units, a bounded number at a time.

    The windows of a unit start `near` to `far` bytes before its anchor; `key` hashes the bytes from the anchor on that
    all windows with this anchor share.
    """
    reach = reach_of(span)
    for parts in _cut(texts, span):
        lengths = np.array([len(p) for *_, p in parts])
        first = np.cumsum(lengths) - lengths
        buffer = b"".join([p for *_, p in parts] + [bytes(span)])
        n = int(lengths.sum())
        words = np.ndarray((n,), "<u8", buffer, strides=(1,))
        keys = words * _MULTIPLY
        keys ^= keys >> np.uint64(32)
        keys *= _MIX
        keys &= _HIGH
        keys |= np.arange(n, dtype=np.uint64)  # of equal hashes the first place
        step = 1
        while step < reach:
            keys = np.minimum(keys[:-step], keys[step:])
            step *= 2
        turns = np.zeros(n + 1, np.int8)
        turns[first] += 1
        turns[first + lengths - span + 1] -= 1
        window = np.flatnonzero(np.cumsum(turns[:-1]))
        anchor = (keys[window] & _LOW).astype(np.int64)
        fresh_unit = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([fresh_unit[1:], [len(window)]]) - 1
        at = anchor[fresh_unit]
        part = np.searchsorted(first, at, side="right") - 1
        shared = span - reach + 1
        rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(buffer, np.uint8), shared)[at]
        owner, base = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
        yield owner[part], at - first[part] + base[part], at - window[last], at - window[fresh_unit], _hash(rows)


def _packed(anchor: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    return (anchor << 16) | (near << 8) | far


class Units(NamedTuple):
    """Units taken out of their texts: rows of `ahead` (the suffix, zeros where no window reads) and `before` (backwards from the anchor)."""

    ahead: np.ndarray
    before: np.ndarray
    near: np.ndarray
    far: np.ndarray
    ids: np.ndarray  # rows of ID_BYTES
    place: np.ndarray
    crowded: np.ndarray

    def take(self, which: np.ndarray) -> Units:
        return Units(*(column[which] for column in self))

    @classmethod
    def joined(cls, parts: list[Units]) -> Units:
        return cls(*map(np.concatenate, zip(*parts))) if len(parts) > 1 else parts[0]


class Run:
    """Units sorted by suffix, equal ones once.

    `once` are those sent, `again` tells which of them are known to have an equal, in the run or, as `known` says,
    outside; `repeated` are all units that the run itself finds to have one.
    """

    def __init__(self, own: Units, known: np.ndarray) -> None:
        whole = np.concatenate([own.ahead, own.before, own.near[:, None].astype(np.uint8), own.far[:, None].astype(np.uint8)], axis=1)
        order = np.argsort(whole.view(f"S{whole.shape[1]}").ravel(), kind="stable")
        whole = whole[order]
        new = np.concatenate([[True], (whole[1:] != whole[:-1]).any(axis=1)])
        kind = np.cumsum(new) - 1
        twice = np.bincount(kind) > 1
        self.again = twice | (np.bincount(kind, known[order]) > 0)
        self.once, self.repeated = own.take(order[new]), own.take(order[twice[kind] & ~known[order]])


def shared_with_previous(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the one before; 0 for the first."""
    differs = rows[1:] != rows[:-1]
    length = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.concatenate([np.zeros(min(1, len(rows)), np.int64), length])


def _marked(run: Run, span: int, parts: int) -> Iterator[tuple]:
    """A row of RUNS with the windows that the run itself knows to be repeated."""
    own = run.repeated
    if len(own.place):
        start, stop = own.place - own.far, own.place - own.near + span
        yield -1 - int(own.place.sum()) % parts, len(start), *[None] * 6, own.ids.tobytes(), start.astype("<i8").tobytes(), stop.astype("<i8").tobytes()


def _pieces(run: Run, span: int, part: np.ndarray) -> Iterator[tuple]:
    """Rows of RUNS: the run front-coded for each receiver; `part` is that of each unit sent."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for some in np.split(order, cuts):
        own = run.once.take(some)
        shared = shared_with_previous(own.ahead)
        column = np.arange(span)
        tails = own.ahead[(column >= shared[:, None]) & (column < (span - own.near)[:, None])]
        before = own.before[np.arange(own.before.shape[1]) < own.far[:, None]]
        yield (
            int(part[some[0]]), len(some), shared.astype("<u2").tobytes(), tails.tobytes(), before.tobytes(), own.near.astype(np.uint8).tobytes(),
            own.far.astype(np.uint8).tobytes(), run.again[some].astype(np.uint8).tobytes(), own.ids.tobytes(), own.place.astype("<i8").tobytes(), None,
        )


def _gathered(texts: list[bytes], ids: np.ndarray, owner: np.ndarray, packed: np.ndarray, crowded: np.ndarray, span: int) -> Iterator[Units]:
    """The units at `packed` places of the texts, at most RUN at a time."""
    reach = reach_of(span)
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(lengths) - lengths + reach
    buffer = np.frombuffer(b"".join([bytes(reach), *texts, bytes(span)]), np.uint8)
    forward = np.lib.stride_tricks.sliding_window_view(buffer, span)
    backward = np.lib.stride_tricks.sliding_window_view(buffer, reach - 1)
    for at in range(0, len(packed), RUN):
        own, unit = owner[at : at + RUN], packed[at : at + RUN]
        place, near, far = unit >> 16, (unit >> 8) & 255, unit & 255
        ahead = forward[first[own] + place] * (np.arange(span) < (span - near)[:, None])
        before = backward[first[own] + place - reach + 1][:, ::-1] * (np.arange(reach - 1) < far[:, None])
        yield Units(ahead, before, near, far, ids[own], place, crowded[at : at + RUN])


def _apart(own: Units, span: int) -> Units:
    """The windows of the units as units of their own, with nothing before their anchors."""
    count = own.far - own.near + 1
    unit = np.repeat(np.arange(len(count)), count)
    back = np.arange(len(unit)) - np.repeat(np.cumsum(count) - count, count) + own.near[unit]
    text = np.concatenate([own.before[:, ::-1], own.ahead], axis=1)  # the anchor is at before's width
    rows = np.lib.stride_tricks.sliding_window_view(text, span, axis=1)[unit, own.before.shape[1] - back]
    none = np.zeros(len(unit), np.int64)
    return Units(rows, np.zeros((len(unit), own.before.shape[1]), np.uint8), none, none, own.ids[unit], own.place[unit] - back, own.crowded[unit])


def runs_of(own: Units, span: int, parts: int) -> Iterator[tuple]:
    """Rows of RUNS for a run of units; crowded ones go as single windows, after equal ones are one."""
    reach = reach_of(span)
    for flag in (False, True):
        which = np.flatnonzero(own.crowded == flag)
        if not len(which):
            continue
        run = Run(own.take(which), np.zeros(len(which), bool))
        yield from _marked(run, span, parts)
        if not flag:
            yield from _pieces(run, span, (_hash(run.once.ahead[:, : span - reach + 1]) % np.uint64(parts)).astype(np.int64))
            continue
        step = max(1, RUN // reach)
        for at in range(0, len(run.again), step):
            some = run.once.take(np.arange(at, min(at + step, len(run.again))))
            windows = Run(_apart(some, span), np.repeat(run.again[at : at + step], some.far - some.near + 1))
            yield from _marked(windows, span, parts)
            yield from _pieces(windows, span, parts + (_hash(windows.once.ahead) % np.uint64(parts * CROWDED_PARTS)).astype(np.int64))


def decode(shared: np.ndarray, tails: bytes, near: np.ndarray, span: int) -> list[bytes]:
    """The suffixes of a front-coded run."""
    out, at, last = [], 0, b""
    for common, length in zip(shared.tolist(), np.maximum(0, span - near.astype(np.int64) - shared).tolist()):
        last = (last[:common] + tails[at : at + length]).ljust(span, b"\0")
        at += length
        out.append(last)
    return out


def _common(x: bytes, y: bytes, at: int) -> int:
    """Length of the common prefix, known to be `at` at least."""
    size, end = 16, len(x)
    while at < end:
        p, q = x[at : at + size], y[at : at + size]
        if p != q:
            return at + len(p) - ((int.from_bytes(p) ^ int.from_bytes(q)).bit_length() + 7) // 8
        at += size
        size *= 4
    return end


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """(run, place in it, common prefix with the one before) of all strings of sorted runs, in order.

    A run is its strings, of equal length, and the common prefix of each with the one before. `share[k]` is the common
    prefix of run k's next string and the last one out, or the winner it lost to; a finished run shares less than any.
    """
    count = len(runs)
    at, share = [0] * count, [0] * count
    head = [strings[0] if strings else b"" for strings, _ in runs]
    for k, (strings, _) in enumerate(runs):
        if not strings:
            share[k] = -1
    losers = [-1] * max(1, count)
    size = [len(strings) for strings, _ in runs]

    def play(a: int, b: int) -> tuple[int, int]:
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        if share[a] < 0:
            return a, b
        x, y = head[a], head[b]
        common = _common(x, y, share[a])
        if common == len(x) or x[common] < y[common]:
            share[b] = common
            return a, b
        share[a] = common
        return b, a

    def first(node: int) -> int:
        """Winner below a node of the tree, whose leaves are the runs."""
        if node >= count:
            return node - count
        winner, losers[node] = play(first(2 * node), first(2 * node + 1))
        return winner

    winner = first(1) if count > 1 else 0
    run, place, prefix = [], [], []
    for _ in range(sum(size)):
        run.append(winner)
        place.append(k := at[winner])
        prefix.append(share[winner])
        at[winner] = k = k + 1
        strings, lengths = runs[winner]
        if k < size[winner]:
            head[winner], share[winner] = strings[k], lengths[k]
        else:
            share[winner] = -1
        node = (winner + count) >> 1
        while node:
            other = losers[node]
            if share[other] > share[winner]:
                losers[node], winner = winner, other
            elif share[other] == share[winner]:
                winner, losers[node] = play(winner, other)
            node >>= 1
    return run, place, prefix


def repeated_windows(prefix: np.ndarray, before: np.ndarray, near: np.ndarray, far: np.ndarray, span: int) -> np.ndarray:
    """Unit x distance: whether the window that starts so far before the anchor equals one of another unit.

    Units are in order of their suffixes. Two windows at a distance are equal if the suffixes share the rest of the span
    and the bytes before the anchors are equal.
    """
    found = np.zeros((len(prefix), before.shape[1] + 1), bool)
    live = np.arange(len(prefix))
    left = np.zeros(len(prefix), np.int64)
    for back in range(int(far.max(initial=-1)) + 1):
        if back:
            stays = far[live] >= back
            live, left = live[stays], left[stays]
            _, left = np.unique((left << 8) | before[live, back - 1], return_inverse=True)
        right = np.cumsum(prefix < span - back)
        here = near[live] <= back
        _, kind, count = np.unique(right[live[here]] * (len(prefix) + 1) + left[here], return_inverse=True, return_counts=True)
        found[live[here], back] = count[kind] > 1
    return found


def _merged(rows: pa.Table, span: int) -> pa.Table:
    """(id, start, end) of the repeated windows of one part, neighbouring ones as one."""
    reach = reach_of(span)
    names, starts, ends = [], [], []
    runs, rest = [], []
    for row in rows.to_pylist():
        if row["stop"] is not None:  # known to be repeated by the run itself
            names.append(np.frombuffer(row["ids"], np.uint8).reshape(-1, ID_BYTES))
            starts.append(np.frombuffer(row["place"], "<i8"))
            ends.append(np.frombuffer(row["stop"], "<i8"))
            continue
        shared, near, far = np.frombuffer(row["shared"], "<u2").astype(np.int64), np.frombuffer(row["near"], np.uint8), np.frombuffer(row["far"], np.uint8)
        before = np.zeros((row["n"], reach - 1), np.uint8)
        before[np.arange(reach - 1) < far[:, None]] = np.frombuffer(row["before"], np.uint8)
        runs.append((decode(shared, row["tails"], near, span), shared.tolist()))
        ids = np.frombuffer(row["ids"], np.uint8).reshape(-1, ID_BYTES)
        rest.append((before, near.astype(np.int64), far.astype(np.int64), np.frombuffer(row["again"], np.uint8) > 0, ids, np.frombuffer(row["place"], "<i8")))
    if runs:
        run, place, prefix = (np.array(c, np.int64) for c in merge(runs))
        sizes = np.array([len(strings) for strings, _ in runs])
        order = (np.cumsum(sizes) - sizes)[run] + place
        # suffixes that share too little with both neighbours for any window have no equal
        close = prefix >= span - reach + 1
        some = np.flatnonzero(close | np.concatenate([close[1:], [False]]))
        before, near, far, again, ids, at = (np.concatenate(c)[order[some]] for c in zip(*rest))
        found = repeated_windows(prefix[some], before, near, far, span)
        found[again] = False  # those are known already
        edge = np.diff(found, prepend=False, append=False, axis=1)
        unit, place = np.nonzero(edge)
        unit, low, high = unit[::2], place[::2], place[1::2]
        names.append(ids[unit])
        starts.append(at[unit] - high + 1)
        ends.append(at[unit] - low + span)
    size = sum(map(len, starts))
    packed = np.concatenate([*names, np.zeros((0, ID_BYTES), np.uint8)])
    ids = pa.Array.from_buffers(pa.binary(ID_BYTES), size, [None, pa.py_buffer(packed.tobytes())]).cast(pa.binary())
    numbers = [pa.array(np.concatenate([*c, np.zeros(0, np.int64)]).astype(np.int64)) for c in (starts, ends)]
    return pa.Table.from_arrays([ids, *numbers], names=["id", "start", "end"])


def _bytes(text: str) -> Column:
    return F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")


def _sha(body: Column) -> Column:
    return F.coalesce(F.sha2(body, 256), F.lit(""))


def _class_id(sha: Column) -> Column:
    """An id of equal texts, the first half of their SHA-256; known not to be null, so that no join adds a filter."""
    return F.coalesce(F.unhex(F.substring(sha, 1, 2 * ID_BYTES)), F.lit(b""))


def _classes(docs: DataFrame, text: str, span: int) -> DataFrame:
    """(id, body, copies) of each distinct text of a span at least. Every step reads all three, so their exchange is made once."""
    rows = docs.select(_bytes(text).alias("body")).where(F.octet_length("body") >= span)
    return rows.groupBy(_class_id(_sha(F.col("body"))).alias("id")).agg(F.min("body").alias("body"), F.count("*").alias("copies"))


def _each(classes: DataFrame, span: int, schema: str, make: Callable[[list[bytes], list[bytes]], Iterator[pa.RecordBatch]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, PIECE):
                yield from make(part.column(0).to_pylist(), part.column(1).to_pylist())

    return classes.select("id", "body", "copies").mapInArrow(run, schema)


def spans_of(classes: DataFrame, parts: int, span: int = SPAN, crowded: int = CROWDED) -> DataFrame:
    """(id, spans): the repeated stretches of the classes that have any, unordered, possibly overlapping."""

    def counted(ids: list[bytes], bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
        for *_, key in units(bodies, span):
            value, count = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], names=["key", "n"])

    def placed(ids: list[bytes], bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
        for owner, anchor, near, far, key in units(bodies, span):
            own = pa.array(ids, pa.binary()).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([pa.array(~key.view(np.int64)), own, pa.array(_packed(anchor, near, far))], names=["key", "id", "unit"])

    counts = _each(classes, span, "key long, n long", counted).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    # the keys are turned round after counting, so that they are exchanged again and Spark can split a join on a hot one
    frequent = counts.select(F.bitwise_not("key").alias("k"), (F.col("n") > crowded).alias("crowded"))
    places = _each(classes, span, "key long, id binary, unit long", placed).join(frequent, F.col("key") == F.col("k"))
    places = places.groupBy("id").agg(F.collect_list(F.struct("unit", "crowded")).alias("units")).select(F.col("id").alias("of"), "units")
    texts = classes.join(places, F.col("id") == F.col("of")).select("id", "body", "copies", "units")
    schema = StructType.fromDDL(RUNS)
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 9]

    def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Units] = []
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            rows = list(runs_of(Units.joined(held), span, parts)) if held else []
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows[at : at + 64]), kinds)], names=schema.fieldNames())

        for batch in batches:
            for part in slices(batch, 1, PIECE):
                listed = part.column(3)
                flat = listed.flatten()
                owner = np.repeat(np.arange(len(part)), listed.value_lengths().to_numpy())
                unit, flags = flat.field("unit").to_numpy(), flat.field("crowded").to_numpy(zero_copy_only=False)
                ids = np.frombuffer(b"".join(part.column(0).to_pylist()), np.uint8).reshape(-1, ID_BYTES)
                for some in _gathered(part.column(1).to_pylist(), ids, owner, unit, flags, span):
                    if held and size + len(some.place) > RUN:
                        yield from sent()
                        held, size = [], 0
                    held.append(some)
                    size += len(some.place)
        yield from sent()

    found = texts.mapInArrow(sorted_runs, schema).groupBy("part").applyInArrow(lambda rows: _merged(rows, span), "id binary, start long, end long")
    return found.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("found")).select(F.col("id").alias("in"), "found")


def joined(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of overlapping or touching ones."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], ends[np.concatenate([new[1:], [True]])]


def cleaned_classes(docs: DataFrame, text: str = "text", span: int = SPAN, crowded: int = CROWDED, part_bytes: int = PART_BYTES) -> DataFrame:
    """(id, spans, kept) of each distinct text of a span at least: its repeated stretches in order, and the other bytes.

    A text with copies is repeated as a whole. `id` is the first half of the text's SHA-256.
    """
    total = docs.agg(F.sum(F.octet_length(_bytes(text)))).first()[0] or 0
    classes = _classes(docs, text, span)
    spans = spans_of(classes, -(-total // part_bytes) or 1, span, crowded)
    rows = classes.join(spans, F.col("id") == F.col("in"), "left").select("id", "body", "copies", "found")
    schema = StructType([StructField("id", BinaryType()), StructField("spans", SPANS), StructField("kept", BinaryType())])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, PIECE):
                spans, kept = [], []
                for body, copies, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3)):
                    if copies > 1:
                        starts, ends = [0], [len(body)]
                    elif found.is_valid:
                        starts, ends = (c.tolist() for c in joined(*(found.values.field(c).to_numpy() for c in ("start", "end"))))
                    else:
                        starts, ends = [], []
                    spans.append([{"start": s, "end": e} for s, e in zip(starts, ends)])
                    kept.append(b"".join(body[a:b] for a, b in zip([0, *ends], [*starts, len(body)])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind), pa.array(kept, pa.binary())], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def drop_repeats(df: DataFrame, text: str = "text", span: int = SPAN, crowded: int = CROWDED, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows with `n_bytes`, `spans` (array of start, end; removed stretches of the text's UTF-8 bytes) and `kept` (binary).

    A byte goes if some `span`-byte string over it also starts at another place, of this text or another. Texts shorter
    than that, empty and null ones lose nothing; a null text has no bytes. Repeated rows are copies of each other and
    lose all. What is kept may begin or end within a character. Columns of the added names are replaced.
    """
    rows = without(df, [c for c in ("n_bytes", "spans", "kept") if c != text])
    of, found, left = (fresh(c, rows) for c in ("of", "found", "left"))
    classes = cleaned_classes(df, text, span, crowded, part_bytes).toDF(of, found, left)
    return rows.join(classes, _class_id(_sha(_bytes(text))) == F.col(of), "left").select(
        *(F.col(f"`{c}`") for c in rows.columns),
        F.octet_length(_bytes(text)).cast("long").alias("n_bytes"),
        F.coalesce(found, F.array().cast(SPANS)).alias("spans"),
        F.coalesce(left, _bytes(text)).alias("kept"),
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, crowded: int = CROWDED, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: its bytes, how many are removed in how many stretches, and SHA-256 of the rest."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed")
    classes = cleaned_classes(docs, text, span, crowded, part_bytes).select(
        F.col("id").alias("of"), removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
    n_bytes = F.octet_length(_bytes(text)).cast("long").alias("n_bytes")
    rows = docs.select(F.col(f"`{key}`").alias("key"), _sha(_bytes(text)).alias("sha"), n_bytes).withColumn("id", _class_id(F.col("sha")))
    none = F.lit(0).cast("long")
    return rows.join(classes, F.col("id") == F.col("of"), "left").select(
        F.col("key").alias(key),
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
