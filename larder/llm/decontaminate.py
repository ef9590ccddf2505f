"""Benchmark decontamination: CGK random walks, bit-sampling LSH over item-sized windows, exact edit verification.

A CGK walk reads a string from left to right and at each step, by a random bit of the word it stands on, stays or goes
on. Two strings a few edits apart fall out of step at an edit and into step again, so that the words they show at most
steps agree: edit distance has become Hamming distance. A repetition has its own bits and its own sampled steps; the words at
those steps are the key. Walks start at every word of an item and of a document, so a window of an item's size has a key
for each of its places, and one key in common makes it a candidate, placed as the key stands in the item. Sampled steps
lie as far apart as the allowed edits do, as further ones would seldom agree. How many repetitions an item needs for the
target recall follows from how often edited items, at the most edits allowed, share a key in one; that is simulated.

Candidates are verified by the exact edit distance, in words, between the item and the best stretch of the window, so
nothing else is found. With `exact` keys are seeds instead, of which any allowed edits spare one, and nothing is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from larder.llm.common import fresh, slices, with_derived
from larder.sources.staging import settle

SIMILARITY = 0.8
RECALL = 0.9999
MIN_WORDS = 1
SAMPLES = 4  # of a walk
SHOWN = 3  # words that a walk reads at least
TRIALS = 96  # of a simulation, each in
TRIED = 12  # repetitions
MOST_EDITS = 12  # beyond which items only get easier to find
SEED_WORDS = 8
ITEMS_A_BLOCK = 16_384
BYTES_A_BLOCK = 16 << 20
TABLE_SIZE = 0x40000
FILTER_BITS = 20
BATCH = 2048
HITS_A_RUN = 1 << 20
SLICE_BYTES = 2 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Scripts written without spaces between words: Thai, Lao, Myanmar, Khmer and their neighbours, kana, Bopomofo, Han, Yi.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
    (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0xA4CF), (0xA980, 0xA9DF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it belongs to words (1), or is a word of its own (2), and its lower-case form."""
    chars = [chr(c) for c in range(TABLE_SIZE)]
    kind = np.fromiter((c.isalnum() for c in chars), np.uint8, TABLE_SIZE)
    for lo, hi in UNSPACED:
        kind[lo : hi + 1] *= 2
    lower = np.fromiter((ord(low) if len(low := c.lower()) == 1 else ord(c) for c in chars), np.uint32, TABLE_SIZE)
    return kind, lower


class Words(NamedTuple):
    """Words of joined texts: a hash of each in lower case, and where it stands."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words_of(text: str) -> Words:
    """Words are runs of letters and digits; everything between them, and case, is no matter.

    In scripts without spaces each letter is a word, so that a clause isn't a single one.
    """
    table, lower = _tables()
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), TABLE_SIZE - 1)
    kind = table[points]
    inside = kind > 0
    turns = np.diff(kind, prepend=0, append=0) != 0
    start = np.flatnonzero(inside & (turns[:-1] | (kind == 2)))
    end = np.flatnonzero(inside & (turns[1:] | (kind == 2))) + 1
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    powers = np.cumprod(np.full(int(size.max()), _MULTIPLIER, np.uint64))
    sums = np.add.reduceat((lower[points[inside]] + np.uint64(1)) * powers[place], first)
    return Words(_mix(sums), start, end)


class Keys(NamedTuple):
    """Keys of one kind: seeds of one number of words, or walks of one repetition."""

    width: int  # 0 for walks
    steps: tuple[int, ...]  # those sampled, of walks
    repetition: int
    allowed: np.ndarray  # a bitmap of the keys
    keys: np.ndarray  # sorted
    item: np.ndarray
    offset: np.ndarray  # where the key starts in the item


class Index(NamedTuple):
    ids: list
    words: np.ndarray  # of all items, one after the other
    first: np.ndarray
    size: np.ndarray
    edits: np.ndarray  # most edits that an item allows
    kinds: list[Keys]  # seeds by rising width, then walks
    pairs: np.ndarray  # a bitmap of hashes of (item, word)


def _chain(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return _mix(key * _MULTIPLIER + symbol)


def _slot(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _grams(words: np.ndarray, widths: list[int]) -> Iterator[np.ndarray]:
    """For each of the rising widths, a key of the run of so many words at each place that has one."""
    key, width = words, 1
    for wanted in widths:
        while width < wanted:
            key = _chain(key[: max(0, len(words) - width)], words[width:])
            width += 1
        yield key


def sampled(repetition: int, similarity: float) -> tuple[int, ...]:
    """The steps of a repetition's walk that make its key: the first, and others within twice the words between edits."""
    apart = 1 / max(1e-9, 1 - similarity) - 1 + 1e-9  # words from one edit to the next, if they lie evenly
    last = int(min(32, max(2, 2 * apart)))
    others = np.random.default_rng([repetition, last]).choice(np.arange(1, last + 1), min(SAMPLES - 1, last), replace=False)
    return 0, *sorted(others.tolist())


def walk(words: np.ndarray, repetition: int, steps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(key, last place) of the walk from each place.

    Walks off the end, and those that stay within fewer than SHOWN words and so tell little, have the place after the last.
    """
    shown = np.append(_mix(words ^ _mix(np.uint64([repetition + 1]) * _MULTIPLIER)), np.uint64(0))
    at = np.arange(len(words))
    key = shown[:-1]
    for step in range(1, steps[-1] + 1):
        on = shown[at] if step > 1 else key
        at = np.minimum(at + (on >> np.uint64(step) & np.uint64(1)).astype(np.int64), len(words))
        if step in steps:
            key = _chain(key, shown[at])
    return key, np.where(at - np.arange(len(words)) < SHOWN - 1, len(words), at)


@lru_cache(maxsize=64)
def chance(edits: int, similarity: float) -> float:
    """How often a repetition finds the smallest item that allows so many edits, with all of them made.

    Half of the trials have the edits evenly spaced from a random place on, half anywhere; words are replaced, taken out
    or put in. Words are all different, so that only words in step make a key agree.
    """
    rng = np.random.default_rng([edits, round(similarity * 1000)])
    size = -(-edits * 1000 // round((1 - similarity) * 1000))
    items = rng.integers(0, 1 << 62, (TRIALS, size)).astype(np.uint64)
    texts, owner = [], []
    for n, words in enumerate(items.tolist()):
        spread = (rng.random() + np.arange(edits)) * size / edits if n % 2 else rng.choice(size, edits, replace=False)
        places = {int(p) % size for p in spread}
        for i, w in enumerate(words):
            texts += [w] if i not in places else [] if n % 3 == 0 else [int(rng.integers(1 << 62))] + [w] * (n % 3 == 1)
        owner += [n] * (len(texts) - len(owner))
    text, whose, of = np.array(texts, np.uint64), np.array(owner), np.repeat(np.arange(TRIALS), size)
    found = 0
    for repetition in range(TRIED):
        steps = sampled(repetition, similarity)
        (a, a_last), (b, b_last) = walk(items.ravel(), repetition, steps), walk(text, repetition, steps)
        a, b = a[np.append(of, -1)[a_last] == of], b[np.append(whose, -1)[b_last] == whose]
        hit = np.flatnonzero(np.isin(b, a))
        found += len(np.unique(whose[np.append(whose, -1)[b_last] == whose][hit]))
    return found / (TRIALS * TRIED)


def repetitions(edits: int, similarity: float, recall: float) -> int:
    """Repetitions that find an item with so many edits with probability `recall`, each of them as `chance` says."""
    missed = 1 - min(chance(min(edits, MOST_EDITS), similarity), 0.999)
    return max(1, int(np.ceil(np.log(1 - recall) / np.log(missed)))) if missed < 1 else 64


def _table(key: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << FILTER_BITS, bool)
    table[_slot(key)] = True
    return table


def _seeds(words: np.ndarray, first: np.ndarray, size: np.ndarray, edits: np.ndarray, which: np.ndarray) -> Iterator[Keys]:
    """Keys that any allowed edits spare one of: the first words of each of one segment more than there are edits."""
    parts = np.minimum(edits + 1, size) * which
    item = np.repeat(np.arange(len(size)), parts)
    part = np.arange(len(item)) - np.repeat(np.cumsum(parts) - parts, parts)
    offset, end = part * size[item] // parts[item], (part + 1) * size[item] // parts[item]
    width = np.minimum(end - offset, SEED_WORDS)
    widths = np.unique(width).tolist()
    for wide, grams in zip(widths, _grams(words, widths)):
        own = np.flatnonzero(width == wide)
        key = grams[first[item[own]] + offset[own]]
        order = np.argsort(key, kind="stable")
        yield Keys(wide, (), 0, _table(key), key[order], item[own][order], offset[own][order])


def _walks(words: np.ndarray, first: np.ndarray, size: np.ndarray, needed: np.ndarray, similarity: float) -> Iterator[Keys]:
    """Keys of all walks that end within their item, in the repetitions that the item needs."""
    owner = np.append(np.repeat(np.arange(len(size)), size), -1)
    for repetition in range(int(needed.max(initial=0))):
        steps = sampled(repetition, similarity)
        key, last = walk(words, repetition, steps)
        own = np.flatnonzero((owner[last] == owner[:-1]) & (needed[owner[:-1]] > repetition))
        own = own[np.argsort(key[own], kind="stable")]
        yield Keys(0, steps, repetition, _table(key[own]), key[own], owner[own], own - first[owner[own]])


def build(
    items: list[tuple[object, str]], similarity: float = SIMILARITY, min_words: int = MIN_WORDS, recall: float = RECALL, exact: bool = False
) -> Index:
    """The index of the items; those that allow no edit have their own words as key, also without `exact`."""
    split = [(i, words_of(t or "").hashes) for i, t in items]
    split = [(i, w) for i, w in split if len(w) >= min_words]
    size = np.array([len(w) for _, w in split], np.int64)
    first = np.cumsum(size) - size
    words = np.concatenate([*(w for _, w in split), np.zeros(0, np.uint64)])
    edits = np.floor((1 - similarity) * size + 1e-9).astype(np.int64)
    needed = np.zeros(len(size), np.int64)
    if not exact:
        for k in np.unique(edits[edits > 0]).tolist():
            needed[edits == k] = repetitions(k, similarity, recall)
    kinds = [*_seeds(words, first, size, edits, needed == 0), *_walks(words, first, size, needed, similarity)]
    owner = np.repeat(np.arange(len(split)), size).astype(np.uint64)
    pairs = np.zeros(1 << FILTER_BITS, bool)
    pairs[_slot(_chain(owner, words))] = True
    return Index([i for i, _ in split], words, first, size, edits, kinds, pairs)


def _keys_of(index: Index, words: np.ndarray) -> Iterator[tuple[Keys, np.ndarray, np.ndarray]]:
    """For each kind, the key at each place that has one, and the last place that it reads."""
    seeds = [kind for kind in index.kinds if kind.width]
    for kind, key in zip(seeds, _grams(words, [s.width for s in seeds])):
        yield kind, key, np.arange(len(key)) + kind.width - 1
    for kind in index.kinds[len(seeds) :]:
        yield kind, *walk(words, kind.repetition, kind.steps)


def _candidates(index: Index, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, item, place of its first word in `words`) of windows that hold a key; about HITS_A_RUN at a time.

    A place may lie outside the document, where the item's part before the key was cut.
    """
    starts, groups, lows, counts = [], [], [], []
    ended = np.append(doc, -1)
    for g, (kind, key, last) in enumerate(_keys_of(index, words)):
        start = np.flatnonzero(kind.allowed[_slot(key)])
        start = start[doc[start] == ended[last[start]]]
        lo, hi = np.searchsorted(kind.keys, key[start], "left"), np.searchsorted(kind.keys, key[start], "right")
        hit = np.flatnonzero(hi > lo)
        starts.append(start[hit])
        groups.append(np.full(len(hit), g))
        lows.append(lo[hit])
        counts.append((hi - lo)[hit])
    if not sum(map(len, starts)):
        return
    start, group, low, count = map(np.concatenate, (starts, groups, lows, counts))
    order = np.argsort(start, kind="stable")
    start, group, low, count = start[order], group[order], low[order], count[order]
    sizes = [len(s.keys) for s in index.kinds]
    low = low + (np.cumsum(sizes) - sizes)[group]
    key_item = np.concatenate([s.item for s in index.kinds])
    key_offset = np.concatenate([s.offset for s in index.kinds])
    run = np.cumsum(count) // HITS_A_RUN
    for part in np.split(np.arange(len(start)), np.flatnonzero(np.diff(run)) + 1):
        hits = np.repeat(part, count[part])
        before = np.cumsum(count[part]) - count[part]
        entry = np.arange(len(hits)) - np.repeat(before, count[part]) + low[hits]
        found = np.stack([doc[start[hits]], key_item[entry], start[hits] - key_offset[entry]])
        found = found[:, np.lexsort(found[::-1])]
        fresh = np.ones(found.shape[1], bool)
        fresh[1:] = (found[:, 1:] != found[:, :-1]).any(axis=0)
        yield tuple(found[:, fresh])


def best_edits(patterns: np.ndarray, sizes: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edit distance between each pattern's first `size` words and any stretch of its window; (edits, start, end).

    One row of the distance table at a time, for all patterns at once; the cost of skipped window words runs along the
    row as a running minimum. The start of the best stretch travels with the distances.
    """
    count, width = windows.shape
    columns = np.arange(width + 1, dtype=np.int64)
    # distance and start in one number: less distance first, then a later start
    scale = np.int64(1 << 32)
    row = np.broadcast_to(-columns, (count, width + 1)).copy()
    result = np.zeros(count, np.int64)
    ends = np.zeros(count, np.int64)
    for i in range(int(sizes.max(initial=0))):
        new = np.empty_like(row)
        new[:, 0] = row[:, 0] + scale
        np.minimum(row[:, :-1] + scale * (windows != patterns[:, i, None]), row[:, 1:] + scale, out=new[:, 1:])
        row = np.minimum.accumulate(new - columns * scale, axis=1) + columns * scale
        done = np.flatnonzero(sizes == i + 1)
        if len(done):
            end = row[done].argmin(axis=1)
            result[done], ends[done] = row[done, end], end
    edits = -((-result) // scale)
    return edits, edits * scale - result, ends


def search(index: Index, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, end) of every item found in each text, at its best place, in code points."""
    if not index.ids:
        return []
    known = [t or "" for t in texts]
    words = words_of("\n".join(known))
    begins = np.cumsum([0] + [len(t) + 1 for t in known])[:-1]
    doc = np.searchsorted(begins, words.start, side="right") - 1
    first = np.searchsorted(doc, np.arange(len(known)))
    last = np.searchsorted(doc, np.arange(len(known)), side="right")
    hashes = np.concatenate([words.hashes, np.zeros(1, np.uint64)])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for own, item, place in _candidates(index, words.hashes, doc):
        size, allowed = index.size[item], index.edits[item]
        lo = np.maximum(place - allowed, first[own])
        hi = np.minimum(place + size + allowed, last[own])
        order = np.argsort(size, kind="stable")
        for batch in _batches(order, size):
            width = int((hi[batch] - lo[batch]).max(initial=0))
            if width < 1:
                continue
            at = lo[batch, None] + np.arange(width)
            inside = at < hi[batch, None]
            window = np.where(inside, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
            pair = _chain(np.broadcast_to(item[batch, None].astype(np.uint64), window.shape), window)
            shared = (inside & index.pairs[_slot(pair)]).sum(axis=1)
            ok = shared >= size[batch] - allowed[batch]  # every kept word of the item is in the window
            batch, window = batch[ok], window[ok]
            if not len(batch):
                continue
            sizes = size[batch]
            cells = index.first[item[batch], None] + np.arange(int(sizes.max()))
            patterns = np.where(np.arange(int(sizes.max())) < sizes[:, None], index.words[np.minimum(cells, len(index.words) - 1)], np.uint64(1))
            edits, start, end = best_edits(patterns, sizes, window)
            for b, e, s, t in zip(batch.tolist(), edits.tolist(), start.tolist(), end.tolist()):
                if e <= allowed[b] and t > s:
                    found = (e, int(words.start[lo[b] + s]), int(words.end[min(lo[b] + t, hi[b]) - 1]))
                    name = (int(own[b]), int(item[b]))
                    if name not in best or found < best[name]:
                        best[name] = found
    return [(d, i, e, s - int(begins[d]), t - int(begins[d])) for (d, i), (e, s, t) in sorted(best.items())]


def _batches(order: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of candidates of similar item size, smaller for long items, so that their tables stay small."""
    at = 0
    while at < len(order):
        take = max(1, min(BATCH, (1 << 20) // max(1, int(size[order[min(at + BATCH, len(order)) - 1]]) * 2)))
        yield order[at : at + take]
        at += take


def _blocks(benchmark: DataFrame, item: str, text: str, block: int) -> Iterator[list[tuple[object, str]]]:
    """The benchmark in lists of about `block` items and BYTES_A_BLOCK bytes."""
    items = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block), -(-size // BYTES_A_BLOCK))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        yield sorted(((r.item, r.text) for r in rows), key=repr)


def _in_turn(blocks: Iterator[list[tuple[object, str]]], search_block: Callable[[list[tuple[object, str]]], DataFrame]) -> Iterator[DataFrame]:
    """The result of each block; all but the last are written first, so that one block is held at a time."""
    last = search_block(next(blocks))
    for items in blocks:
        yield settle(last, "decontamination")
        last = search_block(items)
    yield last


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
    block: int = ITEMS_A_BLOCK,
    recall: float = RECALL,
    exact: bool = False,
) -> DataFrame:
    """(key, item, edits, start, end): each item found in each document, its edits in words, its place in code points.

    An item of n words is found where some stretch of a whole text is within (1 - similarity) * n word edits of it, with
    probability `recall` at the most edits and more surely at fewer; a verbatim one always is, and with `exact` any is. Items of fewer than five words allow no edit at the default and are found where they stand word for word. Items
    without any letter or digit, and null ones, are never found; null and empty texts hold none. Repeated documents and
    repeated items are reported each. The benchmark is searched in blocks of about `block` items and
    BYTES_A_BLOCK bytes; only a block's text travels to the tasks. Documents aren't shuffled; other columns aren't read.
    Of the columns after the key, one of the key's name gets an underscore.
    """
    own = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"))
    names = [key]
    for name in (item, "edits", "start", "end"):
        while name.lower() in [n.lower() for n in names]:
            name += "_"
        names.append(name)
    kinds = [docs.schema[key].dataType, benchmark.schema[item].dataType, IntegerType(), LongType(), LongType()]
    schema = StructType([StructField(n, k) for n, k in zip(names, kinds)])
    kind = to_arrow_type(schema.fields[1].dataType)

    def finder(items: list[tuple[object, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = build(items, similarity, recall=recall, exact=exact)
            for batch in batches:
                for part in slices(batch, 1, SLICE_BYTES):
                    if found := search(index, part.column(1).to_pylist()):
                        row, which, edits, start, end = zip(*found)
                        arrays = [
                            part.column(0).take(pa.array(row, pa.int64())),
                            pa.array([index.ids[i] for i in which], kind),
                            pa.array(edits, pa.int32()),
                            pa.array(start, pa.int64()),
                            pa.array(end, pa.int64()),
                        ]
                        yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

        return run

    return reduce(DataFrame.union, _in_turn(_blocks(benchmark, item, item_text, block), lambda items: own.mapInArrow(finder(items), schema)))


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
    block: int = ITEMS_A_BLOCK,
    recall: float = RECALL,
    exact: bool = False,
) -> DataFrame:
    """The rows whose text holds no item, as `find` finds them; columns are as they were."""
    kept = fresh("clean", docs)

    def maker(items: list[tuple[object, str]]):
        def make():
            index = build(items, similarity, recall=recall, exact=exact)

            def derive(texts: list) -> tuple[list]:
                held = {found[0] for found in search(index, texts)}
                return ([i not in held for i in range(len(texts))],)

            return derive

        return make

    for n, items in enumerate(_blocks(benchmark, item, item_text, block)):
        docs = settle(docs, "decontamination") if n else docs
        docs = with_derived(docs, text, [StructField(kept, BooleanType())], maker(items), SLICE_BYTES).where(F.col(kept)).drop(kept)
    return docs
