"""Language identification of mixed texts: script ranges narrow the candidates, Viterbi labels spans of words.

A word is a run of letters of one script. Its score per language is the sum of the log probabilities of its character
trigrams. A language is a candidate for a word only where its training texts use the word's script. The best label
sequence pays a penalty for each change of language; equal neighbours form a span.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from larder.llm.common import fresh, slices, with_derived

UNKNOWN = "und"
BUCKETS = 1 << 15
SWITCH_PENALTY = 25.0
SCRIPT_SHARE = 0.001
SAMPLE_PER_LANGUAGE = 2000
MAX_LANGUAGES = 256
LETTERS_A_PIECE = 1 << 20
SLICE_BYTES = 6 << 20
TABLE_SIZE = 0x40000

# fixed values: first and last code point of the scripts' blocks
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F))),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
)
OTHER = len(SCRIPTS) + 1

SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("lang", StringType())]))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the script of letters (0 for others), and the lower-case form."""
    chars = [chr(c) for c in range(TABLE_SIZE)]
    letter = np.fromiter((c.isalpha() for c in chars), bool, TABLE_SIZE)
    lower = np.fromiter((ord(low) if len(low := c.lower()) == 1 else ord(c) for c in chars), np.uint32, TABLE_SIZE)
    script = np.full(TABLE_SIZE, OTHER, np.uint8)
    for n, (_, ranges) in enumerate(SCRIPTS, 1):
        for first, last in ranges:
            script[first : last + 1] = n
    return np.where(letter, script, 0).astype(np.uint8), lower


class Words(NamedTuple):
    start: np.ndarray  # of each word in the joined text
    end: np.ndarray
    script: np.ndarray
    buckets: np.ndarray  # of each letter's trigram, words in order
    first: np.ndarray  # a word's first letter among the letters


def words_of(text: str) -> Words:
    """Words and trigram buckets; a newline or any other non-letter parts words."""
    scripts, lower = _tables()
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), TABLE_SIZE - 1)
    script = scripts[points]
    edge = np.flatnonzero(np.diff(script, prepend=np.uint8(0), append=np.uint8(0)))
    if not len(edge):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none)
    own = script[np.minimum(edge[:-1], len(script) - 1)] > 0
    start, end = edge[:-1][own], edge[1:][own]
    at = np.flatnonzero(script)
    low = lower[points[at]].astype(np.uint32)
    size = end - start
    first = np.cumsum(size) - size
    before, after = np.empty_like(low), np.empty_like(low)
    before[1:], after[:-1] = low[:-1], low[1:]
    before[first], after[first + size - 1] = 0, 0
    key = (before * np.uint32(0x9E3779B1) + low) * np.uint32(0x85EBCA6B) + after
    key = (key ^ (key >> np.uint32(15))) * np.uint32(0xC2B2AE35)
    return Words(start, end, script[start], key >> np.uint32(32 - BUCKETS.bit_length() + 1), first)


class Model(NamedTuple):
    languages: tuple[str, ...]
    logs: np.ndarray  # bucket x language
    allowed: np.ndarray  # script x language


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts with about LETTERS_A_PIECE characters."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > LETTERS_A_PIECE:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def _scores(model: Model, words: Words) -> np.ndarray:
    """Word x language: log probabilities, far below the others for a language that isn't a candidate."""
    sums = np.add.reduceat(model.logs[words.buckets], words.first, axis=0) if len(words.first) else np.zeros((0, len(model.languages)), np.float32)
    allowed = model.allowed[words.script]
    sums[~allowed] = -1e6
    sums[~allowed.any(axis=1)] = 0  # a script of no language says nothing
    return sums


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of each word; `sizes` are the documents' word counts, in the order of the rows of `scores`.

    All documents advance together, a word a step, the longest first, so that a step works on a prefix of them.
    """
    labels = np.zeros(len(scores), np.int16)
    order = np.argsort(-sizes, kind="stable")
    begin = (np.cumsum(sizes) - sizes)[order]
    size = sizes[order]
    active = int((size > 0).sum())
    if not active:
        return labels
    left = np.zeros(scores.shape, bool)  # the best way into this label was a change
    origin = np.zeros(len(scores), np.int16)  # the label it came from
    state = scores[begin[:active]].astype(np.float64)
    final = np.zeros(active, np.int16)
    steps = int(size[0])
    alive = np.searchsorted(-size, -np.arange(steps + 1), side="left")  # documents with more than t words
    for t in range(1, steps + 1):
        n = int(alive[t])
        if n < len(state):
            final[n : len(state)] = state[n:].argmax(axis=1)
            state = state[:n]
        if not n:
            break
        row = begin[:n] + t
        best = state.max(axis=1)
        origin[row] = state.argmax(axis=1)
        floor = (best - penalty)[:, None]
        left[row] = state < floor
        state = np.maximum(state, floor) - best[:, None] + scores[row]
    for t in range(steps - 1, -1, -1):
        n = int(alive[t])
        row = begin[:n] + t
        labels[row] = final[:n]
        if t:
            final[:n] = np.where(left[row, final[:n]], origin[row], final[:n])
    return labels


def label(model: Model, texts: list[str | None], penalty: float = SWITCH_PENALTY) -> tuple[list, list, list]:
    """Language, score and spans of each text. The score is the share of letters under the language's label."""
    return _labelled(model, texts, penalty)[:3]


def _labelled(model: Model, texts: list[str | None], penalty: float) -> tuple[list, list, list, list]:
    """As `label`, and the share of letters under any learned language."""
    known = [t or "" for t in texts]
    languages = model.languages
    n, k = len(known), len(languages)
    empty: tuple[list, list, list, list] = ([UNKNOWN] * n, [0.0] * n, [[] for _ in known], [0.0] * n)
    if not k or not n:
        return empty
    scores, sizes, starts, ends, usable = [], [], [], [], []
    for lo, hi in _pieces(known):
        part = known[lo:hi]
        words = words_of("\n".join(part))
        begins = np.cumsum([0] + [len(t) + 1 for t in part])[:-1]
        doc = np.searchsorted(begins, words.start, side="right") - 1
        scores.append(_scores(model, words))
        sizes.append(np.bincount(doc, minlength=hi - lo))
        starts.append(words.start - begins[doc])
        ends.append(words.end - begins[doc])
        usable.append(model.allowed[words.script].any(axis=1))
    score, size = np.concatenate(scores), np.concatenate(sizes)
    start, end = np.concatenate(starts), np.concatenate(ends)
    if not len(score):
        return empty
    labels = viterbi(score, size, penalty)
    doc = np.repeat(np.arange(n), size)
    letters = (end - start).astype(np.float64)
    share = np.bincount(doc * k + labels, weights=letters * np.concatenate(usable), minlength=n * k).reshape(n, k)
    total = np.bincount(doc, weights=letters, minlength=n)
    top = share.argmax(axis=1)
    value = share[np.arange(n), top] / np.maximum(total, 1)
    covered = share.sum(axis=1) / np.maximum(total, 1)
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (labels[1:] != labels[:-1])])
    last = np.r_[new[1:], len(doc)] - 1
    spans: list[list] = [[] for _ in known]
    for d, s, e, x in zip(doc[new].tolist(), start[new].tolist(), end[last].tolist(), labels[new].tolist()):
        spans[d].append({"start": s, "end": e, "lang": languages[x]})
    found = (total > 0).tolist()
    return [languages[x] if f else UNKNOWN for x, f in zip(top.tolist(), found)], value.tolist(), spans, covered.tolist()


def train(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
    max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Trigram counts of about `per_language` texts of each language, chosen by the key's hash.

    Rows with a null text, language or key are not used; whole texts are. The model has one column per language and a
    fixed number of buckets. More than `max_languages` languages are an error, since none is left out.
    """
    usable = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    sizes = {r[0]: r[1] for r in usable.groupBy(lang).count().limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"column {lang!r} holds more than {max_languages} languages; a larger max_languages needs more memory")
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((OTHER + 1, 0), bool))
    chosen = F.lit(False)
    point = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30))
    for name in languages:
        chosen = F.when(F.col(lang) == name, point < int((1 << 30) * min(1.0, per_language / sizes[name]))).otherwise(chosen)
    rows = usable.where(chosen).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for part in slices(batch, 1):
                for name, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = words_of(t)
                    grams, scripts = sums.setdefault(name, (np.zeros(BUCKETS, np.int64), np.zeros(OTHER + 1, np.int64)))
                    grams += np.bincount(words.buckets, minlength=BUCKETS)
                    scripts += np.bincount(words.script, weights=words.end - words.start, minlength=OTHER + 1).astype(np.int64)
        for name, (grams, scripts) in sums.items():
            both = np.concatenate([grams, scripts])
            at = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(both[at], pa.int64())], names=["lang", "cell", "n"])

    counted = rows.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    grams = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((OTHER + 1, len(languages)))
    for name, cell, n in counted.collect():  # at most languages x buckets
        column = languages.index(name)
        (grams if cell < BUCKETS else scripts)[cell % BUCKETS, column] = n
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32)
    return Model(languages, logs, scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1))


def predict(df: DataFrame, model: Model, text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Add `lang_pred`, `score` and `spans` (code points, end exclusive) of each whole text.

    A null text, or one without a letter, is `und` with score 0 and no spans; so is every text if no language was
    learned. Letters of scripts that no language uses lower the score. Columns with these names are replaced.
    """
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("spans", SPANS)]
    return with_derived(df, text, fields, lambda: lambda texts: label(model, texts, penalty), SLICE_BYTES)


def keep_identified(df: DataFrame, model: Model, min_score: float, text: str = "text") -> DataFrame:
    """The rows whose texts have at least `min_score` of their letters under learned languages; columns are as they were.

    The languages count together, so a text of several is as good as one of a single language.
    """
    kept = fresh("identified", df)

    def make():
        def derive(texts: list) -> tuple[list]:
            languages, _, _, covered = _labelled(model, texts, SWITCH_PENALTY)
            return ([x != UNKNOWN and v >= min_score for x, v in zip(languages, covered)],)

        return derive

    return with_derived(df, text, [StructField(kept, BooleanType())], make, SLICE_BYTES).where(F.col(kept)).drop(kept)


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % parts


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Predictions for all documents by a model of those whose crc32 remainder modulo 4 is not 2; the others are held out.

    A null key is never trained on and not held out.
    """
    own = docs.select(key, text, lang)
    model = train(own.where(remainder(key, 4) != 2), text, lang, key)
    held = F.coalesce(remainder(key, 4) == 2, F.lit(False)).alias("held_out")
    return predict(own.drop(lang), model, text).select(key, held, "lang_pred", "score", "spans")
