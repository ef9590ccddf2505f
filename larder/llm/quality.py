"""Quality scores by a byte-level convolutional network in numpy.

A document's bytes are covered by chunks of two segments each, so neighbouring chunks share a segment. Every filter
slides over all bytes; its greatest response in a chunk, plus a bias and cut at zero, is the chunk's feature. The means
of the features over all chunks go through one linear layer and a sigmoid. A filter over one-hot bytes is a table of
256 weights per offset, so a convolution is a sum of table look-ups.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from larder.llm.common import with_derived
from larder.sources.staging import settle

SEGMENT = 128
WIDTH = 5
FILTERS = 16
SAMPLE = 3000
SAMPLE_BYTES = 48 << 20
EPOCHS = 12
BATCH = 48
RATE = 0.015
SEED = 11
THRESHOLD = 0.3
SLICE_BYTES = 1 << 20


class Model(NamedTuple):
    tables: np.ndarray  # offset x byte x filter
    bias: np.ndarray  # of the filters
    weights: np.ndarray
    intercept: float


class Laid(NamedTuple):
    """Documents as bytes in whole segments; zeros before each, so that no window holds bytes of two."""

    flat: np.ndarray
    first: np.ndarray  # each document's first segment
    segments: np.ndarray  # and how many it has


def lay_out(raw: list[bytes]) -> Laid:
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    segments = -(-(sizes + WIDTH - 1) // SEGMENT)
    first = np.cumsum(segments) - segments
    flat = np.zeros(int(segments.sum()) * SEGMENT + WIDTH - 1, np.uint8)
    for at, text in zip((first * SEGMENT + WIDTH - 1).tolist(), raw):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
    return Laid(flat, first, segments)


def _responses(model: Model, flat: np.ndarray) -> np.ndarray:
    """Segment x position x filter."""
    n = len(flat) - WIDTH + 1
    out = model.tables[0].take(flat[:n], axis=0)
    one = np.empty_like(out)
    for offset in range(1, WIDTH):
        np.take(model.tables[offset], flat[offset : offset + n], axis=0, out=one)
        out += one
    return out.reshape(-1, SEGMENT, out.shape[1])


def _chunks(laid: Laid) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each chunk its two segments (the same one twice in a document of one); each document's first chunk."""
    n = np.maximum(laid.segments - 1, 1)
    begin = np.cumsum(n) - n
    left = np.arange(int(n.sum())) - np.repeat(begin, n) + np.repeat(laid.first, n)
    return left, left + np.repeat(laid.segments > 1, n), begin


def scores(model: Model, raw: list[bytes]) -> np.ndarray:
    if not raw:
        return np.zeros(0)
    laid = lay_out(raw)
    most = _responses(model, laid.flat).max(axis=1)
    left, right, begin = _chunks(laid)
    features = np.maximum(np.maximum(most[left], most[right]) + model.bias, 0).astype(np.float64)
    n = np.diff(np.append(begin, len(left)))
    means = np.add.reduceat(features, begin, axis=0) / n[:, None]
    return 1 / (1 + np.exp(-np.clip(means @ model.weights + model.intercept, -30, 30)))


def _gradients(model: Model, raw: list[bytes], label: np.ndarray) -> list[np.ndarray]:
    laid = lay_out(raw)
    responses = _responses(model, laid.flat)
    where = responses.argmax(axis=1)
    most = np.take_along_axis(responses, where[:, None, :], axis=1)[:, 0]
    left, right, begin = _chunks(laid)
    source = np.where(most[left] >= most[right], left[:, None], right[:, None])
    pooled = np.maximum(most[left], most[right]) + model.bias
    n = np.diff(np.append(begin, len(left)))
    means = np.add.reduceat(np.maximum(pooled, 0), begin, axis=0) / n[:, None]
    wrong = (1 / (1 + np.exp(-np.clip(means @ model.weights + model.intercept, -30, 30))) - label) / len(raw)
    back = np.repeat(wrong / n, n)[:, None] * model.weights * (pooled > 0)
    chunk, filt = np.nonzero(back)
    seg = source[chunk, filt]
    at = seg * SEGMENT + where[seg, filt]
    tables = np.zeros_like(model.tables)
    for offset in range(WIDTH):
        np.add.at(tables[offset], (laid.flat[at + offset], filt), back[chunk, filt])
    return [tables, back.sum(axis=0), means.T @ wrong, wrong.sum()]


def fit(raw: list[bytes], label: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Log loss, Adam, a fixed seed. With labels of one kind, or none, the score is their smoothed share."""
    rng = np.random.default_rng(SEED)
    share = (label.sum() + 1) / (len(label) + 2)
    if len(set(label.tolist())) < 2:
        return Model(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(FILTERS), float(np.log(share / (1 - share))))
    tables = (rng.standard_normal((WIDTH, 256, FILTERS)) * 0.1).astype(np.float32)
    weights = np.where(np.arange(FILTERS) % 2, 0.5, -0.5)
    values = [tables, np.zeros(FILTERS, np.float32), weights, np.float64(np.log(share / (1 - share)))]
    mean, square = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(raw))
        for lo in range(0, len(order), BATCH):
            some = order[lo : lo + BATCH]
            step += 1
            for i, g in enumerate(_gradients(Model(*values), [raw[k] for k in some], label[some])):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.99 * square[i] + 0.01 * g * g
                move = RATE * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-6)
                values[i] = (values[i] - move).astype(values[i].dtype)
    return Model(values[0], values[1], values[2], float(values[3]))


def _last_point(sizes: list[tuple[int, int]], most: int) -> int:
    """The last hash at which fewer than `most` bytes have gone before."""
    last, before = -1, 0
    for point, size in sizes:
        if before >= most:
            break
        last, before = point, before + size
    return last


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on about `sample` labelled documents, whole texts of any length, chosen by the key's hash.

    They are taken in the order of the hash until `sample_bytes` are reached, so that the length of a text doesn't decide
    whether it is drawn; that many bytes and one text more reach the driver at most. Rows with a null key, label or text
    are not used; a document labelled twice counts twice.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("label"))
    total = known.count()
    if not total:
        return fit([], np.zeros(0))
    point = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30))
    chosen = known.withColumn("point", point).where(F.col("point") < int((1 << 30) * min(1.0, sample / total)))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.encode(text, "UTF-8").alias("raw"))
    drawn = settle(texts.join(chosen, F.col("id") == F.col(key)).select("id", "label", "point", "raw"), "labelled_sample")
    last = _last_point(sorted((r.point, r.n) for r in drawn.select("point", F.octet_length("raw").alias("n")).collect()), sample_bytes)
    rows = drawn.where(F.col("point") <= last).collect()
    rows.sort(key=lambda r: (str(r.id), bytes(r.raw), r.label))
    return fit([bytes(r.raw) for r in rows], np.array([float(r.label > 0) for r in rows]))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `score`, the probability of label 1 of each whole text; a null text scores as an empty one.

    A column of that name is replaced. Repeated rows stay.
    """

    def make():
        return lambda texts: (scores(model, [(t or "").encode() for t in texts]).tolist(),)

    return with_derived(df, text, [StructField("score", DoubleType())], make, SLICE_BYTES)


def remainder(key: str) -> Column:
    return F.crc32(F.col(key).cast("string")) % 5


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Scores of all documents by a model of labels whose crc32 remainder modulo 5 is not 0; the others are held out.

    A null key is never trained on and not held out.
    """
    own = docs.select(key, text)
    model = train(own, labels.where(remainder(key) != 0), key, text)
    held = F.coalesce(remainder(key) == 0, F.lit(False)).alias("held_out")
    return score(own, model, text).select(key, held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
