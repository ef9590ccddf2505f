"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Equal vectors are one class, so copies cost nothing. Classes that share a table's key meet in a bucket, where one matrix
product gives all cosines. A pair counts in the first table that holds it together. A bucket hands on a link count per
class and a spanning star per group it finds, never its pairs. Buckets too large for a task are cut into blocks, and
each pair of blocks is a group of its own, so no link is lost to a bound.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from larder.llm.common import with_derived
from larder.llm.components import components
from larder.sources.staging import settle

THRESHOLD = 0.95
RECALL = 0.999
BLOCK = 1024
GROUP = 4096
MEAN_BUCKET = 64
SEED = 7

BLOCK_SCHEMA = "uid long, root long, n long"


def tables_for(rows: int, threshold: float = THRESHOLD, recall: float = RECALL, mean_bucket: int = MEAN_BUCKET) -> tuple[int, int]:
    """(bits, tables): as many bits as leave `mean_bucket` random vectors in a bucket, and tables for the recall.

    Recall is that of a pair right at the threshold; closer pairs are found more surely. It is the same at every size.
    """
    bits = min(60, max(8, math.ceil(math.log2(max(rows, 1) / mean_bucket))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def sign_keys(vectors: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Row x table: the signs of `bits` random projections, packed. The planes depend on seed and dimension alone."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _with_keys(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    def make():
        def derive(vectors: list) -> tuple[list]:
            keys: list = [None] * len(vectors)
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(i)
            for rows in by_size.values():
                found = sign_keys(np.array([vectors[i] for i in rows], np.float64), bits, tables)
                for i, k in zip(rows, found.tolist()):
                    keys[i] = k
            return (keys,)

        return derive

    return with_derived(classes, "vec", [StructField("keys", ArrayType(LongType()))], make)


def linked(unit: np.ndarray, threshold: float, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j with cosine at or above the threshold; with `side`, only those of different sides."""
    close = np.triu(unit @ unit.T >= threshold, 1)
    if side is not None:
        close &= side[:, None] != side[None, :]
    return np.nonzero(close)


def roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index of each index's component."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(rows: pa.Table, threshold: float) -> pa.Table:
    """Links within each bucket, or pair of blocks of one, among the rows of a group."""
    get = {c: rows.column(c).to_numpy() for c in ("uid", "copies", "t", "k", "ci", "cj", "c", "dim")}
    vectors, keys = rows.column("vec").combine_chunks(), rows.column("keys").combine_chunks()
    vectors = vectors.flatten().to_numpy().astype(np.float64)
    at = np.concatenate([[0], np.cumsum(get["dim"])])
    keys = keys.flatten().to_numpy().reshape(len(rows), -1)
    order = np.lexsort((get["uid"], get["cj"], get["ci"], get["dim"], get["k"], get["t"]))
    ids = np.stack([get[c][order] for c in ("t", "k", "dim", "ci", "cj")])
    cuts = np.flatnonzero(np.r_[True, (ids[:, 1:] != ids[:, :-1]).any(axis=0), True])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo, hi in zip(cuts, cuts[1:]):
        if hi - lo < 2:
            continue
        own = order[lo:hi]
        x = np.stack([vectors[at[r] : at[r + 1]] for r in own])
        x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        across = get["ci"][own[0]] != get["cj"][own[0]]
        i, j = linked(x, threshold, get["c"][own] if across else None)
        if not len(i):
            continue
        root = roots_of(len(own), i, j)
        k = keys[own][:, : get["t"][own[0]]]
        fresh = ~(k[i] == k[j]).any(axis=1)  # not met in an earlier table
        copies = get["copies"][own]
        n = np.bincount(i[fresh], copies[j[fresh]], len(own)) + np.bincount(j[fresh], copies[i[fresh]], len(own))
        some = np.unique(np.concatenate([i, j]))
        uid = get["uid"][own]
        out.append((uid[some], uid[root[some]], n[some].astype(np.int64)))
    columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else ((), (), ()))]
    return pa.table(dict(zip(("uid", "root", "n"), columns)))


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK, group: int = GROUP
) -> DataFrame:
    """(key, n_links, component_id, kept) per row; `component_id` is the smallest key reachable by links.

    A vector that is null, empty, zero or holds null or non-finite components links with nothing and is its own
    component, as are vectors of different length to each other. Rows with equal vectors link, whatever their keys.
    A null key stays null. Other columns are not read.
    """
    rows = df.select(key, F.col(vector).alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    usable = F.coalesce((F.size("vec") > 0) & ~bad & F.exists("vec", lambda x: x != 0), F.lit(False))
    good = rows.where(usable)
    classes = good.groupBy("vec").agg(F.min(key).alias("least"), F.count("*").alias("copies"))
    classes = settle(classes.withColumn("uid", F.monotonically_increasing_id()), "vector_classes")
    bits, tables = tables_for(classes.count(), threshold, recall)
    keyed = settle(_with_keys(classes.select("uid", "copies", "vec"), bits, tables), "vector_keys")
    size = keyed.count()
    hot = keyed.select(F.posexplode("keys").alias("t", "k")).groupBy("t", "k").count().where(F.col("count") > block)
    hot = hot.select(F.col("t").alias("ht"), F.col("k").alias("hk"), F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    placed = keyed.select("uid", "copies", "vec", "keys", F.posexplode("keys").alias("t", "k"))
    placed = placed.join(hot, (F.col("t") == F.col("ht")) & (F.col("k") == F.col("hk")), "left")
    own = F.pmod(F.xxhash64("uid"), F.coalesce("blocks", F.lit(1))).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda b: F.struct(F.least("c", b).alias("ci"), F.greatest("c", b).alias("cj")))
    blocks = placed.withColumn("c", own).withColumn("p", F.explode(pairs)).withColumn("ci", F.col("p.ci")).withColumn("cj", F.col("p.cj"))
    shared = F.pmod(F.xxhash64("k"), F.lit(max(1, size // group)))  # small buckets share a group
    gid = F.when(F.col("blocks").isNull(), F.xxhash64("t", shared)).otherwise(F.xxhash64("t", "k", "ci", "cj"))
    sent = blocks.select("uid", "copies", "vec", "keys", "t", "k", "c", "ci", "cj", F.size("vec").alias("dim"), gid.alias("gid"))
    found = settle(sent.groupBy("gid").applyInArrow(lambda t: _verify(t, threshold), BLOCK_SCHEMA), "vector_links")
    counts = found.groupBy("uid").agg(F.sum("n").alias("n"))
    groups = components(found.select("uid", "root"))
    labelled = classes.join(groups, F.col("uid") == F.col("node"), "left").select("uid", "vec", "least", "copies", F.coalesce("component", "uid").alias("component"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = labelled.join(counts, "uid", "left").join(smallest, "component")
    of_class = labelled.select(
        F.col("vec").alias("class"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id"
    )
    linked_rows = good.join(of_class, F.col("vec") == F.col("class")).select(key, "n_links", "component_id")
    single = rows.where(~usable).select(key, F.lit(0).cast("long"), F.col(key))
    kept = F.col(key).eqNullSafe(F.col("component_id")).alias("kept")
    return linked_rows.union(single).select(key, "n_links", "component_id", kept)
