"""SimHash near-duplicates, found by deletion-variant signatures.

A fingerprint is cut into so few segments that two fingerprints within the bit distance have a segment that differs in
at most one bit. Each segment is indexed once per bit with that bit blanked out, so such segments meet in an equality
join, and the pair is verified on the whole fingerprints. Only distinct fingerprints are joined, so copies cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from larder.llm.common import fresh, with_derived
from larder.llm.components import components
from larder.sources.staging import settle

BITS = 64
SEED = 42


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """64 bits, unsigned: those set in more than half the shingle hashes, repeats included."""
    import numpy as np
    from xxhash import xxh64_intdigest

    tokens = (text or "").encode().lower().split()  # both work on ASCII only, as asked
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[i:] for i in range(words)))))
    hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))
    if hashes.dtype.byteorder == ">":
        hashes = hashes.byteswap()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(df: DataFrame, text: str = "text", words: int = 3, out: str = "fp") -> DataFrame:
    """Add `out`, the fingerprint of each whole text as a signed long; without words, or null, it is zero."""

    def make():
        def derive(texts: list) -> tuple[list]:
            values = (fingerprint_of(t, words) for t in texts)
            return ([v - (1 << BITS) if v >> (BITS - 1) else v for v in values],)

        return derive

    return with_derived(df, text, [StructField(out, LongType())], make)


def _distance(a: Column, b: Column, mask: int | None = None) -> Column:
    differing = a.bitwiseXOR(b)
    return F.bit_count(differing if mask is None else differing.bitwiseAND(F.lit(_signed(mask))))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints `fp` that differ in at most `max_distance` bits, each once."""
    segments = max_distance // 2 + 1
    cuts = [BITS * i // segments for i in range(segments + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    variants = []
    for s, mask in enumerate(masks):
        # earlier segments differ by 2 bits or more, so with nothing left this one is equal and one variant will do
        bits = range(cuts[s], cuts[s + 1] if max_distance > 2 * s else cuts[s] + 1)
        variants += [(s * BITS + bit, mask & ~(1 << bit)) for bit in bits]
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("variant"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("rest")) for n, m in variants)))
    index = prints.select("fp", rows.alias("i")).select("fp", "i.variant", "i.rest")
    a, b = index.select(F.col("fp").alias("a"), "variant", "rest"), index.select(F.col("fp").alias("b"), "variant", "rest")
    # a pair counts in its first segment that differs by at most one bit, there under the differing bit or else the first
    first = F.lit(False)
    for s, mask in reversed(list(enumerate(masks))):
        own = F.col("variant").between(s * BITS, s * BITS + BITS - 1)
        apart = _distance(F.col("a"), F.col("b"), mask)
        here = own & ((apart == 1) | (F.col("variant") == s * BITS + cuts[s]))
        first = F.when(apart <= 1, here).otherwise(first)
    # Spark takes the index for no larger than its fingerprints, and would broadcast rows many times the size it reckons with
    found = a.join(b.hint("merge"), ["variant", "rest"]).where((F.col("a") < F.col("b")) & (_distance(F.col("a"), F.col("b")) <= max_distance) & first)
    return found.select("a", "b")


def groups_of(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """(fp, component) of every fingerprint in the column `fp`, given once each."""
    linked = components(links(prints, max_distance))
    return prints.join(linked, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, max_distance: int = 2) -> DataFrame:
    """(key, fingerprint, component_id) per row; the component is the smallest key reachable over links.

    Texts without words, and null texts, share the fingerprint zero and link like any other. Repeated rows, and rows
    with equal keys, are separate rows of their fingerprints' groups. A null key stays null and is never the smallest.
    Other columns are not read.
    """
    prints = settle(fingerprints(df.select(key, text), text, words).select(key, "fp"), "fingerprints")
    distinct = settle(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct_fingerprints")
    grouped = settle(groups_of(distinct.select("fp"), max_distance).join(distinct, "fp"), "labelled_fingerprints")
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = grouped.join(smallest, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(ids, "fp").select(key, digits, "component_id")


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of `df`, one of each group of near-duplicates: that with the smallest key, a null key last.

    Of repeated rows one stays, as of any group.
    """
    row, fp = fresh("row", df), fresh("fp", df)
    rows = fingerprints(df, text, words, fp)
    rows = settle(rows.withColumn(row, F.monotonically_increasing_id()), "documents_fingerprints")
    least = F.struct(F.col(f"`{key}`").isNull().alias("no_key"), F.col(f"`{key}`").alias("key"), F.col(row).alias("row"))
    distinct = settle(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(least).alias("least")), "distinct_fingerprints")
    grouped = groups_of(distinct.select("fp"), max_distance).join(distinct, "fp")
    first = grouped.groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row").alias(row))
    return rows.join(first, row, "left_semi").select([F.col(f"`{c}`") for c in df.columns])
