"""Fill-in-middle documents, cut at exact token ranks that an indexable skip list finds.

Tokens are units. Every token is a node of the lowest lane; each higher lane keeps about one node in eight. A link
carries two widths, in units and in code points, so a descent that adds up widths reaches any unit rank exactly and
knows its place in the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from larder.llm.common import fresh, slices, without

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
LIFT = 3  # a node is in the next lane if so many more bits of its hash are zero
PLAIN_FROM = 90  # of 100 draws, those from here on stay plain
SPM_BELOW = 20  # of 100 draws, those below are suffix first

FIELDS = [
    StructField("n", LongType()),
    StructField("form", StringType()),
    StructField("prefix_chars", LongType()),
    StructField("middle_chars", LongType()),
    StructField("output", StringType()),
]


def token_starts(text: str) -> np.ndarray:
    """Where the matches of `[A-Za-z]+|[^A-Za-z]` start, in code points."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = ((points | np.uint32(32)) - np.uint32(97)) < 26
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(points)), bool), ~(letter[1:] & letter[:-1])]))


class SkipList:
    """Tokens under express lanes; the first node of every lane is the head, before the first token."""

    def __init__(self, starts: np.ndarray, chars: int) -> None:
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # units and code points of a link, node one lane down
        nodes, below = np.arange(len(starts)), np.arange(len(starts))
        # heights come from a hash of the rank, so that equal texts have equal lists
        bits = np.arange(len(starts), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16)
        lift = np.uint64((1 << LIFT) - 1)
        while len(nodes):
            units = np.diff(nodes, append=len(starts))
            points = np.diff(starts[nodes], append=chars)
            self.lanes.append((units, points, below))
            if len(nodes) <= 1 << LIFT:
                break
            up = np.flatnonzero(bits[nodes] & lift == 0)
            below = up if len(up) and up[0] == 0 else np.concatenate([[0], up])
            if len(below) == len(nodes):
                break
            nodes = nodes[below]
            bits = bits >> np.uint64(LIFT)

    def points_before(self, rank: int) -> int:
        """Code points of the first `rank` units."""
        node, passed, at = 0, 0, 0
        for units, points, below in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                at += int(points[node])
                node += 1
            if node < len(units):
                node = int(below[node])
            else:
                break  # the end of the list is the end in every lane
        return at


def shape(text: str, draw: str, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and middle, output) of a text; `draw` is hashed for the cuts and the form."""
    starts = token_starts(text)
    n = len(starts)
    digest = hashlib.sha256(draw.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= plain_from or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    ranks = SkipList(starts, len(text))
    lo, hi = (ranks.points_before(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
    if h4 % 100 < spm_below:
        return n, "spm", lo, hi - lo, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", lo, hi - lo, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(
    df: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW
) -> DataFrame:
    """Add `n` (units), `form` (plain, psm or spm), `prefix_chars`, `middle_chars` and `output` to every row.

    Cuts and form follow from the SHA-256 of `seed:key`, so repeated rows get equal output and reruns agree; a null key
    counts as an empty one. A null text is empty. Empty texts, and those that hold a mark, stay plain, with null widths.
    Columns of the added names are replaced; rows are neither moved nor shuffled. Whole texts are cut, however long.
    """
    draw = fresh("draw", df)
    seeded = df.select("*", F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))).alias(draw))
    kept = without(df, [f.name for f in FIELDS])
    sent = seeded.select(*(seeded[f"`{c}`"] for c in kept.columns), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(fresh("whole", seeded)), draw)
    schema = StructType([*kept.schema.fields, *FIELDS])
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.num_columns - 2
            for part in slices(batch, at):
                rows = [shape(t, d, plain_from, spm_below) for t, d in zip(part.column(at).to_pylist(), part.column(at + 1).to_pylist())]
                new = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *new], names=schema.fieldNames())

    return sent.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that `output` was made of, from output and form alone; a mark can't arise where parts and marks meet."""
    first, second = (F.when(form == "psm", a).otherwise(b) for a, b in ((PREFIX, SUFFIX), (SUFFIX, PREFIX)))
    body = F.substring(output, F.length(first) + 1, F.length(output))
    head = F.substring_index(body, "<S>", 1)
    tail = F.substring_index(body, "<P>", 1)
    one = F.when(form == "psm", head).otherwise(tail)
    rest = F.substring(body, F.length(one) + F.length(second) + 1, F.length(output))
    two = F.substring_index(rest, MIDDLE, 1)
    middle = F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(output))
    whole = F.when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    return F.when(form == "plain", output).otherwise(whole)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: units, form, widths, and SHA-256 of the output and of the text restored from it."""
    rows = transform(docs.select(key, text), key, text)

    def digest(value: Column) -> Column:
        return F.sha2(F.encode(value, "UTF-8"), 256)

    whole = digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256")
    return rows.select(key, "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), whole)


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
  CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi FROM k),
p AS (SELECT *, array_to_string(u[1:lo], '') AS a, array_to_string(u[lo + 1:hi], '') AS b, array_to_string(u[hi + 1:], '') AS c,
  CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 >= {PLAIN_FROM} THEN 'plain'
       WHEN h4 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(a) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(b) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || a || '{SUFFIX}' || c || '{MIDDLE}' || b
         ELSE '{SUFFIX}' || c || '{PREFIX}' || a || '{MIDDLE}' || b END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""
