"""Byte-level BPE with a hierarchical-bitmap rank queue.

Each match of the pre-token pattern is merged on its own. Pairs wait in buckets, one per merge rank, that hold positions
of a linked list of tokens. A bitmap in levels marks the ranks with a bucket, so find-first-set gives the next rank in
constant time; an entry whose pair has changed since is stale and skipped. A pre-token of n bytes takes O(n) queue steps,
however long it is. Merges of one rank run from left to right.

Many pre-tokens share one list and one queue: no pair reaches over their borders, so each is merged as if alone, while a
rank is looked up once for all of them.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from larder.llm.common import with_derived

CACHED_PIECES = 320_000
CACHED_PIECE_CHARS = 64
BATCH_BYTES = 1 << 18  # of pre-tokens in one queue; a longer one has a queue of its own
TEXT_BYTES = 1 << 20  # of texts at a time

WORD = 8  # a word of the bitmap has 2 ** WORD bits
BIT = [1 << i for i in range(1 << WORD)]


class Ranks:
    """A set of small integers as a bitmap in levels: a bit of a higher level marks a word that isn't clear."""

    def __init__(self, size: int) -> None:
        self.levels: list[list[int]] = []
        while not self.levels or size > 1:
            size = (size + (1 << WORD) - 1) >> WORD
            self.levels.append([0] * max(1, size))

    def add(self, value: int) -> None:
        for words in self.levels:
            at = value >> WORD
            before = words[at]
            words[at] = before | BIT[value & len(BIT) - 1]
            if before:
                return
            value = at

    def pop(self) -> int:
        """Take out the least value; -1 if there is none."""
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            if not word:
                return -1
            at = (at << WORD) + (word & -word).bit_length() - 1
        value = at
        for words in self.levels:
            word = at >> WORD
            words[word] ^= BIT[at & len(BIT) - 1]
            if words[word]:
                break
            at = word
        return value


class Codec:
    """Vocabulary of a rank file (base64 token, rank per line); encodes and decodes bytes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.double = np.full(1 << 16, -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank
        self.waiting = Ranks(max(ranks.values(), default=0) + 1)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        return next(self.encode_pieces([piece])).tolist() if piece else []

    def encode_pieces(self, pieces: list[bytes]) -> Iterator[np.ndarray]:
        """Token ids of each pre-token, none of them empty."""
        get = self.ranks.get
        whole = [get(piece) for piece in pieces]
        merged = self._merge([piece for piece, rank in zip(pieces, whole) if rank is None])
        for rank in whole:
            yield next(merged) if rank is None else np.array([rank])

    def _merge(self, pieces: list[bytes]) -> Iterator[np.ndarray]:
        held, size = [], 0
        for piece in pieces:
            if held and size + len(piece) > BATCH_BYTES:
                yield from self._queue(held)
                held, size = [], 0
            held.append(piece)
            size += len(piece)
        if held:
            yield from self._queue(held)

    def _queue(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Merge the pre-tokens, laid end to end."""
        get, longest, waiting = self.ranks.get, self.longest, self.waiting
        data = b"".join(pieces)
        n = len(data)
        codes = np.frombuffer(data, np.uint8).astype(np.int64)
        ends = np.cumsum([len(piece) for piece in pieces])
        first = np.full(n, -1, np.int64)
        first[:-1] = self.double[codes[:-1] << 8 | codes[1:]]
        first[ends - 1] = -1
        border = bytearray(n + 1)  # 1 where a pre-token starts, and at the end
        for e in ends.tolist():
            border[e] = 1
        border[0] = 1
        pair = first.tolist()  # rank of the pair that starts at p, -1 for none
        token = self.single[codes].tolist()  # id of the token that starts at p, -1 if it has been taken in
        after = list(range(1, n + 1))  # the token at p is data[p:after[p]]
        before = list(range(-1, n))
        by_rank = np.argsort(first, kind="stable")
        by_rank = by_rank[np.searchsorted(first[by_rank], 0) :]
        cuts = np.flatnonzero(np.diff(first[by_rank], prepend=-1))
        buckets = {}
        for lo, hi, rank in zip(cuts.tolist(), [*cuts[1:].tolist(), len(by_rank)], first[by_rank][cuts].tolist()):
            buckets[rank] = by_rank[lo:hi].tolist()
            waiting.add(rank)
        while (rank := waiting.pop()) >= 0:
            bucket = buckets.pop(rank)
            bucket.sort()  # merges of a rank run from left to right
            for k, p in enumerate(bucket):
                if pair[p] != rank:
                    continue  # stale
                gone = after[p]
                after[p] = end = after[gone]
                before[end] = p
                token[p] = rank
                token[gone] = pair[gone] = pair[p] = -1
                late = False
                if not border[end]:
                    stop = after[end]
                    if stop - p <= longest and (ahead := get(data[p:stop])) is not None:
                        pair[p] = ahead
                        if ahead in buckets:
                            buckets[ahead].append(p)
                        else:
                            buckets[ahead] = [p]
                            waiting.add(ahead)
                        late = ahead < rank
                if not border[p]:
                    q = before[p]
                    pair[q] = -1
                    if end - q <= longest and (behind := get(data[q:end])) is not None:
                        pair[q] = behind
                        if behind in buckets:
                            buckets[behind].append(q)
                        else:
                            buckets[behind] = [q]
                            waiting.add(behind)
                        late = late or behind < rank
                if late and k + 1 < len(bucket):  # a lower rank goes first
                    if rank in buckets:
                        buckets[rank] += bucket[k + 1 :]
                    else:
                        buckets[rank] = bucket[k + 1 :]
                        waiting.add(rank)
                    break
        ids = np.array(token)
        alive = ids >= 0
        return np.split(ids[alive], np.cumsum(alive)[ends[:-1] - 1])

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, unpack(packed)))


class Pieces(dict):
    """Packed ids by pre-token, of those met lately: two generations, so frequent ones outlive rare ones."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        return self.pack([[piece]])[0]

    def pack(self, texts: list[list[str]]) -> list[bytes]:
        """Packed ids of texts given as lists of pre-tokens."""
        new = set(chain.from_iterable(texts)).difference(self)
        if len(self) + len(new) > CACHED_PIECES:
            self.older = dict(self)
            self.clear()
            new = set(chain.from_iterable(texts))
        older = self.older
        missing = [piece for piece in new if piece not in older]
        self.update((piece, older[piece]) for piece in new if piece in older)
        for piece, ids in zip(missing, self.codec.encode_pieces([piece.encode() for piece in missing])):
            self[piece] = pack(ids)
        packed = [b"".join(map(self.__getitem__, pieces)) for pieces in texts]
        for piece in missing:
            if len(piece) > CACHED_PIECE_CHARS:
                del self[piece]
        return packed


def pack(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, "<u4").tobytes()


def unpack(packed: bytes) -> array:
    ids = array("I", packed)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


@lru_cache(maxsize=2)
def load(path: str) -> Codec:
    """The codec of a rank file; once per Python worker."""
    with open(path, "rb") as f:
        return Codec({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())})


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(load(path))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add `ids` (binary: little-endian unsigned 32-bit token ids) and `n_tokens` of each whole text.

    A null or empty text has no tokens. No special tokens are recognised. `path` is a rank file that every executor
    can read. Columns named `ids` or `n_tokens` are replaced; repeated rows stay.
    """
    fields = [StructField("ids", BinaryType()), StructField("n_tokens", LongType())]

    def make():
        import regex

        find, pieces = regex.compile(pattern).findall, pieces_of(path)

        def derive(texts: list) -> tuple[list, list]:
            packed = pieces.pack([find(t) if t else [] for t in texts])
            return packed, [len(p) // 4 for p in packed]

        return derive

    return with_derived(df, text, fields, make, TEXT_BYTES)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add `decoded` (binary), the bytes of the packed token ids; null or empty ids give no bytes."""

    def make():
        codec = load(path)
        return lambda rows: ([codec.decode(r) if r else b"" for r in rows],)

    return with_derived(df, ids, [StructField("decoded", BinaryType())], make)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add `ids`, `n_tokens` and `decoded` in one pass over the texts: those of `encode`, and what `decode` makes of the ids."""
    fields = [StructField("ids", BinaryType()), StructField("n_tokens", LongType()), StructField("decoded", BinaryType())]

    def make():
        import regex

        find, pieces, codec = regex.compile(pattern).findall, pieces_of(path), load(path)

        def derive(texts: list) -> tuple[list, list, list]:
            packed = pieces.pack([find(t) if t else [] for t in texts])
            return packed, [len(p) // 4 for p in packed], [codec.decode(p) for p in packed]

        return derive

    return with_derived(df, text, fields, make, TEXT_BYTES)


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: `n_tokens`, and SHA-256 of its ids and of the bytes decoded from them."""
    return round_trip(docs.select(key, text), path, pattern, text).select(
        key, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
