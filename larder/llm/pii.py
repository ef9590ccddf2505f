"""Personal data in disguise: normalise with offsets kept, detect, map the spans back.

A text is a string with the source span of every character. Each transducer lists edits (span, replacement) and applies
them: look-alike characters, then bracketed at and dot and spelled-out digits, then at and dot as words. Detection runs
on the source and on the normalised text; spans found only after an edit are mapped back to source characters.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from larder.llm.common import with_derived

KINDS = ("email", "ip", "card", "phone")

FOUND = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("base", BooleanType())])
)

# fixed values: characters of an address, and the patterns of the four kinds
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# fixed values: look-alikes of ASCII characters; compatibility forms (full-width, mathematical) and digits follow from Unicode
LOOKALIKES = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іıι", "j": "јϳ", "k": "κ",
    "l": "ⅼӏ", "m": "ⅿ", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "u": "υս", "v": "νѵ",
    "w": "ԝ", "x": "хх", "y": "уγ", "z": "ᴢ", "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ",
    "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ",
    "Z": "Ζ", ".": "․。", "-": "‐‑‒–−", " ": "   ", "@": "﹫", "+": "﹢",
    "": "​‌‍⁠﻿­",
}
# fixed values: digits as words, in English, German, French and Spanish
DIGIT_WORDS = {
    "0": ("zero", "oh", "null", "zéro", "cero"),
    "1": ("one", "eins", "un", "uno"),
    "2": ("two", "zwei", "deux", "dos"),
    "3": ("three", "drei", "trois", "tres"),
    "4": ("four", "vier", "quatre", "cuatro"),
    "5": ("five", "fünf", "cinq", "cinco"),
    "6": ("six", "sechs", "seis"),
    "7": ("seven", "sieben", "sept", "siete"),
    "8": ("eight", "acht", "huit", "ocho"),
    "9": ("nine", "neun", "neuf", "nueve"),
}
# fixed values: words for the signs of an address
AT = "at|arobase|arroba"
DOT = "dot|punkt|point|punto"


@lru_cache(maxsize=1)
def _lookalikes() -> dict[str, str]:
    table = {c: plain for plain, odd in LOOKALIKES.items() for c in odd}
    for c in map(chr, range(0x80, 0x20000)):
        plain = unicodedata.normalize("NFKC", c)
        if unicodedata.category(c) == "Nd":
            table.setdefault(c, str(unicodedata.digit(c)))
        elif len(plain) == 1 and (plain in LOCAL or plain in "@ ()"):
            table.setdefault(c, plain)
    return table


def _alternatives(words) -> str:
    return "|".join(sorted(words, key=len, reverse=True))


WORD_DIGITS = {w: d for d, words in DIGIT_WORDS.items() for w in words}
DIGIT_NAMES = frozenset(WORD_DIGITS)
WORDS = re.compile(r"\w+")
BLANKS = r"[\x20\t\r\n\x0b\x0c]"
_WORD = rf"(?:{_alternatives(WORD_DIGITS)})(?!\w)"
_TOKEN = rf"(?:(?:(?:double|triple){BLANKS}++)?{_WORD}|[0-9]++)"
SPELLED = re.compile(rf"(?<!\w)(?:\+|plus{BLANKS}++)?{_TOKEN}(?:(?:,?{BLANKS}++|-){_TOKEN}){{2,}}", re.I)
SPELLED_WORD = re.compile(rf"(?<!\w)(plus{BLANKS}++)?(?:(double|triple){BLANKS}++)?({_WORD})|(?<!\w)(plus){BLANKS}++(?=[0-9])|(,)(?={BLANKS})|({BLANKS}++)", re.I)
BRACKETED = re.compile(rf"[\[({{<]{BLANKS}*+(?:({AT}|@)|(?:{DOT}|\.)){BLANKS}*+[\])}}>]", re.I)
# signs of an address in words: between blanks, or between two of the same dash
DASHES = r"[-_*|~]"
_LABEL = rf"(?:(?!-(?:{DOT}|{AT})-)[A-Za-z0-9-])++"
_SEP = rf"(?:{BLANKS}++(?:{DOT}){BLANKS}++|\.|(?P<dash>{DASHES})(?:{DOT})(?P=dash))"
AT_SIGN = re.compile(rf"(?<=[A-Za-z0-9._%+-])(?:{BLANKS}++(?:(?P<word>{AT})|(?P<spaced>@)){BLANKS}++|@|(?P<dash>{DASHES})(?:{AT})(?P=dash))(?=[A-Za-z0-9-])", re.I)
DOMAIN_START = re.compile(rf"{_LABEL}{_SEP}{_LABEL}", re.I)
DOMAIN_NEXT = re.compile(rf"(?P<sep>{_SEP}){_LABEL}", re.I)
LABEL = re.compile(_LABEL, re.I)
DASHED_DOT = re.compile(rf"(?<=[A-Za-z0-9])({DASHES})(?:{DOT})\1(?=[A-Za-z0-9])", re.I)
WORDED_DOT = re.compile(rf"{BLANKS}++(?:{DOT}){BLANKS}++", re.I)
DOT_WORDS = tuple(DOT.split("|"))
WORDED_IP = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:{BLANKS}++(?:{DOT}){BLANKS}++|\.)[0-9]{{1,3}}){{3}}(?![0-9])", re.I)

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost addresses: each @ with the run of address characters before it that no earlier address holds."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield "email", start, free
        at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[Span]:
    """Four numbers with dots between, four at a time from the left of each longer chain."""
    for chain in DOTTED.finditer(text):
        if chain.group().count(".") < 3:
            continue
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(_byte(p) for p in four):
                yield "ip", at, end
            at = end + 1


def _byte(digits: str) -> bool:
    significant = digits.lstrip("0")
    return len(significant) < 3 or len(significant) == 3 and significant <= "255"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(m.group().count, "0123456789")) <= 15:
                yield "phone", m.start(), m.end()


def detect(text: str) -> list[Span]:
    return [*emails(text), *addresses(text), *cards(text), *phones(text)]


class Mapped(NamedTuple):
    """A text with the source span of each of its characters, and whether it was written by an edit."""

    text: str
    start: np.ndarray
    end: np.ndarray
    edited: np.ndarray

    @classmethod
    def of(cls, text: str) -> Mapped:
        at = np.arange(len(text))
        return cls(text, at, at + 1, np.zeros(len(text), bool))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace each span; edits are in order and apart. A new character stands for its whole span."""
        if not edits:
            return self
        texts, starts, ends, marks, at = [], [], [], [], 0
        for lo, hi, new in edits:
            if lo < at or hi == lo:
                continue
            texts += [self.text[at:lo], new]
            starts += [self.start[at:lo], np.full(len(new), self.start[lo])]
            ends += [self.end[at:lo], np.full(len(new), self.end[hi - 1])]
            marks += [self.edited[at:lo], np.ones(len(new), bool)]
            at = hi
        texts.append(self.text[at:])
        return Mapped(
            "".join(texts),
            np.concatenate([*starts, self.start[at:]]),
            np.concatenate([*ends, self.end[at:]]),
            np.concatenate([*marks, self.edited[at:]]),
        )


def _characters(points: list[int]) -> re.Pattern[str]:
    """A class of characters, as ranges."""
    ranges: list[list[int]] = []
    for c in sorted(points):
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]")


@lru_cache(maxsize=1)
def _odd() -> tuple[re.Pattern[str], re.Pattern[str]]:
    """Look-alikes within 16 bits, which are quick to search for, and all of them."""
    points = list(map(ord, _lookalikes()))
    return _characters([c for c in points if c < 0x10000]), _characters(points)


def has_lookalikes(text: str) -> bool:
    if text.isascii():
        return False
    near, every = _odd()
    return bool(near.search(text)) or max(text) > "\uffff" and bool(every.search(text))


def plain_characters(text: Mapped) -> Mapped:
    table = _lookalikes()
    return text.rewrite([(m.start(), m.end(), table[m.group()]) for m in _odd()[1].finditer(text.text)])


def bracketed_signs(text: Mapped) -> Mapped:
    """At and dot in brackets, with the blanks around them."""
    edits, free = [], 0
    for m in BRACKETED.finditer(text.text):
        lo, hi = _blanks_before(text.text, m.start(), free), m.end()
        while hi < len(text.text) and text.text[hi] in BLANK:
            hi += 1
        edits.append((lo, hi, "@" if m.group(1) else "."))
        free = hi
    return text.rewrite(edits)


def spelled_digits(text: Mapped) -> Mapped:
    """Digits for words, in runs of three or more words or numbers; blanks in such a run become single spaces."""
    edits = []
    for run in SPELLED.finditer(text.text):
        for m in SPELLED_WORD.finditer(text.text, run.start(), run.end()):
            plus, times, word, bare_plus, comma, blanks = m.groups()
            if comma:
                edits.append((m.start(), m.end(), ""))
            elif blanks:
                if blanks != " ":
                    edits.append((m.start(), m.end(), " "))
            else:
                digit = WORD_DIGITS.get((word or "").lower(), "") * {"double": 2, "triple": 3}.get((times or "").lower(), 1)
                edits.append((m.start(), m.end(), ("+" if plus or bare_plus else "") + digit))
    return text.rewrite(edits)


BLANK = " \t\r\n\x0b\x0c"


def _blanks_before(text: str, at: int, free: int) -> int:
    """Where the run of blanks before a place starts."""
    while at > free and text[at - 1] in BLANK:
        at -= 1
    return at


def _name_before(text: str, at: int, free: int) -> int:
    """Where the run of address characters before a place starts."""
    while at > free and text[at - 1] in LOCAL:
        at -= 1
    return at


def _dot_before(text: str, at: int, free: int) -> int:
    """Where a worded dot that ends at a place starts; the place itself if there is none."""
    end = _blanks_before(text, at, free)
    if end == at:
        return at
    for word in DOT_WORDS:
        start = end - len(word)
        if start > free and text[start:end].lower() == word:
            first = _blanks_before(text, start, free)
            return first if first < start else at
    return at


def worded_addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """Edits that make addresses of names, signs in words or between blanks or dashes, and domains.

    A domain has two labels at least. A worded at needs a worded dot somewhere in the address, or a name that looks like
    one of an address: with a letter, and with a digit or a sign. So "look at example.com" is prose.
    """
    free = 0
    for m in AT_SIGN.finditer(text):
        if m.start() < free or not DOMAIN_START.match(text, m.end()):
            continue
        dots, end = [], LABEL.match(text, m.end()).end()
        while following := DOMAIN_NEXT.match(text, end):
            if following.group("sep") != ".":
                dots.append(following.span("sep"))
            end = following.end()
        start = name = _name_before(text, m.start(), free)
        if m.group("dash"):
            dots += [d.span() for d in DASHED_DOT.finditer(text, name, m.start())]
        before = []
        while (dot := _dot_before(text, start, free)) < start and (label := _name_before(text, dot, free)) < dot:
            before.append((dot, start))
            start = label
        known = text[name : m.start()]
        like_a_name = any(c.isalpha() for c in known) and any(c in "0123456789._%+" for c in known.strip("."))
        if m.group("word"):
            sure = bool(dots or before) or like_a_name
        elif m.group("dash") or m.group("spaced"):
            sure = True
        else:
            sure = bool(dots)  # the rest needs no edit
        if not sure:
            continue
        free = end
        yield from sorted([*((a, b, ".") for a, b in [*dots, *before]), (m.start(), m.end(), "@")])


def worded_signs(text: Mapped) -> Mapped:
    """At and dot as words, where the words around make an address of them."""
    edits = list(worded_addresses(text.text))
    for m in WORDED_IP.finditer(text.text):
        edits += [(d.start(), d.end(), ".") for d in WORDED_DOT.finditer(text.text, m.start(), m.end())]
    return text.rewrite(sorted(set(edits)))


def normalise(text: str) -> Mapped:
    mapped = Mapped.of(text)
    if has_lookalikes(text):
        mapped = plain_characters(mapped)
    return worded_signs(spelled_digits(bracketed_signs(mapped)))


def may_be_disguised(text: str) -> bool:
    """A quick test that is true of every text the transducers would change."""
    if has_lookalikes(text):
        return True
    if any(c in text for c in "[({<") and BRACKETED.search(text):
        return True
    if next(worded_addresses(text), None):
        return True
    low = text.lower()
    if any(word in low for word in DOT_WORDS) and (m := WORDED_IP.search(text)) and WORDED_DOT.search(m.group()):
        return True
    return not DIGIT_NAMES.isdisjoint(WORDS.findall(low)) and bool(SPELLED.search(text))


def spans(text: str) -> list[dict]:
    """All spans of a text in code points, by kind and start; `base` tells those that need no normalising.

    A span found after an edit is added unless a base span of its kind holds it.
    """
    base = detect(text)
    found = [(KINDS.index(k), s, e, True) for k, s, e in base]
    if may_be_disguised(text):
        mapped = normalise(text)
        for kind, s, e in detect(mapped.text):
            lo, hi = int(mapped.start[s]), int(mapped.end[e - 1])
            if mapped.edited[s:e].any() or hi - lo != e - s:
                if not any(k == kind and a <= lo and hi <= b for k, a, b in base):
                    found.append((KINDS.index(kind), lo, hi, False))
    return [{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in sorted(set(found))]


def find(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `found`, an array of (kind, start, end, base) for each whole text; a null text has none.

    A column of that name is replaced. Repeated rows stay.
    """
    return with_derived(df, text, [StructField("found", FOUND)], lambda: lambda texts: ([spans(t) if t else [] for t in texts],))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the number of spans of each kind, a digest of the base spans, and all spans as text."""
    rows = find(docs.select(key, text), text)

    def listed(which):
        return F.array_join(F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    base = F.sha2(F.encode(listed(F.filter("found", lambda s: s["base"])), "UTF-8"), 256).alias("base_sha256")
    return rows.select(key, *counts, base, listed(F.col("found")).alias("spans"))
