"""Small frames shared by the tests: documents with every odd case, and a planted corpus."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"

WORDS = {
    "en": "the quick brown house stands with another garden while people think about weather and trade".split(),
    "de": "das schnelle braune haus steht neben einem garten während menschen über wetter sprechen".split(),
    "fr": "la maison brune est située près du jardin pendant que les gens parlent beaucoup".split(),
}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def corpus(n: int = 60, seed: int = 1) -> list[tuple]:
    """Documents in three languages, three lines each, with a boilerplate line on one host."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        lines = [sentence(rng, lang, 25) for _ in range(3)]
        host = f"host{i % 4}"
        if host == "host1":
            lines.insert(1, "  accept all cookies \t")
        text = "\n".join(lines)
        rows.append((i, text, lang, host, len(text)))
    return rows


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and blank texts, repeated rows and ids, one very long text."""
    long = "word " * 50_000 + "x" * 100_000
    return [
        (1000, None, "en", "host0", None),
        (1001, "", None, None, 0),
        (1002, " \n\t\n ", "de", "host0", 5),
        (1003, "same text here twice", "en", "host2", 20),
        (1003, "same text here twice", "en", "host2", 20),
        (1003, "another text of the same id", "en", "host2", 27),
        (None, "a text without an id", "en", "host3", 20),
        (None, None, None, None, None),
        (1004, long, "en", "host0", len(long)),
        (1005, "1234 5678 !!! ___", "en", "host0", 17),
        (1006, "emoji 😀 \U0001f469‍\U0001f680 and ελληνικά и кириллица", "fr", "host0", 40),
    ]


def documents(spark, rows):
    return spark.createDataFrame(rows, DOC_SCHEMA)


CLASHING = (
    "ids n_tokens decoded lang_pred score spans held_out fp fingerprint component_id component node found n_lines n_dropped "
    "key item edits start end predicted label u v a b uid vec keys"
).split()


def with_clashes(df):
    """The frame with extra columns of names that the operators use themselves."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(f"extra {c}").alias(c) for c in CLASHING if c not in df.columns))
