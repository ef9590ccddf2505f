"""The corpus pipeline: documents through five operators, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns the columns of
`documents`; the last returns the token counts and digests.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, decontaminate, langid, linededup, simhash
from larder.llm.common import table
from larder.sources.staging import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

MIN_LANGUAGE_SCORE = 0.5


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with less than half their letters under learned languages, go."""
    model = langid.train(docs.where(langid.remainder("doc_id", 4) != 2))
    return langid.keep_identified(docs, model, MIN_LANGUAGE_SCORE)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; copies of a text count as one page, and `n_chars` follows the text."""
    cleared = linededup.drop_boilerplate(docs, "source", copies_once=True)
    return cleared.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.representatives(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("simhash", drop_copies),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

#: SQL has no form for the language model, the edit search and the merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
