"""The numbered queries: each operator over its whole table with production parameters, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, chat, decontaminate, embeddings, fim, langid, linededup, pii, quality, repair, simhash, suffixes, warc
from larder.llm.common import table
from larder.sources.staging import stage_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


HARD_TURN = "</s>[INST] ok [/INST]"


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, whose turns are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HARD_TURN).alias("text"),
    )
    return chat.read_back(chat.windows(turns.unionByName(hard)))


@query
def op2_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source, their site."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.drop_boilerplate(documents, "source", copies_once=True).select("doc_id", "text", "n_lines", "n_dropped")


SQL["op2_linededup"] = linededup.SQL


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each benchmark item found in each document."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op7_embeddings"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= {embeddings.THRESHOLD}),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) USING (vec_id)
"""


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to an archive, its records to WARC files, and what the files say when read back."""
    path = stage_path(spark, "warc")
    buckets = warc.write(table(spark, sf_dir, "pages"), path)
    warc.export(spark, path, f"{path}/files", "gzip", buckets)
    return warc.described(warc.parse(spark, f"{path}/files"))


SQL["op10_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT *, strlen(body) AS payload_bytes, max(page_id) OVER (PARTITION BY body) AS owner FROM p),
k AS (SELECT *, payload_bytes >= {warc.MIN_REVISIT_BYTES} AND page_id <> owner AS again FROM q)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN owner END AS refers_to FROM k
"""


@query
def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


@query
def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


SQL["op12_fim"] = fim.SQL


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after the damage that the task prescribes."""
    return repair.report(table(spark, sf_dir, "conversations"))
