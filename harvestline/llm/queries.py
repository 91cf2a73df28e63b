"""The operators of this package as queries over the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.llm import (
    collocations,
    conversations,
    decontaminate,
    embeddings,
    hmm,
    licenses,
    line_dedup,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    toxicity,
)
from harvestline.llm.common import bucket_of_id, text_or_empty

from harvestline.llm.oracle import ORACLE  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        F.crc32(text_or_empty()).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col(pii.SPANS)
    return found.select(
        "doc_id",
        *[pii.count_kind(spans, k.name).alias(f"n_{k.name}") for k in pii.BASE],
        F.sha2(pii.spelled(F.filter(spans, pii.is_base)), 256).alias("base_sha256"),
        pii.spelled(spans).alias("spans"),
    )


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )

@query
def op5_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = F.col(toxicity.SCORE)
    held_out = bucket_of_id("doc_id", toxicity.FOLDS) == toxicity.HELD_FOLD
    return toxicity.add_scores(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "score", "similarity")


@query
def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))

@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = F.col(quality.SCORE)
    held_out = bucket_of_id("doc_id", quality.FOLDS) == quality.HELD_FOLD
    return quality.add_scores(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= quality.THRESHOLD).cast("int").alias("predicted"),
    )
