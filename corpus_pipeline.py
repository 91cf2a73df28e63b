"""From raw documents to packed training sequences, one written stage at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.llm import decontaminate, line_dedup, packing, simhash, toxicity
from harvestline.llm.common import keep

SHINGLE_WORDS = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that match an earlier one; ``n_chars`` follows if there.

    A null text stays null, a text may become empty; columns named as the operator's counts
    (``n_lines``, ``n_removed``) keep what they held.
    """
    names = {line_dedup.LINES: "_own_lines", line_dedup.REMOVED: "_own_removed"}
    left = line_dedup.dedup_lines(docs.withColumnsRenamed(names))
    left = left.drop(*names).withColumnsRenamed({own: name for name, own in names.items()})
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarity 0.8 or more, that with the smallest id."""
    return simhash.keep_one_similar(docs, words=SHINGLE_WORDS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
ORACLE_SQL = None  # hashes, alignment, training and tokens are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written and read again, over the whole ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
