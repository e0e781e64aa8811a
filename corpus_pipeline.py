"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handover.llm import bpe, decontam, linededup, quality, scratch, simhash
from handover.llm.queries import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's cutoffs."""
    ship(spark)
    return quality.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line passages cut; ``n_chars`` follows the text."""
    cut = linededup.remove_repeated_lines(docs)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop("n_lines", "n_removed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    ship(spark)
    return simhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of the ids and of the decoded text."""
    ship(spark)
    done = bpe.encode_decode(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), decoded="decoded")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", encode),
]

#: Learned cutoffs, SimHash and BPE have no DuckDB form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
