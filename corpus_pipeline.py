"""From raw documents to packed training sequences: quality rules, exact and near duplicates, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.llm import exact, minhash, packing, pii, quality
from broadsheet.llm.common import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, held against references of these documents."""
    return quality.drop_bad(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space."""
    return exact.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest identifier of each group linked by five-word shingles, similarity 0.8 or more."""
    return minhash.drop_near(docs, size=5, percent=80)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))) if "n_chars" in out.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 tokens."""
    return packing.pack(docs, capacity=2048, end_id=0)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("quality_rules", keep_good), ("exact_dedup", drop_copies), ("minhash_near_dedup", drop_near_copies), ("pii", redact), ("packing", pack)]

#: Components of near-duplicates and packing have no SQL form; tests/llm compares each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the whole table of documents, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
