"""The given tables, and the SQL pieces shared by the comparison queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.plans.sized import spread_small


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread_small(df, "doc_id") if name == "documents" else df


def articles(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """documents as an article table: doc_id, text and source as the category."""
    return table(spark, sf, "documents").select("doc_id", "text", F.col("source").alias("category"), *extra)


def dated(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    from broadsheet.functions.temporal import synthesize_dates
    return synthesize_dates(articles(spark, sf, *extra), "doc_id", "2024-01-01", 60, "date")


DATED = "(SELECT *, source AS category, CAST(DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS DATE) AS date FROM documents)"


def words_sql(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '\\s+'), lambda w: w <> '')"


def tokens_sql(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_''-]+')"


def sentences_sql(c: str) -> str:
    return (f"list_filter(string_split(regexp_replace({c}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), "
            f"lambda s: regexp_matches(s, '\\S'))")


def list_sql(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def hits_sql(c: str, words) -> str:
    """Number of words of the list contained in the text."""
    return f"len(list_filter({list_sql(words)}, lambda w: contains({c}, w)))"
