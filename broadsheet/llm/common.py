"""What several operators share: text columns, intermediate tables in the shared folder, file access of tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.session import shared_dir

SPACE = " \t\n\x0b\x0c\r"
#: Java and RE2 form of one white-space character of the contracts.
SPACE_CLASS = r"[ \t-\r]"


def text_of(name: str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def squeezed(text: Column) -> Column:
    """Text without white space; plain byte searches, much faster than a regular expression."""
    for c in SPACE:
        text = F.replace(text, F.lit(c))
    return text


def words_of(text: Column) -> Column:
    """Array of the words between white space."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors see."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: a cut of the lineage that outlives executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table whose file splits are fewer than the cores (one row group) is dealt out by key; others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
