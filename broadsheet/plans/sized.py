"""Joins against side tables: broadcast only what was counted, salt everything else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SMALL_ROWS = 50_000
SALTS = 32


def fits(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """True when df has at most max_rows rows; reads no more than max_rows + 1 of them."""
    return df.limit(max_rows + 1).count() <= max_rows


def salt(cols: Sequence[str | Column], salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str],
                how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Equi-join that survives one hot key on the big side.

    Each key of `big` is spread over `salts` sub-keys by a hash of `spread_by`; `small` (unique or
    nearly unique on the key) is repeated once per sub-key. The hint is there as Spark does not foresee the
    repetition, and would send the repeated rows through the driver.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salted_join keeps rows of the big side: inner, left, left_semi or left_anti")
    left = big.withColumn("_salt", salt(spread_by, salts))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def attach(big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str],
           how: str = "inner", max_rows: int = SMALL_ROWS) -> DataFrame:
    """Look up rows of a side table: broadcast when it was counted small, salted shuffle join otherwise."""
    if fits(small, max_rows):
        return big.join(F.broadcast(small), list(on), how)
    return salted_join(big, small, on, spread_by, how)


def bounded_rows(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a side table that must be small (rules, word lists, centres); refuse anything larger."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; use the join form of this operator")
    return rows


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a global aggregate (always exactly one row) to every row."""
    return df.join(F.broadcast(one_row.limit(1)))


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Spread a table with fewer scan splits than cores; a table with more splits is left as it is.

    A small file may be one row group, which only one task can read. Fewer splits than cores also bounds
    what is shuffled here: cores times the split size.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
