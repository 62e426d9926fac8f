"""Dates and time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.plans.sized import with_scalars


def synthesize_dates(df: DataFrame, id_col: str, start: str, modulo: int | None = None, out: str = "date") -> DataFrame:
    """Date an undated table: start + id, or start + id % modulo, days. Never applied implicitly."""
    step = F.col(id_col) % modulo if modulo else F.col(id_col)
    return df.withColumn(out, F.date_add(F.lit(start).cast("date"), step.cast("int")))


def parse_dates(c: str | Column, formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy")) -> Column:
    """First format that parses; null if none does."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def period(c: str | Column, unit: str) -> Column:
    """Start of the week (Monday), month, ... as a date."""
    return F.date_trunc(unit, c).cast("date")


def date_parts(c: str | Column) -> Column:
    return F.struct(F.month(c).alias("month"), F.quarter(c).alias("quarter"), F.weekday(c).alias("weekday"))


def sliding_windows(df: DataFrame, date_col: str, size: int = 30, step: int = 7, min_rows: int = 10,
                    include_partial: bool = False) -> DataFrame:
    """Rows with every day window they fall in: window starts first + k*step, start <= date < start + size.

    Each row computes its own window numbers from the first and last date, so there is no range join.
    The last window that would run past the last date is left out unless include_partial.
    """
    ends = df.agg(F.min(date_col).alias("_first"), F.max(date_col).alias("_last"))
    offset = F.datediff(date_col, "_first")
    span = F.datediff("_last", "_first")
    last_k = F.floor(span / step) if include_partial else F.floor((span - size) / step)
    low = F.greatest(F.lit(0), F.floor((offset - size) / step) + 1)
    high = F.least(F.floor(offset / step), last_k)
    ks = F.when(high >= low, F.sequence(low.cast("int"), high.cast("int"))).otherwise(F.array().cast("array<int>"))
    placed = (with_scalars(df.where(F.col(date_col).isNotNull()), ends)
              .withColumn("_k", F.explode(ks))
              .withColumn("window_start", F.date_add("_first", F.col("_k") * step))
              .withColumn("window_end", F.date_add("window_start", size))
              .drop("_k", "_first", "_last"))
    sizes = placed.groupBy("window_start").agg(F.count(F.lit(1)).alias("window_rows")).where(F.col("window_rows") >= min_rows)
    # one row per window start, at most span/step of them: days, not rows
    from pyspark.sql import Window
    sizes = sizes.withColumn("window_id", F.row_number().over(Window.orderBy("window_start")) - 1)
    return placed.join(F.broadcast(sizes), "window_start")


def date_span(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    days = F.datediff(F.max(date_col), F.min(date_col))
    return df.groupBy(*by).agg(
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"), days.alias("span_days"),
        (F.count(F.lit(1)).cast("double") / F.greatest(days, F.lit(1))).alias("rows_per_day"))


def time_filter(df: DataFrame, ts_col: str, ref: str, interval: str) -> DataFrame:
    """Rows at or after ref - interval, e.g. interval='7 days'."""
    bound = F.lit(ref).cast(df.schema[ts_col].dataType) - F.expr(f"INTERVAL {interval}")
    return df.where(F.col(ts_col) >= bound)
