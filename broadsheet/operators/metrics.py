"""Operators over metric and event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.temporal import time_filter
from broadsheet.operators.relational import metric_anomalies, most_recent
from broadsheet.plans.sized import attach, bounded_rows


def endpoint_stats(df: DataFrame, endpoint: str, is_error: Column, value: str, ts: str) -> DataFrame:
    """Calls, errors, error rate, mean value and last call per endpoint."""
    bad = F.coalesce(is_error, F.lit(False))
    return df.groupBy(endpoint).agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(bad).alias("errors"), F.avg(bad.cast("int")).alias("error_rate"),
        F.avg(value).alias("mean_value"), F.max(ts).alias("last_call"))


def threshold_alerts(df: DataFrame, rules: DataFrame, metric: str, value: str, id_col: str) -> DataFrame:
    """Rows above the threshold of their metric. rules: metric, threshold, severity."""
    r = rules.select(F.col("metric").alias(metric), "threshold", "severity")
    return attach(df, r, [metric], [id_col]).where(F.col(value) > F.col("threshold"))


def metric_anomalies_by(df: DataFrame, metric: str, value: str, order: Sequence[str], **options) -> DataFrame:
    return metric_anomalies(df, order, value, [metric], **options)


def metrics_since(df: DataFrame, ts: str, ref: str, hours: int, component: str | None = None, name: str | None = None,
                  component_col: str = "component", name_col: str = "name") -> DataFrame:
    out = time_filter(df, ts, ref, f"{hours} hours")
    if component is not None:
        out = out.where(F.col(component_col) == component)
    if name is not None:
        out = out.where(F.col(name_col) == name)
    return out


def health_summary(snapshots: DataFrame, rules: DataFrame, ts: str, id_col: str, last: int = 10) -> DataFrame:
    """Mean of each ruled metric over the last snapshots, and whether all stay below their threshold."""
    limits = {r.metric: float(r.threshold) for r in bounded_rows(rules.select("metric", "threshold"), 200, "threshold rules")}
    recent = most_recent(snapshots, ts, last, id_col)
    means = recent.agg(F.count(F.lit(1)).alias("snapshots"), *[F.avg(m).alias(m) for m in limits])
    ok = F.lit(True)
    for m, limit in limits.items():
        ok = ok & F.coalesce(F.col(m) <= limit, F.lit(True))
    return means.withColumn("healthy", ok)


def metric_trend(df: DataFrame, ts: str, ref: str, hours: int, metric: str, value: str) -> DataFrame:
    return time_filter(df, ts, ref, f"{hours} hours").groupBy(metric).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(value).alias("mean"), F.max(value).alias("max"))


def score_histogram(df: DataFrame, col: str, by: Sequence[str] = (), width: float = 0.1) -> DataFrame:
    """Rows and mean score per bin of the given width."""
    return df.where(F.col(col).isNotNull()).groupBy(*by, F.floor(F.col(col) / width).alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(col).alias("mean"))
