"""Component evaluation, grades, summaries and chart tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from broadsheet.functions.text import banded
from broadsheet.functions.wordlists import GRADE_THRESHOLDS
from broadsheet.operators.classify import classification_report, confusion
from broadsheet.operators.metrics import score_histogram
from broadsheet.operators.relational import category_counts
from broadsheet.plans.sized import attach, with_scalars


def evaluate_component(results: DataFrame, kind: str, truth: str = "truth", pred: str = "predicted") -> DataFrame:
    """Report of one component: labels (report), summaries (compression), entities (per text), queries (success)."""
    if kind == "labels":
        return classification_report(results, truth, pred)
    if kind == "summaries":
        return results.agg(F.count(F.lit(1)).alias("summaries"), F.avg("compression").alias("mean_compression"), F.avg("overall").alias("mean_quality"))
    if kind == "entities":
        per = results.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
        return per.agg(F.count(F.lit(1)).alias("texts"), F.avg("n").alias("mean_entities"), F.max("n").alias("max_entities"))
    if kind == "queries":
        return results.agg(F.count(F.lit(1)).alias("queries"), F.avg(F.col("success").cast("int")).alias("success_rate"))
    raise ValueError("kind is labels, summaries, entities or queries")


GRADE_POINTS = {"excellent": 4.0, "good": 3.0, "fair": 2.0, "poor": 1.0}


def grade_components(metrics: DataFrame, thresholds: Mapping[str, float] | DataFrame = GRADE_THRESHOLDS) -> DataFrame:
    """component, metric, value -> grade (.9 / .8 / .7), points, whether the threshold is met, overall grade."""
    if not isinstance(thresholds, DataFrame):
        thresholds = metrics.sparkSession.createDataFrame(list(thresholds.items()), "metric string, threshold double")
    g = attach(metrics, thresholds, ["metric"], ["component"], "left").withColumn("grade", banded(F.col("value"), [(0.9, "excellent"), (0.8, "good"), (0.7, "fair")], "poor"))
    points = F.lit(0.0)
    for name, p in GRADE_POINTS.items():
        points = F.when(F.col("grade") == name, p).otherwise(points)
    g = g.withColumns({"points": points, "met": F.col("value") >= F.col("threshold"),
                       "recommendation": F.when(F.col("value") < F.col("threshold"), F.concat(F.lit("Improve "), F.col("component"), F.lit(": "), F.col("metric")))})
    mean = g.agg(F.avg("points").alias("overall_points"))
    return with_scalars(g, mean).withColumn("overall_grade", banded(F.col("overall_points"), [(3.5, "excellent"), (2.5, "good"), (1.5, "fair")], "poor"))


def executive_summary(results: Mapping[str, DataFrame]) -> DataFrame:
    """Findings as rows (section, finding, value). Sections: classification (report), sentiment (label shares), topics (words)."""
    out = None
    if "classification" in results:
        out = _add(out, results["classification"].where(F.col("class") == "accuracy").select(F.lit("classification").alias("section"), F.lit("accuracy").alias("finding"), F.col("f1").alias("value")))
    if "sentiment" in results:
        s = results["sentiment"]
        out = _add(out, s.agg(F.max_by("sentiment", F.struct("count", "sentiment")).alias("finding"), F.max("percentage").alias("value")).select(F.lit("sentiment").alias("section"), "finding", "value"))
    if "topics" in results:
        out = _add(out, results["topics"].agg(F.count_distinct("topic").cast("double").alias("value")).select(F.lit("topics").alias("section"), F.lit("topics").alias("finding"), "value"))
    return out


def _add(out: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if out is None else out.unionByName(more)


def chart_data(df: DataFrame, kind: str, **args) -> DataFrame:
    """Tables behind the charts: distribution, timeline, histogram, heatmap."""
    if kind == "distribution":
        return category_counts(df, args["col"]).select(args["col"], "count", "percentage")
    if kind == "timeline":
        return df.groupBy(F.date_trunc(args.get("unit", "day"), args["date_col"]).cast("date").alias("period"), *args.get("by", ())).agg(F.count(F.lit(1)).alias("count"))
    if kind == "histogram":
        return score_histogram(df, args["col"], args.get("by", ()), args.get("width", 0.1))
    if kind == "heatmap":
        return confusion(df, args["truth"], args["pred"])
    raise ValueError("kind is distribution, timeline, histogram or heatmap")
