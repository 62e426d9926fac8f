"""Validation of an article table: long report rows (check_name, metric, value, severity)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions import text as tx
from broadsheet.operators.clean import low_quality
from broadsheet.operators.relational import union_results
from broadsheet.plans.sized import with_scalars

REPORT = ["check_name", "metric", "value", "severity"]


def _long(wide: DataFrame, check: str, severity: Mapping[str, Column] | None = None) -> DataFrame:
    """One row of numbers to report rows; severity may depend on the other numbers of the row."""
    severity = severity or {}
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"),
                              severity.get(c, F.lit("info")).alias("severity")) for c in wide.columns])
    return wide.select(F.lit(check).alias("check_name"), F.explode(rows).alias("r")).select("check_name", "r.*")


def flag(condition: Column, level: str) -> Column:
    return F.when(condition, level).otherwise("info")


def check_structure(df: DataFrame, required: Sequence[str] = ("text", "category")) -> DataFrame:
    """Empty table, missing columns, columns that are not text. Reads at most one row."""
    types = dict(df.dtypes)
    rows = [("structure", "empty", float(df.isEmpty()), "issue" if df.isEmpty() else "info")]
    for c in required:
        rows.append(("structure", f"missing:{c}", float(c not in types), "issue" if c not in types else "info"))
        if c in types:
            other = types[c] != "string"
            rows.append(("structure", f"not_text:{c}", float(other), "warning" if other else "info"))
    return df.sparkSession.createDataFrame(rows, "check_name string, metric string, value double, severity string")


def check_text(df: DataFrame, text_col: str = "text", short: int = 50, long: int = 50_000) -> DataFrame:
    n = F.length(text_col)
    wide = df.where(F.col(text_col).isNotNull()).agg(
        F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.avg(n).alias("mean_length"),
        F.percentile(n, 0.5).alias("median_length"),  # whole numbers: one counter per distinct length
        F.stddev_samp(n).alias("std_length"), F.count_if(~F.col(text_col).rlike(r"\S")).alias("empty"),
        F.count_if(n < short).alias("too_short"), F.count_if(n > long).alias("too_long"),
        F.count_if(low_quality(text_col)).alias("low_quality"))
    return _long(wide, "text", {"empty": flag(F.col("empty") > 0, "issue"), "too_short": flag(F.col("too_short") > 0, "warning"),
                                "too_long": flag(F.col("too_long") > 0, "warning"), "low_quality": flag(F.col("low_quality") > 0, "warning")})


def check_categories(df: DataFrame, category_col: str = "category", min_rows: int = 10, max_imbalance: float = 10) -> DataFrame:
    raw = df.where(F.col(category_col).isNotNull()).groupBy(F.col(category_col).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    wide = raw.agg(F.count(F.lit(1)).alias("categories"), F.max("n").alias("largest"), F.min("n").alias("smallest"),
                   (F.max("n") / F.min("n")).alias("imbalance"), F.count_if(F.col("n") < min_rows).alias("below_minimum"),
                   (F.count(F.lit(1)) - F.count_distinct(F.lower(tx.strip("c")))).alias("spelling_variants"),
                   F.count_if(F.col("c").rlike(r"^\d+$")).alias("numeric_names"))
    return _long(wide, "category", {
        "imbalance": flag(F.col("imbalance") > max_imbalance, "warning"), "below_minimum": flag(F.col("below_minimum") > 0, "warning"),
        "spelling_variants": flag(F.col("spelling_variants") > 0, "warning"), "numeric_names": flag(F.col("numeric_names") > 0, "warning")})


def check_missing(df: DataFrame, warn_above: float = 0.1) -> DataFrame:
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"),
                              flag(F.col(c) > F.col("_rows") * warn_above, "warning").alias("severity")) for c in df.columns])
    return wide.select(F.lit("missing").alias("check_name"), F.explode(rows).alias("r")).select("check_name", "r.*")


def check_duplicates(df: DataFrame, text_col: str = "text", prefix: int = 100) -> DataFrame:
    """Exact and prefix duplicates. Null counts as one more value."""
    exact = df.groupBy(F.sha2(text_col, 256).alias("k"), F.sha2(F.substring(text_col, 1, prefix), 256).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    by_prefix = exact.groupBy("p").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    wide = by_prefix.agg((F.sum("n") - F.sum("texts")).alias("exact"), (F.sum("n") - F.count(F.lit(1))).alias("prefix")).withColumn(
        "prefix_only", F.col("prefix") - F.col("exact"))
    return _long(wide, "duplicates", {"exact": flag(F.col("exact") > 0, "warning"), "prefix_only": flag(F.col("prefix_only") > 0, "warning")})


def check_distribution(df: DataFrame, category_col: str = "category") -> DataFrame:
    """Balance of the categories. Equal counts are merged first, so the running sum sees one row per distinct count."""
    counts = df.where(F.col(category_col).isNotNull()).groupBy(category_col).agg(F.count(F.lit(1)).alias("n"))
    merged = counts.groupBy("n").agg(F.count(F.lit(1)).alias("g"))
    before = F.coalesce(F.sum(F.col("n") * F.col("g")).over(Window.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cum = merged.withColumn("_c", F.col("g") * before + F.col("n") * F.col("g") * (F.col("g") + 1) / 2)
    k, total = F.sum("g"), F.sum(F.col("n") * F.col("g"))
    gini = cum.agg(((k + 1 - 2 * F.sum("_c") / total) / k).alias("gini"))
    wide = with_scalars(counts.agg(F.avg("n").alias("mean"), F.stddev_samp("n").alias("std")), gini).withColumn(
        "cv", F.when(F.col("mean") > 0, F.coalesce("std", F.lit(0.0)) / F.col("mean")).otherwise(0.0))
    return _long(wide.select("mean", "std", "cv", "gini"), "distribution", {
        "cv": F.when(F.col("cv") > 1.0, "severe").when(F.col("cv") > 0.5, "moderate").otherwise("info")})


def check_quality_metrics(df: DataFrame, text_col: str = "text") -> DataFrame:
    w = tx.words(text_col)
    pieces = F.size(tx.dot_pieces(text_col))
    d = df.where(F.col(text_col).isNotNull()).select(F.size(w).alias("w"), pieces.alias("s"), tx.vocab_diversity(text_col).alias("d"))
    wide = d.agg(F.avg("w").alias("mean_words"), F.avg("s").alias("mean_sentences"), F.avg("d").alias("mean_diversity"),
                 F.count_if(F.col("s") < 3).alias("few_sentences"), F.count_if(F.col("d") < 0.3).alias("low_diversity"))
    return _long(wide, "quality", {"few_sentences": flag(F.col("few_sentences") > 0, "warning"),
                                   "low_diversity": flag(F.col("low_diversity") > 0, "warning")})


def check_language(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", profiles: Mapping[str, Sequence[str]] | None = None,
                   expected: str = "en", sample_n: int | None = None) -> DataFrame:
    """Detected languages of texts longer than 10 characters: the whole table, or a seeded sample of sample_n."""
    from broadsheet.operators.lang import detect_language
    from broadsheet.operators.relational import hash_sample
    long_enough = df.where(F.length(text_col) > 10)
    if sample_n:
        long_enough = hash_sample(long_enough, id_col, sample_n)
    counts = detect_language(long_enough, text_col, profiles).groupBy("language").agg(F.count(F.lit(1)).alias("n"))
    stats = counts.agg(F.count(F.lit(1)).alias("_k"), F.max_by("language", F.struct("n", "language")).alias("_primary"))
    out = with_scalars(counts, stats)
    mixed = F.when((F.col("_k") > 1) | (F.col("_primary") != expected), "warning").otherwise("info")
    return out.select(F.lit("language").alias("check_name"), F.col("language").alias("metric"), F.col("n").cast("double").alias("value"), mixed.alias("severity"))


def validate_dataset(df: DataFrame, text_col: str = "text", category_col: str = "category", id_col: str = "doc_id", min_rows: int = 10,
                     profiles: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """All checks and a summary: issues, warnings, valid (1 when no issue)."""
    report = union_results(
        check_structure(df, [text_col, category_col]), check_text(df, text_col), check_categories(df, category_col, min_rows),
        check_missing(df), check_duplicates(df, text_col), check_distribution(df, category_col), check_quality_metrics(df, text_col),
        check_language(df, text_col, id_col, profiles))
    summary = report.agg(F.count_if(F.col("severity") == "issue").alias("issues"),
                         F.count_if(F.col("severity").isin("warning", "moderate", "severe")).alias("warnings")).withColumn("valid", (F.col("issues") == 0).cast("int"))
    return report.unionByName(_long(summary, "summary"))


ADVICE = {
    ("text", "empty"): "Remove or fill empty texts", ("text", "too_short"): "Review very short texts",
    ("text", "too_long"): "Review very long texts", ("text", "low_quality"): "Review texts with few letters",
    ("category", "imbalance"): "Balance the categories", ("category", "below_minimum"): "Merge or drop rare categories",
    ("category", "spelling_variants"): "Normalise category names", ("duplicates", "exact"): "Remove duplicate texts",
    ("duplicates", "prefix_only"): "Review near duplicates", ("distribution", "cv"): "Collect more rows for small categories",
    ("quality", "few_sentences"): "Prefer articles of several sentences", ("quality", "low_diversity"): "Review repetitive texts",
}


def recommendations(report: DataFrame) -> DataFrame:
    out = F.lit(None).cast("string")
    for (check, metric), text in ADVICE.items():
        out = F.when((F.col("check_name") == check) & (F.col("metric") == metric), text).otherwise(out)
    return report.where(F.col("severity") != "info").withColumn("recommendation", out).where(F.col("recommendation").isNotNull())
