"""Projections, filters and deduplication of article tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from broadsheet.functions import text as tx
from broadsheet.operators.relational import keep_frequent
from broadsheet.plans.sized import attach
from broadsheet.session import materialize


def require(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; table has {df.columns}")


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    require(df, *cols)
    return df.na.drop(subset=list(cols))


def filter_length(df: DataFrame, col: str, lo: int = 50, hi: int = 10_000) -> DataFrame:
    return df.where(F.length(col).between(lo, hi))


def alpha_ratio(col: str | Column) -> Column:
    c = tx.col(col)
    return F.length(F.regexp_replace(c, r"[^\p{L}\s]", "")).cast("double") / F.length(c)


def filter_alpha_ratio(df: DataFrame, col: str, share: float = 0.7) -> DataFrame:
    return df.where((F.length(col) > 0) & (alpha_ratio(col) >= share))


def keep_first(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """One row per key value, the one with the lowest id (ids must be unique).

    The aggregate combines on the map side, so a text copied into a third of all rows reaches its reducer
    as one row per task; the second step joins on the id, which has no hot values.
    """
    firsts = df.groupBy(F.sha2(key, 256).alias("_key")).agg(F.min(id_col).alias(id_col)).select(id_col)
    return df.join(firsts, id_col, "left_semi")


def dedup_exact(df: DataFrame, col: str, id_col: str) -> DataFrame:
    return keep_first(df, F.col(col), id_col)


def dedup_prefix(df: DataFrame, col: str, id_col: str, n: int = 100) -> DataFrame:
    return keep_first(df, F.substring(col, 1, n), id_col)


def normalize_category(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.lower(tx.strip(col)))


def low_quality(col: str) -> Column:
    n = F.length(col)
    digits = F.regexp_count(F.col(col), F.lit(r"\p{Nd}"))
    letters = F.regexp_count(F.col(col), F.lit(r"\p{L}"))
    return F.coalesce((n > 0) & ((digits > n * 0.5) | (letters < n * 0.3)), F.lit(False))


def flag_low_quality(df: DataFrame, col: str, out: str = "low_quality") -> DataFrame:
    return df.withColumn(out, low_quality(col))


def filter_min_words(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    return df.where(F.size(tx.words(col)) >= n)


def apply_filters(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """Scalar = equality, list = membership; a column the table lacks matches nothing."""
    for name, wanted in filters.items():
        if name not in df.columns:
            return df.where(F.lit(False))
        df = df.where(F.col(name).isin(list(wanted)) if isinstance(wanted, (list, tuple, set)) else F.col(name) == wanted)
    return df


def prepare_dataset(df: DataFrame, text_col: str = "text", category_col: str = "category", id_col: str = "doc_id",
                    min_chars: int = 50, max_chars: int = 10_000, alpha: float = 0.7, min_rows: int = 50,
                    min_categories: int = 4) -> tuple[DataFrame, DataFrame]:
    """Clean article table and the row count after every step.

    Order: exact duplicates, nulls, trim, length, letters, frequent categories.
    """
    require(df, text_col, category_col, id_col)
    firsts = df.groupBy(F.sha2(text_col, 256).alias("_key")).agg(F.min(id_col).alias(id_col)).select(
        id_col, F.lit(True).alias("_first"))
    trimmed = tx.strip(text_col)
    flagged = (
        df.join(firsts, id_col, "left")
        .withColumn("_s1", F.coalesce("_first", F.lit(False)))
        .withColumn("_s2", F.col("_s1") & F.col(text_col).isNotNull() & F.col(category_col).isNotNull())
        .withColumn(text_col, trimmed)
        .withColumn(category_col, F.lower(tx.strip(category_col)))
        .withColumn("_s3", F.col("_s2") & F.coalesce(F.length(text_col).between(min_chars, max_chars), F.lit(False)))
        .withColumn("_s4", F.col("_s3") & F.coalesce(alpha_ratio(text_col) >= alpha, F.lit(False)))
    )
    # only ids, categories and flags are written; the texts are read again for the rows that stay
    flags = materialize(flagged.select(id_col, category_col, "_s1", "_s2", "_s3", "_s4"))
    kept = flags.where("_s4").select(id_col, category_col)
    frequent = kept.groupBy(category_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows)
    if frequent.limit(min_categories).count() < min_categories:
        raise ValueError(f"fewer than {min_categories} categories have {min_rows} rows")
    chosen = attach(kept, frequent.select(category_col), [category_col], [id_col], "left_semi")
    counts = tx.text_counts(text_col)
    clean = df.select(id_col, trimmed.alias(text_col)).join(chosen, id_col).select(
        F.col(id_col).alias("article_id"), text_col, category_col, counts["words"].alias("word_count"),
        counts["chars"].alias("char_count"), counts["sentences"].alias("sentence_count"))
    steps = flags.agg(F.count(F.lit(1)).alias("input"), *[
        F.count_if(F.col(c)).alias(name) for c, name in
        (("_s1", "deduplicated"), ("_s2", "not_null"), ("_s3", "length"), ("_s4", "letters"))])
    last = frequent.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("frequent_categories"))
    wide = steps.join(F.broadcast(last))
    return clean, wide.unpivot([], wide.columns, "step", "rows")


def fix_common_issues(df: DataFrame, text_col: str = "text", category_col: str = "category", id_col: str = "doc_id",
                      min_chars: int = 50, max_chars: int = 50_000, min_rows: int = 10) -> tuple[DataFrame, DataFrame]:
    """Nulls out, duplicates out, length, normal categories, rare categories out; plus rows removed per fix."""
    stages = [("input", df)]
    stages.append(("missing_values", drop_missing(df, [text_col, category_col])))
    stages.append(("duplicates", dedup_exact(stages[-1][1], text_col, id_col)))
    stages.append(("length", filter_length(stages[-1][1], text_col, min_chars, max_chars)))
    normal = normalize_category(stages[-1][1], category_col)
    stages.append(("rare_categories", keep_frequent(normal, category_col, min_rows)))
    counts = None
    for order, (name, stage) in enumerate(stages):
        row = stage.agg(F.lit(order).alias("step"), F.lit(name).alias("fix"), F.count(F.lit(1)).alias("rows"))
        counts = row if counts is None else counts.unionByName(row)
    from pyspark.sql import Window
    removed = F.coalesce(F.lag("rows").over(Window.orderBy("step")) - F.col("rows"), F.lit(0))  # five rows
    return stages[-1][1], counts.withColumn("removed", removed)


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Leaf columns of nested structs, named by their path."""

    def leaves(schema: T.StructType, prefix: str, names: tuple[str, ...]):
        for f in schema.fields:
            path = f"{prefix}`{f.name}`"
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, path + ".", (*names, f.name))
            else:
                yield F.col(path).alias(sep.join((*names, f.name)))

    return df.select(*leaves(df.schema, "", ()))
