"""Joins, aggregates, trend statistics, frames, top-k, set operations and sampling."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions.stats import student_two_sided
from broadsheet.functions.text import banded, ratio
from broadsheet.plans.ordered import cumulative, percentiles, previous, rolling, with_position
from broadsheet.plans.sized import attach, fits, salt, with_scalars
from broadsheet.session import written



def count_all() -> Column:
    return F.count(F.lit(1))


# ---- joins ---------------------------------------------------------------------------------------------------

def attach_results(df: DataFrame, results: DataFrame, id_col: str) -> DataFrame:
    return df.join(results, id_col, "inner")


def attach_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    return attach(df, lookup, on, spread_by, "left")


def keep_frequent(df: DataFrame, col: str, min_rows: int) -> DataFrame:
    """Rows whose value occurs at least min_rows times."""
    valid = df.groupBy(col).agg(count_all().alias("_n")).where(F.col("_n") >= min_rows).select(col)
    spread = [c for c in df.columns if c != col] or [col]
    return attach(df, valid, [col], spread, "left_semi")


def exclude_seen(df: DataFrame, seen: DataFrame, text_col: str, n_wanted: int, key_len: int = 50) -> DataFrame:
    """Rows whose first key_len characters were not shown yet; all rows when fewer than n_wanted would be left."""
    key = F.sha2(F.substring(text_col, 1, key_len), 256)
    shown = seen.select(F.sha2(F.substring(text_col, 1, key_len), 256).alias("_key")).distinct()
    flagged = df.withColumn("_key", key).join(shown.withColumn("_seen", F.lit(True)), "_key", "left")
    left = flagged.agg(F.count_if(F.col("_seen").isNull()).alias("_left"))
    return with_scalars(flagged, left).where(F.col("_seen").isNull() | (F.col("_left") < n_wanted)).drop(
        "_key", "_seen", "_left")


def entity_pairs(mentions: DataFrame, left_labels: Sequence[str], right_labels: Sequence[str], max_dist: int,
                 doc_col: str = "doc_id") -> DataFrame:
    """Mention pairs of one document whose starts are closer than max_dist.

    The band is an equi-join on start // max_dist, each left mention looking at three cells, so a document
    with very many mentions compares neighbours only.
    """
    cell = F.floor(F.col("start") / max_dist)
    left = mentions.where(F.col("label").isin(list(left_labels))).select(
        doc_col, *[F.col(c).alias(f"left_{c}") for c in ("text", "label", "start", "end")],
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"))
    right = mentions.where(F.col("label").isin(list(right_labels))).select(
        doc_col, *[F.col(c).alias(f"right_{c}") for c in ("text", "label", "start", "end")], cell.alias("_cell"))
    return (left.join(right, [doc_col, "_cell"])
            .withColumn("distance", F.abs(F.col("left_start") - F.col("right_start")))
            .where(F.col("distance") < max_dist).drop("_cell"))


def group_pairs(agg: DataFrame, key: str) -> DataFrame:
    """All unordered pairs of an aggregate with one row per key; columns end in _1 and _2."""
    a = agg.select(*[F.col(c).alias(f"{c}_1") for c in agg.columns])
    b = agg.select(*[F.col(c).alias(f"{c}_2") for c in agg.columns])
    return a.join(b, F.col(f"{key}_1") < F.col(f"{key}_2"))


def common_neighbors(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Nodes that both ends of a pair point to. pairs: a, b."""
    e = edges.select("src", "dst").distinct()
    left = pairs.join(e.select(F.col("src").alias("a"), F.col("dst").alias("node")), "a")
    return left.join(e.select(F.col("src").alias("b"), F.col("dst").alias("node")), ["b", "node"]).select("a", "b", "node")


# ---- aggregates ----------------------------------------------------------------------------------------------

def category_counts(df: DataFrame, col: str) -> DataFrame:
    counts = df.groupBy(col).agg(count_all().alias("count"))
    total = counts.agg(F.sum("count").alias("_total"), F.max("count").alias("_max"), F.min("count").alias("_min"))
    return with_scalars(counts, total).select(
        col, "count", (F.col("count") * 100.0 / F.col("_total")).alias("percentage"),
        (F.col("count") == F.col("_max")).alias("most_common"), (F.col("count") == F.col("_min")).alias("least_common"))


def length_stats(df: DataFrame, text_col: str, by: Sequence[str] = ()) -> DataFrame:
    n = F.length(text_col)
    # lengths are whole numbers: the exact median keeps one counter per distinct length, not per row
    return df.groupBy(*by).agg(F.avg(n).alias("mean"), F.percentile(n, 0.5).alias("median"), F.min(n).alias("min"),
                               F.max(n).alias("max"), F.stddev_samp(n).alias("std"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def accuracy_by(df: DataFrame, key: str, truth: str, pred: str) -> DataFrame:
    return df.groupBy(key).agg(count_all().alias("rows"), F.avg((F.col(truth) == F.col(pred)).cast("int")).alias("accuracy"))


def period_shares(df: DataFrame, period: Column, topic_col: str) -> DataFrame:
    """Long table period, topic, count, share with a zero row for every topic of every period."""
    counts = df.withColumn("period", period).groupBy("period", topic_col).agg(count_all().alias("count"))
    totals = counts.groupBy("period").agg(F.sum("count").alias("_total"))
    topics = counts.select(topic_col).distinct()
    if not fits(topics):
        raise ValueError(f"{topic_col} has too many values for a zero-filled table")
    grid = totals.withColumn("_g", F.lit(1)).join(F.broadcast(topics.withColumn("_g", F.lit(1))), "_g").drop("_g")
    return grid.join(counts, ["period", topic_col], "left").select(
        "period", F.col(topic_col).alias("topic"), F.coalesce("count", F.lit(0)).alias("count"),
        (F.coalesce("count", F.lit(0)) / F.col("_total")).alias("share"))


def period_table(df: DataFrame, period: Column, topic_col: str, topics: Sequence) -> DataFrame:
    """The same shares as a wide table, one column per topic value."""
    wide = df.withColumn("period", period).groupBy("period").pivot(topic_col, list(topics)).count().na.fill(0)
    total = sum((F.col(str(t)) for t in topics), F.lit(0))
    return wide.select("period", *[(F.col(str(t)) / total).alias(str(t)) for t in topics])


def concentration(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Herfindahl index with its class, entropy in nats and bits, number of values."""
    by = list(by)
    counts = df.groupBy(*by, key).agg(count_all().alias("_c"))
    totals = counts.groupBy(*by).agg(F.sum("_c").alias("_t"))
    shares = (counts.join(totals, by) if by else with_scalars(counts, totals)).withColumn("_p", F.col("_c") / F.col("_t"))
    return shares.groupBy(*by).agg(
        F.sum(F.col("_p") * F.col("_p")).alias("hhi"), (-F.sum(F.col("_p") * F.ln("_p"))).alias("entropy_nats"),
        (-F.sum(F.col("_p") * F.log2("_p"))).alias("entropy_bits"), count_all().alias("values"),
    ).withColumn("concentration", F.when(F.col("hhi") > 0.5, "highly_concentrated")
                 .when(F.col("hhi") > 0.25, "moderately_concentrated").otherwise("diverse"))


def entity_rollup(mentions: DataFrame, top_k: int = 10) -> DataFrame:
    """Per label: mentions, distinct texts, and the most frequent texts with their rank."""
    texts = mentions.groupBy("label", "text").agg(count_all().alias("count"))
    labels = texts.groupBy("label").agg(F.sum("count").alias("mentions"), count_all().alias("unique"))
    return top_k_per_group(texts, ["label"], "count", top_k, "text").join(labels, "label")


#: Pairs of names that a task holds at once, and names that are broadcast with their codes.
PAIRS, CODED_NAMES = 1 << 22, 200_000


def entity_cooccurrence(mentions: DataFrame, min_weight: int = 2, doc_col: str = "doc_id") -> DataFrame:
    """Pairs of distinct entities named in the same document, with the number of such documents.

    A pair cannot reach min_weight unless both entities are in that many documents, so rarer ones leave first. The others get codes in
    their order; each document is one row of codes, whose pairs are made and counted in blocks inside the tasks.
    """
    names = written(mentions.select(doc_col, F.col("text").alias("entity")).where(F.col(doc_col).isNotNull() & F.col("text").isNotNull()).distinct())
    common = names.groupBy("entity").agg(count_all().alias("_n")).where(F.col("_n") >= min_weight)
    codes = written(common.orderBy("entity").select("entity", F.monotonically_increasing_id().alias("code")))
    docs = attach(names, codes, ["entity"], [doc_col], max_rows=CODED_NAMES).groupBy(doc_col).agg(F.sort_array(F.collect_list("code")).alias("codes"))
    most = PAIRS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            known, code = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            later = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(code)) - 1  # names of the document that follow
            upto = np.cumsum(later)
            first = done = 0
            while first < len(code):
                last = max(first + 1, int(np.searchsorted(upto, done + most, "right")))
                n = later[first:last]
                left = np.repeat(np.arange(first, last), n)
                right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
                key, weight = np.unique(code[left] * len(known) + code[right], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(known[key // len(known)]), pa.array(known[key % len(known)]), pa.array(weight.astype(np.int64))], names=["code_1", "code_2", "weight"])
                first, done = last, int(upto[last - 1])

    weights = docs.select("codes").mapInArrow(count, "code_1 bigint, code_2 bigint, weight bigint").groupBy("code_1", "code_2").agg(F.sum("weight").alias("weight")).where(F.col("weight") >= min_weight)
    for k, other in ((1, "code_2"), (2, "entity_1")):
        weights = attach(weights, codes.select(F.col("code").alias(f"code_{k}"), F.col("entity").alias(f"entity_{k}")), [f"code_{k}"], [other], max_rows=CODED_NAMES)
    return weights.select("entity_1", "entity_2", "weight")


# ---- statistics ----------------------------------------------------------------------------------------------

def score_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(a, b).alias("correlation"), count_all().alias("rows"))


def direction(slope: Column, thr: float) -> Column:
    return F.when(slope > thr, "increasing").when(slope < -thr, "decreasing").otherwise("stable")


def linear_trend(df: DataFrame, order: Sequence[str], y: str, by: Sequence[str] = (), thr: float = 0.001) -> DataFrame:
    """Least-squares trend over the ordinal position of each row, with the t statistic of the slope."""
    x = F.col("position").cast("double")
    return (with_position(df.where(F.col(y).isNotNull()), order, by).groupBy(*by).agg(
        count_all().alias("rows"), F.regr_slope(F.col(y), x).alias("slope"), F.regr_r2(F.col(y), x).alias("r2"),
        F.stddev_samp(y).alias("volatility"), F.avg(y).alias("mean"), F.min_by(y, "position").alias("first"),
        F.max_by(y, "position").alias("last"), F.max(y).alias("max"), F.min(y).alias("min"))
        .withColumn("t_stat", F.when((F.col("r2") < 1) & (F.col("rows") > 2),
                                     F.signum("slope") * F.sqrt(F.col("r2") * (F.col("rows") - 2) / (1 - F.col("r2")))))
        .withColumn("direction", direction(F.col("slope"), thr)))


def with_p_value(trends: DataFrame) -> DataFrame:
    """Two-sided p-value of the slope, from t_stat and rows. One row per series goes through Arrow."""
    @F.pandas_udf("double")
    def p(t: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([student_two_sided(a, b - 2) for a, b in zip(t, n)])

    return trends.withColumn("p_value", p(F.col("t_stat"), F.col("rows").cast("double")))


def _ordinal(shares: DataFrame) -> DataFrame:
    """Number the periods 0.. ; the table holds one row per topic and period, never raw rows."""
    periods = shares.select("period").distinct().withColumn("x", F.row_number().over(Window.orderBy("period")) - 1)
    return shares.join(F.broadcast(periods), "period")


def topic_evolution_stats(shares: DataFrame) -> DataFrame:
    return (_ordinal(shares).groupBy("topic").agg(
        F.regr_slope("share", F.col("x").cast("double")).alias("slope"), F.stddev_pop("share").alias("volatility"),
        F.min_by("share", "x").alias("_first"), F.max_by("share", "x").alias("_last"), F.avg("share").alias("mean"),
        F.max("share").alias("max"), F.min("share").alias("min"))
        .withColumn("growth", F.when(F.col("_first") > 0, (F.col("_last") - F.col("_first")) / F.col("_first")).otherwise(0.0))
        .drop("_first", "_last"))


def emerging_declining(shares: DataFrame, thr: float = 0.05, min_periods: int = 3) -> DataFrame:
    """Topics whose mean share moved by more than thr between the two halves of the periods."""
    n = shares.agg(F.count_distinct("period").alias("_n"))
    placed = with_scalars(_ordinal(shares), n).where(F.col("_n") >= min_periods)
    half = F.floor(F.col("_n") / 2)
    halves = placed.groupBy("topic").agg(F.avg(F.when(F.col("x") < half, F.col("share"))).alias("first_half"),
                                         F.avg(F.when(F.col("x") >= half, F.col("share"))).alias("second_half"))
    change = F.col("second_half") - F.col("first_half")
    return halves.withColumn("change", change).withColumn(
        "trend", F.when(change > thr, "emerging").when(change < -thr, "declining").otherwise("stable"))


def classify_window_trends(window_topics: DataFrame, slope_thr: float = 0.01, mean_thr: float = 0.05,
                           std_thr: float = 0.02) -> DataFrame:
    """window_topics: window_id, topic, p. Label each topic emerging, declining, stable or other."""
    s = window_topics.groupBy("topic").agg(F.regr_slope("p", F.col("window_id").cast("double")).alias("slope"),
                                           F.avg("p").alias("mean"), F.stddev_pop("p").alias("std"))
    label = (F.when((F.col("slope") > slope_thr), "emerging").when(F.col("slope") < -slope_thr, "declining")
             .when((F.col("mean") > mean_thr) & (F.col("std") < std_thr), "stable").otherwise("other"))
    return s.withColumn("trend", label).withColumn("strength", F.abs("slope") / (F.col("std") + 1e-6))


def topic_stability(shares: DataFrame) -> DataFrame:
    w = Window.partitionBy("topic").orderBy("x")  # one row per period
    d = _ordinal(shares).withColumn("_d", F.abs(F.col("share") - F.lag("share").over(w)))
    return (d.groupBy("topic").agg(
        ratio(F.stddev_pop("share"), F.avg("share")).alias("cv"), F.avg((F.col("share") > 0).cast("int")).alias("presence"),
        (1 - F.coalesce(F.avg("_d"), F.lit(0.0))).alias("persistence"))
        .withColumn("stability", (F.col("presence") + F.col("persistence")) / 2))


def window_correlations(window_topics: DataFrame) -> DataFrame:
    """Correlation of the topic shares of every pair of windows."""
    a = window_topics.select(F.col("window_id").alias("window_1"), "topic", F.col("p").alias("_p1"))
    b = window_topics.select(F.col("window_id").alias("window_2"), "topic", F.col("p").alias("_p2"))
    return (a.join(b, "topic").where(F.col("window_1") < F.col("window_2")).groupBy("window_1", "window_2")
            .agg(F.corr("_p1", "_p2").alias("correlation"))
            .withColumn("consecutive", F.col("window_2") == F.col("window_1") + 1))


def series_trend(series: DataFrame, x: str, y: str, thr: float = 0.01) -> DataFrame:
    """Slope of an aggregated series and its label."""
    return series.agg(F.regr_slope(F.col(y), F.col(x).cast("double")).alias("slope"), F.avg(y).alias("mean"),
                      F.stddev_pop(y).alias("std")).withColumn("trend", direction(F.col("slope"), thr))


def sentiment_anomalies(df: DataFrame, order: Sequence[str], y: str, z: float = 2.5, jump: float = 0.5) -> DataFrame:
    """Outliers by z-score and sudden changes to the row before, in one list."""
    stats = df.agg(F.avg(y).alias("_mean"), F.stddev_samp(y).alias("_std"))
    score = F.when(F.col("_std") > 0, (F.col(y) - F.col("_mean")) / F.col("_std")).otherwise(0.0)
    outliers = with_scalars(df, stats).withColumn("measure", score).where(F.abs("measure") > z).select(
        *order, y, "measure", F.lit("outlier").alias("kind"))
    shifts = (previous(df, order, y).withColumn("measure", F.col(y) - F.col("previous"))
              .where(F.abs("measure") > jump).select(*order, y, "measure", F.lit("shift").alias("kind")))
    return outliers.unionByName(shifts)


def chi2_features(long_df: DataFrame, labels: DataFrame, id_col: str, label_col: str, top_k: int = 20) -> DataFrame:
    """Chi-square of every term against the labels, highest first. long_df: id, term, value.

    Summed over all labels, absent ones included, it reduces to sum(o^2 / e) - total of the present ones.
    """
    known = labels.select(id_col, label_col)
    n = known.agg(count_all().alias("_n"))
    shares = with_scalars(known.groupBy(label_col).agg(count_all().alias("_c")), n).select(
        label_col, (F.col("_c") / F.col("_n")).alias("_share"))
    observed = long_df.join(known, id_col).groupBy("term", label_col).agg(F.sum("value").alias("_o"))
    joined = attach(observed, shares, [label_col], ["term"])
    per = joined.groupBy("term").agg(F.sum("_o").alias("total"),
                                     F.sum(F.col("_o") * F.col("_o") / F.col("_share")).alias("_s"))
    scored = per.select("term", "total", (F.col("_s") / F.col("total") - F.col("total")).alias("chi2"))
    return scored.orderBy(F.round("chi2", 6).desc(), "term").limit(top_k)


GRADES = [(0.8, "excellent"), (0.6, "good"), (0.4, "fair")]
CONFIDENCE = [(0.8, "high"), (0.6, "medium"), (0.4, "low")]


def grade(score: Column) -> Column:
    return banded(score, GRADES, "poor")


def confidence_band(score: Column) -> Column:
    return banded(score, CONFIDENCE, "very_low")


# ---- windows, sorts, sets, samples ---------------------------------------------------------------------------

def top_classes(probabilities: Column, labels: Sequence[str], k: int = 3) -> Column:
    """Array of the k best (probability, class) of one row."""
    names = F.array(*[F.lit(x) for x in labels])
    pairs = F.zip_with(probabilities, names, lambda p, c: F.struct(p.alias("probability"), c.alias("class")))
    return F.slice(F.sort_array(pairs, asc=False), 1, k)


def top_k_per_group(df: DataFrame, by: Sequence[str], score: str | Column, k: int, id_col: str,
                    salts: int = 64) -> DataFrame:
    """Best k rows per group, ties by id, with their rank.

    Ranked first inside salted sub-groups, so that a group with a third of all rows is cut in parallel.
    """
    score = F.col(score) if isinstance(score, str) else score
    parts = df.withColumn("_score", score).withColumn("_salt", salt([id_col], salts))
    order = [F.col("_score").desc(), F.col(id_col).asc()]
    inner = Window.partitionBy(*by, "_salt").orderBy(*order)
    outer = Window.partitionBy(*by).orderBy(*order)
    cut = parts.withColumn("rank", F.row_number().over(inner)).where(F.col("rank") <= k)
    return cut.withColumn("rank", F.row_number().over(outer)).where(F.col("rank") <= k).drop("_salt", "_score")


def diff_previous(df: DataFrame, order: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    return previous(df, order, y, by).withColumn("diff", F.col(y) - F.col("previous")).drop("position", "previous")


def first_last(df: DataFrame, order: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    key = F.struct(*order)
    return df.groupBy(*by).agg(F.min_by(y, key).alias("first"), F.max_by(y, key).alias("last"))


def moving_average(df: DataFrame, order: Sequence[str], y: str, rows: int, by: Sequence[str] = (),
                   out: str | None = None) -> DataFrame:
    return rolling(df, order, rows, {out or f"ma_{rows}": lambda w: F.avg(y).over(w)}, by).drop("position")


def spike_flags(df: DataFrame, order: Sequence[str], label: str, by: Sequence[str] = (), last: int = 10,
                share: float = 0.8) -> DataFrame:
    """Positive or negative spike when at least `share` of the last rows carry that label."""
    def of(value: str):
        return lambda w: F.avg((F.col(label) == value).cast("double")).over(w)
    out = rolling(df, order, last, {"_n": lambda w: count_all().over(w), "_pos": of("positive"), "_neg": of("negative")}, by)
    full = F.col("_n") == last
    return out.withColumn("spike", F.when(full & (F.col("_pos") >= share), "positive_spike")
                          .when(full & (F.col("_neg") >= share), "negative_spike")).drop("_n", "_pos", "_neg", "position")


def rolling_std(df: DataFrame, order: Sequence[str], y: str, rows: int = 3, by: Sequence[str] = ()) -> DataFrame:
    return rolling(df, order, rows, {"rolling_std": lambda w: F.when(count_all().over(w) == rows, F.stddev_pop(y).over(w))},
                   by).drop("position")


def metric_anomalies(df: DataFrame, order: Sequence[str], y: str, by: Sequence[str] = (), last: int = 100, k: float = 2,
                     min_std: float = 5) -> DataFrame:
    """Rows outside mean +- k std of the last `last` rows (the row itself included), where std exceeds min_std."""
    out = rolling(df, order, last, {"mean": lambda w: F.avg(y).over(w), "std": lambda w: F.stddev_pop(y).over(w)}, by)
    return out.where((F.col("std") > min_std) & (F.abs(F.col(y) - F.col("mean")) > k * F.col("std"))).drop("position")


def cumulative_sum(df: DataFrame, order: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    return cumulative(df, order, y, by).drop("position")


def top_n(df: DataFrame, score: str | Column, n: int, id_col: str) -> DataFrame:
    score = F.col(score) if isinstance(score, str) else score
    return df.orderBy(score.desc(), id_col).limit(n)


def sort_results(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*keys)


def first_n(df: DataFrame, id_col: str, n: int) -> DataFrame:
    return df.orderBy(id_col).limit(n)


def most_recent(df: DataFrame, ts_col: str, n: int, id_col: str) -> DataFrame:
    return df.orderBy(F.col(ts_col).desc(), F.col(id_col).desc()).limit(n)


def diversify(df: DataFrame, category_col: str, score: str, id_col: str, keep: int = 3) -> DataFrame:
    """In score order, the first `keep` rows and after them only the first row of each new category."""
    top = df.orderBy(F.col(score).desc(), id_col).limit(keep)
    best = df.groupBy(category_col).agg(
        F.min_by(id_col, F.struct(-F.col(score), F.col(id_col))).alias(id_col)).select(id_col)
    chosen = top.select(id_col).union(best).distinct()
    return df.join(chosen, id_col, "left_semi")


def jaccard(a: Column, b: Column) -> Column:
    return ratio(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def overlap_ratio(a: Column, b: Column) -> Column:
    return ratio(F.size(F.array_intersect(a, b)), F.size(F.array_distinct(a)))


def query_relevance(query_tokens: Column, doc_tokens: Column) -> Column:
    return overlap_ratio(query_tokens, doc_tokens)


def category_diff(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    left = a.select(col).distinct()
    right = b.select(col).distinct()
    return left.subtract(right).withColumn("side", F.lit("only_first")).unionByName(
        right.subtract(left).withColumn("side", F.lit("only_second")))


def union_results(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def union_distinct(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """Rows of a, and the rows of b whose id a does not have."""
    return a.unionByName(b.join(a.select(id_col), id_col, "left_anti"))


def hash_order(id_col: str, seed: int) -> list[Column]:
    return [seeded_hash(id_col, seed), F.col(id_col)]


def seeded_hash(id_col: str, seed: int) -> Column:
    """MD5 of seed and id: an order that any SQL engine can repeat."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """n rows chosen by a seeded hash of the id: the same rows under any partitioning."""
    return df.orderBy(*hash_order(id_col, seed)).limit(n)


def stratified_split(df: DataFrame, label: str, id_col: str, frac: float = 0.8, seed: int = 42) -> DataFrame:
    """Add `split` = train or validation with the exact share in every label."""
    placed = with_position(df.withColumn("_h", seeded_hash(id_col, seed)), ["_h", id_col], [label])
    sizes = df.groupBy(label).agg(count_all().alias("_n"))
    joined = attach(placed, sizes, [label], [id_col])
    return joined.withColumn("split", F.when(F.col("position") < F.round(F.col("_n") * frac), "train")
                             .otherwise("validation")).drop("_h", "position", "_n")


def sample_unseen(df: DataFrame, seen: DataFrame, text_col: str, id_col: str, n: int, seed: int = 42) -> DataFrame:
    return hash_sample(exclude_seen(df, seen, text_col, n), id_col, n, seed)


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels in order with their index. Labels are a closed set, so the window sees few rows."""
    return df.where(F.col(label).isNotNull()).select(label).distinct().withColumn(
        "label_id", F.row_number().over(Window.orderBy(label)) - 1)

