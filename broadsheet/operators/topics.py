"""Topic models, their words, quality, trends, evolution and drift."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from broadsheet.functions import temporal as tm
from broadsheet.functions import text as tx
from broadsheet.operators.features import MAX_FEATURES, count_model
from broadsheet.operators.relational import (count_all, direction, emerging_declining, jaccard, period_shares, top_k_per_group,
                                             topic_evolution_stats, topic_stability)
from broadsheet.plans.sized import bounded_rows
from broadsheet.session import materialize, shared_dir


class LdaTopics:
    """Fitted LDA with its vocabulary."""

    def __init__(self, counts: CountVectorizerModel, model: LDAModel, tokens_col: str):
        self.counts, self.model, self.tokens_col = counts, model, tokens_col

    def distributions(self, df: DataFrame) -> DataFrame:
        """df plus `topics`, an array of probabilities."""
        out = self.model.transform(self.counts.transform(df))
        return out.withColumn("topics", vector_to_array("topicDistribution")).drop("topicDistribution", self.counts.getOutputCol())

    def words(self, k: int = 15) -> DataFrame:
        """topic, rank, term, weight: the k x topics table describeTopics gives."""
        names = self.counts.vocabulary
        rows = self.model.describeTopics(k)
        spark = rows.sparkSession
        terms = spark.createDataFrame(list(enumerate(names)), "term_id int, term string")
        long = rows.select(F.col("topic"), F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t"))
        return long.select("topic", (F.col("rank") + 1).alias("rank"), F.col("t.termIndices").alias("term_id"), F.col("t.termWeights").alias("weight")).join(
            F.broadcast(terms), "term_id").select("topic", "rank", "term", "weight")

    def perplexity(self, df: DataFrame) -> float:
        return self.model.logPerplexity(self.counts.transform(df))


def fit_lda(df: DataFrame, tokens_col: str, k: int = 10, iterations: int = 20, seed: int = 42, vocab_size: int = 1000) -> LdaTopics:
    counts = count_model(df, tokens_col, "_counts", vocab_size)
    data = counts.transform(df).select("_counts").cache()
    try:
        model = LDA(k=k, maxIter=iterations, seed=seed, optimizer="online", featuresCol="_counts").fit(data)
    finally:
        data.unpersist()
    return LdaTopics(counts, model, tokens_col)


# ---- factorisations of long TF-IDF tables --------------------------------------------------------------------

def document_rows(weights: DataFrame, id_col: str, documents: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """One row per document (id, term numbers, weights) and the bounded vocabulary.

    With `documents` also those without a term of the vocabulary have a row, an empty one.
    """
    weights = materialize(weights.select(id_col, "term", "tfidf"))
    vocabulary = sorted(r[0] for r in bounded_rows(weights.select("term").distinct(), MAX_FEATURES, "vocabulary"))
    terms = weights.sparkSession.createDataFrame(list(enumerate(vocabulary)), "i int, term string")
    packed = weights.join(F.broadcast(terms), "term").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("i", F.col("tfidf").alias("v")))).alias("_p"))
    rows = packed.select(F.col(id_col).cast("bigint").alias("id"), F.transform("_p", lambda x: x["i"]).alias("i"), F.transform("_p", lambda x: x["v"]).alias("v"))
    if documents is not None:
        nothing = F.array()
        rows = documents.select(F.col(id_col).cast("bigint").alias("id")).distinct().join(rows, "id", "left").select(
            "id", F.coalesce("i", nothing.cast("array<int>")).alias("i"), F.coalesce("v", nothing.cast("array<double>")).alias("v"))
    return rows, vocabulary


def _sum_parts(rows: DataFrame, part, width: int, height: int) -> np.ndarray:
    """Add the (height x width) matrices the partitions return; entries are summed on the cluster."""
    def run(batches):
        total = None
        for b in batches:
            if len(b):
                m = part(b)
                total = m if total is None else total + m
        if total is not None:
            r, c = np.nonzero(total)
            yield pd.DataFrame({"r": r.astype("int32"), "c": c.astype("int32"), "x": total[r, c]})

    sums = rows.mapInPandas(run, "r int, c int, x double").groupBy("r", "c").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros((height, width))
    out[sums["r"], sums["c"]] = sums["x"]
    return out


def _dense(b: pd.DataFrame, n_terms: int) -> np.ndarray:
    a = np.zeros((len(b), n_terms))
    for row, (i, v) in enumerate(zip(b["i"], b["v"])):
        a[row, np.asarray(i, dtype=int)] = v
    return a


def lsa_embeddings(weights: DataFrame, id_col: str, k: int, rounds: int = 6, seed: int = 42, documents: DataFrame | None = None) -> DataFrame:
    """Truncated SVD of the document-term table by subspace iteration. Only the terms x k basis reaches the driver.

    Rows of `documents` without any term get the zero vector.
    """
    rows, vocabulary = document_rows(weights, id_col, documents)
    rows = materialize(rows)
    n = len(vocabulary)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, k)))[0]
    sc = weights.sparkSession.sparkContext
    for _ in range(rounds):
        shared = sc.broadcast(basis)
        product = _sum_parts(rows, lambda b, s=shared: (lambda a: a.T @ (a @ s.value))(_dense(b, n)), k, n)
        basis = np.linalg.qr(product)[0]
    shared = sc.broadcast(basis)

    def project(batches):
        for b in batches:
            if len(b):
                yield pd.DataFrame({"id": b["id"], "embedding": list(_dense(b, n) @ shared.value)})

    return rows.mapInPandas(project, "id bigint, embedding array<double>").withColumnRenamed("id", id_col)


def _loads(a: np.ndarray, h: np.ndarray, steps: int = 30) -> np.ndarray:
    """Document loads for fixed topics by multiplicative updates, started evenly."""
    w = np.full((a.shape[0], h.shape[0]), 1.0 / h.shape[0])
    ah, hh = a @ h.T, h @ h.T
    for _ in range(steps):
        w *= ah / (w @ hh + 1e-12)
    return w


def fit_nmf(weights: DataFrame, id_col: str, k: int = 10, rounds: int = 15, seed: int = 42, words: int = 15,
            documents: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Non-negative factors: (id, topics) with shares summing to 1, and (topic, rank, term, weight).

    Rows of `documents` without any term get even shares.

    Loads are recomputed in every task from the current topics, so the documents-by-topics matrix never
    exists in one place; a round returns the k x (k + terms) sums.
    """
    rows, vocabulary = document_rows(weights, id_col, documents)
    rows = materialize(rows)
    n = len(vocabulary)
    h = _refined(rows, _start(k, n, seed), rounds)
    shared = weights.sparkSession.sparkContext.broadcast(h)

    def assign(batches):
        for b in batches:
            if len(b):
                w = _loads(_dense(b, n), shared.value)
                total = w.sum(axis=1, keepdims=True)
                yield pd.DataFrame({"id": b["id"], "topics": list(np.divide(w, total, out=np.full_like(w, 1.0 / k), where=total > 0))})

    table = weights.sparkSession.createDataFrame(_leading(h, vocabulary, words), "topic int, rank int, term string, weight double")
    return rows.mapInPandas(assign, "id bigint, topics array<double>").withColumnRenamed("id", id_col), table


def _start(k: int, n: int, seed: int) -> np.ndarray:
    return np.abs(np.random.default_rng(seed).normal(scale=0.1, size=(k, n))) + 1e-3


def _refined(rows: DataFrame, h: np.ndarray, rounds: int) -> np.ndarray:
    """Topics after some rounds over the rows; a round returns the k x (k + terms) sums."""
    k, n = h.shape
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(h)

        def part(b, s=shared):
            a = _dense(b, n)
            w = _loads(a, s.value)
            return np.hstack([w.T @ w, w.T @ a])

        sums = _sum_parts(rows, part, k + n, k)
        h = h * sums[:, k:] / (sums[:, :k] @ h + 1e-12)
    return h


def _leading(h: np.ndarray, vocabulary: Sequence[str], words: int) -> list[tuple[int, int, str, float]]:
    return [(t, r + 1, vocabulary[i], float(h[t, i])) for t in range(len(h)) for r, i in enumerate(np.argsort(-h[t], kind="stable")[:words])]


# ---- a model for each window ---------------------------------------------------------------------------------

def best_assignment(gain: np.ndarray) -> np.ndarray:
    """For each row of a square matrix the column it takes, one to one, so that the sum of the gains is the largest.

    Rows enter one by one; each time the cheapest chain of changes is found with prices on rows and columns."""
    n = len(gain)
    cost = gain.max(initial=0) - gain
    row_price, column_price, owner = np.zeros(n), np.zeros(n + 1), np.full(n + 1, -1)
    for row in range(n):
        owner[n], column = row, n
        slack, came, seen = np.full(n, np.inf), np.full(n, n), np.zeros(n + 1, dtype=bool)
        while owner[column] >= 0:
            seen[column] = True
            at = owner[column]
            reduced = cost[at] - row_price[at] - column_price[:n]
            better = ~seen[:n] & (reduced < slack)
            slack[better], came[better] = reduced[better], column
            free = np.where(seen[:n], np.inf, slack)
            nearest = int(free.argmin())
            step = free[nearest]
            row_price[owner[seen]] += step
            column_price[seen] -= step
            slack[~seen[:n]] -= step
            column = nearest
        while column != n:
            owner[column] = owner[came[column]]
            column = came[column]
        owner[n] = -1
    out = np.empty(n, dtype=int)
    out[owner[:n]] = np.arange(n)
    return out


def word_overlap(before: Sequence[set], now: Sequence[set]) -> np.ndarray:
    """Jaccard of the leading words of every pair of topics."""
    return np.array([[len(a & b) / max(1, len(a | b)) for b in now] for a in before])


def aligned(models: Sequence[np.ndarray], top: int = 10) -> list[np.ndarray]:
    """The number that each topic of each window takes: that of the topic of the window before with which it is matched, one to
    one, by the largest sum of overlaps of their `top` words; topics of the first window keep theirs."""
    numbers = [np.arange(len(models[0]))] if models else []
    for before, now in zip(models, models[1:]):
        sets = [[set(np.argsort(-t, kind="stable")[:top].tolist()) for t in m] for m in (before, now)]
        takes = best_assignment(word_overlap(*sets))
        mine = np.empty(len(now), dtype=int)
        mine[takes] = numbers[-1]
        numbers.append(mine)
    return numbers


def window_models(weights: DataFrame, windows: DataFrame, id_col: str, window_col: str = "window_id", k: int = 10, rounds: int = 15, warm_rounds: int = 5, seed: int = 42,
                  words: int = 15, align_words: int = 10) -> tuple[DataFrame, DataFrame]:
    """A factorisation per window: (window_id, topic, rank, term, weight), and (window_id, topic, p, rows) with mean topic shares.

    weights: id, term, tfidf of one bounded vocabulary. windows: id and window, a document in as many windows as it belongs to.
    The first window starts from random topics, each later one from those of the window before, and needs fewer rounds.
    Topics are numbered by the chain of one-to-one matches with the window before (`aligned`), so that a number means the same theme
    throughout. Rows are written by window; a round reads one window and returns sums of the size of the model.
    """
    spark = weights.sparkSession
    rows, vocabulary = document_rows(weights, id_col)
    path = f"{shared_dir(spark).rstrip('/')}/windows-{uuid.uuid4().hex}"
    windows.select(F.col(id_col).cast("bigint").alias("id"), F.col(window_col).cast("bigint").alias("w")).distinct().join(rows, "id").repartition("w", F.pmod(F.xxhash64("id"), F.lit(8))).write.partitionBy("w").parquet(path)
    kept = spark.read.schema("id bigint, i array<int>, v array<double>, w bigint").parquet(path)
    numbers = sorted(r[0] for r in kept.select("w").distinct().collect())  # one per window
    models, shares, h = [], [], _start(k, len(vocabulary), seed)
    for number in numbers:
        own = kept.where(F.col("w") == number)
        if models:  # products never leave zero: terms that the window before lacked get the topic's mean weight
            h = np.maximum(h, h.mean(axis=1, keepdims=True))
        h = _refined(own, h, warm_rounds if models else rounds)
        models.append(h)
        shares.append(_mean_shares(own, h))
    mine = aligned(models, align_words)
    best = [(w, int(new[t]), r, term, x) for w, m, new in zip(numbers, models, mine) for t, r, term, x in _leading(m, vocabulary, words)]
    mean = [(w, int(new[t]), float(p[t]), n) for w, (p, n), new in zip(numbers, shares, mine) for t in range(k)]
    return (spark.createDataFrame(best, "window_id bigint, topic int, rank int, term string, weight double"),
            spark.createDataFrame(mean, "window_id bigint, topic int, p double, rows bigint"))


def _mean_shares(rows: DataFrame, h: np.ndarray) -> tuple[np.ndarray, int]:
    """Mean share of each topic over the rows, and their number."""
    k, n = h.shape
    shared = rows.sparkSession.sparkContext.broadcast(h)

    def part(b):
        w = _loads(_dense(b, n), shared.value)
        total = w.sum(axis=1, keepdims=True)
        share = np.divide(w, total, out=np.full_like(w, 1.0 / k), where=total > 0)
        return np.append(share.sum(axis=0), len(b))[None, :]

    sums = _sum_parts(rows, part, k + 1, 1)[0]
    return sums[:k] / max(1.0, sums[k]), int(sums[k])


# ---- words and quality ---------------------------------------------------------------------------------------

def topic_coherence(words: DataFrame, docs: DataFrame, id_col: str, tokens_col: str, top: int = 10) -> DataFrame:
    """Mean over ordered word pairs (higher ranked first) of docs with both / docs with the first. words: topic, rank, term."""
    best = words.where(F.col("rank") <= top).select("topic", "rank", "term")
    terms = best.select("term").distinct()
    hits = docs.select(id_col, F.explode(F.array_distinct(tokens_col)).alias("term")).join(F.broadcast(terms), "term")
    per_doc = hits.join(F.broadcast(best), "term")
    single = per_doc.groupBy("topic", "rank").agg(count_all().alias("n"))
    inside = per_doc.groupBy(id_col, "topic").agg(F.array_sort(F.collect_list("rank")).alias("ranks"))  # at most `top` entries
    pairs = F.flatten(F.transform("ranks", lambda a: F.transform(F.filter(F.col("ranks"), lambda b: b > a), lambda b: F.struct(a.alias("r1"), b.alias("r2")))))
    both = inside.select("topic", F.inline(pairs)).groupBy("topic", "r1", "r2").agg(count_all().alias("both"))
    a = best.select("topic", F.col("rank").alias("r1"))
    b = best.select("topic", F.col("rank").alias("r2"))
    grid = a.join(b, "topic").where("r1 < r2").join(both, ["topic", "r1", "r2"], "left").join(
        single.select("topic", F.col("rank").alias("r1"), "n"), ["topic", "r1"], "left")
    ratio = F.when(F.col("n") > 0, F.coalesce("both", F.lit(0)) / F.col("n"))
    return grid.groupBy("topic").agg(F.coalesce(F.avg(ratio), F.lit(0.0)).alias("coherence"))


def dominant_topics(dist: DataFrame, topics_col: str = "topics") -> DataFrame:
    top = F.array_max(topics_col)
    return dist.withColumn("topic", (F.array_position(topics_col, top) - 1).cast("int")).withColumn("probability", top)


def topic_quality(dist: DataFrame, k: int, topics_col: str = "topics", used_above: float = 0.1) -> DataFrame:
    """Topics used, mean strongest share, mean correlation of topics, documents covered by a clear topic."""
    d = dominant_topics(dist, topics_col)
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    corr = [F.corr(F.get(topics_col, F.lit(i)), F.get(topics_col, F.lit(j))).alias(f"_c{i}_{j}") for i, j in pairs]
    agg = d.agg(F.count_distinct("topic").alias("_used"), F.avg("probability").alias("mean_max_probability"),
                F.avg((F.col("probability") > used_above).cast("int")).alias("coverage"), *corr)
    mean = F.lit(0.0) if not pairs else sum((F.coalesce(F.col(f"_c{i}_{j}"), F.lit(0.0)) for i, j in pairs), F.lit(0.0)) / len(pairs)
    return agg.select((F.col("_used") / k).alias("topics_used"), "mean_max_probability", mean.alias("mean_correlation"), "coverage")


def assign_topics(dist: DataFrame, id_col: str, words: DataFrame, k: int = 3, topics_col: str = "topics") -> DataFrame:
    """Top k topics per document with their five leading words."""
    pairs = F.transform(topics_col, lambda p, i: F.struct(p.alias("probability"), (-i).alias("o")))
    top = dist.select(id_col, F.posexplode(F.slice(F.sort_array(pairs, asc=False), 1, k)).alias("rank", "t"))
    lead = words.where("rank <= 5").groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), ", ").alias("words"))
    return top.select(id_col, (F.col("rank") + 1).alias("rank"), (-F.col("t.o")).alias("topic"), F.col("t.probability").alias("probability")).join(F.broadcast(lead), "topic", "left")


def topics_by_category(dist: DataFrame, category_col: str, topics_col: str = "topics") -> DataFrame:
    return dist.select(category_col, F.posexplode(topics_col).alias("topic", "p")).groupBy(category_col, "topic").agg(F.avg("p").alias("mean_probability"))


def topic_examples(dist: DataFrame, id_col: str, k: int = 5, topics_col: str = "topics") -> DataFrame:
    return top_k_per_group(dominant_topics(dist, topics_col).select(id_col, "topic", "probability"), ["topic"], "probability", k, id_col)


def name_topics(words: DataFrame, rules: Sequence[tuple[str, Sequence[str]]], default: str = "General", top: int = 5) -> DataFrame:
    """First rule whose words meet the topic's leading words."""
    lead = words.where(F.col("rank") <= top).groupBy("topic").agg(F.collect_set("term").alias("_w"))
    out = None
    for name, terms in rules:
        hit = F.arrays_overlap("_w", F.array(*[F.lit(t) for t in terms]))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return lead.select("topic", out.otherwise(default).alias("name"))


def topic_usage(dist: DataFrame, k: int, topics_col: str = "topics") -> DataFrame:
    """Documents per dominant topic and mean probability per topic, every topic listed."""
    # the topics are pinned and read once: one row per document and topic says whether it is the dominant one
    own = tx.pin(dist.select(topics_col), {"_topics": F.col(topics_col)}).select("_topics")
    each = dominant_topics(own, "_topics").select(F.col("topic").alias("_top"), F.posexplode("_topics").alias("topic", "p"))
    found = each.groupBy("topic").agg(F.avg("p").alias("mean_probability"), F.count_if(F.col("topic") == F.col("_top")).alias("documents"))
    every = dist.sparkSession.range(k).select(F.col("id").cast("int").alias("topic"))
    return every.join(found, "topic", "left").na.fill(0)


# ---- over time -----------------------------------------------------------------------------------------------

def topic_trends(df: DataFrame, date_col: str, topic_col: str) -> dict[str, DataFrame]:
    """Monthly and weekly shares, evolution, emerging topics, seasons and stability. Input: date, topic."""
    monthly = period_shares(df, tm.period(date_col, "month"), topic_col)
    weekly = period_shares(df, tm.period(date_col, "week"), topic_col)
    return {
        "monthly": monthly, "weekly": weekly, "evolution": topic_evolution_stats(monthly), "emerging": emerging_declining(monthly),
        "by_month": period_shares(df, F.month(date_col), topic_col), "by_quarter": period_shares(df, F.quarter(date_col), topic_col),
        "by_weekday": period_shares(df, F.weekday(date_col), topic_col), "stability": topic_stability(monthly),
    }


def topic_evolution(dist: DataFrame, date_col: str, size: int = 30, step: int = 7, min_rows: int = 10, topics_col: str = "topics") -> DataFrame:
    """Mean topic shares per sliding window, from one model for all windows: window_id, topic, p, rows."""
    w = tm.sliding_windows(dist.select(date_col, topics_col), date_col, size, step, min_rows)
    return w.select("window_id", "window_start", "window_rows", F.posexplode(topics_col).alias("topic", "p")).groupBy(
        "window_id", "window_start", "window_rows", "topic").agg(F.avg("p").alias("p"))


def window_topics(evolution: DataFrame, top: int = 3) -> DataFrame:
    """Per topic: mean and max share, how often it is among the top of a window, consistency."""
    rank = F.row_number().over(Window.partitionBy("window_id").orderBy(F.col("p").desc(), "topic"))  # topics of a window
    ranked = evolution.withColumn("_top", rank <= top)
    return ranked.groupBy("topic").agg(F.avg("p").alias("mean"), F.max("p").alias("max"), F.avg(F.col("_top").cast("int")).alias("frequency"),
                                       (1 - F.stddev_pop("p") / (F.avg("p") + 1e-6)).alias("consistency"))


def words_by_window(df: DataFrame, window_col: str, topic_col: str, tokens_col: str, k: int = 10) -> DataFrame:
    """k most frequent words of every topic in every window."""
    counts = df.select(window_col, topic_col, F.explode(tokens_col).alias("term")).groupBy(window_col, topic_col, "term").agg(count_all().alias("n"))
    return top_k_per_group(counts, [window_col, topic_col], "n", k, "term")


def topic_drift(words: DataFrame, window_col: str = "window_id", topic_col: str = "topic") -> DataFrame:
    """Mean Jaccard of the word sets of consecutive windows, drift rate (1 - mean), its trend and maximum."""
    sets = words.groupBy(window_col, topic_col).agg(F.collect_set("term").alias("terms"))  # k words
    before = F.lag("terms").over(Window.partitionBy(topic_col).orderBy(window_col))
    sims = sets.withColumn("_b", before).where("_b IS NOT NULL").withColumn("j", jaccard(F.col("terms"), F.col("_b")))
    out = sims.groupBy(topic_col).agg(F.avg("j").alias("similarity"), (1 - F.avg("j")).alias("drift"), (1 - F.min("j")).alias("max_drift"),
                                      F.regr_slope(1 - F.col("j"), F.col(window_col).cast("double")).alias("slope"))
    ends = out.agg(F.min("drift").alias("_lo"), F.max("drift").alias("_hi"))
    joined = out.join(F.broadcast(ends))  # one row
    return joined.withColumns({"trend": direction(F.coalesce("slope", F.lit(0.0)), 0.01), "most_stable": F.col("drift") == F.col("_lo"),
                               "most_volatile": F.col("drift") == F.col("_hi")}).drop("_lo", "_hi")


