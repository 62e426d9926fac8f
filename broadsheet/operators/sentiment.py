"""Lexicon sentiment, method ensemble, confidence, emotions and sentiment over time."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.functions.temporal import date_span, period
from broadsheet.operators.relational import confidence_band, linear_trend, moving_average, sentiment_anomalies
from broadsheet.plans.ordered import percentiles
from broadsheet.plans.sized import attach, with_scalars
from broadsheet.session import materialize

NEGATION_FACTOR = -0.74
NORMALIZER = 15.0
WEIGHTS = (0.4, 0.3, 0.3)
LABELS = ("positive", "negative", "neutral")


def valued(token: Column, table: Mapping[str, float]) -> Column:
    """Value of a token in a word table held as literals: words are grouped by value, so each look-up is a hashed IN."""
    groups: dict[float, list[str]] = defaultdict(list)
    for word, value in table.items():
        groups[float(value)].append(word)
    out = F.lit(0.0)
    for value, words in sorted(groups.items()):
        out = F.when(token.isin(words), F.lit(value)).otherwise(out)
    return out


def negated(tokens: Column, i: Column, negations: Sequence[str], reach: int = 3) -> Column:
    """Is one of the `reach` tokens before position i a negation?"""
    before = F.slice(tokens, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)))
    return F.exists(before, lambda t: t.isin(list(negations)))


def valences(tokens: Column, lexicon: Mapping[str, float], negations: Sequence[str]) -> Column:
    """Valence of every token; one hashed look-up settles the tokens the lexicon does not have."""
    known = [w for w, v in lexicon.items() if v]

    def one(t, i):
        sign = F.when(negated(tokens, i, negations), F.lit(NEGATION_FACTOR)).otherwise(F.lit(1.0))
        return F.when(t.isin(known), valued(t, lexicon) * sign).otherwise(F.lit(0.0))

    return F.transform(tokens, one)


def compound_of(values: Column) -> Column:
    """struct<compound, pos, neg, neu> of an array of token valences."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("p"), F.lit(0.0).alias("n"))

    def add(acc, v):
        return F.struct((acc["s"] + v).alias("s"), (acc["p"] + F.greatest(v + F.signum(v), F.lit(0.0))).alias("p"),
                        (acc["n"] + F.greatest(-v - F.signum(v), F.lit(0.0))).alias("n"))

    # an array of one element binds the valences, and what differs from zero, to a name: each is computed once
    bound = F.transform(F.array(values), lambda v: F.struct(F.size(v).alias("size"), F.filter(v, lambda x: x != 0).alias("hits")))

    def sums(b):
        z = (b["size"] - F.size(b["hits"])).cast("double")
        return F.aggregate(b["hits"], zero, add, lambda acc: F.struct(acc["s"].alias("s"), acc["p"].alias("p"), acc["n"].alias("n"), z.alias("z")))

    def shares(acc):
        total = acc["p"] + acc["n"] + acc["z"]
        share = lambda x: F.when(total > 0, x / total).otherwise(0.0)
        return F.struct((acc["s"] / F.sqrt(acc["s"] * acc["s"] + NORMALIZER)).alias("compound"),
                        share(acc["p"]).alias("pos"), share(acc["n"]).alias("neg"), share(acc["z"]).alias("neu"))

    return F.get(F.transform(F.transform(bound, sums), shares), F.lit(0))


def lexicon_sentiment(df: DataFrame, tokens_col: str, lexicon: Mapping[str, float] = wl.VALENCE,
                      negations: Sequence[str] = wl.NEGATIONS) -> DataFrame:
    """Compound score and shares per row; no shuffle."""
    df = df.withColumn("_v", valences(F.col(tokens_col), lexicon, negations))
    return df.withColumn("_s", compound_of(F.col("_v"))).drop("_v").withColumns(
        {"compound": F.col("_s.compound"), "pos": F.col("_s.pos"), "neg": F.col("_s.neg"), "neu": F.col("_s.neu")}).drop("_s")


def lexicon_sentiment_table(df: DataFrame, id_col: str, tokens_col: str, lexicon: DataFrame, negations: Sequence[str]) -> DataFrame:
    """The same score for a (word, valence) table of any size."""
    t = F.col(tokens_col)
    long = df.select(id_col, F.posexplode(F.transform(t, lambda w, i: F.struct(
        w.alias("word"), negated(t, i, negations).alias("neg")))).alias("pos", "t")).select(id_col, "pos", "t.word", "t.neg")
    hit = attach(long, lexicon.select("word", F.col("valence").cast("double").alias("valence")).dropDuplicates(["word"]),
                 ["word"], [id_col, "pos"])
    v = F.when(F.col("neg"), F.col("valence") * NEGATION_FACTOR).otherwise(F.col("valence"))
    sums = hit.groupBy(id_col).agg(F.sum(v).alias("_s"))
    s = F.coalesce("_s", F.lit(0.0))
    return df.join(sums, id_col, "left").withColumn("compound", s / F.sqrt(s * s + NORMALIZER)).drop("_s")


def label_compound(score: Column) -> Column:
    return F.when(score >= 0.05, "positive").when(score <= -0.05, "negative").otherwise("neutral")


def label_polarity(score: Column) -> Column:
    return F.when(score > 0.1, "positive").when(score < -0.1, "negative").otherwise("neutral")


def polarity_subjectivity(df: DataFrame, tokens_col: str, lexicon: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Mean polarity and mean subjectivity of the tokens the lexicon knows."""
    known = F.filter(F.col(tokens_col), lambda t: t.isin(list(lexicon)))
    n = F.size(known)

    def mean(values: Mapping[str, float]) -> Column:
        return tx.ratio(F.aggregate(known, F.lit(0.0), lambda a, t: a + valued(t, values)), n)

    return df.withColumns({"polarity": mean({w: v[0] for w, v in lexicon.items()}),
                           "subjectivity": mean({w: v[1] for w, v in lexicon.items()})})


def aggregate_sentiment(scores: Sequence[Column], labels: Sequence[Column], weights: Sequence[float] = WEIGHTS) -> Column:
    """struct<score, label, confidence> over the methods that gave a score; ties go to the earlier method."""
    w = [F.when(s.isNotNull() & l.isNotNull(), F.lit(x)).otherwise(0.0) for s, l, x in zip(scores, labels, weights)]
    total = sum(w[1:], w[0])
    score = sum((F.coalesce(s, F.lit(0.0)) * x for s, x in zip(scores, w)), F.lit(0.0)) / total

    def vote(label: Column) -> Column:
        return sum((F.when(l == label, x).otherwise(0.0) for l, x in zip(labels, w)), F.lit(0.0)) / total

    votes = [F.when(x > 0, vote(l)) for l, x in zip(labels, w)]
    best = F.greatest(*votes) if len(votes) > 1 else votes[0]
    winner = F.coalesce(*[F.when(v == best, l) for v, l in zip(votes, labels)])
    return F.struct(score.alias("score"), winner.alias("label"), best.alias("confidence"))


def sentiment_confidence(label: Column, labels: Sequence[Column], length: Column, compound: Column, model_confidence: Column) -> Column:
    """Mean of method agreement, length, score magnitude and model confidence, whichever are present."""
    present = F.array_compact(F.array(*labels))
    agreement = F.size(F.filter(present, lambda x: x == label)).cast("double") / F.size(present)
    factors = F.array_compact(F.array(agreement, F.least(length / 500.0, F.lit(1.0)), F.abs(compound), model_confidence))
    return F.aggregate(factors, F.lit(0.0), lambda a, x: a + x) / F.size(factors)


POSITIVE_EMOTIONS = ("joy", "trust", "anticipation", "surprise")
NEGATIVE_EMOTIONS = ("sadness", "anger", "fear", "disgust")


def emotion_scores(df: DataFrame, tokens_col: str, lexicon: Mapping[str, Sequence[str]]) -> DataFrame:
    """Share of each emotion among the emotion words of the row, dominant one, intensity and sign sums."""
    t = F.col(tokens_col)
    counts = {e: F.size(F.filter(t, tx.one_of(words))) for e, words in lexicon.items()}
    df = df.withColumns({f"_n_{e}": c for e, c in counts.items()})
    total = sum((F.col(f"_n_{e}") for e in counts), F.lit(0))
    df = df.withColumns({e: tx.ratio(F.col(f"_n_{e}"), total) for e in counts}).drop(*[f"_n_{e}" for e in counts])
    top = F.greatest(*[F.col(e) for e in counts]) if len(counts) > 1 else F.col(next(iter(counts)))
    pick = F.coalesce(*[F.when((F.col(e) == top) & (top > 0), F.lit(e)) for e in sorted(counts)])

    def total_of(names):
        return sum((F.col(e) for e in names if e in counts), F.lit(0.0))

    return df.withColumns({"dominant_emotion": pick, "intensity": top, "positive_emotions": total_of(POSITIVE_EMOTIONS),
                           "negative_emotions": total_of(NEGATIVE_EMOTIONS)})


def analyze_sentiment(df: DataFrame, text_col: str = "text", lexicon: Mapping[str, float] = wl.VALENCE,
                      polarity: Mapping[str, tuple[float, float]] | None = None, negations: Sequence[str] = wl.NEGATIONS,
                      model_score: str | None = None, model_label: str | None = None, model_confidence: str | None = None,
                      full: bool = True) -> DataFrame:
    """Both lexicon methods, an optional model's columns, the ensemble and its confidence. One projection."""
    polarity = polarity or {w: (v / 4, min(1.0, abs(v) / 4 + 0.25)) for w, v in lexicon.items()}
    df = df.withColumn("_tokens", tx.word_tokens(F.coalesce(F.col(text_col), F.lit(""))))
    df = polarity_subjectivity(lexicon_sentiment(df, "_tokens", lexicon, negations), "_tokens", polarity)
    df = df.withColumns({"compound_label": label_compound(F.col("compound")), "polarity_label": label_polarity(F.col("polarity"))})
    scores = [F.col("compound"), F.col("polarity")]
    labels = [F.col("compound_label"), F.col("polarity_label")]
    if model_score and model_label:
        scores.append(F.col(model_score))
        labels.append(F.col(model_label))
    df = tx.pin(df, {"_a": aggregate_sentiment(scores, labels)}).withColumns(
        {"weighted_score": F.col("_a.score"), "sentiment": F.col("_a.label"), "vote": F.col("_a.confidence")})
    model = F.col(model_confidence) if model_confidence else F.lit(None).cast("double")
    df = df.withColumn("confidence", sentiment_confidence(F.col("sentiment"), labels, F.length(text_col), F.col("compound"), model))
    df = df.withColumn("confidence_level", confidence_band(F.col("confidence"))).drop("_a", "_tokens")
    if full:
        return df
    return df.drop("pos", "neg", "neu", "subjectivity", "compound_label", "polarity_label", "vote", "confidence_level")


def sentiment_by_period(df: DataFrame, date_col: str, unit: str) -> DataFrame:
    """Mean, deviation and count of both scores, and counts per label, for every week or month."""
    return df.groupBy(period(date_col, unit).alias("period")).agg(
        F.avg("compound").alias("compound_mean"), F.stddev_samp("compound").alias("compound_std"), F.count("compound").alias("rows"),
        F.avg("polarity").alias("polarity_mean"), F.stddev_samp("polarity").alias("polarity_std"),
        *[F.count_if(F.col("sentiment") == l).alias(l) for l in LABELS])


def sentiment_cube(df: DataFrame, date_col: str, category_col: str) -> DataFrame:
    """Overall, per category, per week and per month in one job."""
    keyed = df.select(F.col(category_col).alias("category"), period(date_col, "week").alias("week"),
                      period(date_col, "month").alias("month"), "compound")
    cats, week, month = F.col("category"), F.col("week"), F.col("month")
    return keyed.groupingSets([[], [cats], [week], [month]], cats, week, month).agg(
        F.when(F.grouping(cats) == 0, "category").when(F.grouping(week) == 0, "week")
        .when(F.grouping(month) == 0, "month").otherwise("overall").alias("level"),
        F.avg("compound").alias("mean"), F.stddev_samp("compound").alias("std"), F.count(F.lit(1)).alias("rows"))


def sentiment_statistics(df: DataFrame, scores: Sequence[str] = ("compound", "polarity")) -> DataFrame:
    """One row per score: mean, std (population), min, max, exact median. Each score keeps its own statistics."""
    df = materialize(df.select(*scores))
    out = None
    for name in scores:
        base = df.agg(F.lit(name).alias("score"), F.avg(name).alias("mean"), F.stddev_pop(name).alias("std"),
                      F.min(name).alias("min"), F.max(name).alias("max"))
        row = with_scalars(base, percentiles(df, name, {"median": 0.5}))
        out = row if out is None else out.unionByName(row)
    return out


def label_shares(df: DataFrame, label_col: str = "sentiment", by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    counts = df.groupBy(*by, label_col).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy(*by).agg(F.sum("count").alias("_t"))
    joined = counts.join(totals, by) if by else with_scalars(counts, totals)
    return joined.withColumn("percentage", F.col("count") * 100.0 / F.col("_t")).drop("_t")


TRACKS = ("overall", "by_category", "weekly", "monthly", "moving_7", "moving_30", "anomalies", "range")


def track_sentiment(df: DataFrame, date_col: str, category_col: str, id_col: str, parts: Sequence[str] = TRACKS) -> dict[str, DataFrame]:
    """Trends (overall and by category), weekly and monthly tables, moving averages, anomalies and the date range.

    The scored table is cut to the needed columns and written once; every part reads it from there.
    """
    df = materialize(df.select(id_col, date_col, category_col, "compound", "polarity", "sentiment"))
    order = [date_col, id_col]
    series = df.select(*order, "compound")
    build = {
        "overall": lambda: linear_trend(df, order, "compound"),
        "by_category": lambda: linear_trend(df, order, "compound", [category_col]),
        "weekly": lambda: sentiment_by_period(df, date_col, "week"),
        "monthly": lambda: sentiment_by_period(df, date_col, "month"),
        "moving_7": lambda: moving_average(series, order, "compound", 7),
        "moving_30": lambda: moving_average(series, order, "compound", 30),
        "anomalies": lambda: sentiment_anomalies(series, order, "compound"),
        "range": lambda: date_span(df, date_col),
    }
    return {name: build[name]() for name in parts}


def sentiment_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Shares, mean, range and dominant label of a result set."""
    n = F.count(F.lit(1))
    counts = {l: F.count_if(F.col("sentiment") == l) for l in LABELS}
    agg = df.groupBy(*by).agg(n.alias("rows"), *[c.alias(f"{l}_count") for l, c in counts.items()],
                              F.avg("compound").alias("mean_score"), F.min("compound").alias("min_score"), F.max("compound").alias("max_score"))
    top = F.greatest(*[F.col(f"{l}_count") for l in LABELS])
    dominant = F.coalesce(*[F.when(F.col(f"{l}_count") == top, F.lit(l)) for l in LABELS])
    return agg.withColumns({**{f"{l}_share": F.col(f"{l}_count") / F.col("rows") for l in LABELS}, "dominant": dominant}).drop(
        *[f"{l}_count" for l in LABELS])
