"""Tables of utterances and queries: intents, parameters, context, insights and whole-table analysis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.operators.relational import category_counts, top_k_per_group
from broadsheet.plans.sized import with_scalars


def parse_query(c: str | Column) -> Column:
    """struct<quantity, phrases, numbers, categories, time_filter, sentiments, follow_up>"""
    c = tx.col(c)
    low = F.lower(c)
    digits = F.regexp_extract(c, r"\b(\d+)\b", 1)
    quantity = F.when(digits != "", F.least(digits.cast("double"), F.lit(20.0)).cast("int"))
    for i, word in enumerate(wl.NUMBER_WORDS, 1):
        quantity = quantity.when(F.contains(low, F.lit(word)), i) if i > 1 else F.when(digits != "", F.least(digits.cast("double"), F.lit(20.0)).cast("int")).when(F.contains(low, F.lit(word)), i)
    time = None
    for label, words in wl.TIME_FILTERS:
        hit = tx.any_hit(low, words)
        time = F.when(hit, label) if time is None else time.when(hit, label)
    sentiments = F.array_compact(F.array(*[F.when(tx.any_hit(low, w), F.lit(s)) for s, w in wl.QUERY_SENTIMENTS.items()]))
    return F.struct(quantity.otherwise(3).alias("quantity"), F.regexp_extract_all(c, F.lit('"([^"]*)"'), 1).alias("phrases"),
                    F.regexp_extract_all(c, F.lit(r"\b\d+\b"), 0).alias("numbers"), tx.contained(low, wl.QUERY_CATEGORIES).alias("categories"),
                    time.alias("time_filter"), sentiments.alias("sentiments"), tx.any_hit(low, wl.FOLLOW_UP_WORDS).alias("follow_up"))


def classify_intent(df: DataFrame, text_col: str, intents: Mapping[str, Mapping[str, Sequence[str]]] = wl.INTENTS) -> DataFrame:
    """Score = (keywords found + 3 per contained example) / keywords; best intent, the first listed on ties."""
    low = F.lower(text_col)
    scores = {n: (tx.hit_count(low, v["keywords"]) + 3 * tx.hit_count(low, [x.lower() for x in v.get("examples", ())])) / float(len(v["keywords"])) for n, v in intents.items()}
    df = tx.pin(df, {"_s": F.struct(*[s.alias(n) for n, s in scores.items()])})
    best = F.greatest(*[F.col(f"_s.{n}") for n in scores])
    pick = F.coalesce(*[F.when((F.col(f"_s.{n}") == best) & (best > 0), F.lit(n)) for n in scores], F.lit("unknown"))
    table = F.create_map(*[x for n in scores for x in (F.lit(n), F.col(f"_s.{n}"))])
    return df.withColumns({"intent": pick, "intent_score": best, "intent_confidence": F.least(best, F.lit(1.0)), "intent_scores": table}).drop("_s")


def combine_intents(rules: DataFrame, model: DataFrame, id_col: str, weights: tuple[float, float] = (0.7, 0.3)) -> DataFrame:
    """Weighted sum of two (id, intent, score) tables and the best intent per id."""
    both = rules.select(id_col, "intent", (F.col("score") * weights[0]).alias("score")).unionByName(model.select(id_col, "intent", (F.col("score") * weights[1]).alias("score")))
    return both.groupBy(id_col, "intent").agg(F.sum("score").alias("score")).groupBy(id_col).agg(
        F.max_by("intent", F.struct(F.round("score", 9), "intent")).alias("intent"), F.max("score").alias("confidence"))


def intent_coverage(df: DataFrame, min_conf: float = 0.5) -> dict[str, DataFrame]:
    known = F.col("intent") != "unknown"
    summary = df.agg(F.count(F.lit(1)).alias("queries"), F.count_if(known).alias("classified"), F.count_if(~known).alias("unknown"),
                     F.avg("intent_confidence").alias("mean_confidence"), F.stddev_pop("intent_confidence").alias("std_confidence"))
    return {"summary": summary, "distribution": df.groupBy("intent").agg(F.count(F.lit(1)).alias("n")), "low_confidence": df.where(F.col("intent_confidence") < min_conf)}


KEY_CHARS = 6


def suggest_intents(df: DataFrame, id_col: str, prefix_col: str, examples: DataFrame, k: int = 5) -> DataFrame:
    """Examples (intent, example) that start with the text, best covered first.

    The join is on the first KEY_CHARS characters, or on the whole text where it is shorter; what they bring together is
    compared in full, so texts of any length find their examples.
    """
    asked = df.select(id_col, F.lower(tx.strip(prefix_col)).alias("prefix")).where(F.length("prefix") > 0)
    asked = asked.withColumn("key", F.substring("prefix", 1, KEY_CHARS))
    offered = examples.select("intent", F.lower("example").alias("example")).distinct().where(F.length("example") > 0)
    sizes = F.sequence(F.lit(1), F.least(F.lit(KEY_CHARS), F.length("example")))
    offered = offered.withColumn("key", F.explode(F.transform(sizes, lambda n: F.substring(F.col("example"), F.lit(1), n))))
    hits = asked.join(offered, "key").where(F.col("example").startswith(F.col("prefix"))).withColumn("score", F.length("prefix") / F.length("example"))
    return top_k_per_group(hits, [id_col], "score", k, "example").select(id_col, "intent", "example", "score", "rank")


def corpus_insights(df: DataFrame, text_col: str, category_col: str) -> DataFrame:
    top = df.groupBy(category_col).agg(F.count(F.lit(1)).alias("n")).agg(F.max_by(category_col, F.struct("n", category_col)).alias("top_category"), F.max("n").alias("top_rows"),
                                                                        F.count(F.lit(1)).alias("categories"))
    return with_scalars(df.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.length(text_col)).alias("mean_length")), top)


def compare_coverage(df: DataFrame, col: str) -> DataFrame:
    counts = category_counts(df, col).select(col, "count", "percentage")
    return with_scalars(counts, counts.agg(F.avg("count").alias("mean"))).withColumn("trend", F.when(F.col("count") > F.col("mean"), "increasing").otherwise("stable"))


def carry_context(df: DataFrame, conv_col: str, turn_col: str, text_col: str, categories: Sequence[str] = wl.QUERY_CATEGORIES,
                  cues: Sequence[str] = wl.FOLLOW_UP_CUES, reach: int = 10) -> DataFrame:
    """Follow-up flag per turn; a turn that names no category takes the last one named in the `reach` turns before."""
    low = F.lower(text_col)
    named = F.get(tx.contained(low, categories), F.lit(0))
    df = df.withColumn("named_category", named)
    before = F.last("named_category", ignorenulls=True).over(Window.partitionBy(conv_col).orderBy(turn_col).rowsBetween(-reach, -1))  # one conversation
    return df.withColumns({"follow_up": tx.any_hit(low, cues), "category": F.coalesce("named_category", before)})


def analyze_articles(df: DataFrame, id_col: str, text_col: str, analyses: Sequence[str] = ("category", "sentiment", "language", "readability", "bias")) -> DataFrame:
    """Chosen analyses as struct columns of one row per article, in one pass over the texts."""
    from broadsheet.operators.bias import detect_bias
    from broadsheet.operators.lang import detect_language
    from broadsheet.operators.lexicon import keyword_category
    from broadsheet.operators.sentiment import analyze_sentiment
    keep = list(df.columns)
    steps = {
        "category": lambda d: keyword_category(d, text_col), "sentiment": lambda d: analyze_sentiment(d, text_col), "language": lambda d: detect_language(d, text_col),
        "readability": lambda d: d.withColumns({"ease": tx.flesch_ease(text_col), "grade": tx.flesch_kincaid(text_col)}), "bias": lambda d: detect_bias(d, text_col),
    }
    out = df
    for name in analyses:
        before = set(out.columns)
        done = steps[name](out)
        new = [c for c in done.columns if c not in before]
        out = done.select(*[c for c in out.columns], F.struct(*new).alias(name))
    return out.select(*[c for c in keep if c != text_col], *analyses)
