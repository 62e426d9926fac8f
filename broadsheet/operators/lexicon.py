"""Keyword predicates and rule classifiers.

Word lists of up to a few hundred entries become literal expressions inside the scan, with no join and no
shuffle. Longer lists, given as tables, go through the join forms.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.plans.sized import attach



def keyword_hits(df: DataFrame, col: str, terms: Sequence[str]) -> DataFrame:
    """Terms contained in the lower-cased text as substrings."""
    return df.withColumn("hits", tx.contained(F.lower(col), terms)).withColumn("n_hits", F.size("hits"))


def token_hits(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """Word-exact hits per row against a (word) table of any size."""
    tokens = df.select(id_col, F.posexplode(tx.word_tokens(text_col)).alias("pos", "word"))
    words = lexicon.select("word").distinct()
    found = attach(tokens, words, ["word"], [id_col, "pos"])
    counts = found.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_hits"), F.count_distinct("word").alias("n_words"))
    return df.select(id_col).join(counts, id_col, "left").na.fill(0, ["n_hits", "n_words"])


def ordered_rules(low: Column, rules: Sequence[tuple[str, Sequence[str]]], otherwise: Column) -> Column:
    out = None
    for label, terms in rules:
        hit = tx.any_hit(low, terms)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(otherwise)


def keyword_category(df: DataFrame, text_col: str, rules: Sequence[tuple[str, Sequence[str]]] = wl.CATEGORY_RULES_LONG,
                     default: str = "business", sure: float = 0.85, unsure: float = 0.75) -> DataFrame:
    """First rule with a keyword in the text wins; no rule means the default with the lower score."""
    label = ordered_rules(F.lower(text_col), rules, F.lit(None).cast("string"))
    return (df.withColumn("_rule", label)
            .withColumn("keyword_category", F.coalesce("_rule", F.lit(default)))
            .withColumn("category_confidence", F.when(F.col("_rule").isNotNull(), sure).otherwise(unsure)).drop("_rule"))


def apply_category_overrides(df: DataFrame, text_col: str, label_col: str, confidence_col: str,
                             rules: Sequence[tuple[str, Sequence[str]]] = wl.OVERRIDE_RULES, floor: float = 0.85) -> DataFrame:
    rule = ordered_rules(F.lower(text_col), rules, F.lit(None).cast("string"))
    changed = F.coalesce(F.col("_rule") != F.col(label_col), F.lit(False))
    return (df.withColumn("_rule", rule).withColumn("corrected", changed)
            .withColumn("original_category", F.col(label_col))
            .withColumn(confidence_col, F.when(F.col("corrected"), F.greatest(F.col(confidence_col), F.lit(floor))).otherwise(F.col(confidence_col)))
            .withColumn(label_col, F.when(F.col("corrected"), F.col("_rule")).otherwise(F.col(label_col))).drop("_rule"))


def simple_sentiment(low: Column, positive: Sequence[str] = wl.SHORT_POSITIVE, negative: Sequence[str] = wl.SHORT_NEGATIVE) -> Column:
    """struct<label, score> from the number of positive and negative substrings."""
    p, n = tx.hit_count(low, positive), tx.hit_count(low, negative)
    return F.struct(F.when(p > n, "positive").when(n > p, "negative").otherwise("neutral").alias("label"),
                    F.when(p == n, 0.5).otherwise(0.7).alias("score"))


def normalized_sentiment(text: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """(positive - negative words) / words."""
    w = F.transform(tx.words(text), F.lower)
    p = F.size(F.filter(w, lambda x: x.isin(list(positive))))
    n = F.size(F.filter(w, lambda x: x.isin(list(negative))))
    return tx.ratio(p - n, F.size(w))


def theme_tags(df: DataFrame, text_col: str, lang_col: str,
               themes: Mapping[str, Mapping[str, Sequence[str]]] = wl.THEMES) -> DataFrame:
    """Array of themes of the row's language whose words occur."""
    low = F.lower(text_col)
    tags = F.array().cast("array<string>")
    for lang, rules in themes.items():
        of_lang = F.array_compact(F.array(*[F.when(tx.any_hit(low, words), F.lit(t)) for t, words in rules.items()]))
        tags = F.when(F.col(lang_col) == lang, of_lang).otherwise(tags)
    return df.withColumn("themes", tags)


def attribution_counts(df: DataFrame, text_col: str, patterns: Sequence[str] = wl.ATTRIBUTION_PATTERNS,
                       opinion: Sequence[str] = wl.BIAS_OPINION, fact: Sequence[str] = wl.BIAS_FACT) -> DataFrame:
    df, low = tx.pin(df, {"_low": F.lower(text_col)}), F.col("_low")
    total = F.lit(0)
    for p in patterns:
        total = total + F.regexp_count(low, F.lit(p))
    return df.withColumns({"attributions": total, "opinion_words": tx.hit_count(low, opinion), "fact_words": tx.hit_count(low, fact)}).drop("_low")


def breaking_score(df: DataFrame, title_col: str, body_col: str, words: Sequence[str] = wl.BREAKING, needed: int = 2) -> DataFrame:
    """Number of words found in the title or the body."""
    both = F.concat_ws("\u0001", F.lower(title_col), F.lower(body_col))
    return df.withColumn("breaking_score", tx.hit_count(both, words)).withColumn("is_breaking", F.col("breaking_score") >= needed)


