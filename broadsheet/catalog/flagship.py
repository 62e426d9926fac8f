"""Minimum slice: how positive is the coverage in each language, on deduplicated articles?"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.catalog.tables import table, tokens_sql, list_sql
from broadsheet.functions.text import word_tokens
from broadsheet.operators.clean import dedup_exact
from broadsheet.operators.sentiment import label_compound, lexicon_sentiment
from broadsheet.registry import query

# The given texts are invented, so the queries score words that do occur in them.
TEST_LEXICON = {"the": 1.5, "and": -1.25, "of": 0.75, "der": 1.0, "und": -0.75, "la": 1.25, "de": -0.75, "que": -1.0,
                "on": 0.5, "les": 0.5, "ist": -0.5, "con": 0.5}
TEST_NEGATIONS = ["to", "is", "le", "die", "en"]


def compound_sql(source: str, text: str = "text", keep: str = "*") -> str:
    """SELECT keep, compound, pos, neg, neu for every row of `source`."""
    words = list(TEST_LEXICON)
    value = "CASE " + " ".join(f"WHEN t = '{w}' THEN {v}::DOUBLE" for w, v in TEST_LEXICON.items()) + " ELSE 0::DOUBLE END"
    hit = (f"list_transform(range(1, len(tk) + 1), lambda i: CASE WHEN list_contains({list_sql(words)}, tk[i]) THEN "
           f"list_sum(list_transform([tk[i]], lambda t: {value})) * (CASE WHEN len(list_intersect(tk[greatest(i - 3, 1):i - 1], {list_sql(TEST_NEGATIONS)})) > 0 "
           f"THEN -0.74::DOUBLE ELSE 1::DOUBLE END) ELSE 0::DOUBLE END)")
    return f"""SELECT {keep}, s / sqrt(s * s + 15) AS compound, CASE WHEN n > 0 THEN p / n ELSE 0 END AS pos,
  CASE WHEN n > 0 THEN ng / n ELSE 0 END AS neg, CASE WHEN n > 0 THEN z / n ELSE 0 END AS neu FROM (SELECT *, p + ng + z AS n FROM (
  SELECT *, coalesce(list_sum(v), 0) AS s, coalesce(list_sum(list_transform(list_filter(v, lambda x: x > 0), lambda x: x + 1)), 0) AS p,
  coalesce(list_sum(list_transform(list_filter(v, lambda x: x < 0), lambda x: 1 - x)), 0) AS ng,
  len(list_filter(v, lambda x: x = 0))::DOUBLE AS z FROM (SELECT *, {hit} AS v FROM (SELECT *, {tokens_sql(text)} AS tk FROM {source}))))"""


LABEL = "CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END"
DEDUP = "(SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)"


@query("coverage_by_language", f"""
SELECT lang, count(*) AS articles, round(avg(compound), 6) AS mean_compound,
  round(avg(CASE WHEN {LABEL} = 'positive' THEN 1 ELSE 0 END), 6) AS positive_share,
  round(avg(CASE WHEN {LABEL} = 'negative' THEN 1 ELSE 0 END), 6) AS negative_share
FROM ({compound_sql(DEDUP, keep='lang')}) GROUP BY lang""")
def coverage_by_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    scored = lexicon_sentiment(dedup_exact(docs, "text", "doc_id").withColumn("tokens", word_tokens("text")),
                               "tokens", TEST_LEXICON, TEST_NEGATIONS)
    label = label_compound(F.col("compound"))
    return scored.groupBy("lang").agg(
        F.count(F.lit(1)).alias("articles"), F.round(F.avg("compound"), 6).alias("mean_compound"),
        F.round(F.avg((label == "positive").cast("int")), 6).alias("positive_share"),
        F.round(F.avg((label == "negative").cast("int")), 6).alias("negative_share")).orderBy("lang")
