"""Rows H on documents. Models are checked by row counts; everything computed from topic tables is checked by SQL."""

from pyspark.sql import functions as F

from broadsheet.catalog.relations import SHARES, WT, rounded, window_topics as lang_windows, windows_sql
from broadsheet.catalog.tables import DATED, articles, dated, tokens_sql
from broadsheet.functions import text as tx
from broadsheet.functions import temporal as tm
from broadsheet.operators import topics as h
from broadsheet.operators.features import tfidf_long
from broadsheet.registry import query

K = 5
_FITTED = {}


def tokens(spark, sf, *extra):
    t = F.filter(tx.word_tokens("text"), lambda x: F.length(x) > 2)
    return articles(spark, sf, "lang").select("doc_id", "category", *extra, t.alias("tokens"))


def lda(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED[key] = h.fit_lda(tokens(spark, sf), "tokens", K, 10, vocab_size=500)
    return _FITTED[key]


@query("H01_lda_distributions")
def h01(spark, sf):
    return lda(spark, sf).distributions(tokens(spark, sf)).select("doc_id", "topics")


@query("H01_perplexity")
def h01b(spark, sf):
    value = lda(spark, sf).perplexity(tokens(spark, sf))
    return tokens(spark, sf).agg(F.count(F.lit(1)).alias("documents"), F.lit(value).alias("log_perplexity"))


@query("H02_nmf_distributions")
def h02(spark, sf):
    return h.fit_nmf(tfidf_long(tokens(spark, sf), "doc_id", "tokens", lo=1, hi=1, max_features=500), "doc_id", K, 8, documents=tokens(spark, sf))[0]


@query("H03_topic_words")
def h03(spark, sf):
    return lda(spark, sf).words(15)


# Topics for the SQL-checked rows: a document's topic mix is its share of vowels a, e, i, o, u.
LETTERS = "aeiou"
N = " + ".join(f"(length(lower(text)) - length(replace(lower(text), '{c}', '')))" for c in LETTERS)
MIX = "SELECT doc_id, lang, source, " + ", ".join(f"(length(lower(text)) - length(replace(lower(text), '{c}', '')))::DOUBLE / greatest({N}, 1) AS p{i}" for i, c in enumerate(LETTERS)) + " FROM documents"
LONG = f"SELECT doc_id, lang, source, t AS topic, [p0, p1, p2, p3, p4][t + 1] AS p FROM ({MIX}), unnest(range(0, 5)) AS u(t)"


def mix(df):
    # pinned, as every use of a share would lower and search the text again for all letters
    df = tx.pin(tx.pin(df, {"_low": F.lower("text")}), {"_counts": F.array(*[tx.occurrences(F.col("_low"), c) for c in LETTERS])})
    counts = [F.get("_counts", F.lit(i)) for i in range(len(LETTERS))]
    total = tx.at_least_one(sum(counts[1:], counts[0]))
    return df.withColumn("topics", F.array(*[c.cast("double") / total for c in counts])).drop("_low", "_counts")


def docs(spark, sf):
    return mix(articles(spark, sf, "lang"))


WORDS = f"""tw AS (SELECT lang AS topic, term, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) AS rank FROM (SELECT lang, unnest({tokens_sql('text')}) AS term FROM documents) GROUP BY lang, term QUALIFY rank <= 10)"""


def lang_words(spark, sf):
    d = articles(spark, sf, "lang").select("lang", F.explode(tx.word_tokens("text")).alias("term")).groupBy(F.col("lang").alias("topic"), "term").agg(F.count(F.lit(1)).alias("n"))
    from broadsheet.operators.relational import top_k_per_group
    return top_k_per_group(d, ["topic"], "n", 10, "term")


@query("H04_topic_coherence", f"""WITH {WORDS}, dt AS (SELECT DISTINCT doc_id, unnest({tokens_sql('text')}) AS term FROM documents), x AS (SELECT topic, rank, doc_id FROM tw JOIN dt USING (term)), s AS (SELECT topic, rank, count(*) AS n FROM x GROUP BY 1, 2),
b AS (SELECT p.topic, p.rank AS r1, q.rank AS r2, count(*) AS nb FROM x p JOIN x q ON p.topic = q.topic AND p.doc_id = q.doc_id AND p.rank < q.rank GROUP BY 1, 2, 3)
SELECT a.topic, round(avg(coalesce(nb, 0)::DOUBLE / n), 6) AS coherence FROM tw a JOIN tw c ON a.topic = c.topic AND a.rank < c.rank JOIN s ON s.topic = a.topic AND s.rank = a.rank LEFT JOIN b ON b.topic = a.topic AND b.r1 = a.rank AND b.r2 = c.rank GROUP BY 1""")
def h04(spark, sf):
    d = articles(spark, sf, "lang").select("doc_id", tx.word_tokens("text").alias("tokens"))
    return rounded(h.topic_coherence(lang_words(spark, sf), d, "doc_id", "tokens"))


PAIRS = [(i, j) for i in range(5) for j in range(i + 1, 5)]


@query("H05_topic_quality", f"""WITH m AS (SELECT *, greatest(p0, p1, p2, p3, p4) AS mx FROM ({MIX})), t AS (SELECT *, CASE mx WHEN p0 THEN 0 WHEN p1 THEN 1 WHEN p2 THEN 2 WHEN p3 THEN 3 ELSE 4 END AS topic FROM m)
SELECT round(count(DISTINCT topic)::DOUBLE / 5, 6) AS topics_used, round(avg(mx), 6) AS mean_max_probability, round(({' + '.join(f'coalesce(corr(p{i}, p{j}), 0)' for i, j in PAIRS)}) / {len(PAIRS)}, 6) AS mean_correlation, round(avg((mx > 0.1)::INT), 6) AS coverage FROM t""")
def h05(spark, sf):
    return rounded(h.topic_quality(docs(spark, sf), 5))


@query("H06_assign_topics", f"""WITH r AS (SELECT doc_id, topic, p, row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, topic) AS rank FROM ({LONG})) SELECT doc_id, rank, topic, round(p, 6) AS probability, 'word' || topic AS words FROM r WHERE rank <= 3""")
def h06(spark, sf):
    words = docs(spark, sf).select(F.explode(F.sequence(F.lit(0), F.lit(4))).alias("topic")).distinct().select("topic", F.lit(1).alias("rank"), F.concat(F.lit("word"), F.col("topic")).alias("term"))
    return rounded(h.assign_topics(docs(spark, sf), "doc_id", words))


@query("H07_topic_trends", f"WITH {SHARES.replace(chr(39) + 'week' + chr(39), chr(39) + 'month' + chr(39))} SELECT CAST(period AS VARCHAR) AS period, topic, count, round(share, 6) AS share FROM x")
def h07(spark, sf):
    return rounded(h.topic_trends(dated(spark, sf, "lang"), "date", "lang")["monthly"]).withColumn("period", F.col("period").cast("string"))


@query("H07_topic_seasons", f"""WITH c AS (SELECT isodow(date) - 1 AS period, lang AS topic, count(*) AS n FROM {DATED} GROUP BY 1, 2)
SELECT period, topic, coalesce(n, 0) AS count, round(coalesce(n, 0)::DOUBLE / sum(coalesce(n, 0)) OVER (PARTITION BY period), 6) AS share FROM (SELECT * FROM (SELECT DISTINCT period FROM c), (SELECT DISTINCT topic FROM c)) LEFT JOIN c USING (period, topic)""")
def h07b(spark, sf):
    return rounded(h.topic_trends(dated(spark, sf, "lang"), "date", "lang")["by_weekday"])


EVO = windows_sql(14, 7, 10) + f", ev AS (SELECT window_id, topic, avg(p) AS p FROM m JOIN c USING (window_start) JOIN (SELECT doc_id, topic, p FROM ({LONG})) USING (doc_id) GROUP BY 1, 2)"


def evolution(spark, sf):
    return h.topic_evolution(mix(dated(spark, sf, "lang")), "date", 14, 7, 10)


@query("H08_topic_evolution", EVO + " SELECT window_id, topic, round(p, 6) AS p FROM ev")
def h08(spark, sf):
    return rounded(evolution(spark, sf).select("window_id", "topic", "p"))


@query("H09_window_topics", EVO + """, r AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY p DESC, topic) <= 3 AS top FROM ev)
SELECT topic, round(avg(p), 6) AS mean, round(max(p), 6) AS max, round(avg(top::INT), 6) AS frequency, round(1 - stddev_pop(p) / (avg(p) + 1e-6), 6) AS consistency FROM r GROUP BY 1""")
def h09(spark, sf):
    return rounded(h.window_topics(evolution(spark, sf)))


@query("H10_topic_drift", windows_sql(14, 7, 10) + f""", tk AS (SELECT window_id, lang AS topic, unnest({tokens_sql('text')}) AS term FROM m JOIN c USING (window_start)), kw AS (SELECT window_id, topic, term FROM tk GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY window_id, topic ORDER BY count(*) DESC, term) <= 10),
st AS (SELECT window_id, topic, list(term) AS s FROM kw GROUP BY 1, 2), j AS (SELECT *, lag(s) OVER (PARTITION BY topic ORDER BY window_id) AS b FROM st), q AS (SELECT topic, window_id, len(list_intersect(s, b))::DOUBLE / len(list_distinct(list_concat(s, b))) AS j FROM j WHERE b IS NOT NULL),
o AS (SELECT topic, avg(j) AS similarity, 1 - avg(j) AS drift, 1 - min(j) AS max_drift, regr_slope(1 - j, window_id) AS slope FROM q GROUP BY 1)
SELECT topic, round(similarity, 6) AS similarity, round(drift, 6) AS drift, round(max_drift, 6) AS max_drift, round(slope, 6) AS slope, CASE WHEN coalesce(slope, 0) > 0.01 THEN 'increasing' WHEN coalesce(slope, 0) < -0.01 THEN 'decreasing' ELSE 'stable' END AS trend FROM o""")
def h10(spark, sf):
    w = tm.sliding_windows(dated(spark, sf, "lang"), "date", 14, 7, 10).select("window_id", F.col("lang").alias("topic"), tx.word_tokens("text").alias("tokens"))
    return rounded(h.topic_drift(h.words_by_window(w, "window_id", "topic", "tokens")).drop("most_stable", "most_volatile"))


def window_models(spark, sf):
    d = dated(spark, sf, "lang").select("doc_id", "date", F.filter(tx.word_tokens("text"), lambda x: F.length(x) > 2).alias("tokens"))
    w = tm.sliding_windows(d.select("doc_id", "date"), "date", 14, 7, 10).select("doc_id", "window_id")
    return h.window_models(tfidf_long(d, "doc_id", "tokens", lo=1, hi=1, max_features=1000), w, "doc_id")


@query("H10_drift_of_window_models")
def h10_models(spark, sf):
    return rounded(h.topic_drift(window_models(spark, sf)[0].where("rank <= 10")))


@query("H08_evolution_of_window_models")
def h08_models(spark, sf):
    return rounded(window_models(spark, sf)[1])


@query("H11_topics_by_category", f"SELECT source AS category, topic, round(avg(p), 6) AS mean_probability FROM ({LONG}) GROUP BY 1, 2")
def h11(spark, sf):
    return rounded(h.topics_by_category(docs(spark, sf), "category"))


@query("H12_topic_examples", f"""WITH m AS (SELECT *, greatest(p0, p1, p2, p3, p4) AS mx FROM ({MIX})), t AS (SELECT *, CASE mx WHEN p0 THEN 0 WHEN p1 THEN 1 WHEN p2 THEN 2 WHEN p3 THEN 3 ELSE 4 END AS topic FROM m)
SELECT doc_id, topic, round(mx, 6) AS probability, row_number() OVER (PARTITION BY topic ORDER BY mx DESC, doc_id) AS rank FROM t QUALIFY rank <= 5""")
def h12(spark, sf):
    return rounded(h.topic_examples(docs(spark, sf), "doc_id"))


@query("H13_name_topics", f"""WITH {WORDS} SELECT topic, CASE WHEN bool_or(term IN ('the', 'and')) THEN 'north' WHEN bool_or(term IN ('der', 'und')) THEN 'east' WHEN bool_or(term IN ('le', 'les')) THEN 'west' ELSE 'General' END AS name FROM tw WHERE rank <= 5 GROUP BY 1""")
def h13(spark, sf):
    return h.name_topics(lang_words(spark, sf), [("north", ["the", "and"]), ("east", ["der", "und"]), ("west", ["le", "les"])])


@query("H14_topic_usage", f"""WITH m AS (SELECT *, greatest(p0, p1, p2, p3, p4) AS mx FROM ({MIX})), d AS (SELECT CASE mx WHEN p0 THEN 0 WHEN p1 THEN 1 WHEN p2 THEN 2 WHEN p3 THEN 3 ELSE 4 END AS topic, count(*) AS documents FROM m GROUP BY 1)
SELECT topic, round(avg(p), 6) AS mean_probability, coalesce(max(documents), 0) AS documents FROM ({LONG}) LEFT JOIN d USING (topic) GROUP BY 1""")
def h14(spark, sf):
    return rounded(h.topic_usage(docs(spark, sf), 5))


@query("H09_language_windows", WT + """, r AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY p DESC, topic) <= 2 AS top FROM wt) SELECT topic, round(avg(top::INT), 6) AS frequency FROM r GROUP BY 1""")
def h09b(spark, sf):
    return rounded(h.window_topics(lang_windows(spark, sf), 2).select("topic", "frequency"))


