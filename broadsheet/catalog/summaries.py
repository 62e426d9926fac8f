"""Rows Y on documents."""

from pyspark.sql import functions as F

from broadsheet.catalog.relations import rounded
from broadsheet.catalog.tables import articles, list_sql, sentences_sql, tokens_sql, words_sql
from broadsheet.functions import text as tx
from broadsheet.functions.wordlists import TRANSITIONS
from broadsheet.operators import summarize as y
from broadsheet.registry import query

STOP = ["the", "and", "of", "der", "die", "la", "de", "que", "le", "el"]


def docs(spark, sf):
    return articles(spark, sf, "lang")


def words_of(c):
    return words_sql(c)


COLLAPSED = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


def prepared_sql(min_words=5, min_chars=100):
    s = f"string_split(regexp_replace({COLLAPSED}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"
    kept = f"list_filter(list_transform({s}, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: len({words_sql('x')}) >= {min_words})"
    return f"SELECT doc_id, i AS pos, s[i + 1] AS sentence FROM (SELECT doc_id, {kept} AS s FROM documents WHERE length(text) >= {min_chars}), unnest(range(0, len(s))) AS u(i)"


TOK = f"list_filter({tokens_sql('sentence')}, lambda t: length(t) >= 2 AND NOT list_contains({list_sql(STOP)}, t))"


def within_sql(max_features=None, source="s"):
    """CTEs s0, tf, w (doc_id, pos, term, tfidf) over sentences of every document."""
    cut = f" QUALIFY dense_rank() OVER (PARTITION BY doc_id ORDER BY total DESC, term) <= {max_features}" if max_features else ""
    return f"""tf AS (SELECT doc_id, pos, term, count(*) AS tf FROM (SELECT doc_id, pos, unnest({TOK}) AS term FROM {source}) GROUP BY ALL),
sz AS (SELECT doc_id, count(*) AS n FROM {source} GROUP BY 1),
tt AS (SELECT *, count(*) OVER (PARTITION BY doc_id, term) AS df, sum(tf) OVER (PARTITION BY doc_id, term) AS total FROM tf),
tc AS (SELECT * FROM tt{cut}), rw AS (SELECT doc_id, pos, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tc JOIN sz USING (doc_id)),
w AS (SELECT doc_id, pos, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, pos)) AS tfidf FROM rw)"""


SIMPLE = f"""s AS ({prepared_sql()}), {within_sql(100)}, sm AS (SELECT doc_id, pos, sum(tfidf) AS t FROM w GROUP BY ALL),
i AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i FROM s),
sc AS (SELECT doc_id, pos, sentence, n, coalesce(t, 0) * 0.5::DOUBLE + (1 - i / n::DOUBLE) * 0.3::DOUBLE + least(len({words_sql('sentence')}) / 20.0::DOUBLE, 1.0) * 0.2::DOUBLE AS score FROM i LEFT JOIN sm USING (doc_id, pos)),
ch AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, pos) <= CASE WHEN n <= 3 THEN n ELSE greatest(2, floor(n * {{ratio}}::DOUBLE)) END)"""


def joined(cte, ratio="0.25"):
    return "WITH " + cte.replace("{ratio}", ratio) + " SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS summary, count(*) AS kept_sentences, max(n) AS sentences FROM ch GROUP BY 1"


@query("Y01_prepare_sentences", prepared_sql())
def y01(spark, sf):
    return y.prepare_sentences(docs(spark, sf), "doc_id", "text")


@query("Y02_summarize", joined(SIMPLE))
def y02(spark, sf):
    return y.summarize(docs(spark, sf), "doc_id", "text", stopwords=STOP)


CENTROID = f"""s AS ({prepared_sql()}), {within_sql()}, c AS (SELECT doc_id, term, sum(tfidf) AS c FROM w GROUP BY ALL), nm AS (SELECT doc_id, sqrt(sum(c * c)) AS nm FROM c GROUP BY 1),
sm AS (SELECT doc_id, pos, sum(tfidf * c) AS d FROM w JOIN c USING (doc_id, term) GROUP BY ALL),
i AS (SELECT *, {words_sql('sentence')} AS ws, count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i FROM s),
sc AS (SELECT doc_id, pos, sentence, n, coalesce(d / nm, 0) * 0.3::DOUBLE + (1 - i / n::DOUBLE) * 0.2::DOUBLE + greatest(0, least(1, 1 - abs(len(ws) - 15) / 30.0::DOUBLE)) * 0.2::DOUBLE
  + len(list_filter(ws[2:], lambda x: regexp_matches(x, '^\\p{{L}}') AND regexp_matches(x, '^\\p{{Lu}}')))::DOUBLE / len(ws) * 0.2::DOUBLE + len(list_filter(ws, lambda x: regexp_matches(x, '\\d')))::DOUBLE / len(ws) * 0.1::DOUBLE AS score
  FROM i LEFT JOIN sm USING (doc_id, pos) LEFT JOIN nm USING (doc_id)),
ch AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, pos) <= CASE WHEN n <= 3 THEN n ELSE least(n - 1, greatest(2, floor(n * 0.25::DOUBLE))) END)"""


@query("Y03_summarize_centroid", joined(CENTROID))
def y03(spark, sf):
    return y.summarize(docs(spark, sf), "doc_id", "text", method="centroid", stopwords=STOP)


def coherence_sql(sents):
    hits = " + ".join(f"CAST(contains(lower(x), '{t}') AS INTEGER)" for t in TRANSITIONS)
    return f"""CASE WHEN len({sents}) = 0 THEN 0 ELSE (least(list_sum(list_transform({sents}, lambda x: {hits}))::DOUBLE / len({sents}), 1.0)
  + greatest(0, 1 - sqrt(greatest(list_avg(list_transform({sents}, lambda x: len({words_sql('x')}) * len({words_sql('x')}))) - pow(list_avg(list_transform({sents}, lambda x: len({words_sql('x')}))), 2), 0)) / list_avg(list_transform({sents}, lambda x: len({words_sql('x')}))))) / 2 END"""


@query("Y06_summary_coherence", f"SELECT doc_id, round({coherence_sql('s')}, 6) AS coherence FROM (SELECT doc_id, {sentences_sql('text')} AS s FROM documents)")
def y06(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(tx.coherence(tx.sentences("text")), 6).alias("coherence"))


def quality_sql():
    tok = lambda c: f"list_distinct(list_filter({tokens_sql(c)}, lambda t: length(t) > 3))"
    return f"""SELECT *, keyword_preservation * 0.3::DOUBLE + coherence * 0.3::DOUBLE + greatest(0, least(readability / 100, 1)) * 0.2::DOUBLE + CASE WHEN compression BETWEEN 0.1 AND 0.5 THEN 1.0 ELSE 0.5 END::DOUBLE * 0.2::DOUBLE AS overall FROM (
SELECT doc_id, len({words_sql('summary')})::DOUBLE / len({words_sql('text')}) AS compression, CASE WHEN len({tok('text')}) = 0 THEN 0 ELSE len(list_intersect({tok('text')}, {tok('summary')}))::DOUBLE / len({tok('text')}) END AS keyword_preservation,
  206.835::DOUBLE - 1.015::DOUBLE * (greatest(len(ws), 1)::DOUBLE / greatest(len(s), 1)) - 84.6::DOUBLE * (list_sum(list_transform(ws, lambda x: greatest(len(regexp_extract_all(lower(x), '[aeiouy]+')), 1)))::DOUBLE / greatest(len(ws), 1)) AS readability,
  {coherence_sql('s')} AS coherence FROM (SELECT doc_id, text, summary, {words_sql('summary')} AS ws, {sentences_sql('summary')} AS s FROM ({joined(SIMPLE)}) JOIN documents USING (doc_id)))"""


def quality(spark, sf):
    d = docs(spark, sf)
    return y.summary_quality(d.join(y.summarize(d, "doc_id", "text", stopwords=STOP), "doc_id"), "text", "summary")


@query("Y04_summary_quality", f"""SELECT doc_id, round(compression, 6) AS compression, round(keyword_preservation, 6) AS keyword_preservation, round(readability, 6) AS readability, round(coherence, 6) AS coherence, round(overall, 6) AS overall,
  CASE WHEN overall >= 0.8 THEN 'excellent' WHEN overall >= 0.6 THEN 'good' WHEN overall >= 0.4 THEN 'fair' ELSE 'poor' END AS grade FROM ({quality_sql()})""")
def y04(spark, sf):
    return rounded(quality(spark, sf).select("doc_id", "compression", "keyword_preservation", "readability", "coherence", "overall", "grade"))


@query("Y05_doc_keywords", f"""WITH s AS ({prepared_sql(1, 0)}), {within_sql()}, m AS (SELECT doc_id, term, sum(tfidf) / max(n) AS score FROM w JOIN sz USING (doc_id) GROUP BY ALL)
SELECT doc_id, term, round(score, 6) AS score, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, term) AS rank FROM m QUALIFY rank <= 20""")
def y05(spark, sf):
    return rounded(y.doc_keywords(docs(spark, sf), "doc_id", "text", stopwords=STOP))


GROUP = f"""WITH {SIMPLE.replace('{ratio}', '0.1')}, p AS (SELECT lang, doc_id, pos, sentence, row_number() OVER (PARTITION BY lang ORDER BY doc_id, pos) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM (SELECT doc_id, pos, sentence FROM ch) JOIN documents USING (doc_id)),
gt AS (SELECT lang, place, term, count(*) AS tf FROM (SELECT lang, place, unnest({TOK}) AS term FROM p) GROUP BY ALL),
gv AS (SELECT lang, term, count(*) AS df, sum(tf) AS total FROM gt GROUP BY lang, term QUALIFY row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) <= 100),
gw AS (SELECT lang, place, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM gt JOIN gv USING (lang, term) JOIN (SELECT DISTINCT lang, n FROM p) USING (lang)),
gs AS (SELECT lang, place, sum(w) / sqrt(sum(w * w)) AS t FROM gw GROUP BY ALL),
gc AS (SELECT lang, place, doc_id, sentence, n, coalesce(t, 0) * 0.5::DOUBLE + (1 - place / n::DOUBLE) * 0.3::DOUBLE + least(len({words_sql('sentence')}) / 20.0::DOUBLE, 1.0) * 0.2::DOUBLE AS score FROM p LEFT JOIN gs USING (lang, place))
SELECT lang, place, doc_id, sentence, round(score, 6) AS score FROM gc QUALIFY row_number() OVER (PARTITION BY lang ORDER BY round(score, 9) DESC, place) <= CASE WHEN n <= 3 THEN n ELSE greatest(2, floor(n * 0.1::DOUBLE)) END"""


@query("Y07_summarize_group", GROUP)
def y07(spark, sf):
    return rounded(y.summarize_group(docs(spark, sf), "lang", "doc_id", "text", kind="brief", stopwords=STOP))


TOPIC = ["thion", "oiele", "schkeit"]
TOPIC_HIT = " OR ".join(f"contains(lower(sentence), '{t}')" for t in TOPIC)


@query("Y08_filter_sentences_by_topic", f"""WITH s AS ({prepared_sql()}), f AS (SELECT *, ({TOPIC_HIT}) AS hit FROM s),
g AS (SELECT *, sum(hit::INT) OVER (PARTITION BY doc_id) AS n, max(hit::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM f)
SELECT doc_id, pos, sentence FROM g WHERE CASE WHEN n < 3 THEN near = 1 ELSE hit END""")
def y08(spark, sf):
    return y.filter_sentences_by_topic(y.prepare_sentences(docs(spark, sf), "doc_id", "text"), "doc_id", ["pos"], TOPIC)


@query("Y09_headlines")
def y09(spark, sf):
    return y.headlines(docs(spark, sf), "doc_id", "text")


@query("Y10_key_themes", f"""WITH t AS (SELECT lang, doc_id, {tokens_sql('text')} AS t FROM documents), g AS (SELECT lang, doc_id, unnest(t) AS term FROM t UNION ALL SELECT lang, doc_id, t[i] || ' ' || t[i + 1] FROM t, unnest(range(1, len(t))) AS u(i)),
tf AS (SELECT lang, doc_id, term, count(*) AS tf FROM g GROUP BY ALL), sz AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1),
v AS (SELECT lang, term, count(*) AS df, sum(tf) AS total, max(n) AS n FROM tf JOIN sz USING (lang) GROUP BY lang, term HAVING count(*) >= 2 AND count(*) <= 0.8::DOUBLE * max(n) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) <= 50),
r AS (SELECT lang, doc_id, term, n, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN v USING (lang, term)),
w AS (SELECT lang, term, n, w / sqrt(sum(w * w) OVER (PARTITION BY lang, doc_id)) AS x FROM r), m AS (SELECT lang, term, sum(x) / max(n) AS score FROM w GROUP BY ALL)
SELECT lang, term, round(score, 6) AS score, row_number() OVER (PARTITION BY lang ORDER BY round(score, 9) DESC, term) AS rank FROM m QUALIFY rank <= 20""")
def y10(spark, sf):
    d = docs(spark, sf).select("lang", "doc_id", tx.word_tokens("text").alias("tokens"))
    return rounded(y.key_themes(d, "lang", "doc_id", "tokens"))


@query("Y11_summary_stats", f"SELECT 'simple' AS method, count(*) AS summaries, round(avg(compression), 6) AS mean_compression, round(avg(overall), 6) AS mean_quality FROM ({quality_sql()})")
def y11(spark, sf):
    return rounded(y.summary_stats(quality(spark, sf).withColumn("method", F.lit("simple")), "method"))


@query("Y12_summarize_frequency", f"""WITH s AS ({prepared_sql()}), t AS (SELECT doc_id, pos, unnest({TOK}) AS term FROM s), f AS (SELECT *, count(*) OVER (PARTITION BY doc_id, term) AS f FROM t),
m AS (SELECT doc_id, pos, avg(f) AS score FROM f GROUP BY ALL), sc AS (SELECT s.*, coalesce(score, 0) AS score, count(*) OVER (PARTITION BY doc_id) AS n FROM s LEFT JOIN m USING (doc_id, pos)),
ch AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, pos) <= 2)
SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS summary, count(*) AS kept_sentences, max(n) AS sentences FROM ch GROUP BY 1""")
def y12(spark, sf):
    return y.summarize(docs(spark, sf), "doc_id", "text", method="frequency", n=2, stopwords=STOP)
