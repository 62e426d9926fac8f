"""Rows L01-L21 and the text rows that depend on a language pair (F29-F31)."""

from pyspark.sql import functions as F

from broadsheet.catalog.flagship import TEST_LEXICON, TEST_NEGATIONS, compound_sql
from broadsheet.catalog.relations import rounded
from broadsheet.catalog.tables import DATED, dated, hits_sql, list_sql, sentences_sql, table, tokens_sql, words_sql
from broadsheet.functions import text as tx
from broadsheet.operators import lang as lg
from broadsheet.operators.sentiment import label_compound, lexicon_sentiment
from broadsheet.registry import query

PROFILES = {
    "en": "the and of to is on that with for by at an in are".split(),
    "fr": "le la les et des du un une en que qui aux avec par dans elle".split(),
    "de": "der die und das ist den nicht mit von zu ein auf für sch".split(),
    "es": "el la los las de que y en un una con para por no".split(),
}
LANGS = sorted(PROFILES)
W = words_sql("text")


def detect_sql(source, id_expr, text="text"):
    """id_expr columns, language and language_score for every row of source."""
    cols = ", ".join(f"CASE WHEN len(tk) = 0 THEN 0 ELSE len(list_filter(tk, lambda t: list_contains({list_sql(PROFILES[l])}, t)))::DOUBLE / len(tk) END AS l_{l}" for l in LANGS)
    best = "greatest(" + ", ".join(f"l_{l}" for l in LANGS) + ")"
    pick = "CASE " + " ".join(f"WHEN l_{l} = {best} THEN '{l}'" for l in LANGS) + " END"
    ok = f"(length(regexp_replace({text}, '^\\s+|\\s+$', '', 'g')) >= 3 AND {best} > 0)"
    return (f"SELECT {id_expr}, CASE WHEN {ok} THEN {pick} ELSE 'unknown' END AS language, CASE WHEN {ok} THEN {best} ELSE 0 END AS language_score "
            f"FROM (SELECT *, {cols} FROM (SELECT *, {tokens_sql(text)} AS tk FROM {source}))")


DETECTED = detect_sql("documents", "doc_id, lang, length(text) AS n, text")  # noqa: E501


def detected(spark, sf):
    return lg.detect_language(table(spark, sf, "documents").select("doc_id", "lang", "text"), "text", PROFILES)


@query("L01_detect_language", f"SELECT doc_id, lang, language, round(language_score, 6) AS language_score FROM ({DETECTED})")
def l01(spark, sf):
    return rounded(detected(spark, sf).select("doc_id", "lang", "language", "language_score"))


@query("L01_detect_language_default_profiles")
def l01b(spark, sf):
    return lg.detect_language(table(spark, sf, "documents").select("doc_id", "lang", "text"), "text").select("doc_id", "lang", "language", "language_score")


@query("L01_language_model")
def l01c(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    model = lg.language_model(d, "text", "lang")
    return model.transform(d).select("doc_id", "lang", "prediction")


COMBINED = f"""SELECT doc_id, n, text, lang, CASE WHEN language = 'unknown' THEN NULL ELSE language END AS l1, language_score AS c1, lang AS l2, 0.9::DOUBLE AS c2 FROM ({DETECTED})"""
COMBINED = f"""SELECT *, coalesce(l1, l2) AS language, CASE WHEN l1 = l2 THEN (c1 * 0.6::DOUBLE + c2 * 0.4::DOUBLE) / (0.6::DOUBLE + 0.4::DOUBLE) WHEN l1 IS NOT NULL THEN c1 ELSE c2 END AS confidence,
  CASE WHEN l1 <> l2 THEN 0.5 ELSE 1.0 END AS agreement FROM ({COMBINED})"""


def combined(spark, sf):
    d = detected(spark, sf)
    one = F.when(F.col("language") != "unknown", F.col("language"))
    return d.withColumn("c", lg.combine_detections((one, F.col("language_score")), (F.col("lang"), F.lit(0.9)))).select("doc_id", "text", "lang", "c.*")


@query("L02_combine_detections", f"SELECT doc_id, language, round(confidence, 6) AS confidence, agreement::DOUBLE AS agreement FROM ({COMBINED})")
def l02(spark, sf):
    return rounded(combined(spark, sf).drop("text", "lang"))


TEST_REGIONS = {"en_US": ["the", "thion"], "en_UK": ["and", "ouor"], "fr_FR": ["elle", "chan"], "fr_CA": ["tion", "reau"], "de_DE": ["sch", "ver"], "de_AT": ["und"], "es_ES": ["para"], "es_MX": ["con", "dad"]}
KEYS = {l: [k for k in TEST_REGIONS if k.startswith(l)] for l in ("en", "fr", "de", "es")}


def region_sql():
    hits = ", ".join(f"{hits_sql('low', w)} AS h_{k}" for k, w in TEST_REGIONS.items())
    region = "CASE lang " + " ".join(
        f"WHEN '{l}' THEN CASE " + (f"WHEN greatest({', '.join('h_' + k for k in ks)}) = 0 THEN '{ks[0]}' ") + " ".join(f"WHEN h_{k} = greatest({', '.join('h_' + x for x in ks)}) THEN '{k}'" for k in ks) + " END" for l, ks in KEYS.items()) + " END"
    best = "CASE lang " + " ".join(f"WHEN '{l}' THEN greatest({', '.join('h_' + k for k in ks)})" for l, ks in KEYS.items()) + " END"
    return f"SELECT doc_id, {region} AS region, round(CASE WHEN {best} > 0 THEN least({best} * 100.0::DOUBLE / greatest(n, 1), 1.0) ELSE 0.1 END, 6) AS region_confidence FROM (SELECT *, {hits} FROM (SELECT doc_id, lang, lower(text) AS low, len({W}) AS n FROM documents))"


@query("L03_regional_variant", region_sql())
def l03(spark, sf):
    return rounded(lg.regional_variant(table(spark, sf, "documents"), "text", "lang", TEST_REGIONS).select("doc_id", "region", "region_confidence"))


MARKERS = {l: [w for k in ks for w in TEST_REGIONS[k]] for l, ks in KEYS.items()}
CONTEXT = ("SELECT *, CASE lang " + " ".join(f"WHEN '{l}' THEN list_filter({list_sql(w)}, lambda w: contains(low, w))" for l, w in MARKERS.items())
           + f" ELSE [] END AS markers FROM (SELECT doc_id, lang, text, lower(text) AS low, len({W}) AS nw FROM documents)")
CONTEXT = f"SELECT *, least(len(markers) / greatest(nw / 100.0::DOUBLE, 1.0), 1.0) AS context_score FROM ({CONTEXT})"


@query("L04_cultural_context", f"SELECT doc_id, array_to_string(markers, ',') AS markers, round(context_score, 6) AS context_score, CASE lang WHEN 'en' THEN 'Germanic' WHEN 'de' THEN 'Germanic' ELSE 'Romance' END AS family FROM ({CONTEXT})")
def l04(spark, sf):
    d = lg.cultural_context(table(spark, sf, "documents"), "text", "lang", TEST_REGIONS)
    return rounded(d.select("doc_id", F.array_join("markers", ",").alias("markers"), "context_score", "family"))


@query("L05_detection_confidence", f"""SELECT doc_id, round(s, 6) AS confidence, CASE WHEN round(s, 6) >= 0.8 THEN 'high' WHEN round(s, 6) >= 0.6 THEN 'medium' WHEN round(s, 6) >= 0.4 THEN 'low' ELSE 'very_low' END AS level
FROM (SELECT doc_id, agreement::DOUBLE * 0.4::DOUBLE + confidence * 0.3::DOUBLE + least(n / 200.0::DOUBLE, 1.0) * 0.2::DOUBLE + context_score * 0.1::DOUBLE AS s FROM ({COMBINED}) JOIN (SELECT doc_id, context_score FROM ({CONTEXT})) USING (doc_id))""")
def l05(spark, sf):
    c = lg.cultural_context(combined(spark, sf), "text", "lang", TEST_REGIONS)
    d = c.withColumn("d", lg.detection_confidence(F.col("agreement"), F.col("confidence"), F.length("text"), F.col("context_score"))["confidence"])
    from broadsheet.operators.relational import confidence_band
    return d.select("doc_id", F.round("d", 6).alias("confidence")).withColumn("level", confidence_band(F.col("confidence")))


SEGMENTS = f"""(SELECT doc_id, i, seg[i + 1] AS text FROM (SELECT doc_id, CASE WHEN len(s) > 1 THEN s WHEN len(p) > 1 THEN p
  ELSE list_transform(range(1, length(text) + 1, 200), lambda k: substring(text, k, 200)) END AS seg FROM
  (SELECT doc_id, text, list_transform({sentences_sql('text')}, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS s,
   list_filter(list_transform(regexp_split_to_array(text, '\\n\\s*\\n'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS p FROM documents)),
  unnest(range(0, len(seg))) AS u(i) WHERE length(seg[i + 1]) >= 10)"""
MIXED = f"""WITH d AS (SELECT * FROM ({detect_sql(SEGMENTS, 'doc_id, length(text) AS n')}) WHERE language <> 'unknown' AND language_score >= 0.1),
w AS (SELECT doc_id, language, sum(n * language_score) AS weight, count(*) AS segments FROM d GROUP BY 1, 2)
SELECT doc_id, language, segments, round(weight / sum(weight) OVER p, 6) AS share, first_value(language) OVER (PARTITION BY doc_id ORDER BY round(weight, 6) DESC, language DESC) AS primary_language,
  CAST(count(*) OVER p > 1 AS INTEGER) AS is_multilingual FROM w WINDOW p AS (PARTITION BY doc_id)"""


@query("L06_detect_mixed", MIXED)
def l06(spark, sf):
    return rounded(lg.detect_mixed(table(spark, sf, "documents"), "doc_id", "text", PROFILES)).withColumn("is_multilingual", F.col("is_multilingual").cast("int"))


def trends(spark, sf):
    d = lg.detect_language(dated(spark, sf, "lang"), "text", PROFILES)
    return lg.language_trends(d, "language", "language_score", "date", 0.1)


TREND = f"(SELECT language, date FROM ({detect_sql(DATED, 'date')}) WHERE language_score > 0.1)"


@query("L07_language_trends", f"SELECT language, count(*) AS rows, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share, CAST(count(*) = max(count(*)) OVER () AS INTEGER) AS dominant FROM {TREND} GROUP BY 1")
def l07(spark, sf):
    return rounded(trends(spark, sf)["shares"]).withColumn("dominant", F.col("dominant").cast("int"))


@query("L07_language_series", f"SELECT language, CAST(date AS VARCHAR) AS date, count(*) AS rows FROM {TREND} GROUP BY 1, 2")
def l07b(spark, sf):
    return trends(spark, sf)["series"].withColumn("date", F.col("date").cast("string"))


@query("L07_language_diversity", f"WITH p AS (SELECT count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM {TREND} GROUP BY language) SELECT round(-sum(p * log2(p)), 6) AS entropy_bits, count(*) AS values FROM p")
def l07c(spark, sf):
    return rounded(trends(spark, sf)["diversity"])


KEYWORDS = ["the", "tion", "sch", "para", "elle"]
COVERAGE = "SELECT lang, docs, mean_length, std_length, keyword, coverage FROM (" + " UNION ALL ".join(
    f"SELECT lang, count(*) AS docs, avg(length(text)) AS mean_length, stddev_pop(length(text)) AS std_length, '{k}' AS keyword, avg(CAST(contains(lower(text), '{k}') AS INTEGER)) AS coverage FROM documents GROUP BY 1" for k in KEYWORDS) + ")"


def coverage(spark, sf):
    return lg.language_coverage(table(spark, sf, "documents"), "lang", "text", KEYWORDS)


@query("L08_language_coverage", f"SELECT lang, docs, round(mean_length, 6) AS mean_length, round(std_length, 6) AS std_length, keyword, round(coverage, 6) AS coverage FROM ({COVERAGE})")
def l08(spark, sf):
    return rounded(coverage(spark, sf))


@query("L08_keyword_samples", f"""SELECT lang, k AS keyword, doc_id, row_number() OVER (PARTITION BY lang, k ORDER BY doc_id) AS rank FROM documents, unnest({list_sql(KEYWORDS)}) AS u(k)
WHERE contains(lower(text), k) QUALIFY rank <= 3""")
def l08b(spark, sf):
    return lg.keyword_samples(table(spark, sf, "documents"), "doc_id", "lang", "text", KEYWORDS)


SENT = f"""SELECT lang, count(*) AS rows, avg(compound) AS mean_sentiment, stddev_pop(compound) AS std_sentiment, avg(CAST(compound > 0.1 AS INTEGER)) AS positive_ratio,
  avg(CAST(compound < -0.1 AS INTEGER)) AS negative_ratio FROM ({compound_sql('documents', keep='lang')}) GROUP BY 1"""


def scored(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "text").withColumn("tokens", tx.word_tokens("text"))
    return lexicon_sentiment(d, "tokens", TEST_LEXICON, TEST_NEGATIONS)


@query("L09_language_sentiment", f"SELECT lang, rows, round(mean_sentiment, 6) AS mean_sentiment, round(std_sentiment, 6) AS std_sentiment, round(positive_ratio, 6) AS positive_ratio, round(negative_ratio, 6) AS negative_ratio FROM ({SENT})")
def l09(spark, sf):
    return rounded(lg.language_sentiment(scored(spark, sf), "lang"))


@query("L10_language_timeline", f"""WITH d AS (SELECT lang, date AS day, count(*) AS n FROM {DATED} GROUP BY 1, 2)
SELECT lang, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, max(day) - min(day) AS span_days, CAST(sum(n) AS BIGINT) AS rows,
  round(sum(n)::DOUBLE / greatest(max(day) - min(day), 1), 6) AS per_day, CAST(arg_max(day, (n, -(day - DATE '1970-01-01'))) AS VARCHAR) AS peak_day, max(n) AS peak_rows FROM d GROUP BY 1""")
def l10(spark, sf):
    return rounded(lg.language_timeline(dated(spark, sf, "lang"), "lang", "date")).withColumns(
        {c: F.col(c).cast("string") for c in ("first_day", "last_day", "peak_day")})


TEST_CULTURES = {"western": {"values": ["the", "tion", "nochance"], "institutions": ["ing"]}, "latin_american": {"values": ["para", "ció"]},
                 "african": {"values": ["elle", "tion"], "institutions": ["eau"]}}
CULT_OF = {"en": ["western"], "es": ["western", "latin_american"], "fr": ["western", "african"], "de": ["western"]}
FOUND = " UNION ALL ".join(
    f"SELECT lang, '{c}' AS culture, '{kind}' AS kind, '{m}' AS marker FROM documents WHERE lang IN ({', '.join(chr(39) + l + chr(39) for l, cs in CULT_OF.items() if c in cs)}) GROUP BY lang HAVING bool_or(contains(lower(text), '{m}'))"
    for c, kinds in TEST_CULTURES.items() for kind, ms in kinds.items() for m in ms)


def found(spark, sf):
    return lg.cultural_markers(table(spark, sf, "documents"), "lang", "text", TEST_CULTURES, CULT_OF)


@query("L11_cultural_markers", FOUND)
def l11(spark, sf):
    return found(spark, sf)


@query("L11_culture_scores", f"""WITH f AS (SELECT lang, culture, count(*) AS markers FROM ({FOUND}) GROUP BY 1, 2), w AS (SELECT lang, sum(len({W})) AS w FROM documents GROUP BY 1)
SELECT lang, culture, markers, round(markers / greatest(w / 1000.0::DOUBLE, 1.0), 6) AS score, CAST(row_number() OVER (PARTITION BY lang ORDER BY markers DESC, culture) = 1 AS INTEGER) AS dominant FROM f JOIN w USING (lang)""")
def l11b(spark, sf):
    return rounded(lg.culture_scores(table(spark, sf, "documents"), "lang", "text", found(spark, sf))).withColumn("dominant", F.col("dominant").cast("int"))


PAIRS = f"""WITH cov AS ({COVERAGE}), s AS ({SENT}), b AS (SELECT DISTINCT lang, docs, mean_length, mean_sentiment, positive_ratio FROM cov JOIN s USING (lang)),
o AS (SELECT x.lang AS lang_1, y.lang AS lang_2, CASE WHEN greatest(x.coverage, y.coverage) > 0 THEN least(x.coverage, y.coverage) / greatest(x.coverage, y.coverage) ELSE 1.0 END AS o
  FROM cov x JOIN cov y ON x.keyword = y.keyword AND x.lang < y.lang),
t AS (SELECT lang_1, lang_2, avg(o) AS topic_overlap, count(*) FILTER (o > 0.8) AS high_overlap, count(*) FILTER (o < 0.3) AS low_overlap FROM o GROUP BY 1, 2),
pairs AS (SELECT p.lang AS lang_1, q.lang AS lang_2, p.docs::DOUBLE / q.docs AS count_ratio, p.mean_length / q.mean_length AS length_ratio, topic_overlap, high_overlap, low_overlap,
  abs(p.mean_sentiment - q.mean_sentiment) AS sentiment_difference, abs(p.positive_ratio - q.positive_ratio) AS positivity_difference,
  CASE WHEN p.mean_sentiment > q.mean_sentiment THEN p.lang ELSE q.lang END AS more_positive FROM b p JOIN b q ON p.lang < q.lang JOIN t ON t.lang_1 = p.lang AND t.lang_2 = q.lang)
"""


def pairs(spark, sf):
    return lg.compare_languages(coverage(spark, sf), lg.language_sentiment(scored(spark, sf), "lang"), "lang")


@query("L12_compare_languages", PAIRS + """SELECT lang_1, lang_2, round(count_ratio, 6) AS count_ratio, round(length_ratio, 6) AS length_ratio, round(topic_overlap, 6) AS topic_overlap, high_overlap, low_overlap,
  round(sentiment_difference, 6) AS sentiment_difference, round(positivity_difference, 6) AS positivity_difference, more_positive FROM pairs""")
def l12(spark, sf):
    return rounded(pairs(spark, sf))


TEST_CONFLICTS = {"north_vs_south": {"north": ["the", "ing"], "south": ["para", "ció"]}, "never": {"a": ["qqqq"], "b": ["tion"]}}


@query("L13_perspective_conflicts", f"""WITH f AS ({FOUND}), p AS (SELECT lang, bool_or(contains(marker, 'the') OR contains(marker, 'ing')) AS a, bool_or(contains(marker, 'para') OR contains(marker, 'ció')) AS b FROM f GROUP BY 1)
SELECT 'conflict' AS kind, 'north_vs_south' AS name, 'north' AS side_1, 'south' AS side_2, count(*) FILTER (a) AS languages_1, count(*) FILTER (b) AS languages_2 FROM p HAVING count(*) FILTER (a) > 0 AND count(*) FILTER (b) > 0
UNION ALL SELECT 'bridge', 'tion', NULL, NULL, count(DISTINCT lang), count(DISTINCT lang) FROM f WHERE contains(marker, 'tion') HAVING count(DISTINCT lang) >= 2""")
def l13(spark, sf):
    return lg.perspective_conflicts(found(spark, sf), "lang", TEST_CONFLICTS, ["tion", "para"])


@query("L14_coverage_gaps", f"""WITH cov AS ({COVERAGE}), b AS (SELECT DISTINCT lang, docs, max(docs) OVER () AS m FROM cov), k AS (SELECT *, max(coverage) OVER (PARTITION BY keyword) AS b FROM cov)
SELECT 'volume' AS gap, lang, NULL AS keyword, round(docs::DOUBLE / m, 6) AS share, CASE WHEN docs < m * 0.2::DOUBLE THEN 'high' ELSE 'medium' END AS severity FROM b WHERE docs < m * 0.5::DOUBLE
UNION ALL SELECT 'topic', lang, keyword, round(coverage / b, 6), 'medium' FROM k WHERE b > 0 AND coverage < b * 0.3::DOUBLE""")
def l14(spark, sf):
    return rounded(lg.coverage_gaps(coverage(spark, sf), "lang"))


@query("L15_language_dominance", """WITH p AS (SELECT lang, count(*) AS docs, avg(length(text)) AS mean_length FROM documents GROUP BY 1),
s AS (SELECT *, docs * 100.0::DOUBLE / sum(docs) OVER () AS percentage, sum(docs * docs) OVER ()::DOUBLE / (sum(docs) OVER () * sum(docs) OVER ()) AS hhi FROM p)
SELECT lang, docs, round(mean_length, 6) AS mean_length, round(hhi, 6) AS hhi, round(percentage, 6) AS percentage, round(percentage * mean_length / 1000, 6) AS score,
  rank() OVER (ORDER BY percentage * mean_length DESC) AS rank, CASE WHEN hhi > 0.5 THEN 'highly_concentrated' WHEN hhi > 0.25 THEN 'moderately_concentrated' ELSE 'diverse' END AS concentration FROM s""")
def l15(spark, sf):
    return rounded(lg.language_dominance(table(spark, sf, "documents"), "lang", "text"))


@query("L16_cross_lingual_insights", PAIRS + """SELECT count(*) AS pairs, concat_ws('; ', CASE WHEN avg(count_ratio) > 2 THEN 'coverage differs by more than two to one between languages' END,
  CASE WHEN avg(length_ratio) > 1.5 THEN 'texts of one language are more than half as long again as those of another' END,
  CASE WHEN avg(topic_overlap) < 0.5 THEN 'less than half of the topics are shared between languages' END) AS findings,
  concat_ws('; ', CASE WHEN avg(count_ratio) > 2 THEN 'publish more in the languages with few texts' END,
  CASE WHEN avg(topic_overlap) < 0.5 THEN 'compare which topics each language leaves out' END) AS recommendations FROM pairs""")
def l16(spark, sf):
    return lg.cross_lingual_insights(pairs(spark, sf)).select("pairs", *[F.array_join(c, "; ").alias(c) for c in ("findings", "recommendations")])


# Turns of a conversation stand in for parallel texts: a turn and its answer.
PARALLEL = "(SELECT a.conv_id, a.turn, a.text AS original, b.text AS translation, CASE a.conv_id % 3 WHEN 0 THEN 'fr' WHEN 1 THEN 'de' ELSE 'es' END AS dst FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"


def parallel(spark, sf):
    c = table(spark, sf, "conversations")
    k = F.col("conv_id") % 3
    return c.select("conv_id", "turn", F.col("text").alias("original")).join(
        c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("translation")), ["conv_id", "turn"]).withColumn(
        "dst", F.when(k == 0, "fr").when(k == 1, "de").otherwise("es"))


CHARSET = "CASE dst " + " ".join(f"WHEN '{l}' THEN (length({{t}}) < 50 OR regexp_matches(lower({{t}}), '[{lg.wl.EXPECTED_LETTERS[l]}]'))" for l in ("fr", "de", "es")) + " END"


@query("F31_charset_ok", f"SELECT doc_id, CAST({CHARSET.replace('CASE dst', 'CASE lang').format(t='text').replace(' END', ' ELSE true END')} AS INTEGER) AS ok FROM documents")
def f31(spark, sf):
    return table(spark, sf, "documents").select("doc_id", lg.charset_ok(F.col("text"), F.col("lang")).cast("int").alias("ok"))


OW, TW = words_sql("original"), words_sql("translation")
QUALITY = f"""SELECT *, (CAST(length_ratio BETWEEN 0.3 AND 3.0 AS INTEGER) + CAST(preservation >= 0.1 AS INTEGER) + CAST(coalesce(repetition <= 0.3, false) AS INTEGER) + CAST(cs AS INTEGER)) / 4.0::DOUBLE AS quality FROM (
SELECT conv_id, turn, dst, length(translation)::DOUBLE / length(original) AS length_ratio, CASE WHEN len(k) > 0 THEN len(list_intersect(k, tw))::DOUBLE / len(k) ELSE 1.0 END AS preservation,
  CASE WHEN len(tw) > 0 THEN (len(tw) - len(list_distinct(tw)))::DOUBLE / len(tw) END AS repetition, {CHARSET.format(t='translation')} AS cs FROM (
SELECT *, list_distinct(list_transform(list_filter({OW}, lambda w: regexp_matches(w, '^\\p{{Nd}}+$') OR regexp_matches(w, '^\\p{{Lu}}') OR length(w) > 10 OR list_contains({list_sql(lg.wl.ALWAYS_PRESERVED)}, lower(w))), lambda w: lower(w))) AS k,
  list_transform({TW}, lambda w: lower(w)) AS tw FROM {PARALLEL}))"""
GRADE = "CASE WHEN quality >= 0.8 THEN 'excellent' WHEN quality >= 0.6 THEN 'good' WHEN quality >= 0.4 THEN 'fair' ELSE 'poor' END"


def quality(spark, sf):
    return lg.translation_quality(parallel(spark, sf), "original", "translation", "dst")


@query("L17_translation_quality", f"SELECT conv_id, turn, round(length_ratio, 6) AS length_ratio, round(preservation, 6) AS preservation, round(repetition, 6) AS repetition, CAST(cs AS INTEGER) AS charset_ok, quality, {GRADE} AS grade FROM ({QUALITY})")
def l17(spark, sf):
    return rounded(quality(spark, sf).drop("original", "translation", "dst")).withColumn("charset_ok", F.col("charset_ok").cast("int"))


@query("L18_rank_translations", f"SELECT conv_id, turn, quality, row_number() OVER (PARTITION BY conv_id ORDER BY quality DESC, turn) AS rank, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY quality DESC, turn) = 1 AS INTEGER) AS best FROM ({QUALITY})")
def l18(spark, sf):
    return lg.rank_translations(quality(spark, sf), "conv_id", "turn").select("conv_id", "turn", "quality", "rank", F.col("best").cast("int"))


@query("L19_translation_stats", f"""SELECT src, dst, count(*) AS rows, round(avg(CAST(cs AS INTEGER)), 6) AS success_rate, round(avg(quality), 6) AS mean_quality, round(stddev_pop(quality), 6) AS std_quality,
  count(*) FILTER (g = 'excellent') AS excellent, count(*) FILTER (g = 'good') AS good, count(*) FILTER (g = 'fair') AS fair, count(*) FILTER (g = 'poor') AS poor FROM (SELECT *, 'xx' AS src, {GRADE} AS g FROM ({QUALITY})) GROUP BY 1, 2""")
def l19(spark, sf):
    return rounded(lg.translation_stats(quality(spark, sf).withColumn("src", F.lit("xx")), "src", "dst", "charset_ok"))


CONV = "(SELECT * FROM conversations)"
CSENT = f"SELECT conv_id, turn, CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment FROM ({compound_sql(CONV, keep='conv_id, turn')})"


@query("L20_sentiment_consistency", f"""WITH s AS ({CSENT}), o AS (SELECT conv_id, sentiment AS original FROM s WHERE turn = 0)
SELECT conv_id, original, count(sentiment) AS versions, count(*) FILTER (sentiment = original) AS agreeing, round(count(*) FILTER (sentiment = original)::DOUBLE / count(sentiment), 6) AS consistency
FROM s JOIN o USING (conv_id) WHERE turn > 0 GROUP BY 1, 2""")
def l20(spark, sf):
    c = lexicon_sentiment(table(spark, sf, "conversations").withColumn("tokens", tx.word_tokens("text")), "tokens", TEST_LEXICON, TEST_NEGATIONS)
    c = c.select("conv_id", "turn", label_compound(F.col("compound")).alias("sentiment"))
    return rounded(lg.sentiment_consistency(c.where("turn = 0"), c.where("turn > 0"), "conv_id"))


@query("L21_language_name", "SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' ELSE upper(lang) END AS name FROM documents")
def l21(spark, sf):
    return table(spark, sf, "documents").select("doc_id", lg.language_name(F.col("lang")).alias("name"))


BASE29 = "regexp_replace(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '\\s+([.,!?;:])', '\\1', 'g'), '([.,!?;:])\\s*([.,!?;:])', '\\1 \\2', 'g')"
FR29 = "t"
for _m, _r in ((":", ":"), (";", ";"), ("!", "!"), ("\\?", "?")):
    FR29 = f"regexp_replace({FR29}, '\\s*{_m}\\s*', ' {_r} ', 'g')"
DE29 = f"""array_to_string(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i > 1 AND length(w[i]) > 3 AND w[i] = lower(w[i]) AND regexp_matches(w[i], '\\p{{L}}') AND NOT starts_with(w[i], 'ß')
  AND list_contains(['der', 'die', 'das', 'ein', 'eine'], lower(w[i - 1])) THEN upper(substring(w[i], 1, 1)) || substring(w[i], 2) ELSE w[i] END), ' ')"""


@query("F29_fix_punctuation", f"""SELECT doc_id, CASE lang WHEN 'es' THEN regexp_replace(regexp_replace(t, '([¿¡])\\s+', '\\1', 'g'), '\\s+([?!])', '\\1', 'g') WHEN 'fr' THEN {FR29} WHEN 'de' THEN {DE29} ELSE t END AS text
FROM (SELECT *, {words_sql('t')} AS w FROM (SELECT doc_id, lang, {BASE29} AS t FROM documents))""")
def f29(spark, sf):
    return table(spark, sf, "documents").select("doc_id", lg.fix_punctuation(F.col("text"), F.col("lang")).alias("text"))


def swap_sql(text, rules):
    """Replace whole words, whatever their case; a word is a run of letters, digits and underscores."""
    cases = " ".join(f"WHEN lower(x) = '{a}' THEN '{b}'" for a, b in rules.items())
    return f"array_to_string(list_transform(regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+'), lambda x: CASE {cases} ELSE x END), '')"


@query("F30_localize", f"""SELECT doc_id, CASE WHEN lang <> 'en' THEN {swap_sql('t', {'miles': 'kilometers', 'the': 'THE'})} ELSE t END AS text FROM (
SELECT doc_id, lang, CASE WHEN lang IN ('de', 'fr', 'es') THEN regexp_replace(text, '(\\d{{1,2}})/(\\d{{1,2}})/(\\d{{4}})', '\\1.\\2.\\3', 'g') ELSE text END AS t FROM (
SELECT doc_id, lang, CASE lang WHEN 'es' THEN {swap_sql('text', {'para': 'por'})} WHEN 'de' THEN {swap_sql('text', {'die': 'der'})} ELSE text END AS text FROM documents))""")
def f30(spark, sf):
    return table(spark, sf, "documents").select("doc_id", lg.localize(
        F.col("text"), F.lit("en"), F.col("lang"), {("en", "es"): {"para": "por"}}, {("en", "de"): {"die": "der"}}, {"miles": "kilometers", "the": "THE"}).alias("text"))
