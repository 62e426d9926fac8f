"""Rows K, N, A04, A06, A07, A09, A13 and B on documents and conversations."""

from pyspark.sql import functions as F

from broadsheet.catalog.flagship import LABEL, TEST_LEXICON, TEST_NEGATIONS, compound_sql
from broadsheet.catalog.relations import rounded, trend9, trend_sql
from broadsheet.catalog.tables import DATED, articles, dated, hits_sql, list_sql, table, tokens_sql, words_sql
from broadsheet.catalog.texts import BIAS_READ, READ_SQL
from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.operators import bias as b
from broadsheet.operators import lexicon as lx
from broadsheet.operators import sentiment as s
from broadsheet.registry import query

LOW = "lower(text)"
W = words_sql("text")


def docs(spark, sf):
    return articles(spark, sf, "lang")


# ---- keywords

@query("K01_keyword_hits", f"SELECT doc_id, array_to_string(list_filter({list_sql(['the', 'tion', 'sch', 'para'])}, lambda w: contains({LOW}, w)), ',') AS hits, {hits_sql(LOW, ['the', 'tion', 'sch', 'para'])} AS n_hits FROM documents")
def k01(spark, sf):
    return lx.keyword_hits(docs(spark, sf), "text", ["the", "tion", "sch", "para"]).select("doc_id", F.array_join("hits", ",").alias("hits"), "n_hits")


@query("K02_token_hits", f"""WITH l AS (SELECT DISTINCT unnest({tokens_sql('text')}) AS word FROM benchmark), t AS (SELECT doc_id, unnest({tokens_sql('text')}) AS word FROM documents)
SELECT doc_id, count(l.word) AS n_hits, count(DISTINCT l.word) AS n_words FROM documents LEFT JOIN t USING (doc_id) LEFT JOIN l USING (word) GROUP BY 1""")
def k02(spark, sf):
    lexicon = table(spark, sf, "benchmark").select(F.explode(tx.word_tokens("text")).alias("word"))
    return lx.token_hits(docs(spark, sf), "doc_id", "text", lexicon)


RULES = [("north", ["thion", "ouor", "ingth"]), ("east", ["sch", "ung"]), ("south", ["para", "ción"]), ("west", ["eau", "elle"])]
RULE_CASE = "CASE " + " ".join("WHEN " + " OR ".join(f"contains({LOW}, '{t}')" for t in ts) + f" THEN '{l}'" for l, ts in RULES) + " END"


@query("K03_keyword_category", f"SELECT doc_id, coalesce({RULE_CASE}, 'other') AS keyword_category, CASE WHEN {RULE_CASE} IS NULL THEN 0.75 ELSE 0.85 END::DOUBLE AS category_confidence FROM documents")
def k03(spark, sf):
    return lx.keyword_category(docs(spark, sf), "text", RULES, "other").select("doc_id", "keyword_category", "category_confidence")


LONG_CASE = "CASE " + " ".join("WHEN " + " OR ".join(f"contains({LOW}, '{t}')" for t in ts) + f" THEN '{l}'" for l, ts in wl.CATEGORY_RULES_LONG) + " END"


@query("K03_keyword_category_default_rules", f"SELECT doc_id, coalesce({LONG_CASE}, 'business') AS keyword_category, CASE WHEN {LONG_CASE} IS NULL THEN 0.75 ELSE 0.85 END::DOUBLE AS category_confidence FROM documents")
def k03b(spark, sf):
    return lx.keyword_category(docs(spark, sf), "text").select("doc_id", "keyword_category", "category_confidence")


@query("K04_category_overrides", f"""SELECT doc_id, lang AS original_category, coalesce({RULE_CASE}, lang) AS label, CAST(coalesce({RULE_CASE} <> lang, false) AS INTEGER) AS corrected,
  CASE WHEN coalesce({RULE_CASE} <> lang, false) THEN greatest(c, 0.85::DOUBLE) ELSE c END AS confidence FROM (SELECT *, (doc_id % 10) / 10.0::DOUBLE AS c FROM documents)""")
def k04(spark, sf):
    d = docs(spark, sf).withColumns({"label": F.col("lang"), "confidence": (F.col("doc_id") % 10) / 10.0})
    return lx.apply_category_overrides(d, "text", "label", "confidence", RULES).select("doc_id", "original_category", "label", F.col("corrected").cast("int"), "confidence")


POS, NEG = ["the", "eau", "ción", "lich"], ["ing", "que", "sch", "tion"]
P_SQL, N_SQL = hits_sql(LOW, POS), hits_sql(LOW, NEG)


@query("K07_simple_sentiment", f"SELECT doc_id, CASE WHEN {P_SQL} > {N_SQL} THEN 'positive' WHEN {N_SQL} > {P_SQL} THEN 'negative' ELSE 'neutral' END AS label, CASE WHEN {P_SQL} = {N_SQL} THEN 0.5 ELSE 0.7 END::DOUBLE AS score FROM documents")
def k07(spark, sf):
    return docs(spark, sf).select("doc_id", lx.simple_sentiment(F.lower("text"), POS, NEG).alias("s")).select("doc_id", "s.*")


@query("K07_normalized_sentiment", f"""SELECT doc_id, round(CASE WHEN len(w) = 0 THEN 0 ELSE (len(list_filter(w, lambda x: list_contains(['the', 'la'], x))) - len(list_filter(w, lambda x: list_contains(['of', 'de'], x))))::DOUBLE / len(w) END, 6) AS score
FROM (SELECT doc_id, list_transform({W}, lambda x: lower(x)) AS w FROM documents)""")
def k07b(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(lx.normalized_sentiment(F.col("text"), ["the", "la"], ["of", "de"]), 6).alias("score"))


THEMES = {"en": {"sea": ["thion", "oning"], "land": ["eringe"]}, "fr": {"mer": ["eaueau"], "terre": ["tionch"]}, "de": {"see": ["schkeit"]}}
THEME_SQL = "CASE lang " + " ".join(f"WHEN '{l}' THEN concat_ws(',', " + ", ".join(f"CASE WHEN {' OR '.join(f'contains({LOW}, {chr(39)}{t}{chr(39)})' for t in ts)} THEN '{n}' END" for n, ts in th.items()) + ")" for l, th in THEMES.items()) + " ELSE '' END"


@query("K08_theme_tags", f"SELECT doc_id, {THEME_SQL} AS themes FROM documents")
def k08(spark, sf):
    return lx.theme_tags(docs(spark, sf), "text", "lang", THEMES).select("doc_id", F.array_join("themes", ",").alias("themes"))


PATTERNS = ["of (the|and)", "de la", "der|die", "ingth?"]
ATTR = " + ".join(f"len(regexp_extract_all({LOW}, '{p}'))" for p in PATTERNS)


@query("K09_attribution_counts", f"SELECT doc_id, {ATTR} AS attributions, {hits_sql(LOW, ['the', 'que'])} AS opinion_words, {hits_sql(LOW, ['and', 'und', 'los'])} AS fact_words FROM documents")
def k09(spark, sf):
    return lx.attribution_counts(docs(spark, sf), "text", PATTERNS, ["the", "que"], ["and", "und", "los"]).select("doc_id", "attributions", "opinion_words", "fact_words")


BREAK = ["eringth", "schung", "ciónde", "eaueau", "tionon", "ouor"]


@query("K10_R04_breaking_score", f"SELECT doc_id, {hits_sql('lower(source) || chr(1) || lower(text)', BREAK)} AS breaking_score, CAST({hits_sql('lower(source) || chr(1) || lower(text)', BREAK)} >= 2 AS INTEGER) AS is_breaking FROM documents")
def k10(spark, sf):
    return lx.breaking_score(docs(spark, sf), "category", "text", BREAK).select("doc_id", "breaking_score", F.col("is_breaking").cast("int"))


# ---- sentiment

POL = {w: (v / 4, min(1.0, abs(v) / 4 + 0.25)) for w, v in TEST_LEXICON.items()}
KNOWN = f"list_filter(tk, lambda t: list_contains({list_sql(POL)}, t))"


def mean_case(i):
    return "CASE " + " ".join(f"WHEN t = '{w}' THEN {v[i]}::DOUBLE" for w, v in POL.items()) + " ELSE 0::DOUBLE END"


def scored_sql(source, text="text"):
    """Every column of source plus compound, polarity, subjectivity, labels, ensemble."""
    inner = compound_sql(source, text)
    return f"""SELECT *, CASE WHEN cl = pl THEN cl ELSE cl END AS sentiment, CASE WHEN cl = pl THEN 1.0::DOUBLE ELSE 0.4::DOUBLE / (0.4::DOUBLE + 0.3::DOUBLE) END AS vote,
  (compound * 0.4::DOUBLE + polarity * 0.3::DOUBLE) / (0.4::DOUBLE + 0.3::DOUBLE) AS weighted_score FROM (
  SELECT *, {LABEL} AS cl, CASE WHEN polarity > 0.1 THEN 'positive' WHEN polarity < -0.1 THEN 'negative' ELSE 'neutral' END AS pl FROM (
  SELECT *, CASE WHEN len({KNOWN}) = 0 THEN 0 ELSE list_sum(list_transform({KNOWN}, lambda t: {mean_case(0)})) / len({KNOWN}) END AS polarity,
  CASE WHEN len({KNOWN}) = 0 THEN 0 ELSE list_sum(list_transform({KNOWN}, lambda t: {mean_case(1)})) / len({KNOWN}) END AS subjectivity FROM ({inner})))"""


def scored(spark, sf, frame=None):
    return s.analyze_sentiment(docs(spark, sf) if frame is None else frame, "text", TEST_LEXICON, POL, TEST_NEGATIONS)


def scored_dated(spark, sf):
    return scored(spark, sf, dated(spark, sf, "lang"))


SCORED = scored_sql(DATED)


@query("N01_N02_lexicon_sentiment", f"SELECT doc_id, round(compound, 6) AS compound, round(pos, 6) AS pos, round(neg, 6) AS neg, round(neu, 6) AS neu, {LABEL} AS label FROM ({compound_sql('documents')})")
def n01(spark, sf):
    d = s.lexicon_sentiment(docs(spark, sf).withColumn("tokens", tx.word_tokens("text")), "tokens", TEST_LEXICON, TEST_NEGATIONS)
    return rounded(d.select("doc_id", "compound", "pos", "neg", "neu", s.label_compound(F.col("compound")).alias("label")))


@query("N01_lexicon_sentiment_table", f"SELECT doc_id, round(compound, 6) AS compound FROM ({compound_sql('documents')})")
def n01b(spark, sf):
    d = docs(spark, sf).select("doc_id", tx.word_tokens("text").alias("tokens"))
    lexicon = spark.createDataFrame(list(TEST_LEXICON.items()), "word string, valence double")
    return rounded(s.lexicon_sentiment_table(d, "doc_id", "tokens", lexicon, TEST_NEGATIONS).select("doc_id", "compound"))


@query("N03_polarity_subjectivity", f"SELECT doc_id, round(polarity, 6) AS polarity, round(subjectivity, 6) AS subjectivity, pl AS label FROM ({SCORED})")
def n03(spark, sf):
    d = s.polarity_subjectivity(docs(spark, sf).withColumn("tokens", tx.word_tokens("text")), "tokens", POL)
    return rounded(d.select("doc_id", "polarity", "subjectivity", s.label_polarity(F.col("polarity")).alias("label")))


@query("N04_aggregate_sentiment", f"""SELECT doc_id, ml, round(CASE WHEN ml IS NULL THEN weighted_score ELSE compound * 0.4::DOUBLE + polarity * 0.3::DOUBLE + ms * 0.3::DOUBLE END, 6) AS score,
  CASE WHEN ml IS NULL THEN sentiment WHEN cl <> pl AND pl = ml THEN pl ELSE cl END AS label,
  round(CASE WHEN ml IS NULL THEN vote WHEN cl = pl AND pl = ml THEN 1.0 WHEN cl = pl OR cl = ml THEN 0.7 WHEN pl = ml THEN 0.6 ELSE 0.4 END::DOUBLE, 6) AS confidence
FROM (SELECT *, CASE doc_id % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' END AS ml, CASE doc_id % 3 WHEN 0 THEN 0.8::DOUBLE WHEN 1 THEN -0.6::DOUBLE END AS ms FROM ({SCORED}))""")
def n04(spark, sf):
    d = scored(spark, sf)
    k = F.col("doc_id") % 3
    d = d.withColumns({"ml": F.when(k == 0, "positive").when(k == 1, "negative"), "ms": F.when(k == 0, 0.8).when(k == 1, -0.6)})
    a = s.aggregate_sentiment([F.col("compound"), F.col("polarity"), F.col("ms")], [F.col("compound_label"), F.col("polarity_label"), F.col("ml")])
    return rounded(d.select("doc_id", "ml", a.alias("a")).select("doc_id", "ml", "a.*"))


CONF = "(CASE WHEN cl = pl THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END + least(length(text) / 500.0::DOUBLE, 1.0) + abs(compound)) / 3"


@query("N05_N07_analyze_sentiment", f"""SELECT doc_id, round(compound, 6) AS compound, round(polarity, 6) AS polarity, sentiment, round(weighted_score, 6) AS weighted_score, round({CONF}, 6) AS confidence,
  CASE WHEN {CONF} >= 0.8 THEN 'high' WHEN {CONF} >= 0.6 THEN 'medium' WHEN {CONF} >= 0.4 THEN 'low' ELSE 'very_low' END AS confidence_level FROM ({SCORED})""")
def n05(spark, sf):
    return rounded(scored(spark, sf).select("doc_id", "compound", "polarity", "sentiment", "weighted_score", "confidence", "confidence_level"))


EMO = {"joy": ["the", "la"], "fear": ["of", "de", "der"], "trust": ["and", "und", "et"]}
EMO_N = {e: f"len(list_filter(tk, lambda t: list_contains({list_sql(ws)}, t)))" for e, ws in EMO.items()}


@query("N06_emotion_scores", f"""SELECT doc_id, round(joy, 6) AS joy, round(fear, 6) AS fear, round(trust, 6) AS trust, CASE WHEN greatest(joy, fear, trust) = 0 THEN NULL WHEN fear = greatest(joy, fear, trust) THEN 'fear'
  WHEN joy = greatest(joy, fear, trust) THEN 'joy' ELSE 'trust' END AS dominant_emotion, round(greatest(joy, fear, trust), 6) AS intensity, round(joy + trust, 6) AS positive_emotions, round(fear, 6) AS negative_emotions FROM (
SELECT doc_id, CASE WHEN a + b + c = 0 THEN 0 ELSE a::DOUBLE / (a + b + c) END AS joy, CASE WHEN a + b + c = 0 THEN 0 ELSE b::DOUBLE / (a + b + c) END AS fear, CASE WHEN a + b + c = 0 THEN 0 ELSE c::DOUBLE / (a + b + c) END AS trust FROM (
SELECT doc_id, {EMO_N['joy']} AS a, {EMO_N['fear']} AS b, {EMO_N['trust']} AS c FROM (SELECT doc_id, {tokens_sql('text')} AS tk FROM documents)))""")
def n06(spark, sf):
    d = s.emotion_scores(docs(spark, sf).withColumn("tokens", tx.word_tokens("text")), "tokens", EMO)
    return rounded(d.select("doc_id", *EMO, "dominant_emotion", "intensity", "positive_emotions", "negative_emotions"))


@query("N08_track_sentiment_by_category", trend_sql("category").replace("FROM events)", f"FROM (SELECT category, date AS ts, doc_id AS event_id, compound AS value FROM ({SCORED})))")
       .replace("arg_min(value, x) AS first, arg_max(value, x) AS last, max(value) AS max, min(value) AS min", "round(arg_min(value, x), 6) AS first, round(arg_max(value, x), 6) AS last, round(max(value), 6) AS max, round(min(value), 6) AS min"))
def n08(spark, sf):
    return trend9(s.track_sentiment(scored_dated(spark, sf), "date", "category", "doc_id", ["by_category"])["by_category"])


@query("N08_track_sentiment_moving_average", f"SELECT date, doc_id, round(compound, 6) AS compound, round(avg(compound) OVER (ORDER BY date, doc_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS ma_7 FROM ({SCORED})")
def n08b(spark, sf):
    return rounded(s.track_sentiment(scored_dated(spark, sf), "date", "category", "doc_id", ["moving_7"])["moving_7"])


@query("N09_sentiment_summary", f"""SELECT lang, count(*) AS rows, round(avg(compound), 6) AS mean_score, round(min(compound), 6) AS min_score, round(max(compound), 6) AS max_score, round(avg((sentiment = 'positive')::INT), 6) AS positive_share,
  round(avg((sentiment = 'negative')::INT), 6) AS negative_share, round(avg((sentiment = 'neutral')::INT), 6) AS neutral_share,
  CASE greatest(count(*) FILTER (sentiment = 'positive'), count(*) FILTER (sentiment = 'negative'), count(*) FILTER (sentiment = 'neutral')) WHEN count(*) FILTER (sentiment = 'positive') THEN 'positive'
  WHEN count(*) FILTER (sentiment = 'negative') THEN 'negative' ELSE 'neutral' END AS dominant FROM ({SCORED}) GROUP BY 1""")
def n09(spark, sf):
    return rounded(s.sentiment_summary(scored(spark, sf), ["lang"]))


@query("A04_sentiment_by_period", f"""SELECT CAST(CAST(date_trunc('week', date) AS DATE) AS VARCHAR) AS period, round(avg(compound), 6) AS compound_mean, round(stddev_samp(compound), 6) AS compound_std, count(*) AS rows, round(avg(polarity), 6) AS polarity_mean,
  round(stddev_samp(polarity), 6) AS polarity_std, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment = 'neutral') AS neutral FROM ({SCORED}) GROUP BY 1""")
def a04(spark, sf):
    return rounded(s.sentiment_by_period(scored_dated(spark, sf), "date", "week")).withColumn("period", F.col("period").cast("string"))


@query("A06_sentiment_statistics", " UNION ALL ".join(f"SELECT '{c}' AS score, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(quantile_cont({c}, 0.5), 6) AS median FROM ({SCORED})" for c in ("compound", "polarity")))
def a06(spark, sf):
    return rounded(s.sentiment_statistics(scored(spark, sf)))


@query("A06_label_shares", f"SELECT sentiment, count(*) AS count, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percentage FROM ({SCORED}) GROUP BY 1")
def a06b(spark, sf):
    return rounded(s.label_shares(scored(spark, sf)))


@query("A09_sentiment_cube", f"""SELECT CASE WHEN grouping(category) = 0 THEN 'category' WHEN grouping(week) = 0 THEN 'week' WHEN grouping(month) = 0 THEN 'month' ELSE 'overall' END AS level, category, CAST(week AS VARCHAR) AS week, CAST(month AS VARCHAR) AS month,
  round(avg(compound), 6) AS mean, round(stddev_samp(compound), 6) AS std, count(*) AS rows FROM (SELECT category, CAST(date_trunc('week', date) AS DATE) AS week, CAST(date_trunc('month', date) AS DATE) AS month, compound FROM ({SCORED}))
GROUP BY GROUPING SETS ((), (category), (week), (month))""")
def a09(spark, sf):
    return rounded(s.sentiment_cube(scored_dated(spark, sf), "date", "category")).withColumns({c: F.col(c).cast("string") for c in ("week", "month")})


@query("A13_readability_by", f"""SELECT source AS category, round(avg(206.835::DOUBLE - 1.015::DOUBLE * wps - 84.6::DOUBLE * spw), 6) AS ease, round(avg(0.39::DOUBLE * wps + 11.8::DOUBLE * spw - 15.59::DOUBLE), 6) AS grade,
  round(avg(length(text)), 6) AS mean_length FROM ({READ_SQL}) JOIN (SELECT doc_id, text FROM documents) USING (doc_id) GROUP BY 1""")
def a13(spark, sf):
    from broadsheet.operators.summarize import readability_by
    return rounded(readability_by(docs(spark, sf), "text", "category"))


# ---- bias

BP, BN = ["the", "la", "und"], ["of", "de", "die"]
BKEY = {"left": ["thion", "eau", "ción"], "right": ["ouor", "sch"], "neutral": ["er", "que"]}
BOP, BFA = ["the", "que", "sch"], ["ing", "para", "eau"]
LEX = f"""SELECT *, abs(skew) + 0.5::DOUBLE * er AS lexical_score FROM (SELECT doc_id, CASE WHEN len(w) = 0 THEN 0 ELSE (p + n)::DOUBLE / len(w) END AS er, CASE WHEN len(w) = 0 THEN 0 ELSE (p - n)::DOUBLE / len(w) END AS skew FROM (
SELECT doc_id, w, len(list_filter(w, lambda x: list_contains({list_sql(BP)}, x))) AS p, len(list_filter(w, lambda x: list_contains({list_sql(BN)}, x))) AS n FROM (SELECT doc_id, list_transform({W}, lambda x: lower(x)) AS w FROM documents)))"""


@query("B01_lexical_bias", f"SELECT doc_id, round(er, 6) AS emotional_ratio, round(skew, 6) AS sentiment_skew, round(lexical_score, 6) AS lexical_score FROM ({LEX})")
def b01(spark, sf):
    return rounded(b.lexical_bias(docs(spark, sf), "text", BP, BN).select("doc_id", "emotional_ratio", "sentiment_skew", "lexical_score"))


POLB = f"""SELECT doc_id, l, r, CASE WHEN l > r + 0.2::DOUBLE THEN 'left' WHEN r > l + 0.2::DOUBLE THEN 'right' ELSE 'neutral' END AS leaning, abs(l - r) AS political_score FROM (
SELECT doc_id, CASE WHEN a + b + c = 0 THEN 0 ELSE a::DOUBLE / (a + b + c) END AS l, CASE WHEN a + b + c = 0 THEN 0 ELSE b::DOUBLE / (a + b + c) END AS r FROM (SELECT doc_id, {hits_sql(LOW, BKEY['left'])} AS a, {hits_sql(LOW, BKEY['right'])} AS b, {hits_sql(LOW, BKEY['neutral'])} AS c FROM documents))"""


@query("B02_political_bias", f"SELECT doc_id, round(l, 6) AS left_ratio, round(r, 6) AS right_ratio, leaning, round(political_score, 6) AS political_score FROM ({POLB})")
def b02(spark, sf):
    return rounded(b.political_bias(docs(spark, sf), "text", BKEY).select("doc_id", "left_ratio", "right_ratio", "leaning", "political_score"))


PIECES = "(SELECT doc_id, x AS text FROM (SELECT doc_id, unnest(list_filter(list_transform(string_split(text, '.'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: length(x) > 10)) AS x FROM documents))"
EMOB = f"""SELECT doc_id, coalesce(v, 0) AS v, CASE WHEN v IS NULL THEN 'neutral' WHEN p >= g AND p >= z THEN 'positive' WHEN g >= z THEN 'negative' ELSE 'neutral' END AS dominant, least(2 * coalesce(v, 0), 1.0::DOUBLE) AS emotional_score FROM documents LEFT JOIN (
SELECT doc_id, var_pop(compound) AS v, count(*) FILTER ({LABEL} = 'positive') AS p, count(*) FILTER ({LABEL} = 'negative') AS g, count(*) FILTER ({LABEL} = 'neutral') AS z FROM ({compound_sql(PIECES, keep='doc_id')}) GROUP BY 1) USING (doc_id)"""


@query("B03_emotional_bias", f"SELECT doc_id, round(v, 6) AS emotional_variance, dominant AS dominant_emotion, round(emotional_score, 6) AS emotional_score FROM ({EMOB})")
def b03(spark, sf):
    return rounded(b.emotional_bias(docs(spark, sf), "text", TEST_LEXICON, TEST_NEGATIONS).select("doc_id", "emotional_variance", "dominant_emotion", "emotional_score"))


SRC = f"""SELECT *, CASE WHEN n = 0 THEN 0 ELSE a::DOUBLE / n END AS density, fa::DOUBLE / greatest(op, 1) AS fo, CASE WHEN n = 0 THEN 0 ELSE greatest(0, (op - fa)::DOUBLE / n) END AS source_score FROM (
SELECT doc_id, len({W}) AS n, {{attr}} AS a, {hits_sql(LOW, BOP)} AS op, {hits_sql(LOW, BFA)} AS fa FROM documents)"""


@query("B04_source_bias", f"SELECT doc_id, round(density, 6) AS source_density, round(fo, 6) AS fact_opinion_ratio, round(source_score, 6) AS source_score FROM ({SRC.replace('{attr}', ATTR)})")
def b04(spark, sf):
    return rounded(b.source_bias(docs(spark, sf), "text", PATTERNS, BOP, BFA).select("doc_id", "source_density", "fact_opinion_ratio", "source_score"))


CPLX = f"SELECT doc_id, CASE WHEN len(w) = 0 THEN 0 ELSE len(list_filter(w, lambda x: length(x) > 6))::DOUBLE / len(w) END AS cr FROM (SELECT doc_id, {W} AS w FROM documents)"


@query("B05_linguistic_bias", f"SELECT doc_id, round(score, 6) AS readability, round(cr, 6) AS complex_ratio, round(least(cr, 0.5::DOUBLE), 6) AS linguistic_score FROM ({BIAS_READ}) JOIN ({CPLX}) USING (doc_id)")
def b05(spark, sf):
    return rounded(b.linguistic_bias(docs(spark, sf), "text").select("doc_id", "readability", "complex_ratio", "linguistic_score"))


WITHIN = f"""s AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id) AS pos, {tokens_sql('text')} AS tk FROM {PIECES}), sz AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
tf AS (SELECT doc_id, pos, term, count(*) AS tf FROM (SELECT doc_id, pos, unnest(tk) AS term FROM s) GROUP BY ALL), d AS (SELECT doc_id, term, count(*) AS df FROM tf GROUP BY ALL),
w AS (SELECT doc_id, pos, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN d USING (doc_id, term) JOIN sz USING (doc_id)),
u AS (SELECT doc_id, pos, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, pos)) AS u FROM w)"""


@query("B06_semantic_bias", f"""WITH {WITHIN}, t AS (SELECT doc_id, term, sum(u) AS s, sum(u * u) AS q FROM u GROUP BY ALL)
SELECT doc_id, max(n) AS sentences, round((sum(s * s) - sum(q)) / (max(n) * (max(n) - 1)), 6) AS similarity, round(avg(q / n - (s / n) * (s / n)), 6) AS variance, round(least((sum(s * s) - sum(q)) / (max(n) * (max(n) - 1)), 1.0), 6) AS semantic_score
FROM t JOIN sz USING (doc_id) WHERE n >= 2 GROUP BY 1""")
def b06(spark, sf):
    return rounded(b.semantic_bias(docs(spark, sf), "doc_id", "text"))


def detected(spark, sf):
    return b.detect_bias(docs(spark, sf), "text", BKEY, BP, BN, TEST_LEXICON, TEST_NEGATIONS, BOP, BFA)


ATTR_DEFAULT = " + ".join(f"len(regexp_extract_all({LOW}, '{p}'))" for p in wl.ATTRIBUTION_PATTERNS)
BIAS = f"""SELECT *, CASE WHEN s >= 0.8 THEN 'high' WHEN s >= 0.6 THEN 'medium' WHEN s >= 0.3 THEN 'low' ELSE 'minimal' END AS bias_level,
  concat_ws(',', CASE WHEN political_score > 0.3 THEN 'political_' || leaning END, CASE WHEN emotional_score > 0.3 THEN 'emotional_' || dominant END, CASE WHEN source_score > 0.3 THEN 'poor_sourcing' END,
  CASE WHEN lexical_score > 0.3 AND skew > 0.1 THEN 'positive_lexical' END, CASE WHEN lexical_score > 0.3 AND skew < -0.1 THEN 'negative_lexical' END) AS types FROM (
SELECT *, least(lexical_score * 0.25::DOUBLE + political_score * 0.3::DOUBLE + emotional_score * 0.2::DOUBLE + source_score * 0.15::DOUBLE + least(cr, 0.5::DOUBLE) * 0.1::DOUBLE, 1.0) AS s
FROM ({LEX}) JOIN ({POLB}) USING (doc_id) JOIN ({EMOB}) USING (doc_id) JOIN ({SRC.replace('{attr}', ATTR_DEFAULT)}) USING (doc_id) JOIN ({CPLX}) USING (doc_id))"""


@query("B07_detect_bias", f"SELECT doc_id, round(s, 6) AS bias_score, bias_level, types AS bias_types, CAST(s > 0.3 AS INTEGER) AS bias_detected, round(least(1.2::DOUBLE * s, 1.0), 6) AS bias_confidence FROM ({BIAS})")
def b07(spark, sf):
    return rounded(detected(spark, sf).select("doc_id", "bias_score", "bias_level", F.array_join("bias_types", ",").alias("bias_types"), F.col("bias_detected").cast("int"), "bias_confidence"))


@query("A07_bias_rollup", f"""WITH x AS ({BIAS}) SELECT 'level' AS measure, bias_level AS value, count(*)::DOUBLE AS number FROM x GROUP BY 2
UNION ALL SELECT 'type', t, count(*)::DOUBLE FROM x, unnest(string_split(types, ',')) AS u(t) WHERE t <> '' GROUP BY 2 UNION ALL SELECT 'score', 'mean', round(avg(s), 6) FROM x UNION ALL SELECT 'score', 'std', round(stddev_pop(s), 6) FROM x
UNION ALL SELECT 'score', 'median', round(quantile_cont(s, 0.5), 6) FROM x UNION ALL SELECT 'score', 'detected', count(*) FILTER (s > 0.3)::DOUBLE FROM x""")
def a07(spark, sf):
    return rounded(b.bias_rollup(detected(spark, sf)))


@query("A07_high_bias", f"SELECT doc_id, round(s, 6) AS bias_score FROM ({BIAS}) WHERE s > 0.35")
def a07b(spark, sf):
    return rounded(b.high_bias(detected(spark, sf), "doc_id", "text", 0.35).select("doc_id", "bias_score"))
