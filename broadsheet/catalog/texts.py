"""Text rows F01-F32 on documents, conversations and pages."""

from pyspark.sql import functions as F

from broadsheet.catalog.tables import articles, list_sql, sentences_sql, table, tokens_sql, words_sql
from broadsheet.functions import text as tx
from broadsheet.registry import query

W = words_sql("text")
S = sentences_sql("text")
URL_SQL, EMAIL_SQL = "https?://\\S+", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
PHONE_SQL = "(\\+?1[-.\\s]?)?\\(?[0-9]{3}\\)?[-.\\s]?[0-9]{3}[-.\\s]?[0-9]{4}"
CLEAN = (f"trim(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(text, '{URL_SQL}', '', 'g'), "
         f"'{EMAIL_SQL}', '', 'g'), '{PHONE_SQL}', '', 'g')), '\\s+', ' ', 'g'))")
ALL_TOKENS = "'[\\p{L}\\p{N}_''-]+|[^\\s\\p{L}\\p{N}]'"
STOPS = ["the", "and", "of", "der", "die", "la", "de", "que"]
NEWS_STOPS = tx.NEWS_STOP_WORDS
JVM = {"normalize_unicode": False}


def docs(spark, sf):
    return articles(spark, sf, "lang")


@query("F01_text_counts", f"""SELECT doc_id, length(text) AS chars, len({W}) AS words,
  len(regexp_extract_all(text, '[.!?]+')) + 1 AS sentences FROM documents""")
def f01(spark, sf):
    return docs(spark, sf).select("doc_id", tx.text_counts("text").alias("c")).select("doc_id", "c.*")


@query("F02_normalize_unicode")
def f02(spark, sf):
    return docs(spark, sf).select("doc_id", tx.normalize_unicode("text").alias("text"))


@query("F03_remove_urls", f"SELECT page_id, regexp_replace(html, '{URL_SQL}', '', 'g') AS text FROM pages")
def f03(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.remove_urls("html").alias("text"))


@query("F04_remove_emails", f"SELECT doc_id, regexp_replace(text, '{EMAIL_SQL}', '', 'g') AS text FROM documents")
def f04(spark, sf):
    return docs(spark, sf).select("doc_id", tx.remove_emails("text").alias("text"))


@query("F05_remove_phones", f"SELECT doc_id, regexp_replace(text, '{PHONE_SQL}', '', 'g') AS text FROM documents")
def f05(spark, sf):
    return docs(spark, sf).select("doc_id", tx.remove_phones("text").alias("text"))


@query("F06_collapse_ws", "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents")
def f06(spark, sf):
    return docs(spark, sf).select("doc_id", tx.collapse_ws("text").alias("text"))


@query("F07_clean_text", f"SELECT doc_id, {CLEAN} AS text FROM documents")
def f07(spark, sf):
    return docs(spark, sf).select("doc_id", tx.clean_text("text", JVM).alias("text"))


@query("F08_simple_normalize", """SELECT doc_id,
  trim(regexp_replace(regexp_replace(lower(text), '[^a-zA-Z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM documents""")
def f08(spark, sf):
    return docs(spark, sf).select("doc_id", tx.simple_normalize("text").alias("text"))


@query("F09_tokenize", f"SELECT doc_id, array_to_string(regexp_extract_all(text, {ALL_TOKENS}), '|') AS tokens FROM documents")
def f09(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(tx.tokenize("text"), "|").alias("tokens"))


@query("F10_drop_punct_tokens", f"""SELECT doc_id, len(t) AS kept, len(list_filter(t, lambda x: NOT regexp_matches(x, '^\\p{{N}}+$'))) AS kept_words
FROM (SELECT doc_id, list_filter(regexp_extract_all(text, {ALL_TOKENS}), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')) AS t FROM documents)""")
def f10(spark, sf):
    t = tx.tokenize("text")
    return docs(spark, sf).select("doc_id", F.size(tx.drop_punct_tokens(t)).alias("kept"),
                                  F.size(tx.drop_punct_tokens(t, drop_numbers=True)).alias("kept_words"))


@query("F11_drop_stopwords", f"""SELECT doc_id, array_to_string(list_filter({tokens_sql('text')},
  lambda x: length(x) >= 2 AND NOT list_contains({list_sql(STOPS + NEWS_STOPS)}, x)), ' ') AS tokens FROM documents""")
def f11(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(tx.drop_stopwords(tx.word_tokens("text"), STOPS), " ").alias("tokens"))


LEMMAS = {"es": "e", "thth": "th", "ending": "end", "ons": "on", "des": "de", "les": "le", "los": "lo", "las": "la"}


def lemma_table(spark, sf):
    """Token-to-lemma table derived from the texts: plural-like tokens of the stop profile lose their last letter."""
    tokens = docs(spark, sf).select(F.explode(tx.word_tokens("text")).alias("token")).where(
        F.col("token").rlike("^[a-z]{2,4}s$")).distinct()
    return tokens.select("token", F.expr("substring(token, 1, length(token) - 1)").alias("lemma"))


LEMMA_SQL = "CASE WHEN regexp_matches(x, '^[a-z]{2,4}s$') THEN substring(x, 1, length(x) - 1) ELSE x END"


@query("F12_lemmatize", f"""SELECT doc_id, array_to_string(list_transform({tokens_sql('text')}, lambda x: {LEMMA_SQL}), ' ') AS tokens FROM documents""")
def f12(spark, sf):
    d = docs(spark, sf).select("doc_id", tx.word_tokens("text").alias("tokens"))
    return tx.lemmatize(d, "doc_id", "tokens", lemma_table(spark, sf)).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("F13_preprocess_text", f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all({CLEAN}, {ALL_TOKENS}),
  lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]') AND length(x) >= 2 AND NOT list_contains({list_sql(STOPS + NEWS_STOPS)}, x)), ' ') AS processed FROM documents""")
def f13(spark, sf):
    return tx.preprocess_text(docs(spark, sf), "text", JVM, STOPS).select("doc_id", "processed")


@query("F14_explode_sentences", f"SELECT doc_id, i AS pos, s[i + 1] AS sentence FROM (SELECT doc_id, {S} AS s FROM documents), unnest(range(0, len(s))) AS u(i)")
def f14(spark, sf):
    return tx.explode_sentences(docs(spark, sf), "doc_id", "text")


@query("F15_text_statistics", f"""SELECT doc_id, length(text) AS chars, len({W}) AS words, len({S}) AS sentences,
  round(CASE WHEN len({S}) = 0 THEN 0 ELSE len({W})::DOUBLE / len({S}) END, 6) AS words_per_sentence,
  len(list_distinct(list_transform({W}, lambda w: lower(w)))) AS unique_words FROM documents""")
def f15(spark, sf):
    return tx.text_statistics(docs(spark, sf), "text").select(
        "doc_id", "chars", "words", "sentences", F.round("words_per_sentence", 6).alias("words_per_sentence"), "unique_words")


@query("F16_linguistic_features", f"""SELECT doc_id, length(text) AS char_count, len(w) AS word_count, len(s) AS sentence_count,
  round(CASE WHEN len(w) = 0 THEN 0 ELSE list_sum(list_transform(w, lambda x: length(x)))::DOUBLE / len(w) END, 6) AS mean_word_length,
  round(CASE WHEN len(s) = 0 THEN 0 ELSE len(w)::DOUBLE / len(s) END, 6) AS mean_sentence_length,
  len(regexp_extract_all(text, '!')) AS exclamations, len(regexp_extract_all(text, '\\?')) AS questions,
  round(CASE WHEN length(text) = 0 THEN 0 ELSE len(regexp_extract_all(text, '\\p{{Lu}}'))::DOUBLE / length(text) END, 6) AS upper_share,
  round(CASE WHEN length(text) = 0 THEN 0 ELSE len(regexp_extract_all(text, '\\p{{Nd}}'))::DOUBLE / length(text) END, 6) AS digit_share
FROM (SELECT doc_id, text, {W} AS w, {S} AS s FROM documents)""")
def f16(spark, sf):
    d = tx.linguistic_features(docs(spark, sf), "text").drop("text", "category", "lang")
    return d.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])


READ_SQL = f"""SELECT doc_id, source, greatest(len(w), 1)::DOUBLE / greatest(len(s), 1) AS wps,
  coalesce(list_sum(list_transform(w, lambda x: greatest(len(regexp_extract_all(lower(x), '[aeiouy]+')), 1))), 0)::DOUBLE / greatest(len(w), 1) AS spw
FROM (SELECT doc_id, source, {W} AS w, {S} AS s FROM documents)"""


@query("F17_flesch", f"""SELECT doc_id, round(206.835::DOUBLE - 1.015::DOUBLE * wps - 84.6::DOUBLE * spw, 6) AS ease,
  round(0.39::DOUBLE * wps + 11.8::DOUBLE * spw - 15.59::DOUBLE, 6) AS grade FROM ({READ_SQL})""")
def f17(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(tx.flesch_ease("text"), 6).alias("ease"),
                                  F.round(tx.flesch_kincaid("text"), 6).alias("grade"))


BIAS_READ = f"""SELECT doc_id, 206.835::DOUBLE - 1.015::DOUBLE * (len(w)::DOUBLE / greatest(len(s), 1))
  - 84.6::DOUBLE * CASE WHEN len(w) = 0 THEN 0 ELSE len(list_filter(w, lambda x: length(x) > 6))::DOUBLE / len(w) END AS score
FROM (SELECT doc_id, {W} AS w, list_filter(string_split(text, '.'), lambda x: regexp_matches(x, '\\S')) AS s FROM documents)"""


@query("F18_bias_readability", f"SELECT doc_id, round(score, 6) AS score FROM ({BIAS_READ})")
def f18(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(tx.bias_readability("text"), 6).alias("score"))


@query("F19_readability_band", f"""SELECT doc_id, CASE WHEN e >= 90 THEN 'very_easy' WHEN e >= 80 THEN 'easy' WHEN e >= 70 THEN 'fairly_easy'
  WHEN e >= 60 THEN 'standard' WHEN e >= 50 THEN 'fairly_difficult' WHEN e >= 30 THEN 'difficult' ELSE 'very_difficult' END AS band
FROM (SELECT doc_id, round(206.835::DOUBLE - 1.015::DOUBLE * wps - 84.6::DOUBLE * spw, 6) AS e FROM ({READ_SQL}))""")
def f19(spark, sf):
    return docs(spark, sf).select("doc_id", tx.readability_band(F.round(tx.flesch_ease("text"), 6)).alias("band"))


NEWS = {"urgency": ["the", "ing"], "opinion": ["la", "que"], "factual": ["der", "und"], "time": ["on", "of"]}


def occ_sql(terms):
    return " + ".join(f"(length(low) - length(replace(low, '{t}', ''))) // {len(t)}" for t in terms)


@query("F20_news_features", "SELECT doc_id, " + ", ".join(
    f"CAST({occ_sql(t)} AS BIGINT) AS {k}_count, round(({occ_sql(t)})::DOUBLE / n, 6) AS {k}_ratio" for k, t in NEWS.items()) + f""",
  CAST(q AS BIGINT) AS quote_count, round(q::DOUBLE / n, 6) AS quote_ratio, len(list_filter(w, lambda x: regexp_matches(x, '\\d'))) AS number_tokens,
  CAST(length(text) - length(replace(text, '%', '')) + (length(low) - length(replace(low, 'percent', ''))) // 7 AS BIGINT) AS percent_count
FROM (SELECT *, greatest(len(w), 1) AS n, (length(text) - length(replace(text, '"', ''))) // 2 AS q FROM (SELECT doc_id, text, lower(text) AS low, {W} AS w FROM documents))""")
def f20(spark, sf):
    d = tx.news_features(docs(spark, sf), "text", NEWS).drop("text", "category", "lang")
    return d.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])


@query("F21_vocab_diversity", f"""SELECT doc_id, round(CASE WHEN len({W}) = 0 THEN 0 ELSE
  len(list_distinct(list_transform({W}, lambda w: lower(w))))::DOUBLE / len({W}) END, 6) AS diversity FROM documents""")
def f21(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(tx.vocab_diversity("text"), 6).alias("diversity"))


@query("F22_preview_title", f"""SELECT doc_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS preview,
  array_to_string(({W})[1:10], ' ') || CASE WHEN len({W}) > 10 THEN '...' ELSE '' END AS title FROM documents""")
def f22(spark, sf):
    return docs(spark, sf).select("doc_id", tx.preview("text", 200).alias("preview"), tx.title_words("text").alias("title"))


@query("F23_numbers", f"""SELECT doc_id, array_to_string(regexp_extract_all(text, '\\d+'), ',') AS numbers, round(CASE WHEN len({W}) = 0 THEN 0
  ELSE len(list_filter({W}, lambda x: regexp_matches(x, '\\d')))::DOUBLE / len({W}) END, 6) AS density FROM documents""")
def f23(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(tx.extract_numbers("text"), ",").alias("numbers"),
                                  F.round(tx.number_density("text"), 6).alias("density"))


@query("F24_chunk_sentences")
def f24(spark, sf):
    return tx.chunk_sentences(docs(spark, sf), "doc_id", "text", 100)


STRIPPED = "regexp_replace(x, '^\\s+|\\s+$', '', 'g')"


@query("F25_segment_text", f"""SELECT doc_id, i AS pos, seg[i + 1] AS segment FROM (SELECT doc_id, CASE WHEN len(s) > 1 THEN s WHEN len(p) > 1 THEN p
  ELSE list_transform(range(1, length(text) + 1, 200), lambda k: substring(text, k, 200)) END AS seg FROM
  (SELECT doc_id, text, list_transform({S}, lambda x: {STRIPPED}) AS s,
   list_filter(list_transform(regexp_split_to_array(text, '\\n\\s*\\n'), lambda x: {STRIPPED}), lambda x: x <> '') AS p FROM documents)),
  unnest(range(0, len(seg))) AS u(i)""")
def f25(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(tx.segment_text("text")).alias("pos", "segment"))


@query("F26_first_words", f"SELECT doc_id, array_to_string(({W})[1:300], ' ') AS text FROM documents")
def f26(spark, sf):
    return docs(spark, sf).select("doc_id", tx.first_words("text", 300).alias("text"))


@query("F27_ngrams", f"""WITH t AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents), g AS (
  SELECT doc_id, unnest(t) AS gram FROM t UNION ALL
  SELECT doc_id, t[i] || ' ' || t[i + 1] FROM t, unnest(range(1, len(t))) AS u(i) UNION ALL
  SELECT doc_id, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] FROM t, unnest(range(1, len(t) - 1)) AS u(i))
SELECT doc_id, count(*) AS grams, count(DISTINCT gram) AS distinct_grams, min(gram) AS first_gram, max(gram) AS last_gram FROM g GROUP BY 1""")
def f27(spark, sf):
    d = docs(spark, sf).select("doc_id", tx.word_tokens("text").alias("t"))
    return d.select("doc_id", tx.ngrams("t", 1, 3).alias("g")).where(F.size("g") > 0).select(
        "doc_id", F.size("g").alias("grams"), F.size(F.array_distinct("g")).alias("distinct_grams"),
        F.array_min("g").alias("first_gram"), F.array_max("g").alias("last_gram"))


COLLAPSED = sentences_sql("trim(regexp_replace(text, '\\s+', ' ', 'g'))")


@query("F28_capitalize_sentences", f"SELECT doc_id, array_to_string(list_transform({COLLAPSED}, lambda x: upper(substring(x, 1, 1)) || substring(x, 2)), ' ') AS text FROM documents")
def f28(spark, sf):
    return docs(spark, sf).select("doc_id", tx.capitalize_sentences("text").alias("text"))
