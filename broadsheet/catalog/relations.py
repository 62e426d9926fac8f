"""Rows J, A, ST, W, O, U, M and T on documents, events, embeddings and the order tables."""

from pyspark.sql import functions as F

from broadsheet.catalog.tables import DATED, articles, dated, table, tokens_sql
from broadsheet.functions import temporal as tm
from broadsheet.functions import text as tx
from broadsheet.operators import relational as r
from broadsheet.registry import query


def rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# ---- joins

@query("J01_attach_results", "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)")
def j01(spark, sf):
    return r.attach_results(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


@query("J02_attach_lookup", "SELECT o_orderkey, o_orderpriority, share FROM orders LEFT JOIN (SELECT o_orderpriority, count(*) AS share FROM orders GROUP BY 1) USING (o_orderpriority)")
def j02(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    look = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("share"))
    return r.attach_lookup(o, look, ["o_orderpriority"], ["o_orderkey"])


@query("J03_keep_frequent", "SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM documents GROUP BY 1 HAVING count(*) >= 50)")
def j03(spark, sf):
    return r.keep_frequent(table(spark, sf, "documents").select("doc_id", "source"), "source", 50)


@query("J04_exclude_seen", """SELECT doc_id FROM documents WHERE substring(text, 1, 50) NOT IN
  (SELECT substring(text, 1, 50) FROM documents JOIN labels USING (doc_id))""")
def j04(spark, sf):
    d = articles(spark, sf)
    seen = d.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return r.exclude_seen(d, seen, "text", 3).select("doc_id")


@query("J06_group_pairs", """WITH a AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1)
SELECT a.lang AS lang_1, a.n AS n_1, b.lang AS lang_2, b.n AS n_2 FROM a JOIN a b ON a.lang < b.lang""")
def j06(spark, sf):
    return r.group_pairs(table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang")


def windows_sql(size, step, min_rows):
    return f"""WITH d AS {DATED}, e AS (SELECT min(date) AS f, max(date) AS l FROM d),
k AS (SELECT CAST(f + CAST(i * {step} AS INTEGER) AS DATE) AS window_start FROM e, unnest(range(0, 1000)) AS u(i) WHERE f + CAST(i * {step} + {size} AS INTEGER) <= l),
m AS (SELECT window_start, doc_id, source, lang, date, text FROM d JOIN k ON date >= window_start AND date < window_start + {size}),
c AS (SELECT window_start, count(*) AS window_rows, row_number() OVER (ORDER BY window_start) - 1 AS window_id FROM m GROUP BY 1 HAVING count(*) >= {min_rows})"""


@query("J08_T05_sliding_windows", windows_sql(30, 7, 10) + "SELECT window_id, CAST(window_start AS VARCHAR) AS window_start, window_rows, doc_id FROM m JOIN c USING (window_start)")
def j08(spark, sf):
    return tm.sliding_windows(dated(spark, sf), "date", 30, 7, 10).select(
        "window_id", F.col("window_start").cast("string"), "window_rows", "doc_id")


@query("J09_common_neighbors", """WITH e AS (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem),
p AS (SELECT s_suppkey AS a, s_suppkey + 1 AS b FROM supplier)
SELECT a, b, x.dst AS node FROM p JOIN e x ON x.src = a JOIN e y ON y.src = b AND y.dst = x.dst""")
def j09(spark, sf):
    e = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"))
    pairs = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("a"), (F.col("s_suppkey") + 1).alias("b"))
    return r.common_neighbors(e, pairs)


# ---- aggregates

@query("A01_category_counts", """WITH c AS (SELECT source AS category, count(*) AS count FROM documents GROUP BY 1)
SELECT category, count, round(count * 100.0::DOUBLE / sum(count) OVER (), 6) AS percentage, CAST(count = max(count) OVER () AS INTEGER) AS most_common,
  CAST(count = min(count) OVER () AS INTEGER) AS least_common FROM c""")
def a01(spark, sf):
    return rounded(r.category_counts(articles(spark, sf), "category")).withColumns(
        {c: F.col(c).cast("int") for c in ("most_common", "least_common")})


@query("A02_length_stats", """SELECT lang, round(avg(length(text)), 6) AS mean, round(quantile_cont(length(text), 0.5), 6) AS median, min(length(text)) AS min,
  max(length(text)) AS max, round(stddev_samp(length(text)), 6) AS std FROM documents GROUP BY 1""")
def a02(spark, sf):
    return rounded(r.length_stats(table(spark, sf, "documents"), "text", ["lang"]))


@query("A03_distinct_values", "SELECT DISTINCT source FROM documents")
def a03(spark, sf):
    return r.distinct_values(table(spark, sf, "documents"), "source")


@query("A05_accuracy_by", "SELECT source, count(*) AS rows, round(avg(CAST(quality = 1 - toxic AS INTEGER)), 6) AS accuracy FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def a05(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").withColumn("pred", 1 - F.col("toxic"))
    return rounded(r.accuracy_by(d, "source", "quality", "pred"))


SHARES = f"""c AS (SELECT CAST(date_trunc('week', date) AS DATE) AS period, lang AS topic, count(*) AS n FROM {DATED} GROUP BY 1, 2),
g AS (SELECT period, topic, coalesce(n, 0) AS count, coalesce(n, 0)::DOUBLE / sum(coalesce(n, 0)) OVER (PARTITION BY period) AS share
  FROM (SELECT * FROM (SELECT DISTINCT period FROM c), (SELECT DISTINCT topic FROM c)) LEFT JOIN c USING (period, topic)),
x AS (SELECT *, dense_rank() OVER (ORDER BY period) - 1 AS x, count(DISTINCT period) OVER () AS np FROM g)"""


def shares(spark, sf):
    return r.period_shares(dated(spark, sf, "lang"), tm.period("date", "week"), "lang")


@query("A08_period_shares", f"WITH {SHARES} SELECT CAST(period AS VARCHAR) AS period, topic, count, round(share, 6) AS share FROM x")
def a08(spark, sf):
    return rounded(shares(spark, sf)).withColumn("period", F.col("period").cast("string"))


@query("A08_period_table", f"""SELECT month(date) AS period, round(avg(CAST(lang = 'en' AS INTEGER)), 6) AS en, round(avg(CAST(lang = 'fr' AS INTEGER)), 6) AS fr,
  round(avg(CAST(lang = 'de' AS INTEGER)), 6) AS de, round(avg(CAST(lang = 'es' AS INTEGER)), 6) AS es FROM {DATED} GROUP BY 1""")
def a08b(spark, sf):
    return rounded(r.period_table(dated(spark, sf, "lang"), F.month("date"), "lang", ["en", "fr", "de", "es"]))


CONC = """WITH c AS (SELECT {by} {key} AS k, count(*) AS c FROM documents GROUP BY ALL), p AS (SELECT *, c::DOUBLE / sum(c) OVER ({over}) AS p FROM c)
SELECT {by} round(sum(p * p), 6) AS hhi, round(-sum(p * ln(p)), 6) AS entropy_nats, round(-sum(p * log2(p)), 6) AS entropy_bits, count(*) AS values,
  CASE WHEN sum(p * p) > 0.5 THEN 'highly_concentrated' WHEN sum(p * p) > 0.25 THEN 'moderately_concentrated' ELSE 'diverse' END AS concentration FROM p GROUP BY ALL"""


@query("A10_concentration", CONC.format(by="", key="lang", over=""))
def a10(spark, sf):
    return rounded(r.concentration(table(spark, sf, "documents"), "lang"))


@query("A10_concentration_by_source", CONC.format(by="source,", key="lang", over="PARTITION BY source"))
def a10b(spark, sf):
    return rounded(r.concentration(table(spark, sf, "documents"), "lang", ["source"]))


# ---- statistics

@query("ST01_score_correlation", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation, count(*) AS rows FROM lineitem")
def st01(spark, sf):
    return rounded(r.score_correlation(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


def trend_sql(by):
    part = f"PARTITION BY {by} " if by else ""
    key = f"{by}, " if by else ""
    return f"""WITH p AS (SELECT *, (row_number() OVER ({part}ORDER BY ts, event_id) - 1)::DOUBLE AS x FROM events)
SELECT {key}count(*) AS rows, round(regr_slope(value, x), 9) AS slope, round(regr_r2(value, x), 6) AS r2, round(stddev_samp(value), 6) AS volatility,
  round(avg(value), 6) AS mean, arg_min(value, x) AS first, arg_max(value, x) AS last, max(value) AS max, min(value) AS min,
  CASE WHEN regr_slope(value, x) > 0.001 THEN 'increasing' WHEN regr_slope(value, x) < -0.001 THEN 'decreasing' ELSE 'stable' END AS direction
FROM p {'GROUP BY ' + by if by else ''}"""


def trend9(df):
    cols = [c for c in df.columns if c != "t_stat"]
    return df.select(*[F.round(c, 9 if c == "slope" else 6).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in cols])


@query("ST02_linear_trend", trend_sql(None))
def st02(spark, sf):
    return trend9(r.linear_trend(events(spark, sf).select("ts", "event_id", "value"), ["ts", "event_id"], "value"))


@query("ST02_linear_trend_by_type", trend_sql("event_type"))
def st02b(spark, sf):
    return trend9(r.linear_trend(events(spark, sf).select("ts", "event_id", "event_type", "value"), ["ts", "event_id"], "value", ["event_type"]))


@query("ST02_p_values")
def st02c(spark, sf):
    t = r.linear_trend(events(spark, sf).select("ts", "event_id", "event_type", "value"), ["ts", "event_id"], "value", ["event_type"])
    return r.with_p_value(t).select("event_type", "rows", "slope", "t_stat", "p_value")


@query("ST03_topic_evolution_stats", f"""WITH {SHARES} SELECT topic, round(regr_slope(share, x), 6) AS slope, round(stddev_pop(share), 6) AS volatility, round(avg(share), 6) AS mean,
  round(max(share), 6) AS max, round(min(share), 6) AS min,
  round(CASE WHEN arg_min(share, x) > 0 THEN (arg_max(share, x) - arg_min(share, x)) / arg_min(share, x) ELSE 0 END, 6) AS growth FROM x GROUP BY 1""")
def st03(spark, sf):
    return rounded(r.topic_evolution_stats(shares(spark, sf)))


@query("ST04_emerging_declining", f"""WITH {SHARES}, h AS (SELECT topic, avg(share) FILTER (x < np // 2) AS a, avg(share) FILTER (x >= np // 2) AS b FROM x WHERE np >= 3 GROUP BY 1)
SELECT topic, round(a, 6) AS first_half, round(b, 6) AS second_half, round(b - a, 6) AS change,
  CASE WHEN b - a > 0.01 THEN 'emerging' WHEN b - a < -0.01 THEN 'declining' ELSE 'stable' END AS trend FROM h""")
def st04(spark, sf):
    return rounded(r.emerging_declining(shares(spark, sf), 0.01))


def window_topics(spark, sf):
    w = tm.sliding_windows(dated(spark, sf, "lang"), "date", 14, 7, 10)
    return w.groupBy("window_id", F.col("lang").alias("topic"), "window_rows").agg(F.count(F.lit(1)).alias("n")).select(
        "window_id", "topic", (F.col("n") / F.col("window_rows")).alias("p"))


WT = windows_sql(14, 7, 10) + ", wt AS (SELECT window_id, lang AS topic, count(*)::DOUBLE / max(window_rows) AS p FROM m JOIN c USING (window_start) GROUP BY 1, 2)"


@query("ST05_classify_window_trends", WT + """, s AS (SELECT topic, regr_slope(p, window_id) AS slope, avg(p) AS mean, stddev_pop(p) AS std FROM wt GROUP BY 1)
SELECT topic, round(slope, 6) AS slope, round(mean, 6) AS mean, round(std, 6) AS std, CASE WHEN slope > 0.01 THEN 'emerging' WHEN slope < -0.01 THEN 'declining'
  WHEN mean > 0.05 AND std < 0.02 THEN 'stable' ELSE 'other' END AS trend, round(abs(slope) / (std + 1e-6), 6) AS strength FROM s""")
def st05(spark, sf):
    return rounded(r.classify_window_trends(window_topics(spark, sf)))


@query("ST06_topic_stability", f"""WITH {SHARES}, d AS (SELECT *, abs(share - lag(share) OVER (PARTITION BY topic ORDER BY x)) AS d FROM x),
s AS (SELECT topic, CASE WHEN avg(share) = 0 THEN 0 ELSE stddev_pop(share) / avg(share) END AS cv, avg(CAST(share > 0 AS INTEGER)) AS presence, 1 - coalesce(avg(d), 0) AS persistence FROM d GROUP BY 1)
SELECT topic, round(cv, 6) AS cv, round(presence, 6) AS presence, round(persistence, 6) AS persistence, round((presence + persistence) / 2, 6) AS stability FROM s""")
def st06(spark, sf):
    return rounded(r.topic_stability(shares(spark, sf)))


@query("ST07_window_correlations", WT + """SELECT a.window_id AS window_1, b.window_id AS window_2, round(corr(a.p, b.p), 6) AS correlation,
  CAST(b.window_id = a.window_id + 1 AS INTEGER) AS consecutive FROM wt a JOIN wt b ON a.topic = b.topic AND a.window_id < b.window_id GROUP BY ALL""")
def st07(spark, sf):
    return rounded(r.window_correlations(window_topics(spark, sf))).withColumn("consecutive", F.col("consecutive").cast("int"))


@query("ST08_series_trend", WT + """, h AS (SELECT window_id, -sum(p * ln(p)) AS entropy FROM wt GROUP BY 1)
SELECT round(regr_slope(entropy, window_id), 6) AS slope, round(avg(entropy), 6) AS mean, round(stddev_pop(entropy), 6) AS std,
  CASE WHEN regr_slope(entropy, window_id) > 0.001 THEN 'increasing' WHEN regr_slope(entropy, window_id) < -0.001 THEN 'decreasing' ELSE 'stable' END AS trend FROM h""")
def st08(spark, sf):
    h = window_topics(spark, sf).groupBy("window_id").agg((-F.sum(F.col("p") * F.ln("p"))).alias("entropy"))
    return rounded(r.series_trend(h, "window_id", "entropy", 0.001))


@query("ST09_sentiment_anomalies", """WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events), d AS (SELECT event_id, ts, value, value - lag(value) OVER (ORDER BY ts, event_id) AS d FROM events)
SELECT ts, event_id, value, round((value - m) / sd, 6) AS measure, 'outlier' AS kind FROM events, s WHERE abs((value - m) / sd) > 2.5
UNION ALL SELECT ts, event_id, value, round(d, 6), 'shift' FROM d WHERE abs(d) > 40""")
def st09(spark, sf):
    return rounded(r.sentiment_anomalies(events(spark, sf).select("ts", "event_id", "value"), ["ts", "event_id"], "value", 2.5, 40))


@query("ST10_chi2_features", f"""WITH t AS (SELECT doc_id, term, count(*) AS value FROM (SELECT doc_id, unnest({tokens_sql('text')}) AS term FROM documents) GROUP BY 1, 2),
sh AS (SELECT lang, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM documents GROUP BY 1),
o AS (SELECT term, lang, sum(value)::DOUBLE AS o FROM t JOIN documents USING (doc_id) GROUP BY 1, 2)
SELECT term, CAST(sum(o) AS BIGINT) AS total, round(sum(o * o / share) / sum(o) - sum(o), 6) AS chi2 FROM o JOIN sh USING (lang) GROUP BY 1 ORDER BY round(sum(o * o / share) / sum(o) - sum(o), 6) DESC, term LIMIT 20""")
def st10(spark, sf):
    d = table(spark, sf, "documents")
    t = d.select("doc_id", F.explode(tx.word_tokens("text")).alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("value"))
    return rounded(r.chi2_features(t, d.select("doc_id", "lang"), "doc_id", "lang", 20))


@query("ST11_bands", """SELECT event_id, CASE WHEN s >= 0.8 THEN 'excellent' WHEN s >= 0.6 THEN 'good' WHEN s >= 0.4 THEN 'fair' ELSE 'poor' END AS grade,
  CASE WHEN s >= 0.8 THEN 'high' WHEN s >= 0.6 THEN 'medium' WHEN s >= 0.4 THEN 'low' ELSE 'very_low' END AS band FROM (SELECT event_id, value / 50 AS s FROM events)""")
def st11(spark, sf):
    s = F.col("value") / 50
    return events(spark, sf).select("event_id", r.grade(s).alias("grade"), r.confidence_band(s).alias("band"))


# ---- frames

@query("W01_top_classes")
def w01(spark, sf):
    e = table(spark, sf, "embeddings")
    p = F.transform(F.slice("embedding", 1, 5), lambda x: F.abs(x).cast("double"))
    return e.select("vec_id", F.posexplode(r.top_classes(p, ["a", "b", "c", "d", "e"])).alias("rank", "top")).select("vec_id", "rank", "top.*")


@query("W02_top_k_per_group", "SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank FROM events QUALIFY rank <= 10")
def w02(spark, sf):
    return r.top_k_per_group(events(spark, sf).select("event_type", "event_id", "value"), ["event_type"], "value", 10, "event_id")


@query("W03_diff_previous", "SELECT event_id, event_type, ts, value, round(value - lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS diff FROM events")
def w03(spark, sf):
    return rounded(r.diff_previous(events(spark, sf).select("event_id", "event_type", "ts", "value"), ["ts", "event_id"], "value", ["event_type"]))


@query("W04_first_last", "SELECT event_type, arg_min(value, (ts, event_id)) AS first, arg_max(value, (ts, event_id)) AS last FROM events GROUP BY 1")
def w04(spark, sf):
    return r.first_last(events(spark, sf), ["ts", "event_id"], "value", ["event_type"])


@query("W05_moving_average", "SELECT event_id, ts, value, round(avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS ma_30 FROM events")
def w05(spark, sf):
    return rounded(r.moving_average(events(spark, sf).select("event_id", "ts", "value"), ["ts", "event_id"], "value", 30))


SPIKE_LABEL = "CASE WHEN value > 12 THEN 'positive' WHEN value < 3 THEN 'negative' ELSE 'neutral' END"


def labelled_events(spark, sf):
    v = F.col("value")
    return events(spark, sf).select("event_id", "user_id", "ts", F.when(v > 12, "positive").when(v < 3, "negative").otherwise("neutral").alias("label"))


@query("W06_R05_spike_flags", f"""WITH e AS (SELECT event_id, user_id, ts, {SPIKE_LABEL} AS label FROM events), w AS (SELECT *, count(*) OVER f AS n, avg(CAST(label = 'positive' AS DOUBLE)) OVER f AS p,
  avg(CAST(label = 'negative' AS DOUBLE)) OVER f AS g FROM e WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, CASE WHEN n = 10 AND p >= 0.6 THEN 'positive_spike' WHEN n = 10 AND g >= 0.6 THEN 'negative_spike' END AS spike FROM w""")
def w06(spark, sf):
    return r.spike_flags(labelled_events(spark, sf), ["ts", "event_id"], "label", ["user_id"], 10, 0.6).select("event_id", "user_id", "spike")


@query("W07_rolling_std", """SELECT event_id, ts, value, CASE WHEN count(*) OVER f = 3 THEN round(stddev_pop(value) OVER f, 6) END AS rolling_std FROM events
WINDOW f AS (ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def w07(spark, sf):
    return rounded(r.rolling_std(events(spark, sf).select("event_id", "ts", "value"), ["ts", "event_id"], "value"))


@query("W08_G03_metric_anomalies", """WITH w AS (SELECT event_id, event_type, ts, value, avg(value) OVER f AS mean, stddev_pop(value) OVER f AS std FROM events
WINDOW f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))
SELECT event_id, event_type, ts, value, round(mean, 6) AS mean, round(std, 6) AS std FROM w WHERE std > 5 AND abs(value - mean) > 2 * std""")
def w08(spark, sf):
    return rounded(r.metric_anomalies(events(spark, sf).select("event_id", "event_type", "ts", "value"), ["ts", "event_id"], "value", ["event_type"]))


@query("W09_cumulative_sum", "SELECT event_id, value, round(sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS cumulative FROM events")
def w09(spark, sf):
    return r.cumulative_sum(events(spark, sf).select("event_id", "ts", "value"), ["ts", "event_id"], "value").select("event_id", "value", F.round("cumulative", 4).alias("cumulative"))


# ---- sorts, sets, samples

@query("O01_top_n", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 20")
def o01(spark, sf):
    return r.top_n(events(spark, sf).select("event_id", "value"), "value", 20, "event_id")


@query("O02_sort_results", "SELECT source, count(*) AS n FROM documents GROUP BY 1")
def o02(spark, sf):
    return r.sort_results(table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")), [F.col("n").desc(), "source"])


@query("O03_first_n", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10")
def o03(spark, sf):
    return r.first_n(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 10)


@query("O04_most_recent", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def o04(spark, sf):
    return r.most_recent(events(spark, sf).select("event_id", "ts"), "ts", 50, "event_id")


@query("O05_diversify", """SELECT event_id, event_type, value FROM (SELECT *, row_number() OVER (ORDER BY value DESC, event_id) AS a,
  row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS b FROM events) WHERE a <= 3 OR b = 1""")
def o05(spark, sf):
    return r.diversify(events(spark, sf).select("event_id", "event_type", "value"), "event_type", "value", "event_id")


U_TOK = f"list_distinct({tokens_sql('text')})"


def turn_pairs(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", tx.word_tokens("text").alias("t"))
    return c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("t").alias("u")), ["conv_id", "turn"])


U_SQL = f"""WITH c AS (SELECT conv_id, turn, {U_TOK} AS t FROM conversations), p AS (SELECT a.conv_id, a.turn, a.t, b.t AS u FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, """


@query("U01_jaccard", U_SQL + "round(CASE WHEN len(t) + len(u) = 0 THEN 0 ELSE len(list_intersect(t, u))::DOUBLE / len(list_distinct(list_concat(t, u))) END, 6) AS jaccard FROM p")
def u01(spark, sf):
    return turn_pairs(spark, sf).select("conv_id", "turn", F.round(r.jaccard(F.col("t"), F.col("u")), 6).alias("jaccard"))


@query("U02_overlap_ratio", U_SQL + "round(CASE WHEN len(t) = 0 THEN 0 ELSE len(list_intersect(t, u))::DOUBLE / len(t) END, 6) AS overlap FROM p")
def u02(spark, sf):
    return turn_pairs(spark, sf).select("conv_id", "turn", F.round(r.overlap_ratio(F.col("t"), F.col("u")), 6).alias("overlap"))


@query("U03_query_relevance", U_SQL + "round(CASE WHEN len(u) = 0 THEN 0 ELSE len(list_intersect(t, u))::DOUBLE / len(u) END, 6) AS relevance FROM p")
def u03(spark, sf):
    return turn_pairs(spark, sf).select("conv_id", "turn", F.round(r.query_relevance(F.col("u"), F.col("t")), 6).alias("relevance"))


U04_A = "(SELECT DISTINCT source FROM documents WHERE lang = 'de')"
U04_B = "(SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE lang = 'es')"


@query("U04_category_diff", f"SELECT source, 'only_first' AS side FROM ({U04_A} EXCEPT {U04_B}) UNION ALL SELECT source, 'only_second' FROM ({U04_B} EXCEPT {U04_A})")
def u04(spark, sf):
    d = table(spark, sf, "documents")
    return r.category_diff(d.where("lang = 'de'"), d.where("lang = 'es'").join(table(spark, sf, "labels"), "doc_id", "left_semi"), "source")


@query("U05_union_results", "SELECT doc_id AS id, lang, NULL AS role FROM documents UNION ALL SELECT conv_id, NULL, role FROM conversations")
def u05(spark, sf):
    return r.union_results(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang"),
                           table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "role"))


@query("U06_union_distinct", "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'the') OR lang = 'fr'")
def u06(spark, sf):
    d = articles(spark, sf, "lang")
    return r.union_distinct(d.where(F.contains(F.lower("text"), F.lit("the"))), d.where("lang = 'fr'"), "doc_id").select("doc_id", "lang")


@query("M01_hash_sample", "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def m01(spark, sf):
    return r.hash_sample(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100)


@query("M02_stratified_split", """SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) - 1 < round(count(*) OVER (PARTITION BY lang) * 0.8) THEN 'train' ELSE 'validation' END AS split FROM documents""")
def m02(spark, sf):
    return r.stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id")


@query("M03_sample_unseen", """WITH f AS (SELECT doc_id, substring(text, 1, 50) IN (SELECT substring(text, 1, 50) FROM documents JOIN labels USING (doc_id)) AS seen FROM documents),
n AS (SELECT count(*) FILTER (NOT seen) AS n_left FROM f) SELECT doc_id FROM f, n WHERE NOT seen OR n_left < 20 ORDER BY md5('42:' || doc_id), doc_id LIMIT 20""")
def m03(spark, sf):
    d = articles(spark, sf)
    return r.sample_unseen(d, d.join(table(spark, sf, "labels"), "doc_id", "left_semi"), "text", "doc_id", 20).select("doc_id")


@query("M04_label_index", "SELECT source, row_number() OVER (ORDER BY source) - 1 AS label_id FROM (SELECT DISTINCT source FROM documents)")
def m04(spark, sf):
    return r.label_index(table(spark, sf, "documents"), "source")


# ---- dates

@query("T01_synthesize_dates", f"SELECT doc_id, CAST(date AS VARCHAR) AS date FROM {DATED}")
def t01(spark, sf):
    return dated(spark, sf).select("doc_id", F.col("date").cast("string"))


MIXED = "CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%d/%m/%Y') WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE 'no date' END"


@query("T02_parse_dates", f"""SELECT event_id, strftime(coalesce(try_strptime(s, '%Y-%m-%d %H:%M:%S'), try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%d/%m/%Y')), '%Y-%m-%d %H:%M:%S') AS parsed
FROM (SELECT event_id, {MIXED} AS s FROM events)""")
def t02(spark, sf):
    ts, k = F.col("ts"), F.col("event_id") % 4
    s = (F.when(k == 0, F.date_format(ts, "yyyy-MM-dd")).when(k == 1, F.date_format(ts, "dd/MM/yyyy"))
         .when(k == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise("no date"))
    return events(spark, sf).select("event_id", F.date_format(tm.parse_dates(s), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("T03_period", "SELECT event_id, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month FROM events")
def t03(spark, sf):
    return events(spark, sf).select("event_id", tm.period("ts", "week").cast("string").alias("week"), tm.period("ts", "month").cast("string").alias("month"))


@query("T04_date_parts", "SELECT o_orderkey, month(o_orderdate) AS month, quarter(o_orderdate) AS quarter, isodow(o_orderdate) - 1 AS weekday FROM orders")
def t04(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", tm.date_parts("o_orderdate").alias("p")).select("o_orderkey", "p.*")


@query("T06_date_span", f"""SELECT lang, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date, max(date) - min(date) AS span_days,
  round(count(*)::DOUBLE / greatest(max(date) - min(date), 1), 6) AS rows_per_day FROM {DATED} GROUP BY 1""")
def t06(spark, sf):
    return rounded(tm.date_span(dated(spark, sf, "lang"), "date", ["lang"])).withColumns(
        {c: F.col(c).cast("string") for c in ("first_date", "last_date")})


@query("T07_time_filter", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY")
def t07(spark, sf):
    return tm.time_filter(events(spark, sf), "ts", "2024-01-30 00:00:00", "7 days").select("event_id")


