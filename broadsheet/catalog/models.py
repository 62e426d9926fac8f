"""Rows C on documents and labels, Z and F32 on conversations."""

from pyspark.sql import functions as F

from broadsheet.catalog.relations import rounded
from broadsheet.catalog.sentiments import SCORED, scored
from broadsheet.catalog.tables import articles, hits_sql, list_sql, table
from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.operators import classify as c
from broadsheet.operators import evaluate as ev
from broadsheet.operators import features as ft
from broadsheet.operators import queries as q
from broadsheet.operators import relational as r
from broadsheet.registry import query
from broadsheet.session import materialize

_CACHE = {}


def prepared(spark, sf):
    """Split table with feature vectors, the vocabulary model, the fitted models, and the split texts. Texts are split, as their tokens are several times larger."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        texts = materialize(r.stratified_split(table(spark, sf, "documents").select("doc_id", "lang", "text"), "lang", "doc_id"))
        split = tokenized(texts)
        train = split.where("split = 'train'")
        tfidf = ft.fit_tfidf(train, "doc_id", "tokens", max_features=500, lo=1, hi=1, sub=False)  # counts x idf, as the vectors have it
        from pyspark.ml import Pipeline
        stages = Pipeline(stages=ft.vector_stages(tfidf, "tokens")).fit(train)
        data = materialize(stages.transform(split).select("doc_id", "lang", "split", "features"))
        _CACHE[key] = (data, tfidf, {}, texts)
    return _CACHE[key]


def tokenized(texts):
    return texts.withColumn("tokens", tx.word_tokens("text")).drop("text")


def trained(spark, sf, names):
    data, _, models, _ = prepared(spark, sf)
    missing = [n for n in names if n not in models]
    if missing:
        models.update(c.train_classifiers(data.where("split = 'train'"), data.where("split = 'validation'"), "lang", missing, trees=20, iterations=20))
    return {n: models[n] for n in names}


ALL = ["logistic_regression", "naive_bayes", "svm", "random_forest"]


@query("C01_C03_train_classifiers")
def c01(spark, sf):
    t = trained(spark, sf, ALL)
    best = c.best_model(t)
    rows = table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("rows"))
    scores = spark.createDataFrame([(n, float(a), n == best) for n, (_, a) in t.items()], "model string, accuracy double, best boolean")
    return scores.join(F.broadcast(rows))


@query("C02_tune")
def c02(spark, sf):
    data, *_ = prepared(spark, sf)
    _, mean, std = c.tune(data, "lang", {"regParam": [0.01, 0.1]}, 3)
    return data.agg(F.count(F.lit(1)).alias("rows"), F.lit(float(mean)).alias("accuracy"), F.lit(float(std)).alias("std"))


@query("C04_ensemble_predict")
def c04(spark, sf):
    data, *_ = prepared(spark, sf)
    models = {n: m for n, (m, _) in trained(spark, sf, ["logistic_regression", "naive_bayes", "random_forest"]).items()}
    return c.ensemble_predict(models, data, "doc_id", ["lang"])


def predictions(spark, sf):
    data, *_ = prepared(spark, sf)
    return c.predict_with_confidence(trained(spark, sf, ["logistic_regression"])["logistic_regression"][0], data, "doc_id", keep=["lang"])


@query("C05_predict_with_confidence")
def c05(spark, sf):
    return predictions(spark, sf).withColumn("top", F.to_json("top"))


@query("C06_explain_prediction")
def c06(spark, sf):
    _, tfidf, _, texts = prepared(spark, sf)
    model = trained(spark, sf, ["logistic_regression"])["logistic_regression"][0]
    weights = tfidf.transform(tokenized(texts), "doc_id", "tokens").withColumnRenamed("tfidf", "value")
    return c.explain_prediction(predictions(spark, sf), weights, c.coefficient_table(model, ft.vocabulary_list(tfidf), spark), "doc_id")


@query("C06_forest_importances")
def c06b(spark, sf):
    _, tfidf, *_ = prepared(spark, sf)
    return c.forest_importances(trained(spark, sf, ["random_forest"])["random_forest"][0], ft.vocabulary_list(tfidf), spark)


PRED = "(SELECT doc_id, CAST(quality AS VARCHAR) AS t, CAST(CASE WHEN doc_id % 7 = 0 THEN 1 - quality WHEN doc_id % 11 = 0 THEN 2 ELSE quality END AS VARCHAR) AS p FROM labels)"


def predicted(spark, sf):
    k = F.when(F.col("doc_id") % 7 == 0, 1 - F.col("quality")).when(F.col("doc_id") % 11 == 0, 2).otherwise(F.col("quality"))
    return table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("t"), k.cast("string").alias("p"))


def report_sql(src, t="t", p="p"):
    return f"""SELECT * FROM (WITH ce AS (SELECT {t} AS t, {p} AS p, count(*) AS n FROM {src} GROUP BY 1, 2), h AS (SELECT t AS class, sum(n) AS support, sum(CASE WHEN t = p THEN n ELSE 0 END) AS tp FROM ce GROUP BY 1), sd AS (SELECT p AS class, sum(n) AS said FROM ce GROUP BY 1),
a AS (SELECT coalesce(h.class, sd.class) AS class, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(said, 0) AS said FROM h FULL JOIN sd ON h.class = sd.class),
b AS (SELECT *, CASE WHEN said = 0 THEN 0 ELSE tp::DOUBLE / said END AS pr, CASE WHEN support = 0 THEN 0 ELSE tp::DOUBLE / support END AS re FROM a), f AS (SELECT *, CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END AS f1 FROM b)
SELECT class, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 6), round(sum(re * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', round(sum(tp)::DOUBLE / sum(support), 6), round(sum(tp)::DOUBLE / sum(support), 6), round(sum(tp)::DOUBLE / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f)"""


@query("C07_classification_report", report_sql(PRED))
def c07(spark, sf):
    return rounded(c.classification_report(predicted(spark, sf), "t", "p"))


@query("C08_calibration_bins", """WITH b AS (SELECT CAST(least(floor(value / 60 * 10), 9) AS BIGINT) AS bin, value / 60 AS p, CAST(event_type = 'click' AS INTEGER) AS ok FROM (SELECT *, least(value, 60) AS v FROM events)), g AS (SELECT bin, count(*) AS rows, avg(ok) AS a, avg(p) AS m FROM b GROUP BY 1)
SELECT bin, rows, round(a, 6) AS accuracy, round(m, 6) AS mean_confidence, round(sum(abs(a - m) * rows) OVER () / sum(rows) OVER (), 6) AS ece FROM g""")
def c08(spark, sf):
    e = table(spark, sf, "events").withColumn("p", F.col("value") / 60)
    return rounded(c.calibration_bins(e, "p", F.col("event_type") == "click"))


@query("C09_ensemble_agreement", "SELECT event_id, round(least(1.0::DOUBLE, value / 50 / ((1 - value / 50) + 0.1::DOUBLE)), 6) AS agreement FROM events WHERE value < 50")
def c09(spark, sf):
    p = F.col("value") / 50
    return rounded(table(spark, sf, "events").where("value < 50").select("event_id", c.ensemble_agreement(p, 1 - p).alias("agreement")))


@query("C10_compare_models", f"""SELECT a.class, a.f1 AS f1_model, b.f1 AS f1_baseline, round(a.f1 - b.f1, 4) AS difference, round((a.f1 - b.f1) / nullif(b.f1, 0), 4) AS relative FROM ({report_sql(PRED)}) a JOIN ({report_sql("(SELECT t, '1' AS p FROM " + PRED + ")")}) b ON a.class = b.class""")
def c10(spark, sf):
    d = predicted(spark, sf)
    base = c.classification_report(d.withColumn("p", F.lit("1")), "t", "p")
    out = c.compare_models(rounded(c.classification_report(d, "t", "p")), rounded(base))
    return out.select("class", "f1_model", "f1_baseline", F.round("difference", 4).alias("difference"), F.round("relative", 4).alias("relative"))


RAT = {"en": ["thion", "oning", "ing", "the"], "fr": ["elle", "eau"]}


@query("C11_prediction_rationale", "SELECT doc_id, CASE WHEN cf > 0.8 THEN 'High confidence' WHEN cf > 0.6 THEN 'Moderate confidence' ELSE 'Low confidence' END || ' classification as ' || lang || CASE WHEN len(f) > 0 THEN ' based on: ' || array_to_string(f, ', ') ELSE '' END AS rationale FROM (SELECT doc_id, lang, (doc_id % 10) / 10.0::DOUBLE AS cf, CASE lang "
       + " ".join(f"WHEN '{l}' THEN list_filter({list_sql(w)}, lambda x: contains(lower(text), x))[1:3]" for l, w in RAT.items()) + " ELSE [] END AS f FROM documents)")
def c11(spark, sf):
    d = articles(spark, sf, "lang").withColumn("cf", (F.col("doc_id") % 10) / 10.0)
    return c.prediction_rationale(d, "text", "lang", "cf", RAT).select("doc_id", "rationale")


@query("C12_train_intent")
def c12(spark, sf):
    turns = table(spark, sf, "conversations").select(F.expr("conv_id * 1000 + turn").alias("id"), "role", tx.word_tokens("text").alias("tokens"))
    model, _ = c.train_intent(turns, "id", "tokens", "role")
    return c.with_names(model, model.transform(turns)).select("id", "role", "predicted")


# ---- query tables

CONV = "SELECT conv_id, turn, role, text, lower(text) AS low FROM conversations"


def turns(spark, sf):
    return table(spark, sf, "conversations")


NUM = " ".join(f"WHEN contains(low, '{w}') THEN {i}" for i, w in enumerate(wl.NUMBER_WORDS, 1))
TIMES = " ".join(f"WHEN {hits_sql('low', w)} > 0 THEN '{l}'" for l, w in wl.TIME_FILTERS)
SENTS = ", ".join(f"CASE WHEN {hits_sql('low', w)} > 0 THEN '{s}' END" for s, w in wl.QUERY_SENTIMENTS.items())


@query("F32_parse_query", f"""SELECT conv_id, turn, CASE WHEN regexp_extract(text, '\\b(\\d+)\\b', 1) <> '' THEN CAST(least(CAST(regexp_extract(text, '\\b(\\d+)\\b', 1) AS DOUBLE), 20) AS INTEGER) {NUM} ELSE 3 END AS quantity,
  array_to_string(regexp_extract_all(text, '"([^"]*)"', 1), '|') AS phrases, array_to_string(regexp_extract_all(text, '\\b\\d+\\b'), ',') AS numbers, array_to_string(list_filter({list_sql(wl.QUERY_CATEGORIES)}, lambda w: contains(low, w)), ',') AS categories,
  CASE {TIMES} END AS time_filter, concat_ws(',', {SENTS}) AS sentiments, CAST({hits_sql('low', wl.FOLLOW_UP_WORDS)} > 0 AS INTEGER) AS follow_up FROM ({CONV})""")
def f32(spark, sf):
    p = turns(spark, sf).select("conv_id", "turn", q.parse_query("text").alias("p")).select("conv_id", "turn", "p.*")
    return p.select("conv_id", "turn", "quantity", F.array_join("phrases", "|").alias("phrases"), *[F.array_join(x, ",").alias(x) for x in ("numbers", "categories", "sentiments")],
                    "time_filter", F.col("follow_up").cast("int"))


INTENTS = {"north": {"keywords": ["the", "thion", "oning"], "examples": ["the that"]}, "west": {"keywords": ["elle", "eau", "qui", "ch"], "examples": ["de la"]}, "east": {"keywords": ["sch", "ung"], "examples": []}}
ISC = {n: f"({hits_sql('low', v['keywords'])} + 3 * {hits_sql('low', v['examples']) if v['examples'] else 0}) / {len(v['keywords'])}.0::DOUBLE" for n, v in INTENTS.items()}
INT = "SELECT *, CASE WHEN greatest(north, west, east) = 0 THEN 'unknown' WHEN north = greatest(north, west, east) THEN 'north' WHEN west = greatest(north, west, east) THEN 'west' ELSE 'east' END AS intent, greatest(north, west, east) AS s FROM (SELECT *, " + ", ".join(f"{s} AS {n}" for n, s in ISC.items()) + f" FROM ({CONV}) WHERE role = 'user')"


def intents(spark, sf):
    return q.classify_intent(turns(spark, sf).where("role = 'user'"), "text", INTENTS)


@query("Z01_classify_intent", f"SELECT conv_id, turn, intent, round(s, 6) AS intent_score, round(least(s, 1.0), 6) AS intent_confidence FROM ({INT})")
def z01(spark, sf):
    return rounded(intents(spark, sf).select("conv_id", "turn", "intent", "intent_score", "intent_confidence"))


@query("Z01_classify_intent_default", None)
def z01b(spark, sf):
    return q.classify_intent(turns(spark, sf), "text").select("conv_id", "turn", "intent", "intent_confidence")


@query("Z02_combine_intents", f"""WITH i AS ({INT}), b AS (SELECT conv_id * 1000 + turn AS id, intent, least(s, 1.0) * 0.7::DOUBLE AS score FROM i UNION ALL SELECT conv_id * 1000 + turn, CASE WHEN turn % 4 = 0 THEN 'north' ELSE 'west' END, 0.9 * 0.3::DOUBLE FROM i),
g AS (SELECT id, intent, sum(score) AS score FROM b GROUP BY 1, 2) SELECT id, arg_max(intent, (round(score, 9), intent)) AS intent, round(max(score), 6) AS confidence FROM g GROUP BY 1""")
def z02(spark, sf):
    i = intents(spark, sf).withColumn("id", F.expr("conv_id * 1000 + turn"))
    model = i.select("id", F.when(F.col("turn") % 4 == 0, "north").otherwise("west").alias("intent"), F.lit(0.9).alias("score"))
    return rounded(q.combine_intents(i.select("id", "intent", F.col("intent_confidence").alias("score")), model, "id"))


@query("Z03_intent_coverage", f"SELECT count(*) AS queries, count(*) FILTER (intent <> 'unknown') AS classified, count(*) FILTER (intent = 'unknown') AS unknown, round(avg(least(s, 1.0)), 6) AS mean_confidence, round(stddev_pop(least(s, 1.0)), 6) AS std_confidence FROM ({INT})")
def z03(spark, sf):
    return rounded(q.intent_coverage(intents(spark, sf))["summary"])


@query("Z04_suggest_intents", """WITH p AS (SELECT DISTINCT conv_id * 1000 + turn AS id, lower(substring(text, 1, 4)) AS prefix FROM conversations WHERE role = 'user'), e AS (SELECT DISTINCT 'i' || (item_id % 5) AS intent, lower(text) AS example FROM benchmark),
h AS (SELECT id, intent, example, length(prefix)::DOUBLE / length(example) AS score FROM p JOIN e ON starts_with(example, prefix) WHERE prefix = regexp_replace(prefix, '^\\s+|\\s+$', '', 'g'))
SELECT id, intent, example, round(score, 6) AS score, row_number() OVER (PARTITION BY id ORDER BY score DESC, example) AS rank FROM h QUALIFY rank <= 5""")
def z04(spark, sf):
    asked = turns(spark, sf).where("role = 'user'").select(F.expr("conv_id * 1000 + turn").alias("id"), F.lower(F.substring("text", 1, 4)).alias("prefix")).where(~F.col("prefix").rlike(r"^\s|\s$"))
    examples = table(spark, sf, "benchmark").select(F.concat(F.lit("i"), F.col("item_id") % 5).alias("intent"), F.col("text").alias("example"))
    return rounded(q.suggest_intents(asked, "id", "prefix", examples))


@query("Z06_corpus_insights", "WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1) SELECT (SELECT count(*) FROM documents) AS rows, (SELECT round(avg(length(text)), 6) FROM documents) AS mean_length, arg_max(source, (n, source)) AS top_category, max(n) AS top_rows, count(*) AS categories FROM c")
def z06(spark, sf):
    return rounded(q.corpus_insights(articles(spark, sf), "text", "category"))


@query("Z07_compare_coverage", "WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1) SELECT source, n AS count, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS percentage, round(avg(n) OVER (), 6) AS mean, CASE WHEN n > avg(n) OVER () THEN 'increasing' ELSE 'stable' END AS trend FROM c")
def z07(spark, sf):
    return rounded(q.compare_coverage(table(spark, sf, "documents"), "source"))


@query("Z08_analyze_articles")
def z08(spark, sf):
    out = q.analyze_articles(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", ["category", "sentiment", "language", "readability"])
    return out.select("doc_id", *[F.to_json(x).alias(x) for x in ("sentiment", "language", "readability")])


@query("Z09_evaluate_labels", report_sql(PRED))
def z09(spark, sf):
    return rounded(ev.evaluate_component(predicted(spark, sf), "labels", "t", "p"))


@query("Z09_evaluate_queries", f"SELECT count(*) AS queries, round(avg((intent <> 'unknown')::INT), 6) AS success_rate FROM ({INT})")
def z09b(spark, sf):
    return rounded(ev.evaluate_component(intents(spark, sf).withColumn("success", F.col("intent") != "unknown"), "queries"))


@query("Z10_grade_components", f"""WITH m AS (SELECT class AS component, 'classification_accuracy' AS metric, f1 AS value FROM ({report_sql(PRED)})), g AS (SELECT *, 0.85::DOUBLE AS threshold, CASE WHEN value >= 0.9 THEN 'excellent' WHEN value >= 0.8 THEN 'good' WHEN value >= 0.7 THEN 'fair' ELSE 'poor' END AS grade FROM m),
p AS (SELECT *, CASE grade WHEN 'excellent' THEN 4.0 WHEN 'good' THEN 3.0 WHEN 'fair' THEN 2.0 ELSE 1.0 END::DOUBLE AS points FROM g)
SELECT component, metric, value, grade, points, CAST(value >= threshold AS INTEGER) AS met, round(avg(points) OVER (), 6) AS overall_points, CASE WHEN avg(points) OVER () >= 3.5 THEN 'excellent' WHEN avg(points) OVER () >= 2.5 THEN 'good' WHEN avg(points) OVER () >= 1.5 THEN 'fair' ELSE 'poor' END AS overall_grade FROM p""")
def z10(spark, sf):
    rep = rounded(c.classification_report(predicted(spark, sf), "t", "p"))
    m = rep.select(F.col("class").alias("component"), F.lit("classification_accuracy").alias("metric"), F.col("f1").alias("value"))
    return rounded(ev.grade_components(m)).select("component", "metric", "value", "grade", "points", F.col("met").cast("int"), "overall_points", "overall_grade")


@query("Z12_executive_summary", f"""SELECT 'classification' AS section, 'accuracy' AS finding, f1 AS value FROM ({report_sql(PRED)}) WHERE class = 'accuracy'
UNION ALL SELECT 'sentiment', arg_max(sentiment, (n, sentiment)), round(max(n) * 100.0::DOUBLE / sum(n), 6) FROM (SELECT sentiment, count(*) AS n FROM ({SCORED}) GROUP BY 1)""")
def z12(spark, sf):
    from broadsheet.operators.sentiment import label_shares
    return rounded(ev.executive_summary({"classification": c.classification_report(predicted(spark, sf), "t", "p"), "sentiment": label_shares(scored(spark, sf))}))


@query("Z13_chart_timeline", "SELECT CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR) AS period, event_type, count(*) AS count FROM events GROUP BY 1, 2")
def z13(spark, sf):
    return ev.chart_data(table(spark, sf, "events"), "timeline", date_col="ts", by=["event_type"]).withColumn("period", F.col("period").cast("string"))


@query("Z13_chart_heatmap", f"SELECT t AS truth, p AS predicted, count(*) AS n FROM {PRED} GROUP BY 1, 2")
def z13b(spark, sf):
    return ev.chart_data(predicted(spark, sf), "heatmap", truth="t", pred="p")


CATS, CUES = ["thion", "elle", "sch", "para"], ["the", "que", "und"]


@query("Z14_carry_context", f"""WITH n AS (SELECT conv_id, turn, list_filter({list_sql(CATS)}, lambda w: contains(low, w))[1] AS named_category, CAST({hits_sql('low', CUES)} > 0 AS INTEGER) AS follow_up FROM ({CONV}))
SELECT conv_id, turn, named_category, follow_up, coalesce(named_category, last_value(named_category IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)) AS category FROM n""")
def z14(spark, sf):
    return q.carry_context(turns(spark, sf), "conv_id", "turn", "text", CATS, CUES).select("conv_id", "turn", "named_category", F.col("follow_up").cast("int"), "category")


