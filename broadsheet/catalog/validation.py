"""Rows V01-V09 on documents and G01-G07 on events."""

from pyspark.sql import functions as F

from broadsheet.catalog.relations import events, rounded
from broadsheet.catalog.tables import articles, table, words_sql
from broadsheet.operators import metrics as m
from broadsheet.operators import quality as q
from broadsheet.registry import query

ART = "(SELECT doc_id, text, source AS category FROM documents)"


def report(df):
    return rounded(df)


def long_sql(check, wide, severities=None):
    """Report rows from a one-row query; severities maps a metric to SQL."""
    sev = severities or {}
    cols = [c for c, _ in wide]
    inner = ", ".join(f"{e} AS {c}" for c, e in wide)
    parts = [f"SELECT '{check}' AS check_name, '{c}' AS metric, round(CAST({c} AS DOUBLE), 6) AS value, {sev.get(c, chr(39) + 'info' + chr(39))} AS severity FROM w" for c in cols]
    return inner, " UNION ALL ".join(parts)


def positive(c, level="warning"):
    return f"CASE WHEN {c} > 0 THEN '{level}' ELSE 'info' END"


LOWQ = "(length(text) > 0 AND (len(regexp_extract_all(text, '\\p{Nd}')) > length(text) * 0.5::DOUBLE OR len(regexp_extract_all(text, '\\p{L}')) < length(text) * 0.3::DOUBLE))"
TEXT_INNER, TEXT_ROWS = long_sql("text", [
    ("min_length", "min(length(text))"), ("max_length", "max(length(text))"), ("mean_length", "avg(length(text))"),
    ("median_length", "quantile_cont(length(text), 0.5)"), ("std_length", "stddev_samp(length(text))"),
    ("empty", "count(*) FILTER (NOT regexp_matches(text, '\\S'))"), ("too_short", "count(*) FILTER (length(text) < 50)"),
    ("too_long", "count(*) FILTER (length(text) > 50000)"), ("low_quality", f"count(*) FILTER ({LOWQ})")],
    {"empty": positive("empty", "issue"), **{c: positive(c) for c in ("too_short", "too_long", "low_quality")}})
TEXT_SQL = f"WITH w AS (SELECT {TEXT_INNER} FROM {ART} WHERE text IS NOT NULL) {TEXT_ROWS}"

CAT_INNER, CAT_ROWS = long_sql("category", [
    ("categories", "count(*)"), ("largest", "max(n)"), ("smallest", "min(n)"), ("imbalance", "max(n)::DOUBLE / min(n)"),
    ("below_minimum", "count(*) FILTER (n < 10)"), ("spelling_variants", "count(*) - count(DISTINCT lower(trim(c)))"),
    ("numeric_names", "count(*) FILTER (regexp_matches(c, '^\\d+$'))")],
    {"imbalance": "CASE WHEN imbalance > 10 THEN 'warning' ELSE 'info' END", **{c: positive(c) for c in ("below_minimum", "spelling_variants", "numeric_names")}})
CAT_SQL = f"WITH w AS (SELECT {CAT_INNER} FROM (SELECT category AS c, count(*) AS n FROM {ART} GROUP BY 1)) {CAT_ROWS}"

MISSING = "SELECT 'missing' AS check_name, '{c}' AS metric, count(*) FILTER ({c} IS NULL)::DOUBLE AS value, CASE WHEN count(*) FILTER ({c} IS NULL) > count(*) * 0.1::DOUBLE THEN 'warning' ELSE 'info' END AS severity FROM {t}"
MISSING_SQL = " UNION ALL ".join(MISSING.format(c=c, t=ART) for c in ("doc_id", "text", "category"))

DUP_INNER, DUP_ROWS = long_sql("duplicates", [
    ("exact", "count(*) - count(DISTINCT text)"), ("prefix", "count(*) - count(DISTINCT substring(text, 1, 100))"),
    ("prefix_only", "count(DISTINCT text) - count(DISTINCT substring(text, 1, 100))")], {c: positive(c) for c in ("exact", "prefix_only")})
DUP_SQL = f"WITH w AS (SELECT {DUP_INNER} FROM {ART}) {DUP_ROWS}"

DIST_INNER, DIST_ROWS = long_sql("distribution", [
    ("mean", "avg(n)"), ("std", "stddev_samp(n)"), ("cv", "stddev_samp(n) / avg(n)"),
    ("gini", "(count(*) + 1 - 2 * sum(cum)::DOUBLE / sum(n)) / count(*)")],
    {"cv": "CASE WHEN cv > 1.0 THEN 'severe' WHEN cv > 0.5 THEN 'moderate' ELSE 'info' END"})
DIST_SQL = f"WITH w AS (SELECT {DIST_INNER} FROM (SELECT n, sum(n) OVER (ORDER BY n, c ROWS UNBOUNDED PRECEDING) AS cum FROM (SELECT category AS c, count(*) AS n FROM {ART} GROUP BY 1))) {DIST_ROWS}"

W = words_sql("text")
QUAL_INNER, QUAL_ROWS = long_sql("quality", [
    ("mean_words", "avg(w)"), ("mean_sentences", "avg(s)"), ("mean_diversity", "avg(d)"),
    ("few_sentences", "count(*) FILTER (s < 3)"), ("low_diversity", "count(*) FILTER (d < 0.3)")],
    {c: positive(c) for c in ("few_sentences", "low_diversity")})
QUAL_SQL = f"""WITH w AS (SELECT {QUAL_INNER} FROM (SELECT len(w) AS w, len(list_filter(string_split(text, '.'), lambda x: regexp_matches(x, '\\S'))) AS s,
  CASE WHEN len(w) = 0 THEN 0 ELSE len(list_distinct(list_transform(w, lambda x: lower(x))))::DOUBLE / len(w) END AS d FROM (SELECT text, {W} AS w FROM documents))) {QUAL_ROWS}"""


@query("V01_check_structure", """SELECT 'structure' AS check_name, * FROM (VALUES ('empty', 0.0::DOUBLE, 'info'), ('missing:text', 0.0, 'info'), ('not_text:text', 0.0, 'info'),
  ('missing:category', 0.0, 'info'), ('not_text:category', 0.0, 'info')) AS t(metric, value, severity) WHERE (SELECT count(*) FROM documents) > 0""")
def v01(spark, sf):
    return report(q.check_structure(articles(spark, sf)))


@query("V02_check_text", TEXT_SQL)
def v02(spark, sf):
    return report(q.check_text(articles(spark, sf)))


@query("V03_check_categories", CAT_SQL)
def v03(spark, sf):
    return report(q.check_categories(articles(spark, sf)))


@query("V04_check_missing", MISSING_SQL)
def v04(spark, sf):
    return report(q.check_missing(articles(spark, sf)))


@query("V05_check_duplicates", DUP_SQL)
def v05(spark, sf):
    return report(q.check_duplicates(articles(spark, sf)))


@query("V06_check_distribution", DIST_SQL)
def v06(spark, sf):
    return report(q.check_distribution(articles(spark, sf)))


@query("V07_check_quality_metrics", QUAL_SQL)
def v07(spark, sf):
    return report(q.check_quality_metrics(articles(spark, sf)))


def _languages_sql():
    from broadsheet.catalog.languages import DETECTED
    return f"""WITH c AS (SELECT language, count(*) AS n FROM ({DETECTED}) WHERE n > 10 GROUP BY 1)
SELECT 'language' AS check_name, language AS metric, n::DOUBLE AS value, CASE WHEN (SELECT count(*) FROM c) > 1 THEN 'warning' ELSE 'info' END AS severity FROM c"""


LANG_SQL = _languages_sql()


@query("V08_check_language", LANG_SQL)
def v08(spark, sf):
    from broadsheet.catalog.languages import PROFILES
    return report(q.check_language(articles(spark, sf), profiles=PROFILES))


ALL_CHECKS = " UNION ALL ".join(f"SELECT * FROM ({s})" for s in (TEXT_SQL, CAT_SQL, MISSING_SQL, DUP_SQL, DIST_SQL, QUAL_SQL, LANG_SQL))


@query("V09_validate_dataset", f"""WITH r AS ({ALL_CHECKS} UNION ALL SELECT 'structure', * FROM (VALUES ('empty', 0.0::DOUBLE, 'info'), ('missing:text', 0.0, 'info'),
  ('not_text:text', 0.0, 'info'), ('missing:category', 0.0, 'info'), ('not_text:category', 0.0, 'info')) AS t(metric, value, severity)),
s AS (SELECT count(*) FILTER (severity = 'issue') AS i, count(*) FILTER (severity IN ('warning', 'moderate', 'severe')) AS w FROM r)
SELECT * FROM r UNION ALL SELECT 'summary', 'issues', i::DOUBLE, 'info' FROM s UNION ALL SELECT 'summary', 'warnings', w::DOUBLE, 'info' FROM s
UNION ALL SELECT 'summary', 'valid', CAST(i = 0 AS INTEGER)::DOUBLE, 'info' FROM s""")
def v09(spark, sf):
    from broadsheet.catalog.languages import PROFILES
    return report(q.validate_dataset(articles(spark, sf), profiles=PROFILES))


@query("V09_recommendations", f"""SELECT check_name, metric, CASE metric WHEN 'too_short' THEN 'Review very short texts' WHEN 'too_long' THEN 'Review very long texts'
  WHEN 'low_quality' THEN 'Review texts with few letters' WHEN 'empty' THEN 'Remove or fill empty texts' WHEN 'exact' THEN 'Remove duplicate texts' WHEN 'prefix_only' THEN 'Review near duplicates'
  END AS recommendation FROM (SELECT * FROM ({TEXT_SQL}) UNION ALL SELECT * FROM ({DUP_SQL})) WHERE severity <> 'info'""")
def v09b(spark, sf):
    a = articles(spark, sf)
    return q.recommendations(q.check_text(a).unionByName(q.check_duplicates(a))).select("check_name", "metric", "recommendation")


# ---- metric tables

@query("G01_endpoint_stats", """SELECT event_type, count(*) AS calls, count(*) FILTER (value > 25) AS errors, round(avg(CAST(value > 25 AS INTEGER)), 6) AS error_rate,
  round(avg(value), 6) AS mean_value, max(ts) AS last_call FROM events GROUP BY 1""")
def g01(spark, sf):
    return rounded(m.endpoint_stats(events(spark, sf), "event_type", F.col("value") > 25, "value", "ts"))


RULES = "SELECT event_type, quantile_cont(value, 0.9) AS threshold, CASE WHEN avg(value) > 10 THEN 'critical' ELSE 'warning' END AS severity FROM events GROUP BY 1"


def rules(spark, sf):
    """Thresholds taken from the table itself: one row per event type."""
    from broadsheet.plans.ordered import percentiles
    e = events(spark, sf)
    top = percentiles(e.select("event_type", "value"), "value", {"threshold": 0.9}, ["event_type"])
    level = e.groupBy("event_type").agg(F.when(F.avg("value") > 10, "critical").otherwise("warning").alias("severity"))
    return top.join(level, "event_type").withColumnRenamed("event_type", "metric")


@query("G02_threshold_alerts", f"SELECT event_id, event_type, value, round(threshold, 6) AS threshold, severity FROM events JOIN ({RULES}) USING (event_type) WHERE value > threshold")
def g02(spark, sf):
    return rounded(m.threshold_alerts(events(spark, sf).select("event_id", "event_type", "value"), rules(spark, sf), "event_type", "value", "event_id"))


@query("G04_metrics_since", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 48 HOUR AND event_type = 'click'")
def g04(spark, sf):
    return m.metrics_since(events(spark, sf), "ts", "2024-01-30 00:00:00", 48, name="click", name_col="event_type").select("event_id", "event_type")


@query("G05_health_summary", """
SELECT count(*) AS snapshots, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_discount), 6) AS l_discount,
  CAST(avg(l_quantity) <= 30 AND avg(l_discount) <= 0.2 AS INTEGER) AS healthy FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (ORDER BY l_shipdate DESC, l_orderkey * 10 + l_linenumber DESC) <= 1000)""")
def g05(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    limits = spark.createDataFrame([("l_quantity", 30.0), ("l_discount", 0.2)], "metric string, threshold double")
    return rounded(m.health_summary(li, limits, "l_shipdate", "id", 1000)).withColumn("healthy", F.col("healthy").cast("int"))


@query("G06_metric_trend", "SELECT event_type, count(*) AS rows, round(avg(value), 6) AS mean, max(value) AS max FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 72 HOUR GROUP BY 1")
def g06(spark, sf):
    return rounded(m.metric_trend(events(spark, sf), "ts", "2024-01-30 00:00:00", 72, "event_type", "value"))


@query("G07_score_histogram", "SELECT event_type, CAST(floor(value / 5) AS BIGINT) AS bin, count(*) AS rows, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2")
def g07(spark, sf):
    return rounded(m.score_histogram(events(spark, sf), "value", ["event_type"], 5))
