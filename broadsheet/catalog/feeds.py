"""Rows R on events and documents read as streams, and S on documents and pages."""

import uuid

from pyspark.sql import functions as F

from broadsheet.catalog.flagship import LABEL, TEST_LEXICON, TEST_NEGATIONS, compound_sql
from broadsheet.catalog.languages import DETECTED, PROFILES
from broadsheet.catalog.relations import rounded
from broadsheet.catalog.sentiments import BREAK
from broadsheet.catalog.tables import articles, hits_sql, table, words_sql
from broadsheet.registry import query
from broadsheet.session import shared_dir
from broadsheet.sources import io
from broadsheet.streaming import feeds as fd, spikes as sp
from broadsheet.streaming.progress import ProgressTable, rates


def fresh(spark):
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def stream(spark, sf, name):
    # a glob, as the file source takes a plain path for a folder: a table may be one file or a folder of parts
    return fd.article_stream(spark, f"{sf}/{{{name}}}.parquet", table(spark, sf, name).schema)


def written(spark, df, totals=False):
    """Run a stream to its end and read back what it wrote."""
    base = fresh(spark)
    q = fd.export_totals(df, f"{base}/out", f"{base}/state") if totals else fd.export_stream(df, f"{base}/out", f"{base}/state")
    q.awaitTermination()
    return fd.latest_totals(spark, f"{base}/out") if totals else spark.read.parquet(f"{base}/out")


@query("R01_R10_article_stream", "SELECT doc_id, lang FROM documents")
def r01(spark, sf):
    return written(spark, stream(spark, sf, "documents").select("doc_id", "lang"))


@query("R02_enrich_stream", f"SELECT doc_id, language, round(compound, 6) AS compound, {LABEL} AS sentiment, CASE WHEN regexp_matches(text, '\\S') THEN 'ok' ELSE 'error' END AS status FROM ({DETECTED}) JOIN (SELECT doc_id, compound FROM ({compound_sql('documents')})) USING (doc_id)")
def r02(spark, sf):
    out = fd.enrich_stream(stream(spark, sf, "documents").select("doc_id", "text"), "text", PROFILES, TEST_LEXICON, TEST_NEGATIONS)
    return rounded(written(spark, out.select("doc_id", "language", "compound", "sentiment", "status")))


@query("R04_breaking_alerts", f"SELECT doc_id FROM documents WHERE {hits_sql('lower(source) || chr(1) || lower(text)', BREAK)} >= 2")
def r04(spark, sf):
    return written(spark, fd.breaking_alerts(stream(spark, sf, "documents"), "source", "text", BREAK).select("doc_id"))


@query("R05_sentiment_spikes", """WITH e AS (SELECT event_id, user_id, ts, CASE WHEN value > 12 THEN 'positive' WHEN value < 3 THEN 'negative' ELSE 'neutral' END AS label FROM events), w AS (SELECT *, count(*) OVER f AS n, avg(CAST(label = 'positive' AS DOUBLE)) OVER f AS p,
  avg(CAST(label = 'negative' AS DOUBLE)) OVER f AS g FROM e WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS id, CASE WHEN n = 10 AND p >= 0.6 THEN 'positive_spike' WHEN n = 10 AND g >= 0.6 THEN 'negative_spike' END AS spike FROM w""")
def r05(spark, sf):
    return spiked(spark, sf, delay=240)[0]


#: A slice of the feed is one file, and of larger tables one per so many rows; a trigger takes the files of a slice.
SLICES, DELAY_HOURS, FILE_ROWS = 4, 1, 500_000


def labelled(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "user_id", F.when(v > 12, "positive").when(v < 3, "negative").otherwise("neutral").alias("label"))


def spiked(spark, sf, late=None, delay=DELAY_HOURS):
    """The events as a feed of several triggers, and what the listener saw of them. Rows come late by up to half the delay, those of `late` with the last trigger."""
    base, e = fresh(spark), labelled(spark, sf)
    behind = e.where(late) if late is not None else None
    feed = e.where(~late) if late is not None else e
    files = 1 if late is not None else max(1, feed.count() // (SLICES * FILE_ROWS))
    sp.replay(feed, "ts", f"{base}/feed", SLICES, behind, files, jitter="0 hours" if late is not None else f"{delay // 2} hours")
    rows = fd.event_time(fd.article_stream(spark, f"{base}/feed", feed.schema, max_files=files), "ts", f"{delay} hours")
    with ProgressTable(spark, f"{base}/progress") as seen:
        q = fd.export_stream(sp.sentiment_spikes(rows, "user_id", "event_id", "ts", "label", 10, 0.6), f"{base}/out", f"{base}/state")
        q.awaitTermination()
        seen.wait_for(q.runId)
    return spark.read.parquet(f"{base}/out").where("id IS NOT NULL").select("key", "id", "spike"), seen.table()


#: Rows that come three slices late; Spark drops what lies before the watermark of the trigger before.
LATE_SQL = f"""e AS (SELECT event_id, user_id, ts, epoch_us(ts) AS us, event_id % 50 = 7 AS behind, CASE WHEN value > 12 THEN 'positive' WHEN value < 3 THEN 'negative' ELSE 'neutral' END AS label FROM events),
span AS (SELECT min(us) AS low, max(us) AS high FROM e WHERE NOT behind),
fed AS (SELECT e.*, CASE WHEN behind THEN {SLICES - 1} ELSE least(floor((us - low) * {SLICES} / (high - low + 1)), {SLICES - 1}) END AS slice FROM e, span),
mark AS (SELECT max(us) // 1000 * 1000 - {DELAY_HOURS * 3_600_000_000} AS us FROM fed WHERE slice <= {SLICES - 3}),
kept AS (SELECT * FROM fed WHERE slice < {SLICES - 1} OR us > (SELECT us FROM mark))"""


@query("R08_late_rows", f"""WITH {LATE_SQL}, w AS (SELECT *, count(*) OVER f AS n, avg(CAST(label = 'positive' AS DOUBLE)) OVER f AS p, avg(CAST(label = 'negative' AS DOUBLE)) OVER f AS g
  FROM kept WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS id, CASE WHEN n = 10 AND p >= 0.6 THEN 'positive_spike' WHEN n = 10 AND g >= 0.6 THEN 'negative_spike' END AS spike FROM w""")
def r08_late(spark, sf):
    return spiked(spark, sf, F.col("event_id") % 50 == 7)[0]


@query("R07_R08_progress", f"WITH {LATE_SQL} SELECT (SELECT count(*) FROM fed) + 1 AS rows, {SLICES} + 1 AS triggers, (SELECT count(*) FROM fed) - (SELECT count(*) FROM kept) AS dropped_rows, 1 AS running")
def r07_progress(spark, sf):
    out = rates(spiked(spark, sf, F.col("event_id") % 50 == 7)[1])
    return out.select("rows", "triggers", "dropped_rows", ((F.col("running_seconds") > 0) & (F.col("rows_per_minute") > 0)).cast("int").alias("running"))


TREND = """WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY window_start) AS total FROM w)
SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS window_start, event_type, n, CAST(total AS BIGINT) AS total, round(n::DOUBLE / total, 6) AS share FROM t WHERE total >= 10 AND n >= 3 AND n::DOUBLE / total > 0.3"""


@query("R06_trending", TREND)
def r06(spark, sf):
    counts = fd.trending(fd.event_time(stream(spark, sf, "events"), "ts"), "ts", "event_type", "1 hour", "1 hour")
    out = fd.trending_share(written(spark, counts, totals=True), "event_type", 0.3, 3, 10)
    return rounded(out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query("R07_stream_stats", "SELECT lang, source, count(*) AS processed FROM documents GROUP BY 1, 2")
def r07(spark, sf):
    return written(spark, fd.stream_stats(stream(spark, sf, "documents"), ["lang", "source"]), totals=True)


@query("R07_running_totals", f"""WITH d AS (SELECT doc_id, text, NOT regexp_matches(text, '\\S') OR text IS NULL AS bad, language, {LABEL} AS sentiment FROM (SELECT doc_id, text FROM documents) JOIN (SELECT doc_id, language FROM ({DETECTED})) USING (doc_id) JOIN (SELECT doc_id, compound FROM ({compound_sql('documents')})) USING (doc_id))
SELECT CASE WHEN bad THEN 'errors' ELSE 'processed' END AS measure, NULL AS value, count(*) AS n FROM d GROUP BY bad UNION ALL SELECT 'language', language, count(*) FROM d WHERE NOT bad GROUP BY language
UNION ALL SELECT 'sentiment', sentiment, count(*) FROM d WHERE NOT bad GROUP BY sentiment""")
def r07_totals(spark, sf):
    rows = fd.enrich_stream(stream(spark, sf, "documents").select("doc_id", "text"), "text", PROFILES, TEST_LEXICON, TEST_NEGATIONS)
    return written(spark, fd.running_totals(rows, {"language": "language", "sentiment": "sentiment"}, F.col("status") == "error"), totals=True)


@query("R08_R11_dedup_stream", "SELECT DISTINCT user_id, event_type, CAST(date_trunc('day', ts) AS DATE)::VARCHAR AS day FROM events")
def r11(spark, sf):
    e = fd.event_time(stream(spark, sf, "events"), "ts", "40 days").withColumn("day", F.to_date("ts").cast("string"))
    return written(spark, fd.dedup_stream(e, ["user_id", "event_type", "day"]).select("user_id", "event_type", "day"))


@query("R09_recent_articles", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def r09(spark, sf):
    base = fresh(spark)
    fd.export_stream(stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), f"{base}/out", f"{base}/state").awaitTermination()
    return fd.recent_articles(spark, f"{base}/out", "ts", "event_id").select("event_id", "event_type")


@query("R03_R12_X01_hooks", "SELECT 'ok' AS event, count(*) AS n FROM documents WHERE length(text) >= 50 UNION ALL SELECT 'error', count(*) FROM documents WHERE length(text) < 50")
def r12(spark, sf):
    base = fresh(spark)
    hooks = fd.Hooks()
    for event in ("ok", "error"):
        hooks.register_sink(event, fd.epoch_sink(f"{base}/{event}"))
    status = F.when(F.length("text") >= 50, "ok").otherwise("error")
    s = stream(spark, sf, "documents").withColumn("status", status).select("doc_id", "status")
    fd.on_new(s, hooks.run({"ok": lambda b: fd.split_errors(b)[0], "error": lambda b: fd.split_errors(b)[1]}), f"{base}/state").awaitTermination()
    both = [spark.read.parquet(f"{base}/{e}").agg(F.lit(e).alias("event"), F.count(F.lit(1)).alias("n")) for e in ("ok", "error")]
    return both[0].unionByName(both[1])


@query("R13_event_rates", "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def r13(spark, sf):
    out = written(spark, fd.event_rates(fd.event_time(stream(spark, sf, "events"), "ts"), "ts", ["event_type"], "1 hour"), totals=True)
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


# ---- files

@query("S01_read_articles", "SELECT doc_id, text, source AS category FROM documents")
def s01(spark, sf):
    path = fresh(spark)
    articles(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return io.read_articles(spark, path, "csv", "doc_id BIGINT, text STRING, category STRING")


@query("S02_split_bulk_articles", """SELECT doc_id, i - 1 AS pos, t AS text FROM (SELECT doc_id, i, regexp_replace(p[i], '^\\s+|\\s+$', '', 'g') AS t FROM (SELECT doc_id, CASE WHEN regexp_matches(text, '\\n\\s*\\n') THEN regexp_split_to_array(text, '\\n\\s*\\n')
  WHEN regexp_matches(text, '\\. ') THEN regexp_split_to_array(text, '\\. ') ELSE [text] END AS p FROM documents), unnest(range(1, len(p) + 1)) AS u(i)) WHERE length(t) > 80""")
def s02(spark, sf):
    return io.split_bulk_articles(articles(spark, sf), "doc_id", "text", (r"\n\s*\n", r"\. "))


@query("S03_parse_feed_items")
def s03(spark, sf):
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    # XML has no place for these characters
    d = articles(spark, sf).withColumn("text", F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " "))
    xml = F.concat(F.lit("<rss><channel><item><title>"), esc(F.substring("text", 1, 40)), F.lit("</title><link>http://example.org/"), F.col("doc_id"),
                   F.lit("</link><description>"), esc(F.col("text")), F.lit("</description><pubDate>2024-01-01</pubDate></item></channel></rss>"))
    return io.parse_feed_items(d.select("doc_id", xml.alias("xml")), "xml", keep=["doc_id"])[0]


HTML = "html"
for _p in ("(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", "<[^>]+>"):
    HTML = f"regexp_replace({HTML}, '{_p}', ' ', 'g')"
for _e, _c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    HTML = f"replace({HTML}, '{_e}', '{_c}')"


@query("S04_html_to_text", f"SELECT page_id, trim(regexp_replace({HTML}, '\\s+', ' ', 'g')) AS text FROM pages")
def s04(spark, sf):
    return table(spark, sf, "pages").select("page_id", io.html_to_text("html").alias("text"))


@query("S05_verify_dataset", "SELECT count(*) AS rows, 0 AS missing_categories, 0 AS extra_categories, 0 AS different_counts, count(*) AS total_articles, 1 AS same_rows, CAST(count(*) > 500 AS INTEGER) AS ready FROM documents")
def s05(spark, sf):
    a, path = articles(spark, sf), fresh(spark)
    io.dataset_profile(a, "text", "category").write.json(path)
    meta = spark.read.schema("total_articles BIGINT, categories MAP<STRING, BIGINT>").json(path)
    return io.verify_dataset(a, meta, "category", 500).withColumns({c: F.col(c).cast("int") for c in ("same_rows", "ready")})


@query("S06_dataset_profile", f"""SELECT count(*) AS total_articles, round(avg(len({words_sql('text')})), 6) AS mean_words, quantile_cont(len({words_sql('text')}), 0.5) AS median_words, min(len({words_sql('text')})) AS min_words, max(len({words_sql('text')})) AS max_words,
  round(avg(len(regexp_extract_all(text, '[.!?]+')) + 1), 6) AS mean_sentences, round(avg(length(text)), 6) AS average_article_length FROM documents""")
def s06(spark, sf):
    return rounded(io.dataset_profile(articles(spark, sf), "text", "category").drop("categories"))


@query("S07_read_results", "SELECT doc_id, lang FROM documents")
def s07(spark, sf):
    path = fresh(spark)
    d = table(spark, sf, "documents").select("doc_id", "lang")
    d.groupBy(F.floor(F.col("doc_id") / 100).alias("part")).agg(F.collect_list(F.struct("doc_id", "lang")).alias("results")).select("results").write.json(path)
    return io.read_results(spark, path, "doc_id: BIGINT, lang: STRING", multi_line=False)


@query("S08_S09_export_bundle", "SELECT 'documents' AS name, 'json' AS format, count(*) AS records, 3 AS columns FROM documents UNION ALL SELECT 'labels', 'json', count(*), 3 FROM labels")
def s09(spark, sf):
    return io.export_bundle({"documents": table(spark, sf, "documents").select("doc_id", "lang", "source"), "labels": table(spark, sf, "labels")}, fresh(spark), "json")


@query("S08_export_csv_xml", "SELECT 'csv' AS format, count(*) AS records, 2 AS columns FROM embeddings UNION ALL SELECT 'xml', count(*), 2 FROM labels")
def s08(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return io.export_table(e, fresh(spark), "csv").unionByName(io.export_table(table(spark, sf, "labels").select("doc_id", "quality"), fresh(spark), "xml"))


@query("S10_save_and_load_model")
def s10(spark, sf):
    from broadsheet.operators.lang import language_model
    d, path = table(spark, sf, "documents").select("doc_id", "text", "lang"), fresh(spark)
    io.save_model(language_model(d, "text", "lang", 1 << 10), path)
    return io.load_model(path).transform(d).select("doc_id", "lang", "prediction")
