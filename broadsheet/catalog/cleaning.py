"""Cleaning rows P01-P12 on documents."""

from pyspark.sql import functions as F

from broadsheet.catalog.tables import articles, table, words_sql
from broadsheet.operators import clean as c
from broadsheet.registry import query

FIRST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY doc_id) = 1"
STRIP = "regexp_replace(text, '^\\s+|\\s+$', '', 'g')"


@query("P01_drop_missing", """
SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def p01(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return c.drop_missing(joined, ["quality", "toxic"]).select("doc_id", "quality", "toxic")


@query("P02_filter_length", "SELECT doc_id, length(text) AS n FROM documents WHERE length(text) BETWEEN 50 AND 10000")
def p02(spark, sf):
    return c.filter_length(articles(spark, sf), "text").select("doc_id", F.length("text").alias("n"))


@query("P03_filter_alpha_ratio", """
SELECT doc_id FROM documents WHERE length(text) > 0
  AND length(regexp_replace(text, '[^\\p{L}\\s]', '', 'g'))::DOUBLE / length(text) >= 0.7""")
def p03(spark, sf):
    return c.filter_alpha_ratio(articles(spark, sf), "text").select("doc_id")


@query("P04_dedup_exact", "SELECT doc_id, text FROM documents " + FIRST.format(key="text"))
def p04(spark, sf):
    return c.dedup_exact(articles(spark, sf), "text", "doc_id").select("doc_id", "text")


@query("P05_dedup_prefix", "SELECT doc_id FROM documents " + FIRST.format(key="substring(text, 1, 100)"))
def p05(spark, sf):
    return c.dedup_prefix(articles(spark, sf), "text", "doc_id").select("doc_id")


@query("P06_normalize_category", "SELECT doc_id, lower(trim(category)) AS category FROM (SELECT doc_id, '  ' || upper(source) || ' ' AS category FROM documents)")
def p06(spark, sf):
    noisy = articles(spark, sf).select("doc_id", F.concat(F.lit("  "), F.upper("category"), F.lit(" ")).alias("category"))
    return c.normalize_category(noisy, "category")


@query("P07_flag_low_quality", """
SELECT doc_id, CAST(length(text) > 0 AND (d > length(text) * 0.5::DOUBLE OR l < length(text) * 0.3::DOUBLE) AS INTEGER) AS low_quality
FROM (SELECT doc_id, text, len(regexp_extract_all(text, '\\p{Nd}')) AS d, len(regexp_extract_all(text, '\\p{L}')) AS l FROM documents)""")
def p07(spark, sf):
    return c.flag_low_quality(articles(spark, sf), "text").select("doc_id", F.col("low_quality").cast("int"))


PREPARED = f"""
WITH d AS (SELECT doc_id, text, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents),
s1 AS (SELECT * FROM d WHERE rn = 1), s2 AS (SELECT * FROM s1 WHERE text IS NOT NULL AND source IS NOT NULL),
t AS (SELECT doc_id, {STRIP} AS text, lower(trim(source)) AS category FROM s2),
s3 AS (SELECT * FROM t WHERE length(text) BETWEEN 50 AND 10000),
s4 AS (SELECT * FROM s3 WHERE length(regexp_replace(text, '[^\\p{{L}}\\s]', '', 'g'))::DOUBLE / length(text) >= 0.7),
f AS (SELECT category FROM s4 GROUP BY 1 HAVING count(*) >= 5), s5 AS (SELECT * FROM s4 WHERE category IN (SELECT category FROM f))
"""


@query("P08_prepare_dataset", PREPARED + f"""
SELECT doc_id AS article_id, category, len({words_sql('text')}) AS word_count, length(text) AS char_count,
  len(regexp_extract_all(text, '[.!?]+')) + 1 AS sentence_count FROM s5""")
def p08(spark, sf):
    return c.prepare_dataset(articles(spark, sf), min_rows=5)[0].drop("text")


@query("P08_prepare_steps", PREPARED + """
SELECT 'input' AS step, count(*) AS rows FROM documents UNION ALL SELECT 'deduplicated', count(*) FROM s1
UNION ALL SELECT 'not_null', count(*) FROM s2 UNION ALL SELECT 'length', count(*) FROM s3
UNION ALL SELECT 'letters', count(*) FROM s4 UNION ALL SELECT 'frequent_categories', count(*) FROM s5""")
def p08_steps(spark, sf):
    return c.prepare_dataset(articles(spark, sf), min_rows=5)[1]


FIXED = """
WITH s1 AS (SELECT doc_id, text, source FROM documents WHERE text IS NOT NULL AND source IS NOT NULL),
s2 AS (SELECT * FROM s1 QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
s3 AS (SELECT * FROM s2 WHERE length(text) BETWEEN 50 AND 50000),
s4 AS (SELECT doc_id, lower(trim(source)) AS category FROM s3 WHERE source IN (SELECT source FROM s3 GROUP BY 1 HAVING count(*) >= 10))
"""


@query("P09_fix_common_issues", FIXED + "SELECT doc_id, category FROM s4")
def p09(spark, sf):
    return c.fix_common_issues(articles(spark, sf))[0].select("doc_id", "category")


@query("P09_fixes_applied", FIXED + """
, n AS (SELECT 0 AS step, 'input' AS fix, count(*) AS rows FROM documents UNION ALL SELECT 1, 'missing_values', count(*) FROM s1
UNION ALL SELECT 2, 'duplicates', count(*) FROM s2 UNION ALL SELECT 3, 'length', count(*) FROM s3
UNION ALL SELECT 4, 'rare_categories', count(*) FROM s4)
SELECT *, coalesce(lag(rows) OVER (ORDER BY step) - rows, 0) AS removed FROM n""")
def p09_fixes(spark, sf):
    return c.fix_common_issues(articles(spark, sf))[1]


@query("P10_apply_filters", "SELECT doc_id, lang, source FROM documents WHERE lang = 'fr' AND source IN ('src1', 'src4', 'src8')")
def p10(spark, sf):
    return c.apply_filters(table(spark, sf, "documents"), {"lang": "fr", "source": ["src1", "src4", "src8"]}).select("doc_id", "lang", "source")


@query("P11_filter_min_words", f"SELECT doc_id FROM documents WHERE len({words_sql('text')}) >= 5")
def p11(spark, sf):
    return c.filter_min_words(articles(spark, sf), "text").select("doc_id")


@query("P12_flatten_struct", """SELECT doc_id, lang AS analysis_language, n_chars AS analysis_size_chars,
  length(source) AS analysis_size_source FROM documents""")
def p12(spark, sf):
    d = table(spark, sf, "documents")
    nested = d.select("doc_id", F.struct(F.col("lang").alias("language"), F.struct(
        F.col("n_chars").alias("chars"), F.length("source").alias("source")).alias("size")).alias("analysis"))
    return c.flatten_struct(nested)
