"""Catalogue queries against their SQL on the smallest tables, and plan checks."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["coverage_by_language", "P04_dedup_exact", "P08_prepare_steps", "F13_preprocess_text", "J08_T05_sliding_windows", "W05_moving_average", "ST02_linear_trend_by_type",
         "ST10_chi2_features", "V05_check_duplicates", "V06_check_distribution", "X10_tfidf", "N01_N02_lexicon_sentiment", "C07_classification_report", "L12_compare_languages",
         "I02_similar_items", "I04_similar_pairs", "E05_rule_relations", "E12_pagerank", "Y02_summarize", "R05_sentiment_spikes", "R06_trending", "Z01_classify_intent"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = check.rows_of(entry.queries()[name](spark, SF).toPandas())
    assert got == check.rows_of(duck.execute(entry.oracle_sql()[name]).df())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 200


@pytest.mark.parametrize("name", ["coverage_by_language", "N05_N07_analyze_sentiment", "F13_preprocess_text", "B07_detect_bias", "L01_detect_language", "Y02_summarize", "X10_tfidf"])
def test_no_python_rows_and_no_cartesian(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "CartesianProduct" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(entry.queries()["coverage_by_language"](spark, SF))
    assert "n_chars" not in text and "source" not in text


def test_shuffle_free_scoring(spark):
    from broadsheet.functions.text import word_tokens
    from broadsheet.operators.sentiment import lexicon_sentiment
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", word_tokens("text").alias("tokens"))
    assert "Exchange" not in plan(lexicon_sentiment(d, "tokens"))


def test_classifiers_carry_features_but_no_tokens(spark, tmp_path):
    from broadsheet.catalog import models
    texts = ["the cat sat on the mat", "a dog and the cat", "", "the mat", "le chat est la", "la vie est belle", "le chien et la vie", "le chat"]
    rows = [(i % 30 if i % 17 else None, t, "en" if i % 8 < 4 else "fr", "s", 1) for i, t in enumerate(texts * 5)]  # keys repeat and are null
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    data, tfidf, _, split = models.prepared(spark, str(tmp_path))
    assert data.columns == ["doc_id", "lang", "split", "features"] and "tokens" not in split.columns
    assert data.count() == len(rows) and data.where("split = 'train'").count() == 32
    terms = models.tokenized(split)
    assert sorted(map(str, terms.select("doc_id", "tokens").collect())) == sorted(map(str, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").select("doc_id", models.tx.word_tokens("text").alias("tokens")).collect()))
