"""Reading articles, feeds, results and models; writing tables and bundles."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from broadsheet.functions import text as tx
from broadsheet.plans.sized import with_scalars

ARTICLE_SCHEMA = "doc_id BIGINT, text STRING, category STRING, date STRING, title STRING, source STRING"


def read_articles(spark: SparkSession, path: str, fmt: str = "csv", schema: str | T.StructType = ARTICLE_SCHEMA) -> DataFrame:
    """Article table under a declared schema; the schema is never inferred."""
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    if fmt == "parquet" and schema is ARTICLE_SCHEMA:
        return reader.parquet(path)
    return reader.schema(schema).format(fmt).load(path)


SEPARATORS = (r"\n\s*\n", r"\n\d{1,2}:\d{2}\s*\n", r"\nFrom [^\n]*\n")


def split_bulk_articles(df: DataFrame, id_col: str, text_col: str, separators: Sequence[str] = SEPARATORS, min_chars: int = 80,
                        must_contain: str | None = None) -> DataFrame:
    """Pieces of pasted text: the first separator that occurs cuts it; pieces longer than min_chars are kept."""
    t = F.col(text_col)
    pieces = F.array(t)
    for sep in reversed(separators):
        pieces = F.when(t.rlike(sep), F.split(t, sep)).otherwise(pieces)
    out = df.select(id_col, F.posexplode(pieces).alias("pos", "text")).withColumn("text", tx.strip("text")).where(F.length("text") > min_chars)
    return out.where(F.contains(F.col("text"), F.lit(must_contain))) if must_contain else out


def html_to_text(c: str | Column) -> Column:
    """Scripts, styles, comments and tags out, the five basic entities and blanks back, spaces collapsed."""
    out = F.regexp_replace(tx.col(c), r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return tx.collapse_ws(out)


FEED_SCHEMA = ("channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING, description: STRING, summary: STRING, content: STRING, "
               "pubDate: STRING, updated: STRING>>>")


def parse_feed_items(df: DataFrame, xml_col: str, now: Column | None = None, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Article rows of RSS documents, and the rows that could not be parsed."""
    parsed = df.withColumn("_f", F.from_xml(F.col(xml_col), FEED_SCHEMA, {"mode": "PERMISSIVE"}))
    items = F.coalesce(F.col("_f.channel.item"), F.array().cast("array<struct<title:string,link:string,description:string,summary:string,content:string,pubDate:string,updated:string>>"))
    bad = parsed.where(F.col("_f.channel").isNull()).drop("_f")
    rows = parsed.where(F.col("_f.channel").isNotNull()).select(*keep, F.inline(items))
    blank = lambda c: F.when(F.col(c).rlike(r"\S"), F.col(c))
    content = html_to_text(F.coalesce(blank("summary"), blank("description"), blank("content"), F.lit("")))
    out = rows.withColumn("content", content).where(blank("title").isNotNull() & (F.length("content") > 20))
    return out.select(*keep, tx.strip("title").alias("title"), tx.preview("content", 500).alias("content"), "link",
                      F.coalesce("pubDate", "updated", (now if now is not None else F.current_timestamp()).cast("string")).alias("timestamp")), bad


def dataset_profile(df: DataFrame, text_col: str, category_col: str) -> DataFrame:
    """One row: rows, word statistics, mean sentences, and the counts per category as a map (a closed set of categories)."""
    c = tx.text_counts(text_col)
    base = df.agg(F.count(F.lit(1)).alias("total_articles"), F.avg(c["words"]).alias("mean_words"), F.percentile(c["words"], 0.5).alias("median_words"),
                  F.min(c["words"]).alias("min_words"), F.max(c["words"]).alias("max_words"), F.avg(c["sentences"]).alias("mean_sentences"),
                  F.avg(c["chars"]).alias("average_article_length"))
    counts = df.groupBy(category_col).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.collect_list(F.struct(category_col, "n"))).alias("categories"))
    return with_scalars(base, counts)


def verify_dataset(df: DataFrame, meta: DataFrame, category_col: str, min_rows: int = 1000) -> DataFrame:
    """Compare a table with its metadata row: counts, category set, ready flag."""
    actual = df.groupBy(category_col).agg(F.count(F.lit(1)).alias("n"))
    said = meta.select(F.explode("categories").alias(category_col, "said"))
    diff = actual.join(said, category_col, "full").agg(F.sum(F.coalesce("n", F.lit(0))).alias("rows"), F.count_if(F.col("n").isNull()).alias("missing_categories"),
                                                       F.count_if(F.col("said").isNull()).alias("extra_categories"), F.count_if(F.col("n") != F.col("said")).alias("different_counts"))
    return with_scalars(diff, meta.select("total_articles")).withColumns({"same_rows": F.col("rows") == F.col("total_articles"), "ready": F.col("rows") > min_rows})


def read_results(spark: SparkSession, path: str, item_schema: str, multi_line: bool = True) -> DataFrame:
    """Rows of the `results` array of JSON result files: one document per file, or one per line."""
    return spark.read.schema(f"results ARRAY<STRUCT<{item_schema}>>").option("multiLine", multi_line).json(path).select(F.inline("results"))


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[re.sub(r"[^a-zA-Z0-9_]", "_", c) for c in df.columns])


def export_table(df: DataFrame, path: str, fmt: str = "json") -> DataFrame:
    """Write as json, csv, xml or parquet; nested columns become JSON text for csv. Returns format, records, columns."""
    out = clean_names(df)
    if fmt == "csv":
        nested = (T.StructType, T.ArrayType, T.MapType)
        out = out.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in out.schema.fields])
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "xml":
        writer.option("rootTag", "rows").option("rowTag", "row").xml(path)
    elif fmt in ("json", "parquet"):
        writer.format(fmt).save(path)
    else:
        raise ValueError("fmt is json, csv, xml or parquet")
    spark = df.sparkSession
    back = spark.read.format(fmt).option("header", True) if fmt == "csv" else spark.read.format(fmt)
    if fmt == "xml":
        back = back.option("rowTag", "row")
    written = back.schema(out.schema if fmt != "csv" else T.StructType([T.StructField(f.name, T.StringType()) for f in out.schema.fields])).load(path)
    return written.agg(F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("records"), F.lit(len(out.columns)).alias("columns"))


def export_bundle(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet") -> DataFrame:
    """One folder per table and a manifest (name, format, records, columns)."""
    manifest = None
    for name, df in tables.items():
        row = export_table(df, f"{base}/{name}", fmt).withColumn("name", F.lit(name))
        manifest = row if manifest is None else manifest.unionByName(row)
    manifest.write.mode("overwrite").json(f"{base}/manifest")
    return manifest


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
