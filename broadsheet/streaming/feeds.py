"""Live feeds: file intake, enrichment, alerts and totals as Structured Streaming queries."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.operators.lang import detect_language
from broadsheet.operators.lexicon import breaking_score, keyword_category
from broadsheet.operators.sentiment import label_compound, lexicon_sentiment

Batch = Callable[[DataFrame, int], None]


def article_stream(spark: SparkSession, folder: str, schema: str | T.StructType, fmt: str = "parquet", max_files: int = 1000, pattern: str | None = None) -> DataFrame:
    """Files dropped into a folder; intake per trigger is bounded and progress is kept by the query's checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def event_time(df: DataFrame, ts_col: str, delay: str = "10 minutes") -> DataFrame:
    """Cast to a zoned timestamp and set the watermark."""
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)


def enrich_stream(df: DataFrame, text_col: str, profiles: Mapping[str, Sequence[str]] | None = None, lexicon: Mapping[str, float] = wl.VALENCE,
                  negations: Sequence[str] = wl.NEGATIONS) -> DataFrame:
    """Language, category, sentiment and status per article: the batch expressions, so stream and batch agree."""
    out = detect_language(keyword_category(df, text_col), text_col, profiles)
    out = lexicon_sentiment(out.withColumn("_tokens", tx.word_tokens(text_col)), "_tokens", lexicon, negations).drop("_tokens", "language_scores")
    ok = F.col(text_col).rlike(r"\S")
    return out.withColumns({"sentiment": label_compound(F.col("compound")), "status": F.when(F.coalesce(ok, F.lit(False)), "ok").otherwise("error"),
                            "processed_time": F.current_timestamp()})


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("status = 'ok'"), df.where("status <> 'ok'")


def breaking_alerts(df: DataFrame, title_col: str, body_col: str, words: Sequence[str] = wl.BREAKING, needed: int = 2) -> DataFrame:
    return breaking_score(df, title_col, body_col, words, needed).where("is_breaking")


def dedup_stream(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First row per key within the watermark."""
    return df.dropDuplicatesWithinWatermark(list(keys))


def event_rates(df: DataFrame, ts_col: str, by: Sequence[str], width: str = "1 minute") -> DataFrame:
    return df.groupBy(F.window(ts_col, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def trending(df: DataFrame, ts_col: str, category_col: str, width: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Rows per category in sliding windows; trending_share turns a batch of them into shares."""
    return df.groupBy(F.window(ts_col, width, slide).alias("w"), category_col).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), category_col, "n")


def trending_share(counts: DataFrame, category_col: str, share: float = 0.5, min_rows: int = 5, min_total: int = 20) -> DataFrame:
    totals = counts.groupBy("window_start").agg(F.sum("n").alias("total"))
    out = counts.join(totals, "window_start").withColumn("share", F.col("n") / F.col("total"))
    return out.where((F.col("total") >= min_total) & (F.col("n") >= min_rows) & (F.col("share") > share)).select("window_start", category_col, "n", "total", "share")


def stream_stats(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Running totals by status, language, category or sentiment."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("processed"))


def running_totals(df: DataFrame, by: Mapping[str, Column | str], failed: Column) -> DataFrame:
    """measure, value, n: rows processed and failed, and the good rows by each of the named columns, in one aggregate."""
    ok = [F.struct(F.lit(name).alias("measure"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("value")) for name, c in by.items()]
    status = F.when(failed, F.lit("errors")).otherwise(F.lit("processed"))
    total = F.struct(status.alias("measure"), F.lit(None).cast("string").alias("value"))
    each = F.when(failed, F.array(total)).otherwise(F.array(total, *ok))
    return df.select(F.explode(each).alias("m")).groupBy("m.measure", "m.value").agg(F.count(F.lit(1)).alias("n"))


class Hooks:
    """Callbacks by event type, run on every micro-batch."""

    def __init__(self) -> None:
        self.sinks: dict[str, list[Batch]] = defaultdict(list)

    def register_sink(self, event: str, fn: Batch) -> None:
        self.sinks[event].append(fn)

    def run(self, tables: Mapping[str, Callable[[DataFrame], DataFrame]]) -> Batch:
        """foreachBatch function: derive each event table from the batch and hand it to its callbacks."""
        def each(batch: DataFrame, epoch: int) -> None:
            batch.persist()
            try:
                for event, derive in tables.items():
                    for fn in self.sinks[event]:
                        fn(derive(batch), epoch)
            finally:
                batch.unpersist()
        return each


def epoch_sink(path: str, fmt: str = "parquet") -> Batch:
    """A callback that keeps each batch in a folder of its epoch: a batch that is run again replaces what it wrote before."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/epoch={epoch}")
    return write


def on_new(df: DataFrame, fn: Batch, checkpoint: str):
    """Run fn on every batch of new articles that is waiting."""
    return df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def export_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", mode: str = "append"):
    """Write waiting rows to files; the checkpoint makes each row land exactly once."""
    return df.writeStream.format(fmt).outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def export_totals(df: DataFrame, path: str, checkpoint: str):
    """Keep the totals of an aggregating stream: each batch writes them whole in a folder of its epoch, and the last two are kept, so
    that a reader of `latest_totals` never meets a table that is being replaced."""
    store = epoch_sink(path)

    def replace(batch: DataFrame, epoch: int) -> None:
        store(batch, epoch)
        jvm = batch.sparkSession._jvm
        old = jvm.org.apache.hadoop.fs.Path(f"{path}/epoch={epoch - 2}")
        old.getFileSystem(batch.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(old, True)

    return df.writeStream.foreachBatch(replace).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    """The totals after the last batch that was written whole."""
    found = spark.read.parquet(path)
    last = found.agg(F.max("epoch")).first()[0]
    return found.where(F.col("epoch") == last).drop("epoch")


def recent_articles(spark: SparkSession, path: str, ts_col: str, id_col: str, n: int = 100) -> DataFrame:
    from broadsheet.operators.relational import most_recent
    return most_recent(spark.read.parquet(path), ts_col, n, id_col)
