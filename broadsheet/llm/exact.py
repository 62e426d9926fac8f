"""Exact deduplication by content sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from broadsheet.llm.common import shuffle_partitions, squeezed, stored, text_of

#: Code points of the normalised text that the splitters compare. It bounds what range partitioning samples to the driver.
SPLITTER_CHARS = 32


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", splitter_chars: int = SPLITTER_CHARS) -> DataFrame:
    """Groups of texts that are equal without white space: one row per row of `docs`.

    Sampled splitters range-partition the rows by the first characters of the normalised text; the sort inside
    the partitions (external, it spills) then places equal texts side by side, and neighbours are compared in
    full. Every text is cut into slices by a hash of the identifier, as many as there are shuffle partitions,
    so that a text which makes up a third of all rows is sorted by many tasks. What a slice found is one row
    without text; rows of one text meet by digest in a second, small step.

    Columns: doc_id, keep_id, group_size, kept, text_sha256, n_chars (code points of the original).
    The row with most code points, then the smallest identifier, stays. A null text counts as empty, empty texts
    are equal to each other, null identifiers come last. Of rows that repeat identifier and text one is kept.
    An empty table gives no rows; other columns of `docs` are ignored, whatever their names.
    """
    slices = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select(
        "id", F.char_length("text").alias("size"), squeezed(F.col("text")).alias("body"),
        F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice"))
    placed = rows.withColumn("head", F.substring("body", 1, splitter_chars)).repartitionByRange("head", "slice")
    # the range partitioning already brings equal (head, slice) together: no further exchange
    order = Window.partitionBy("head", "slice", "body").orderBy(F.desc("size"), F.asc_nulls_last("id"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = stored(placed.select(
        "id", "size", "slice", F.sha2("body", 256).alias("digest"), F.row_number().over(order).alias("at"),
        F.count(F.lit(1)).over(whole).alias("n"), F.first("id").over(whole).alias("best_id"),
        F.first("size").over(whole).alias("best_size")), "exact")
    best = Window.partitionBy("digest").orderBy(F.desc("best_size"), F.asc_nulls_last("best_id")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    groups = found.where("at = 1").select(  # at most one row per text and slice
        "digest", "slice", F.first("best_id").over(best).alias("keep_id"), F.sum("n").over(best).alias("group_size"))
    return found.join(groups, ["digest", "slice"]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", ((F.col("at") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("digest").alias("text_sha256"), F.col("size").cast("long").alias("n_chars"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of `docs` that stay, with all their columns. Of rows that repeat identifier, text and length one stays."""
    def key(who, digest, size):
        return F.concat_ws(":", F.coalesce(who.cast("string"), F.lit("null")), size.cast("string"), digest)

    kept = exact_groups(docs, id_col, text_col).where("kept").select(key(F.col("doc_id"), F.col("text_sha256"), F.col("n_chars")).alias("key"))
    text = text_of(text_col)
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                        key(F.col(id_col), F.sha2(squeezed(text), 256), F.char_length(text)).alias("key"))
    return keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
