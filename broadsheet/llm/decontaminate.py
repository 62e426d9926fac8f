"""Benchmark passages in documents: a prefix-filtered set join of rare shingles, confirmed word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from broadsheet.llm.common import spread, stored
from broadsheet.llm.minhash import parts
from broadsheet.llm.shingles import mix, seeds, words_in_place
from broadsheet.plans.sized import attach

#: Words of an item that must occur in a row.
WINDOW = 10
#: Words of a shingle; a window of fewer words is one shingle.
SHINGLE = 3
#: What stands between words, as a regular expression and as a flag per byte.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = np.array([b < 0x30 or 0x3A <= b <= 0x60 and not 0x41 <= b <= 0x5A or 0x7B <= b <= 0x7F for b in range(256)])
#: Bits of the filter for each shingle that is looked for, and its largest size as a power of two (32 MB).
BITS_EACH, MOST_BITS = 64, 28
#: Candidates in one batch of the output.
BATCH = 1 << 14

FOUND = "row long, doc_id {}, n_words long, at int, hash long, ahead int, context string"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, GAPS), lambda w: w != "")


def windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """item_id, window (its words, a space between): every run of `window` words of each item, or all its words if they are fewer."""
    words = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    first = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return words.select("item_id", F.explode(F.transform(first, lambda i: F.array_join(F.slice("words", i, F.lit(window)), " "))).alias("window")).distinct()


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each place on."""
    keys, n = seeds(size + 1, 31 + size), max(0, len(words) - size + 1)
    out = np.full(n, keys[size], dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mix(out + words[k:k + n] * keys[k])
    return out


def shingles_of(words: tuple, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and text of every run of `size` words that lies in one text; `words` is what `words_in_place` gives."""
    hashes, at = words[:2]
    runs = run_hashes(hashes, size)
    text = np.searchsorted(at, np.arange(len(runs)), "right") - 1
    inside = np.flatnonzero(np.arange(len(runs)) + size <= at[text + 1])
    return inside, runs[inside], text[inside]


def window_shingles(distinct: DataFrame) -> DataFrame:
    """window, size (its words), offset, hash: the shingles of each window and where in it they stand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                words = words_in_place(part.column("window"), GAP)
                length = np.minimum(part.column("size").to_numpy(), SHINGLE)
                for size in np.unique(length):
                    place, hashes, text = shingles_of(words, int(size))
                    own = length[text] == size
                    of = pa.array(text[own])
                    yield pa.RecordBatch.from_arrays([part.column("window").take(of), part.column("size").take(of), pa.array((place - words[1][text])[own].astype(np.int32)), pa.array(hashes[own].view(np.int64))],
                                                     names=["window", "size", "offset", "hash"])

    return distinct.mapInArrow(run, "window string, size int, offset int, hash long")


class Filter:
    """A bit table of hashes, of bounded size: what it rejects is not among them, what it lets pass mostly is. Joins decide."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    @classmethod
    def of(cls, hashes: DataFrame) -> Filter:
        """Of the column hash; the bits of one word of the table are gathered by Spark, at most 2**MOST_BITS / 64 words come back."""
        n = hashes.count()
        bits = min(MOST_BITS, max(16, int(n * BITS_EACH).bit_length()))
        slots = hashes.select(F.explode(F.array(F.shiftrightunsigned("hash", 64 - bits), F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)))).alias("slot"))
        found = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("set")).toPandas()
        table = np.zeros(1 << bits - 6, dtype=np.uint64)
        table[found["word"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64).view(np.uint64)
        return cls(table, bits)

    def _set(self, slot: np.ndarray) -> np.ndarray:
        return (self.table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    def passing(self, hashes: np.ndarray) -> np.ndarray:
        """Where the hashes pass."""
        at = np.flatnonzero(self._set(hashes >> np.uint64(64 - self.bits)))
        return at[self._set(hashes[at] & np.uint64((1 << self.bits) - 1))]


def shingle_counts(docs: DataFrame, wanted: Broadcast, sizes: list[int]) -> DataFrame:
    """hash, n: how often each wanted shingle occurs in all documents (and some that are not wanted)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                words = words_in_place(part.column("text"), GAP)
                for size in sizes:
                    hashes = shingles_of(words, size)[1]
                    h, n = np.unique(hashes[wanted.value.passing(hashes)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["hash", "n"])

    return docs.select("text").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def rarest(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """window, size, offset, hash: of each window whose shingles all occur, the one that occurs least.

    A window lies whole in a text only if all its shingles do, so the necessary prefix of their order by rarity is one shingle.
    """
    known = shingles.join(counts, "hash", "left")
    least = known.groupBy("window", "size").agg(F.min(F.struct("n", "hash", "offset")).alias("least"), F.count_if(F.col("n").isNull()).alias("missing"))
    return least.where("missing = 0").select("window", "size", F.col("least.hash").alias("hash"), F.col("least.offset").alias("offset"))


def candidates(docs: DataFrame, wanted: Broadcast, sizes: list[int], window: int) -> DataFrame:
    """Two kinds of rows: row, doc_id, n_words of every document; and row, at, hash, ahead, context for every place of a wanted shingle, with
    the words around it that a window may take in, `ahead` of them before it."""
    schema = T._parse_datatype_string(FOUND.format(docs.schema["doc_id"].dataType.simpleString()))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                ids, own = part.column("row"), part.column("doc_id")
                words = words_in_place(part.column("text"), GAP)
                _, at, start, stop, data, _ = words
                for size in sizes:
                    place, hashes, text = shingles_of(words, size)
                    hit = wanted.value.passing(hashes)
                    for i in range(0, len(hit), BATCH):
                        some = hit[i:i + BATCH]
                        p, t = place[some], text[some]
                        first, last = np.maximum(at[t], p - (window - size)), np.minimum(at[t + 1], p + window)
                        context = [b" ".join(data[a:b].tobytes() for a, b in zip(start[x:y].tolist(), stop[x:y].tolist())).lower().decode() for x, y in zip(first.tolist(), last.tolist())]
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(t)), pa.nulls(len(t), own.type), pa.nulls(len(t), pa.int64()), pa.array((p - at[t]).astype(np.int32)), pa.array(hashes[some].view(np.int64)),
                                                          pa.array((p - first).astype(np.int32)), pa.array(context, pa.string())], names=names)
                n = len(part)
                yield pa.RecordBatch.from_arrays([ids, own, pa.array(np.diff(at).astype(np.int64)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], names=names)

    return docs.mapInArrow(run, schema)


def confirmed(found: DataFrame, prefix: DataFrame) -> DataFrame:
    """row, start, size, window: every window of an item that lies in a document, its words compared in full.

    A candidate meets the places (offset, size) that its shingle has in windows; one that would begin before the document or
    end after it is out. The words that are left at that place are then looked up among the windows.
    """
    places = stored(prefix.select("hash", "offset", "size").distinct(), "places")
    words = F.split("context", " ")
    inside = (F.col("offset") <= F.col("ahead")) & (F.col("ahead") - F.col("offset") + F.col("size") <= F.size(words))
    window = F.when(inside, F.array_join(F.slice(words, F.col("ahead") - F.col("offset") + 1, F.col("size")), " "))  # guarded: filters may be moved below it
    there = attach(found.where("at IS NOT NULL").select("row", "at", "hash", "ahead", "context"), places, ["hash"], ["row", "at"]).where(inside).select(
        "row", (F.col("at") - F.col("offset")).alias("start"), "size", "hash", "offset", window.alias("window"))
    return attach(there, prefix.select("window", "hash", "offset"), ["window", "hash", "offset"], ["row", "start"], "left_semi").select("row", "start", "size", "window")


def covered(hits: DataFrame) -> DataFrame:
    """row, n_hit, spans: the words inside any hit, each once, and the runs of them (start, end: words from 0, end exclusive)."""
    by_start = Window.partitionBy("row").orderBy("start")  # the hits of one text
    ends = hits.groupBy("row", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    apart = F.col("start") > F.coalesce(F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    runs = ends.withColumn("apart", apart).withColumn("run", F.count_if("apart").over(by_start)).groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("row").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def item_lists(hits: DataFrame, named: DataFrame) -> DataFrame:
    """row, n_items, items: identifiers of the items with a window in the text, sorted as strings."""
    pairs = attach(hits.select("row", "window").distinct(), named, ["window"], ["row"]).select("row", F.col("item_id").cast("string").alias("item_id")).where("item_id IS NOT NULL").distinct()
    return pairs.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("items"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, spans, n_items, items of every row of `docs`: which of its words lie in a window of an item, and of which items.

    Shingles of the items are counted over all documents; each window is looked for by the shingle that occurs least, its
    necessary prefix. Documents are read twice and never shuffled: a bit table of bounded size lets through the
    places of such shingles, with the few words around them; length and position are checked and the words compared
    in full. Hot shingles and windows are spread over sub-keys, or their windows broadcast where they were counted few.

    A null or empty text has no words and no hits; a null or empty item has no window; rows that repeat are judged
    each for itself; equal items are found each; an item without an identifier counts for n_hit, but is neither counted
    nor named. Without items nothing is hit; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    named = stored(windows(items, item_col, item_text_col, window), "item-windows")
    shingles = stored(window_shingles(named.select("window").distinct().withColumn("size", F.size(F.split("window", " ")))), "item-shingles")
    sizes = sorted(r[0] for r in shingles.select(F.least("size", F.lit(SHINGLE)).alias("size")).distinct().collect())
    texts = spread(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "doc_id")
    wanted = spark.sparkContext.broadcast(Filter.of(shingles.select("hash").distinct()))
    prefix = stored(rarest(shingles, shingle_counts(texts, wanted, sizes)), "prefixes")
    first = spark.sparkContext.broadcast(Filter.of(prefix.select("hash").distinct()))
    found = stored(candidates(texts.withColumn("row", F.monotonically_increasing_id()), first, sizes, window), "candidates")
    hits = stored(confirmed(found, prefix), "hits")
    verdict = covered(hits).join(item_lists(hits, named), "row", "left")
    rows = found.where("at IS NULL").select("row", "doc_id", "n_words").join(verdict, "row", "left")
    zero = F.lit(0).cast("long")
    return rows.select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
                       F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
