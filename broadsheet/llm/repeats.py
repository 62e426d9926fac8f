"""Substring deduplication: lines, sentences and passages that occurred before are removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import spread, stored, text_of
from broadsheet.llm.decontaminate import MOST_BITS, Filter
from broadsheet.llm.minhash import parts
from broadsheet.llm.shingles import mix, run_hashes, seeds, words_in_place

#: A unit holds at least so many words. Shorter lines are no units; a shorter sentence takes the next ones with it.
MIN_WORDS = 8

#: Units that need no line or sentence: runs of so many atoms, of which the one with the smallest hash among so many neighbours
#: is taken. Passages of RUN + NEAR - 1 atoms that are equal have a unit in common, and their units leave no gap between them.
RUN, NEAR = 12, 12

#: Bits of the filter for each digest that occurs twice.
BITS_EACH = 16

#: Bytes of text cut into units at once.
PART = 1 << 21

_ENDS = np.frombuffer(b".!?", np.uint8)


def atoms(h: np.ndarray, start: np.ndarray, stop: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and stop of the words, cut at each code point of a script that sets no spaces (Thai to Tibetan, Burmese, Khmer, Han, Kana)."""
    second = np.append(data[1:], 0)
    alone = ((data == 0xE0) & (second >= 0xB8)) | ((data == 0xE1) & ((second <= 0x82) | (second == 0x9E) | (second == 0x9F))) | ((data == 0xE2) & (second >= 0xBA)) \
        | ((data >= 0xE3) & (data <= 0xE9)) | ((data == 0xEF) & (second >= 0xA4)) | ((data == 0xF0) & (second >= 0xA0))
    single = np.flatnonzero(alone)
    if not len(single):
        return h, start, stop
    behind = single + 3 + (data[single] == 0xF0)
    a = np.unique(np.concatenate([start, single, behind]))
    word = np.searchsorted(start, a, "right") - 1
    inside = a < stop[word]
    a, word = a[inside], word[inside]
    b = np.minimum(stop[word], np.append(a[1:], len(data)))
    out = h[word]
    cut = np.flatnonzero((a != start[word]) | (b != stop[word]))
    out[cut] = run_hashes(data, a[cut], b[cut])
    return out, a, b


def passages(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First atoms of the runs of RUN atoms that are taken as units, by winnowing; at: the first atom of each text, and the end."""
    runs = np.maximum(np.diff(at) - RUN + 1, 0)
    n = len(h) - RUN - NEAR + 2
    if n <= 0:
        return np.zeros(0, np.int64)
    key = mix(_sums(h, np.arange(len(h) - RUN + 1), np.arange(RUN, len(h) + 1), 13))
    best = np.arange(n)
    for k in range(1, NEAR):
        best = np.where(key[k:k + n] < key[best], np.arange(k, k + n), best)
    whole = np.zeros(n, bool)  # all runs of the neighbourhood lie in one text
    text = np.repeat(np.arange(len(runs)), np.diff(at))[:n]
    whole[:] = np.arange(n) + NEAR <= at[:-1][text] + runs[text]
    return np.unique(best[whole])


def _sums(h: np.ndarray, a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of the ranges [a, b) of hashes."""
    with np.errstate(over="ignore"):
        base = seeds(1, salt)[0]
        up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(h), base, np.uint64), dtype=np.uint64)])
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(h), inverse, np.uint64), dtype=np.uint64)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(salt)) * up[:len(h)], dtype=np.uint64)])
        return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))


def unit_ranges(texts: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of texts: index of the text, start and end in code points, words, and two 64-bit hashes of the normalised words.

    A line is a unit if it has `least` words. A sentence starts after a mark of its end, on a new line, or at a
    capital letter (a passage may be set in mid-sentence); from each start a unit runs to the first end of a sentence
    that gives it `least` words, so equal passages have equal units wherever they stand. What has neither lines nor
    sentences to go by, or lies around them, is cut by its content alone: `passages` of `atoms`.
    """
    h, at, start, stop, data, text_at = words_in_place(texts)
    none = np.zeros(0, np.int64)
    if not len(h):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    new_text = np.zeros(len(h), bool)
    new_text[at[:-1][np.diff(at) > 0]] = True
    # line breaks before each byte tell whether one lies between two words
    breaks = np.cumsum(data == 10)
    new_line = new_text.copy()
    new_line[1:] |= breaks[start[1:]] > breaks[start[:-1]]
    ended = np.isin(data[stop - 1], _ENDS)
    head = data[start]
    second = data[np.minimum(start + 1, len(data) - 1)]
    capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97))
    begins = new_line | capital
    begins[1:] |= ended[:-1]
    first = np.flatnonzero(begins)
    # ends: one past the last word of a sentence
    ends = np.concatenate([first[1:], [len(h)]])
    reach = np.searchsorted(ends, first + least, "left")
    last = at[1:][text[first]]
    to = np.where(reach < len(ends), ends[np.minimum(reach, len(ends) - 1)], len(h) + 1)
    ok = to <= last
    a, b = first[ok], to[ok]
    line = np.flatnonzero(new_line)
    line_end = np.concatenate([line[1:], [len(h)]])
    long = line_end - line >= least
    pairs = np.unique(np.stack([np.concatenate([a, line[long]]), np.concatenate([b, line_end[long]])]), axis=1)
    a, b = pairs
    piece, piece_start, piece_stop = atoms(h, start, stop, data)
    piece_at = np.searchsorted(piece_start, text_at, "left")
    c = passages(piece, piece_at)
    piece_text = np.searchsorted(piece_at, c, "right") - 1
    out = [np.concatenate([_sums(h, a, b, salt), _sums(piece, c, c + RUN, salt)]) for salt in (11, 12)]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    of, first_byte = np.concatenate([text[a], piece_text]), np.concatenate([start[a], piece_start[c]])
    last_byte, words = np.concatenate([stop[b - 1], piece_stop[c + RUN - 1]]), np.concatenate([b - a, np.full(len(c), RUN)])
    zero = points[text_at[:-1]][of]
    return of, points[first_byte] - zero, points[last_byte] - zero, words, out[0], out[1]


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (of the row), text; a null text counts as empty."""
    rows = spread(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), "doc_id")
    return rows.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")


def unit_counts(texts: DataFrame, least: int) -> DataFrame:
    """hash, n: how often the units with the first half of a digest occur; counted in each batch, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, PART):
                hashes, n = np.unique(unit_ranges(part.column("text"), least)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], names=["hash", "n"])

    return texts.select("text").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def filter_of(hashes: DataFrame) -> Filter:
    """The bit table of the column hash; Spark gathers it in pages of 4 kB, at most 2**MOST_BITS bits come back."""
    bits = min(MOST_BITS, max(16, int(hashes.count() * BITS_EACH).bit_length()))
    slots = hashes.select(F.explode(F.array(F.shiftrightunsigned("hash", 64 - bits), F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)))).alias("slot"))
    pages = slots.groupBy(F.shiftright("slot", 15).alias("page")).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767))).alias("set"))
    table = np.zeros((1 << bits - 15, 4096), dtype=np.uint8)
    for row in pages.collect():
        table[row.page] = np.frombuffer(row.set, np.uint8)
    return Filter(table.reshape(-1).view(np.uint64), bits)


def units(texts: DataFrame, wanted: Broadcast, least: int) -> DataFrame:
    """key, doc_id, start, end, words, hi, lo: the units of all texts that the filter lets pass."""
    schema = T.StructType([texts.schema["key"], texts.schema["doc_id"], *T._parse_datatype_string("start int, end int, words int, hi long, lo long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, PART):
                found = unit_ranges(part.column("text"), least)
                text, start, end, words, hi, lo = (x[wanted.value.passing(found[4])] for x in found)
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([part.column("key").take(at), part.column("doc_id").take(at), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)),
                                                  pa.array(words.astype(np.int32)), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64))], names=schema.names)

    return texts.mapInArrow(run, schema)


def row_key(who, text):
    """Key of a row by identifier and text; rows that repeat both share it."""
    return F.xxhash64(F.coalesce(who.cast("string"), F.lit("null")), text)


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """Units to remove: key, doc_id, start, end, words, first_doc_id, first_start, copies.

    Units with the same normalised words (white space collapsed, A-Z lower-cased) are one group by a 128-bit digest; the
    occurrence with the smallest identifier (nulls last), then the smallest start, stays, the others are listed with their
    offsets in the original text, code points, end exclusive. Where an occurrence overlaps the one that stays, only what is
    beyond it is listed. Texts are cut into units twice: the first time only half of the digest is counted, and a bit
    table of bounded size then lets through what may be repeated; only that is stored, grouped by the whole digest and
    joined back, a join whose hot digests Spark splits. Null and empty texts have no units; rows that repeat identifier and
    text are one row here; an empty table gives no rows; other columns are ignored.
    """
    texts = texts_of(docs, id_col, text_col)
    twice = stored(unit_counts(texts, least).where("n > 1").select("hash"), "unit-hashes")
    wanted = docs.sparkSession.sparkContext.broadcast(filter_of(twice))
    found = stored(units(texts, wanted, least), "units")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "start", "end", "key")
    groups = stored(found.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("first")).where("copies > 1"), "unit-groups")
    same = (F.col("key") == F.col("first.key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    joined = found.join(groups, ["hi", "lo"]).where(~(same & (F.col("start") == F.col("first.start"))))
    start = F.when(same, F.greatest("start", "first.end")).otherwise(F.col("start"))
    return joined.select("key", "doc_id", start.alias("start"), "end", "words", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"), "copies").where("start < end")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """One row per text with repeats: key, doc_id, spans (array of start, end, in order, merged also over a
    single white space), n_units, n_removed (code points), first_doc_ids."""
    removed = repeated_units(docs, id_col, text_col, least)
    by_text = removed.groupBy("key", "doc_id").agg(F.collect_set(F.struct("start", "end")).alias("units"), F.collect_set("first_doc_id").alias("first_doc_ids"))  # bounded by the length of the text
    nothing = F.array().cast("array<struct<start:int,end:int>>")

    def merge(acc, u):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], u["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (u["start"] <= F.get(acc, F.size(acc) - 1)["end"] + 1), joined).otherwise(F.concat(acc, F.array(u)))

    return by_text.select("key", "doc_id", F.aggregate(F.array_sort("units"), nothing, merge).alias("spans"), F.size("units").cast("long").alias("n_units"), F.array_sort("first_doc_ids").alias("first_doc_ids")).select(
        "key", "doc_id", "spans", "n_units", F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]).cast("long").alias("n_removed"), "first_doc_ids")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without its repeats, kept (array of start, end in the original text) of every row of `docs`.

    A text without repeats is kept whole; one that consists of repeats becomes empty; a null text counts as empty.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    spans = repeated_spans(docs, id_col, text_col, least).select(F.col("key").alias("row_key"), F.col("doc_id").alias("row_id"), "spans")
    joined = rows.join(spans, (F.col("key") == F.col("row_key")) & F.col("doc_id").eqNullSafe(F.col("row_id")), "left")
    n = F.char_length("text")
    starts = F.concat(F.array(F.lit(0)), F.coalesce(F.transform("spans", lambda s: s["end"]), F.array().cast("array<int>")))
    ends = F.concat(F.coalesce(F.transform("spans", lambda s: s["start"]), F.array().cast("array<int>")), F.array(n))
    kept = F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end"))), lambda s: s["start"] < s["end"])
    return joined.select("doc_id", "text", kept.alias("kept")).select(
        "doc_id", F.array_join(F.transform("kept", lambda s: F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])), "").alias("text"), "kept")
