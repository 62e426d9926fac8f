"""Product codes of vectors with whole-number codebooks; nearest entries by partial distances of Walsh-Hadamard transforms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import stored
from broadsheet.llm.vectors import LONGEST, integers, saturated, scaled, usable
from broadsheet.plans.sized import attach

#: Differences held at once: rows of a chunk times entries.
CHUNK = 1 << 20


def sequency_order(n: int) -> np.ndarray:
    """Rows of the Sylvester-Hadamard matrix of order n by their number of sign changes."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")


def walsh(m: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, padded with zeros to a power of two, lowest sequency first: sums and differences only.

    Squared distances between transformed rows are those between the rows times the padded width."""
    n = 1
    while n < m.shape[1]:
        n *= 2
    out = np.zeros((len(m), n), dtype=m.dtype)
    out[:, :m.shape[1]] = m
    step = 1
    while step < n:
        x = out.reshape(len(m), n // (2 * step), 2, step)
        out = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(m), n)
        step *= 2
    return out[:, sequency_order(n)]


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the nearest entry, ties to the lower index, and the squared distance; whole numbers throughout.

    The coefficients of lowest sequency are compared with all entries. The full distance to the entry that leads
    then bounds the rest: an entry whose partial sum is beyond it is out, the others go on coefficient by coefficient.
    """
    n = len(rows)
    index, distance = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=rows.dtype)
    x, c = walsh(rows), walsh(book)
    width = x.shape[1]
    lead = max(1, width // 4)
    for start in range(0, n, max(1, CHUNK // len(book))):
        part = x[start:start + max(1, CHUNK // len(book))]
        partial = np.zeros((len(part), len(book)), dtype=x.dtype)
        for k in range(lead):
            d = part[:, k, None] - c[None, :, k]
            partial += d * d
        guess = partial.argmin(axis=1)
        d = part - c[guess]
        bound = (d * d).sum(axis=1)
        row, entry = np.nonzero(partial <= bound[:, None])
        sums = partial[row, entry]
        for k in range(lead, width):
            d = part[row, k] - c[entry, k]
            sums = sums + d * d
            if k % 2 and k + 1 < width:
                on = sums <= bound[row]
                row, entry, sums = row[on], entry[on], sums[on]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
        best = np.minimum.reduceat(sums, first)
        on = np.flatnonzero(sums == best[row])  # each row keeps an entry at least: the one that gave its bound
        _, at = np.unique(row[on], return_index=True)
        index[start:start + len(part)] = entry[on[at]]
        distance[start:start + len(part)] = best // width
    return index, distance


def _width(n: int, parts: int) -> int:
    """Components of a part: the vector is cut evenly, padded with zeros where it does not come out even."""
    return -(-n // parts)


def _pieces(vectors: pa.Array, scale: int, width: int, parts: int, book: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each part position: the rows' parts and its codebook, as numbers wide enough for exact sums."""
    m = scaled(vectors, scale, width * parts)
    peak = max(float(np.abs(m).max(initial=0)), float(np.abs(book).max(initial=0)))
    kind = np.int64 if integers(np.array([[peak * 2]]), 4 * (2 * width) ** 3).dtype == np.int64 else object
    return [(m[:, p * width:(p + 1) * width].astype(np.int64).astype(kind), book[p].astype(kind)) for p in range(parts)]


def start_book(rows: DataFrame, parts: int, entries: int, scale: int, width: int) -> np.ndarray:
    """Parts of the rows with the smallest identifiers: parts x entries x width, fewer entries where there are fewer rows."""
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").toArrow().column("vector")
    return scaled(first, scale, width * parts).astype(np.int64).reshape(-1, parts, width).transpose(1, 0, 2)


def means(rows: DataFrame, book: np.ndarray, scale: int) -> np.ndarray:
    """The codebook after a round: entries become the floored means of the parts that are nearest to them. Tasks sum, Spark adds up."""
    parts, entries, width = book.shape
    share = rows.sparkSession.sparkContext.broadcast(book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            slots, totals, counts = [], [], []
            for p, (x, c) in enumerate(_pieces(batch.column("vector"), scale, width, parts, share.value)):
                index, _ = nearest(x, c)
                order = np.argsort(index, kind="stable")
                used, first, n = np.unique(index[order], return_index=True, return_counts=True)
                sums = np.add.reduceat(x[order], first, axis=0)
                slots.append(((p * entries + used)[:, None] * width + np.arange(width)).ravel())
                totals += sums.ravel().tolist()
                counts.append(np.repeat(n, width))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(slots)), pa.array(totals, pa.decimal128(38, 0)), pa.array(np.concatenate(counts))], names=["slot", "total", "n"])

    sums = rows.select("vector").mapInArrow(run, "slot long, total decimal(38,0), n long").groupBy("slot").agg(F.sum("total").cast("string").alias("total"), F.sum("n").alias("n"))
    out = book.copy().reshape(-1)
    for r in sums.collect():  # one number of the codebook each
        out[r["slot"]] = int(r["total"]) // r["n"]
    return out.reshape(book.shape)


def encode(rows: DataFrame, book: np.ndarray, scale: int) -> DataFrame:
    """id, label, code, error of every row: the indexes of its parts, two hex digits each, and its squared distance."""
    parts, _, width = book.shape
    share = rows.sparkSession.sparkContext.broadcast(book)
    schema = T.StructType([rows.schema["id"], rows.schema["label"], *T._parse_datatype_string("code string, error long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            found = [nearest(x, c) for x, c in _pieces(batch.column("vector"), scale, width, parts, share.value)]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = saturated(sum(d.astype(object) for _, d in found))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], names=schema.names)

    return rows.select("id", "label", "vector").mapInArrow(run, schema)


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, a comma between."""
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 and codebooks (parts, entries, components) of every row with a usable vector.

    Components become floor(scale * x). Each part position has a codebook of at most 256 entries, at first the parts of the
    rows with the smallest identifiers (nulls last, equal ones by their vectors), then in each round the floored means of the
    parts nearest to them; an entry without parts stays. A round reads the rows once and returns one
    number per component of the codebooks, whose size does not depend on the rows.

    Rows without a vector, or with a component that is null or not finite, are left out; a row without identifier has a code too.
    Shorter vectors count as if followed by zeros, and so do vectors that do not divide evenly; repeated rows are coded each; scaled
    components saturate at 2**53, errors at 64 bits. label_error is the sum over rows of the same label, nulls together. An empty table gives
    no rows; other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    used = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).where(usable(F.col("vector")))
    longest = used.agg(F.max(F.size("vector"))).first()[0] or 0
    book = start_book(used, parts, entries, scale, max(1, _width(longest, parts)))
    for _ in range(rounds if book.size else 0):
        book = means(used, book, scale)
    coded = stored(encode(used, book, scale).withColumn("key", F.struct(F.col("label").isNull().alias("none"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("text"))), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    sums = stored(coded.groupBy("key").agg(total.alias("label_error")), "label-errors")
    books = F.lit(book.tobytes())
    return attach(coded, sums, ["key"], ["id"]).select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(book_digest(book)).alias("codebooks_sha256"), books.alias("codebooks"))
