"""Similarity, search and clustering."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, BucketedRandomProjectionLSH, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.operators.clean import apply_filters, dedup_prefix
from broadsheet.operators.features import tfidf_by_corpus
from broadsheet.operators.lexicon import simple_sentiment
from broadsheet.operators.relational import hash_sample, overlap_ratio, top_k_per_group, top_n
from broadsheet.plans import sparse
from broadsheet.plans.blocks import CHUNK_ROWS, meet, pack, partial_top_k, vectors
from broadsheet.plans.cells import BLOCK_ROWS, STEP_ROWS, CellIndex, build_cells, pairs_above, search_cells
from broadsheet.plans.vectors import matrix, unit
from broadsheet.plans.sized import attach, bounded_rows, fits, with_scalars
from broadsheet.session import materialize, written


def normalize_vectors(df: DataFrame, vec_col: str, out: str | None = None) -> DataFrame:
    v = F.transform(vec_col, lambda x: x.cast("double"))
    df = df.withColumn("_norm", F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)))
    return df.withColumn(out or vec_col, F.transform(v, lambda x: F.when(F.col("_norm") > 0, x / F.col("_norm")).otherwise(0.0))).drop("_norm")


def _ids(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"))


def similar_items(queries: DataFrame, items: DataFrame, id_col: str, vec_col: str, k: int = 5, threshold: float | None = None,
                  skip_self: bool = False) -> DataFrame:
    """Exact cosine top k per query: query_id, item_id, score, rank."""
    found = partial_top_k(_ids(queries, id_col, vec_col), _ids(items, id_col, vec_col), k, threshold, skip_self)
    return top_k_per_group(found, ["query_id"], F.round("score", 9), k, "item_id", salts=1)


def semantic_search(queries: DataFrame, docs: DataFrame, id_col: str, vec_col: str, text_col: str, filters: Mapping[str, Any] | None = None,
                    k: int = 5) -> DataFrame:
    """Filter, then rank by cosine; positive scores only, with the word overlap of query and document."""
    kept = apply_filters(docs, filters or {})
    found = similar_items(queries, kept, id_col, vec_col, k, 1e-9)
    q = queries.select(F.col(id_col).alias("query_id"), tx.word_tokens(text_col).alias("_q"))
    d = kept.select(F.col(id_col).alias("item_id"), tx.word_tokens(text_col).alias("_d"))
    return found.join(q, "query_id").join(d, "item_id").withColumn("relevance", overlap_ratio(F.col("_q"), F.col("_d"))).drop("_q", "_d")


def item_cells(items: DataFrame, id_col: str, vec_col: str, cells: int | None = None, path: str | None = None) -> CellIndex:
    """Write the search index of a table; it serves any number of searches."""
    return build_cells(_ids(items, id_col, vec_col), cells, path)


def search_items(index: CellIndex, queries: DataFrame, id_col: str, vec_col: str, k: int = 5, threshold: float | None = None, skip_self: bool = False) -> DataFrame:
    """As `similar_items`, from an index: query_id, item_id, score, rank, and cells, how many cells the query read to prove its result."""
    found, read = search_cells(index, _ids(queries, id_col, vec_col), k, threshold, skip_self)
    return top_k_per_group(found, ["query_id"], F.round("score", 9), k, "item_id", salts=1).join(read, "query_id")


def cross_similarity(a: DataFrame, b: DataFrame, id_col: str, vec_col: str, threshold: float) -> DataFrame:
    """Pairs of two sets with cosine of at least the threshold; rows of the one look into the cells of the other that can hold such a pair."""
    found = pairs_above(item_cells(b, id_col, vec_col), _ids(a, id_col, vec_col), threshold)
    return found.select(F.col("query_id").alias("id_1"), F.col("item_id").alias("id_2"), "score")


def similarity_features(df: DataFrame, reference: DataFrame, id_col: str, vec_col: str, max_reference: int = 20_000) -> DataFrame:
    """Max, mean, std (population) and median cosine of each row to a reference set.

    A reference set that was counted small travels to every task. Of a larger one, mean and deviation come from the sum of its
    unit vectors and of their outer products, the maximum and the median from rounds over all block pairs (`_extremes`). A row never
    holds more than the counts of its steps or a bounded number of cosines, whatever the size of the reference set.
    """
    if not fits(reference, max_reference):
        rows = materialize(_ids(df, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()))
        others = materialize(reference.select(F.monotonically_increasing_id().alias("id"), F.col(vec_col).alias("vec")))
        own = rows.select(F.col("row").alias("id"), "vec")
        moments = _moments(own, others)
        return moments.join(_extremes(own, others), "id").join(rows.select(F.col("row").alias("id"), F.col("id").alias("_own")), "id").select(
            F.col("_own").alias(id_col), "max_similarity", "mean_similarity", "std_similarity", "median_similarity")
    ref = unit(np.array([r[0] for r in bounded_rows(reference.select(vec_col), max_reference, "reference set")], dtype=np.float64))
    shared = df.sparkSession.sparkContext.broadcast(ref)

    def run(batches):
        for b in batches:
            if len(b):
                s = unit(matrix(b["vec"])) @ shared.value.T
                yield pd.DataFrame({"id": b["id"], "max_similarity": s.max(1), "mean_similarity": s.mean(1),
                                    "std_similarity": s.std(1), "median_similarity": np.median(s, axis=1)})

    return _ids(df, id_col, vec_col).mapInPandas(
        run, "id bigint, max_similarity double, mean_similarity double, std_similarity double, median_similarity double").withColumnRenamed("id", id_col)


def _moments(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """id, mean_similarity, std_similarity: from the reference set's sum and second moments, whose size is that of a vector squared."""
    def add(batches):
        total = square = None
        n = 0
        for b in batches:
            if len(b):
                u = unit(matrix(b["vec"]))
                total, square, n = (u.sum(0), u.T @ u, len(u)) if total is None else (total + u.sum(0), square + u.T @ u, n + len(u))
        if n:
            d = len(total)
            yield pd.DataFrame({"i": np.concatenate([np.arange(d), np.repeat(np.arange(d), d), [-1]]), "j": np.concatenate([np.full(d, -1), np.tile(np.arange(d), d), [-1]]), "x": np.concatenate([total, square.ravel(), [n]])})

    found = reference.select("vec").mapInPandas(add, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    d = int(found["i"].max()) + 1
    n = float(found.loc[found["i"] < 0, "x"].iloc[0])
    total, square = np.zeros(d), np.zeros((d, d))
    one, two = found[(found["i"] >= 0) & (found["j"] < 0)], found[found["j"] >= 0]
    total[one["i"]], square[two["i"], two["j"]] = one["x"] / n, two["x"] / n
    shared = rows.sparkSession.sparkContext.broadcast((total, square))

    def run(batches):
        mean, second = shared.value
        for b in batches:
            if len(b):
                u = unit(matrix(b["vec"]))
                m = u @ mean
                yield pd.DataFrame({"id": b["id"], "mean_similarity": m, "std_similarity": np.sqrt(np.maximum(0, np.einsum("ij,jk,ik->i", u, second, u) - m * m))})

    return rows.mapInPandas(run, "id bigint, mean_similarity double, std_similarity double")


#: Steps of a bracket in one round of counts; values of a bracket that are gathered instead; reference rows that guess the first bracket; slack of
#: a bracket, as a product differs in its last bits from block to block; brackets as narrow as this are the result.
STEPS, GATHERED, GUESS_ROWS, SLACK, NARROW = 256, 512, 8192, 1e-12, 1e-11
EDGE = 1.0 + 1e-9
_COUNTED = "block long, below binary, counts binary, row binary, value binary, best binary"
_BRACKETS = "block long, ids binary, m binary, low binary, high binary, first binary, last binary, gather binary"
_REFINED = _BRACKETS + ", done array<bigint>, value array<double>, best_id array<bigint>, best array<double>"


def _extremes(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """id, max_similarity, median_similarity (the middle cosine, or the mean of the two middle ones) of each row to all reference rows.

    Some reference rows guess a bracket of the middle for every row. A round multiplies all pairs of blocks and counts the cosines below
    a row's bracket and in its steps; the next bracket is the step that holds the middle, or what lies beside a bracket that missed it.
    A bracket with few values hands them on, and the middle is read from them, so two rounds are enough for most rows."""
    n = reference.count()
    right = pack(reference).select("m")
    guess = reference.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // GUESS_ROWS))) == 0).limit(2 * GUESS_ROWS).select("vec").toPandas()["vec"]
    shared = rows.sparkSession.sparkContext.broadcast(unit(matrix(guess)) if len(guess) else None)

    def guessed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block, ids, m in zip(b["block"], b["ids"], b["m"]):
                size, sample = len(ids) // 8, shared.value
                low, high = np.full(size, -EDGE), np.full(size, EDGE)
                if sample is not None:
                    k, off = len(sample), 2 * np.sqrt(len(sample))
                    a, z = int(k / 2 - off) - 1, int(k / 2 + off) + 1
                    if a >= 0 and z < k:
                        u = vectors(m, size)
                        for i in range(0, size, CHUNK_ROWS):
                            s = np.partition(u[i:i + CHUNK_ROWS] @ sample.T, (a, z), axis=1)
                            low[i:i + CHUNK_ROWS], high[i:i + CHUNK_ROWS] = s[:, a] - SLACK, s[:, z] + SLACK
                yield pd.DataFrame({"block": [block], "ids": [ids], "m": [m], "low": [low.tobytes()], "high": [high.tobytes()], "first": [np.full(size, (n - 1) // 2).tobytes()],
                                    "last": [np.full(size, n // 2).tobytes()], "gather": [np.zeros(size, bool).tobytes()]})

    state, results, top = materialize(pack(rows).mapInPandas(guessed, _BRACKETS)), [], None
    while True:
        counted = meet(state, right).mapInArrow(_counted, _COUNTED)
        refined = materialize(counted.groupBy("block").cogroup(state.groupBy("block")).applyInPandas(_refine(n), _REFINED))
        results.append(refined.select(F.explode(F.arrays_zip("done", "value")).alias("x")).select(F.col("x.done").alias("id"), F.col("x.value").alias("value")))
        if top is None:
            top = refined.select(F.explode(F.arrays_zip("best_id", "best")).alias("x")).select(F.col("x.best_id").alias("id"), F.col("x.best").alias("max_similarity"))
        state = refined.select([c.split()[0] for c in _BRACKETS.split(", ")]).where(F.length("ids") > 0)
        if state.limit(1).count() == 0:
            break
    # a row whose two middle ranks parted has two values
    return top.join(reduce(DataFrame.unionByName, results).groupBy("id").agg(F.avg("value").alias("median_similarity")), "id")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pairs of a left block have in and below the brackets of its rows, summed up over the pairs of the task."""
    held: tuple | None = None

    def handed_on() -> pa.RecordBatch:
        block, below, counts, found, best = held
        row, value = (np.concatenate(x) if x else np.zeros(0) for x in zip(*found)) if found else (np.zeros(0), np.zeros(0))
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *[pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in (
            (below, np.int64), (counts, np.int32), (row, np.int32), (value, np.float64), (best, np.float64))]], names=[c.split()[0] for c in _COUNTED.split(", ")])

    for batch in batches:
        columns = {c: batch.column(batch.schema.get_field_index(c)) for c in ("block_1", "m_1", "low_1", "high_1", "gather_1", "m_2")}
        for i in range(len(batch)):
            block = columns["block_1"][i].as_py()
            if held is None or held[0] != block:
                if held:
                    yield handed_on()
                low, high, gather = (np.frombuffer(columns[c][i].as_buffer(), t) for c, t in (("low_1", np.float64), ("high_1", np.float64), ("gather_1", bool)))
                size, x = len(low), vectors(columns["m_1"][i].as_buffer(), len(low))
                scale = STEPS / (high - low)
                held = block, np.zeros(size, np.int64), np.zeros((0 if gather.all() else size, STEPS), np.int64), [], np.full(size, -np.inf)
            _, below, counts, found, best = held
            y = np.frombuffer(columns["m_2"][i].as_buffer(), np.float64).reshape(-1, x.shape[1])
            for a in range(0, size, CHUNK_ROWS):
                rows = slice(a, min(a + CHUNK_ROWS, size))
                s = x[rows] @ y.T
                np.maximum(best[rows], s.max(1), out=best[rows])
                below[rows] += np.count_nonzero(s < low[rows, None], axis=1)
                at = np.flatnonzero((s >= low[rows, None]) & (s < high[rows, None]))
                row, value = at // len(y), s.ravel()[at]
                kept = gather[rows][row]
                found.append(((row[kept] + a).astype(np.int32), value[kept]))
                if len(counts):
                    row, value = row[~kept], value[~kept]
                    step = np.minimum(((value - low[rows][row]) * scale[rows][row]).astype(np.int64), STEPS - 1)
                    counts[rows] += np.bincount(row * STEPS + step, minlength=len(s) * STEPS).reshape(-1, STEPS)
    if held:
        yield handed_on()


def _refine(n: int):
    """The next brackets of a block, or the results, from the counts of all its tasks; n reference rows."""
    def run(counted: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        b = block.iloc[0]
        low, high, first, last, gather, ids = (np.frombuffer(b[c], t) for c, t in (("low", float), ("high", float), ("first", np.int64), ("last", np.int64), ("gather", bool), ("ids", np.int64)))
        size = len(ids)
        below = sum(np.frombuffer(x, np.int64) for x in counted["below"])
        best = np.max([np.frombuffer(x, np.float64) for x in counted["best"]], axis=0)
        row, value = (np.concatenate([np.frombuffer(x, t) for x in counted[c]]) for c, t in (("row", np.int32), ("value", np.float64)))
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        at = np.searchsorted(row, np.arange(size))
        here = np.searchsorted(row, np.arange(size), "right") - at
        read = gather & (first >= below) & (last < below + here)
        middle = (value[(at + first - below)[read]] + value[(at + last - below)[read]]) / 2
        done, values = [ids[read]], [middle]
        # a gathered bracket that missed its rank starts afresh
        lost, going = gather & ~read, np.flatnonzero(~gather)
        parts = [(np.flatnonzero(lost), np.full(lost.sum(), -EDGE), np.full(lost.sum(), EDGE), first[lost], last[lost], np.zeros(lost.sum(), bool))]
        if len(going):
            counts = sum(np.frombuffer(x, np.int32).reshape(size, STEPS).astype(np.int64) for x in counted["counts"])[going]
            start, upto, under = low[going], np.cumsum(counts, axis=1), below[going]
            width = (high[going] - start) / STEPS

            def place(rank: np.ndarray) -> np.ndarray:  # -1: below the bracket, STEPS: above
                return np.where(rank < under, -1, (upto + under[:, None] <= rank[:, None]).sum(1))

            def bracket(which: np.ndarray, step: np.ndarray, a: np.ndarray, z: np.ndarray) -> None:
                k, inner = step[which], np.clip(step[which], 0, STEPS - 1)
                lo = np.where(k < 0, -EDGE, np.where(k < STEPS, start[which] + inner * width[which], high[going][which])) - SLACK
                hi = np.where(k < 0, start[which], np.where(k < STEPS, start[which] + (inner + 1) * width[which], EDGE)) + SLACK
                inside = np.where(k < 0, under[which], np.where(k < STEPS, counts[which, inner], n - under[which] - upto[which, -1]))
                narrow, own = hi - lo < NARROW, going[which]
                done.append(ids[own[narrow]])
                values.append((lo + hi)[narrow] / 2)
                parts.append(tuple(x[~narrow] for x in (own, lo, hi, a[going][which], z[going][which], inside <= GATHERED)))

            one, two = place(first[going]), place(last[going])
            together, apart = np.flatnonzero(one == two), np.flatnonzero(one != two)
            bracket(together, one, first, last)
            bracket(apart, one, first, first)
            bracket(apart, two, last, last)
        own, lo, hi, a, z, few = (np.concatenate(x) for x in zip(*parts))
        own = own.astype(np.int64)
        arrays = (ids[own], vectors(b["m"], size)[own], lo.astype(np.float64), hi.astype(np.float64), a.astype(np.int64), z.astype(np.int64), few.astype(bool))
        return pd.DataFrame({"block": [b["block"]]} | {c: [x.tobytes()] for c, x in zip(("ids", "m", "low", "high", "first", "last", "gather"), arrays)} | {
            "done": [np.concatenate(done)], "value": [np.concatenate(values)], "best_id": [ids], "best": [best]})

    return run


def copy_groups(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """id, rep, copies: rows with the same tokens share the lowest id as their representative."""
    keyed = df.select(id_col, F.sha2(F.array_join(tokens_col, "\u0001"), 256).alias("_k"))
    reps = keyed.groupBy("_k").agg(F.min(id_col).alias("rep"), F.count(F.lit(1)).alias("copies"))
    return keyed.join(reps, "_k").drop("_k")


def pair_candidates(weights: DataFrame, id_col: str, threshold: float, cell_rows: int = 2000) -> DataFrame:
    """id_1 < id_2, part, rest: pairs of rows (id, term, tfidf) whose dot product may reach the threshold, as part <= product <= part + rest.

    Rows are packed into blocks of about cell_rows rows, and every two blocks are multiplied inside a task (`sparse.multiply`), which hands on only
    pairs that reach the threshold: no product of two weights is ever a row, and blocks are written once, however many others they meet.
    All terms are multiplied, so nothing rests.
    """
    least = threshold - 1e-9
    blocks, kind = sparse.pack(weights.select(F.col(id_col).alias("id"), "term", F.col("tfidf").cast("double").alias("w")), cell_rows)
    return sparse.block_pairs(blocks, least, kind).select("id_1", "id_2", "part", F.lit(0.0).alias("rest"))


def similar_pairs(weights: DataFrame, id_col: str, threshold: float, cell_rows: int = 2000) -> DataFrame:
    """All pairs id_1 < id_2 of unit TF-IDF rows (id, term, tfidf) with cosine >= threshold, exactly: candidates come with their dot products."""
    pairs = pair_candidates(weights, id_col, threshold, cell_rows).select("id_1", "id_2", F.col("part").alias("score"))
    return pairs.where(F.round("score", 9) >= threshold)


def similar_pairs_of_texts(weights: DataFrame, groups: DataFrame, id_col: str, threshold: float) -> DataFrame:
    """Similar pairs between representatives, with the copies behind each; a group of copies is one row with itself.

    Every pair of single documents follows from the membership table `groups` (id, rep, copies).
    """
    reps = materialize(groups.select(F.col("rep").alias(id_col), "copies").distinct())
    pairs = similar_pairs(weights.join(reps.select(id_col), id_col, "left_semi"), id_col, threshold)
    c1 = reps.select(F.col(id_col).alias("id_1"), F.col("copies").alias("copies_1"))
    c2 = reps.select(F.col(id_col).alias("id_2"), F.col("copies").alias("copies_2"))
    same = reps.where("copies > 1").select(F.col(id_col).alias("id_1"), F.col(id_col).alias("id_2"), F.lit(1.0).alias("score"),
                                           F.col("copies").alias("copies_1"), F.col("copies").alias("copies_2"))
    return pairs.join(c1, "id_1").join(c2, "id_2").select("id_1", "id_2", "score", "copies_1", "copies_2").unionByName(same)


def approximate_pairs(df: DataFrame, id_col: str, vec_col: str, threshold: float, bucket: float = 0.5, tables: int = 6, seed: int = 42, block_rows: int | None = None, whole: bool = False) -> DataFrame:
    """Neighbours by random projection of unit vectors; identical vectors are compared once.

    The rows of a bucket are cut into blocks, and a pair of blocks is one task of bounded size that emits only close pairs; a pair that shares
    buckets of several tables comes from the first of them. Pairs that share no bucket are left out, unless the `whole` result is asked for: then
    no close pair is (`_pairs_of_near_buckets`), and a vector that several ids share is also a row with itself."""
    v = F.transform(vec_col, lambda x: x.cast("double"))
    keyed = df.select(F.col(id_col).alias("id"), v.alias("v"), F.sha2(F.to_json(v), 256).alias("_k"))
    reps = keyed.groupBy("_k").agg(F.min_by("v", "id").alias("v"), F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), (F.min("id") < F.max("id")).alias("several"))
    units = Normalizer(inputCol="raw", outputCol="unit").transform(reps.withColumn("raw", array_to_vector("v")).select("id", "copies", "several", "raw"))
    lsh = BucketedRandomProjectionLSH(inputCol="unit", outputCol="hashes", bucketLength=bucket, numHashTables=tables, seed=seed).fit(units)
    distance = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    keys = F.array(*[vector_to_array(F.col("hashes")[i])[0].cast("bigint") for i in range(tables)])
    rows = written(lsh.transform(units).where("id IS NOT NULL").select("id", "copies", "several", vector_to_array("unit").alias("vec"), keys.alias("keys")))
    if whole:
        same = rows.where("several").select(F.col("id").alias("id_1"), F.col("id").alias("id_2"), F.lit(1.0).alias("score"), F.col("copies").alias("copies_1"), F.col("copies").alias("copies_2"))
        return _pairs_of_near_buckets(rows, distance, bucket, block_rows or BLOCK_ROWS).unionByName(same)
    posted = rows.select("*", F.posexplode("keys").alias("table", "bucket"))
    most, least = F.lit(block_rows or 4 * BLOCK_ROWS), F.lit(block_rows or BLOCK_ROWS)
    n = F.count(F.lit(1))
    sizes = materialize(posted.groupBy("table", "bucket").agg(F.ceil(n / F.least(most, F.greatest(least, n / 8))).cast("int").alias("blocks")))
    tasks = sizes.agg(F.coalesce(F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2), F.lit(1))).first()[0]
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = attach(posted, sizes, ["table", "bucket"], ["id"]).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("id", "copies", "vec", "keys", "table", "bucket", "mine", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        table, p, q = (int(group[c].iloc[0]) for c in ("table", "p", "q"))
        x, y = group[group["mine"] == p], group[group["mine"] == q]
        parts = [pd.DataFrame({"id_1": [], "id_2": [], "score": [], "copies_1": [], "copies_2": []})]
        if len(x) and len(y):
            right, right_keys, right_id, right_n = matrix(y["vec"]), np.stack(y["keys"]), y["id"].to_numpy(), y["copies"].to_numpy()
            for at in range(0, len(x), STEP_ROWS):
                part = x.iloc[at:at + STEP_ROWS]
                left, left_keys, left_id, left_n = matrix(part["vec"]), np.stack(part["keys"]), part["id"].to_numpy(), part["copies"].to_numpy()
                # a vector of length zero is at distance one, or zero, of any other
                near = (left * left).sum(1)[:, None] + (right * right).sum(1)[None, :] - 2 * (left @ right.T)
                i, j = np.nonzero(near < distance * distance + 1e-9)
                new = (left_id[i] < right_id[j] if p == q else left_id[i] != right_id[j]) & ~(left_keys[i, :table] == right_keys[j, :table]).any(axis=1)
                i, j = i[new], j[new]
                d = np.sqrt(((left[i] - right[j]) ** 2).sum(axis=1))
                i, j, d = i[d < distance], j[d < distance], d[d < distance]
                swap = left_id[i] > right_id[j]
                parts.append(pd.DataFrame({"id_1": np.where(swap, right_id[j], left_id[i]), "id_2": np.where(swap, left_id[i], right_id[j]), "score": 1 - d * d / 2,
                                           "copies_1": np.where(swap, right_n[j], left_n[i]), "copies_2": np.where(swap, left_n[i], right_n[j])}))
        return pd.concat(parts[1:] or parts)

    schema = f"id_1 {rows.schema['id'].dataType.simpleString()}, id_2 {rows.schema['id'].dataType.simpleString()}, score double, copies_1 bigint, copies_2 bigint"
    return dealt.repartition(max(1, min(int(tasks), 2000)), "table", "bucket", "p", "q").groupBy("table", "bucket", "p", "q").applyInPandas(compared, schema)


def _pairs_of_near_buckets(rows: DataFrame, distance: float, bucket: float, block_rows: int) -> DataFrame:
    """id_1 < id_2, score, copies_1, copies_2: all pairs of rows (id, copies, vec, keys) nearer than the distance.

    Projections on a unit vector differ by no more than the vectors do, so near vectors lie in near buckets of every table. Blocks hold
    rows of one bucket of the first table and are written once; a Cartesian product brings together those whose ranges of buckets are near in all tables."""
    kind = rows.schema["id"].dataType.simpleString()
    first = rows.select("*", F.col("keys")[0].alias("bucket"), F.monotonically_increasing_id().alias("row"))
    sizes = first.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    keyed = attach(first, sizes, ["bucket"], ["row"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("blocks")))

    def packed(t: pd.DataFrame) -> pd.DataFrame:
        t, keys = t.sort_values("row"), np.stack(t["keys"])
        return pd.DataFrame({"ids": [list(t["id"])], "copies": [t["copies"].to_numpy(np.int64).tobytes()], "m": [matrix(t["vec"]).tobytes()],
                             "low": [keys.min(0).astype(np.int64)], "high": [keys.max(0).astype(np.int64)]})

    blocks = keyed.select("bucket", "part", "row", "id", "copies", "vec", "keys").groupBy("bucket", "part").applyInPandas(
        packed, f"ids array<{kind}>, copies binary, m binary, low array<bigint>, high array<bigint>")
    blocks = materialize(blocks.withColumn("block", F.monotonically_increasing_id()))
    reach = F.lit(int(distance / bucket) + 1)
    apart = F.exists(F.arrays_zip("low_1", "high_1", "low_2", "high_2"), lambda x: (x["low_1"] - x["high_2"] > reach) | (x["low_2"] - x["high_1"] > reach))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(len(batch)):
                pair = batch.iloc[at]
                (left_id, left_n, left), (right_id, right_n, right) = ((np.asarray(pair[f"ids_{k}"]), np.frombuffer(pair[f"copies_{k}"], np.int64), vectors(pair[f"m_{k}"], len(pair[f"ids_{k}"]))) for k in (1, 2))
                own, square = pair["block_1"] == pair["block_2"], (right * right).sum(1)
                for a in range(0, len(left), CHUNK_ROWS):
                    x = left[a:a + CHUNK_ROWS]
                    # |x - y|^2 < distance^2, a little widened, as a bound of the product
                    least = ((x * x).sum(1)[:, None] - distance * distance - 1e-9) / 2
                    i, j = np.divmod(np.flatnonzero(x @ right.T > least + square / 2), max(1, len(right)))
                    i += a
                    new = left_id[i] != right_id[j]
                    i, j = (i[new & (i < j)], j[new & (i < j)]) if own else (i[new], j[new])
                    d = np.sqrt(((left[i] - right[j]) ** 2).sum(axis=1))
                    i, j, d = i[d < distance], j[d < distance], d[d < distance]
                    swap = left_id[i] > right_id[j]
                    yield pd.DataFrame({"id_1": np.where(swap, right_id[j], left_id[i]), "id_2": np.where(swap, left_id[i], right_id[j]), "score": 1 - d * d / 2,
                                        "copies_1": np.where(swap, right_n[j], left_n[i]), "copies_2": np.where(swap, left_n[i], right_n[j])})

    return meet(blocks, blocks, (F.col("block_1") <= F.col("block_2")) & ~apart).mapInPandas(near, f"id_1 {kind}, id_2 {kind}, score double, copies_1 bigint, copies_2 bigint")


# ---- clusters ------------------------------------------------------------------------------------------------

def as_vectors(df: DataFrame, vec_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(vec_col, lambda x: x.cast("double"))))


def cluster_items(df: DataFrame, vec_col: str, k: int, seed: int = 42) -> tuple[DataFrame, KMeansModel]:
    data = as_vectors(df, vec_col)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(data)
    return model.transform(data).drop("features"), model


def choose_k(df: DataFrame, vec_col: str, k_max: int = 20, seed: int = 42) -> int:
    """First k whose gain in inertia falls below half of the gain before; small sets get min(3, n)."""
    n = df.count()
    if n < 10:
        return min(3, n)
    data = as_vectors(df, vec_col).select("features").cache()
    try:
        costs: list[float] = []
        for k in range(2, min(k_max, n - 1) + 1):
            costs.append(KMeans(k=k, seed=seed).fit(data).summary.trainingCost)
            if len(costs) >= 3 and costs[-2] - costs[-1] < (costs[-3] - costs[-2]) * 0.5:
                return k
        return min(8, n // 3)
    finally:
        data.unpersist()


def cluster_stats(df: DataFrame, cluster_col: str) -> DataFrame:
    sizes = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n"))
    ideal = F.sum("n") / F.count(F.lit(1))
    return sizes.agg(F.count(F.lit(1)).alias("clusters"), F.max("n").alias("largest"), F.min("n").alias("smallest"), F.avg("n").alias("mean"),
                     F.greatest(F.lit(0.0), 1 - F.stddev_pop("n") / ideal).alias("balance"))


def vector_sums(df: DataFrame, by: Sequence[str], vec_col: str) -> DataFrame:
    return df.select(*by, F.posexplode(vec_col).alias("pos", "x")).groupBy(*by, "pos").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"))


def cluster_coherence(df: DataFrame, cluster_col: str, vec_col: str) -> DataFrame:
    """Mean cosine over all pairs of a cluster, from the norm of the sum of unit vectors: linear in the rows."""
    sums = vector_sums(normalize_vectors(df.select(cluster_col, vec_col), vec_col), [cluster_col], vec_col)
    per = sums.groupBy(cluster_col).agg(F.max("n").alias("items"), F.sum(F.col("s") * F.col("s")).alias("_q"))
    n = F.col("items")
    return per.select(cluster_col, "items", F.when(n > 1, (F.col("_q") - n) / (n * (n - 1))).otherwise(1.0).alias("coherence"))


def cluster_terms(df: DataFrame, cluster_col: str, id_col: str, tokens_col: str, k: int = 10, max_features: int = 100) -> DataFrame:
    """Top words of each cluster by mean TF-IDF inside it."""
    w = tfidf_by_corpus(df.select(cluster_col, id_col, tokens_col), cluster_col, id_col, tokens_col, max_features, 1, 1.0, 1, 1)
    sizes = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("_n"))
    means = w.groupBy(cluster_col, "term").agg(F.sum("tfidf").alias("_s")).join(sizes, cluster_col).withColumn("score", F.col("_s") / F.col("_n"))
    return top_k_per_group(means.select(cluster_col, "term", "score"), [cluster_col], F.round("score", 9), k, "term")


def project_pca(df: DataFrame, vec_col: str, k: int = 2):
    """Rows with their k coordinates, and the share of variance each explains."""
    data = as_vectors(df, vec_col)
    model = PCA(k=k, inputCol="features", outputCol="_pca").fit(data)
    return model.transform(data).withColumn("coordinates", vector_to_array("_pca")).drop("_pca", "features"), list(model.explainedVariance.toArray())


COUNTS = "group_1 string, group_2 string, bin bigint, n bigint"
#: Pairs of groups that a task counts at once.
HELD_PAIRS = 8


def group_similarity(df: DataFrame, key: str, id_col: str, vec_col: str, digits: int = 6) -> DataFrame:
    """Per pair of groups: cosine of the centroids, and distribution of the cosines between their members.

    Blocks hold members of one group, and only blocks of two groups meet, once. A task counts cosines rounded to `digits` over all its
    pairs, so the quantiles are exact to that precision and what is shuffled does not grow with the pairs.
    """
    scale = 10 ** digits
    data = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"), F.col(key).cast("string").alias("group"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], np.ndarray] = {}

        def handed_on(groups: tuple[str, str], n: np.ndarray) -> pa.RecordBatch:
            bins = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([*[pa.array([g]).take(pa.array(np.zeros(len(bins), np.int64))) for g in groups], pa.array(bins - scale - 1), pa.array(n[bins])], names=["group_1", "group_2", "bin", "n"])

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("group_1", "group_2", "ids_1", "ids_2", "m_1", "m_2")]
            for i in range(len(batch)):
                groups = columns[0][i].as_py(), columns[1][i].as_py()
                if groups not in held:
                    if len(held) == HELD_PAIRS:
                        yield handed_on(first := next(iter(held)), held.pop(first))
                    held[groups] = np.zeros(2 * scale + 3, np.int64)
                x, y = (vectors(columns[4 + k][i].as_buffer(), len(columns[2 + k][i].as_buffer()) // 8) for k in (0, 1))
                for a in range(0, len(x), CHUNK_ROWS):
                    s = x[a:a + CHUNK_ROWS] @ y.T
                    s *= scale
                    held[groups] += np.bincount(np.rint(s, out=s).ravel().astype(np.int64) + (scale + 1), minlength=2 * scale + 3)
        for groups, n in held.items():
            yield handed_on(groups, n)

    blocks = pack(data, "group").select("group", "ids", "m")
    counts = meet(blocks, blocks, F.col("group_1") < F.col("group_2")).mapInArrow(count, COUNTS).groupBy("group_1", "group_2", "bin").agg(F.sum("n").alias("n"))
    pair = Window.partitionBy("group_1", "group_2")  # at most 2 * 10^digits + 1 distinct values
    upto = F.sum("n").over(pair.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    run = counts.withColumns({"_upto": upto, "_t": F.sum("n").over(pair)})

    def at(share: float) -> Column:
        rank = F.lit(share) * (F.col("_t") - 1)
        pick = lambda r: F.max(F.when((F.col("_upto") > r) & (F.col("_upto") - F.col("n") <= r), F.col("bin")))
        lo, hi = pick(F.floor(rank)), pick(F.ceil(rank))
        return (lo + (hi - lo) * F.max(rank - F.floor(rank))) / scale

    mean = F.sum(F.col("bin") * F.col("n")) / F.sum("n")
    dist = run.groupBy("group_1", "group_2").agg(
        F.sum("n").alias("pairs"), (F.min("bin") / scale).alias("min"), (F.max("bin") / scale).alias("max"), (mean / scale).alias("mean"),
        at(0.25).alias("q25"), at(0.5).alias("median"), at(0.75).alias("q75"),
        (F.sqrt(F.sum(F.col("bin") * F.col("bin") * F.col("n").cast("double")) / F.sum("n") - mean * mean) / scale).alias("std"))
    sums = vector_sums(data, ["group"], "vec").select("group", "pos", (F.col("s") / F.col("n")).alias("c"))
    norms = sums.groupBy("group").agg(F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("_n"))
    s = sums.join(norms, "group").withColumn("u", F.col("c") / F.col("_n"))
    c = s.select(F.col("group").alias("group_1"), "pos", F.col("u").alias("u1")).join(
        s.select(F.col("group").alias("group_2"), "pos", F.col("u").alias("u2")), "pos").where("group_1 < group_2").groupBy("group_1", "group_2").agg(
        F.sum(F.col("u1") * F.col("u2")).alias("centroid_similarity"))
    return dist.join(c, ["group_1", "group_2"])


def mixed_clusters(df: DataFrame, cluster_col: str, group_col: str) -> DataFrame:
    """Clusters with the groups they mix, and whether they hold more than one."""
    per = df.groupBy(cluster_col, group_col).agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy(cluster_col).agg(F.sum("n").alias("items"), F.count(F.lit(1)).alias("groups"), (F.max("n") / F.sum("n")).alias("main_share"))
    share = out.agg(F.avg((F.col("groups") > 1).cast("int")).alias("mixed_ratio"))
    return with_scalars(out, share)


# ---- article search ------------------------------------------------------------------------------------------

def search_articles(df: DataFrame, id_col: str, text_col: str, category_col: str, terms: Sequence[str], categories: Sequence[str] = (),
                    sentiment: str | None = None, n: int = 3, positive: Sequence[str] = wl.SEARCH_POSITIVE,
                    negative: Sequence[str] = wl.SEARCH_NEGATIVE) -> DataFrame:
    """Best n articles: 3 for the category, 1 per term found, 2 for the sentiment; duplicates by prefix first."""
    low = F.lower(text_col)
    d = dedup_prefix(df, text_col, id_col)
    in_category = tx.any_hit(F.lower(category_col), [c.lower() for c in categories])
    if categories:
        d = d.where(in_category)
    if sentiment:
        d = d.where(simple_sentiment(low, positive, negative)["label"] == sentiment)
    wanted = [t for t in terms if t not in wl.COMMAND_WORDS and t not in ("positive", "negative") and t not in categories]
    score = tx.hit_count(low, wanted) + F.lit((3 if categories else 0) + (2 if sentiment else 0))
    scored = d.withColumn("score", score).where((F.col("score") > 0) | F.lit(bool(categories)))
    best = top_n(scored, "score", n, id_col)
    return best.select(id_col, tx.title_words(text_col).alias("title"), tx.preview(text_col, 400).alias("text"), category_col, "score")


def keyword_search(df: DataFrame, id_col: str, text_col: str, text_query: str, n: int = 10) -> DataFrame:
    """Articles with any meaningful word of the query, by number of words found."""
    terms = [t for t in dict.fromkeys(text_query.lower().split()) if len(t) > 2 and t not in wl.SEARCH_STOP_WORDS]
    scored = df.withColumn("relevance", tx.hit_count(F.lower(text_col), terms)).where("relevance > 0")
    return top_n(scored, "relevance", n, id_col)


def articles_by(df: DataFrame, id_col: str, text_col: str, category_col: str, category: str | None = None, polarity: str | None = None,
                n: int = 5, seed: int = 42, positive: Sequence[str] = wl.BROWSE_POSITIVE, negative: Sequence[str] = wl.BROWSE_NEGATIVE) -> DataFrame:
    """n seeded articles of a category or word list, with the total that matched."""
    d = df
    if category:
        d = d.where(F.lower(category_col) == category.lower())
    if polarity:
        d = d.where(tx.any_hit(F.lower(text_col), positive if polarity == "positive" else negative))
    total = d.agg(F.count(F.lit(1)).alias("total"))
    return with_scalars(hash_sample(d, id_col, n, seed), total)
