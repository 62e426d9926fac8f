"""Exact search in cells: an inverted file of unit vectors around centroids.

Vectors are written in blocks of the cells of their nearest centroids. The angle between a query and a vector is at least the
difference of their angles to the centroid, so the smallest and largest angle of a cell bound the cosine of everything in it.
Queries look into cells in the order of that bound, a few more in each round, until the score of their k-th row is
above the bound of all that is left. What is left out is proved useless; nothing is approximate.

Blocks of queries and blocks of cells meet in a Cartesian product: no vector is repeated in a shuffle, however many cells it meets.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from broadsheet.plans.vectors import matrix, unit
from broadsheet.session import materialize, shared_dir

#: Least rows of a block of cells; a block holds up to four times as many, and no more components than the second number. Rows of a block of queries.
BLOCK_ROWS, BLOCK_COMPONENTS, QUERY_ROWS = 4096, 1 << 23, 2048
#: Queries that are ranked against all cells, or multiplied with a cell, at once.
STEP_ROWS = 512
#: Bytes of blocks of cells that a task holds, about; most partitions of blocks of queries.
SIDE_BYTES, MOST_PARTITIONS = 1 << 26, 1024
#: Cells at most; their centroids and bounds travel to every task.
MOST_CELLS = 4096
#: Rows per cell from which the centroids are fitted. They shape the cells only; results do not depend on them.
FIT_ROWS = 64
#: Scores count as equal when they agree to nine digits, so bounds give way by more than that.
SLACK = 1e-8
#: Stands for a null id inside blocks.
NO_ID = -(1 << 63) + 1

SCORED = "query_id bigint, item_id bigint, score double"


@dataclass
class CellIndex:
    """A written index: its folder, unit centroids, per cell the rows and the range of angles to the centroid, first block and number of blocks, and the type of components.

    The last cell holds vectors of length zero, whose cosine counts as zero."""

    spark: SparkSession
    path: str
    centroids: np.ndarray
    rows: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray
    first: np.ndarray
    blocks: np.ndarray
    kind: str

    def table(self) -> DataFrame:
        """block, cells, n, ids, m: per block its cells, the rows of each, and identifiers and vectors in that order, ids ascending within a cell."""
        return self.spark.read.schema("block int, cells binary, n binary, ids binary, m binary").parquet(self.path)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest cosine that a row of each cell can have with each unit vector; below -1 for empty cells."""
        angle = np.arccos(np.clip(queries @ self.centroids.T, -1, 1))
        apart = np.maximum(0, np.maximum(angle - self.farthest[:-1], self.nearest[:-1] - angle))
        out = np.concatenate([np.cos(np.minimum(apart, math.pi)), np.zeros((len(queries), 1))], axis=1)
        out[np.linalg.norm(queries, axis=1) == 0] = 0
        return np.where(self.rows > 0, out, -2.0)


def _known(df: DataFrame) -> DataFrame:
    """id, vec of a table, null ids as a number."""
    return df.select(F.coalesce(F.col("id").cast("bigint"), F.lit(NO_ID)).alias("id"), "vec")


def _nulls_again(df: DataFrame, *ids: str) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) != NO_ID, F.col(c)) for c in ids})


def _kind(df: DataFrame) -> str:
    """The type in which blocks hold the components of `vec` without loss."""
    return "float32" if isinstance(df.schema["vec"].dataType.elementType, T.FloatType) else "float64"


def build_cells(items: DataFrame, cells: int | None = None, path: str | None = None, seed: int = 42) -> CellIndex:
    """Index of items (id, vec). The default is as many cells as the square root of the rows, up to MOST_CELLS."""
    spark = items.sparkSession
    n = items.count()
    k = min(MOST_CELLS, max(1, cells or round(math.sqrt(n))))
    sample = items.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS * k)
    centroids = np.zeros((1, 1))
    if n:
        fit = KMeans(k=k, maxIter=5, seed=seed).fit(sample.select(array_to_vector(F.transform("vec", lambda x: x.cast("double"))).alias("features")))
        centroids = unit(np.array(fit.clusterCenters()))
    share = spark.sparkContext.broadcast(centroids)
    kind = _kind(items)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                u = unit(matrix(b["vec"]))
                cosine = u @ share.value.T
                none = np.linalg.norm(u, axis=1) == 0
                cell = np.where(none, len(share.value), cosine.argmax(axis=1))
                yield b.assign(angle=np.where(none, 0.0, np.arccos(np.clip(cosine.max(axis=1), -1, 1))), cell=cell.astype("int32"))

    base = path or f"{shared_dir(spark).rstrip('/')}/cells-{uuid.uuid4().hex}"
    element = "float" if kind == "float32" else "double"
    rows = _known(items).withColumn("vec", F.col("vec").cast(f"array<{element}>"))
    rows.mapInPandas(assign, f"id bigint, vec array<{element}>, angle double, cell int").write.parquet(f"{base}/assigned")
    assigned = spark.read.parquet(f"{base}/assigned")
    found = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")).toPandas().set_index("cell").reindex(range(len(centroids) + 1))
    held = found["n"].fillna(0).to_numpy(np.int64)
    size = max(1, min(4 * BLOCK_ROWS, max(BLOCK_ROWS, n // 8), BLOCK_COMPONENTS // centroids.shape[1]))
    first, blocks = _shelves(held, size)

    def packed(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["cell", "id"], kind="stable")
        cell, rows = np.unique(t["cell"].to_numpy(np.int32), return_counts=True)
        return pd.DataFrame({"block": [t["block"].iloc[0]], "cells": [cell.tobytes()], "n": [rows.astype(np.int64).tobytes()], "ids": [t["id"].to_numpy(np.int64).tobytes()],
                             "m": [matrix(t["vec"]).astype(kind).tobytes()]})

    block = (_numbers(first, F.col("cell")) + F.pmod(F.xxhash64("id", "vec"), _numbers(blocks, F.col("cell")))).cast("int")
    shelved = assigned.select("id", "vec", "cell", block.alias("block")).repartition(min(MOST_PARTITIONS, int((first + blocks).max())), "block")
    shelved.groupBy("block").applyInPandas(packed, "block int, cells binary, n binary, ids binary, m binary").write.parquet(f"{base}/cells")
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/assigned")  # nothing reads it again
    old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)
    return CellIndex(spark, f"{base}/cells", centroids, held, found["low"].fillna(0).to_numpy(), found["high"].fillna(0).to_numpy(), first, blocks, kind)


def _numbers(values: np.ndarray, cell: Column) -> Column:
    """Element of a small array by cell."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), cell + 1)


def _shelves(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell: neighbouring small cells share a block, a large one is cut into several."""
    first, blocks = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64)
    block, held = 0, 0
    for c, n in enumerate(rows):
        if held and held + n > size:
            block, held = block + 1, 0
        first[c], blocks[c], held = block, max(1, -(-n // size)), held + n
        if blocks[c] > 1:
            block, held = block + blocks[c], 0
    return first, blocks


PROBES = "block int, ids binary, m binary, least binary, wanted binary, n binary, into array<int>"


def _vectors(data: bytes, kind: str, rows: int) -> np.ndarray:
    return unit(np.frombuffer(data, kind).reshape(rows, -1).astype(np.float64))


def _unpacked(wanted: bytes, rows: int, cells: int) -> np.ndarray:
    """Rows by cells: what the bits say."""
    return np.unpackbits(np.frombuffer(wanted, np.uint8).reshape(rows, -1), axis=1, count=cells).astype(bool)


def _wanted(bounds: np.ndarray, least: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows by cells: those that stand at places [first, last) in a row's order of bounds and may hold a score that matters to it; and the cell of the best bound."""
    order = np.argsort(-bounds, axis=1, kind="stable")
    places = order[:, first:last]
    row, place = np.nonzero(np.take_along_axis(bounds, places, axis=1) >= least[:, None])
    wanted = np.zeros(bounds.shape, bool)
    wanted[row, places[row, place]] = True
    return wanted, order[:, 0]


def _probe_block(index: _Bounds, block: int, ids: np.ndarray, m: np.ndarray, least: np.ndarray, wanted: np.ndarray, best: np.ndarray) -> pd.DataFrame:
    """The rows of a block of queries that want a cell, in the order of their best cell, with the blocks of cells to look into; no row if none wants one."""
    n = wanted.sum(axis=1)
    at = np.argsort(best, kind="stable")
    at = at[n[at] > 0]
    cells = np.flatnonzero(wanted[at].any(axis=0)) if len(at) else []
    into = np.unique(np.concatenate([np.arange(index.first[c], index.first[c] + index.blocks[c]) for c in cells])) if len(cells) else np.zeros(0)
    return pd.DataFrame({"block": [block], "ids": [ids[at].tobytes()], "m": [m[at].tobytes()], "least": [least[at].tobytes()], "wanted": [np.packbits(wanted[at], axis=1).tobytes()],
                         "n": [n[at].astype(np.int64).tobytes()], "into": [into.astype("int32")]}).iloc[:len(at)]


def meet(index: CellIndex, probes: DataFrame, kind: str, opened: Callable[[np.ndarray, np.ndarray], _Pairs], schema: str) -> DataFrame:
    """What `opened(ids, least)` takes of the scores of each block of probes (PROBES, components of a type) with the rows of the cells that its rows want.

    Blocks are read where they were written and meet in a Cartesian product; only rows and cells that want each other are multiplied. A task
    holds about SIDE_BYTES of the cells' blocks, and meets all of them with one block of probes after the other."""
    cells, right = len(index.rows), index.table()
    n_left, size = max(1, probes.count()), int(index.rows.sum()) * (8 + index.centroids.shape[1] * np.dtype(index.kind).itemsize)
    tasks = max(-(-size // SIDE_BYTES), -(-4 * index.spark.sparkContext.defaultParallelism // n_left))
    if right.rdd.getNumPartitions() < min(tasks, int((index.first + index.blocks).max())):
        right = right.repartition(tasks)
    a, b = (df.select([F.col(c).alias(f"{c}_{k}") for c in df.columns]) for k, df in ((1, probes), (2, right.coalesce(tasks))))
    columns, held_kind = [c.split()[0] for c in schema.split(", ")], index.kind

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = pairs = None
        for batch in batches:
            for i in range(len(batch)):
                r = batch.iloc[i]
                if block != r["block_1"]:
                    if pairs is not None:
                        yield pairs.end()[columns]
                    block, ids = r["block_1"], np.frombuffer(r["ids_1"], np.int64)
                    u, wanted, pairs = _vectors(r["m_1"], kind, len(ids)), _unpacked(r["wanted_1"], len(ids), cells), opened(ids, np.frombuffer(r["least_1"], np.float64))
                item_ids = np.frombuffer(r["ids_2"], np.int64)
                items, end = _vectors(r["m_2"], held_kind, len(item_ids)), 0
                for cell, n in zip(np.frombuffer(r["cells_2"], np.int32), np.frombuffer(r["n_2"], np.int64)):
                    begin, end = end, end + n
                    rows = np.flatnonzero(wanted[:, cell])
                    for at in range(0, len(rows), STEP_ROWS):
                        part = rows[at:at + STEP_ROWS]
                        pairs.add(part, item_ids[begin:end], u[part] @ items[begin:end].T)
                if (found := pairs.met()) is not None:
                    yield found[columns]
        if pairs is not None:
            yield pairs.end()[columns]

    return a.hint("shuffle_replicate_nl").join(b, F.array_contains("into_1", F.col("block_2"))).mapInPandas(run, schema)


class _Pairs:
    """What is kept of the scores of a block of queries."""

    def __init__(self, ids: np.ndarray, least: np.ndarray):
        self.ids, self.least, self.found = ids, least.copy(), []

    def keep(self, row: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        if len(row):
            self.found.append((row, item, score))

    def frame(self) -> pd.DataFrame:
        row, item, score = map(np.concatenate, zip(*self.found)) if self.found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pd.DataFrame({"query_id": self.ids[row], "item_id": item, "score": score, "row": row})

    def met(self) -> pd.DataFrame | None:
        """What can be handed on after a block of cells."""

    def end(self) -> pd.DataFrame:
        return self.frame()


class _Best(_Pairs):
    """The k best rows of each query, ties by the smaller item; scores below `least` cannot be among them."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, k: int, threshold: float | None, skip_self: bool):
        super().__init__(ids, least)
        self.k, self.threshold, self.skip_self = k, threshold, skip_self

    def add(self, rows: np.ndarray, items: np.ndarray, scores: np.ndarray) -> None:
        if self.skip_self:
            low, high = (np.searchsorted(items, self.ids[rows], side) for side in ("left", "right"))
            for i in np.flatnonzero(high > low):
                scores[i, low[i]:high[i]] = -np.inf
        near = (scores >= self.least[rows][:, None]) & (scores > -np.inf)
        many = np.flatnonzero(near.sum(axis=1) > 4 * self.k)
        if len(many):  # of these, no more than k: items ascend, so of equal scores the first ones
            rounded = np.round(scores[many], 9)
            kth = np.partition(rounded, -self.k, axis=1)[:, -self.k]
            above, equal = rounded > kth[:, None], rounded == kth[:, None]
            near[many] = above | (equal & (np.cumsum(equal, axis=1) <= (self.k - above.sum(axis=1))[:, None]))
            self.least[rows[many]] = np.maximum(self.least[rows[many]], kth - SLACK)
        i, j = np.nonzero(near)
        self.keep(rows[i], items[j], scores[i, j])

    def met(self) -> None:
        """Only the best of what was found so far stay."""
        if self.found:
            row, item, score = map(np.concatenate, zip(*self.found))
            rounded = np.round(score, 9)
            order = np.lexsort((item, -rounded, row))
            order = order[(score >= self.least[row])[order] & (True if self.threshold is None else rounded[order] >= self.threshold)]
            row, item, score = row[order], item[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
            kth = rank == self.k - 1
            self.least[row[kth]] = np.maximum(self.least[row[kth]], score[kth] - SLACK)
            self.found = [(row[rank < self.k], item[rank < self.k], score[rank < self.k])]


class _Above(_Pairs):
    """All pairs with a score, to nine digits, of at least the threshold; handed on after each block."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, threshold: float):
        super().__init__(ids, least)
        self.threshold = threshold

    def add(self, rows: np.ndarray, items: np.ndarray, scores: np.ndarray) -> None:
        i, j = np.nonzero(scores >= self.threshold - SLACK)
        good = np.round(scores[i, j], 9) >= self.threshold
        i, j = i[good], j[good]
        self.keep(rows[i], items[j], scores[i, j])

    def met(self) -> pd.DataFrame | None:
        out = self.frame() if self.found else None
        self.found = []
        return out


def _probes(index: Broadcast, queries: DataFrame, first: int, last: int, threshold: float | None) -> DataFrame:
    """id, vec, least, wanted, best, cells: each query (id, vec, kth) with the score that matters to it and, as bits and as a number, the cells that stand at places [first, last)
    in its order of bounds and may hold such a row, and the cell of the best bound."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), STEP_ROWS):
                b = batch.iloc[at:at + STEP_ROWS]
                least = _least(b["kth"].fillna(-1.5).to_numpy(), threshold)
                wanted, best = _wanted(index.value.bounds(unit(matrix(b["vec"]))), least, first, last)
                n = wanted.sum(axis=1)
                bits = [x.tobytes() for x in np.packbits(wanted, axis=1)]
                yield pd.DataFrame({"id": b["id"].to_numpy(), "vec": b["vec"].to_numpy(), "least": least, "wanted": bits, "best": best, "cells": n})[n > 0]

    return queries.mapInPandas(run, f"id bigint, vec {queries.schema['vec'].dataType.simpleString()}, least double, wanted binary, best int, cells bigint")


def _least(kth: np.ndarray, threshold: float | None) -> np.ndarray:
    return np.maximum(kth, -1.5 if threshold is None else threshold) - SLACK


class _Bounds:
    """What tasks need of an index to rank cells."""

    def __init__(self, index: CellIndex):
        self.centroids, self.rows, self.nearest, self.farthest, self.first, self.blocks = index.centroids, index.rows, index.nearest, index.farthest, index.first, index.blocks

    bounds = CellIndex.bounds


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def search_cells(index: CellIndex, queries: DataFrame, k: int, threshold: float | None = None, skip_self: bool = False, growth: int = 16) -> tuple[DataFrame, DataFrame]:
    """The k best rows of each query (query_id, item_id, score; ties to nine digits by the smaller item), and query_id, cells: how many it read.

    The first round looks at the best cell of each query, the second at `growth` more, and the last at all that may still hold a better row."""
    from broadsheet.operators.relational import top_k_per_group
    spark = index.spark
    if not index.rows.sum():
        return spark.createDataFrame([], SCORED), queries.select(F.col("id").cast("bigint").alias("query_id"), F.lit(0).cast("bigint").alias("cells"))
    share, kind = spark.sparkContext.broadcast(_Bounds(index)), _kind(queries)
    asked = max(1, -(-queries.count() // QUERY_ROWS))
    parts, cells = min(asked, MOST_PARTITIONS), len(index.rows)
    by_block = F.pmod(F.xxhash64("id"), F.lit(asked)).cast("int").alias("block")

    def packed(t: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [t["block"].iloc[0]], "ids": [t["id"].to_numpy(np.int64).tobytes()], "m": [matrix(t["vec"]).astype(kind).tobytes()]})

    blocks = materialize(_known(queries).select(by_block, "id", "vec").repartition(parts, "block").groupBy("block").applyInPandas(packed, "block int, ids binary, m binary"))
    best = spark.createDataFrame([], SCORED)
    read: list[DataFrame] = []

    def probes(first: int, last: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
        def run(block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            if block.empty:
                return pd.DataFrame({c.split()[0]: [] for c in PROBES.split(", ")})
            ids = np.frombuffer(block["ids"].iloc[0], np.int64)
            m = np.frombuffer(block["m"].iloc[0], kind).reshape(len(ids), -1)
            kth = np.full(len(ids), -1.5)
            known = known.dropna(subset=["kth"]).sort_values("id")
            if len(known):
                at = np.minimum(np.searchsorted(known["id"].to_numpy(np.int64), ids), len(known) - 1)
                same = known["id"].to_numpy(np.int64)[at] == ids
                kth[same] = known["kth"].to_numpy()[at[same]]
            least = _least(kth, threshold)
            found = [_wanted(share.value.bounds(unit(m[i:i + STEP_ROWS].astype(np.float64))), least[i:i + STEP_ROWS], first, last) for i in range(0, len(ids), STEP_ROWS)]
            return _probe_block(share.value, block["block"].iloc[0], ids, m, least, *map(np.concatenate, zip(*found)))
        return run

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, n in zip(b["ids"], b["n"]):
                yield pd.DataFrame({"query_id": np.frombuffer(ids, np.int64), "cells": np.frombuffer(n, np.int64)})

    for first, last in ((0, 1), (1, 1 + growth), (1 + growth, cells)):
        if first >= cells:
            break
        kth = best.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth")).select("id", "kth", by_block)
        probed = materialize(blocks.repartition(parts, "block").groupBy("block").cogroup(kth.repartition(parts, "block").groupBy("block")).applyInPandas(probes(first, last), PROBES))
        read.append(probed.select("ids", "n").mapInPandas(counted, "query_id bigint, cells bigint"))
        if probed.isEmpty():
            break
        more = best.unionByName(meet(index, probed, kind, lambda ids, least: _Best(ids, least, k, threshold, skip_self), SCORED))
        best = _written(top_k_per_group(more, ["query_id"], F.round("score", 9), k, "item_id", salts=1).select("query_id", "item_id", "score"), "best")
    counts = read[0]
    for r in read[1:]:
        counts = counts.unionByName(r)
    return _nulls_again(best, "query_id", "item_id"), _nulls_again(counts.groupBy("query_id").agg(F.sum("cells").alias("cells")), "query_id")


def pairs_above(index: CellIndex, queries: DataFrame, threshold: float) -> DataFrame:
    """query_id, item_id, score of all pairs with a cosine (to nine digits) of at least the threshold: each query meets the cells whose bound reaches it."""
    if not index.rows.sum():
        return index.spark.createDataFrame([], SCORED)
    share, kind, cells = index.spark.sparkContext.broadcast(_Bounds(index)), _kind(queries), len(index.rows)
    asked = max(1, -(-queries.count() // QUERY_ROWS))
    rows = _probes(share, _known(queries).withColumn("kth", F.lit(None).cast("double")), 0, cells, threshold)

    def packed(t: pd.DataFrame) -> pd.DataFrame:
        return _probe_block(share.value, t["block"].iloc[0], t["id"].to_numpy(np.int64), matrix(t["vec"]).astype(kind), t["least"].to_numpy(), _unpacked(b"".join(t["wanted"]), len(t), cells), t["best"].to_numpy())

    blocked = rows.withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.lit(asked)).cast("int")).repartition(min(asked, MOST_PARTITIONS), "block").groupBy("block")
    probed = materialize(blocked.applyInPandas(packed, PROBES))
    return _nulls_again(meet(index, probed, kind, lambda ids, least: _Above(ids, least, threshold), SCORED), "query_id", "item_id")
