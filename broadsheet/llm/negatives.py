"""Hard negatives of anchors: scores in blocks, a secondary sort by (anchor, descending score, id), windows opened by the positives that stream past."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from broadsheet.llm.common import shuffle_partitions, stored
from broadsheet.llm.vectors import MOST, saturated, scaled, usable

#: Components in a block of vectors (2 MB), and anchors of which a task keeps best rows before it hands them on.
BLOCK, HELD = 1 << 18, 1 << 14

BLOCKS = "ids binary, labels binary, vectors binary, n int"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
SCORED = "anchor_id long, a_block long, place int, score long, id long"

#: At equal scores a positive comes before the negatives, which its window takes in.
POSITIVE, NEGATIVE = 0, 1


def _packed(rows: DataFrame, scale: int) -> DataFrame:
    """Rows (id, label, vector) of each task as blocks of bounded size: identifiers, labels, and a matrix of scaled components."""
    def block(ids, labels, m) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"ids": [ids.tobytes()], "labels": [labels.tobytes()], "vectors": [m.tobytes()], "n": pa.array([len(ids)], pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            if not len(batch):
                continue
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
            m = scaled(batch.column("vector"), scale)
            step = max(1, BLOCK // max(1, m.shape[1]))
            for i in range(0, len(ids), step):
                new = (ids[i:i + step], labels[i:i + step], m[i:i + step])
                if held and (held[0][2].shape[1] != m.shape[1] or sum(len(x[0]) for x in held) + len(new[0]) > step):
                    yield block(*map(np.concatenate, zip(*held)))
                    held = []
                held.append(new)
        if held:
            yield block(*map(np.concatenate, zip(*held)))

    return rows.mapInArrow(run, BLOCKS)


def _opened(ids: bytes, labels: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
    return ids, labels, np.frombuffer(vectors).reshape(len(ids), -1)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two blocks of whole numbers, exact; missing components count as zero, sums beyond 64 bits saturate."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width) < MOST:
        return (a @ b.T).astype(np.int64)  # every partial sum is a whole number that a double holds
    return saturated(a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T)


def _first(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` highest scores, ties by the smaller identifier, in that order."""
    at = np.arange(len(score))
    if len(at) > most > 0:
        at = np.flatnonzero(score >= np.partition(score, len(score) - most)[len(score) - most])
    return at[np.lexsort((ids[at], -score[at]))][:most]


def lowest(positive: int, percent: int) -> int:
    """The smallest whole score with percent * positive <= 100 * score."""
    return -((-percent * positive) // 100)


def _in_windows(score: np.ndarray, ids: np.ndarray, positives: list[int], most: int, percent: int) -> np.ndarray:
    """Places of all rows that are among the first `most` of a window [percent of positive, positive]: no other can be returned."""
    opened = [p for p in positives if p >= 0]
    if not opened:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((score >= lowest(min(opened), percent)) & (score <= max(opened)))
    at = at[np.lexsort((ids[at], -score[at]))]
    down = -score[at]
    taken = [at[i:min(i + most, int(np.searchsorted(down, -lowest(p, percent), "right")))] for p in opened for i in [int(np.searchsorted(down, -p, "left"))]]
    return np.unique(np.concatenate(taken))


def _met(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of rows beside every block of anchors, by a Cartesian product of blocks that are written once: none is repeated in a shuffle or sent by the driver.

    A task reads one block of anchors and a share of the rows' blocks, whose number follows from the cores, as each task hands on rows of every anchor."""
    n_rows, n_anchors = (max(1, df.count()) for df in (blocks, anchors))
    left = blocks.drop("block").repartition(min(n_rows, 4 * blocks.sparkSession.sparkContext.defaultParallelism))
    return left.hint("shuffle_replicate_nl").crossJoin(anchors.repartition(n_anchors))


def _chosen(met: DataFrame, same: bool, choose: Callable[[np.ndarray, np.ndarray, list[int]], np.ndarray]) -> RDD:
    """(anchor, block, place, score, id): of each anchor and task, the rows that `choose(scores, ids, positives)` takes of those of the same label, or of others.

    A task chooses again from what it has and each further block, so it hands on a bounded number of rows per anchor. The pairs of blocks
    are read as an RDD, as its batches for Python go by bytes: a batch of many blocks would not be bounded."""
    def run(pairs: Iterator[Row]) -> Iterator[tuple]:
        held: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}

        def handed() -> Iterator[tuple]:
            for key, (ids, score) in held.items():
                yield from ((*key, s, i) for i, s in zip(ids.tolist(), score.tolist()))
            held.clear()

        for r in pairs:
            ids, labels, m = _opened(r["ids"], r["labels"], r["vectors"])
            a_ids, a_labels, a = _opened(r["a_ids"], r["a_labels"], r["a_vectors"])
            positives: dict[int, list[int]] = {}
            for place, score in r["best"] if "best" in r else ():
                positives.setdefault(place, []).append(score)
            for place, score in enumerate(scores(a, m)):
                at = np.flatnonzero(((labels == a_labels[place]) == same) & (ids != a_ids[place]))
                key = int(a_ids[place]), r["a_block"], place
                before = held.get(key, (ids[:0], score[:0]))
                own, score = np.concatenate([before[0], ids[at]]), np.concatenate([before[1], score[at]])
                at = choose(score, own, positives.get(place, []))
                held[key] = own[at], score[at]
            if len(held) > HELD:
                yield from handed()
        yield from handed()

    return met.rdd.mapPartitions(run)


def _windows(most: int, percent: int) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """Streams over rows sorted by (anchor, descending score, positives first, id): a positive opens a window, a negative goes to all open ones."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        who, opened = None, []
        for (anchor, block, place, down, kind, other), _ in rows:
            if (anchor, block, place) != who:
                who, opened = (anchor, block, place), []
            if kind == POSITIVE:
                if down <= 0:  # else its window is empty
                    opened.append([other, -down, lowest(-down, percent), 0])
                continue
            opened = [w for w in opened if w[2] <= -down and w[3] < most]
            for w in opened:
                w[3] += 1
                yield anchor, w[0], w[3], other, w[1], -down

    return run


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows for which the condition holds. Scores are inner products of the components floor(scale * x), higher first,
    ties by the smaller identifier. An anchor's positives are its first other rows of the same label; of each, the first
    rows of another label follow whose score lies between `percent` hundredths of the positive's and the positive's.

    Anchors and rows are cut into blocks of bounded size. A first pass over the pairs of blocks finds the positives, a second the
    rows of other labels that can be among the first of a window; a task hands on no more of them than windows can return. Scores go
    into keys (anchor, descending score, positives first, id), which one shuffle deals by anchor and sorts; an iterator opens a
    window at each positive and closes it at its lowest score or last rank, so no anchor's rows are ever held together.

    Rows take no part without identifier, label, or vector, or with a component that is null or not finite. A table without
    rows or anchors gives none. Rows that repeat an identifier each take part; an anchor's others are rows with another identifier, and rows
    equal in identifier and score are interchangeable in the result. Shorter vectors count as if followed by zeros;
    scaled components saturate at 2**53 and scores at 64 bits. Labels are integers. Other columns are ignored.
    """
    spark = rows.sparkSession
    used = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    n, width = used.where("anchor").agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], RESULT)
    blocks = stored(_packed(used, scale).withColumn("block", F.monotonically_increasing_id()), "row-blocks")
    dealt = _packed(used.where("anchor").repartition(-(-n * max(1, width) // BLOCK)), scale)
    parted = stored(dealt.select(F.monotonically_increasing_id().alias("a_block"), *[F.col(c).alias(f"a_{c}") for c in dealt.columns]), "anchor-blocks")

    near = spark.createDataFrame(_chosen(_met(blocks, parted), True, lambda s, i, _: _first(s, i, positives)), SCORED, verifySchema=False)
    order = Window.partitionBy("a_block", "place").orderBy(F.desc("score"), "id")  # a few rows of each task
    best = stored(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives).drop("rank"), "positives")
    known = parted.join(best.groupBy("a_block").agg(F.collect_list(F.struct("place", "score")).alias("best")).hint("merge"), "a_block")
    others = _chosen(_met(blocks, stored(known, "anchor-blocks")), False, lambda s, i, p: _in_windows(s, i, p, negatives, percent))

    keyed = spark.sparkContext.union([best.rdd.map(lambda r: ((r[0], r[1], r[2], -r[3], POSITIVE, r[4]), None)), others.map(lambda r: ((r[0], r[1], r[2], -r[3], NEGATIVE, r[4]), None))])
    sorted_keys = keyed.repartitionAndSortWithinPartitions(shuffle_partitions(spark), lambda key: hash(key[:3]))
    return spark.createDataFrame(sorted_keys.mapPartitions(_windows(negatives, percent)), RESULT, verifySchema=False)
