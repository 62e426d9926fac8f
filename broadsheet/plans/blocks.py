"""Exact dense similarity in bounded blocks.

A query table that was counted small travels to every task and items stream past it, each task keeping only
its best k per query. Larger ones look into the cells of an index (`cells`). Where every pair counts, tables are cut into
blocks that are written once; a Cartesian product brings them together, they are multiplied as matrices, and a task hands on only what it summed up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.plans.cells import build_cells, search_cells
from broadsheet.plans.sized import attach, fits
from broadsheet.plans.vectors import best_rows, matrix, unit
from broadsheet.session import materialize

#: Rows of a block, rows multiplied at once, bytes of the right side in a task, most partitions of the left side.
BLOCK_ROWS, CHUNK_ROWS, SIDE_BYTES, MOST_PARTITIONS = 4096, 512, 1 << 26, 1024


RESULT = "query_id bigint, item_id bigint, score double"


def partial_top_k(queries: DataFrame, items: DataFrame, k: int, threshold: float | None, skip_self: bool = False) -> DataFrame:
    """A superset of the k best items per query: at most k rows per query and task. Inputs: id, vec."""
    if fits(queries, BLOCK_ROWS):
        q = queries.toPandas()
        if q.empty:
            return items.sparkSession.createDataFrame([], RESULT)
        q_ids, q_vec = q["id"].to_numpy(), unit(matrix(q["vec"]))
        shared = items.sparkSession.sparkContext.broadcast((q_ids, q_vec))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, vecs = shared.value
            best = None
            for b in batches:
                if b.empty:
                    continue
                part = best_rows(ids, b["id"].to_numpy(), vecs @ unit(matrix(b["vec"])).T, k, threshold, skip_self)
                best = part if best is None else pd.concat([best, part]).assign(r=lambda d: d["score"].round(9)).sort_values(
                    ["query_id", "r", "item_id"], ascending=[True, False, True]).groupby("query_id").head(k).drop(columns="r")
            if best is not None:
                yield best

        return items.select("id", "vec").mapInPandas(scan, RESULT)
    return search_cells(build_cells(items), queries, k, threshold, skip_self)[0]


def pack(rows: DataFrame, group: str | None = None) -> DataFrame:
    """Blocks (block, group, ids, m) of rows (id, vec), written once: about BLOCK_ROWS ids and unit vectors as bytes, all of one group if one is named.

    Rows are dealt out by their place, so neither copies nor repeated ids make a large block. Null groups are left out."""
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    if group is None:
        keyed, blocks = numbered.withColumn("group", F.lit(None).cast("string")), F.lit(max(1, -(-rows.count() // BLOCK_ROWS)))
    else:
        sizes = rows.groupBy(F.col(group).alias("group")).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("_blocks"))
        keyed, blocks = attach(numbered.withColumnRenamed(group, "group"), sizes, ["group"], ["_row"]), F.col("_blocks")

    def packed(t: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"group": [t["group"].iloc[0]], "ids": [t["id"].to_numpy(np.int64).tobytes()], "m": [unit(matrix(t["vec"])).tobytes()]})

    keyed = keyed.select("group", F.pmod(F.xxhash64("_row"), blocks).alias("block"), "id", "vec")
    return materialize(keyed.groupBy("group", "block").applyInPandas(packed, "group string, ids binary, m binary").withColumn("block", F.monotonically_increasing_id()))


def meet(left: DataFrame, right: DataFrame, condition: Column | None = None) -> DataFrame:
    """Every block of the one side (columns with _1) with every block of the other (_2) under the condition, all pairs of a left block in a row.

    A task holds at most about SIDE_BYTES of the right side; there are no more tasks for a left block than that and the cores ask for, so
    what a task sums up over its pairs stays in proportion to the left rows."""
    cores, n_left = left.sparkSession.sparkContext.defaultParallelism, max(1, left.count())
    n_right, size = right.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("m")), F.lit(0))).first()
    tasks = max(1, min(n_right, max(-(-size // SIDE_BYTES), -(-4 * cores // n_left))))
    a, b = (df.select([F.col(c).alias(f"{c}_{k}") for c in df.columns]).repartition(n) for k, df, n in ((1, left, min(n_left, MOST_PARTITIONS)), (2, right, tasks)))
    return a.hint("shuffle_replicate_nl").join(b, F.lit(True) if condition is None else condition)


def vectors(data: bytes, n: int) -> np.ndarray:
    """The unit vectors of a block of n rows."""
    return np.frombuffer(data, np.float64).reshape(n, -1)
