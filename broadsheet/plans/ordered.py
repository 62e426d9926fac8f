"""Row-based frames over tables of any size.

A window over a whole raw table, or over one hot group, would put all its rows into one task. Here rows are
range-partitioned by (group, order) and numbered from per-partition counts; a frame of k rows is then
evaluated inside fixed-size blocks of consecutive positions, each block carrying the k-1 rows before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from broadsheet.plans.sized import with_scalars
from broadsheet.session import materialize

BLOCK = 200_000
_LOCAL = (1 << 33) - 1


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def with_position(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
                  name: str = "position") -> DataFrame:
    """Add the 0-based position of every row in its group. `order` should end with a unique key."""
    by = list(by)
    keys = [*_cols(by), *_cols(order)]
    stamped = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)))
    )
    stamped = materialize(stamped)
    runs = stamped.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*by, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    if not by:
        runs = F.broadcast(runs)  # one row per partition
        joined = stamped.join(runs, "_part")
    else:
        right = runs.select(*[F.col(c).alias(f"_g_{c}") for c in by], F.col("_part").alias("_p"), "_first", "_before")
        same = F.col("_part") == F.col("_p")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        joined = stamped.join(right, same).drop("_p", *[f"_g_{c}" for c in by])
    return joined.withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).drop(
        "_part", "_at", "_first", "_before")


def rolling(df: DataFrame, order: Sequence[str | Column], rows: int,
            measures: Mapping[str, Callable[[WindowSpec], Column]], by: Sequence[str] = (),
            block: int = BLOCK) -> DataFrame:
    """Measures over the last `rows` rows of each group, the current one included. Keeps `position`."""
    block = max(block, rows)
    placed = with_position(df, order, by)
    home = F.floor(F.col("position") / block)
    copies = F.when(F.col("position") % block >= block - (rows - 1), F.array(home, home + 1)).otherwise(F.array(home))
    spread = placed.withColumn("_block", F.explode(copies))
    w = Window.partitionBy(*by, "_block").orderBy("position").rowsBetween(-(rows - 1), 0)
    out = spread.withColumns({k: fn(w) for k, fn in measures.items()})
    return out.where(F.col("_block") == home).drop("_block")


def previous(df: DataFrame, order: Sequence[str | Column], value: str, by: Sequence[str] = (),
             name: str = "previous", block: int = BLOCK) -> DataFrame:
    """Value of the row before, as lag would give it."""
    return rolling(
        df, order, 2,
        {name: lambda w: F.when(F.count(F.lit(1)).over(w) == 2, F.first(value).over(w))}, by, block)


def cumulative(df: DataFrame, order: Sequence[str | Column], value: str, by: Sequence[str] = (),
               name: str = "cumulative", block: int = BLOCK) -> DataFrame:
    """Running sum: sums inside blocks plus the total of the blocks before."""
    placed = materialize(with_position(df, order, by).withColumn("_block", F.floor(F.col("position") / block)))
    sums = placed.groupBy(*by, "_block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    w = Window.partitionBy(*by, "_block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumn("_inside", F.sum(value).over(w))
    return (inside.join(sums, [*by, "_block"])
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_block", "_before", "_inside"))


def percentiles(df: DataFrame, value: str, shares: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group.

    Equal values are counted first, then numbered by running count, so a group is never held in one buffer.
    """
    by = list(by)
    counts = materialize(df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    run = materialize(cumulative(counts, ["_v"], "_n", by, "_upto"))
    totals = run.groupBy(*by).agg(F.sum("_n").alias("_total"))
    placed = run.join(totals, by) if by else with_scalars(run, totals)
    aggs = []
    for name, share in shares.items():
        rank = F.lit(float(share)) * (F.col("_total") - 1)
        low = F.max(F.when((F.col("_upto") > F.floor(rank)) & (F.col("_upto") - F.col("_n") <= F.floor(rank)), F.col("_v")))
        high = F.max(F.when((F.col("_upto") > F.ceil(rank)) & (F.col("_upto") - F.col("_n") <= F.ceil(rank)), F.col("_v")))
        frac = F.max(rank - F.floor(rank))
        aggs.append((low + (high - low) * frac).alias(name))
    return placed.groupBy(*by).agg(*aggs)
