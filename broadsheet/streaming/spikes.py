"""Sentiment spikes of live feeds in event-time order, whatever the order of arrival.

Rows wait in state until the watermark has passed them; a timer then hands them on in order. The state of
a feed is its waiting rows and its last labels. Feeds share shelves, a fixed number of state keys: their rows are kept as packed columns and all
feeds of a shelf are computed at once, so the calls to the state follow the shelves and triggers, not feeds and rows. State lies in RocksDB, so it may outgrow the memory of an executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SPIKE = "key string, id bigint, ts timestamp, spike string"
#: Keys of the state. A checkpoint depends on the number.
SHELVES = 512
#: Labels that count, by code; others are code 0.
KINDS = ("negative", "positive")
ROWS = pa.schema([("key", pa.dictionary(pa.int32(), pa.string())), ("micros", pa.int64()), ("id", pa.int64()), ("kind", pa.int8())])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Queries that start from now on keep their state in RocksDB; processors with timers need it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def codes(labels: pd.Series) -> np.ndarray:
    """The code of each label."""
    return sum((k * (labels == kind).to_numpy(bool) for k, kind in enumerate(KINDS, 1)), np.zeros(len(labels), np.int8)).astype(np.int8)


def spikes_at(kind: np.ndarray, place: np.ndarray, last: int, share: float) -> np.ndarray:
    """Code of the spike at each row of feeds that lie one after the other, from the `last` rows up to it; `place` counts the rows of its feed before it."""
    out = np.zeros(len(kind), np.int8)
    end = np.flatnonzero(place >= last - 1) + 1
    for k in range(1, len(KINDS) + 1):  # where both reach the share, positive counts
        counts = np.concatenate([[0], np.cumsum(kind == k)])
        out[end[(counts[end] - counts[end - last]) / last >= share] - 1] = k
    return out


def _spike_names(spikes: np.ndarray) -> np.ndarray:
    return np.array([None, *[f"{kind}_spike" for kind in KINDS]], dtype=object)[spikes]


def spikes_of(before: list[str], labels: list[str], last: int, share: float) -> list[str | None]:
    """Spike of each label, from the `last` labels up to it; `before` holds those that came earlier."""
    kind = codes(pd.Series([*before, *labels], dtype=object))
    return list(_spike_names(spikes_at(kind, np.arange(len(kind)), last, share))[len(before):])


def _packed(rows: pa.RecordBatch) -> tuple[bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ROWS) as out:
        out.write_batch(rows)
    return (sink.getvalue().to_pybytes(),)


def _batch(key: np.ndarray, micros: np.ndarray, ids: pd.arrays.IntegerArray, kind: np.ndarray) -> pa.RecordBatch:
    names = pa.array(key, pa.string()).dictionary_encode()
    return pa.RecordBatch.from_arrays([names, pa.array(micros, pa.int64()), pa.array(ids, pa.int64()), pa.array(kind, pa.int8())], schema=ROWS)


def _unpacked(parts: Iterator[tuple]) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(part[0]).read_all() for part in parts]
    table = pa.concat_tables([t.set_column(0, "key", t["key"].cast(pa.string())) for t in tables]) if tables else pa.schema([("key", pa.string()), *list(ROWS)[1:]]).empty_table()
    return pd.DataFrame({"key": table["key"].to_numpy(zero_copy_only=False).astype(object), "micros": table["micros"].to_numpy(), "id": table["id"].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get), "kind": table["kind"].to_numpy()})


class InOrder(StatefulProcessor):
    """Holds the rows of a shelf of feeds until the watermark passes them; one timer per shelf, at its earliest waiting row or at the expiry of a feed."""

    def __init__(self, last: int, share: float, idle_ms: int | None, batch: int = 10_000):
        self.last, self.share, self.idle_ms, self.batch = last, share, idle_ms, batch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.recent = handle.getValueState("recent", "rows binary")
        self.due = handle.getValueState("due", "ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            pdf = pdf[pdf["micros"].notna()]
            if len(pdf):
                micros = pdf["micros"].to_numpy(np.int64)
                self.waiting.appendValue(_packed(_batch(pdf["key"].to_numpy(object), micros, pd.array(pdf["id"], "Int64"), codes(pdf["label"]))))
                low = -(-int(micros.min()) // 1000)
                first = low if first is None else min(first, low)
        if first is not None:
            self._wake(first)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = _unpacked(self.waiting.get() if self.waiting.exists() else ())
        ready = (rows["micros"] <= passed).to_numpy()
        self.due.clear()
        wait = rows[~ready]
        before = _unpacked([self.recent.get()] if self.recent.exists() else ())
        both = self._in_order(before, rows[ready])
        feed, micros = both["feed"].to_numpy(), both["micros"].to_numpy()
        fresh = np.ones(len(both), bool)
        fresh[1:] = feed[1:] != feed[:-1]
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(both)) if len(both) else starts
        if self.idle_ms is not None:  # what comes after an idle time starts anew
            fresh[1:] |= micros[1:] - micros[:-1] > self.idle_ms * 1000
        at = np.arange(len(both))
        spikes = spikes_at(both["kind"].to_numpy(), at - np.maximum.accumulate(np.where(fresh, at, 0)), self.last, self.share)
        due = both["due"].to_numpy()
        out, spikes = both[due], spikes[due]
        for i in range(0, len(out), self.batch):
            part = out.iloc[i:i + self.batch]
            yield pd.DataFrame({"key": part["key"].to_numpy(object), "id": part["id"].array, "ts": pd.to_datetime(part["micros"].to_numpy(), unit="us"), "spike": _spike_names(spikes[i:i + self.batch])})
        self._keep(both, np.repeat(ends, ends - starts) - at, micros[ends - 1], ends - starts, wait, passed)

    def _in_order(self, before: pd.DataFrame, ready: pd.DataFrame) -> pd.DataFrame:
        """The rows of each feed one after the other: those handed on before, then those that are due, by time and id, nulls last."""
        both = pd.concat([before, ready], ignore_index=True)
        due, ids = np.arange(len(both)) >= len(before), both["id"]
        both["feed"], both["due"] = pd.factorize(both["key"])[0], due
        order = np.lexsort((np.where(due, ids.fillna(0).to_numpy(np.int64), 0), due & ids.isna().to_numpy(bool), np.where(due, both["micros"], 0), due, both["feed"]))
        return both.iloc[order]

    def _keep(self, both: pd.DataFrame, left: np.ndarray, latest: np.ndarray, sizes: np.ndarray, wait: pd.DataFrame, passed: int) -> None:
        """Keep the last rows of each feed, unless nothing came for the idle time, and those that wait; `left` counts the rows of a feed from each on."""
        stay, wakes = left <= self.last, []
        if self.idle_ms is not None:
            live = latest + self.idle_ms * 1000 > passed
            stay &= np.repeat(live, sizes)
            wakes += [-(-int(latest[live].min()) // 1000) + self.idle_ms] if live.any() else []
        tail = both[stay]
        if len(tail):
            self.recent.update(_packed(_batch(*(tail[c].array if c == "id" else tail[c].to_numpy() for c in ("key", "micros", "id", "kind")))))
        else:
            self.recent.clear()
        if len(wait):
            self.waiting.put([_packed(_batch(*(wait[c].array if c == "id" else wait[c].to_numpy() for c in ("key", "micros", "id", "kind"))))])
            wakes.append(-(-int(wait["micros"].min()) // 1000))
        else:
            self.waiting.clear()
        if wakes:
            self._wake(min(wakes))

    def _wake(self, at: int) -> None:
        """The shelf's timer, moved forward if it stands later."""
        held = self.due.get()[0] if self.due.exists() else None
        if held is not None and held <= at:
            return
        if held is not None:
            self.handle.deleteTimer(held)
        self.handle.registerTimer(at)
        self.due.update((at,))

    def close(self) -> None:
        pass


def sentiment_spikes(df: DataFrame, key_col: str, id_col: str, ts_col: str, label_col: str, last: int = 10, share: float = 0.8, idle: str | None = None) -> DataFrame:
    """key, id, ts, spike of every row of a stream with a watermark on `ts_col`, in event-time order within each feed.

    A row is handed on once the watermark has passed it, so rows may arrive in any order within the watermark's delay;
    rows that are later still are dropped and counted by Spark (`numRowsDroppedByWatermark`, see `progress`). Rows of equal time go by
    id. A feed without rows for more than `idle` (a duration of event time, such as "2 days") starts anew, and its
    state is removed once the watermark has passed that time; by default its last labels are kept. Rows without time are left out; rows without feed share one.
    """
    spark = df.sparkSession
    use_rocksdb(spark)
    idle_ms = None if idle is None else int(spark.sql(f"SELECT CAST(unix_millis(TIMESTAMP '1970-01-01 00:00:00' + INTERVAL {idle}) - unix_millis(TIMESTAMP '1970-01-01 00:00:00') AS BIGINT)").first()[0])
    keyed = df.select(F.col(key_col).cast("string").alias("key"), F.col(id_col).cast("bigint").alias("id"), F.col(ts_col), F.unix_micros(F.col(ts_col)).alias("micros"), F.col(label_col).cast("string").alias("label"))
    keyed = keyed.withColumn("shelf", F.pmod(F.xxhash64("key"), F.lit(SHELVES)).cast("int"))
    return keyed.groupBy("shelf").transformWithStateInPandas(InOrder(last, share, idle_ms), SPIKE, "Append", "EventTime")


def replay(df: DataFrame, ts_col: str, path: str, slices: int, late: DataFrame | None = None, files: int = 1, jitter: str = "0 seconds") -> None:
    """Write a table as the files of a live feed: `slices` of arrival time one after the other, then an end marker.

    A row arrives after its event time by up to `jitter`, depending on its hash; inside a slice the order is that of a hash. Rows of `late` come with the last slice. The marker is a row of nulls whose time lies ten
    years after the last row: it lifts the watermark, so that rows still waiting are handed on.
    """
    low, high = df.agg(F.min(F.unix_micros(ts_col)), F.max(F.unix_micros(ts_col))).first()
    if low is None:
        return
    most = F.greatest(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {jitter}")), F.lit(1))
    arrives = F.unix_micros(ts_col) + F.pmod(F.xxhash64(*df.columns), most)
    number = F.least(F.floor((arrives - low) * slices / (high - low + 1)), F.lit(slices - 1))
    for k in range(slices):
        part = df.where(number == k)
        if late is not None and k == slices - 1:
            part = part.unionByName(late)
        part.repartition(files, F.xxhash64(*part.columns)).write.mode("append").parquet(path)
    end = F.timestamp_micros(F.lit(high)) + F.expr("INTERVAL 10 YEARS")
    df.sparkSession.range(1).select(*[(end if f.name == ts_col else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema]).write.mode("append").parquet(path)
