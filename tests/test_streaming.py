"""Streams with state: order, lateness, restarts and expiry against a batch computation; progress, totals and sinks."""

import datetime as dt
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from broadsheet.session import shared_dir
from broadsheet.streaming import feeds as fd, spikes as sp
from broadsheet.streaming.progress import ProgressTable, progress, rates

START = dt.datetime(2024, 1, 1)
SCHEMA = "feed string, id long, ts timestamp, label string"


def spikes_brute(rows, last, share):
    """key, id -> spike, rows in order of (time, id) within their feed."""
    out, feeds = {}, {}
    for feed, i, _, label in sorted(rows, key=lambda r: (r[2], r[1])):
        seen = feeds.setdefault(feed, [])
        seen.append(label)
        part = seen[-last:]
        full = len(part) == last
        out[feed, i] = "positive_spike" if full and part.count("positive") / last >= share else "negative_spike" if full and part.count("negative") / last >= share else None
    return out


def some_rows(n, seed, minutes=600):
    rnd = random.Random(seed)
    feeds = ["a", "a", "a", "b", None]
    return [(rnd.choice(feeds), i, START + dt.timedelta(minutes=rnd.randrange(minutes)), rnd.choice(["positive", "positive", "negative", None])) for i in range(n)]


def folder(spark):
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)  # the source goes by file time


def spiked(spark, base, delay, idle=None):
    feed = fd.event_time(fd.article_stream(spark, f"{base}/in", SCHEMA, max_files=1), "ts", delay)
    q = fd.export_stream(sp.sentiment_spikes(feed, "feed", "id", "ts", "label", 4, 0.75, idle), f"{base}/out", f"{base}/state")
    q.awaitTermination()
    return q


def results(spark, base):
    return [(r.key, r.id, r.spike) for r in spark.read.parquet(f"{base}/out").where("id IS NOT NULL").collect()]


def end(hours=1000):
    return [(None, None, START + dt.timedelta(hours=hours), None)]


def test_rows_in_any_order_over_triggers_and_a_restart_equal_the_batch(spark):
    base, rows = folder(spark), some_rows(120, 1)
    random.Random(2).shuffle(rows)
    for i in range(0, 120, 40):
        put(spark, f"{base}/in", rows[i:i + 40])
    spiked(spark, base, "600 minutes")
    early = results(spark, base) if spark._jvm.java.io.File(f"{base}/out".removeprefix("file:")).exists() else []
    assert len(early) < 120  # the rest waits for the watermark
    more = [(f, i + 1000, t + dt.timedelta(hours=11), x) for f, i, t, x in some_rows(30, 3)]
    put(spark, f"{base}/in", more)
    put(spark, f"{base}/in", end())
    spiked(spark, base, "600 minutes")  # goes on from the state of the first run
    got = results(spark, base)
    assert len(got) == 150 and {(k, i): s for k, i, s in got} == spikes_brute(rows + more, 4, 0.75)


def test_late_rows_are_dropped_and_counted(spark):
    base = folder(spark)
    on_time = [("a", i, START + dt.timedelta(hours=i), "positive") for i in range(9)]
    late = [("a", 100, START + dt.timedelta(hours=1), "negative"), ("a", 101, START + dt.timedelta(minutes=30), "negative")]
    within = [("a", 102, START + dt.timedelta(hours=7, minutes=30), "negative")]
    for part in (on_time[:6], on_time[6:], late + within, end()):
        put(spark, f"{base}/in", part)
    with ProgressTable(spark, f"{base}/progress", every=2) as seen:
        q = spiked(spark, base, "2 hours")
        assert seen.wait_for(q.runId)
    assert {(k, i): s for k, i, s in results(spark, base)} == spikes_brute(on_time + within, 4, 0.75)
    r = rates(progress(spark, f"{base}/progress")).first()
    assert (r.rows, r.triggers, r.dropped_rows) == (13, 4, 2) and r.running_seconds > 0 and r.rows_per_minute == pytest.approx(13 * 60 / r.running_seconds) and r.dropped_share == pytest.approx(2 / 13)


def test_a_quiet_feed_starts_anew(spark):
    base = folder(spark)
    first = [("a", i, START + dt.timedelta(minutes=i), "positive") for i in range(5)]
    second = [("a", 10 + i, START + dt.timedelta(hours=30, minutes=i), "positive") for i in range(4)]
    put(spark, f"{base}/in", first)
    put(spark, f"{base}/in", [("b", 50, START + dt.timedelta(hours=20), "positive")])
    put(spark, f"{base}/in", [("b", 51, START + dt.timedelta(hours=25), "positive")])
    put(spark, f"{base}/in", second)
    put(spark, f"{base}/in", end())
    spiked(spark, base, "1 minute", idle="10 hours")
    got = {i: s for k, i, s in results(spark, base) if k == "a"}
    assert got == {0: None, 1: None, 2: None, 3: "positive_spike", 4: "positive_spike", 10: None, 11: None, 12: None, 13: "positive_spike"}


def test_spikes_of_equals_brute_force():
    rnd = random.Random(5)
    for _ in range(50):
        labels = [rnd.choice(["positive", "negative", None]) for _ in range(rnd.randrange(30))]
        cut = rnd.randrange(len(labels) + 1)
        whole = spikes_brute([("f", i, i, x) for i, x in enumerate(labels)], 5, 0.6)
        assert sp.spikes_of(labels[:cut][-5:], labels[cut:], 5, 0.6) == [whole["f", i] for i in range(cut, len(labels))]


def test_feeds_of_a_shelf_are_computed_together(spark, monkeypatch):
    monkeypatch.setattr(sp, "SHELVES", 2)
    base, rnd = folder(spark), random.Random(4)
    rows = [(f"f{rnd.randrange(60)}" if i % 9 else None, i, START + dt.timedelta(minutes=rnd.randrange(900)), rnd.choice(["positive", "negative", "positive", None])) for i in range(900)]
    for part in (rows[:400], rows[400:], end()):
        put(spark, f"{base}/in", part)
    state = spiked(spark, base, "900 minutes").recentProgress
    got = results(spark, base)
    assert len(got) == 900 and {(k, i): s for k, i, s in got} == spikes_brute(rows, 4, 0.75)
    held = [o.numRowsTotal for p in state for o in p.stateOperators]
    assert held and max(held) < 30  # a few values of two shelves, not of 61 feeds or 900 rows


def test_state_keeps_the_last_rows_of_each_feed_and_drops_idle_ones(spark):
    class State:
        def __init__(self):
            self.held = []

        def exists(self):
            return bool(self.held)

        def get(self):
            return iter(self.held) if self.many else self.held[0]

        def put(self, rows):
            self.held = list(rows)

        def appendValue(self, row):
            self.held.append(row)

        def update(self, row):
            self.held = [row]

        def clear(self):
            self.held = []

    class Handle:
        timers = set()

        def getListState(self, name, _):
            s = State()
            s.many = True
            return s

        def getValueState(self, name, _):
            s = State()
            s.many = False
            return s

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Now:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    import pandas as pd
    shelf, handle = sp.InOrder(2, 1.0, 1000, batch=2), Handle()
    shelf.init(handle)
    rows = pd.DataFrame({"key": ["a", "a", "b", None, "a", "b"], "micros": [3000, 1000, 2000, 2000, 900_000, 5_000_000], "id": [1, 2, 3, None, 4, 5], "label": ["positive"] * 5 + ["negative"]})
    list(shelf.handleInputRows((0,), iter([rows]), None))
    assert handle.timers == {1}
    handle.timers.clear()
    first = pd.concat(shelf.handleExpiredTimer((0,), Now(950), None))
    assert [(k, None if pd.isna(i) else i, s) for k, i, s in zip(first["key"], first["id"], first["spike"])] == [
        (None, None, None), ("a", 2, None), ("a", 1, "positive_spike"), ("a", 4, "positive_spike"), ("b", 3, None)]
    assert handle.timers == {1002}  # the expiry of b and of the feed without a name
    handle.timers.clear()
    assert not list(shelf.handleExpiredTimer((0,), Now(1500), None)) and handle.timers == {1900}
    handle.timers.clear()
    last = pd.concat(shelf.handleExpiredTimer((0,), Now(9000), None))
    assert list(last["id"]) == [5] and not shelf.recent.exists() and not shelf.waiting.exists() and not handle.timers


def test_replay_of_an_empty_table_writes_nothing(spark):
    base = folder(spark)
    sp.replay(spark.createDataFrame([], SCHEMA), "ts", f"{base}/in", 3)
    assert not spark._jvm.java.io.File(f"{base}/in".removeprefix("file:")).exists()


def test_a_batch_that_is_run_again_replaces_its_rows(spark):
    base, df = folder(spark), spark.range(5)
    write = fd.epoch_sink(f"{base}/out")
    for epoch in (0, 1, 1, 0):
        write(df, epoch)
    assert spark.read.parquet(f"{base}/out").groupBy("epoch").count().orderBy("epoch").collect() == [(0, 5), (1, 5)]


def test_totals_are_whole_after_each_batch(spark):
    base = folder(spark)
    rows = [("a", 1, START, "positive"), ("b", 2, START, "negative"), (None, 3, START, None), ("a", 4, START, "positive")]
    for r in rows:
        put(spark, f"{base}/in", [r])
    feed = fd.article_stream(spark, f"{base}/in", SCHEMA, max_files=1)
    totals = fd.running_totals(feed, {"feed": "feed", "label": F.upper("label")}, F.col("label").isNull())
    fd.export_totals(totals, f"{base}/out", f"{base}/state").awaitTermination()
    got = {(r.measure, r.value): r.n for r in fd.latest_totals(spark, f"{base}/out").collect()}
    assert got == {("processed", None): 3, ("errors", None): 1, ("feed", "a"): 2, ("feed", "b"): 1, ("label", "POSITIVE"): 2, ("label", "NEGATIVE"): 1}
    assert {r.epoch for r in spark.read.parquet(f"{base}/out").select("epoch").distinct().collect()} == {2, 3}


def test_progress_counts_a_trigger_once(spark):
    base = folder(spark)
    table = ProgressTable(spark, f"{base}/p", every=1)
    row = ("q", "r", 0, START, START, 10, 1.0, 2.0, 3.0, 4, 1, None)
    for _ in range(2):
        table._rows = [row]
        table.flush()
    r = rates(table.table()).first()
    assert (r.rows, r.dropped_rows, r.running_seconds, r.rows_per_minute) == (10, 1, 3.0, 200.0)


@pytest.mark.parametrize("parts", [1, 3])
def test_catalogue_streams_read_a_table_of_one_file_or_many(spark, tmp_path, parts):
    from broadsheet.catalog import feeds

    rows = [(i, f"{'a good market ' * (i + 1)}", "en", f"src{i % 2}", 14 * (i + 1)) for i in range(9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts).write.parquet(f"{tmp_path}/w")
    if parts == 1:
        next((tmp_path / "w").glob("part-*.parquet")).rename(tmp_path / "documents.parquet")
    else:
        (tmp_path / "w").rename(tmp_path / "documents.parquet")
    sf = str(tmp_path)
    assert {(r.doc_id, r.lang) for r in feeds.r01(spark, sf).collect()} == {(i, "en") for i in range(9)}
    assert {(r.source, r.processed) for r in feeds.r07(spark, sf).collect()} == {("src0", 5), ("src1", 4)}
    assert {r.event: r.n for r in feeds.r12(spark, sf).collect()} == {"ok": 6, "error": 3}
