"""Streams that keep late rows, allow lateness, fire early, or follow the clock."""

import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from eventide.plans import q_late_streams as Q
from eventide.session import scratch_path
from eventide.streaming import stateful_windows as V
from eventide.streaming.feed import arrival_feed
from eventide.streaming.jobs import start_continuous, start_periodic_watermark
from eventide.streaming.late import KeptWatermark, row_is_late, split_late_batches, window_is_closed
from eventide.streaming.runner import _run, file_stream, run_bounded, stream_settings
from eventide.streaming.sources import event_stream
from eventide.streaming.state import read_state

from helpers import rows

SF = "/root/testdata/sf0.001"
SCHEMA = "event_id long, key string, ts timestamp_ntz, arrival_ms long"
T0 = 1_700_000_000_000

# (event_id, key, seconds after T0, arrival slice)
EVENTS = [(1, "a", 1, 0), (2, "a", 9, 0), (3, "b", 3, 0),
          (4, "a", 2, 1), (5, "b", 12, 1), (6, "a", 4, 1), (7, None, 6, 1),
          (8, "a", 0, 2), (9, "b", 30, 2), (10, "b", 11, 2),
          (11, "a", 8, 3), (12, "b", 29, 3), (13, "b", 60, 3), (14, "a", None, 3)]


def frame(spark, order=(0, 1, 2, 3)):
    data = [(i, k, None if t is None else T0 + t * 1000, order.index(s)) for i, k, t, s in EVENTS]
    df = spark.createDataFrame(data, "event_id long, key string, ms long, slice long")
    return df.select("event_id", "key", F.timestamp_millis("ms").cast("timestamp_ntz").alias("ts"),
                     (F.col("slice") * 1000).alias("arrival_ms"))


def tagged(order, late, bound=5_000):
    """(event_id, watermark, late) by a plain loop over the slices."""
    out, top = [], None
    for s in order:
        wm = None if top is None else top - bound
        batch = [(i, None if t is None else T0 + t * 1000) for i, _, t, at in EVENTS if at == s]
        out += [(i, wm, wm is not None and t is not None and late(t, wm)) for i, t in batch]
        times = [t for _, t in batch if t is not None]
        top = max([*times, *([] if top is None else [top])])
    return sorted(out)


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2), (2, 3, 1, 0)])
@pytest.mark.parametrize("kind", ["row", "window"])
def test_late_rows_are_a_second_output(spark, order, kind):
    path, schema = arrival_feed(frame(spark, order), "arrival_ms", 1000)
    rule = row_is_late("ts_ms") if kind == "row" else window_is_closed("ts_ms", 10_000)
    plain = (lambda t, wm: t < wm) if kind == "row" else (lambda t, wm: t // 10_000 * 10_000 + 9_999 <= wm)
    out = run_bounded(spark, path, schema, Q._with_ms, "t", max_files_per_trigger=1,
                      batch_writer=split_late_batches("ts_ms", 5_000, rule))
    got = out.select("event_id", "wm_ms", (F.col("side") == "late").alias("late"))
    assert sorted(map(tuple, got.collect())) == tagged(order, plain)


def test_a_replayed_batch_gives_the_same_tags(spark):
    """A micro-batch that fails after its rows were written is run again."""
    path, schema = arrival_feed(frame(spark), "arrival_ms", 1000)
    broken = []

    def failing_once(out):
        write = split_late_batches("ts_ms", 5_000, row_is_late("ts_ms"))(out)

        def run(batch, batch_id):
            write(batch, batch_id)
            if batch_id == 2 and not broken:
                broken.append(batch_id)
                raise RuntimeError("lost after writing")
        return run

    base = scratch_path(spark, "replay")
    make = lambda: Q._with_ms(file_stream(spark, path, schema, max_files_per_trigger=1))
    with stream_settings(spark), pytest.raises(Exception, match="lost after writing"):
        _run(spark, base, make, "replay", "append", failing_once, None)
    with stream_settings(spark):
        out = _run(spark, base, make, "replay", "append", failing_once, None)
    got = out.select("event_id", "wm_ms", (F.col("side") == "late").alias("late"))
    assert sorted(map(tuple, got.collect())) == tagged((0, 1, 2, 3), lambda t, wm: t < wm)


def test_a_lost_watermark_stops_the_stream(spark):
    kept = KeptWatermark(spark, scratch_path(spark, "kept"))
    assert kept.before(0) is None
    kept.keep(0, 17)
    kept.keep(0, 99)                                   # a replay leaves the first value
    assert kept.before(1) == 17
    with pytest.raises(RuntimeError, match="missing"):
        kept.before(2)


def lateness_by_loop(order, size, bound, lateness):
    """Every (key, window_end, seq, cnt) by a plain loop over the slices."""
    out, state, top = [], {}, None

    def fire(wm):
        for (k, end), held in state.items():
            if held[0] and not held[1] and (wm is None or wm >= end - 1):
                held[1] = 1
                out.append((k, end, 1, held[0]))

    for s in order:
        wm = None if top is None else top - bound
        if wm is not None:
            fire(wm)
        times = []
        for _, k, t, at in EVENTS:
            if at != s or t is None:
                continue
            t = T0 + t * 1000
            times.append(t)
            end = t // size * size + size
            held = state.setdefault((k, end), [0, 0])
            if wm is None or wm < end - 1:
                held[0] += 1
            elif wm < end - 1 + lateness:
                held[0] += 1
                held[1] += 1
                out.append((k, end, held[1], held[0]))
        top = max([*times, *([] if top is None else [top])])
    fire(None)
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (2, 0, 3, 1)])
def test_allowed_lateness_and_its_state(spark, order):
    path, schema = arrival_feed(frame(spark, order), "arrival_ms", 1000)
    base = scratch_path(spark, "lateness")
    flush = f"{base}/flush"
    spark.createDataFrame([], schema).write.parquet(flush)

    def make():
        s = file_stream(spark, path, schema, max_files_per_trigger=1).unionByName(spark.readStream.schema(schema).parquet(flush))
        counts = V.partial_counts(event_stream(s, "5000 milliseconds"), "key", "ts_ms", 10_000)
        return counts.groupBy("key", "window_start").transformWithState(
            V.LateCounts("key", 10_000, 20_000), "key string, window_end long, seq long, cnt long, is_update boolean", "Append", "EventTime")

    def again():
        (spark.sql("SELECT -1L AS event_id, 'flush' AS `key`, timestamp_ntz'2100-01-01 00:00:00' AS ts, 0L AS arrival_ms, 0L AS slice")
         .write.mode("append").parquet(flush))

    with stream_settings(spark):
        out = _run(spark, base, make, "lateness", "append", None, again)
        assert sorted((tuple(r) for r in out.select("key", "window_end", "seq", "cnt").collect()), key=repr) == lateness_by_loop(
            order, 10_000, 5_000, 20_000)
        assert all(r["is_update"] == (r["seq"] > 1) for r in out.collect())
        # Every window is gone from the state but that of the flush row itself.
        left = read_state(spark, f"{base}/checkpoint", "window").select("key.*").collect()
        assert {r["key"] for r in left} == {"flush"}


def test_cumulative_windows_over_many_batches(spark):
    """The chain of timers fires each step once, whatever order files come in."""
    for order in ((0, 1, 2, 3), (3, 2, 1, 0)):
        path, schema = arrival_feed(frame(spark, order), "arrival_ms", 1000)
        flush = spark.sql("SELECT -1L AS event_id, 'flush' AS `key`, timestamp_ntz'2100-01-01 00:00:00' AS ts, 0L AS arrival_ms, 0L AS slice")

        def build(s):
            counts = V.partial_counts(event_stream(s, "100 seconds"), "key", "ts_ms", 10_000, 2_000)
            return counts.groupBy("key", "window_start").transformWithState(
                V.CumulativeCounts("key", 10_000, 2_000), "key string, window_end long, fire_ms long, cnt long", "Append", "EventTime")
        got = run_bounded(spark, path, schema, build, "cumulative", max_files_per_trigger=1, flush=flush)
        want = []
        times = [(k, T0 + t * 1000) for _, k, t, _ in EVENTS if t is not None]
        for k, start in {(k, t // 10_000 * 10_000) for k, t in times}:
            held = sorted(t for key, t in times if key == k and t // 10_000 * 10_000 == start)
            want += [(k, start + 10_000, fire, sum(t < fire for t in held))
                     for fire in range(start + 2_000, start + 10_001, 2_000) if fire > held[0]]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="multiple"):
        V.CumulativeCounts("key", 10_000, 3_000)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_the_slower_input_holds_the_watermark_back(spark):
    got = Q.stream_union_watermark(spark, SF).collect()
    first = {s: min(r["ts_ms"] for r in got if r["stream"] == s) for s in ("clicks", "views")}
    assert any(r["wm_ms"] is None for r in got) and any(r["wm_ms"] is not None for r in got)
    for r in got:
        if r["wm_ms"] is not None:
            top = {s: max(x["ts_ms"] for x in got if x["stream"] == s) for s in first}
            assert r["wm_ms"] <= min(top.values()) - Q.BOUND


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_windows_on_the_arrival_clock(spark):
    before = int(time.time() * 1000)
    got = Q.proctime_windows(spark, SF).collect()
    assert sum(r["cnt"] for r in got) == spark.read.parquet(f"{SF}/events.parquet").count()
    assert all(r["window_start"] % 10_000 == 0 and r["window_end"] - r["window_start"] == 10_000 for r in got)
    assert all(before - 10_000 <= r["window_start"] <= time.time() * 1000 for r in got)


def test_periodic_watermark_moves_at_ticks(spark):
    """A row behind the bound is taken before the tick and late after it."""
    folder, out = tempfile.mkdtemp(prefix="eventide-ticks-"), scratch_path(spark, "ticks")

    def arrive(name, lines):
        with open(os.path.join(folder, f"_{name}"), "w") as f:
            f.write("".join(f"{k} {t}\n" for k, t in lines))
        os.rename(os.path.join(folder, f"_{name}"), os.path.join(folder, name))

    from eventide.sources.files import read_key_ts_lines
    arrive("1.txt", [("a", 1000), ("early", 900)])           # 100 s behind, in the same tick
    stream = read_key_ts_lines(spark, folder, streaming=True).select("key", "ts_ms")
    q = start_periodic_watermark(stream, "ticks", "ts_ms", out, bound_ms=10_000, window_ms=10_000, trigger="2 seconds")
    try:
        q.processAllAvailable()
        arrive("2.txt", [("late", 985), ("open", 991), ("b", 1001)])
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["key"]: r["side"] for r in spark.read.parquet(out).collect()}
    # After the tick the watermark is 990 s: the window of 985 is closed, that of 991 is not.
    assert got == {"a": "main", "early": "main", "late": "late", "open": "main", "b": "main"}


def test_resumed_run_equals_the_undisturbed_one(spark):
    """Stopped between micro-batches and resumed from the checkpoint."""
    path, schema = arrival_feed(frame(spark), "arrival_ms", 1000)
    counts = {}
    for name, stop_after in (("whole", None), ("resumed", 2)):
        base = scratch_path(spark, f"recovery-{name}")
        seen = []

        def writer(out, seen=seen, stop_after=stop_after):
            def write(batch, batch_id):
                if stop_after is not None and batch_id == stop_after and not seen:
                    seen.append(batch_id)
                    raise RuntimeError("killed")
                batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            return write

        def make():
            s = event_stream(file_stream(spark, path, schema, max_files_per_trigger=1), "1000 seconds")
            return s.groupBy("key").count()
        with stream_settings(spark):
            if stop_after is not None:
                with pytest.raises(Exception, match="killed"):
                    _run(spark, base, make, name, "update", writer, None)
            out = _run(spark, base, make, name, "update", writer, None)
            counts[name] = rows(out.groupBy("key").agg(F.max("count").alias("n")).filter("key is not null"))
            state = spark.read.format("statestore").load(f"{base}/checkpoint").select("key.key", "value.count").filter("key is not null")
            assert rows(state) == counts[name]
    assert counts["whole"] == counts["resumed"] == [("a", 7), ("b", 6)]


def test_top_of_windows_released_in_pieces(spark):
    """Counts of one window that come over several micro-batches rank together."""
    data = [(0, 1, "x", 5), (0, 1, "y", 9), (1, 1, "z", 7), (1, 1, "w", 9), (2, 1, "v", 1), (2, 2, "x", 3), (3, 90, "flush", 1)]
    df = spark.createDataFrame([(b, w * 1000 + T0, i, c) for b, w, i, c in data], "arrival_ms long, window_end long, item string, cnt long")
    path, schema = arrival_feed(df, "arrival_ms", 1)

    def make():
        s = file_stream(spark, path, schema, max_files_per_trigger=1)
        # The windows' ends move the watermark; a delay keeps all pieces of a window in time.
        s = s.withColumn("at", F.timestamp_millis("window_end")).withWatermark("at", "10 seconds").select("window_end", "item", "cnt")
        return s.groupBy("window_end").transformWithState(V.TopOfWindow(3, "item", "string"),
                                                          "window_end long, rank long, item string, cnt long", "Append", "EventTime")
    with stream_settings(spark):
        got = _run(spark, scratch_path(spark, "pieces"), make, "pieces", "append", None, None)
    assert rows(got) == [(T0 + 1000, 1, "w", 9), (T0 + 1000, 2, "y", 9), (T0 + 1000, 3, "z", 7), (T0 + 2000, 1, "x", 3)]


def test_console_sink_of_a_continuous_stream(spark):
    path, schema = arrival_feed(frame(spark), "arrival_ms", 1000)
    q = start_continuous(file_stream(spark, path, schema), "printed", sink="console", trigger="1 second")
    try:
        q.processAllAvailable()
        assert sum(json.loads(p.json)["numInputRows"] for p in q.recentProgress) == len(EVENTS)
    finally:
        q.stop()


def test_timers_of_a_lane_are_shared(spark):
    """Sensors of a lane that arrive together take one timer and one state entry; each still fires for itself."""
    ids = [f"s{i}" for i in range(200)] + [None]
    df = spark.createDataFrame([(k, b) for k in ids for b in (0, 1)], "id string, slice long")
    path, schema = arrival_feed(df, "slice", 1, "feed-lanes")
    base = scratch_path(spark, "lanes")

    def start(build, seconds):
        time.sleep(seconds)
        s = build(file_stream(spark, path, schema, max_files_per_trigger=1))
        q = (s.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    def build(s):
        lanes = s.select("id", V.lane_of("id", 4).alias("lane")).groupBy("lane")
        return lanes.transformWithState(V.ArrivalTimers("id", 60_000), "id string, waited_ms long", "Append", "ProcessingTime")
    with stream_settings(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
        start(build, 0)
    held = read_state(spark, f"{base}/checkpoint", "arrivals").collect()
    # Two arrivals of four lanes, not of 201 sensors.
    assert len(held) <= 8
    assert sorted((k or "") for r in held for k in r["user_map_value"]["keys"]) == sorted(2 * [k or "" for k in ids])
