"""Stream twins over many micro-batches equal their batch twins.

The sf0.001 events are split into files by time and streamed one file per
trigger in time order, reversed and shuffled, so state, timers and watermarks
carry across micro-batches and rows come late within the derived delay."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from eventide.functions.time import epoch_ms_of
from eventide.plans import q_streams

SF = "/root/testdata/sf0.001"
PAIRS = {
    "stream_tumble_count": "tumble_count",
    "stream_hot_items_top3": "hot_items_top3",
    "stream_timer_deadlines": "timer_deadlines",
    "stream_rising_run_alert": "rising_run_alert",
    "stream_list_state_ticks": "list_state_ticks",
    "stream_order_timeout_state": "order_timeout_state",
    "stream_order_match": "order_match",
    "stream_login_fail_3": "login_fail_3",
    "stream_gate": "gate",
    "stream_slide_count": "slide_count",
    "stream_uv_incremental": "uv_incremental",
    "stream_group_count": "group_count",
    "stream_window_join": "window_join",
    "stream_interval_join": "interval_join",
    "stream_order_timeout": "order_timeout",
    "stream_reconcile_matched": "reconcile_matched",
    "stream_reconcile_unmatched_orders": "reconcile_unmatched_orders",
    "stream_reconcile_unmatched_pays": "reconcile_unmatched_pays",
    "stream_hot_items_sql": "hot_items_sql",
    "stream_sensor_minmax_tumble": "sensor_minmax_tumble",
    "stream_group_count_updates": "group_count",
    "stream_group_count_changelog": "group_count_changelog",
    "stream_top2": "top2",
}


ORDERS = {"ordered": [0, 1, 2], "reversed": [2, 1, 0], "shuffled": [1, 2, 0]}
# All twins run over the shuffled files, and those that walk rows in order
# over the other orders too.
FEW = {"stream_tumble_count", "stream_rising_run_alert", "stream_order_match", "stream_gate"}
CASES = [(o, n) for o in sorted(ORDERS) for n in sorted(PAIRS) if o == "shuffled" or n in FEW]


@pytest.fixture(scope="module")
def split_dirs(spark):
    return {}


@pytest.fixture
def split_dir(spark, request, split_dirs):
    order = request.param
    if order not in split_dirs:
        split_dirs[order] = _split(spark, order)
    return split_dirs[order]


def _split(spark, order):
    """The events in three time ranges, one file each, written in some order;
    a tenth of the users are negative and a tenth null."""
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    d = tempfile.mkdtemp(prefix="eventide-split-")
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn(
        "user_id", F.when(F.col("event_id") % 10 == 3, -F.col("user_id") - 1).when(F.col("event_id") % 10 != 7, F.col("user_id")))
    ms = epoch_ms_of(ev, "ts")
    bounds = ev.select(F.percentile_approx(ms, [0.35, 0.7], 10000)).collect()[0][0]
    edges = [None, *bounds, None]
    for i in ORDERS[order]:
        lo, hi = edges[i], edges[i + 1]
        part = ev
        if lo is not None:
            part = part.filter(ms >= F.lit(lo))
        if hi is not None:
            part = part.filter(ms < F.lit(hi))
        part.coalesce(1).write.mode("append").parquet(f"{d}/events.parquet")
        time.sleep(0.05)                      # files are picked up in write order
    return d


@pytest.mark.parametrize(("split_dir", "stream_name"), CASES, indirect=["split_dir"])
def test_stream_over_many_batches(spark, split_dir, stream_name, monkeypatch):
    monkeypatch.setattr(q_streams, "MAX_FILES_PER_TRIGGER", 1)
    got = E.queries()[stream_name](spark, split_dir)
    want = E.queries()[PAIRS[stream_name]](spark, split_dir)
    order = lambda df: sorted(map(repr, rows_any(df, sorted(want.columns))))
    assert order(got) == order(want)


def rows_any(df, cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.mark.parametrize("split_dir", ["reversed"], indirect=True)
def test_late_rows_raise(spark, split_dir, monkeypatch):
    """A delay too small for the files fails the run instead of losing rows."""
    monkeypatch.setattr(q_streams, "MAX_FILES_PER_TRIGGER", 1)
    monkeypatch.setattr(q_streams, "bounded_delay", lambda *_: 1)
    with pytest.raises(RuntimeError, match="watermark dropped"):
        E.queries()["stream_tumble_count"](spark, split_dir)



def _events(spark, days):
    """An events table of a file a day: repeated rows, also of the day before, null users, null times, one sensor
    with half of all rows."""
    d = tempfile.mkdtemp(prefix="eventide-own-")
    for day in days:
        rows = [(1000 * day + i, None if i % 11 == 0 else f"2024-01-{day - (i % 50 == 0):02d} {i % 24:02d}:00:00.{i % 7:03d}",
                 None if i % 13 == 0 else 7 if i % 2 else i % 40, "view", float(i), None) for i in range(600)]
        ev = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
        ev.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(f"{d}/events.parquet")
        time.sleep(0.05)
    return d


@pytest.mark.parametrize("days", [(3, 4, 5), (5, 3, 4)])
def test_deadlines_fire_once(spark, monkeypatch, days):
    """F1: lanes hold deadlines over micro-batches and fire each (sensor, time) once."""
    monkeypatch.setattr(q_streams, "MAX_FILES_PER_TRIGGER", 1)
    d = _events(spark, days)
    got = E.queries()["stream_timer_deadlines"](spark, d)
    want = E.queries()["timer_deadlines"](spark, d).filter("fire_ms is not null")
    assert sorted(map(repr, rows_any(got, ["id", "fire_ms"]))) == sorted(map(repr, rows_any(want, ["id", "fire_ms"])))


def test_late_deadlines_raise(spark, monkeypatch):
    """rows behind the watermark are still seen, though the lanes need no event time."""
    monkeypatch.setattr(q_streams, "MAX_FILES_PER_TRIGGER", 1)
    monkeypatch.setattr(q_streams, "bounded_delay", lambda *_: 1)
    with pytest.raises(RuntimeError, match="watermark dropped"):
        E.queries()["stream_timer_deadlines"](spark, _events(spark, (5, 3, 4)))
