"""Continuous stream jobs and the processing-time timer."""

import os
import tempfile
import time

from eventide.sources.files import read_key_ts_lines
from eventide.streaming.jobs import start_continuous
from eventide.streaming.processors import ProcessingTimeDeadline


def test_processing_time_timer_continuous(spark):
    d = tempfile.mkdtemp(prefix="eventide-pt-")
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("sensor_1 1\nsensor_2 2\nsensor_1 3\n")
    s = read_key_ts_lines(spark, d, streaming=True)
    out = s.groupBy("key").transformWithState(ProcessingTimeDeadline("key", 200), "key string, fire_ms long",
                                               "Append", "ProcessingTime")
    start = int(time.time() * 1000)
    q = start_continuous(out, "pt_deadlines", sink="memory", trigger="200 milliseconds")
    try:
        deadline = time.time() + 60
        got = []
        while time.time() < deadline:
            got = spark.table("pt_deadlines").collect()
            if {r["key"] for r in got} == {"sensor_1", "sensor_2"}:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert {r["key"] for r in got} == {"sensor_1", "sensor_2"}
    assert all(r["fire_ms"] >= start + 200 for r in got)


def test_a_bounded_join_keeps_one_store_a_partition(spark):
    """the stores of a stream-stream join stand in one RocksDB, without a row count, and the caller's settings come back."""
    from eventide.streaming.runner import COUNT_ROWS, JOIN_FORMAT, stream_settings

    before = [spark.conf.get(k, None) for k in (JOIN_FORMAT, COUNT_ROWS)]
    with stream_settings(spark):
        assert spark.conf.get(JOIN_FORMAT) == "3"
        assert spark.conf.get(COUNT_ROWS) == "false"
    assert [spark.conf.get(k, None) for k in (JOIN_FORMAT, COUNT_ROWS)] == before


def test_waiting_rows_are_few_state_entries():
    """rows of a micro-batch wait as arrays, not as an entry each, and come back as they were."""
    from eventide.streaming.processors import _ENTRY_ROWS, _entries

    rows = [(None if i % 7 == 0 else i, i, "x" if i % 3 else None) for i in range(2 * _ENTRY_ROWS + 1)]
    entries = _entries(rows)
    assert len(entries) == 3
    assert [r for e in entries for r in zip(*e, strict=True)] == rows


class _Held:
    """A list state and the timers of one key, and how often each was written."""

    def __init__(self):
        self.entries, self.timers, self.calls = [], set(), 0

    def getListState(self, name, schema):
        return self

    def registerTimer(self, t):
        self.calls += 1
        self.timers.add(t)

    def appendList(self, entries):
        self.calls += 1
        self.entries += entries

    def put(self, entries):
        self.calls += 1
        self.entries = list(entries)

    def clear(self):
        self.calls += 1
        self.entries = []

    def get(self):
        return iter(self.entries)


def test_deadlines_of_a_lane_share_a_timer():
    """F1: state calls follow micro-batches and not rows, and each (key, time) fires once, when the watermark has passed it."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

    from eventide.streaming.processors import _ENTRY_ROWS, DeadlineTimers

    n = 2 * _ENTRY_ROWS + 1
    rows = [(None if i % 7 == 0 else f"s{i % 5}", 1000 + i // 2) for i in range(n)]
    want = {(k, t + 10) for k, t in rows}
    held, p = _Held(), DeadlineTimers("id", 10)

    def fired(watermark):
        """What the timers passed by the watermark emit; each is deleted after its call."""
        p.init(held)
        out = []
        for t in sorted(t for t in held.timers if t <= watermark):
            for frame in p.handleExpiredTimer((3,), TimerValues(0, watermark), ExpiredTimerInfo(t)):
                out += [tuple(r) for r in frame.itertuples(index=False)]
            held.timers.discard(t)
        return out

    for part in (rows[n // 2:], rows[:n // 2] + rows[:9]):            # later times first, some rows again
        p.init(held)
        frames = [pd.DataFrame(part[at:at + 1000], columns=["id", "ts_ms"]) for at in range(0, len(part), 1000)]
        assert list(p.handleInputRows((3,), iter(frames), TimerValues(0, 0))) == []
    assert held.timers == {1010 + n // 2 // 2, 1010}
    assert held.calls == 5 + 5 + 2                                    # an append a frame, a timer a micro-batch
    got = []
    for watermark in (1009, 1010, 1500, 1010 + n // 2 // 2 + 7, 1010 + n):
        now = fired(watermark)
        assert all(t <= watermark for _, t in now)
        got += now
        assert {(k, t) for k, t in want if t <= watermark} == set(got)
    assert len(got) == len(want)
    assert held.entries == [] and held.timers == set()
