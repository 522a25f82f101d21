"""Timer chains in buckets against one walk over the whole key."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.operators import chains as C, state as ST


def simulate(rows, delay):
    """Fire times of one walk over (ts, arms, resets) in order."""
    due, out = None, []
    for ts, arms, resets in rows:
        if due is not None and ts > due:
            out.append(due)
            due = None
        if resets:
            due = None
        elif arms and due is None:
            due = ts + delay
    return out + ([due] if due is not None else [])


ROWS = st.lists(st.tuples(st.integers(0, 60), st.sampled_from(["a", "a", "r", "n"])), min_size=1, max_size=40)


@settings(max_examples=400, deadline=None)
@given(ROWS, st.integers(1, 15), st.integers(1, 25))
def test_buckets_compose(rows, delay, width):
    rows = sorted(rows, key=lambda r: r[0])
    rows = [(t, k == "a", k == "r") for t, k in rows if k != "n"] or [(3, True, False)]
    due, fired = C.NO_TIMER, []
    for b in sorted({t // width for t, _, _ in rows}):
        ts, arms, resets = (np.array(x) for x in zip(*[r for r in rows if r[0] // width == b]))
        cuts, exits = C.exit_function(ts, arms, resets, delay)
        left = exits[0] if due == C.NO_TIMER else exits[int(np.searchsorted(cuts, due, side="right"))]
        got, after = C.replay(ts, arms, resets, delay, due)
        assert after == (due if left == C.UNCHANGED else left)
        assert all(n == int((ts <= t).sum()) for t, n in got)
        fired += [t for t, _ in got]
        due = after
    assert fired + ([due] if due != C.NO_TIMER else []) == simulate(rows, delay)


def test_dense_rounds_stay_within_buckets(spark):
    """A row every 200 ms and a period of 10 s: one stretch without a gap."""
    n = 20_000
    df = spark.range(n).selectExpr("'hot' AS k", "id * 200 AS ts_ms", "id AS event_id")
    got = sorted(tuple(r) for r in ST.list_state_rounds(df, "k", "ts_ms", "event_id", 10_000, bucket_ms=60_000).collect())
    times = simulate([(200 * i, True, False) for i in range(n)], 10_000)
    assert got == [("hot", t, min(n, t // 200 + 1)) for t in times]


def test_a_run_that_rises_forever(spark):
    df = spark.range(5_000).selectExpr("cast(null as string) AS k", "id * 1000 AS ts_ms", "id AS event_id", "cast(id as double) AS v")
    got = sorted(r["alert_ms"] for r in ST.rising_alerts(df, "k", "v", "ts_ms", "event_id", 7_000, bucket_ms=1_000).collect())
    assert got == simulate([(1000 * i, i > 0, i == 0) for i in range(5_000)], 7_000)
