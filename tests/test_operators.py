"""Operators against brute force / direct simulations of the keyed process
functions, on random input where one key holds a third of the rows and the
time buckets are small (so carries and halos are exercised)."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import rows
from eventide.operators import joins as J
from eventide.operators import late as L
from eventide.operators.patterns import followed_by_within, match_sequence
from eventide.operators.sequence import keyed_scan
from eventide.operators.state import changelog_count, list_state_rounds, rising_alerts

N = 400


def _events(seed=7, n=N):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 9)}"
        out.append((i, key, rnd.randint(0, 200_000), float(rnd.randint(0, 20)), rnd.choice("abc")))
    return out


@pytest.fixture(scope="module")
def ev(spark):
    return spark.createDataFrame(_events(), "id long, key string, ts_ms long, temp double, kind string")


def _by_key(data):
    g = defaultdict(list)
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        g[r[1]].append(r)
    return g


def test_keyed_scan_matches_full_window(ev):
    s = keyed_scan(ev, ["key"], "ts_ms", "id", sums={"n": F.lit(1), "na": F.col("kind") == "a"},
                   lags=["temp"], bucket_ms=5_000)
    got = {r["id"]: (r["n"], r["na"], r["prev_temp"]) for r in s.collect()}
    for _, rs in _by_key(_events()).items():
        na = 0
        for pos, r in enumerate(rs):
            na += r[4] == "a"
            assert got[r[0]] == (pos + 1, na, rs[pos - 1][3] if pos else None)


def test_keyed_scan_splits_hot_buckets(ev):
    """A tiny row target forces quantile cuts inside buckets; results are unchanged."""
    s = keyed_scan(ev, ["key"], "ts_ms", "id", sums={"n": F.lit(1)}, lags=["temp"], bucket_ms=50_000,
                   target_rows=5)
    got = {r["id"]: (r["n"], r["prev_temp"]) for r in s.collect()}
    for _, rs in _by_key(_events()).items():
        for pos, r in enumerate(rs):
            assert got[r[0]] == (pos + 1, rs[pos - 1][3] if pos else None)


def test_changelog(ev):
    out = changelog_count(ev, "key", "ts_ms", "id", bucket_ms=5_000)
    expect = []
    for k, rs in _by_key(_events()).items():
        for pos in range(1, len(rs) + 1):
            expect.append((k, pos, True, pos))
            if pos > 1:
                expect.append((k, pos, False, pos - 1))
    assert rows(out, "key", "seq", "is_add", "cnt") == sorted(expect)


def test_range_joins_brute_force(ev, spark):
    data = _events()
    left = ev.select("key", F.col("id").alias("lid"), F.col("ts_ms").alias("lts"))
    right = ev.filter("kind = 'a'").select("key", F.col("id").alias("rid"), F.col("ts_ms").alias("rts"))
    out = J.interval_join(left, right, "key", -3_000, 2_000, "lts", "rts", bucket_ms=1_000)
    expect = sorted((a[0], b[0]) for a in data for b in data
                    if b[4] == "a" and a[1] == b[1] and a[2] - 3000 <= b[2] <= a[2] + 2000)
    assert rows(out, "lid", "rid") == expect
    sw = ev.filter("kind = 'b'").select("key", F.col("ts_ms").alias("sw_ts"),
                                        (F.col("temp") * 500).cast("long").alias("dur_ms"))
    gated = J.gate(ev.select("id", "key", "ts_ms"), sw, "key", "ts_ms", "sw_ts", "dur_ms", bucket_ms=2_000)
    expect = sorted(a[0] for a in data if any(b[4] == "b" and b[1] == a[1] and b[2] <= a[2] < b[2] + int(b[3] * 500)
                                              for b in data))
    assert sorted(r["id"] for r in gated.collect()) == expect
    scanned = J.gate(ev.select("id", "key", "ts_ms"), sw, "key", "ts_ms", "sw_ts", "dur_ms", bucket_ms=10)
    assert sorted(r["id"] for r in scanned.collect()) == expect


@pytest.mark.parametrize("bucket_ms", [1_000, 10 ** 13])
def test_gate_of_long_and_tied_switches(spark, bucket_ms):
    """A switch may be on for any number of buckets; ends are exclusive, starts
    inclusive; a shorter later switch does not end a longer one.  By the scan
    and, in wide buckets, by the join."""
    readings = spark.createDataFrame(
        [(1, "a", 999), (2, "a", 1_000), (3, "a", 5_000), (3, "a", 5_000), (4, "a", 10 ** 13), (5, "a", 10 ** 13 + 1_000),
         (6, "b", 2_000), (7, "b", 2_010), (8, None, 2_000), (9, "b", None), (10, "c", 5)], "id int, key string, ts_ms long")
    switches = spark.createDataFrame(
        [("a", 1_000, 10 ** 13), ("a", 1_500, 10), ("b", 2_000, 10), ("b", 2_020, -50), (None, 0, 10 ** 13), ("c", 5, None),
         ("c", None, 7), ("c", 5, 0)], "key string, sw_ts long, dur_ms long")
    out = J.gate(readings, switches, "key", "ts_ms", "sw_ts", "dur_ms", bucket_ms=bucket_ms)
    assert out.columns == readings.columns
    assert sorted(r["id"] for r in out.collect()) == [2, 3, 3, 4, 6]
    none = J.gate(readings, switches.limit(0), "key", "ts_ms", "sw_ts", "dur_ms", bucket_ms=bucket_ms)
    assert none.collect() == []


@pytest.mark.parametrize("target", [None, 3])
def test_running_maxima(ev, target):
    """Running maxima over hot buckets that are cut again."""
    from eventide.operators.sequence import keyed_scan
    out = keyed_scan(ev.select("id", "key", "ts_ms", "temp"), ["key"], "ts_ms", "id",
                     maxes={"top": F.when(F.col("temp") > 1, F.col("temp"))}, bucket_ms=7_000, target_rows=target)
    top, expect = {}, []
    for a in sorted(_events(), key=lambda a: (a[2], a[0])):
        if a[3] > 1:
            top[a[1]] = max(top.get(a[1], a[3]), a[3])
        expect.append((a[0], top.get(a[1])))
    assert sorted((r["id"], r["top"]) for r in out.collect()) == sorted(expect)


@pytest.mark.parametrize("bucket_ms,target", [(10_000, None), (1_000, None), (50_000, 5)])
def test_match_sequence_buckets(ev, bucket_ms, target):
    steps = [F.col("kind") == "a", F.col("kind") == "b", F.col("kind") == "a"]
    m = match_sequence(ev, ["key"], "ts_ms", "id", steps, 9_000, ["id"], bucket_ms=bucket_ms, target_rows=target)
    got = sorted(r["step0"]["id"] for r in m.collect())
    expect = []
    for rs in _by_key(_events()).values():
        for i in range(len(rs) - 2):
            a, b, c = rs[i], rs[i + 1], rs[i + 2]
            if (a[4], b[4], c[4]) == ("a", "b", "a") and c[2] - a[2] < 9_000:
                expect.append(a[0])
    assert got == sorted(expect)
    mt, to = followed_by_within(ev, ["key"], "ts_ms", "id", F.col("kind") == "a", F.col("kind") == "b",
                                4_000, ["id"], bucket_ms=bucket_ms, target_rows=target)
    exp_m, exp_t = [], []
    for rs in _by_key(_events()).values():
        for i, r in enumerate(rs):
            if r[4] != "a":
                continue
            nxt = rs[i + 1] if i + 1 < len(rs) else None
            if nxt is None or nxt[2] - r[2] >= 4_000:
                exp_t.append(r[0])
            elif nxt[4] == "b":
                exp_m.append(r[0])
    assert sorted(r["first"]["id"] for r in mt.collect()) == sorted(exp_m)
    assert sorted(r["id"] for r in to.collect()) == sorted(exp_t)


def _sim_rising(rs, delay):
    out, last, timer = [], None, None
    for r in rs:
        ts, temp = r[2], r[3]
        if timer is not None and ts > timer:
            out.append(timer)
            timer = None
        prev, last = last, temp
        if prev is None or temp < prev:
            timer = None
        elif temp > prev and timer is None:
            timer = ts + delay
    if timer is not None:
        out.append(timer)
    return out


@pytest.mark.parametrize("seed", [7, 11, 23])
def test_rising_alerts_simulation(spark, seed):
    data = _events(seed)
    ev = spark.createDataFrame(data, "id long, key string, ts_ms long, temp double, kind string")
    got = rows(rising_alerts(ev, "key", "temp", "ts_ms", "id", 3_000, bucket_ms=5_000), "key", "alert_ms")
    expect = sorted((k, a) for k, rs in _by_key(data).items() for a in _sim_rising(rs, 3_000))
    assert got == expect


def _sim_rounds(rs, period):
    out, n, timer = [], 0, None
    for r in rs:
        if timer is not None and r[2] > timer:
            out.append((timer, n))
            timer = None
        n += 1
        if timer is None:
            timer = r[2] + period
    if timer is not None:
        out.append((timer, n))
    return out


def test_list_state_rounds_simulation(ev):
    got = rows(list_state_rounds(ev, "key", "ts_ms", "id", 4_000, bucket_ms=5_000), "key", "fire_ms", "cnt")
    expect = sorted((k, t, n) for k, rs in _by_key(_events()).items() for t, n in _sim_rounds(rs, 4_000))
    assert got == expect


def _arrivals(data):  # noqa: D401
    # arrival = ts + pseudo-random delay up to 3 s; order by (arrival, id)
    return sorted(((r[2] + (r[0] * 7919 % 3000), r[0], r[1], r[2]) for r in data))


def test_watermark_and_late_split(ev):
    data = _events()
    x = ev.withColumn("arrival_ms", F.col("ts_ms") + F.col("id") * 7919 % 3000)
    got = {r["id"]: (r["wm_ms"], r["is_late"]) for r in
           L.split_late(x, "arrival_ms", "id", "ts_ms", 1_000, bucket_ms=2_000).collect()}
    mx = None
    for arr, i, key, ts in _arrivals(data):
        wm = None if mx is None else mx - 1_000
        assert got[i] == (wm, wm is not None and ts < wm)
        mx = ts if mx is None else max(mx, ts)


def test_running_max_with_cut_arrival_buckets(ev):
    x = ev.withColumn("arrival_ms", F.col("ts_ms") + F.col("id") * 7919 % 3000)
    out = L.running_max_before(x, "arrival_ms", "id", {"m": F.col("ts_ms")}, bucket_ms=20_000, target_rows=7)
    got = {r["id"]: r["m"] for r in out.collect()}
    mx = None
    for arr, i, key, ts in _arrivals(_events()):
        assert got[i] == mx
        mx = ts if mx is None else max(mx, ts)


def _sim_lateness(data, size, bound, lateness):
    state, out, wm, mx = {}, [], None, None
    for arr, i, key, ts in _arrivals(data):
        end = ts // size * size + size
        if not (wm is not None and end - 1 + lateness <= wm):
            st = state.setdefault((key, end), {"n": 0, "fired": False, "seq": 0})
            st["n"] += 1
            if st["fired"] or (wm is not None and end - 1 <= wm):
                st["seq"] += 1
                st["fired"] = True
                out.append((key, end, st["seq"], st["n"]))
        mx = ts if mx is None else max(mx, ts)
        if wm is None or mx - bound > wm:
            wm = mx - bound
            for (k, e), st in sorted(state.items()):
                if not st["fired"] and e - 1 <= wm:
                    st["seq"] += 1
                    st["fired"] = True
                    out.append((k, e, st["seq"], st["n"]))
    for (k, e), st in sorted(state.items()):
        if not st["fired"]:
            out.append((k, e, 1, st["n"]))
    return sorted(out)


@pytest.mark.parametrize("seed", [7, 11, 23])
def test_allowed_lateness_simulation(spark, seed):
    data = _events(seed)
    ev = spark.createDataFrame(data, "id long, key string, ts_ms long, temp double, kind string")
    x = ev.withColumn("arrival_ms", F.col("ts_ms") + F.col("id") * 7919 % 3000)
    out = L.allowed_lateness_counts(x, "key", "arrival_ms", "id", "ts_ms", 5_000, 500, 1_000, bucket_ms=2_000)
    assert rows(out, "key", "window_end", "seq", "cnt") == _sim_lateness(data, 5_000, 500, 1_000)


def test_cumulative_window_brute_force(ev):
    out = L.cumulative_window_count(ev, "key", "ts_ms", 10_000, 1_000)
    expect = []
    data = _events()
    for k in {r[1] for r in data}:
        for ws in {r[2] // 10_000 * 10_000 for r in data if r[1] == k}:
            in_w = [r[2] for r in data if r[1] == k and ws <= r[2] < ws + 10_000]
            for j in range(1, 11):
                t = ws + j * 1_000
                if t > min(in_w):
                    expect.append((k, ws + 10_000, t, sum(1 for x in in_w if x < t)))
    assert rows(out, "key", "window_end", "fire_ms", "cnt") == sorted(expect)
