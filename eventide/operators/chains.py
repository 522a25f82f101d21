"""Timer chains over buckets: the next timer depends on when the last one fired.

A chain walks a key's rows in order: while no timer is pending, an arming row
sets one at ts + delay; a reset row up to that time cancels it; otherwise it
fires before the first later row, and the next arming row sets the next.  What
crosses from one bucket of the key to the next is only the pending time.  So:

1. each (key, bucket) works out, in its own task, its exit as a function of
   its entry: constant between the bucket's first rows, as far as a timer set
   before the bucket can reach (one delay), and merged where equal;
2. per key, these small functions are followed in bucket order, one row at a
   time with one number of state, which gives every bucket's entry;
3. each (key, bucket) replays its rows from its known entry, in its own task.

No task holds more rows than one bucket.  Alerts pending at the key's end fire.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from eventide.operators.grouped import group_bounds, map_sorted_groups
from eventide.operators.sequence import key_struct
from eventide.session import cut_lineage

NO_TIMER = -(1 << 62)
# Exit that equals the entry: no row of the bucket is later than the timer.
UNCHANGED = NO_TIMER + 1


def _following(flag: np.ndarray) -> np.ndarray:
    """For each place (and the end) the first place at or after it with the flag."""
    n = len(flag)
    at = np.where(flag, np.arange(n), n)
    return np.append(np.minimum.accumulate(at[::-1])[::-1], n) if n else np.zeros(1, np.int64)


def exits_without_timer(ts: np.ndarray, arms: np.ndarray, resets: np.ndarray, delay: int) -> np.ndarray:
    """Pending time at the end when the walk stands before each row (and after
    the last) without a timer."""
    n = len(ts)
    next_arm, next_reset = _following(arms).tolist(), _following(resets).tolist()
    after = np.searchsorted(ts, ts + delay, side="right").tolist()
    times = ts.tolist()
    out = [NO_TIMER] * (n + 2)
    for i in range(n - 1, -1, -1):
        k = next_arm[i]
        if k == i:
            r, j = next_reset[k + 1], after[k]
            out[i] = out[r + 1] if r < j else (times[k] + delay if j == n else out[j])
        else:
            out[i] = out[k]
    return np.array(out[:n + 1], np.int64)


def exit_function(ts: np.ndarray, arms: np.ndarray, resets: np.ndarray, delay: int) -> tuple[list[int], list[int]]:
    """(cuts, exits): the exit for an entry T is exits[number of cuts <= T]; for
    no timer it is exits[0]."""
    n = len(ts)
    out = exits_without_timer(ts, arms, resets, delay)
    first_reset = int(_following(resets)[0])
    steps = min(first_reset + 1, n, int(np.searchsorted(ts, ts[0] + delay, side="right")))
    # After ``j`` rows up to T: the first reset among them cancels, else T fires.
    values = [int(out[j]) for j in range(steps + 1)]
    if steps == first_reset + 1:
        values[steps] = int(out[first_reset + 1])
    elif steps == n:
        values[n] = UNCHANGED
    cuts, exits = [], [values[0]]
    for t, v in zip(ts[:steps].tolist(), values[1:], strict=True):
        if cuts and cuts[-1] == t:            # rows of one time are passed together
            exits[-1] = v
        else:
            cuts.append(t)
            exits.append(v)
    keep = [i for i in range(len(cuts)) if exits[i + 1] != exits[i]]
    return [cuts[i] for i in keep], [exits[0], *(exits[i + 1] for i in keep)]


def replay(ts: np.ndarray, arms: np.ndarray, resets: np.ndarray, delay: int, entry: int) -> tuple[list[tuple[int, int]], int]:
    """[(fire time, rows of the bucket before it)] from a known entry, and the exit."""
    n, i, due, fired = len(ts), 0, entry, []
    next_arm, next_reset = _following(arms), _following(resets)
    while True:
        if due == NO_TIMER:
            k = int(next_arm[i])
            if k == n:
                return fired, NO_TIMER
            due, i = int(ts[k]) + delay, k + 1
        j, r = max(i, int(np.searchsorted(ts, due, side="right"))), int(next_reset[i])
        if r < j:
            due, i = NO_TIMER, r + 1
        elif j == n:
            return fired, due
        else:
            fired.append((due, j))
            due, i = NO_TIMER, j


def timer_chains(rows: DataFrame, key: str, delay_ms: int, count: str | None = None) -> DataFrame:
    """(key, fire_ms[, cnt]) of every timer that fires.

    ``rows``: the key, ``_b`` (bucket, non-decreasing in time), ``ts_ms``, a
    unique ``tie``, booleans ``arms`` and ``resets``, and, with ``count``, a
    running number whose value at the last row before a firing is reported.
    Rows without a time take no part."""
    rows = rows.filter(F.col("ts_ms").isNotNull())
    if count is None:
        rows = rows.withColumn("_n", F.lit(0).cast("long"))
    else:
        rows = rows.withColumn("_n", F.col(count))
    rows = cut_lineage(rows.select(key, "_b", "ts_ms", "tie", "arms", "resets", "_n"))
    kind = rows.schema[key].dataType.simpleString()

    def tables(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        ts, arms, resets = (pdf[c].to_numpy() for c in ("ts_ms", "arms", "resets"))
        made = [exit_function(ts[a:b], arms[a:b], resets[a:b], delay_ms) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        at = bounds[:-1]
        return pd.DataFrame({key: pdf[key].iloc[at].to_numpy(), "_b": pdf["_b"].iloc[at].to_numpy(),
                             "cuts": [m[0] for m in made], "exits": [m[1] for m in made]})

    small = map_sorted_groups(rows, [key, "_b"], ["ts_ms", "tie"], tables, f"{key} {kind}, _b bigint, cuts array<bigint>, exits array<bigint>")

    def follow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        due, held = NO_TIMER, None                 # the last bucket seen waits to learn whether it is its key's last
        for pdf in frames:
            if pdf.empty:
                continue
            starts = set(group_bounds(pdf, [key])[:-1].tolist())
            out = []
            for i, (k, b, cuts, exits) in enumerate(zip(pdf[key], pdf["_b"], pdf["cuts"], pdf["exits"], strict=True)):
                fresh = i in starts and (i > 0 or held is None or not _same(k, held[0]))
                if held is not None:
                    out.append((*held, fresh))
                due = NO_TIMER if fresh else due
                held = (k, b, due)
                left = exits[0] if due == NO_TIMER else exits[int(np.searchsorted(cuts, due, side="right"))]
                due = due if left == UNCHANGED else int(left)
            yield _entries(out, key, pdf)
        if held is not None:
            yield _entries([(*held, True)], key, pdf)

    entries = small.repartition(key).sortWithinPartitions(key, "_b").mapInPandas(
        follow, f"{key} {kind}, _b bigint, entry bigint, is_last boolean")
    named = entries.select(key_struct([key]).alias("_key"), F.col("_b"), "entry", "is_last")
    ready = rows.withColumn("_key", key_struct([key])).join(named, ["_key", "_b"]).drop("_key")

    def play(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        ts, arms, resets, n = (pdf[c].to_numpy() for c in ("ts_ms", "arms", "resets", "_n"))
        found = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            fired, left = replay(ts[a:b], arms[a:b], resets[a:b], delay_ms, int(pdf["entry"].iloc[a]))
            found += [(a, t, int(n[a + j - 1]) if j else int(n[a]) - 1) for t, j in fired]
            if left != NO_TIMER and pdf["is_last"].iloc[a]:
                found.append((a, left, int(n[b - 1])))
        at = [f[0] for f in found]
        return pd.DataFrame({key: pdf[key].iloc[at].reset_index(drop=True), "fire_ms": pd.Series([f[1] for f in found], dtype="int64"),
                             "cnt": pd.Series([f[2] for f in found], dtype="int64")})

    out = map_sorted_groups(ready, [key, "_b"], ["ts_ms", "tie"], play, f"{key} {kind}, fire_ms bigint, cnt bigint")
    return out if count is not None else out.drop("cnt")


def _same(a, b) -> bool:
    return (pd.isna(a) and pd.isna(b)) or (not pd.isna(a) and not pd.isna(b) and a == b)


def _entries(rows: list[tuple], key: str, like: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({key: pd.Series([r[0] for r in rows], dtype=like[key].dtype), "_b": pd.Series([r[1] for r in rows], dtype="int64"),
                         "entry": pd.Series([r[2] for r in rows], dtype="int64"), "is_last": pd.Series([bool(r[3]) for r in rows], dtype=bool)})
