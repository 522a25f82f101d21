"""Joins (G1-G5, J1).

Time-range joins are written as an equi-join on (key, time bucket) plus the
exact range predicate.  The side holding ranges is exploded into the
buckets its range touches; the side holding points keeps one bucket.  With
buckets about as wide as the ranges, each range touches at most two or three
buckets, so the equi-join finds every candidate pair exactly once while a
hot key is spread over as many tasks as it has buckets, and the residual
range check inside a task compares only rows of neighbouring times rather
than all rows of the key.  Semi and anti joins keep the point side, so each
of its rows is tested once.  Where the length of ranges is data (a switch's
duration) the longest one is looked at first.  Beyond ``MAX_BUCKETS`` buckets
no range is exploded: a point lies in one of its key's ranges if the greatest
end of those begun so far is still to come, which is a keyed scan.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.functions.time import epoch_ms, floor_div
from eventide.operators.sequence import keyed_scan
from eventide.operators.windows import window_col

# Buckets that one range of a gate may be exploded over.
MAX_BUCKETS = 32


def point_range_join(points: DataFrame, ranges: DataFrame,
                     keys: Sequence[tuple[str, str]], point_ms: str,
                     lo_ms: Column, hi_ms: Column, bucket_ms: int,
                     how: str = "inner", hi_inclusive: bool = True) -> DataFrame:
    """Join rows of ``points`` to rows of ``ranges`` with equal keys and
    ``lo <= point <= hi`` (``< hi`` when ``hi_inclusive`` is false).

    ``how`` is inner, left_semi or left_anti (left = ``points``).  Key and
    column names of the two sides must not collide except for the key pairs,
    which may share a name.
    """
    r = ranges.withColumn("_lo", lo_ms).withColumn("_hi", hi_ms)
    r = r.withColumn("_b", F.explode(F.sequence(floor_div(F.col("_lo"), bucket_ms),
                                                floor_div(F.col("_hi"), bucket_ms))))
    rk = []
    for i, (_, rc) in enumerate(keys):
        r = r.withColumn(f"_rk{i}", F.col(rc))
        rk.append(f"_rk{i}")
    r = r.drop(*{rc for _, rc in keys})
    if how != "inner":
        r = r.select(*rk, "_b", "_lo", "_hi")
    p = points.withColumn("_pb", floor_div(F.col(point_ms), bucket_ms))
    cond = [p[lc] == r[f"_rk{i}"] for i, (lc, _) in enumerate(keys)]
    cond.append(p["_pb"] == r["_b"])
    cond.append(p[point_ms] >= r["_lo"])
    cond.append(p[point_ms] <= r["_hi"] if hi_inclusive else p[point_ms] < r["_hi"])
    out = p.join(r, on=cond, how=how)
    drop = ["_pb", "_b", "_lo", "_hi", *rk]
    return out.drop(*[d for d in drop if d in out.columns])


def window_join(left: DataFrame, right: DataFrame, key: str, size, ts: str = "ts",
                left_cols: Sequence[str] = (), right_cols: Sequence[str] = ()) -> DataFrame:
    """G1: inner join of rows with the same key in the same tumbling window.

    Output: key, window_end (ms), then the chosen columns of each side
    (pass them already renamed so they do not collide).
    """
    lw = left.select(key, window_col(size, ts=ts).alias("w"), *left_cols)
    rw = right.select(key, window_col(size, ts=ts).alias("w"), *right_cols)
    dtype = left.schema[ts].dataType
    from pyspark.sql import types as T
    ltz = dtype if isinstance(dtype, T.TimestampType) else None
    j = lw.join(rw, on=[key, "w"], how="inner")
    return j.select(key, epoch_ms(F.col("w.end"), ltz).alias("window_end"), *left_cols, *right_cols)


def interval_join(left: DataFrame, right: DataFrame, key: str, lower_ms: int, upper_ms: int,
                  left_ts_ms: str, right_ts_ms: str, bucket_ms: int | None = None) -> DataFrame:
    """Same key and ``right.ts`` in ``[left.ts + lower, left.ts + upper]``
    (both ends inclusive).  The right side's key column must be named
    differently or equal to ``key``; right columns must not collide."""
    b = bucket_ms or max(upper_ms - lower_ms, 1)
    return point_range_join(right, left, [(key, key)], right_ts_ms,
                            F.col(left_ts_ms) + F.lit(lower_ms), F.col(left_ts_ms) + F.lit(upper_ms), b)


def reconcile(orders: DataFrame, pays: DataFrame, key: str, tolerance_ms: int,
              order_ts: str = "order_ts", pay_ts: str = "pay_ts"):
    """Match orders and payments of the same key within +-tolerance.

    Returns (matched pairs, orders without a payment, payments without an
    order).  Sides must use distinct column names apart from ``key``.
    """
    b = max(2 * tolerance_ms, 1)
    pay_r = F.col(pay_ts)
    matched = point_range_join(orders, pays, [(key, key)], order_ts,
                               pay_r - tolerance_ms, pay_r + tolerance_ms, b)
    o_r = F.col(order_ts)
    unmatched_orders = point_range_join(orders, pays, [(key, key)], order_ts,
                                        pay_r - tolerance_ms, pay_r + tolerance_ms, b, how="left_anti")
    unmatched_pays = point_range_join(pays, orders, [(key, key)], pay_ts,
                                      o_r - tolerance_ms, o_r + tolerance_ms, b, how="left_anti")
    return matched, unmatched_orders, unmatched_pays


def gate(readings: DataFrame, switches: DataFrame, key: str, reading_ts: str,
         switch_ts: str, switch_dur: str, bucket_ms: int) -> DataFrame:
    """Keep readings that fall while a switch of their key is on,
    ``switch.ts <= reading.ts < switch.ts + dur`` (each once, as a semi join).

    The longest duration, one number, is read first.  Within ``MAX_BUCKETS``
    buckets this is a left semi range join.  Beyond, a switch stays one row,
    however long it is on: the running maximum of the ends, per key in time
    order, tells whether one is on; switches stand before readings of the same
    time.  Rows without key, time or duration match nothing.
    """
    longest = switches.agg(F.max(switch_dur)).first()[0]
    if longest is None or longest <= MAX_BUCKETS * bucket_ms:
        return point_range_join(readings, switches, [(key, key)], reading_ts,
                                F.col(switch_ts), F.col(switch_ts) + F.col(switch_dur), bucket_ms,
                                how="left_semi", hi_inclusive=False)
    known = lambda *names: functools.reduce(operator.and_, [F.col(c).isNotNull() for c in names])
    points = readings.filter(known(key, reading_ts)).withColumn("_reading", F.lit(1))
    starts = switches.filter(known(key, switch_ts, switch_dur)).select(
        key, F.col(switch_ts).alias(reading_ts), F.lit(0).alias("_reading"), (F.col(switch_ts) + F.col(switch_dur)).alias("_end"))
    seen = keyed_scan(points.unionByName(starts, allowMissingColumns=True), [key], reading_ts, "_reading",
                      maxes={"_until": F.col("_end")}, bucket_ms=bucket_ms)
    return seen.filter((F.col("_reading") == 1) & (F.col("_until") > F.col(reading_ts))).select(*readings.columns)


def union_streams(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
