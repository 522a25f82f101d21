"""Keyed state and timers on bounded input.

Batch twins of keyed process functions.  Event-time timers follow one rule:
a timer at T fires before the first row of its key with ts > T (rows at
exactly T are processed first), and every pending timer fires at the end of
the input.  Per-key order is (ts, tie).

Per-key ordered facts (positions, previous values, run ids) come from
``keyed_scan`` and never put a whole key into one task.  The two timer
chains (I3 alerts while values rise, I4 rounds of a list state) are sequential
by nature -- the next timer depends on when the previous one fired -- but only
the pending time crosses a bucket; ``chains`` follows it over small functions
of the buckets, so no task holds more than one bucket of a key.  Only the
columns the chain needs cross to Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.operators.chains import timer_chains
from eventide.operators.joins import point_range_join
from eventide.operators.sequence import DEFAULT_BUCKET_MS, DEFAULT_TARGET_ROWS, keyed_scan

# Rows of a (key, bucket) that a timer chain walks in one Python call, and
# delays in its bucket.
CHAIN_ROWS = 500_000
CHAIN_DELAYS = 16


def changelog_count(df: DataFrame, key: str, ts_ms: str, tie: str, bucket_ms: int = DEFAULT_BUCKET_MS,
                    target_rows: int | None = DEFAULT_TARGET_ROWS) -> DataFrame:
    """The retract stream of ``SELECT key, COUNT(*) GROUP BY key``.

    Each input row (position ``seq`` in its key) emits ``(false, seq-1)``
    retracting the previous count when there is one, then ``(true, seq)``.
    Output: key, seq, is_add, cnt.
    """
    s = keyed_scan(df.select(key, ts_ms, tie), [key], ts_ms, tie, sums={"seq": F.lit(1)},
                   bucket_ms=bucket_ms, target_rows=target_rows)
    msgs = F.array(
        F.struct(F.lit(True).alias("is_add"), F.col("seq").alias("cnt")),
        F.when(F.col("seq") > 1, F.struct(F.lit(False).alias("is_add"), (F.col("seq") - 1).alias("cnt"))))
    return (s.select(key, "seq", F.explode(F.filter(msgs, lambda m: m.isNotNull())).alias("m"))
             .select(key, "seq", "m.is_add", "m.cnt"))


def timer_deadlines(df: DataFrame, key: str, ts_ms: str, delay_ms: int) -> DataFrame:
    """One timer per row at ts + delay; timers are unique per (key, time)."""
    return df.select(key, (F.col(ts_ms) + F.lit(delay_ms)).alias("fire_ms")).distinct()


def rising_alerts(df: DataFrame, key: str, value: str, ts_ms: str, tie: str, delay_ms: int,
                  bucket_ms: int = DEFAULT_BUCKET_MS) -> DataFrame:
    """Alert when a key's value keeps rising (no drop) for ``delay_ms``.

    A row above the previous value arms a timer at ts + delay unless one is
    pending; a row below the previous value (or the key's first row)
    cancels it; an equal value does neither.  A fired timer clears itself,
    so the next rise re-arms.  Output: key, alert_ms.
    """
    base = df.select(key, value, ts_ms, tie)
    s = keyed_scan(base, [key], ts_ms, tie, lags=[value], bucket_ms=_chain_bucket(bucket_ms, delay_ms),
                   target_rows=CHAIN_ROWS, keep_bucket=True)
    prev = F.col(f"prev_{value}")
    rows = s.select(key, "_b", F.col(ts_ms).alias("ts_ms"), F.col(tie).alias("tie"),
                    F.coalesce(F.col(value) > prev, F.lit(False)).alias("arms"),
                    (prev.isNull() | F.coalesce(F.col(value) < prev, F.lit(False))).alias("resets"))
    alerts = timer_chains(rows.filter("arms or resets"), key, delay_ms)
    return alerts.withColumnRenamed("fire_ms", "alert_ms")


def list_state_rounds(df: DataFrame, key: str, ts_ms: str, tie: str, period_ms: int,
                      bucket_ms: int = DEFAULT_BUCKET_MS) -> DataFrame:
    """I4: rows accumulate in never-cleared list state; the first row while no
    timer is pending sets one at ts + period; when it fires the key emits how
    many rows it has stored so far.  Output: key, fire_ms, cnt."""
    base = df.select(key, ts_ms, tie)
    s = keyed_scan(base, [key], ts_ms, tie, sums={"n": F.lit(1)}, bucket_ms=_chain_bucket(bucket_ms, period_ms),
                   target_rows=CHAIN_ROWS, keep_bucket=True)
    rows = s.select(key, "_b", F.col(ts_ms).alias("ts_ms"), F.col(tie).alias("tie"), F.lit(True).alias("arms"),
                    F.lit(False).alias("resets"), "n")
    return timer_chains(rows, key, period_ms, count="n")


def _chain_bucket(bucket_ms: int, delay_ms: int) -> int:
    """Buckets several delays long keep their exit functions small."""
    return max(bucket_ms, CHAIN_DELAYS * delay_ms)


def order_timeouts(orders: DataFrame, key: str, ts_ms: str, type_col: str, within_ms: int,
                   create: str = "create", bucket_ms: int | None = None):
    """(paid, timed out).  Every non-create event is reported as paid;
    a create times out when no other event of its key follows in
    (ts, ts + within] (a payment exactly at the deadline still counts)."""
    paid = orders.filter(F.col(type_col) != create)
    creates = orders.filter(F.col(type_col) == create)
    pays = paid.select(F.col(key).alias("_pk"), F.col(ts_ms).alias("_pts"))
    timeouts = point_range_join(creates, pays, [(key, "_pk")], ts_ms,
                                F.col("_pts") - F.lit(within_ms), F.col("_pts"),
                                bucket_ms or within_ms, how="left_anti", hi_inclusive=False)
    return paid, timeouts.withColumn("deadline_ms", F.col(ts_ms) + F.lit(within_ms))
