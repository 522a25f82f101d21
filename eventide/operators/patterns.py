"""Contiguous event patterns per key with a time limit (H1, H2).

A pattern ``e0, e1, ..., e{k-1}`` of strictly consecutive events of one key
needs, for each anchor, only its next k-1 events.  Rows are partitioned by
(key, time bucket) -- a hot bucket is cut again at ts quantiles -- and
``lead`` runs inside each partition.  The last k-1 rows of a bucket take
their followers from a small carry table: the first k-1 rows of every
bucket, shifted back over the key's following buckets.  A hot key is spread
over its buckets, no row is copied, and the followers are exact however far
apart the events are.

Semantics (strict contiguity, skip-none, exclusive time limit):
* a match needs every step's predicate on the anchor's 0..k-1 next events
  and ``ts_last - ts_first < within``;
* a partial match after the first step times out at ``ts_first + within``
  when the key's next event is absent or not earlier than that deadline;
  it is discarded without timeout when the next event arrives in time but
  fails the next predicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.operators.sequence import DEFAULT_TARGET_ROWS, key_struct, time_buckets


def with_following(df: DataFrame, keys: Sequence[str], ts_ms: str, tie: str,
                   cols: Sequence[str], n: int, within_ms: int,
                   bucket_ms: int | None = None, target_rows: int | None = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add ``next{i}`` structs (i = 1..n) of ``cols`` + ts: the i-th next
    event of the row's key in (ts, tie) order, null past the key's last row.

    Rows are partitioned by (key, time bucket) -- hot buckets are cut at ts
    quantiles -- and ``lead`` runs inside each bucket.  The last ``n`` rows
    of a bucket take their followers from a small carry: every bucket's
    first ``n`` rows, shifted back over the following buckets of the key.
    """
    if n == 0:
        return df
    b = bucket_ms or max(8 * within_ms, 1)
    fields = list(dict.fromkeys([*cols, ts_ms]))
    x = time_buckets(df, keys, ts_ms, b, target_rows).withColumn("_key", key_struct(keys))
    w = Window.partitionBy("_key", "_b").orderBy(ts_ms, tie)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = (x.withColumn("_row", F.struct(*[F.col(c) for c in fields]))
          .withColumn("_rn", F.row_number().over(w))
          .withColumn("_m", F.count(F.lit(1)).over(whole)))
    for i in range(1, n + 1):
        x = x.withColumn(f"_in{i}", F.lead("_row", i).over(w))
    # Each bucket's first n rows (at most n per bucket are collected).
    heads = (x.filter(F.col("_rn") <= n).groupBy("_key", "_b")
              .agg(F.sort_array(F.collect_list(F.struct("_rn", "_row"))).alias("_h")))
    heads = heads.withColumn("_h", F.transform("_h", lambda e: e["_row"]))
    wk = Window.partitionBy("_key").orderBy("_b")
    empty = F.array().cast(heads.schema["_h"].dataType)
    following = [F.coalesce(F.lead("_h", j).over(wk), empty) for j in range(1, n + 1)]
    carries = heads.select("_key", "_b", F.slice(F.concat(*following), 1, n).alias("_next"))
    j = x.join(carries, on=["_key", "_b"], how="inner")
    for i in range(1, n + 1):
        spill = F.try_element_at("_next", (F.col("_rn") + i - F.col("_m")).cast("int"))
        j = j.withColumn(f"next{i}", F.when(F.col("_rn") + i <= F.col("_m"), F.col(f"_in{i}"))
                         .otherwise(spill))
    return j.drop("_key", "_b", "_row", "_rn", "_m", "_next", *[f"_in{i}" for i in range(1, n + 1)])


def match_sequence(df: DataFrame, keys: Sequence[str], ts_ms: str, tie: str,
                   steps: Sequence[Column], within_ms: int, cols: Sequence[str],
                   bucket_ms: int | None = None, target_rows: int | None = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Rows anchoring a match of ``steps`` (boolean expressions over a row).

    Output: keys, then ``step0 .. step{k-1}`` structs of ``cols`` + ts.
    """
    k = len(steps)
    x = df
    for i, s in enumerate(steps):
        x = x.withColumn(f"_p{i}", F.coalesce(s, F.lit(False)))
    flags = [f"_p{i}" for i in range(k)]
    f = with_following(x, keys, ts_ms, tie, [*cols, *flags], k - 1, within_ms, bucket_ms, target_rows)
    cond = F.col("_p0")
    for i in range(1, k):
        cond = cond & F.coalesce(F.col(f"next{i}._p{i}"), F.lit(False))
    if k > 1:
        cond = cond & ((F.col(f"next{k - 1}.{ts_ms}") - F.col(ts_ms)) < within_ms)
    step0 = F.struct(*[F.col(c) for c in dict.fromkeys([*cols, ts_ms])]).alias("step0")
    later = [F.struct(*[F.col(f"next{i}.{c}").alias(c) for c in dict.fromkeys([*cols, ts_ms])])
             .alias(f"step{i}") for i in range(1, k)]
    return f.filter(cond).select(*keys, step0, *later)


def followed_by_within(df: DataFrame, keys: Sequence[str], ts_ms: str, tie: str,
                       first: Column, second: Column, within_ms: int, cols: Sequence[str],
                       bucket_ms: int | None = None,
                       target_rows: int | None = DEFAULT_TARGET_ROWS) -> tuple[DataFrame, DataFrame]:
    """H2: ``first`` immediately followed by ``second`` within the limit.

    Returns (matches, timeouts).  Matches carry ``first``/``second`` structs;
    timeouts carry the first event and ``deadline_ms = ts + within``.
    """
    x = df.withColumn("_p0", F.coalesce(first, F.lit(False))) \
          .withColumn("_p1", F.coalesce(second, F.lit(False)))
    f = with_following(x, keys, ts_ms, tie, [*cols, "_p1"], 1, within_ms, bucket_ms, target_rows)
    anchors = f.filter("_p0")
    in_time = F.col("next1").isNotNull() & ((F.col(f"next1.{ts_ms}") - F.col(ts_ms)) < within_ms)
    fields = list(dict.fromkeys([*cols, ts_ms]))
    matches = anchors.filter(in_time & F.col("next1._p1")).select(
        *keys,
        F.struct(*[F.col(c) for c in fields]).alias("first"),
        F.struct(*[F.col(f"next1.{c}").alias(c) for c in fields]).alias("second"))
    timeouts = anchors.filter(~in_time).select(
        *keys, *[c for c in fields if c not in keys],
        (F.col(ts_ms) + F.lit(within_ms)).alias("deadline_ms"))
    return matches, timeouts
