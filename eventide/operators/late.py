"""Late data, watermarks and early firing on bounded input.

A streaming engine's watermark is global: after each arriving row it is the
largest event time seen so far minus the allowed out-of-orderness.  The batch
twins here need, for every row, the watermark in force when it arrived, i.e.
a running max over *arrival order* across the whole input.

``running_max_before`` computes it in two phases so that no task sees all
rows: rows are bucketed by arrival time (a bucket with too many rows is cut
again at arrival quantiles); the per-bucket maxima (one small row
per bucket) are prefix-maxed in arrival order and joined back; inside each
bucket a window ordered by (arrival, tie) finishes the job.  Only the
per-bucket table -- its size is the arrival span divided by the bucket width,
independent of row count -- is scanned in one partition.

Batch rules (our definition where the streaming engine is timing dependent):
the watermark advances after every row, and a row sees the watermark left by
the rows that arrived strictly before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.functions.time import floor_div
from eventide.operators.sequence import DEFAULT_TARGET_ROWS, key_struct, keyed_scan, time_buckets
from eventide.session import cut_lineage


def running_max_before(df: DataFrame, arrival_ms: str, tie: str, values: Mapping[str, Column],
                       bucket_ms: int = 3_600_000, partition_by: Sequence[str] = (),
                       target_rows: int | None = DEFAULT_TARGET_ROWS) -> DataFrame:
    """For each name in ``values``: max of that expression over all rows that
    arrived strictly earlier (same ``partition_by`` group), null if none."""
    # Arrival buckets; a burst holding too many rows is cut at arrival quantiles.
    x = time_buckets(df, list(partition_by), arrival_ms, bucket_ms, target_rows).withColumnRenamed("_b", "_ab")
    x = x.withColumn("_key", key_struct(partition_by))
    for n, c in values.items():
        x = x.withColumn(f"_v_{n}", c)
    pk = ["_key"]
    stats = x.groupBy(*pk, "_ab").agg(*[F.max(f"_v_{n}").alias(f"_m_{n}") for n in values])
    earlier = Window.partitionBy(*pk).orderBy("_ab").rowsBetween(Window.unboundedPreceding, -1)
    carries = stats.select(*pk, "_ab", *[F.max(f"_m_{n}").over(earlier).alias(f"_c_{n}") for n in values])
    j = x.join(carries, on=[*pk, "_ab"])
    inside = (Window.partitionBy(*pk, "_ab").orderBy(arrival_ms, tie)
              .rowsBetween(Window.unboundedPreceding, -1))
    out = j
    for n in values:
        out = out.withColumn(n, F.greatest(F.col(f"_c_{n}"), F.max(f"_v_{n}").over(inside)))
    return out.drop("_key", "_ab", *[f"_{p}_{n}" for n in values for p in ("v", "c")])


def with_watermark_at_arrival(df: DataFrame, arrival_ms: str, tie: str, ts_ms: str,
                              bound_ms: int, bucket_ms: int = 3_600_000) -> DataFrame:
    """Adds ``wm_ms``: max event time of earlier arrivals minus ``bound_ms``."""
    out = running_max_before(df, arrival_ms, tie, {"_maxts": F.col(ts_ms)}, bucket_ms)
    return out.withColumn("wm_ms", F.col("_maxts") - F.lit(bound_ms)).drop("_maxts")


def split_late(df: DataFrame, arrival_ms: str, tie: str, ts_ms: str, bound_ms: int,
               bucket_ms: int = 3_600_000) -> DataFrame:
    """tag each row ``is_late`` iff its event time is behind the watermark."""
    w = with_watermark_at_arrival(df, arrival_ms, tie, ts_ms, bound_ms, bucket_ms)
    return w.withColumn("is_late", F.coalesce(F.col(ts_ms) < F.col("wm_ms"), F.lit(False)))


def _window_start(ts_ms: str, size_ms: int) -> Column:
    return floor_div(F.col(ts_ms), size_ms) * F.lit(size_ms)


def late_window_split(df: DataFrame, key: str, arrival_ms: str, tie: str, ts_ms: str,
                      size_ms: int, bound_ms: int, bucket_ms: int = 3_600_000):
    """tumbling count per key; rows whose window already closed go aside.

    A row is late iff ``window_end - 1 <= watermark`` when it arrives.
    Returns (counts of on-time rows per key/window, late rows).
    """
    w = with_watermark_at_arrival(df, arrival_ms, tie, ts_ms, bound_ms, bucket_ms)
    w = w.withColumn("window_end", _window_start(ts_ms, size_ms) + F.lit(size_ms))
    late = F.coalesce(F.col("window_end") - 1 <= F.col("wm_ms"), F.lit(False))
    w = w.withColumn("is_late", late)
    counts = (w.filter(~F.col("is_late")).groupBy(key, "window_end")
               .agg(F.count(F.lit(1)).alias("cnt")))
    return counts, w.filter(F.col("is_late"))


def allowed_lateness_counts(df: DataFrame, key: str, arrival_ms: str, tie: str, ts_ms: str,
                            size_ms: int, bound_ms: int, lateness_ms: int,
                            bucket_ms: int = 3_600_000) -> DataFrame:
    """every emission of a tumbling count with allowed lateness.

    The first emission (when the watermark passes the window) counts the
    on-time rows; each later row that arrives while the watermark is below
    ``window_end - 1 + lateness`` re-emits the updated count; rows after that
    are dropped.  Output: key, window_end, seq (1-based), cnt, is_update.
    """
    w = with_watermark_at_arrival(df, arrival_ms, tie, ts_ms, bound_ms, bucket_ms)
    w = w.withColumn("window_end", _window_start(ts_ms, size_ms) + F.lit(size_ms))
    close = F.col("window_end") - 1
    kind = (F.when(F.col("wm_ms").isNull() | (F.col("wm_ms") < close), F.lit(0))
             .when(F.col("wm_ms") < close + lateness_ms, F.lit(1)).otherwise(F.lit(2)))
    # Both branches below read these rows: written once, the watermark is not taken twice.
    w = cut_lineage(w.withColumn("_kind", kind).filter(F.col("_kind") < 2).select(key, "window_end", arrival_ms, tie, "_kind"))
    # On-time count per window: a partial + final aggregate, never one task per window.
    first = (w.filter(F.col("_kind") == 0).groupBy(key, "window_end")
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(key, "window_end", F.lit(1).cast("bigint").alias("seq"), "cnt"))
    # Late-but-allowed rows, numbered per window in arrival order (skew-safe scan).
    late = keyed_scan(w.filter(F.col("_kind") == 1).select(key, "window_end", arrival_ms, tie),
                      [key, "window_end"], arrival_ms, tie, sums={"_k": F.lit(1)}, bucket_ms=bucket_ms)
    late = late.withColumn("_key", key_struct([key, "window_end"]))
    on = first.select(key_struct([key, "window_end"]).alias("_key"), F.col("cnt").alias("_n_on"))
    updates = (late.join(on, on="_key", how="left")
                   .withColumn("_n_on", F.coalesce(F.col("_n_on"), F.lit(0)))
                   .select(key, "window_end",
                           (F.col("_k") + F.when(F.col("_n_on") > 0, 1).otherwise(0)).cast("bigint").alias("seq"),
                           (F.col("_n_on") + F.col("_k")).cast("bigint").alias("cnt")))
    out = first.unionByName(updates)
    return out.withColumn("is_update", F.col("seq") > 1)


def union_watermark(df: DataFrame, stream: str, streams: Sequence[str], arrival_ms: str, tie: str,
                    ts_ms: str, bound_ms: int = 1, bucket_ms: int = 3_600_000) -> DataFrame:
    """C4: watermark seen by each row of a union of streams = min over inputs
    of (max event time of that input so far - bound); null until every input
    has produced a row (the engine's initial watermark is the minimum long)."""
    vals = {f"_mx{i}": F.when(F.col(stream) == s, F.col(ts_ms)) for i, s in enumerate(streams)}
    out = running_max_before(df, arrival_ms, tie, vals, bucket_ms)
    per = [F.col(f"_mx{i}") - F.lit(bound_ms) for i in range(len(streams))]
    anynull = F.lit(False)
    for i in range(len(streams)):
        anynull = anynull | F.col(f"_mx{i}").isNull()
    wm = F.when(anynull, F.lit(None).cast("bigint")).otherwise(F.least(*per))
    return out.withColumn("wm_ms", wm).drop(*vals.keys())


def cumulative_window_count(df: DataFrame, key: str, ts_ms: str, size_ms: int,
                            step_ms: int) -> DataFrame:
    """Early-firing window.  For each key and tumbling window of
    ``size_ms``, emit at every step end T (a multiple of ``step_ms`` after the
    window start, up to the window end) that lies after the window's first row
    the count of the window's rows with ts < T."""
    if step_ms <= 0 or size_ms % step_ms:
        raise ValueError(f"the window of {size_ms} ms is not a multiple of the step of {step_ms} ms")
    n = size_ms // step_ms
    x = (df.select(key, ts_ms)
           .withColumn("window_start", _window_start(ts_ms, size_ms))
           .withColumn("_s", floor_div(F.col(ts_ms) - F.col("window_start"), step_ms)))
    per_step = x.groupBy(key, "window_start", "_s").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(key, "window_start").orderBy("_s")
    running = (per_step
               .withColumn("cnt", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
               .withColumn("_next", F.coalesce(F.lead("_s").over(w), F.lit(n))))
    fires = running.withColumn("_k", F.explode(F.sequence(F.col("_s") + 1, F.col("_next"))))
    return fires.select(key, (F.col("window_start") + F.lit(size_ms)).alias("window_end"),
                        (F.col("window_start") + F.col("_k") * F.lit(step_ms)).alias("fire_ms"),
                        F.col("cnt").cast("bigint").alias("cnt"))
