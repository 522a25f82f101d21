"""Window aggregations.

Tumbling and sliding windows are grouping columns (``F.window``); Spark
plans a partial ``HashAggregate`` before the shuffle and a final one after,
which is the reference's incremental ``aggregate(agg, windowFn)`` (D16).
A constant key (B5) is never materialised: a global window aggregate groups
by the window alone, so a single hot key cannot exist.

Window bounds leave the operator as BIGINT epoch milliseconds, like the
reference's ``windowEnd: Long``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from eventide.functions.time import duration_ms, epoch_ms, interval_text


def _ms(x: int | str) -> int:
    return x if isinstance(x, int) else duration_ms(x)


def window_col(size: int | str, slide: int | str | None = None, ts: str = "ts") -> Column:
    """Tumbling (slide None) or sliding window over ``ts``, epoch-aligned."""
    size_t = interval_text(_ms(size))
    if slide is None or _ms(slide) == _ms(size):
        return F.window(ts, size_t)
    return F.window(ts, size_t, interval_text(_ms(slide)))


def _bounds(df: DataFrame, ts: str, w: str = "w") -> list[Column]:
    dtype = df.schema[ts].dataType
    ltz = dtype if isinstance(dtype, T.TimestampType) else None
    return [epoch_ms(F.col(f"{w}.start"), ltz).alias("window_start"),
            epoch_ms(F.col(f"{w}.end"), ltz).alias("window_end")]


def window_aggregate(df: DataFrame, keys: Sequence[str | Column], size: int | str,
                     aggs: Sequence[Column], slide: int | str | None = None,
                     ts: str = "ts") -> DataFrame:
    """keys + window_start/window_end (ms) + aggs, one row per (keys, window)."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    g = df.groupBy(*key_cols, window_col(size, slide, ts).alias("w")).agg(*aggs)
    others = [c for c in g.columns if c != "w"]
    return g.select(*[F.col(c) for c in others[: len(key_cols)]], *_bounds(df, ts),
                    *[F.col(c) for c in others[len(key_cols):]])


def window_count(df: DataFrame, keys: Sequence[str | Column], size: int | str,
                 slide: int | str | None = None, ts: str = "ts", name: str = "cnt") -> DataFrame:
    """Row count per key and window.

    A sliding window is expanded before the map-side partial aggregate, so one
    exchange carries a count per key and window, not the rows' copies."""
    return window_aggregate(df, keys, size, [F.count(F.lit(1)).alias(name)], slide, ts)


def window_min_max(df: DataFrame, key: str, value: str, size: int | str,
                   ts: str = "ts") -> DataFrame:
    """Min and max of ``value`` per key and tumbling window, with its end."""
    return window_aggregate(df, [key], size,
                            [F.min(value).alias("min_temp"), F.max(value).alias("max_temp")],
                            ts=ts).drop("window_start")


def group_count(df: DataFrame, key: str, name: str = "cnt") -> DataFrame:
    """Unbounded group count (final values; the changelog is in ``changelog``)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def constant_per_row(df: DataFrame, value: str = "hello") -> DataFrame:
    """B8 row/keyed form: one constant row per input row."""
    return df.select(F.lit(value).alias("out"))


def constant_per_window(df: DataFrame, key: str, size: int | str, ts: str = "ts",
                        value: str = "hello") -> DataFrame:
    """B8 window form: one constant row per (key, window)."""
    return (window_count(df, [key], size, ts=ts)
            .select(F.col(key), F.col("window_end"), F.lit(value).alias("out")))
