"""Distinct counts per window.

* exact (D13): ``count_distinct``; Spark plans it as a dedup aggregate keyed
  by (window, user) -- shuffled on both -- followed by a partial count per
  window, so a window with many users is spread over many tasks.
* incremental (D14): ``dropDuplicates`` on (window, user) and a count; the
  same relation in a form Structured Streaming accepts (no per-window set
  is ever held in one place, unlike a ``collect_set`` accumulator).
* sketch (D15): theta sketch per window; mergeable partial aggregates of a
  bounded size (16,384 retained hashes, about 0.8% standard error), exact
  below that many ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.operators.windows import _bounds, window_col


def distinct_exact(df: DataFrame, user: str, size, ts: str = "ts", name: str = "uv") -> DataFrame:
    g = df.groupBy(window_col(size, ts=ts).alias("w")).agg(F.count_distinct(user).alias(name))
    return g.select(_bounds(df, ts)[1], name)


def distinct_incremental(df: DataFrame, user: str, size, ts: str = "ts", name: str = "uv") -> DataFrame:
    d = (df.select(window_col(size, ts=ts).alias("w"), user)
           .dropDuplicates(["w", user]))
    g = d.groupBy("w").agg(F.count(F.lit(1)).alias(name))
    return g.select(_bounds(df, ts)[1], name)


def distinct_sketch(df: DataFrame, user: str, size, ts: str = "ts", name: str = "uv",
                    lg_nom_entries: int = 14) -> DataFrame:
    g = df.groupBy(window_col(size, ts=ts).alias("w")).agg(
        F.theta_sketch_estimate(F.theta_sketch_agg(user, lg_nom_entries)).alias(name))
    return g.select(_bounds(df, ts)[1], name)
