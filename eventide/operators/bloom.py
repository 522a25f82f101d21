"""Distinct counts by a Bloom filter that merges.

The filter of a window is m bits with k positions an id, sized from the ids
expected and the false-positive rate wanted (1,000,000 and 1% give 9,585,059
bits and 7 positions).  It is kept as a table: one row per (window, bucket) of
32,768 bits.  An id's positions are spread over the buckets by its hashes, so
a window with many ids is many small groups, never one; each task sets bits of
its own first (partial aggregate), and accumulators merge by OR, whether they
come from tasks, files or micro-batches.

The count is read from the bits set, X: n = -(m / k) ln(1 - X / m).  Its
standard error at n ids is about n / sqrt(2 m) while the filter is not
overfull -- exact after rounding for small windows, 0.02% at a million ids.
Unlike counting only the ids whose bits were new, it does not depend on the
order of rows and does not undercount.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from eventide.operators.windows import _bounds, window_col

EXPECTED_IDS = 1_000_000
FALSE_POSITIVES = 0.01
BITS, BUCKET = "bits", "bucket"


@dataclass(frozen=True)
class Shape:
    """Bits of a filter and positions an id."""

    bits: int
    positions: int


def shape_for(expected: int = EXPECTED_IDS, false_positives: float = FALSE_POSITIVES) -> Shape:
    bits = math.ceil(-expected * math.log(false_positives) / math.log(2) ** 2)
    return Shape(bits, max(1, round(bits / expected * math.log(2))))


def accumulate(df: DataFrame, keys: Sequence, id: str, shape: Shape) -> DataFrame:
    """keys + (bucket, bits): the filter of each group.  Null ids are no ids."""
    first = F.pmod(F.xxhash64(id), F.lit(shape.bits))
    step = F.pmod(F.xxhash64(id, F.lit(shape.bits)), F.lit(shape.bits - 1)) + 1
    spots = F.transform(F.sequence(F.lit(0), F.lit(shape.positions - 1)),
                        lambda i: (F.col("_first") + i * F.col("_step")) % F.lit(shape.bits) + 1)
    x = df.filter(F.col(id).isNotNull()).select(*keys, first.alias("_first"), step.alias("_step"))
    names = x.columns[:-2]
    x = x.select(*names, F.explode(spots).alias("_at"))
    return (x.groupBy(*names, F.bitmap_bucket_number("_at").alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias(BITS)))


def merge(filters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One filter per group from any number of them (their union): OR per bucket."""
    return filters.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def estimate(filters: DataFrame, keys: Sequence[str], shape: Shape, name: str = "uv") -> DataFrame:
    """keys + the number of distinct ids, from merged filters."""
    free = F.greatest(1 - F.col("_set") / F.lit(shape.bits), F.lit(0.5 / shape.bits))
    count = F.round(-F.lit(shape.bits / shape.positions) * F.ln(free)).cast("long")
    return filters.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias("_set")).select(*keys, count.alias(name))


def distinct_bloom(df: DataFrame, user: str, size, ts: str = "ts", name: str = "uv",
                   expected: int = EXPECTED_IDS, false_positives: float = FALSE_POSITIVES) -> DataFrame:
    """Distinct users per window, batch or stream."""
    shape = shape_for(expected, false_positives)
    filters = accumulate(df, [window_col(size, ts=ts).alias("w")], user, shape)
    return estimate(filters, ["w"], shape, name).select(_bounds(df, ts)[1], name)
