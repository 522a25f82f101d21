"""Distinct counts that are estimates: the Bloom filter and the theta sketch."""

import pytest
from pyspark.sql import functions as F

from eventide.operators.bloom import accumulate, distinct_bloom, estimate, merge, shape_for
from eventide.operators.distinct import distinct_sketch


def events(spark, per_window, copies=1):
    """Rows of windows 0, 1, ... with so many distinct ids each."""
    parts = [spark.range(n * copies).select(F.lit(w * 3600).cast("timestamp").alias("ts"), (F.col("id") % n + w * 10**9).alias("user_id"))
             for w, n in enumerate(per_window)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_shape():
    shape = shape_for(1_000_000, 0.01)
    assert (shape.bits, shape.positions) == (9_585_059, 7)


def test_a_million_ids(spark):
    got = {r["window_end"]: r["uv"] for r in distinct_bloom(events(spark, [1_000_000, 300_000, 100], copies=2), "user_id", 3_600_000).collect()}
    for i, n in enumerate([1_000_000, 300_000, 100]):
        # Standard error n / sqrt(2 m), here with a margin of five.
        assert abs(got[(i + 1) * 3_600_000] - n) <= 5 * n / (2 * 9_585_059) ** 0.5 + 1


def test_false_positives_are_as_few_as_promised(spark):
    """Of ids never added, about 1% have all positions set in a full filter."""
    shape = shape_for(20_000, 0.01)
    key = F.lit(1).alias("k")
    full = accumulate(spark.range(20_000), [key], "id", shape)
    probes = spark.range(1_000_000, 1_000_500)
    alone = accumulate(probes, [F.col("id").alias("k")], "id", shape).select("k", "bucket", F.col("bits").alias("probe"))
    hits = (alone.select("k", "bucket", F.col("probe").alias("bits")).unionByName(
        alone.select("k", "bucket").join(full.select("bucket", "bits"), "bucket").select("k", "bucket", "bits"))
        .groupBy("k", "bucket").agg(F.bitmap_or_agg("bits").alias("joined"))
        .join(full.select("bucket", F.bitmap_count("bits").alias("before")), "bucket", "left")
        .groupBy("k").agg(F.sum(F.bitmap_count("joined") - F.coalesce("before", F.lit(0))).alias("fresh")))
    share = hits.filter("fresh = 0").count() / 500
    assert share < 0.03


def test_merged_parts_equal_the_whole(spark):
    shape = shape_for(10_000, 0.01)
    df = spark.range(30_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7000).alias("user"))
    whole = accumulate(df, ["k"], "user", shape)
    parts = [accumulate(df.filter(F.col("user") % 4 == i), ["k"], "user", shape) for i in range(4)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    merged = merge(union.unionByName(parts[0]), ["k"])            # merging twice changes nothing
    order = lambda f: sorted((r["k"], r["bucket"], bytes(r["bits"])) for r in f.collect())
    assert order(merged) == order(whole)
    for r in estimate(merged, ["k"], shape).collect():
        assert abs(r["uv"] - 7000) <= 5 * 7000 / (2 * shape.bits) ** 0.5 + 1


def test_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(0, None), (0, 5), (0, 5)], "s int, user_id long").select(F.col("s").cast("timestamp").alias("ts"), "user_id")
    assert [r["uv"] for r in distinct_bloom(df, "user_id", 1000).collect()] == [1]
    assert distinct_bloom(df.limit(0), "user_id", 1000).collect() == []


@pytest.mark.parametrize("n", [100_000])
def test_theta_sketch_beyond_its_entries(spark, n):
    """More ids than the sketch keeps: the estimate itself, about 0.8% off."""
    got = [r["uv"] for r in distinct_sketch(events(spark, [n], copies=3), "user_id", 3_600_000).collect()]
    assert len(got) == 1 and got[0] != n and abs(got[0] - n) / n < 0.04
