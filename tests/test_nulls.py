"""Null keys and times, uneven cuts and other awkward input, against plain
windows over whole keys."""

import random

import pytest
from pyspark.sql import Window, functions as F

from eventide.operators import late as L, patterns as P, sequence as Q, state as ST

DAY = 86_400_000


def awkward(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", "c", None]), None if rng.random() < 0.1 else rng.randrange(0, 5 * DAY, 1000),
             None if rng.random() < 0.1 else round(rng.random() * 9, 1), rng.choice(["x", "y"])) for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, k string, ts_ms long, v double, kind string").repartition(3)


def same(a, b):
    assert sorted(map(repr, map(tuple, a.collect()))) == sorted(map(repr, map(tuple, b.collect())))


@pytest.mark.parametrize("target", [None, 4_000_000, 20])
def test_keyed_scan(spark, target):
    df = awkward(spark)
    w = Window.partitionBy("k").orderBy("ts_ms", "event_id")
    want = df.withColumn("n", F.row_number().over(w).cast("long")).withColumn("prev_v", F.lag("v").over(w))
    got = Q.keyed_scan(df, ["k"], "ts_ms", "event_id", sums={"n": F.lit(1)}, lags=["v"], bucket_ms=DAY, target_rows=target)
    same(got.select("event_id", "n", "prev_v"), want.select("event_id", "n", "prev_v"))


def test_changelog_numbers_every_row(spark):
    df = awkward(spark)
    log = ST.changelog_count(df, "k", "ts_ms", "event_id").filter("is_add")
    assert log.count() == df.count()
    for r in log.groupBy("k").agg(F.max("seq").alias("m"), F.count("*").alias("n"), F.min("seq").alias("lo")).collect():
        assert r["m"] == r["n"] and r["lo"] == 1


@pytest.mark.parametrize("target", [4_000_000, 25])
def test_following_events(spark, target):
    df = awkward(spark)
    w = Window.partitionBy("k").orderBy("ts_ms", "event_id")
    want = df.select("event_id", F.lead("event_id", 1).over(w).alias("a"), F.lead("event_id", 2).over(w).alias("b"))
    got = P.with_following(df, ["k"], "ts_ms", "event_id", ["event_id"], 2, DAY, bucket_ms=DAY, target_rows=target)
    same(got.select("event_id", F.col("next1.event_id").alias("a"), F.col("next2.event_id").alias("b")), want)


def test_one_step_pattern(spark):
    df = awkward(spark)
    got = P.match_sequence(df, ["k"], "ts_ms", "event_id", [F.col("kind") == "x"], DAY, ["event_id"])
    assert got.count() == df.filter("kind = 'x'").count()


def test_late_split_keeps_every_row(spark):
    df = awkward(spark).withColumn("arrival_ms", F.when(F.col("event_id") % 9 != 0, F.col("ts_ms") + F.col("event_id") % 7 * 1000))
    w = Window.orderBy("arrival_ms", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("event_id", (F.max("ts_ms").over(w) - 500).alias("wm_ms"))
    same(L.split_late(df, "arrival_ms", "event_id", "ts_ms", 500).select("event_id", "wm_ms"), want)


def test_no_piece_is_much_over_the_target(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") * 37 % 86_000_000).alias("ts_ms"), F.col("id").alias("event_id"))
    sizes = Q.time_buckets(df, ["k"], "ts_ms", DAY, 1_000).groupBy("_b").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2_000


def test_early_firing_wants_whole_steps(spark):
    with pytest.raises(ValueError, match="multiple"):
        L.cumulative_window_count(awkward(spark), "k", "ts_ms", 10, 4)


def test_sketch_error_is_small(spark):
    from eventide.operators.distinct import distinct_sketch
    df = spark.range(60_000).select((F.col("id") * 7919 % 50_000).alias("user_id"), F.timestamp_seconds(F.lit(10)).alias("ts"))
    assert abs(distinct_sketch(df, "user_id", 3_600_000).first()["uv"] - 50_000) <= 0.03 * 50_000


def test_a_local_folder_is_refused_on_a_cluster():
    from eventide.session import is_one_machine
    assert is_one_machine("local[*]") and is_one_machine("local") and is_one_machine("local[4, 2]")
    assert not any(map(is_one_machine, ["local-cluster[3,2,1000]", "yarn", "spark://host:7077", "k8s://x"]))
