"""Golden cases: the literal inputs of the reference jobs and their expected
outputs (derived by hand from the job code)."""

import os
import tempfile

from pyspark.sql import functions as F

from helpers import rows
from eventide.functions.scalar import hash_code, register_hash_code, split_keep_java
from eventide.functions.table import register_split_words, split_words
from eventide.operators import joins as J
from eventide.operators.patterns import followed_by_within, match_sequence
from eventide.operators.state import order_timeouts
from eventide.operators.windows import window_count
from eventide.sources.files import literal_rows, read_csv_table

SENSOR_TXT = """sensor_1,1603037857096,10.49524320602528
sensor_2,1603037857096,6.754004883097225
sensor_3,1603037857096,-31.382673291638692
sensor_4,1603037857096,29.785537215900916
"""


def test_csv_select_filter(spark):
    d = tempfile.mkdtemp(prefix="eventide-csv-")
    with open(os.path.join(d, "sensor.txt"), "w") as f:
        f.write(SENSOR_TXT)
    t = read_csv_table(spark, d, view="input_table")
    assert rows(t.selectExpr("id", "temperature").filter("id = 'sensor_1'")) == [("sensor_1", 10.49524320602528)]
    got = spark.sql("SELECT id, temperature FROM input_table WHERE id = 'sensor_2'")
    assert rows(got) == [("sensor_2", 6.754004883097225)]


def _kv(spark, data):
    df = literal_rows(spark, data, "key string, v int, ts_ms bigint")
    return df.withColumn("ts", F.timestamp_millis("ts_ms"))


def test_window_join(spark):
    left = _kv(spark, [("a", 1, 1000), ("a", 2, 2000), ("b", 1, 3000), ("b", 2, 4000)]).withColumnRenamed("v", "lv")
    right = _kv(spark, [("a", 10, 1000), ("a", 20, 2000), ("b", 10, 3000), ("b", 20, 4000)]).withColumnRenamed("v", "rv")
    out = J.window_join(left, right, "key", "10 seconds", left_cols=["lv"], right_cols=["rv"])
    assert rows(out, "key", "lv", "rv") == sorted(
        (k, l, r) for k in "ab" for l in (1, 2) for r in (10, 20))
    assert {r["window_end"] for r in out.collect()} == {10000}


def test_interval_join(spark):
    left = literal_rows(spark, [("a", "click", 3600000)], "key string, kind string, lts bigint")
    right = literal_rows(spark, [("a", "browse", t) for t in (2000000, 3000000, 3200000, 4000000, 4100000, 7200000)]
                         + [("b", "browse", 3100000)], "key string, rkind string, rts bigint")
    out = J.interval_join(left, right, "key", -600000, 500000, "lts", "rts")
    assert rows(out, "key", "rts") == [("a", t) for t in (3000000, 3200000, 4000000, 4100000)]


def test_reconcile(spark):
    orders = literal_rows(spark, [("order_1", 2000), ("order_2", 3000), ("order_3", 4000), ("order_4", 7000)],
                          "order_id string, order_ts bigint")
    pays = literal_rows(spark, [("order_1", 5000), ("order_4", 6000), ("order_5", 7000)],
                        "order_id string, pay_ts bigint")
    m, uo, up = J.reconcile(orders, pays, "order_id", 5000)
    assert rows(m, "order_id") == [("order_1",), ("order_4",)]
    assert rows(uo, "order_id") == [("order_2",), ("order_3",)]
    assert rows(up, "order_id") == [("order_5",)]


def test_gate(spark):
    readings = literal_rows(spark, [("sensor_2", 1000), ("sensor_2", 12000), ("sensor_5", 4000),
                                    ("sensor_5", 6000), ("sensor_1", 1000)], "id string, ts_ms bigint")
    switches = literal_rows(spark, [("sensor_2", 0, 10000), ("sensor_5", 0, 5000)],
                            "id string, sw_ts bigint, dur_ms bigint")
    out = J.gate(readings, switches, "id", "ts_ms", "sw_ts", "dur_ms", bucket_ms=10000)
    assert rows(out) == [("sensor_2", 1000), ("sensor_5", 4000)]


def test_login_fail_three(spark):
    lg = literal_rows(spark, [("user_1", "fail", "0.0.0.1", 1000, 1), ("user_1", "fail", "0.0.0.2", 2000, 2),
                              ("user_1", "fail", "0.0.0.3", 3000, 3), ("user_2", "success", "0.0.0.4", 4000, 4)],
                      "user_id string, event_type string, ip_addr string, ts_ms bigint, seq int")
    fail = F.col("event_type") == "fail"
    m = match_sequence(lg, ["user_id"], "ts_ms", "seq", [fail, fail, fail], 10000, ["ip_addr"])
    got = [(r["user_id"], r["step0"]["ip_addr"], r["step1"]["ip_addr"], r["step2"]["ip_addr"]) for r in m.collect()]
    assert got == [("user_1", "0.0.0.1", "0.0.0.2", "0.0.0.3")]


def test_order_timeout_cep(spark):
    oe = literal_rows(spark, [("order_1", "create", 2000, 1), ("order_2", "create", 3000, 2),
                              ("order_2", "pay", 4000, 3)], "order_id string, event_type string, ts_ms bigint, seq int")
    m, t = followed_by_within(oe, ["order_id"], "ts_ms", "seq", F.col("event_type") == "create",
                              F.col("event_type") == "pay", 5000, ["event_type"])
    got = [(r["order_id"], r["first"]["event_type"], r["second"]["event_type"]) for r in m.collect()]
    assert got == [("order_2", "create", "pay")]
    assert rows(t, "order_id", "deadline_ms") == [("order_1", 7000)]


def test_order_timeout_without_cep(spark):
    oe = literal_rows(spark, [("order_1", "create", 2000), ("order_1", "pay", 3000), ("order_2", "create", 3000),
                              ("order_2", "pay", 4000), ("order_3", "create", 4000), ("order_4", "create", 5000)],
                      "order_id string, event_type string, ts_ms bigint")
    paid, timeouts = order_timeouts(oe, "order_id", "ts_ms", "event_type", 5000)
    assert rows(paid, "order_id") == [("order_1",), ("order_2",)]
    assert rows(timeouts, "order_id") == [("order_3",), ("order_4",)]


def test_split_table_function(spark):
    t = literal_rows(spark, [("hello#world",), ("sample#bigdata",)], "s string")
    assert rows(split_words(t, "s", "#"), "word", "length") == sorted(
        [("hello", 5), ("world", 5), ("sample", 6), ("bigdata", 7)])
    register_split_words(spark, "split_t")
    t.createOrReplaceTempView("t")
    got = spark.sql("SELECT s, word, length FROM t, LATERAL split_t(s, '#')")
    assert rows(got, "word", "length") == sorted([("hello", 5), ("world", 5), ("sample", 6), ("bigdata", 7)])
    left = spark.sql("SELECT s, word FROM t LEFT JOIN LATERAL split_t(s, '#') ON TRUE")
    assert len(left.collect()) == 4


def test_split_trailing_empties(spark):
    t = literal_rows(spark, [("a#b##",), ("#",), ("",), ("x",), ("#a",)], "s string")
    got = {r["s"]: r["p"] for r in t.select("s", split_keep_java("s", "#").alias("p")).collect()}
    assert got == {"a#b##": ["a", "b"], "#": [], "": [""], "x": ["x"], "#a": ["", "a"]}


def test_hash_code(spark):
    t = literal_rows(spark, [("sensor_1",), ("",), (None,), ("日本語",), ("a\U0001F600b",)], "id string")
    got = {r["id"]: r["h"] for r in t.select("id", hash_code("id", 1).alias("h")).collect()}

    def jhash(s):
        h = 0
        for unit in (s.encode("utf-16-be")[i:i + 2] for i in range(0, len(s.encode("utf-16-be")), 2)):
            h = (31 * h + int.from_bytes(unit, "big")) & 0xFFFFFFFF
        return h - (1 << 32) if h >= (1 << 31) else h

    assert got["sensor_1"] == 1262115052
    for s in ("", "日本語", "a\U0001F600b"):
        assert got[s] == jhash(s)
    assert got[None] is None
    register_hash_code(spark, "hash_t", 10)
    assert spark.sql("SELECT hash_t('sensor_1') AS h").collect()[0]["h"] == -263751368


def test_pv_hourly_fixture(spark):
    df = literal_rows(spark, [(1, 1000), (2, 3_599_999), (3, 3_600_000)], "id int, ts_ms bigint")
    df = df.withColumn("ts", F.timestamp_millis("ts_ms"))
    assert rows(window_count(df, [], "1 hour"), "window_end", "cnt") == [(3_600_000, 2), (7_200_000, 1)]
