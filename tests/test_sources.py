"""File sources (A1-A5, batch and stream) and the document sink."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from helpers import rows
from eventide.sinks.documents import to_documents, write_documents
from eventide.sources.files import (parse_access_log, read_access_log, read_csv_table, read_key_ts_lines,
                                    read_user_behaviour)


def _write(lines, name="part-0.txt"):
    d = tempfile.mkdtemp(prefix="eventide-src-")
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def test_user_behaviour_lines(spark):
    d = _write(["543462,1715,1464116,pv,1511658000", "662867,2244074,1575622,cart,1511658001"])
    got = rows(read_user_behaviour(spark, d), "user_id", "behaviour", "ts_ms")
    assert got == [(543462, "pv", 1511658000000), (662867, "cart", 1511658001000)]


def test_access_log(spark):
    d = _write(["83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash",
                "10.0.0.1 - - 17/05/2015:10:05:43 +0000 POST /index.html"])
    got = rows(read_access_log(spark, d), "ip", "ts_ms", "method", "url")
    assert got == [("10.0.0.1", 1431857143000, "POST", "/index.html"),
                   ("83.149.9.216", 1431857103000, "GET", "/presentations/logstash")]


def test_key_ts_lines_batch_and_stream(spark):
    d = _write(["a 1", "a 2", "b 5"])
    assert rows(read_key_ts_lines(spark, d), "key", "ts_ms") == [("a", 1000), ("a", 2000), ("b", 5000)]
    ms = _write(["a 1500"])
    assert rows(read_key_ts_lines(spark, ms, seconds=False), "key", "ts_ms") == [("a", 1500)]
    s = read_key_ts_lines(spark, d, streaming=True)
    assert s.isStreaming
    q = (s.groupBy("key").count().writeStream.format("memory").queryName("key_counts")
          .outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("key_counts"), "key", "count") == [("a", 2), ("b", 1)]


def test_csv_stream(spark):
    d = _write(["sensor_1,1603037857096,10.5", "sensor_2,1603037857096,6.75"], "sensor.csv")
    s = read_csv_table(spark, d, streaming=True)
    q = (s.filter("id = 'sensor_1'").writeStream.format("memory").queryName("csv_rows")
          .trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("csv_rows"), "id", "temperature") == [("sensor_1", 10.5)]


def test_document_sink(spark):
    df = spark.createDataFrame([("sensor_1", 1000, 10.5)], "id string, ts_ms long, temperature double")
    docs = to_documents(df, "sensor", "SensorReading", ["id", "ts_ms", "temperature"])
    out = tempfile.mkdtemp(prefix="eventide-docs-")
    write_documents(docs, out, mode="overwrite")
    files = [os.path.join(r, f) for r, _, fs in os.walk(os.path.join(out, "index=sensor")) for f in fs
             if f.startswith("part-")]
    lines = [json.loads(x) for p in files for x in open(p) if x.strip()]
    assert lines == [{"data": "SensorReading(sensor_1,1000,10.5)"}]


def test_parse_access_log_column(spark):
    df = spark.createDataFrame([("1.2.3.4 - - 01/01/2024:00:00:01 +0000 GET /a",)], "value string")
    r = parse_access_log(df).collect()[0]
    assert (r["ip"], r["ts_ms"], r["method"], r["url"]) == ("1.2.3.4", 1704067201000, "GET", "/a")
    assert parse_access_log(df).select(F.col("ts")).schema[0].dataType.simpleString() == "timestamp_ntz"
