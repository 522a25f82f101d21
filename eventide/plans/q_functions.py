"""User functions (K1-K5), lateral table functions (G4) and the document sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions.aggregate import avg_per_key, register_avg_result
from eventide.functions.scalar import epoch_ms_text, hash_code, register_hash_code
from eventide.functions.table import register_split_words, split_words
from eventide.plans.registry import query
from eventide.plans.sqlparts import SENSOR, with_
from eventide.sinks.documents import to_documents
from eventide.sources import tables as S

HASH_SQL = with_(SENSOR) + """
SELECT id, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS hash_code FROM (
  SELECT id, (list_reduce(list_prepend(0, list_transform(range(length(id)), lambda i: ord(id[i + 1]))),
                          lambda acc, x: (acc * 31 + x) % 4294967296) * 10) % 4294967296 AS h FROM sensor)"""


def _sensor(spark, sf):
    return S.sensor_readings(S.events(spark, sf))


@query("hash_udf", oracle=HASH_SQL)
def hash_udf(spark, sf):
    """K1: scalar function with a parameter: string hash x 10, 32-bit wrap."""
    return _sensor(spark, sf).select("id", hash_code("id", 10).alias("hash_code"))


@query("hash_udf_sql", oracle=HASH_SQL)
def hash_udf_sql(spark, sf):
    """K2: the same function registered for SQL."""
    register_hash_code(spark, "eventide_hash_code", 10)
    _sensor(spark, sf).createOrReplaceTempView("eventide_sensor")
    return spark.sql("SELECT id, eventide_hash_code(id) AS hash_code FROM eventide_sensor")


SPLIT_SQL = """
SELECT event_id, s, word, CAST(length(word) AS INTEGER) AS length FROM (
  SELECT event_id, event_type || '#' || props AS s, unnest(string_split(event_type || '#' || props, '#')) AS word
  FROM events)"""


@query("lateral_split", oracle=SPLIT_SQL)
def lateral_split(spark, sf):
    """Inner lateral join with a table function splitting on '#'."""
    return split_words(S.split_text(S.events(spark, sf)), "s", "#").select("event_id", "s", "word", "length")


@query("lateral_split_sql", oracle=SPLIT_SQL)
def lateral_split_sql(spark, sf):
    """K4: the table function registered for SQL, used with LATERAL."""
    register_split_words(spark, "eventide_split")
    S.split_text(S.events(spark, sf)).createOrReplaceTempView("eventide_text")
    return spark.sql("SELECT event_id, s, word, length FROM eventide_text, LATERAL eventide_split(s, '#')")


@query("lateral_split_left", oracle="""
WITH t AS (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE event_type || '#' || props END AS s
           FROM events)
SELECT event_id, s, word, CAST(length(word) AS INTEGER) AS length FROM t
LEFT JOIN LATERAL (SELECT unnest(string_split(t.s, '#')) AS word) w ON true""")
def lateral_split_left(spark, sf):
    """G4 LEFT form: rows without a payload (views) keep one row with null word."""
    ev = S.events(spark, sf)
    t = ev.select("event_id", F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
                  .otherwise(F.concat("event_type", F.lit("#"), "props")).alias("s"))
    return split_words(t, "s", "#", outer=True).select("event_id", "s", "word", "length")


@query("epoch_text", oracle=with_(SENSOR) +
       "SELECT id, ts_ms, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS at FROM sensor")
def epoch_text(spark, sf):
    """Epoch milliseconds as text, the UTC wall clock."""
    return _sensor(spark, sf).select("id", "ts_ms", epoch_ms_text("ts_ms").alias("at"))


@query("avg_udaf", oracle=with_(SENSOR) +
       "SELECT id, round(sum(temperature) / count(temperature), 6) AS avg_temp FROM sensor GROUP BY id")
def avg_udaf(spark, sf):
    """K5: aggregate function mean = sum / count per sensor (rounded to 6 places)."""
    out = avg_per_key(_sensor(spark, sf), "id", "temperature")
    return out.select("id", F.round("avg_temp", 6).alias("avg_temp"))


@query("avg_udaf_sql", oracle=with_(SENSOR) +
       "SELECT id, round(sum(temperature) / count(temperature), 6) AS avg_temp FROM sensor GROUP BY id")
def avg_udaf_sql(spark, sf):
    """K5 in SQL: the registered result function over the accumulator (sum, count)."""
    register_avg_result(spark)
    _sensor(spark, sf).createOrReplaceTempView("eventide_avg_sensor")
    return spark.sql("SELECT id, round(mean, 6) AS avg_temp FROM (SELECT id, avg_result(sum(temperature), count(temperature)) AS mean "
                     "FROM eventide_avg_sensor GROUP BY id)")


@query("json_docs", oracle=with_(SENSOR) + """
SELECT 'sensor' AS "index",
       CAST(to_json(struct_pack(data := 'SensorReading(' || id || ',' || CAST(ts_ms AS VARCHAR) || ','
                                         || CAST(temperature AS VARCHAR) || ')')) AS VARCHAR) AS doc FROM sensor""")
def json_docs(spark, sf):
    """Every reading as a JSON document for index 'sensor'."""
    return to_documents(_sensor(spark, sf), "sensor", "SensorReading", ["id", "ts_ms", "temperature"])
