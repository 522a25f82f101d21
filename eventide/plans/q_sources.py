"""File sources and the document sink (A1, A2, A5, A11): a projection of
``events`` is written to the shared folder in the source's own format, in
parallel, and read back by the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.plans.registry import REGISTRY, query
from eventide.plans import q_functions
from eventide.plans.sqlparts import BEHAVIOUR, SENSOR, with_
from eventide.session import scratch_path
from eventide.sinks.documents import write_documents
from eventide.sources import files, tables as S

_ = q_functions      # its queries register first


@query("csv_sensor_scan", oracle=with_(SENSOR) +
       "SELECT id, ts_ms // 1000 AS \"timestamp\", temperature FROM sensor WHERE temperature >= 50")
def csv_sensor_scan(spark, sf):
    """A1: sensor CSV scanned with a declared schema through a view."""
    path = f"{scratch_path(spark, 'csv-sensor')}/data"
    rows = S.sensor_readings(S.events(spark, sf))
    rows.select("id", F.call_function("div", F.col("ts_ms"), F.lit(1000)), "temperature").write.csv(path)
    files.read_csv_table(spark, path, view="eventide_csv_sensor")
    return spark.sql("SELECT id, timestamp, temperature FROM eventide_csv_sensor WHERE temperature >= 50")


@query("behaviour_lines_scan", oracle=with_(BEHAVIOUR) + """
SELECT user_id, item_id, CAST(user_id % 10 AS INTEGER) AS category_id, behaviour, ts_ms // 1000 * 1000 AS ts_ms FROM behaviour""")
def behaviour_lines_scan(spark, sf):
    """A2: comma-separated behaviour lines, seconds to milliseconds."""
    path = f"{scratch_path(spark, 'behaviour-lines')}/data"
    rows = S.user_behaviour(S.events(spark, sf))
    rows.select("user_id", "item_id", "category_id", "behaviour", F.call_function("div", F.col("ts_ms"), F.lit(1000))).write.csv(path)
    return files.read_user_behaviour(spark, path).select("user_id", "item_id", "category_id", "behaviour", "ts_ms")


@query("key_time_lines_scan", oracle=with_(SENSOR) + "SELECT id AS key, ts_ms // 1000 * 1000 AS ts_ms FROM sensor")
def key_time_lines_scan(spark, sf):
    """A5: "key seconds" text lines."""
    path = f"{scratch_path(spark, 'key-time-lines')}/data"
    rows = S.sensor_readings(S.events(spark, sf))
    seconds = F.call_function("div", F.col("ts_ms"), F.lit(1000)).cast("string")
    rows.select(F.concat("id", F.lit(" "), seconds)).write.text(path)
    return files.read_key_ts_lines(spark, path).select("key", "ts_ms")


@query("json_docs_written", oracle=REGISTRY["json_docs"].oracle)
def json_docs_written(spark, sf):
    """Documents written one folder per index, and read back."""
    path = f"{scratch_path(spark, 'documents')}/data"
    write_documents(REGISTRY["json_docs"].fn(spark, sf), path)
    back = spark.read.option("basePath", path).text(path)
    return back.select(F.col("index").cast("string").alias("index"), F.col("value").alias("doc"))
