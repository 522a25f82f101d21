"""File and literal sources (A1-A5).

Each reader has a batch form (``spark.read``) and a streaming form
(``spark.readStream`` over a folder), both with declared schemas: nothing is
inferred, so a scan never runs an extra pass over the data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

SENSOR_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
])

BEHAVIOUR_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behaviour", T.StringType()),
    T.StructField("ts_seconds", T.LongType()),
])


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType = SENSOR_CSV_SCHEMA,
                   view: str | None = None, streaming: bool = False) -> DataFrame:
    """A1: CSV scan with a declared schema, optionally registered as a view."""
    df = _reader(spark, streaming).schema(schema).option("header", "false").csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_user_behaviour(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """A2: comma-separated behaviour lines, seconds -> ms and a timestamp."""
    df = _reader(spark, streaming).schema(BEHAVIOUR_SCHEMA).csv(path)
    return (df.withColumn("ts_ms", F.col("ts_seconds") * 1000)
              .withColumn("ts", F.timestamp_seconds("ts_seconds"))
              .drop("ts_seconds"))


def parse_access_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """A3: space-split log line; 0 ip, 3 time dd/MM/yyyy:HH:mm:ss, 5 method, 6 url.

    The time text carries no zone; it is read as a UTC wall clock.
    """
    parts = F.split(F.col(value), " ")
    ts = F.to_timestamp_ntz(F.get(parts, 3), F.lit("dd/MM/yyyy:HH:mm:ss"))
    out = lines.select(
        F.get(parts, 0).alias("ip"),
        ts.alias("ts"),
        F.get(parts, 5).alias("method"),
        F.get(parts, 6).alias("url"),
    )
    from eventide.functions.time import epoch_ms
    return out.withColumn("ts_ms", epoch_ms(F.col("ts")))


def read_access_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return parse_access_log(_reader(spark, streaming).text(path))


def parse_key_ts_lines(lines: DataFrame, seconds: bool = True, value: str = "value") -> DataFrame:
    """A5: 'key time' lines; time in seconds (x1000) or already in ms."""
    parts = F.split(F.col(value), " ")
    t = F.get(parts, 1).cast("long")
    ts_ms = t * 1000 if seconds else t
    return lines.select(F.get(parts, 0).alias("key"), ts_ms.alias("ts_ms")) \
                .withColumn("ts", F.timestamp_millis("ts_ms"))


def read_key_ts_lines(spark: SparkSession, path: str, seconds: bool = True,
                      streaming: bool = False) -> DataFrame:
    """A5 re-aimed: the socket becomes a folder of text files."""
    return parse_key_ts_lines(_reader(spark, streaming).text(path), seconds=seconds)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A4: literal rows with a declared schema (tests and examples only)."""
    return spark.createDataFrame(list(rows), schema)
