"""Table functions (K3, K4, G4): split text into (word, length) rows.

The DataFrame form is an ``explode`` (inner) or ``explode_outer`` (LEFT
lateral).  The SQL form registers a SQL table function, so
``FROM t, LATERAL split_words(s, '#')`` and
``FROM t LEFT JOIN LATERAL split_words(s, '#') ON TRUE`` stay inside the
JVM; no Python UDTF runs per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.functions.scalar import split_keep_java


def split_words(df: DataFrame, col: str, sep_regex: str = "#", outer: bool = False,
                word: str = "word", length: str = "length") -> DataFrame:
    """K3: each row joined with one row per piece of ``col`` split by ``sep``."""
    pieces = split_keep_java(F.col(col), sep_regex)
    exploder = F.explode_outer if outer else F.explode
    out = df.withColumn("_w", exploder(pieces))
    return out.withColumn(word, F.col("_w")).withColumn(length, F.length("_w")).drop("_w")


def register_split_words(spark: SparkSession, name: str = "split_words") -> None:
    """K4: register ``name(s STRING, sep STRING)`` as a SQL table function."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING, sep STRING) "
        "RETURNS TABLE (word STRING, length INT) "
        "RETURN SELECT col AS word, length(col) AS length FROM explode("
        "  CASE WHEN size(split(s, sep)) = 1 THEN split(s, sep)"
        "       ELSE slice(split(s, sep), 1,"
        "                  array_max(transform(split(s, sep), (x, i) -> IF(x <> '', i + 1, 0)))) END)")
