"""Aggregate functions (K5).

The reference's aggregate UDF keeps (sum, count) and returns sum / count.
As a Spark expression it gets a partial aggregate before the shuffle and a
final one after; no Python, no per-group buffering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def avg_of(col: str) -> Column:
    """K5: mean from a (sum, count) accumulator; null for an empty group."""
    return F.sum(col) / F.count(col)


def avg_per_key(df: DataFrame, key: str, value: str, name: str = "avg_temp") -> DataFrame:
    return df.groupBy(key).agg(avg_of(value).alias(name))


def register_avg_result(spark: SparkSession, name: str = "avg_result") -> None:
    """K5 for SQL: the result function of the (sum, count) accumulator, used as
    ``avg_result(sum(x), count(x))``.  The accumulator's two parts are built-in
    aggregates, so SQL queries keep the partial aggregate too (a SQL function
    may not hold an aggregate itself)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(total DOUBLE, n BIGINT) RETURNS DOUBLE RETURN total / nullif(n, 0)")
