"""Top-N per group.

``row_number() <= n`` over a window partition.  Spark plans this as a
``WindowGroupLimit`` on each map partition *before* the shuffle and again
after it, so at most n rows per group per map task cross the network: a hot
window with millions of candidates still ships only n rows from each task.
Ties are broken by the extra order columns (the reference leaves them
unordered); rank is a 1-based BIGINT.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], n: int,
          rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return (df.withColumn(rank, F.row_number().over(w).cast("bigint"))
              .filter(F.col(rank) <= n))


def top_n_by_count(counts: DataFrame, group: str, item: str, n: int,
                   count: str = "cnt", rank: str = "rank") -> DataFrame:
    """Top n items per ``group`` by count desc, item asc."""
    return top_n(counts, [group], [F.col(count).desc(), F.col(item).asc()], n, rank)


def top_values(df: DataFrame, key: str, value: str, n: int = 2, rank: str = "rank",
               tie: str | None = None) -> DataFrame:
    """K6: the n largest values per key with their rank (table-aggregate UDF)."""
    order = [F.col(value).desc()] + ([F.col(tie).asc()] if tie else [])
    return top_n(df, [key], order, n, rank).select(key, value, rank)
