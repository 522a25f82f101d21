"""A table as a feed: files that arrive one after the other.

A file stream takes files by their modification time.  ``arrival_feed``
writes a table as one file per slice of arrival time and dates the files in
slice order, so that a stream with one file per trigger sees slice after
slice, each in a micro-batch of its own.  A slice is what one file brings:
choose its width so that a file fits a task.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from eventide.functions.time import floor_div
from eventide.session import scratch_path
from eventide.streaming.runner import _hadoop_fs

SLICE = "slice"


def arrival_feed(df: DataFrame, arrival_ms: str, slice_ms: int, purpose: str = "feed") -> tuple[str, T.StructType]:
    """Writes the feed; returns its folder and schema (``slice`` added, last).

    Rows without an arrival time come first.  The folder's file system must
    keep the modification times it is given."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    sliced = df.withColumn(SLICE, F.coalesce(floor_div(F.col(arrival_ms), slice_ms), F.lit(-1)).cast("long"))
    sliced.repartition(SLICE).write.mode("overwrite").partitionBy(SLICE).parquet(path)
    date_files(spark, path)
    return path, sliced.schema


def date_files(spark, path: str) -> None:
    """Modification times of a feed's files, a second apart in slice order."""
    root, fs = _hadoop_fs(spark, path)
    found, it = [], fs.listFiles(root, True)
    while it.hasNext():
        f = it.next().getPath()
        if f.getName().endswith(".parquet"):
            found.append((int(f.getParent().getName().split("=")[1]), f.getName(), f))
    found.sort(key=lambda x: x[:2])
    start = (int(time.time()) - len(found) - 1) * 1000
    for i, (_, _, f) in enumerate(found):
        fs.setTimes(f, start + i * 1000, -1)
        if fs.getFileStatus(f).getModificationTime() != start + i * 1000:
            raise RuntimeError(f"{path}: this file system keeps no modification times, so the feed has no order")
