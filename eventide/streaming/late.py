"""Late rows kept aside on a stream (F1, F2).

The engine's own watermark drops a late row; here it becomes a second output.
The operator keeps its own watermark: the largest event time of all earlier
micro-batches minus the bound, one small file per micro-batch beside the
output.  A micro-batch reads the file of the batch before it, tags its rows,
writes them, and then leaves its own file, so that

* the rule has batch granularity: every row of a micro-batch meets the same
  watermark, that of the batches before (a trigger is where it moves);
* a replayed micro-batch reads the same watermark, overwrites the same folder
  and tags every row as before.

Rows without a time are never late and move no watermark.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from eventide.functions.time import floor_div
from eventide.streaming.runner import _hadoop_fs

MAIN, LATE = "main", "late"


class KeptWatermark:
    """Largest event time after each micro-batch, under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def before(self, batch_id: int) -> int | None:
        """Largest event time of the batches before ``batch_id``."""
        if batch_id == 0:
            return None
        p, fs = self._at(batch_id - 1)
        if not fs.exists(p):
            raise RuntimeError(f"{self.path}: the watermark of micro-batch {batch_id - 1} is missing")
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)["largest"]

    def keep(self, batch_id: int, largest: int | None) -> None:
        """Whole or not at all: written aside, then renamed."""
        p, fs = self._at(batch_id)
        if fs.exists(p):                                  # a replay has the same value
            return
        aside = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{p}.tmp")
        stream = fs.create(aside, True)
        try:
            stream.write(bytearray(json.dumps({"largest": largest}).encode()))
        finally:
            stream.close()
        if not fs.rename(aside, p):
            raise RuntimeError(f"{p}: the watermark could not be kept")

    def _at(self, batch_id: int):
        return _hadoop_fs(self.spark, f"{self.path}/{batch_id}.json")


def row_is_late(ts_ms: str) -> Callable[[Column], Column]:
    """a row is late iff its time is behind the watermark."""
    return lambda wm: F.col(ts_ms) < wm


def window_is_closed(ts_ms: str, size_ms: int) -> Callable[[Column], Column]:
    """a row is late iff its whole tumbling window is closed
    (``window_end - 1 <= watermark``)."""
    return lambda wm: floor_div(F.col(ts_ms), size_ms) * size_ms + (size_ms - 1) <= wm


def split_late_batches(ts_ms: str, bound_ms: int, is_late: Callable[[Column], Column]):
    """``foreachBatch`` writer with two outputs: ``side=main`` and
    ``side=late`` under ``batch=<id>``.  Every row carries the watermark that
    it met (``wm_ms``)."""
    def make(out: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            kept = KeptWatermark(batch.sparkSession, f"{out}/_watermark")
            before = kept.before(batch_id)
            wm = F.lit(None if before is None else before - bound_ms).cast("long")
            late = F.coalesce(is_late(F.col("wm_ms")), F.lit(False))
            seen = Observation()
            (batch.withColumn("wm_ms", wm).withColumn("side", F.when(late, LATE).otherwise(MAIN))
                  .observe(seen, F.max(ts_ms).alias("largest"))
                  .write.mode("overwrite").partitionBy("side").parquet(f"{out}/batch={batch_id}"))
            times = [t for t in (before, seen.get["largest"]) if t is not None]
            kept.keep(batch_id, max(times) if times else None)
        return write
    return make
