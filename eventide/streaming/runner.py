"""Run a streaming plan over a bounded input and read its sink back.

The stream reads the table's own files in place.  Everything it writes
lives in a fresh folder under ``spark.checkpoint.dir`` (the cluster's shared
storage): the flush rows, the sink, and the stream checkpoint (offsets,
commits and RocksDB state).  A lost executor or
driver resumes from that checkpoint.

Append-mode windows and event-time timers are released only when the
watermark passes them, and a bounded input never pushes it past its last
windows.  After the data is consumed (``availableNow``), the run is
restarted from its checkpoint with one extra file holding a single far-future
*flush* rows -- exactly what a bounded source does in the reference engine
when it ends.  Operators never emit for the flush rows (their key matches
nothing and their own windows and timers lie beyond the watermark).
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventide.session import ROCKSDB_PROVIDER, STATE_STORE, scratch_path

FLUSH_TS = "2100-01-01 00:00:00"
FLUSH_MS = 4_102_444_800_000
# Input of one micro-batch (bytes of files); a file is never split.
MAX_BYTES_PER_TRIGGER = 8 << 30


def events_flush_row(spark: SparkSession, table: DataFrame) -> DataFrame:
    """Far-future flush rows shaped like the events table: one per event type
    found in it, each with a key below every key of the table.

    Catalyst pushes filters that do not read the event-time column below the
    watermark, so a flush row must survive the operator's own filters to
    reach it; one row per type does, whatever type the operator keeps.
    """
    # One pass: the types (few) with the least key of each.
    found = table.groupBy("event_type").agg(F.least(F.min("user_id"), F.min("event_id"), F.lit(0)).alias("low")).collect()
    types, low = [r["event_type"] for r in found], min((r["low"] for r in found), default=0)
    rows = [(low - 1 - i, t) for i, t in enumerate(sorted(types, key=lambda t: (t is None, t)))]
    # Each flush row has its own key, so no key ever holds two of them: no
    # pattern, join or timer chain can form among flush rows.
    return (spark.createDataFrame(rows, "k long, event_type string")
                .select(F.col("k").alias("event_id"),
                        F.lit(FLUSH_TS).cast("timestamp_ntz").alias("ts"),
                        F.col("k").alias("user_id"),
                        F.col("event_type"),
                        F.lit(0.0).alias("value"),
                        F.lit(None).cast("string").alias("props")))


def bounded_delay(table: DataFrame, ts_ms: Column) -> int:
    """Watermark delay (ms) that loses no row of a bounded file stream; a row
    at the watermark itself is late already.

    Files are read oldest first, each whole, so a row can only be late against
    earlier files: the delay is the largest lag of a file's smallest time
    behind the largest time before it.  Files of one modification time may be
    read in any order.  One row per file is looked at.
    """
    spans = (table.select(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"),
                          ts_ms.alias("t"))
             .groupBy("at", "file").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).filter("lo is not null"))
    times = spans.groupBy("at").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n"))
    # The table of file times is small beside the data; one number leaves it.
    top = F.max("hi").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    before = F.greatest(top, F.when(F.col("n") > 1, F.col("hi")), F.col("lo"))
    lag = times.select((before - F.col("lo")).alias("lag")).agg(F.max("lag")).first()[0]
    return (lag or 0) + 1


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds any parquet file, on whatever file system it names."""
    p, fs = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        if it.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fs_has_tables(spark: SparkSession, out: str) -> bool:
    p, fs = _hadoop_fs(spark, out)
    return any(f.getPath().getName().startswith("table=") for f in fs.listStatus(p))


def stream_path(spark: SparkSession, path: str) -> str:
    """A path a file stream accepts.  File sources watch folders; a single
    table file is addressed by a glob that matches just that file."""
    p, fs = _hadoop_fs(spark, path)
    if any(ch in path for ch in "*?[{") or not fs.exists(p) or not fs.getFileStatus(p).isFile():
        return path
    return f"{path[:-1]}[{path[-1]}]"


def run_bounded(spark: SparkSession, source_path: str, schema, build: Callable[[DataFrame], DataFrame],
                purpose: str, output_mode: str = "append",
                batch_writer: Callable[[str], Callable[[DataFrame, int], None]] | None = None,
                flush: DataFrame | None = None, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER, before_flush: Callable[[], None] | None = None,
                no_data_batches: bool = True) -> DataFrame:
    """Stream the table at ``source_path`` in place through ``build``, with
    ``availableNow``; optionally restart once with ``flush`` rows; return the
    sink's contents as a batch DataFrame.

    The input is not copied: the stream reads the table's own files, unioned
    with a flush folder that stays empty until the restart.  A micro-batch
    takes ``max_bytes_per_trigger`` of files, or ``max_files_per_trigger``.
    ``before_flush`` runs before the restart (to let the clock pass a window).
    Processing-time timers ask for another batch for ever: such a plan runs
    without batches that bring no data (``no_data_batches``).

    Raises if any row came too late for the watermark, or if rows were read
    and the sink's folder is missing: a run is whole or it fails.
    """
    base = scratch_path(spark, purpose)
    flush_dir = f"{base}/flush"
    p, fs = _hadoop_fs(spark, flush_dir)
    fs.mkdirs(p)

    def make() -> DataFrame:
        data = file_stream(spark, source_path, schema, max_files_per_trigger, max_bytes_per_trigger)
        return build(data.unionByName(spark.readStream.schema(schema).parquet(flush_dir)))

    def again() -> None:
        if before_flush is not None:
            before_flush()
        flush.select(*schema.names).write.mode("append").parquet(flush_dir)

    extra = {} if no_data_batches else {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    with stream_settings(spark, extra):
        return _run(spark, base, make, purpose, output_mode, batch_writer, again if flush is not None else None)


def run_plan(spark: SparkSession, make: Callable[[], DataFrame], purpose: str, output_mode: str = "append",
             batch_writer: Callable[[str], Callable[[DataFrame, int], None]] | None = None) -> DataFrame:
    """``run_bounded`` for a plan over any sources that end: ``make`` returns
    the streaming result."""
    with stream_settings(spark):
        return _run(spark, scratch_path(spark, purpose), make, purpose, output_mode, batch_writer, None)


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER) -> DataFrame:
    """The table at ``path`` as a stream, some files a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(stream_path(spark, path))


# Of a bounded run: all four stores of a join side by side in one RocksDB a
# partition, so a commit is one and not four; rows are not counted, which
# reads each key before it is written.
JOIN_FORMAT = "spark.sql.streaming.join.stateFormatVersion"
COUNT_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


@contextlib.contextmanager
def stream_settings(spark: SparkSession, extra: dict[str, str] | None = None):
    """The settings of a bounded run; the caller's own come back afterwards."""
    keys = {STATE_STORE: ROCKSDB_PROVIDER, JOIN_FORMAT: "3", COUNT_ROWS: "false",
            "spark.sql.streaming.numRecentProgressUpdates": "1000000"} | (extra or {})
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _run(spark, base, make, purpose, output_mode, batch_writer, again) -> DataFrame:
    out, ck = f"{base}/output", f"{base}/checkpoint"
    result_schema, rows_read = None, 0

    def start() -> None:
        nonlocal result_schema, rows_read
        result = make()
        result_schema = result.schema
        w = (result.writeStream.option("checkpointLocation", ck)
             .outputMode(output_mode).trigger(availableNow=True))
        if batch_writer is not None:
            w = w.foreachBatch(batch_writer(out))
        else:
            w = w.format("parquet").option("path", out)
        q = w.start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        progress = [json.loads(p.json) for p in q.recentProgress]
        rows_read += sum(p["numInputRows"] for p in progress)
        late = sum(o.get("numRowsDroppedByWatermark", 0) for p in progress for o in p["stateOperators"])
        if late:
            raise RuntimeError(f"{purpose}: the watermark dropped {late} rows; give the stream a larger delay")

    start()
    if again is not None:
        again()
        start()
    if not _has_files(spark, out):
        p, fs = _hadoop_fs(spark, out)
        if rows_read and not fs.exists(p):
            raise RuntimeError(f"{purpose}: {rows_read} rows were read but {out} is missing; is the folder shared?")
        return spark.createDataFrame([], result_schema)
    if fs_has_tables(spark, out):
        return newest_complete(spark, out)
    back = spark.read.parquet(out)
    return back.drop("batch") if "batch" in back.columns else back


def append_batches(transform: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` writer: each micro-batch (optionally transformed)
    lands in ``batch=<id>`` and is overwritten on replay, so a retried batch
    is not written twice."""
    def make(out: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            b = transform(batch) if transform else batch
            b.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        return write
    return make


def numbered_batches():
    """``foreachBatch`` writer that keeps each row's micro-batch number."""
    def make(out: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            b = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            b.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        return write
    return make


def newest_per_key(log: DataFrame, key: str) -> DataFrame:
    """Rows of each key's newest micro-batch, by a partial maximum and a join."""
    newest = log.groupBy(F.struct(key).alias("_key")).agg(F.max("batch_id").alias("batch_id"))
    return log.withColumn("_key", F.struct(key)).join(newest, ["_key", "batch_id"]).drop("_key")


def latest_complete():
    """``foreachBatch`` writer for complete results: each micro-batch writes
    the full table to a folder of its own, marked once it is whole, so a
    failure while writing leaves the one before; see ``newest_complete``."""
    def make(out: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/table={batch_id}")
        return write
    return make


def newest_complete(spark: SparkSession, out: str) -> DataFrame:
    """The newest whole table written by ``latest_complete``."""
    p, fs = _hadoop_fs(spark, out)
    jvm = spark.sparkContext._jvm
    done = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(p)
            if f.getPath().getName().startswith("table=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return spark.read.parquet(f"{out}/table={max(done)}")
