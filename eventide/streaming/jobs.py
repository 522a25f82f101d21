"""Long-running stream jobs.

``start_continuous`` is the production form of every stream twin: the same
operator plan, a processing-time trigger (the reference's periodic watermark
emission and checkpoint interval both map to it), the checkpoint in the
cluster's shared folder, and a file, console or ``foreachBatch`` sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventide.session import ensure_rocksdb_state_store, scratch_path
from eventide.streaming.late import split_late_batches, window_is_closed


def start_continuous(result: DataFrame, name: str, sink: str = "parquet", path: str | None = None,
                     trigger: str = "10 seconds", output_mode: str = "append",
                     batch_writer: Callable[[DataFrame, int], None] | None = None,
                     checkpoint: str | None = None) -> StreamingQuery:
    """Start ``result`` as a checkpointed stream; returns the running query.

    ``checkpoint`` defaults to a fresh folder under ``spark.checkpoint.dir``;
    pass the same folder again to resume after a failure.
    """
    spark = result.sparkSession
    ensure_rocksdb_state_store(spark)
    ck = checkpoint or scratch_path(spark, f"checkpoint-{name}")
    w = (result.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", ck).trigger(processingTime=trigger))
    if batch_writer is not None:
        w = w.foreachBatch(batch_writer)
    elif sink == "console":                      # A10 print sink
        w = w.format("console").option("truncate", "false")
    elif sink == "memory":
        w = w.format("memory")
    else:
        w = w.format(sink).option("path", path or scratch_path(spark, f"sink-{name}"))
    return w.start()


def start_periodic_watermark(rows: DataFrame, name: str, ts_ms: str, path: str, bound_ms: int = 10_000,
                             window_ms: int = 10_000, trigger: str = "60 seconds", checkpoint: str | None = None) -> StreamingQuery:
    """A continuous stream whose watermark moves only at trigger ticks.

    The watermark is the largest event time of the ticks before minus the
    bound; all rows of a tick meet the same one.  Rows whose tumbling window it
    has closed go to ``side=late`` under ``path``, all others to ``side=main``
    (see ``streaming.late``)."""
    writer = split_late_batches(ts_ms, bound_ms, window_is_closed(ts_ms, window_ms))(path)
    return start_continuous(rows, name, trigger=trigger, batch_writer=writer, checkpoint=checkpoint)
