"""Streaming views of the event records.

The event-time column for watermarks must be a TIMESTAMP (instant); the
driver's ``ts`` is TIMESTAMP_NTZ.  The instant is rebuilt from the
zone-free epoch milliseconds, so windows and bounds agree with the batch
twins under any session time zone.  The watermark is declared right at the
source, before any filter, so the flush row advances it for every operator.
The delay has no default: a bounded run derives it from its files
(``runner.bounded_delay``), a continuous one names the disorder it takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.functions.time import epoch_ms


def event_stream(raw: DataFrame, delay: str) -> DataFrame:
    """Streaming ``events`` with ``ts_ms`` and an instant ``ts`` + watermark."""
    x = raw.withColumn("ts_ms", epoch_ms(F.col("ts")))
    x = x.withColumn("ts", F.timestamp_millis("ts_ms"))
    return x.withWatermark("ts", delay)
