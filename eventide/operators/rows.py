"""Per-row process functions with side outputs.

A side output becomes a second DataFrame over the same input.  Both read the
same scan; on a cluster the caller can cut lineage with
``eventide.session.cut_lineage`` when both outputs are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def freezing_alarm(readings: DataFrame, threshold: float = 22.0, temp: str = "temperature",
                   key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(main, alarms).  Main keeps every row; alarms only cold rows."""
    alarms = (readings.filter(F.col(temp) < F.lit(threshold))
                      .select(key, "ts_ms",
                              F.concat(F.col(key), F.lit(" low temperature alarm")).alias("alarm")))
    return readings, alarms
