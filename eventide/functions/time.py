"""Time helpers: epoch milliseconds without time-zone dependence.

The reference carries event time as epoch milliseconds (``Long``).  We keep
timestamps as Spark timestamps for ``window``/``withWatermark`` and emit
bounds as BIGINT epoch ms, which compare equal across engines and zones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_NTZ_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_ms(col: str | Column, dtype: T.DataType | None = None) -> Column:
    """Epoch milliseconds (floor) of a TIMESTAMP or TIMESTAMP_NTZ column.

    For NTZ values the wall clock is read as UTC, independent of the session
    zone.  ``dtype`` may be passed when the caller knows it; otherwise NTZ is
    assumed for plain column names resolved via :func:`epoch_ms_of`.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(c)
    return F.timestamp_diff("MILLISECOND", F.expr(_NTZ_EPOCH), c)


def epoch_ms_of(df: DataFrame, name: str) -> Column:
    """:func:`epoch_ms` for a column of ``df``, dispatching on its type."""
    return epoch_ms(F.col(name), df.schema[name].dataType)


def ms_to_ntz(col: str | Column) -> Column:
    """Epoch ms BIGINT -> TIMESTAMP_NTZ (UTC wall clock)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MILLISECOND", c, F.expr(_NTZ_EPOCH))


def duration_ms(text: str) -> int:
    """Parse '10 seconds', '5 minutes', '1 hour', '2 days', '500 ms' to ms."""
    num, unit = text.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    factor = {
        "ms": 1, "millisecond": 1, "milli": 1,
        "second": 1000, "sec": 1000,
        "minute": 60_000, "min": 60_000,
        "hour": 3_600_000,
        "day": 86_400_000,
        "week": 7 * 86_400_000,
    }[unit]
    return int(float(num) * factor)


def interval_text(ms: int) -> str:
    """ms -> a Spark interval string usable by ``window``/``withWatermark``."""
    if ms % 1000 == 0:
        return f"{ms // 1000} seconds"
    return f"{ms} milliseconds"


def floor_div(col: str | Column, n: int) -> Column:
    """Exact integer floor division of a BIGINT by a positive constant
    (also for negative values, unlike truncating ``div``)."""
    c = F.col(col) if isinstance(col, str) else col
    rest = F.pmod(c, F.lit(n))
    # Integer division of an exact multiple; ``/`` would go through doubles.
    return F.call_function("div", c - rest, F.lit(n))
