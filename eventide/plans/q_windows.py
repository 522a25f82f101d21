"""Projections, filters and window aggregations over ``events``.

Reference intervals are seconds on a dense stream; ``events`` has about one
row per user every 11 hours, so intervals are scaled up (see README).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import windows as W
from eventide.operators.rows import freezing_alarm
from eventide.plans.registry import query
from eventide.plans.sqlparts import MARKETING, SENSOR, BEHAVIOUR, with_
from eventide.sources import tables as S

HOUR = 3_600_000
DAY = 24 * HOUR


def _sensor(spark, sf):
    return S.sensor_readings(S.events(spark, sf))


@query("select_filter_df", oracle=with_(SENSOR) +
       "SELECT id, temperature FROM sensor WHERE id = 'sensor_1'")
def select_filter_df(spark, sf):
    """B1/B2: Table-API style string projection and filter expression."""
    one = S.sensor_readings(S.events(spark, sf), id="sensor_1")
    return one.selectExpr("id", "temperature").filter("id = 'sensor_1'")


@query("select_filter_sql", oracle=with_(SENSOR) +
       "SELECT id, temperature FROM sensor WHERE id = 'sensor_2'")
def select_filter_sql(spark, sf):
    """SQL projection + filter over a registered view."""
    S.sensor_readings(S.events(spark, sf), id="sensor_2").createOrReplaceTempView("eventide_sensor")
    return spark.sql("SELECT id, temperature FROM eventide_sensor WHERE id = 'sensor_2'")


@query("freezing_alarm", oracle=with_(SENSOR) +
       "SELECT id, ts_ms, id || ' low temperature alarm' AS alarm FROM sensor WHERE temperature < 22")
def q_freezing_alarm(spark, sf):
    """Alarm side output for readings below 22 (main output = all rows)."""
    _, alarms = freezing_alarm(_sensor(spark, sf), threshold=22.0)
    return alarms


@query("sensor_minmax_tumble", oracle=with_(SENSOR) +
       f"SELECT id, ts_ms // {DAY} * {DAY} + {DAY} AS window_end, min(temperature) AS min_temp, "
       "max(temperature) AS max_temp FROM sensor GROUP BY ALL")
def sensor_minmax_tumble(spark, sf):
    """Min and max temperature per sensor and 1-day tumbling window."""
    return W.window_min_max(_sensor(spark, sf), "id", "temperature", DAY)


@query("tumble_count", oracle=with_(SENSOR) +
       f"SELECT id, ts_ms // {6 * HOUR} * {6 * HOUR} AS window_start, "
       f"ts_ms // {6 * HOUR} * {6 * HOUR} + {6 * HOUR} AS window_end, count(*) AS cnt "
       "FROM sensor GROUP BY ALL")
def tumble_count(spark, sf):
    """Count per key and 6-hour tumbling event-time window."""
    return W.window_count(_sensor(spark, sf), ["id"], 6 * HOUR)


@query("pv_hourly", oracle=
       f"SELECT (epoch_us(ts) // 1000) // {HOUR} * {HOUR} + {HOUR} AS window_end, count(*) AS pv "
       "FROM events WHERE event_type = 'view' GROUP BY ALL")
def pv_hourly(spark, sf):
    """D3: global page views per hour (no key)."""
    b = S.page_views(S.events(spark, sf))
    return W.window_count(b, [], HOUR, name="pv").drop("window_start")


@query("marketing_total", oracle=with_(MARKETING) +
       f"SELECT count(*) AS cnt, ts_ms // {HOUR} * {HOUR} + {HOUR} AS window_end "
       "FROM marketing WHERE behaviour <> 'UNINSTALL' GROUP BY ALL")
def marketing_total(spark, sf):
    """Global count per hour with UNINSTALL removed; the constant key is dropped."""
    m = S.marketing(S.events(spark, sf), drop_uninstall=True)
    return W.window_count(m, [], HOUR).select("cnt", "window_end")


@query("marketing_by_channel", oracle=with_(MARKETING) +
       f"SELECT channel, cnt, window_end FROM (SELECT channel, behaviour, "
       f"ts_ms // {HOUR} * {HOUR} + {HOUR} AS window_end, count(*) AS cnt "
       "FROM marketing WHERE behaviour <> 'UNINSTALL' GROUP BY ALL)")
def marketing_by_channel(spark, sf):
    """Count per (channel, behaviour, hour); behaviour is dropped from the output."""
    m = S.marketing(S.events(spark, sf), drop_uninstall=True)
    return W.window_count(m, ["channel", "behaviour"], HOUR).select("channel", "cnt", "window_end")


SLIDE_SQL = (with_(BEHAVIOUR) +
             f"SELECT item_id, (ts_ms // {HOUR} - j) * {HOUR} AS window_start, "
             f"(ts_ms // {HOUR} - j) * {HOUR} + {6 * HOUR} AS window_end, count(*) AS cnt "
             "FROM behaviour CROSS JOIN range(0, 6) t(j) WHERE behaviour = 'pv' GROUP BY ALL")


@query("slide_count", oracle=SLIDE_SQL)
def slide_count(spark, sf):
    """Sliding count per item, 6-hour windows every hour."""
    b = S.page_views(S.events(spark, sf))
    return W.window_count(b, ["item_id"], 6 * HOUR, HOUR)


HOP_SQL = (with_(SENSOR) + f"SELECT id, cnt FROM (SELECT id, ts_ms // {HOUR} - j AS w, count(id) AS cnt "
           "FROM sensor CROSS JOIN range(0, 2) t(j) GROUP BY ALL)")


@query("hop_count_sql", oracle=HOP_SQL)
def hop_count_sql(spark, sf):
    """SQL sliding count (2 h every 1 h), window not in the output."""
    _sensor(spark, sf).createOrReplaceTempView("eventide_sensor")
    return spark.sql("SELECT id, count(id) AS cnt FROM eventide_sensor "
                     "GROUP BY id, window(ts, '2 hours', '1 hour')")


@query("hop_count_df", oracle=HOP_SQL)
def hop_count_df(spark, sf):
    """The same sliding count in DataFrame form."""
    return W.window_count(_sensor(spark, sf), ["id"], 2 * HOUR, HOUR).select("id", "cnt")


TUMBLE_SQL = (with_(SENSOR) + f"SELECT id, cnt FROM (SELECT id, ts_ms // {HOUR} AS w, count(id) AS cnt "
              "FROM sensor GROUP BY ALL)")


@query("tumble_count_sql", oracle=TUMBLE_SQL)
def tumble_count_sql(spark, sf):
    """SQL tumbling count (1 h), window not in the output."""
    _sensor(spark, sf).createOrReplaceTempView("eventide_sensor")
    return spark.sql("SELECT id, count(id) AS cnt FROM eventide_sensor GROUP BY id, window(ts, '1 hour')")


@query("tumble_count_df", oracle=TUMBLE_SQL)
def tumble_count_df(spark, sf):
    """The same tumbling count in DataFrame form."""
    return W.window_count(_sensor(spark, sf), ["id"], HOUR).select("id", "cnt")


@query("group_count", oracle=with_(SENSOR) + "SELECT id, count(id) AS cnt FROM sensor GROUP BY id")
def group_count(spark, sf):
    """Unbounded group count (final value per key)."""
    return W.group_count(_sensor(spark, sf), "id")


@query("constant_per_window", oracle=with_(SENSOR) +
       f"SELECT DISTINCT id, ts_ms // {DAY} * {DAY} + {DAY} AS window_end, 'hello' AS out FROM sensor")
def constant_per_window(spark, sf):
    """One constant row per (key, window) from a window process function."""
    return W.constant_per_window(_sensor(spark, sf), "id", DAY)


@query("proctime_tumble_count", oracle=with_(SENSOR) + "SELECT id, count(id) AS cnt FROM sensor GROUP BY id")
def proctime_tumble_count(spark, sf):
    """C6 + D9/D11: tumbling count on a processing-time column.  A batch query
    reads the clock once, so every row shares one processing time and one
    10-second window: the result is the per-key count."""
    s = _sensor(spark, sf).withColumn("pt", F.current_timestamp())
    return W.window_count(s, ["id"], "10 seconds", ts="pt").select("id", "cnt")


@query("constant_per_row", oracle="SELECT 'hello' AS out FROM events")
def constant_per_row(spark, sf):
    """A process function emitting one constant row per input row."""
    return W.constant_per_row(S.events(spark, sf))
