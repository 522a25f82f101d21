"""Keyed state and timers."""

from __future__ import annotations

from eventide.operators import state as ST
from eventide.plans.registry import query
from eventide.plans.sqlparts import ORDERS, SENSOR, with_
from eventide.sources import tables as S

DAY = 86_400_000


def _sensor(spark, sf):
    return S.sensor_readings(S.events(spark, sf))


@query("group_count_changelog", oracle=with_(SENSOR) + """
, s AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY ts_ms, event_id) AS seq FROM sensor)
SELECT id, seq, true AS is_add, seq AS cnt FROM s
UNION ALL
SELECT id, seq, false AS is_add, seq - 1 AS cnt FROM s WHERE seq > 1""")
def group_count_changelog(spark, sf):
    """Retract stream of the running count per sensor."""
    return ST.changelog_count(_sensor(spark, sf), "id", "ts_ms", "event_id")


@query("type_count_changelog_cut", oracle=f"""
WITH s AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts) // 1000, event_id) AS seq FROM events)
SELECT event_type, seq, true AS is_add, seq AS cnt FROM s
UNION ALL
SELECT event_type, seq, false AS is_add, seq - 1 AS cnt FROM s WHERE seq > 1""")
def type_count_changelog_cut(spark, sf):
    """A9/D12 over few keys, each with a fifth of all rows, in one bucket cut
    at ts quantiles into pieces of at most some 100 rows: the hot path."""
    return ST.changelog_count(S.events(spark, sf), "event_type", "ts_ms", "event_id", bucket_ms=3650 * DAY, target_rows=100)


@query("timer_deadlines", oracle=with_(SENSOR) + "SELECT DISTINCT id, ts_ms + 10000 AS fire_ms FROM sensor")
def timer_deadlines(spark, sf):
    """Event-time timer 10 s after every reading; one firing per (key, time)."""
    return ST.timer_deadlines(_sensor(spark, sf), "id", "ts_ms", 10_000)


@query("rising_run_alert", oracle="WITH RECURSIVE " + SENSOR + f"""
, s AS (SELECT id, event_id, ts_ms, temperature,
               lag(temperature) OVER (PARTITION BY id ORDER BY ts_ms, event_id) AS prev FROM sensor),
r AS (SELECT *, prev IS NULL OR temperature < prev AS reset, prev IS NOT NULL AND temperature > prev AS rise FROM s),
r2 AS (SELECT *, sum(CASE WHEN reset THEN 1 ELSE 0 END)
                   OVER (PARTITION BY id ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS run FROM r),
rises AS (SELECT id, run, ts_ms FROM r2 WHERE rise),
ends AS (SELECT id, run - 1 AS run, ts_ms AS end_ts FROM r2 WHERE reset),
chain(id, run, a) AS (
  SELECT id, run, min(ts_ms) + {DAY} FROM rises GROUP BY id, run
  UNION ALL
  SELECT c.id, c.run, min(x.ts_ms) + {DAY} FROM chain c
  JOIN rises x ON x.id = c.id AND x.run = c.run AND x.ts_ms > c.a GROUP BY c.id, c.run)
SELECT c.id, CAST(a AS BIGINT) AS alert_ms FROM chain c LEFT JOIN ends e ON e.id = c.id AND e.run = c.run
WHERE e.end_ts IS NULL OR a < e.end_ts""")
def rising_run_alert(spark, sf):
    """Alert when a sensor's temperature has kept rising for 1 day."""
    return ST.rising_alerts(_sensor(spark, sf), "id", "temperature", "ts_ms", "event_id", DAY)


@query("list_state_ticks", oracle="WITH RECURSIVE " + SENSOR + f"""
, chain(id, t) AS (
  SELECT id, min(ts_ms) + {DAY} FROM sensor GROUP BY id
  UNION ALL
  SELECT c.id, min(s.ts_ms) + {DAY} FROM chain c JOIN sensor s ON s.id = c.id AND s.ts_ms > c.t GROUP BY c.id)
SELECT c.id, CAST(c.t AS BIGINT) AS fire_ms, count(*) AS cnt
FROM chain c JOIN sensor s ON s.id = c.id AND s.ts_ms <= c.t GROUP BY ALL""")
def list_state_ticks(spark, sf):
    """I4: cumulative stored-row count per sensor at each 1-day round timer."""
    return ST.list_state_rounds(_sensor(spark, sf), "id", "ts_ms", "event_id", DAY)


def _orders(spark, sf):
    return ST.order_timeouts(S.order_events(S.events(spark, sf)), "order_id", "ts_ms", "event_type", DAY)


@query("order_paid_state", oracle=with_(ORDERS) +
       "SELECT order_id, event_id, ts_ms FROM oev WHERE event_type <> 'create'")
def order_paid_state(spark, sf):
    """Every pay event reported at once (keyed process function, no CEP)."""
    return _orders(spark, sf)[0].select("order_id", "event_id", "ts_ms")


@query("order_timeout_state", oracle=with_(ORDERS) + f"""
SELECT order_id, event_id, ts_ms, ts_ms + {DAY} AS deadline_ms FROM oev c
WHERE event_type = 'create' AND NOT EXISTS (
  SELECT 1 FROM oev p WHERE p.order_id = c.order_id AND p.event_type <> 'create'
    AND p.ts_ms > c.ts_ms AND p.ts_ms <= c.ts_ms + {DAY})""")
def order_timeout_state(spark, sf):
    """Creates with no payment within (ts, ts + 1 day], reported at the deadline."""
    return _orders(spark, sf)[1].select("order_id", "event_id", "ts_ms", "deadline_ms")
