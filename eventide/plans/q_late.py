"""Late data and watermarks over out-of-order arrivals."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import late as L
from eventide.plans.registry import query
from eventide.sources import tables as S

HOUR = 3_600_000
DAY = 24 * HOUR
BOUND = 30 * 60_000
TS = "(epoch_us(ts) // 1000)"

ARRIVALS = f"""WITH a AS (SELECT event_id, user_id, event_type, {TS} AS ts_ms,
                     {TS} + (event_id * 7919 % 3600) * 1000 AS arrival_ms FROM events),
w AS (SELECT *, max(ts_ms) OVER (ORDER BY arrival_ms, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {BOUND} AS wm_ms,
             ts_ms // {HOUR} * {HOUR} + {HOUR} AS window_end FROM a)
"""


def _arrivals(spark, sf):
    return S.with_arrival(S.events(spark, sf)).select("event_id", "user_id", "event_type", "ts_ms", "arrival_ms")


@query("late_split", oracle=ARRIVALS + """
SELECT event_id, ts_ms, arrival_ms, wm_ms, coalesce(ts_ms < wm_ms, false) AS is_late FROM w""")
def late_split(spark, sf):
    """per-row late tag, late iff event time < watermark (30 min bound) at arrival."""
    out = L.split_late(_arrivals(spark, sf), "arrival_ms", "event_id", "ts_ms", BOUND)
    return out.select("event_id", "ts_ms", "arrival_ms", "wm_ms", "is_late")


@query("late_window_counts", oracle=ARRIVALS + """
SELECT event_type, window_end, count(*) AS cnt FROM w
WHERE NOT coalesce(window_end - 1 <= wm_ms, false) GROUP BY ALL""")
def late_window_counts(spark, sf):
    """F1 main output: hourly count per event type of rows whose window was still open."""
    counts, _ = L.late_window_split(_arrivals(spark, sf), "event_type", "arrival_ms", "event_id",
                                    "ts_ms", HOUR, BOUND)
    return counts


@query("late_window_rows", oracle=ARRIVALS + """
SELECT event_id, event_type, ts_ms, window_end, wm_ms FROM w WHERE window_end - 1 <= wm_ms""")
def late_window_rows(spark, sf):
    """F1 side output: rows whose whole window had closed when they arrived."""
    _, late = L.late_window_split(_arrivals(spark, sf), "event_type", "arrival_ms", "event_id",
                                  "ts_ms", HOUR, BOUND)
    return late.select("event_id", "event_type", "ts_ms", "window_end", "wm_ms")


LATENESS_SQL = ARRIVALS + f"""
, k AS (SELECT *, CASE WHEN wm_ms IS NULL OR wm_ms < window_end - 1 THEN 0
                       WHEN wm_ms < window_end - 1 + {BOUND} THEN 1 ELSE 2 END AS kind FROM w),
n AS (SELECT event_type, window_end, count(*) FILTER (WHERE kind = 0) AS n_on FROM k
      WHERE kind < 2 GROUP BY ALL),
e AS (SELECT event_type, window_end, 1 AS seq, n_on AS cnt FROM n WHERE n_on > 0
      UNION ALL
      SELECT k.event_type, k.window_end,
             row_number() OVER (PARTITION BY k.event_type, k.window_end ORDER BY arrival_ms, event_id)
               + CASE WHEN n_on > 0 THEN 1 ELSE 0 END AS seq,
             n_on + row_number() OVER (PARTITION BY k.event_type, k.window_end ORDER BY arrival_ms, event_id) AS cnt
      FROM k JOIN n ON k.event_type = n.event_type AND k.window_end = n.window_end WHERE kind = 1)
"""


@query("allowed_lateness", oracle=LATENESS_SQL + "SELECT event_type, window_end, seq, cnt FROM e")
def allowed_lateness(spark, sf):
    """hourly count per type with 30 min bound and 30 min allowed lateness; every emission."""
    out = L.allowed_lateness_counts(_arrivals(spark, sf), "event_type", "arrival_ms", "event_id",
                                    "ts_ms", HOUR, BOUND, BOUND)
    return out.select("event_type", "window_end", "seq", "cnt")


@query("lateness_update_flag", oracle=LATENESS_SQL +
       "SELECT event_type, window_end, cnt, seq > 1 AS is_update FROM e")
def lateness_update_flag(spark, sf):
    """each emission marked as first result or late update."""
    out = L.allowed_lateness_counts(_arrivals(spark, sf), "event_type", "arrival_ms", "event_id",
                                    "ts_ms", HOUR, BOUND, BOUND)
    return out.select("event_type", "window_end", "cnt", "is_update")


@query("union_watermark", oracle=f"""
WITH u AS (SELECT event_id, {TS} AS ts_ms, CASE event_type WHEN 'click' THEN 'clicks' ELSE 'views' END AS stream
           FROM events WHERE event_type IN ('click', 'view')),
m AS (SELECT *, max(CASE WHEN stream = 'clicks' THEN ts_ms END) OVER o AS m1,
                max(CASE WHEN stream = 'views' THEN ts_ms END) OVER o AS m2 FROM u
      WINDOW o AS (ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, stream, ts_ms, CASE WHEN m1 IS NULL OR m2 IS NULL THEN NULL
                                     ELSE least(m1, m2) - 1 END AS wm_ms FROM m""")
def union_watermark(spark, sf):
    """Union of two ascending streams; each row's watermark = min over inputs."""
    ev = S.events(spark, sf).filter(F.col("event_type").isin("click", "view"))
    u = ev.select("event_id", "ts_ms",
                  F.when(F.col("event_type") == "click", "clicks").otherwise("views").alias("stream"))
    out = L.union_watermark(u, "stream", ["clicks", "views"], "ts_ms", "event_id", "ts_ms", bound_ms=1)
    return out.select("event_id", "stream", "ts_ms", "wm_ms")


@query("cumulative_window", oracle=f"""
WITH e AS (SELECT event_type, {TS} AS ts_ms, {TS} // {DAY} * {DAY} AS ws FROM events),
f AS (SELECT event_type, ws, min(ts_ms) AS first_ts FROM e GROUP BY ALL),
t AS (SELECT event_type, ws, ws + k * {HOUR} AS fire_ms FROM f CROSS JOIN range(1, 25) r(k)
      WHERE ws + k * {HOUR} > first_ts)
SELECT t.event_type, t.ws + {DAY} AS window_end, fire_ms, count(*) AS cnt
FROM t JOIN e ON e.event_type = t.event_type AND e.ws = t.ws AND e.ts_ms < fire_ms GROUP BY ALL""")
def cumulative_window(spark, sf):
    """1-day window per event type re-emitting its running count every hour."""
    ev = S.events(spark, sf)
    return L.cumulative_window_count(ev, "event_type", "ts_ms", DAY, HOUR)
