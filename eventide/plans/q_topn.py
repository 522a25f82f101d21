"""Top-N queries: hot items (E1, E3), hot urls from access logs (A3 + E2), top-2 (K6)."""

from __future__ import annotations

from eventide.operators import windows as W
from eventide.operators.topn import top_n_by_count, top_values
from eventide.plans.registry import query
from eventide.plans.sqlparts import BEHAVIOUR, SENSOR, with_
from eventide.sources import tables as S
from eventide.sources.files import parse_access_log

HOUR = 3_600_000
TEN_MIN = 600_000

HOT_ITEMS_SQL = (with_(BEHAVIOUR) + f"""
, c AS (SELECT item_id, (ts_ms // {HOUR} - j) * {HOUR} + {6 * HOUR} AS window_end, count(*) AS cnt
        FROM behaviour CROSS JOIN range(0, 6) t(j) WHERE behaviour = 'pv' GROUP BY ALL)
SELECT window_end, rank, item_id, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM c)
WHERE rank <= 3""")


def hot_items(spark, sf, n: int = 3):
    b = S.page_views(S.events(spark, sf))
    counts = W.window_count(b, ["item_id"], 6 * HOUR, HOUR)
    return top_n_by_count(counts, "window_end", "item_id", n).select("window_end", "rank", "item_id", "cnt")


@query("hot_items_top3", oracle=HOT_ITEMS_SQL)
def hot_items_top3(spark, sf):
    """Top-3 items by views per sliding window (6 h every 1 h)."""
    return hot_items(spark, sf, 3)


@query("hot_items_sql", oracle=HOT_ITEMS_SQL)
def hot_items_sql(spark, sf):
    """The same top-3 written as SQL with ROW_NUMBER over a HOP aggregate."""
    S.page_views(S.events(spark, sf)).createOrReplaceTempView("eventide_behaviour")
    return spark.sql("""
        SELECT window_end, CAST(rank AS BIGINT) AS rank, item_id, cnt FROM (
          SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank
          FROM (SELECT item_id,
                       timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', window.end) AS window_end,
                       count(*) AS cnt
                FROM eventide_behaviour WHERE behaviour = 'pv'
                GROUP BY item_id, window(ts, '6 hours', '1 hour')))
        WHERE rank <= 3""")


@query("log_top5", oracle=f"""
WITH logs AS (SELECT '/page/' || CAST(event_id % 20 AS VARCHAR) AS url,
                     (epoch_us(ts) // 1000) // 1000 * 1000 AS ts_ms FROM events),
c AS (SELECT url, (ts_ms // {TEN_MIN} - j) * {TEN_MIN} + {HOUR} AS window_end, count(*) AS cnt
      FROM logs CROSS JOIN range(0, 6) t(j) GROUP BY ALL)
SELECT window_end, rank, url, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rank FROM c)
WHERE rank <= 5""")
def log_top5(spark, sf):
    """A3 + E2: parse access-log lines, count per url over 1 h every 10 min, top 5."""
    logs = parse_access_log(S.access_log_lines(S.events(spark, sf)))
    counts = W.window_count(logs, ["url"], HOUR, TEN_MIN)
    return top_n_by_count(counts, "window_end", "url", 5).select("window_end", "rank", "url", "cnt")


@query("top2", oracle=with_(SENSOR) + """
SELECT id, temperature, rank FROM (
  SELECT id, temperature, row_number() OVER (PARTITION BY id ORDER BY temperature DESC) AS rank FROM sensor)
WHERE rank <= 2""")
def top2(spark, sf):
    """K6: table-aggregate top-2 temperatures per sensor with their rank."""
    return top_values(S.sensor_readings(S.events(spark, sf)), "id", "temperature", 2)
