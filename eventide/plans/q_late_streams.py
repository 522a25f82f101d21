"""Streams over rows that arrive out of order, one slice of arrivals a micro-batch.

The feed of these queries is the ``events`` table dealt into files by arrival
time (up to three days behind event time); a stream takes one file per
trigger, so micro-batch numbers follow from the data and the oracles can state
them: every row of a slice meets the watermark left by the slices before it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F

from eventide.functions.time import epoch_ms_of, floor_div
from eventide.operators import windows as W
from eventide.plans import q_functions, q_late, q_sources, q_topn, q_windows
from eventide.plans.q_streams import _oracle, _run, _tws
from eventide.plans.registry import REGISTRY, query
from eventide.session import scratch_path
from eventide.sinks.document_source import read_documents, register_documents
from eventide.sinks.documents import to_documents
from eventide.sources import tables as S
from eventide.sources.files import parse_access_log
from eventide.sources.growing import growing_key_ts_lines
from eventide.streaming import stateful_windows as V
from eventide.streaming.feed import SLICE, arrival_feed
from eventide.streaming.late import row_is_late, split_late_batches, window_is_closed
from eventide.streaming.runner import (
    FLUSH_MS, bounded_delay, events_flush_row, file_stream, run_bounded, run_plan, stream_settings)
from eventide.streaming.sources import event_stream

_ = (q_functions, q_late, q_sources, q_topn, q_windows)     # batch twins register first

SECOND = 1_000
TEN_MIN = 600_000
HOUR = 3_600_000
DAY = 24 * HOUR
SPREAD_S = 3 * 86_400          # arrivals up to three days late
SLICE_MS = 3 * DAY             # one file of the feed
BOUND = DAY
LATENESS = DAY
TS = "(epoch_us(ts) // 1000)"


def _batches(bound: int, size: int = DAY) -> str:
    """CTE w: every row with the watermark of its micro-batch."""
    return f"""WITH a AS (SELECT event_id, user_id, event_type, {TS} AS ts_ms,
         ({TS} + (event_id * 7919 % {SPREAD_S}) * 1000) // {SLICE_MS} AS slice FROM events),
t AS (SELECT slice, max(ts_ms) AS top FROM a GROUP BY slice),
b AS (SELECT slice, max(top) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {bound} AS wm_ms FROM t),
w AS (SELECT event_id, user_id, event_type, ts_ms, slice, wm_ms, ts_ms // {size} * {size} + {size} AS window_end
      FROM a JOIN b USING (slice))
"""


def _feed(spark, sf, purpose, keep=None) -> tuple[str, object]:
    ev = S.read_table(spark, sf, "events")
    arrivals = S.with_arrival(S.events(spark, sf), SPREAD_S).select(*ev.columns, "arrival_ms")
    return arrival_feed(arrivals if keep is None else arrivals.filter(keep), "arrival_ms", SLICE_MS, f"feed-{purpose}")


def _flush(spark, sf) -> DataFrame:
    rows = events_flush_row(spark, S.read_table(spark, sf, "events"))
    return rows.withColumn("arrival_ms", F.lit(FLUSH_MS).cast("long")).withColumn(SLICE, F.lit(0).cast("long"))


def _split(spark, sf, purpose, rule, bound) -> DataFrame:
    path, schema = _feed(spark, sf, purpose)
    return run_bounded(spark, path, schema, _with_ms, purpose, max_files_per_trigger=1,
                       batch_writer=split_late_batches("ts_ms", bound, rule))


def _with_ms(s: DataFrame) -> DataFrame:
    return s.withColumn("ts_ms", epoch_ms_of(s, "ts"))


def _window_end(size: int = DAY):
    return floor_div(F.col("ts_ms"), size) * size + size


@query("stream_late_split", oracle=_batches(BOUND) + """
SELECT event_id, ts_ms, wm_ms, coalesce(ts_ms < wm_ms, false) AS is_late FROM w""")
def stream_late_split(spark, sf):
    """F2 on a stream: rows behind the kept watermark go to a second output."""
    out = _split(spark, sf, "stream_late_split", row_is_late("ts_ms"), BOUND)
    return out.select("event_id", "ts_ms", "wm_ms", (F.col("side") == "late").alias("is_late"))


@query("stream_late_window_rows", oracle=_batches(BOUND) + """
SELECT event_id, event_type, ts_ms, window_end, wm_ms FROM w WHERE window_end - 1 <= wm_ms""")
def stream_late_window_rows(spark, sf):
    """F1 side output on a stream: rows whose whole window was closed when their micro-batch began."""
    out = _split(spark, sf, "stream_late_window_rows", window_is_closed("ts_ms", DAY), BOUND)
    return out.filter(F.col("side") == "late").select("event_id", "event_type", "ts_ms", _window_end().alias("window_end"), "wm_ms")


@query("stream_late_window_counts", oracle=_batches(BOUND) + """
SELECT event_type, window_end, count(*) AS cnt FROM w WHERE NOT coalesce(window_end - 1 <= wm_ms, false) GROUP BY ALL""")
def stream_late_window_counts(spark, sf):
    """F1 main output on a stream: daily counts of the rows whose window was still open."""
    out = _split(spark, sf, "stream_late_window_counts", window_is_closed("ts_ms", DAY), BOUND)
    return out.filter(F.col("side") == "main").groupBy("event_type", _window_end().alias("window_end")).agg(F.count("*").alias("cnt"))


@query("stream_periodic_watermark", oracle=_batches(10 * SECOND, HOUR) + """
SELECT event_type, window_end, count(*) AS cnt FROM w WHERE NOT coalesce(window_end - 1 <= wm_ms, false) GROUP BY ALL""")
def stream_periodic_watermark(spark, sf):
    """A 10 s bound under a watermark that moves only between triggers; hourly counts of the rows it lets in."""
    out = _split(spark, sf, "stream_periodic_watermark", window_is_closed("ts_ms", HOUR), 10 * SECOND)
    return (out.filter(F.col("side") == "main").groupBy("event_type", _window_end(HOUR).alias("window_end"))
            .agg(F.count("*").alias("cnt")))


LATENESS_SQL = _batches(BOUND) + f"""
, k AS (SELECT *, CASE WHEN wm_ms IS NULL OR wm_ms < window_end - 1 THEN 0
                       WHEN wm_ms < window_end - 1 + {LATENESS} THEN 1 ELSE 2 END AS kind FROM w),
n AS (SELECT event_type, window_end, count(*) FILTER (WHERE kind = 0) AS n_on FROM k WHERE kind < 2 GROUP BY ALL),
e AS (SELECT event_type, window_end, 1 AS seq, n_on AS cnt FROM n WHERE n_on > 0
      UNION ALL
      SELECT event_type, window_end, nth + CASE WHEN n_on > 0 THEN 1 ELSE 0 END AS seq, n_on + nth AS cnt
      FROM (SELECT event_type, window_end, row_number() OVER (PARTITION BY event_type, window_end) AS nth FROM k WHERE kind = 1)
      JOIN n USING (event_type, window_end))
"""


def _lateness(spark, sf, purpose) -> DataFrame:
    path, schema = _feed(spark, sf, purpose)

    def build(s):
        counts = V.partial_counts(event_stream(s, f"{BOUND} milliseconds"), "event_type", "ts_ms", DAY)
        return counts.groupBy("event_type", "window_start").transformWithState(
            V.LateCounts("event_type", DAY, LATENESS), "event_type string, window_end long, seq long, cnt long, is_update boolean",
            "Append", "EventTime")
    return run_bounded(spark, path, schema, build, purpose, max_files_per_trigger=1, flush=_flush(spark, sf))


@query("stream_allowed_lateness", oracle=LATENESS_SQL + "SELECT event_type, window_end, seq, cnt FROM e")
def stream_allowed_lateness(spark, sf):
    """F3 on a stream: daily counts, a day's bound and a day's lateness; every emission."""
    return _lateness(spark, sf, "stream_allowed_lateness").select("event_type", "window_end", "seq", "cnt")


@query("stream_lateness_update_flag", oracle=LATENESS_SQL + "SELECT event_type, window_end, cnt, seq > 1 AS is_update FROM e")
def stream_lateness_update_flag(spark, sf):
    """F4 on a stream: each emission marked as first result or late update."""
    return _lateness(spark, sf, "stream_lateness_update_flag").select("event_type", "window_end", "cnt", "is_update")


@query("stream_cumulative_window", oracle=_oracle("cumulative_window"))
def stream_cumulative_window(spark, sf):
    """D17 on a stream: a timer that renews itself fires the day's running count every hour."""
    def build(s):
        counts = V.partial_counts(s, "event_type", "ts_ms", DAY, HOUR)
        return counts.groupBy("event_type", "window_start").transformWithState(
            V.CumulativeCounts("event_type", DAY, HOUR), "event_type string, window_end long, fire_ms long, cnt long",
            "Append", "EventTime")
    return _run(spark, sf, build, "stream_cumulative_window")


UNION_KINDS = {"clicks": "click", "views": "view"}


@query("stream_union_watermark", oracle=f"""
WITH a AS (SELECT event_id, {TS} AS ts_ms, CASE event_type WHEN 'click' THEN 'clicks' ELSE 'views' END AS stream,
                  ({TS} + (event_id * 7919 % {SPREAD_S}) * 1000) // {SLICE_MS} AS slice
           FROM events WHERE event_type IN ('click', 'view')),
n AS (SELECT *, dense_rank() OVER (PARTITION BY stream ORDER BY slice) AS batch FROM a),
t AS (SELECT batch, max(ts_ms) FILTER (WHERE stream = 'clicks') AS c, max(ts_ms) FILTER (WHERE stream = 'views') AS v
      FROM n GROUP BY batch),
m AS (SELECT batch, max(c) OVER o AS c, max(v) OVER o AS v FROM t
      WINDOW o AS (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, stream, ts_ms, CASE WHEN c IS NULL OR v IS NULL THEN NULL ELSE least(c, v) - {BOUND} END AS wm_ms
FROM n JOIN m USING (batch)""")
def stream_union_watermark(spark, sf):
    """C4 on a stream: two inputs, each with its own watermark; the union's is the lower of the two."""
    feeds = {name: _feed(spark, sf, f"union-{name}", F.col("event_type") == kind) for name, kind in UNION_KINDS.items()}

    def one(name):
        path, schema = feeds[name]
        s = event_stream(file_stream(spark, path, schema, max_files_per_trigger=1), f"{BOUND} milliseconds")
        # Without its time column a row is not dropped by the watermark it is to report.
        return s.select("event_id", F.lit(name).alias("stream"), "ts_ms")

    def make():
        u = one("clicks").unionByName(one("views")).withColumn("lane", F.pmod("event_id", F.lit(64)))
        return _tws(u, "lane", V.WatermarkSeen(("event_id", "stream", "ts_ms")),
                    "event_id long, stream string, ts_ms long, wm_ms long")
    return run_plan(spark, make, "stream_union_watermark")


def _top_of_windows(counts, n, item, item_type):
    tops = counts.select("window_end", item, "cnt").groupBy("window_end")
    return tops.transformWithState(V.TopOfWindow(n, item, item_type), f"window_end long, rank long, {item} {item_type}, cnt long",
                                   "Append", "EventTime")


@query("stream_hot_items_state", oracle=_oracle("hot_items_top3"))
def stream_hot_items_state(spark, sf):
    """E1 in one streaming plan: sliding counts, then list state and a timer per window end."""
    def build(s):
        return _top_of_windows(W.window_count(S.page_views(s), ["item_id"], 6 * HOUR, HOUR), 3, "item_id", "long")
    return _run(spark, sf, build, "stream_hot_items_state")


@query("stream_log_top5", oracle=_oracle("log_top5"))
def stream_log_top5(spark, sf):
    """E2 in one streaming plan: access-log lines, sliding counts per url, top 5 by list state and timer."""
    table = S.read_table(spark, sf, "events")
    # Log lines carry whole seconds: a row may seem up to a second older.
    delay = f"{bounded_delay(table, epoch_ms_of(table, 'ts')) + SECOND} milliseconds"

    def build(s):
        logs = event_stream(parse_access_log(S.access_log_lines(s)), delay)
        return _top_of_windows(W.window_count(logs, ["url"], HOUR, TEN_MIN), 5, "url", "string")
    return run_bounded(spark, f"{sf.rstrip('/')}/events.parquet", table.schema, build, "stream_log_top5",
                       flush=events_flush_row(spark, table))


PROC_WINDOW_S = 10


@query("stream_proctime_tumble_count", oracle=_oracle("group_count"))
def stream_proctime_tumble_count(spark, sf):
    """C6, D9, D11 on a stream: 10 s windows on the arrival clock, closed by the
    clock; over all windows a sensor's counts add up to its rows."""
    windows = proctime_windows(spark, sf)
    return windows.groupBy("id").agg(F.sum("cnt").alias("cnt"))


def proctime_windows(spark, sf) -> DataFrame:
    """(id, window_start, window_end, cnt) of rows as they arrive, one slice a trigger."""
    path, schema = _feed(spark, sf, "proctime")

    def build(s):
        arrived = S.sensor_readings(_with_ms(s)).withColumn("pt", F.current_timestamp()).withWatermark("pt", "0 seconds")
        counts = arrived.groupBy("id", F.window("pt", f"{PROC_WINDOW_S} seconds")).agg(F.count("*").alias("cnt"))
        return counts.select("id", F.unix_millis("window.start").alias("window_start"),
                             F.unix_millis("window.end").alias("window_end"), "cnt")

    def wait():
        """Until the clock has passed the window of the last rows."""
        time.sleep(PROC_WINDOW_S - time.time() % PROC_WINDOW_S + 0.1)
    return run_bounded(spark, path, schema, build, "stream_proctime", max_files_per_trigger=1,
                       flush=_flush(spark, sf), before_flush=wait)


@query("stream_key_time_lines", oracle=_oracle("key_time_lines_scan"))
def stream_key_time_lines(spark, sf):
    """A5: "key seconds" lines read by byte offsets from files that may grow."""
    path = f"{scratch_path(spark, 'growing-lines')}/data"
    rows = S.sensor_readings(S.events(spark, sf))
    seconds = F.call_function("div", F.col("ts_ms"), F.lit(1000)).cast("string")
    rows.select(F.concat("id", F.lit(" "), seconds)).write.text(path)
    return run_plan(spark, lambda: growing_key_ts_lines(spark, path).select("key", "ts_ms"), "stream_key_time_lines")


@query("stream_json_docs", oracle=_oracle("json_docs"))
def stream_json_docs(spark, sf):
    """A11 on a stream: documents committed a micro-batch at a time by the document data source."""
    path, schema = _feed(spark, sf, "json-docs")
    base = scratch_path(spark, "stream-json-docs")
    register_documents(spark)
    with stream_settings(spark):
        rows = S.sensor_readings(_with_ms(file_stream(spark, path, schema, max_files_per_trigger=1)))
        docs = to_documents(rows, "sensor", "SensorReading", ["id", "ts_ms", "temperature"])
        q = (docs.writeStream.format("json_documents").option("path", f"{base}/docs").option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return read_documents(spark, f"{base}/docs")


TIMER_MS = 1000
LANE_ROWS = 8192               # rows of the table for each lane of timers


@query("stream_processing_timer", oracle=f"""
SELECT id, CAST({TIMER_MS} AS BIGINT) AS waited_ms FROM (
  SELECT DISTINCT 'sensor_' || CAST(user_id AS VARCHAR) AS id, ({TS} + (event_id * 7919 % {SPREAD_S}) * 1000) // {SLICE_MS} AS slice FROM events)""")
def stream_processing_timer(spark, sf):
    """I2 as a query: a processing-time timer a second after each arrival of a
    sensor; what it waited does not depend on the clock."""
    path, schema = _feed(spark, sf, "processing-timer")
    lanes = max(64, S.read_table(spark, sf, "events").count() // LANE_ROWS)

    def build(s):
        arrived = S.sensor_readings(_with_ms(s)).select("id", V.lane_of("id", lanes).alias("lane"))
        return arrived.groupBy("lane").transformWithState(
            V.ArrivalTimers("id", TIMER_MS), "id string, waited_ms long", "Append", "ProcessingTime")

    def wait():
        time.sleep(TIMER_MS / 1000 + 0.1)
    return run_bounded(spark, path, schema, build, "stream_processing_timer", max_files_per_trigger=1,
                       flush=_flush(spark, sf), before_flush=wait, no_data_batches=False)
