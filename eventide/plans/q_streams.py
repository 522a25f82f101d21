"""Structured Streaming twins.

Each runs the streaming form of an operator over the ``events`` table read
as a file stream in place (``availableNow``, checkpointed under the shared
checkpoint root, flushed at the end) and returns what its sink holds.  They share the
oracle of their batch twin: same relation, computed incrementally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.operators import distinct as D
from eventide.operators import windows as W
from eventide.operators.bloom import distinct_bloom
from eventide.operators.topn import top_n_by_count
from eventide.plans import q_distinct, q_joins, q_patterns, q_state, q_topn, q_windows
from eventide.plans.registry import REGISTRY, query
from eventide.sources import tables as S
from eventide.streaming import processors as P
from eventide.functions.time import epoch_ms_of
from eventide.streaming.runner import (
    FLUSH_MS, append_batches, bounded_delay, events_flush_row, latest_complete, newest_per_key, numbered_batches,
    run_bounded)
from eventide.streaming.sources import event_stream
from eventide.streaming.stateful_windows import lane_of

HOUR = 3_600_000
DAY = 24 * HOUR

_ = (q_distinct, q_joins, q_patterns, q_state, q_topn, q_windows)  # batch twins register first


# Files per micro-batch of the table stream (None = all available at once).
MAX_FILES_PER_TRIGGER: int | None = None


def _oracle(name: str) -> str | None:
    return REGISTRY[name].oracle


def _run(spark, sf, build, purpose, **kw) -> DataFrame:
    path = f"{sf.rstrip('/')}/events.parquet"
    table = S.read_table(spark, sf, "events")
    flush = kw.pop("flush", True)
    delay = f"{bounded_delay(table, epoch_ms_of(table, 'ts'))} milliseconds"
    return run_bounded(spark, path, table.schema, lambda s: build(event_stream(s, delay)), purpose,
                       flush=events_flush_row(spark, table) if flush else None,
                       max_files_per_trigger=MAX_FILES_PER_TRIGGER, **kw)


@query("stream_tumble_count", oracle=_oracle("tumble_count"))
def stream_tumble_count(spark, sf):
    """D2 on a stream: append-mode tumbling count, windows released by the watermark."""
    return _run(spark, sf, lambda s: W.window_count(S.sensor_readings(s), ["id"], 6 * HOUR),
                "stream_tumble_count")


@query("stream_slide_count", oracle=_oracle("slide_count"))
def stream_slide_count(spark, sf):
    """D6 on a stream: sliding count per item."""
    def build(s):
        b = S.page_views(s)
        return W.window_count(b, ["item_id"], 6 * HOUR, HOUR)
    return _run(spark, sf, build, "stream_slide_count")


@query("stream_uv_incremental", oracle=_oracle("uv_incremental"))
def stream_uv_incremental(spark, sf):
    """D13/D14 on a stream: per-window dedup of users, then a count (two stateful steps)."""
    def build(s):
        return D.distinct_incremental(S.page_views(s), "user_id", HOUR)
    return _run(spark, sf, build, "stream_uv_incremental")


@query("stream_uv_bloom", oracle=_oracle("uv_bloom"))
def stream_uv_bloom(spark, sf):
    """D15 on a stream: bits per (window, bucket), then their count per window, released by the watermark."""
    return _run(spark, sf, lambda s: distinct_bloom(S.page_views(s), "user_id", DAY), "stream_uv_bloom")


@query("stream_hot_items_top3", oracle=_oracle("hot_items_top3"))
def stream_hot_items_top3(spark, sf):
    """E1 on a stream: sliding counts in append mode; every window's counts are
    released together, so top-3 per window is taken inside each micro-batch."""
    def build(s):
        b = S.page_views(s)
        return W.window_count(b, ["item_id"], 6 * HOUR, HOUR)

    def top3(batch):
        return top_n_by_count(batch, "window_end", "item_id", 3).select("window_end", "rank", "item_id", "cnt")
    return _run(spark, sf, build, "stream_hot_items", batch_writer=append_batches(top3))


@query("stream_group_count", oracle=_oracle("group_count"))
def stream_group_count(spark, sf):
    """D12 on a stream: unbounded group count in complete mode."""
    return _run(spark, sf, lambda s: W.group_count(S.sensor_readings(s), "id"),
                "stream_group_count", output_mode="complete", batch_writer=latest_complete(), flush=False)


@query("stream_window_join", oracle=_oracle("window_join"))
def stream_window_join(spark, sf):
    """G1 on a stream: stream-stream inner join on (user, 1-day window)."""
    from eventide.operators.joins import window_join

    def build(s):
        left = s.filter(F.col("event_type") == "click").select("user_id", F.col("event_id").alias("left_id"), "ts")
        right = s.filter(F.col("event_type") == "view").select("user_id", F.col("event_id").alias("right_id"), "ts")
        return window_join(left, right, "user_id", DAY, left_cols=["left_id"], right_cols=["right_id"])
    return _run(spark, sf, build, "stream_window_join", flush=False)


@query("stream_interval_join", oracle=_oracle("interval_join"))
def stream_interval_join(spark, sf):
    """G2 on a stream: event-time range join; both sides watermarked, so join
    state older than the range is evicted."""
    def build(s):
        left = s.filter(F.col("event_type") == "click").select(
            F.col("user_id").alias("l_user"), F.col("event_id").alias("left_id"),
            F.col("ts_ms").alias("left_ts"), F.col("ts").alias("l_time"))
        right = s.filter(F.col("event_type") == "view").select(
            F.col("user_id").alias("r_user"), F.col("event_id").alias("right_id"),
            F.col("ts_ms").alias("right_ts"), F.col("ts").alias("r_time"))
        cond = ((F.col("l_user") == F.col("r_user"))
                & (F.col("r_time") >= F.col("l_time") - F.expr("INTERVAL 6 HOURS"))
                & (F.col("r_time") <= F.col("l_time") + F.expr("INTERVAL 5 HOURS")))
        return left.join(right, cond, "inner").select(
            F.col("l_user").alias("user_id"), "left_id", "left_ts", "right_id", "right_ts")
    return _run(spark, sf, build, "stream_interval_join", flush=False)


def _tws(s, key, proc, schema):
    return s.groupBy(key).transformWithState(proc, schema, "Append", "EventTime")


LANE_ROWS = 8192               # rows of the table for each lane of timers


@query("stream_timer_deadlines", oracle=_oracle("timer_deadlines"))
def stream_timer_deadlines(spark, sf):
    """I1 on a stream: event-time timers in transformWithState, shared by the
    deadlines of a lane."""
    lanes = max(64, S.read_table(spark, sf, "events").count() // LANE_ROWS)

    def build(s):
        # A row without a time has no deadline; the event time stays, so late rows are seen.
        r = S.sensor_readings(s).filter(F.col("ts_ms").isNotNull())
        r = r.select("id", "ts", "ts_ms", lane_of(F.struct("id", "ts_ms"), lanes).alias("lane"))
        return r.groupBy("lane").transformWithStateInPandas(
            P.DeadlineTimers("id", 10_000), "id string, fire_ms long", "Append", "EventTime")
    return _run(spark, sf, build, "stream_timer_deadlines")


@query("stream_rising_run_alert", oracle=_oracle("rising_run_alert"))
def stream_rising_run_alert(spark, sf):
    """I3 on a stream: value + timer state, cancellable timer."""
    def build(s):
        r = S.sensor_readings(s)
        return _tws(r, "id", P.RisingAlert("id", "temperature", DAY), "id string, alert_ms long")
    return _run(spark, sf, build, "stream_rising_run_alert")


@query("stream_list_state_ticks", oracle=_oracle("list_state_ticks"))
def stream_list_state_ticks(spark, sf):
    """I4 on a stream: never-cleared count + round timer."""
    def build(s):
        r = S.sensor_readings(s)
        return _tws(r, "id", P.ListStateRounds("id", DAY), "id string, fire_ms long, cnt long")
    return _run(spark, sf, build, "stream_list_state_ticks")


@query("stream_order_timeout_state", oracle=_oracle("order_timeout_state"))
def stream_order_timeout_state(spark, sf):
    """I5 on a stream: pending creates in list state, settled by payments, timed out by timers."""
    def build(s):
        oe = S.order_events(s)
        return _tws(oe, "order_id", P.PendingCreates("order_id", DAY),
                    "order_id long, event_id long, ts_ms long, deadline_ms long")
    return _run(spark, sf, build, "stream_order_timeout_state")


@query("stream_login_fail_3", oracle=_oracle("login_fail_3"))
def stream_login_fail_3(spark, sf):
    """H1 on a stream: last two events per user in state."""
    def build(s):
        lg = S.logins(s)
        return _tws(lg, "user_id", P.ConsecutiveFails("user_id", "event_type", "fail", DAY),
                    "user_id long, first_ts long, ip1 string, ip2 string, ip3 string")
    return _run(spark, sf, build, "stream_login_fail_3")


def _followed_by(spark, sf, purpose):
    def build(s):
        oe = S.order_events(s)
        return _tws(oe, "order_id", P.FollowedBy("order_id", "event_type", "create", "pay", DAY),
                    "kind string, order_id long, match_id long, event_id long, event_type string, "
                    "ts_ms long, deadline_ms long")
    return _run(spark, sf, build, purpose)


@query("stream_order_match", oracle=_oracle("order_match"))
def stream_order_match(spark, sf):
    """H2 on a stream: create immediately followed by pay within 1 day (both events)."""
    out = _followed_by(spark, sf, "stream_order_match")
    return out.filter(F.col("kind") == "match").select("order_id", "match_id", "event_id", "event_type", "ts_ms")


@query("stream_order_timeout", oracle=_oracle("order_timeout"))
def stream_order_timeout(spark, sf):
    """H2 side output on a stream: creates timed out at their deadline."""
    out = _followed_by(spark, sf, "stream_order_timeout")
    return out.filter(F.col("kind") == "timeout").select("order_id", "event_id", "ts_ms", "deadline_ms")


@query("stream_gate", oracle=_oracle("gate"))
def stream_gate(spark, sf):
    """G5 on a stream: switches and readings of a user in one keyed processor."""
    def build(s):
        # A null user matches no switch, as in the join of the batch twin.
        x = s.filter(F.col("user_id").isNotNull()).select(
                     "event_id", "user_id", "ts_ms", F.col("value").alias("temperature"),
                     (F.col("event_type") == "signup").alias("is_switch"),
                     ((F.col("event_id") % 24 + 1) * HOUR).alias("dur_ms"))
        return _tws(x, "user_id", P.SwitchGate("user_id"),
                    "event_id long, user_id long, ts_ms long, temperature double")
    return _run(spark, sf, build, "stream_gate")


def _reconcile_stream(spark, sf, purpose):
    """G3 on a stream: full outer event-time range join, both sides watermarked;
    unmatched rows are released once the watermark passes their range."""
    def build(s):
        o = s.filter(F.col("event_type") == "purchase").select(
            F.col("user_id").alias("o_user"), F.col("event_id").alias("order_event_id"),
            F.col("ts_ms").alias("order_ts"), F.col("ts").alias("o_time"))
        p = s.filter(F.col("event_type") == "click").select(
            F.col("user_id").alias("p_user"), F.col("event_id").alias("pay_event_id"),
            F.col("ts_ms").alias("pay_ts"), F.col("ts").alias("p_time"))
        cond = ((F.col("o_user") == F.col("p_user"))
                & (F.col("p_time") >= F.col("o_time") - F.expr("INTERVAL 1 HOUR"))
                & (F.col("p_time") <= F.col("o_time") + F.expr("INTERVAL 1 HOUR")))
        return o.join(p, cond, "full_outer").select(
            "o_user", "order_event_id", "order_ts", "p_user", "pay_event_id", "pay_ts")

    def drop_flush(batch):
        return batch.filter(F.coalesce(F.col("order_ts"), F.col("pay_ts"), F.lit(0)) != FLUSH_MS)
    return _run(spark, sf, build, purpose, batch_writer=append_batches(drop_flush))


@query("stream_reconcile_matched", oracle=_oracle("reconcile_matched"))
def stream_reconcile_matched(spark, sf):
    """G3 matched pairs from the streaming full outer join."""
    out = _reconcile_stream(spark, sf, "stream_reconcile_matched")
    return out.filter(F.col("order_event_id").isNotNull() & F.col("pay_event_id").isNotNull()).select(
        F.col("o_user").alias("user_id"), "order_event_id", "order_ts", "pay_event_id", "pay_ts")


@query("stream_reconcile_unmatched_orders", oracle=_oracle("reconcile_unmatched_orders"))
def stream_reconcile_unmatched_orders(spark, sf):
    """G3 orders without a payment, released by the watermark."""
    out = _reconcile_stream(spark, sf, "stream_reconcile_unmatched_orders")
    return out.filter(F.col("pay_event_id").isNull()).select(
        F.col("o_user").alias("user_id"), "order_event_id", "order_ts")


@query("stream_reconcile_unmatched_pays", oracle=_oracle("reconcile_unmatched_pays"))
def stream_reconcile_unmatched_pays(spark, sf):
    """G3 payments without an order, released by the watermark."""
    out = _reconcile_stream(spark, sf, "stream_reconcile_unmatched_pays")
    return out.filter(F.col("order_event_id").isNull()).select(
        F.col("p_user").alias("user_id"), "pay_event_id", "pay_ts")


@query("stream_hot_items_sql", oracle=_oracle("hot_items_sql"))
def stream_hot_items_sql(spark, sf):
    """E3 on a stream: ROW_NUMBER is not allowed on a streaming plan, so the
    top-3 SQL runs inside foreachBatch over each batch's released windows."""
    def build(s):
        return W.window_count(S.page_views(s), ["item_id"], 6 * HOUR, HOUR)

    def top3_sql(batch):
        batch.createOrReplaceTempView("eventide_window_counts")
        return batch.sparkSession.sql("""
            SELECT window_end, CAST(rank AS BIGINT) AS rank, item_id, cnt FROM (
              SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank
              FROM eventide_window_counts) WHERE rank <= 3""")
    return _run(spark, sf, build, "stream_hot_items_sql", batch_writer=append_batches(top3_sql))


@query("stream_sensor_minmax_tumble", oracle=_oracle("sensor_minmax_tumble"))
def stream_sensor_minmax_tumble(spark, sf):
    """D1 on a stream: min/max per sensor and 1-day window, append mode."""
    return _run(spark, sf, lambda s: W.window_min_max(S.sensor_readings(s), "id", "temperature", DAY),
                "stream_sensor_minmax_tumble")


@query("stream_group_count_updates", oracle=_oracle("group_count"))
def stream_group_count_updates(spark, sf):
    """A9/D12 on a stream in update mode: each micro-batch emits only the keys
    whose count changed; the changelog is kept with its batch id, and the
    newest row per key is the current count."""
    log = _run(spark, sf, lambda s: W.group_count(S.sensor_readings(s), "id"), "stream_group_count_updates",
               output_mode="update", batch_writer=numbered_batches(), flush=False)
    return newest_per_key(log, "id").select("id", "cnt")


@query("stream_group_count_changelog", oracle=_oracle("group_count_changelog"))
def stream_group_count_changelog(spark, sf):
    """A9 on a stream: a retraction and an addition per row, in order."""
    def build(s):
        return _tws(S.sensor_readings(s), "id", P.CountChangelog("id"), "id string, seq long, is_add boolean, cnt long")
    return _run(spark, sf, build, "stream_group_count_changelog")


@query("stream_top2", oracle=_oracle("top2"))
def stream_top2(spark, sf):
    """K6 on a stream: two values of state per sensor; the newest emission of
    each sensor is its result."""
    def build(s):
        return _tws(S.sensor_readings(s), "id", P.TopValues("id", "temperature", 2), "id string, temperature double, rank long")
    log = _run(spark, sf, build, "stream_top2", batch_writer=numbered_batches(), flush=False)
    return newest_per_key(log, "id").select("id", "temperature", "rank")
