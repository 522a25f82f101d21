"""Joins over ``events`` (G1-G3, G5, J1) and an orders/lineitem interval join."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions.time import epoch_ms_of
from eventide.operators import joins as J
from eventide.plans.registry import query
from eventide.sources import tables as S

HOUR = 3_600_000
DAY = 24 * HOUR
TS = "(epoch_us(ts) // 1000)"


def _side(ev, kind, id_name, ts_name):
    return (ev.filter(F.col("event_type") == kind)
              .select("user_id", F.col("event_id").alias(id_name), "ts", F.col("ts_ms").alias(ts_name)))


@query("window_join", oracle=f"""
WITH c AS (SELECT user_id, event_id AS left_id, {TS} // {DAY} AS w FROM events WHERE event_type = 'click'),
     v AS (SELECT user_id, event_id AS right_id, {TS} // {DAY} AS w FROM events WHERE event_type = 'view')
SELECT c.user_id, c.w * {DAY} + {DAY} AS window_end, left_id, right_id
FROM c JOIN v ON c.user_id = v.user_id AND c.w = v.w""")
def window_join(spark, sf):
    """G1: clicks and views of the same user in the same 1-day tumbling window, all pairs."""
    ev = S.events(spark, sf)
    left = _side(ev, "click", "left_id", "left_ts")
    right = _side(ev, "view", "right_id", "right_ts")
    return J.window_join(left, right, "user_id", DAY, left_cols=["left_id"], right_cols=["right_id"])


@query("interval_join", oracle=f"""
WITH c AS (SELECT user_id, event_id AS left_id, {TS} AS left_ts FROM events WHERE event_type = 'click'),
     v AS (SELECT user_id, event_id AS right_id, {TS} AS right_ts FROM events WHERE event_type = 'view')
SELECT c.user_id, left_id, left_ts, right_id, right_ts FROM c JOIN v
  ON c.user_id = v.user_id AND right_ts BETWEEN left_ts - {6 * HOUR} AND left_ts + {5 * HOUR}""")
def interval_join(spark, sf):
    """Views of the same user within [click - 6 h, click + 5 h], both ends inclusive."""
    ev = S.events(spark, sf)
    left = _side(ev, "click", "left_id", "left_ts").drop("ts")
    right = _side(ev, "view", "right_id", "right_ts").drop("ts")
    out = J.interval_join(left, right, "user_id", -6 * HOUR, 5 * HOUR, "left_ts", "right_ts")
    return out.select("user_id", "left_id", "left_ts", "right_id", "right_ts")


def _bills(spark, sf):
    ev = S.events(spark, sf)
    orders = _side(ev, "purchase", "order_event_id", "order_ts").drop("ts")
    pays = _side(ev, "click", "pay_event_id", "pay_ts").drop("ts")
    return J.reconcile(orders, pays, "user_id", HOUR)


_BILL_CTE = f"""WITH o AS (SELECT user_id, event_id AS order_event_id, {TS} AS order_ts FROM events
                  WHERE event_type = 'purchase'),
     p AS (SELECT user_id, event_id AS pay_event_id, {TS} AS pay_ts FROM events WHERE event_type = 'click')
"""


@query("reconcile_matched", oracle=_BILL_CTE + f"""
SELECT o.user_id, order_event_id, order_ts, pay_event_id, pay_ts FROM o JOIN p
  ON o.user_id = p.user_id AND abs(order_ts - pay_ts) <= {HOUR}""")
def reconcile_matched(spark, sf):
    """order/payment pairs of the same user within +-1 h."""
    return _bills(spark, sf)[0].select("user_id", "order_event_id", "order_ts", "pay_event_id", "pay_ts")


@query("reconcile_unmatched_orders", oracle=_BILL_CTE + f"""
SELECT user_id, order_event_id, order_ts FROM o WHERE NOT EXISTS
  (SELECT 1 FROM p WHERE p.user_id = o.user_id AND abs(order_ts - pay_ts) <= {HOUR})""")
def reconcile_unmatched_orders(spark, sf):
    """G3 side output: orders with no payment within +-1 h."""
    return _bills(spark, sf)[1].select("user_id", "order_event_id", "order_ts")


@query("reconcile_unmatched_pays", oracle=_BILL_CTE + f"""
SELECT user_id, pay_event_id, pay_ts FROM p WHERE NOT EXISTS
  (SELECT 1 FROM o WHERE p.user_id = o.user_id AND abs(order_ts - pay_ts) <= {HOUR})""")
def reconcile_unmatched_pays(spark, sf):
    """G3 side output: payments with no order within +-1 h."""
    return _bills(spark, sf)[2].select("user_id", "pay_event_id", "pay_ts")


@query("gate", oracle=f"""
WITH sw AS (SELECT user_id, {TS} AS sw_ts, (event_id % 24 + 1) * {HOUR} AS dur_ms FROM events
            WHERE event_type = 'signup'),
     r AS (SELECT event_id, user_id, {TS} AS ts_ms, value AS temperature FROM events
           WHERE event_type <> 'signup')
SELECT event_id, user_id, ts_ms, temperature FROM r WHERE EXISTS
  (SELECT 1 FROM sw WHERE sw.user_id = r.user_id AND r.ts_ms >= sw_ts AND r.ts_ms < sw_ts + dur_ms)""")
def gate(spark, sf):
    """Readings forwarded only while a switch (signup, open 1-24 h) of the user is on."""
    ev = S.events(spark, sf)
    switches = (ev.filter(F.col("event_type") == "signup")
                  .select("user_id", F.col("ts_ms").alias("sw_ts"),
                          ((F.col("event_id") % 24 + 1) * HOUR).alias("dur_ms")))
    readings = (ev.filter(F.col("event_type") != "signup")
                  .select("event_id", "user_id", "ts_ms", F.col("value").alias("temperature")))
    return J.gate(readings, switches, "user_id", "ts_ms", "sw_ts", "dur_ms", bucket_ms=DAY)


@query("union_two_streams", oracle=f"""
SELECT event_id, user_id, {TS} AS ts_ms, 'clicks' AS stream FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, user_id, {TS} AS ts_ms, 'views' AS stream FROM events WHERE event_type = 'view'""")
def union_two_streams(spark, sf):
    """Bag union of two same-typed streams."""
    ev = S.events(spark, sf)
    a = ev.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts_ms",
                                                         F.lit("clicks").alias("stream"))
    b = ev.filter(F.col("event_type") == "view").select("event_id", "user_id", "ts_ms",
                                                        F.lit("views").alias("stream"))
    return J.union_streams(a, b)


@query("order_ship_interval_join", oracle="""
SELECT o_orderkey, l_linenumber, o_custkey, epoch_us(o_orderdate) // 1000 AS order_ms,
       epoch_us(l_shipdate) // 1000 AS ship_ms, l_extendedprice * (1 - l_discount) AS revenue
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
 AND epoch_us(l_shipdate) // 1000 BETWEEN epoch_us(o_orderdate) // 1000
                                      AND epoch_us(o_orderdate) // 1000 + 7776000000""")
def order_ship_interval_join(spark, sf):
    """G2 at table scale: line items shipped within 90 days of their order date."""
    o = S.read_table(spark, sf, "orders")
    li = S.read_table(spark, sf, "lineitem")
    o = o.select("o_orderkey", "o_custkey", epoch_ms_of(o, "o_orderdate").alias("order_ms"))
    li = li.select("l_orderkey", "l_linenumber", epoch_ms_of(li, "l_shipdate").alias("ship_ms"),
                   (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    # o_orderkey is unique, so no order is hot: a plain equi-join with the range as a residual.
    out = li.join(o, (F.col("l_orderkey") == F.col("o_orderkey"))
                  & F.col("ship_ms").between(F.col("order_ms"), F.col("order_ms") + F.lit(90 * DAY)))
    return out.select("o_orderkey", "l_linenumber", "o_custkey",
                      "order_ms", "ship_ms", "revenue")
