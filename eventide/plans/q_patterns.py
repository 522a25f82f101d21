"""Event patterns: three failed logins in a row (H1), order create -> pay (H2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators.patterns import followed_by_within, match_sequence
from eventide.plans.registry import query
from eventide.plans.sqlparts import LOGINS, ORDERS, with_
from eventide.sources import tables as S

DAY = 86_400_000


@query("login_fail_3", oracle=with_(LOGINS) + f"""
, s AS (SELECT user_id, ts_ms, event_type, ip_addr,
               lead(event_type, 1) OVER w AS t1, lead(event_type, 2) OVER w AS t2,
               lead(ip_addr, 1) OVER w AS ip2, lead(ip_addr, 2) OVER w AS ip3,
               lead(ts_ms, 2) OVER w AS ts3
        FROM logins WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, event_id))
SELECT user_id, ts_ms AS first_ts, ip_addr AS ip1, ip2, ip3 FROM s
WHERE event_type = 'fail' AND t1 = 'fail' AND t2 = 'fail' AND ts3 - ts_ms < {DAY}""")
def login_fail_3(spark, sf):
    """H1: three consecutive failed logins of a user within 1 day; the three IPs."""
    lg = S.logins(S.events(spark, sf))
    fail = F.col("event_type") == "fail"
    m = match_sequence(lg, ["user_id"], "ts_ms", "event_id", [fail, fail, fail], DAY, ["ip_addr"])
    return m.select("user_id", F.col("step0.ts_ms").alias("first_ts"),
                    F.col("step0.ip_addr").alias("ip1"), F.col("step1.ip_addr").alias("ip2"),
                    F.col("step2.ip_addr").alias("ip3"))


_NEXT = with_(ORDERS) + """
, s AS (SELECT order_id, event_id, event_type, ts_ms,
               lead(event_type) OVER w AS next_type, lead(ts_ms) OVER w AS next_ts,
               lead(event_id) OVER w AS next_id
        FROM oev WINDOW w AS (PARTITION BY order_id ORDER BY ts_ms, event_id))
"""


def _orders(spark, sf):
    oe = S.order_events(S.events(spark, sf))
    return followed_by_within(oe, ["order_id"], "ts_ms", "event_id",
                              F.col("event_type") == "create", F.col("event_type") == "pay",
                              DAY, ["event_id", "event_type"])


@query("order_match", oracle=_NEXT + f"""
SELECT order_id, event_id AS match_id, event_id, event_type, ts_ms FROM s
WHERE event_type = 'create' AND next_type = 'pay' AND next_ts - ts_ms < {DAY}
UNION ALL
SELECT order_id, event_id AS match_id, next_id AS event_id, next_type AS event_type, next_ts AS ts_ms FROM s
WHERE event_type = 'create' AND next_type = 'pay' AND next_ts - ts_ms < {DAY}""")
def order_match(spark, sf):
    """H2: create immediately followed by pay within 1 day; both events of each match."""
    m, _ = _orders(spark, sf)
    both = F.array(F.col("first"), F.col("second"))
    return m.select("order_id", F.col("first.event_id").alias("match_id"),
                    F.explode(both).alias("e")).select(
        "order_id", "match_id", F.col("e.event_id").alias("event_id"),
        F.col("e.event_type").alias("event_type"), F.col("e.ts_ms").alias("ts_ms"))


@query("order_timeout", oracle=_NEXT + f"""
SELECT order_id, event_id, ts_ms, ts_ms + {DAY} AS deadline_ms FROM s
WHERE event_type = 'create' AND (next_ts IS NULL OR next_ts - ts_ms >= {DAY})""")
def order_timeout(spark, sf):
    """H2 side output: creates with no next event within 1 day, with their deadline."""
    _, t = _orders(spark, sf)
    return t.select("order_id", "event_id", "ts_ms", "deadline_ms")
