"""Shared DuckDB CTEs for the oracle SQL: the same record views as
``eventide.sources.tables``, written in SQL over the registered tables."""

SENSOR = ("sensor AS (SELECT event_id, 'sensor_' || CAST(user_id AS VARCHAR) AS id, "
          "(epoch_us(ts) // 1000) AS ts_ms, value AS temperature FROM events)")

BEHAVIOUR = ("behaviour AS (SELECT event_id, user_id, event_id % 50 AS item_id, "
             "CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behaviour, "
             "(epoch_us(ts) // 1000) AS ts_ms FROM events)")

MARKETING = ("marketing AS (SELECT event_id, user_id, "
             "CASE event_type WHEN 'view' THEN 'BROWSE' WHEN 'click' THEN 'CLICK' "
             "WHEN 'error' THEN 'UNINSTALL' ELSE 'INSTALL' END AS behaviour, "
             "(['AppleStore', 'XiaomiStore', 'HuaweiStore'])[user_id % 3 + 1] AS channel, "
             "(epoch_us(ts) // 1000) AS ts_ms FROM events)")

LOGINS = ("logins AS (SELECT event_id, user_id, "
          "CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type, "
          "'10.' || CAST(event_id // 65536 % 256 AS VARCHAR) || '.' || "
          "CAST(event_id // 256 % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS ip_addr, "
          "(epoch_us(ts) // 1000) AS ts_ms FROM events)")

ORDERS = ("oev AS (SELECT event_id, user_id AS order_id, "
          "CASE WHEN event_type = 'signup' THEN 'create' ELSE 'pay' END AS event_type, "
          "(epoch_us(ts) // 1000) AS ts_ms FROM events WHERE event_type IN ('signup', 'purchase'))")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
