"""Record views over the driver's ``events`` table.

The reference's jobs read sensors, user behaviour, marketing actions, logins,
orders and access logs.  The driver ships one ``events`` table, so each record
kind is a projection of it.  Every view keeps ``event_id`` (a unique arrival
tie-break), ``ts`` (TIMESTAMP_NTZ) and ``ts_ms`` (epoch ms BIGINT).

All views are plain projections/filters: Catalyst pushes their filters and
column choice into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventide.functions.time import epoch_ms_of

# Marketing channels of the jobs this library re-expresses.
CHANNELS = ["AppleStore", "XiaomiStore", "HuaweiStore"]

ITEM_MOD = 50          # item_id = event_id % 50
URL_MOD = 20           # url = '/page/' || event_id % 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "events")
    return df.withColumn("ts_ms", epoch_ms_of(df, "ts"))


def sensor_readings(ev: DataFrame, id: str | None = None) -> DataFrame:
    """SensorReading(id, ts, temperature) = ('sensor_' || user_id, ts, value).

    ``id`` keeps one sensor, tested on the raw user id so the predicate
    reaches the parquet scan."""
    if id is not None:
        number = id.removeprefix("sensor_")
        ev = ev.filter(F.col("user_id") == int(number)) if id != number and number.lstrip("-").isdigit() else ev.limit(0)
    return ev.select(
        "event_id",
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        "ts", "ts_ms",
        F.col("value").alias("temperature"),
    )


def user_behaviour(ev: DataFrame) -> DataFrame:
    """UserBehaviour: item = event_id % 50, behaviour 'pv' for views."""
    return ev.select(
        "event_id", "user_id",
        (F.col("event_id") % ITEM_MOD).alias("item_id"),
        (F.col("user_id") % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv"))
         .otherwise(F.col("event_type")).alias("behaviour"),
        "ts", "ts_ms",
    )


def page_views(ev: DataFrame) -> DataFrame:
    """UserBehaviour rows with behaviour 'pv', filtered on the raw column so
    the predicate reaches the parquet scan."""
    return user_behaviour(ev.filter(F.col("event_type") == "view"))


def channel_of(user_id: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CHANNELS]),
                        (F.pmod(user_id, F.lit(len(CHANNELS))) + 1).cast("int"))


def marketing(ev: DataFrame, drop_uninstall: bool = False) -> DataFrame:
    """Marketing actions: channel by user, error = UNINSTALL (optionally
    removed on the raw column, so the predicate reaches the scan)."""
    if drop_uninstall:
        ev = ev.filter(F.col("event_type") != "error")
    beh = (F.when(F.col("event_type") == "view", "BROWSE")
            .when(F.col("event_type") == "click", "CLICK")
            .when(F.col("event_type") == "error", "UNINSTALL")
            .otherwise("INSTALL"))
    return ev.select(
        "event_id", "user_id",
        beh.alias("behaviour"),
        channel_of(F.col("user_id")).alias("channel"),
        "ts", "ts_ms",
    )


def ip_of(n: Column) -> Column:
    return F.concat(F.lit("10."), (F.floor(n / 65536) % 256).cast("string"), F.lit("."),
                    (F.floor(n / 256) % 256).cast("string"), F.lit("."), (n % 256).cast("string"))


def logins(ev: DataFrame) -> DataFrame:
    """LoginEvent: error = 'fail', anything else = 'success'."""
    return ev.select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type"),
        ip_of(F.col("event_id")).alias("ip_addr"),
        "ts", "ts_ms",
    )


def order_events(ev: DataFrame) -> DataFrame:
    """OrderEvent: order = user, signup = 'create', purchase = 'pay'."""
    return (ev.filter(F.col("event_type").isin("signup", "purchase"))
              .select("event_id",
                      F.col("user_id").alias("order_id"),
                      F.when(F.col("event_type") == "signup", "create")
                       .otherwise("pay").alias("event_type"),
                      "ts", "ts_ms"))


def access_log_lines(ev: DataFrame) -> DataFrame:
    """Render events as access-log text lines (parsed back by ``parse_access_log``).

    Field layout after a split on ' ': 0 ip, 3 time dd/MM/yyyy:HH:mm:ss,
    5 method, 6 url.
    """
    page = F.concat(F.lit("/page/"), (F.col("event_id") % URL_MOD).cast("string"))
    # Every field has its place, also where it is unknown; a row without a
    # time has no line.
    line = F.concat(
        F.coalesce(ip_of(F.col("user_id")), F.lit("-")), F.lit(" - - "),
        F.date_format(F.col("ts"), "dd/MM/yyyy:HH:mm:ss"), F.lit(" +0000 "),
        F.when(F.col("event_type") == "purchase", "POST").otherwise("GET"), F.lit(" "),
        F.coalesce(page, F.lit("-")),
    )
    return ev.select(line.alias("value"))


def split_text(ev: DataFrame) -> DataFrame:
    """Text for the table function: event_type || '#' || props."""
    return ev.select("event_id", F.concat("event_type", F.lit("#"), "props").alias("s"))


ARRIVAL_SPREAD_S = 3600   # out-of-order arrival: up to one hour behind event time
ARRIVAL_MULT = 7919


def with_arrival(ev: DataFrame, spread_s: int = ARRIVAL_SPREAD_S) -> DataFrame:
    """Deterministic out-of-order arrival time: ts + (event_id * 7919 % spread_s) s.

    Rows arrive ordered by (arrival_ms, event_id).
    """
    delay = (F.col("event_id") * ARRIVAL_MULT % spread_s) * 1000
    return ev.withColumn("arrival_ms", F.col("ts_ms") + delay)
