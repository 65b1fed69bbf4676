"""Record schemas and the views that turn the driver tables into sensor data.

The reference's record is a water-level reading ``(id string, ts bigint
seconds, vc int)``. Batch frames also carry ``seq bigint``: arrival order,
which several operators depend on. ``seq`` must come from the data (an event
id, a Kafka offset, file + line), never from a global ``row_number()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENSOR = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("ts", T.LongType(), True),
    T.StructField("vc", T.IntegerType(), True),
])

SENSOR_SEQ = T.StructType(SENSOR.fields + [T.StructField("seq", T.LongType(), True)])

LINES = T.StructType([T.StructField("value", T.StringType(), True)])

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Arrival disorder used by the test views: a row arrives as if it were
# ``jitter`` rows later than its event id, jitter in [0, ARRIVAL_SPREAD).
ARRIVAL_SPREAD = 64
ARRIVAL_MIX = 7919


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(c: Column) -> Column:
    """timestamp_ntz -> whole epoch seconds (the wall time read as UTC).

    Date and time-of-day parts of a TIMESTAMP_NTZ carry no zone, so this is
    the same under any ``spark.sql.session.timeZone`` (a cast to TIMESTAMP
    would shift by the session zone's offset, DST included)."""
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return (days * 86400 + F.hour(c).cast("bigint") * 3600 + F.minute(c).cast("bigint") * 60
            + F.second(c).cast("bigint"))


def ntz_from_epoch(seconds: int) -> Column:
    """Epoch seconds as a TIMESTAMP_NTZ literal (zone-free), for predicates
    on raw timestamp columns that Parquet can push down."""
    return F.lit(ntz_text(seconds)).cast("timestamp_ntz")


def ntz_text(seconds: int) -> str:
    """Epoch seconds as the text of a TIMESTAMP_NTZ literal."""
    import datetime as _dt

    return (_dt.datetime(1970, 1, 1) + _dt.timedelta(seconds=int(seconds))).strftime("%Y-%m-%d %H:%M:%S")


def sensor(spark: SparkSession, sf_dir: str, min_ts: int | None = None) -> DataFrame:
    """``events`` as sensor readings in event-id (= time) order.

    id = 's' + user_id, ts = epoch seconds, vc = floor(value), seq = event_id.
    ``min_ts`` keeps ``ts >= min_ts``, stated on the raw column so the
    predicate reaches the Parquet scan (``floor`` to seconds is monotonic).
    """
    ev = table(spark, sf_dir, "events")
    if min_ts is not None:
        ev = ev.where(ev.ts >= ntz_from_epoch(min_ts))
    return ev.select(
        F.concat(F.lit("s"), ev.user_id.cast("string")).alias("id"),
        epoch_seconds(ev.ts).cast("bigint").alias("ts"),
        F.floor(ev.value).cast("int").alias("vc"),
        ev.event_id.cast("bigint").alias("seq"),
    )


def sensor_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`sensor` with the raw event time as ``event_time``, on which SQL
    states bounds that reach the Parquet scan."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("s"), ev.user_id.cast("string")).alias("id"),
        epoch_seconds(ev.ts).cast("bigint").alias("ts"),
        F.floor(ev.value).cast("int").alias("vc"),
        ev.event_id.cast("bigint").alias("seq"), ev.ts.alias("event_time"))


def arrival_seq(event_id: Column, spread: int = ARRIVAL_SPREAD) -> Column:
    """Unique arrival key: event e arrives at position e + j(e), ties by j.

    ``(e + j) * spread + j`` is injective for 0 <= j < spread, so the order is
    total without any global ranking.
    """
    j = F.pmod(event_id * F.lit(ARRIVAL_MIX), F.lit(spread))
    return (event_id + j) * F.lit(spread) + j


def sensor_arrivals(spark: SparkSession, sf_dir: str, spread: int = ARRIVAL_SPREAD) -> DataFrame:
    """Sensor readings whose arrival order ``seq`` is out of event-time order."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("s"), ev.user_id.cast("string")).alias("id"),
        epoch_seconds(ev.ts).cast("bigint").alias("ts"),
        F.floor(ev.value).cast("int").alias("vc"),
        arrival_seq(ev.event_id.cast("bigint"), spread).alias("seq"),
    )


# --- DuckDB twins of the views (used in oracle SQL) -------------------------

SQL_SENSOR = ("SELECT concat('s', CAST(user_id AS VARCHAR)) AS id, "
              "CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts, "
              "CAST(floor(value) AS INTEGER) AS vc, CAST(event_id AS BIGINT) AS seq FROM events")

SQL_SENSOR_ARRIVALS = (
    "SELECT concat('s', CAST(user_id AS VARCHAR)) AS id, "
    "CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts, "
    "CAST(floor(value) AS INTEGER) AS vc, "
    f"CAST((event_id + ((event_id * {ARRIVAL_MIX}) % {ARRIVAL_SPREAD} + {ARRIVAL_SPREAD}) % {ARRIVAL_SPREAD}) "
    f"* {ARRIVAL_SPREAD} + ((event_id * {ARRIVAL_MIX}) % {ARRIVAL_SPREAD} + {ARRIVAL_SPREAD}) % {ARRIVAL_SPREAD} "
    "AS BIGINT) AS seq FROM events")
