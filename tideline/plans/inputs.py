"""Inputs of the registered queries, derived from the driver tables, with
their DuckDB twins.

* ``sensor``    -- ``events`` as readings, arrival order = event id (in time order)
* ``arrivals``  -- the same readings arriving out of time order
* ``doc_lines`` / ``doc_words`` -- ``documents.text`` as a line stream and its words
* ``left`` / ``right`` -- two sensor streams (clicks + views vs. the other events)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators.transforms import text_lines, tokenize

LEFT_TYPES = ("click", "view")


def sensor(spark: SparkSession, sf: str, min_ts: int | None = None) -> DataFrame:
    return schema.sensor(spark, sf, min_ts)


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return schema.sensor_arrivals(spark, sf)


def sensor_typed(spark: SparkSession, sf: str, arrival: bool = False) -> DataFrame:
    """Sensor rows with their event type (one scan of ``events``)."""
    ev = schema.table(spark, sf, "events")
    seq = schema.arrival_seq(ev.event_id.cast("bigint")) if arrival else ev.event_id.cast("bigint")
    return ev.select(F.concat(F.lit("s"), ev.user_id.cast("string")).alias("id"),
                     schema.epoch_seconds(ev.ts).cast("bigint").alias("ts"),
                     F.floor(ev.value).cast("int").alias("vc"), seq.alias("seq"), "event_type")


def left(spark: SparkSession, sf: str, arrival: bool = False) -> DataFrame:
    return sensor_typed(spark, sf, arrival).where(F.col("event_type").isin(*LEFT_TYPES)).drop("event_type")


def right(spark: SparkSession, sf: str, arrival: bool = False) -> DataFrame:
    return sensor_typed(spark, sf, arrival).where(~F.col("event_type").isin(*LEFT_TYPES)).drop("event_type")


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    return text_lines(schema.table(spark, sf, "documents").select("doc_id", "text"))


def doc_words(spark: SparkSession, sf: str) -> DataFrame:
    return tokenize(doc_lines(spark, sf))


def sensor_lines(spark: SparkSession, sf: str, malformed: bool = False) -> DataFrame:
    """``id,ts,vc,event_type`` text lines; with ``malformed`` the vc field of
    error events is written as ``<vc>.5`` (not an integer)."""
    t = sensor_typed(spark, sf)
    vc = F.col("vc").cast("string")
    if malformed:
        vc = F.when(F.col("event_type") == "error", F.concat(vc, F.lit(".5"))).otherwise(vc)
    return t.select(F.concat_ws(",", "id", F.col("ts").cast("string"), vc, "event_type").alias("value"), "seq")


# --- DuckDB twins ----------------------------------------------------------------

_A = schema.ARRIVAL_SPREAD
_J = f"(((event_id * {schema.ARRIVAL_MIX}) % {_A} + {_A}) % {_A})"

SQL_CTE = {
    "sensor": schema.SQL_SENSOR,
    "arrivals": schema.SQL_SENSOR_ARRIVALS,
    "sensor_typed": ("SELECT concat('s', CAST(user_id AS VARCHAR)) AS id, "
                     "CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts, CAST(floor(value) AS INTEGER) AS vc, "
                     "CAST(event_id AS BIGINT) AS seq, event_type FROM events"),
    "arrivals_typed": ("SELECT concat('s', CAST(user_id AS VARCHAR)) AS id, "
                       "CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts, CAST(floor(value) AS INTEGER) AS vc, "
                       f"CAST((event_id + {_J}) * {_A} + {_J} AS BIGINT) AS seq, event_type FROM events"),
    "doc_lines": ("SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS line_no, unnest(l) AS line "
                  "FROM (SELECT doc_id, CASE WHEN len(p) > 1 AND p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS l "
                  "FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))"),
    "doc_words": ("SELECT doc_id, line_no, CAST(generate_subscripts(w, 1) - 1 AS BIGINT) AS word_no, "
                  "unnest(w) AS word, 1 AS cnt FROM (SELECT doc_id, line_no, "
                  "CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[] "
                  "ELSE string_split(rtrim(line, ' '), ' ') END AS w FROM doc_lines)"),
}
SQL_CTE["left_s"] = f"SELECT id, ts, vc, seq FROM sensor_typed WHERE event_type IN {LEFT_TYPES!r}"
SQL_CTE["right_s"] = f"SELECT id, ts, vc, seq FROM sensor_typed WHERE event_type NOT IN {LEFT_TYPES!r}"
SQL_CTE["left_a"] = f"SELECT id, ts, vc, seq FROM arrivals_typed WHERE event_type IN {LEFT_TYPES!r}"
SQL_CTE["right_a"] = f"SELECT id, ts, vc, seq FROM arrivals_typed WHERE event_type NOT IN {LEFT_TYPES!r}"

_DEPS = {"doc_words": ["doc_lines"], "left_s": ["sensor_typed"], "right_s": ["sensor_typed"],
         "left_a": ["arrivals_typed"], "right_a": ["arrivals_typed"]}


def with_ctes(body: str, *names: str) -> str:
    """``WITH <needed views> <body>`` for the DuckDB oracle."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({SQL_CTE[n]})" for n in order) + "\n" + body


def sql_fmt_ms(expr: str) -> str:
    """DuckDB twin of ``format_millis``."""
    return f"strftime(make_timestamp(CAST({expr} AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S.%g')"


def sql_sensor_text(i: str, t: str, v: str) -> str:
    from ..functions.text import SENSOR_RECORD, sql_render

    return sql_render(SENSOR_RECORD, id=i, ts=t, vc=v)
