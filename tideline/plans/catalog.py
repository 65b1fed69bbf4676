"""Registered queries: one per operator, each with its DuckDB oracle.

Every query reads the driver tables (through :mod:`.inputs`) and runs over
all of their rows. Window sizes are the reference's scaled to the data:
the reference's sensors report every second, the ``events`` table about
every few minutes per user, so seconds become hours or days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import accumulators as acc
from ..functions.aggregate import weighted_avg
from ..functions.scalar import java_hash, java_string_hash
from ..functions.table import register_split_words_sql, split_words
from ..operators import changelog, joins, keyed, lateness, over, topn, transforms, windows
from ..sources import kafka
from ..sources.lines import parse_sensor_lines
from . import inputs as I
from .inputs import sql_fmt_ms, sql_sensor_text, with_ctes

HOUR, DAY = 3600, 86400
# scaled parameters of the reference jobs
TUMBLE = DAY               # keyed tumbling aggregates (5 s in the reference)
SLIDE_SIZE, SLIDE_STEP = 2 * HOUR, HOUR   # sliding Top-N (10 s / 5 s)
LATE_WINDOW, LATE_DELAY, LATENESS = HOUR, 600, 1800   # 10 s / 3 s / 2 s
RANGE = DAY                # OVER range (10 s)
JOIN_LOWER, JOIN_UPPER = -2 * HOUR, HOUR   # interval join (-2 s, +1 s)
SESSION_GAP = HOUR
TTL = 12 * HOUR
FILTER_TS = 1705000000
TOPIC = "ws"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _tumble_sql(src: str, ts_expr: str, size: int = TUMBLE) -> str:
    return with_ctes(
        f"SELECT id, ts - ts % {size} AS window_start, ts - ts % {size} + {size} AS window_end, "
        f"{ts_expr} AS ts, CAST(sum(vc) AS BIGINT) AS vc FROM {src} GROUP BY id, ts - ts % {size}", src)


# ---------------------------------------------------------------- sources (2.1)

@register("parse_sensor_lines", with_ctes(
    "SELECT split_part(v, ',', 1) AS id, CAST(split_part(v, ',', 2) AS BIGINT) AS ts, "
    "CAST(split_part(v, ',', 3) AS INTEGER) AS vc, seq FROM (SELECT concat_ws(',', id, CAST(ts AS VARCHAR), "
    "CAST(vc AS VARCHAR), event_type) AS v, seq FROM sensor_typed)", "sensor_typed"))
def q_parse_sensor_lines(spark, sf):
    return parse_sensor_lines(I.sensor_lines(spark, sf), mode="FAILFAST")


@register("parse_sensor_lines_permissive", with_ctes(
    "SELECT split_part(v, ',', 1) AS id, CAST(split_part(v, ',', 2) AS BIGINT) AS ts, "
    "CAST(split_part(v, ',', 3) AS INTEGER) AS vc, seq FROM (SELECT concat_ws(',', id, CAST(ts AS VARCHAR), "
    "CASE WHEN event_type = 'error' THEN concat(CAST(vc AS VARCHAR), '.5') ELSE CAST(vc AS VARCHAR) END, "
    "event_type) AS v, seq FROM sensor_typed) WHERE regexp_matches(split_part(v, ',', 3), '^[+-]?[0-9]+$')",
    "sensor_typed"))
def q_parse_permissive(spark, sf):
    return parse_sensor_lines(I.sensor_lines(spark, sf, malformed=True), mode="PERMISSIVE")


@register("kafka_value_rows", with_ctes(
    f"SELECT '{TOPIC}' AS topic, concat_ws(',', id, CAST(ts AS VARCHAR), CAST(vc AS VARCHAR)) AS value, seq "
    "FROM sensor", "sensor"))
def q_kafka_value_rows(spark, sf):
    s = I.sensor(spark, sf)
    lines = s.select(F.concat_ws(",", "id", F.col("ts").cast("string"), F.col("vc").cast("string")).alias("value"), "seq")
    return kafka.value_rows(lines, TOPIC, keep=("seq",))


@register("kafka_keyed_rows", with_ctes(
    f"SELECT '{TOPIC}' AS topic, id AS key, concat_ws(',', id, CAST(ts AS VARCHAR), CAST(vc AS VARCHAR)) AS value, "
    "seq FROM sensor", "sensor"))
def q_kafka_keyed_rows(spark, sf):
    s = I.sensor(spark, sf)
    lines = s.select(F.concat_ws(",", "id", F.col("ts").cast("string"), F.col("vc").cast("string")).alias("value"), "seq")
    return kafka.keyed_rows(lines, TOPIC, keep=("seq",), binary=False)


# ---------------------------------------------------- projections, filters (2.2)

@register("project_id", with_ctes("SELECT id FROM sensor", "sensor"))
def q_project_id(spark, sf):
    return transforms.project_id(I.sensor(spark, sf))


@register("tokenize", with_ctes("SELECT doc_id, line_no, word_no, word, cnt FROM doc_words", "doc_words"))
def q_tokenize(spark, sf):
    return I.doc_words(spark, sf)


@register("filter_ts", with_ctes(f"SELECT id, ts, vc FROM sensor WHERE ts >= {FILTER_TS}", "sensor"))
def q_filter_ts(spark, sf):
    # the bound is also stated on the raw column so it reaches the parquet scan
    return transforms.filter_ts(I.sensor(spark, sf, min_ts=FILTER_TS), FILTER_TS).select("id", "ts", "vc")


@register("sql_on_view", with_ctes(f"SELECT id, ts, vc FROM sensor WHERE ts >= {FILTER_TS}", "sensor"))
def q_sql_on_view(spark, sf):
    # the view shows the raw event time as well: a bound on it reaches the parquet scan,
    # and whole seconds make it the same bound as one on ts
    from ..schema import ntz_text, sensor_view
    sensor_view(spark, sf).createOrReplaceTempView("sensor")
    return spark.sql(f"SELECT id, ts, vc FROM sensor WHERE event_time >= TIMESTAMP_NTZ '{ntz_text(FILTER_TS)}'")


_JSON_VALUES = {  # column of the query's input -> (Spark, DuckDB)
    "props": ("props", "props"),
    "event_type": ("event_type", "event_type"),
    "repeated": ("concat('{\"a\":1,\"a\":', event_id, ',\"b\":', props, '}')",
                 "concat('{\"a\":1,\"a\":', event_id, ',\"b\":', props, '}')"),
    "array": ("concat('[', props, ']')", "concat('[', props, ']')"),
    "broken": ("left(props, length(props) - 1)", "left(props, length(props) - 1)"),
    "trailing": ("concat(props, ' x')", "concat(props, ' x')"),
    "empty": ("''", "''"),
    "null": ("cast(null as string)", "CAST(NULL AS VARCHAR)"),
    "json_null": ("'null'", "'null'"),
}


@register("json_filter", "SELECT src, value FROM (" + " UNION ALL ".join(
    f"SELECT '{src}' AS src, {sql} AS value FROM events" for src, (_, sql) in _JSON_VALUES.items())
    + ") WHERE CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END")
def q_json_filter(spark, sf):
    from ..schema import table
    values = F.array(*[F.struct(F.lit(src).alias("src"), F.expr(expr).alias("value"))
                       for src, (expr, _) in _JSON_VALUES.items()])
    lines = table(spark, sf, "events").select(F.explode(values).alias("v")).select("v.src", "v.value")
    return transforms.json_filter(lines, "value")


@register("split_by_prefix", with_ctes(
    "SELECT doc_id, line_no, CASE WHEN starts_with(line, 'a') THEN 'a' WHEN starts_with(line, 'b') THEN 'b' "
    "ELSE 'main' END AS branch FROM (SELECT doc_id, line_no, lower(line) AS line FROM doc_lines)", "doc_lines"))
def q_split_by_prefix(spark, sf):
    lines = I.doc_lines(spark, sf).select("doc_id", "line_no", F.lower("line").alias("line"))
    return transforms.split_by_prefix(lines, "line").select("doc_id", "line_no", "branch")


@register("derive_key", with_ctes(
    "SELECT id, ts, vc, seq, CASE WHEN substr(id, 1, 1) IN ('a', 'b', 's') THEN substr(id, 1, 1) ELSE '' END "
    "AS prefix_key, CASE WHEN vc % 2 = 0 THEN '偶数' ELSE '奇数' END AS parity_key, vc % 3 AS mod3_key "
    "FROM sensor", "sensor"))
def q_derive_key(spark, sf):
    return transforms.derive_key(I.sensor(spark, sf))


@register("partition_by_key", with_ctes(
    "SELECT CAST(((vc % 4) + 4) % 4 AS INTEGER) AS partition, count(*) AS cnt FROM sensor GROUP BY 1", "sensor"))
def q_partition_by_key(spark, sf):
    return transforms.partition_counts(I.sensor(spark, sf), F.col("vc"), 4)


@register("key_trace", with_ctes("SELECT id, ts, vc, seq, id AS key FROM sensor", "sensor"))
def q_key_trace(spark, sf):
    return transforms.key_trace(I.sensor(spark, sf), "id").drop("subtask")


# --------------------------------------------------------------- joins (2.3)

@register("window_join", with_ctes(
    f"SELECT l.id, l.ts - l.ts % {DAY} AS window_start, l.ts - l.ts % {DAY} + {DAY} AS window_end, "
    "l.ts AS l_ts, l.vc AS l_vc, r.ts AS r_ts, r.vc AS r_vc, "
    f"concat({sql_sensor_text('l.id', 'l.ts', 'l.vc')}, '---->', {sql_sensor_text('r.id', 'r.ts', 'r.vc')}) AS text "
    f"FROM left_s l JOIN right_s r ON l.id = r.id AND l.ts - l.ts % {DAY} = r.ts - r.ts % {DAY}",
    "left_s", "right_s"))
def q_window_join(spark, sf):
    return joins.window_join(I.left(spark, sf), I.right(spark, sf), DAY)


_INTERVAL_SQL = with_ctes(
    "SELECT l.id, l.ts AS l_ts, l.vc AS l_vc, r.ts AS r_ts, r.vc AS r_vc, "
    f"concat({sql_sensor_text('l.id', 'l.ts', 'l.vc')}, '--->', {sql_sensor_text('r.id', 'r.ts', 'r.vc')}) AS text "
    f"FROM left_s l JOIN right_s r ON l.id = r.id AND r.ts BETWEEN l.ts + ({JOIN_LOWER}) AND l.ts + {JOIN_UPPER}",
    "left_s", "right_s")


@register("interval_join", _INTERVAL_SQL)
def q_interval_join(spark, sf):
    return joins.interval_join(I.left(spark, sf), I.right(spark, sf), JOIN_LOWER, JOIN_UPPER)


@register("interval_join_plain", _INTERVAL_SQL)
def q_interval_join_plain(spark, sf):
    return joins.interval_join_plain(I.left(spark, sf), I.right(spark, sf), JOIN_LOWER, JOIN_UPPER)


@register("interval_join_late", with_ctes(f"""
SELECT side, id, ts, vc, seq, wm FROM (
  SELECT *, CASE WHEN ml IS NULL OR mr IS NULL THEN NULL ELSE least(ml, mr) - {LATE_DELAY} END AS wm FROM (
    SELECT *, max(CASE WHEN side = 'left' THEN ts END) OVER w AS ml,
              max(CASE WHEN side = 'right' THEN ts END) OVER w AS mr
    FROM (SELECT 'left' AS side, * FROM left_a UNION ALL SELECT 'right' AS side, * FROM right_a)
    WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
WHERE ts < wm""", "left_a", "right_a"))
def q_interval_join_late(spark, sf):
    return lateness.interval_join_late(I.left(spark, sf, True), I.right(spark, sf, True), LATE_DELAY)


_MARKED_SQL = f"""(
  SELECT *, CASE WHEN ml IS NULL OR mr IS NULL THEN false ELSE ts < least(ml, mr) - {LATE_DELAY} END AS late FROM (
    SELECT *, max(CASE WHEN side = 'left' THEN ts END) OVER w AS ml,
              max(CASE WHEN side = 'right' THEN ts END) OVER w AS mr
    FROM (SELECT 'left' AS side, * FROM left_a UNION ALL SELECT 'right' AS side, * FROM right_a)
    WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""


@register("interval_join_on_time", with_ctes(f"""
SELECT l.id, l.ts AS l_ts, l.vc AS l_vc, r.ts AS r_ts, r.vc AS r_vc,
       concat({sql_sensor_text('l.id', 'l.ts', 'l.vc')}, '--->', {sql_sensor_text('r.id', 'r.ts', 'r.vc')}) AS text
FROM {_MARKED_SQL} l JOIN {_MARKED_SQL} r
  ON l.side = 'left' AND r.side = 'right' AND NOT l.late AND NOT r.late AND l.id = r.id
 AND r.ts BETWEEN l.ts + ({JOIN_LOWER}) AND l.ts + {JOIN_UPPER}""", "left_a", "right_a"))
def q_interval_join_on_time(spark, sf):
    return lateness.interval_join_on_time(I.left(spark, sf, True), I.right(spark, sf, True), JOIN_LOWER, JOIN_UPPER,
                                          LATE_DELAY)


@register("event_timer", with_ctes(f"""
SELECT id, CAST({FILTER_TS} AS BIGINT) AS timer, count(*) AS registered, fired_at
FROM (SELECT id, min(CASE WHEN ts > {FILTER_TS + LATE_DELAY} AND (top IS NULL OR ts > top) THEN seq END)
               OVER (ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fired_at
      FROM (SELECT id, ts, seq, max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
            FROM arrivals))
WHERE fired_at IS NOT NULL GROUP BY id, fired_at""", "arrivals"))
def q_event_timer(spark, sf):
    return lateness.event_timer(I.arrivals(spark, sf), FILTER_TS, LATE_DELAY)


@register("broadcast_threshold", with_ctes(f"""
SELECT id, ts, vc, seq, threshold,
       concat({sql_sensor_text('id', 'ts', 'vc')}, ',水位超过指定阈值：', CAST(threshold AS VARCHAR), '!!!') AS text
FROM (
  SELECT *, coalesce(last_value(cfg IGNORE NULLS) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS threshold
  FROM (SELECT id, ts, vc, seq, CAST(NULL AS INTEGER) AS cfg, true AS is_data FROM arrivals_typed WHERE event_type <> 'error'
        UNION ALL SELECT NULL, NULL, NULL, seq, vc, false FROM arrivals_typed WHERE event_type = 'error'))
WHERE is_data AND vc >= threshold""", "arrivals_typed"))
def q_broadcast_threshold(spark, sf):
    t = I.sensor_typed(spark, sf, arrival=True)
    data = t.where(F.col("event_type") != "error").drop("event_type")
    config = t.where(F.col("event_type") == "error").select(F.col("vc").alias("threshold"), "seq")
    return joins.broadcast_threshold(data, config)


@register("lateral_split", with_ctes(
    "SELECT doc_id, line_no, word, CAST(length(word) AS INTEGER) AS length FROM doc_words", "doc_words"))
def q_lateral_split(spark, sf):
    register_split_words_sql(spark, "split_words")
    I.doc_lines(spark, sf).createOrReplaceTempView("doc_lines")
    return spark.sql("SELECT l.doc_id, l.line_no, w.word, w.length FROM doc_lines l, LATERAL split_words(l.line) w")


@register("split_words", with_ctes(
    "SELECT doc_id, line_no, word_no, word, CAST(length(word) AS INTEGER) AS length FROM doc_words", "doc_words"))
def q_split_words(spark, sf):
    return split_words(I.doc_lines(spark, sf), "line", keep=("doc_id", "line_no"))


# -------------------------------------------------------- aggregations (2.4)

@register("word_count_running", with_ctes(
    "SELECT doc_id, line_no, word_no, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, word_no "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM doc_words", "doc_words"))
def q_word_count_running(spark, sf):
    from ..operators.scan import Scan, prefix_scan
    w = I.doc_words(spark, sf)
    return prefix_scan(w.drop("cnt"), ["doc_id", "line_no", "word_no"], [Scan("cnt", F.lit(1), "count")], "word")


@register("word_count_final", with_ctes("SELECT word, count(*) AS cnt FROM doc_words GROUP BY word", "doc_words"))
def q_word_count_final(spark, sf):
    return I.doc_words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@register("tumbling_sum", _tumble_sql("arrivals", "arg_min(ts, seq)"))
def q_tumbling_sum(spark, sf):
    return windows.tumbling_sum(I.arrivals(spark, sf), TUMBLE)


@register("tumbling_reduce", _tumble_sql("arrivals", "arg_max(ts, seq)"))
def q_tumbling_reduce(spark, sf):
    return windows.tumbling_reduce(I.arrivals(spark, sf), TUMBLE)


@register("tumbling_aggregate", _tumble_sql("arrivals", "arg_max(ts, seq)"))
def q_tumbling_aggregate(spark, sf):
    return windows.tumbling_aggregate(I.arrivals(spark, sf), TUMBLE)


@register("tumbling_process", _tumble_sql("arrivals", "max(ts)"))
def q_tumbling_process(spark, sf):
    return windows.tumbling_process(I.arrivals(spark, sf), TUMBLE)


@register("tumbling_agg_format", with_ctes(
    f"SELECT *, concat(id, ':[', {sql_sensor_text('id', 'ts', 'vc')}, '],') AS text FROM ("
    + _tumble_sql("arrivals", "arg_max(ts, seq)").split("\n", 1)[1] + ")", "arrivals"))
def q_tumbling_agg_format(spark, sf):
    return windows.tumbling_agg_format(I.arrivals(spark, sf), TUMBLE)


@register("parity_window_reduce", with_ctes(
    "SELECT parity, window_start, window_start + 3600 AS window_end, total, "
    "concat('key：', parity, '[', CAST(total AS VARCHAR), ']') AS text FROM ("
    "SELECT CASE WHEN vc % 2 = 0 THEN '偶数' ELSE '奇数' END AS parity, ts - ts % 3600 AS window_start, "
    "CAST(sum(vc) AS BIGINT) AS total FROM sensor GROUP BY 1, 2)", "sensor"))
def q_parity_window_reduce(spark, sf):
    return windows.parity_window_reduce(I.sensor(spark, sf), HOUR)


@register("sql_group_sum", with_ctes("SELECT id, CAST(sum(vc) AS BIGINT) AS sumVc FROM sensor GROUP BY id", "sensor"))
def q_sql_group_sum(spark, sf):
    I.sensor(spark, sf).createOrReplaceTempView("sensor")
    return spark.sql("SELECT id, sum(vc) AS sumVc FROM sensor GROUP BY id")


@register("table_api_group_sum", with_ctes("SELECT id, CAST(sum(vc) AS BIGINT) AS sumVc FROM sensor GROUP BY id",
                                           "sensor"))
def q_table_api_group_sum(spark, sf):
    return I.sensor(spark, sf).groupBy("id").agg(F.sum("vc").alias("sumVc"))


@register("group_sum_changelog", with_ctes("""
SELECT id, seq, op_no, op, sumVc FROM (
  SELECT id, seq, 0 AS op_no, '+I' AS op, new AS sumVc FROM r WHERE n = 1
  UNION ALL SELECT id, seq, 0, '-U', old FROM r WHERE n > 1 AND new IS DISTINCT FROM old
  UNION ALL SELECT id, seq, 1, '+U', new FROM r WHERE n > 1 AND new IS DISTINCT FROM old)""".replace(
    "FROM r", "FROM (SELECT id, seq, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING "
              "AND CURRENT ROW) AS BIGINT) AS new, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN "
              "UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS old, count(*) OVER (PARTITION BY id ORDER BY seq "
              "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM arrivals)"), "arrivals"))
def q_group_sum_changelog(spark, sf):
    return changelog.group_sum_changelog(I.arrivals(spark, sf))


@register("append_stream", with_ctes("SELECT id, ts, vc, seq FROM sensor", "sensor"))
def q_append_stream(spark, sf):
    return changelog.append_stream(I.sensor(spark, sf))


@register("window_contents", with_ctes(
    f"SELECT id, window_start, window_end, cnt, concat('key=', id, '的窗口[', {sql_fmt_ms('window_start * 1000')}, ',', "
    f"{sql_fmt_ms('window_end * 1000')}, ')包含', CAST(cnt AS VARCHAR), '条数据') AS text FROM ("
    f"SELECT id, ts - ts % {TUMBLE} AS window_start, ts - ts % {TUMBLE} + {TUMBLE} AS window_end, count(*) AS cnt "
    "FROM arrivals GROUP BY 1, 2, 3)", "arrivals"))
def q_window_contents(spark, sf):
    return windows.window_contents(I.arrivals(spark, sf), TUMBLE)


@register("window_members", with_ctes(
    f"SELECT id, ts - ts % {TUMBLE} AS window_start, ts - ts % {TUMBLE} + {TUMBLE} AS window_end, "
    f"count(*) OVER (PARTITION BY id, ts - ts % {TUMBLE}) AS cnt, "
    f"row_number() OVER (PARTITION BY id, ts - ts % {TUMBLE} ORDER BY seq) AS position, "
    f"{sql_sensor_text('id', 'ts', 'vc')} AS text FROM arrivals", "arrivals"))
def q_window_members(spark, sf):
    return windows.window_members(I.arrivals(spark, sf), TUMBLE)


# ---------------------------------------------- windows, Top-N, sorts (2.5)

@register("over_range_count", with_ctes(
    f"SELECT id, ts, vc, seq, count(vc) OVER (PARTITION BY id ORDER BY ts RANGE BETWEEN {RANGE} PRECEDING "
    "AND CURRENT ROW) AS cnt FROM sensor", "sensor"))
def q_over_range_count(spark, sf):
    return over.over_range_count(I.sensor(spark, sf), RANGE)


@register("over_range_count_scan", ORACLE["over_range_count"])
def q_over_range_count_scan(spark, sf):
    return over.over_range_count(I.sensor(spark, sf), RANGE, strategy="scan")


_SLIDE_COUNT_SQL = (
    f"SELECT vc, ts - ts % {SLIDE_STEP} - k * {SLIDE_STEP} AS window_start, "
    f"ts - ts % {SLIDE_STEP} - k * {SLIDE_STEP} + {SLIDE_SIZE} AS window_end, count(*) AS cnt "
    f"FROM sensor, (SELECT unnest(range(0, {SLIDE_SIZE // SLIDE_STEP})) AS k) GROUP BY 1, 2, 3")


@register("sliding_count", with_ctes(_SLIDE_COUNT_SQL, "sensor"))
def q_sliding_count(spark, sf):
    return topn.sliding_count(I.sensor(spark, sf), SLIDE_SIZE, SLIDE_STEP)


_TOPN_SQL = (f"SELECT window_start, window_end, rank, vc, cnt FROM (SELECT *, CAST(row_number() OVER "
             f"(PARTITION BY window_end ORDER BY cnt DESC, vc ASC) AS INTEGER) AS rank FROM ({_SLIDE_COUNT_SQL})) "
             "WHERE rank <= 2")


@register("sliding_topn", with_ctes(_TOPN_SQL, "sensor"))
def q_sliding_topn(spark, sf):
    return topn.sliding_topn(I.sensor(spark, sf), SLIDE_SIZE, SLIDE_STEP, 2)


@register("sliding_topn_all", with_ctes(
    "SELECT window_start, window_end, concat('================================' || chr(10), "
    "string_agg(concat('Top', CAST(rank AS VARCHAR), chr(10), 'vc=', CAST(vc AS VARCHAR), chr(10), 'count=', "
    f"CAST(cnt AS VARCHAR), chr(10), '窗口结束时间=', {sql_fmt_ms('window_end * 1000')}, chr(10), "
    "'================================', chr(10)), '' ORDER BY rank)) AS text "
    f"FROM ({_TOPN_SQL}) GROUP BY 1, 2", "sensor"))
def q_sliding_topn_all(spark, sf):
    return topn.sliding_topn_all(I.sensor(spark, sf), SLIDE_SIZE, SLIDE_STEP, 2)


@register("top2_overall", with_ctes(
    "SELECT value, CAST(row_number() OVER (ORDER BY value DESC) AS INTEGER) AS rank FROM ("
    "SELECT vc AS value FROM sensor WHERE vc IS NOT NULL AND vc > -2147483648 ORDER BY vc DESC LIMIT 2)", "sensor"))
def q_top2_overall(spark, sf):
    return topn.top2_overall(I.sensor(spark, sf))


@register("top2_by_key", with_ctes(
    "SELECT id, value, rank FROM (SELECT id, vc AS value, CAST(row_number() OVER (PARTITION BY id ORDER BY vc DESC) "
    "AS INTEGER) AS rank FROM sensor WHERE vc IS NOT NULL) WHERE rank <= 2", "sensor"))
def q_top2_by_key(spark, sf):
    return topn.top2_by_key(I.sensor(spark, sf))


@register("running_top3", with_ctes(
    "SELECT id, seq, vc, array_to_string(list_slice(list_reverse_sort(list(vc) OVER (PARTITION BY id ORDER BY seq "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 1, 3), ',') AS top3_text FROM arrivals "
    "WHERE vc IS NOT NULL", "arrivals"))
def q_running_top3(spark, sf):
    return topn.running_top3(I.arrivals(spark, sf)).select("id", "seq", "vc", "top3_text")


# ------------------------------------- event time, watermarks, late data (2.6)

def _late_cte(delay: int, lateness_s: int, size: int = LATE_WINDOW, src: str = "arrivals") -> str:
    return (f"SELECT *, CASE WHEN wm IS NULL OR wm < window_end THEN 'on_time' "
            f"WHEN wm < window_end + {lateness_s} THEN 'allowed' ELSE 'late' END AS status FROM ("
            f"SELECT id, ts, vc, seq, ts - ts % {size} AS window_start, ts - ts % {size} + {size} AS window_end, "
            f"max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay} AS wm "
            f"FROM {src})")


@register("late_data_split", with_ctes(
    f"SELECT id, ts, vc, seq, window_start, window_end, wm, status FROM ({_late_cte(LATE_DELAY, LATENESS)})",
    "arrivals"))
def q_late_data_split(spark, sf):
    return lateness.late_data_split(I.arrivals(spark, sf), LATE_WINDOW, LATE_DELAY, LATENESS)


def _wm_windows_sql(delay: int) -> str:
    return with_ctes(
        f"SELECT id, window_start, window_end, cnt, vc, concat('key=', id, '的窗口[', "
        f"{sql_fmt_ms('window_start * 1000')}, ',', {sql_fmt_ms('window_end * 1000')}, ')包含', "
        f"CAST(cnt AS VARCHAR), '条数据') AS text FROM (SELECT id, window_start, window_end, count(*) AS cnt, "
        f"CAST(sum(vc) AS BIGINT) AS vc FROM ({_late_cte(delay, 0)}) WHERE status = 'on_time' GROUP BY 1, 2, 3)",
        "arrivals")


@register("watermark_monotonic", _wm_windows_sql(0))
def q_watermark_monotonic(spark, sf):
    return lateness.watermark_monotonic(I.arrivals(spark, sf), LATE_WINDOW)


@register("watermark_bounded", _wm_windows_sql(LATE_DELAY))
def q_watermark_bounded(spark, sf):
    return lateness.watermark_bounded(I.arrivals(spark, sf), LATE_WINDOW, LATE_DELAY)


_SOURCES = ("click", "error", "purchase", "signup", "view")
_SOURCE_MAX = ", ".join(f"max(CASE WHEN event_type = '{v}' THEN ts END) OVER w AS m{i}" for i, v in enumerate(_SOURCES))
_EACH = [f"m{i}" for i in range(len(_SOURCES))]


@register("watermark_partitioned", with_ctes(f"""
SELECT id, window_start, window_end, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc FROM (
  SELECT *, CASE WHEN {" OR ".join(f"{m} IS NULL" for m in _EACH)} THEN NULL ELSE least({", ".join(_EACH)}) - {LATE_DELAY} END AS wm
  FROM (SELECT *, ts - ts % {LATE_WINDOW} AS window_start, ts - ts % {LATE_WINDOW} + {LATE_WINDOW} AS window_end, {_SOURCE_MAX}
        FROM arrivals_typed WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
WHERE wm IS NULL OR wm < window_end GROUP BY 1, 2, 3""", "arrivals_typed"))
def q_watermark_partitioned(spark, sf):
    """The event types are the sources."""
    return lateness.watermark_partitioned(I.sensor_typed(spark, sf, arrival=True), "event_type", _SOURCES, LATE_WINDOW, LATE_DELAY)


@register("allowed_lateness", with_ctes(f"""
SELECT id, window_start, window_end, CAST(0 AS BIGINT) AS firing, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc
FROM c WHERE status = 'on_time' GROUP BY 1, 2, 3
UNION ALL
SELECT a.id, a.window_start, a.window_end, a.firing, coalesce(o.on_cnt, 0) + a.firing AS cnt,
       CAST(CASE WHEN o.on_vc IS NULL THEN a.run_vc WHEN a.run_vc IS NULL THEN o.on_vc ELSE o.on_vc + a.run_vc END
            AS BIGINT) AS vc
FROM (SELECT id, window_start, window_end,
        count(*) OVER (PARTITION BY id, window_start ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS firing,
        sum(vc) OVER (PARTITION BY id, window_start ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_vc
      FROM c WHERE status = 'allowed') a
LEFT JOIN (SELECT id, window_start, count(*) AS on_cnt, sum(vc) AS on_vc FROM c WHERE status = 'on_time'
           GROUP BY 1, 2) o ON a.id = o.id AND a.window_start = o.window_start""".replace(
    "FROM c ", f"FROM ({_late_cte(LATE_DELAY, LATENESS)}) ").replace(
    "FROM c\n", f"FROM ({_late_cte(LATE_DELAY, LATENESS)})\n"), "arrivals"))
def q_allowed_lateness(spark, sf):
    return lateness.allowed_lateness(I.arrivals(spark, sf), LATE_WINDOW, LATE_DELAY, LATENESS)


@register("tumbling_window", with_ctes(
    "SELECT id, ts - ts % 3600 AS window_start, ts - ts % 3600 + 3600 AS window_end, count(*) AS cnt, "
    "CAST(sum(vc) AS BIGINT) AS vc FROM sensor GROUP BY 1, 2, 3", "sensor"))
def q_tumbling_window(spark, sf):
    return windows.tumbling_window(I.sensor(spark, sf), HOUR)


@register("sliding_window", with_ctes(
    f"SELECT id, ts - ts % {SLIDE_STEP} - k * {SLIDE_STEP} AS window_start, "
    f"ts - ts % {SLIDE_STEP} - k * {SLIDE_STEP} + {SLIDE_SIZE} AS window_end, count(*) AS cnt, "
    f"CAST(sum(vc) AS BIGINT) AS vc FROM sensor, (SELECT unnest(range(0, {SLIDE_SIZE // SLIDE_STEP})) AS k) "
    "GROUP BY 1, 2, 3", "sensor"))
def q_sliding_window(spark, sf):
    return windows.sliding_window(I.sensor(spark, sf), SLIDE_SIZE, SLIDE_STEP)


@register("session_window", with_ctes(f"""
SELECT id, min(ts) AS window_start, max(ts) + {SESSION_GAP} AS window_end, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev > {SESSION_GAP} THEN 1 ELSE 0 END)
                 OVER (PARTITION BY id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sess
      FROM (SELECT *, lag(ts) OVER (PARTITION BY id ORDER BY ts) AS prev FROM sensor))
GROUP BY id, sess""", "sensor"))
def q_session_window(spark, sf):
    return windows.session_window(I.sensor(spark, sf), SESSION_GAP)


@register("count_window", with_ctes("""
SELECT id, CAST((rn - 1) // 5 AS BIGINT) AS window_no, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc, arg_max(ts, seq) AS ts
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM arrivals)
GROUP BY 1, 2 HAVING count(*) = 5""", "arrivals"))
def q_count_window(spark, sf):
    return windows.count_window(I.arrivals(spark, sf), 5)


@register("count_window_sliding", with_ctes("""
SELECT id, CAST(rn AS BIGINT) AS fire_rn, count(*) OVER w AS cnt, CAST(sum(vc) OVER w AS BIGINT) AS vc
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM arrivals)
WINDOW w AS (PARTITION BY id ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
QUALIFY rn % 2 = 0""", "arrivals"))
def q_count_window_sliding(spark, sf):
    return windows.count_window_sliding(I.arrivals(spark, sf), 5, 2)


@register("window_all", with_ctes(
    "SELECT ts - ts % 3600 AS window_start, ts - ts % 3600 + 3600 AS window_end, count(*) AS cnt, "
    "CAST(sum(vc) AS BIGINT) AS vc, max(vc) AS max_vc FROM sensor GROUP BY 1, 2", "sensor"))
def q_window_all(spark, sf):
    return windows.window_all(I.sensor(spark, sf), HOUR)


# ----------------------------------------------------- stateful (2.7) twins

def _run_sql(expr: str, frame: str = "CURRENT ROW") -> str:
    return (f"{expr} OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND {frame})")


@register("level_jump_alert", with_ctes(
    "SELECT id, ts, vc, seq, last_vc, concat('lastVc:', CAST(last_vc AS VARCHAR), ',vc:', CAST(vc AS VARCHAR)) AS text "
    "FROM (SELECT *, coalesce(lag(vc) OVER (PARTITION BY id ORDER BY seq), 0) AS last_vc FROM arrivals) "
    "WHERE abs(vc - last_vc) > 10", "arrivals"))
def q_level_jump_alert(spark, sf):
    return keyed.level_jump_alert(I.arrivals(spark, sf))


@register("level_jump_alert_ttl", with_ctes(
    "SELECT id, ts, vc, seq, last_vc, concat('lastVc:', CAST(last_vc AS VARCHAR), ',vc:', CAST(vc AS VARCHAR)) AS text "
    f"FROM (SELECT *, CASE WHEN pt IS NOT NULL AND pt + {TTL} > ts THEN coalesce(pv, 0) ELSE 0 END AS last_vc FROM ("
    "SELECT *, lag(vc) OVER (PARTITION BY id ORDER BY seq) AS pv, lag(ts) OVER (PARTITION BY id ORDER BY seq) AS pt "
    "FROM sensor)) WHERE abs(vc - last_vc) > 10", "sensor"))
def q_level_jump_alert_ttl(spark, sf):
    return keyed.level_jump_alert_ttl(I.sensor(spark, sf), TTL)


@register("running_histogram", with_ctes(
    "SELECT id, ts, vc, seq, count(*) OVER (PARTITION BY id, vc ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS cnt FROM arrivals WHERE vc IS NOT NULL", "arrivals"))
def q_running_histogram(spark, sf):
    return keyed.running_histogram(I.arrivals(spark, sf))


@register("histogram_final", with_ctes(
    "SELECT id, vc, count(*) AS cnt, concat('vc=', CAST(vc AS VARCHAR), ',count=', CAST(count(*) AS VARCHAR)) AS text "
    "FROM arrivals WHERE vc IS NOT NULL GROUP BY id, vc", "arrivals"))
def q_histogram_final(spark, sf):
    return keyed.histogram_final(I.arrivals(spark, sf))


@register("running_sum", with_ctes(
    f"SELECT id, ts, vc, seq, CAST({_run_sql('sum(vc)')} AS BIGINT) AS vc_sum, "
    f"concat('key:', id, ',vcSum:', CAST(CAST({_run_sql('sum(vc)')} AS BIGINT) AS VARCHAR)) AS text FROM arrivals",
    "arrivals"))
def q_running_sum(spark, sf):
    return keyed.running_sum(I.arrivals(spark, sf))


@register("running_avg", with_ctes(
    f"SELECT id, ts, vc, seq, CAST({_run_sql('sum(vc)')} AS DOUBLE) / {_run_sql('count(vc)')} AS vc_avg "
    "FROM arrivals", "arrivals"))
def q_running_avg(spark, sf):
    return keyed.running_avg(I.arrivals(spark, sf))


@register("running_row_count", with_ctes(
    "SELECT event_type, seq, count(*) OVER (PARTITION BY event_type ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS cnt FROM arrivals_typed", "arrivals_typed"))
def q_running_row_count(spark, sf):
    return keyed.running_row_count(I.sensor_typed(spark, sf, arrival=True), "event_type")


# ---------------------------------------------------------- functions (2.8)

_JAVA_HASH_SQL = (
    "CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER)")


@register("java_hash", with_ctes(
    f"SELECT seq, id, {_JAVA_HASH_SQL} AS id_hash, vc AS int_hash, "
    "CAST(seq * 4294967296 + ts AS BIGINT) AS big, "
    "CAST(CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END AS INTEGER) AS long_hash, "
    "CASE WHEN vc % 2 = 0 THEN 1231 ELSE 1237 END AS boolean_hash "
    "FROM (SELECT *, xor(seq, ts) % 4294967296 AS x, list_reduce(list_prepend(0::BIGINT, "
    "list_transform(string_split(id, ''), lambda c: unicode(c)::BIGINT)), lambda a, x: (a * 31 + x) % 4294967296) "
    "AS h FROM sensor)", "sensor"))
def q_java_hash(spark, sf):
    from pyspark.sql import types as T
    s = I.sensor(spark, sf).withColumn("big", F.col("seq") * F.lit(1 << 32) + F.col("ts"))
    return s.select("seq", "id", java_string_hash(F.col("id")).alias("id_hash"),
                    java_hash(F.col("vc"), T.IntegerType()).alias("int_hash"), "big",
                    java_hash(F.col("big"), T.LongType()).alias("long_hash"),
                    java_hash(F.col("vc") % 2 == 0, T.BooleanType()).alias("boolean_hash"))


def _int32(expr: str) -> str:
    """What Java's int arithmetic keeps of a BIGINT."""
    return f"CAST((({expr}) % 4294967296 + 4294967296 + 2147483648) % 4294967296 - 2147483648 AS INTEGER)"


_DATE_HASH = ("xor(y & 4294965248, ((y << 11) + (month(d) << 6) + day(d)))")


@register("java_hash_types", with_ctes(f"""
SELECT seq, {_int32("bits")} AS double_hash, {_int32("31 * (vc::BIGINT * 100) + 2")} AS decimal_hash,
       {_int32(_DATE_HASH)} AS date_hash, {_int32("xor(ts, ts >> 32)")} AS timestamp_hash,
       {_int32(f"xor({_DATE_HASH}, xor(nano, nano >> 32) % 4294967296)")} AS timestamp_ntz_hash,
       {_int32("31 * (31 + vc) + seq % 7")} AS array_hash,
       {_int32("31 * (31 + vc) + CASE WHEN vc % 2 = 0 THEN 1231 ELSE 1237 END")} AS struct_hash,
       {_int32("31 * (31 + ((vc % 100 + 256) % 256 + 128) % 256 - 128) + 7")} AS binary_hash
FROM (SELECT *, year(d)::BIGINT AS y, (ts % 86400) * 1000000000 AS nano,
             CASE WHEN vc = 0 THEN 0 ELSE (CASE WHEN vc < 0 THEN 2147483648 ELSE 0 END)
               + ((floor(log2(abs(vc) / 4.0))::BIGINT + 1023) << 20)
               + ((abs(vc) / 4.0 / pow(2, floor(log2(abs(vc) / 4.0))) - 1) * 1048576)::BIGINT END AS bits
      FROM (SELECT *, (make_timestamp(ts * 1000000))::DATE AS d FROM sensor WHERE vc IS NOT NULL))""", "sensor"))
def q_java_hash_types(spark, sf):
    """``java_hash`` of one column per further type."""
    s = I.sensor(spark, sf).where("vc is not null").select(
        "seq", (F.col("vc") / F.lit(4.0)).alias("double"), F.col("vc").cast("decimal(12,2)").alias("decimal"),
        F.timestamp_seconds("ts").cast("date").alias("date"), F.timestamp_seconds("ts").alias("timestamp"),
        F.timestamp_seconds("ts").cast("timestamp_ntz").alias("timestamp_ntz"),
        F.array(F.col("vc").cast("bigint"), F.col("seq") % 7).alias("array"),
        F.struct(F.col("vc").alias("vc"), (F.col("vc") % 2 == 0).alias("even")).alias("struct"),
        F.unhex(F.concat(F.lpad(F.hex(F.pmod(F.col("vc") % 100, F.lit(256))), 2, "0"), F.lit("07"))).alias("binary"))
    return s.select("seq", *[java_hash(F.col(f.name), f.dataType).alias(f"{f.name}_hash") for f in s.schema if f.name != "seq"])


@register("weighted_avg", """
SELECT l_returnflag, l_linestatus,
       CASE WHEN sum(l_linenumber) = 0 THEN NULL
            ELSE CAST(sum(CAST(l_quantity AS BIGINT) * l_linenumber) // sum(l_linenumber) AS BIGINT) END AS wavg
FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1, 2""")
def q_weighted_avg(spark, sf):
    from ..schema import table
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        weighted_avg(F.col("l_quantity").cast("bigint"), F.col("l_linenumber")).alias("wavg"))


@register("weighted_avg_retract", with_ctes("""
SELECT id, CAST(sum(new * n) // sum(n) AS BIGINT) AS wavg FROM (
  SELECT id, seq, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq) AS BIGINT) AS new, 1 AS n,
         row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS back FROM arrivals)
WHERE back = 1 GROUP BY id""", "arrivals"))
def q_weighted_avg_retract(spark, sf):
    """The weighted average over a changelog: every retracted sum takes its
    weight back, so what is left is the last sum of each key."""
    changes = changelog.group_sum_changelog(I.arrivals(spark, sf))
    return changes.groupBy("id").agg(weighted_avg("sumVc", F.lit(1), F.col("op")).alias("wavg"))


@register("weighted_avg_accumulated", ORACLE["weighted_avg"])
def q_weighted_avg_accumulated(spark, sf):
    """:func:`q_weighted_avg` as a user-defined aggregate."""
    from ..schema import table
    li = table(spark, sf, "lineitem").withColumn("v", F.col("l_quantity").cast("bigint"))
    return acc.aggregate(li, ["l_returnflag", "l_linestatus"], ["v", "l_linenumber"], acc.WeightedAvg())


@register("weighted_avg_retracted", ORACLE["weighted_avg_retract"])
def q_weighted_avg_retracted(spark, sf):
    """:func:`q_weighted_avg_retract` as a user-defined aggregate that retracts."""
    changes = changelog.group_sum_changelog(I.arrivals(spark, sf)).withColumn("weight", F.lit(1))
    return acc.aggregate(changes, "id", ["sumVc", "weight"], acc.WeightedAvg(), op="op")


@register("top2_accumulated", ORACLE["top2_by_key"])
def q_top2_accumulated(spark, sf):
    """:func:`q_top2_by_key` as a user-defined table aggregate."""
    return acc.aggregate(I.sensor(spark, sf), "id", ["vc"], acc.TopN(2))


@register("format_window_time", with_ctes(
    f"SELECT seq, {sql_fmt_ms('ts * 1000')} AS text FROM sensor", "sensor"))
def q_format_window_time(spark, sf):
    return I.sensor(spark, sf).select("seq", windows.format_millis(F.col("ts") * 1000).alias("text"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
