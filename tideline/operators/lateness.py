"""Per-record watermark replay: late data, allowed lateness, watermarks per
source, late rows of an interval join.

A streaming engine decides lateness against the watermark *at the moment a
row arrives*. Replaying that on a table needs, for every row, the maximum
event time of all rows that arrived before it -- an un-partitioned running
max, which as a plain window would pull the whole table into one task. Here
it is the chunked :func:`~tideline.operators.scan.prefix_scan` (chunks by
arrival order, prefix over chunk maxima, broadcast-or-shuffle join back).

Rules (event time in whole seconds, watermark = max seen - delay):

* a window ``[start, end)`` is *closed* once ``end <= wm``;
* a row is ``on_time`` if its window is open, ``allowed`` if the window is
  closed but ``end + lateness > wm`` (the window fires again), else ``late``
  (side output).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import DEFAULT_CHUNK_WIDTH, Scan, prefix_scan
from .windows import assign_tumbling, window_header

ON_TIME, ALLOWED, LATE = "on_time", "allowed", "late"


def per_record_watermark(df: DataFrame, delay_s: int, order: str = "seq", ts_col: str = "ts",
                         chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Add ``wm``: max event time over rows that arrived earlier, minus the
    delay; null before the first row (no watermark yet)."""
    s = prefix_scan(df, order, [Scan("__max_prev", ts_col, "max", inclusive=False)], chunk_width=chunk_width)
    return s.withColumn("wm", F.col("__max_prev") - F.lit(delay_s)).drop("__max_prev")


def classify_lateness(df: DataFrame, size_s: int = 10, delay_s: int = 3, lateness_s: int = 2,
                      order: str = "seq", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Tag every row with its tumbling window and ``status`` in
    ``on_time`` / ``allowed`` / ``late``."""
    d = assign_tumbling(per_record_watermark(df, delay_s, order, chunk_width=chunk_width), size_s)
    end, wm = F.col("window_end"), F.col("wm")
    status = (F.when(wm.isNull() | (wm < end), F.lit(ON_TIME))
              .when(wm < end + F.lit(lateness_s), F.lit(ALLOWED))
              .otherwise(F.lit(LATE)))
    return d.withColumn("status", status)


def late_data_split(df: DataFrame, size_s: int = 10, delay_s: int = 3, lateness_s: int = 2,
                    order: str = "seq", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Rows with their window and status; ``status = 'late'`` is the
    ``late_data`` side output, the rest feed the window."""
    c = classify_lateness(df, size_s, delay_s, lateness_s, order, chunk_width)
    return c.select("id", "ts", "vc", order, "window_start", "window_end", "wm", "status")


def side_output(classified: DataFrame, status: str = LATE) -> DataFrame:
    return classified.where(F.col("status") == status)


def _contents(rows: DataFrame, key: str) -> DataFrame:
    r = rows.groupBy(key, "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("vc"))
    return r.withColumn("text", window_header(F.col(key)))


def watermark_windows(df: DataFrame, size_s: int = 10, delay_s: int = 0, key: str = "id", order: str = "seq",
                      chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Event-time tumbling windows under a watermark with ``delay_s`` of
    out-of-orderness (0 = monotonic): rows arriving after their window
    closed are dropped; each window reports its on-time rows. At end of input
    every open window fires (final watermark)."""
    c = classify_lateness(df, size_s, delay_s, 0, order, chunk_width)
    return _contents(c.where(F.col("status") == ON_TIME), key)


def watermark_monotonic(df: DataFrame, size_s: int = 10, key: str = "id", order: str = "seq",
                        chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    return watermark_windows(df, size_s, 0, key, order, chunk_width)


def watermark_bounded(df: DataFrame, size_s: int = 10, delay_s: int = 3, key: str = "id", order: str = "seq",
                      chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    return watermark_windows(df, size_s, delay_s, key, order, chunk_width)


def allowed_lateness(df: DataFrame, size_s: int = 10, delay_s: int = 3, lateness_s: int = 2, key: str = "id",
                     order: str = "seq", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Every firing of every window under allowed lateness.

    ``firing = 0``: the watermark passes the window end (or input ends) --
    on-time rows only; absent when there were none. ``firing = k``: the k-th
    allowed-late row re-fires the window with everything so far. Late rows
    are not counted (see :func:`late_data_split`).
    """
    c = classify_lateness(df, size_s, delay_s, lateness_s, order, chunk_width)
    # the watermark only rises, so a window's on-time rows come before its
    # allowed ones: one running pass gives every firing's count and sum. Hot
    # windows are found in the input: the watermark isn't needed for that
    run = prefix_scan(c.where(F.col("status") != LATE), order, [
        Scan("cnt", F.lit(1), "count"), Scan("__run_vc", F.col("vc").cast("bigint"), "sum"),
        Scan("firing", F.when(F.col("status") == ALLOWED, 1), "count")], [key, "window_start"], chunk_width=chunk_width,
        seen=assign_tumbling(df, size_s))
    return (run.groupBy(key, "window_start", "window_end", "firing")
            .agg(F.max("cnt").alias("cnt"), F.max_by("__run_vc", order).alias("vc")))


def watermark_partitioned(df: DataFrame, source: str, sources: Sequence[str], size_s: int = 10, delay_s: int = 3,
                          key: str = "id", order: str = "seq", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Tumbling windows per ``key`` over rows of several sources, each with a
    watermark of its own: the least of the declared ``sources``' watermarks
    (max seen - delay) decides what is late. While one of them has no rows yet
    nothing is late. Rows of other or null sources move no watermark but are
    judged by it; late rows are left out."""
    names = [f"__max_{i}" for i in range(len(sources))]
    s = prefix_scan(df, order, [Scan(n, F.when(F.col(source) == v, F.col("ts")), "max", inclusive=False)
                                for n, v in zip(names, sources)], chunk_width=chunk_width)
    seen = F.array(*[F.col(n) for n in names])
    wm = F.when(F.forall(seen, lambda m: m.isNotNull()), F.array_min(seen) - F.lit(delay_s))
    s = assign_tumbling(s.withColumn("wm", wm), size_s)
    return (s.where(F.col("wm").isNull() | (F.col("wm") < F.col("window_end")))
            .groupBy(key, "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("vc")))


def two_input_lateness(left: DataFrame, right: DataFrame, delay_s: int = 3, order: str = "seq",
                       chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """The rows of two inputs with ``side``, the watermark ``wm`` at their
    arrival and ``late``.

    Both inputs form one arrival sequence; the watermark is the minimum of
    the two inputs' watermarks (max seen - delay, -infinity before a side's
    first row). A row is late iff ``ts < wm``.
    """
    cols = ["id", "ts", "vc", order]
    both = (left.select(*cols, F.lit("left").alias("side"))
            .unionByName(right.select(*cols, F.lit("right").alias("side"))))
    s = prefix_scan(both, order, [
        Scan("__ml", F.when(F.col("side") == "left", F.col("ts")), "max", inclusive=False),
        Scan("__mr", F.when(F.col("side") == "right", F.col("ts")), "max", inclusive=False)],
        chunk_width=chunk_width)
    wm = F.least(F.col("__ml"), F.col("__mr")) - F.lit(delay_s)
    s = s.withColumn("wm", F.when(F.col("__ml").isNotNull() & F.col("__mr").isNotNull(), wm))
    return s.select("side", *cols, "wm", F.coalesce(F.col("ts") < F.col("wm"), F.lit(False)).alias("late"))


def interval_join_late(left: DataFrame, right: DataFrame, delay_s: int = 3, order: str = "seq",
                       chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Late rows of an interval join (its two side outputs)."""
    return two_input_lateness(left, right, delay_s, order, chunk_width).where("late").drop("late")


def interval_join_on_time(left: DataFrame, right: DataFrame, lower_s: int, upper_s: int, delay_s: int = 3,
                          order: str = "seq", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """The interval join of the rows that aren't late (its main output)."""
    from .joins import interval_join

    rows = two_input_lateness(left, right, delay_s, order, chunk_width).where("not late")
    sides = [rows.where(F.col("side") == s).select("id", "ts", "vc") for s in ("left", "right")]
    return interval_join(*sides, lower_s, upper_s, seen=(left.select("id", "ts", "vc"), right.select("id", "ts", "vc")))


def event_timer(df: DataFrame, timer_s: int, delay_s: int, key: str = "id", order: str = "seq",
                ts_col: str = "ts", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Every firing of every key's event-time timer at the fixed time
    ``timer_s``, which each row of the key registers.

    Registrations of one key collapse until they fire: at the first arrival,
    the row's own included, that raises the watermark (max ts seen - delay) and
    leaves it beyond ``timer_s``. So rows up to the arrival that first passes
    the time fire there, and a timer registered again later fires at the next
    rise. One row per key and firing: the rows that registered it
    (``registered``) and the arrival that made it fire (``fired_at``). Rows
    behind the last rise don't fire.

    "The next rise at or after a row" is a running minimum over the rows in
    reverse order, so no arrival sequence goes through one task.
    """
    rows = df.select(key, F.col(ts_col).alias("__ts"), F.col(order).cast("bigint").alias("__at"))
    ahead = prefix_scan(rows, "__at", [Scan("__max", "__ts", "max", inclusive=False)], chunk_width=chunk_width)
    rises = (F.col("__ts") > F.lit(timer_s + delay_s)) & (F.col("__max").isNull() | (F.col("__ts") > F.col("__max")))
    back = ahead.select(key, F.when(rises, F.col("__at")).alias("__rise"), (-F.col("__at")).alias("__back"))
    fired = prefix_scan(back, "__back", [Scan("fired_at", "__rise", "min")], chunk_width=chunk_width,
                        seen=rows.select((-F.col("__at")).alias("__back")))
    return (fired.where(F.col("fired_at").isNotNull()).groupBy(key, "fired_at").agg(F.count(F.lit(1)).alias("registered"))
            .select(key, F.lit(timer_s).cast("bigint").alias("timer"), "registered", "fired_at"))
