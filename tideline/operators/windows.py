"""Keyed and un-keyed time windows and count windows.

Event time is ``ts`` (epoch seconds). Window bounds come back as epoch
seconds ``window_start`` / ``window_end``. All time-window aggregates are
declarative, so Spark runs them as partial + final aggregation (map-side
combine) and, on a stream, keeps one accumulator per (key, window) in the
state store -- the reference's incremental ``aggregate`` without buffering.

Which ``ts`` a windowed result carries differs by reference operator:
first arrival (``sum``), last arrival (``reduce``/``aggregate``) or the
maximum (``process``). Arrival order is the ``seq`` column.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import CHUNK, DEFAULT_CHUNK_WIDTH, PREFIX, Scan, hot_chunks, key_columns, prefix_scan
from ..functions.text import AGG_AND_PROCESS, PARITY_SUM, SENSOR_RECORD, WINDOW_HEADER, render
from .transforms import parity_label


def event_time(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Add the window time column ``et`` unless present: from epoch seconds,
    or -- for processing-time windows -- a TIMESTAMP column such as
    ``row_time`` (see :func:`~.transforms.row_time_column`) used as is."""
    if "et" in df.columns:
        return df
    c = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn("et", c.cast("timestamp"))
    return df.withColumn("et", F.timestamp_seconds(c))


def with_watermark(df: DataFrame, delay_s: int, ts_col: str = "ts") -> DataFrame:
    """Event time + bounded out-of-orderness watermark (``delay_s`` = 0 is the
    monotonic strategy). A no-op on batch frames."""
    return event_time(df, ts_col).withWatermark("et", f"{int(delay_s)} seconds")


def watermark_on(df: DataFrame, time_col: str, delay_s: int) -> DataFrame:
    """``WATERMARK FOR row_time AS row_time - INTERVAL 'delay' SECOND`` on an
    existing TIMESTAMP column (e.g. ``row_time_column``)."""
    return df.withWatermark(time_col, f"{int(delay_s)} seconds")


def time_window(size_s: int, slide_s: int | None = None) -> Column:
    slide = f"{int(slide_s)} seconds" if slide_s and slide_s != size_s else None
    return F.window("et", f"{int(size_s)} seconds", slide)


def _bounds(win: str = "window") -> list[Column]:
    return [F.unix_seconds(F.col(f"{win}.start")).alias("window_start"),
            F.unix_seconds(F.col(f"{win}.end")).alias("window_end")]


def window_agg(df: DataFrame, size_s: int, aggs: dict[str, Column], keys: Sequence[str] = ("id",),
               slide_s: int | None = None, time_col: str = "ts") -> DataFrame:
    """Group by keys and the (tumbling or sliding) window of ``et``;
    ``aggs`` maps output name -> aggregate."""
    d = event_time(df, time_col)
    return (d.groupBy(*keys, time_window(size_s, slide_s).alias("window"))
            .agg(*[c.alias(n) for n, c in aggs.items()])
            .select(*keys, *_bounds(), *aggs.keys()))


# --- the four ts rules (A3-A6) ------------------------------------------------

def tumbling_sum(df: DataFrame, size_s: int = 5, key: str = "id") -> DataFrame:
    """``window.sum("vc")``: vc summed; ``ts`` of the first-arrived row."""
    return window_agg(df, size_s, {"ts": F.min_by("ts", "seq"), "vc": F.sum("vc")}, [key])


def tumbling_reduce(df: DataFrame, size_s: int = 5, key: str = "id") -> DataFrame:
    """``window.reduce((a, b) -> (a.id, b.ts, a.vc + b.vc))``: ``ts`` of the
    last-arrived row."""
    return window_agg(df, size_s, {"ts": F.max_by("ts", "seq"), "vc": F.sum("vc")}, [key])


def tumbling_aggregate(df: DataFrame, size_s: int = 5, key: str = "id") -> DataFrame:
    """Accumulator form of :func:`tumbling_reduce` (same result)."""
    return tumbling_reduce(df, size_s, key)


def tumbling_process(df: DataFrame, size_s: int = 5, key: str = "id") -> DataFrame:
    """Full-window function ``(key, max(ts), sum(vc))`` -- no buffering needed."""
    return window_agg(df, size_s, {"ts": F.max("ts"), "vc": F.sum("vc")}, [key])


def sensor_text(id_c: Column, ts_c: Column, vc_c: Column) -> Column:
    """A sensor record as the reference prints it (``SENSOR_RECORD``)."""
    return render(SENSOR_RECORD, id=id_c, ts=ts_c, vc=vc_c)


def tumbling_agg_format(df: DataFrame, size_s: int = 5, key: str = "id") -> DataFrame:
    """Incremental aggregate then a window function that prints
    ``key:[WaterSensor(...)],`` (one aggregate per window)."""
    r = tumbling_reduce(df, size_s, key)
    return r.withColumn("text", render(AGG_AND_PROCESS, key=F.col(key),
                                       record=sensor_text(F.col(key), F.col("ts"), F.col("vc"))))


def parity_window_reduce(df: DataFrame, size_s: int = 5, value: str = "vc", time_col: str = "ts") -> DataFrame:
    """Integers keyed even/odd, tumbling window, sum, text ``key：<label>[sum]``
    (the reference runs it on processing time: pass ``time_col="row_time"``)."""
    d = df.withColumn("parity", parity_label(F.col(value)))
    r = window_agg(d, size_s, {"total": F.sum(value)}, ["parity"], time_col=time_col)
    return r.withColumn("text", render(PARITY_SUM, label=F.col("parity"), total=F.col("total")))


# --- window contents (A13) and formatting ----------------------------------------

def format_millis(ms: Column) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd HH:mm:ss.SSS`` (UTC, any session zone)."""
    ntz = F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(ntz, "yyyy-MM-dd HH:mm:ss.SSS")


def window_contents(df: DataFrame, size_s: int = 10, key: str = "id") -> DataFrame:
    """Per key and window: bounds, row count and the header the reference
    prints (``WINDOW_HEADER``).

    The members themselves stay rows (``assign_tumbling``); they are not
    gathered into one value, so a hot window never becomes one huge cell.
    """
    r = window_agg(df, size_s, {"cnt": F.count(F.lit(1))}, [key])
    return r.withColumn("text", window_header(F.col(key)))


def window_members(df: DataFrame, size_s: int = 10, key: str = "id", order: str = "seq",
                   chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """The members that the reference prints after a window's header: one row
    per member with its window's bounds and count, its position in arrival
    order (from 1) and its text. No list per window."""
    d = assign_tumbling(df, size_s)
    placed = prefix_scan(d, order, [Scan("position", F.lit(1), "count")], [key, "window_start"], chunk_width=chunk_width)
    sizes = d.groupBy(F.col(key).alias("__key"), F.col("window_start").alias("__start")).agg(
        F.count(F.lit(1)).alias("cnt"))
    both = placed.join(sizes, F.col(key).eqNullSafe(F.col("__key")) & F.col("window_start").eqNullSafe(F.col("__start")))
    return both.select(key, "window_start", "window_end", "cnt", "position",
                       sensor_text(F.col("id"), F.col("ts"), F.col("vc")).alias("text"))


def window_header(key: Column) -> Column:
    """``WINDOW_HEADER`` from ``window_start``, ``window_end`` and ``cnt``."""
    return render(WINDOW_HEADER, key=key, start=format_millis(F.col("window_start") * 1000),
                  end=format_millis(F.col("window_end") * 1000), count=F.col("cnt"))


def assign_tumbling(df: DataFrame, size_s: int, ts_col: str = "ts") -> DataFrame:
    """Tag each row with its tumbling window (integer arithmetic, epoch-aligned)."""
    start = F.col(ts_col) - F.pmod(F.col(ts_col), F.lit(size_s))
    return df.withColumn("window_start", start).withColumn("window_end", start + F.lit(size_s))


# --- plain time windows (E7, E8, E12) --------------------------------------------

def tumbling_window(df: DataFrame, size_s: int = 5, key: str = "id", time_col: str = "ts") -> DataFrame:
    """Epoch-aligned tumbling window: rows and vc sum per key and window
    (``time_col`` = ``row_time`` for processing-time windows)."""
    return window_agg(df, size_s, {"cnt": F.count(F.lit(1)), "vc": F.sum("vc")}, [key], time_col=time_col)


def sliding_window(df: DataFrame, size_s: int = 10, slide_s: int = 2, key: str = "id",
                   time_col: str = "ts") -> DataFrame:
    """Sliding window: every row lands in ``size/slide`` windows."""
    return window_agg(df, size_s, {"cnt": F.count(F.lit(1)), "vc": F.sum("vc")}, [key], slide_s, time_col)


def window_all(df: DataFrame, size_s: int = 5) -> DataFrame:
    """Un-keyed window aggregate. Unlike ``windowAll`` (one task), the partial
    aggregation keeps it parallel up to the final per-window merge."""
    return window_agg(df, size_s, {"cnt": F.count(F.lit(1)), "vc": F.sum("vc"),
                                   "max_vc": F.max("vc")}, [])


# --- session windows (E9) --------------------------------------------------------

def session_window(df: DataFrame, gap_s: int = 5, key: str = "id", ts_col: str = "ts",
                   chunk_rows: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Sessions per key with gap ``gap_s``: a row starts a new session iff it
    is more than ``gap_s`` after the previous row of its key (windows that
    touch merge). Session = ``[first ts, last ts + gap)``.

    Batch plan: one window per key numbers its sessions. A key with more than
    ``chunk_rows`` rows is cut by quantiles of time (:func:`~.scan.hot_chunks`,
    so a burst is cut as finely as its rows require); each of its chunks counts
    the session starts after its first row, and a window over the chunks of
    these keys alone decides whether a chunk's first row starts a session and
    how many began before it.
    Streaming input uses ``session_window``.
    """
    if df.isStreaming:
        d = event_time(df, ts_col)
        r = d.groupBy(key, F.session_window("et", f"{int(gap_s)} seconds").alias("window")).agg(
            F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("vc"))
        return r.select(key, *_bounds(), "cnt", "vc")
    base, kcols = key_columns(df, [key])
    every, hot = hot_chunks(base, kcols, ts_col, chunk_rows)
    g = F.lit(int(gap_s))
    run, prev = PREFIX + "run", PREFIX + "prev"

    def starts(rows: DataFrame) -> DataFrame:
        """Session starts inside each (key, chunk) after the chunk's first row, so far."""
        w = Window.partitionBy(*kcols, CHUNK).orderBy(ts_col)
        return (rows.withColumn(prev, F.lag(ts_col).over(w))
                .withColumn(run, F.sum(F.when(F.col(ts_col) - F.col(prev) > g, 1).otherwise(0))
                            .over(w.rowsBetween(Window.unboundedPreceding, 0))))

    # of hot keys: does a chunk's first row start a session, and how many began in earlier chunks
    chunks = starts(hot).groupBy(*kcols, CHUNK).agg(F.min(ts_col).alias("__first"), F.max(ts_col).alias("__last"),
                                                    F.max(run).alias("__inner"))
    wc = Window.partitionBy(*kcols).orderBy(CHUNK)
    last = F.lag("__last").over(wc)
    chunks = (chunks.withColumn("__starts", F.when(last.isNull() | (F.col("__first") - last > g), 1).otherwise(0))
              .withColumn("__before", F.coalesce(F.sum(F.col("__starts") + F.col("__inner"))
                                                 .over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select(*kcols, CHUNK, (F.col("__before") + F.col("__starts")).alias(PREFIX + "base")))
    numbered = starts(every).join(chunks, [*kcols, CHUNK], "left").withColumn(
        "__session", F.coalesce(F.col(PREFIX + "base"), F.lit(1)) + F.col(run))
    return (numbered.groupBy(*kcols, "__session")
            .agg(F.first(key).alias(PREFIX + "key"), F.min(ts_col).alias("window_start"),
                 (F.max(ts_col) + F.lit(gap_s)).alias("window_end"),
                 F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("vc"))
            .select(F.col(PREFIX + "key").alias(key), "window_start", "window_end", "cnt", "vc"))


# --- count windows (E10, E11) ----------------------------------------------------

def count_window(df: DataFrame, size: int = 5, key: str = "id", order: str = "seq",
                 chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Tumbling count window per key in arrival order: rows ``1..n``,
    ``n+1..2n`` ...; a partial last window is never emitted."""
    rn = prefix_scan(df, order, [Scan("__rn", F.lit(1), "count")], key, chunk_width=chunk_width)
    g = rn.withColumn("window_no", ((F.col("__rn") - 1) / F.lit(size)).cast("bigint"))
    return (g.groupBy(key, "window_no")
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("vc"), F.max_by("ts", order).alias("ts"))
            .where(F.col("cnt") == size))


def count_window_sliding(df: DataFrame, size: int = 5, slide: int = 2, key: str = "id",
                         order: str = "seq", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Sliding count window: after every ``slide``-th row of a key emit the
    last (up to) ``size`` rows.

    Each row is sent to the firings it belongs to (row r fires at the
    multiples of ``slide`` in ``[r, r+size-1]``), so the result is a parallel
    equi-aggregation, not a per-key ordered frame.
    """
    rn = prefix_scan(df, order, [Scan("__rn", F.lit(1), "count")], key, chunk_width=chunk_width)
    first = ((F.col("__rn") + F.lit(slide - 1)) / F.lit(slide)).cast("bigint") * F.lit(slide)
    fires = F.sequence(first, F.col("__rn") + F.lit(size - 1), F.lit(slide))
    exploded = rn.select(key, "ts", "vc", order, "__rn",
                         F.explode(F.when(first <= F.col("__rn") + F.lit(size - 1), fires)
                                   .otherwise(F.array().cast("array<bigint>"))).alias("fire_rn"))
    # a firing exists iff its own row exists, and that row is in its group
    return (exploded.groupBy(key, "fire_rn")
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("vc"), F.max("__rn").alias("__last"))
            .where(F.col("__last") == F.col("fire_rn"))
            .drop("__last"))
