"""Keyed running state in arrival order -- batch twins of the stream jobs.

Each function returns one row per qualifying input row, as the reference's
``processElement`` emits. State starts empty (the reference's ``0``
defaults) and follows arrival order ``seq``, not event time. All running
values come from :func:`~tideline.operators.scan.prefix_scan`, so a hot key
is processed in parallel chunks. The streaming versions (state store,
timers, TTL) are in :mod:`tideline.streaming.processors`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import HISTOGRAM_ENTRY, LEVEL_JUMP, RUNNING_SUM, render
from .scan import DEFAULT_CHUNK_WIDTH, Scan, prefix_scan


def level_jump_alert(df: DataFrame, threshold: int = 10, key: str = "id", order: str = "seq",
                     chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Value state ``lastVc`` (starts at 0): emit ``(lastVc, vc)`` when
    ``|vc - lastVc| > threshold``; the state always takes the new vc."""
    s = prefix_scan(df, order, [Scan("__prev", "vc", "last", inclusive=False)], key, chunk_width=chunk_width)
    s = s.withColumn("last_vc", F.coalesce(F.col("__prev"), F.lit(0)))
    return (s.where(F.abs(F.col("vc") - F.col("last_vc")) > threshold)
            .select(key, "ts", "vc", order, "last_vc",
                    render(LEVEL_JUMP, last=F.col("last_vc"), vc=F.col("vc")).alias("text")))


def level_jump_alert_ttl(df: DataFrame, ttl_s: int = 10, threshold: int = 10, key: str = "id",
                         order: str = "seq", time_col: str = "ts",
                         chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """:func:`level_jump_alert` with a time-to-live on the state, refreshed on
    every write and never returned once expired: the previous value counts
    only if it was written less than ``ttl_s`` before (``time_col`` is the
    processing time of each row)."""
    s = prefix_scan(df, order, [Scan("__prev", "vc", "last", inclusive=False),
                                Scan("__prev_t", time_col, "last", inclusive=False)], key,
                    chunk_width=chunk_width)
    alive = F.col("__prev_t").isNotNull() & (F.col("__prev_t") + F.lit(ttl_s) > F.col(time_col))
    s = s.withColumn("last_vc", F.when(alive, F.coalesce(F.col("__prev"), F.lit(0))).otherwise(F.lit(0)))
    return (s.where(F.abs(F.col("vc") - F.col("last_vc")) > threshold)
            .select(key, "ts", "vc", order, "last_vc",
                    render(LEVEL_JUMP, last=F.col("last_vc"), vc=F.col("vc")).alias("text")))


def running_histogram(df: DataFrame, key: str = "id", order: str = "seq",
                      chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Map state vc -> count: per row the entry it changed, ``(vc, count so
    far)``. The whole map after a row is the latest entry of every vc up to
    that row; :func:`histogram_final` gives it at end of input."""
    s = prefix_scan(df.where(F.col("vc").isNotNull()), order, [Scan("cnt", F.lit(1), "count")],
                    [key, "vc"], chunk_width=chunk_width)
    return s.select(key, "ts", "vc", order, "cnt")


def histogram_final(df: DataFrame, key: str = "id") -> DataFrame:
    """The map state at end of input, one row per entry, plus the text line
    ``vc=count`` the reference prints for it."""
    g = df.where(F.col("vc").isNotNull()).groupBy(key, "vc").agg(F.count(F.lit(1)).alias("cnt"))
    return g.withColumn("text", render(HISTOGRAM_ENTRY, vc=F.col("vc"), count=F.col("cnt")))


def running_sum(df: DataFrame, key: str = "id", order: str = "seq",
                chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Reducing state ``Integer::sum``: the running vc sum after every row
    (BIGINT: the reference's int would wrap at 2^31)."""
    s = prefix_scan(df, order, [Scan("vc_sum", F.col("vc").cast("bigint"), "sum")], key, chunk_width=chunk_width)
    return s.select(key, "ts", "vc", order, "vc_sum",
                    render(RUNNING_SUM, key=F.col(key), sum=F.col("vc_sum")).alias("text"))


def running_avg(df: DataFrame, key: str = "id", order: str = "seq",
                chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Aggregating state (sum, count) -> ``sum * 1.0 / count`` after every row."""
    s = prefix_scan(df, order, [Scan("__s", F.col("vc").cast("bigint"), "sum"),
                                Scan("__n", "vc", "count")], key, chunk_width=chunk_width)
    return s.select(key, "ts", "vc", order, (F.col("__s").cast("double") / F.col("__n")).alias("vc_avg"))


def running_row_count(df: DataFrame, key: str = "id", order: str = "seq",
                      chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """The count of the rows of ``key`` so far, after every row. The stream
    form keeps the counts in its state, so they go on after a restart."""
    s = prefix_scan(df, order, [Scan("cnt", F.lit(1), "count")], key, chunk_width=chunk_width)
    return s.select(key, order, "cnt")
