"""Window join, interval join (plain and time-bucketed), broadcast threshold,
lateral split.

Only inner equi-key joins with a time condition exist in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import JOIN_ARROW_INTERVAL, JOIN_ARROW_WINDOW, THRESHOLD_ALERT, render
from .scan import DEFAULT_CHUNK_WIDTH, Scan, prefix_scan
from .windows import event_time, sensor_text

# Rows of both sides of an equi-join group that one task may meet.
GROUP_ROWS = 1 << 20
# Groups that are cut at most, the largest ones: a list that every task can
# hold. A group beyond them has fewer rows than both sides' total / HOT_GROUPS.
HOT_GROUPS = 1 << 14
# Rows of a group that just reaches the limit which are counted.
SAMPLED = 256


def grid_join(left: DataFrame, right: DataFrame, on: list[str], group_rows: int = GROUP_ROWS,
              seen: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Inner equi-join of two batch frames whose other columns have different
    names, with large groups cut into a grid of tasks.

    A group of ``on`` with more than ``group_rows`` rows of both sides becomes
    an ``a x b`` grid: a left row belongs to one of ``a`` fragments and is
    copied to the ``b`` cells beside it, a right row the other way round, so
    each pair meets in one cell, and a cell has about ``group_rows`` rows at
    most. Only rows of such groups are copied. Group sizes are taken from a
    fixed share of the rows, chosen by the rows' hash; errors of these
    estimates change the cells' sizes, never the result. Rows equal in all
    columns share a fragment. Null keys match nothing. ``seen`` are cheaper
    frames with about the rows of both sides to take sizes from, if the sides
    are dear to compute.
    """
    rate = max(1, int(group_rows) // SAMPLED)
    # a cell's share leaves room for the estimates' errors
    cell = max(1.0, 0.4 * group_rows)

    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("__hash", F.xxhash64(*[c for c in df.columns]))

    def counted(df: DataFrame, side: str) -> DataFrame:
        n = [F.lit(int(s == side) * rate).cast("bigint").alias(s) for s in ("__nl", "__nr")]
        return hashed(df).where(F.pmod(F.col("__hash"), F.lit(rate)) == 0).select(*on, *n)

    count_left, count_right = seen or (left, right)
    sizes = (counted(count_left, "__nl").unionByName(counted(count_right, "__nr")).groupBy(*on)
             .agg(F.sum("__nl").alias("__nl"), F.sum("__nr").alias("__nr"))
             .where(F.col("__nl") + F.col("__nr") > int(group_rows))
             .orderBy(F.desc(F.col("__nl") + F.col("__nr"))).limit(HOT_GROUPS)
             .select(*on, *[F.greatest(F.lit(1), F.ceil(F.col(n) / cell)).cast("bigint").alias(c)
                            for n, c in (("__nl", "__rows"), ("__nr", "__cols"))]))

    def cells(df: DataFrame, own: str, other: str) -> DataFrame:
        d = hashed(df).join(F.broadcast(sizes), on, "left")
        # other bits of the hash than those that choose the counted rows
        at = F.pmod(F.shiftright("__hash", 24), F.coalesce(F.col(own), F.lit(1)))
        return (d.withColumn(f"{own}_at", at)
                .withColumn(f"{other}_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other), F.lit(1)) - 1)))
                .drop("__hash", "__rows", "__cols"))

    return (cells(left, "__rows", "__cols").join(cells(right, "__cols", "__rows"), [*on, "__rows_at", "__cols_at"])
            .drop("__rows_at", "__cols_at"))


def _side(df: DataFrame, p: str, cols=("id", "ts", "vc", "seq")) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{p}_{c}") for c in cols if c in df.columns])


def window_join(left: DataFrame, right: DataFrame, size_s: int = 10, key: str = "id",
                group_rows: int = GROUP_ROWS) -> DataFrame:
    """Inner join on key **and** the same tumbling window; every pair in the
    window, text ``left---->right``.

    Batch: the window start is a second equi-key, so a hot key is split over
    its windows by the hash join, and a hot window over a grid of tasks
    (:func:`grid_join`). Streaming: both sides need a watermark; the equality
    on the ``window`` structs lets Spark evict join state.
    """
    if left.isStreaming or right.isStreaming:
        l = event_time(left).withColumn("window", F.window("et", f"{size_s} seconds"))
        r = event_time(right).withColumn("window", F.window("et", f"{size_s} seconds"))
        lw, rw = _side(l, "l", (key, "ts", "vc", "window")), _side(r, "r", (key, "ts", "vc", "window"))
        j = lw.join(rw, (lw[f"l_{key}"] == rw[f"r_{key}"]) & (lw["l_window"] == rw["r_window"]))
        return _window_pairs(j.withColumns({"window_start": F.unix_seconds(F.col("l_window.start")),
                                            "window_end": F.unix_seconds(F.col("l_window.end"))}), key)
    sides = [_side(df, p).withColumn(key, F.col(f"{p}_{key}"))
             .withColumn("window_start", F.col(f"{p}_ts") - F.pmod(f"{p}_ts", F.lit(size_s))) for df, p in ((left, "l"), (right, "r"))]
    j = grid_join(*sides, [key, "window_start"], group_rows).drop(key)
    return _window_pairs(j.withColumn("window_end", F.col("window_start") + F.lit(size_s)), key)


def _window_pairs(j: DataFrame, key: str) -> DataFrame:
    return j.select(F.col(f"l_{key}").alias(key), "window_start", "window_end", "l_ts", "l_vc", "r_ts", "r_vc",
                    F.concat(sensor_text(F.col(f"l_{key}"), F.col("l_ts"), F.col("l_vc")), F.lit(JOIN_ARROW_WINDOW),
                             sensor_text(F.col(f"r_{key}"), F.col("r_ts"), F.col("r_vc"))).alias("text"))


def _pairs(j: DataFrame, key: str) -> DataFrame:
    return j.select(F.col(f"l_{key}").alias(key), "l_ts", "l_vc", "r_ts", "r_vc",
                    F.concat(sensor_text(F.col(f"l_{key}"), F.col("l_ts"), F.col("l_vc")), F.lit(JOIN_ARROW_INTERVAL),
                             sensor_text(F.col(f"r_{key}"), F.col("r_ts"), F.col("r_vc"))).alias("text"))


def interval_join_plain(left: DataFrame, right: DataFrame, lower_s: int = -2, upper_s: int = 1,
                        key: str = "id") -> DataFrame:
    """Inner join on key with ``l.ts + lower <= r.ts <= l.ts + upper`` (both
    bounds inclusive). One equi-key: all rows of a key meet in one sort-merge
    group. Works on streams with watermarks on both sides."""
    if left.isStreaming or right.isStreaming:
        # range on the watermarked event-time columns, so Spark can evict
        # join state once the watermark passes a row's interval
        l = _side(event_time(left), "l", (key, "ts", "vc", "et"))
        r = _side(event_time(right), "r", (key, "ts", "vc", "et"))
        cond = ((l[f"l_{key}"] == r[f"r_{key}"])
                & (r.r_et >= l.l_et + F.expr(f"INTERVAL {int(lower_s)} SECONDS"))
                & (r.r_et <= l.l_et + F.expr(f"INTERVAL {int(upper_s)} SECONDS")))
        return _pairs(l.join(r, cond), key)
    l, r = _side(left, "l"), _side(right, "r")
    cond = ((l[f"l_{key}"] == r[f"r_{key}"])
            & (r.r_ts >= l.l_ts + F.lit(lower_s)) & (r.r_ts <= l.l_ts + F.lit(upper_s)))
    return _pairs(l.join(r, cond), key)


def interval_join(left: DataFrame, right: DataFrame, lower_s: int = -2, upper_s: int = 1,
                  key: str = "id", bucket_s: int | None = None, group_rows: int = GROUP_ROWS,
                  seen: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """:func:`interval_join_plain` with a time bucket as second equi-key.

    The left row sits in bucket ``floor(l.ts / w)``; a right row can only
    match left rows with ``l.ts`` in ``[r.ts - upper, r.ts - lower]``, so it is
    copied to the (at most ``ceil(span / w) + 1``) buckets covering that span.
    Every pair is produced exactly once (the left row has one bucket) and the
    exact range filter still applies. A hot key becomes many (key, bucket)
    groups instead of one huge sort-merge group, and a hot bucket a grid of
    tasks (:func:`grid_join`; ``seen`` as there, before they have buckets).
    """
    if left.isStreaming or right.isStreaming:
        return interval_join_plain(left, right, lower_s, upper_s, key)
    span = upper_s - lower_s
    w = int(bucket_s or max(span, 1))

    def bucket(c):
        return F.expr(f"(({c}) - pmod({c}, {w})) div {w}")

    lo, hi = bucket(f"r_ts - ({int(upper_s)})"), bucket(f"r_ts - ({int(lower_s)})")

    def placed(l: DataFrame, r: DataFrame) -> tuple[DataFrame, DataFrame]:
        return (_side(l, "l").withColumn(key, F.col(f"l_{key}")).withColumn("bucket", bucket("l_ts")),
                _side(r, "r").withColumn(key, F.col(f"r_{key}")).withColumn("bucket", F.explode(F.sequence(lo, hi))))

    j = grid_join(*placed(left, right), [key, "bucket"], group_rows, placed(*seen) if seen else None).drop(key)
    return _pairs(j.where((F.col("r_ts") >= F.col("l_ts") + F.lit(lower_s)) & (F.col("r_ts") <= F.col("l_ts") + F.lit(upper_s))), key)


# --- broadcast threshold (J4) -----------------------------------------------------

DEFAULT_THRESHOLD = 0  # threshold before any config row (the reference's default)


def threshold_alert(id_c, ts_c, vc_c, thr_c):
    return render(THRESHOLD_ALERT, record=sensor_text(id_c, ts_c, vc_c), threshold=thr_c)


def broadcast_threshold(data: DataFrame, config: DataFrame, order: str = "seq",
                        chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """Emit a data row when ``vc >= threshold``, where threshold is the latest
    config value that arrived before the row (0 before any).

    Data and config are one arrival sequence; the threshold "as of" each data
    row is the last non-null config value in that sequence -- a chunked
    prefix scan, not a broadcast of a config table whose size is unknown.
    On a stream, :mod:`tideline.streaming` re-reads the config per batch.
    """
    d = data.select("id", "ts", "vc", order, F.lit(None).cast("int").alias("__cfg"), F.lit(True).alias("__data"))
    c = config.select(F.lit(None).cast("string").alias("id"), F.lit(None).cast("bigint").alias("ts"),
                      F.lit(None).cast("int").alias("vc"), order,
                      F.col("threshold").cast("int").alias("__cfg"), F.lit(False).alias("__data"))
    both = d.unionByName(c)
    s = prefix_scan(both, order, [Scan("__thr", "__cfg", "last", inclusive=False)], chunk_width=chunk_width)
    out = (s.where("__data").withColumn("threshold", F.coalesce(F.col("__thr"), F.lit(DEFAULT_THRESHOLD)))
           .where(F.col("vc") >= F.col("threshold")))
    return out.select("id", "ts", "vc", order, "threshold",
                      threshold_alert(F.col("id"), F.col("ts"), F.col("vc"), F.col("threshold")).alias("text"))
