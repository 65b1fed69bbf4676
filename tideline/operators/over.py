"""OVER windows with a RANGE frame on event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scan import DEFAULT_CHUNK_WIDTH, Scan, prefix_scan


def over_range_count(df: DataFrame, range_s: int = 10, key: str = "id", ts_col: str = "ts",
                     value: str = "vc", bucket_s: int | None = None, strategy: str = "bucket",
                     row_id: str = "seq", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """``count(vc) over (partition by id order by ts range between range_s
    preceding and current row)`` -- both ends inclusive, peers included.

    ``strategy="bucket"`` (default) -- rows are grouped by ``(key, time
    bucket)`` with bucket width ``w`` (four ranges by default); the rows of a
    bucket's last ``range_s`` seconds are also copied, as *halo* rows, into
    the next bucket. Every frame ``[t - range, t]`` then lies inside its row's
    own bucket plus the halo, so the RANGE window runs per ``(key, bucket)``
    and only owner rows are kept. One shuffle of the input and its halo. A
    bucket holds the rows of ``w`` seconds of one key, so a key that is dense
    within that time stays in one task; for such data use ``strategy="scan"``.

    ``strategy="scan"`` -- ``count = #rows <= t - #rows < t - range``: every row
    adds two probe rows, one prefix sum of non-null ``value`` flags runs over
    rows and probes in ``(ts, kind)`` order (:func:`~.scan.prefix_scan`: hot
    keys are cut by quantiles of time, so bursts are split), and the two probe
    values are paired back on ``row_id`` (unique per key).
    """
    if strategy == "scan":
        return _over_range_count_scan(df, range_s, key, ts_col, value, row_id, chunk_width)
    w = int(bucket_s or max(4 * range_s, 1))
    if w < range_s:
        raise ValueError("bucket width must cover the range")
    ts = F.col(ts_col)
    b = F.floor(ts / F.lit(w)).cast("bigint")
    halo = F.when(ts >= (b + 1) * F.lit(w) - F.lit(int(range_s)), F.array(b, b + 1)).otherwise(F.array(b))
    both = (df.withColumn("__own", b).withColumn("__bucket", F.explode(halo))
            .withColumn("__own", F.col("__own") == F.col("__bucket")))
    frame = (Window.partitionBy(key, "__bucket").orderBy(ts)
             .rangeBetween(-int(range_s), 0))
    out = both.withColumn("cnt", F.count(F.col(value)).over(frame))
    return out.where("__own").drop("__own", "__bucket")


def over_range_count_window(df: DataFrame, range_s: int = 10, key: str = "id", ts_col: str = "ts",
                            value: str = "vc") -> DataFrame:
    """The same result as one window per key (for keys known to be small)."""
    frame = Window.partitionBy(key).orderBy(F.col(ts_col)).rangeBetween(-int(range_s), 0)
    return df.withColumn("cnt", F.count(F.col(value)).over(frame))


def _over_range_count_scan(df: DataFrame, range_s: int, key: str, ts_col: str, value: str,
                           row_id: str, chunk_width: int) -> DataFrame:
    rows = df.select(key, F.col(ts_col).alias("__pos"), F.lit(1).alias("__kind"),
                     F.when(F.col(value).isNotNull(), 1).otherwise(0).alias("__w"), F.col(row_id).alias("__ref"))
    lo = df.select(key, (F.col(ts_col) - F.lit(range_s)).alias("__pos"), F.lit(0).alias("__kind"),
                   F.lit(0).alias("__w"), F.col(row_id).alias("__ref"))
    hi = df.select(key, F.col(ts_col).alias("__pos"), F.lit(2).alias("__kind"),
                   F.lit(0).alias("__w"), F.col(row_id).alias("__ref"))
    both = rows.unionByName(lo).unionByName(hi)
    scanned = prefix_scan(both, ["__pos", "__kind", "__ref"], [Scan("__c", "__w", "sum")], key,
                          chunk_width=chunk_width)
    probes = (scanned.where(F.col("__kind") != 1).groupBy(F.col(key).alias("__key"), "__ref")
              .agg((F.sum(F.when(F.col("__kind") == 2, F.col("__c")))
                    - F.coalesce(F.sum(F.when(F.col("__kind") == 0, F.col("__c"))), F.lit(0))).alias("cnt")))
    return (df.join(probes, F.col(key).eqNullSafe(F.col("__key")) & (F.col(row_id) == F.col("__ref")))
            .drop("__key", "__ref"))
