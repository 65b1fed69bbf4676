"""Skew-safe running aggregates in arrival order.

A plain ``sum(x) over (partition by key order by seq)`` puts every row of a
key into one task, and an un-partitioned one puts the whole table there. For
the arrival-order operators of this library (running sums, last value,
per-record watermarks, row numbers) that is the hot-key failure mode, so they
all go through :func:`prefix_scan`:

1. look at a fixed share of the rows, chosen by the hash of their position in
   the order: the keys with about more rows than a chunk may hold are *hot*.
   Their list is bounded (:data:`HOT_KEYS`), so every task can hold it, and
   needs no shuffle of the input;
2. cut hot keys into *chunks* by quantiles of the order column, taken from the
   same share in the same pass, so a burst is split as well as an even
   sequence; every other key is one chunk. The window runs inside each
   ``(key, chunk)``: one shuffle of the input;
3. for hot keys only, aggregate every chunk to one row and run the exclusive
   prefix over the chunk rows, ``rows / chunk_width`` of them for a key;
4. join the prefix back on ``(key, chunk)`` and combine. Without hot keys the
   chunk table is empty and adaptive execution drops the join.

What the share misses changes the size of a window, never a result.
The result equals the single window row for row; only the plan differs.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a key that one window may hold, and about the rows of a chunk of a
# larger key. 1M rows is a few MB sorted.
DEFAULT_CHUNK_WIDTH = 1 << 20

# Quantiles by which a hot key is cut first; each bracket is then cut evenly.
QUANTILES = 64
# Rows of a key that just fills a chunk which the first pass looks at.
SAMPLED = 128
# Hot keys at most, the largest ones. A key beyond them has fewer rows than the
# table's rows / HOT_KEYS.
HOT_KEYS = 1 << 14

KINDS = ("sum", "count", "max", "min", "last")
PREFIX = "__scan_"
CHUNK = PREFIX + "chunk"


@dataclass(frozen=True)
class Scan:
    """One running aggregate: ``name = kind(expr)`` over prior rows.

    ``inclusive`` decides whether the current row takes part.
    ``last`` is the last non-null value in order.
    """

    name: str
    expr: Column | str
    kind: str = "sum"
    inclusive: bool = True

    def col(self) -> Column:
        return F.col(self.expr) if isinstance(self.expr, str) else self.expr


def _running(kind: str, c: Column, w) -> Column:
    if kind == "sum":
        return F.sum(c).over(w)
    if kind == "count":
        return F.count(c).over(w)
    if kind == "max":
        return F.max(c).over(w)
    if kind == "min":
        return F.min(c).over(w)
    if kind == "last":
        return F.last(c, ignorenulls=True).over(w)
    raise ValueError(f"unknown scan kind {kind!r}")


def _total(kind: str, c: Column, order: Sequence[str]) -> Column:
    if kind == "sum":
        return F.sum(c)
    if kind == "count":
        return F.count(c)
    if kind == "max":
        return F.max(c)
    if kind == "min":
        return F.min(c)
    # last non-null value: the value at the greatest order among non-null
    # rows (max_by ignores null orderings).
    ordering = F.struct(*[F.col(o) for o in order]) if len(order) > 1 else F.col(order[0])
    return F.max_by(c, F.when(c.isNotNull(), ordering))


def _of_totals(kind: str) -> str:
    return "sum" if kind == "count" else kind


def _combine(kind: str, prefix: Column, local: Column) -> Column:
    if kind == "count":
        return (F.coalesce(prefix, F.lit(0)) + F.coalesce(local, F.lit(0))).cast("bigint")
    if kind == "sum":
        return (F.when(prefix.isNull(), local)
                .when(local.isNull(), prefix)
                .otherwise(prefix + local))
    if kind == "max":
        return F.greatest(prefix, local)
    if kind == "min":
        return F.least(prefix, local)
    return F.coalesce(local, prefix)


def key_columns(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with its keys as plain, non-null columns and their names, so that
    windows, chunk tables and joins all partition on exactly the same columns.
    A nullable key becomes (value or default, is null); no key at all becomes
    a constant one."""
    taken = [c for c in df.columns if c.startswith(PREFIX)]
    if taken:
        raise ValueError(f"columns {taken} have names that the scan uses itself")
    names: list[str] = []
    for i, k in enumerate(keys):
        f = df.schema[k]
        if f.nullable:
            df = (df.withColumn(f"{PREFIX}v{i}", F.coalesce(F.col(k), _default(f.dataType)))
                  .withColumn(f"{PREFIX}n{i}", F.col(k).isNull()))
            names += [f"{PREFIX}v{i}", f"{PREFIX}n{i}"]
        else:
            names.append(k)
    if not names:
        df, names = df.withColumn(f"{PREFIX}all", F.lit(0)), [f"{PREFIX}all"]
    return df, names


def hot_chunks(base: DataFrame, kcols: Sequence[str], position: str, chunk_width: int = DEFAULT_CHUNK_WIDTH,
               seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Two frames: ``base`` with the column :data:`CHUNK`, and of it the rows
    of hot keys alone. A key with more than about ``chunk_width`` rows is hot;
    its chunk grows along ``position`` (a bigint, rows of equal position share
    a chunk, null comes first). All other keys are the one chunk 0.

    ``seen`` is a cheaper frame with the same keys and positions to find hot
    keys in, if ``base`` is dear to compute.
    """
    n, bounds, top, parts = (PREFIX + c for c in ("rows", "bounds", "top", "parts"))
    quantiles = F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES)])
    rate = max(1, int(chunk_width) // SAMPLED)
    share = (base if seen is None else seen).select(*kcols, F.col(position).alias(top))
    if rate > 1:
        share = share.where(F.pmod(F.xxhash64(top), F.lit(rate)) == 0)
    hot = (share.groupBy(*kcols).agg((F.count(F.lit(1)) * rate).alias(n),
                                     F.percentile_approx(top, quantiles, 10_000).alias(bounds), F.max(top).alias(top))
           .where(F.col(n) > int(chunk_width)).orderBy(F.desc(n)).limit(HOT_KEYS)
           .select(*kcols, F.array_distinct(bounds).alias(bounds), top,
                   F.ceil(F.col(n) / (QUANTILES * int(chunk_width))).cast("bigint").alias(parts)))
    p = F.col(position)
    at = F.size(F.filter(bounds, lambda b: b <= p))
    low = F.get(bounds, F.greatest(at, F.lit(1)) - 1)
    high = F.coalesce(F.get(bounds, at), F.col(top) + 1)
    inside = (p - low).cast("double") / F.greatest(high - low, F.lit(1)).cast("double")
    step = F.least(F.col(parts) - 1, F.floor(inside * F.col(parts)).cast("bigint"))
    chunk = (F.when(F.col(parts).isNull(), F.lit(0)).when(p.isNull(), F.lit(-1))
             .otherwise(at * F.col(parts) + F.greatest(step, F.lit(0)))).cast("bigint")
    helpers = [bounds, top, parts]
    every = base.join(F.broadcast(hot), list(kcols), "left").withColumn(CHUNK, chunk).drop(*helpers)
    only = base.join(F.broadcast(hot), list(kcols)).withColumn(CHUNK, chunk).drop(*helpers)
    return every, only


def _chunk_prefix(totals: DataFrame, kcols: list[str], scans: list[Scan]) -> DataFrame:
    """``kcols, CHUNK`` and, for every scan, the aggregate of all earlier
    chunks. One task orders the chunk rows of a key: a million of them for a
    key of 2^40 rows."""
    w = Window.partitionBy(*kcols).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*kcols, CHUNK, *[
        _running(_of_totals(s.kind), F.col(f"{PREFIX}t_{s.name}"), w).alias(f"{PREFIX}p_{s.name}") for s in scans])


def prefix_scan(df: DataFrame, order_by: Sequence[str] | str, scans: Iterable[Scan],
                partition_by: Sequence[str] | str = (), chunk_width: int = DEFAULT_CHUNK_WIDTH,
                totals_from: str = "input", seen: DataFrame | None = None) -> DataFrame:
    """Add one column per :class:`Scan`: a running aggregate over the rows of
    the same ``partition_by`` key that come before (and, if inclusive, at)
    each row in ``order_by`` order, null first.

    ``order_by`` must be unique within a key for the result to be
    deterministic, as with any ROWS frame, and begin with an integer column.
    ``totals_from`` says whether hot keys' chunks are summed up from the input
    again or from the windows' output. ``seen``: see :func:`hot_chunks`; a
    frame with at least the keys and the first order column of every row.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    scans = list(scans)
    for s in scans:
        if s.kind not in KINDS:
            raise ValueError(f"unknown scan kind {s.kind!r}")
    base, kcols = key_columns(df, keys)
    if seen is not None:
        seen = seen.select(*[F.col(c) for c in dict.fromkeys([*keys, order[0]])])
        for k in keys:  # the key columns must come out alike
            if df.schema[k].nullable != seen.schema[k].nullable:
                raise ValueError(f"key {k} is nullable in one of both frames only")
        seen, _ = key_columns(seen, keys)
    every, hot = hot_chunks(base, kcols, order[0], chunk_width, seen)

    def windows(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*kcols, CHUNK).orderBy(*order)
        for s in scans:
            frame = w.rowsBetween(Window.unboundedPreceding, 0 if s.inclusive else -1)
            rows = rows.withColumn(f"{PREFIX}l_{s.name}", _running(s.kind, s.col(), frame))
        return rows

    local = windows(every)
    if totals_from == "window":
        last = F.struct(*[F.col(o) for o in order])
        totals = windows(hot).groupBy(*kcols, CHUNK).agg(
            *[F.max_by(F.col(f"{PREFIX}l_{s.name}") if s.inclusive
                       else _combine(s.kind, F.col(f"{PREFIX}l_{s.name}"), _one(s)), last).alias(f"{PREFIX}t_{s.name}")
              for s in scans])
    else:
        totals = hot.groupBy(*kcols, CHUNK).agg(
            *[_total(s.kind, s.col(), order).alias(f"{PREFIX}t_{s.name}") for s in scans])
    out = local.join(_chunk_prefix(totals, kcols, scans), [*kcols, CHUNK], "left")
    for s in scans:
        out = out.withColumn(s.name, _combine(s.kind, F.col(f"{PREFIX}p_{s.name}"), F.col(f"{PREFIX}l_{s.name}")))
    return out.drop(*[c for c in out.columns if c.startswith(PREFIX)])


def _one(s: Scan) -> Column:
    """What one row adds to an aggregate."""
    return F.when(s.col().isNotNull(), 1).otherwise(0) if s.kind == "count" else s.col()


def _default(dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                       T.DecimalType)):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.BinaryType):
        return F.lit(b"")
    if isinstance(dt, T.DateType):
        return F.lit("1970-01-01").cast(dt)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    raise TypeError(f"prefix_scan: unsupported nullable key type {dt}")


def row_number_in_order(df: DataFrame, order_by: Sequence[str] | str, partition_by=(),
                        name: str = "rn", chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """1-based position of each row within its key in ``order_by`` order,
    computed with :func:`prefix_scan` (a running count of rows)."""
    return prefix_scan(df, order_by, [Scan(name, F.lit(1), "count")], partition_by,
                       chunk_width=chunk_width)
