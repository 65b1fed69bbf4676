"""Top-N: sliding-window hot values (two-phase), global top-2, running top-3."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import CHUNK, DEFAULT_CHUNK_WIDTH, hot_chunks, key_columns
from ..functions.text import RULE, TOPN_ENTRY, render
from .windows import format_millis, window_agg

MIN_INT = -2147483648  # Integer.MIN_VALUE, the empty-slot sentinel of the top-2 accumulator


def sliding_count(df: DataFrame, size_s: int = 10, slide_s: int = 5, value: str = "vc") -> DataFrame:
    """Phase 1: rows per ``value`` in each sliding window (partial + final
    aggregation), tagged with the window end."""
    return window_agg(df, size_s, {"cnt": F.count(F.lit(1))}, [value], slide_s)


def sliding_topn(df: DataFrame, size_s: int = 10, slide_s: int = 5, n: int = 2, value: str = "vc") -> DataFrame:
    """Phase 2: per window end the ``n`` values with most rows (ties: smaller
    value first). ``row_number() <= n`` plans as a WindowGroupLimit, which
    also trims each task's rows before the shuffle by window end."""
    c = sliding_count(df, size_s, slide_s, value)
    w = Window.partitionBy("window_end").orderBy(F.desc("cnt"), F.asc(value))
    return (c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("window_start", "window_end", "rank", value, "cnt"))


def sliding_topn_all(df: DataFrame, size_s: int = 10, slide_s: int = 5, n: int = 2, value: str = "vc") -> DataFrame:
    """The un-keyed (``windowAll``) report: one text block per window listing
    ``Top<i>``, value, count and the formatted window end. Same two-phase
    plan as :func:`sliding_topn`; only the <= n winners are gathered."""
    t = sliding_topn(df, size_s, slide_s, n, value)
    entry = render(TOPN_ENTRY + RULE + "\n", rank=F.col("rank"), vc=F.col(value), count=F.col("cnt"),
                   end=format_millis(F.col("window_end") * 1000))
    g = t.groupBy("window_start", "window_end").agg(
        F.array_sort(F.collect_list(F.struct("rank", entry.alias("e")))).alias("entries"))
    return g.select("window_start", "window_end",
                    F.concat(F.lit(RULE + "\n"), F.array_join(F.col("entries.e"), "")).alias("text"))


def top2_overall(df: DataFrame, value: str = "vc", n: int = 2) -> DataFrame:
    """Global top-2 values with rank; duplicates kept; ``Integer.MIN_VALUE``
    is the empty-slot sentinel and never emitted; nulls are skipped.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every task keeps
    its own top n, only n rows per task reach the final merge.
    """
    top = (df.select(F.col(value).cast("int").alias("value"))
           .where(F.col("value").isNotNull() & (F.col("value") > F.lit(MIN_INT)))
           .orderBy(F.desc("value")).limit(n))
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("value"))))


def top2_by_key(df: DataFrame, key: str = "id", value: str = "vc", n: int = 2) -> DataFrame:
    """Grouped form of :func:`top2_overall` (WindowGroupLimit per key)."""
    w = Window.partitionBy(key).orderBy(F.desc(value))
    return (df.where(F.col(value).isNotNull() & (F.col(value) > F.lit(MIN_INT)))
            .select(key, F.col(value).alias("value"), F.row_number().over(w).alias("rank"))
            .where(F.col("rank") <= n))


# --- running top-k per key in arrival order (K2 / T5) ---------------------------

def _cascade(rows: DataFrame, value: str, k: int, partition: list[str], order: list[str]) -> DataFrame:
    """Add ``__m1 .. __mk``: the k largest values so far, by an insertion
    cascade. A value is compared with the largest before it; the smaller of
    the two falls through to the second place, and so on. A value that falls
    past a place with nothing in it yet falls no further. All windows share
    one sort; nulls are no values."""
    w = Window.partitionBy(*partition).orderBy(*order)
    so_far, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    falls = F.col(value)
    for i in range(1, k + 1):
        rows = rows.withColumn(f"__f{i}", falls)
        rows = (rows.withColumn(f"__m{i}", F.max(f"__f{i}").over(so_far))
                .withColumn(f"__b{i}", F.max(f"__f{i}").over(before)))
        falls = F.when(F.col(f"__b{i}").isNotNull() & F.col(f"__f{i}").isNotNull(),
                       F.least(f"__f{i}", f"__b{i}"))
    return rows.drop(*[f"__{c}{i}" for c in "fb" for i in range(1, k + 1)])


def running_topk(df: DataFrame, k: int = 3, key: str = "id", order: str = "seq", value: str = "vc",
                 chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """After every row, the ``k`` largest values of its key so far (desc).

    One cascade of running maxima per key (:func:`_cascade`); keys with more
    than ``chunk_width`` rows run it per chunk. Of these keys alone each chunk
    gives its k largest, the same cascade over them gives the k largest of all
    earlier chunks, and the k largest of both lists are a row's result.
    """
    places = [f"__m{i}" for i in range(1, k + 1)]
    d = (df.where(F.col(value).isNotNull())
         .select(F.col(key), F.col(order).cast("bigint").alias(order), F.col(value).cast("int").alias(value)))
    base, kcols = key_columns(d, [key])
    every, hot = hot_chunks(base, kcols, order, chunk_width)
    local = _cascade(every, value, k, [*kcols, CHUNK], [order])

    # the places only rise along a chunk: their largest values are its top k
    tops = (_cascade(hot, value, k, [*kcols, CHUNK], [order]).groupBy(*kcols, CHUNK)
            .agg(*[F.max(m).alias(m) for m in places]))
    spread = tops.select(*kcols, CHUNK, F.posexplode(F.array_compact(F.array(*places))).alias("__i", "__v"))
    reached = (_cascade(spread, "__v", k, kcols, [CHUNK, "__i"]).groupBy(*kcols, CHUNK)
               .agg(*[F.max(m).alias(m) for m in places]))
    prior = Window.partitionBy(*kcols).orderBy(CHUNK)
    prefix = reached.select(*kcols, CHUNK, F.lag(F.array_compact(F.array(*places))).over(prior).alias("__prefix"))

    both = F.concat(F.coalesce("__prefix", F.array().cast("array<int>")), F.array_compact(F.array(*places)))
    return (local.join(prefix, [*kcols, CHUNK], "left")
            .select(key, order, value, F.slice(F.sort_array(both, asc=False), 1, k).alias(f"top{k}")))


def running_top3(df: DataFrame, key: str = "id", order: str = "seq", value: str = "vc",
                 chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """The reference's list-state job: add vc, sort desc, keep 3, emit."""
    r = running_topk(df, 3, key, order, value, chunk_width)
    return r.withColumn("top3_text", F.array_join(F.transform("top3", lambda x: x.cast("string")), ","))
