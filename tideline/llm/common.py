"""Helpers shared by the operators: cutting lineage, prefix sums, word counts."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word is a run of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text as a long; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that an operator is about to add. An input
    column with the name of an output column is replaced by it, in any case."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def cut(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a frame as Parquet into the shared checkpoint folder and read it
    back: later stages start from files that every executor sees, so a lost
    executor costs its own tasks and nothing before them."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def frugal(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that hands freed memory back to the system
    when its task ends: Python workers live on between tasks, and those of
    several stages share an executor's memory."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped


def running_totals(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str],
                   value: str, name: str, super_chunk: int = 4096) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same key that
    come *before* the row in ``(chunk, order)`` order, as a long.

    ``chunk`` (a non-null, non-negative long) must not fall along the order
    and bounds the rows that meet in one window: rows are summed inside their
    chunk, chunks inside groups of ``super_chunk`` chunks, and only the group
    totals run along a whole key. No key goes through one task. ``keys`` must
    be non-null. ``df`` is read twice; pass a written table.
    """
    ks = list(keys)
    sc = "__super"
    base = df.withColumn(sc, F.expr(f"`{chunk}` div {int(super_chunk)}"))
    w_row = Window.partitionBy(*ks, sc, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("__in", F.coalesce(F.sum(value).over(w_row), F.lit(0)))
    chunks = base.groupBy(*ks, sc, chunk).agg(F.sum(value).alias("__v"))
    w_chunk = Window.partitionBy(*ks, sc).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(*ks, sc, chunk, "__v",
                           F.coalesce(F.sum("__v").over(w_chunk), F.lit(0)).alias("__c"))
    supers = chunks.groupBy(*ks, sc).agg(F.sum("__v").alias("__v"))
    w_super = (Window.partitionBy(*ks) if ks else Window.partitionBy()).orderBy(sc)
    supers = supers.select(*ks, sc, F.coalesce(
        F.sum("__v").over(w_super.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__s"))
    chunks = (chunks.join(supers, [*ks, sc])
              .select(*ks, sc, chunk, (F.col("__c") + F.col("__s")).alias("__before")))
    return (rows.join(chunks, [*ks, sc, chunk])
            .withColumn(name, (F.col("__in") + F.col("__before")).cast("bigint"))
            .drop("__in", "__before", sc))


def unit_hash(*cols: Column) -> Column:
    """A double in [0, 1) from the hash of the columns: 53 bits of xxhash64."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def ragged_take(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join the pieces ``flat[offsets[i]:offsets[i + 1]]`` for i in ``which``.
    Returns the joined array and the length of each piece."""
    starts = offsets[which]
    lens = offsets[which + 1] - starts
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)
    return flat[at], lens
