"""Table <-> changelog views of a grouped sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SENSOR
from .scan import DEFAULT_CHUNK_WIDTH, Scan, prefix_scan

INSERT, UPDATE_BEFORE, UPDATE_AFTER = "+I", "-U", "+U"


def group_sum_changelog(df: DataFrame, key: str = "id", value: str = "vc", order: str = "seq",
                        chunk_width: int = DEFAULT_CHUNK_WIDTH) -> DataFrame:
    """``select key, sum(value) group by key`` as a changelog: the first row of
    a key inserts (+I); a later row that changes the sum retracts the old
    result (-U) and adds the new one (+U); an unchanged sum emits nothing.

    Columns: key, ``seq`` of the causing row, ``op_no`` (0/1 within the
    row), ``op``, ``sumVc``.
    """
    s = prefix_scan(df, order, [Scan("__new", F.col(value).cast("bigint"), "sum"),
                                Scan("__old", F.col(value).cast("bigint"), "sum", inclusive=False),
                                Scan("__n", F.lit(1), "count")], key, chunk_width=chunk_width)
    ins = F.array(F.struct(F.lit(0).alias("op_no"), F.lit(INSERT).alias("op"), F.col("__new").alias("sumVc")))
    upd = F.array(F.struct(F.lit(0).alias("op_no"), F.lit(UPDATE_BEFORE).alias("op"), F.col("__old").alias("sumVc")),
                  F.struct(F.lit(1).alias("op_no"), F.lit(UPDATE_AFTER).alias("op"), F.col("__new").alias("sumVc")))
    none = F.array().cast("array<struct<op_no:int,op:string,sumVc:bigint>>")
    ops = (F.when(F.col("__n") == 1, ins)
           .when(~F.col("__new").eqNullSafe(F.col("__old")), upd)
           .otherwise(none))
    return s.select(key, order, F.explode(ops).alias("c")).select(key, order, "c.op_no", "c.op", "c.sumVc")


def apply_changelog(changes: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """Fold a changelog back into the table: the last +I/+U per key."""
    latest = (changes.where(F.col("op").isin(INSERT, UPDATE_AFTER))
              .groupBy(key).agg(F.max_by("sumVc", F.struct(order, "op_no")).alias("sumVc")))
    return latest


def append_stream(df: DataFrame) -> DataFrame:
    """Insert-only table -> typed sensor rows (``toDataStream``)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SENSOR.fields],
                     *[c for c in df.columns if c not in SENSOR.fieldNames()])
