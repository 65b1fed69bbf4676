"""Declared tables: a name, a schema and a connector with options.

The reference declares sources and sinks with DDL ``WITH ('connector' =
...)``. Here the same declaration is a small registry entry that builds the
matching reader or writer; the query itself is ordinary Spark SQL on the
temp view the declaration registers. (Not a DDL parser.)
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import datagen as dg

_DECLARED: dict[str, "TableDecl"] = {}


@dataclass
class TableDecl:
    name: str
    schema: StructType | str | None
    connector: str                       # filesystem | datagen | kafka | jdbc | print | blackhole
    options: dict = field(default_factory=dict)


def declare_source(spark: SparkSession, name: str, connector: str, schema=None, streaming: bool = False,
                   **options) -> DataFrame:
    """Declare a source table, register it as a temp view and return it."""
    decl = TableDecl(name, schema, connector, options)
    _DECLARED[name] = decl
    df = _read(spark, decl, streaming)
    df.createOrReplaceTempView(name)
    return df


def declare_sink(name: str, connector: str, schema=None, **options) -> TableDecl:
    decl = TableDecl(name, schema, connector, options)
    _DECLARED[name] = decl
    return decl


def table_from_name(spark: SparkSession, name: str) -> DataFrame:
    """``tEnv.from(name)``: the registered view."""
    return spark.table(name)


def _read(spark: SparkSession, d: TableDecl, streaming: bool) -> DataFrame:
    o = dict(d.options)
    if d.connector == "datagen":
        rate, n, seed = o.pop("rows-per-second", None), o.pop("number-of-rows", None), int(o.pop("seed", 0))
        if streaming:
            return dg.datagen_stream(spark, int(rate or dg.ROWS_PER_SECOND), seed, fields=o)
        return dg.datagen(spark, int(n) if n is not None else None, seed, fields=o)
    if d.connector == "filesystem":
        fmt, path = o.pop("format", "parquet"), o.pop("path")
        r = spark.readStream if streaming else spark.read
        r = r.format(fmt).options(**o)
        if d.schema is not None:
            r = r.schema(d.schema)
        return r.load(path)
    if d.connector == "kafka":
        from .kafka import decode_values
        r = spark.readStream if streaming else spark.read
        return decode_values(r.format("kafka").options(**o).load())
    if d.connector == "jdbc":
        return spark.read.jdbc(o.pop("url"), o.pop("table"), properties=o)
    raise ValueError(f"unknown source connector {d.connector!r}")


def write_to(df: DataFrame, name: str, checkpoint: str | None = None):
    """``executeInsert(name)``: send a result to a declared sink."""
    d = _DECLARED[name]
    o = dict(d.options)
    _check_schema(df, d)
    if df.isStreaming:
        w = df.writeStream.option("checkpointLocation", checkpoint)
        if d.connector == "print":
            return w.format("console").outputMode(o.get("mode", "update")).start()
        if d.connector == "blackhole":
            return w.format("noop").outputMode(o.get("mode", "update")).start()
        if d.connector == "filesystem":
            fmt, path = o.pop("format", "parquet"), o.pop("path")
            return w.format(fmt).options(**o).start(path)
        if d.connector == "kafka":
            return w.format("kafka").options(**o).start()
        if d.connector == "jdbc":
            from .sinks import jdbc_writer
            return w.foreachBatch(jdbc_writer(o.pop("url"), o.pop("table"), o, columns=tuple(df.columns))).start()
        raise ValueError(f"unknown streaming sink connector {d.connector!r}")
    if d.connector == "print":
        df.show(truncate=False)
        return None
    if d.connector == "blackhole":
        df.write.format("noop").mode("overwrite").save()
        return None
    if d.connector == "filesystem":
        fmt, path = o.pop("format", "parquet"), o.pop("path")
        df.write.mode(o.pop("mode", "append")).format(fmt).options(**o).save(path)
        return None
    if d.connector == "jdbc":
        df.write.mode("append").jdbc(o.pop("url"), o.pop("table"), properties=o)
        return None
    if d.connector == "kafka":
        df.write.format("kafka").options(**o).save()
        return None
    raise ValueError(f"unknown sink connector {d.connector!r}")


def _check_schema(df: DataFrame, d: TableDecl) -> None:
    """A declared schema must be the result's: the same names and types in order."""
    if d.schema is None:
        return
    want = d.schema if isinstance(d.schema, StructType) else StructType.fromDDL(d.schema)
    if [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in want]:
        raise ValueError(f"sink {d.name!r} is declared as {want.simpleString()}, the result is {df.schema.simpleString()}")
