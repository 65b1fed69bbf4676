"""Sinks: rolling text files by hour bucket, JDBC, console/print, insert into."""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The reference's file sink bucket pattern and JDBC batching (100 rows, 3 s, 3 retries).
BUCKET_PATTERN = "yyyy-MM-dd HH"
CHECKPOINT_INTERVAL = "2 seconds"
JDBC_BATCH_ROWS = 100
JDBC_MAX_RETRIES = 3


def with_hour_bucket(df: DataFrame, pattern: str = BUCKET_PATTERN, time_col: str | None = None) -> DataFrame:
    """Add ``bucket`` = processing time (or ``time_col``) formatted like the
    reference's date-time bucket assigner (session time zone)."""
    t = F.current_timestamp() if time_col is None else F.col(time_col)
    return df.withColumn("bucket", F.date_format(t, pattern))


def bucketed_text_sink(df: DataFrame, path: str, checkpoint: str, value: str = "value",
                       max_records_per_file: int | None = None, trigger: str = CHECKPOINT_INTERVAL
                       ) -> StreamingQuery:
    """Rolling text files, one folder per hour bucket (``bucket=<yyyy-MM-dd
    HH>``), exactly-once through the file sink's commit log. Files roll per
    micro-batch (``trigger``) and at ``max_records_per_file``."""
    out = with_hour_bucket(df.select(F.col(value).cast("string").alias("value")))
    w = (out.writeStream.format("text").partitionBy("bucket").option("checkpointLocation", checkpoint)
         .trigger(processingTime=trigger))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w.start(path)


def write_bucketed_text(df: DataFrame, path: str, value: str = "value", mode: str = "append",
                        max_records_per_file: int | None = None) -> None:
    """Batch twin of :func:`bucketed_text_sink`."""
    out = with_hour_bucket(df.select(F.col(value).cast("string").alias("value")))
    w = out.write.mode(mode).partitionBy("bucket")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.text(path)


def read_bucketed_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def delete_batch(spark: SparkSession, url: str, table: str, props: dict, column: str, batch_id: int) -> None:
    """Delete what an earlier attempt of a batch has inserted, over one driver
    connection; a table that isn't there yet has nothing to delete."""
    jvm = spark._jvm
    if props.get("driver"):
        jvm.java.lang.Class.forName(props["driver"])
    settings = jvm.java.util.Properties()
    for k, v in props.items():
        settings.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        name = table.split(".")[-1]
        tables = connection.getMetaData().getTables(None, None, None, None)
        there = False
        while tables.next():
            there = there or tables.getString("TABLE_NAME").lower() == name.strip('"').lower()
        if there:
            statement = connection.prepareStatement(f'DELETE FROM {table} WHERE "{column}" = ?')
            statement.setLong(1, batch_id)
            statement.executeUpdate()
    finally:
        connection.close()


def jdbc_writer(url: str, table: str, properties: dict | None = None, batch_rows: int = JDBC_BATCH_ROWS,
                retries: int = JDBC_MAX_RETRIES, backoff_s: float = 1.0,
                columns=("id", "ts", "vc"), batch_column: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: ``insert into table values (?, ?, ?, ?)`` in JDBC
    batches of ``batch_rows`` with bounded retries. Every row carries its
    batch's id in ``batch_column``, and each attempt first deletes that batch's
    rows: partitions that an attempt committed before it failed, and batches
    replayed after a restart, are there once. Credentials come only from
    ``properties`` (user/password/driver)."""
    props = dict(properties or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(retries + 1):
            try:
                delete_batch(batch.sparkSession, url, table, props, batch_column, batch_id)
                rows = batch.select(*columns, F.lit(batch_id).cast("bigint").alias(batch_column))
                (rows.write.mode("append").option("batchsize", batch_rows)
                 .jdbc(url, table, properties=props))
                return
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(backoff_s * (attempt + 1))

    return write


def jdbc_sink(df: DataFrame, url: str, table: str, checkpoint: str, properties: dict | None = None,
              trigger: str = "3 seconds") -> StreamingQuery:
    """Streaming JDBC sink, idempotent by batch id (:func:`jdbc_writer`)."""
    return (df.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=trigger)
            .foreachBatch(jdbc_writer(url, table, properties)).start())


def print_sink(df: DataFrame, prefix: str | None = None, truncate: bool = False) -> StreamingQuery:
    """``.print([prefix])``: the console sink (driver stdout)."""
    out = df if prefix is None else df.select(F.lit(prefix).alias("sink"), "*")
    return out.writeStream.format("console").option("truncate", truncate).start()


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """``executeInsert`` / ``INSERT INTO``: append a result to a declared table
    (matching columns by position, as SQL does)."""
    df.write.insertInto(table, overwrite=overwrite)
