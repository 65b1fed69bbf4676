"""Running operators as streams: file-fed sources, triggers, sinks per batch."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.transforms import text_lines, tokenize


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = 1) -> DataFrame:
    """A directory as an unbounded source: every new file is one more input
    (oldest first). ``max_files_per_trigger`` bounds each micro-batch."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def start(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None,
          output_mode: str = "append", fmt: str | None = None, path: str | None = None,
          available_now: bool = True, processing_time: str | None = None,
          options: dict | None = None) -> StreamingQuery:
    """Start a query with a checkpoint (offsets, commits, state), either into
    ``sink`` via ``foreachBatch`` or into a format/path sink."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    if sink is not None:
        return w.foreachBatch(sink).start()
    if fmt:
        w = w.format(fmt)
    return w.start(path) if path else w.start()


def append_to(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch sink appending every batch to a table folder (shared
    storage on a cluster). Replays after a failure re-append the same batch;
    readers that need exactly-once dedupe on ``batch_id``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").format(fmt).save(path)
    return sink


def overwrite_to(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch sink replacing the table (complete-mode results)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(path)
    return sink


def topn_per_batch(n: int, writer: Callable[[DataFrame, int], None], value: str = "vc") -> Callable:
    """foreachBatch function that ranks the windows closed in this batch
    (phase 2 of the sliding Top-N) and hands the winners to ``writer``.
    With append-mode counts every row of a closed window arrives in the same
    batch, so ranking per batch is exact."""
    def rank(batch: DataFrame, batch_id: int) -> None:
        w = Window.partitionBy("window_end").orderBy(F.desc("cnt"), F.asc(value))
        top = (batch.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
               .select("window_start", "window_end", "rank", value, "cnt"))
        writer(top, batch_id)
    return rank


def restartable_word_count(spark: SparkSession, lines_dir: str, out_path: str, checkpoint: str,
                           max_files_per_trigger: int = 1) -> StreamingQuery:
    """Word count over a directory of text files, with the counts in the
    checkpointed state store: stop the query, add files, start it again with
    the same ``checkpoint`` and the counts continue from where they were.

    Every micro-batch appends the words it has changed as ``(word, cnt,
    batch_id)``; :func:`latest_counts` reads the result. A batch that is
    written again after a failure has the same counts under the same id."""
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", max_files_per_trigger) \
        .text(lines_dir).select(F.input_file_name().alias("doc"), F.col("value").alias("text"))
    words = tokenize(text_lines(lines.withColumnRenamed("doc", "doc_id"), "text", keep=("doc_id",)))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return start(counts, checkpoint, append_to(out_path), output_mode="update")


def latest_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The counts of a :func:`restartable_word_count` table: each word's last."""
    return spark.read.parquet(out_path).groupBy("word").agg(F.max_by("cnt", "batch_id").alias("cnt"))


def broadcast_threshold_batch(config_reader: Callable[[], DataFrame], writer: Callable[[DataFrame, int], None],
                              order: str = "seq", default: int = 0) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for the broadcast-threshold job on a stream.

    Each micro-batch re-reads the config table (``config_reader()``, columns
    ``threshold`` and ``order``), takes its latest row -- exactly one row, so
    the broadcast has a fixed size -- and keeps the data rows with
    ``vc >= threshold``. Config rows apply from the next micro-batch on.
    """
    from ..operators.joins import threshold_alert

    def run(batch: DataFrame, batch_id: int) -> None:
        # an aggregate without keys has one row, whatever the config table holds
        latest = config_reader().agg(F.max_by(F.col("threshold").cast("int"), order).alias("t")).first()["t"]
        out = (batch.withColumn("threshold", F.lit(default if latest is None else latest).cast("int"))
               .where(F.col("vc") >= F.col("threshold"))
               .select("id", "ts", "vc", order, "threshold",
                       threshold_alert(F.col("id"), F.col("ts"), F.col("vc"), F.col("threshold")).alias("text")))
        writer(out, batch_id)

    return run
