"""Rolling text files as a Python data source: parts that roll at a size or an
age, with a prefix and a suffix, in a folder per time bucket.

Tasks write hidden parts; a part becomes visible when its micro-batch is
committed, by a rename. The commit is a small log in the folder: what is to be
renamed is written down first (``_parts/<batch>.pending``), then renamed, then
marked ``.done``. A batch that is replayed after a failure finds its entry and
ends what the first attempt has begun, instead of adding its rows again. Parts
of failed or repeated attempts stay hidden and are deleted where they are known.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# The reference's part suffix and rolling policy (1 MiB, 60 ms).
PART_SUFFIX = ".log"
ROLL_BYTES = 1024 * 1024
ROLL_INTERVAL_MS = 60


@dataclass
class Parts(WriterCommitMessage):
    """What one task has written: hidden name and final name of each part."""

    renames: list[tuple[str, str]] = field(default_factory=list)


class _Writer:
    """The parts of one task, and the commit of all of them."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.prefix, self.suffix = options.get("prefix", "part"), options.get("suffix", PART_SUFFIX)
        self.roll_bytes = int(options.get("rollbytes", ROLL_BYTES))
        self.roll_ms = int(options.get("rollms", ROLL_INTERVAL_MS))

    def _fs(self) -> tuple[pyarrow.fs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return pyarrow.fs.FileSystem.from_uri(self.path)
        return pyarrow.fs.LocalFileSystem(), self.path

    def write(self, rows: Iterator[Row]) -> Parts:
        fs, root = self._fs()
        part, own, n = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        done = Parts()
        open_parts: dict[str, list] = {}     # bucket -> stream, bytes, opened at

        def roll(bucket: str) -> None:
            open_parts.pop(bucket)[0].close()

        try:
            for row in rows:
                bucket, raw = row[0], (row[1] or "").encode() + b"\n"
                now = time.monotonic()
                if bucket in open_parts and (open_parts[bucket][1] + len(raw) > self.roll_bytes
                                             or (now - open_parts[bucket][2]) * 1000 >= self.roll_ms):
                    roll(bucket)
                if bucket not in open_parts:
                    fs.create_dir(f"{root}/{bucket}", recursive=True)
                    hidden = f"{root}/{bucket}/.{self.prefix}-{own}-{n}.inprogress"
                    done.renames.append((hidden, f"{root}/{bucket}/{self.prefix}-{{batch}}-{part}-{n}{self.suffix}"))
                    open_parts[bucket] = [fs.open_output_stream(hidden), 0, now]
                    n += 1
                open_parts[bucket][0].write(raw)
                open_parts[bucket][1] += len(raw)
        except BaseException:
            self._drop(fs, [(h, f) for h, f in done.renames], list(open_parts.values()))
            raise
        for bucket in list(open_parts):
            roll(bucket)
        return done

    @staticmethod
    def _drop(fs, renames: list[tuple[str, str]], streams: list = ()) -> None:
        for s in streams:
            s[0].close()
        for hidden, _ in renames:
            if fs.get_file_info(hidden).type != pyarrow.fs.FileType.NotFound:
                fs.delete_file(hidden)

    def _finish(self, messages: list[Parts | None], batch: str) -> None:
        fs, root = self._fs()
        log = f"{root}/_parts"
        fs.create_dir(log, recursive=True)
        pending, finished = f"{log}/{batch}.pending", f"{log}/{batch}.done"
        there = lambda p: fs.get_file_info(p).type != pyarrow.fs.FileType.NotFound
        renames = [(h, f.format(batch=batch)) for m in messages if m is not None for h, f in m.renames]
        if there(finished) or there(pending):
            self._drop(fs, renames)          # an earlier attempt's parts stand
            if there(finished):
                return
            with fs.open_input_stream(pending) as f:
                renames = [tuple(x) for x in json.loads(f.read())]
        else:
            entry = f"{log}/.{uuid.uuid4().hex}"
            with fs.open_output_stream(entry) as f:
                f.write(json.dumps(renames).encode())
            fs.move(entry, pending)
        for hidden, final in renames:
            if there(hidden):
                fs.move(hidden, final)
        fs.move(pending, finished)

    def _abort(self, messages: list[Parts | None]) -> None:
        fs, _ = self._fs()
        for m in messages:
            if m is not None:
                self._drop(fs, m.renames)


class _StreamWriter(_Writer, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self._finish(messages, f"{batchId:010d}")

    def abort(self, messages, batchId: int) -> None:
        self._abort(messages)


class _BatchWriter(_Writer, DataSourceWriter):
    def commit(self, messages) -> None:
        self._finish(messages, uuid.uuid4().hex)

    def abort(self, messages) -> None:
        self._abort(messages)


class RollingText(DataSource):
    """Format ``rolling_text``: rows of ``bucket, value``. Options ``path``,
    ``prefix``, ``suffix``, ``rollBytes``, ``rollMs``. A row longer than
    ``rollBytes`` is a part of its own; a null value is an empty line."""

    @classmethod
    def name(cls) -> str:
        return "rolling_text"

    def schema(self) -> str:
        return "bucket string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _BatchWriter(dict(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return _StreamWriter(dict(self.options))


def _bucketed(df: DataFrame, value: str, time_col: str | None) -> DataFrame:
    from .sinks import with_hour_bucket

    out = with_hour_bucket(df, time_col=time_col)
    # rows without a time go to a bucket of their own
    return out.select(F.coalesce("bucket", F.lit("none")).alias("bucket"), F.col(value).cast("string").alias("value"))


def _options(prefix: str, suffix: str, roll_bytes: int, roll_ms: int, path: str) -> dict[str, str]:
    return {"path": path, "prefix": prefix, "suffix": suffix, "rollBytes": str(roll_bytes), "rollMs": str(roll_ms)}


def rolling_text_sink(df: DataFrame, path: str, checkpoint: str, value: str = "value", prefix: str = "part",
                      suffix: str = PART_SUFFIX, roll_bytes: int = ROLL_BYTES, roll_ms: int = ROLL_INTERVAL_MS,
                      time_col: str | None = None, available_now: bool = False, trigger: str = "2 seconds") -> StreamingQuery:
    """Stream the lines of ``df`` into rolling parts under ``path``, one folder
    per hour of processing time (or of ``time_col``), each line once."""
    df.sparkSession.dataSource.register(RollingText)
    w = (_bucketed(df, value, time_col).writeStream.format("rolling_text").option("checkpointLocation", checkpoint)
         .options(**_options(prefix, suffix, roll_bytes, roll_ms, path)))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def write_rolling_text(df: DataFrame, path: str, value: str = "value", prefix: str = "part", suffix: str = PART_SUFFIX,
                       roll_bytes: int = ROLL_BYTES, roll_ms: int = ROLL_INTERVAL_MS, time_col: str | None = None) -> None:
    """Batch twin of :func:`rolling_text_sink`."""
    df.sparkSession.dataSource.register(RollingText)
    (_bucketed(df, value, time_col).write.format("rolling_text").mode("append")
     .options(**_options(prefix, suffix, roll_bytes, roll_ms, path)).save())


def read_rolling_text(spark: SparkSession, path: str, suffix: str = PART_SUFFIX) -> DataFrame:
    """The committed lines: ``value``."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(path)
