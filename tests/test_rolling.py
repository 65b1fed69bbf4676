"""Rolling text files: roll by size and age, hidden until committed, each line once."""

import datetime as dt
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tideline.sources import rolling


def files(path, hidden=False):
    found = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]
    return sorted(f for f in found if os.path.basename(f).startswith(".") == hidden and "_parts" not in f)


def lines(spark, path):
    return sorted(r.value for r in rolling.read_rolling_text(spark, path).collect())


def feed(spark, folder, name, values):
    os.makedirs(folder, exist_ok=True)
    d = tempfile.mkdtemp(prefix="tl-roll-")
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("overwrite").parquet(d)
    f = next(x for x in os.listdir(d) if x.endswith(".parquet"))
    os.link(os.path.join(d, f), os.path.join(folder, f"{name}.parquet"))
    time.sleep(0.02)


def test_parts_roll_at_a_size_and_a_stream_goes_on(spark):
    base = tempfile.mkdtemp(prefix="tl-roll-")
    src, out, ck = (os.path.join(base, x) for x in ("in", "out", "ck"))
    first = [f"line {i} " + "x" * 40 for i in range(200)]
    feed(spark, src, "a", first)

    def run():
        s = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(src)
        rolling.rolling_text_sink(s, out, ck, prefix="log", roll_bytes=1024, roll_ms=60_000, available_now=True).awaitTermination()

    run()
    parts = files(out)
    assert len(parts) > 5 and all(os.path.getsize(f) <= 1024 and os.path.basename(f).startswith("log-") and f.endswith(".log")
                                  for f in parts)
    assert all(dt.datetime.strptime(os.path.basename(os.path.dirname(f)), "%Y-%m-%d %H") for f in parts)
    feed(spark, src, "b", ["after the restart"])
    run()
    assert lines(spark, out) == sorted([*first, "after the restart"]) and files(out, hidden=True) == []


def test_parts_roll_at_an_age():
    base = tempfile.mkdtemp(prefix="tl-roll-")
    writer = rolling._BatchWriter({"path": base, "rollms": "60"})

    def rows():
        for i in range(4):
            time.sleep(0.08)
            yield ("b", str(i))

    class Context:
        @staticmethod
        def partitionId():
            return 0

    real = rolling.TaskContext.get
    rolling.TaskContext.get = staticmethod(lambda: Context)
    try:
        message = writer.write(rows())
    finally:
        rolling.TaskContext.get = real
    assert len(message.renames) == 4 and files(base) == []
    writer.commit([message])
    assert len(files(base)) == 4


def test_a_failed_write_leaves_nothing_to_see(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="tl-roll-"), "out")
    rolling.write_rolling_text(spark.createDataFrame([("one",), (None,), ("two",)], "value string"), base)
    bad = spark.range(500, numPartitions=3).select(
        F.when(F.col("id") == 490, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="broken row"):
        rolling.write_rolling_text(bad, base)
    assert lines(spark, base) == ["", "one", "two"]


def test_a_batch_that_is_committed_again_adds_nothing(spark):
    """A crash between the sink's commit and the query's own: the batch is
    written and committed a second time, as it is after one in the middle of the renames."""
    base = tempfile.mkdtemp(prefix="tl-roll-")
    writer = rolling._StreamWriter({"path": base})

    def attempt(name):
        os.makedirs(os.path.join(base, "b"), exist_ok=True)
        parts = []
        for n in range(3):
            hidden = os.path.join(base, "b", f".part-{name}-{n}.inprogress")
            with open(hidden, "w") as f:
                f.write(f"row {n}\n")
            parts.append((hidden, os.path.join(base, "b", f"part-{{batch}}-0-{n}.log")))
        return rolling.Parts(parts)

    writer.commit([attempt("one"), None], 0)
    writer.commit([attempt("two")], 0)
    assert lines(spark, base) == ["row 0", "row 1", "row 2"] and files(base, hidden=True) == []

    half = attempt("three")                      # batch 1 breaks off after its first rename
    real, moves = writer._fs, []
    fs, root = real()

    class Breaks:
        def __getattr__(self, name):
            return getattr(fs, name)

        def move(self, a, b):
            moves.append(b)
            if len(moves) > 2:
                raise OSError("lost")
            fs.move(a, b)

    writer._fs = lambda: (Breaks(), root)
    with pytest.raises(OSError):
        writer.commit([half], 1)
    writer._fs = real
    writer.commit([attempt("four")], 1)
    assert lines(spark, base) == sorted(["row 0", "row 1", "row 2"] * 2) and files(base, hidden=True) == []
