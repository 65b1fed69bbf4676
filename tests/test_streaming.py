"""Streaming forms: the same rows fed as files give the batch result;
state survives restarts; timers fire on the right row."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tideline import schema
from tideline.operators import changelog, keyed, topn, windows
from tideline.streaming import processors as P
from tideline.streaming.runner import append_to, file_stream, latest_counts, restartable_word_count, start, topn_per_batch


def _feed(df, directory, parts, order="seq"):
    """Write ``df`` as ``parts`` parquet files in arrival order (one file per
    seq range, written one after the other so mtimes ascend)."""
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        part = df.where((F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step))
        part.coalesce(1).write.mode("overwrite").parquet(os.path.join(directory, f"p{i:03d}"))
        time.sleep(0.05)


def _stream_dir(base, parts):
    # file source reads one directory: move the part files up one level
    out = os.path.join(base, "in")
    os.makedirs(out, exist_ok=True)
    n = 0
    for i in range(parts):
        d = os.path.join(base, f"p{i:03d}")
        for f in sorted(os.listdir(d)):
            if f.endswith(".parquet"):
                os.link(os.path.join(d, f), os.path.join(out, f"{n:05d}.parquet"))
                n += 1
                time.sleep(0.02)
    return out


@pytest.fixture(scope="module")
def arrivals_dir(spark):
    base = tempfile.mkdtemp(prefix="tl-stream-")
    df = schema.sensor_arrivals(spark, SF_SMALL)
    _feed(df, base, 4)
    return _stream_dir(base, 4), df


def _run(spark, stream_df, mode="append"):
    base = tempfile.mkdtemp(prefix="tl-out-")
    q = start(stream_df, os.path.join(base, "ckpt"), append_to(os.path.join(base, "out")), output_mode=mode)
    q.awaitTermination()
    out = os.path.join(base, "out")
    return spark.read.parquet(out).drop("batch_id") if os.path.exists(out) else None


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_tumbling_reduce_stream_equals_batch(spark, arrivals_dir):
    path, batch = arrivals_dir
    s = windows.with_watermark(file_stream(spark, path, schema.SENSOR_SEQ), 3 * 86400)
    got = _run(spark, windows.tumbling_reduce(s, 86400))
    want = windows.tumbling_reduce(batch, 86400)
    cols = ["id", "window_start", "window_end", "ts", "vc"]
    # windows closed by the final watermark (max ts - delay) are emitted
    wm = batch.agg(F.max("ts")).first()[0] - 3 * 86400
    assert _rows(got, cols) == _rows(want.where(F.col("window_end") <= wm), cols)


@pytest.mark.parametrize("proc,twin,cols", [
    (P.LevelJumpAlert(), lambda b: keyed.level_jump_alert(b), ["id", "seq", "vc", "last_vc"]),
    (P.RunningTopK(3), lambda b: topn.running_top3(b), ["id", "seq", "vc", "top3"]),
    (P.RunningHistogram(), lambda b: keyed.running_histogram(b), ["id", "seq", "vc", "cnt"]),
    (P.RunningAggregate(), lambda b: keyed.running_sum(b), ["id", "seq", "vc", "vc_sum"]),
    (P.GroupSumChangelog(), lambda b: changelog.group_sum_changelog(b), ["id", "seq", "op_no", "op", "sumVc"]),
])
def test_processor_equals_batch_twin(spark, arrivals_dir, proc, twin, cols):
    path, batch = arrivals_dir
    got = _run(spark, P.apply(file_stream(spark, path, schema.SENSOR_SEQ), proc))
    got_rows = _rows(got, cols)
    want_rows = _rows(twin(batch), cols)
    if "top3" in cols:
        got_rows = [tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in got_rows]
        want_rows = [tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in want_rows]
    assert got_rows == want_rows


def test_event_timer_fires_after_the_right_row(spark):
    base = tempfile.mkdtemp(prefix="tl-timer-")
    src, ck, out = os.path.join(base, "in"), os.path.join(base, "ckpt"), os.path.join(base, "out")
    os.makedirs(src)

    def add(ts, i):
        spark.createDataFrame([("s1", ts, 1, i)], schema.SENSOR_SEQ).coalesce(1).write.parquet(
            os.path.join(base, f"f{i}"))
        f = [x for x in os.listdir(os.path.join(base, f"f{i}")) if x.endswith(".parquet")][0]
        os.link(os.path.join(base, f"f{i}", f), os.path.join(src, f"{i:03d}.parquet"))
        time.sleep(0.05)

    def run():
        s = windows.with_watermark(file_stream(spark, src, schema.SENSOR_SEQ), 5)
        q = start(P.apply(s, P.KeyTimer(5000), time_mode="EventTime"), ck, append_to(out))
        q.awaitTermination()
        return spark.read.parquet(out).collect() if os.path.exists(out) else []

    add(1, 1)
    add(10, 2)
    assert run() == []           # watermark 10 s - 5 s = 5000 ms: not yet
    add(11, 3)
    fired = run()                # watermark 6000 ms passes the timer
    assert [(r.id, r.timer_ms) for r in fired] == [("s1", 5000)]


def test_restartable_word_count(spark):
    base = tempfile.mkdtemp(prefix="tl-wc-")
    src, ck, out = os.path.join(base, "in"), os.path.join(base, "ckpt"), os.path.join(base, "out")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("hello scala\nhello java\n")
    restartable_word_count(spark, src, out, ck).awaitTermination()
    first = {r.word: r.cnt for r in latest_counts(spark, out).collect()}
    assert first == {"hello": 2, "scala": 1, "java": 1}
    time.sleep(0.05)
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("hello git  1\n")
    restartable_word_count(spark, src, out, ck).awaitTermination()
    second = {r.word: r.cnt for r in latest_counts(spark, out).collect()}
    assert second == {"hello": 3, "scala": 1, "java": 1, "git": 1, "": 1, "1": 1}


def test_sliding_topn_stream(spark, arrivals_dir):
    path, batch = arrivals_dir
    s = windows.with_watermark(file_stream(spark, path, schema.SENSOR_SEQ), 3 * 86400)
    counts = topn.sliding_count(s, 7200, 3600)
    base = tempfile.mkdtemp(prefix="tl-topn-")
    out = os.path.join(base, "out")
    start(counts, os.path.join(base, "ckpt"), topn_per_batch(2, append_to(out))).awaitTermination()
    got = spark.read.parquet(out)
    wm = batch.agg(F.max("ts")).first()[0] - 3 * 86400
    want = topn.sliding_topn(batch, 7200, 3600, 2).where(F.col("window_end") <= wm)
    cols = ["window_end", "rank", "vc", "cnt"]
    assert _rows(got, cols) == _rows(want, cols)


def test_interval_and_window_join_stream(spark, arrivals_dir):
    from tideline.operators import joins

    path, batch = arrivals_dir
    s = windows.with_watermark(file_stream(spark, path, schema.SENSOR_SEQ), 3 * 86400)
    left, right = s.where(F.col("vc") % 2 == 0), s.where(F.col("vc") % 2 == 1)
    got = _run(spark, joins.interval_join_plain(left, right, -7200, 3600))
    bl, br = batch.where(F.col("vc") % 2 == 0), batch.where(F.col("vc") % 2 == 1)
    cols = ["id", "l_ts", "l_vc", "r_ts", "r_vc"]
    assert _rows(got, cols) == _rows(joins.interval_join(bl, br, -7200, 3600), cols)
    got_w = _run(spark, joins.window_join(left, right, 86400))
    cols_w = ["id", "window_start", "l_ts", "r_ts"]
    assert _rows(got_w, cols_w) == _rows(joins.window_join(bl, br, 86400), cols_w)


def test_allowed_lateness_stream_matches_replay(spark):
    from tideline.operators import lateness

    base_ts = 1_000_000
    rows = [("s1", base_ts + t, 1, i + 1) for i, t in enumerate((1, 5, 13, 6, 15, 3, 25))]
    rows.append(("zz", base_ts + 1000, 1, 99))           # moves the watermark past every window
    base = tempfile.mkdtemp(prefix="tl-late-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    for r in rows:                                        # one row per file = one row per micro-batch
        d = os.path.join(base, f"f{r[3]:03d}")
        spark.createDataFrame([r], schema.SENSOR_SEQ).coalesce(1).write.parquet(d)
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.link(os.path.join(d, f), os.path.join(src, f"{r[3]:03d}.parquet"))
        time.sleep(0.02)
    got = _run(spark, P.allowed_lateness_stream(file_stream(spark, src, schema.SENSOR_SEQ), 10, 3, 2))
    got = got.where(F.col("id") == "s1")
    fired = sorted((r.window_start - base_ts, r.firing, r.cnt) for r in got.where("kind = 'firing'").collect())
    assert fired == [(0, 0, 2), (0, 1, 3), (10, 0, 2), (20, 0, 1)]
    assert [r.ts - base_ts for r in got.where("kind = 'late'").collect()] == [3]
    batch = spark.createDataFrame(rows[:-1], schema.SENSOR_SEQ)
    want = sorted((r.window_start - base_ts, r.firing, r.cnt) for r in lateness.allowed_lateness(batch, 10, 3, 2).collect())
    assert fired == want


def test_over_range_count_stream_equals_batch(spark, arrivals_dir):
    from tideline.operators import over

    path, batch = arrivals_dir
    delay = 3 * 86400
    s = windows.with_watermark(file_stream(spark, path, schema.SENSOR_SEQ), delay)
    got = _run(spark, P.apply(s, P.OverRangeCount(86400), time_mode="EventTime"))
    wm = batch.agg(F.max("ts")).first()[0] - delay
    want = over.over_range_count(batch, 86400).where(F.col("ts") <= wm)
    cols = ["id", "ts", "seq", "cnt"]
    assert _rows(got, cols) == _rows(want, cols)


def test_broadcast_threshold_stream(spark):
    from tideline.streaming.runner import broadcast_threshold_batch

    base = tempfile.mkdtemp(prefix="tl-thr-")
    src, cfg, out = os.path.join(base, "in"), os.path.join(base, "cfg"), os.path.join(base, "out")
    os.makedirs(src)

    def add_data(vc, i):
        d = os.path.join(base, f"d{i}")
        spark.createDataFrame([("s", i, vc, i)], schema.SENSOR_SEQ).coalesce(1).write.parquet(d)
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.link(os.path.join(d, f), os.path.join(src, f"{i:03d}.parquet"))

    def add_config(thr, i):
        spark.createDataFrame([(thr, i)], "threshold int, seq bigint").write.mode("append").parquet(cfg)

    def run():
        fn = broadcast_threshold_batch(
            lambda: spark.read.parquet(cfg) if os.path.exists(cfg) else spark.createDataFrame([], "threshold int, seq bigint"),
            append_to(out))
        start(file_stream(spark, src, schema.SENSOR_SEQ), os.path.join(base, "ck"), fn).awaitTermination()

    # arrival: data 5; config 10; data 9; data 10; config 3; data 4
    add_data(5, 1); run()
    add_config(10, 2); add_data(9, 3); add_data(10, 4); run()
    add_config(3, 5); add_data(4, 6); run()
    got = sorted((r.vc, r.threshold) for r in spark.read.parquet(out).collect())
    assert got == [(4, 3), (5, 0), (10, 10)]


def test_running_word_count_stream(spark):
    from pyspark.sql import types as T

    from tideline.operators.transforms import text_lines, tokenize

    base = tempfile.mkdtemp(prefix="tl-rwc-")
    for i, chunk in enumerate([["hello scala", "hello java"], ["hello git  1", "hello hot-fix 2"],
                               ["hello remote", "hello remote1"]]):
        with open(os.path.join(base, f"{i}.txt"), "w") as f:
            f.write("\n".join(chunk) + "\n")
        time.sleep(0.05)
    lines = (spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(base)
             .select(F.input_file_name().alias("doc_id"), F.col("value").alias("text")))
    words = tokenize(text_lines(lines, "text", keep=("doc_id",)))
    cols = T.StructType([T.StructField("word", T.StringType()), T.StructField("doc_id", T.StringType()),
                         T.StructField("line_no", T.LongType()), T.StructField("word_no", T.LongType())])
    proc = P.RunningCount("word", ("doc_id", "line_no", "word_no"), cols)
    got = _run(spark, words.select("word", "doc_id", "line_no", "word_no")
               .groupBy("word").transformWithState(proc, proc.SCHEMA, "Append", "None"))
    hello = sorted(r.cnt for r in got.where("word = 'hello'").collect())
    assert hello == [1, 2, 3, 4, 5, 6]
    assert got.count() == 15  # every word emits once (incl. the empty word of the double space)


def test_running_row_count_survives_restart(spark):
    from pyspark.sql import types as T

    base = tempfile.mkdtemp(prefix="tl-k7-")
    src, ck, out = os.path.join(base, "in"), os.path.join(base, "ck"), os.path.join(base, "out")
    os.makedirs(src)
    cols = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("seq", T.LongType())])
    proc = P.RunningCount("shard", ("seq",), cols)

    def add(lo, hi, name):
        d = os.path.join(base, name)
        spark.range(lo, hi).select(F.col("id").alias("seq")).coalesce(1).write.parquet(d)
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.link(os.path.join(d, f), os.path.join(src, f"{name}.parquet"))

    def run():
        s = file_stream(spark, src, T.StructType([T.StructField("seq", T.LongType())]))
        s = s.select(F.pmod("seq", F.lit(2)).cast("int").alias("shard"), "seq")
        start(s.groupBy("shard").transformWithState(proc, proc.SCHEMA, "Append", "None"), ck,
              append_to(out)).awaitTermination()

    add(0, 6, "a")
    run()
    add(6, 10, "b")          # restart from the checkpoint: counts continue
    run()
    got = {r.seq: r.cnt for r in spark.read.parquet(out).collect()}
    want = {r.seq: r.cnt for r in keyed.running_row_count(
        spark.range(0, 10).select(F.col("id").alias("seq"), F.pmod("id", F.lit(2)).alias("shard")), "shard").collect()}
    assert got == want


def test_window_contents_stream(spark, arrivals_dir):
    path, batch = arrivals_dir
    s = windows.with_watermark(file_stream(spark, path, schema.SENSOR_SEQ), 3 * 86400)
    got = _run(spark, windows.window_contents(s, 86400))
    wm = batch.agg(F.max("ts")).first()[0] - 3 * 86400
    want = windows.window_contents(batch, 86400).where(F.col("window_end") <= wm)
    cols = ["id", "window_start", "cnt", "text"]
    assert _rows(got, cols) == _rows(want, cols)
