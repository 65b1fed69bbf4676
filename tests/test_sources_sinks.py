"""Sources, sinks and declared tables."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tideline import schema
from tideline.operators.transforms import row_time_column
from tideline.sources import datagen, kafka, sinks, tables
from tideline.sources.lines import line_stream, parse_sensor_lines, read_lines, reject_sensor_lines, rows
from tideline.streaming import processors as P
from tideline.streaming.runner import file_stream

SAMPLE = ["1", "2", "3rer", "435545", "dfds"]


def test_read_lines_and_bucketed_text_roundtrip(spark):
    base = tempfile.mkdtemp(prefix="tl-files-")
    src = os.path.join(base, "in.txt")
    with open(src, "w") as f:
        f.write("\n".join(SAMPLE) + "\n")
    df = read_lines(spark, src)
    assert [r.value for r in df.collect()] == SAMPLE
    out = os.path.join(base, "out")
    sinks.write_bucketed_text(df, out, max_records_per_file=2)
    dirs = [d for d in os.listdir(out) if d.startswith("bucket=")]
    assert len(dirs) >= 1 and len(dirs[0]) == len("bucket=yyyy-MM-dd HH")
    back = spark.read.text(out)
    assert sorted(r.value for r in back.collect()) == sorted(SAMPLE)


def test_bucketed_text_stream(spark):
    base = tempfile.mkdtemp(prefix="tl-fsink-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(SAMPLE) + "\n")
    q = sinks.bucketed_text_sink(line_stream(spark, src), os.path.join(base, "out"),
                                 os.path.join(base, "ckpt"), trigger="100 milliseconds")
    q.processAllAvailable()
    q.stop()
    assert sorted(r.value for r in spark.read.text(os.path.join(base, "out")).collect()) == sorted(SAMPLE)


def test_parse_modes(spark):
    lines = spark.createDataFrame([("s1,1,1",), ("s2,2,2,extra",), ("s3,x,3",), ("s4,4",)], "value string")
    good = parse_sensor_lines(lines, mode="PERMISSIVE")
    assert [(r.id, r.ts, r.vc) for r in good.collect()] == [("s1", 1, 1), ("s2", 2, 2)]
    assert reject_sensor_lines(lines).count() == 2
    with pytest.raises(Exception):
        parse_sensor_lines(lines, mode="FAILFAST").collect()


def test_datagen(spark):
    df = datagen.datagen(spark, 5000, seed=7)
    r = df.agg(F.min("id"), F.max("id"), F.min("vc"), F.max("vc"), F.min("ts"), F.max("ts"),
               F.countDistinct("ts")).first()
    assert (r[0], r[1], r[2], r[3]) == (1, 10, 1, 100)
    assert (r[4], r[5], r[6]) == (1, 5000, 5000)  # sequence without gaps
    assert datagen.datagen(spark, 100, seed=7).collect() == datagen.datagen(spark, 100, seed=7).collect()


def test_kafka_frames(spark):
    raw = spark.createDataFrame([(b"s1", b"s1,1,1", "ws", 0, 5, None, 0)], kafka.KAFKA_SCHEMA)
    assert kafka.decode_values(raw).first().value == "s1,1,1"
    lines = spark.createDataFrame([("s1,1,1",)], "value string")
    rec = kafka.keyed_rows(lines, "ws").first()
    assert (rec.topic, bytes(rec.key), bytes(rec.value)) == ("ws", b"s1", b"s1,1,1")
    opts = kafka.kafka_source_options("host:9092", "topic_1", "g1")
    assert opts["startingOffsets"] == "latest" and opts["subscribe"] == "topic_1"


def test_jdbc_sink_derby(spark):
    url = "jdbc:derby:memory:tideline_ws;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = rows(spark, [("s1", 1, 1), ("s2", 2, 2)])
    sinks.jdbc_writer(url, "ws", props)(df, 0)
    back = spark.read.jdbc(url, "ws", properties=props)
    assert sorted((r.id, r.ts, r.vc) for r in back.collect()) == [("s1", 1, 1), ("s2", 2, 2)]


def test_declared_tables(spark):
    src = tables.declare_source(spark, "source", "datagen", **{"number-of-rows": "1000", "seed": "3"})
    assert src.count() == 1000
    res = spark.sql("select id, sum(vc) as sumVc from source group by id")
    base = tempfile.mkdtemp(prefix="tl-tables-")
    tables.declare_sink("sink", "filesystem", path=os.path.join(base, "sink"), format="parquet")
    tables.write_to(res, "sink")
    back = spark.read.parquet(os.path.join(base, "sink"))
    assert back.count() == res.count() == 10
    assert tables.table_from_name(spark, "source").count() == 1000
    spark.sql("create table if not exists tl_group_sum (id int, sumVc bigint) using parquet")
    sinks.insert_into(res, "tl_group_sum", overwrite=True)
    assert spark.table("tl_group_sum").count() == 10


def test_row_time_column(spark):
    df = row_time_column(rows(spark, [("s1", 1, 1)]))
    t = df.first().row_time
    assert t is not None and t.microsecond % 1000 == 0


def test_line_stream(spark):
    base = tempfile.mkdtemp(prefix="tl-lines-")
    with open(os.path.join(base, "a.txt"), "w") as f:
        f.write("a\nb\n")
    q = line_stream(spark, base).writeStream.format("memory").queryName("tl_lines").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.value for r in spark.table("tl_lines").collect()) == ["a", "b"]


def test_ttl_state_expires_in_processing_time(spark):
    base = tempfile.mkdtemp(prefix="tl-ttl-")
    src = os.path.join(base, "in")
    os.makedirs(src)

    def add(vc, i):
        spark.createDataFrame([("s1", i, vc, i)], schema.SENSOR_SEQ).coalesce(1).write.parquet(
            os.path.join(base, f"f{i}"))
        f = [x for x in os.listdir(os.path.join(base, f"f{i}")) if x.endswith(".parquet")][0]
        os.link(os.path.join(base, f"f{i}", f), os.path.join(src, f"{i:03d}.parquet"))

    stream = P.apply(file_stream(spark, src, schema.SENSOR_SEQ), P.LevelJumpAlert(10, ttl_ms=20000),
                     time_mode="ProcessingTime")
    q = (stream.writeStream.format("memory").queryName("tl_ttl").option("checkpointLocation", os.path.join(base, "ck"))
         .trigger(processingTime="200 milliseconds").start())

    def wait_input(n, deadline_s=60):
        # processAllAvailable() does not return for processing-time state: poll progress instead
        end = time.time() + deadline_s
        while time.time() < end:
            if sum(p["numInputRows"] for p in q.recentProgress) >= n:
                return
            time.sleep(0.2)
        raise TimeoutError(n)

    try:
        add(20, 1)
        wait_input(1)
        add(25, 2)            # within the TTL: |25 - 20| = 5, no alert
        wait_input(2)
        time.sleep(25)
        add(27, 3)            # state expired: last = 0, alert (0, 27)
        wait_input(3)
        time.sleep(1)
    finally:
        q.stop()
    got = [(r.last_vc, r.vc) for r in spark.table("tl_ttl").orderBy("seq").collect()]
    assert got == [(0, 20), (0, 27)]


def test_sensor_views_agree_on_rows(spark):
    a, b = schema.sensor(spark, SF_SMALL), schema.sensor_arrivals(spark, SF_SMALL)
    assert a.count() == b.count() == b.select("seq").distinct().count()


def test_processing_time_timer_and_sql_watermark(spark):
    from tideline.operators.windows import watermark_on

    base = tempfile.mkdtemp(prefix="tl-ptimer-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    spark.createDataFrame([("s1", 1, 1, 1)], schema.SENSOR_SEQ).coalesce(1).write.parquet(os.path.join(base, "f"))
    f = [x for x in os.listdir(os.path.join(base, "f")) if x.endswith(".parquet")][0]
    os.link(os.path.join(base, "f", f), os.path.join(src, "000.parquet"))
    stream = watermark_on(row_time_column(file_stream(spark, src, schema.SENSOR_SEQ)), "row_time", 5)
    q = (P.apply(stream, P.KeyTimer(fixed_ms=None, delay_ms=500), time_mode="ProcessingTime")
         .writeStream.format("memory").queryName("tl_ptimer").option("checkpointLocation", os.path.join(base, "ck"))
         .trigger(processingTime="200 milliseconds").start())
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("tl_ptimer").count() == 0:
            time.sleep(0.5)
    finally:
        q.stop()
    assert [r.id for r in spark.table("tl_ptimer").collect()] == ["s1"]


def test_print_sink_starts(spark):
    base = tempfile.mkdtemp(prefix="tl-print-")
    with open(os.path.join(base, "a.txt"), "w") as f:
        f.write("x\n")
    q = sinks.print_sink(line_stream(spark, base), prefix="main")
    q.processAllAvailable()
    q.stop()
    assert q.lastProgress["numInputRows"] == 1


def test_datagen_stream(spark):
    base = tempfile.mkdtemp(prefix="tl-dgs-")
    q = (datagen.datagen_stream(spark, rows_per_second=50).writeStream.format("memory").queryName("tl_dgs")
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(processingTime="200 milliseconds").start())
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("tl_dgs").count() < 20:
            time.sleep(0.5)
    finally:
        q.stop()
    r = spark.table("tl_dgs").agg(F.min("id"), F.max("id"), F.min("vc"), F.max("vc"), F.min("ts"),
                                  F.count("*"), F.countDistinct("ts")).first()
    assert 1 <= r[0] <= r[1] <= 10 and 1 <= r[2] <= r[3] <= 100
    assert r[4] == 1 and r[5] == r[6] >= 20
