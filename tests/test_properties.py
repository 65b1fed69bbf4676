"""Rewritten plans equal their direct form on random inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import joins, over, windows
from tideline.schema import SENSOR_SEQ

ids = st.sampled_from(["a", "b"])
sensor_rows = st.lists(st.tuples(ids, st.integers(-30, 30), st.one_of(st.none(), st.integers(0, 9))),
                       min_size=1, max_size=25)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(rows)], SENSOR_SEQ)


@settings(max_examples=6, deadline=None)
@given(left=sensor_rows, right=sensor_rows, lower=st.integers(-6, 0), width=st.integers(0, 6),
       bucket=st.integers(1, 9))
def test_bucketed_interval_join_equals_plain(spark, left, right, lower, width, bucket):
    l, r = frame(spark, left), frame(spark, right)
    upper = lower + width
    a = joins.interval_join(l, r, lower, upper, bucket_s=bucket)
    b = joins.interval_join_plain(l, r, lower, upper)
    key = lambda df: sorted(((x.id, x.l_ts, x.l_vc, x.r_ts, x.r_vc) for x in df.collect()), key=repr)
    assert key(a) == key(b)


@settings(max_examples=6, deadline=None)
@given(rows=sensor_rows, rng=st.integers(0, 12))
def test_over_range_strategies_equal_window(spark, rows, rng):
    df = frame(spark, rows)
    want = {x.seq: x.cnt for x in over.over_range_count_window(df, rng).collect()}
    for strategy in ("bucket", "scan"):
        got = {x.seq: x.cnt for x in over.over_range_count(df, rng, strategy=strategy).collect()}
        assert got == want, strategy


@settings(max_examples=6, deadline=None)
@given(rows=sensor_rows, size=st.integers(1, 5), slide=st.integers(1, 4))
def test_sliding_count_window_equals_rows_frame(spark, rows, size, slide):
    df = frame(spark, rows)
    got = {(x.id, x.fire_rn): (x.cnt, x.vc) for x in
           windows.count_window_sliding(df, size, slide, chunk_width=3).collect()}
    w = Window.partitionBy("id").orderBy("seq")
    ref = (df.withColumn("rn", F.row_number().over(w))
           .withColumn("cnt", F.count(F.lit(1)).over(w.rowsBetween(-(size - 1), 0)))
           .withColumn("s", F.sum("vc").over(w.rowsBetween(-(size - 1), 0)))
           .where(F.col("rn") % slide == 0))
    want = {(x.id, x.rn): (x.cnt, x.s) for x in ref.collect()}
    assert got == want


@settings(max_examples=6, deadline=None)
@given(rows=sensor_rows, gap=st.integers(0, 6), chunk_rows=st.integers(1, 4))
def test_session_window_equals_gaps_and_islands(spark, rows, gap, chunk_rows):
    # unique ts per key, as sessions order by ts
    seen, uniq = set(), []
    for k, t, v in rows:
        if (k, t) not in seen:
            seen.add((k, t))
            uniq.append((k, t, v))
    df = frame(spark, uniq)
    got = sorted(((x.id, x.window_start, x.window_end, x.cnt, x.vc)
                  for x in windows.session_window(df, gap, chunk_rows=chunk_rows).collect()), key=repr)
    w = Window.partitionBy("id").orderBy("ts")
    g = (df.withColumn("prev", F.lag("ts").over(w))
         .withColumn("new", F.when(F.col("prev").isNull() | (F.col("ts") - F.col("prev") > gap), 1).otherwise(0))
         .withColumn("sess", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .groupBy("id", "sess").agg(F.min("ts").alias("s"), (F.max("ts") + gap).alias("e"),
                                    F.count(F.lit(1)).alias("c"), F.sum("vc").alias("v")))
    want = sorted(((x.id, x.s, x.e, x.c, x.v) for x in g.collect()), key=repr)
    assert got == want


@settings(max_examples=6, deadline=None)
@given(rows=sensor_rows, delay=st.integers(0, 5), lateness=st.integers(0, 5), width=st.integers(1, 5))
def test_lateness_classification_equals_window(spark, rows, delay, lateness, width):
    from tideline.operators import lateness as L

    df = frame(spark, rows)
    got = {x.seq: x.status for x in L.late_data_split(df, 10, delay, lateness, chunk_width=width).collect()}
    wm = F.max("ts").over(Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)) - delay
    end = F.col("ts") - F.pmod("ts", F.lit(10)) + 10
    ref = df.withColumn("wm", wm).withColumn(
        "st", F.when(F.col("wm").isNull() | (F.col("wm") < end), "on_time")
        .when(F.col("wm") < end + lateness, "allowed").otherwise("late"))
    assert got == {x.seq: x.st for x in ref.collect()}
