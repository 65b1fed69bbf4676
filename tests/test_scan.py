"""The chunked prefix scan equals the single window, for any chunking."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import over, topn, windows
from tideline.operators.scan import CHUNK, Scan, hot_chunks, key_columns, prefix_scan

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))),
                   min_size=1, max_size=40)


@settings(max_examples=6, deadline=None)
@given(rows=rows_st, width=st.integers(1, 7), totals_from=st.sampled_from(["input", "window"]))
def test_prefix_scan_matches_window(spark, rows, width, totals_from):
    df = spark.createDataFrame([(k, v, i * 3 - 20) for i, (k, v) in enumerate(rows)],
                               "k string, v int, seq bigint")
    got = prefix_scan(df, "seq", [Scan("s", "v", "sum"), Scan("c", "v", "count"), Scan("m", "v", "max", False),
                                  Scan("l", "v", "last", False), Scan("n", "v", "min")],
                      "k", chunk_width=width, totals_from=totals_from)
    w = Window.partitionBy("k").orderBy("seq")
    inc, exc = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    ref = df.select("seq", F.sum("v").over(inc).alias("s2"), F.count("v").over(inc).alias("c2"),
                    F.max("v").over(exc).alias("m2"), F.last("v", True).over(exc).alias("l2"),
                    F.min("v").over(inc).alias("n2"))
    a = {r.seq: (r.s, r.c, r.m, r.l, r.n) for r in got.collect()}
    b = {r.seq: (r.s2, r.c2, r.m2, r.l2, r.n2) for r in ref.collect()}
    assert a == b


def skewed(spark, n=3000):
    """One key with a third of the rows, a null key with some, many sparse ones."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, F.lit("hot")).when(i % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), i)).alias("k"),
        (i * 7919 % 101).cast("int").alias("vc"), (i * i + 5).alias("seq"))


@pytest.mark.parametrize("width", [1, 90, 10_000])
def test_skewed_and_null_keys(spark, width):
    df = skewed(spark)
    got = prefix_scan(df, "seq", [Scan("s", "vc", "sum"), Scan("m", "vc", "max", False)], "k", chunk_width=width)
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("seq", F.sum("vc").over(w).alias("s2"),
                    F.max("vc").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("m2"))
    both = got.join(ref, "seq")
    assert both.count() == df.count()
    assert both.where(~F.col("s").eqNullSafe(F.col("s2")) | ~F.col("m").eqNullSafe(F.col("m2"))).count() == 0


def test_only_hot_keys_are_cut_and_bursts_are_split(spark):
    """A million seconds with one row at either end and all others in one hour."""
    n = 20_002
    i = F.col("id")
    ts = F.when(i == 0, 0).when(i == 1, 10 ** 9).otherwise(5 * 10 ** 8 + i % 3600)
    df = spark.range(n).select(F.lit("a").alias("k"), ts.alias("ts")).unionByName(
        spark.range(500).select(F.concat(F.lit("s"), F.col("id")).alias("k"), F.col("id").alias("ts")))
    base, kcols = key_columns(df, ["k"])
    every, hot = hot_chunks(base, kcols, "ts", 1000)
    sizes = {(r[0], r[1]): r["count"] for r in every.groupBy(kcols[0], CHUNK).count().collect()}
    assert max(sizes.values()) <= 1000
    assert {c for (k, c) in sizes if k != "a"} == {0}
    assert hot.select(kcols[0]).distinct().collect()[0][0] == "a" and hot.count() == n


def test_global_scan_many_chunks(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 101).alias("v"), F.col("id").alias("seq"))
    got = prefix_scan(df, "seq", [Scan("mx", "v", "max", False)], chunk_width=16)
    ref = df.select("seq", F.max("v").over(Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)).alias("mx2"))
    assert got.join(ref, "seq").where(~F.col("mx").eqNullSafe(F.col("mx2"))).count() == 0


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError):
        prefix_scan(spark.range(3).withColumnRenamed("id", "__scan_x"), "__scan_x", [Scan("s", F.lit(1), "count")])


@pytest.mark.parametrize("width", [1, 2, 100, 10_000])
def test_running_topk_is_native_and_keeps_null_keys(spark, width):
    df = skewed(spark, 900)
    got = topn.running_topk(df, 3, "k", "seq", "vc", width)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
    seen: dict = {}
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.seq):
        seen.setdefault(r.k, []).append(r.vc)
        want[r.seq] = sorted(seen[r.k], reverse=True)[:3]
    assert {r.seq: r.top3 for r in got.collect()} == want


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_sessions_of_null_and_hot_keys(spark, width):
    rows = [(k, t, 1) for k, ts in (("a", [1, 2, 9, 10, 11, 40, 41, 90]), (None, [5, 6, 30]), ("b", [7])) for t in ts]
    got = windows.session_window(spark.createDataFrame(rows, "id string, ts bigint, vc int"), 5, chunk_rows=width)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [("a", 1, 7, 2, 2), ("a", 9, 16, 3, 3), ("a", 40, 46, 2, 2), ("a", 90, 95, 1, 1),
         (None, 5, 11, 2, 2), (None, 30, 35, 1, 1), ("b", 7, 12, 1, 1)], key=repr)


@pytest.mark.parametrize("options", [{}, {"bucket_s": 3}, {"strategy": "scan", "chunk_width": 4}])
def test_over_range_keeps_null_keys_and_dense_ranges(spark, options):
    df = spark.range(60).select(F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.lit("a")).alias("id"),
                                (F.col("id") * F.col("id") % 23).alias("ts"), F.col("id").alias("seq"),
                                F.when(F.col("id") % 5 > 0, 1).alias("vc"))
    rows = df.collect()
    want = {r.seq: sum(o.id == r.id and r.ts - 3 <= o.ts <= r.ts and o.vc is not None for o in rows) for r in rows}
    assert {r.seq: r.cnt for r in over.over_range_count(df, 3, **options).collect()} == want
