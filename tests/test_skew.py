"""Hot groups: grid joins, bounded hot-key finding, timers over long sequences."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tideline import schema
from tideline.operators import joins, lateness, scan
from tideline.plans import catalog

KEYED = "id string, ts bigint, vc int, seq bigint"


def skewed(seed, n, hot=0.4):
    """Rows of which one key and window hold a share; some keys and times are null."""
    r = random.Random(seed)
    return [("hot", 1000 + r.randrange(10), r.randrange(9), k) if r.random() < hot
            else (r.choice(["a", "b", None]), r.choice([*range(990, 1040), None]), r.randrange(9), k) for k in range(n)]


def pairs(left, right, match):
    return Counter((a[0], a[1], a[2], b[1], b[2]) for a in left for b in right
                   if a[0] is not None and a[0] == b[0] and a[1] is not None and b[1] is not None and match(a[1], b[1]))


@pytest.mark.parametrize("group_rows", [10, 60, 1 << 20])
def test_grid_joins_equal_plain_joins(spark, group_rows):
    left, right = skewed(1, 160), skewed(2, 110)
    l, r = spark.createDataFrame(left, KEYED), spark.createDataFrame(right, KEYED)
    cols = ["id", "l_ts", "l_vc", "r_ts", "r_vc"]
    got = joins.window_join(l, r, 10, group_rows=group_rows).select(*cols).collect()
    assert Counter(map(tuple, got)) == pairs(left, right, lambda a, b: a // 10 == b // 10)
    got = joins.interval_join(l, r, -4, 3, group_rows=group_rows).select(*cols).collect()
    assert Counter(map(tuple, got)) == pairs(left, right, lambda a, b: a - 4 <= b <= a + 3)


def test_no_cell_of_a_grid_exceeds_the_limit(spark):
    """A group of a third of the rows: without adaptive skew handling, no
    group that a task of the join meets is above the limit."""
    n, limit = 60_000, 4096
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("k"), F.col("id").alias("seq"))
    left, right = rows.withColumnRenamed("seq", "l"), rows.where("seq % 2 = 0").withColumnRenamed("seq", "r")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        seen = {}
        real = type(left).drop

        def spy(df, *cols):
            if "__rows_at" in cols:
                seen["cells"] = df
            return real(df, *cols)

        type(left).drop = spy
        try:
            joined = joins.grid_join(left, right, ["k"], limit)
        finally:
            type(left).drop = real
        cells = seen["cells"].groupBy("k", "__rows_at", "__cols_at").agg(
            (F.count_distinct("l") + F.count_distinct("r")).alias("n")).agg(F.max("n").alias("n"), F.count("*").alias("cells"))
        worst = cells.first()
        assert worst.n <= limit and worst.cells > 100
        n_hot, n_right = n // 3, n // 6
        assert joined.where("k = 'hot'").count() == n_hot * n_right
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def test_hot_keys_are_found_in_a_share_of_the_rows(spark):
    """With a chunk of 1024 rows an eighth of the rows is looked at: the hot
    key is cut evenly, and the running sum is that of a plain window."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).cast("bigint").alias("k"),
        (F.col("id") * 7).alias("seq"), (F.col("id") % 10).alias("v"))
    base, kcols = scan.key_columns(rows, ["k"])
    every, only = scan.hot_chunks(base, kcols, "seq", 1024)
    sizes = [r["count"] for r in every.groupBy("k", scan.CHUNK).count().collect()]
    assert max(sizes) < 2 * 1024 and {r.k for r in only.select("k").distinct().collect()} == {0}
    got = scan.prefix_scan(rows, "seq", [scan.Scan("s", "v", "sum")], "k", chunk_width=1024)
    from pyspark.sql import Window
    plain = rows.withColumn("p", F.sum("v").over(Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)))
    assert got.join(plain, ["k", "seq"]).where("s <> p").count() == 0 and got.count() == 40_000


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


def test_reads_of_a_scan(spark):
    """One light pass for hot keys per use of the list, one for the windows, one for hot keys' chunks."""
    s = schema.sensor_arrivals(spark, SF_SMALL)
    assert scans(scan.prefix_scan(s, "seq", [scan.Scan("x", "vc", "sum")], "id")) <= 4
    assert scans(catalog.QUERIES["allowed_lateness"](spark, SF_SMALL)) <= 10
    assert scans(catalog.QUERIES["interval_join_on_time"](spark, SF_SMALL)) <= 20


def timer_firings(rows, timer, delay):
    """Row by row: registrations wait until the watermark rises beyond the timer."""
    out, waiting, top = Counter(), Counter(), None
    for key, ts, _, seq in sorted(rows, key=lambda r: r[3]):
        waiting[key] += 1
        if ts is not None and (top is None or ts > top):
            top = ts
            if ts > timer + delay:
                out.update({(k, timer, n, seq): 1 for k, n in waiting.items()})
                waiting.clear()
    return out


@pytest.mark.parametrize("chunk_width", [6, 1 << 20])
def test_event_timer_fires_again_at_each_rise(spark, chunk_width):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", "c", None]), r.choice([k // 2 + r.randrange(-6, 6), None]), 1, k) for k in range(120)]
    df = spark.createDataFrame(rows, KEYED)
    got = lateness.event_timer(df, 20, 3, chunk_width=chunk_width)
    want = timer_firings(rows, 20, 3)
    assert len({k[3] for k in want}) > 5 and Counter(map(tuple, got.collect())) == want
    assert lateness.event_timer(df, 10_000, 3).collect() == []
