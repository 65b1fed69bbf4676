"""Stream forms whose batch twins replay arrival order row by row: fed one row
a micro-batch, across restarts, they give the twins' results."""

import os
import random
import tempfile
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline import schema
from tideline.operators import joins, lateness, topn, windows
from tideline.streaming import joins as SJ
from tideline.streaming import windows as SW
from tideline.streaming.runner import append_to, file_stream, start

BASE = 1_000_000


@pytest.fixture(autouse=True)
def one_partition(spark):
    """Micro-batches of a few rows: one state partition instead of eight."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


class Feed:
    """A folder that is read as a stream, one file a micro-batch."""

    def __init__(self, spark, columns):
        self.spark, self.columns, self.n = spark, columns, 0
        self.base = tempfile.mkdtemp(prefix="tl-feed-")
        self.src, self.out = os.path.join(self.base, "in"), os.path.join(self.base, "out")
        os.makedirs(self.src)

    def add(self, *rows):
        d = os.path.join(self.base, f"f{self.n:04d}")
        self.spark.createDataFrame(list(rows), self.columns).coalesce(1).write.parquet(d)
        f = next(x for x in os.listdir(d) if x.endswith(".parquet"))
        os.link(os.path.join(d, f), os.path.join(self.src, f"{self.n:04d}.parquet"))
        self.n += 1
        time.sleep(0.01)

    def stream(self, per_batch=1):
        kind = self.spark.createDataFrame([], self.columns).schema
        return file_stream(self.spark, self.src, kind, max_files_per_trigger=per_batch)

    def run(self, df):
        q = start(df, os.path.join(self.base, "ckpt"), append_to(self.out))
        q.awaitTermination()
        return q

    def rows(self):
        return self.spark.read.parquet(self.out).drop("batch_id") if os.path.exists(self.out) else None


TWO_SIDED = "side string, id string, ts bigint, vc int, seq bigint"


def two_sided(seed, n):
    r, ts, rows = random.Random(seed), BASE, []
    for seq in range(n):
        ts += r.choice([0, 0, 1, 1, 2, 4])
        rows.append((r.choice(["left", "right"]), r.choice(["a", "b"]), ts - r.choice([0, 0, 0, 1, 3, 9, 14]), seq, seq))
    return rows


def sides(df):
    return [df.where(F.col("side") == s).drop("side") for s in ("left", "right")]


def multiset(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_interval_join_stream_gives_pairs_and_late_rows(spark):
    rows = two_sided(12, 18)
    feed = Feed(spark, TWO_SIDED)
    for k, row in enumerate(rows):
        feed.add(row)
        if k == len(rows) // 2:    # stop, and go on from the checkpoint
            feed.run(SJ.interval_join_stream(*sides(feed.stream()), -2, 1, 3))
    feed.run(SJ.interval_join_stream(*sides(feed.stream()), -2, 1, 3))
    got = feed.rows()
    batch = sides(spark.createDataFrame(rows, TWO_SIDED))
    pairs = ("id", "l_ts", "l_vc", "r_ts", "r_vc", "text")
    want = multiset(lateness.interval_join_on_time(*batch, -2, 1, 3), *pairs)
    assert len(want) > 3 and multiset(SJ.join_pairs(got), *pairs) == want
    late = ("side", "id", "ts", "vc", "seq", "wm")
    want = multiset(lateness.interval_join_late(*batch, 3), *late)
    assert {k[0] for k in want} == {"left", "right"} and multiset(SJ.late_rows(got), *late) == want


def test_interval_join_stream_of_whole_batches_and_wide_intervals(spark):
    """No row is late: pairs across and inside micro-batches, wide buckets, null ids and times."""
    rows = [(s, i, t, v, q) for s, i, t, v, q in two_sided(5, 60)] + [("left", None, BASE, 1, 100), ("right", None, BASE, 1, 101),
                                                                      ("right", "a", None, 1, 102)]
    feed = Feed(spark, TWO_SIDED)
    for k in range(0, len(rows), 13):
        feed.add(*rows[k:k + 13])
    feed.run(SJ.interval_join_stream(*sides(feed.stream()), -7, 5, 500))
    pairs = ("id", "l_ts", "l_vc", "r_ts", "r_vc", "text")
    batch = sides(spark.createDataFrame(rows, TWO_SIDED))
    assert multiset(SJ.join_pairs(feed.rows()), *pairs) == multiset(joins.interval_join(*batch, -7, 5), *pairs)
    assert SJ.late_rows(feed.rows()).count() == 0


def test_interval_join_state_empties_behind_the_watermark(spark):
    feed = Feed(spark, TWO_SIDED)
    for k, (side, ts) in enumerate([("left", 0), ("right", 1), ("left", 5), ("right", 6), ("left", 9), ("right", 9)]):
        feed.add((side, "a", BASE + ts, 1, k))
    stream = SJ.interval_join_stream(*sides(feed.stream()), -2, 1, 3)
    held = feed.run(stream).lastProgress["stateOperators"][0]["numRowsTotal"]
    for k, side in enumerate(["left", "right", "left", "right"]):   # another key moves the watermark far on
        feed.add((side, "z", BASE + 1000 + 100 * k, 1, 10 + k))
    feed.run(SJ.interval_join_stream(*sides(feed.stream()), -2, 1, 3))
    feed.add(("left", "z", BASE + 2000, 1, 20))
    feed.add(("right", "z", BASE + 2000, 1, 21))
    left = feed.run(SJ.interval_join_stream(*sides(feed.stream()), -2, 1, 3)).lastProgress["stateOperators"][0]["numRowsTotal"]
    # what is left are the last two rows' own buckets with their timers
    assert held > 0 and left <= held
    assert multiset(SJ.join_pairs(feed.rows()), "id", "l_ts", "r_ts") == Counter(
        {("a", BASE + 9, BASE + 9): 1, ("a", BASE + 5, BASE + 6): 1, ("a", BASE, BASE + 1): 1, ("z", BASE + 2000, BASE + 2000): 1})


# --- Top-N per window end -----------------------------------------------------------


def test_sliding_topn_stream_fires_by_timer(spark):
    r, rows, ts = random.Random(6), [], BASE
    for seq in range(150):
        ts += r.choice([0, 0, 0, 1])
        rows.append((f"s{seq % 3}", ts, r.choice([1, 1, 2, 3, 4, None]), seq))
    rows.append(("zz", BASE + 10_000, 9, 999))
    feed = Feed(spark, schema.SENSOR_SEQ)
    for k in range(0, len(rows), 30):
        feed.add(*rows[k:k + 30])

    def query():
        return SW.sliding_topn_stream(windows.with_watermark(feed.stream(), 3), 10, 5, 2)

    feed.run(query())
    feed.add(("zz", BASE + 20_000, 9, 1000))
    feed.run(query())   # goes on from the checkpoint
    batch = spark.createDataFrame(rows, schema.SENSOR_SEQ)
    cols = ("window_start", "window_end", "rank", "vc", "cnt")
    want = multiset(topn.sliding_topn(batch, 10, 5, 2), *cols)
    assert len(want) > 10 and multiset(feed.rows(), *cols) == want


def test_topn_of_counts_that_come_in_several_batches(spark):
    feed = Feed(spark, "et timestamp, window_start bigint, window_end bigint, vc int, cnt bigint")

    def count(at, end, vc, n):
        import datetime as dt
        return dt.datetime.fromtimestamp(at, dt.timezone.utc), end - 10, end, vc, n

    feed.add(count(100, 110, 1, 4), count(100, 110, 2, 9))
    feed.add(count(101, 110, 3, 7), count(101, 115, 1, 1))
    feed.add(count(102, 110, 4, 9), count(102, 110, None, 7))
    feed.add(count(111, 115, 5, 3))                                 # the watermark passes 110 here
    feed.add(count(112, 115, 6, 3))
    feed.run(SW.topn_of_counts(feed.stream().withWatermark("et", "0 seconds"), 3))
    got = sorted((r.window_end, r.rank, r.vc, r.cnt) for r in feed.rows().collect())
    assert got == [(110, 1, 2, 9), (110, 2, 4, 9), (110, 3, None, 7)]
    feed.add(count(200, 300, 1, 1))
    feed.run(SW.topn_of_counts(feed.stream().withWatermark("et", "0 seconds"), 3))
    got = sorted((r.window_end, r.rank, r.vc, r.cnt) for r in feed.rows().where("window_end = 115").collect())
    assert got == [(115, 1, 5, 3), (115, 2, 6, 3), (115, 3, 1, 1)]


# --- broadcast threshold ------------------------------------------------------------


@pytest.mark.parametrize("max_disorder", [None, 12])
def test_threshold_stream_takes_the_config_before_each_row(spark, max_disorder):
    r = random.Random(7)
    rows = [("config", None, None, None, seq, r.choice([3, 5, 8, None])) if r.random() < .25
            else ("data", r.choice(["a", "b", None]), BASE + seq, r.choice([1, 4, 6, 9, None]), seq, None) for seq in range(60)]
    columns = "kind string, id string, ts bigint, vc int, seq bigint, threshold int"
    feed = Feed(spark, columns)

    def query():
        s = feed.stream()
        return SJ.broadcast_threshold_stream(s.where("kind = 'data'"), s.where("kind = 'config'"), 5, max_disorder)

    for k in range(0, 60, 12):     # configs and data are interleaved within a batch and shuffled in it
        part = rows[k:k + 12]
        r.shuffle(part)
        feed.add(*part)
        if k == 24:
            feed.run(query())
    feed.run(query())
    batch = spark.createDataFrame(rows, columns)
    cols = ("id", "ts", "vc", "seq", "threshold", "text")
    want = multiset(joins.broadcast_threshold(batch.where("kind = 'data'"), batch.where("kind = 'config'")), *cols)
    assert len(want) > 10 and multiset(feed.rows(), *cols) == want


# --- count windows ------------------------------------------------------------------


@pytest.mark.parametrize("size,slide", [(5, None), (5, 2), (3, 4), (4, 1)])
def test_count_windows_stream_equal_batch(spark, size, slide):
    r = random.Random(size)
    rows = [(r.choice(["a", "a", "b", None]), BASE + r.randrange(50), r.choice([1, 2, 3, None]), seq) for seq in range(45)]
    feed = Feed(spark, schema.SENSOR_SEQ)

    def query():
        return SW.count_window_stream(feed.stream(), size) if slide is None else SW.count_window_sliding_stream(feed.stream(), size, slide)

    for k in range(0, 45, 9):
        part = rows[k:k + 9]
        r.shuffle(part)
        feed.add(*part)
        if k == 18:
            feed.run(query())
    feed.run(query())
    batch = spark.createDataFrame(rows, schema.SENSOR_SEQ)
    want = windows.count_window(batch, size) if slide is None else windows.count_window_sliding(batch, size, slide)
    cols = ("id", "window_no", "cnt", "vc", "ts") if slide is None else ("id", "fire_rn", "cnt", "vc")
    assert multiset(feed.rows(), *cols) == multiset(want, *cols)
