"""Golden tests on the reference's literal inputs and small hand-made
scenarios; expected values derived by hand from the reference jobs."""

import pytest
from pyspark.sql import functions as F

from conftest import sensor_df
from tideline.functions.aggregate import top2_apply, weighted_avg
from tideline.functions.scalar import java_hash, java_string_hash
from tideline.functions.table import register_split_words_sql, split_words
from tideline.operators import changelog, joins, keyed, lateness, over, topn, transforms, windows
from tideline.operators.transforms import java_split, text_lines, tokenize
from tideline.schema import LINES
from pyspark.sql import types as T

FOUR = [("s1", 1, 1), ("s2", 2, 2), ("s3", 3, 3), ("s3", 4, 4)]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], LINES)


def test_project_id(spark):
    df = sensor_df(spark, FOUR[:3])
    assert [r.id for r in transforms.project_id(df).collect()] == ["s1", "s2", "s3"]


def test_filter_and_group_sum(spark):
    df = sensor_df(spark, FOUR)
    assert transforms.filter_ts(df, 1).count() == 4
    got = {r.id: r.sumVc for r in df.groupBy("id").agg(F.sum("vc").alias("sumVc")).collect()}
    assert got == {"s1": 1, "s2": 2, "s3": 7}


def test_changelog(spark):
    got = changelog.group_sum_changelog(sensor_df(spark, FOUR)).orderBy("seq", "op_no").collect()
    assert [(r.op, r.id, r.sumVc) for r in got] == [
        ("+I", "s1", 1), ("+I", "s2", 2), ("+I", "s3", 3), ("-U", "s3", 3), ("+U", "s3", 7)]
    folded = {r.id: r.sumVc for r in changelog.apply_changelog(changelog.group_sum_changelog(
        sensor_df(spark, FOUR))).collect()}
    assert folded == {"s1": 1, "s2": 2, "s3": 7}


def test_java_hash(spark):
    df = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("",), ("Ωé",), (None,)], "s string")
    got = [r.h for r in df.select(java_string_hash(F.col("s")).alias("h")).collect()]
    assert got == [3614, 3615, 3616, 0, hash_java("Ωé"), None]
    longs = spark.createDataFrame([(1 << 40,), (-1,)], "x bigint")
    assert [r.h for r in longs.select(java_hash(F.col("x"), T.LongType()).alias("h")).collect()] == [256, 0]


def hash_java(s):
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i:i + 2], "big")) % (1 << 32)
    return h - (1 << 32) if h >= 1 << 31 else h


def test_split_words_table_function(spark):
    df = spark.createDataFrame([("hello hadoop",), ("hello flink",), ("hello spark",)], "words string")
    got = sorted((r.words, r.word, r.length) for r in split_words(df, "words", keep=["words"]).collect())
    assert len(got) == 6 and ("hello hadoop", "hadoop", 6) in got and ("hello spark", "hello", 5) in got
    register_split_words_sql(spark, "split_words")
    df.createOrReplaceTempView("str")
    sql = spark.sql("select words, word, length from str, lateral split_words(words)").collect()
    assert sorted((r.words, r.word, r.length) for r in sql) == got


def test_weighted_avg(spark):
    df = spark.createDataFrame([(80, 4), (90, 4), (100, 2)], "v int, w int")
    assert df.agg(weighted_avg("v", "w").alias("a")).first().a == 88
    zero = spark.createDataFrame([(80, 0)], "v int, w int")
    assert zero.agg(weighted_avg("v", "w").alias("a")).first().a is None
    # retraction: the (100, 2) row withdrawn again
    ch = spark.createDataFrame([(80, 4, "+I"), (90, 4, "+I"), (100, 2, "+I"), (100, 2, "-U")], "v int, w int, op string")
    assert ch.agg(weighted_avg("v", "w", F.col("op")).alias("a")).first().a == 85


def test_top2(spark):
    vals = [123, 454, 23435, 654, 67, 78, 45, 679, 74, 5, 3, 453]
    df = spark.createDataFrame([(v,) for v in vals], "score int")
    got = [(r.value, r.rank) for r in topn.top2_overall(df, "score").orderBy("rank").collect()]
    assert got == [(23435, 1), (679, 2)]
    dup = spark.createDataFrame([(5,), (5,)], "score int")
    assert [r.value for r in topn.top2_overall(dup, "score").collect()] == [5, 5]
    one = spark.createDataFrame([(7,), (-2147483648,)], "score int")
    assert [(r.value, r.rank) for r in topn.top2_overall(one, "score").collect()] == [(7, 1)]
    g = top2_apply(df.withColumn("g", F.lit("x")), "g", "score").orderBy("rank").collect()
    assert [(r.value, r.rank) for r in g] == [(23435, 1), (679, 2)]


def test_window_join(spark):
    left = sensor_df(spark, [("s1", 1, 0), ("s1", 2, 0), ("s2", 11, 0), ("s3", 22, 0)])
    right = sensor_df(spark, [("s1", 9, 9), ("s1", 11, 11), ("s2", 12, 12), ("s3", 32, 32)])
    got = sorted((r.id, r.l_ts, r.r_ts) for r in joins.window_join(left, right, 10).collect())
    assert got == [("s1", 1, 9), ("s1", 2, 9), ("s2", 11, 12)]


def test_json_filter(spark):
    df = lines(spark, ["aa", '{"common":"ba"}', "cc", "[1]", "", None])
    assert [r.value for r in transforms.json_filter(df).collect()] == ['{"common":"ba"}']
    with pytest.raises(Exception):
        transforms.json_filter(df, mode="FAILFAST").collect()


WORD_TXT = ["hello scala", "hello java", "hello git  1", "hello hot-fix 2", "hello remote", "hello remote1"]


def test_word_count_final(spark):
    toks = tokenize(lines(spark, WORD_TXT).select(F.lit(1).alias("doc_id"), F.lit(0).alias("line_no"),
                                                  F.col("value").alias("line")))
    got = {r.word: r["count"] for r in toks.groupBy("word").count().collect()}
    assert got == {"hello": 6, "scala": 1, "java": 1, "git": 1, "": 1, "1": 1, "hot-fix": 1, "2": 1,
                   "remote": 1, "remote1": 1}


@pytest.mark.parametrize("s,expected", [
    ("a b", ["a", "b"]), ("a  b", ["a", "", "b"]), (" a", ["", "a"]), ("a  ", ["a"]),
    ("", [""]), (" ", []), ("   ", []),
])
def test_java_split(spark, s, expected):
    df = spark.createDataFrame([(s,)], "v string")
    assert df.select(java_split(F.col("v")).alias("a")).first().a == expected


def test_text_lines(spark):
    df = spark.createDataFrame([(1, "a\nb\n"), (2, "x"), (3, "\n\ny")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.line_no, r.line) for r in text_lines(df).collect())
    assert got == [(1, 0, "a"), (1, 1, "b"), (2, 0, "x"), (3, 0, ""), (3, 1, ""), (3, 2, "y")]


def test_split_by_prefix(spark):
    t = transforms.split_by_prefix(lines(spark, ["apple", "banana", "cherry", None]))
    assert sorted((r.value, r.branch) for r in t.collect() if r.value) == [
        ("apple", "a"), ("banana", "b"), ("cherry", "main")]
    assert transforms.branch(t, "a").count() == 1 and transforms.branch(t, "main").count() == 2


def test_derive_key_and_partition(spark):
    df = sensor_df(spark, [("a1", 1, -7), ("b2", 2, 4), ("x", 3, 3)])
    got = [(r.prefix_key, r.parity_key, r.mod3_key) for r in transforms.derive_key(df).orderBy("seq").collect()]
    assert got == [("a", "奇数", -1), ("b", "偶数", 1), ("", "奇数", 0)]
    parts = {r.partition: r.cnt for r in transforms.partition_counts(df, F.col("vc"), 3).collect()}
    assert parts == {2: 1, 1: 1, 0: 1}  # pmod(-7,3)=2, 4%3=1, 3%3=0


# --- §3 scenarios ---------------------------------------------------------------

def test_four_ts_rules(spark):
    df = sensor_df(spark, [("s1", 1, 1), ("s1", 4, 4), ("s1", 2, 2)])
    for fn, ts in [(windows.tumbling_sum, 1), (windows.tumbling_reduce, 2), (windows.tumbling_aggregate, 2),
                   (windows.tumbling_process, 4)]:
        r = fn(df, 5).collect()
        assert [(x.window_start, x.window_end, x.ts, x.vc) for x in r] == [(0, 5, ts, 7)], fn.__name__
    txt = windows.tumbling_agg_format(df, 5).first().text
    assert txt == "s1:[WaterSensor(id=s1, ts=2, vc=7)],"


def test_parity_window(spark):
    df = sensor_df(spark, [("x", 1, 1), ("x", 2, 2), ("x", 3, 3), ("x", 4, 4)])
    got = {r.parity: (r.total, r.text) for r in windows.parity_window_reduce(df, 5).collect()}
    assert got == {"奇数": (4, "key：奇数[4]"), "偶数": (6, "key：偶数[6]")}


def test_window_contents_text(spark):
    df = sensor_df(spark, [("s1", 1, 1), ("s1", 3, 3)])
    r = windows.window_contents(df, 10).first()
    assert r.text == "key=s1的窗口[1970-01-01 00:00:00.000,1970-01-01 00:00:10.000)包含2条数据"


def test_interval_join(spark):
    left = sensor_df(spark, [("s1", 5, 0)])
    right = sensor_df(spark, [("s1", 2, 0), ("s1", 3, 0), ("s1", 6, 0), ("s1", 7, 0)])
    for fn in (joins.interval_join, joins.interval_join_plain):
        assert sorted((r.l_ts, r.r_ts) for r in fn(left, right, -2, 1).collect()) == [(5, 3), (5, 6)]
    # a small bucket width still gives every pair once
    assert sorted((r.l_ts, r.r_ts) for r in joins.interval_join(left, right, -2, 1, bucket_s=1).collect()) == [
        (5, 3), (5, 6)]


def test_broadcast_threshold(spark):
    # arrival: data 5; config 10; data 9; data 10; config 3; data 4
    data = spark.createDataFrame([("s", 1, 5, 1), ("s", 3, 9, 3), ("s", 4, 10, 4), ("s", 6, 4, 6)],
                                 "id string, ts bigint, vc int, seq bigint")
    config = spark.createDataFrame([(10, 2), (3, 5)], "threshold int, seq bigint")
    got = [(r.vc, r.threshold) for r in joins.broadcast_threshold(data, config, chunk_width=2).orderBy("seq").collect()]
    assert got == [(5, 0), (10, 10), (4, 3)]


def test_over_range_count(spark):
    df = sensor_df(spark, [("s1", 0, 1), ("s1", 10, 1), ("s1", 11, 1)])
    for fn in (over.over_range_count, over.over_range_count_window):
        assert [r.cnt for r in fn(df, 10).orderBy("ts").collect()] == [1, 2, 2]
    assert [r.cnt for r in over.over_range_count(df, 10, bucket_s=25).orderBy("ts").collect()] == [1, 2, 2]
    assert [r.cnt for r in over.over_range_count(df, 10, strategy="scan").orderBy("ts").collect()] == [1, 2, 2]
    # peers (same ts) are all in each other's frame; null values are not counted
    peers = sensor_df(spark, [("s1", 5, 1), ("s1", 5, None), ("s1", 5, 2), ("s1", 16, 1)])
    for strategy in ("bucket", "scan"):
        got = [r.cnt for r in over.over_range_count(peers, 10, strategy=strategy).orderBy("seq").collect()]
        assert got == [2, 2, 2, 1], strategy


def test_sliding_topn(spark):
    df = sensor_df(spark, [("x", 1, 1), ("x", 2, 1), ("x", 3, 2), ("x", 6, 3)])
    got = sorted((r.window_end, r.rank, r.vc, r.cnt) for r in topn.sliding_topn(df, 10, 5, 2).collect())
    assert got == [(5, 1, 1, 2), (5, 2, 2, 1), (10, 1, 1, 2), (10, 2, 2, 1), (15, 1, 3, 1)]
    block = {r.window_end: r.text for r in topn.sliding_topn_all(df, 10, 5, 2).collect()}[15]
    assert block.startswith("================================\nTop1\nvc=3\ncount=1\n窗口结束时间=1970-01-01 00:00:15.000")


LATE_ROWS = [("s1", t, 1) for t in (1, 5, 13, 6, 15, 3, 25)]


def test_late_data_split(spark):
    df = sensor_df(spark, LATE_ROWS)
    got = {r.ts: r.status for r in lateness.late_data_split(df, 10, 3, 2, chunk_width=2).collect()}
    assert got == {1: "on_time", 5: "on_time", 13: "on_time", 6: "allowed", 15: "on_time", 3: "late",
                   25: "on_time"}


def test_allowed_lateness_firings(spark):
    df = sensor_df(spark, LATE_ROWS)
    got = sorted((r.window_start, r.firing, r.cnt) for r in lateness.allowed_lateness(df, 10, 3, 2).collect())
    assert got == [(0, 0, 2), (0, 1, 3), (10, 0, 2), (20, 0, 1)]


def test_watermark_windows(spark):
    df = sensor_df(spark, LATE_ROWS)
    got = sorted((r.window_start, r.cnt) for r in lateness.watermark_bounded(df, 10, 3).collect())
    assert got == [(0, 2), (10, 2), (20, 1)]  # 6 and 3 arrive after [0,10) closed
    mono = sorted((r.window_start, r.cnt) for r in lateness.watermark_monotonic(df, 10).collect())
    assert mono == [(0, 2), (10, 2), (20, 1)]


def test_interval_join_late(spark):
    left = spark.createDataFrame([("s", 10, 0, 1), ("s", 2, 0, 4)], "id string, ts bigint, vc int, seq bigint")
    right = spark.createDataFrame([("s", 20, 0, 2), ("s", 1, 0, 3)], "id string, ts bigint, vc int, seq bigint")
    got = sorted((r.side, r.ts) for r in lateness.interval_join_late(left, right, 3).collect())
    # wm after seq 2 = min(10, 20) - 3 = 7: right ts 1 and left ts 2 are late
    assert got == [("left", 2), ("right", 1)]


def test_session_window(spark):
    df = sensor_df(spark, [("s1", 0, 1), ("s1", 5, 1), ("s1", 11, 1)])
    got = sorted((r.window_start, r.window_end, r.cnt) for r in windows.session_window(df, 5, chunk_rows=1).collect())
    assert got == [(0, 10, 2), (11, 16, 1)]


def test_count_windows(spark):
    df = sensor_df(spark, [("s1", i, i) for i in range(1, 8)])
    assert [r.vc for r in windows.count_window(df, 5).collect()] == [15]
    got = sorted((r.fire_rn, r.vc) for r in windows.count_window_sliding(df, 5, 2, chunk_width=3).collect())
    assert got == [(2, 3), (4, 10), (6, 20)]


def test_level_jump_alert(spark):
    df = sensor_df(spark, [("s1", i, v) for i, v in enumerate([5, 12, 25, 1, 12])])
    got = [(r.last_vc, r.vc) for r in keyed.level_jump_alert(df, chunk_width=2).orderBy("seq").collect()]
    assert got == [(12, 25), (25, 1), (1, 12)]


def test_running_top3(spark):
    df = sensor_df(spark, [("s1", i, v) for i, v in enumerate([3, 1, 5, 4, 5])])
    for cw in (1 << 20, 2):
        got = [r.top3 for r in topn.running_top3(df, chunk_width=cw).orderBy("seq").collect()]
        assert got == [[3], [3, 1], [5, 3, 1], [5, 4, 3], [5, 5, 4]]


def test_running_histogram(spark):
    df = sensor_df(spark, [("s1", i, v) for i, v in enumerate([1, 2, 1])])
    got = [(r.vc, r.cnt) for r in keyed.running_histogram(df).orderBy("seq").collect()]
    assert got == [(1, 1), (2, 1), (1, 2)]
    assert sorted((r.vc, r.cnt) for r in keyed.histogram_final(df).collect()) == [(1, 2), (2, 1)]


def test_running_sum_avg(spark):
    df = sensor_df(spark, [("s1", i, v) for i, v in enumerate([1, 2, 6])])
    assert [r.vc_sum for r in keyed.running_sum(df).orderBy("seq").collect()] == [1, 3, 9]
    assert [r.vc_avg for r in keyed.running_avg(df).orderBy("seq").collect()] == [1.0, 1.5, 3.0]


def test_level_jump_ttl(spark):
    df = sensor_df(spark, [("s1", 0, 20), ("s1", 5, 25), ("s1", 15, 27)])
    got = [(r.last_vc, r.vc) for r in keyed.level_jump_alert_ttl(df, 10).orderBy("seq").collect()]
    assert got == [(0, 20), (0, 27)]


def test_running_row_count(spark):
    df = sensor_df(spark, [("b", 1, 1), ("a", 1, 1), ("b", 1, 1), (None, 1, 1), ("a", 1, 1), (None, 1, 1)])
    got = [(r.id, r.cnt) for r in keyed.running_row_count(df).orderBy("seq").collect()]
    assert got == [("b", 1), ("a", 1), ("b", 2), (None, 1), ("a", 2), (None, 2)]


def test_watermark_of_several_sources(spark):
    # the source is the id; while one is silent nothing is late
    rows = [("a", 20, 2), ("a", 1, 4), ("b", 30, 3), ("a", 2, 6), (None, 3, 1), (None, 18, 1)]
    df = sensor_df(spark, rows).withColumnRenamed("id", "source").withColumn("id", F.lit("k"))
    got = sorted((r.id, r.window_start, r.cnt) for r in lateness.watermark_partitioned(df, "source", ("a", "b"), 10, 3).collect())
    # after seq 3 both have been seen: wm = min(20, 30) - 3 = 17 -> ts 2 and 3 (window end 10) are late
    assert got == [("k", 0, 1), ("k", 10, 1), ("k", 20, 1), ("k", 30, 1)]


def test_register_functions_for_sql(spark):
    from tideline.functions.registry import register_all

    names = register_all(spark)
    assert {"java_hash", "split_words", "weighted_avg"} <= set(names)
    r = spark.sql("select java_hash('s1') a, java_hash('') b").first()
    assert (r.a, r.b) == (3614, 0)
    spark.createDataFrame([(80, 4), (90, 4), (100, 2)], "v int, w int").createOrReplaceTempView("wt")
    assert spark.sql("select weighted_avg(v, w) a from wt").first().a == 88
    assert spark.sql("select count(*) n from split_words_py('hello  spark')").first().n == 3


def test_rename_on_import(spark):
    df = spark.createDataFrame([("hello hadoop",)], "value string").toDF("words")
    assert df.columns == ["words"]


def test_processing_time_windows(spark):
    df = transforms.row_time_column(sensor_df(spark, [("x", 1, 1), ("x", 2, 2), ("x", 3, 3), ("x", 4, 4)]))
    got = {r.parity: r.total for r in windows.parity_window_reduce(df, 3600, time_col="row_time").collect()}
    assert got == {"奇数": 4, "偶数": 6}  # current_timestamp() is one value per query: one window
    assert windows.tumbling_window(df, 3600, time_col="row_time").first().cnt == 4
