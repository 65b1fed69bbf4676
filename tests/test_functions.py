"""Functions and user-defined aggregates against Java's own values and plain folds."""

import datetime as dt
import decimal
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import accumulators as acc
from tideline.functions.scalar import java_hash

D = decimal.Decimal


def hashes(spark, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", java_hash(F.col("v"), df.schema["v"].dataType).alias("h")).orderBy("i").collect()
    return [r.h for r in rows]


@pytest.mark.parametrize("kind,values,want", [
    # values that Java's documentation of each hashCode gives
    ("string", ["s1", "", "hello", None], [3614, 0, 99162322, None]),
    ("boolean", [True, False], [1231, 1237]),
    ("bigint", [1, -1, 1 << 32, (1 << 32) + 1], [1, 0, 1, 0]),
    ("double", [0.0, 1.0, -1.5, 0.1], [0, 1072693248, -1074266112, -1507852285]),
    ("float", [0.5, -3.25, 1e30], [0x3F000000, 0xC0500000 - (1 << 32), 0x7149F2CA]),
    ("array<int>", [[], [1, 2, 3], [None], None], [1, 30817, 31, None]),
    ("array<string>", [["a", "b"]], [4066]),
    ("map<string,int>", [{}, {"a": 1, "b": 2}], [0, 192]),
    ("struct<a:int,b:string>", [(1, "a"), (None, None)], [31 * (31 + 1) + 97, 961]),
    ("binary", [b"", b"\x01\xff"], [1, 31 * (31 + 1) - 1]),
])
def test_java_hash_of_known_values(spark, kind, values, want):
    assert hashes(spark, kind, values) == want


def test_java_hash_equals_the_jvm(spark):
    j = spark._jvm.java
    r = random.Random(1)
    doubles = [r.uniform(-1e9, 1e9) for _ in range(20)] + [float("inf"), float("nan"), -0.0, 5e-324]
    assert hashes(spark, "double", doubles) == [j.lang.Double.hashCode(x) for x in doubles]
    for p, s in [(5, 0), (9, 2), (18, 18), (20, 3), (38, 0), (38, 18), (38, 37), (10, 10)]:
        values = [D(r.randrange(-10 ** p + 1, 10 ** p)).scaleb(-s, decimal.Context(60)) for _ in range(12)]
        values += [D(0).scaleb(-s, decimal.Context(60)), D(10 ** p - 1).scaleb(-s, decimal.Context(60)), D(1).scaleb(-s, decimal.Context(60))]
        want = [j.util.Objects.hashCode(v) for v in values]
        assert hashes(spark, f"decimal({p},{s})", values) == want, (p, s)
    days = [dt.date(1970, 1, 1), dt.date(2024, 2, 29), dt.date(9999, 12, 31), dt.date(1, 1, 1)]
    assert hashes(spark, "date", days) == [j.util.Objects.hashCode(j.time.LocalDate.of(d.year, d.month, d.day)) for d in days]
    times = [dt.datetime(2024, 1, 15, 23, 59, 58, 123456), dt.datetime(1969, 12, 31, 23, 59, 59, 1), dt.datetime(2000, 1, 1)]
    assert hashes(spark, "timestamp_ntz", times) == [j.time.LocalDateTime.parse(t.isoformat()).hashCode() for t in times]
    utc = [t.replace(tzinfo=dt.timezone.utc) for t in times]
    assert hashes(spark, "timestamp", utc) == [j.time.Instant.parse(t.isoformat() + "Z").hashCode() for t in times]


# --- user-defined aggregates --------------------------------------------------------


def test_weighted_avg_with_retraction_and_a_hot_group(spark):
    r = random.Random(4)
    rows = [("hot" if r.random() < .4 else r.choice(["a", "b", None]), r.choice([None, -7, 3, 90]), r.choice([None, -2, 0, 1, 5]),
             r.choice(["+I", "+U", "-U", "-D"])) for _ in range(3000)]
    rows += [("zero", 5, 2, "+I"), ("zero", 5, 2, "-D")]
    total = Counter()
    weight = Counter()
    for k, v, w, o in rows:
        total[k] += 0 if v is None or w is None else v * w * (-1 if o[0] == "-" else 1)
        weight[k] += 0 if v is None or w is None else w * (-1 if o[0] == "-" else 1)
    want = {k: None if not weight[k] else int(D(total[k]) / D(weight[k])) for k in total}
    df = spark.createDataFrame(rows, "k string, v bigint, w bigint, op string").repartition(9)
    assert dict(map(tuple, acc.aggregate(df, "k", ["v", "w"], acc.WeightedAvg(), "op").collect())) == want


def test_states_that_are_handed_on_early_are_merged(spark, monkeypatch):
    monkeypatch.setattr(acc, "GROUPS_HELD", 3)
    monkeypatch.setattr(acc, "TEAMS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(i % 11, i % 5, (i * 37) % 101) for i in range(500)]
        df = spark.createDataFrame(rows, "a int, b int, vc int").repartition(6)
        want = Counter()
        for a, b in {(a, b) for a, b, _ in rows}:
            top = sorted((v for x, y, v in rows if (x, y) == (a, b)), reverse=True)[:3]
            want.update((a, b, v, k + 1) for k, v in enumerate(top))
        assert Counter(map(tuple, acc.aggregate(df, ["a", "b"], ["vc"], acc.TopN(3)).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_table_aggregate_without_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(v,) for v in [5, None, 9, -2147483648, 9]], "vc int").repartition(3)
    assert sorted(map(tuple, acc.aggregate(df, [], ["vc"], acc.TopN(2)).collect())) == [(9, 1), (9, 2)]
    assert acc.aggregate(df.limit(0), [], ["vc"], acc.TopN(2)).collect() == []
    assert acc.aggregate(df.where("vc is null"), [], ["vc"], acc.TopN(2)).collect() == []


def test_top_n_does_not_retract(spark):
    df = spark.createDataFrame([("a", 1, "-D")], "k string, vc int, op string")
    with pytest.raises(Exception, match="can't retract"):
        acc.aggregate(df, "k", ["vc"], acc.TopN(2), "op").collect()
