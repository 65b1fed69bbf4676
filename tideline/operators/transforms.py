"""Projections, filters, routing and keys (one-to-one and one-to-many maps)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parity labels used as keys by the reference ("even", "odd").
EVEN_LABEL = "偶数"
ODD_LABEL = "奇数"


def project_id(df: DataFrame) -> DataFrame:
    """One-to-one map sensor -> id."""
    return df.select("id")


def java_split(c: Column, sep: str = " ") -> Column:
    """``String.split(sep)`` for a one-character literal separator: inner and
    leading empty strings are kept, trailing ones dropped; ``""`` -> ``[""]``."""
    if len(sep) != 1:
        raise ValueError("java_split handles one-character separators")
    pattern = "\\" + sep if not sep.isalnum() else sep
    # rtrim strips exactly the trailing spaces (no regex per row)
    trimmed = F.rtrim(c) if sep == " " else F.regexp_replace(c, pattern + "+$", "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, pattern)))


def text_lines(df: DataFrame, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """Whole texts -> one row per line, as a line reader yields them: split on
    ``\\n``; a final empty line after a trailing newline is not a line."""
    parts = F.split(F.col(text_col), "\n")
    n = F.size(parts)
    last_empty = F.element_at(parts, -1) == ""
    lines = F.when(last_empty & (n > 1), F.slice(parts, 1, n - 1)).otherwise(parts)
    return (df.select(*keep, F.posexplode(lines).alias("line_no", "line"))
            .withColumn("line_no", F.col("line_no").cast("bigint")))


def tokenize(lines: DataFrame, line_col: str = "line", keep=("doc_id", "line_no")) -> DataFrame:
    """flatMap: split a line on one space (Java rules) and emit ``(word, 1)``."""
    return (lines.select(*keep, F.posexplode(java_split(F.col(line_col), " ")).alias("word_no", "word"))
            .withColumn("word_no", F.col("word_no").cast("bigint"))
            .withColumn("cnt", F.lit(1)))


def filter_ts(df: DataFrame, min_ts: int = 1) -> DataFrame:
    """``select id, ts, vc from sensor where ts >= min_ts`` (pushed into the scan)."""
    return df.where(F.col("ts") >= F.lit(min_ts))


_STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _wrapped(c: Column, mode: str) -> Column:
    """The text as the only element of a JSON array: parsing that also finds
    what stands behind a complete value, and repeated keys are accepted."""
    return F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>", _STRICT_JSON | {"mode": mode})


def json_object_flag(c: Column, mode: str = "PERMISSIVE") -> Column:
    """True iff ``c`` is the text of one JSON object; keys may repeat."""
    return F.coalesce((F.size(_wrapped(c, mode)) == 1) & F.ltrim(F.translate(c, "\t\r\n", "   ")).startswith("{"),
                      F.lit(False))


def json_filter(df: DataFrame, col: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """Keep rows whose ``col`` is a JSON object.

    PERMISSIVE drops the others; FAILFAST raises on the first malformed row,
    as the reference aborts its job.
    """
    return df.where(json_object_flag(F.col(col), mode.upper()))


def split_by_prefix(df: DataFrame, col: str = "value", tags=("a", "b"), main: str = "main") -> DataFrame:
    """Route each row to exactly one branch: the first tag its value starts
    with, else ``main``. Select a branch with ``branch(df, name)``."""
    expr = F.lit(main)
    for t in reversed(tags):
        expr = F.when(F.col(col).startswith(t), F.lit(t)).otherwise(expr)
    return df.withColumn("branch", F.coalesce(expr, F.lit(main)))


def branch(tagged: DataFrame, name: str) -> DataFrame:
    """One side output of :func:`split_by_prefix` (a filter on the tag)."""
    return tagged.where(F.col("branch") == name).drop("branch")


def prefix_class(c: Column) -> Column:
    """Key by leading letter: 'a', 'b', 's', else the empty class."""
    first = F.substring(c, 1, 1)
    return F.when(first.isin("a", "b", "s"), first).otherwise(F.lit(""))


def parity_label(c: Column) -> Column:
    return F.when(c % 2 == 0, F.lit(EVEN_LABEL)).otherwise(F.lit(ODD_LABEL))


def derive_key(df: DataFrame) -> DataFrame:
    """The reference's computed keys: prefix class of id, parity of vc, vc % 3
    (``%`` truncates toward zero as in Java)."""
    return df.select("id", "ts", "vc", "seq",
                     prefix_class(F.col("id")).alias("prefix_key"),
                     parity_label(F.col("vc")).alias("parity_key"),
                     (F.col("vc") % 3).alias("mod3_key"))


def partition_by_key(df: DataFrame, key: Column, num_partitions: int) -> DataFrame:
    """Physical placement ``partition = key mod n`` (custom partitioner).

    ``repartitionById`` routes each row straight to partition ``pmod(key, n)``.
    """
    return df.repartitionById(num_partitions, key)


def partition_counts(df: DataFrame, key: Column, num_partitions: int) -> DataFrame:
    """Rows per physical partition under :func:`partition_by_key`: the data
    rows go through the custom partitioner and are counted where they land."""
    target = F.pmod(key, F.lit(num_partitions)).cast("int")
    placed = partition_by_key(df, target, num_partitions)
    return (placed.select(F.spark_partition_id().alias("partition"))
            .groupBy("partition").agg(F.count(F.lit(1)).alias("cnt")))


def key_trace(df: DataFrame, key: Column | str = "id") -> DataFrame:
    """Annotate each row with its key and the index of the task handling it."""
    k = F.col(key) if isinstance(key, str) else key
    return df.withColumn("key", k).withColumn("subtask", F.spark_partition_id())


def row_time_column(df: DataFrame, name: str = "row_time") -> DataFrame:
    """``row_time = CAST(CURRENT_TIMESTAMP AS TIMESTAMP(3))``."""
    return df.withColumn(name, F.date_trunc("millisecond", F.current_timestamp()))
