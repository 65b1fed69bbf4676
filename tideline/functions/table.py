"""Table functions: one input row -> many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.transforms import java_split

SPLIT_WORDS_SCHEMA = "word string, length int"


def split_words(df: DataFrame, col: str = "words", keep=None) -> DataFrame:
    """``lateral table(SplitFunction(words))``: one row ``(word, length)`` per
    piece of ``col`` split on one space (Java rules). Native ``explode``."""
    keep = list(keep) if keep is not None else list(df.columns)
    pieces = java_split(F.col(col), " ")
    return (df.select(*keep, F.posexplode(pieces).alias("word_no", "word"))
            .withColumn("word_no", F.col("word_no").cast("bigint"))
            .withColumn("length", F.length("word").cast("int")))


def register_split_words_sql(spark: SparkSession, name: str = "split_words") -> None:
    """Register ``name(s)`` as a SQL table function so that
    ``select ... from t, lateral name(t.words)`` works in ``spark.sql``.
    It is a SQL-bodied function: Catalyst inlines it, no Python runs."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING)
        RETURNS TABLE (word STRING, length INT)
        RETURN SELECT w AS word, CAST(length(w) AS INT) AS length
               FROM (SELECT explode(
                   CASE WHEN s = '' THEN array('')
                        WHEN rtrim(s) = '' THEN CAST(array() AS ARRAY<STRING>)
                        ELSE split(rtrim(s), ' ') END) AS w)
    """)


def python_split_words_udtf():
    """The same function as a Python UDTF, for API parity with code that
    registers table functions from classes. Row-at-a-time Python: prefer
    :func:`split_words` or the SQL function on large inputs."""
    from pyspark.sql.functions import udtf

    @udtf(returnType=SPLIT_WORDS_SCHEMA)
    class SplitWords:
        def eval(self, s: str):
            if s is None:
                return
            parts = s.split(" ")
            while len(parts) > 1 and parts[-1] == "":
                parts.pop()
            if parts == [""] and s != "":
                parts = []
            for p in parts:
                yield p, len(p.encode("utf-16-le")) // 2

    return SplitWords
