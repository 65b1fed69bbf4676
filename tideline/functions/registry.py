"""Registering functions for SQL (``createTemporarySystemFunction``)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .table import python_split_words_udtf, register_split_words_sql


def register_all(spark: SparkSession) -> list[str]:
    """Make the library's functions callable from ``spark.sql``:

    * ``java_hash(string)`` -- SQL-bodied scalar function (inlined, no Python);
    * ``weighted_avg(value, weight)`` -- the Pandas grouped-aggregate UDF, which
      takes a whole group into memory: for large groups use the expression
      :func:`~.aggregate.weighted_avg`;
    * ``split_words(s)`` -- SQL table function for ``lateral``;
    * ``split_words_py(s)`` -- the Python UDTF form.
    """
    from .aggregate import weighted_avg_udaf

    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION java_hash(s STRING) RETURNS INT
        RETURN CASE WHEN s IS NOT NULL
                    THEN CAST(java_method('java.util.Objects', 'hashCode', s) AS INT) END
    """)
    register_split_words_sql(spark, "split_words")
    spark.udtf.register("split_words_py", python_split_words_udtf())
    spark.udf.register("weighted_avg", weighted_avg_udaf())
    return ["java_hash", "split_words", "split_words_py", "weighted_avg"]
