"""Line sources and the sensor line parser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LINES, SENSOR

_INT = r"^[+-]?[0-9]+$"


def _field(c, i: int):
    return F.try_element_at(F.split(c, ","), F.lit(i))


def parse_sensor_lines(lines: DataFrame, col: str = "value", keep=("seq",), mode: str = "FAILFAST") -> DataFrame:
    """CSV ``id,ts,vc[,...]`` -> ``(id, ts, vc)``; extra fields are ignored.

    FAILFAST raises on a short line or a malformed number (ANSI ``cast`` and
    ``element_at`` raise), as the reference's parser throws. PERMISSIVE
    returns only the good rows; :func:`reject_sensor_lines` returns the rest.
    """
    keep = [k for k in keep if k in lines.columns]
    v = F.col(col)
    if mode.upper() == "FAILFAST":
        parts = F.split(v, ",")
        return lines.select(F.element_at(parts, 1).alias("id"),
                            F.element_at(parts, 2).cast("bigint").alias("ts"),
                            F.element_at(parts, 3).cast("int").alias("vc"), *keep)
    ok = _parse_ok(v)
    return (lines.where(ok)
            .select(_field(v, 1).alias("id"), _field(v, 2).cast("bigint").alias("ts"),
                    _field(v, 3).cast("int").alias("vc"), *keep))


def _parse_ok(v):
    ts, vc = _field(v, 2), _field(v, 3)
    return F.coalesce(
        _field(v, 1).isNotNull() & ts.rlike(_INT) & vc.rlike(_INT)
        & ts.try_cast("bigint").isNotNull() & vc.try_cast("int").isNotNull(),
        F.lit(False))


def reject_sensor_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines the PERMISSIVE parser drops (the reject branch)."""
    return lines.where(~_parse_ok(F.col(col)))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s), one row per line, column ``value`` (no event time)."""
    return spark.read.text(path)


def line_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded line stream: every new file in ``directory`` is read as lines.

    Stands in for the reference's socket text streams; files can be replayed
    and are tracked in the query checkpoint.
    """
    r = spark.readStream.schema(LINES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(directory)


def rows(spark: SparkSession, data, schema=SENSOR) -> DataFrame:
    """Literal rows as a table (``fromElements``)."""
    return spark.createDataFrame(list(data), schema)
