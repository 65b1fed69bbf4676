"""Synthetic source like the reference's ``datagen`` table.

Batch: ``spark.range`` + seeded hashes, deterministic and fully parallel.
Stream: the ``rate`` source with the same projection and the same end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's datagen field settings.
FIELDS = {
    "id": {"kind": "random", "min": 1, "max": 10},
    "ts": {"kind": "sequence", "start": 1, "end": 1000000},
    "vc": {"kind": "random", "min": 1, "max": 100},
}
ROWS_PER_SECOND = 1
_KEYS = {"random": {"kind", "min", "max"}, "sequence": {"kind", "start", "end"}}


def field_options(options: dict) -> dict[str, dict]:
    """``fields.<name>.<key>`` options over the default :data:`FIELDS`. A field
    without any option keeps its default; unknown fields and keys raise."""
    given: dict[str, dict] = {}
    for name, value in options.items():
        head, _, rest = name.partition(".")
        field, _, key = rest.partition(".")
        if head != "fields" or field not in FIELDS or key not in {"kind", "min", "max", "start", "end"}:
            raise ValueError(f"unknown datagen option {name!r}")
        given.setdefault(field, {})[key] = value if key == "kind" else int(value)
    return {name: _complete(name, given.get(name, {})) for name in FIELDS}


def _complete(name: str, given: dict) -> dict:
    kind = given.get("kind", FIELDS[name]["kind"])
    if kind not in _KEYS or set(given) - _KEYS[kind]:
        raise ValueError(f"datagen field {name!r}: options {sorted(given)} don't make a field of kind {kind!r}")
    spec = {"kind": kind} | (FIELDS[name] if FIELDS[name]["kind"] == kind else {}) | given
    low, high = ("min", "max") if kind == "random" else ("start", "end")
    if low not in spec or high not in spec or spec[low] > spec[high]:
        raise ValueError(f"datagen field {name!r} needs {low} <= {high}")
    return spec


def _length(fields: dict[str, dict]) -> int | None:
    """Rows until the first sequence ends; None without a sequence."""
    return min((f["end"] - f["start"] + 1 for f in fields.values() if f["kind"] == "sequence"), default=None)


def _column(n: Column, seed: int, spec: dict) -> Column:
    if spec["kind"] == "sequence":
        return n + F.lit(spec["start"])
    return F.pmod(F.xxhash64(n, F.lit(seed)), F.lit(spec["max"] - spec["min"] + 1)) + F.lit(spec["min"])


def _project(n: Column, seed: int, fields: dict[str, dict]) -> list[Column]:
    types = {"id": "int", "ts": "bigint", "vc": "int"}
    return [_column(n, seed + (name == "vc"), fields[name]).cast(t).alias(name) for name, t in types.items()]


def datagen(spark: SparkSession, num_rows: int | None = None, seed: int = 0, num_partitions: int | None = None,
            fields: dict | None = None) -> DataFrame:
    """By default ``id`` random 1..10, ``ts`` a sequence from 1 without gaps,
    ``vc`` random 1..100; ``fields`` takes ``fields.<name>.<key>`` options.

    ``num_rows`` defaults to the length of the sequence. More rows than the
    sequence has raise, as does no number at all without a sequence.
    """
    spec = field_options(fields or {})
    length = _length(spec)
    n = length if num_rows is None else num_rows
    if n is None or length is not None and n > length:
        raise ValueError(f"datagen can't give {num_rows} rows: its sequence has {length}")
    base = spark.range(0, n, numPartitions=num_partitions) if num_partitions else spark.range(0, n)
    return base.select(*_project(F.col("id"), seed, spec))


def datagen_stream(spark: SparkSession, rows_per_second: int = ROWS_PER_SECOND, seed: int = 0,
                   fields: dict | None = None) -> DataFrame:
    """The same fields from the ``rate`` source (``value`` counts from 0); like
    the batch form it ends where its sequence ends."""
    spec = field_options(fields or {})
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    if (length := _length(spec)) is not None:
        rate = rate.where(F.col("value") < length)
    return rate.select(*_project(F.col("value"), seed, spec), F.col("timestamp").alias("row_time"))
