"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import format_millis  # noqa: F401  (re-export: U6)

_M32 = 4294967296


def _to_int32(c: Column) -> Column:
    """Unsigned 32-bit value (as bigint) -> signed int."""
    return F.when(c >= F.lit(2147483648), c - F.lit(_M32)).otherwise(c).cast("int")


def java_string_hash(s: Column) -> Column:
    """``String.hashCode()`` by the JVM's own method, linear in the string's
    length; null gives null."""
    hashed = F.java_method(F.lit("java.util.Objects"), F.lit("hashCode"), s).cast("int")
    return F.when(s.isNotNull(), hashed)


def _wrap(c: Column) -> Column:
    """Any bigint -> the 32 bits that Java's int arithmetic keeps of it, unsigned."""
    return F.pmod(c, F.lit(_M32))


def _fold(hashes: Column, start: int) -> Column:
    """``h = 31 * h + e`` over an array of ints, as Java's lists and arrays fold; null elements are 0."""
    return _to_int32(F.aggregate(hashes, F.lit(start).cast("bigint"), lambda h, e: _wrap(h * 31 + F.coalesce(e, F.lit(0)))))


def _long_hash(x: Column) -> Column:
    return _to_int32(_wrap(x.bitwiseXOR(F.shiftrightunsigned(x, 32))))


def _decimal_hash(c: Column, t: T.DecimalType) -> Column:
    """``BigDecimal.hashCode()``: the unscaled value's 32-bit words folded by
    31 from the highest, signed, then ``31 * h + scale``."""
    whole = "decimal(38,0)"
    # the digits: arithmetic on more than 34 of them would round
    layout = "S" + "0" * max(1, t.precision - t.scale) + ("D" + "0" * t.scale if t.scale else "")
    unscaled = F.regexp_replace(F.to_char(c, F.lit(layout)), "[^0-9]", "")
    word = F.lit(_M32).cast(whole)

    def folded(u: Column) -> Column:
        h = F.lit(0).cast("bigint")
        for k in (3, 2, 1, 0):
            unit = F.lit(str(1 << 32 * k)).cast(whole)
            above = ((u - F.pmod(u, unit)) / unit).cast(whole) if k else u   # a multiple of the divisor: exact
            h = _wrap(h * 31 + F.pmod(above, word).cast("bigint"))
        return h

    # a lambda holds the unscaled value once, however often it is used
    h = F.get(F.transform(F.array(unscaled.cast(whole)), folded), F.lit(0))
    h = F.when(c < 0, -h).otherwise(h)
    return _to_int32(_wrap(h * 31 + t.scale))


def java_hash(c: Column, data_type: T.DataType) -> Column:
    """``Object.hashCode()`` of the Java value that stands for a Spark value;
    null gives null (the reference throws).

    ========================  =====================================================
    string                    ``String``
    byte, short, int          ``Integer`` (the value itself)
    long                      ``Long``: ``(int)(x ^ (x >>> 32))``
    boolean                   ``Boolean``: 1231 or 1237
    float, double             ``Float``, ``Double``: of the IEEE bits
    decimal(p, s)             ``BigDecimal`` of scale s
    date                      ``LocalDate``
    timestamp                 ``Instant``
    timestamp without zone    ``LocalDateTime``
    binary                    ``Arrays.hashCode(byte[])``
    array                     ``List``: ``31 * h + e`` from 1
    struct                    the list of its fields, ``Objects.hash(...)``
    map                       ``Map``: the sum of ``key ^ value``
    ========================  =====================================================
    """
    h = _java_hash(c, data_type)
    return F.when(c.isNotNull(), h)


def _java_hash(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return java_string_hash(c)
    if isinstance(data_type, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("int")
    if isinstance(data_type, T.LongType):
        return _long_hash(c)
    if isinstance(data_type, T.BooleanType):
        return F.when(c, F.lit(1231)).otherwise(F.lit(1237)).cast("int")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        owner = "java.lang.Float" if isinstance(data_type, T.FloatType) else "java.lang.Double"
        return F.java_method(F.lit(owner), F.lit("hashCode"), c).cast("int")
    if isinstance(data_type, T.DecimalType):
        return _decimal_hash(c, data_type)
    if isinstance(data_type, T.DateType):
        y = F.year(c)
        return y.bitwiseAND(F.lit(-2048)).bitwiseXOR(F.shiftleft(y, 11) + F.shiftleft(F.month(c), 6) + F.dayofmonth(c))
    if isinstance(data_type, T.TimestampNTZType):
        day = F.date_trunc("DAY", c)
        nano = (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1_000_000_000 + (
            F.extract(F.lit("SECOND"), c).cast("decimal(8,6)") * 1_000_000).cast("bigint") * 1000
        return _java_hash(day.cast("date"), T.DateType()).bitwiseXOR(_long_hash(nano))
    if isinstance(data_type, T.TimestampType):
        micros = F.unix_micros(c)
        seconds = F.floor(micros / F.lit(1_000_000).cast("decimal(10,0)")).cast("bigint")
        nanos = (micros - seconds * 1_000_000) * 1000
        return _to_int32(_wrap(_long_hash(seconds).cast("bigint") + 51 * nanos))
    if isinstance(data_type, T.BinaryType):
        pairs = F.regexp_extract_all(F.hex(c), F.lit("(..)"), 1)
        unsigned = F.transform(pairs, lambda p: F.conv(p, 16, 10).cast("bigint"))
        return _fold(F.transform(unsigned, lambda u: F.when(u >= 128, u - 256).otherwise(u)), 1)
    if isinstance(data_type, T.ArrayType):
        return _fold(F.transform(c, lambda e: java_hash(e, data_type.elementType).cast("bigint")), 1)
    if isinstance(data_type, T.StructType):
        return _fold(F.array(*[java_hash(c[f.name], f.dataType).cast("bigint") for f in data_type.fields]), 1)
    if isinstance(data_type, T.MapType):
        def entry(k: Column, v: Column) -> Column:
            return F.coalesce(java_hash(k, data_type.keyType), F.lit(0)).bitwiseXOR(
                F.coalesce(java_hash(v, data_type.valueType), F.lit(0))).cast("bigint")
        both = F.transform(F.map_entries(c), lambda e: entry(e["key"], e["value"]))
        return _to_int32(F.aggregate(both, F.lit(0).cast("bigint"), lambda a, e: _wrap(a + e)))
    raise TypeError(f"java_hash: unsupported type {data_type}")
