"""Aggregate and table-aggregate functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def weighted_avg(value: Column | str, weight: Column | str, op: Column | None = None) -> Column:
    """``sum(v * w) / sum(w)`` with integer (truncating) division, null when
    the weight sum is 0. A weight counts only where its value is present. With a changelog ``op`` column, retractions
    (``-U``/``-D``) subtract their weight: the reference's ``retract``."""
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    if op is not None:
        w = F.when(op.isin("-U", "-D"), -w).otherwise(w)
    w = F.when(v.isNotNull(), w)
    num = F.sum(v.cast("bigint") * w.cast("bigint"))
    den = F.sum(w.cast("bigint"))
    return F.when(den == 0, F.lit(None).cast("bigint")).otherwise(_int_div(num, den))


def _int_div(a: Column, b: Column) -> Column:
    """Java ``long / long``: truncation toward zero."""
    exact = F.abs(a) - F.pmod(F.abs(a), F.abs(b))  # a multiple of |b|: the quotient is exact
    q = (exact.cast("decimal(38,0)") / F.abs(b).cast("decimal(38,0)")).cast("bigint")
    return F.when((a < 0) != (b < 0), -q).otherwise(q)


def weighted_avg_udaf():
    """The same aggregate as a grouped-aggregate Pandas UDF (UDAF surface;
    usable in ``groupBy().agg`` and over windows)."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf(T.LongType())
    def wavg(v: pd.Series, w: pd.Series) -> int | None:
        both = v.notna() & w.notna()
        v, w = v[both], w[both]
        den = int(w.astype("int64").sum())
        if den == 0:
            return None
        num = int((v.astype("int64") * w.astype("int64")).sum())
        q = abs(num) // abs(den)
        return q if (num >= 0) == (den > 0) else -q

    return wavg


def top2_apply(df: DataFrame, group_by, value: str = "value", n: int = 2) -> DataFrame:
    """Table-aggregate surface (``flatAggregate``): per group emit up to n
    rows ``(value, rank)``. Grouped Pandas map; each group is reduced with
    ``nlargest``, so per group only the top n are materialised in the output."""
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("value", T.IntegerType()),
                           T.StructField("rank", T.IntegerType())])

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        vals = pdf[value].dropna().astype("int64")
        vals = vals[vals > -2147483648].nlargest(n, keep="all").head(n)
        out = pd.DataFrame({"value": vals.values.astype("int32"),
                            "rank": range(1, len(vals) + 1)})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "value", "rank"]]

    return df.groupBy(*keys).applyInPandas(top, schema)
