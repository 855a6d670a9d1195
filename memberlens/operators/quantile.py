"""Exact quantiles of any size without gathering or sorting the column."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of a histogram, and rows that may be looked at one by one.
BUCKETS, FEW = 1024, 4096


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """The ``q`` quantile (linear interpolation) of the non-null, finite values;
    None when there are none.

    A histogram between the smallest and the largest value tells in which bucket
    a rank lies; that bucket is split again until it holds ``FEW`` rows or one
    value.  Every pass is one aggregate, so the result is exact and the plan the
    same at every size.
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & (F.abs("v") < float("inf")))
    n, lo, hi = v.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    pos = q * (n - 1)
    below = math.floor(pos)
    a = _ranked(v, below, n, lo, hi)
    if pos == below:
        return a
    return a + (pos - below) * (_ranked(v, below + 1, n, lo, hi) - a)


def _ranked(v: DataFrame, rank: int, n: int, lo: float, hi: float) -> float:
    """The value with ``rank`` (from 0) among the ``n`` values of [lo, hi]."""
    while lo < hi:
        inside = v.where((F.col("v") >= lo) & (F.col("v") <= hi))
        if n <= FEW:
            return sorted(r["v"] for r in inside.collect())[rank]
        width = hi / BUCKETS - lo / BUCKETS
        b = F.least(F.floor((F.col("v") - lo) / width), F.lit(BUCKETS - 1)) if width > 0 else F.when(F.col("v") > lo, 1).otherwise(0)
        for r in inside.groupBy(b.alias("b")).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect():
            if rank < r["n"]:
                n, lo, hi = r["n"], r["lo"], r["hi"]
                break
            rank -= r["n"]
    return lo
