"""L4 from scraped counters: increase and rate with resets and extrapolation.

A counter sample is (labels, time, value); the value only grows until its
process restarts, when it begins at zero again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import epoch_us
from .monitoring import prev_in_series


def counter_samples(req: DataFrame, step: str = "10 minutes", by: tuple[str, ...] = ("endpoint",), ts: str = "ts", restart: str = "day") -> DataFrame:
    """Samples (by, t, value) of the request counters: at the end of each ``step``
    with requests, the requests since the process started, once a ``restart`` unit.

    One partial aggregate, then a running sum inside (by, restart unit), which is
    bounded by the steps of that unit whatever the traffic.
    """
    counts = req.groupBy(*by, F.window(ts, step).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    life = Window.partitionBy(*by, F.date_trunc(restart, "w.start")).orderBy("w.start")
    return counts.select(*by, F.col("w.end").alias("t"), F.sum("n").over(life).alias("value"))


def counter_increases(samples: DataFrame, by: list[str], t: str = "t", value: str = "value", slice_: str = "day") -> DataFrame:
    """Add ``growth``: how far the counter went since the sample before (null for a series' first).

    A value below the one before means a restart in between, so all of it is
    growth.  The sample before is found inside time slices and across their
    borders, so a long series is dealt to many tasks.
    """
    s = samples.withColumn("_slice", F.date_trunc(slice_, F.col(t)))
    s = prev_in_series(s, by, t, [value], "_slice")
    p, v = F.col(f"prev_{value}"), F.col(value)
    return s.select(*samples.columns, F.when(p.isNotNull(), F.when(v >= p, v - p).otherwise(v)).alias("growth"))


def counter_rate(samples: DataFrame, by: list[str], length: str = "2 hours", slide: str = "1 hour", seconds: float = 7200.0,
                 t: str = "t", value: str = "value") -> DataFrame:
    """(window_start, window_end, by, samples, resets, increase, rate) over sliding ranges.

    Between a range's first and last sample the counter's growth is known; it is
    carried on to the range's ends at the same pace.  An end farther than 1.1
    mean sample distances off is not reached: the series began or ended there, and
    half a distance is added.  Towards the start it is never carried below zero.
    Ranges with fewer than two samples have no result.

    All that a range needs comes from one partial aggregate (counts, ends and
    sums), so no range's samples are gathered.
    """
    s = counter_increases(samples, by, t, value)
    reset = F.col("growth").isNotNull() & (F.col("growth") == F.col(value)) & (F.col("growth") > 0)
    g = s.groupBy(F.window(t, length, slide).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("samples"), F.min(t).alias("t0"), F.max(t).alias("t1"),
        F.min_by(value, t).alias("v0"), F.min_by(F.coalesce("growth", F.lit(0)), t).alias("g0"), F.sum(F.coalesce("growth", F.lit(0))).alias("g"),
        F.min_by(F.when(reset, 1).otherwise(0), t).alias("r0"), F.sum(F.when(reset, 1).otherwise(0)).alias("r"))
    g = g.where("samples > 1")

    def gap(a, b):
        return (epoch_us(b) - epoch_us(a)) / 1e6
    known = (F.col("g") - F.col("g0")).cast("double")
    g = g.select("*", known.alias("known"), gap(F.col("t0"), F.col("t1")).alias("span"),
                 gap(F.col("w.start"), F.col("t0")).alias("before"), gap(F.col("t1"), F.col("w.end")).alias("after"))
    g = g.withColumn("mean", F.col("span") / (F.col("samples") - 1))
    to_zero = F.when(F.col("known") > 0, F.col("span") * F.col("v0") / F.col("known"))
    before = F.least(F.col("before"), to_zero)              # least() passes over null

    def reach(c):
        return F.when(c < 1.1 * F.col("mean"), c).otherwise(F.col("mean") / 2)
    increase = F.col("known") * (F.col("span") + reach(before) + reach(F.col("after"))) / F.col("span")
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "samples",
                    (F.col("r") - F.col("r0")).cast("bigint").alias("resets"), increase.alias("increase"), (increase / seconds).alias("rate"))
