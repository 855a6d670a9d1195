"""D / F / G: aggregations, ordering, set operations.

Aggregates are written so Spark can run them partially (map-side) before the
shuffle; no aggregate here keeps an unbounded per-group buffer except
``unit_history`` (D19), whose groups are bounded by the number of periods.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import one_of
from .cleaning import quantiles

EPS = 1e-9


def total_by_period(panel: DataFrame, y: str = "members") -> DataFrame:
    """Sum per period."""
    return panel.groupBy("period").agg(F.sum(y).cast("bigint").alias("total_members"))


def unit_profile(panel: DataFrame, y: str = "members", leak: str = "leak_rate") -> DataFrame:
    """Per-unit profile in one partial aggregate.

    mean/max/min/sample std/sum of members, mean leak, range, cv =
    std/(mean+1e-9), retention = 1 - mean leak/100, mean of first differences
    = (last - first)/(n - 1) and trend % = (last - first)/(first + 1e-9)*100
    (first/last by ``min_by``/``max_by`` on the period: no window needed).
    """
    agg = panel.groupBy("unit").agg(
        F.avg(y).alias("avg_members"), F.max(y).cast("double").alias("max_members"),
        F.min(y).cast("double").alias("min_members"), F.stddev_samp(y).alias("std_members"),
        F.sum(y).cast("bigint").alias("total_members"), F.avg(leak).alias("avg_leak_rate"),
        F.max(leak).alias("max_leak_rate"), F.count(F.lit(1)).alias("n_periods"),
        F.min_by(y, "period").cast("double").alias("first_members"),
        F.max_by(y, "period").cast("double").alias("last_members"))
    return agg.select(
        "unit", "avg_members", "max_members", "min_members", "std_members", "total_members",
        "avg_leak_rate", "max_leak_rate", "n_periods",
        (F.col("max_members") - F.col("min_members")).alias("range_members"),
        (F.col("std_members") / (F.col("avg_members") + EPS)).alias("cv_members"),
        (1 - F.col("avg_leak_rate") / 100.0).alias("retention_rate"),
        F.when(F.col("n_periods") > 1, (F.col("last_members") - F.col("first_members"))
               / (F.col("n_periods") - 1)).alias("avg_variation"),
        ((F.col("last_members") - F.col("first_members")) / (F.col("first_members") + EPS) * 100.0)
        .alias("trend_pct"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts and share per value."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    tot = df.agg(F.count(F.lit(1)).alias("total"))
    from ..functions.scalar import with_scalars
    return with_scalars(c, tot).select(col, "n", (F.col("n") / F.col("_s.total")).alias("share"))


def describe(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per column (long form)."""
    one = df.agg(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).cast("double").alias("min"), quantiles(df, c, [0.25, 0.5, 0.75], exact).alias("_q"),
        F.max(c).cast("double").alias("max")) for c in cols]).alias("_s"))
    return one.select(F.inline("_s")).select("column_name", "count", "mean", "std", "min", F.col("_q")[0].alias("p25"),
                                             F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"), "max")


def target_correlation(df: DataFrame, feats: list[str], y: str) -> DataFrame:
    """Pearson correlation of every feature with the target, one pass,
    sorted by strength (F2)."""
    wide = df.agg(*[F.corr(F.col(f).cast("double"), F.col(y).cast("double")).alias(f"_c{i}")
                    for i, f in enumerate(feats)])
    stack = "stack({}, {}) as (feature, corr)".format(
        len(feats), ", ".join(f"'{f}', _c{i}" for i, f in enumerate(feats)))
    return wide.selectExpr(stack).orderBy(F.abs("corr").desc_nulls_last(), "feature")


def grouped_metrics(df: DataFrame, y: str, p: str, by: str = "unit") -> DataFrame:
    """Error metrics per group AND overall via GROUPING SETS ((by), ())."""
    from .metrics import regression_metric_aggs
    return (df.rollup(by).agg(*regression_metric_aggs(y, p), F.grouping(by).alias("_g"))
            .select(F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col(by).cast("string")).alias("scope"),
                    "n", "mae", "mse", "rmse", "mape", "r2"))


def cluster_profile(df: DataFrame, label: str, cols: list[str], digits: int = 2) -> DataFrame:
    """Mean of each column per label, rounded."""
    return df.groupBy(label).agg(*[F.round(F.avg(c), digits).alias(c) for c in cols],
                                 F.count(F.lit(1)).alias("n"))


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    """Distinct sorted keys (sorted at the sink only)."""
    return df.select(col).distinct()


def first_by(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """First value per group, deterministic via ``min_by``."""
    return df.groupBy(key).agg(F.min_by(value, order).alias(value))


def best_by(df: DataFrame, metric: str, mode: str = "max", name: str = "model",
            by: list[str] | None = None) -> DataFrame:
    """Arg-max / arg-min row by metric, ties broken by name."""
    lowest = F.col(metric).cast("double") if mode != "max" else -F.col(metric).cast("double")
    row = F.struct(*df.columns)
    best = F.min_by(row, F.struct(F.col(metric).isNull().alias("none"), lowest.alias("m"), F.col(name)))
    return (df.groupBy(*by) if by else df).agg(best.alias("_b")).select("_b.*")


def alert_message(df: DataFrame, key: str, flag: str, prefix: str = "units at risk: ") -> DataFrame:
    """Flagged keys joined into one sorted message string.

    The collected list holds flagged keys only; it is one row by design (a
    message), sized by the number of flagged keys.
    """
    keys = df.where(F.coalesce(F.col(flag), F.lit(0)) == 1).agg(
        F.sort_array(F.collect_set(F.col(key))).alias("_k"))
    return keys.select(F.size("_k").alias("n_flagged"),
                       F.concat(F.lit(prefix), F.array_join(F.transform("_k", lambda x: x.cast("string")), ", "))
                       .alias("message"))


def cv_summary(df: DataFrame, err: str) -> DataFrame:
    """Mean and population std of fold errors."""
    return df.agg(F.avg(err).alias("mean_error"), F.stddev_pop(err).alias("std_error"),
                  F.count(F.lit(1)).alias("n_folds"))


def history_mean(panel: DataFrame, y: str = "members") -> DataFrame:
    """Mean over all known periods per unit."""
    return panel.groupBy("unit").agg(F.avg(y).alias("history_mean"))


def crosstab(df: DataFrame, a: str, b: str, b_values: list) -> DataFrame:
    """Contingency table with an explicit pivot value list; a value outside it fails the query."""
    return df.withColumn(b, one_of(b, b_values)).groupBy(a).pivot(b, b_values).agg(F.count(F.lit(1))).na.fill(0)


def unit_history(panel: DataFrame) -> DataFrame:
    """Ordered (period, members, leak_rate) records per unit.

    Group size is the number of periods of one unit (bounded by the calendar,
    not by the data volume).
    """
    return panel.groupBy("unit").agg(
        F.sort_array(F.collect_list(F.struct("period", "members", "leak_rate"))).alias("history"))


def top_k(df: DataFrame, col: str, k: int, tiebreak: str) -> DataFrame:
    """top-k rows (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(F.col(col).desc(), F.col(tiebreak)).limit(k)


def compare(*results: DataFrame) -> DataFrame:
    """G1: union of per-model result rows, missing columns as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def forecast_table(long: DataFrame, models: list[str], unit: str = "unit",
                   model: str = "model", value: str = "forecast") -> DataFrame:
    """One column per model (pivot with a fixed value list; a model outside it fails the query)."""
    return long.withColumn(model, one_of(model, models)).groupBy(unit).pivot(model, models).agg(F.first(value))


def feature_combos(spark, cols: list[str], lo: int, hi: int) -> DataFrame:
    """Every subset of ``cols`` with lo..hi members, via bitmasks."""
    n = len(cols)
    names = F.array(*[F.lit(c) for c in cols])
    masks = spark.range(1, 2 ** n).select(F.col("id").alias("mask"))
    bits = F.expr(f"filter(sequence(0, {n - 1}), i -> ((mask >> i) & 1) = 1)")
    return (masks.where(F.bit_count("mask").between(lo, hi))
            .select("mask", F.transform(bits, lambda i: F.element_at(names, i + 1)).alias("features")))
