"""B: projection, filters, cleaning and derived columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col_, safe_ratio
from .quantile import exact_quantile


def project(df: DataFrame, cols: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """B1: subset / reorder / rename."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in cols])


def fill_zero(df: DataFrame) -> DataFrame:
    """B2: global null fill with 0 (numeric columns); NaN counts as missing."""
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("float", "double")]
    out = df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in num else F.col(c)
                      for c in df.columns])
    return out.na.fill(0)


def null_profile(df: DataFrame) -> DataFrame:
    """NULL (or NaN) count and ratio per column, one pass, then unpivot."""
    fields = df.schema.fields

    def is_missing(f):
        c = F.col(f.name)
        if f.dataType.typeName() in ("float", "double"):
            return c.isNull() | F.isnan(c)
        return c.isNull()

    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(is_missing(f)).alias(f"_m{i}") for i, f in enumerate(fields)]
    wide = df.agg(*aggs)
    stack = "stack({}, {}) as (column_name, null_count)".format(
        len(fields), ", ".join(f"'{f.name}', _m{i}" for i, f in enumerate(fields)))
    return (wide.selectExpr("_n", stack)
            .select("column_name", F.col("null_count").cast("bigint").alias("null_count"),
                    (F.col("null_count") / F.nullif(F.col("_n").cast("double"), F.lit(0.0))).alias("null_ratio")))


def cast_types(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Casts (``try_cast`` for dirty text when ``lenient``)."""
    def cast(c, t):
        return F.expr(f"try_cast(`{c}` as {t})") if lenient else F.col(c).cast(t)
    return df.select(*[cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def dropout_risk(df: DataFrame, col: str = "leak_rate", thr: float = 30.0) -> DataFrame:
    """Strict ``leak_rate > thr`` label as 0/1 (Q4)."""
    return df.withColumn("dropout_risk", (F.col(col) > thr).cast("int"))


def drop_first(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with NULL in any of ``subset``."""
    return df.na.drop(subset=subset)


def retention_metrics(df: DataFrame, cur: str = "members", prev: str = "members_prev",
                      retained: str = "retained") -> DataFrame:
    """Variation and retention percentages (0 when prev = 0) and loss."""
    return df.select(
        "*",
        safe_ratio(F.col(cur) - F.col(prev), prev, 100.0, 2, 0.0).alias("variation_pct"),
        safe_ratio(retained, prev, 100.0, 2, 0.0).alias("retention_pct"),
        (F.col(prev) - F.col(retained)).cast("bigint").alias("lost_members"))


def coalesce_cols(df: DataFrame, out: str, *cols: str) -> DataFrame:
    """First non-null across columns (join sides)."""
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in cols]))


def interactions(df: DataFrame, members: str = "members_lag1", leak: str = "leak_rate_lag1") -> DataFrame:
    """retention_rate = 1 - leak/100 and members x retention.

    Lagged inputs by default; pass the current columns for the anomaly form.
    """
    rr = 1 - col_(leak) / 100.0
    return df.withColumn("retention_rate", rr).withColumn("members_x_retention", col_(members) * rr)


# B16 fixed values: per-task allow-lists of columns (target-derived columns excluded)
FEATURE_SETS = {
    "regression": ["unit", "members_prev", "period", "members"],
    "classification": ["unit", "members", "members_prev", "period", "dropout_risk"],
    "clustering": ["members", "members_prev", "leak_rate", "unit", "period"],
    "timeseries": ["unit", "period", "members"],
}
LEAKY = {"regression": {"leak_rate", "retained", "variation_pct"},
         "classification": {"leak_rate", "retention_pct", "variation_pct", "retained"}}


def feature_set(task: str) -> list[str]:
    """Allowed columns per task; asserts no target-derived column."""
    cols = FEATURE_SETS[task]
    assert not (set(cols) & LEAKY.get(task, set())), f"leaky columns in {task}"
    return cols


def quantiles(df: DataFrame, col: str, probs: list[float], exact: bool = True,
              accuracy: int = 100000):
    """Quantile columns of one 1-row aggregate.

    ``exact`` uses ``percentile`` (linear interpolation, = pandas / DuckDB
    quantile_cont); it keeps a value->count map, so use it on bounded inputs
    (panel level).  ``exact=False`` is the fixed-memory sketch for raw tables.
    """
    if exact:
        return F.percentile(F.col(col), F.array(*[F.lit(p) for p in probs]))
    return F.percentile_approx(F.col(col), F.array(*[F.lit(p) for p in probs]), accuracy)


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, exact: bool = True) -> DataFrame:
    """Rows outside [q1 - k*iqr, q3 + k*iqr], flagged.

    Exact quartiles come from histogram passes at any size; ``exact=False``
    takes the fixed-memory sketch.
    """
    if exact:
        q1, q3 = exact_quantile(df, col, 0.25), exact_quantile(df, col, 0.75)
    else:
        q1, q3 = df.agg(quantiles(df, col, [0.25, 0.75], False)).first()[0] or (None, None)
    known = q1 is not None
    lo = F.lit(q1 - k * (q3 - q1) if known else None).cast("double")
    hi = F.lit(q3 + k * (q3 - q1) if known else None).cast("double")
    return (df.withColumn("lower_fence", lo).withColumn("upper_fence", hi)
            .withColumn("is_outlier", ((F.col(col) < F.col("lower_fence"))
                                       | (F.col(col) > F.col("upper_fence"))).cast("int")))


def all_true(*conds):
    return reduce(lambda a, b: a & b, conds)
