"""E: per-unit window features over a (unit, period) panel.

All features of one build share ONE window spec (partitionBy unit, orderBy
period), so the physical plan has a single Exchange hashpartitioning(unit) +
Sort feeding one Window operator.  Nothing is ordered globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col_

UNBOUNDED = Window.unboundedPreceding


def unit_window(unit: str = "unit", period: str = "period"):
    return Window.partitionBy(unit).orderBy(period)


def lag1(c, w, fill=None) -> Column:
    """Lag 1 with optional fill."""
    out = F.lag(col_(c), 1).over(w)
    return out if fill is None else F.coalesce(out, F.lit(fill))


def diff(c, w) -> Column:
    """First difference."""
    return col_(c) - F.lag(col_(c), 1).over(w)


def pct_change(c, w) -> Column:
    """C / lag(c) - 1; a zero previous value yields NULL (not inf)."""
    prev = F.lag(col_(c), 1).over(w).cast("double")
    return col_(c) / F.nullif(prev, F.lit(0.0)) - 1


def past_mean(c, w, first_fill: str = "null") -> Column:
    """E5: mean of strictly earlier rows; first row by policy (Q2).

    ``first_fill``: 'null' (leave NULL), 'zero', or 'self' (the row's own
    value, the parity mode that leaks the target).
    """
    m = F.avg(col_(c)).over(w.rowsBetween(UNBOUNDED, -1))
    if first_fill == "zero":
        return F.coalesce(m, F.lit(0.0))
    if first_fill == "self":
        return F.coalesce(m, col_(c).cast("double"))
    return m


def cumsum(c, w) -> Column:
    """Running sum up to the current row."""
    return F.sum(col_(c)).over(w.rowsBetween(UNBOUNDED, 0))


def _global_carry(df: DataFrame, unit: str, cols: dict[str, str],
                  buckets: int = 4096) -> DataFrame:
    """Q1 parity: the previous unit's last value for each unit (by unit order).

    Two-level so no window runs without a partition over all units: a window
    inside ``unit div buckets`` handles most units; for the first unit of each
    bucket the last row of the previous non-empty bucket comes from a
    per-bucket summary (#units / buckets rows).
    """
    last = df.groupBy(unit).agg(*[F.max_by(F.col(src), F.col("_ord")).alias(dst)
                                  for dst, src in cols.items()])
    last = last.withColumn("_bucket", F.floor(F.col(unit) / buckets))
    wb = Window.partitionBy("_bucket").orderBy(unit)
    within = last.select(unit, "_bucket", *[F.lag(d, 1).over(wb).alias(d) for d in cols],
                         (F.row_number().over(wb) == 1).alias("_first"))
    bsum = last.groupBy("_bucket").agg(
        *[F.max_by(F.col(d), F.col(unit)).alias(d) for d in cols])
    # per-bucket summary is #units/buckets rows: a small, bounded frame
    bprev = bsum.select(
        "_bucket", *[F.lag(d, 1).over(Window.orderBy("_bucket")).alias("_p_" + d) for d in cols])
    out = within.join(bprev, "_bucket", "left")
    return out.select(unit, *[F.when(F.col("_first"), F.col("_p_" + d)).otherwise(F.col(d)).alias(d)
                              for d in cols])


def lagged_growth(df: DataFrame, y: str = "members", unit: str = "unit",
                  period: str = "period", carry: str = "unit") -> DataFrame:
    """Growth and delta of the previous period (two rows back).

    growth_rate_lag1 = (y[t-1] - y[t-2]) / y[t-2] * 100, delta_members_lag1 =
    y[t-1] - y[t-2], both from one window (lag 1 and lag 2, no
    window-of-window).  ``carry='global'`` reproduces the reference's
    ungrouped shift: a unit's first row takes the previous unit's last value.
    """
    w = unit_window(unit, period)
    l1 = F.lag(col_(y), 1).over(w).cast("double")
    l2 = F.lag(col_(y), 2).over(w).cast("double")
    out = df.withColumn("growth_rate_lag1", (l1 - l2) / F.nullif(l2, F.lit(0.0)) * 100.0) \
            .withColumn("delta_members_lag1", l1 - l2)
    if carry == "global":
        y2 = F.lag(col_(y), 1).over(w).cast("double")
        cur = df.withColumn("_g", (col_(y) - y2) / F.nullif(y2, F.lit(0.0)) * 100.0) \
                .withColumn("_d", col_(y) - y2).withColumn("_ord", F.col(period))
        carried = _global_carry(cur, unit, {"_cg": "_g", "_cd": "_d"})
        first = F.row_number().over(w) == 1
        out = (out.join(carried, unit, "left")
               .withColumn("growth_rate_lag1", F.when(first, F.col("_cg")).otherwise(F.col("growth_rate_lag1")))
               .withColumn("delta_members_lag1", F.when(first, F.col("_cd")).otherwise(F.col("delta_members_lag1")))
               .drop("_cg", "_cd"))
    return out


def build_features(panel: DataFrame, carry: str = "unit", first_fill: str = "null",
                   drop_first: bool = True, fill_zero: bool = False) -> DataFrame:
    """The full lag feature set, in one window spec.

    Output: unit, period, members (target), leak_rate, members_lag1,
    leak_rate_lag1, growth_rate_lag1, delta_members_lag1,
    avg_members_unite_past, season_index, retention_rate,
    members_x_retention.  Policies: Q1 ``carry``, Q2 ``first_fill``, Q3
    ``drop_first`` (drop rows without a previous period) / ``fill_zero``.
    """
    w = unit_window()
    df = lagged_growth(panel, carry=carry)
    df = df.select(
        "unit", "period", "members", "leak_rate",
        F.lag("members", 1).over(w).cast("double").alias("members_lag1"),
        F.lag("leak_rate", 1).over(w).alias("leak_rate_lag1"),
        "growth_rate_lag1", "delta_members_lag1",
        past_mean("members", w, first_fill).alias("avg_members_unite_past"),
        F.row_number().over(w).alias("season_index"))
    if fill_zero:
        df = df.na.fill(0.0, ["members_lag1", "leak_rate_lag1", "growth_rate_lag1",
                              "delta_members_lag1"])
    if drop_first:
        df = df.where(F.col("members_lag1").isNotNull())
    return (df.withColumn("retention_rate", 1 - F.col("leak_rate_lag1") / 100.0)
              .withColumn("members_x_retention", F.col("members_lag1") * F.col("retention_rate")))


def last_two(panel: DataFrame, y: str = "members", unit: str = "unit",
             period: str = "period") -> DataFrame:
    """Last and second-last value per unit (second falls back to last).

    A bounded aggregate per unit: ``max_by`` for the last row, and the
    second-last from the rows left after excluding the last period.
    """
    w = Window.partitionBy(unit).orderBy(F.col(period).desc())
    ranked = panel.select(unit, period, y, F.row_number().over(w).alias("_rn")).where("_rn <= 2")
    return (ranked.groupBy(unit)
            .agg(F.max(F.when(F.col("_rn") == 1, F.col(period))).alias("last_period"),
                 F.max(F.when(F.col("_rn") == 1, F.col(y))).alias("last_value"),
                 F.max(F.when(F.col("_rn") == 2, F.col(y))).alias("_prev"))
            .select(unit, "last_period", "last_value",
                    F.coalesce("_prev", "last_value").alias("prev_value")))


def next_period_features(panel: DataFrame) -> DataFrame:
    """The feature row for the period after each unit's last one.

    One ``groupBy(unit)`` (E8 + D17 + B11): members_lag1 = last members,
    leak_rate_lag1 = last leak, growth/delta from the last two rows (growth 0
    when the previous value is 0), mean of all history, index = count + 1.
    """
    agg = (panel.groupBy("unit")
           .agg(F.max("period").alias("last_period"),
                F.max_by("members", "period").alias("m_last"),
                F.max_by("leak_rate", "period").alias("leak_last"),
                F.avg("members").alias("avg_members_unite_past"),
                F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("unit").orderBy(F.col("period").desc())
    prev = (panel.select("unit", "members", F.row_number().over(w).alias("_rn"))
            .where("_rn = 2").select("unit", F.col("members").alias("m_prev")))
    j = agg.join(prev, "unit", "left")
    m_prev = F.coalesce(F.col("m_prev"), F.col("m_last")).cast("double")
    m_last = F.col("m_last").cast("double")
    return j.select(
        "unit",
        (F.col("last_period") + 1).alias("period"),
        m_last.alias("members_lag1"),
        F.col("leak_last").alias("leak_rate_lag1"),
        F.when(m_prev > 0, (m_last - m_prev) / m_prev * 100.0).otherwise(F.lit(0.0)).alias("growth_rate_lag1"),
        (m_last - m_prev).alias("delta_members_lag1"),
        "avg_members_unite_past",
        (F.col("n") + 1).cast("int").alias("season_index"),
        (1 - F.col("leak_last") / 100.0).alias("retention_rate"),
        (m_last * (1 - F.col("leak_last") / 100.0)).alias("members_x_retention"))


def total_variation(panel: DataFrame) -> DataFrame:
    """D1 + E10: total per period and its period-over-period change.

    The total series has one row per period (bounded by the calendar), so the
    window over it is a small single-partition frame by construction.
    """
    tot = panel.groupBy("period").agg(F.sum("members").cast("bigint").alias("total_members"))
    w = Window.orderBy("period")
    prev = F.lag("total_members", 1).over(w).cast("double")
    return tot.select("period", "total_members",
                      (F.col("total_members") - prev).alias("diff"),
                      ((F.col("total_members") / F.nullif(prev, F.lit(0.0)) - 1) * 100.0).alias("pct_change"))
