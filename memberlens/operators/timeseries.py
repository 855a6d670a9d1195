"""I: per-series statistics and forecasts, all in closed form.

Every operator works on a long (unit, period, y) frame with any number of
series: windows are partitioned by unit, statistics are ``groupBy(unit)``
aggregates.  Degenerate series (too short, zero variance) give NULL, never an
exception.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clamp

# MacKinnon (2010) response-surface coefficients for the
# Dickey-Fuller tau with a constant, c(n) = b0 + b1/n + b2/n^2 + b3/n^3,
# at the 1 %, 5 % and 10 % levels.
ADF_CRIT_C = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
# Fixed value: KPSS level-stationarity critical value at 5 % (Kwiatkowski et al. 1992).
KPSS_CRIT_5 = 0.463


def _w(unit="unit", period="period"):
    return Window.partitionBy(unit).orderBy(period)


def adf(panel: DataFrame, y: str = "members", unit: str = "unit", period: str = "period",
        min_obs: int = 4) -> DataFrame:
    """Dickey-Fuller tau with constant, 0 lags, per series.

    dy_t = a + b*y_{t-1}; tau = b / se(b) from ``regr_sxx/sxy/syy``; critical
    value from the response surface at the series' n.
    """
    w = _w(unit, period)
    yl = F.lag(F.col(y), 1).over(w).cast("double")
    d = panel.select(unit, (F.col(y).cast("double") - yl).alias("dy"), yl.alias("ylag")) \
             .where(F.col("ylag").isNotNull())
    a = d.groupBy(unit).agg(F.regr_count("dy", "ylag").alias("n"), F.regr_sxx("dy", "ylag").alias("sxx"),
                            F.regr_sxy("dy", "ylag").alias("sxy"), F.regr_syy("dy", "ylag").alias("syy"))
    sxx = F.nullif(F.col("sxx"), F.lit(0.0))     # ANSI: never divide by zero
    b = F.col("sxy") / sxx
    ssr = F.col("syy") - F.col("sxy") * F.col("sxy") / sxx
    se = F.sqrt(ssr / F.nullif((F.col("n") - 2).cast("double"), F.lit(0.0)) / sxx)
    ok = (F.col("n") >= min_obs) & (F.col("sxx") > 0) & (ssr > 0)
    tau = F.when(ok, b / F.nullif(se, F.lit(0.0)))
    n = F.col("n").cast("double")
    c5 = ADF_CRIT_C["5%"]
    crit = F.lit(c5[0]) + F.lit(c5[1]) / n + F.lit(c5[2]) / (n * n) + F.lit(c5[3]) / (n * n * n)
    return a.select(unit, F.col("n").cast("bigint").alias("n"), tau.alias("adf_stat"),
                    F.when(ok, crit).alias("crit_5pct"),
                    F.when(~ok, F.lit("undetermined")).when(tau < crit, "stationary")
                    .otherwise("non-stationary").alias("conclusion"))


def kpss(panel: DataFrame, y: str = "members", unit: str = "unit", period: str = "period",
         min_obs: int = 3) -> DataFrame:
    """KPSS level statistic, 0 lags: sum(S_t^2) / (n^2 * sigma^2)."""
    w = _w(unit, period)
    wa = Window.partitionBy(unit)
    e = panel.select(unit, period, (F.col(y) - F.avg(y).over(wa)).alias("e"))
    s = e.select(unit, "e", F.sum("e").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("S"))
    a = s.groupBy(unit).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("S") * F.col("S")).alias("ss"),
                            F.sum(F.col("e") * F.col("e")).alias("ee"))
    n = F.col("n").cast("double")
    ok = (F.col("n") >= min_obs) & (F.col("ee") > 0)
    stat = F.when(ok, F.col("ss") / F.nullif(n * n * (F.col("ee") / n), F.lit(0.0)))
    return a.select(unit, F.col("n").cast("bigint").alias("n"), stat.alias("kpss_stat"),
                    F.when(~ok, F.lit("undetermined")).when(stat <= KPSS_CRIT_5, "stationary")
                    .otherwise("non-stationary").alias("conclusion"))


def decompose(panel: DataFrame, period_len: int, y: str = "members", unit: str = "unit",
              period: str = "period") -> DataFrame:
    """Additive decomposition: centred moving average, phase means, residual.

    Odd ``period_len``: plain centred mean; even: the 2 x p moving average.
    Rows without a full window have NULL trend (and NULL residual).
    """
    w = _w(unit, period)
    p = period_len
    yy = F.col(y).cast("double")
    if p == 1:
        trend = yy
    elif p % 2 == 1:
        h = p // 2
        wf = w.rowsBetween(-h, h)
        trend = F.when(F.count(yy).over(wf) == p, F.avg(yy).over(wf))
    else:
        h = p // 2
        wf = w.rowsBetween(-h, h)
        full = F.sum(yy).over(wf)
        ends = F.lag(yy, h).over(w) + F.lead(yy, h).over(w)
        trend = F.when(F.count(yy).over(wf) == p + 1, (full - 0.5 * ends) / p)
    base = panel.select(unit, period, yy.alias("y"), trend.alias("trend"),
                        F.pmod(F.row_number().over(w) - 1, F.lit(p)).alias("phase"))
    ph = (base.where(F.col("trend").isNotNull())
          .groupBy(unit, "phase").agg(F.avg(F.col("y") - F.col("trend")).alias("pm")))
    ph = ph.select(unit, "phase", (F.col("pm") - F.avg("pm").over(Window.partitionBy(unit))).alias("seasonal"))
    out = base.join(ph, [unit, "phase"], "left") \
              .withColumn("seasonal", F.coalesce(F.col("seasonal"), F.lit(0.0)))
    return out.select(unit, period, "y", "trend", "seasonal",
                      (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid"))


def naive_forecast(panel: DataFrame, y: str = "members", unit: str = "unit",
                   period: str = "period") -> DataFrame:
    """Next-period forecast = last observed value."""
    return panel.groupBy(unit).agg((F.max(period) + 1).alias(period),
                                   F.max_by(F.col(y), F.col(period)).cast("double").alias("forecast"))


def ar1_forecast(panel: DataFrame, y: str = "members", unit: str = "unit",
                 period: str = "period") -> DataFrame:
    """I4: AR(1) on first differences without constant (ARIMA(1,1,0)).

    phi = sum(d_t d_{t-1}) / sum(d_{t-1}^2) by conditional least squares;
    forecast = max(0, y_last + phi * d_last); naive when phi is undefined.
    """
    w = _w(unit, period)
    yy = F.col(y).cast("double")
    d = yy - F.lag(yy, 1).over(w)
    x = panel.select(unit, period, yy.alias("y"), d.alias("d"))
    x = x.select("*", F.lag("d", 1).over(w).alias("d1"))
    a = x.groupBy(unit).agg(
        F.max(period).alias("last_period"),
        F.max_by("y", period).alias("y_last"), F.max_by("d", period).alias("d_last"),
        F.sum(F.col("d") * F.col("d1")).alias("sxy"), F.sum(F.col("d1") * F.col("d1")).alias("sxx"))
    phi = F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx"))
    fc = F.coalesce(clamp(F.col("y_last") + phi * F.col("d_last"), lo=0.0), F.col("y_last"))
    return a.select(unit, (F.col("last_period") + 1).alias(period), phi.alias("phi"),
                    fc.alias("forecast"),
                    F.when(phi.isNull(), F.lit("naive")).otherwise(F.lit("ar1")).alias("method"))


def backtest(panel: DataFrame, y: str = "members", unit: str = "unit", period: str = "period",
             model: str = "naive") -> DataFrame:
    """Expanding-origin backtest: predict each point from earlier points.

    naive = previous value; mean = mean of all earlier values; drift =
    previous + mean earlier change; ar1 = previous + phi * last change with phi
    fitted on the earlier changes only, at least 0, naive while phi is undefined.
    Closed forms over ``rowsBetween(unboundedPreceding, -1)``; first row has no
    prediction.
    """
    w = _w(unit, period)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    yy = F.col(y).cast("double")
    prev = F.lag(yy, 1).over(w)
    if model == "naive":
        pred = prev
    elif model == "mean":
        pred = F.avg(yy).over(past)
    elif model == "drift":
        n_prev = F.count(yy).over(past)
        first = F.first(yy).over(past)
        pred = F.when(n_prev >= 2, prev + (prev - first) / (n_prev - 1)).otherwise(prev)
    elif model == "ar1":
        d = yy - F.lag(yy, 1).over(w)
        x = panel.select(unit, period, yy.alias("y"), F.lag(yy, 1).over(w).alias("prev"), d.alias("d"))
        x = x.select("*", F.lag("d", 1).over(w).alias("d1"))
        phi = F.sum(F.col("d") * F.col("d1")).over(past) / F.nullif(F.sum(F.when(F.col("d").isNotNull(), F.col("d1") * F.col("d1"))).over(past), F.lit(0.0))
        step = F.greatest(F.lit(0.0), F.col("prev") + phi * F.col("d1"))
        pred = F.when(phi.isNotNull(), step).otherwise(F.col("prev"))
        return x.select(unit, period, "y", pred.alias("pred")).where(F.col("pred").isNotNull()).withColumn("model", F.lit(model))
    else:
        raise ValueError(model)
    return (panel.select(unit, period, yy.alias("y"), pred.alias("pred"))
            .where(F.col("pred").isNotNull()).withColumn("model", F.lit(model)))


def histogram(df: DataFrame, col: str, bins: int = 8) -> DataFrame:
    """Equal-width histogram between min and max (top edge closed)."""
    from ..functions.scalar import with_scalars
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    j = with_scalars(df.select(col), mm)
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    b = F.least(F.floor((F.col(col) - F.col("_s.lo")) / F.nullif(F.col("_s.hi") - F.col("_s.lo"), F.lit(0.0)) * bins)
                + 1, F.lit(bins))
    b = F.coalesce(b, F.lit(1))
    return (j.select(b.cast("int").alias("bin"), (F.col("_s.lo") + (b - 1) * width).alias("bin_lo"),
                     (F.col("_s.lo") + b * width).alias("bin_hi"))
            .groupBy("bin", "bin_lo", "bin_hi").agg(F.count(F.lit(1)).alias("n")))
