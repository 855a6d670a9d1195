"""H: scalar column builders (all JVM-side expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season_year(season) -> Column:
    """B5: 'YYYY/YYYY' -> first year as int."""
    return F.split(col_(season), "/").getItem(0).cast("int")


def season_label(year) -> Column:
    """Inverse of B5: 2023 -> '2023/2024'."""
    y = col_(year).cast("int")
    return F.concat_ws("/", y.cast("string"), (y + 1).cast("string"))


def safe_ratio(num, den, scale: float = 1.0, digits: int | None = None,
               default=None) -> Column:
    """Num / den with den = 0 -> NULL (or ``default``), optional round."""
    r = col_(num) * F.lit(scale) / F.nullif(col_(den).cast("double"), F.lit(0.0))
    if digits is not None:
        r = F.round(r, digits)
    return r if default is None else F.coalesce(r, F.lit(default))


def leak_rate_expr(prev, cur) -> Column:
    """Q5: round(max(0, (prev - cur) / prev * 100), 2), 0 when prev = 0."""
    p, c = col_(prev).cast("double"), col_(cur).cast("double")
    return F.when(p > 0, F.round(F.greatest(F.lit(0.0), (p - c) * 100.0 / p), 2)).otherwise(F.lit(0.0))


def safe_growth(cur, prev) -> Column:
    """Percent growth only if prev > 0 else 0."""
    c, p = col_(cur).cast("double"), col_(prev).cast("double")
    return F.when(p > 0, (c - p) / p * 100.0).otherwise(F.lit(0.0))


def clamp(c, lo=None, hi=None) -> Column:
    """greatest(least(c, hi), lo)."""
    out = col_(c)
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return out


def round_to(c, digits: int, half_even: bool = False) -> Column:
    """Numpy rounding is half-even (``bround``); SQL oracles use ``round``."""
    return F.bround(col_(c), digits) if half_even else F.round(col_(c), digits)


def trend_label(real, forecast, tol: float = 1.0) -> Column:
    """Delta > tol up, < -tol down, else stable."""
    d = col_(forecast) - col_(real)
    return F.when(d > tol, "up").when(d < -tol, "down").otherwise("stable")


def action_label(delta, tol: float = 2.0) -> Column:
    """Recommended action from a forecast delta."""
    d = col_(delta)
    return (F.when(d > tol, "add resources")
            .when(d < -tol, "retention campaign")
            .otherwise("maintain"))


def cluster_name(avg_variation, cv) -> Column:
    """Name a cluster from its profile (variation x dispersion).

    Fixed values: variation below -10 -> 'declining', below -5 -> 'eroding',
    else 'stable'; cv above 0.5 -> 'volatile', above 0.3 -> 'variable', else
    'steady'.
    """
    v, c = col_(avg_variation), col_(cv)
    trend = F.when(v < -10, "declining").when(v < -5, "eroding").otherwise("stable")
    disp = F.when(c > 0.5, "volatile").when(c > 0.3, "variable").otherwise("steady")
    return F.concat_ws(" / ", trend, disp)


def risk_tier(pred_flag, n_anomalies) -> Column:
    """B15d: 'risk' when a dropout is predicted, 'warn' with anomalies, else 'ok'."""
    return (F.when(F.coalesce(col_(pred_flag), F.lit(0)) == 1, "risk")
            .when(F.coalesce(col_(n_anomalies), F.lit(0)) > 0, "warn")
            .otherwise("ok"))


def flagged(c) -> Column:
    """flag == 1 with a missing value read as 0."""
    return F.coalesce(col_(c), F.lit(0)) == 1


def inv_norm_cdf(p) -> Column:
    """Inverse standard-normal CDF as a column expression.

    Acklam's rational approximation (relative error < 1.2e-9).  Fixed values:
    the published coefficient sets a, b, c, d and the split point 0.02425.
    """
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00]
    p = col_(p)
    lo = 0.02425

    def poly(coefs, x):
        out = F.lit(coefs[0])
        for k in coefs[1:]:
            out = out * x + F.lit(k)
        return out

    q_lo = F.sqrt(-2 * F.log(p))
    low = poly(c, q_lo) / (poly(d, q_lo) * q_lo + 1)
    q_hi = F.sqrt(-2 * F.log(1 - p))
    high = -poly(c, q_hi) / (poly(d, q_hi) * q_hi + 1)
    q = p - 0.5
    r = q * q
    mid = poly(a, r) * q / (poly(b, r) * r + 1)
    return F.when(p < lo, low).when(p > 1 - lo, high).otherwise(mid)


def with_scalars(df, onerow, name: str = "_s"):
    """Attach a 1-row aggregate to every row as a scalar subquery.

    The aggregate runs once and is inlined as a value: no join, no shuffle of
    ``df``, and a proven size bound (one row) by construction.  Fields are
    read as ``F.col("_s.<field>")``.
    """
    return df.withColumn(name, onerow.select(F.struct(*onerow.columns)).scalar())


def round_sig(c, digits: int) -> Column:
    """Round to ``digits`` significant digits (for scores spanning 1e-10..1e10)."""
    x = col_(c)
    e = F.floor(F.log10(F.abs(x)))
    scaled = F.round(x / F.pow(F.lit(10.0), e), digits - 1) * F.pow(F.lit(10.0), e)
    return F.when(x == 0, x).otherwise(scaled)


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_us(c) -> Column:
    """Microseconds since the epoch of a wall-clock timestamp, independent of
    the session time zone (a timestamp is first read as wall clock)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col_(c).cast("timestamp_ntz"))


def from_epoch_us(c) -> Column:
    """Inverse of ``epoch_us``: a timestamp_ntz, again without a time zone."""
    return F.timestamp_add("MICROSECOND", col_(c), F.expr(_EPOCH_NTZ))


def one_of(c, values) -> Column:
    """The column itself, which must have one of ``values`` in every row: any other
    value, null too, fails the query, so a pivot over a fixed list loses nothing."""
    c = col_(c)
    told = F.concat(F.lit(f"not one of {list(values)}: "), F.coalesce(c.cast("string"), F.lit("null")))
    return F.when(F.coalesce(c.isin(list(values)), F.lit(False)), c).otherwise(F.raise_error(told))
