"""B, C, D, E, F, G, I queries over the panel and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregates as D
from ..operators import cleaning as B
from ..operators import joins as C
from ..operators import metrics as M
from ..operators import timeseries as TS
from ..operators import windows as W
from ..plans.panel import load_panel, panel_events
from ..sources.tables import read_table
from .registry import query
from .sqlparts import FEATURES_CTE, PANEL_CTE

FEATURE_COLS = ["members_lag1", "leak_rate_lag1", "growth_rate_lag1", "delta_members_lag1",
                "avg_members_unite_past", "season_index", "unit", "retention_rate",
                "members_x_retention"]

# ----------------------------------------------------------------------------- B


_NP_COLS = ["unit", "period", "members", "leak_rate", "members_lag1", "leak_rate_lag1",
            "growth_rate_lag1", "delta_members_lag1", "avg_members_unite_past", "season_index",
            "retention_rate", "members_x_retention"]
_NP_SQL_FEAT = FEATURES_CTE.replace("FROM feat0 WHERE members_lag1 IS NOT NULL", "FROM feat0")
_NP_SQL = "WITH " + _NP_SQL_FEAT + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL OR isnan(CAST({c} AS DOUBLE))) AS BIGINT) AS null_count, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL OR isnan(CAST({c} AS DOUBLE))) / CAST(COUNT(*) AS DOUBLE) AS null_ratio FROM features"
    for c in _NP_COLS)


@query("null_profile", doubles=("null_ratio",), sql=_NP_SQL)
def null_profile(spark, sf_dir):
    """NULL count and ratio per column of the undropped feature frame."""
    f = W.build_features(load_panel(spark, sf_dir), drop_first=False)
    return B.null_profile(f.select(*_NP_COLS))


@query("iqr_outliers", doubles=("leak_rate", "lower_fence", "upper_fence"), sql=f"""
WITH {PANEL_CTE},
q AS (SELECT quantile_cont(leak_rate, 0.25) AS q1, quantile_cont(leak_rate, 0.75) AS q3 FROM panel)
SELECT unit, period, leak_rate,
       q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence,
       CAST(CASE WHEN leak_rate < q1 - 1.5 * (q3 - q1) OR leak_rate > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END AS INTEGER) AS is_outlier
FROM panel, q""")
def iqr_outliers(spark, sf_dir):
    """leak_rate outside the 1.5 IQR fences (exact linear quantiles)."""
    p = load_panel(spark, sf_dir).select("unit", "period", "leak_rate")
    return B.iqr_outliers(p, "leak_rate")


@query("retention_metrics", doubles=("leak_rate", "variation_pct", "retention_pct"), sql=f"""
WITH {PANEL_CTE}
SELECT unit, period, members, members_prev, retained, leak_rate,
       COALESCE(ROUND(CAST(members - members_prev AS DOUBLE) * 100.0 / NULLIF(CAST(members_prev AS DOUBLE), 0.0), 2), 0.0) AS variation_pct,
       COALESCE(ROUND(CAST(retained AS DOUBLE) * 100.0 / NULLIF(CAST(members_prev AS DOUBLE), 0.0), 2), 0.0) AS retention_pct,
       CAST(members_prev - retained AS BIGINT) AS lost_members
FROM panel""")
def retention_metrics(spark, sf_dir):
    """Safe-ratio variation / retention percentages and member loss."""
    return B.retention_metrics(load_panel(spark, sf_dir))


@query("season_parse", sql=f"""
WITH {PANEL_CTE}
SELECT unit, CAST(period AS VARCHAR) || '/' || CAST(period + 1 AS VARCHAR) AS season,
       CAST(split_part(CAST(period AS VARCHAR) || '/' || CAST(period + 1 AS VARCHAR), '/', 1) AS INTEGER) AS season_year,
       CAST(substring(CAST(period AS VARCHAR) || '/' || CAST(period + 1 AS VARCHAR), 1, 4) AS INTEGER) AS season_prefix_year
FROM panel""")
def season_parse(spark, sf_dir):
    """Period label 'YYYY/YYYY' and its parse back by split and prefix."""
    p = load_panel(spark, sf_dir).select("unit", S.season_label("period").alias("season"))
    return p.select("unit", "season", S.season_year("season").alias("season_year"),
                    F.substring("season", 1, 4).cast("int").alias("season_prefix_year"))


@query("dropout_label", doubles=("leak_rate",), sql=f"""
WITH {PANEL_CTE}
SELECT unit, period, leak_rate, CAST(leak_rate > 30 AS INTEGER) AS dropout_risk FROM panel""")
def dropout_label(spark, sf_dir):
    """Strict leak_rate > 30 label."""
    return B.dropout_risk(load_panel(spark, sf_dir).select("unit", "period", "leak_rate"))


@query("clamp_round", doubles=("growth_clamped", "growth_r0", "growth_r1"), sql=f"""
WITH {FEATURES_CTE}
SELECT unit, period,
       GREATEST(LEAST(growth_rate_lag1, 50.0), -50.0) AS growth_clamped,
       ROUND(growth_rate_lag1, 0) AS growth_r0, ROUND(growth_rate_lag1, 1) AS growth_r1,
       CASE WHEN members_lag1 - members > 1 THEN 'up' WHEN members_lag1 - members < -1 THEN 'down' ELSE 'stable' END AS trend,
       CASE WHEN members_lag1 - members > 2 THEN 'add resources' WHEN members_lag1 - members < -2 THEN 'retention campaign' ELSE 'maintain' END AS action
FROM features""")
def clamp_round(spark, sf_dir):
    """B12 / B13 / B15a / B15b on the feature panel (lag-1 value as forecast)."""
    f = W.build_features(load_panel(spark, sf_dir))
    return f.select("unit", "period",
                    S.clamp("growth_rate_lag1", -50.0, 50.0).alias("growth_clamped"),
                    S.round_to("growth_rate_lag1", 0).alias("growth_r0"),
                    S.round_to("growth_rate_lag1", 1).alias("growth_r1"),
                    S.trend_label("members", "members_lag1").alias("trend"),
                    S.action_label(F.col("members_lag1") - F.col("members")).alias("action"))


# ----------------------------------------------------------------------------- C

@query("join_leak_left", doubles=("leak_rate",), sql=f"""
WITH {PANEL_CTE},
reg AS (SELECT unit, period, members_prev, members FROM panel),
clu AS (SELECT unit, CAST(period AS VARCHAR) || '/' || CAST(period + 1 AS VARCHAR) AS season, members, leak_rate FROM panel)
SELECT r.unit, r.period, r.members_prev, COALESCE(r.members, c.members) AS members, c.season, c.leak_rate
FROM reg r LEFT JOIN clu c ON r.unit = c.unit AND r.period = CAST(split_part(c.season, '/', 1) AS INTEGER)""")
def join_leak_left(spark, sf_dir):
    """C1 + C2 + C3: regression rows left-joined to clustering rows on a
    computed key (season string -> year), colliding column coalesced."""
    p = load_panel(spark, sf_dir)
    reg = B.project(p, ["unit", "period", "members_prev", "members"])
    clu = p.select("unit", S.season_label("period").alias("season"), "members", "leak_rate")
    clu = clu.withColumn("period", S.season_year("season"))
    j = C.join_coalesce(reg, clu.select("unit", "period", "members"), ["unit", "period"], "members")
    return j.join(clu.select("unit", "period", "season", "leak_rate"), ["unit", "period"], "left") \
            .select("unit", "period", "members_prev", "members", "season", "leak_rate")


@query("retained_semi", sql="""
WITH cy AS (
  SELECT DISTINCT o.o_custkey AS entity, c.c_nationkey AS unit, CAST(year(o.o_orderdate) AS INTEGER) AS period
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT unit, period, COUNT(*) AS retained_semi
FROM cy a WHERE EXISTS (SELECT 1 FROM cy b WHERE b.entity = a.entity AND b.period = a.period - 1)
GROUP BY unit, period""")
def retained_semi(spark, sf_dir):
    """C11: retained members by a left-semi join on (entity, period - 1)."""
    ev = panel_events(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))
    ev = ev.select("entity", "unit", "period")
    return C.retained(ev).groupBy("unit", "period").agg(F.count(F.lit(1)).alias("retained_semi"))


# ----------------------------------------------------------------------------- D

_UP_DOUBLES = ("avg_members", "max_members", "min_members", "std_members", "avg_leak_rate",
               "max_leak_rate", "range_members", "cv_members", "retention_rate", "avg_variation",
               "trend_pct")


@query("unit_profile", doubles=_UP_DOUBLES, sql=f"""
WITH {PANEL_CTE},
a AS (
  SELECT unit, AVG(members) AS avg_members, CAST(MAX(members) AS DOUBLE) AS max_members,
         CAST(MIN(members) AS DOUBLE) AS min_members, STDDEV_SAMP(members) AS std_members,
         CAST(SUM(members) AS BIGINT) AS total_members, AVG(leak_rate) AS avg_leak_rate,
         MAX(leak_rate) AS max_leak_rate, COUNT(*) AS n_periods,
         CAST(arg_min(members, period) AS DOUBLE) AS first_members,
         CAST(arg_max(members, period) AS DOUBLE) AS last_members
  FROM panel GROUP BY unit)
SELECT unit, avg_members, max_members, min_members, std_members, total_members, avg_leak_rate,
       max_leak_rate, n_periods, max_members - min_members AS range_members,
       std_members / (avg_members + 1e-9) AS cv_members, 1 - avg_leak_rate / 100.0 AS retention_rate,
       CASE WHEN n_periods > 1 THEN (last_members - first_members) / (n_periods - 1) END AS avg_variation,
       (last_members - first_members) / (first_members + 1e-9) * 100.0 AS trend_pct
FROM a""")
def unit_profile(spark, sf_dir):
    """Per-unit profile (mean/max/min/std/sum, range, cv, trend)."""
    return D.unit_profile(load_panel(spark, sf_dir))


@query("cluster_name", sql=f"""
WITH {PANEL_CTE},
a AS (
  SELECT unit, AVG(members) AS m, STDDEV_SAMP(members) AS s, COUNT(*) AS n,
         CAST(arg_min(members, period) AS DOUBLE) AS f, CAST(arg_max(members, period) AS DOUBLE) AS l
  FROM panel GROUP BY unit),
b AS (SELECT unit, CASE WHEN n > 1 THEN (l - f) / (n - 1) END AS v, s / (m + 1e-9) AS cv FROM a)
SELECT unit,
  concat_ws(' / ', CASE WHEN v < -10 THEN 'declining' WHEN v < -5 THEN 'eroding' ELSE 'stable' END,
                   CASE WHEN cv > 0.5 THEN 'volatile' WHEN cv > 0.3 THEN 'variable' ELSE 'steady' END) AS profile_name
FROM b""")
def cluster_name(spark, sf_dir):
    """Profile name from mean variation x coefficient of variation."""
    up = D.unit_profile(load_panel(spark, sf_dir))
    return up.select("unit", S.cluster_name("avg_variation", "cv_members").alias("profile_name"))


_TC_FEATS = ["members_lag1", "leak_rate_lag1", "growth_rate_lag1", "delta_members_lag1",
             "avg_members_unite_past", "season_index", "retention_rate", "members_x_retention"]


@query("target_correlation", doubles=("corr",), sql=f"""
WITH {FEATURES_CTE}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(members AS DOUBLE)) AS corr FROM features"
    for c in _TC_FEATS))
def target_correlation(spark, sf_dir):
    """Correlation of every lag feature with the target."""
    f = W.build_features(load_panel(spark, sf_dir))
    return D.target_correlation(f, _TC_FEATS, "members")


_MET_DOUBLES = ("mae", "mse", "rmse", "mape", "r2")


def _metrics_sql(y="y", p="pred"):
    e = f"(CAST({y} AS DOUBLE) - CAST({p} AS DOUBLE))"
    return (f"COUNT(*) AS n, AVG(abs({e})) AS mae, AVG({e} * {e}) AS mse, sqrt(AVG({e} * {e})) AS rmse, "
            f"AVG(abs({e}) / greatest(abs(CAST({y} AS DOUBLE) + 1e-9), 2.220446049250313e-16)) * 100.0 AS mape, "
            f"CASE WHEN COUNT(*) > 1 THEN 1 - AVG({e} * {e}) / NULLIF(var_pop(CAST({y} AS DOUBLE)), 0.0) END AS r2")


_NAIVE_BT_CTE = PANEL_CTE + """,
bt AS (
  SELECT unit, period, CAST(members AS DOUBLE) AS y,
         CAST(LAG(members) OVER (PARTITION BY unit ORDER BY period) AS DOUBLE) AS pred
  FROM panel),
bt_naive AS (SELECT * FROM bt WHERE pred IS NOT NULL)"""


@query("metrics_grouping_sets", doubles=_MET_DOUBLES, sql=f"""
WITH {_NAIVE_BT_CTE}
SELECT CASE WHEN GROUPING(unit) = 1 THEN 'ALL' ELSE CAST(unit AS VARCHAR) END AS scope, {_metrics_sql()}
FROM bt_naive GROUP BY GROUPING SETS ((unit), ())""")
def metrics_grouping_sets(spark, sf_dir):
    """D9 + I7: naive-backtest error metrics per unit and overall."""
    bt = TS.backtest(load_panel(spark, sf_dir), model="naive")
    return D.grouped_metrics(bt, "y", "pred", "unit")


@query("regression_metrics", doubles=_MET_DOUBLES, sql=f"""
WITH {_NAIVE_BT_CTE}
SELECT {_metrics_sql()} FROM bt_naive""")
def regression_metrics(spark, sf_dir):
    """I7 (Q9): pooled metrics of the naive last-value backtest."""
    bt = TS.backtest(load_panel(spark, sf_dir), model="naive")
    return M.regression_metrics(bt, "y", "pred")


@query("value_counts", doubles=("share",), sql=f"""
WITH {PANEL_CTE}
SELECT CAST(leak_rate > 30 AS INTEGER) AS dropout_risk, COUNT(*) AS n,
       COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS share
FROM panel GROUP BY 1""")
def value_counts(spark, sf_dir):
    """Class balance of the dropout label."""
    return D.value_counts(B.dropout_risk(load_panel(spark, sf_dir)), "dropout_risk")


@query("describe", doubles=("mean", "std", "min", "p25", "p50", "p75", "max"), sql=f"""
WITH {PANEL_CTE}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, AVG({c}) AS mean, STDDEV_SAMP({c}) AS std, "
    f"CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
    f"quantile_cont({c}, 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM panel"
    for c in ["members", "members_prev", "retained", "leak_rate"]))
def describe(spark, sf_dir):
    """Count, mean, std, min, quartiles, max of the panel columns."""
    return D.describe(load_panel(spark, sf_dir), ["members", "members_prev", "retained", "leak_rate"])


@query("history_mean", doubles=("history_mean", "first_leak"), sql=f"""
WITH {PANEL_CTE}
SELECT unit, AVG(members) AS history_mean, arg_min(leak_rate, period) AS first_leak FROM panel GROUP BY unit""")
def history_mean(spark, sf_dir):
    """D17 + D13: history mean and first value per unit."""
    p = load_panel(spark, sf_dir)
    return D.history_mean(p).join(
        D.first_by(p, "unit", "leak_rate", "period").withColumnRenamed("leak_rate", "first_leak"), "unit")


@query("crosstab", sql=f"""
WITH {PANEL_CTE}
SELECT period, COUNT(*) FILTER (WHERE leak_rate <= 30) AS dropout_0,
       COUNT(*) FILTER (WHERE leak_rate > 30) AS dropout_1
FROM panel GROUP BY period""")
def crosstab(spark, sf_dir):
    """Period x dropout label contingency table (fixed pivot values)."""
    p = B.dropout_risk(load_panel(spark, sf_dir))
    ct = D.crosstab(p, "period", "dropout_risk", [0, 1])
    return ct.select("period", F.col("0").cast("bigint").alias("dropout_0"),
                     F.col("1").cast("bigint").alias("dropout_1"))


@query("unit_history", sql=f"""
WITH {PANEL_CTE}
SELECT unit, list({{'period': period, 'members': members, 'leak_rate': leak_rate}} ORDER BY period) AS history
FROM panel GROUP BY unit""")
def unit_history(spark, sf_dir):
    """Nested, ordered history per unit."""
    return D.unit_history(load_panel(spark, sf_dir))


@query("alert_message", sql=f"""
WITH {PANEL_CTE},
l AS (SELECT unit FROM panel WHERE leak_rate > 30 AND period = (SELECT MAX(period) FROM panel))
SELECT COUNT(*) AS n_flagged,
       'units at risk: ' || COALESCE(string_agg(CAST(unit AS VARCHAR), ', ' ORDER BY unit), '') AS message
FROM l""")
def alert_message(spark, sf_dir):
    """Sorted list of units flagged in the latest period as one message."""
    p = B.dropout_risk(load_panel(spark, sf_dir))
    last = p.where(F.col("period") == p.select(F.max("period")).scalar())
    return D.alert_message(last, "unit", "dropout_risk")


@query("total_variation", doubles=("diff", "pct_change"), sql=f"""
WITH {PANEL_CTE},
t AS (SELECT period, CAST(SUM(members) AS BIGINT) AS total_members FROM panel GROUP BY period)
SELECT period, total_members,
       total_members - CAST(LAG(total_members) OVER (ORDER BY period) AS DOUBLE) AS diff,
       (total_members / NULLIF(CAST(LAG(total_members) OVER (ORDER BY period) AS DOUBLE), 0.0) - 1) * 100.0 AS pct_change
FROM t""")
def total_variation(spark, sf_dir):
    """D1 + E10: total members per period and its change."""
    return W.total_variation(load_panel(spark, sf_dir))


@query("kpis", doubles=("variation_pct",), sql=f"""
WITH {PANEL_CTE},
mx AS (SELECT MAX(period) AS p FROM panel)
SELECT CAST(SUM(members) FILTER (WHERE period = p) AS BIGINT) AS members_latest,
       CAST(SUM(members) FILTER (WHERE period = p - 1) AS BIGINT) AS members_previous,
       (SUM(members) FILTER (WHERE period = p) - SUM(members) FILTER (WHERE period = p - 1))
         * 100.0 / NULLIF(CAST(SUM(members) FILTER (WHERE period = p - 1) AS DOUBLE), 0.0) AS variation_pct,
       COUNT(*) FILTER (WHERE period = p AND leak_rate > 30) AS units_at_risk,
       COUNT(DISTINCT unit) AS n_units
FROM panel, mx""")
def kpis(spark, sf_dir):
    """Latest-period totals, % variation, flagged count."""
    p = load_panel(spark, sf_dir)
    j = S.with_scalars(p, p.agg(F.max("period").alias("p")))
    cur = F.col("period") == F.col("_s.p")
    prv = F.col("period") == F.col("_s.p") - 1
    a = j.agg(F.sum(F.when(cur, F.col("members"))).cast("bigint").alias("members_latest"),
              F.sum(F.when(prv, F.col("members"))).cast("bigint").alias("members_previous"),
              F.count_if(cur & (F.col("leak_rate") > 30)).alias("units_at_risk"),
              F.count_distinct("unit").alias("n_units"))
    return a.select("members_latest", "members_previous",
                    ((F.col("members_latest") - F.col("members_previous")) * 100.0
                     / F.nullif(F.col("members_previous").cast("double"), F.lit(0.0))).alias("variation_pct"),
                    "units_at_risk", "n_units")


# ----------------------------------------------------------------------------- E

@query("last_two", sql=f"""
WITH {PANEL_CTE},
r AS (SELECT unit, period, members, ROW_NUMBER() OVER (PARTITION BY unit ORDER BY period DESC) AS rn FROM panel)
SELECT unit, MAX(period) FILTER (WHERE rn = 1) AS last_period, MAX(members) FILTER (WHERE rn = 1) AS last_value,
       COALESCE(MAX(members) FILTER (WHERE rn = 2), MAX(members) FILTER (WHERE rn = 1)) AS prev_value
FROM r WHERE rn <= 2 GROUP BY unit""")
def last_two(spark, sf_dir):
    """Last and second-last value per unit."""
    return W.last_two(load_panel(spark, sf_dir))


_NPF_DOUBLES = ("members_lag1", "leak_rate_lag1", "growth_rate_lag1", "delta_members_lag1",
                "avg_members_unite_past", "retention_rate", "members_x_retention")


NEXT_PERIOD_CTE = """
a AS (SELECT unit, MAX(period) AS lp, CAST(arg_max(members, period) AS DOUBLE) AS m_last,
             arg_max(leak_rate, period) AS leak_last, AVG(members) AS avg_members_unite_past, COUNT(*) AS n
      FROM panel GROUP BY unit),
r AS (SELECT unit, members, ROW_NUMBER() OVER (PARTITION BY unit ORDER BY period DESC) AS rn FROM panel),
p AS (SELECT unit, CAST(members AS DOUBLE) AS m_prev FROM r WHERE rn = 2),
j AS (SELECT a.*, COALESCE(p.m_prev, a.m_last) AS mp FROM a LEFT JOIN p ON a.unit = p.unit),
npf AS (SELECT unit, lp + 1 AS period, m_last AS members_lag1, leak_last AS leak_rate_lag1,
       CASE WHEN mp > 0 THEN (m_last - mp) / mp * 100.0 ELSE 0.0 END AS growth_rate_lag1,
       m_last - mp AS delta_members_lag1, avg_members_unite_past,
       CAST(n + 1 AS INTEGER) AS season_index,
       1 - leak_last / 100.0 AS retention_rate, m_last * (1 - leak_last / 100.0) AS members_x_retention
FROM j)"""


@query("next_period_features", doubles=_NPF_DOUBLES, sql=f"""
WITH {PANEL_CTE},{NEXT_PERIOD_CTE}
SELECT * FROM npf""")
def next_period_features(spark, sf_dir):
    """Feature row for the next period of every unit."""
    return W.next_period_features(load_panel(spark, sf_dir))


@query("past_mean", doubles=("past_mean_null", "past_mean_self", "past_mean_zero", "deviation_from_avg"), sql=f"""
WITH {PANEL_CTE},
m AS (SELECT unit, period, members,
             AVG(members) OVER (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
      FROM panel)
SELECT unit, period, pm AS past_mean_null, COALESCE(pm, CAST(members AS DOUBLE)) AS past_mean_self,
       COALESCE(pm, 0.0) AS past_mean_zero, members - pm AS deviation_from_avg
FROM m""")
def past_mean(spark, sf_dir):
    """E5 / E7 (Q2 policies): expanding mean of strictly earlier periods."""
    p = load_panel(spark, sf_dir)
    w = W.unit_window()
    return p.select("unit", "period",
                    W.past_mean("members", w, "null").alias("past_mean_null"),
                    W.past_mean("members", w, "self").alias("past_mean_self"),
                    W.past_mean("members", w, "zero").alias("past_mean_zero"),
                    (F.col("members") - W.past_mean("members", w, "null")).alias("deviation_from_avg"))


@query("lagged_growth", doubles=("growth_rate_lag1", "delta_members_lag1"), sql=f"""
WITH {PANEL_CTE},
g AS (SELECT unit, period,
             (CAST(members AS DOUBLE) - CAST(LAG(members) OVER w AS DOUBLE)) / NULLIF(CAST(LAG(members) OVER w AS DOUBLE), 0.0) * 100.0 AS g,
             CAST(members AS DOUBLE) - CAST(LAG(members) OVER w AS DOUBLE) AS d
      FROM panel WINDOW w AS (PARTITION BY unit ORDER BY period))
SELECT unit, period, LAG(g) OVER (ORDER BY unit, period) AS growth_rate_lag1,
       LAG(d) OVER (ORDER BY unit, period) AS delta_members_lag1
FROM g""")
def lagged_growth(spark, sf_dir):
    """E4 with carry='global' (Q1 parity): the ungrouped shift, where a unit's
    first period takes the previous unit's last growth (oracle: a global LAG)."""
    p = load_panel(spark, sf_dir)
    return W.lagged_growth(p, carry="global").select("unit", "period", "growth_rate_lag1",
                                                     "delta_members_lag1")


@query("diff_pct", doubles=("diff", "pct_change", "cumsum"), sql=f"""
WITH {PANEL_CTE}
SELECT unit, period, CAST(members - LAG(members) OVER w AS DOUBLE) AS diff,
       members / NULLIF(CAST(LAG(members) OVER w AS DOUBLE), 0.0) - 1 AS pct_change,
       CAST(SUM(members) OVER (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumsum
FROM panel WINDOW w AS (PARTITION BY unit ORDER BY period)""")
def diff_pct(spark, sf_dir):
    """First difference, percent change, running sum."""
    p = load_panel(spark, sf_dir)
    w = W.unit_window()
    return p.select("unit", "period", W.diff("members", w).cast("double").alias("diff"),
                    W.pct_change("members", w).alias("pct_change"),
                    W.cumsum("members", w).cast("double").alias("cumsum"))


# ----------------------------------------------------------------------------- F / G

@query("top_k", doubles=("leak_rate",), sql=f"""
WITH {PANEL_CTE}
SELECT unit, period, leak_rate FROM panel ORDER BY leak_rate DESC, unit, period LIMIT 10""")
def top_k(spark, sf_dir):
    """the ten highest leak rates (the limit is the feature)."""
    p = load_panel(spark, sf_dir).select("unit", "period", "leak_rate")
    return p.orderBy(F.col("leak_rate").desc(), "unit", "period").limit(10)


_FC_CTE = PANEL_CTE + """,
m AS (SELECT unit, period, CAST(members AS DOUBLE) AS y FROM panel),
a AS (SELECT unit, MAX(period) AS lp, arg_max(y, period) AS y_last, arg_min(y, period) AS y_first,
             AVG(y) AS y_mean, COUNT(*) AS n FROM m GROUP BY unit),
fc AS (
  SELECT unit, 'naive' AS model, y_last AS forecast FROM a
  UNION ALL SELECT unit, 'mean', y_mean FROM a
  UNION ALL SELECT unit, 'drift', CASE WHEN n > 1 THEN y_last + (y_last - y_first) / (n - 1) ELSE y_last END FROM a)"""


def _forecasts_long(p):
    a = p.groupBy("unit").agg(F.max_by(F.col("members").cast("double"), "period").alias("y_last"),
                              F.min_by(F.col("members").cast("double"), "period").alias("y_first"),
                              F.avg("members").alias("y_mean"), F.count(F.lit(1)).alias("n"))
    drift = F.when(F.col("n") > 1, F.col("y_last") + (F.col("y_last") - F.col("y_first")) / (F.col("n") - 1)) \
             .otherwise(F.col("y_last"))
    return D.compare(a.select("unit", F.lit("naive").alias("model"), F.col("y_last").alias("forecast")),
                     a.select("unit", F.lit("mean").alias("model"), F.col("y_mean").alias("forecast")),
                     a.select("unit", F.lit("drift").alias("model"), drift.alias("forecast")))


@query("forecast_pivot", doubles=("naive", "mean", "drift"), sql=f"""
WITH {_FC_CTE}
SELECT unit, MAX(forecast) FILTER (WHERE model = 'naive') AS naive,
       MAX(forecast) FILTER (WHERE model = 'mean') AS mean,
       MAX(forecast) FILTER (WHERE model = 'drift') AS drift
FROM fc GROUP BY unit""")
def forecast_pivot(spark, sf_dir):
    """G1 + G2: per-model forecasts unioned, then pivoted to one column each."""
    return D.forecast_table(_forecasts_long(load_panel(spark, sf_dir)), ["naive", "mean", "drift"])


@query("best_model", doubles=("mae",), sql=f"""
WITH {PANEL_CTE},
m AS (SELECT unit, period, CAST(members AS DOUBLE) AS y FROM panel),
bt AS (
  SELECT unit, 'naive' AS model, y, LAG(y) OVER w AS pred FROM m WINDOW w AS (PARTITION BY unit ORDER BY period)
  UNION ALL
  SELECT unit, 'mean', y, AVG(y) OVER (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) FROM m
  UNION ALL
  SELECT unit, 'drift', y,
         CASE WHEN COUNT(y) OVER p >= 2
              THEN LAG(y) OVER w + (LAG(y) OVER w - FIRST_VALUE(y) OVER p) / (COUNT(y) OVER p - 1)
              ELSE LAG(y) OVER w END
  FROM m WINDOW w AS (PARTITION BY unit ORDER BY period),
                p AS (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT unit, model, AVG(abs(y - pred)) AS mae FROM bt WHERE pred IS NOT NULL GROUP BY unit, model),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY unit ORDER BY mae, model) AS rn FROM e)
SELECT unit, model, mae FROM r WHERE rn = 1""")
def best_model(spark, sf_dir):
    """E13 + D14: expanding-origin backtest of three models, best MAE per unit."""
    p = load_panel(spark, sf_dir)
    bt = D.compare(*[TS.backtest(p, model=m) for m in ("naive", "mean", "drift")])
    e = bt.groupBy("unit", "model").agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae"))
    return D.best_by(e, "mae", "min", "model", by=["unit"]).select("unit", "model", "mae")


# ----------------------------------------------------------------------------- I

@query("adf_stat", doubles=("adf_stat", "crit_5pct"), sql=f"""
WITH {PANEL_CTE},
d AS (SELECT unit, CAST(members AS DOUBLE) - CAST(LAG(members) OVER w AS DOUBLE) AS dy,
             CAST(LAG(members) OVER w AS DOUBLE) AS ylag
      FROM panel WINDOW w AS (PARTITION BY unit ORDER BY period)),
a AS (SELECT unit, regr_count(dy, ylag) AS n, regr_sxx(dy, ylag) AS sxx, regr_sxy(dy, ylag) AS sxy,
             regr_syy(dy, ylag) AS syy FROM d WHERE ylag IS NOT NULL GROUP BY unit),
b AS (SELECT *, syy - sxy * sxy / sxx AS ssr, CAST(n AS DOUBLE) AS nd FROM a),
c AS (SELECT unit, CAST(n AS BIGINT) AS n, n >= 4 AND sxx > 0 AND ssr > 0 AS ok,
             (sxy / sxx) / sqrt(ssr / (n - 2) / sxx) AS tau,
             -2.86154 + -2.8903 / nd + -4.234 / (nd * nd) + -40.04 / (nd * nd * nd) AS crit FROM b)
SELECT unit, n, CASE WHEN ok THEN tau END AS adf_stat, CASE WHEN ok THEN crit END AS crit_5pct,
       CASE WHEN NOT ok THEN 'undetermined' WHEN tau < crit THEN 'stationary' ELSE 'non-stationary' END AS conclusion
FROM c""")
def adf_stat(spark, sf_dir):
    """Dickey-Fuller tau per unit series."""
    return TS.adf(load_panel(spark, sf_dir))


@query("kpss_stat", doubles=("kpss_stat",), sql=f"""
WITH {PANEL_CTE},
e AS (SELECT unit, period, members - AVG(members) OVER (PARTITION BY unit) AS e FROM panel),
s AS (SELECT unit, e, SUM(e) OVER (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM e),
a AS (SELECT unit, COUNT(*) AS n, SUM(s * s) AS ss, SUM(e * e) AS ee FROM s GROUP BY unit),
b AS (SELECT unit, n, n >= 3 AND ee > 0 AS ok, ss / (CAST(n AS DOUBLE) * n * (ee / n)) AS st FROM a)
SELECT unit, CAST(n AS BIGINT) AS n, CASE WHEN ok THEN st END AS kpss_stat,
       CASE WHEN NOT ok THEN 'undetermined' WHEN st <= 0.463 THEN 'stationary' ELSE 'non-stationary' END AS conclusion
FROM b""")
def kpss_stat(spark, sf_dir):
    """KPSS level statistic per unit series."""
    return TS.kpss(load_panel(spark, sf_dir))


@query("decompose", doubles=("y", "trend", "seasonal", "resid"), sql=f"""
WITH {PANEL_CTE},
b AS (SELECT unit, period, CAST(members AS DOUBLE) AS y,
             CASE WHEN COUNT(members) OVER f = 3 THEN AVG(members) OVER f END AS trend,
             (ROW_NUMBER() OVER w - 1) % 3 AS phase
      FROM panel WINDOW w AS (PARTITION BY unit ORDER BY period),
                        f AS (PARTITION BY unit ORDER BY period ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
ph AS (SELECT unit, phase, AVG(y - trend) AS pm FROM b WHERE trend IS NOT NULL GROUP BY unit, phase),
ph2 AS (SELECT unit, phase, pm - AVG(pm) OVER (PARTITION BY unit) AS seasonal FROM ph)
SELECT b.unit, b.period, b.y, b.trend, COALESCE(ph2.seasonal, 0.0) AS seasonal,
       b.y - b.trend - COALESCE(ph2.seasonal, 0.0) AS resid
FROM b LEFT JOIN ph2 ON b.unit = ph2.unit AND b.phase = ph2.phase""")
def decompose(spark, sf_dir):
    """Additive decomposition with period 3 (centred MA + phase means)."""
    return TS.decompose(load_panel(spark, sf_dir), 3)


@query("ar1_forecast", doubles=("phi", "forecast"), sql=f"""
WITH {PANEL_CTE},
x AS (SELECT unit, period, CAST(members AS DOUBLE) AS y,
             CAST(members AS DOUBLE) - CAST(LAG(members) OVER w AS DOUBLE) AS d
      FROM panel WINDOW w AS (PARTITION BY unit ORDER BY period)),
x1 AS (SELECT *, LAG(d) OVER (PARTITION BY unit ORDER BY period) AS d1 FROM x),
a AS (SELECT unit, MAX(period) AS lp, arg_max(y, period) AS y_last, arg_max(d, period) AS d_last,
             SUM(d * d1) AS sxy, SUM(d1 * d1) AS sxx FROM x1 GROUP BY unit),
b AS (SELECT *, CASE WHEN sxx > 0 THEN sxy / sxx END AS phi FROM a)
SELECT unit, lp + 1 AS period, phi, COALESCE(GREATEST(y_last + phi * d_last, 0.0), y_last) AS forecast,
       CASE WHEN phi IS NULL THEN 'naive' ELSE 'ar1' END AS method
FROM b""")
def ar1_forecast(spark, sf_dir):
    """I4: ARIMA(1,1,0) by conditional least squares, naive fallback."""
    return TS.ar1_forecast(load_panel(spark, sf_dir))


@query("naive_backtest", doubles=("y", "pred", "forecast"), sql=f"""
WITH {_NAIVE_BT_CTE},
f AS (SELECT unit, MAX(period) + 1 AS fp, CAST(arg_max(members, period) AS DOUBLE) AS forecast FROM panel GROUP BY unit)
SELECT b.unit, b.period, b.y, b.pred, f.forecast FROM bt_naive b JOIN f ON b.unit = f.unit""")
def naive_backtest(spark, sf_dir):
    """I5 (Q9): naive backtest rows with each unit's next-period forecast."""
    p = load_panel(spark, sf_dir)
    bt = TS.backtest(p, model="naive").select("unit", "period", "y", "pred")
    return bt.join(TS.naive_forecast(p).select("unit", "forecast"), "unit")


@query("ar1_backtest", doubles=("y", "pred"), sql=f"""
WITH {PANEL_CTE},
a AS (SELECT unit, period, CAST(members AS DOUBLE) AS y, LAG(CAST(members AS DOUBLE)) OVER (PARTITION BY unit ORDER BY period) AS prev FROM panel),
b AS (SELECT *, y - prev AS d FROM a),
c AS (SELECT *, LAG(d) OVER (PARTITION BY unit ORDER BY period) AS d1 FROM b),
e AS (SELECT *, SUM(d * d1) OVER w / NULLIF(SUM(CASE WHEN d IS NOT NULL THEN d1 * d1 END) OVER w, 0) AS phi FROM c
      WINDOW w AS (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT unit, period, y, CASE WHEN phi IS NOT NULL THEN GREATEST(0.0, prev + phi * d1) ELSE prev END AS pred FROM e WHERE prev IS NOT NULL""")
def ar1_backtest(spark, sf_dir):
    """Rolling-origin AR(1) backtest of every unit."""
    return TS.backtest(load_panel(spark, sf_dir), model="ar1").select("unit", "period", "y", "pred")


@query("residual_hist", doubles=("bin_lo", "bin_hi"), sql=f"""
WITH {_NAIVE_BT_CTE},
r AS (SELECT y - pred AS e FROM bt_naive),
mm AS (SELECT MIN(e) AS lo, MAX(e) AS hi FROM r),
b AS (SELECT COALESCE(LEAST(FLOOR((e - lo) / NULLIF(hi - lo, 0.0) * 8) + 1, 8), 1) AS bin, lo, hi FROM r, mm)
SELECT CAST(bin AS INTEGER) AS bin, lo + (bin - 1) * ((hi - lo) / 8) AS bin_lo, lo + bin * ((hi - lo) / 8) AS bin_hi,
       COUNT(*) AS n
FROM b GROUP BY bin, lo, hi""")
def residual_hist(spark, sf_dir):
    """8-bin histogram of naive-backtest residuals."""
    bt = TS.backtest(load_panel(spark, sf_dir), model="naive")
    return TS.histogram(bt.select((F.col("y") - F.col("pred")).alias("e")), "e", 8)


@query("residual_diagnostics", doubles=("skewness", "kurtosis", "jarque_bera", "corr_pred_resid", "t_stat"), sql=f"""
WITH {_NAIVE_BT_CTE},
r AS (SELECT pred, y - pred AS e FROM bt_naive),
c AS (SELECT pred, e, e - AVG(e) OVER () AS dv FROM r),
a AS (SELECT COUNT(*) AS n, AVG(dv * dv * dv) / pow(AVG(dv * dv), 1.5) AS sk,
             AVG(dv * dv * dv * dv) / (AVG(dv * dv) * AVG(dv * dv)) - 3 AS ku, corr(pred, e) AS rho FROM c)
SELECT n, sk AS skewness, ku AS kurtosis, n / 6.0 * (sk * sk + ku * ku / 4.0) AS jarque_bera,
       rho AS corr_pred_resid, rho * sqrt((n - 2) / (1 - rho * rho)) AS t_stat
FROM a""")
def residual_diagnostics(spark, sf_dir):
    """Normality (Jarque-Bera from skewness / excess kurtosis) and
    homoscedasticity proxy (corr(pred, residual) with its t statistic)."""
    bt = TS.backtest(load_panel(spark, sf_dir), model="naive")
    r = bt.select("pred", (F.col("y") - F.col("pred")).alias("e"))
    a = r.agg(F.count(F.lit(1)).alias("n"), F.skewness("e").alias("sk"), F.kurtosis("e").alias("ku"),
              F.corr("pred", "e").alias("rho"))
    return a.select("n", F.col("sk").alias("skewness"), F.col("ku").alias("kurtosis"),
                    (F.col("n") / 6.0 * (F.col("sk") ** 2 + F.col("ku") ** 2 / 4.0)).alias("jarque_bera"),
                    F.col("rho").alias("corr_pred_resid"),
                    (F.col("rho") * F.sqrt((F.col("n") - 2) / F.nullif(1 - F.col("rho") ** 2, F.lit(0.0))))
                    .alias("t_stat"))
