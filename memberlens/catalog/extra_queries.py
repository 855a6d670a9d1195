"""Remaining A, C, D, F, G, I, J queries: sources/sinks, report joins,
profiles, alert union, forecast actions, Q-Q points, clustering search."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregates as D
from ..operators import cleaning as B
from ..operators import ml as ML
from ..operators import monitoring as L
from ..operators import timeseries as TS
from ..operators.ranks import global_row_number
from ..operators import windows as W
from ..plans.panel import load_panel, load_requests
from ..session import cut_lineage
from ..sources import tables as A
from . import ledger_queries as LQ
from . import monitoring_queries as MQ
from .analytics_queries import _FC_CTE, _forecasts_long
from .registry import query
from .sqlparts import FEATURES_CTE, PANEL_CTE, REQUESTS_CTE, sig_sql

# ----------------------------------------------------------------------------- A

_SPLIT_SQL = f"WITH {PANEL_CTE}\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS task, COUNT(*) AS n_rows, '{','.join(c)}' AS columns FROM panel"
    for t, c in B.FEATURE_SETS.items())


@query("split_datasets", sql=_SPLIT_SQL)
def split_datasets(spark, sf_dir):
    """A4 + B16: one cleaned panel fanned out to four task datasets (one
    cached scan, leakage-guarded column lists)."""
    p = B.dropout_risk(load_panel(spark, sf_dir))
    parts = [df.agg(F.lit(t).alias("task"), F.count(F.lit(1)).alias("n_rows"),
                    F.lit(",".join(df.columns)).alias("columns")) for t, df in A.split_datasets(p).items()]
    return D.compare(*parts)


@query("records_export", sql=f"""
WITH {PANEL_CTE}
SELECT to_json({{'unit': unit, 'period': period, 'members': members, 'leak_rate': leak_rate}}) AS record
FROM panel""")
def records_export(spark, sf_dir):
    """One JSON object per row."""
    p = load_panel(spark, sf_dir).select("unit", "period", "members", "leak_rate")
    return A.to_records(p)


_PROFILE_COLS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


@query("table_profile", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CASE WHEN '{t}' LIKE 'dim\\_%' ESCAPE '\\' THEN 'dimension' "
    f"WHEN '{t}' LIKE 'fact\\_%' ESCAPE '\\' THEN 'fact' ELSE 'other' END AS kind, COUNT(*) AS n_rows, "
    f"CAST({len(c)} AS BIGINT) AS n_columns, '{','.join(c)}' AS columns FROM {t}"
    for t, c in _PROFILE_COLS.items()))
def table_profile(spark, sf_dir):
    """Kind by name prefix, row count and column list per table."""
    return A.profile_tables(spark, sf_dir, list(_PROFILE_COLS))


def _fingerprint_sql(t: str, cols) -> str:
    row = " || ',' || ".join(f"CASE WHEN {c} IS NULL THEN 'n' ELSE 'v' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in cols)
    return (f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, CAST(SUM(CAST(CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT) AS HUGEINT)) "
            f"% 2305843009213693951 AS BIGINT) AS content_hash FROM {t}")


_FINGERPRINTS = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus"], "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"],
                 "events": ["event_id", "user_id", "event_type", "props"]}


@query("fingerprint", sql="\nUNION ALL\n".join(_fingerprint_sql(t, c) for t, c in _FINGERPRINTS.items()))
def fingerprint(spark, sf_dir):
    """Order-insensitive content fingerprints of the fact tables' keys and codes."""
    parts = [A.fingerprint(A.read_table(spark, sf_dir, t).select(*c)).select(F.lit(t).alias("table_name"), "*")
             for t, c in _FINGERPRINTS.items()]
    return D.compare(*parts)


@query("fingerprint_all")
def fingerprint_all(spark, sf_dir):
    """Order-insensitive content fingerprints of the fact tables, every column."""
    parts = [A.fingerprint(A.read_table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "*") for t in _FINGERPRINTS]
    return D.compare(*parts)


@query("parse_requests", doubles=("members_lag1", "leak_rate_lag1"), sql=f"""
WITH {PANEL_CTE},
snap AS (SELECT unit, CAST(arg_max(members, period) AS DOUBLE) AS m_last, arg_max(leak_rate, period) AS leak_last
         FROM panel GROUP BY unit)
SELECT unit AS fk_type_unite, CASE WHEN unit % 2 = 1 THEN 'override' ELSE 'default' END AS type,
       CASE WHEN unit % 2 = 1 THEN m_last + 1 ELSE m_last END AS members_lag1, leak_last AS leak_rate_lag1
FROM snap""")
def parse_requests(spark, sf_dir):
    """A11 + C7: JSON prediction requests with optional fields (odd units
    override members_lag1) parsed with from_json; missing fields default to
    the unit's latest snapshot (one row per unit, joined by key)."""
    p = load_panel(spark, sf_dir)
    snap = p.groupBy("unit").agg(F.max_by(F.col("members").cast("double"), "period").alias("m_last"),
                                 F.max_by("leak_rate", "period").alias("leak_last"))
    odd = F.col("unit") % 2 == 1
    req = snap.select(F.to_json(F.struct(
        F.when(odd, F.lit("override")).otherwise(F.lit("default")).alias("type"),
        F.col("unit").alias("fk_type_unite"),
        F.when(odd, F.col("m_last") + 1).alias("members_lag1"))).alias("body"))
    schema = "type string, fk_type_unite int, members_lag1 double, leak_rate_lag1 double"
    parsed = req.select(F.from_json("body", schema).alias("r")).select("r.*")
    j = parsed.join(snap.withColumnRenamed("unit", "fk_type_unite"), "fk_type_unite", "left")
    return j.select("fk_type_unite", "type", F.coalesce("members_lag1", "m_last").alias("members_lag1"),
                    F.coalesce("leak_rate_lag1", "leak_last").alias("leak_rate_lag1"))


# ----------------------------------------------------------------------------- C

@query("forecast_report", doubles=("forecast",), sql=f"""
WITH {_FC_CTE},
drop_last AS (SELECT unit, arg_max(CAST(leak_rate > 30 AS INTEGER), period) AS dropout_pred FROM panel GROUP BY unit),
f AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY unit ORDER BY model) AS rn FROM fc WHERE model = 'drift') WHERE rn = 1)
SELECT f.unit, f.forecast, COALESCE(d.dropout_pred, 0) AS dropout_pred
FROM f LEFT JOIN drop_last d ON f.unit = d.unit""")
def forecast_report(spark, sf_dir):
    """Forecast table x dropout flag by unit, first match, default 0."""
    p = load_panel(spark, sf_dir)
    fc = _forecasts_long(p).where(F.col("model") == "drift")
    fc = fc.withColumn("_rn", F.row_number().over(Window.partitionBy("unit").orderBy("model"))).where("_rn = 1")
    dp = p.groupBy("unit").agg(F.max_by((F.col("leak_rate") > 30).cast("int"), "period").alias("dropout_pred"))
    return fc.join(dp, "unit", "left").select("unit", "forecast", F.coalesce("dropout_pred", F.lit(0)).alias("dropout_pred"))


@query("unit_scoreboard", sql=f"""
WITH {_FC_CTE},
hist AS (SELECT unit, CAST(arg_max(members, period) AS BIGINT) AS members_last, COUNT(*) AS n_periods FROM panel GROUP BY unit),
an AS (SELECT unit, COUNT(*) FILTER (WHERE leak_rate > 30) AS n_flags FROM panel GROUP BY unit),
piv AS (SELECT unit, MAX(forecast) FILTER (WHERE model = 'naive') AS naive, MAX(forecast) FILTER (WHERE model = 'mean') AS mean,
               MAX(forecast) FILTER (WHERE model = 'drift') AS drift FROM fc GROUP BY unit)
SELECT n.n_nationkey AS unit, n.n_name, h.members_last, h.n_periods,
       COALESCE(printf('%.1f', p.naive), '-') AS naive, COALESCE(printf('%.1f', p.mean), '-') AS mean,
       COALESCE(printf('%.1f', p.drift), '-') AS drift, COALESCE(CAST(a.n_flags AS VARCHAR), '-') AS n_flags
FROM nation n LEFT JOIN hist h ON n.n_nationkey = h.unit LEFT JOIN piv p ON n.n_nationkey = p.unit
LEFT JOIN an a ON n.n_nationkey = a.unit""")
def unit_scoreboard(spark, sf_dir):
    """Every unit (nation dimension) with its history, three forecasts
    and flag count, '-' where missing (pre-aggregated inputs, one row per
    unit each)."""
    p = load_panel(spark, sf_dir)
    n = A.read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("unit"), "n_name")
    hist = p.groupBy("unit").agg(F.max_by("members", "period").cast("bigint").alias("members_last"),
                                 F.count(F.lit(1)).alias("n_periods"))
    an = p.groupBy("unit").agg(F.count_if(F.col("leak_rate") > 30).alias("n_flags"))
    piv = D.forecast_table(_forecasts_long(p), ["naive", "mean", "drift"])
    j = n.join(hist, "unit", "left").join(piv, "unit", "left").join(an, "unit", "left")
    fmt = [F.coalesce(F.format_string("%.1f", F.col(m)), F.lit("-")).alias(m) for m in ("naive", "mean", "drift")]
    return j.select("unit", "n_name", "members_last", "n_periods", *fmt,
                    F.coalesce(F.col("n_flags").cast("string"), F.lit("-")).alias("n_flags"))


# ----------------------------------------------------------------------------- D / F

@query("cluster_profile", doubles=("members", "leak_rate", "retained", "members_prev"), sql=f"""
WITH {PANEL_CTE}
SELECT CAST(leak_rate > 30 AS INTEGER) AS dropout_risk, ROUND(AVG(members), 2) AS members, ROUND(AVG(leak_rate), 2) AS leak_rate,
       ROUND(AVG(retained), 2) AS retained, ROUND(AVG(members_prev), 2) AS members_prev, COUNT(*) AS n
FROM panel GROUP BY 1""")
def cluster_profile(spark, sf_dir):
    """Mean profile per label (here the dropout label), rounded to 2."""
    p = B.dropout_risk(load_panel(spark, sf_dir))
    return D.cluster_profile(p, "dropout_risk", ["members", "leak_rate", "retained", "members_prev"])


@query("distinct_keys", sql=f"""
WITH {PANEL_CTE}
SELECT period, COUNT(DISTINCT unit) AS n_units FROM panel GROUP BY period""")
def distinct_keys(spark, sf_dir):
    """Distinct periods with the distinct unit count."""
    p = load_panel(spark, sf_dir)
    return D.distinct_keys(p, "period").join(p.groupBy("period").agg(F.count_distinct("unit").alias("n_units")), "period")


@query("head_row", doubles=("leak_rate",), sql=f"""
WITH {PANEL_CTE}
SELECT unit, period, members, leak_rate FROM panel ORDER BY period DESC, leak_rate DESC, unit LIMIT 1""")
def head_row(spark, sf_dir):
    """F1 + F4: multi-key sort and head (the limit is the feature)."""
    p = load_panel(spark, sf_dir).select("unit", "period", "members", "leak_rate")
    return p.orderBy(F.col("period").desc(), F.col("leak_rate").desc(), "unit").limit(1)


@query("recent_runs", sql=f"""
WITH {LQ._LEDGER_CTE}
SELECT run_id, section, start_time FROM runs""")
def recent_runs(spark, sf_dir):
    """every run, the most recent first."""
    runs = LQ.ledger_once(spark, sf_dir).select("run_id", "section", "start_time").distinct()
    return runs.orderBy(F.col("start_time").desc(), "run_id")


# ----------------------------------------------------------------------------- G3

@query("active_alerts", doubles=("value",), sql=f"""
WITH {FEATURES_CTE},{MQ._HEALTH_PARTS},{MQ._DRIFT_PARTS},
miss AS (""" + "\nUNION ALL\n".join(
    f"SELECT period, '{c}' AS feature, COUNT(*) FILTER (WHERE {c} IS NULL) / CAST(COUNT(*) AS DOUBLE) AS r FROM feat0 GROUP BY period"
    for c in MQ._MISS_FEATS) + """)
SELECT 'drift' AS source, feature AS subject, period, drift_score AS value FROM dr WHERE drift_score > 0.3
UNION ALL
SELECT 'accuracy_drop', model, period, accuracy_delta FROM deg WHERE accuracy_degradation = 1
UNION ALL
SELECT 'missing_values', feature, period, r FROM miss WHERE r > 0.10""")
def active_alerts(spark, sf_dir):
    """Union of the drift, accuracy and missing-value checks."""
    f_all = W.build_features(load_panel(spark, sf_dir), drop_first=False)
    f = f_all.where(F.col("members_lag1").isNotNull())
    dr = L.drift_score(L.feature_stats(f, MQ._DRIFT_FEATS, "period"), L.reference_frame(spark))
    dg = L.degradation(MQ._model_health(spark, sf_dir), L.baselines_frame(spark))
    ms = L.missing_ratio(f_all, MQ._MISS_FEATS, "period")
    return D.compare(
        dr.where("drift_score > 0.3").select(F.lit("drift").alias("source"), F.col("feature").alias("subject"),
                                             "period", F.col("drift_score").alias("value")),
        dg.where("accuracy_degradation = 1").select(F.lit("accuracy_drop").alias("source"),
                                                    F.col("model").alias("subject"), "period",
                                                    F.col("accuracy_delta").alias("value")),
        ms.where("missing_ratio > 0.10").select(F.lit("missing_values").alias("source"),
                                                F.col("feature").alias("subject"), "period",
                                                F.col("missing_ratio").alias("value")))


_PERIOD_END = "make_timestamp(period + 1, 1, 1, 0, 0, 0)"
_MODEL_METRICS_CTE = f"""{FEATURES_CTE},{MQ._HEALTH_PARTS},{MQ._DRIFT_PARTS},{REQUESTS_CTE},
miss AS (""" + "\nUNION ALL\n".join(
    f"SELECT period, '{c}' AS feature, COUNT(*) FILTER (WHERE {c} IS NULL) / CAST(COUNT(*) AS DOUBLE) AS r FROM feat0 GROUP BY period"
    for c in MQ._MISS_FEATS) + f"""),
trig AS (SELECT period, 'drift' AS reason FROM dr WHERE drift_score > 0.3
         UNION ALL SELECT period, 'accuracy_drop' FROM deg WHERE accuracy_degradation = 1),
hh AS (SELECT endpoint, h, LAG(h) OVER (PARTITION BY endpoint ORDER BY h) AS p
       FROM (SELECT DISTINCT endpoint, date_trunc('hour', ts) AS h FROM requests)),
down AS (SELECT endpoint, unnest(generate_series(p + INTERVAL 1 HOUR, h - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS t FROM hh WHERE h > p + INTERVAL 1 HOUR),
ml AS (
  SELECT 'accuracy_degradation' AS metric, model AS labels, {_PERIOD_END} AS eval_time, CAST(accuracy_degradation AS DOUBLE) AS value FROM deg
  UNION ALL SELECT 'accuracy_delta', model, {_PERIOD_END}, accuracy_delta FROM deg
  UNION ALL SELECT 'confidence_degradation', model, {_PERIOD_END}, confidence_degradation FROM deg
  UNION ALL SELECT 'drift_detected', feature, {_PERIOD_END}, CAST(drift_score > 0.3 AS INTEGER) FROM dr
  UNION ALL SELECT 'drift_score', feature, {_PERIOD_END}, drift_score FROM dr
  UNION ALL SELECT 'missing_ratio', feature, {_PERIOD_END}, r FROM miss
  UNION ALL SELECT 'retraining_increase', reason, {_PERIOD_END}, COUNT(*) FROM trig GROUP BY reason, period
  UNION ALL SELECT 'freshness_s', event_type, (SELECT MAX(ts) FROM events), (epoch_us((SELECT MAX(ts) FROM events)) - epoch_us(MAX(ts))) / 1e6
            FROM events GROUP BY event_type
  UNION ALL SELECT 'up', endpoint, t, 0 FROM down)"""


def model_metrics(spark, sf_dir):
    """Model, drift, data and target metrics in the rule engine's long form:
    one evaluation per period (at its end); data age at the last event; target
    down (0) for every hour without a request between two hours with requests."""
    f_all = W.build_features(load_panel(spark, sf_dir), drop_first=False)
    f = f_all.where(F.col("members_lag1").isNotNull())
    end = F.make_timestamp_ntz(F.col("period") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))

    def long(df, labels, **metrics):
        rows = F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in metrics.items()])
        return df.select(F.col(labels).alias("labels"), end.alias("eval_time"), F.inline(rows)).select("metric", "labels", "eval_time", "value")
    dr = cut_lineage(L.drift_score(L.feature_stats(f, MQ._DRIFT_FEATS, "period"), L.reference_frame(spark)))
    dg = cut_lineage(L.degradation(MQ._model_health(spark, sf_dir), L.baselines_frame(spark)))
    trig = dr.where("drift_detected = 1").select("period", F.lit("drift").alias("reason")).unionByName(
        dg.where("accuracy_degradation = 1").select("period", F.lit("accuracy_drop").alias("reason")))
    trig = trig.groupBy("reason", "period").agg(F.count(F.lit(1)).alias("n"))
    ev = A.read_table(spark, sf_dir, "events").select("ts", "event_type")
    last = ev.agg(F.max("ts").alias("now"))
    age = S.with_scalars(L.freshness(ev, "ts", ["event_type"], last.select("now").scalar()), last, "_now")
    hours = load_requests(spark, sf_dir).select("endpoint", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).distinct()
    hour = F.expr("INTERVAL 1 HOUR")
    down = hours.withColumn("p", F.lag("h", 1).over(Window.partitionBy("endpoint").orderBy("h"))).where(F.col("h") > F.col("p") + hour) \
        .select("endpoint", F.explode(F.sequence(F.col("p") + hour, F.col("h") - hour, hour)).alias("eval_time"))
    return (long(dg, "model", accuracy_degradation=F.col("accuracy_degradation"), accuracy_delta=F.col("accuracy_delta"),
                 confidence_degradation=F.col("confidence_degradation"))
            .unionByName(long(dr, "feature", drift_detected=F.col("drift_detected"), drift_score=F.col("drift_score")))
            .unionByName(long(L.missing_ratio(f_all, MQ._MISS_FEATS, "period"), "feature", missing_ratio=F.col("missing_ratio")))
            .unionByName(long(trig, "reason", retraining_increase=F.col("n")))
            .unionByName(age.select(F.lit("freshness_s").alias("metric"), F.col("event_type").alias("labels"),
                                    F.col("_now.now").alias("eval_time"), F.col("freshness_s").alias("value")))
            .unionByName(down.select(F.lit("up").alias("metric"), F.col("endpoint").alias("labels"), "eval_time", F.lit(0.0).alias("value"))))


@query("model_alert_rules", doubles=("value", "threshold"), sql=f"""
WITH {_MODEL_METRICS_CTE}
SELECT rules.alertname, rules.severity, ml.labels, ml.eval_time, CAST(ml.value AS DOUBLE) AS value, rules.threshold
FROM ml JOIN {MQ._RULES_SQL} ON ml.metric = rules.metric
WHERE CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold WHEN '>=' THEN value >= threshold
              WHEN '<=' THEN value <= threshold WHEN '==' THEN value = threshold WHEN '!=' THEN value <> threshold END""")
def model_alert_rules(spark, sf_dir):
    """The rules on model, drift, data and target metrics that hold (the
    request rules are ``alert_rules``)."""
    ev = L.evaluate_rules(model_metrics(spark, sf_dir), L.rules_frame(spark))
    return ev.where("condition").select("alertname", "severity", "labels", "eval_time", "value", "threshold")


@query("model_status", doubles=("value",), sql=f"""
WITH {_MODEL_METRICS_CTE}
SELECT metric, labels, MAX(eval_time) AS as_of, CAST(arg_max(value, eval_time) AS DOUBLE) AS value FROM ml
WHERE value IS NOT NULL GROUP BY metric, labels""")
def model_status(spark, sf_dir):
    """Latest value of every model, drift and data gauge."""
    return L.status_snapshot(model_metrics(spark, sf_dir).where("value is not null"), ["metric", "labels"])


# ----------------------------------------------------------------------------- I8 / I11

@query("forecast_actions", doubles=("real", "forecast", "delta", "total_variation_pct"), sql=f"""
WITH {_FC_CTE},
x AS (SELECT a.unit, a.y_last AS real, f.forecast FROM a JOIN fc f ON a.unit = f.unit AND f.model = 'drift')
SELECT unit, real, forecast, forecast - real AS delta,
       CASE WHEN forecast - real > 2 THEN 'add resources' WHEN forecast - real < -2 THEN 'retention campaign' ELSE 'maintain' END AS action,
       (SUM(forecast) OVER () - SUM(real) OVER ()) / SUM(real) OVER () * 100.0 AS total_variation_pct
FROM x""")
def forecast_actions(spark, sf_dir):
    """I8: real vs forecast per unit, delta, recommended action and the %
    variation of the totals (a 1-row aggregate inlined as a scalar)."""
    p = load_panel(spark, sf_dir)
    fc = _forecasts_long(p).where(F.col("model") == "drift").select("unit", "forecast")
    real = p.groupBy("unit").agg(F.max_by(F.col("members").cast("double"), "period").alias("real"))
    x = real.join(fc, "unit")
    tot = x.agg(((F.sum("forecast") - F.sum("real")) / F.sum("real") * 100.0).alias("v"))
    x = S.with_scalars(x, tot)
    return x.select("unit", "real", "forecast", (F.col("forecast") - F.col("real")).alias("delta"),
                    S.action_label(F.col("forecast") - F.col("real")).alias("action"),
                    F.col("_s.v").alias("total_variation_pct"))


def _acklam_sql(p: str) -> str:
    """The same rational approximation as functions.scalar.inv_norm_cdf."""
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]

    def poly(coefs, x):
        out = f"CAST({coefs[0]!r} AS DOUBLE)"
        for k in coefs[1:]:
            out = f"({out} * {x} + CAST({k!r} AS DOUBLE))"
        return out
    ql = f"sqrt(-2 * ln({p}))"
    qh = f"sqrt(-2 * ln(1 - {p}))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    low = f"{poly(c, ql)} / ({poly(d, ql)} * {ql} + 1)"
    high = f"-{poly(c, qh)} / ({poly(d, qh)} * {qh} + 1)"
    mid = f"{poly(a, r)} * {q} / ({poly(b, r)} * {r} + 1)"
    return f"CASE WHEN {p} < 0.02425 THEN {low} WHEN {p} > 1 - 0.02425 THEN {high} ELSE {mid} END"


@query("qq_points", doubles=("residual", "theoretical"), sql=f"""
WITH {PANEL_CTE},
m AS (SELECT unit, period, CAST(members AS DOUBLE) - CAST(LAG(members) OVER (PARTITION BY unit ORDER BY period) AS DOUBLE) AS e
      FROM panel),
r AS (SELECT unit, period, e AS residual, ROW_NUMBER() OVER (ORDER BY e, unit, period) AS i, COUNT(*) OVER () AS n
      FROM m WHERE e IS NOT NULL),
pp AS (SELECT *, (i - 0.5) / n AS p FROM r)
SELECT unit, period, residual, {_acklam_sql('p')} AS theoretical FROM pp""")
def qq_points(spark, sf_dir):
    """Normal Q-Q points of the naive residuals (plotting position
    (i - 0.5)/n; ranks come from ranges of residuals and their sizes)."""
    bt = TS.backtest(load_panel(spark, sf_dir), model="naive")
    r = bt.select("unit", "period", (F.col("y") - F.col("pred")).alias("residual"))
    r = global_row_number(r, ["residual", "unit", "period"], "i", "n")
    pp = (F.col("i") - 0.5) / F.col("n")
    return r.select("unit", "period", "residual", S.inv_norm_cdf(pp).alias("theoretical"))


# ----------------------------------------------------------------------------- J

_SEARCH_FEATS = ["avg_members", "cv_members", "avg_variation", "trend_pct", "avg_leak_rate"]


def _kmeans_np(X: np.ndarray, k: int, n_init: int, seed: int) -> np.ndarray:
    """Lloyd's k-means with k-means++ starts on a bounded unit profile."""
    rng = np.random.default_rng(seed)
    best, best_cost = None, np.inf
    for _ in range(n_init):
        cent = [X[rng.integers(len(X))]]
        for _ in range(1, k):
            d2 = np.min(((X[:, None, :] - np.array(cent)[None]) ** 2).sum(-1), axis=1)
            cent.append(X[rng.choice(len(X), p=d2 / d2.sum())] if d2.sum() > 0 else X[rng.integers(len(X))])
        c = np.array(cent)
        for _ in range(100):
            lab = np.argmin(((X[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
            newc = np.array([X[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(k)])
            if np.allclose(newc, c):
                break
            c = newc
        cost = ((X - c[lab]) ** 2).sum()
        if cost < best_cost:
            best, best_cost = lab, cost
    return best


def _silhouette_np(X: np.ndarray, lab: np.ndarray) -> float:
    d = np.sqrt(((X[:, None, :] - X[None]) ** 2).sum(-1))
    s = np.zeros(len(X))
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() <= 1:
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == j].mean() for j in set(lab) if j != lab[i])
        s[i] = (b - a) / max(a, b)
    return float(s.mean())


# Largest unit profile shipped to every configuration task.
MAX_BROADCAST_PROFILE_ROWS = 50_000


def _search_spark_ml(spark, up, combos):
    """Fallback for profiles too large to broadcast: one distributed k-means
    and squared-Euclidean silhouette per configuration (the loop is over the
    bounded configuration list, the data stays on the executors)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    z = ML.pop_scale(up, _SEARCH_FEATS).cache()
    rows = []
    for r in combos.collect():
        data = ML.assemble(z, list(r["features"]))
        for k in (2, 3, 4):
            pred = KMeans(featuresCol="features", k=k, seed=42).fit(data).transform(data)
            if pred.select("prediction").distinct().count() < k:
                continue
            rows.append((",".join(r["features"]), k, float(ClusteringEvaluator().evaluate(pred))))
    return spark.createDataFrame(rows, "features string, k int, silhouette double")


@query("search_clusterings")
def search_clusterings(spark, sf_dir):
    """J19 + G4: every 2-3 feature subset of the unit profile x k in 2..4,
    one task per configuration (``applyInPandas``) with the unit profile
    broadcast after a size check (Spark ML fallback beyond it); degenerate
    labelings skipped; top 15 by Euclidean silhouette."""
    up = D.unit_profile(load_panel(spark, sf_dir)).select(*_SEARCH_FEATS).na.fill(0.0)
    combos = D.feature_combos(spark, _SEARCH_FEATS, 2, 3)
    if up.limit(MAX_BROADCAST_PROFILE_ROWS + 1).count() > MAX_BROADCAST_PROFILE_ROWS:
        res = _search_spark_ml(spark, up, combos)
        return res.orderBy(F.col("silhouette").desc(), "features", "k").limit(15)
    prof = up.toPandas()          # size checked above: at most MAX_BROADCAST_PROFILE_ROWS rows
    z = ((prof - prof.mean()) / prof.std(ddof=0).replace(0, 1)).to_numpy()
    bc = spark.sparkContext.broadcast(z)
    cfg = combos.select("mask", "features", F.explode(F.array(*[F.lit(k) for k in (2, 3, 4)])).alias("k"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        X_all = bc.value
        rows = []
        for r in pdf.itertuples(index=False):
            idx = [_SEARCH_FEATS.index(f) for f in r.features]
            X = X_all[:, idx]
            lab = _kmeans_np(X, int(r.k), 10, 42)
            if len(set(lab)) < int(r.k):
                continue
            rows.append((",".join(r.features), int(r.k), _silhouette_np(X, lab)))
        return pd.DataFrame(rows, columns=["features", "k", "silhouette"])

    res = cfg.repartition(8, "mask", "k").groupBy("mask", "k").applyInPandas(
        run, "features string, k int, silhouette double")
    return res.orderBy(F.col("silhouette").desc(), "features", "k").limit(15)


@query("bisecting_kmeans")
def bisecting_kmeans(spark, sf_dir):
    """J12 (re-aimed): divisive clustering with BisectingKMeans instead of
    Ward linkage; cluster sizes and mean profile."""
    from pyspark.ml.clustering import BisectingKMeans
    up = D.unit_profile(load_panel(spark, sf_dir))
    # Spark moves the two start centres of a split in proportion to the mean's
    # length, which is 0 for centred features: keep the features away from 0
    z = ML.pop_scale(up, ["avg_variation", "cv_members"], suffix="__z").na.fill(0.0) \
        .withColumns({f"{c}__s": F.col(f"{c}__z") + 5.0 for c in ("avg_variation", "cv_members")})
    data = ML.assemble(z, ["avg_variation__s", "cv_members__s"])
    m = BisectingKMeans(featuresCol="features", k=3, seed=42, minDivisibleClusterSize=2.0).fit(data)
    lab = m.transform(data)
    found = lab.select("prediction").distinct().count()
    if found != 3:
        raise RuntimeError(f"bisecting k-means made {found} clusters of 3")
    return D.cluster_profile(lab, "prediction", ["avg_members", "avg_variation", "cv_members"])


@query("gmm_ic")
def gmm_ic(spark, sf_dir):
    """GMM log-likelihood, BIC and AIC for k = 2..4 on the unit profile."""
    up = cut_lineage(D.unit_profile(load_panel(spark, sf_dir)))
    z = ML.pop_scale(up, ["avg_variation", "cv_members"], suffix="__z").na.fill(0.0)
    n = z.count()
    rows = []
    for k in (2, 3, 4):
        m, _ = ML.gmm(z, ["avg_variation__z", "cv_members__z"], k)
        ic = ML.gmm_ic(m, n, 2)
        rows.append((k, float(ic["log_likelihood"]), float(ic["bic"]), float(ic["aic"])))
    return spark.createDataFrame(rows, "k int, log_likelihood double, bic double, aic double")




@query("gmm_variants")
def gmm_variants(spark, sf_dir):
    """Mixtures with full (Spark ML), tied, diagonal and spherical
    covariance on the scaled unit profile: log-likelihood, BIC, AIC and the
    number of non-empty clusters."""
    up = cut_lineage(D.unit_profile(load_panel(spark, sf_dir)))
    feats = ["avg_variation__z", "cv_members__z"]
    z = ML.pop_scale(up, ["avg_variation", "cv_members"], suffix="__z").na.fill(0.0).select("unit", *feats)
    n = z.count()
    m, out = ML.gmm(z, feats, 3)
    full = ML.gmm_ic(m, n, 2)
    rows = [("full", float(full["log_likelihood"]), float(full["bic"]), float(full["aic"]),
             out.select("prediction").distinct().count())]
    for cov in ("tied", "diag", "spherical"):
        scored, info = ML.gmm_em(z, feats, 3, cov=cov)
        rows.append((cov, float(info["log_likelihood"]), float(info["bic"]), float(info["aic"]),
                     scored.select("label").distinct().count()))
    return spark.createDataFrame(rows, "cov_type string, log_likelihood double, bic double, aic double, n_clusters long")


# ----------------------------------------------------------------------------- scale variants
_CUST_CTE = """
cp AS (SELECT o_custkey AS unit, CAST(year(o_orderdate) AS INTEGER) AS period, SUM(o_totalprice) AS y
       FROM orders GROUP BY 1, 2)"""


@query("cust_ar1_forecast", doubles=("phi",), sql=f"""
WITH {_CUST_CTE},
x AS (SELECT unit, period, y, y - LAG(y) OVER w AS d FROM cp WINDOW w AS (PARTITION BY unit ORDER BY period)),
x1 AS (SELECT *, LAG(d) OVER (PARTITION BY unit ORDER BY period) AS d1 FROM x),
a AS (SELECT unit, MAX(period) AS lp, arg_max(y, period) AS y_last, arg_max(d, period) AS d_last,
             SUM(d * d1) AS sxy, SUM(d1 * d1) AS sxx FROM x1 GROUP BY unit),
b AS (SELECT *, CASE WHEN sxx > 0 THEN sxy / sxx END AS phi FROM a),
c AS (SELECT unit, lp + 1 AS period, phi, COALESCE(GREATEST(y_last + phi * d_last, 0.0), y_last) AS forecast,
             CASE WHEN phi IS NULL THEN 'naive' ELSE 'ar1' END AS method FROM b)
SELECT unit, period, {sig_sql('phi')} AS phi, {sig_sql('forecast')} AS forecast, method FROM c""")
def cust_ar1_forecast(spark, sf_dir):
    """I4 at scale: ARIMA(1,1,0) forecast of every customer's yearly order
    value (one series per customer; windows partitioned by customer);
    reported to 10 significant digits."""
    from ..plans.panel import load_cust_panel
    f = TS.ar1_forecast(load_cust_panel(spark, sf_dir), y="y")
    return f.select("unit", "period", S.round_sig("phi", 10).alias("phi"),
                    S.round_sig("forecast", 10).alias("forecast"), "method")


_CBT_SQL = f"""
WITH {_CUST_CTE},
bt AS (SELECT unit, y, LAG(y) OVER (PARTITION BY unit ORDER BY period) AS pred FROM cp),
b AS (SELECT unit % 10 AS shard, y, pred FROM bt WHERE pred IS NOT NULL),
m AS (
  SELECT CASE WHEN GROUPING(shard) = 1 THEN 'ALL' ELSE CAST(shard AS VARCHAR) END AS scope,
         COUNT(*) AS n, AVG(abs(y - pred)) AS mae, AVG((y - pred) * (y - pred)) AS mse,
         sqrt(AVG((y - pred) * (y - pred))) AS rmse,
         AVG(abs(y - pred) / greatest(abs(y + 1e-9), 2.220446049250313e-16)) * 100.0 AS mape,
         CASE WHEN COUNT(*) > 1 THEN 1 - AVG((y - pred) * (y - pred)) / NULLIF(var_pop(y), 0.0) END AS r2
  FROM b GROUP BY GROUPING SETS ((shard), ()))
SELECT scope, n, """ + ", ".join(f"{sig_sql(c)} AS {c}" for c in ("mae", "mse", "rmse", "mape", "r2")) + " FROM m"


@query("cust_backtest_metrics", sql=_CBT_SQL)
def cust_backtest_metrics(spark, sf_dir):
    """E13 + D9 at scale: naive backtest of every customer series, metrics
    per customer shard (custkey mod 10) and overall (GROUPING SETS); values
    reported to 10 significant digits (order values reach 1e11)."""
    from ..plans.panel import load_cust_panel
    bt = TS.backtest(load_cust_panel(spark, sf_dir), y="y", model="naive")
    m = D.grouped_metrics(bt.withColumn("shard", F.col("unit") % 10), "y", "pred", "shard")
    return m.select("scope", "n", *[S.round_sig(c, 10).alias(c) for c in ("mae", "mse", "rmse", "mape", "r2")])


_ORDER_FEATS = ["n_lines", "qty", "revenue", "avg_discount"]


@query("order_zscore", doubles=("zscore_max",), sql="""
WITH f AS (SELECT l_orderkey AS id, CAST(COUNT(*) AS DOUBLE) AS n_lines, SUM(l_quantity) AS qty,
                  SUM(l_extendedprice) AS revenue, AVG(l_discount) AS avg_discount
           FROM lineitem GROUP BY l_orderkey),
st AS (SELECT """ + ", ".join(f"AVG({c}) AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1.0 ELSE STDDEV_POP({c}) END AS s_{c}"
                              for c in _ORDER_FEATS) + """ FROM f)
SELECT id, greatest(""" + ", ".join(f"abs(({c} - m_{c}) / s_{c})" for c in _ORDER_FEATS) + """) AS zscore_max,
       CAST(greatest(""" + ", ".join(f"abs(({c} - m_{c}) / s_{c})" for c in _ORDER_FEATS) + """) > 3.0 AS INTEGER) AS zscore_anomaly
FROM f, st""")
def order_zscore(spark, sf_dir):
    """J16 at scale: max |z| over per-order lineitem aggregates (one row per
    order), flag > 3."""
    from ..operators import anomaly as A
    from ..plans.panel import load_order_features
    return A.zscore(load_order_features(spark, sf_dir), _ORDER_FEATS, thr=3.0) \
        .select("id", "zscore_max", "zscore_anomaly")


@query("order_isolation_forest")
def order_isolation_forest(spark, sf_dir):
    """J14 at scale: isolation forest over per-order lineitem aggregates
    (100 trees of <= 256 sampled orders; every order scored); the flagged
    count per flag value."""
    from ..operators import anomaly as A
    from ..plans.panel import load_order_features
    iso = A.isolation_forest(load_order_features(spark, sf_dir), "id", _ORDER_FEATS, contamination=0.01)
    return iso.groupBy("iso_anomaly").agg(F.count(F.lit(1)).alias("n"), F.avg("iso_score").alias("mean_score"))
