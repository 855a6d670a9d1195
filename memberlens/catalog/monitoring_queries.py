"""L queries: request metrics, drift, degradation and alerting on ``events``.

Window sizes are parameters of the operators; the registered queries use 1 h
tumbling and 2 h / 1 h sliding windows because the driver's event table has
about one event per endpoint every 15 minutes (the reference's 2 min ranges
would be mostly empty).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import counters as C
from ..operators import monitoring as L
from ..operators import windows as W
from ..operators.joins import inhibit
from ..plans.panel import load_panel, load_requests
from ..session import cut_lineage
from ..sources.tables import read_table
from .registry import query
from .sqlparts import FEATURES_CTE, PANEL_CTE, REQUESTS_CTE

LE_LABELS = ["0.01", "0.05", "0.1", "0.25", "0.5", "1", "2.5", "5", "10", "+Inf"]
_B = L.LATENCY_BUCKETS


def _cum_sql():
    return ", ".join([f"COUNT(*) FILTER (WHERE latency_s <= {b}) AS c{i + 1}" for i, b in enumerate(_B)])


def _quantile_sql(q: float) -> str:
    """CASE chain equal to PromQL histogram_quantile over c1..c9, n."""
    r = f"({q} * n)"
    parts = ["CASE WHEN n = 0 THEN NULL"]
    lo_b, lo_c = "0.0", "0.0"
    for i, b in enumerate(_B):
        c = f"CAST(c{i + 1} AS DOUBLE)"
        parts.append(f" WHEN c{i + 1} >= {r} THEN {lo_b} + ({b} - {lo_b}) * ({r} - {lo_c}) / ({c} - {lo_c})")
        lo_b, lo_c = str(b), c
    parts.append(f" ELSE {_B[-1]} END")
    return "".join(parts)


_SLIDE_CTE = REQUESTS_CTE + """,
rw AS (
  SELECT r.*, ws AS window_start, ws + INTERVAL 2 HOUR AS window_end
  FROM requests r, UNNEST([date_trunc('hour', r.ts), date_trunc('hour', r.ts) - INTERVAL 1 HOUR]) AS u(ws))"""


@query("request_counts", sql=f"""
WITH {REQUESTS_CTE}
SELECT date_trunc('hour', ts) AS window_start, endpoint, status, COUNT(*) AS requests
FROM requests GROUP BY ALL""")
def request_counts(spark, sf_dir):
    """L1: request counters by (endpoint, status) per 1 h window."""
    return L.request_counts(load_requests(spark, sf_dir))


@query("latency_buckets", sql=f"""
WITH {REQUESTS_CTE},
h AS (SELECT date_trunc('hour', ts) AS window_start, endpoint, {_cum_sql()}, COUNT(*) AS c10
      FROM requests GROUP BY ALL)
SELECT window_start, endpoint, s.le AS le, s.cum_count AS cum_count FROM (
  SELECT window_start, endpoint, unnest([{", ".join(f"{{'le': '{x}', 'cum_count': c{i + 1}}}" for i, x in enumerate(LE_LABELS))}]) AS s
  FROM h) AS z""")
def latency_buckets(spark, sf_dir):
    """L2: cumulative latency histogram per endpoint and 1 h window (long form)."""
    h = L.latency_buckets(load_requests(spark, sf_dir))
    z = F.arrays_zip(F.array(*[F.lit(x) for x in LE_LABELS]).alias("le"), F.col("cum").alias("cum_count"))
    return h.select("window_start", "endpoint", F.explode(z).alias("z")) \
            .select("window_start", "endpoint", "z.le", "z.cum_count")


@query("bucket_quantile", doubles=("p50", "p95", "p99"), sql=f"""
WITH {REQUESTS_CTE},
h AS (SELECT date_trunc('hour', ts) AS window_start, endpoint, {_cum_sql()}, COUNT(*) AS n
      FROM requests GROUP BY ALL)
SELECT window_start, endpoint, n, {_quantile_sql(0.5)} AS p50, {_quantile_sql(0.95)} AS p95,
       {_quantile_sql(0.99)} AS p99
FROM h""")
def bucket_quantile(spark, sf_dir):
    """L3: histogram_quantile p50/p95/p99 from the bucket counts (one partial
    aggregate; per-window state is 10 counters whatever the traffic)."""
    h = L.latency_buckets(load_requests(spark, sf_dir))
    for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        h = L.bucket_quantile(h, q, name)
    return h.select("window_start", "endpoint", "n", "p50", "p95", "p99")


@query("request_rate", doubles=("rate",), sql=f"""
WITH {_SLIDE_CTE}
SELECT window_start, window_end, endpoint, COUNT(*) AS increase, COUNT(*) / 7200.0 AS rate
FROM rw GROUP BY ALL""")
def request_rate(spark, sf_dir):
    """L4: per-second rate and increase over a 2 h range sliding by 1 h."""
    return L.rate(load_requests(spark, sf_dir))


@query("counter_rate", doubles=("increase", "rate"), sql=f"""
WITH {REQUESTS_CTE},
steps AS (SELECT endpoint, time_bucket(INTERVAL 10 MINUTE, ts) AS b, COUNT(*) AS n FROM requests GROUP BY ALL),
samples AS (SELECT endpoint, b + INTERVAL 10 MINUTE AS t,
                   SUM(n) OVER (PARTITION BY endpoint, date_trunc('day', b) ORDER BY b) AS v FROM steps),
grown AS (SELECT *, v < LAG(v) OVER s AS is_reset, CASE WHEN v >= LAG(v) OVER s THEN v - LAG(v) OVER s ELSE v END AS g,
                 LAG(v) OVER s IS NULL AS is_first FROM samples WINDOW s AS (PARTITION BY endpoint ORDER BY t)),
ranges AS (SELECT g.*, ws FROM grown g, UNNEST([date_trunc('hour', g.t), date_trunc('hour', g.t) - INTERVAL 1 HOUR]) AS u(ws)),
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY endpoint, ws ORDER BY t) AS i FROM ranges),
spans AS (SELECT endpoint, ws, COUNT(*) AS samples, COUNT(*) FILTER (WHERE i > 1 AND is_reset) AS resets,
                 CAST(SUM(g) FILTER (WHERE i > 1) AS DOUBLE) AS known, MAX(v) FILTER (WHERE i = 1) AS v0,
                 epoch_us(MIN(t)) / 1e6 - epoch_us(ws) / 1e6 AS before, epoch_us(ws) / 1e6 + 7200 - epoch_us(MAX(t)) / 1e6 AS after,
                 (epoch_us(MAX(t)) - epoch_us(MIN(t))) / 1e6 AS span
          FROM numbered GROUP BY endpoint, ws HAVING COUNT(*) > 1),
ends AS (SELECT *, span / (samples - 1) AS mean, CASE WHEN known > 0 AND span * v0 / known < before THEN span * v0 / known ELSE before END AS back FROM spans),
told AS (SELECT *, known * (span + CASE WHEN back < 1.1 * mean THEN back ELSE mean / 2 END
                                 + CASE WHEN after < 1.1 * mean THEN after ELSE mean / 2 END) / span AS increase FROM ends)
SELECT ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, endpoint, samples, resets, increase, increase / 7200.0 AS rate FROM told""")
def counter_rate(spark, sf_dir):
    """L4: increase and rate of cumulative request counters that restart every
    midnight, scraped every 10 minutes, over a 2 h range sliding by 1 h."""
    return C.counter_rate(C.counter_samples(load_requests(spark, sf_dir)), ["endpoint"])


@query("error_ratio", doubles=("error_ratio",), sql=f"""
WITH {_SLIDE_CTE}
SELECT window_start, window_end, endpoint, COUNT(*) AS requests,
       COUNT(*) FILTER (WHERE status = '500') AS errors,
       (COUNT(*) FILTER (WHERE status = '500') / 7200.0) / (COUNT(*) / 7200.0 + 0.001) AS error_ratio
FROM rw GROUP BY ALL""")
def error_ratio(spark, sf_dir):
    """Per-endpoint error ratio with the +0.001 denominator guard."""
    return L.error_ratio(load_requests(spark, sf_dir))


@query("global_error_ratio", doubles=("error_ratio",), sql=f"""
WITH {_SLIDE_CTE}
SELECT window_start, window_end, COUNT(*) AS requests,
       COUNT(*) FILTER (WHERE status = '500') AS errors,
       (COUNT(*) FILTER (WHERE status = '500') / 7200.0) / (COUNT(*) / 7200.0 + 0.001) AS error_ratio
FROM rw GROUP BY ALL""")
def global_error_ratio(spark, sf_dir):
    """Error ratio over all endpoints."""
    return L.error_ratio(load_requests(spark, sf_dir), by=())


@query("active_requests", sql=f"""
WITH {REQUESTS_CTE},
ev AS (SELECT endpoint, epoch_us(ts) AS t, 1 AS delta FROM requests
       UNION ALL
       SELECT endpoint, epoch_us(ts) + CAST(round(latency_s * 1e6) AS BIGINT), -1 FROM requests),
r AS (SELECT endpoint, floor(t / 3600000000) AS b,
             SUM(delta) OVER (PARTITION BY endpoint ORDER BY t * 10 + delta + 1 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS active
      FROM ev)
SELECT endpoint, CAST(b * 3600 AS BIGINT) AS bucket_epoch_s, CAST(MAX(active) AS BIGINT) AS peak_active, COUNT(*) AS n_changes
FROM r GROUP BY endpoint, b""")
def active_requests(spark, sf_dir):
    """Peak concurrent requests per endpoint and hour."""
    out = L.active_requests(load_requests(spark, sf_dir))
    return out.select("endpoint", F.col("bucket_epoch_s").cast("bigint").alias("bucket_epoch_s"),
                      F.col("peak_active").cast("bigint").alias("peak_active"), "n_changes")


@query("silence_gaps", doubles=("gap_s",), sql="""
WITH g AS (SELECT ts, LAG(ts) OVER (ORDER BY ts) AS prev FROM events)
SELECT prev AS silent_from, ts AS silent_to, (epoch_us(ts) - epoch_us(prev)) / 1e6 AS gap_s
FROM g WHERE (epoch_us(ts) - epoch_us(prev)) / 1e6 > 1200""")
def silence_gaps(spark, sf_dir):
    """Stretches of more than 20 minutes without any event."""
    return L.silence_gaps(read_table(spark, sf_dir, "events"), 1200.0)


_MISS_FEATS = ["members_lag1", "leak_rate_lag1", "growth_rate_lag1"]
_FEAT_ALL_CTE = FEATURES_CTE.replace("FROM feat0 WHERE members_lag1 IS NOT NULL", "FROM feat0")


@query("missing_ratio", doubles=("missing_ratio",), sql=f"""
WITH {_FEAT_ALL_CTE}
""" + "\nUNION ALL\n".join(
    f"SELECT period, '{c}' AS feature, COUNT(*) FILTER (WHERE {c} IS NULL) / CAST(COUNT(*) AS DOUBLE) AS missing_ratio, "
    f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) / CAST(COUNT(*) AS DOUBLE) > 0.10 AS INTEGER) AS high_missing "
    f"FROM features GROUP BY period" for c in _MISS_FEATS))
def missing_ratio(spark, sf_dir):
    """Missing ratio per feature per period batch, flag > 0.10."""
    f = W.build_features(load_panel(spark, sf_dir), drop_first=False)
    return L.missing_ratio(f, _MISS_FEATS, "period")


@query("freshness", doubles=("freshness_s",), sql="""
WITH l AS (SELECT event_type, MAX(ts) AS last_ts FROM events GROUP BY event_type),
n AS (SELECT MAX(ts) AS now_ts FROM events)
SELECT event_type, last_ts, (epoch_us(now_ts) - epoch_us(last_ts)) / 1e6 AS freshness_s,
       CAST((epoch_us(now_ts) - epoch_us(last_ts)) / 1e6 > 600 AS INTEGER) AS stale
FROM l, n""")
def freshness(spark, sf_dir):
    """Seconds since each event type's last event, relative to the
    table's latest event (explicit 'now')."""
    ev = read_table(spark, sf_dir, "events")
    now = ev.select(F.max("ts")).scalar()
    return L.freshness(ev, "ts", ["event_type"], now)


_DRIFT_FEATS = ["members_lag1", "leak_rate_lag1", "growth_rate_lag1", "retention_rate", "delta_members_lag1"]
_REF_SQL = "(VALUES " + ", ".join(f"('{f}', CAST({m} AS DOUBLE), CAST({s} AS DOUBLE))" for f, m, s in L.REFERENCE_DISTRIBUTIONS) + \
    ") AS ref(feature, ref_mean, ref_std)"
_DRIFT_PARTS = """
st AS (""" + "\nUNION ALL\n".join(
    f"SELECT period, '{c}' AS feature, AVG({c}) AS cur_mean, STDDEV_POP({c}) AS cur_std FROM features GROUP BY period"
    for c in _DRIFT_FEATS) + f"""),
dr AS (
  SELECT st.period, st.feature, st.cur_mean, st.cur_std,
         CASE WHEN ref.feature IS NULL THEN 0.0 ELSE ROUND(LEAST(1.0, (abs(cur_mean - ref_mean) / (ref_std + 1e-9) * 0.6
                                   + abs(cur_std - ref_std) / (ref_std + 1e-9) * 0.4) / 3.0), 4) END AS drift_score
  FROM st LEFT JOIN {_REF_SQL} ON st.feature = ref.feature)"""
_DRIFT_CTE = FEATURES_CTE + "," + _DRIFT_PARTS


@query("drift_score", doubles=("cur_mean", "cur_std", "drift_score"), sql=f"""
WITH {_DRIFT_CTE}
SELECT period, feature, cur_mean, cur_std, drift_score,
       CAST(drift_score > 0.3 AS INTEGER) AS drift_detected, CAST(drift_score > 0.6 AS INTEGER) AS severe_drift
FROM dr""")
def drift_score(spark, sf_dir):
    """Per-period feature drift against the reference
    distributions; a feature without reference scores 0."""
    f = W.build_features(load_panel(spark, sf_dir))
    stats = L.feature_stats(f, _DRIFT_FEATS, "period")
    return L.drift_score(stats, L.reference_frame(spark))


_BASE_SQL = "(VALUES " + ", ".join(f"('{m}', CAST({a} AS DOUBLE), CAST({c} AS DOUBLE), CAST({p} AS DOUBLE))" for m, a, c, p in L.MODEL_BASELINES) + \
    ") AS base(model, base_accuracy, base_confidence, base_latency_p95)"
_HEALTH_PARTS = """
m AS (SELECT unit, period, CAST(members AS DOUBLE) AS y,
             CAST(LAG(members) OVER (PARTITION BY unit ORDER BY period) AS DOUBLE) AS p_naive,
             AVG(members) OVER (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p_mean,
             CAST(leak_rate > 30 AS INTEGER) AS yc,
             CAST(LAG(leak_rate) OVER (PARTITION BY unit ORDER BY period) > 30 AS INTEGER) AS pc
      FROM panel),
mm AS (SELECT * FROM m WHERE p_naive IS NOT NULL),
health AS (
  SELECT 'regression' AS model, period, 1 - AVG((y - p_naive) * (y - p_naive)) / NULLIF(var_pop(y), 0.0) AS accuracy,
         1 - AVG(abs(y - p_naive)) / AVG(y) AS confidence FROM mm GROUP BY period
  UNION ALL
  SELECT 'timeseries', period, 1 - AVG((y - p_mean) * (y - p_mean)) / NULLIF(var_pop(y), 0.0),
         1 - AVG(abs(y - p_mean)) / AVG(y) FROM mm GROUP BY period
  UNION ALL
  SELECT 'classification', period,
         COALESCE(2.0 * COUNT(*) FILTER (WHERE yc = 1 AND pc = 1)
           / NULLIF(CAST(2 * COUNT(*) FILTER (WHERE yc = 1 AND pc = 1) + COUNT(*) FILTER (WHERE yc = 0 AND pc = 1)
                         + COUNT(*) FILTER (WHERE yc = 1 AND pc = 0) AS DOUBLE), 0.0), 0.0),
         COUNT(*) FILTER (WHERE yc = pc) / CAST(COUNT(*) AS DOUBLE) FROM mm GROUP BY period),
deg AS (
  SELECT h.model, h.period, h.accuracy, h.confidence,
         ROUND(h.accuracy - base_accuracy, 4) AS accuracy_delta,
         CAST(h.accuracy - base_accuracy < -0.05 AS INTEGER) AS accuracy_degradation,
         CAST(h.accuracy - base_accuracy < -0.03 AS INTEGER) AS accuracy_warning,
         ROUND(h.confidence - base_confidence, 4) AS confidence_delta,
         CAST(h.confidence - base_confidence < -0.1 AS INTEGER) AS confidence_degradation
  FROM health h LEFT JOIN """ + _BASE_SQL + " ON h.model = base.model)"
_HEALTH_CTE = PANEL_CTE + "," + _HEALTH_PARTS


def _model_health(spark, sf_dir):
    """Per-period quality of three simple models on the panel (current
    accuracy / confidence the degradation checks compare with baselines)."""
    p = load_panel(spark, sf_dir)
    w = W.unit_window()
    m = p.select("unit", "period", F.col("members").cast("double").alias("y"),
                 F.lag("members", 1).over(w).cast("double").alias("p_naive"),
                 W.past_mean("members", w).alias("p_mean"),
                 (F.col("leak_rate") > 30).cast("int").alias("yc"),
                 (F.lag("leak_rate", 1).over(w) > 30).cast("int").alias("pc")).where("p_naive IS NOT NULL")

    def reg(pred, name):
        e = F.col("y") - F.col(pred)
        return m.groupBy("period").agg(
            F.lit(name).alias("model"),
            (1 - F.avg(e * e) / F.nullif(F.var_pop("y"), F.lit(0.0))).alias("accuracy"),
            (1 - F.avg(F.abs(e)) / F.avg("y")).alias("confidence"))
    tp = F.count_if((F.col("yc") == 1) & (F.col("pc") == 1))
    fp = F.count_if((F.col("yc") == 0) & (F.col("pc") == 1))
    fn = F.count_if((F.col("yc") == 1) & (F.col("pc") == 0))
    cls = m.groupBy("period").agg(
        F.lit("classification").alias("model"),
        F.coalesce(2.0 * tp / F.nullif((2 * tp + fp + fn).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("accuracy"),
        (F.count_if(F.col("yc") == F.col("pc")) / F.count(F.lit(1)).cast("double")).alias("confidence"))
    return reg("p_naive", "regression").unionByName(reg("p_mean", "timeseries")).unionByName(cls) \
        .select("model", "period", "accuracy", "confidence")


_DEG_DOUBLES = ("accuracy", "confidence", "accuracy_delta", "confidence_delta")


@query("degradation", doubles=_DEG_DOUBLES, sql=f"""
WITH {_HEALTH_CTE}
SELECT * FROM deg""")
def degradation(spark, sf_dir):
    """Accuracy and confidence deltas vs the model baselines."""
    return L.degradation(_model_health(spark, sf_dir), L.baselines_frame(spark))


@query("retraining_triggers", sql=f"""
WITH {FEATURES_CTE},{_HEALTH_PARTS},{_DRIFT_PARTS},
trig AS (SELECT period, 'drift' AS reason FROM dr WHERE drift_score > 0.3
         UNION ALL SELECT period, 'accuracy_drop' FROM deg WHERE accuracy_degradation = 1)
SELECT reason, period, COUNT(*) AS triggers FROM trig GROUP BY reason, period""")
def retraining_triggers(spark, sf_dir):
    """Retraining triggers per period by reason (drift, accuracy drop)."""
    f = W.build_features(load_panel(spark, sf_dir))
    dr = L.drift_score(L.feature_stats(f, _DRIFT_FEATS, "period"), L.reference_frame(spark))
    dg = L.degradation(_model_health(spark, sf_dir), L.baselines_frame(spark))
    trig = dr.where("drift_detected = 1").select("period", F.lit("drift").alias("reason")).unionByName(
        dg.where("accuracy_degradation = 1").select("period", F.lit("accuracy_drop").alias("reason")))
    return trig.groupBy("reason", "period").agg(F.count(F.lit(1)).alias("triggers"))


# ------------------------------------------------------------------ alert engine
# Seconds between two evaluations of a rule (the slide of the metric windows).
EVAL_STEP_S = 3600

_RULES_SQL = "(VALUES " + ", ".join(f"('{a}', '{m}', '{o}', CAST({t} AS DOUBLE), {h}, '{s}')" for a, m, o, t, h, s in L.ALERT_RULES) + \
    ") AS rules(alertname, metric, op, threshold, hold_s, severity)"

_EVAL_CTE = _SLIDE_CTE + f""",
h AS (SELECT window_end, endpoint, {_cum_sql()}, COUNT(*) AS n,
             COUNT(*) FILTER (WHERE status = '500') AS errors
      FROM rw GROUP BY ALL),
ml AS (
  SELECT 'p95_latency' AS metric, endpoint AS labels, window_end AS eval_time, {_quantile_sql(0.95)} AS value FROM h
  UNION ALL
  SELECT 'error_ratio', endpoint, window_end, (errors / 7200.0) / (n / 7200.0 + 0.001) FROM h),
ev AS (
  SELECT ml.*, rules.alertname, rules.op, rules.threshold, rules.hold_s, rules.severity,
         COALESCE(CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold
                          WHEN '>=' THEN value >= threshold WHEN '<=' THEN value <= threshold
                          WHEN '==' THEN value = threshold WHEN '!=' THEN value <> threshold END, false) AS condition
  FROM ml JOIN {_RULES_SQL} ON ml.metric = rules.metric
  WHERE value IS NOT NULL),
gp AS (SELECT *, COALESCE(epoch_us(eval_time) - epoch_us(LAG(eval_time) OVER (PARTITION BY alertname, labels ORDER BY eval_time))
                          > {EVAL_STEP_S}000000, false) AS missed FROM ev),
isl AS (SELECT *, SUM(CASE WHEN condition AND NOT missed THEN 0 ELSE 1 END) OVER (PARTITION BY alertname, labels ORDER BY eval_time
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM gp),
act AS (SELECT *, MIN(CASE WHEN condition THEN eval_time END) OVER (PARTITION BY alertname, labels, island) AS active_since FROM isl),
st AS (SELECT *, CASE WHEN NOT condition THEN 'inactive'
                      WHEN (epoch_us(eval_time) - epoch_us(active_since)) / 1e6 >= hold_s THEN 'firing'
                      ELSE 'pending' END AS state FROM act)"""


_TRANSITIONS_CTE = _EVAL_CTE + f""",
nb AS (SELECT *, CASE WHEN missed THEN 'inactive' ELSE COALESCE(LAG(state) OVER (PARTITION BY alertname, labels ORDER BY eval_time), 'inactive') END AS prev,
              LEAD(eval_time) OVER (PARTITION BY alertname, labels ORDER BY eval_time) AS nxt FROM st),
tr AS (SELECT alertname, severity, labels, eval_time, CASE WHEN state = 'firing' THEN 'firing' ELSE 'resolved' END AS status FROM nb
       WHERE (state = 'firing' AND prev <> 'firing') OR (state <> 'firing' AND prev = 'firing')
       UNION ALL
       SELECT alertname, severity, labels, eval_time + INTERVAL {EVAL_STEP_S} SECOND, 'resolved' FROM nb
       WHERE state = 'firing' AND CASE WHEN nxt IS NULL THEN eval_time + INTERVAL {EVAL_STEP_S} SECOND <= (SELECT MAX(eval_time) FROM st)
                                       ELSE nxt > eval_time + INTERVAL {EVAL_STEP_S} SECOND END)"""


def _alert_states(spark, sf_dir):
    """Rule states, built once: the callers read them several times."""
    req = load_requests(spark, sf_dir)
    ev = L.evaluate_rules(L.metrics_long(req), L.rules_frame(spark))
    return cut_lineage(L.hold(ev, ["alertname", "labels"], step_s=EVAL_STEP_S))


def _transitions(spark, sf_dir):
    return L.alert_transitions(_alert_states(spark, sf_dir), ["alertname", "labels"], step_s=EVAL_STEP_S)


@query("alert_rules", doubles=("value", "threshold"), sql=f"""
WITH {_EVAL_CTE}
SELECT alertname, severity, labels, eval_time, value, threshold FROM ev WHERE condition""")
def alert_rules(spark, sf_dir):
    """Rule table x request metrics: rows whose condition holds."""
    req = load_requests(spark, sf_dir)
    ev = L.evaluate_rules(L.metrics_long(req), L.rules_frame(spark))
    return ev.where("condition").select("alertname", "severity", "labels", "eval_time", "value", "threshold")


@query("alert_hold", sql=f"""
WITH {_EVAL_CTE}
SELECT alertname, severity, labels, eval_time, active_since, state FROM st WHERE condition""")
def alert_hold(spark, sf_dir):
    """Pending / firing state after the rule's hold time."""
    return _alert_states(spark, sf_dir).where("condition") \
        .select("alertname", "severity", "labels", "eval_time", "active_since", "state")


@query("alert_transitions", sql=f"""
WITH {_TRANSITIONS_CTE}
SELECT alertname, severity, labels, eval_time, status FROM tr""")
def alert_transitions(spark, sf_dir):
    """Firing and resolved notifications per alert key."""
    t = _transitions(spark, sf_dir)
    return t.select("alertname", "severity", "labels", "eval_time", "status")


@query("inhibit_anti", sql=f"""
WITH {_EVAL_CTE},
f AS (SELECT alertname, severity, labels, eval_time, metric FROM st WHERE state = 'firing')
SELECT alertname, severity, labels, eval_time FROM f
WHERE severity <> 'warning'
   OR NOT EXISTS (SELECT 1 FROM f c WHERE c.severity = 'critical' AND c.labels = f.labels
                  AND c.eval_time = f.eval_time AND c.metric = f.metric)""")
def inhibit_anti(spark, sf_dir):
    """Warnings dropped while a critical of the same metric family,
    labels and evaluation is firing (Q14: ``equal`` is a parameter)."""
    f = _alert_states(spark, sf_dir).where("state = 'firing'") \
        .select("alertname", "severity", "labels", "eval_time", "metric")
    return inhibit(f, ["labels", "eval_time", "metric"]).select("alertname", "severity", "labels", "eval_time")


@query("alert_route", sql=f"""
WITH RECURSIVE {_EVAL_CTE},
f AS (SELECT alertname, severity, labels, eval_time,
             CASE severity WHEN 'critical' THEN 'critical-receiver' WHEN 'warning' THEN 'log-receiver' ELSE 'log-receiver' END AS receiver,
             CASE severity WHEN 'critical' THEN 900 WHEN 'warning' THEN 1800 ELSE 3600 END AS repeat_s
      FROM st WHERE state = 'firing'),
n AS (SELECT alertname, severity, MIN(eval_time) AS t FROM f GROUP BY 1, 2
      UNION ALL
      SELECT n.alertname, n.severity, MIN(f.eval_time) FROM n JOIN f ON f.alertname = n.alertname AND f.severity = n.severity
             AND epoch_us(f.eval_time) >= epoch_us(n.t) + f.repeat_s * 1000000 GROUP BY 1, 2),
g AS (SELECT f.*, (SELECT MAX(t) FROM n WHERE n.alertname = f.alertname AND n.severity = f.severity AND n.t <= f.eval_time) AS t FROM f)
SELECT alertname, severity, receiver, t AS notify_time, COUNT(*) AS n_alerts, list_sort(list_distinct(list(labels))) AS labels
FROM g GROUP BY alertname, severity, receiver, t""")
def alert_route(spark, sf_dir):
    """Receivers by severity, grouped by (alertname, severity), one
    notification per repeat interval."""
    f = _alert_states(spark, sf_dir).where("state = 'firing'")
    return L.route_alerts(f.select("alertname", "severity", "labels", "eval_time"))


@query("flatten_alerts", sql=f"""
WITH {_TRANSITIONS_CTE}
SELECT eval_time, alertname, severity, status, alertname || ' on ' || labels AS summary FROM tr""")
def flatten_alerts(spark, sf_dir):
    """A10: transitions packed into webhook JSON payloads (one per
    evaluation), then parsed back with from_json + explode_outer + defaults."""
    t = _transitions(spark, sf_dir)
    alert = F.struct(F.create_map(F.lit("alertname"), F.col("alertname"), F.lit("severity"), F.col("severity")).alias("labels"),
                     F.create_map(F.lit("summary"), F.concat_ws(" on ", "alertname", "labels")).alias("annotations"),
                     F.col("status").alias("status"))
    payloads = t.groupBy("eval_time").agg(F.to_json(F.struct(F.collect_list(alert).alias("alerts"))).alias("payload"))
    return L.flatten_alerts(payloads).select("eval_time", "alertname", "severity", "status", "summary")


@query("status_snapshot", doubles=("value",), sql=f"""
WITH {_EVAL_CTE}
SELECT metric, labels, MAX(eval_time) AS as_of, arg_max(value, eval_time) AS value FROM ml
WHERE value IS NOT NULL GROUP BY metric, labels""")
def status_snapshot(spark, sf_dir):
    """Latest value of every gauge (metric, labels)."""
    return L.status_snapshot(L.metrics_long(load_requests(spark, sf_dir)), ["metric", "labels"])


@query("risk_tier", sql=f"""
WITH {PANEL_CTE},
l AS (SELECT unit, arg_max(CAST(leak_rate > 30 AS INTEGER), period) AS pred_flag FROM panel GROUP BY unit),
q AS (SELECT quantile_cont(leak_rate, 0.25) AS q1, quantile_cont(leak_rate, 0.75) AS q3 FROM panel),
a AS (SELECT unit, COUNT(*) FILTER (WHERE leak_rate < q1 - 1.5 * (q3 - q1) OR leak_rate > q3 + 1.5 * (q3 - q1)) AS n_anom
      FROM panel, q GROUP BY unit)
SELECT l.unit, CASE WHEN COALESCE(pred_flag, 0) = 1 THEN 'risk' WHEN COALESCE(n_anom, 0) > 0 THEN 'warn' ELSE 'ok' END AS tier
FROM l LEFT JOIN a ON l.unit = a.unit""")
def risk_tier(spark, sf_dir):
    """B15d: risk / warn / ok per unit from the latest dropout flag and the
    number of IQR anomalies."""
    from ..operators.cleaning import iqr_outliers
    p = load_panel(spark, sf_dir)
    flag = p.groupBy("unit").agg(F.max_by((F.col("leak_rate") > 30).cast("int"), "period").alias("pred_flag"))
    an = iqr_outliers(p, "leak_rate").groupBy("unit").agg(F.sum("is_outlier").alias("n_anom"))
    return flag.join(an, "unit", "left").select("unit", S.risk_tier("pred_flag", "n_anom").alias("tier"))


