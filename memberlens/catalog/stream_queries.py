"""T queries: the streaming forms, run to completion on a file stream and
returned as batch frames.  Their oracles are the batch SQL of the same
operator (stream = batch)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators import monitoring as L
from ..operators import windows as W
from ..plans.panel import load_panel, load_requests
from ..session import cut_lineage
from ..sources import tables as A
from ..streaming import alert_chain as AC
from ..streaming import streams as ST
from . import monitoring_queries as MQ
from .registry import ORACLE, query
from .sqlparts import REQUESTS_CTE


def _ntz(*cols):
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in cols]


@query("stream_request_counts")
def stream_request_counts(spark, sf_dir):
    """L1 (T): request counters per 1 h window on the event stream."""
    s = ST.request_stream(spark, sf_dir)
    res = ST.run_update(L.request_counts(s), ["window_start", "endpoint", "status"], "req-counts")
    return res.select(*_ntz("window_start"), "endpoint", "status", "requests")


@query("stream_error_ratio", doubles=("error_ratio",))
def stream_error_ratio(spark, sf_dir):
    """L5 (T): sliding 2 h / 1 h error ratio per endpoint on the stream."""
    s = ST.request_stream(spark, sf_dir)
    res = ST.run_update(L.error_ratio(s), ["window_start", "window_end", "endpoint"], "err-ratio")
    return res.select(*_ntz("window_start", "window_end"), "endpoint", "requests", "errors", "error_ratio")


@query("stream_latency_quantile", doubles=("p50", "p95", "p99"), sql=f"""
WITH {REQUESTS_CTE},
h AS (SELECT date_trunc('hour', ts) AS window_start, endpoint, {MQ._cum_sql()}, COUNT(*) AS n
      FROM requests GROUP BY ALL)
SELECT window_start, endpoint, n, {MQ._quantile_sql(0.5)} AS p50, {MQ._quantile_sql(0.95)} AS p95,
       {MQ._quantile_sql(0.99)} AS p99
FROM h""")
def stream_latency_quantile(spark, sf_dir):
    """L2 + L3 (T): bucket histogram per window, then histogram_quantile."""
    s = ST.request_stream(spark, sf_dir)
    h = ST.run_update(L.latency_buckets(s), ["window_start", "endpoint"], "lat-hist")
    for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        h = L.bucket_quantile(h, q, name)
    return h.select(*_ntz("window_start"), "endpoint", "n", "p50", "p95", "p99")


@query("stream_alert_hold")
def stream_alert_hold(spark, sf_dir):
    """L16 (T): rule evaluations (derived from events) replayed as a stream
    through the stateful hold (applyInPandasWithState, event-time timeout)."""
    req = load_requests(spark, sf_dir)
    ev = L.evaluate_rules(L.metrics_long(req), L.rules_frame(spark))
    path = ST.scratch_path(spark, "evals")
    ev.select("alertname", "severity", "labels", F.col("eval_time").cast("timestamp").alias("eval_time"),
              "condition", "hold_s").write.parquet(path)
    schema = spark.read.parquet(path).schema
    ST.close_folder(spark, path, "eval_time")
    s = ST.folder_stream(spark, path, schema).withWatermark("eval_time", "6 hours")
    out = ST.run_append(ST.hold_stream(s, MQ.EVAL_STEP_S), "hold")
    return out.select("alertname", "severity", "labels", *_ntz("eval_time", "active_since"), "state")


def _evaluations_stream(spark, sf_dir, past: timedelta):
    """Rule evaluations derived from the events, replayed in several micro-batches
    under a watermark of 6 hours; the replay ends ``past`` after the last one."""
    req = load_requests(spark, sf_dir)
    ev = cut_lineage(L.evaluate_rules(L.metrics_long(req), L.rules_frame(spark)).select(
        "alertname", "severity", "labels", F.col("eval_time").cast("timestamp").alias("eval_time"), "condition", "hold_s"))
    path = ST.replay_folder(ev, "eval_time", "chain", files=3, past=past)
    return ST.folder_stream(spark, path, ev.schema).withWatermark("eval_time", "6 hours")


@query("stream_alert_transitions")
def stream_alert_transitions(spark, sf_dir):
    """L16 + L17 (T): firing and resolved changes of the replayed evaluations; a series
    that vanishes is resolved by a timer.  The replay ends as the watermark
    passes the last evaluation, so a series that fires then is not resolved."""
    s = _evaluations_stream(spark, sf_dir, timedelta(hours=6, milliseconds=2))
    out = AC.run_chain(AC.lifecycle(s, MQ.EVAL_STEP_S), "transitions")
    return out.where("status IS NOT NULL").select("alertname", "severity", "labels", "eval_time", "status")


@query("stream_alert_route")
def stream_alert_route(spark, sf_dir):
    """L16 + L19 (T): hold and routing chained in one streaming query; a row per
    notification with the alerts of its repeat interval."""
    s = _evaluations_stream(spark, sf_dir, timedelta(days=3650))
    out = AC.run_chain(AC.notifications(AC.lifecycle(s, MQ.EVAL_STEP_S), {v: (r, n) for v, r, n in L.ROUTES}, L.DEFAULT_ROUTE), "route")
    return out.where("kind = 'closed'").select("alertname", "severity", "receiver", "notify_time", "n_alerts", "labels")


@query("stream_silence_gaps", doubles=("gap_s",))
def stream_silence_gaps(spark, sf_dir):
    """L20 (T): silences of more than 20 minutes on the event stream (first
    and last event of every slice, then the gaps between slices)."""
    e = ST.table_stream(spark, sf_dir, "events").select("ts")
    return ST.gap_stream(e, 1200.0)


@query("stream_score", doubles=("last_value", "prev_value", "forecast"), sql="""
WITH o AS (
  SELECT c.c_nationkey AS unit, CAST(year(o.o_orderdate) AS INTEGER) AS period, o.o_custkey AS cust
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
p AS (SELECT unit, period, COUNT(DISTINCT cust) AS members FROM o GROUP BY unit, period),
r AS (SELECT unit, members, ROW_NUMBER() OVER (PARTITION BY unit ORDER BY period DESC) AS rn FROM p),
snap AS (SELECT unit, CAST(MAX(members) FILTER (WHERE rn = 1) AS DOUBLE) AS last_value,
                CAST(COALESCE(MAX(members) FILTER (WHERE rn = 2), MAX(members) FILTER (WHERE rn = 1)) AS DOUBLE) AS prev_value
         FROM r WHERE rn <= 2 GROUP BY unit)
SELECT c.c_custkey, c.c_nationkey AS unit, s.last_value, s.prev_value,
       GREATEST(0.0, s.last_value + (s.last_value - s.prev_value)) AS forecast
FROM customer c LEFT JOIN snap s ON c.c_nationkey = s.unit""")
def stream_score(spark, sf_dir):
    """L22 + C7 (T): a stream of per-customer requests enriched with its
    unit's latest two periods (stream-static join against a snapshot with
    one row per unit) and scored with the drift forecast."""
    snap = W.last_two(load_panel(spark, sf_dir)).select(
        "unit", F.col("last_value").cast("double").alias("last_value"),
        F.col("prev_value").cast("double").alias("prev_value"))
    req = ST.table_stream(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("unit"))
    scored = req.join(F.broadcast(snap), "unit", "left").select(
        "c_custkey", "unit", "last_value", "prev_value",
        F.greatest(F.lit(0.0), F.col("last_value") + (F.col("last_value") - F.col("prev_value"))).alias("forecast"))
    return ST.run_append(scored, "score")


@query("stream_ingest_profile", doubles=("missing_ratio", "mean_chars"), sql="""
SELECT 0 AS batch_id, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE text IS NULL) / CAST(COUNT(*) AS DOUBLE) AS missing_ratio,
       AVG(n_chars) AS mean_chars FROM documents""")
def stream_ingest_profile(spark, sf_dir):
    """A12 + L8: micro-batch ingest of documents with per-batch row count,
    missing ratio (NaN without rows) and mean length computed in ``foreachBatch``
    (the SQL is for a table of one file, which is one batch)."""
    s = ST.table_stream(spark, sf_dir, "documents", max_files=1)
    path = ST.scratch_path(spark, "ingest")

    def sink(batch, batch_id):
        n = F.count(F.lit(1))
        batch.agg(F.lit(batch_id).alias("batch_id"), n.alias("n_rows"),
                  F.when(n > 0, F.count_if(F.col("text").isNull()) / n).otherwise(F.lit(float("nan"))).alias("missing_ratio"),
                  F.avg("n_chars").alias("mean_chars")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = s.writeStream.foreachBatch(sink).option("checkpointLocation", path + "-ckpt") \
         .trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(path).drop("batch")


@query("stream_request_rate", doubles=("rate",))
def stream_request_rate(spark, sf_dir):
    """L4 (T): sliding 2 h / 1 h rate and increase per endpoint on the stream."""
    res = ST.run_update(L.rate(ST.request_stream(spark, sf_dir)), ["window_start", "window_end", "endpoint"], "rate")
    return res.select(*_ntz("window_start", "window_end"), "endpoint", "increase", "rate")


@query("stream_global_error_ratio", doubles=("error_ratio",))
def stream_global_error_ratio(spark, sf_dir):
    """L6 (T): the error ratio over all endpoints on the stream."""
    res = ST.run_update(L.error_ratio(ST.request_stream(spark, sf_dir), by=()), ["window_start", "window_end"], "all-err-ratio")
    return res.select(*_ntz("window_start", "window_end"), "requests", "errors", "error_ratio")


#: Features of a request, with a reference mean and deviation (fixed inputs of the query).
REQUEST_REFERENCE = [("latency_s", 1.0, 0.5), ("value", 40.0, 20.0)]


@query("stream_drift_summary", doubles=("worst",), sql=f"""
WITH {REQUESTS_CTE},
h AS (SELECT date_trunc('hour', ts) AS w, feature, AVG(x) AS m, stddev_pop(x) AS s
      FROM (SELECT ts, 'latency_s' AS feature, latency_s AS x FROM requests UNION ALL SELECT ts, 'value', value FROM requests) GROUP BY ALL),
d AS (SELECT h.*, ROUND(LEAST(1.0, (0.6 * abs(m - rm) / (rs + 1e-9) + 0.4 * abs(s - rs) / (rs + 1e-9)) / 3.0), 4) AS score
      FROM h JOIN (VALUES {", ".join(f"('{f}', CAST({m} AS DOUBLE), CAST({s} AS DOUBLE))" for f, m, s in REQUEST_REFERENCE)}) AS r(f, rm, rs) ON f = feature)
SELECT time_bucket(INTERVAL 6 HOUR, w, TIMESTAMP '1970-01-01') AS span_start, feature, COUNT(*) AS windows,
       CAST(SUM(CAST(score > 0.3 AS INTEGER)) AS BIGINT) AS drifted, CAST(SUM(CAST(score > 0.6 AS INTEGER)) AS BIGINT) AS severe, MAX(score) AS worst
FROM d GROUP BY ALL""")
def stream_drift_summary(spark, sf_dir):
    """L10 + L11 + L14 (T): hourly drift scores of the request features, and per 6 h
    how many hours drifted: two windowed aggregates in one streaming query,
    over a replay of ``events`` in several micro-batches."""
    events = A.read_table(spark, sf_dir, "events")
    path = ST.replay_folder(events, "ts", "drift")
    s = ST.requests_from_events(ST.folder_stream(spark, path, events.schema))
    ref = spark.createDataFrame(REQUEST_REFERENCE, "feature string, ref_mean double, ref_std double")
    out = ST.run_append(ST.drift_summary(ST.drift_windows(s, [f for f, _, _ in REQUEST_REFERENCE], ref)), "drift")
    return out.select(*_ntz("span_start"), "feature", "windows", "drifted", "severe", "worst")


@query("stream_sessions", sql=f"""
WITH {REQUESTS_CTE},
p AS (SELECT user_id, ts, epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap, event_id FROM requests),
s AS (SELECT user_id, ts, SUM(CASE WHEN gap IS NULL OR gap > 1200500000 THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM p)
SELECT user_id, MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(*) AS events FROM s GROUP BY user_id, i""")
def stream_sessions(spark, sf_dir):
    """L20 (T): sessions of each user, closed by a silence of more than 1200.5 s
    once the watermark has passed it (``session_window``, append mode)."""
    events = A.read_table(spark, sf_dir, "events")
    path = ST.replay_folder(events, "ts", "sessions")
    s = ST.requests_from_events(ST.folder_stream(spark, path, events.schema))
    out = ST.run_append(ST.sessions(s, "1200500 milliseconds", ["user_id"]), "sessions")
    return out.select("user_id", *_ntz("first_ts", "last_ts"), "events")


# stream = batch: the oracle of each streamed operator is its batch SQL
ORACLE_ALIASES = {
    "stream_request_counts": "request_counts",
    "stream_error_ratio": "error_ratio",
    "stream_alert_hold": "alert_hold",
    "stream_alert_transitions": "alert_transitions",
    "stream_alert_route": "alert_route",
    "stream_silence_gaps": "silence_gaps",
    "stream_request_rate": "request_rate",
    "stream_global_error_ratio": "global_error_ratio",
}
for _s, _b in ORACLE_ALIASES.items():
    ORACLE[_s] = ORACLE[_b]

