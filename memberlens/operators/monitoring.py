"""L (batch form): request metrics, drift, degradation and alert evaluation.

Event-level work is windowed with ``F.window`` (epoch-aligned, [start, end)),
so the same functions run on a static DataFrame and on a stream.  Per-event
running state (concurrency, gaps between events) uses two-level prefix sums
and lags split by time bucket, never one window over all events of a key.
Alert-level series (one row per evaluation) are keyed by rule and labels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import epoch_us, from_epoch_us, with_scalars
from .metrics import prefix_sums

# Latency histogram upper bounds (seconds), +Inf implied.
LATENCY_BUCKETS = [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]

# Reference distributions per feature (mean, std) for drift.
REFERENCE_DISTRIBUTIONS = [
    ("members_lag1", 13.8, 3.2),
    ("leak_rate_lag1", 48.5, 12.0),
    ("growth_rate_lag1", 2.1, 8.5),
    ("retention_rate", 0.515, 0.12),
]

# Per-model baselines (accuracy, confidence, p95 latency s).
MODEL_BASELINES = [
    ("regression", 0.770, 0.85, 0.5),
    ("classification", 0.800, 0.80, 0.3),
    ("clustering", 0.6276, 0.75, 0.4),
    ("timeseries", 0.685, 0.78, 0.6),
]

DRIFT_THRESHOLD = 0.3
SEVERE_DRIFT = 0.6
ACCURACY_DROP = 0.05
ACCURACY_WARN = 0.03
CONFIDENCE_DROP = 0.10

# The 13 alert rules (alertname, metric, op, threshold, hold
# seconds, severity).
ALERT_RULES = [
    ("HighLatency", "p95_latency", ">", 1.0, 30, "warning"),
    ("CriticalLatency", "p95_latency", ">", 2.5, 30, "critical"),
    ("HighErrorRate", "error_ratio", ">", 0.10, 30, "warning"),
    ("CriticalErrorRate", "error_ratio", ">", 0.30, 30, "critical"),
    ("ModelAccuracyDegradation", "accuracy_degradation", "==", 1.0, 0, "critical"),
    ("AccuracyDeltaWarning", "accuracy_delta", "<", -0.03, 60, "warning"),
    ("ModelConfidenceDrop", "confidence_degradation", "==", 1.0, 0, "warning"),
    ("DataDriftDetected", "drift_detected", "==", 1.0, 0, "warning"),
    ("SevereDriftScore", "drift_score", ">", 0.6, 30, "critical"),
    ("HighMissingValues", "missing_ratio", ">", 0.10, 30, "warning"),
    ("StaleData", "freshness_s", ">", 600.0, 60, "warning"),
    ("RetrainingRequired", "retraining_increase", ">", 0.0, 0, "critical"),
    ("APIDown", "up", "==", 0.0, 30, "critical"),
]
RULE_SCHEMA = "alertname string, metric string, op string, threshold double, hold_s int, severity string"

# Routing (receiver and repeat interval seconds by severity).
ROUTES = [("critical", "critical-receiver", 900), ("warning", "log-receiver", 1800)]
DEFAULT_ROUTE = ("log-receiver", 3600)


def rules_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALERT_RULES, RULE_SCHEMA)


def reference_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REFERENCE_DISTRIBUTIONS, "feature string, ref_mean double, ref_std double")


def baselines_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        MODEL_BASELINES, "model string, base_accuracy double, base_confidence double, base_latency_p95 double")


def _win(ts: str, length: str, slide: str | None = None):
    return F.window(ts, length, slide) if slide else F.window(ts, length)


def request_counts(req: DataFrame, length: str = "1 hour", labels=("endpoint", "status"),
                   ts: str = "ts") -> DataFrame:
    """L1: request counters by labels per tumbling window."""
    return (req.groupBy(_win(ts, length).alias("w"), *labels)
            .agg(F.count(F.lit(1)).alias("requests"))
            .select(F.col("w.start").alias("window_start"), *labels, "requests"))


def latency_buckets(req: DataFrame, length: str = "1 hour", by=("endpoint",), ts: str = "ts",
                    lat: str = "latency_s", buckets=LATENCY_BUCKETS) -> DataFrame:
    """L2: cumulative ``le`` bucket counts (+Inf = total), one partial agg.

    Output keeps the arrays ``les`` / ``cum`` for L3 and the count and sum.
    """
    cums = [F.count_if(F.col(lat) <= b) for b in buckets] + [F.count(F.lit(1))]
    return (req.groupBy(_win(ts, length).alias("w"), *by)
            .agg(F.array(*cums).alias("cum"), F.sum(lat).alias("lat_sum"))
            .select(F.col("w.start").alias("window_start"), *by,
                    F.array(*[F.lit(float(b)) for b in buckets]).alias("les"), "cum",
                    F.element_at("cum", -1).alias("n"), "lat_sum"))


def bucket_quantile(hist: DataFrame, q: float, name: str = "quantile") -> DataFrame:
    """L3: PromQL ``histogram_quantile`` over (les, cum) arrays.

    First bucket whose cumulative count reaches q*n, linear interpolation
    inside it (lower bound 0 for the first bucket); the +Inf bucket returns
    the last finite bound; n = 0 gives NULL.
    """
    nb = len(LATENCY_BUCKETS)
    rank = F.lit(q) * F.col("n")
    idx = F.size(F.filter("cum", lambda c: c < rank))            # 0-based bucket index
    upper = F.element_at("les", idx + 1)
    lower = F.when(idx == 0, F.lit(0.0)).otherwise(F.element_at("les", F.greatest(idx, F.lit(1))))
    c_hi = F.element_at("cum", idx + 1).cast("double")
    c_lo = F.when(idx == 0, F.lit(0.0)).otherwise(F.element_at("cum", F.greatest(idx, F.lit(1))).cast("double"))
    interp = lower + (upper - lower) * (rank - c_lo) / F.nullif(c_hi - c_lo, F.lit(0.0))
    val = (F.when(F.col("n") == 0, F.lit(None).cast("double"))
           .when(idx >= nb, F.element_at("les", nb))
           .otherwise(F.coalesce(interp, upper)))
    return hist.withColumn(name, val)


def sliding_counts(req: DataFrame, length: str, slide: str, by=("endpoint",), ts: str = "ts") -> DataFrame:
    """Shared L4-L6 input: requests and errors per sliding window."""
    return (req.groupBy(_win(ts, length, slide).alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.count_if(F.col("status") == "500").alias("errors"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *by, "requests", "errors"))


def rate(req: DataFrame, length: str = "2 hours", slide: str = "1 hour", by=("endpoint",),
         seconds: float = 7200.0, ts: str = "ts") -> DataFrame:
    """L4: per-second request rate and increase over a sliding range."""
    c = sliding_counts(req, length, slide, by, ts)
    return c.select("window_start", "window_end", *by, F.col("requests").alias("increase"),
                    (F.col("requests") / seconds).alias("rate"))


def error_ratio(req: DataFrame, length: str = "2 hours", slide: str = "1 hour", by=("endpoint",),
                seconds: float = 7200.0, ts: str = "ts") -> DataFrame:
    """rate(errors) / (rate(requests) + 0.001); both sides
    aggregated to the same labels first (Q19).  ``by=()`` is the global ratio."""
    c = sliding_counts(req, length, slide, by, ts)
    return c.select("window_start", "window_end", *by, "requests", "errors",
                    ((F.col("errors") / seconds) / (F.col("requests") / seconds + 0.001)).alias("error_ratio"))


def _epoch_us(ts: str):
    return epoch_us(ts)


def active_requests(req: DataFrame, by: str = "endpoint", ts: str = "ts",
                    lat: str = "latency_s", bucket_s: int = 3600, split_s: int = 300) -> DataFrame:
    """Concurrent in-flight requests (+1 at start, -1 at end).

    Running sum per endpoint ordered by (time, delta) with ends before starts
    at equal instants.  The running sum is split into ``split_s`` time slices
    (each slice one window partition, earlier slices added from a per-slice
    summary) so a hot endpoint is spread over many tasks.  Returns the peak
    per (endpoint, ``bucket_s`` reporting bucket).
    """
    start = _epoch_us(ts)
    end = start + F.round(F.col(lat) * 1e6).cast("bigint")
    ev = req.select(by, F.explode(F.array(
        F.struct(start.alias("t"), F.lit(1).alias("delta")),
        F.struct(end.alias("t"), F.lit(-1).alias("delta")))).alias("e"))
    ev = ev.select(by, "e.t", "e.delta",
                   (F.col("t") * 10 + F.col("delta") + 1).alias("_ord"),   # ends (-1) first
                   F.floor(F.col("t") / (split_s * 1_000_000)).alias("_bucket"))
    run = prefix_sums(ev, "_ord", ["delta"], partition=[by], bucket="_bucket")
    report = F.floor(F.col("t") / (bucket_s * 1_000_000)) * bucket_s
    return (run.groupBy(by, report.alias("bucket_epoch_s"))
            .agg(F.max("cum_delta").alias("peak_active"), F.count(F.lit(1)).alias("n_changes")))


def prev_in_series(df: DataFrame, key: list[str], order: str, cols: list[str],
                   bucket: str) -> DataFrame:
    """Two-level lag: the previous row's ``cols`` per key in ``order``.

    Inside (key, bucket) a plain ``lag``; the first row of a bucket takes the
    last row of the previous non-empty bucket (per-bucket summary, #buckets
    rows per key).
    """
    w_in = Window.partitionBy(*key, bucket).orderBy(order)
    inner = df.select("*", *[F.lag(c, 1).over(w_in).alias(f"_pv_{c}") for c in cols],
                      (F.row_number().over(w_in) == 1).alias("_first_in_bucket"))
    last = df.groupBy(*key, bucket).agg(
        *[F.max_by(F.col(c), F.col(order)).alias(f"_lb_{c}") for c in cols])
    w_b = Window.partitionBy(*key).orderBy(bucket)
    prev_b = last.select(*key, bucket, *[F.lag(f"_lb_{c}", 1).over(w_b).alias(f"_pb_{c}") for c in cols])
    j = inner.join(prev_b, [*key, bucket])
    return j.select(*df.columns, *[F.when(F.col("_first_in_bucket"), F.col(f"_pb_{c}"))
                                   .otherwise(F.col(f"_pv_{c}")).alias(f"prev_{c}") for c in cols])


def silence_gaps(df: DataFrame, gap_s: float, by: list[str] | None = None, ts: str = "ts",
                 bucket_s: int = 60) -> DataFrame:
    """Gaps longer than ``gap_s`` between consecutive events ("target
    down"), per key; two-level lag split into ``bucket_s`` time slices."""
    key = by or []
    base = df.select(*key, _epoch_us(ts).alias("t_us"),
                     F.floor(_epoch_us(ts) / (bucket_s * 1_000_000)).alias("_bucket"))
    p = prev_in_series(base, key, "t_us", ["t_us"], "_bucket")
    gap = (F.col("t_us") - F.col("prev_t_us")) / 1e6
    return (p.where(gap > gap_s)
            .select(*key, from_epoch_us("prev_t_us").alias("silent_from"),
                    from_epoch_us("t_us").alias("silent_to"),
                    gap.alias("gap_s")))


def missing_ratio(df: DataFrame, cols: list[str], by: str = "period") -> DataFrame:
    """NULL ratio per feature per batch, flag > 0.10."""
    wide = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"),
                              *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    stack = "stack({}, {}) as (feature, missing)".format(
        len(cols), ", ".join(f"'{c}', _m{i}" for i, c in enumerate(cols)))
    return (wide.selectExpr(by, "_n", stack)
            .select(by, "feature", (F.col("missing") / F.col("_n")).alias("missing_ratio"))
            .withColumn("high_missing", (F.col("missing_ratio") > 0.10).cast("int")))


def freshness(df: DataFrame, ts: str, by: list[str], now_col) -> DataFrame:
    """Seconds since the last update per key, stale > 600 s.  ``now_col``
    is an explicit column (never the wall clock)."""
    last = df.groupBy(*by).agg(F.max(ts).alias("last_ts"))
    age = (epoch_us(now_col) - epoch_us("last_ts")) / 1e6
    return last.select(*by, "last_ts", age.alias("freshness_s"), (age > 600).cast("int").alias("stale"))


def feature_stats(df: DataFrame, feats: list[str], by: str) -> DataFrame:
    """Current mean / population std per feature per batch (long form): one wide
    aggregate, then a row per feature."""
    wide = df.groupBy(by).agg(F.array(*[F.struct(F.lit(f).alias("feature"), F.avg(f).alias("cur_mean"),
                                                 F.stddev_pop(f).alias("cur_std")) for f in feats]).alias("_s"))
    return wide.select(by, F.inline("_s"))


def drift_score(stats: DataFrame, ref: DataFrame) -> DataFrame:
    """score = round(min(1, (0.6*mean shift + 0.4*std shift)/3), 4),
    shifts in units of the reference std (+1e-9); unknown feature -> 0."""
    j = stats.join(F.broadcast(ref), "feature", "left")
    ms = F.abs(F.col("cur_mean") - F.col("ref_mean")) / (F.col("ref_std") + 1e-9)
    ss = F.abs(F.col("cur_std") - F.col("ref_std")) / (F.col("ref_std") + 1e-9)
    # least() skips NULLs, so an unknown feature must be caught explicitly
    score = F.when(F.col("ref_mean").isNull(), F.lit(0.0)) \
             .otherwise(F.round(F.least(F.lit(1.0), (ms * 0.6 + ss * 0.4) / 3.0), 4))
    return (j.withColumn("drift_score", score)
            .withColumn("drift_detected", (F.col("drift_score") > DRIFT_THRESHOLD).cast("int"))
            .withColumn("severe_drift", (F.col("drift_score") > SEVERE_DRIFT).cast("int"))
            .drop("ref_mean", "ref_std"))


def degradation(current: DataFrame, baselines: DataFrame) -> DataFrame:
    """Absolute deltas vs baseline (Q15).

    accuracy_degradation = delta < -0.05; accuracy warning < -0.03;
    confidence_degradation = delta < -0.10.
    """
    j = current.join(F.broadcast(baselines), "model", "left")
    da = F.col("accuracy") - F.col("base_accuracy")
    dc = F.col("confidence") - F.col("base_confidence")
    return j.select(*current.columns, F.round(da, 4).alias("accuracy_delta"),
                    (da < -ACCURACY_DROP).cast("int").alias("accuracy_degradation"),
                    (da < -ACCURACY_WARN).cast("int").alias("accuracy_warning"),
                    F.round(dc, 4).alias("confidence_delta"),
                    (dc < -CONFIDENCE_DROP).cast("int").alias("confidence_degradation"))


def evaluate_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Join the long metric frame (metric, labels, eval_time, value) with
    the broadcast rule table and evaluate the operator per row."""
    j = metrics.join(F.broadcast(rules), "metric")
    v, t = F.col("value"), F.col("threshold")
    cond = (F.when(F.col("op") == ">", v > t).when(F.col("op") == "<", v < t)
            .when(F.col("op") == ">=", v >= t).when(F.col("op") == "<=", v <= t)
            .when(F.col("op") == "==", v == t).when(F.col("op") == "!=", v != t))
    return j.withColumn("condition", F.coalesce(cond, F.lit(False)))


def hold(evals: DataFrame, key: list[str], t: str = "eval_time", step_s: float | None = None) -> DataFrame:
    """Pending -> firing after the condition held ``hold_s`` seconds.

    Gaps-and-islands: an island ends at a false evaluation and, with ``step_s``
    (seconds between evaluations), where an evaluation is missing: a series that
    vanishes starts anew.  The active-since time is the first true evaluation of
    the island; firing when eval_time - active_since >= hold_s.
    """
    by = Window.partitionBy(*key).orderBy(t)
    w = by.rowsBetween(Window.unboundedPreceding, 0)
    goes_on = F.col("condition")
    if step_s is not None:
        before = F.lag(epoch_us(t), 1).over(by)
        evals = evals.withColumn("_missed", F.coalesce(epoch_us(t) - before > F.lit(int(step_s * 1e6)), F.lit(False)))
        goes_on = goes_on & ~F.col("_missed")
    e = evals.withColumn("_island", F.sum(F.when(goes_on, 0).otherwise(1)).over(w))
    wi = Window.partitionBy(*key, "_island")
    e = e.withColumn("active_since", F.min(F.when(F.col("condition"), F.col(t))).over(wi))
    held = (epoch_us(t) - epoch_us("active_since")) / 1e6
    state = (F.when(~F.col("condition"), F.lit("inactive"))
             .when(held >= F.col("hold_s"), F.lit("firing")).otherwise(F.lit("pending")))
    return e.withColumn("state", state).drop("_island", "_missed")


def alert_transitions(states: DataFrame, key: list[str], t: str = "eval_time", step_s: float | None = None) -> DataFrame:
    """Firing / resolved notifications on state changes per alert key.

    With ``step_s`` a series that fires and then misses an evaluation resolves
    one step after its last one (unless the data end there), and counts as
    inactive when it comes back.
    """
    w = Window.partitionBy(*key).orderBy(t)
    prev = F.coalesce(F.lag("state", 1).over(w), F.lit("inactive"))
    s, at = states, F.col(t)
    none = F.lit(None).cast(states.schema[t].dataType)
    gone = none
    if step_s is not None:
        step = F.make_dt_interval(secs=F.lit(float(step_s)))
        s = with_scalars(s, states.agg(F.max(t).alias("mx")), "_end").withColumn("_next", F.lead(t, 1).over(w))
        missed = F.coalesce(at - F.lag(t, 1).over(w) > step, F.lit(False))
        prev = F.when(missed, F.lit("inactive")).otherwise(prev)
        vanishes = F.coalesce(F.col("_next") - at > step, at + step <= F.col("_end.mx"))
        gone = F.when((F.col("state") == "firing") & vanishes, at + step)
    s = s.withColumn("_prev", prev)
    changes = F.array(
        F.struct(F.when((F.col("state") == "firing") & (F.col("_prev") != "firing"), at).alias("at"), F.lit("firing").alias("status")),
        F.struct(F.when((F.col("state") != "firing") & (F.col("_prev") == "firing"), at).alias("at"), F.lit("resolved").alias("status")),
        F.struct(gone.alias("at"), F.lit("resolved").alias("status")))
    s = s.withColumn("_c", F.explode(F.filter(changes, lambda c: c["at"].isNotNull())))
    return s.withColumn(t, F.col("_c.at")).withColumn("status", F.col("_c.status")).drop("_prev", "_c", "_next", "_end")


def route_alerts(firing: DataFrame, t: str = "eval_time") -> DataFrame:
    """Receiver by severity; group by (alertname, severity); a group is
    notified by its first alert and then by the first alert that comes at least
    the repeat interval after its last notification.

    The walk is over a group's distinct evaluation times (bounded by the
    evaluation calendar, not by the alerts); alerts join their notification
    afterwards.
    """
    recv = F.lit(DEFAULT_ROUTE[0])
    rep = F.lit(DEFAULT_ROUTE[1])
    for sev, r, s in reversed(ROUTES):
        recv = F.when(F.col("severity") == sev, F.lit(r)).otherwise(recv)
        rep = F.when(F.col("severity") == sev, F.lit(s)).otherwise(rep)
    keys = ["alertname", "severity"]
    f = firing.withColumn("receiver", recv).withColumn("repeat_s", rep)
    due = F.col("repeat_s").cast("bigint") * 1_000_000
    walk = f.groupBy(*keys, "repeat_s").agg(F.array_sort(F.collect_set(epoch_us(t))).alias("_times"))
    chosen = F.aggregate("_times", F.array().cast("array<bigint>"), lambda acc, x: F.when(
        (F.size(acc) == 0) | (x - F.element_at(acc, -1) >= due), F.concat(acc, F.array(x))).otherwise(acc))
    f = f.join(walk.select(*keys, chosen.alias("_notified")), keys)
    last = F.array_max(F.filter("_notified", lambda c: c <= epoch_us(t)))
    return (f.withColumn("_at", last).groupBy(*keys, "receiver", "_at")
            .agg(F.min(t).alias("notify_time"), F.count(F.lit(1)).alias("n_alerts"),
                 F.array_sort(F.collect_set(F.col("labels"))).alias("labels"))
            .drop("_at"))


def metrics_long(req: DataFrame, length: str = "2 hours", slide: str = "1 hour",
                 seconds: float = 7200.0) -> DataFrame:
    """Request metrics of L3 and L5 in the long (metric, labels, eval_time,
    value) form the rule engine consumes; eval_time = window end."""
    h = latency_buckets_sliding(req, length, slide)
    p95 = bucket_quantile(h, 0.95, "value").select(
        F.lit("p95_latency").alias("metric"), F.col("endpoint").alias("labels"),
        F.col("window_end").alias("eval_time"), "value")
    er = error_ratio(req, length, slide, ("endpoint",), seconds).select(
        F.lit("error_ratio").alias("metric"), F.col("endpoint").alias("labels"),
        F.col("window_end").alias("eval_time"), F.col("error_ratio").alias("value"))
    return p95.unionByName(er).where(F.col("value").isNotNull())


def latency_buckets_sliding(req: DataFrame, length: str, slide: str, by=("endpoint",),
                            ts: str = "ts", lat: str = "latency_s") -> DataFrame:
    """L2 over a sliding range (the rate window of the latency rules)."""
    cums = [F.count_if(F.col(lat) <= b) for b in LATENCY_BUCKETS] + [F.count(F.lit(1))]
    return (req.groupBy(_win(ts, length, slide).alias("w"), *by)
            .agg(F.array(*cums).alias("cum"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                    F.array(*[F.lit(float(b)) for b in LATENCY_BUCKETS]).alias("les"), "cum",
                    F.element_at("cum", -1).alias("n")))


def alert_schema() -> T.StructType:
    """A10: webhook payload schema."""
    return T.StructType([T.StructField("alerts", T.ArrayType(T.StructType([
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("annotations", T.MapType(T.StringType(), T.StringType())),
        T.StructField("status", T.StringType())])))])


def flatten_alerts(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """A10: nested ``alerts[]`` -> one row per alert with defaults."""
    p = payloads.select("*", F.from_json(col, alert_schema()).alias("_p"))
    e = p.select(*[c for c in payloads.columns if c != col], F.explode_outer("_p.alerts").alias("a"))
    return e.select(*[c for c in payloads.columns if c != col],
                    F.coalesce(F.col("a.labels")["alertname"], F.lit("Unknown")).alias("alertname"),
                    F.coalesce(F.col("a.labels")["severity"], F.lit("unknown")).alias("severity"),
                    F.coalesce(F.col("a.status"), F.lit("unknown")).alias("status"),
                    F.coalesce(F.col("a.annotations")["summary"], F.lit("")).alias("summary"))


def status_snapshot(gauges: DataFrame, key: list[str], ts: str = "eval_time") -> DataFrame:
    """Last value per gauge key (``max_by`` on time)."""
    return gauges.groupBy(*key).agg(F.max(ts).alias("as_of"), F.max_by("value", ts).alias("value"))



