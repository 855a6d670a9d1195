"""L (stream form) and A12: the same operators on Structured Streaming.

* Sources are file streams over a table, be it one file (``pathGlobFilter``
  picks it) or a folder of files; timestamps are cast to ``timestamp`` and watermarked (Q21).
* Windowed metrics reuse the batch functions of ``operators.monitoring``
  unchanged; they run in ``update`` mode into a ``foreachBatch`` sink that
  appends (batch id, rows), and the result is the last version per key.
* Alert hold / throttle are ``applyInPandasWithState`` keyed by alert labels.
  They hold rows back until the watermark has passed them and then take them in
  event-time order, so rows that arrive out of order within the watermark give
  what the batch form gives.  Event-time timeouts release held rows of keys that
  stay silent; ``close_folder`` ends a replay.
* Sinks and checkpoints live under ``base``, by default a fresh folder below the
  session's ``spark.checkpoint.dir``.  A query that is to resume after a restart
  must be given the same ``base`` again.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType

from ..functions.scalar import epoch_us, from_epoch_us
from ..session import ensure_checkpoint_dir


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """File stream over one table, a file or a folder of files, with the batch schema.

    A file stream reads a folder: that of a table, or for a table of one file the
    folder it lies in, of which the glob picks that file.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def folder_stream(spark: SparkSession, path: str, schema, max_files: int | None = 1) -> DataFrame:
    """File stream over a folder of parquet files (one micro-batch per file)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local on
    a cluster: the setting names shared storage there)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"memberlens-{tag}-{uuid.uuid4().hex[:12]}")


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Number of state-store partitions for a new stateful query.

    Fixed in the checkpoint at the first run; defaults to the cluster's
    parallelism (total executor cores), so the state is spread over every
    core without hundreds of near-empty state stores on a small stream.
    """
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n or max(8, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def close_folder(spark: SparkSession, path: str, at: str, past: timedelta = timedelta(days=3650)) -> None:
    """End a replayed folder: one more file with a row of nulls, ``past`` after the last
    row's ``at`` (far in the future), moves the watermark past all rows before it."""
    schema = spark.read.parquet(path).schema
    last = spark.read.parquet(path).agg(F.max(at).alias("t")).first()["t"]
    if last is not None:
        row = [last + past if f.name == at else None for f in schema.fields]
        spark.createDataFrame([row], StructType([StructField(f.name, f.dataType, True) for f in schema.fields])) \
             .coalesce(1).write.mode("append").parquet(path)


def run_update(df: DataFrame, keys: list[str], tag: str, trigger_once: bool = True, base: str | None = None) -> DataFrame:
    """Run a streaming aggregate in update mode to completion and return the
    final version of each key as a batch DataFrame.

    ``foreachBatch`` appends every micro-batch's updated rows with its batch
    id (idempotent per batch id: a retried batch overwrites its own folder);
    the last version per key wins.
    """
    spark = df.sparkSession
    base = base or scratch_path(spark, tag)
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    w = df.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", ckpt)
    with state_partitions(spark):
        q = (w.trigger(availableNow=True) if trigger_once else w).start()
        q.awaitTermination()
    res = spark.read.option("basePath", out).parquet(out)
    vals = [c for c in df.columns if c not in keys]
    last = res.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch")).alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])


def run_append(df: DataFrame, tag: str, base: str | None = None) -> DataFrame:
    """Run a streaming query in append mode to a parquet sink and read it back."""
    spark = df.sparkSession
    base = base or scratch_path(spark, tag)
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    with state_partitions(spark):
        q = (df.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def request_stream(spark: SparkSession, sf_dir: str, watermark: str = "2 hours") -> DataFrame:
    """Request events as a watermarked stream (same columns as the batch)."""
    return requests_from_events(table_stream(spark, sf_dir, "events"), watermark)


def requests_from_events(e: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """The request projection of ``plans.panel.load_requests`` on a stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    s = e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("ep"), (k % 4).cast("string")).alias("endpoint"),
        F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")).alias("status"),
        (F.col("value") / 50.0).alias("latency_s"), "user_id", "event_type", "value")
    return s.withWatermark("ts", watermark)


# --------------------------------------------------------------------------- L16 stream
HELD = "times array<bigint>, flags array<boolean>, holds array<double>, severities array<string>, labels array<string>"
HOLD_STATE = f"active bigint, last bigint, {HELD}"
HOLD_OUT = ("alertname string, severity string, labels string, eval_time timestamp, "
            "active_since timestamp, state string")


def _in_order(pdfs, state: GroupState, held: list, columns: list[str]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Rows that the watermark has passed, in event-time order, and those it has
    not; ``held`` are the columns kept by earlier calls."""
    parts = [pd.DataFrame(dict(zip(columns, map(list, held))))] if len(held[0]) else []
    if not state.hasTimedOut:
        parts += [p[columns].assign(eval_time=p["eval_time"].astype("datetime64[us]").astype("int64")) for p in pdfs if not p.empty]
    rows = pd.concat(parts) if parts else pd.DataFrame({c: pd.Series(dtype="int64" if c == "eval_time" else object) for c in columns})
    rows = rows.sort_values("eval_time", kind="stable")
    passed = rows["eval_time"].astype("int64") < state.getCurrentWatermarkMs() * 1000
    return rows[passed], rows[~passed]


def _keep(state: GroupState, values: list, waiting: pd.DataFrame, forget_us: int | None) -> None:
    """Store the state and wake up when the watermark reaches the first row held
    back, or else ``forget_us``, from when on the state has no effect."""
    if len(waiting) == 0 and forget_us is None:
        state.remove()
        return
    state.update((*values, *[waiting[c].tolist() for c in waiting.columns]))
    wake = int(waiting["eval_time"].min()) if len(waiting) else forget_us
    state.setTimeoutTimestamp(max(wake // 1000, state.getCurrentWatermarkMs()) + 1)


def make_hold(step_s: float) -> Callable:
    """Hold of one (alertname, labels): ``operators.monitoring.hold`` with the
    same ``step_s``; a state older than a step is forgotten, as a later
    evaluation starts an island anyway."""
    step = int(step_s * 1e6)
    columns = ["eval_time", "condition", "hold_s", "severity", "labels"]

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        active, last, *held = state.get if state.exists else (None, None, [], [], [], [], [])
        ready, waiting = _in_order(pdfs, state, held, columns)
        if len(ready):
            t = ready["eval_time"].astype("int64").to_numpy()
            on = ready["condition"].astype(bool).to_numpy()
            before = [last if last is not None else t[0], *t[:-1]]
            begins = on & ((t - before > step) | ~pd.Series(on).shift(1, fill_value=active is not None).to_numpy())
            since = pd.Series(pd.array([x if b else None for x, b in zip(t, begins)], "Int64"))
            since = since.ffill().fillna(active if active is not None else 0).astype("int64")
            firing = (t - since) / 1e6 >= ready["hold_s"].to_numpy(float)
            out = pd.DataFrame({"alertname": key[0], "severity": ready["severity"].to_numpy(), "labels": ready["labels"].to_numpy(),
                                "eval_time": pd.to_datetime(t, unit="us"), "active_since": pd.to_datetime(since.to_numpy(), unit="us"),
                                "state": firing.map({True: "firing", False: "pending"}).to_numpy()})[on]
            active, last = (int(since.iloc[-1]) if on[-1] else None), int(t[-1])
            if len(out):
                yield out
        _keep(state, [active, last], waiting, last + step if active is not None else None)
    return fn


def hold_stream(evals: DataFrame, step_s: float) -> DataFrame:
    """L16 (stream): stateful hold keyed by (alertname, labels)."""
    evals = evals.withColumn("hold_s", F.col("hold_s").cast("double")).withColumn("condition", F.coalesce("condition", F.lit(False)))
    return evals.groupBy("alertname", "labels").applyInPandasWithState(
        make_hold(step_s), HOLD_OUT, HOLD_STATE, "append", GroupStateTimeout.EventTimeTimeout)


# --------------------------------------------------------------------------- L19 stream
ROUTE_STATE = "last_notify bigint, times array<bigint>, severities array<string>, labels array<string>"
ROUTE_OUT = "alertname string, severity string, labels string, eval_time timestamp, receiver string"


def make_throttle(receivers: dict[str, tuple[str, int]], default: tuple[str, int]) -> Callable:
    """Throttle of one (alertname, severity), as in ``operators.monitoring.route_alerts``;
    a notification is forgotten after the repeat interval, when it has no effect."""
    columns = ["eval_time", "severity", "labels"]

    def fn(key, pdfs, state: GroupState):
        last, *held = state.get if state.exists else (None, [], [], [])
        receiver, repeat_s = receivers.get(key[1], default)
        ready, waiting = _in_order(pdfs, state, held, columns)
        chosen, t = [], ready["eval_time"].astype("int64").to_numpy()
        at = 0
        while at < len(t):                               # one step per notification
            at = at if last is None else max(at, int(t.searchsorted(last + repeat_s * 1_000_000)))
            if at < len(t):
                chosen.append(at)
                last, at = int(t[at]), at + 1
        if chosen:
            out = ready.iloc[chosen]
            yield pd.DataFrame({"alertname": key[0], "severity": out["severity"].to_numpy(), "labels": out["labels"].to_numpy(),
                                "eval_time": pd.to_datetime(out["eval_time"].astype("int64").to_numpy(), unit="us"), "receiver": receiver})
        _keep(state, [last], waiting, None if last is None else last + repeat_s * 1_000_000)
    return fn


def route_stream(firing: DataFrame, receivers: dict[str, tuple[str, int]],
                 default: tuple[str, int]) -> DataFrame:
    """L19 (stream): exact repeat-interval throttle per (alertname, severity)."""
    return firing.groupBy("alertname", "severity").applyInPandasWithState(
        make_throttle(receivers, default), ROUTE_OUT, ROUTE_STATE, "append", GroupStateTimeout.EventTimeTimeout)


# --------------------------------------------------------------------------- L20 stream
def gap_stream(stream: DataFrame, gap_s: float, tag: str = "gaps", ts: str = "ts", watermark: str = "6 hours",
               base: str | None = None) -> DataFrame:
    """L20 (stream): silences longer than ``gap_s`` between consecutive events.

    The stream keeps the first and the last event time of every slice of
    ``gap_s`` seconds (an update-mode aggregate: late events inside the watermark
    correct their slice).  No silence fits inside a slice, so all of them lie
    between a slice's last event and the next slice's first one.
    """
    from ..operators.monitoring import prev_in_series
    slices = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark).groupBy(F.window(ts, f"{gap_s} seconds").alias("w")) \
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    seen = run_update(slices.select(F.col("w.start").alias("slice"), "first", "last"), ["slice"], tag, base=base)
    ends = seen.select(F.explode(F.array(epoch_us("first"), epoch_us("last"))).alias("t_us")).distinct()
    p = prev_in_series(ends.withColumn("_bucket", F.floor(F.col("t_us") / (3600 * 1_000_000))), [], "t_us", ["t_us"], "_bucket")
    gap = (F.col("t_us") - F.col("prev_t_us")) / 1e6
    return p.where(gap > gap_s).select(from_epoch_us("prev_t_us").alias("silent_from"), from_epoch_us("t_us").alias("silent_to"), gap.alias("gap_s"))


def sessions(stream: DataFrame, gap: str, by: list[str] | None = None) -> DataFrame:
    """L20 (stream): activity sessions; a silence longer than ``gap`` closes a
    session (``session_window``)."""
    return (stream.groupBy(F.session_window("ts", gap).alias("s"), *(by or []))     # append mode: when the watermark passes its end
            .agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("last_ts"), F.min("ts").alias("first_ts"))
            .select(*(by or []), F.col("s.start").alias("session_start"), "first_ts", "last_ts", "events"))


def drift_windows(stream: DataFrame, feats: list[str], ref: DataFrame, ts: str = "ts", window: str = "1 hour") -> DataFrame:
    """L10 / L11 (stream): a row per closed window and feature with its mean, deviation
    and drift score against the reference table (one row a feature, joined to the
    stream's small aggregate).  ``w`` stays, so the rows can be aggregated again."""
    from ..operators.monitoring import drift_score
    wide = stream.groupBy(F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.struct(F.lit(f).alias("feature"), F.avg(f).alias("cur_mean"), F.stddev_pop(f).alias("cur_std")) for f in feats]).alias("_s"))
    return drift_score(wide.select("w", "n", F.inline("_s")), ref)


def drift_summary(windows: DataFrame, span: str = "6 hours") -> DataFrame:
    """L14 (stream): per feature and ``span`` the windows seen, those with drift and with
    severe drift, and the worst score: a second windowed aggregate over the first
    one's closed windows, both under the one watermark (append mode)."""
    return (windows.groupBy(F.window(F.window_time("w"), span).alias("s"), "feature")
            .agg(F.count(F.lit(1)).alias("windows"), F.sum("drift_detected").alias("drifted"),
                 F.sum("severe_drift").alias("severe"), F.max("drift_score").alias("worst"))
            .select(F.col("s.start").alias("span_start"), "feature", "windows", "drifted", "severe", "worst"))


def replay_folder(df: DataFrame, at: str, tag: str, files: int = 4, past: timedelta = timedelta(days=3650)) -> str:
    """Write a table as ``files`` files of equal spans of time, one after the other, and
    end it (``close_folder``, ``past``).  A file stream takes files by their time of writing,
    so the replay comes in event-time order, a file a micro-batch.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    lo, hi = df.agg(F.min(epoch_us(at)), F.max(epoch_us(at))).first()
    part = F.least(F.lit(files - 1), F.floor((epoch_us(at) - F.lit(lo)) * files / F.lit(max(1, (hi or 0) - (lo or 0)))))
    for i in range(files):
        df.where(part == i).sort(at).coalesce(1).write.mode("append").parquet(path)
    close_folder(spark, path, at, past)
    return path
