"""Stream = batch, late data inside / beyond the watermark, stateful hold."""

import os
from datetime import timedelta

import pandas as pd
from pyspark.sql import functions as F

from memberlens.operators import monitoring as L
from memberlens.plans.panel import load_requests
from memberlens.streaming import alert_chain as AC
from memberlens.streaming import streams as ST

from .conftest import SF_SMALL


def _write_parts(spark, df, root, n_parts):
    """Split a frame by time into ordered files (one micro-batch each)."""
    pdf = df.orderBy("ts").toPandas()
    size = len(pdf) // n_parts + 1
    for i in range(n_parts):
        chunk = pdf.iloc[i * size:(i + 1) * size]
        spark.createDataFrame(chunk, df.schema).coalesce(1).write.parquet(os.path.join(root, f"part{i:02d}"))


def test_windowed_counts_stream_equals_batch_with_late_data(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    root = str(tmp_path / "ev")
    _write_parts(spark, ev, root, 4)
    last = ev.agg(F.max("ts")).first()[0]
    inside = last - pd.Timedelta(minutes=30)       # within the 2 h watermark
    beyond = last - pd.Timedelta(days=3)           # far behind the watermark
    late = spark.createDataFrame(
        [(10_000_001, inside, 1, "error", 40.0, '{"k": 1}'), (10_000_002, beyond, 1, "error", 40.0, '{"k": 1}')],
        ev.schema)
    late.coalesce(1).write.parquet(os.path.join(root, "part99"))

    files = sorted(os.path.join(dp, f) for dp, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))
    flat = str(tmp_path / "flat")
    os.makedirs(flat)
    for i, f in enumerate(files):
        os.link(f, os.path.join(flat, f"f{i:03d}.parquet"))
    s = ST.folder_stream(spark, flat, ev.schema, max_files=1)
    res = ST.run_update(L.request_counts(ST.requests_from_events(s)), ["window_start", "endpoint", "status"], "t")
    got = {(r["window_start"].replace(tzinfo=None), r["endpoint"], r["status"]): r["requests"] for r in res.collect()}

    k = F.get_json_object("props", "$.k").cast("int")

    def batch_counts(frame):
        breq = frame.select(F.col("ts"), F.concat(F.lit("ep"), (k % 4).cast("string")).alias("endpoint"),
                            F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
                            (F.col("value") / 50.0).alias("latency_s"))
        return {(r["window_start"], r["endpoint"], r["status"]): r["requests"] for r in L.request_counts(breq).collect()}

    # Spark's contract: data within the watermark delay is always counted;
    # data beyond it may or may not be (its window state is already evicted).
    with_inside = batch_counts(ev.unionByName(late.where(F.col("event_id") == 10_000_001)))
    with_both = batch_counts(ev.unionByName(late))
    assert got in (with_inside, with_both)
    inside_key = [key for key in with_inside if with_inside[key] != batch_counts(ev).get(key)]
    assert inside_key and all(got[key] == with_inside[key] for key in inside_key)


def test_alert_hold_stream_equals_batch(spark, tmp_path):
    req = load_requests(spark, SF_SMALL)
    ev = L.evaluate_rules(L.metrics_long(req), L.rules_frame(spark)).cache()
    batch = L.hold(ev, ["alertname", "labels"], step_s=3600).where("condition") \
        .select("alertname", "labels", F.col("eval_time").cast("string").alias("t"), "state")
    evs = ev.select("alertname", "severity", "labels", F.col("eval_time").cast("timestamp").alias("eval_time"),
                    "condition", "hold_s")
    # evaluations arrive in time order, three micro-batches
    root = str(tmp_path / "evals")
    _write_parts(spark, evs.withColumnRenamed("eval_time", "ts"), root, 3)
    flat = str(tmp_path / "evf")
    os.makedirs(flat)
    files = sorted(os.path.join(dp, f) for dp, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))
    for i, f in enumerate(files):
        os.link(f, os.path.join(flat, f"f{i:03d}.parquet"))
    ST.close_folder(spark, flat, "ts")
    schema = spark.read.parquet(flat).withColumnRenamed("ts", "eval_time").schema
    s = ST.folder_stream(spark, flat, spark.read.parquet(flat).schema, max_files=1) \
        .withColumnRenamed("ts", "eval_time").withWatermark("eval_time", "6 hours")
    assert schema.fieldNames() == s.columns
    out = ST.run_append(ST.hold_stream(s, 3600), "t-hold") \
        .select("alertname", "labels", F.col("eval_time").cast("timestamp_ntz").cast("string").alias("t"), "state")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, out.collect()))


def test_gap_stream_equals_batch(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("ts")
    root = str(tmp_path / "g")
    pdf = ev.orderBy("ts").toPandas()
    for i, chunk in enumerate([pdf.iloc[:300], pdf.iloc[300:650], pdf.iloc[650:]]):
        spark.createDataFrame(chunk, ev.schema).coalesce(1).write.parquet(os.path.join(root, f"p{i}"))
    flat = str(tmp_path / "gf")
    os.makedirs(flat)
    files = sorted(os.path.join(dp, f) for dp, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))
    for i, f in enumerate(files):
        os.link(f, os.path.join(flat, f"f{i:03d}.parquet"))
    got = ST.gap_stream(ST.folder_stream(spark, flat, ev.schema, max_files=1), 1200.0)
    exp = L.silence_gaps(ev, 1200.0)
    key = lambda df: sorted((str(r["silent_from"]), str(r["silent_to"]), round(r["gap_s"], 6)) for r in df.collect())
    assert key(got) == key(exp)
    assert len(key(exp)) > 0


def test_throttle_stream_one_notification_per_interval(spark):
    rows = [("A", "critical", "ep0", f"2024-01-01 00:{m:02d}:00") for m in range(0, 40, 5)]
    df = spark.createDataFrame(rows, "alertname string, severity string, labels string, t string") \
        .withColumn("eval_time", F.col("t").cast("timestamp")).drop("t")
    path = ST.scratch_path(spark, "t-route")
    df.coalesce(1).write.parquet(path)          # one ordered file
    ST.close_folder(spark, path, "eval_time")
    s = ST.folder_stream(spark, path, spark.read.parquet(path).schema).withWatermark("eval_time", "1 hour")
    out = ST.run_append(ST.route_stream(s, {"critical": ("critical-receiver", 900)}, ("log-receiver", 3600)), "t-r")
    minutes = sorted(r["eval_time"].minute for r in out.collect())
    assert minutes == [0, 15, 30]


def _replay(spark, rows, schema, at, build, watermark="1 hour"):
    """Each row a micro-batch of its own, in the given order, then the end."""
    path = ST.scratch_path(spark, "t-replay")
    for r in rows:
        spark.createDataFrame([r], schema).withColumn(at, F.col(at).cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    ST.close_folder(spark, path, at)
    s = ST.folder_stream(spark, path, spark.read.parquet(path).schema).withWatermark(at, watermark)
    return ST.run_append(build(s), "t-replay-out")


def test_hold_stream_takes_out_of_order_evaluations(spark):
    rows = [("A", "warning", "x", f"2024-01-01 00:{m:02d}:00", True, 600.0) for m in (10, 5, 20)]
    schema = "alertname string, severity string, labels string, eval_time string, condition boolean, hold_s double"
    out = _replay(spark, rows, schema, "eval_time", lambda s: ST.hold_stream(s, 3600)).collect()
    assert sorted((r.eval_time.minute, r.active_since.minute, r.state) for r in out) == [
        (5, 5, "pending"), (10, 5, "pending"), (20, 5, "firing")]


def test_throttle_stream_takes_out_of_order_firings(spark):
    rows = [("A", "critical", "x", f"2024-01-01 00:{m:02d}:00") for m in (20, 0, 14, 16)]
    build = lambda s: ST.route_stream(s, {"critical": ("critical-receiver", 900)}, ("log-receiver", 3600))
    out = _replay(spark, rows, "alertname string, severity string, labels string, eval_time string", "eval_time", build).collect()
    assert sorted(r.eval_time.minute for r in out) == [0, 16]


def test_gap_stream_takes_late_events(spark):
    path = ST.scratch_path(spark, "t-late")
    for t in ("00:00", "02:00", "01:00", "02:05"):
        spark.createDataFrame([(f"2024-01-01 {t}:00",)], "ts string").select(F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    got = ST.gap_stream(ST.folder_stream(spark, path, spark.read.parquet(path).schema), 1200.0)
    assert sorted(r.gap_s for r in got.collect()) == [3600.0, 3600.0]


def test_batch_hold_breaks_at_a_missing_evaluation(spark):
    rows = [("A", "x", "2024-01-01 00:00:00", True), ("A", "x", "2024-01-02 00:00:00", True), ("B", "x", "2024-01-02 00:00:00", False)]
    ev = spark.createDataFrame(rows, "alertname string, labels string, t string, condition boolean") \
        .withColumn("eval_time", F.col("t").cast("timestamp")).withColumn("hold_s", F.lit(0.0))
    st = L.hold(ev, ["alertname", "labels"], step_s=3600).withColumn("hold_s", F.lit(0.0))
    assert {(r.eval_time, r.active_since) for r in st.where("alertname = 'A'").collect()} == {(r.eval_time, r.eval_time) for r in st.where("alertname = 'A'").collect()}
    tr = L.alert_transitions(st, ["alertname", "labels"], step_s=3600)
    assert sorted((str(r.eval_time), r.status) for r in tr.collect()) == [
        ("2024-01-01 00:00:00", "firing"), ("2024-01-01 01:00:00", "resolved"), ("2024-01-02 00:00:00", "firing")]


def test_batch_throttle_keeps_the_repeat_interval(spark):
    rows = [("A", "critical", "x", f"2024-01-01 00:{m:02d}:00") for m in (14, 16, 29, 31)]
    f = spark.createDataFrame(rows, "alertname string, severity string, labels string, t string").withColumn("eval_time", F.col("t").cast("timestamp"))
    assert sorted(r.notify_time.minute for r in L.route_alerts(f).collect()) == [14, 29]


EVALS = "alertname string, severity string, labels string, eval_time string, condition boolean, hold_s double"


def _chain(spark, batches, build, past, watermark="1 hour"):
    """Each list of rows a micro-batch, in the given order, then the end."""
    path = ST.scratch_path(spark, "t-chain")
    for rows in batches:
        spark.createDataFrame(rows, EVALS).withColumn("eval_time", F.col("eval_time").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    ST.close_folder(spark, path, "eval_time", past)
    s = ST.folder_stream(spark, path, spark.read.parquet(path).schema).withWatermark("eval_time", watermark)
    return AC.run_chain(build(s), "t-chain-out").collect()


def _at(day_hour, on=True, label="x", name="A", severity="critical", hold=3600.0):
    return (name, severity, label, f"2024-01-{day_hour}:00:00", on, hold)


def test_lifecycle_stream_takes_late_rows_and_resolves_vanished_series(spark):
    batches = [[_at("01 02"), _at("01 00"), _at("01 00", label=None)], [_at("01 01"), _at("01 04", name="B")],
               [_at("01 03", on=False), _at("01 04")], [_at("01 05")], [_at("02 00")]]
    out = _chain(spark, batches, lambda s: AC.lifecycle(s, 3600), timedelta(hours=1, milliseconds=2), "4 hours")
    changes = sorted((r.eval_time.strftime("%d %H"), r.status) for r in out if r.alertname == "A" and r.labels == "x" and r.status)
    assert changes == [("01 01", "firing"), ("01 03", "resolved"), ("01 05", "firing"), ("01 06", "resolved")]
    assert {(r.alertname, r.status) for r in out if r.alertname == "B" or r.labels is None} == {("A", None), ("B", None)}
    # the batch form on the same rows
    ev = spark.createDataFrame([r for b in batches for r in b], EVALS).withColumn("eval_time", F.col("eval_time").cast("timestamp"))
    states = L.hold(ev, ["alertname", "labels"], step_s=3600)
    want = L.alert_transitions(states, ["alertname", "labels"], step_s=3600).collect()
    assert sorted((r.alertname, r.labels, str(r.eval_time), r.status) for r in want) == \
        sorted((r.alertname, r.labels, str(r.eval_time), r.status) for r in out if r.status)


def test_notification_chain_equals_batch_and_notifies_at_once(spark):
    hot = [[_at(f"01 {h:02d}", label=f"l{i}", severity=sev, name=sev, hold=0.0) for i in range(3) for sev in ("critical", "warning")
            if (h + i) % 4] for h in (0, 2, 1, 3, 5, 4, 9)]
    receivers = {"critical": ("critical-receiver", 7200)}
    out = _chain(spark, hot, lambda s: AC.notifications(AC.lifecycle(s, 3600), receivers, ("log-receiver", 10800)), timedelta(days=30), "2 hours")
    firing, want = {}, []
    for name, _, label, t, _, _ in (r for b in hot for r in b):
        firing.setdefault(name, []).append((t, label))
    hour = lambda t: int(t[11:13])
    for name, alerts in firing.items():                   # brute force: walk a group's alerts in order
        repeat, began = (2 if name == "critical" else 3), None
        for t, label in sorted(alerts):
            if began is None or hour(t) - began >= repeat:
                began = hour(t)
                want.append([name, began, 0, set()])
            want[-1][2] += 1
            want[-1][3].add(label)
    assert sorted((r.alertname, r.notify_time.hour, r.n_alerts, tuple(r.labels)) for r in out if r.kind == "closed") == \
        sorted((n, h, c, tuple(sorted(s))) for n, h, c, s in want)
    at_once = {(r.alertname, r.notify_time): r for r in out if r.kind == "notify"}
    for r in out:
        if r.kind == "closed":
            first = at_once.pop((r.alertname, r.notify_time))
            assert first.emitted <= r.emitted and set(first.labels) <= set(r.labels) and first.n_alerts <= r.n_alerts
    assert not at_once


def test_chain_of_an_empty_stream_is_empty(spark):
    path = ST.scratch_path(spark, "t-none")
    spark.createDataFrame([], EVALS).withColumn("eval_time", F.col("eval_time").cast("timestamp")).write.parquet(path)
    s = ST.folder_stream(spark, path, spark.read.parquet(path).schema).withWatermark("eval_time", "1 hour")
    assert AC.run_chain(AC.notifications(AC.lifecycle(s, 3600), {}, ("log-receiver", 60)), "t-none-out").count() == 0


def test_streams_read_tables_of_several_files(spark, tmp_path):
    """A table may be a folder of files: its streams read all of them, one batch a file where asked."""
    from memberlens.catalog import QUERIES
    one, many = SF_SMALL, str(tmp_path)
    docs = spark.read.parquet(f"{one}/documents.parquet")
    docs.repartition(3, "doc_id").write.parquet(f"{many}/documents.parquet")
    docs.limit(0).coalesce(1).write.mode("append").parquet(f"{many}/documents.parquet")      # and a file without rows
    for t in ("events", "customer", "orders"):
        spark.read.parquet(f"{one}/{t}.parquet").repartition(3).write.parquet(f"{many}/{t}.parquet")
    got = QUERIES["stream_ingest_profile"](spark, many).collect()
    assert sorted(r.batch_id for r in got) == [0, 1, 2, 3] and sum(r.n_rows for r in got) == docs.count()
    assert [r.mean_chars for r in got if not r.n_rows] == [None] and all(r.missing_ratio != r.missing_ratio for r in got if not r.n_rows)
    whole = QUERIES["stream_ingest_profile"](spark, one).first()
    assert abs(sum(r.n_rows * (r.mean_chars or 0.0) for r in got) / whole.n_rows - whole.mean_chars) < 1e-4
    for q in ("stream_request_counts", "stream_score", "stream_silence_gaps"):
        a, b = (sorted(map(str, QUERIES[q](spark, d).collect())) for d in (one, many))
        assert a and a == b, q
