"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then timed ``BENCH_REPEAT`` times (median)
with a full materialisation through the ``noop`` sink (the whole plan runs,
nothing is collected to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    # panel build + features (orders x customer, one shuffle per stage)
    "panel", "feature_panel", "retained_semi", "unit_profile", "metrics_grouping_sets",
    "next_period_features", "best_model", "adf_stat", "kpss_stat", "ar1_forecast",
    # monitoring over events
    "request_counts", "bucket_quantile", "error_ratio", "active_requests", "silence_gaps",
    "drift_score", "degradation", "alert_hold", "alert_route", "inhibit_anti",
    # ML / anomaly / metrics
    "zscore_anomaly", "lof", "silhouette", "davies_bouldin", "roc_curve", "auc", "ridge_loo",
    # ledger and streaming forms
    "best_runs", "promote", "stream_request_counts", "stream_alert_hold",
    # work that grows with the data: one series per customer, one row per order
    "cust_ar1_forecast", "cust_backtest_metrics", "order_zscore", "order_isolation_forest",
]


def main():
    from memberlens.catalog import QUERIES
    from memberlens.session import get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-ckpt-")})

    def run(name):
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for name in names:
        run(name)                                    # warm-up (JIT, file listing, codegen)
        times[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
        spark.catalog.clearCache()                   # no cached frames carried into the next query
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": int(cpus), "repeat": repeat, "streaming": stream_replay(spark, sf_dir)}))


def stream_replay(spark, sf_dir):
    """Replay ``events`` through the windowed request counters (update mode)
    and report input rows per second and the state size."""
    from memberlens.operators import monitoring as L
    from memberlens.streaming import streams as ST
    s = ST.request_stream(spark, sf_dir)
    agg = L.request_counts(s)
    base = ST.scratch_path(spark, "bench-stream")
    t0 = time.perf_counter()
    q = (agg.writeStream.outputMode("update").format("noop")
         .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    wall = time.perf_counter() - t0
    prog = q.recentProgress
    rows = sum(p["numInputRows"] for p in prog)
    state = sum(op.get("numRowsTotal", 0) for op in (prog[-1].get("stateOperators", []) if prog else []))
    return {"query": "request_counts", "input_rows": rows, "wall_sec": round(wall, 3),
            "rows_per_sec": round(rows / wall, 1) if wall else None, "state_rows": state}


if __name__ == "__main__":
    main()
