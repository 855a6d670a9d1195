"""Counters with resets, exact Euclidean silhouette, global row numbers, closed pivots."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from memberlens.functions.scalar import inv_norm_cdf
from memberlens.operators import aggregates as D
from memberlens.operators import ml as ML
from memberlens.operators.counters import counter_increases, counter_rate
from memberlens.operators.metrics import confusion
from memberlens.operators.ranks import global_row_number

START = dt.datetime(2024, 1, 1)


def samples(spark, rows):
    return spark.createDataFrame([(k, START + dt.timedelta(minutes=m), v) for k, m, v in rows], "k string, t timestamp_ntz, value bigint")


def expected(points, lo, hi):
    """Increase of one range by a plain walk over its samples (minutes, values)."""
    inside = [(m, v) for m, v in points if lo <= m < hi]
    if len(inside) < 2:
        return None
    grown = sum(v - u if v >= u else v for (_, u), (_, v) in zip(inside, inside[1:]))
    resets = sum(v < u for (_, u), (_, v) in zip(inside, inside[1:]))
    span = inside[-1][0] - inside[0][0]
    mean = span / (len(inside) - 1)
    before, after = inside[0][0] - lo, hi - inside[-1][0]
    if grown > 0:
        before = min(before, span * inside[0][1] / grown)
    reach = lambda x: x if x < 1.1 * mean else mean / 2
    return len(inside), resets, grown * (span + reach(before) + reach(after)) / span


def test_counter_rate_equals_a_walk_over_the_samples(spark):
    rnd, rows = random.Random(1), []
    for k in "abc":
        v = 0
        for m in sorted(rnd.sample(range(1, 4000), 260)):        # uneven scrapes over three days
            v = rnd.randint(0, 5) if rnd.random() < 0.05 else v + rnd.randint(0, 9)
            rows.append((k, m, v))
    got = {(r.k, r.window_start): (r.samples, r.resets, r.increase) for r in counter_rate(samples(spark, rows), ["k"]).collect()}
    want = {}
    for k in "abc":
        points = [(m, v) for c, m, v in rows if c == k]
        for lo in range(-60, 4020, 60):
            e = expected(points, lo, lo + 120)
            if e:
                want[k, START + dt.timedelta(minutes=lo)] = e
    assert set(got) == set(want) and sum(r for _, r, _ in want.values()) > 20
    for w in want:
        assert got[w][0] == want[w][0] and got[w][2] == pytest.approx(want[w][2])


def test_planted_reset(spark):
    rows = [("a", 10 * i, v) for i, v in enumerate([100, 130, 160, 20, 50, 80])]
    s = samples(spark, rows)
    assert [r.growth for r in counter_increases(s, ["k"]).orderBy("t").collect()] == [None, 30, 30, 20, 30, 30]
    r = counter_rate(s, ["k"], "60 minutes", "60 minutes", 3600.0).collect()[0]
    assert (r.samples, r.resets) == (6, 1) and r.increase == pytest.approx(140 * 60 / 50) and r.rate == pytest.approx(r.increase / 3600)
    assert counter_rate(samples(spark, [("a", 5, 7)]), ["k"]).count() == 0      # one sample tells no growth


def brute_silhouette(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = (c == c[i]) & (np.arange(len(x)) != i)
        others = [d[i, c == o].mean() for o in set(c.tolist()) if o != c[i]]
        if not own.any() or not others:
            out.append(0.0)
            continue
        a, b = d[i, own].mean(), min(others)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return out


@pytest.mark.parametrize("block", [16, 4096])
def test_exact_silhouette_in_blocks(spark, block):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 3))
    c = np.where(np.arange(120) < 90, 0, rng.integers(1, 4, 120))       # one cluster holds most rows
    c[119] = 9                                                          # and one a single row
    x[5] = x[6]
    d = spark.createDataFrame([(i, x[i].tolist(), int(c[i])) for i in range(120)], "id int, v array<double>, c int")
    got = {r.id: r.silhouette for r in ML.silhouette_exact(d, "id", "v", "c", block).collect()}
    assert [got[i] for i in range(120)] == pytest.approx(brute_silhouette(x, c))
    one = ML.silhouette_exact(d.where("c = 0"), "id", "v", "c", block).collect()
    assert len(one) == 90 and {r.silhouette for r in one} == {0.0}
    assert ML.silhouette_exact(d.limit(0), "id", "v", "c", block).collect() == []


def test_exact_silhouette_of_many_clusters(spark, monkeypatch):
    """More clusters than a task holds sums of, in blocks of few rows; labels are texts, one of them null."""
    monkeypatch.setattr(ML, "SILHOUETTE_CLUSTERS", 4)
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(150, 2)), np.arange(150) % 40
    d = spark.createDataFrame([(i, x[i].tolist(), f"c{c[i]}" if c[i] else None) for i in range(150)], "id int, v array<double>, c string")
    out = ML.silhouette_exact(d, "id", "v", "c", 16).collect()
    got = {r.id: r.silhouette for r in out}
    assert len(out) == 150 and {r.id: r.c for r in out} == {i: f"c{c[i]}" if c[i] else None for i in range(150)}
    assert [got[i] for i in range(150)] == pytest.approx(brute_silhouette(x, c))
    with pytest.raises(Exception, match="differ in length"):
        ML.silhouette_exact(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0, 3.0], 1)], "id int, v array<double>, c int"), "id", "v", "c")


def test_exact_silhouette_shuffles_no_vectors_per_pair_of_blocks(spark):
    d = spark.createDataFrame([(i, [float(i), 1.0], i % 3) for i in range(90)], "id int, v array<double>, c int")
    plan = ML.silhouette_exact(d, "id", "v", "c", 8)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "CartesianProduct" in below and "Exchange" not in below and "CoGroup" not in plan


def test_exact_silhouette_golden(spark, fixture_panel):
    """0.6276 of the published clustering: 6 units, k = 3, average members and leak rate, scaled."""
    from memberlens.catalog.extra_queries import _kmeans_np
    prof = fixture_panel.groupBy("unit").agg(F.avg("members").alias("m"), F.avg("leak_rate").alias("l")).toPandas().sort_values("unit")
    z = prof[["m", "l"]].to_numpy(float)
    z = (z - z.mean(0)) / z.std(0)
    label = _kmeans_np(z, 3, 10, 42)
    d = spark.createDataFrame([(i, z[i].tolist(), int(label[i])) for i in range(6)], "id int, v array<double>, c int")
    got = ML.silhouette_exact(d, "id", "v", "c", 2).agg(F.avg("silhouette")).first()[0]
    assert got == pytest.approx(float(np.mean(brute_silhouette(z, label))))


def test_global_row_number(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([None, 1.5, -2.0, float("inf"), rnd.random()])) for i in range(3000)]
    d = spark.createDataFrame(rows, "id int, x double").repartition(7)
    got = global_row_number(d, ["x", "id"], "r", "n").collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[0]))
    assert [(r.id, r.x) for r in sorted(got, key=lambda r: r.r)] == want and {r.n for r in got} == {3000}
    assert global_row_number(d.limit(0), ["x"]).collect() == []


def test_known_normal_quantiles(spark):
    p = [0.001, 0.01, 0.025, 0.5, 0.84134474607, 0.95, 0.975, 0.999]
    z = [-3.090232, -2.326348, -1.959964, 0.0, 1.0, 1.644854, 1.959964, 3.090232]
    got = spark.createDataFrame([(x,) for x in p], "p double").select(inv_norm_cdf(F.col("p")).alias("z")).collect()
    assert [r.z for r in got] == pytest.approx(z, abs=1e-6)


@pytest.mark.parametrize("value", [2, None])
def test_pivots_do_not_lose_values(spark, value):
    ok, bad = [(0, 1), (1, 1), (1, 0)], [(0, value)]
    d = lambda rows: spark.createDataFrame(rows, "label int, pred int")
    assert {r.actual: (r.pred_0, r.pred_1) for r in confusion(d(ok)).collect()} == {0: (0, 1), 1: (1, 1)}
    with pytest.raises(Exception, match="not one of"):
        confusion(d(ok + bad)).collect()
    with pytest.raises(Exception, match="not one of"):
        D.crosstab(d(ok + bad), "label", "pred", [0, 1]).collect()
    long = spark.createDataFrame([(1, "a", 1.0), (1, "new", 2.0)], "unit int, model string, forecast double")
    with pytest.raises(Exception, match="not one of"):
        D.forecast_table(long, ["a"]).collect()
    assert D.forecast_table(long, ["a", "new"]).first()["new"] == 2.0


def events(spark, rows):
    """(minute, user, value, key) as event rows."""
    return spark.createDataFrame([(i, START + dt.timedelta(minutes=m), u, "click", v, f'{{"k": {k}}}') for i, (m, u, v, k) in enumerate(rows)],
                                 "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")


def test_two_chained_windows_over_batches_with_late_rows(spark):
    """Hourly drift and its 6-hour summary equal a batch over all rows, with rows up to an hour late in later files."""
    from memberlens.streaming import streams as ST
    rnd = random.Random(6)
    rows = sorted((rnd.randrange(0, 3000), 1, rnd.choice([20.0, 40.0, 90.0]) + rnd.random(), 0) for _ in range(900))
    path = ST.scratch_path(spark, "late")
    files = [rows[:300], rows[300:600], rows[600:]]
    files[1] += [(files[0][-1][0] - 40, 1, 500.0, 0)]             # late, inside the watermark of two hours
    for f in files:
        events(spark, f).coalesce(1).write.mode("append").parquet(path)
    ST.close_folder(spark, path, "ts")
    ref = spark.createDataFrame([("value", 40.0, 20.0)], "feature string, ref_mean double, ref_std double")
    s = ST.folder_stream(spark, path, events(spark, []).schema).withWatermark("ts", "2 hours")
    out = ST.run_append(ST.drift_summary(ST.drift_windows(s, ["value"], ref)), "late")
    by_hour = {}
    for m, _, v, _ in (r for f in files for r in f):
        by_hour.setdefault(m // 60, []).append(v)
    want = {}
    for h, v in by_hour.items():
        score = round(min(1.0, (0.6 * abs(np.mean(v) - 40) / (20 + 1e-9) + 0.4 * abs(np.std(v) - 20) / (20 + 1e-9)) / 3), 4)
        want.setdefault(h // 6, []).append(score)
    got = {int((r.span_start - START).total_seconds() // 21600): r for r in out.collect()}
    assert set(got) == set(want)
    for k, scores in want.items():
        assert (got[k].windows, got[k].drifted, got[k].severe) == (len(scores), sum(x > 0.3 for x in scores), sum(x > 0.6 for x in scores))
        assert got[k].worst == pytest.approx(max(scores), abs=2e-4)


def test_sessions_over_batches(spark):
    from memberlens.streaming import streams as ST
    rows = [(0, 1, 1.0, 0), (15, 1, 1.0, 0), (50, 1, 1.0, 0), (5, 2, 1.0, 0), (400, 1, 1.0, 0), (405, 2, 1.0, 0), (410, 1, 1.0, 0)]
    path = ST.replay_folder(events(spark, rows), "ts", "sess", files=3)
    s = ST.folder_stream(spark, path, events(spark, []).schema).withWatermark("ts", "1 hour")
    got = ST.run_append(ST.sessions(s, "20 minutes", ["user_id"]), "sess").collect()
    minute = lambda t: int((t - START).total_seconds() // 60)
    assert sorted((r.user_id, minute(r.first_ts), minute(r.last_ts), r.events) for r in got) == \
        [(1, 0, 15, 2), (1, 50, 50, 1), (1, 400, 410, 2), (2, 5, 5, 1), (2, 405, 405, 1)]
