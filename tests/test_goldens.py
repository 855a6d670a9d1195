"""Golden checks on the reference's 18-row panel (values typed from its
committed data and result files)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from memberlens.functions.scalar import leak_rate_expr
from memberlens.operators import anomaly as A
from memberlens.operators import metrics as M
from memberlens.operators import ml as ML
from memberlens.operators import monitoring as L
from memberlens.operators import timeseries as TS
from memberlens.operators import windows as W

REG_FEATS = ["members_lag1", "leak_rate_lag1", "growth_rate_lag1", "delta_members_lag1",
             "avg_members_unite_past", "season_index", "unit", "retention_rate", "members_x_retention"]
ANOM_FEATS = ["members", "leak_rate", "growth_rate", "delta_members", "retention_rate",
              "members_x_retention", "deviation_from_avg"]


def test_leak_rate_formula(fixture_panel):
    got = fixture_panel.select("leak_rate", leak_rate_expr("members_prev", "members").alias("q5")).collect()
    assert all(abs(r["leak_rate"] - r["q5"]) < 1e-9 for r in got)


def test_feature_frame_drops_first_season(fixture_panel):
    f = W.build_features(fixture_panel).orderBy("unit", "period").collect()
    assert len(f) == 12
    u1 = [r for r in f if r["unit"] == 1]
    assert u1[0]["members_lag1"] == 45 and u1[0]["growth_rate_lag1"] is None
    assert u1[1]["growth_rate_lag1"] == pytest.approx((25 - 45) / 45 * 100)
    assert u1[1]["avg_members_unite_past"] == pytest.approx(35.0)
    assert u1[1]["season_index"] == 3


def test_global_carry_reproduces_ungrouped_shift(fixture_panel):
    g = W.lagged_growth(fixture_panel, carry="global").orderBy("unit", "period").collect()
    first_of_unit2 = [r for r in g if r["unit"] == 2][0]
    assert first_of_unit2["growth_rate_lag1"] == pytest.approx(-52.0)
    assert first_of_unit2["delta_members_lag1"] == pytest.approx(-13.0)


def _regression_frame(fixture_panel):
    return W.build_features(fixture_panel, carry="global", first_fill="self", drop_first=False, fill_zero=True)


def test_ridge_loo_matches_published_metrics(fixture_panel):
    f = _regression_frame(fixture_panel)
    loo = ML.ridge_loo(f, REG_FEATS, "members", 0.01, ["unit", "period"])
    m = M.regression_metrics(loo, "members", "loo_pred").first()
    assert m["mse"] == pytest.approx(27.685, abs=5e-4)
    assert m["rmse"] == pytest.approx(5.262, abs=5e-4)
    assert m["mae"] == pytest.approx(3.924, abs=5e-4)
    assert m["r2"] == pytest.approx(0.770, abs=5e-4)


def test_ridge_loo_equals_brute_force_refits(fixture_panel):
    f = _regression_frame(fixture_panel).orderBy("unit", "period").toPandas()
    X = f[REG_FEATS].to_numpy(float)
    y = f["members"].to_numpy(float)
    alpha = 0.01
    preds = []
    for i in range(len(y)):
        tr = np.arange(len(y)) != i
        mu, sd = X[tr].mean(0), X[tr].std(0)
        sd[sd == 0] = 1
        Z = (X[tr] - mu) / sd
        zc = Z - Z.mean(0)
        w = np.linalg.solve(zc.T @ zc + alpha * np.eye(X.shape[1]), zc.T @ (y[tr] - y[tr].mean()))
        preds.append(max(0.0, y[tr].mean() + ((X[i] - mu) / sd - Z.mean(0)) @ w))
    spark_preds = (ML.ridge_loo(_regression_frame(fixture_panel), REG_FEATS, "members", alpha, ["unit", "period"])
                   .orderBy("unit", "period").toPandas()["loo_pred"].to_numpy())
    assert np.allclose(spark_preds, preds, atol=1e-7)


def test_ridge_next_period_forecasts(fixture_panel):
    coefs = ML.ridge_fit(_regression_frame(fixture_panel), REG_FEATS, "members", 0.01)
    nxt = W.next_period_features(fixture_panel)
    pred = ML.linear_score(nxt, coefs, "pred").orderBy("unit").collect()
    assert [round(r["pred"], 1) for r in pred] == [26.3, 14.6, 13.4, 14.3, 10.3, 15.3]
    assert [r["season_index"] for r in pred] == [4] * 6


def test_naive_forecast_metrics_equal_published_sarima(fixture_panel):
    bt = TS.backtest(fixture_panel, model="naive")
    m = M.regression_metrics(bt, "y", "pred").first()
    assert m["n"] == 12
    assert m["mae"] == pytest.approx(8.5)
    assert m["mse"] == pytest.approx(122.5)
    assert m["mape"] == pytest.approx(54.37, abs=5e-3)
    assert m["r2"] == pytest.approx(-2.326, abs=5e-4)


def _anomaly_frame(fixture_panel):
    w = W.unit_window()
    m = F.col("members").cast("double")
    return fixture_panel.select(
        (F.col("unit") * 10000 + F.col("period")).cast("bigint").alias("id"), "unit", "period",
        m.alias("members"), "leak_rate",
        F.coalesce(W.pct_change("members", w) * 100.0, F.lit(0.0)).alias("growth_rate"),
        F.coalesce(W.diff("members", w).cast("double"), F.lit(0.0)).alias("delta_members"),
        (1 - F.col("leak_rate") / 100.0).alias("retention_rate"),
        (m * (1 - F.col("leak_rate") / 100.0)).alias("members_x_retention"),
        (m - W.past_mean("members", w, "self")).alias("deviation_from_avg"))


# Published zscore_max and lof_score per row (unit-major order).
ZSCORE_MAX = [2.3829648062365982, 1.9769358043387675, 2.0780376109839396, 1.967911037214628,
              2.231113264896609, 2.022232365289274, 0.8927208954004794, 0.7204834529188301,
              0.6424555918517635, 1.4698465143882637, 1.4685808832230844, 0.9673416659784653,
              0.8927208954004794, 0.8245689879672239, 1.0066823840826844, 1.0066823840826844,
              1.4947870156338696, 1.1887957801981448]
LOF_SCORE = [1.1255743110563547, 0.9313203549416755, 0.9313203549416755, 1.1255743110563547,
             1.0663269158235948, 1.0705803737578923, 0.8392368380663954, 0.9679374652606759,
             1.1257901653918008, 1.1559682203129318, 1.0869592381004256, 1.066412096163271,
             0.9773144370714925, 0.9292802661723027, 0.9038559858721773, 1.0241349067244303,
             0.9569682670885015, 1.1082537120123088]


def test_zscore_and_lof_match_published(fixture_panel):
    af = _anomaly_frame(fixture_panel)
    z = A.zscore(af, ANOM_FEATS).orderBy("id").collect()
    assert np.allclose([r["zscore_max"] for r in z], ZSCORE_MAX, atol=1e-9)
    assert sum(r["zscore_anomaly"] for r in z) == 4
    lof = A.lof(af, "id", ANOM_FEATS, k=3, contamination=0.15).orderBy("id").collect()
    assert np.allclose([r["lof_score"] for r in lof], LOF_SCORE, atol=1e-9)
    assert [r["id"] for r in lof if r["lof_anomaly"] == 1] == [32025, 42023]


def test_drift_goldens(spark):
    stats = spark.createDataFrame(
        [("members_lag1", 18.5, 6.0), ("leak_rate_lag1", 65.0, 18.0), ("growth_rate_lag1", -5.0, 12.0),
         ("retention_rate", 0.35, 0.18), ("unknown_feature", 1.0, 1.0)],
        "feature string, cur_mean double, cur_std double")
    d = {r["feature"]: r for r in L.drift_score(stats, L.reference_frame(spark)).collect()}
    assert d["members_lag1"]["drift_score"] == pytest.approx(0.4104)
    assert d["leak_rate_lag1"]["drift_score"] == pytest.approx(0.3417)
    assert d["growth_rate_lag1"]["drift_score"] == pytest.approx(0.2220)
    assert d["retention_rate"]["drift_score"] == pytest.approx(0.3417)
    assert [d[f]["drift_detected"] for f in ("members_lag1", "leak_rate_lag1", "growth_rate_lag1")] == [1, 1, 0]
    assert d["unknown_feature"]["drift_score"] == 0.0


def test_kmeans_silhouette_on_unit_profile(fixture_panel):
    from memberlens.catalog.extra_queries import _kmeans_np, _silhouette_np
    from memberlens.operators.aggregates import unit_profile
    up = unit_profile(fixture_panel).orderBy("unit").toPandas()
    X = up[["avg_variation", "cv_members"]].to_numpy(float)
    Z = (X - X.mean(0)) / X.std(0)
    lab = _kmeans_np(Z, 3, 10, 42)
    assert _silhouette_np(Z, lab) == pytest.approx(0.6276, abs=5e-5)
    # squared-Euclidean closed form equals brute force on the same labels
    df = fixture_panel.sparkSession.createDataFrame(
        [(int(i), int(l), [float(v) for v in z]) for i, (l, z) in enumerate(zip(lab, Z))],
        "id int, label int, v array<double>")
    s = ML.silhouette_sq(df, "v", "label").orderBy("id").toPandas()["silhouette"].to_numpy()
    d2 = ((Z[:, None] - Z[None]) ** 2).sum(-1)
    ref = []
    for i in range(len(Z)):
        own = lab == lab[i]
        a = d2[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else math.nan
        b = min(d2[i, lab == j].mean() for j in set(lab) if j != lab[i])
        ref.append(0.0 if own.sum() <= 1 else (b - a) / max(a, b))
    assert np.allclose(s, ref, atol=1e-9)


def test_auc_ties_count_half(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (0, 0.5), (1, 0.7)], "label int, score double")
    got = M.auc(df).first()["auc"]
    pos = [0.9, 0.5, 0.7]
    neg = [0.9, 0.1, 0.5]
    ref = np.mean([1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg])
    assert got == pytest.approx(ref)


def test_histogram_quantile_promql_rules(spark):
    # 10 requests: cumulative counts over the fixed buckets
    lat = [0.005, 0.02, 0.07, 0.2, 0.3, 0.4, 0.8, 2.0, 3.0, 20.0]
    req = spark.createDataFrame([("2024-01-01 00:00:00", "ep0", x) for x in lat],
                                "ts string, endpoint string, latency_s double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    h = L.latency_buckets(req)
    q = L.bucket_quantile(L.bucket_quantile(h, 0.5, "p50"), 0.99, "p99").first()
    # cumulative 1,2,3,4,6,7,8,9,9,10: rank 5 falls in (0.25, 0.5] (cum 4 -> 6)
    assert q["p50"] == pytest.approx(0.25 + 0.25 * (5 - 4) / (6 - 4))
    # rank 9.9 lands in +Inf: last finite bound
    assert q["p99"] == pytest.approx(10.0)


def test_logreg_loo_matches_published_metrics(fixture_panel):
    f = _regression_frame(fixture_panel).withColumn("dropout_risk", (F.col("leak_rate") > 30).cast("int")) \
        .withColumn("fold", (F.col("unit") * 10000 + F.col("period")).cast("long"))
    oof = ML.logreg_oof(f, REG_FEATS, "dropout_risk", "fold", C=0.001)
    scored = oof.select(F.col("dropout_risk").alias("label"), F.col("prediction").cast("int").alias("pred"),
                        F.col("p1").alias("score")).cache()
    m = M.classification_metrics(scored).first()
    assert m["accuracy"] == pytest.approx(0.889, abs=5e-4)
    assert m["precision"] == pytest.approx(1.0)
    assert m["recall"] == pytest.approx(0.667, abs=5e-4)
    assert m["f1"] == pytest.approx(0.8, abs=5e-4)
    assert M.auc(scored).first()["auc"] == pytest.approx(0.736, abs=5e-4)


def test_gmm_em_variants_recover_separated_blobs(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[0.0, 0.0], [8.0, 0.0], [0.0, 8.0]])
    pts = np.vstack([c + rng.normal(0, 0.5, size=(40, 2)) for c in centres])
    df = spark.createDataFrame([(int(i), float(x), float(y)) for i, (x, y) in enumerate(pts)], "id int, x double, y double")
    for cov in ("diag", "spherical", "tied"):
        scored, info = ML.gmm_em(df, ["x", "y"], 3, cov=cov)
        lab = scored.orderBy("id").toPandas()["label"].to_numpy()
        groups = [set(lab[i * 40:(i + 1) * 40]) for i in range(3)]
        assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3, cov
        assert info["bic"] > 0 and np.isfinite(info["log_likelihood"])


def test_mixtures_pass_over_as_many_partitions_as_their_rows_need(spark):
    """However many partitions the shuffles before a fit have, each of its passes is over few."""
    df = spark.createDataFrame([(i, float(i % 2 * 9 + i % 5), float(i % 3)) for i in range(60)], "id int, x double, y double").repartition(64)
    _, out = ML.gmm(df, ["x", "y"], 2)
    assert out.rdd.getNumPartitions() == 1 and out.count() == 60
    scored, _ = ML.gmm_em(df, ["x", "y"], 2)
    assert scored.rdd.getNumPartitions() == 1 and scored.count() == 60


def test_kmeans_restarts_compute_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = spark.createDataFrame([(i, float(i % 2 * 9 + i % 5), float(i % 3)) for i in range(60)], "id int, x double, y double").repartition(8)
    _, out = ML.kmeans(df.mapInPandas(count, df.schema), ["x", "y"], 2, n_init=4)
    assert out.count() == 60 and out.select("prediction").distinct().count() == 2 and seen.value == 60


def test_kmeans_profile_reads_the_panel_once(spark):
    from memberlens.catalog import QUERIES
    from .conftest import SF_SMALL
    out = QUERIES["kmeans_profile"](spark, SF_SMALL)
    assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString() and out.agg(F.sum("n")).first()[0] == 25
