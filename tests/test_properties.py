"""Property checks: partition/ordering invariance, no cross-unit leakage,
exact kNN, bounded scores, edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from memberlens.operators import aggregates as D
from memberlens.operators import anomaly as A
from memberlens.operators import cleaning as B
from memberlens.operators import metrics as M
from memberlens.operators import monitoring as L
from memberlens.operators import timeseries as TS
from memberlens.operators import windows as W
from memberlens.plans.panel import build_panel
from memberlens.sources import tables as T

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(None if v is None else (round(v, 9) if isinstance(v, float) else v) for v in r)
                  for r in df.collect())


def test_lag_never_crosses_units(fixture_panel):
    f = W.build_features(fixture_panel, drop_first=False).collect()
    firsts = [r for r in f if r["season_index"] == 1]
    assert all(r["members_lag1"] is None and r["leak_rate_lag1"] is None for r in firsts)
    assert all(r["avg_members_unite_past"] is None for r in firsts)


def test_past_mean_ignores_current_row(fixture_panel):
    w = W.unit_window()
    a = fixture_panel.select("unit", "period", W.past_mean("members", w).alias("pm"))
    bumped = fixture_panel.withColumn("members", F.when(F.col("period") == 2025, F.col("members") + 1000)
                                      .otherwise(F.col("members")))
    b = bumped.select("unit", "period", W.past_mean("members", w).alias("pm"))
    assert _rows(a) == _rows(b)


def test_panel_invariant_to_row_order_and_partitions(spark):
    o = T.read_table(spark, SF_SMALL, "orders")
    c = T.read_table(spark, SF_SMALL, "customer")
    base = _rows(build_panel(o, c))
    shuffled = build_panel(o.orderBy(F.rand(7)).repartition(8), c.repartition(3))
    single = build_panel(o.coalesce(1), c.coalesce(1))
    assert _rows(shuffled) == base == _rows(single)


def test_features_invariant_to_partitioning(fixture_panel):
    a = W.build_features(fixture_panel.repartition(1))
    b = W.build_features(fixture_panel.repartition(8, "period"))
    assert _rows(a) == _rows(b)


def test_knn_exact_with_duplicates(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(120, 4))
    X[10] = X[11] = X[12]          # exact duplicates
    X[50:54] = X[50] + 1e-12       # near duplicates
    df = spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in enumerate(X)], "id long, v array<double>")
    got = A.knn(df, "id", "v", 3).toPandas()
    D2 = np.round(np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)), 9)
    np.fill_diagonal(D2, np.inf)
    for i in range(len(X)):
        exp = sorted(range(len(X)), key=lambda j: (D2[i, j], j))[:3]
        assert got[got.id == i].sort_values("rank").nbr.tolist() == exp


def test_knn_far_outlier_resolves_by_radius_growth(spark):
    pts = [(i, [float(i % 5), float(i // 5)]) for i in range(25)] + [(99, [1000.0, 1000.0])]
    df = spark.createDataFrame(pts, "id long, v array<double>")
    got = A.knn(df, "id", "v", 2).where("id = 99").orderBy("rank").collect()
    assert [r["nbr"] for r in got] == [24, 19]


def test_drift_score_bounded(spark):
    rng = np.random.default_rng(1)
    rows = [(f, float(m), float(s)) for f in ("members_lag1", "leak_rate_lag1", "x")
            for m, s in zip(rng.normal(0, 100, 20), rng.uniform(0, 50, 20))]
    stats = spark.createDataFrame(rows, "feature string, cur_mean double, cur_std double")
    vals = [r["drift_score"] for r in L.drift_score(stats, L.reference_frame(spark)).collect()]
    assert all(0.0 <= v <= 1.0 for v in vals)


def test_latency_histogram_cumulative_monotone(spark):
    from memberlens.plans.panel import load_requests
    h = L.latency_buckets(load_requests(spark, SF_SMALL)).collect()
    assert h and all(all(a <= b for a, b in zip(r["cum"], r["cum"][1:])) for r in h)
    assert all(r["cum"][-1] == r["n"] for r in h)


def test_prefix_sums_match_global_cumsum(spark):
    rng = np.random.default_rng(5)
    vals = rng.integers(0, 10, 500)
    df = spark.createDataFrame([(int(i), int(v)) for i, v in enumerate(vals)], "t long, v long")
    df = df.withColumn("_bucket", F.floor(F.col("t") / 37))
    got = M.prefix_sums(df, "t", ["v"]).orderBy("t").toPandas()["cum_v"].to_numpy()
    assert (got == np.cumsum(vals)).all()


def test_degenerate_series_give_null_not_error(spark):
    p = spark.createDataFrame([(1, 2020, 5), (2, 2020, 7), (2, 2021, 7), (2, 2022, 7), (2, 2023, 7)],
                              "unit int, period int, members long")
    a = {r["unit"]: r for r in TS.adf(p).collect()}
    k = {r["unit"]: r for r in TS.kpss(p).collect()}
    assert a[2]["adf_stat"] is None and a[2]["conclusion"] == "undetermined"
    assert k[2]["kpss_stat"] is None
    lt = {r["unit"]: r for r in W.last_two(p).collect()}
    assert lt[1]["prev_value"] == lt[1]["last_value"] == 5


def test_all_one_class_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "label int, pred int")
    m = M.classification_metrics(df).first()
    assert m["precision"] == 1.0 and m["recall"] == pytest.approx(2 / 3)
    one = spark.createDataFrame([(1, 0.3), (1, 0.6)], "label int, score double")
    assert M.auc(one).first()["auc"] is None


def test_empty_input_null_profile(spark):
    empty = spark.createDataFrame([], "a double, b string")
    rows = B.null_profile(empty).collect()
    assert {r["column_name"] for r in rows} == {"a", "b"}
    assert all(r["null_count"] == 0 and r["null_ratio"] is None for r in rows)


def test_feature_combos_and_crosstab(spark):
    combos = D.feature_combos(spark, ["a", "b", "c", "d"], 2, 3).collect()
    assert len(combos) == 6 + 4
    assert all(2 <= len(r["features"]) <= 3 for r in combos)


def test_read_optional_and_contract(spark, tmp_path):
    schema = "x long, y double"
    missing = T.read_optional(spark, str(tmp_path / "nope"), schema=spark.createDataFrame([], schema).schema)
    assert missing.count() == 0 and missing.columns == ["x", "y"]
    df = spark.createDataFrame([(1, 2.0), (None, 3.0)], schema)
    sig = T.contract(df)
    assert sig == [{"name": "x", "type": "long", "required": True}, {"name": "y", "type": "double", "required": True}]
    viol = [r["_contract_violations"] for r in T.enforce(df, sig).collect()]
    assert sorted(viol) == [0, 1]
    with pytest.raises(ValueError):
        T.enforce(df.drop("y"), sig)


def test_fingerprint_order_insensitive(spark):
    o = T.read_table(spark, SF_SMALL, "orders")
    a = T.fingerprint(o).first()
    b = T.fingerprint(o.orderBy(F.rand(11)).repartition(5)).first()
    assert a == b


def test_csv_roundtrip_and_model_save(spark, tmp_path):
    from pyspark.ml.pipeline import PipelineModel
    from memberlens.operators import ml as ML
    df = spark.createDataFrame([(float(i), float(2 * i + 1)) for i in range(20)], "x double, y double")
    T.write_table(df, str(tmp_path / "t"), fmt="csv")
    back = T.read_csv(spark, str(tmp_path / "t"), df.schema)
    assert _rows(back) == _rows(df)
    m = ML.rf_regressor(df, ["x"], "y", trees=5, depth=2)
    m.write().overwrite().save(str(tmp_path / "m"))
    m2 = PipelineModel.load(str(tmp_path / "m"))
    assert _rows(m.transform(df).select("prediction")) == _rows(m2.transform(df).select("prediction"))


def test_isolation_forest_flags_planted_outlier(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(300, 3))
    X[7] = [9.0, -9.0, 9.0]                       # planted outlier
    df = spark.createDataFrame([(int(i), *map(float, x)) for i, x in enumerate(X)], "id long, a double, b double, c double")
    out = A.isolation_forest(df, "id", ["a", "b", "c"], trees=60, contamination=0.05, seed=3).toPandas()
    assert out.sort_values("iso_score").iloc[0]["id"] == 7      # most anomalous
    assert out.loc[out.id == 7, "iso_anomaly"].item() == 1
    assert 5 <= out["iso_anomaly"].sum() <= 30                   # about 5 % flagged


def test_leakage_guard_and_fanout(spark, fixture_panel):
    from memberlens.operators.cleaning import LEAKY, feature_set
    for task in ("regression", "classification", "clustering", "timeseries"):
        assert not set(feature_set(task)) & LEAKY.get(task, set())
    sets = T.split_datasets(B.dropout_risk(fixture_panel.withColumn("retained", F.lit(0))))
    assert set(sets) == {"regression", "classification", "clustering", "timeseries"}
    assert "leak_rate" not in sets["regression"].columns and "dropout_risk" in sets["classification"].columns


def test_cleaning_helpers(spark):
    from memberlens.functions import scalar as S
    df = spark.createDataFrame([(1, None, "7", float("nan"), 10.0, 0.0), (2, 5.0, "x", 3.0, 12.0, 10.0)],
                               "unit int, a double, s string, b double, cur double, prev double")
    filled = {r["unit"]: r for r in B.fill_zero(df).collect()}
    assert filled[1]["a"] == 0.0 and filled[1]["b"] == 0.0          # NULL and NaN both -> 0
    lenient = [r["s"] for r in B.cast_types(df, {"s": "int"}, lenient=True).orderBy("unit").collect()]
    assert lenient == [7, None]                                       # try_cast on dirty text
    assert B.drop_first(df, ["a"]).count() == 1
    co = B.coalesce_cols(df, "ab", "a", "b").orderBy("unit").collect()
    assert math.isnan(co[0]["ab"]) and co[1]["ab"] == 5.0
    inter = B.interactions(spark.createDataFrame([(40.0, 25.0)], "m double, l double"), "m", "l").first()
    assert inter["retention_rate"] == 0.75 and inter["members_x_retention"] == 30.0
    g = df.select(S.safe_growth("cur", "prev").alias("g"), S.flagged(F.lit(None).cast("int")).alias("f")) \
          .orderBy("g").collect()
    assert [r["g"] for r in g] == [0.0, 20.0] and not g[0]["f"]
    assert spark.range(1).select(S.season_year(F.lit("2023/2024")).alias("y"),
                                 S.season_label(F.lit(2023)).alias("s")).first() == (2023, "2023/2024")


# --- exact quantiles and neighbours at any size

@pytest.mark.parametrize("q", [0.0, 0.15, 0.5, 0.85, 1.0])
def test_exact_quantile_equals_numpy(spark, q, monkeypatch):
    from memberlens.operators import quantile as Q
    monkeypatch.setattr(Q, "FEW", 8)
    monkeypatch.setattr(Q, "BUCKETS", 7)
    rng = np.random.default_rng(3)
    for values in (rng.normal(size=500), np.r_[np.zeros(300), rng.lognormal(8, 6, 200)], np.full(40, 2.5), np.array([7.0]), np.r_[-1e300, 1e300, 0.0]):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").where("v is null or not isnan(v)")
        assert Q.exact_quantile(df, "v", q) == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert Q.exact_quantile(df.where("v > 1e301"), "v", q) is None


def test_lof_keeps_rows_with_missing_features(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    rows += [(100, float("nan"), 0.0), (101, None, 1.0)]
    out = {r["id"]: r for r in anomaly_lof(spark.createDataFrame(rows, "id int, a double, b double"))}
    assert len(out) == 42 and all(out[i]["lof_score"] is None and out[i]["lof_anomaly"] == 0 for i in (100, 101))
    assert sum(r["lof_score"] is not None for r in out.values()) == 40


def anomaly_lof(df):
    from memberlens.operators.anomaly import lof
    return lof(df, "id", ["a", "b"], k=3).collect()


def test_knn_with_many_equal_vectors_is_exact(spark):
    from memberlens.operators.anomaly import knn
    rng = np.random.default_rng(2)
    pts = np.r_[np.zeros((30, 2)), np.ones((2, 2)), rng.normal(size=(40, 2)).round(1) * 3]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id int, v array<double>")
    got = {(r["id"], r["rank"]): (r["nbr"], r["dist"]) for r in knn(df, "id", "v", 3).collect()}
    for i, p in enumerate(pts):
        want = sorted((round(float(np.linalg.norm(p - q)), 9), j) for j, q in enumerate(pts) if j != i)[:3]
        assert [got[i, k + 1] for k in range(3)] == [(j, pytest.approx(d)) for d, j in want]


def test_bisecting_kmeans_gives_three_clusters(spark):
    import __spark_entry__ as E
    assert E.queries()["bisecting_kmeans"](spark, "/root/testdata/sf0.001").count() == 3


def test_fingerprint_tells_null_places_apart(spark):
    from memberlens.sources.tables import fingerprint
    a = fingerprint(spark.createDataFrame([(1, None)], "a int, b int")).first()
    b = fingerprint(spark.createDataFrame([(None, 1)], "a int, b int")).first()
    assert a["content_hash"] != b["content_hash"]


def test_fingerprint_all_sees_every_column(spark, tmp_path):
    import hashlib
    import __spark_entry__ as E
    names, sf = ("orders", "lineitem", "events"), str(tmp_path / "sf")
    small = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(20).coalesce(1).cache() for t in names}

    def run():
        return {r.table_name: (r.n_rows, r.content_hash) for r in E.queries()["fingerprint_all"](spark, sf).collect()}

    def brute(df):
        total = 0
        for r in df.select(*[F.col(c).cast("string") for c in df.columns]).collect():
            row = ",".join("n" if v is None else f"v{len(v)}:{v}" for v in r)
            total += int(hashlib.md5(row.encode()).hexdigest()[:15], 16)
        return df.count(), total % 2305843009213693951
    for t in names:
        small[t].write.parquet(f"{sf}/{t}.parquet")
    assert run() == {t: brute(small[t]) for t in names}
    for k in range(max(len(d.columns) for d in small.values())):       # the k-th column of each table loses one value
        change = [t for t in names if k < len(small[t].columns)]
        before = run()
        for t in change:
            d, c = small[t], small[t].columns[k]
            least = d.agg(F.min(c)).first()[0]
            d.withColumn(c, F.when(F.col(c) != F.lit(least), F.col(c))).write.mode("overwrite").parquet(f"{sf}/{t}.parquet")
        after = run()
        assert all(after[t][1] != before[t][1] for t in change), k
        for t in change:
            small[t].write.mode("overwrite").parquet(f"{sf}/{t}.parquet")
