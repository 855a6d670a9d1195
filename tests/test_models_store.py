"""Models saved and loaded in another session score alike; requests and streams use what is stored."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from memberlens.operators import anomaly as A
from memberlens.operators import ml as ML
from memberlens.operators import models as MD
from memberlens.operators import requests as R
from memberlens.streaming import streams as ST
from memberlens.streaming.scoring import score_stream

from .test_goldens import REG_FEATS, _regression_frame


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.5, size=(60, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    rows = [(i, float(a), float(b), int(a + b + rng.normal(0, 1.5) > 3)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, y int").cache()


def _again(spark, model, tag):
    """The model as a second session loads it."""
    root = ST.scratch_path(spark, "store")
    assert MD.save_model(spark, model, root, tag) == 1
    return MD.load_model(spark.newSession(), root, tag)


def _rows(df, *cols):
    return df.orderBy("id").select("id", *cols).collect()


def test_every_kind_scores_alike_after_a_reload(spark, points):
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                            RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=5, seed=1)]).fit(points)
    fits = [(MD.fit_ridge(points, ["a", "b"], "y", 0.1), ["prediction"]), (MD.fit_logit(points, ["a", "b"], "y"), ["p1", "prediction"]),
            (MD.fit_mixture(points, ["a", "b"], 3, cov="tied"), ["proba", "label"]),
            (MD.fit_forest(points, "id", ["a", "b"], trees=10), ["iso_score", "iso_anomaly"]), (MD.ml_model(pipe, ["a", "b"]), ["prediction"])]
    for model, cols in fits:
        loaded = _again(spark, model, model.kind)
        assert (loaded.kind, loaded.features, loaded.params, loaded.version) == (model.kind, model.features, model.params, 1)
        assert _rows(MD.score(loaded, points), *cols) == _rows(MD.score(model, points), *cols)


def test_scores_equal_the_fits_own(spark, points):
    forest = MD.score(MD.fit_forest(points, "id", ["a", "b"], trees=10), points)
    own = A.isolation_forest(points, "id", ["a", "b"], trees=10)
    assert np.allclose([r[1] for r in _rows(forest, "iso_score")], [r[1] for r in _rows(own, "iso_score")])
    for cov in ("diag", "spherical", "tied"):
        mix = MD.score(MD.fit_mixture(points, ["a", "b"], 3, cov=cov), points)
        own, _ = ML.gmm_em(points, ["a", "b"], 3, cov=cov)
        assert np.allclose([r[1] for r in _rows(mix, "proba")], [r[1] for r in _rows(own, "proba")], atol=1e-9)
    model, stats = ML.logreg_train(points, ["a", "b"], "y", C=0.5)
    own = ML.logreg_apply(model, stats, points, ["a", "b"])
    logit = MD.score(MD.fit_logit(points, ["a", "b"], "y", C=0.5), points)
    assert np.allclose([r[1] for r in _rows(logit, "p1")], [r[1] for r in _rows(own, "p1")], atol=1e-5)


def test_next_season_forecasts_of_a_loaded_ridge(spark, fixture_panel):
    model = _again(spark, MD.fit_ridge(_regression_frame(fixture_panel), REG_FEATS, "members", 0.01), "ridge")
    asked = spark.createDataFrame([(u, None, None, None) for u in range(1, 7)], "unit int, type string, members_lag1 double, leak_rate_lag1 double")
    f = R.request_features(asked, R.unit_snapshot(fixture_panel))
    assert [r["season_index"] for r in f.collect()] == [4] * 6
    assert [round(r["prediction"], 1) for r in MD.score(model, f).orderBy("unit").collect()] == [26.3, 14.6, 13.4, 14.3, 10.3, 15.3]


def test_versions(spark, points):
    root = ST.scratch_path(spark, "store")
    with pytest.raises(LookupError):
        MD.load_model(spark, root, "m")
    for alpha in (0.1, 5.0):
        MD.save_model(spark, MD.fit_ridge(points, ["a", "b"], "y", alpha, clamp_min=None), root, "m")
    assert MD.load_model(spark, root, "m").params == {"alpha": "5.0"}
    assert MD.load_model(spark, root, "m", 1).params == {"alpha": "0.1"}
    with pytest.raises(LookupError):
        MD.load_model(spark, root, "m", 3)
    MD.versions(spark, root, "m").where("version = 2").coalesce(1).write.mode("append").parquet(f"{root}/m/versions")
    with pytest.raises(ValueError, match="twice"):
        MD.load_model(spark, root, "m")


def test_missing_features_and_labels_of_one_class(spark, points):
    hole = spark.createDataFrame([(1, None, 1.0), (2, 0.0, float("nan"))], "id long, a double, b double")
    assert MD.score(MD.fit_ridge(points, ["a", "b"], "y", 0.1), hole).orderBy("id").first()["prediction"] is None
    assert MD.score(MD.fit_mixture(points, ["a", "b"], 2), hole).orderBy("id").first()["label"] is None
    forest = MD.fit_forest(points, "id", ["a", "b"], trees=5)
    assert all(r["iso_score"] is not None for r in MD.score(forest, hole).collect())
    assert MD.score(forest, hole.limit(0)).count() == 0
    for bad in (points.withColumn("y", F.lit(1)), points.limit(0)):
        with pytest.raises(ValueError, match="one class"):
            MD.fit_logit(bad, ["a", "b"], "y")


def test_requests_without_a_snapshot_or_a_known_type(spark, fixture_panel):
    train = _regression_frame(fixture_panel).withColumn("risk", (F.col("leak_rate") > 30).cast("int"))
    reg, cls = MD.fit_ridge(train, REG_FEATS, "members", 0.01), MD.fit_logit(train, REG_FEATS, "risk", 0.001)
    asked = spark.createDataFrame([(99, None, None, None), (1, "nonsense", None, None), (1, "dropout", 5.0, 80.0), (99, "regression", 0.0, None)],
                                  "unit int, type string, members_lag1 double, leak_rate_lag1 double")
    f = R.request_features(asked, R.unit_snapshot(fixture_panel))
    got = {(r["unit"], r["type"], r["members_lag1"]): r for r in R.answer(f, reg, cls).collect()}
    assert len(got) == 4
    unknown = got[99, "regression", R.UNKNOWN_MEMBERS]
    assert (unknown["status"], unknown["season_index"], unknown["growth_rate_lag1"], unknown["avg_members_unite_past"]) == (200, 1, 0.0, 10.0)
    assert unknown["prediction"] is not None and unknown["probability"] is None
    bad = got[1, "nonsense", 12.0]
    assert (bad["status"], bad["prediction"], bad["probability"]) == (400, None, None)
    risk = got[1, "dropout", 5.0]
    assert risk["prediction"] == float(risk["probability"] > 0.5) and risk["delta_members_lag1"] == 5.0 - 25.0
    assert got[99, "regression", 0.0]["growth_rate_lag1"] == 0.0                       # previous members 0


def test_stream_takes_the_snapshot_and_model_of_its_batch(spark, fixture_panel):
    train = _regression_frame(fixture_panel).withColumn("risk", (F.col("leak_rate") > 30).cast("int"))
    store, path, base = (ST.scratch_path(spark, t) for t in ("store", "asked", "run"))
    MD.save_model(spark, MD.fit_ridge(train, REG_FEATS, "members", 0.01), store, "reg")
    MD.save_model(spark, MD.fit_logit(train, REG_FEATS, "risk", 0.001), store, "cls")
    panels = [fixture_panel.where("period < 2025"), fixture_panel]
    ref = train.agg(F.lit("members_lag1").alias("feature"), F.avg("members_lag1").alias("ref_mean"), F.stddev_pop("members_lag1").alias("ref_std"))
    asked = spark.createDataFrame([(u, "regression", None, None) for u in range(1, 7)], "unit int, type string, members_lag1 double, leak_rate_lag1 double")
    for turn, panel in enumerate(panels):
        asked.coalesce(1).write.mode("append").parquet(path)
        answers, drift = score_stream(ST.folder_stream(spark, path, asked.schema), lambda: R.unit_snapshot(panel), store, "reg", "cls", ref,
                                      ["members_lag1"], "t", base)
        if turn == 0:
            MD.save_model(spark, MD.fit_ridge(train, REG_FEATS, "members", 10.0), store, "reg")
    per = {r[0]: r for r in answers.groupBy("batch_id").agg(F.sum("members_lag1"), F.min("regressor_version"), F.max("regressor_version"), F.count("*")).collect()}
    assert [tuple(per[b])[1:] for b in (0, 1)] == [(97.0, 1, 1, 6), (83.0, 2, 2, 6)]
    assert sorted((r["batch_id"], round(r["cur_mean"], 6)) for r in drift.collect()) == [(0, round(97 / 6, 6)), (1, round(83 / 6, 6))]
