"""Grids whose candidates advance together: plain numpy, the older fits, published metrics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from memberlens.operators import ml as ML
from memberlens.operators import selection as S

from .test_goldens import REG_FEATS, _regression_frame


def _blobs(spark, n=60, d=2, centres=((0, 0), (9, 0), (0, 9)), seed=0):
    rng = np.random.default_rng(seed)
    x = np.vstack([np.array(c, float) + rng.normal(0, 0.6, size=(n, d)) for c in centres])
    return x, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double").repartition(5)


def test_k_selection_finds_the_clusters(spark):
    x, df = _blobs(spark)
    rows = {r["k"]: r for r in S.k_selection(df, "id", ["a", "b"], [2, 3, 4], n_init=3).collect()}
    assert [k for k in rows if rows[k]["best_kmeans"]] == [3] == [k for k in rows if rows[k]["best_mixture"]]
    cells = [x[i * 60:(i + 1) * 60] for i in range(3)]
    assert rows[3]["inertia"] == pytest.approx(sum(((c - c.mean(0)) ** 2).sum() for c in cells))
    # log-likelihood of far-apart blobs: each blob's own Gaussian with weight 1/3
    ll = sum(-0.5 * 60 * (2 * np.log(2 * np.pi) + np.linalg.slogdet(np.cov(c.T, bias=True))[1] + 2) + 60 * np.log(1 / 3) for c in cells)
    assert rows[3]["log_likelihood"] == pytest.approx(ll, rel=1e-4)
    assert rows[3]["bic"] == pytest.approx(-2 * rows[3]["log_likelihood"] + 17 * np.log(180))
    s = []
    for i, c in enumerate(cells):
        for p in c:
            a = np.linalg.norm(c - p, axis=1).sum() / 59
            b = min(np.linalg.norm(o - p, axis=1).mean() for j, o in enumerate(cells) if j != i)
            s.append((b - a) / max(a, b))
    assert rows[3]["silhouette"] == pytest.approx(np.mean(s))


def test_k_selection_of_few_equal_or_no_rows(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(3)], "id long, a double, b double")
    out = S.k_selection(same, "id", ["a", "b"], [2, 3, 4], n_init=2).collect()
    assert [(r["k"], r["n_clusters"], r["silhouette"], r["best_kmeans"]) for r in out] == [(2, 1, None, False), (3, 1, None, False)]
    assert S.k_selection(same.limit(0), "id", ["a", "b"], [2]).count() == 0


def test_logit_grid_matches_published_metrics_and_single_fits(fixture_panel):
    f = _regression_frame(fixture_panel).withColumn("dropout_risk", (F.col("leak_rate") > 30).cast("int")) \
        .withColumn("fold", (F.col("unit") * 10000 + F.col("period")).cast("int")).cache()
    oof = S.logit_grid(f.withColumn("id", F.col("fold")), "id", REG_FEATS, "dropout_risk", "fold", [0.001, 1.0]).cache()
    m = {r["C"]: r for r in S.grid_metrics(oof).collect()}
    assert [round(m[0.001][c], 3) for c in ("accuracy", "precision", "recall", "f1")] == [0.889, 1.0, 0.667, 0.8]
    only = S.grid_metrics(oof.where("C = 0.001")).first()
    assert only["best"] and only["auc"] == pytest.approx(0.736, abs=5e-4)
    model, stats = ML.logreg_train(f.where("fold <> 12024"), REG_FEATS, "dropout_risk", C=1.0)
    one = ML.logreg_apply(model, stats, f.where("fold = 12024"), REG_FEATS).first()["p1"]
    assert oof.where("C = 1.0 AND fold = 12024").first()["p1"] == pytest.approx(one, abs=1e-5)


def test_logit_grid_refuses_what_it_cannot_fit(spark):
    rows = [(i, float(i), int(i > 5), i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, a double, y int, fold int")
    with pytest.raises(ValueError, match="lack a class"):
        S.logit_grid(df.withColumn("fold", F.col("y")), "id", ["a"], "y", "fold", [1.0])
    with pytest.raises(ValueError, match="candidates"):
        S.logit_grid(df, "id", ["a"], "y", "fold", [1.0 + i for i in range(1001)])
    separable = S.logit_grid(df, "id", ["a"], "y", "fold", [100.0]).collect()
    assert all(r["pred"] == r["label"] for r in separable if r["id"] not in (5, 6))
