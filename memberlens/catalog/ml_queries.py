"""J queries: anomaly scores, clustering quality, classifier metrics, model fits.

Deterministic operators carry a DuckDB oracle; model fits with random
seeds / Spark ML split rules are rows-only here and checked against numpy
goldens in tests/.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as D
from ..operators import anomaly as A
from ..operators import cleaning as B
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import selection as S
from ..operators import windows as W
from ..plans.panel import load_panel
from ..session import cut_lineage
from ..sources.tables import read_table
from .analytics_queries import FEATURE_COLS, NEXT_PERIOD_CTE
from .registry import query
from .sqlparts import FEATURES_CTE, PANEL_CTE, ridge_cte, train_cte

ANOM_FEATS = ["members", "leak_rate", "growth_rate", "delta_members", "retention_rate",
              "members_x_retention", "deviation_from_avg"]


def anomaly_frame(spark, sf_dir):
    """Anomaly feature rows (one per unit-period), id = unit * 10000 + period."""
    p = load_panel(spark, sf_dir)
    w = W.unit_window()
    m = F.col("members").cast("double")
    return p.select(
        (F.col("unit").cast("bigint") * 10000 + F.col("period")).alias("id"), "unit", "period",
        m.alias("members"), "leak_rate",
        F.coalesce(W.pct_change("members", w) * 100.0, F.lit(0.0)).alias("growth_rate"),
        F.coalesce(W.diff("members", w).cast("double"), F.lit(0.0)).alias("delta_members"),
        (1 - F.col("leak_rate") / 100.0).alias("retention_rate"),
        (m * (1 - F.col("leak_rate") / 100.0)).alias("members_x_retention"),
        (m - W.past_mean("members", w, "self")).alias("deviation_from_avg"))


_AF_CTE = PANEL_CTE + """,
af AS (
  SELECT CAST(unit AS BIGINT) * 10000 + period AS id, unit, period, CAST(members AS DOUBLE) AS members, leak_rate,
         COALESCE((members / NULLIF(CAST(LAG(members) OVER w AS DOUBLE), 0.0) - 1) * 100.0, 0.0) AS growth_rate,
         COALESCE(CAST(members - LAG(members) OVER w AS DOUBLE), 0.0) AS delta_members,
         1 - leak_rate / 100.0 AS retention_rate,
         CAST(members AS DOUBLE) * (1 - leak_rate / 100.0) AS members_x_retention,
         CAST(members AS DOUBLE) - COALESCE(AVG(members) OVER (PARTITION BY unit ORDER BY period
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(members AS DOUBLE)) AS deviation_from_avg
  FROM panel WINDOW w AS (PARTITION BY unit ORDER BY period)),
st AS (SELECT """ + ", ".join(f"AVG({c}) AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 OR STDDEV_POP({c}) IS NULL THEN 1.0 ELSE STDDEV_POP({c}) END AS s_{c}"
                              for c in ANOM_FEATS) + """ FROM af),
zs AS (SELECT af.id, """ + ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in ANOM_FEATS) + """ FROM af, st),
zsc AS (SELECT id, greatest(""" + ", ".join(f"abs(z_{c})" for c in ANOM_FEATS) + """) AS zscore_max FROM zs),
pairs AS (SELECT a.id, b.id AS nbr, round(sqrt(""" + " + ".join(f"(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})" for c in ANOM_FEATS) + """), 9) AS dist
          FROM zs a JOIN zs b ON a.id <> b.id),
nn AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY dist, nbr) AS rk FROM pairs) WHERE rk <= 3),
kd AS (SELECT id AS nbr, dist AS kdist FROM nn WHERE rk = 3),
reach AS (SELECT nn.id, nn.rk, greatest(kd.kdist, nn.dist) AS reach FROM nn JOIN kd ON nn.nbr = kd.nbr),
lrd AS (SELECT id, 1.0 / ((MAX(reach) FILTER (WHERE rk = 1) + MAX(reach) FILTER (WHERE rk = 2)
                           + MAX(reach) FILTER (WHERE rk = 3)) / 3 + 1e-10) AS lrd FROM reach GROUP BY id),
lofv AS (SELECT nn.id, ((MAX(l2.lrd) FILTER (WHERE nn.rk = 1) + MAX(l2.lrd) FILTER (WHERE nn.rk = 2)
                         + MAX(l2.lrd) FILTER (WHERE nn.rk = 3)) / 3) / l1.lrd AS lof_score
         FROM nn JOIN lrd l2 ON nn.nbr = l2.id JOIN lrd l1 ON nn.id = l1.id GROUP BY nn.id, l1.lrd),
lofr AS (SELECT id, lof_score, CAST(lof_score > (SELECT quantile_cont(lof_score, 0.85) FROM lofv) AS INTEGER) AS lof_anomaly FROM lofv),
qf AS (SELECT quantile_cont(leak_rate, 0.25) AS q1, quantile_cont(leak_rate, 0.75) AS q3 FROM af),
iqr AS (SELECT id, CAST(leak_rate < q1 - 1.5 * (q3 - q1) OR leak_rate > q3 + 1.5 * (q3 - q1) AS INTEGER) AS iqr_anomaly FROM af, qf)"""


def _zscores(spark, sf_dir):
    return A.zscore(anomaly_frame(spark, sf_dir), ANOM_FEATS)


@query("zscore_anomaly", doubles=("zscore_max",), sql=f"""
WITH {_AF_CTE}
SELECT id, zscore_max, CAST(zscore_max > 2.0 AS INTEGER) AS zscore_anomaly FROM zsc""")
def zscore_anomaly(spark, sf_dir):
    """Max |z| over the 7 anomaly features, flag > 2."""
    return _zscores(spark, sf_dir).select("id", "zscore_max", "zscore_anomaly")


@query("scaled_features", doubles=tuple(f"z_{c}" for c in ANOM_FEATS), sql=f"""
WITH {_AF_CTE}
SELECT * FROM zs""")
def scaled_features(spark, sf_dir):
    """Population-std standardisation of the anomaly features."""
    z = ML.pop_scale(anomaly_frame(spark, sf_dir), ANOM_FEATS, suffix="__z")
    return z.select("id", *[F.col(c + "__z").alias(f"z_{c}") for c in ANOM_FEATS])


def _lof(spark, sf_dir):
    return A.lof(anomaly_frame(spark, sf_dir), "id", ANOM_FEATS, k=3, contamination=0.15)


@query("lof", doubles=("lof_score",), sql=f"""
WITH {_AF_CTE}
SELECT id, CASE WHEN lof_score = 0 THEN lof_score
                ELSE round(lof_score / pow(10.0, floor(log10(abs(lof_score)))), 9) * pow(10.0, floor(log10(abs(lof_score)))) END AS lof_score,
       lof_anomaly FROM lofr""")
def lof(spark, sf_dir):
    """LOF k=3 with exact grid kNN, flagged above the 85th percentile
    (score reported to 10 significant digits)."""
    from ..functions.scalar import round_sig
    return _lof(spark, sf_dir).select("id", round_sig("lof_score", 10).alias("lof_score"), "lof_anomaly")


@query("consensus", sql=f"""
WITH {_AF_CTE}
SELECT z.id, CAST(zscore_max > 2.0 AS INTEGER) AS zscore_anomaly, lof_anomaly, iqr_anomaly,
       CAST(zscore_max > 2.0 AS INTEGER) + lof_anomaly + iqr_anomaly AS vote_sum,
       CAST(CAST(zscore_max > 2.0 AS INTEGER) + lof_anomaly + iqr_anomaly >= 2 AS INTEGER) AS consensus
FROM zsc z JOIN lofr l ON z.id = l.id JOIN iqr i ON z.id = i.id""")
def consensus(spark, sf_dir):
    """>= 2 of 3 votes among z-score, LOF and the IQR fence (the
    deterministic trio; the isolation_forest query votes with the forest)."""
    z = _zscores(spark, sf_dir).select("id", "zscore_anomaly")
    lf = _lof(spark, sf_dir).select("id", "lof_anomaly")
    iq = B.iqr_outliers(anomaly_frame(spark, sf_dir).select("id", "leak_rate"), "leak_rate") \
        .select("id", F.col("is_outlier").alias("iqr_anomaly"))
    j = z.join(lf, "id").join(iq, "id")
    return A.consensus(j, ["zscore_anomaly", "lof_anomaly", "iqr_anomaly"])


@query("minmax_scores", doubles=("lof_score_norm", "zscore_max_norm"), sql=f"""
WITH {_AF_CTE},
j AS (SELECT z.id, zscore_max, lof_score FROM zsc z JOIN lofr l ON z.id = l.id)
SELECT id, (lof_score - MIN(lof_score) OVER ()) / (MAX(lof_score) OVER () - MIN(lof_score) OVER () + 1e-9) AS lof_score_norm,
       (zscore_max - MIN(zscore_max) OVER ()) / (MAX(zscore_max) OVER () - MIN(zscore_max) OVER () + 1e-9) AS zscore_max_norm
FROM j""")
def minmax_scores(spark, sf_dir):
    """Min-max normalised anomaly scores (1e-9 guard)."""
    j = _zscores(spark, sf_dir).select("id", "zscore_max").join(
        _lof(spark, sf_dir).select("id", "lof_score"), "id")
    return A.normalise(j, {"lof_score": True, "zscore_max": True}).select("id", "lof_score_norm", "zscore_max_norm")


@query("isolation_forest")
def isolation_forest(spark, sf_dir):
    """J14 + J17: Isolation Forest flags and the reference's 3-method vote
    (forest, LOF, z-score); random by nature -> rows-only."""
    af = anomaly_frame(spark, sf_dir)
    iso = A.isolation_forest(af, "id", ANOM_FEATS, trees=100, contamination=0.15, seed=42)
    j = iso.select("id", "iso_score", "iso_anomaly").join(_lof(spark, sf_dir).select("id", "lof_anomaly"), "id") \
        .join(_zscores(spark, sf_dir).select("id", "zscore_anomaly"), "id")
    return A.consensus(j, ["iso_anomaly", "lof_anomaly", "zscore_anomaly"])


# --------------------------------------------------------------------------- clustering quality
_EMB_CTE = """
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


@query("silhouette", doubles=("mean_silhouette",), sql=f"""
WITH {_EMB_CTE},
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, pow(list_distance(a.v, b.v), 2) AS sq
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
per AS (SELECT vec_id, la, lb, AVG(sq) AS m FROM d GROUP BY vec_id, la, lb),
ab AS (SELECT vec_id, la, MAX(m) FILTER (WHERE la = lb) AS a, MIN(m) FILTER (WHERE la <> lb) AS b FROM per GROUP BY vec_id, la),
s AS (SELECT la AS label, CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)
SELECT CASE WHEN GROUPING(label) = 1 THEN 'ALL' ELSE CAST(label AS VARCHAR) END AS scope,
       COUNT(*) AS n, AVG(s) AS mean_silhouette
FROM s GROUP BY GROUPING SETS ((label), ())""")
def silhouette(spark, sf_dir):
    """Squared-Euclidean silhouette of the embedding labels, per label
    and overall; closed form on Spark, brute-force pairs in the oracle."""
    e = read_table(spark, sf_dir, "embeddings")
    s = ML.silhouette_sq(e.select("vec_id", "label", "embedding"), "embedding", "label")
    return (s.rollup("label").agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("mean_silhouette"),
                                  F.grouping("label").alias("_g"))
            .select(F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col("label").cast("string")).alias("scope"),
                    "n", "mean_silhouette"))


@query("silhouette_exact", doubles=("silhouette",), sql=f"""
WITH {_EMB_CTE},
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, list_distance(a.v, b.v) AS m FROM e a JOIN e b ON a.vec_id <> b.vec_id),
per AS (SELECT vec_id, la, lb, AVG(m) AS m FROM d GROUP BY vec_id, la, lb),
ab AS (SELECT vec_id, la, MAX(m) FILTER (WHERE la = lb) AS a, MIN(m) FILTER (WHERE la <> lb) AS b FROM per GROUP BY vec_id, la)
SELECT vec_id, la AS label, CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END AS silhouette
FROM ab""")
def silhouette_exact(spark, sf_dir):
    """Euclidean silhouette of every embedding; distances meet in blocks and
    only sums per row and cluster leave them."""
    return ML.silhouette_exact(read_table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL"), "vec_id", "embedding", "label")


@query("davies_bouldin", doubles=("davies_bouldin",), sql=f"""
WITH {_EMB_CTE},
x AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
c AS (SELECT label, i, AVG(x) AS mu FROM x GROUP BY label, i),
dm AS (SELECT x.vec_id, x.label, sqrt(SUM((x.x - c.mu) * (x.x - c.mu))) AS dist
       FROM x JOIN c ON x.label = c.label AND x.i = c.i GROUP BY x.vec_id, x.label),
s AS (SELECT label, AVG(dist) AS s FROM dm GROUP BY label),
cc AS (SELECT a.label AS la, b.label AS lb, sqrt(SUM((a.mu - b.mu) * (a.mu - b.mu))) AS d
       FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY a.label, b.label),
r AS (SELECT cc.la, MAX((sa.s + sb.s) / cc.d) AS r FROM cc JOIN s sa ON cc.la = sa.label JOIN s sb ON cc.lb = sb.label GROUP BY cc.la)
SELECT AVG(r) AS davies_bouldin, COUNT(*) AS k FROM r""")
def davies_bouldin(spark, sf_dir):
    """Davies-Bouldin index of the embedding labels."""
    e = read_table(spark, sf_dir, "embeddings")
    return ML.davies_bouldin(e.select("label", "embedding"), "embedding", "label")


# --------------------------------------------------------------------------- classifier metrics
def _doc_scores(spark, sf_dir):
    """Labelled documents with a deterministic length score in (0, 1)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id")
    score = F.col("n_chars") / (F.col("n_chars") + 1000.0)
    return j.select("doc_id", F.col("quality").alias("label"), score.alias("score"),
                    (score >= 0.5).cast("int").alias("pred"))


_DOC_CTE = """
ds AS (SELECT d.doc_id, l.quality AS label, d.n_chars / (d.n_chars + 1000.0) AS score,
              CAST(d.n_chars / (d.n_chars + 1000.0) >= 0.5 AS INTEGER) AS pred
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@query("classification_metrics", doubles=("accuracy", "precision", "recall", "f1"), sql=f"""
WITH {_DOC_CTE},
a AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
             COUNT(*) FILTER (WHERE label = 0 AND pred = 1) AS fp, COUNT(*) FILTER (WHERE label = 1 AND pred = 0) AS fn,
             COUNT(*) FILTER (WHERE label = pred) AS correct FROM ds),
b AS (SELECT *, COALESCE(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0.0), 0.0) AS p,
                COALESCE(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0.0), 0.0) AS r FROM a)
SELECT n, tp, fp, fn, correct / n AS accuracy, p AS precision, r AS recall,
       COALESCE(2 * p * r / NULLIF(p + r, 0.0), 0.0) AS f1 FROM b""")
def classification_metrics(spark, sf_dir):
    """Accuracy / precision / recall / F1 of the length rule vs quality."""
    return M.classification_metrics(_doc_scores(spark, sf_dir))


@query("confusion", sql=f"""
WITH {_DOC_CTE}
SELECT label AS actual, COUNT(*) FILTER (WHERE pred = 0) AS pred_0, COUNT(*) FILTER (WHERE pred = 1) AS pred_1
FROM ds GROUP BY label""")
def confusion(spark, sf_dir):
    """Confusion matrix (fixed pivot values 0, 1)."""
    return M.confusion(_doc_scores(spark, sf_dir))


@query("class_report", doubles=("precision", "recall", "f1"), sql=f"""
WITH {_DOC_CTE},
cls AS (SELECT DISTINCT label AS c FROM ds UNION SELECT DISTINCT pred FROM ds),
per AS (SELECT c, COUNT(*) FILTER (WHERE label = c AND pred = c) AS tp, COUNT(*) FILTER (WHERE pred = c) AS pn,
               COUNT(*) FILTER (WHERE label = c) AS support FROM cls, ds GROUP BY c),
rows AS (SELECT CAST(c AS VARCHAR) AS label, COALESCE(tp / NULLIF(CAST(pn AS DOUBLE), 0.0), 0.0) AS precision,
                COALESCE(tp / NULLIF(CAST(support AS DOUBLE), 0.0), 0.0) AS recall, CAST(support AS BIGINT) AS support FROM per),
rf AS (SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0.0), 0.0) AS f1 FROM rows)
SELECT * FROM rf
UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), CAST(SUM(support) AS BIGINT), AVG(f1) FROM rf
UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
                 CAST(SUM(support) AS BIGINT), SUM(f1 * support) / SUM(support) FROM rf""")
def class_report(spark, sf_dir):
    """Per-class report with macro and weighted averages."""
    return M.class_report(_doc_scores(spark, sf_dir))


@query("roc_curve", doubles=("threshold", "fpr", "tpr"), sql=f"""
WITH {_DOC_CTE},
g AS (SELECT score AS threshold, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label <> 1) AS neg
      FROM ds GROUP BY score),
t AS (SELECT COUNT(*) FILTER (WHERE label = 1) AS P, COUNT(*) FILTER (WHERE label <> 1) AS N FROM ds)
SELECT threshold, SUM(neg) OVER w / NULLIF(CAST(N AS DOUBLE), 0.0) AS fpr, SUM(pos) OVER w / NULLIF(CAST(P AS DOUBLE), 0.0) AS tpr
FROM g, t WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def roc_curve(spark, sf_dir):
    """J20d: ROC points at every distinct score (distributed prefix sums)."""
    return M.roc_curve(_doc_scores(spark, sf_dir))


@query("auc", doubles=("auc",), sql=f"""
WITH {_DOC_CTE}
SELECT AVG(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END) AS auc,
       (SELECT COUNT(*) FROM ds WHERE label = 1) AS n_pos, (SELECT COUNT(*) FROM ds WHERE label <> 1) AS n_neg
FROM ds p JOIN ds n ON p.label = 1 AND n.label <> 1""")
def auc(spark, sf_dir):
    """J20e: ROC-AUC by grouped rank sums (oracle: brute-force pairs)."""
    return M.auc(_doc_scores(spark, sf_dir))


@query("class_weights", doubles=("weight",), sql="""
WITH c AS (SELECT quality, COUNT(*) AS n_c FROM labels GROUP BY quality)
SELECT quality, n_c, (SELECT SUM(n_c) FROM c) / (CAST((SELECT COUNT(*) FROM c) AS DOUBLE) * n_c) AS weight FROM c""")
def class_weights(spark, sf_dir):
    """Balanced class weights n / (k n_c)."""
    return M.class_weights(read_table(spark, sf_dir, "labels"), "quality")


# --------------------------------------------------------------------------- model fits (rows-only)
def _reg_features(spark, sf_dir):
    return W.build_features(load_panel(spark, sf_dir))


_TRAIN_SQL, _SQL_FEATS = train_cte(FEATURE_COLS)
_RIDGE_CTE = FEATURES_CTE + "," + _TRAIN_SQL + "," + ridge_cte("rg", "train", _SQL_FEATS, "members", 0.01)


@query("ridge_fit", doubles=("coefficient", "standardized_coefficient"), sql=f"""
WITH RECURSIVE {_RIDGE_CTE}
SELECT UNNEST({FEATURE_COLS}) AS feature, UNNEST(w) AS coefficient, UNNEST(w_scaled) AS standardized_coefficient FROM rg
UNION ALL SELECT '(intercept)', b, NULL FROM rg""")
def ridge_fit(spark, sf_dir):
    """J2 + J21: ridge (alpha 0.01) coefficients on the lag features."""
    return ML.ridge_fit(_reg_features(spark, sf_dir), FEATURE_COLS, "members", 0.01)


@query("ridge_loo")
def ridge_loo(spark, sf_dir):
    """Exact leave-one-out ridge predictions (per-row down-date)."""
    return ML.ridge_loo(_reg_features(spark, sf_dir), FEATURE_COLS, "members", 0.01, ["unit", "period"])


@query("grid_search")
def grid_search(spark, sf_dir):
    """Ridge alpha grid scored by pooled LOO metrics."""
    return ML.ridge_grid(_reg_features(spark, sf_dir), FEATURE_COLS, "members",
                         [0.001, 0.01, 0.1, 1.0, 10.0, 50.0, 100.0], ["unit", "period"])


@query("score_next_period", doubles=("members_lag1", "pred_members"), sql=f"""
WITH RECURSIVE {_RIDGE_CTE},{NEXT_PERIOD_CTE}
SELECT unit, period, members_lag1,
       GREATEST(0.0, rg.b + list_dot_product([{", ".join(f"CAST({c} AS DOUBLE)" for c in FEATURE_COLS)}], rg.w)) AS pred_members
FROM npf, rg""")
def score_next_period(spark, sf_dir):
    """Next-period member forecast per unit (ridge coefficients inlined
    as column arithmetic, clamped at 0)."""
    coefs = ML.ridge_fit(_reg_features(spark, sf_dir), FEATURE_COLS, "members", 0.01)
    nxt = W.next_period_features(load_panel(spark, sf_dir))
    return ML.linear_score(nxt, coefs, "pred_members").select("unit", "period", "members_lag1", "pred_members")


def _doc_features(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    words = F.size(F.split(F.trim(F.col("text")), r"\s+"))
    digits = F.length(F.regexp_replace("text", r"[^0-9]", ""))
    return d.join(lab, "doc_id").select(
        "doc_id", "quality", F.log1p("n_chars").alias("log_chars"), F.log1p(words).alias("log_words"),
        (F.col("n_chars") / F.greatest(words, F.lit(1))).alias("chars_per_word"),
        (digits / F.greatest(F.col("n_chars"), F.lit(1))).alias("digit_share"))


_DOC_FEATS = ["log_chars", "log_words", "chars_per_word", "digit_share"]


@query("logreg_fit")
def logreg_fit(spark, sf_dir):
    """Balanced L2 logistic regression (C = 1) on document features;
    per-row P(class 1) and predicted class."""
    _, scored = ML.logreg_fit(_doc_features(spark, sf_dir), _DOC_FEATS, "quality", C=1.0)
    return scored.select("doc_id", F.col("quality").cast("int").alias("label"), "p1",
                         F.col("prediction").cast("int").alias("pred"))


@query("rf_fit")
def rf_fit(spark, sf_dir):
    """Random forests (regressor on the lag features,
    balanced classifier on documents) and their feature importances."""
    reg = ML.rf_regressor(_reg_features(spark, sf_dir).na.fill(0.0), FEATURE_COLS, "members")
    cls, _ = ML.rf_classifier(_doc_features(spark, sf_dir), _DOC_FEATS, "quality")
    a = ML.importances(reg, FEATURE_COLS, spark).withColumn("model", F.lit("rf_regressor"))
    b = ML.importances(cls, _DOC_FEATS, spark).withColumn("model", F.lit("rf_classifier"))
    return a.unionByName(b)


@query("gbt_fit")
def gbt_fit(spark, sf_dir):
    """Boosted trees on the lag features; next-period forecasts."""
    f = _reg_features(spark, sf_dir).na.fill(0.0)
    m = ML.gbt_regressor(f, FEATURE_COLS, "members")
    nxt = W.next_period_features(load_panel(spark, sf_dir)).na.fill(0.0)
    return m.transform(nxt).select("unit", "period", F.col("prediction").alias("gbt_forecast"))


def _unit_profile(spark, sf_dir):
    return cut_lineage(D.unit_profile(load_panel(spark, sf_dir)))     # scaler and fits read it again


_CLU_FEATS = ["avg_variation", "cv_members"]


@query("kmeans_profile")
def kmeans_profile(spark, sf_dir):
    """J8 + D11 + B15c: k-means (k = 3, 10 restarts) on the scaled unit
    profile, cluster profile and name."""
    from ..functions.scalar import cluster_name
    up = _unit_profile(spark, sf_dir)
    z = ML.pop_scale(up, _CLU_FEATS, suffix="__z")
    _, lab = ML.kmeans(z, [c + "__z" for c in _CLU_FEATS], k=3, n_init=10)
    prof = D.cluster_profile(lab, "prediction", ["avg_members", "avg_leak_rate", "avg_variation", "range_members",
                                                 "cv_members", "max_leak_rate", "trend_pct", "retention_rate"])
    return prof.withColumn("name", cluster_name("avg_variation", "cv_members")) \
               .withColumnRenamed("prediction", "cluster_km")


@query("gmm_soft")
def gmm_soft(spark, sf_dir):
    """Gaussian mixture (k = 3) hard label and soft probabilities."""
    up = _unit_profile(spark, sf_dir)
    z = ML.pop_scale(up, _CLU_FEATS, suffix="__z")
    _, out = ML.gmm(z, [c + "__z" for c in _CLU_FEATS], k=3)
    return out.select("unit", F.col("prediction").alias("cluster_gmm"),
                      *[F.col("proba")[i].alias(f"p{i}") for i in range(3)])


@query("pca2")
def pca2(spark, sf_dir):
    """First two principal components of the scaled anomaly features."""
    z = ML.pop_scale(anomaly_frame(spark, sf_dir), ANOM_FEATS, suffix="__z")
    _, proj, _ev = ML.pca(z.select("id", *[c + "__z" for c in ANOM_FEATS]), [c + "__z" for c in ANOM_FEATS], 2)
    return proj.select("id", "pc1", "pc2")


@query("leak_model")
def leak_model(spark, sf_dir):
    """J25 (behind B16): leak_rate regressor on lag features only, 5-fold
    CV by hashed unit folds, MAE per fold plus mean and std (D16)."""
    f = _reg_features(spark, sf_dir).na.fill(0.0)
    feats = ["members_lag1", "leak_rate_lag1", "growth_rate_lag1", "delta_members_lag1", "season_index"]
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    assert not set(feats) & {"leak_rate", "retention_rate", "members_x_retention"}, "target leakage"
    rf = RandomForestRegressor(featuresCol="features", labelCol="leak_rate", numTrees=50, maxDepth=3, seed=42)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"), rf])
    oof = ML.oof_predict(f, pipe, ML.hash_folds("unit", 5))
    folds = oof.groupBy("fold").agg(F.avg(F.abs(F.col("leak_rate") - F.col("prediction"))).alias("mae"))
    return D.cv_summary(folds, "mae")


@query("logit_grid")
def logit_grid(spark, sf_dir):
    """J5 + J23 + J24: balanced logit over six C and five hashed folds of the documents,
    all candidates fitted together; pooled out-of-fold metrics and the best C."""
    f = _doc_features(spark, sf_dir).dropna()
    fold, k = ML.hash_folds("doc_id", 5)
    oof = S.logit_grid(f.withColumn("fold", fold), "doc_id", _DOC_FEATS, "quality", "fold", [0.001, 0.01, 0.1, 1.0, 10.0, 100.0])
    return S.grid_metrics(cut_lineage(oof))


@query("k_selection")
def k_selection(spark, sf_dir):
    """J8 + J9b + J10 + J11: k-means and mixtures for k = 2..4, ten starts each, on the
    scaled unit profile; quality per k and both picks."""
    z = ML.pop_scale(_unit_profile(spark, sf_dir), _CLU_FEATS, suffix="__z").na.fill(0.0)
    return S.k_selection(z, "unit", [c + "__z" for c in _CLU_FEATS], [2, 3, 4])
