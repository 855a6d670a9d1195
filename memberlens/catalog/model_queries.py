"""Saved models and the requests that they answer.

A request per customer: its unit, a type by its key, and for some of them the
members and the leak rate that they override.  The models are fitted on the
lag features, saved, loaded again, and scored with what was loaded.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models as MD
from ..operators import requests as R
from ..operators import windows as W
from ..plans.panel import load_panel
from ..session import cut_lineage
from ..sources.tables import read_table
from ..streaming import streams as ST
from ..streaming.scoring import score_stream
from .analytics_queries import FEATURE_COLS
from .registry import query
from .sqlparts import FEATURES_CTE, logit_cte, ridge_cte, train_cte

# Penalties of the ridge and of the balanced logit.
ALPHA, LOGIT_C = 0.01, 0.001
REPLAY_FILES = 3

TRAIN_SQL, SQL_FEATS = train_cte(FEATURE_COLS)
_MODELS_CTE = FEATURES_CTE + "," + TRAIN_SQL + "," + ridge_cte("rg", "train", SQL_FEATS, "members", ALPHA) + "," + \
    logit_cte("lg", "train", SQL_FEATS, "losing", LOGIT_C)
_X = "[" + ", ".join(f"CAST({f} AS DOUBLE)" for f in FEATURE_COLS) + "]"

_REQUESTS_CTE = _MODELS_CTE + """,
sn AS (SELECT unit, CAST(MAX(members) FILTER (WHERE rn = 1) AS DOUBLE) AS m_last, MAX(leak_rate) FILTER (WHERE rn = 1) AS leak_last,
              CAST(MAX(members) FILTER (WHERE rn = 2) AS DOUBLE) AS m_prev, AVG(members) AS m_mean, COUNT(*) AS n
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY unit ORDER BY period DESC) AS rn FROM panel) GROUP BY unit),
rq AS (SELECT c_custkey AS request_id, c_nationkey AS unit,
              CASE c_custkey % 4 WHEN 0 THEN 'classification' WHEN 1 THEN 'dropout' WHEN 2 THEN NULL ELSE
                CASE WHEN c_custkey % 25 = 3 THEN 'clustering' ELSE 'regression' END END AS type,
              CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 90 AS DOUBLE) END AS o_members,
              CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey % 100 AS DOUBLE) END AS o_leak FROM customer),
r1 AS (SELECT request_id, rq.unit, COALESCE(type, 'regression') AS type, COALESCE(o_members, m_last, 10.0) AS members_lag1,
              COALESCE(o_leak, leak_last, 0.0) AS leak_rate_lag1, m_prev, m_last, m_mean, n FROM rq LEFT JOIN sn ON rq.unit = sn.unit),
r2 AS (SELECT *, COALESCE(m_prev, m_last, members_lag1) AS prev FROM r1),
ft AS (SELECT request_id, unit, type, members_lag1, leak_rate_lag1,
              CASE WHEN prev > 0 THEN (members_lag1 - prev) / prev * 100.0 ELSE 0.0 END AS growth_rate_lag1, members_lag1 - prev AS delta_members_lag1,
              COALESCE(m_mean, members_lag1) AS avg_members_unite_past, COALESCE(n, 0) + 1 AS season_index,
              1 - leak_rate_lag1 / 100.0 AS retention_rate, members_lag1 * (1 - leak_rate_lag1 / 100.0) AS members_x_retention FROM r2)"""
_ANSWERS = f"""
SELECT request_id, unit, type, members_lag1, leak_rate_lag1,
       CAST(CASE WHEN type IN ('regression', 'classification', 'dropout') THEN 200 ELSE 400 END AS INTEGER) AS status,
       CASE WHEN type = 'regression' THEN GREATEST(0.0, rg.b + list_dot_product({_X}, rg.w))
            WHEN type IN ('classification', 'dropout') THEN CAST(1 / (1 + exp(-lg.b - list_dot_product({_X}, lg.w))) > 0.5 AS DOUBLE) END AS prediction,
       CASE WHEN type IN ('classification', 'dropout') THEN 1 / (1 + exp(-lg.b - list_dot_product({_X}, lg.w))) END AS probability"""
_ANSWER_DOUBLES = ("members_lag1", "leak_rate_lag1", "prediction", "probability")
_ANSWER_COLS = ["request_id", "unit", "type", "members_lag1", "leak_rate_lag1", "status", "prediction", "probability"]


def _requests(spark, sf_dir):
    key = F.col("c_custkey")
    kind = F.when(key % 4 == 0, "classification").when(key % 4 == 1, "dropout") \
            .when(key % 4 == 3, F.when(key % 25 == 3, "clustering").otherwise("regression"))
    return read_table(spark, sf_dir, "customer").select(
        key.alias("request_id"), F.col("c_nationkey").alias("unit"), kind.alias("type"),
        F.when(key % 3 == 0, (key % 90).cast("double")).alias("members_lag1"),
        F.when(key % 5 == 0, (key % 100).cast("double")).alias("leak_rate_lag1"))


def _training(spark, sf_dir):
    """Lag features, missing ones 0, and whether the unit lost members (``losing``)."""
    f = W.build_features(load_panel(spark, sf_dir)).na.fill(0.0)
    return cut_lineage(f.withColumn("losing", (F.col("leak_rate") > 0).cast("int")))


def _store(spark, sf_dir):
    """A fresh model store with the fitted ridge and logit; (its folder, the training rows)."""
    train, root = _training(spark, sf_dir), ST.scratch_path(spark, "models")
    MD.save_model(spark, MD.fit_ridge(train, FEATURE_COLS, "members", ALPHA), root, "ridge")
    MD.save_model(spark, MD.fit_logit(train, FEATURE_COLS, "losing", LOGIT_C), root, "logit")
    return root, train


@query("score_requests", doubles=_ANSWER_DOUBLES, sql=f"""
WITH RECURSIVE {_REQUESTS_CTE}
{_ANSWERS} FROM ft, rg, lg""")
def score_requests(spark, sf_dir):
    """A8 + A11 + C7 + J22: a ridge and a logit fitted, saved, loaded, and applied to one request
    per customer as column arithmetic; a request of an unknown type is answered with 400."""
    root, _ = _store(spark, sf_dir)
    f = R.request_features(_requests(spark, sf_dir), R.unit_snapshot(load_panel(spark, sf_dir)))
    return R.answer(f, MD.load_model(spark, root, "ridge"), MD.load_model(spark, root, "logit")).select(*_ANSWER_COLS)


def _scored_stream(spark, sf_dir):
    root, train = _store(spark, sf_dir)
    path, req = ST.scratch_path(spark, "requests"), _requests(spark, sf_dir)
    for i in range(REPLAY_FILES):
        req.where(F.col("request_id") % REPLAY_FILES == i).coalesce(1).write.mode("append").parquet(path)
    ref = train.agg(F.array(*[F.struct(F.lit(f).alias("feature"), F.avg(f).alias("ref_mean"), F.stddev_pop(f).alias("ref_std"))
                              for f in _DRIFT_FEATS]).alias("r")).select(F.inline("r"))
    return score_stream(ST.folder_stream(spark, path, req.schema), lambda: R.unit_snapshot(load_panel(spark, sf_dir)), root, "ridge", "logit",
                        cut_lineage(ref), _DRIFT_FEATS, "requests")


_DRIFT_FEATS = ["members_lag1", "leak_rate_lag1", "growth_rate_lag1", "retention_rate"]


@query("stream_score_requests", doubles=_ANSWER_DOUBLES, sql=f"""
WITH RECURSIVE {_REQUESTS_CTE}
{_ANSWERS}, CAST(request_id % {REPLAY_FILES} AS INTEGER) AS batch_id, 1 AS regressor_version, 1 AS classifier_version FROM ft, rg, lg""")
def stream_score_requests(spark, sf_dir):
    """L22 + C7 (T): the same requests as a stream of several batches, each scored with the
    newest stored models and a snapshot read anew."""
    answers, _ = _scored_stream(spark, sf_dir)
    return answers.select(*_ANSWER_COLS, "batch_id", "regressor_version", "classifier_version")


@query("stream_request_drift", doubles=("cur_mean", "cur_std", "drift_score"), sql=f"""
WITH RECURSIVE {_REQUESTS_CTE},
st AS (""" + "\nUNION ALL\n".join(f"""SELECT CAST(request_id % {REPLAY_FILES} AS INTEGER) AS batch_id, '{f}' AS feature, AVG({f}) AS cur_mean, STDDEV_POP({f}) AS cur_std,
  (SELECT AVG({f}) FROM train) AS rm, (SELECT STDDEV_POP({f}) FROM train) AS rs FROM ft GROUP BY ALL""" for f in _DRIFT_FEATS) + """),
dr AS (SELECT batch_id, feature, cur_mean, cur_std,
              ROUND(LEAST(1.0, (abs(cur_mean - rm) / (rs + 1e-9) * 0.6 + abs(cur_std - rs) / (rs + 1e-9) * 0.4) / 3.0), 4) AS drift_score FROM st)
SELECT *, CAST(drift_score > 0.3 AS INTEGER) AS drift_detected, CAST(drift_score > 0.6 AS INTEGER) AS severe_drift FROM dr""")
def stream_request_drift(spark, sf_dir):
    """A12 + L10 (T): drift of every micro-batch's request features against the training rows."""
    _, drift = _scored_stream(spark, sf_dir)
    return drift.select("batch_id", "feature", "cur_mean", "cur_std", "drift_score", "drift_detected", "severe_drift")
