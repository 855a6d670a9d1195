"""K queries over a run ledger built from deterministic evaluations on the
given tables: expanding-origin backtests of three forecasters on the panel
(one run per model and evaluation period) and length-threshold rules on the
labelled documents (one run per threshold)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as D
from ..operators import ledger as K
from ..operators import registry as G
from ..operators import timeseries as TS
from ..plans.panel import load_panel
from ..session import cut_lineage
from ..sources.tables import read_table
from ..streaming.streams import scratch_path
from .registry import query
from .sqlparts import PANEL_CTE

# Fixed parameters of the document rule runs.
DOC_THRESHOLDS = [500, 1000, 2000, 4000]
FORECASTERS = ["naive", "mean", "drift"]


def build_ledger(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    bt = D.compare(*[TS.backtest(p, model=m) for m in FORECASTERS])
    last = p.agg(F.max("period").alias("mx"))
    first_eval = bt.agg(F.min("period").alias("mn"))
    bt = bt.withColumn("_mx", last.select("mx").scalar()).withColumn("_mn", first_eval.select("mn").scalar())
    ev = bt.select("model", "y", "pred", "_mn", F.explode(F.sequence("period", "_mx")).alias("e"))
    err = F.col("y") - F.col("pred")
    ts = ev.groupBy("model", "e", "_mn").agg(
        (1 - F.avg(err * err) / F.nullif(F.var_pop("y"), F.lit(0.0))).alias("R2"),
        F.avg(F.abs(err)).alias("MAE"))
    ts = ts.select(F.concat_ws(":", F.lit("timeseries"), "model", F.col("e").cast("string")).alias("run_id"),
                   F.lit("timeseries").alias("section"), "model",
                   F.concat(F.lit("panel_"), "model", F.lit("_forecast")).alias("registered_name"),
                   (F.col("e") - F.col("_mn") + 1).cast("int").alias("version"),
                   F.make_timestamp_ntz(F.col("e") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("start_time"),
                   "R2", "MAE")
    ts_long = ts.selectExpr("run_id", "section", "model", "registered_name", "version", "start_time",
                            "stack(2, 'R2', R2, 'MAE', MAE) as (metric_name, metric_value)")

    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    th = F.array(*[F.struct(F.lit(i + 1).alias("v"), F.lit(t).alias("t")) for i, t in enumerate(DOC_THRESHOLDS)])
    dj = d.join(lab, "doc_id").select("quality", "n_chars", F.explode(th).alias("r"))
    pred = (F.col("n_chars") >= F.col("r.t")).cast("int")
    tp = F.count_if((F.col("quality") == 1) & (pred == 1))
    fp = F.count_if((F.col("quality") == 0) & (pred == 1))
    fn = F.count_if((F.col("quality") == 1) & (pred == 0))
    cls = dj.groupBy(F.col("r.v").alias("v"), F.col("r.t").alias("t")).agg(
        F.coalesce(2.0 * tp / F.nullif((2 * tp + fp + fn).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("F1"),
        (F.count_if(F.col("quality") == pred) / F.count(F.lit(1)).cast("double")).alias("Accuracy"))
    cls = cls.select(F.concat(F.lit("classification:length_rule:"), F.col("t").cast("string")).alias("run_id"),
                     F.lit("classification").alias("section"),
                     F.concat(F.lit("length_rule_"), F.col("t").cast("string")).alias("model"),
                     F.lit("doc_length_rule").alias("registered_name"), F.col("v").cast("int").alias("version"),
                     F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.col("v"), F.lit(0), F.lit(0), F.lit(0)).alias("start_time"),
                     "F1", "Accuracy")
    cls_long = cls.selectExpr("run_id", "section", "model", "registered_name", "version", "start_time",
                              "stack(2, 'F1', F1, 'Accuracy', Accuracy) as (metric_name, metric_value)")
    return ts_long.unionByName(cls_long)


_LEDGER_CTE = PANEL_CTE + """,
m AS (SELECT unit, period, CAST(members AS DOUBLE) AS y FROM panel),
bt AS (
  SELECT unit, period, 'naive' AS model, y, LAG(y) OVER w AS pred FROM m WINDOW w AS (PARTITION BY unit ORDER BY period)
  UNION ALL
  SELECT unit, period, 'mean', y, AVG(y) OVER (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) FROM m
  UNION ALL
  SELECT unit, period, 'drift', y,
         CASE WHEN COUNT(y) OVER p >= 2
              THEN LAG(y) OVER w + (LAG(y) OVER w - FIRST_VALUE(y) OVER p) / (COUNT(y) OVER p - 1)
              ELSE LAG(y) OVER w END
  FROM m WINDOW w AS (PARTITION BY unit ORDER BY period),
                p AS (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
btn AS (SELECT * FROM bt WHERE pred IS NOT NULL),
lim AS (SELECT (SELECT MAX(period) FROM panel) AS mx, (SELECT MIN(period) FROM btn) AS mn),
ev AS (SELECT model, y, pred, mn, e FROM btn, lim, UNNEST(generate_series(period, mx)) AS g(e)),
tsr AS (SELECT model, e, mn, 1 - AVG((y - pred) * (y - pred)) / NULLIF(var_pop(y), 0.0) AS r2,
               AVG(abs(y - pred)) AS mae FROM ev GROUP BY model, e, mn),
tsl AS (
  SELECT 'timeseries:' || model || ':' || CAST(e AS VARCHAR) AS run_id, 'timeseries' AS section, model,
         'panel_' || model || '_forecast' AS registered_name, CAST(e - mn + 1 AS INTEGER) AS version,
         make_timestamp(CAST(e + 1 AS BIGINT), 1, 1, 0, 0, 0) AS start_time, u.metric_name, u.metric_value
  FROM tsr, UNNEST([{'metric_name': 'R2', 'metric_value': r2}, {'metric_name': 'MAE', 'metric_value': mae}]) AS t(u)),
dj AS (SELECT l.quality, d.n_chars, th.v, th.t
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id,
            (VALUES """ + ", ".join(f"({i + 1}, {t})" for i, t in enumerate(DOC_THRESHOLDS)) + """) AS th(v, t)),
cr AS (SELECT v, t,
         COALESCE(2.0 * COUNT(*) FILTER (WHERE quality = 1 AND n_chars >= t)
           / NULLIF(CAST(2 * COUNT(*) FILTER (WHERE quality = 1 AND n_chars >= t) + COUNT(*) FILTER (WHERE quality = 0 AND n_chars >= t)
                         + COUNT(*) FILTER (WHERE quality = 1 AND n_chars < t) AS DOUBLE), 0.0), 0.0) AS f1,
         COUNT(*) FILTER (WHERE quality = CAST(n_chars >= t AS INTEGER)) / CAST(COUNT(*) AS DOUBLE) AS acc
       FROM dj GROUP BY v, t),
cl AS (
  SELECT 'classification:length_rule:' || CAST(t AS VARCHAR) AS run_id, 'classification' AS section,
         'length_rule_' || CAST(t AS VARCHAR) AS model, 'doc_length_rule' AS registered_name, CAST(v AS INTEGER) AS version,
         make_timestamp(2024, 1, v, 0, 0, 0) AS start_time, u.metric_name, u.metric_value
  FROM cr, UNNEST([{'metric_name': 'F1', 'metric_value': f1}, {'metric_name': 'Accuracy', 'metric_value': acc}]) AS t(u)),
ledger AS (SELECT * FROM tsl UNION ALL SELECT * FROM cl),
sm AS (SELECT * FROM (VALUES ('regression', 'R2'), ('classification', 'F1'), ('clustering', 'Silhouette'),
                             ('timeseries', 'R2')) AS s(section, key_metric)),
runs AS (SELECT DISTINCT run_id, section, model, registered_name, version, start_time FROM ledger),
scored AS (SELECT r.*, COALESCE(k.metric_value, -999.0) AS score
           FROM runs r LEFT JOIN (SELECT l.run_id, l.metric_value FROM ledger l JOIN sm ON l.section = sm.section
                                  AND l.metric_name = sm.key_metric) k ON r.run_id = k.run_id),
best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section ORDER BY score DESC, start_time DESC, run_id) AS rn
                                     FROM scored) WHERE rn = 1),
thr AS (SELECT * FROM (VALUES ('R2', 0.5), ('F1', 0.6), ('Silhouette', 0.4)) AS t(metric_name, threshold)),
gb AS (SELECT l.registered_name, l.section, l.metric_name, CAST(thr.threshold AS DOUBLE) AS threshold, MAX(l.metric_value) AS best_value
       FROM ledger l JOIN thr ON l.metric_name = thr.metric_name GROUP BY ALL),
mods AS (SELECT DISTINCT registered_name, section FROM ledger),
gate AS (SELECT m.registered_name, m.section, gb.metric_name, gb.threshold, COALESCE(gb.best_value, 0.0) AS best_value,
                CAST(COALESCE(gb.best_value, 0.0) >= COALESCE(gb.threshold, 'inf'::DOUBLE) AS INTEGER) AS validated
         FROM mods m LEFT JOIN gb ON m.registered_name = gb.registered_name AND m.section = gb.section),
lv AS (SELECT registered_name, MAX(version) AS latest_version, arg_max(run_id, version) AS latest_run_id
       FROM (SELECT DISTINCT registered_name, version, run_id FROM ledger) GROUP BY registered_name),
prom AS (SELECT g.registered_name, g.section, lv.latest_version AS version, g.validated,
                CASE WHEN g.registered_name = b.registered_name AND g.validated = 1 THEN 'production'
                     WHEN g.registered_name = b.registered_name THEN 'staging' ELSE 'registered' END AS stage
         FROM gate g LEFT JOIN best b ON g.section = b.section JOIN lv ON g.registered_name = lv.registered_name)"""


def ledger_once(spark, sf_dir):
    """The ledger, built once: best runs, gate and promotion read it several times."""
    return cut_lineage(build_ledger(spark, sf_dir))


@query("run_ledger", doubles=("metric_value",), sql=f"""
WITH {_LEDGER_CTE}
SELECT * FROM ledger""")
def run_ledger(spark, sf_dir):
    """K1: the run ledger (long form: one row per run and metric)."""
    return build_ledger(spark, sf_dir)


@query("best_runs", doubles=("score",), sql=f"""
WITH {_LEDGER_CTE}
SELECT * FROM best""")
def best_runs(spark, sf_dir):
    """K2: best run per section by the section metric (-999 when missing,
    most recent wins ties)."""
    return K.best_runs(ledger_once(spark, sf_dir), spark)


@query("run_summary", sql=f"""
WITH {_LEDGER_CTE},
piv AS (SELECT run_id, MAX(metric_value) FILTER (WHERE metric_name = 'R2') AS r2,
               MAX(metric_value) FILTER (WHERE metric_name = 'F1') AS f1,
               MAX(metric_value) FILTER (WHERE metric_name = 'Silhouette') AS sil FROM ledger GROUP BY run_id)
SELECT run_id, COALESCE('R2=' || printf('%.3f', r2), 'F1=' || printf('%.3f', f1),
                        'Silhouette=' || printf('%.3f', sil), 'n/a') AS key_metric FROM piv""")
def run_summary(spark, sf_dir):
    """K3: key-metric label per run."""
    return K.run_summary(ledger_once(spark, sf_dir))


@query("latest_versions", sql=f"""
WITH {_LEDGER_CTE}
SELECT * FROM lv""")
def latest_versions(spark, sf_dir):
    """K4: latest integer version per registered model."""
    return K.latest_versions(ledger_once(spark, sf_dir))


@query("gate", doubles=("threshold", "best_value"), sql=f"""
WITH {_LEDGER_CTE}
SELECT * FROM gate""")
def gate(spark, sf_dir):
    """Quality gate per registered model."""
    return K.gate(ledger_once(spark, sf_dir), spark)


@query("promote", sql=f"""
WITH {_LEDGER_CTE}
SELECT * FROM prom""")
def promote(spark, sf_dir):
    """K6: registered / staging / production stage per model."""
    return K.promote(ledger_once(spark, sf_dir), spark)


@query("registry_report", sql=f"""
WITH {_LEDGER_CTE}
SELECT p.registered_name, p.version, p.stage, p.section, g.metric_name,
       concat_ws(' ', p.section, 'model,', g.metric_name, printf('%.3f', g.best_value)) AS description,
       COUNT(*) FILTER (WHERE p.stage = 'production') OVER () AS n_production
FROM prom p JOIN gate g ON p.registered_name = g.registered_name""")
def registry_report(spark, sf_dir):
    """K7: registry report with the production count."""
    return K.registry_report(ledger_once(spark, sf_dir), spark)


# The model whose runs are kept out of the gate, so that its ``metric`` tag counts.
TAGGED_MODEL = "panel_drift_forecast"


def _run_records(spark, sf_dir):
    return G.run_records(build_ledger(spark, sf_dir),
                         tags={"section": F.col("section"), "validation": F.when(F.col("section") == "timeseries", "expanding")},
                         params={"version": F.col("version"), "threshold": F.when(F.col("section") == "classification", F.element_at(F.split("model", "_"), -1))})


@query("run_records", doubles=("r2", "f1", "accuracy"), sql=f"""
WITH {_LEDGER_CTE}
SELECT run_id, model AS run_name, section, section AS tag_section, CASE WHEN section = 'timeseries' THEN 'expanding' END AS tag_validation,
       CASE WHEN section = 'classification' THEN split_part(model, '_', 3) END AS param_threshold, CAST(version AS VARCHAR) AS param_version,
       CAST(COUNT(DISTINCT metric_name) AS INTEGER) AS n_metrics, MAX(metric_value) FILTER (WHERE metric_name = 'R2') AS r2,
       MAX(metric_value) FILTER (WHERE metric_name = 'F1') AS f1, MAX(metric_value) FILTER (WHERE metric_name = 'Accuracy') AS accuracy
FROM ledger GROUP BY run_id, model, section, version""")
def run_records(spark, sf_dir):
    """K1: run records with tags, params and metrics as maps, written as a batch and looked up by key."""
    path = scratch_path(spark, "runs")
    G.append_runs(_run_records(spark, sf_dir), path, "all")
    r = spark.read.parquet(path)
    return r.select("run_id", "run_name", "section", F.element_at("tags", "section").alias("tag_section"), F.element_at("tags", "validation").alias("tag_validation"),
                    F.element_at("params", "threshold").alias("param_threshold"), F.element_at("params", "version").alias("param_version"),
                    F.size("metrics").alias("n_metrics"), F.element_at("metrics", "R2").alias("r2"), F.element_at("metrics", "F1").alias("f1"),
                    F.element_at("metrics", "Accuracy").alias("accuracy"))


@query("registry_aliases", sql=f"""
WITH {_LEDGER_CTE},
best2 AS (SELECT section, registered_name AS staged FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY section ORDER BY score DESC, start_time DESC, run_id DESC) AS rn
            FROM scored WHERE registered_name <> '{TAGGED_MODEL}') WHERE rn = 1),
val AS (SELECT m.registered_name AS model, m.section, lv.latest_version AS version, COALESCE(gb.threshold, 0.0) AS threshold,
               printf('%s=%.3f', sm.key_metric, gb.best_value) AS metric,
               CASE WHEN m.registered_name = '{TAGGED_MODEL}' THEN CAST(printf('%.3f', gb.best_value) AS DOUBLE) ELSE gb.best_value END AS value
        FROM mods m JOIN sm ON m.section = sm.section JOIN lv ON m.registered_name = lv.registered_name
        JOIN gb ON gb.registered_name = m.registered_name AND gb.section = m.section AND gb.metric_name = sm.key_metric),
st AS (SELECT val.*, value >= threshold AS ok, COALESCE(model = staged, FALSE) AS staged_now FROM val LEFT JOIN best2 ON val.section = best2.section)
SELECT model, version, CASE WHEN ok THEN 'production' WHEN staged_now THEN 'staging' ELSE 'registered' END AS stage,
       CASE WHEN ok THEN 'true' ELSE 'false' END AS validated,
       CASE WHEN ok AND staged_now THEN 'production, staging' WHEN ok THEN 'production' WHEN staged_now THEN 'staging' ELSE '-' END AS aliases,
       metric, COUNT(*) FILTER (WHERE ok) OVER () AS n_production
FROM st""")
def registry_aliases(spark, sf_dir):
    """K5-K7: a registry of the ledger's models, promoted twice in a row and reported; one model has no
    runs of its own, so the gate reads the text of its tag."""
    runs, root = cut_lineage(_run_records(spark, sf_dir)), scratch_path(spark, "registry")
    key = G.metric_of(F.col("section"))
    models = runs.groupBy(F.col("registered_name").alias("name"), "section").agg(
        F.max(F.element_at("params", "version").cast("int")).alias("version"),
        F.create_map(F.lit("metric"), F.concat(F.any_value(key), F.lit("="), F.format_string("%.3f", F.max(F.element_at("metrics", key))))).alias("tags")) \
        .withColumn("aliases", F.lit(None).cast(G.MODEL_SCHEMA["aliases"].dataType))
    G.write_registry(models, root)
    own = runs.where(F.col("registered_name") != TAGGED_MODEL)
    for _ in range(2):
        G.write_registry(G.promote_models(G.read_registry(spark, root), own), root)
    return G.models_report(G.read_registry(spark, root))
