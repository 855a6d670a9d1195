"""K: model-run ledger, best runs, quality gate and stage promotion.

The ledger is a long table (run_id, section, model, registered_name, version,
start_time, metric_name, metric_value); appended as parquet partitions.
Everything else is joins, windows and small aggregates over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import with_scalars

# The metric each section is ranked by, and the promotion
# thresholds per metric.
SECTION_METRIC = [("regression", "R2"), ("classification", "F1"),
                  ("clustering", "Silhouette"), ("timeseries", "R2")]
GATE_THRESHOLDS = [("R2", 0.5), ("F1", 0.6), ("Silhouette", 0.4)]
MISSING = -999.0

LEDGER_SCHEMA = ("run_id string, section string, model string, registered_name string, version int, "
                 "start_time timestamp_ntz, metric_name string, metric_value double")


def section_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SECTION_METRIC, "section string, key_metric string")


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GATE_THRESHOLDS, "metric_name string, threshold double")


def log_runs(runs: DataFrame, path: str) -> None:
    """K1: append run records (metrics rounded to 4 digits) to the ledger."""
    (runs.withColumn("metric_value", F.round("metric_value", 4))
     .write.mode("append").partitionBy("section").parquet(path))


def best_runs(ledger: DataFrame, spark: SparkSession) -> DataFrame:
    """K2: best run per section by the section's metric; a run without that
    metric counts as -999; ties go to the most recent run (Q20)."""
    sm = section_metrics(spark)
    key = ledger.join(F.broadcast(sm), "section").where(F.col("metric_name") == F.col("key_metric"))
    per_run = ledger.select("run_id", "section", "model", "registered_name", "version", "start_time").distinct()
    scored = per_run.join(key.select("run_id", "key_metric", F.col("metric_value").alias("score")), "run_id", "left") \
                    .withColumn("score", F.coalesce("score", F.lit(MISSING)))
    w = Window.partitionBy("section").orderBy(F.col("score").desc(), F.col("start_time").desc(), F.col("run_id"))
    return scored.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "key_metric")


def run_summary(ledger: DataFrame) -> DataFrame:
    """K3: key-metric label per run: first available of R2, F1, Silhouette."""
    piv = ledger.groupBy("run_id").agg(*[F.max(F.when(F.col("metric_name") == m, F.col("metric_value"))).alias(m)
                                         for m in ("R2", "F1", "Silhouette")])
    label = F.coalesce(*[F.when(F.col(m).isNotNull(), F.concat(F.lit(m + "="), F.format_string("%.3f", F.col(m))))
                         for m in ("R2", "F1", "Silhouette")], F.lit("n/a"))
    return piv.select("run_id", label.alias("key_metric"))


def latest_versions(ledger: DataFrame) -> DataFrame:
    """K4: latest (integer) version per registered model."""
    runs = ledger.select("registered_name", "version", "run_id").distinct()
    return runs.groupBy("registered_name").agg(F.max("version").alias("latest_version"),
                                               F.max_by("run_id", "version").alias("latest_run_id"))


def gate(ledger: DataFrame, spark: SparkSession) -> DataFrame:
    """Best value of the gated metric per registered model vs the
    threshold; a model without the metric falls back to 0 (rejected)."""
    g = ledger.join(F.broadcast(thresholds(spark)), "metric_name")
    best = g.groupBy("registered_name", "section", "metric_name", "threshold") \
            .agg(F.max("metric_value").alias("best_value"))
    models = ledger.select("registered_name", "section").distinct()
    out = models.join(best, ["registered_name", "section"], "left")
    return out.select("registered_name", "section", "metric_name", "threshold",
                      F.coalesce("best_value", F.lit(0.0)).alias("best_value"),
                      (F.coalesce("best_value", F.lit(0.0)) >= F.coalesce("threshold", F.lit(float("inf"))))
                      .cast("int").alias("validated"))


def promote(ledger: DataFrame, spark: SparkSession) -> DataFrame:
    """K6: registered -> staging (the model of its section's best run) ->
    production (staging and validated); at most one production per section."""
    best = best_runs(ledger, spark).select("section", F.col("registered_name").alias("_staged"))
    g = gate(ledger, spark)
    lv = latest_versions(ledger)
    j = g.join(best, "section", "left").join(lv, "registered_name")
    staged = F.col("registered_name") == F.col("_staged")
    stage = (F.when(staged & (F.col("validated") == 1), F.lit("production"))
             .when(staged, F.lit("staging")).otherwise(F.lit("registered")))
    return j.select("registered_name", "section", F.col("latest_version").alias("version"), "validated",
                    stage.alias("stage"))


def registry_report(ledger: DataFrame, spark: SparkSession) -> DataFrame:
    """K7: one line per registered model with stage, metric description and
    the number of production models."""
    p = promote(ledger, spark)
    g = gate(ledger, spark).select("registered_name", "metric_name", "best_value")
    j = p.join(g, "registered_name")
    desc = F.concat_ws(" ", F.col("section"), F.lit("model,"), F.col("metric_name"),
                       F.format_string("%.3f", F.col("best_value")))
    j = with_scalars(j, p.agg(F.count_if(F.col("stage") == "production").alias("n")), "_production")
    return j.select("registered_name", "version", "stage", "section", "metric_name", desc.alias("description"),
                    F.col("_production.n").alias("n_production"))
