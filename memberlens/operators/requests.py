"""A11 + C7 + J22: prediction requests, their features from a unit snapshot, and their answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .models import Model, linear_value, logit_value

#: Units up to which a snapshot is broadcast; a larger one is joined by key.
SNAPSHOT_ROWS = 100_000
# The members of a unit that no period is known of, and the request types of each model.
UNKNOWN_MEMBERS = 10.0
REGRESSION_TYPES = ["regression"]
CLASSIFICATION_TYPES = ["classification", "dropout"]


def unit_snapshot(panel: DataFrame) -> DataFrame:
    """One row a unit: last and last but one members, last leak rate, mean members, periods."""
    w = Window.partitionBy("unit").orderBy(F.col("period").desc())
    return panel.withColumn("_rn", F.row_number().over(w)).groupBy("unit").agg(
        F.max(F.when(F.col("_rn") == 1, F.col("members"))).cast("double").alias("m_last"),
        F.max(F.when(F.col("_rn") == 1, F.col("leak_rate"))).alias("leak_last"),
        F.max(F.when(F.col("_rn") == 2, F.col("members"))).cast("double").alias("m_prev"),
        F.avg("members").alias("m_mean"), F.max("period").alias("last_period"), F.count(F.lit(1)).alias("n"))


def request_features(requests: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The features of requests (``unit``, ``type``, optional ``members_lag1`` and ``leak_rate_lag1``).

    What a request leaves out comes from its unit's snapshot.  A unit without one
    counts as UNKNOWN_MEMBERS members, no leak and no change, at index 1.  The snapshot
    is broadcast only if it has at most SNAPSHOT_ROWS rows.
    """
    small = snapshot.limit(SNAPSHOT_ROWS + 1).count() <= SNAPSHOT_ROWS
    j = requests.join(F.broadcast(snapshot) if small else snapshot, "unit", "left")
    j = j.withColumn("type", F.coalesce("type", F.lit("regression"))) \
         .withColumn("members_lag1", F.coalesce("members_lag1", "m_last", F.lit(UNKNOWN_MEMBERS))) \
         .withColumn("leak_rate_lag1", F.coalesce("leak_rate_lag1", "leak_last", F.lit(0.0)))
    now, prev = F.col("members_lag1"), F.coalesce("m_prev", "m_last", "members_lag1")
    return j.withColumns({
        "growth_rate_lag1": F.when(prev > 0, (now - prev) / F.nullif(prev, F.lit(0.0)) * 100.0).otherwise(0.0),
        "delta_members_lag1": now - prev,
        "avg_members_unite_past": F.coalesce("m_mean", "members_lag1"),
        "season_index": F.coalesce("n", F.lit(0)) + 1,
        "retention_rate": 1 - F.col("leak_rate_lag1") / 100.0,
        "members_x_retention": now * (1 - F.col("leak_rate_lag1") / 100.0),
    }).drop("m_last", "leak_last", "m_prev", "m_mean", "last_period", "n")


def answer(features: DataFrame, regressor: Model, classifier: Model) -> DataFrame:
    """``status`` (200, or 400 for an unknown type), ``prediction`` and ``probability``.

    Both models are column arithmetic: a regression request gets the clamped value, a
    classification request its class above the threshold and P(class 1).
    """
    reg, cls = F.col("type").isin(REGRESSION_TYPES), F.col("type").isin(CLASSIFICATION_TYPES)
    p1 = logit_value(classifier)
    return features.withColumns({
        "status": F.when(reg | cls, 200).otherwise(400),
        "prediction": F.when(reg, linear_value(regressor)).when(cls, (p1 > float(classifier.params["threshold"])).cast("double")),
        "probability": F.when(cls, p1)})
