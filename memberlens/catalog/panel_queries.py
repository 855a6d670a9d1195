"""Panel and feature queries (A, B, C, E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..plans.panel import load_panel
from .registry import query
from .sqlparts import FEATURES_CTE, PANEL_CTE

FEATURE_DOUBLES = ("leak_rate", "members_lag1", "leak_rate_lag1", "growth_rate_lag1",
                   "delta_members_lag1", "avg_members_unite_past", "retention_rate",
                   "members_x_retention")


def feature_panel_df(spark, sf_dir):
    f = W.build_features(load_panel(spark, sf_dir))
    return f.withColumn("season_index", F.col("season_index").cast("int"))


@query("feature_panel", doubles=FEATURE_DOUBLES, sql=f"""
WITH {FEATURES_CTE}
SELECT * FROM features""")
def feature_panel(spark, sf_dir):
    """E11 flagship: orders x customer -> panel -> lag feature set."""
    return feature_panel_df(spark, sf_dir)


@query("panel", doubles=("leak_rate",), sql=f"""
WITH {PANEL_CTE}
SELECT * FROM panel""")
def panel(spark, sf_dir):
    """§1.1 / C11 / Q5: the membership panel with retained and leak_rate."""
    return load_panel(spark, sf_dir)
