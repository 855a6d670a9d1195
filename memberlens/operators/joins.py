"""C: joins.

Broadcast is only requested for sides with a bound that does not grow with
the data (a rule table, one row per model, a 1-row aggregate).  Everything
else is left to the planner: AQE turns a sort-merge join into a broadcast join
only after measuring the shuffled side under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import season_year


def attach_leak(base: DataFrame, leak: DataFrame, keys=("unit", "period")) -> DataFrame:
    """Left equi join on (unit, period) to attach leak_rate."""
    return base.join(leak.select(*keys, "leak_rate"), list(keys), "left")


def join_on_expr(left: DataFrame, right: DataFrame, season_col: str = "season") -> DataFrame:
    """Equi join on a computed key (season string -> year)."""
    r = right.withColumn("_year", season_year(season_col))
    return left.join(r, (left["unit"] == r["unit"]) & (left["period"] == r["_year"]), "left") \
               .drop(r["unit"]).drop("_year")


def join_coalesce(left: DataFrame, right: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Left join with a colliding column, resolved by coalesce(left, right)."""
    lc = left.withColumnRenamed(col, "_l")
    rc = right.select(*keys, F.col(col).alias("_r"))
    return lc.join(rc, keys, "left").withColumn(col, F.coalesce("_l", "_r")).drop("_l", "_r")


def latest_rows(df: DataFrame, key: str, order: str, n: int = 1) -> DataFrame:
    """Latest ``n`` rows per key (row_number with a deterministic order)."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)


def retained(events: DataFrame, entity: str = "entity", period: str = "period") -> DataFrame:
    """C11: (entity, period) rows also present at period - 1 (left semi join)."""
    prev = events.select(F.col(entity).alias("_e"), (F.col(period) + 1).alias("_p"))
    return events.join(prev, (events[entity] == prev["_e"]) & (events[period] == prev["_p"]),
                       "left_semi")


def inhibit(alerts: DataFrame, equal: list[str], source_sev: str = "critical",
            target_sev: str = "warning") -> DataFrame:
    """Drop target-severity alerts while a source-severity alert with
    equal ``equal`` labels is active (left anti join)."""
    src = alerts.where(F.col("severity") == source_sev).select(*equal).distinct()
    tgt = alerts.where(F.col("severity") == target_sev)
    rest = alerts.where(F.col("severity") != target_sev)
    return rest.unionByName(tgt.join(src, equal, "left_anti"))


def with_baseline(df: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Attach a reference/baseline row by key (small fixed lookup table)."""
    return df.join(F.broadcast(ref), key, "left")
