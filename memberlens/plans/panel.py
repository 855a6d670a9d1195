"""Canonical inputs derived from the warehouse tables.

``build_panel`` is the (unit, period) membership panel every panel operator
reads.  Plan shape at scale:

* orders -> ``groupBy(o_custkey)`` with a set of active years.  The aggregate
  is partial (map-side) so a customer holding a third of all orders collapses
  to one small set per map task before the shuffle.
* join customer on the same key: the aggregated side is already hash
  partitioned on ``o_custkey``, so only customer is exchanged (or broadcast,
  when AQE measures it under the threshold).
* ``explode`` the years, flag "also active the year before" from the same
  set (no self-join), then a partial aggregate on (unit, period).
* previous-period members by ``lag`` over ``partitionBy(unit)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import leak_rate_expr
from ..sources.tables import read_table


def customer_years(orders: DataFrame) -> DataFrame:
    """Distinct active years per customer: (o_custkey, years array<int>)."""
    return (orders
            .select("o_custkey", F.year("o_orderdate").alias("period"))
            .groupBy("o_custkey")
            .agg(F.array_sort(F.collect_set("period")).alias("years")))


def panel_events(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per (entity, unit, period) with a retained flag (C11)."""
    cy = customer_years(orders)
    cust = customer.select(F.col("c_custkey").alias("o_custkey"),
                           F.col("c_nationkey").alias("unit"))
    return (cy.join(cust, "o_custkey")
            .select("o_custkey", "unit", "years", F.explode("years").alias("period"))
            .select(F.col("o_custkey").alias("entity"), "unit", "period",
                    F.array_contains("years", F.col("period") - 1).cast("int").alias("retained")))


def build_panel(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Panel (unit int, period int, members, members_prev, retained, leak_rate).

    ``members_prev`` is positional (previous available period, 0 for the
    first), ``leak_rate`` = round(max(0, (prev - cur) / prev * 100), 2), 0 when
    prev = 0.
    """
    ev = panel_events(orders, customer)
    agg = (ev.groupBy("unit", "period")
           .agg(F.count(F.lit(1)).alias("members"),
                F.sum("retained").cast("bigint").alias("retained")))
    w = Window.partitionBy("unit").orderBy("period")
    prev = F.coalesce(F.lag("members", 1).over(w), F.lit(0)).cast("bigint")
    return (agg.withColumn("members_prev", prev)
            .withColumn("leak_rate", leak_rate_expr(F.col("members_prev"), F.col("members")))
            .select("unit", "period", "members", "members_prev", "retained", "leak_rate"))


def load_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_panel(read_table(spark, sf_dir, "orders"),
                       read_table(spark, sf_dir, "customer"))


def load_cust_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale variant: one series per customer, y = yearly order value."""
    o = read_table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("unit"),
                      F.year("o_orderdate").alias("period"))
            .agg(F.sum("o_totalprice").alias("y")))


def load_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request events from ``events``: endpoint from props.k, 500 on error."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("ep"), (k % 4).cast("string")).alias("endpoint"),
        F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")).alias("status"),
        (F.col("value") / 50.0).alias("latency_s"),
        "user_id", "event_type", "value")


def load_order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric rows for clustering / anomaly at scale: per-order lineitem stats."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("id"))
            .agg(F.count(F.lit(1)).cast("double").alias("n_lines"),
                 F.sum("l_quantity").alias("qty"),
                 F.sum("l_extendedprice").alias("revenue"),
                 F.avg("l_discount").alias("avg_discount")))


def load_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows: documents joined with quality labels."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id")
