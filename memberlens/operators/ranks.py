"""Exact row numbers over a whole table without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_row_number(df: DataFrame, order: list[str], out: str = "rank", total: str | None = None) -> DataFrame:
    """Add ``out``: each row's number (from 1) in the order of the columns
    ``order``, nulls first; ``total`` names a column for the number of rows.

    Rows are dealt to ranges of the order, and written so that the ranges do not
    change between attempts.  A range's first number is the number of rows in the
    ranges before it: one row a range, so that table is bounded by the number of
    partitions and broadcast.  Inside a range rows are numbered by a window.  Equal
    rows lie in one range: give a last column that tells rows apart, or the ties of
    a crowded value are one task's work (and their numbers any of theirs).
    """
    part, first = "_range", "_before"
    dealt = cut_lineage(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    sizes = dealt.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy(part)
    starts = sizes.select(F.col(part).alias("_r"), (F.sum("n").over(upto) - F.col("n")).alias(first), F.sum("n").over(Window.partitionBy()).alias("_all"))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    joined = dealt.withColumn("_at", inside).join(F.broadcast(starts), F.col(part) == F.col("_r"))
    extra = [F.col("_all").alias(total)] if total else []
    return joined.select(*df.columns, (F.col(first) + F.col("_at")).alias(out), *extra)
