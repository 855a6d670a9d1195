"""Query catalog: name -> Spark callable, name -> DuckDB oracle SQL.

A query is registered with the double columns that both sides round to six
digits (different summation orders otherwise differ in the last bits).  The
Spark side rounds in the plan; the oracle SQL is wrapped with
``SELECT * REPLACE (round(c, 6) AS c)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ROUND_DIGITS = 6


def _round_df(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    if not cols:
        return df
    return df.select(*[F.round(F.col(c), ROUND_DIGITS).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _round_sql(sql: str, cols: tuple[str, ...]) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, {ROUND_DIGITS}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def query(name: str, sql: str | None = None, doubles: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` (and its oracle SQL)."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _round_df(fn(spark, sf_dir), tuple(doubles))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = _round_sql(sql.strip(), tuple(doubles))
        return fn
    return deco
