"""Scans, sinks, table profile, snapshots, schema contracts."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A1: parquet scan of one warehouse table.

    Projection and filters written downstream reach the scan through Catalyst
    (``ReadSchema`` / ``PushedFilters``); nothing is selected here on purpose.
    """
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_fact(spark: SparkSession, url: str, table: str, columns: list[str],
              order_by: list[str] | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int = 64, properties: dict | None = None) -> DataFrame:
    """A1: warehouse scan over JDBC with a column list and optional order.

    With ``partition_column`` the read is split into ``num_partitions`` range
    queries so a large fact table is not pulled through one connection.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    df = reader.load().select(*columns)
    return df.orderBy(*order_by) if order_by else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A2: CSV with header and a declared schema (never inferred)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """A3: sink without index; CSV gets a header."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def split_datasets(df: DataFrame) -> dict[str, DataFrame]:
    """A4: one cleaned panel fanned out to the four task datasets.

    The four selects share one cached scan; each keeps only its own columns
    (the leakage guard B16 decides which).
    """
    from ..operators.cleaning import feature_set
    base = df.cache()
    return {task: base.select(*feature_set(task)) for task in
            ("regression", "classification", "clustering", "timeseries")}


def read_optional(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """A5: missing input -> empty frame with the declared schema."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def to_records(df: DataFrame, col: str = "record") -> DataFrame:
    """One JSON object per row, built on the executors."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(col))


def profile_tables(spark: SparkSession, sf_dir: str, tables=TABLES) -> DataFrame:
    """Kind by name prefix, row count and column list for each table.

    One small aggregate per table (row counts come from parquet footers when
    nothing else is read), then one ``unionByName``.
    """
    parts = []
    for name in tables:
        df = read_table(spark, sf_dir, name)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("table_name"),
                    F.when(F.lit(name).startswith("dim_"), "dimension")
                    .when(F.lit(name).startswith("fact_"), "fact")
                    .otherwise("other").alias("kind"),
                    F.col("n_rows"),
                    F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
                    F.lit(",".join(df.columns)).alias("columns")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content fingerprint (row count + hash sum).

    A row is the text of its values, each with its length, so NULLs, empty
    strings and shifted values differ; the first 60 bits of its MD5 are summed
    modulo 2^61-1 in a decimal.  Partial sums are associative, so the result does
    not depend on the partitioning or row order.
    """
    value = [F.when(F.col(c).isNull(), F.lit("n")).otherwise(
        F.concat(F.lit("v"), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))) for c in df.columns]
    h = F.conv(F.substring(F.md5(F.concat_ws(",", *value)), 1, 15), 16, 10)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.pmod(F.sum(h.cast("decimal(38,0)")), F.lit(2305843009213693951))
                  .cast("bigint").alias("content_hash"))


def snapshot(df: DataFrame, root: str, run_id: str) -> str:
    """Write the data a run saw under ``root/run_id=<id>``."""
    path = os.path.join(root, f"run_id={run_id}")
    df.write.mode("overwrite").parquet(path)
    return path


# --------------------------------------------------------------------------- A13
_NUMERIC_RANK = {"byte": 0, "short": 1, "integer": 2, "long": 3, "float": 4, "double": 5}


def contract(df: DataFrame) -> list[dict]:
    """Typed signature (name, type, required) of a feature frame."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        kind = "long" if t in ("byte", "short", "integer", "long") else (
            "double" if t in ("float", "double") else t)
        out.append({"name": f.name, "type": kind, "required": True})
    return out


def enforce(df: DataFrame, signature: list[dict]) -> DataFrame:
    """Check and cast a frame to a signature before scoring.

    Missing columns raise; numeric columns are upcast only when safe; a
    ``_contract_violations`` column counts NULLs in required fields per row.
    """
    have = {f.name: f.dataType.typeName() for f in df.schema.fields}
    missing = [s["name"] for s in signature if s["name"] not in have]
    if missing:
        raise ValueError(f"missing columns for contract: {missing}")
    cols = []
    for s in signature:
        src = have[s["name"]]
        target = "bigint" if s["type"] == "long" else s["type"]
        if s["type"] == "long" and _NUMERIC_RANK.get(src, 9) > _NUMERIC_RANK["long"]:
            raise TypeError(f"unsafe cast {s['name']}: {src} -> long")
        cols.append(F.col(s["name"]).cast(target).alias(s["name"]))
    nulls = [F.when(F.col(s["name"]).isNull(), 1).otherwise(0)
             for s in signature if s.get("required", True)]
    viol = reduce(lambda a, b: a + b, nulls) if nulls else F.lit(0)
    return df.select(*cols, viol.alias("_contract_violations"))
