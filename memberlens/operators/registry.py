"""K1, K5-K7 with maps: run records, and a registry of models with tags and aliases.

A run record is (run_id, run_name, section, registered_name, start_time, tags, params, metrics),
a registered model (name, section, version, tags, aliases): ``version`` is its
newest one and ``aliases`` says which version an alias stands for.  The registry
is small; it is rewritten whole as a new numbered folder, and a row appended to
``current`` makes that folder the valid one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import read_optional
from .ledger import GATE_THRESHOLDS, MISSING, SECTION_METRIC

# The tags that a promotion sets.
PROMOTED_BY = "AutoML_Pipeline"

_TEXTS = T.MapType(T.StringType(), T.StringType())
MODEL_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("section", T.StringType()), T.StructField("version", T.IntegerType()),
                             T.StructField("tags", _TEXTS), T.StructField("aliases", T.MapType(T.StringType(), T.IntegerType()))])
_CURRENT_SCHEMA = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("path", T.StringType())])


def _lookup(pairs: list[tuple], key) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for p in pairs for v in p]), key)


def metric_of(section: Column) -> Column:
    """The metric that a section is ranked and gated by; null for an unknown one."""
    return _lookup(SECTION_METRIC, section)


def _put(m: Column, **values) -> Column:
    """The map with these keys set anew."""
    return F.map_concat(F.map_filter(m, lambda k, _: ~k.isin(*values)), F.create_map(*[c for k, v in values.items() for c in (F.lit(k), F.lit(v))]))


# ----------------------------------------------------------------------- K1
def run_records(ledger: DataFrame, tags: dict[str, Column] | None = None, params: dict[str, Column] | None = None) -> DataFrame:
    """K1: one record per run of a long ledger; ``tags`` and ``params`` are expressions over its columns.

    Metrics of a run are gathered in a map; of a metric logged twice the larger value counts.
    """
    keys = ["run_id", "section", "registered_name", "start_time"]

    def entries(values: dict[str, Column] | None) -> Column:
        return F.map_filter(F.create_map(*[c for k, v in (values or {}).items() for c in (F.lit(k), v.cast("string"))]), lambda _, v: v.isNotNull()) \
            if values else F.lit(None).cast(_TEXTS)
    rows = ledger.select(*keys, F.col("model").alias("run_name"), "metric_name", "metric_value", entries(tags).alias("tags"), entries(params).alias("params"))
    one = rows.groupBy(*keys, "run_name", "metric_name").agg(F.max("metric_value").alias("v"), F.any_value("tags").alias("tags"), F.any_value("params").alias("params"))
    return one.groupBy(*keys, "run_name").agg(F.any_value("tags").alias("tags"), F.any_value("params").alias("params"),
                                              F.map_from_entries(F.collect_list(F.struct("metric_name", "v"))).alias("metrics"))


def append_runs(runs: DataFrame, path: str, batch: str) -> None:
    """K1: add the runs of one ``batch``; a batch written again replaces itself only."""
    runs.write.mode("overwrite").parquet(f"{path}/batch={batch}")


# ----------------------------------------------------------------------- K5
def gate_models(models: DataFrame, runs: DataFrame) -> DataFrame:
    """K5: (name, metric, threshold, value, validated) per model.

    The value is the best of its section's metric over its runs; without one, the number
    behind the last '=' of its ``metric`` tag; without that, 0.
    """
    metric = metric_of(F.col("section"))
    best = runs.groupBy(F.col("registered_name").alias("name"), "section").agg(F.max(F.element_at("metrics", metric)).alias("found"))
    text = F.element_at("tags", "metric")
    told = F.when(F.contains(text, F.lit("=")), F.element_at(F.split(text, "="), -1).try_cast("double"))
    value = F.coalesce("found", told, F.lit(0.0))
    out = models.join(best, ["name", "section"], "left").withColumns({"metric": metric, "value": value})
    out = out.withColumn("threshold", _lookup(GATE_THRESHOLDS, F.col("metric")))
    return out.select("name", "metric", "threshold", "value", F.coalesce(F.col("value") >= F.col("threshold"), F.lit(False)).alias("validated"))


# ----------------------------------------------------------------------- K6
def best_of_sections(runs: DataFrame) -> DataFrame:
    """(section, staged): the model of a section's best run; -999 without the metric, ties to the latest run, then the larger id."""
    key = F.coalesce(F.element_at("metrics", metric_of(F.col("section"))), F.lit(MISSING))
    return runs.where(F.col("registered_name").isNotNull()).groupBy("section").agg(
        F.max_by("registered_name", F.struct(key, F.col("start_time"), F.col("run_id"))).alias("staged"))


def promote_models(models: DataFrame, runs: DataFrame) -> DataFrame:
    """K6: the registry after one promotion.

    The model of a section's best run gets the alias ``staging`` on its newest version; every model
    that passes the gate gets ``production`` there, which leaves its older version.
    Nothing is taken from models that do not pass.
    """
    j = models.join(gate_models(models, runs), "name").join(best_of_sections(runs), "section", "left")
    tags = F.coalesce("tags", F.create_map().cast(_TEXTS))
    aliases = F.coalesce("aliases", F.create_map().cast(MODEL_SCHEMA["aliases"].dataType))
    staged = F.coalesce(F.col("name") == F.col("staged"), F.lit(False))

    def alias(m, name):
        return F.map_concat(F.map_filter(m, lambda k, _: k != name), F.create_map(F.lit(name), F.col("version")))
    j = j.withColumns({"tags": F.when(staged, _put(tags, stage="staging")).otherwise(tags),
                       "aliases": F.when(staged, alias(aliases, "staging")).otherwise(aliases)})
    return j.select("name", "section", "version",
                    F.when(F.col("validated"), _put(F.col("tags"), stage="production", validated="true", promoted_by=PROMOTED_BY))
                    .otherwise(F.col("tags")).alias("tags"),
                    F.when(F.col("validated"), alias(F.col("aliases"), "production")).otherwise(F.col("aliases")).alias("aliases"))


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """The registry that is valid now (empty, if none was written)."""
    row = read_optional(spark, f"{root}/current", _CURRENT_SCHEMA).orderBy(F.col("number").desc()).first()
    return spark.read.schema(MODEL_SCHEMA).parquet(row["path"]) if row else spark.createDataFrame([], MODEL_SCHEMA)


def write_registry(models: DataFrame, root: str) -> int:
    """K6: make ``models`` the valid registry; returns its number.

    The new folder is written and checked before it becomes valid: a name that occurs twice, or an
    alias of a version that does not exist, raises and leaves the old registry valid.
    """
    spark = models.sparkSession
    number = (read_optional(spark, f"{root}/current", _CURRENT_SCHEMA).agg(F.max("number")).first()[0] or 0) + 1
    path = f"{root}/v{number}-{uuid.uuid4().hex[:12]}"
    models.select(*MODEL_SCHEMA.names).write.parquet(path)
    new = spark.read.schema(MODEL_SCHEMA).parquet(path)
    twice = new.groupBy("name").count().where(F.col("count") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"model {twice[0]['name']} occurs twice")
    stray = new.where(F.exists(F.map_values("aliases"), lambda v: v.isNull() | (v < 1) | (v > F.col("version")))).limit(1).collect()
    if stray:
        raise ValueError(f"an alias of {stray[0]['name']} stands for a version that does not exist")
    spark.createDataFrame([(number, path)], _CURRENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/current")
    return number


# ----------------------------------------------------------------------- K7
def models_report(models: DataFrame) -> DataFrame:
    """K7: (model, version, stage, validated, aliases, metric, n_production); what a model lacks is '-', 'registered' or 'false'."""
    held = F.array_sort(F.map_keys(F.map_filter("aliases", lambda _, v: v == F.col("version"))))
    rows = models.select(F.col("name").alias("model"), "version", F.coalesce(F.element_at("tags", "stage"), F.lit("registered")).alias("stage"),
                         F.coalesce(F.element_at("tags", "validated"), F.lit("false")).alias("validated"),
                         F.when(F.size(held) > 0, F.concat_ws(", ", held)).otherwise("-").alias("aliases"),
                         F.coalesce(F.element_at("tags", "metric"), F.lit("-")).alias("metric"))
    n = rows.agg(F.count_if(F.col("stage") == "production").alias("n")).select("n").scalar()
    return rows.withColumn("n_production", n)
