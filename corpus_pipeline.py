"""Corpus pipeline: quality filter, line dedup, near-dedup, source mix, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
works on every row that the stage before it kept.  ``run`` writes each stage's
result as Parquet in the shared folder and reads it again for the next one, so a
lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlens.llm.bpe import encode, load_ranks
from memberlens.llm.common import scratch, table
from memberlens.llm.lines import passage_dedup
from memberlens.llm.mixing import mix
from memberlens.llm.quality import fit_quality, score_quality
from memberlens.llm.queries import QUALITY_THRESHOLD
from memberlens.llm.simhash import simhash_dedup
from memberlens.session import ensure_checkpoint_dir

#: Rank file of the token ids.
RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, out="pipeline_score").filter(F.col("pipeline_score") >= QUALITY_THRESHOLD).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere before; ``n_chars`` follows the text."""
    out = passage_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    return simhash_dedup(docs).filter("kept").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0 to 3 times)."""
    turn = scratch(docs, "copy")
    return mix(docs).filter("copies > 0").withColumn(turn, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether decoding them gives the text's bytes back."""
    import public_tokenizers
    ranks = load_ranks(public_tokenizers.path(RANKS))
    return encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"], outputs=("n_tokens", "ids", "round_trip"))


STAGES = [("quality", quality), ("line_dedup", lines), ("simhash", near_duplicates), ("mix", mixture), ("bpe", tokens)]

#: Neither the compressed sizes nor XXH64 nor the token ids can be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; the last one's rows."""
    docs, base = table(spark, sf_dir, "documents"), f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for i, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
