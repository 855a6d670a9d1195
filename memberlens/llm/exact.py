"""Exact deduplication by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, mark_repeated, own_columns, repeated_keys, scratch

#: Leading characters that the second refinement looks at.
PREFIX_CHARS = 64


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                normalise=lambda c: c, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """All rows of ``docs`` plus ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when ``normalise(text)`` is identical; null counts as empty.
    Of equal texts the row with the largest id stays (``keep_id``).

    Three refinements, each over the survivors of the one before: groups of
    equal byte length, then of equal (length, hash of the first characters),
    then of equal SHA-256 of the whole text.  Which rows survive is told by a
    filter of fixed size that is broadcast, so no text is shuffled and the whole
    content is hashed only for rows that may have an equal.

    Nulls: a null id never wins against another id; equal texts that all have
    null ids get a null ``keep_id`` and are all kept.  Repeated rows (same id
    and text) count in ``group_size`` and share the value of ``kept``.  Further
    columns pass through; an input that has one of the three names is refused.
    """
    own_columns(docs, ["keep_id", "group_size", "kept"])
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    n, prefix = F.octet_length(text).cast("bigint"), F.substring(text, 1, prefix_chars)

    lengths = repeated_keys(docs.select(n.alias("k")))
    by_length, short = scratch(docs, "by_length"), scratch(docs, "short_key")
    key = F.xxhash64(n, prefix)
    passed = mark_repeated(docs, n, lengths, by_length)
    prefixes = repeated_keys(passed.filter(by_length).select(key.alias("k")))
    second = passed.withColumn(short, F.when(F.col(by_length), key))
    by_prefix, full = scratch(docs, "by_prefix"), scratch(docs, "full")
    third = mark_repeated(second, F.col(short), prefixes, by_prefix)
    # a row that no other can equal gets a key of its own, which also spreads it over the partitions
    alone = F.concat(F.lit("u"), F.hex(F.xxhash64(F.col(id_col), n, prefix)))
    hashed = third.withColumn(full, F.when(F.col(by_length) & F.col(by_prefix),
                                           F.concat(n.cast("string"), F.lit(":"), F.sha2(text, 256))).otherwise(alone))
    # cut: the join then has an exchange on either side, which AQE can split at a hot group
    groups = cut(hashed.filter(F.col(by_length) & F.col(by_prefix))
                 .groupBy(F.col(full).alias("_g")).agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                 .filter("group_size > 1"))
    out = hashed.join(groups, F.col(full) == F.col("_g"), "left")
    keep = F.when(F.col("_g").isNotNull(), F.col("keep_id")).otherwise(F.col(id_col))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], keep.alias("keep_id"),
                      F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
                      keep.eqNullSafe(F.col(id_col)).alias("kept"))


def text_sha256(text_col: str = "text", normalise=lambda c: c) -> Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8 (null counts as empty)."""
    return F.sha2(normalise(F.coalesce(F.col(text_col), F.lit(""))), 256)
