"""Mixing sources to target weights by nested hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut, own_columns

#: Weights of the sources in code-point order, repeating; null comes last.
WEIGHTS = (5, 2, 1)
#: A source is repeated at most so many times.
MAX_EPOCHS = 3
#: The sources' targets are broadcast up to so many bytes.
BROADCAST_BYTES = 16 << 20
#: The sampling hash has HASH_BITS bits; each histogram splits LEVEL_BITS of them.
HASH_BITS, LEVEL_BITS = 60, 10


def word_count(text: Column) -> Column:
    """Number of runs of non-white-space characters; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def sample_hash(key: Column, seed: str = "mix") -> Column:
    """The first 60 bits of MD5(seed:key); null keys hash like the empty string."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("bigint")


def weigh(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Add ``weight``: ``weights`` repeated along the code-point order of ``source``, null last.

    The order is one range-partitioned sort; ranks are counted within
    partitions and shifted by the partitions' sizes (one number each), so no
    task sees all sources.
    """
    s = cut(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    before, seen = {}, 0
    for r in s.groupBy("part").count().orderBy("part").collect():
        before[r["part"]], seen = seen, seen + r["count"]
    w = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    shift = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("part")) if before else F.lit(0)
    rank = (F.row_number().over(w) - 1 + shift) % len(weights)
    return s.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank + 1).cast("int"))).drop("part")


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` (double) to rows (source, source_size, weight).

    The sum of all sizes is shared by weight; a share above ``max_epochs`` times
    the source's size stops there and its excess is reshared by weight among the
    others, until none is above.  Each round is one aggregate over the sources.
    """
    s = cut(sources.withColumn("cap", F.lit(max_epochs) * F.col("source_size")).withColumn("full", F.lit(False)))
    total = s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    while True:
        taken, weight = s.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0)),
                              F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0.0))).first()
        share = F.lit(float(total - taken)) * F.col("weight") / F.lit(weight or 1.0)
        over = ~F.col("full") & (share > F.col("cap"))
        if s.filter(over).isEmpty():
            return s.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))
        s = cut(s.withColumn("full", F.col("full") | over))


def thresholds(rows: DataFrame, budgets: DataFrame, max_rounds: int = HASH_BITS // LEVEL_BITS) -> DataFrame:
    """(source, threshold): rows with hash ``u`` below or at it have sizes that sum near the source's ``budget``.

    A histogram of sizes by the hash's top bits finds, per source, the bucket in
    which the running sum crosses the budget; only that bucket's rows go into
    the next, finer histogram, until the bucket holds one hash value.  It is
    taken when that comes nearer to the budget.  No row is sorted: a window sees
    the 2**LEVEL_BITS buckets of one source.
    """
    state = budgets.select("source", F.col("budget"), F.lit(0).cast("bigint").alias("lo"),
                           F.lit(0).cast("decimal(38,0)").alias("below"))
    done = None
    for level in range(max_rounds):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        width = 1 << shift
        state = cut(state)
        s = state.select(F.col("source").alias("s"), "budget", "lo", "below")
        inside = rows.join(s, rows.source.eqNullSafe(F.col("s"))).filter(
            (F.col("u") >= F.col("lo")) & (F.col("u") <= F.col("lo") + F.lit((width << LEVEL_BITS) - 1)))
        hist = (inside.groupBy("s", "budget", "lo", "below", F.shiftright(F.col("u") - F.col("lo"), shift).alias("b"))
                .agg(F.sum("size").cast("decimal(38,0)").alias("n"), F.min("u").alias("first"), F.max("u").alias("last")))
        w = Window.partitionBy("s").orderBy("b")
        run = hist.withColumn("to", F.col("below") + F.sum("n").over(w)).withColumn("from", F.col("to") - F.col("n"))
        edge = cut(run.filter((F.col("from") < F.col("budget")) & (F.col("to") >= F.col("budget"))))
        nearer = F.col("to") - F.col("budget") <= F.col("budget") - F.col("from")
        single = edge.filter("first = last").select(
            F.col("s").alias("source"), F.when(nearer, F.col("last")).otherwise(F.col("first") - 1).alias("threshold"))
        done = single if done is None else done.union(single)
        state = edge.filter("first < last").select(F.col("s").alias("source"), "budget",
                                                   (F.col("lo") + F.col("b") * F.lit(width)).alias("lo"), F.col("from").alias("below"))
        if state.isEmpty():
            break
    return done


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """All rows of ``docs`` plus ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Each source's target is its share of all words (see ``targets``).  A source
    with target r times its size gives every row floor(r) times, and rows whose
    hash is at or below its threshold once more; ``copies`` is that number and
    ``taken`` is ``copies * size``.  So a source's taken words differ from its
    target by at most half of its boundary row's size (or rows of equal id).

    The choice depends on the ids' hashes alone, so reruns and lost executors
    give the same rows.  Null source is a source of its own; null text has size 0
    and follows its hash; rows with the same id are taken together; an empty
    table gives an empty result.  Other columns pass through; an input with one
    of the five added names is refused.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    own_columns(docs, added)
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    d = docs.toDF(*plain.values())
    d = d.withColumn("size", word_count(F.col(plain[text_col]))).withColumn("u", sample_hash(F.col(plain[id_col]), seed)) \
         .withColumnRenamed(plain[source_col], "source")
    slim = cut(d.select("source", "size", "u"))
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = cut(targets(weigh(sizes, weights), max_epochs)
               .withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
               .withColumn("base", F.least(F.floor("ratio"), F.lit(max_epochs)).cast("bigint"))
               .withColumn("budget", F.col("target") - F.col("base") * F.col("source_size")))
    limits = thresholds(slim, plan.filter("budget > 0").select("source", F.col("budget")))
    plan = plan.join(limits.select(F.col("source").alias("ts"), "threshold"), F.col("source").eqNullSafe(F.col("ts")), "left")
    p = cut(plan.select(F.col("source").alias("ps"), "source_size", "target", "base", "threshold"))
    n, held = p.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("ps")), F.lit(0))).first()
    if 64 * n + held <= BROADCAST_BYTES:        # else the exchanges on either side let AQE split a hot source
        p = F.broadcast(p)
    j = d.join(p, F.col("source").eqNullSafe(F.col("ps")))
    copies = F.col("base") + F.when(F.col("u") <= F.col("threshold"), F.lit(1)).otherwise(F.lit(0))
    j = j.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return j.select(*[F.col("source" if c == source_col else p).alias(c) for c, p in plain.items()], *added)
