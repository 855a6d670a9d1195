"""Helpers that the corpus operators share: table reads, lineage cuts, a
fixed-size filter of repeated keys, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlens.session import ensure_checkpoint_dir

#: White space that separates words, as a Java and Python character class.
SPACE = r"\x20\x09-\x0D"

#: Positions of the repeated-key filter: 2**26 bits, so 8 MB at any input size.
FILTER_BITS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the folder named by ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def own_columns(df: DataFrame, names: list[str]) -> None:
    """Raise when ``df`` already has a column that an operator is to add."""
    taken = sorted(set(n.lower() for n in names) & set(c.lower() for c in df.columns))
    if taken:
        raise ValueError(f"input has columns that the operator adds: {taken}")


def scratch(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (inputs may bring any names)."""
    taken, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name.lower() in taken:
        name = "_" + name
    return name


# --- repeated keys -----------------------------------------------------------

def repeated_keys(keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Bitmap rows (bucket, bitmap) of the bigint keys that occur twice or more.

    ``keys`` has one column ``k``.  Keys are counted in full (partial counts
    before the shuffle); each repeated key then sets one of ``bits`` positions.
    The result has at most ``bits / 32768`` rows of 4 KB, whatever the input, so
    broadcasting it is safe.  A position may also be set by another key: callers
    use the filter to skip work for keys that are surely unique and decide
    exactly afterwards.
    """
    position = F.pmod(F.xxhash64("k"), F.lit(bits))
    twice = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(position.alias("p"))
    return cut(twice.groupBy(F.expr("bitmap_bucket_number(p)").alias("_bucket"))
               .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("_bitmap")))


def mark_repeated(df: DataFrame, key: Column, bitmaps: DataFrame, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """Add boolean ``flag``: true for every row whose bigint key is repeated
    (and for the few unique keys that share a position), never null."""
    p = F.pmod(F.xxhash64(key), F.lit(bits))
    pos = scratch(df, "pos")
    d = df.withColumn(pos, p)
    bucket, bit = F.expr(f"bitmap_bucket_number({pos})"), F.expr(f"bitmap_bit_position({pos})")
    j = d.join(F.broadcast(bitmaps), bucket == F.col("_bucket"), "left")
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    # shiftright takes a constant only, so divide by the bit's power of two
    on = F.floor(byte / F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), (bit % 8 + 1).cast("int"))) % 2
    return j.withColumn(flag, F.coalesce(on == 1, F.lit(False))).drop("_bucket", "_bitmap", pos)


# --- connected components ----------------------------------------------------

def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components of the undirected links (a, b): rows (node, root)
    with root the smallest node of the component; only linked nodes appear.

    Alternates the large-star and small-star steps: every node hangs its
    neighbours under the smallest one it knows, until each component is a star.
    A step is a ``min`` per node and a join, so a hub's neighbours are never
    gathered, and the links never grow in number.  Each round is checkpointed;
    the driver sees two sums per round.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .filter("u <> v").distinct())
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = (both.join(low, both.u == low.w).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        hung = large.join(low, large.u == low.w)
        e = cut(hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(low.select(F.col("w").alias("u"), F.col("m").alias("v")))
                .filter("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
