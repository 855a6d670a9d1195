"""Line deduplication by content-defined chunks of lines, and by whole passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut, mark_repeated, own_columns, repeated_keys

#: Lines that the rolling hash sees, and the mean number of lines in a chunk.
WINDOW, DIVISOR = 2, 3
#: A line of so many bytes (some 35 words) would fill several printed lines; it is a chunk by itself.
LONG_BYTES = 200
#: Shorter chunks are left alone (closing brackets, bare headings).
MIN_BYTES = 40
#: Words from which a run of whole lines is a passage.
PASSAGE_WORDS = 50
#: Multiplier and modulus of the rolling hash: products stay below 2**62.
BASE, MODULUS = 1_000_003, 2_147_483_647


def hash60(c: Column) -> Column:
    """The first 60 bits of a string's MD5 as a bigint."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")


def _shifted(a: Column) -> Column:
    """The array moved one place on, with null first."""
    return F.concat(F.array(F.lit(None)), F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))))


def _times(power: Column):
    return lambda x: F.coalesce(x, F.lit(0)) * power


def with_chunks(docs: DataFrame, text_col: str, out: str, window: int = WINDOW, divisor: int = DIVISOR,
                long_bytes: int = LONG_BYTES, at: str | None = None) -> DataFrame:
    """Add ``out``: the text's chunks; joined by newlines they give the text back.
    ``at`` names an array to add with the number of each chunk's first line.

    A chunk ends behind line j when a polynomial rolling hash over the hashes of
    lines j-window+1..j is divisible by ``divisor``, so a boundary depends on
    those lines alone and lines inserted elsewhere do not move it.  A line of
    ``long_bytes`` or more bytes is a chunk by itself.
    """
    d = docs.withColumn(f"{out}_l", F.split(F.col(text_col), "\n", -1))
    lines = F.col(f"{out}_l")
    d = d.withColumn(f"{out}_h", F.transform(lines, lambda x: F.struct(
        (hash60(x) % MODULUS).alias("h"), (F.octet_length(x) >= long_bytes).alias("long"))))
    d = d.withColumn(f"{out}_p", _shifted(F.col(f"{out}_h")))
    # rolling hash of the window that ends at each line; shorter at the text's start
    rolled, back = F.col(f"{out}_h.h"), F.col(f"{out}_h.h")
    for k in range(1, window):
        back, power = _shifted(back), F.lit(pow(BASE, k, MODULUS))
        rolled = F.zip_with(rolled, F.transform(back, _times(power)), lambda r, b: (r + b) % MODULUS)
    d = d.withColumn(f"{out}_r", _shifted(rolled))
    # flag every line with B (begins a chunk) or C (continues); lines hold no newline, so "\nB" only stands at cuts
    flagged = F.transform(
        F.arrays_zip(lines.alias("x"), F.col(f"{out}_h").alias("a"), F.col(f"{out}_p").alias("p"), F.col(f"{out}_r").alias("r")),
        lambda z: F.concat(F.when(z["p"].isNull() | z["a"]["long"] | z["p"]["long"] | (z["r"] % divisor == 0), F.lit("B"))
                           .otherwise(F.lit("C")), z["x"]))
    if at is not None:
        d = d.withColumn(f"{out}_f", flagged)
        flagged = F.col(f"{out}_f")
        d = d.withColumn(at, F.filter(F.transform(flagged, lambda x, i: F.when(x.startswith("B"), i)), lambda i: i.isNotNull()))
    marked = F.substr(F.array_join(flagged, "\n"), F.lit(2))
    chunks = F.transform(F.split(marked, "\nB", -1), lambda c: F.replace(c, F.lit("\nC"), F.lit("\n")))
    return d.withColumn(out, chunks).drop(f"{out}_l", f"{out}_h", f"{out}_p", f"{out}_r", f"{out}_f")


def eligible(chunk: Column, long_bytes: int = LONG_BYTES, min_bytes: int = MIN_BYTES) -> Column:
    """Chunks that may be removed: several lines, or one line that is long by itself."""
    n = F.octet_length(chunk)
    return (n >= min_bytes) & ((n >= long_bytes) | chunk.contains("\n"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
               divisor: int = DIVISOR, long_bytes: int = LONG_BYTES, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with every globally repeated chunk removed from ``text`` but at
    its first place, plus ``n_chunks`` and ``n_removed`` (bigint).

    First place: smallest id (null ids last), then the text's hash, then the
    position.  Chunk hashes of the whole corpus are counted, a fixed-size filter
    lets through the chunks that may repeat, and only these travel with their
    bytes: they are grouped by hash and text, so equality is byte equality.
    A hot chunk is one aggregate row; its places are joined to it, which AQE can
    split.  What is removed is gathered per document, so is bounded by its lines.

    Null texts stay null and empty texts empty (0 chunks).  Rows that repeat
    both id and text are one document: they keep or lose the same chunks.  Other
    columns pass through; an input with one of the two added names is refused.
    """
    own_columns(docs, ["n_chunks", "n_removed"])
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}       # inputs may bring any names
    d = docs.toDF(*plain.values())
    did, text = plain[id_col], plain[text_col]
    d = with_chunks(d, text, "chunks", window, divisor, long_bytes).withColumn("th", F.xxhash64(text)).withColumn("empty", F.col(text) == "")
    # outer: else Catalyst infers a filter on the array and computes it several times per row
    at = (d.select(F.col(did).alias("id"), "th", F.posexplode_outer("chunks").alias("pos", "chunk"))
          .filter(eligible(F.col("chunk"), long_bytes, min_bytes)).withColumn("h", hash60(F.col("chunk"))))
    repeated = repeated_keys(at.select(F.col("h").alias("k")))
    some = cut(mark_repeated(at, F.col("h"), repeated, "again").filter("again").drop("again"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "pos")
    first = cut(some.groupBy("h", "chunk").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                .select(F.col("h").alias("fh"), F.col("chunk").alias("fc"), "first"))
    gone = (some.join(first, (F.col("h") == F.col("fh")) & (F.col("chunk") == F.col("fc")))
            .filter(~place.eqNullSafe(F.col("first")))
            .groupBy(F.col("id").alias("gid"), F.col("th").alias("gth")).agg(F.collect_set("pos").alias("gone")))
    kept = (d.drop(text).join(gone, F.col(did).eqNullSafe(F.col("gid")) & (F.col("th") == F.col("gth")), "left"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    new = F.when(F.col("gone").isNull(), F.array_join("chunks", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("chunks"), i)), "\n"))
    kept = kept.select("*", new.alias("new"), F.when(F.col("chunks").isNull() | F.col("empty"), F.lit(0)).otherwise(F.size("chunks")).cast("bigint").alias("n_chunks"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))
    return kept.select(*[(F.col("new") if c == text_col else F.col(p)).alias(c) for c, p in plain.items()],
                       "n_chunks", "n_removed")


# --- passages ----------------------------------------------------------------

def _windows(keyed: DataFrame, words: int) -> DataFrame:
    """Windows (id, th, lo, hi, k) of the lines that may repeat: from every line
    on, and up to every line, the fewest lines that reach ``words`` words.

    Blank lines are passed over.  A line that surely stands once breaks a run, so
    only lines that the fixed-size filter lets through are dealt by document;
    what a window sees is bounded by ``words`` lines.
    """
    texts = F.filter(F.transform(F.split("x", "\n", -1), lambda x, i: F.struct(i.alias("pos"), x.alias("x"))),
                     lambda z: z["x"].rlike(f"[^{SPACE}]"))
    lines = (keyed.select("id", "th", F.posexplode_outer(texts).alias("ix", "z")).filter("z is not null")
             .select("id", "th", "ix", F.col("z.pos").alias("pos"), F.col("z.x").alias("x"), F.md5("z.x").alias("m")))
    h = F.conv(F.substring("m", 1, 15), 16, 10).cast("bigint")
    again = mark_repeated(lines, h, repeated_keys(lines.select(h.alias("k"))), "again").filter("again")
    doc = Window.partitionBy("id", "th").orderBy("ix")
    rows = (again.select("id", "th", "ix", "pos", "m", F.regexp_count("x", F.lit(f"[^{SPACE}]+")).cast("bigint").alias("w"))
            .repartition("id", "th").dropDuplicates(["id", "th", "ix"])
            # a gap counts as ``words`` words, so no window reaches over it
            .withColumn("upto", F.sum("w").over(doc) + (F.col("ix") - F.row_number().over(doc)) * words)
            .withColumn("since", F.col("upto") - F.col("w")))
    on = Window.partitionBy("id", "th").orderBy("since").rangeBetween(0, words - 1)
    back = Window.partitionBy("id", "th").orderBy("upto").rangeBetween(1 - words, 0)
    rows = rows.select("id", "th", "pos", F.collect_list("m").over(on).alias("m1"), F.sum("w").over(on).alias("w1"), F.max("pos").over(on).alias("hi"),
                       F.collect_list("m").over(back).alias("m2"), F.sum("w").over(back).alias("w2"), F.min("pos").over(back).alias("lo"))

    def one(lo: str, hi: str, m: str, w: str) -> Column:
        return F.when(F.col(w) >= words, F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi"),
                                                  F.concat(F.lit("w"), F.md5(F.array_join(m, ""))).alias("k")))
    both = F.array_compact(F.array(one("pos", "hi", "m1", "w1"), one("lo", "pos", "m2", "w2")))
    return rows.select("id", "th", F.explode_outer(both).alias("z")).filter("z is not null").select("id", "th", "z.*")


def passage_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` with every globally repeated passage removed from ``text`` but at
    its first place, plus ``n_lines`` and ``n_removed`` (lines, bigint).

    A passage is a run of whole lines of ``words`` or more words, whatever the
    length of its lines (blank lines between them do not count), a chunk that
    ``line_dedup`` may remove, or a whole text of MIN_BYTES or more bytes, so
    a later exact copy becomes empty.  Every line of a repeated run lies in the
    window that starts at it or in the one that ends the run, and every window
    that repeats is a repeated run: the windows of ``_windows`` are an exact
    index.  A run that overlaps its own first place keeps the lines of that
    place.  Whatever goes stands at an earlier place, so every line of the corpus
    stays somewhere.

    First places, rows that repeat id and text, nulls, and other columns are as
    in ``line_dedup``.  Chunks are compared by bytes, windows and whole texts by
    the MD5 of their lines.
    """
    own_columns(docs, ["n_lines", "n_removed"])
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}       # inputs may bring any names
    d = docs.toDF(*plain.values())
    did, text = plain[id_col], plain[text_col]
    keyed = d.select(F.col(did).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("x"))
    c = with_chunks(keyed, "x", "chunks", at="at")
    pieces = F.transform(F.arrays_zip("chunks", "at"), lambda z: F.struct(
        z["at"].alias("lo"), (z["at"] + F.size(F.split(z["chunks"], "\n", -1)) - 1).alias("hi"), z["chunks"].alias("k")))
    # the keys of texts and windows have 33 bytes, so are no eligible chunk
    whole = F.when(F.octet_length("x") >= MIN_BYTES, F.array(F.struct(
        F.lit(0).alias("lo"), (F.size(F.split("x", "\n", -1)) - 1).alias("hi"), F.concat(F.lit("t"), F.md5("x")).alias("k"))))
    # outer: else Catalyst infers a filter on the array and computes it several times per row
    at = (c.select("id", "th", F.explode_outer(F.concat(F.filter(pieces, lambda z: eligible(z["k"])), whole)).alias("z"))
          .filter("z is not null").select("id", "th", "z.*").withColumn("h", hash60(F.col("k"))))
    chunks = mark_repeated(at, F.col("h"), repeated_keys(at.select(F.col("h").alias("k"))), "again").filter("again").drop("again")
    some = cut(chunks.unionByName(_windows(keyed, words).withColumn("h", hash60(F.col("k")))))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "lo", "hi")
    first = cut(some.groupBy("h", "k").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .filter(~F.col("first").eqNullSafe(F.col("last"))).select(F.col("h").alias("fh"), F.col("k").alias("fk"), "first"))
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th"))
    gone = (some.join(first, (F.col("h") == F.col("fh")) & (F.col("k") == F.col("fk")))
            .filter(~place.eqNullSafe(F.col("first")))
            .select("id", "th", F.when(same, F.greatest("lo", F.col("first.hi") + 1)).otherwise(F.col("lo")).alias("lo"), "hi").filter("lo <= hi")
            .select(F.col("id").alias("gid"), F.col("th").alias("gth"), F.explode(F.sequence("lo", "hi")).alias("line"))
            .groupBy("gid", "gth").agg(F.collect_set("line").alias("gone")))
    d = d.withColumn("th", F.xxhash64(text)).withColumn("bare", F.col(text) == "").withColumn("ls", F.split(text, "\n", -1)).drop(text)
    kept = d.join(gone, F.col(did).eqNullSafe(F.col("gid")) & (F.col("th") == F.col("gth")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("ls") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    new = F.when(F.col("gone").isNull(), F.array_join("ls", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("ls"), i)), "\n"))
    kept = kept.select("*", new.alias("new"), F.when(F.col("ls").isNull() | F.col("bare"), F.lit(0)).otherwise(F.size("ls")).cast("bigint").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))
    return kept.select(*[(F.col("new") if c == text_col else F.col(p)).alias(c) for c, p in plain.items()], "n_lines", "n_removed")
