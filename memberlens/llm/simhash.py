"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import components, cut, own_columns

#: Words in a shingle, seed of XXH64, and the largest number of differing bits.
SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Segments of the 64-bit fingerprint that are indexed.
SEGMENTS = 2
#: Shingles hashed at a time, so a very long text needs bounded memory.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash as a signed integer: bit i is set when it is set in over
    half of the shingles' XXH64 (repeats included).

    Only A-Z are lower-cased and only space and \\x09-\\x0D separate words, which
    is what ``bytes.lower`` and ``bytes.split`` do.  A text of fewer words is one
    shingle; no words (or null) give 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, grams, repeat(seed))), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(h, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text_col: str, out: str, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Add the bigint column ``out``; the other columns pass through in Arrow batches."""
    schema = StructType([*docs.schema.fields, StructField(out, LongType())])
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            fp = pa.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, fp], names=[*b.schema.names, out])
    return docs.mapInArrow(run, schema)


def segment_radii(max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> list[int]:
    """Radius of the Hamming ball to search in each segment (-1: none needed).

    Radii that sum to ``max_bits - segments + 1`` lose nothing: were the
    distance in every segment above its radius, the whole distance would be at
    least the sum of (radius + 1), which is ``max_bits + 1``.
    """
    total, radii = max_bits - segments + 1, [0] * segments
    if total < 0:
        return [0] * (max_bits + 1) + [-1] * (segments - max_bits - 1)
    for i in range(total):
        radii[i % segments] += 1
    return radii


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with ``radius`` or fewer set."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column ``fp``) that differ
    in ``max_bits`` or fewer bits.

    One table per segment, keyed by the segment's value.  Every fingerprint
    probes it with the segment values of a small Hamming ball; what it meets is
    checked at its full distance in the join condition, so only links leave it.
    Fingerprints are distinct, so copies cost nothing, and a key gathers only
    fingerprints that agree in a whole segment.
    """
    if not 0 <= max_bits < 64:
        raise ValueError("max_bits must be 0 to 63")
    width, out = 64 // segments, None
    for i, radius in enumerate(segment_radii(max_bits, segments)):
        if radius < 0:
            continue
        w = width if i < segments - 1 else 64 - width * (segments - 1)
        value = F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << w) - 1 if w < 64 else -1))
        index = fps.select(F.col("fp").alias("a"), value.alias("key"))
        probes = fps.select(F.col("fp").alias("b"), value.alias("v"))
        if radius:
            masks = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("bigint") for m in ball(w, radius)])
            probes = probes.select("b", F.explode(F.transform(masks, lambda m: F.col("v").bitwiseXOR(m))).alias("probe"))
        else:
            probes = probes.withColumnRenamed("v", "probe")
        far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
        hits = index.join(probes, (F.col("key") == F.col("probe")) & (F.col("a") < F.col("b")) & (far <= max_bits)).select("a", "b")
        out = hits if out is None else out.union(hits)
    return out.distinct()


def hex16(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  max_bits: int = MAX_BITS, segments: int = SEGMENTS, seed: int = SEED) -> DataFrame:
    """All rows of ``docs`` plus ``fingerprint`` (16 hex digits), ``component_id``
    and ``kept``.

    Documents link when their fingerprints differ in ``max_bits`` or fewer bits;
    ``component_id`` is the smallest id reachable over links, the own included,
    and the row with that id is kept.  Equal fingerprints collapse to one node
    first, so a group of copies of any size is one row in the search.

    Null and empty texts have fingerprint zero and link like any other.  Null
    ids count as larger than any id (a component of null ids alone has a null
    ``component_id`` and keeps all its rows); rows that repeat an id are kept or
    dropped together.  Other columns pass through; an input with one of the
    three added names is refused.
    """
    own_columns(docs, ["fingerprint", "component_id", "kept"])
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}       # inputs may bring any names
    d = docs.toDF(*names.values())
    did, text = names[id_col], names[text_col]
    prints = cut(with_fingerprint(d.select(did, text), text, "fp", shingle, seed)
                 .groupBy("fp").agg(F.min(did).alias("id")))
    roots = components(near_pairs(prints.select("fp"), max_bits, segments))
    member = prints.join(roots, prints.fp == roots.node, "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("id").alias("least")).withColumnRenamed("root", "r")
    label = cut(member.join(least, member.root == F.col("r")).select(F.col("fp").alias("lfp"), "least"))
    out = with_fingerprint(d, text, "fp", shingle, seed).join(label, F.col("fp") == F.col("lfp"))
    return out.select(*[F.col(p).alias(c) for c, p in names.items()], hex16(F.col("fp")).alias("fingerprint"),
                      F.col("least").alias("component_id"), F.col("least").eqNullSafe(F.col(did)).alias("kept"))
