"""Embedding near-duplicates by product quantisation over inverted lists."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from .common import components, cut

#: Smallest cosine of a link.
THRESHOLD = 0.9
#: Vectors per inverted list that the number of lists aims at, and its bounds.
LIST_ROWS, MIN_LISTS, MAX_LISTS = 256, 8, 4096
#: The fit sees at most so many distinct vectors per list (the smallest hashes).
SAMPLE_PER_LIST = 64
#: Subspaces of the residual codes, and codewords of each.
SUBSPACES, CODEWORDS = 8, 256
#: A list is probed when its border is nearer than PROBE_WIDTH times the standard
#: deviation with which a partner at the threshold lies along one direction.
PROBE_WIDTH = 2.0
#: Probes are widened until they find this share of planted and of measured links.
RECALL = 0.995
#: Vectors that the probes are measured with, pairs taken at once, steps of the widening.
QUERIES, PAIRS, STEPS = 2048, 1 << 16, 512
#: Rows of a block of a list's queries and of its codes.
QUERY_BLOCK, CODE_BLOCK = 4096, 4096
#: Rows of the fit's sample that are compared with all centroids at once.
FIT_BLOCK = 2048


def nearest(x: np.ndarray, c: np.ndarray):
    """Yield (slice of the rows, nearest centroid of each), FIT_BLOCK rows at a time."""
    half = (c ** 2).sum(1) / 2
    for s in range(0, len(x), FIT_BLOCK):
        yield slice(s, s + FIT_BLOCK), np.argmax(x[s:s + FIT_BLOCK] @ c.T - half, axis=1)


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spaced rows; an empty cell keeps its centroid.
    Beside ``x`` it holds FIT_BLOCK x k products and the sums of the cells."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        n, total = np.zeros(k, np.int64), np.zeros_like(c)
        for rows, cell in nearest(x, c):
            order = np.argsort(cell, kind="stable")
            cells, first = np.unique(cell[order], return_index=True)
            total[cells] += np.add.reduceat(x[rows][order], first)
            n += np.bincount(cell, minlength=k)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def fit(sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codewords: int = CODEWORDS) -> dict:
    """Coarse centroids and one codebook per subspace for the residuals of unit vectors."""
    c = kmeans(sample, min(lists, len(sample)))
    rest = sample.copy()
    for rows, cell in nearest(sample, c):
        rest[rows] -= c[cell]
    parts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
    books = [kmeans(rest[:, p], min(codewords, len(sample))) for p in parts]
    return {"centroids": c, "parts": parts, "books": books}


def assign(x: np.ndarray, model: dict, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """List, residual codes, length of what the codes miss, and probed lists (bool) of unit vectors.

    Of lists i (own) and j, the border lies at (d_j^2 - d_i^2) / (2 |c_i - c_j|)
    from x; j is probed when that is ``reach`` or less.
    """
    c = model["centroids"]
    d2 = (x ** 2).sum(1)[:, None] - 2 * x @ c.T + (c ** 2).sum(1)
    own = d2.argmin(1)
    rest = x - c[own]
    codes = np.empty((len(x), len(model["parts"])), np.uint8)
    for s, (p, book) in enumerate(zip(model["parts"], model["books"])):
        codes[:, s] = np.argmax(rest[:, p] @ book.T - (book ** 2).sum(1) / 2, axis=1)
        rest[:, p] -= book[codes[:, s]]
    gap = np.sqrt(np.maximum((c[own] ** 2).sum(1)[:, None] - 2 * c[own] @ c.T + (c ** 2).sum(1), 1e-24))
    probed = (d2 - d2[np.arange(len(x)), own][:, None]) / (2 * gap) <= reach
    probed[np.arange(len(x)), own] = True
    return own, codes, np.linalg.norm(rest, axis=1), probed


def needed(x: np.ndarray, y: np.ndarray, model: dict) -> np.ndarray:
    """Smallest reach with which x or y probes the other's list, row by row."""
    c = model["centroids"]
    half = (c ** 2).sum(1) / 2
    i, j = np.argmax(x @ c.T - half, axis=1), np.argmax(y @ c.T - half, axis=1)
    to = c[i] - c[j]
    gap = np.maximum(np.linalg.norm(to, axis=1), 1e-12)
    middle = half[i] - half[j]
    need = np.minimum((x * to).sum(1) - middle, middle - (y * to).sum(1)) / gap
    return np.where(i == j, 0.0, np.maximum(need, 0.0))


def planted_reach(sample: np.ndarray, model: dict, threshold: float, recall: float = RECALL) -> float:
    """Reach that finds the share ``recall`` of partners at the threshold that lie from
    sampled vectors towards other sampled ones, so in directions in which the data vary."""
    rng = np.random.default_rng(0)
    x, to = sample[rng.integers(0, len(sample), 4 * QUERIES)], sample[rng.integers(0, len(sample), 4 * QUERIES)]
    to = to - (to * x).sum(1, keepdims=True) * x
    n = np.linalg.norm(to, axis=1)
    x, to = x[n > 1e-6], to[n > 1e-6] / n[n > 1e-6, None]
    need = [needed(x[s:s + 2048], threshold * x[s:s + 2048] + np.sqrt(1 - threshold ** 2) * to[s:s + 2048], model) for s in range(0, len(x), 2048)]
    return float(np.quantile(np.concatenate(need), recall, method="higher")) if len(x) else 0.0


def links_of_block(x: np.ndarray, y: np.ndarray, codes: np.ndarray, miss: np.ndarray, at: int, model: dict,
                   same: np.ndarray, threshold: float):
    """Yield (query rows, code rows) that link, a piece of the block at a time.

    The table-lookup value of x . y errs by at most ``miss`` of y (x has length
    1), so what stays below the threshold with that added cannot be a link; the
    others are measured exactly in double precision.
    """
    coarse = x @ model["centroids"][at]
    tables = [x[:, p] @ book.T for p, book in zip(model["parts"], model["books"])]
    for s in range(0, len(x), 256):
        near = coarse[s:s + 256, None] + miss[None, :]
        for t, c in zip(tables, codes.T):
            near += t[s:s + 256][:, c]
        i, j = np.nonzero(near >= threshold - 1e-9)
        if len(i) > near.size // 50:                    # a dense piece: all its products at once
            exact = (x[s:s + 256] @ y.T)[i, j]
        else:
            exact = np.einsum("ij,ij->i", x[s + i], y[j])
        hit = (exact >= threshold) & (same[s + i] != j)
        if hit.any():
            yield s + i[hit], j[hit]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable over the links (a, b) for each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    list_rows: int = LIST_ROWS, max_lists: int = MAX_LISTS, probe_width: float = PROBE_WIDTH) -> DataFrame:
    """(``id_col``, n_links, component_id, kept) of every row of ``vectors``.

    Two vectors link when their cosine, in double precision, is ``threshold`` or
    more.  Equal vectors are one class in the search, weighted by its size.
    Lists and codebooks are fitted on a sample of at most ``max_lists`` *
    SAMPLE_PER_LIST classes; every class is indexed, in its nearest list.  Every
    class queries all lists whose border is near enough that a partner at the
    threshold can lie behind it, and a pair counts if either side finds it.  How
    near that is comes from the data: PROBE_WIDTH standard deviations of an even
    spread at least, then as wide as RECALL of planted partners need, and of all
    true links of QUERIES classes, which are compared with every class; a border
    farther than a partner at the threshold is never probed.  Blocks of a
    list's queries and codes meet in a task each, so a crowded list is split
    into many.  A block gives counts and a spanning forest of its links, never
    the pairs themselves.

    Vectors that are null, empty, zero, or hold null or non-finite components,
    link with nothing, and so do vectors whose dimension is not the most frequent
    one.  ``component_id`` is the smallest id over links; null ids count as
    larger than any (a component of null ids has null and keeps all its rows).
    Rows that repeat id and vector link with each other.  Other columns are not
    read.
    """
    kind = np.float64 if isinstance(vectors.schema[vector_col].dataType.elementType, DoubleType) else np.float32
    d = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    id_field = d.schema["id"]
    dims = d.groupBy(F.size("v").alias("n")).count().filter("n > 0").orderBy(F.col("count").desc(), F.col("n").desc()).first()
    dim = dims["n"] if dims else 0
    schema = StructType([id_field, StructField("key", StringType()), StructField("raw", BinaryType())])

    def prepare(batches):
        for b in batches:
            keys, raws = [], []
            for v in b.column(1):
                x = np.array(v.as_py() or (), np.float64) if v.is_valid else np.zeros(0)     # null components become nan
                raw = None
                if len(x) == dim and dim and np.isfinite(x).all() and x.any():
                    raw = (x + 0.0).astype(kind).tobytes()                                   # -0.0 becomes 0.0
                keys.append(raw and hashlib.md5(raw).hexdigest())
                raws.append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.string()), pa.array(raws, pa.binary())], names=schema.names)
    rows = d.mapInArrow(prepare, schema)
    classes = cut(rows.filter("key is not null").groupBy("key").agg(
        F.min("id").alias("low"), F.count(F.lit(1)).alias("n"), F.any_value("raw").alias("raw")))
    size = classes.count()
    spark = vectors.sparkSession

    def unit(column) -> np.ndarray:
        x = np.frombuffer(b"".join(column), kind).reshape(-1, dim).astype(np.float64)
        return x / np.linalg.norm(x / (big := np.abs(x).max(1, keepdims=True)), axis=1, keepdims=True) / big

    if size:
        lists = int(min(max_lists, max(MIN_LISTS, size // list_rows)))
        sample = classes.orderBy("key").limit(lists * SAMPLE_PER_LIST).select("key", "raw").collect()
        fitted = unit([r["raw"] for r in sample])
        model = fit(fitted, lists)
        shared = spark.sparkContext.broadcast(model)
        asked = spark.sparkContext.broadcast(({r["key"]: i for i, r in enumerate(sample[:QUERIES])}, fitted[:QUERIES]))
        top = float(np.sqrt(max(2 - 2 * threshold, 0.0)))           # no partner's border is farther

        def measure(batches):
            at, x = asked.value
            for b in batches:
                for s in range(0, b.num_rows, 2048):
                    part = b.slice(s, 2048)
                    y, n = unit(part.column(2).to_pylist()), part.column(1).to_numpy()
                    near = y @ x.T >= threshold
                    for row, key in enumerate(part.column(0).to_pylist()):
                        if key in at:
                            near[row, at[key]] = False
                    i, j = np.nonzero(near)
                    total = np.zeros(STEPS + 1)
                    for p in range(0, len(i), PAIRS):
                        need = needed(x[j[p:p + PAIRS]], y[i[p:p + PAIRS]], shared.value)
                        step = np.minimum(np.ceil(need / max(top, 1e-12) * STEPS), STEPS).astype(int)
                        total += np.bincount(step, n[i[p:p + PAIRS]], STEPS + 1)
                    k = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total[k].astype(np.int64))], names=["step", "n"])
        links_at = np.zeros(STEPS + 1)
        for r in classes.select("key", "n", "raw").mapInArrow(measure, "step int, n long").groupBy("step").agg(F.sum("n").alias("n")).collect():
            links_at[r["step"]] = r["n"]
        # the first step with the goal; 0 where no link was met
        measured = top * float(np.argmax(np.cumsum(links_at) >= RECALL * links_at.sum())) / STEPS
        reach = min(top, max(probe_width * top / float(np.sqrt(dim)), planted_reach(fitted, model, threshold), measured)) + 1e-9
        schema2 = StructType([StructField("key", StringType()), StructField("n", LongType()), StructField("raw", BinaryType()),
                              StructField("list", IntegerType()), StructField("codes", BinaryType()), StructField("miss", DoubleType()),
                              StructField("probes", ArrayType(IntegerType()))])

        def index(batches):
            for b in batches:
                for s in range(0, b.num_rows, 2048):
                    part = b.slice(s, 2048)
                    own, codes, miss, probed = assign(unit(part.column(2).to_pylist()), shared.value, reach)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(miss),
                         pa.array([np.flatnonzero(p) for p in probed], pa.list_(pa.int32()))], names=schema2.names)
        indexed = cut(classes.select("key", "n", "raw").mapInArrow(index, schema2))
        # blocks of each list: two numbers a list, so at most max_lists rows
        per = (indexed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CODE_BLOCK).cast("int").alias("code_blocks"))
               .join(indexed.select(F.explode("probes").alias("list")).groupBy("list")
                     .agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("query_blocks")), "list"))
        per = F.broadcast(cut(per))
        codes = (indexed.join(per, "list").withColumn("c", F.pmod(F.xxhash64("key"), "code_blocks").cast("int"))
                 .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
                 .select("list", "q", "c", "key", "n", "raw", "codes", "miss", "probes"))
        queries = (indexed.select(F.col("key").alias("q_key"), F.col("n").alias("q_n"), F.col("raw").alias("q_raw"),
                                  F.col("list").alias("own"), F.explode("probes").alias("list")).join(per, "list")
                   .withColumn("q", F.pmod(F.xxhash64("q_key", "list"), "query_blocks").cast("int"))
                   .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("code_blocks") - 1)))
                   .select(F.col("list").alias("q_list"), F.col("q").alias("q_q"), F.col("c").alias("q_c"), "q_key", "q_n", "q_raw", "own"))
        out_schema = pa.schema([("key", pa.string()), ("other", pa.string()), ("links", pa.int64())])

        def meet(q: pa.Table, c: pa.Table) -> pa.Table:
            if not q.num_rows or not c.num_rows:
                return out_schema.empty_table()
            model, at = shared.value, q.column("q_list")[0].as_py()
            x, y = unit(q.column("q_raw").to_pylist()), unit(c.column("raw").to_pylist())
            qk, ck = q.column("q_key").to_pylist(), c.column("key").to_pylist()
            place = {k: j for j, k in enumerate(ck)}
            same = np.array([place.get(k, -1) for k in qk])
            own, nq, nc = (t.column(n).to_numpy() for t, n in ((q, "own"), (q, "q_n"), (c, "n")))
            codes = np.frombuffer(b"".join(c.column("codes").to_pylist()), np.uint8).reshape(len(ck), -1)
            probes = c.column("probes").to_pylist()
            back = np.zeros((len(ck), len(model["centroids"])), bool)     # lists that the code's vector probes itself
            back[np.repeat(np.arange(len(ck)), [len(p) for p in probes]), np.concatenate(probes)] = True
            found_q, found_c, a, b = np.zeros(len(qk), np.int64), np.zeros(len(ck), np.int64), [], []
            for i, j in links_of_block(x, y, codes, c.column("miss").to_numpy(), at, model, same, threshold):
                found_q += np.bincount(i, nc[j], len(qk)).astype(np.int64)
                alone = ~back[j, own[i]]                                  # only this side finds the pair
                found_c += np.bincount(j[alone], nq[i[alone]], len(ck)).astype(np.int64)
                a.append(i.astype(np.int32))
                b.append(j.astype(np.int32))
            keys = qk + ck
            counts = [(k, None, int(n)) for k, n in zip(keys, np.concatenate([found_q, found_c])) if n]
            if a:
                label = forest(np.concatenate(a), np.concatenate(b) + len(qk), len(keys))
                counts += [(keys[i], keys[label[i]], None) for i in np.flatnonzero(label != np.arange(len(keys)))]
            return pa.table([pa.array(v, t) for v, t in zip(zip(*counts), out_schema.types)], schema=out_schema) if counts else out_schema.empty_table()
        met = cut(queries.groupBy("q_list", "q_q", "q_c").cogroup(codes.groupBy("list", "q", "c"))
                  .applyInArrow(meet, "key string, other string, links long"))
        links = met.filter("links is not null").groupBy("key").agg(F.sum("links").alias("links"))
        roots = components(met.filter("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b")))
        member = (classes.select("key", "low", "n").join(links, "key", "left")
                  .join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")))
        least = member.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component_id"))
        told = cut(member.join(least, F.col("root") == F.col("r"))
                   .select(F.col("key").alias("k"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    else:
        told = spark.createDataFrame([], StructType([StructField("k", StringType()), StructField("n_links", LongType()),
                                                     StructField("component_id", id_field.dataType)]))
    own_key = F.coalesce("key", F.concat(F.lit("alone "), F.xxhash64("id").cast("string")))     # spreads rows that link with nothing
    out = rows.select("id", own_key.alias("key")).join(told, F.col("key") == F.col("k"), "left")
    low = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      low.alias("component_id"), low.eqNullSafe(F.col("id")).alias("kept"))
