"""Approximate nearest neighbours by robust-pruned directed graphs, one a shard."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StringType, StructField, StructType

from .common import cut

#: Distinct vectors a shard aims at; one task builds and holds a shard's graph.
SHARD_ROWS = 8192
#: Edges that a node keeps, nodes that a search keeps in view (building, asking), and the relaxation of the pruning.
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 128, 1.2
#: Nodes or queries that a search advances together, and queries that meet a shard in one task.
TOGETHER, QUERY_BLOCK = 512, 8192


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of each x (rows) to its own row of vectors y (rows, many, dim)."""
    d = y - x[:, None, :]
    return np.einsum("bcd,bcd->bc", d, d)


class Graph:
    """Directed graph over the vectors of one shard.

    ``edges`` has places for half as many edges again as a node keeps (-1: none), so
    that edges back are not pruned one by one.  Searches start at ``entry``, the
    vector nearest to the mean.
    """

    def __init__(self, x: np.ndarray, degree: int = DEGREE, edges: np.ndarray | None = None):
        self.x, self.degree = x, degree
        self.edges = np.full((len(x), degree + degree // 2), -1, np.int32) if edges is None else edges
        self.entry = int(((x - x.mean(0)) ** 2).sum(1).argmin())

    def search(self, queries: np.ndarray, beam: int, trail: bool = False) -> tuple[np.ndarray, ...]:
        """The ``beam`` nearest nodes met by greedy searches, nearest first, and their
        squared distances (-1 and inf fill up).  All queries advance together: each
        takes the nearest node in view that it has not been at and looks at that
        node's edges, until it has been at all in view.  With ``trail`` also the
        nodes that each was at, in order (-1 fills up).
        """
        n, q = len(self.x), len(queries)
        seen = np.zeros((q, n), bool)
        node = np.full((q, beam), -1, np.int64)
        near = np.full((q, beam), np.inf)
        done = np.ones((q, beam), bool)
        node[:, 0], done[:, 0] = self.entry, False
        near[:, 0] = ((queries - self.x[self.entry]) ** 2).sum(1)
        seen[:, self.entry] = True
        path, alive = [], np.arange(q)
        while len(alive):
            at = np.argmax(~done[alive], axis=1)                    # sorted, so the nearest
            here = node[alive, at]
            done[alive, at] = True
            if trail:
                step = np.full(q, -1, np.int64)
                step[alive] = here
                path.append(step)
            next_ = self.edges[here].astype(np.int64)
            new = (next_ >= 0) & ~seen[alive[:, None], next_]
            rows, places = np.nonzero(new)
            seen[alive[rows], next_[rows, places]] = True
            gap = np.full(next_.shape, np.inf)
            diff = self.x[next_[rows, places]] - queries[alive[rows]]
            gap[rows, places] = np.einsum("ij,ij->i", diff, diff)
            far = np.concatenate([near[alive], gap], axis=1)
            order = np.argsort(far, axis=1, kind="stable")[:, :beam]
            near[alive] = np.take_along_axis(far, order, 1)
            node[alive] = np.take_along_axis(np.concatenate([node[alive], np.where(new, next_, -1)], axis=1), order, 1)
            done[alive] = np.take_along_axis(np.concatenate([done[alive], ~new], axis=1), order, 1)
            alive = alive[~done[alive].all(1)]
        node[np.isinf(near)] = -1
        return (node, near, np.stack(path, 1)) if trail else (node, near)

    def prune(self, p: np.ndarray, around: np.ndarray, alpha: float) -> np.ndarray:
        """Edges of the nodes p out of candidates ``around`` (-1: none; no row has one twice).

        The nearest candidate stays, and every other that is more than ``alpha``
        times as near to it as to the node goes; then the next nearest that is
        left.  So the edges that stay lead in different directions.
        """
        far = squares(self.x[p], self.x[around])
        far[(around < 0) | (around == p[:, None])] = np.inf
        order = np.argsort(far, axis=1, kind="stable")[:, :np.isfinite(far).sum(1).max(initial=1)]
        around, far = np.take_along_axis(around, order, 1), np.take_along_axis(far, order, 1)
        y, left, row = self.x[around], np.isfinite(far), np.arange(len(p))
        long = np.einsum("bcd,bcd->bc", y, y)
        edges = np.full((len(p), self.edges.shape[1]), -1, np.int32)
        for k in range(self.degree):
            some = left.any(1)
            if not some.any():
                break
            at = np.argmax(left, axis=1)
            edges[some, k] = around[row, at][some]
            apart = long + long[row, at][:, None] - 2 * np.matmul(y, y[row, at][:, :, None])[:, :, 0]
            left &= alpha ** 2 * apart > far
            left[row, at] = False
        return edges

    def insert(self, p: np.ndarray, beam: int, alpha: float) -> None:
        """Edges of the nodes p out of what a search for each went by, and edges back;
        a node that has no place left is pruned."""
        node, _, trail = self.search(self.x[p], beam, trail=True)
        around = np.concatenate([node, trail, self.edges[p]], axis=1).astype(np.int64)
        around.sort(axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
        self.edges[p] = self.prune(p, around, alpha)
        of, place = np.nonzero(self.edges[p] >= 0)
        to, back = self.edges[p][of, place].astype(np.int64), p[of]
        known = (self.edges[to] == back[:, None]).any(1)
        to, back = to[~known], back[~known]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        nodes, first, many = np.unique(to, return_index=True, return_counts=True)
        by_size = np.argsort(many, kind="stable")                    # nodes of like numbers of new edges together
        for s in range(0, len(nodes), TOGETHER):
            some = by_size[s:s + TOGETHER]
            new = np.full((len(some), many[some].max()), -1, np.int64)
            row = np.repeat(np.arange(len(some)), many[some])
            col = np.arange(len(row)) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
            new[row, col] = back[np.repeat(first[some], many[some]) + col]
            around = np.concatenate([self.edges[nodes[some]].astype(np.int64), new], axis=1)
            fits = (around >= 0).sum(1) <= self.edges.shape[1]
            packed = np.take_along_axis(around, np.argsort(around < 0, axis=1, kind="stable"), 1)[:, :self.edges.shape[1]]
            self.edges[nodes[some][fits]] = packed[fits]
            self.prune_to(nodes[some][~fits], around[~fits], alpha)

    def prune_to(self, p: np.ndarray, around: np.ndarray, alpha: float) -> None:
        step = max(1, (1 << 22) // (around.shape[1] * self.x.shape[1]))         # bounds what is held at once
        for s in range(0, len(p), step):
            self.edges[p[s:s + step]] = self.prune(p[s:s + step], around[s:s + step], alpha)

    def build(self, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> Graph:
        """Insert all nodes twice, in growing batches: with plain pruning, then with the relaxed one."""
        order = np.random.default_rng(0).permutation(len(self.x))
        for relax in (1.0, alpha):
            s, size = 0, 1 if relax == 1.0 else TOGETHER
            while s < len(order):
                self.insert(order[s:s + size], beam, relax)
                s += size
                size = min(TOGETHER, max(1, s))
        over = np.flatnonzero((self.edges >= 0).sum(1) > self.degree)
        self.prune_to(over, self.edges[over].astype(np.int64), alpha)
        self.edges = np.take_along_axis(self.edges, np.argsort(self.edges < 0, axis=1, kind="stable"), 1)[:, :self.degree]
        return self


def unpack(raws, kind, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), kind).reshape(-1, dim).astype(np.float64)


def build_graphs(classes: DataFrame, kind, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> DataFrame:
    """Graphs over distinct vectors (key, low, dim, raw): rows with ``shard``, ``place``
    (in the shard) and ``edges`` (places) beside them.

    A dimension's vectors are dealt to shards by a hash of the key; the number
    of shards follows their number, so a shard has about ``shard_rows`` vectors
    at any size and is one task's work.
    """
    shards = F.greatest(F.lit(1), F.ceil(F.col("n") / shard_rows))
    per = classes.groupBy(F.col("dim").alias("d")).agg(F.count(F.lit(1)).alias("n")).select("d", shards.cast("int").alias("shards"))
    # joined without a hint: one row a dimension as a rule
    dealt = classes.join(per, F.col("dim") == F.col("d")).select(
        "key", "low", "dim", "raw", F.pmod(F.xxhash64("key", F.lit(11)), "shards").cast("int").alias("shard"))

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        x = unpack(t.column("raw").to_pylist(), kind, t.column("dim")[0].as_py())
        edges = Graph(x, degree).build(beam, alpha).edges
        return pa.table([*t.columns, pa.array(range(len(x)), pa.int32()), pa.array([e.tobytes() for e in edges], pa.binary())],
                        names=[*t.column_names, "place", "edges"])
    schema = StructType([*dealt.schema.fields, StructField("place", IntegerType()), StructField("edges", BinaryType())])
    # dealt by number: shards are few bytes but much work, so AQE is not to join their partitions
    tasks = max(1, per.agg(F.sum("shards")).first()[0] or 0)
    return dealt.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInArrow(build, schema)


def search_graphs(graphs: DataFrame, asked: DataFrame, kind, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """(q_key, key, low, near): for each asked class (q_key, q_dim, q_raw) the ``k`` nearest
    classes found in each shard of its dimension, by distance, then ``low``.

    Every shard is searched for every query, a block of queries and a shard in a
    task.  Each shard's rows go to as many tasks as there are blocks.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / QUERY_BLOCK)).cast("int")
    per = asked.groupBy(F.col("q_dim").alias("d")).agg(F.count(F.lit(1)).alias("n")).select("d", blocks.alias("blocks"))
    shards = graphs.groupBy(F.col("dim").alias("d")).agg((F.max("shard") + 1).alias("shards"))
    kept = (graphs.join(per, F.col("dim") == F.col("d")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("dim", "shard", "block", "place", "key", "low", "raw", "edges"))
    put = (asked.join(per.join(shards, "d"), F.col("q_dim") == F.col("d"))
           .withColumn("q_block", F.pmod(F.xxhash64("q_key"), "blocks").cast("int"))
           .withColumn("q_shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
           .select("q_dim", "q_shard", "q_block", "q_key", "q_raw"))
    schema = StructType([StructField("q_key", StringType()), kept.schema["key"], kept.schema["low"], StructField("near", DoubleType())])

    def meet(q: pa.Table, g: pa.Table) -> pa.Table:
        if not q.num_rows or not g.num_rows:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.int64(), pa.float64())], names=schema.names)
        g = g.sort_by("place")
        dim = g.column("dim")[0].as_py()
        x = unpack(g.column("raw").to_pylist(), kind, dim)
        edges = np.frombuffer(b"".join(g.column("edges").to_pylist()), np.int32).reshape(len(x), -1)
        graph, lows = Graph(x, edges.shape[1], edges), g.column("low").to_numpy()
        queries, found = unpack(q.column("q_raw").to_pylist(), kind, dim), []
        for s in range(0, len(queries), TOGETHER):
            node, _ = graph.search(queries[s:s + TOGETHER], max(beam, k))
            for i, row in enumerate(node, s):
                row = row[row >= 0]
                d = np.sqrt(((x[row] - queries[i]) ** 2).sum(1))
                best = np.lexsort((lows[row], d))[:k]
                found += zip([i] * len(best), row[best].tolist(), d[best].tolist())
        i, r, d = zip(*found)
        return pa.table([q.column("q_key").take(pa.array(i)), g.column("key").take(pa.array(r)), g.column("low").take(pa.array(r)), pa.array(d, pa.float64())],
                        names=schema.names)
    tasks = max(1, per.join(shards, "d").agg(F.sum(F.col("blocks") * F.col("shards"))).first()[0] or 0)
    put, kept = put.repartition(tasks, "q_dim", "q_shard", "q_block"), kept.repartition(tasks, "dim", "shard", "block")
    return put.groupBy("q_dim", "q_shard", "q_block").cogroup(kept.groupBy("dim", "shard", "block")).applyInArrow(meet, schema)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, degree: int = DEGREE, build_beam: int = BUILD_BEAM, beam: int = SEARCH_BEAM, alpha: float = ALPHA) -> DataFrame:
    """(query_id, rank, ``id_col``, score): for each row of ``queries`` the ``k`` nearest
    rows found among ``vectors`` that have another id, by Euclidean distance in
    double precision, then by id.

    Equal vectors are one node, so copies crowd nothing out; a node brings its
    k + 1 smallest ids.  All nodes are indexed.  Fewer rows come back only where
    there are fewer candidates of the query's dimension.

    Vectors that are null, empty, zero, or hold null or non-finite components
    take no part, on either side, and rows without an id neither; vectors of
    different dimensions are no candidates of each other.  Rows that repeat id and
    vector count once; one id with several vectors is several candidates and, as
    a query, takes the nearest over all its vectors.  Other columns are not read.
    """
    kind = np.float64 if isinstance(vectors.schema[vector_col].dataType.elementType, DoubleType) else np.float32

    def keyed(df: DataFrame) -> DataFrame:
        d = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v"))

        def prepare(batches):
            for b in batches:
                keys, dims, raws = [], [], []
                for i, v in zip(b.column(0), b.column(1)):
                    x = np.array(v.as_py() or (), np.float64) if v.is_valid and i.is_valid else np.zeros(0)     # null components become nan
                    good = len(x) > 0 and np.isfinite(x).all() and x.any()
                    raws.append((x + 0.0).astype(kind).tobytes() if good else None)                              # -0.0 becomes 0.0
                    dims.append(len(x))
                    keys.append(hashlib.md5(raws[-1]).hexdigest() if good else None)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.string()), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())],
                                                 names=["id", "key", "dim", "raw"])
        return d.mapInArrow(prepare, "id long, key string, dim int, raw binary").filter("key is not null")
    rows, asked = cut(keyed(vectors)), cut(keyed(queries))
    classes = cut(rows.groupBy("key").agg(F.min("id").alias("low"), F.any_value("dim").alias("dim"), F.any_value("raw").alias("raw")))
    graphs = cut(build_graphs(classes, kind, shard_rows, degree, build_beam, alpha))
    sought = asked.groupBy(F.col("key").alias("q_key")).agg(F.any_value("dim").alias("q_dim"), F.any_value("raw").alias("q_raw"))
    # of equal distance the class with the smallest id comes first: k + 1 classes hold the k nearest rows of other ids
    met = cut(search_graphs(graphs, sought, kind, k + 1, beam)
              .withColumn("at", F.row_number().over(Window.partitionBy("q_key").orderBy("near", "low"))).filter(F.col("at") <= k + 1).drop("at"))
    # the k + 1 smallest ids of each class, in two steps so that a large class is dealt to many tasks
    salted = Window.partitionBy("key", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    members = rows.select("key", "id").distinct().withColumn("at", F.row_number().over(salted)).filter(F.col("at") <= k + 1)
    members = (members.withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy("id"))).filter(F.col("at") <= k + 1)
               .select(F.col("key").alias("m_key"), F.col("id").alias("m_id")))
    listed = (met.join(members, F.col("key") == F.col("m_key"))
              .withColumn("at", F.row_number().over(Window.partitionBy("q_key").orderBy("near", "m_id"))).filter(F.col("at") <= k + 1)
              .groupBy("q_key").agg(F.sort_array(F.collect_list(F.struct("near", "m_id"))).alias("found")))
    # cut, so that the join's small side has an exchange of its own and a class with many queries is split
    listed = cut(listed)
    own = asked.select("id", "key").distinct().join(listed, F.col("key") == F.col("q_key"))
    told = own.select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter("found", lambda z: z["m_id"] != F.col("id")), 1, k)).alias("pos", "z"))
    several = Window.partitionBy("query_id")
    told = (told.select("query_id", F.col("z.m_id").alias("m"), F.col("z.near").alias("score"))
            .groupBy("query_id", "m").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(several.orderBy("score", "m"))).filter(F.col("rank") <= k))
    return told.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("m").alias(id_col), "score")
