"""Nearest neighbours over pruned graphs: recall against brute force, copies, odd rows."""

import math

import numpy as np
import pytest

from memberlens.llm import queries as Q
from memberlens.llm.graph import Graph, nearest


def brute(rows, asked, k):
    """The k nearest rows of other ids by a plain loop."""
    good = lambda v: bool(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)
    rows = {(i, tuple(v)) for i, v in rows if i is not None and good(v)}
    out = {}
    for i, v in {(i, tuple(v)) for i, v in asked if i is not None and good(v)}:
        near = out.setdefault(i, {})
        for j, w in rows:
            if j != i and len(w) == len(v):
                d = math.dist(v, w)
                near[j] = min(d, near.get(j, d))
    return {i: sorted((d, j) for j, d in near.items())[:k] for i, near in out.items()}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    for rows in out.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    return {q: [(s, v) for _, s, v in rows] for q, rows in out.items()}


def recall(got, want):
    return np.mean([len({v for _, v in got[q]} & {v for _, v in want[q]}) / len(want[q]) for q in want])


@pytest.mark.parametrize("sf, least", [("sf0.001", 1.0), ("sf0.1", 0.99)])
def test_query_against_brute_force(spark, sf, least):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    df = Q.op11_graph_ann(spark, f"/root/testdata/{sf}")
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    got = found(df)
    assert set(got) == set(want) and all(len(g) == 10 for g in got.values())
    assert recall(got, want) >= least
    vector = dict(rows)
    for q, near in got.items():
        assert all(abs(s - math.dist(vector[q], vector[v])) < 1e-12 for s, v in near) and near == sorted(near)


@pytest.mark.parametrize("rank", [2, 6, 24])
def test_recall_over_many_shards(spark, rank):
    """Vectors that vary in few directions, with a crowd of near copies; shards of 256."""
    rng = np.random.default_rng(rank)
    x = rng.normal(size=(1500, rank)) @ rng.normal(size=(rank, 24))
    x[:500] = x[0] + 1e-3 * rng.normal(size=(500, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    asked = d.filter("vec_id % 25 = 0")
    got = found(nearest(d, asked, 10, shard_rows=256))
    assert recall(got, brute(rows, [r for r in rows if r[0] % 25 == 0], 10)) >= 0.98


def test_pruned_edges():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 8))
    g = Graph(x, 12).build()
    assert g.edges.shape == (700, 12) and ((g.edges >= 0).sum(1) > 0).all()
    for i, row in enumerate(g.edges):
        row = row[row >= 0]
        assert i not in row and len(set(row.tolist())) == len(row)
    # what the rule keeps, by its definition
    p, around = np.array([3]), rng.permutation(np.r_[0:3, 4:60])[None, :]
    kept, left = [], sorted(around[0].tolist(), key=lambda j: math.dist(x[3], x[j]))
    while left and len(kept) < 12:
        best, *left = left
        kept.append(best)
        left = [j for j in left if 1.2 * math.dist(x[best], x[j]) > math.dist(x[3], x[j])]
    got = Graph(x, 12).prune(p, around, 1.2)[0]
    assert got[got >= 0].tolist() == kept


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    same = [[1.0, 2.0, 3.0]] * 40                               # a crowd of copies, ties by id
    rows = [(i, v) for i, v in enumerate(same)] + [
        (100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 2.0]), (104, [inf, 0.0, 0.0]), (105, [nan, 1.0, 0.0]),
        (106, [1.0, 2.0, 4.0]), (106, [1.0, 2.0, 4.0]), (107, [1.0, 2.0, 2.0]), (108, [-0.0, 5.0, 1.0]), (109, [0.0, 5.0, 1.0]),
        (None, [1.0, 2.0, 3.0]), (110, [1.0, 2.0]), (111, [2.0, 1.0]), (112, [7.0]), (113, [9.0, 9.0, 9.0]), (113, [1.0, 2.0, 3.5])]
    d = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id bigint, embedding array<double>, rank int, key string")
    got = found(nearest(d, d, 12))
    want = {q: near for q, near in brute(rows, rows, 12).items() if near}
    assert set(got) == set(want)
    for q in want:
        assert [v for _, v in got[q]] == [v for _, v in want[q]] and np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]])
    assert len(got[110]) == 1 and 112 not in got               # fewer candidates, and none
    assert nearest(d.limit(0), d.limit(0)).collect() == []
    assert nearest(d, d.limit(0)).collect() == [] and nearest(d.limit(0), d).collect() == []


def test_float_vectors_and_a_query_that_is_no_row(spark):
    d = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id int, embedding array<float>")
    q = spark.createDataFrame([(500, [10.2, 1.0])], "vec_id int, embedding array<float>")
    assert [v for _, v in found(nearest(d, q, 3))[500]] == [10, 11, 9]
