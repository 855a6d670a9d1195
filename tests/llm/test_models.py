"""Classifiers and embeddings: held-out accuracy, brute force, odd rows; the pipeline's stages."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from memberlens.llm import pq
from memberlens.llm import queries as Q
from memberlens.llm.pq import near_embeddings
from memberlens.llm.quality import calibrate, difference, compressor, fit_quality, score_quality
from memberlens.llm.toxicity import best_threshold, fit_ordinal, fit_toxicity, score_toxicity, severity

SF = "/root/testdata/sf0.1"
ODD = [(1, None, 0), (2, "", 0), (3, "word " * 40_000, 0), (3, "word " * 40_000, 1), (None, "plain text here", 1)]


def auc(y, s):
    rank = np.argsort(np.argsort(s, kind="stable"), kind="stable")
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))


def test_quality_held_out(spark):
    got = Q.op7_quality(spark, SF).toPandas()
    assert len(got) == 10_000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    m = got.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    m = m[m.held_out]
    good = m[m.quality == 1]
    assert auc(m.quality.to_numpy(), m.score.to_numpy()) > 0.96
    assert good.predicted.mean() > 0.98 and m[m.quality == 0].predicted.mean() < 0.5


def test_quality_odd_rows_and_missing_classes(spark):
    d = spark.createDataFrame(ODD, "doc_id bigint, text string, c0 int")
    labels = spark.createDataFrame([(1, 1), (3, None)], "doc_id bigint, quality int")
    assert fit_quality(d, labels)["share"] == 1.0
    assert fit_quality(d, labels.filter("quality > 5"))["share"] == 0.5
    rows = [(i, ("good prose number %d with many words" if i % 2 else "%d$$$ ### %%%%%% &&& $$$") % i * 20) for i in range(80)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = fit_quality(train, train.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")))
    got = score_quality(d, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1 and len({r.score for r in got if r.doc_id == 3}) == 1
    by = {r.doc_id: r.score for r in score_quality(train, model).collect()}
    assert min(by[i] for i in by if i % 2) > max(by[i] for i in by if i % 2 == 0)
    assert score_quality(spark.createDataFrame([], d.schema), model).count() == 0
    with pytest.raises(ValueError):
        score_quality(d.withColumnRenamed("c0", "score"), model)


def test_difference_and_calibration():
    good, bad = compressor(b"the quick brown fox jumps over the lazy dog " * 20), compressor(b"### $$$ %%% &&& " * 40)
    assert difference("the quick brown fox jumps over", good, bad) > 0 > difference("### $$$ %%% &&& $$$ ###", good, bad)
    assert difference("", good, bad) == difference(None, good, bad) == 0
    rng = np.random.default_rng(0)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 0.5)))).astype(float)
    slope, offset = calibrate(x, y, np.ones(4000))
    assert abs(slope - 2) < 0.2 and abs(offset + 0.5) < 0.15


def test_ordinal_regression_recovers_its_model():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 3))
    z = x @ [1.5, -1.0, 0.0] + rng.logistic(size=6000)
    grade = (z[:, None] > [-1.0, 0.5, 2.0]).sum(1)
    w, cuts = fit_ordinal(x, grade, np.ones(6000), 4, penalty=1e-6, steps=600)
    assert np.abs(w - [1.5, -1.0, 0.0]).max() < 0.12 and np.abs(cuts - [-1.0, 0.5, 2.0]).max() < 0.12
    expected, p = severity(x @ w, cuts)
    assert abs(expected.mean() - grade.mean()) < 0.05 and abs(p.mean() - (grade > 0).mean()) < 0.03


def test_best_threshold():
    p, y = np.array([0.9, 0.8, 0.8, 0.3, 0.1, 0.1]), np.array([1, 1, 0, 1, 0, 0], bool)
    assert best_threshold(p, y, np.ones(6)) == pytest.approx(0.2)
    assert best_threshold(p, y, np.array([1, 1, 100, 1, 1, 1.0])) == pytest.approx(0.85)


def test_toxicity_held_out(spark):
    got = Q.op2_toxicity(spark, SF).toPandas()
    m = got.rename(columns={"toxic": "found"}).merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    m = m[m.held_out]
    assert len(got) == 10_000 and auc(m.toxic.to_numpy(), m.p_toxic.to_numpy()) > 0.95
    assert m[m.toxic == 0].found.mean() < 0.01 and m[m.toxic == 1].found.mean() > 0.8
    assert got.severity.between(0, 2).all()


def test_toxicity_given_grades_and_odd_rows(spark):
    rnd = random.Random(3)
    filler = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rnd.sample(filler, 20) + ["mean"] * (g >= 1) + ["awful"] * (g >= 2) + ["vile"] * (g >= 3)), g)
            for i in range(400) for g in [rnd.randrange(4)]]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, grade int")
    model = fit_toxicity(d, d.select("doc_id", "grade"), label_col="grade", grades=4)
    got = score_toxicity(d, model).toPandas()
    assert [round(v) for v in got.groupby("grade").severity.mean()] == [0, 1, 2, 3]
    odd = score_toxicity(spark.createDataFrame(ODD, "doc_id bigint, text string, c0 int"), model).collect()
    assert len(odd) == len(ODD) and all(math.isfinite(r.severity) and 0 <= r.p_toxic <= 1 for r in odd)
    assert score_toxicity(spark.createDataFrame([], d.schema), model).count() == 0
    constant = fit_toxicity(d, d.filter("grade = 0").select("doc_id", "grade"), label_col="grade", grades=4)
    assert score_toxicity(d, constant).select("severity").distinct().count() == 1


def brute_links(vectors, threshold=0.9):
    ok = [v is not None and len(v) == 16 and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v in vectors]
    x = np.array([np.array(v, float) / np.linalg.norm(v) if k else np.zeros(16) for (_, v), k in zip(vectors, ok)])
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    return near


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 16))
    near = base[:100] + rng.normal(size=(100, 16)) * 0.1
    chain = [base[0]]
    for _ in range(30):
        chain.append(chain[-1] + rng.normal(size=16) * 0.35)
    x = np.concatenate([base, near, chain, np.repeat(base[7:8], 150, 0), base[9] + rng.normal(size=(200, 16)) * 0.02]).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [float("nan")] * 16), (9005, [None, *[1.0] * 15]), (9006, [1.0] * 5),
             (9007, [float("inf")] * 16), (9008, [1e-30] * 16), (9009, [1e30] * 16)]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("label", F.lit(1)).repartition(6)
    got = {r.vec_id: r for r in near_embeddings(d).collect()}
    links = brute_links([(i, [float(np.float32(c)) for c in v] if v and all(c is not None for c in v) else v) for i, v in rows])
    assert len(got) == len(rows)
    found, true = sum(r.n_links for r in got.values()), links.sum()
    assert found <= true and found >= 0.99 * true
    comp = np.arange(len(rows))
    while True:
        new = np.array([min([comp[i], *comp[links[i]]]) for i in range(len(rows))])
        if (new == comp).all():
            break
        comp = new
    wrong = sum(got[i].component_id != rows[comp[k]][0] for k, (i, _) in enumerate(rows))
    assert wrong <= 2
    assert all(got[i].n_links == 0 and got[i].kept for i in range(9001, 9008)) and got[9008].n_links == 1
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_embeddings_recall_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    g = rng.normal(size=a.shape)
    g -= (g * a).sum(1, keepdims=True) * a
    b = 0.905 * a + math.sqrt(1 - 0.905 ** 2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    got = near_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).toPandas()
    assert got.n_links.sum() >= 0.99 * 6000


@pytest.mark.parametrize("rank", [3, 8])
def test_embeddings_recall_where_vectors_vary_in_few_directions(spark, rank):
    rng = np.random.default_rng(rank)
    basis = np.linalg.qr(rng.normal(size=(64, rank)))[0].T
    a = rng.normal(size=(3000, rank))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    g = rng.normal(size=a.shape)
    g -= (g * a).sum(1, keepdims=True) * a
    b = 0.905 * a + math.sqrt(1 - 0.905 ** 2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    v = np.concatenate([a, b]) @ basis
    true = int((v @ v.T >= 0.9).sum()) - len(v)
    got = near_embeddings(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")).toPandas()
    assert 0.99 * true <= got.n_links.sum() <= true + 2


def test_kmeans_in_blocks_equals_plain_rounds(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 6))
    c = x[np.linspace(0, 499, 20).astype(int)].copy()
    for _ in range(10):
        cell = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        c = np.array([x[cell == i].mean(0) if (cell == i).any() else c[i] for i in range(20)])
    for block in (7, 64, 2048):
        monkeypatch.setattr(pq, "FIT_BLOCK", block)
        assert np.allclose(pq.kmeans(x, 20), c)


def test_fit_holds_no_sample_by_lists_matrix():
    import tracemalloc
    x = np.random.default_rng(1).normal(size=(16384, 16))
    tracemalloc.start()
    pq.fit(x, 512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20                            # the whole matrix alone has 64 MB


def test_embeddings_empty_and_repeated(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert near_embeddings(spark.createDataFrame([], schema)).count() == 0
    got = near_embeddings(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, 4.0]), (None, None)], schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in got) == [(0, 0, 0), (0, 2, 1), (1, 2, 1), (1, 2, 1)]


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").quality
    assert [n for n, _ in C.STAGES] == ["quality", "line_dedup", "simhash", "mix", "bpe"]
    kept = {}
    for name, stage in C.STAGES:
        before = docs
        docs = stage(spark, docs, sf).cache()
        kept[name] = docs
        if name != "bpe":
            assert docs.columns == before.columns
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in kept.items()}
    good = {i for i, q in labels.items() if q == 1}
    assert len(good & ids["quality"]) >= 0.97 * len(good)
    assert ids["line_dedup"] == ids["quality"] >= ids["simhash"] >= ids["mix"] == ids["bpe"]
    assert kept["bpe"].filter("not round_trip").count() == 0 and kept["bpe"].count() == kept["mix"].count()
    assert kept["simhash"].count() == len(ids["simhash"])
    run = C.run(spark, sf)
    assert run.select("doc_id").exceptAll(kept["bpe"].select("doc_id")).count() == 0
    spark.catalog.clearCache()
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    dirty = spark.createDataFrame([(1, None, "en", None, None), (2, "", None, "s", 0), (2, "", None, "s", 0), (None, "a b", "en", "s", 3)], schema)
    for name, stage in C.STAGES:
        dirty = stage(spark, dirty, sf)
    # null and empty texts are one SimHash group of size 0, of which the mix takes nothing
    assert [(r.doc_id, r.lang, r.source, r.n_tokens, r.ids, r.round_trip) for r in dirty.collect()] == [(None, "en", "s", 2, [64, 272], True)]
    empty = spark.createDataFrame([], schema)
    for name, stage in C.STAGES:
        empty = stage(spark, empty, sf)
    assert empty.collect() == []


def test_pipeline_copies_leave_one_document_with_text(spark):
    rnd = random.Random(3)
    # lines below 200 bytes that one chunk or none holds, so that chunks alone leave fragments
    texts = ["\n".join(" ".join(f"g{g}x{rnd.randrange(10**6)}" for _ in range(rnd.randint(2, 12))) for _ in range(rnd.randint(1, 9))) for g in range(60)]
    schema = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").schema
    rows = [(100 * c + g, t, "en", "s", len(t)) for g, t in enumerate(texts) for c in range(3)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in C.STAGES[1:3]:
        docs = stage(spark, docs, "/root/testdata/sf0.01")
    left = [r for r in docs.collect() if r.text]
    assert sorted(r.doc_id for r in left) == list(range(60)) and all(r.text == texts[r.doc_id] for r in left)
