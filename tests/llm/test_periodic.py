"""Periodic runs: brute force over every period, planted tails, odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from memberlens.llm import queries as Q
from memberlens.llm.periodic import Suffixes, Wavelet, find_runs, periodic_runs


def brute(words, least=24):
    """Runs by trying every period: maximal stretches where words p apart are equal."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted(((s, l, p) for (s, l), p in found.items()), key=lambda r: (r[0], r[2]))


def planted(rnd, alphabet, size):
    out = []
    while rnd.random() < 0.8 and len(out) < size:
        unit = [rnd.randrange(alphabet) for _ in range(rnd.randint(1, rnd.choice([3, 12, 60])))]
        if rnd.random() < 0.3:                          # powers inside the period
            unit = unit * rnd.randint(1, 4) + unit[:1]
        out += unit * rnd.randint(1, 6) + unit[:rnd.randint(0, len(unit))]
    return out


@pytest.mark.parametrize("least", [24, 3, 6, 10])
def test_runs_equal_brute_force(least):
    rnd, met = random.Random(least), 0
    for _ in range(120):
        texts = [planted(rnd, rnd.choice([1, 2, 3, 50]), 250) for _ in range(rnd.randint(1, 4))]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = list(zip(*(x.tolist() for x in find_runs(np.array([w for t in texts for w in t], np.int64), bounds, least))))
        want = [(int(s + bounds[i]), l, p) for i, t in enumerate(texts) for s, l, p in brute(t, least)]
        assert got == want
        met += len(want)
    assert met > 100


def test_structures():
    rnd = random.Random(3)
    words = np.array([rnd.randrange(2) for _ in range(90)])
    order = Suffixes(words, np.array([0, 40, 90]))
    for a, b in ((0, 40), (40, 90)):
        want = sorted(range(a, b), key=lambda i: words[i:b].tolist())
        assert np.argsort(order.rank)[a:b].tolist() == want
    i, j = np.array([1, 5, 40]), np.array([9, 6, 71])
    for f, b, x, y in zip(order.forward(i, j), order.backward(i, j), i, j):
        end, start = (40, 0) if x < 40 else (90, 40)
        assert f == next((k for k in range(end - y) if words[x + k] != words[y + k]), end - y)
        assert b == next((k for k in range(x - start) if words[x - 1 - k] != words[y - 1 - k]), x - start)
    values = np.array(rnd.sample(range(77), 77))
    tree = Wavelet(values)
    lo, hi, x = (np.array([rnd.randrange(78) for _ in range(300)]) for _ in range(3))
    lo, hi = np.minimum(lo, hi), np.maximum(lo, hi)
    want = [min((v for v in values[a:b] if v >= c), default=77) for a, b, c in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x).tolist() == want


def digests(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    number = {}
    x = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = {}
    for p in range(1, n // 3 + 1):                       # as brute(), a period at a time
        edge = np.flatnonzero(np.diff(np.concatenate([[0], x[:-p] == x[p:], [0]])))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e - s + p >= max(24, 3 * p):
                found.setdefault((s, e - s + p), p)
    runs = sorted(((s, l, p) for (s, l), p in found.items()), key=lambda r: (r[0], r[2]))
    gone = {i for s, l, p in runs for i in range(s + p, s + l)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{l},{p}\n" for s, l, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    rows = Q.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = [digests(d.doc_id, d.text) for d in docs]
    assert rows[0].__fields__ == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, rows)) == sorted(want)
    assert sum(w[1] for w in want) > 5


def test_planted_tail_of_odd_rows(spark, tmp_path):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    rows = [(ids[0], None), (ids[1], ""), (ids[2], " \t\n"), (ids[3], "one"), (ids[4], "a b " * 40), (ids[4], "a b " * 40), (None, "a b " * 40),
            (ids[5], " ".join(f"w{i}" for i in range(300))), (None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.op13_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[-1], r[1])
    assert sorted(map(tuple, got), key=key) == sorted([digests(*r) for r in rows], key=key)


def test_odd_rows_and_names(spark):
    text = "x " * 30 + "a b c d " * 12 + "\x1c end"          # no-break space and file separator do not part words
    rows = [(1, text, "k"), (1, text, "k"), (2, None, None), (3, "", "k"), (None, " \n ", "k"), (4, "w " * 60_000, "k"),
            (5, " ".join(str(i % 9_000) for i in range(40_000)), "k")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, c1 string")
    got = periodic_runs(d).collect()
    assert [r.c1 for r in got] == [r[2] for r in rows] and [r.text for r in got] == [r[1] for r in rows]
    want = brute((rows[0][1]).encode().split())
    for r in got[:2]:
        assert [tuple(x) for x in r.runs] == want and len(want) == 2 and r.collapsed == "x a b c d \x1c end"
    for r in got[2:5]:
        assert (r.n_words, r.runs, r.collapsed) == (0, [], "")
    assert [tuple(x) for x in got[5].runs] == [(0, 60_000, 1)] and got[5].collapsed == "w"
    assert [tuple(x) for x in got[6].runs] == [(0, 40_000, 9_000)] and got[6].collapsed.split() == [str(i) for i in range(9_000)]
    assert periodic_runs(d.limit(0)).collect() == []
    assert periodic_runs(d, keep=["doc_id"]).columns == ["doc_id", "n_words", "runs", "collapsed"]
    with pytest.raises(ValueError):
        periodic_runs(d.withColumnRenamed("c1", "Runs"))
