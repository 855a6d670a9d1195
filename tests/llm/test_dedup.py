"""Exact, line and SimHash deduplication: brute force, odd rows, hot groups."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from memberlens.llm import queries as Q
from memberlens.llm.common import components
from memberlens.llm.exact import exact_dedup
from memberlens.llm.lines import line_dedup, passage_dedup, with_chunks
from memberlens.llm.simhash import ball, fingerprint, near_pairs, segment_radii, simhash_dedup

DOCS = "doc_id bigint, text string, k int"
SMALL = "/root/testdata/sf0.001"


def odd_rows():
    long = "word " * 60_000
    rows = [(1, "a b c", 0), (2, "a b c", 0), (2, "a b c", 0), (3, None, 0), (4, "", 1), (None, "a b c", 1), (None, "only here", None),
            (5, long, 2), (6, long + "x", 2), (7, long, 2), (8, "é日本 \x00\x01", 3), (9, "tail", 3), (9, "other tail", 3)]
    return rows


def test_exact_dedup_matches_brute_force(spark):
    rows = odd_rows() + [(100 + i, "hot", 0) for i in range(300)]
    random.Random(1).shuffle(rows)
    got = exact_dedup(spark.createDataFrame(rows, DOCS)).collect()
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[t or ""].append(d)
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r.text or ""]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        assert r.keep_id == (max(known) if known else None)
        assert r.kept == (r.doc_id == r.keep_id)


def test_exact_dedup_empty_table_and_clashing_names(spark):
    empty = exact_dedup(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "k", "keep_id", "group_size", "kept"]
    d = spark.createDataFrame([(1, "x", 5), (2, "x", 6)], "doc_id bigint, text string, _full int")
    assert {r["_full"] for r in exact_dedup(d).collect()} == {5, 6}
    with pytest.raises(ValueError):
        exact_dedup(spark.createDataFrame([(1, "x", 5)], "doc_id bigint, text string, kept int"))


def test_exact_dedup_normaliser(spark):
    d = spark.createDataFrame([(1, "Ab"), (2, "aB"), (3, "c")], "doc_id bigint, text string")
    got = {r.doc_id: r.keep_id for r in exact_dedup(d, normalise=F.lower).collect()}
    assert got == {1: 2, 2: 2, 3: 3}


# --- line dedup --------------------------------------------------------------

def brute_lines(rows):
    def h60(s):
        return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)

    def chunks(text):
        ls, out, prev_r, prev_h, prev_long = text.split("\n"), [], None, 0, False
        for i, x in enumerate(ls):
            h, long = h60(x) % 2147483647, len(x.encode()) >= 200
            if i == 0 or long or prev_long or prev_r % 3 == 0:
                out.append([])
            out[-1].append(x)
            prev_r, prev_h, prev_long = (h + (prev_h * 1_000_003 if i else 0)) % 2147483647, h, long
        return ["\n".join(c) for c in out]
    docs = {}
    for d, t in rows:
        docs[(d, t)] = chunks(t) if t is not None else None
    places = defaultdict(list)
    for (d, t), cs in docs.items():
        for i, c in enumerate(cs or []):
            n = len(c.encode())
            if n >= 40 and (n >= 200 or "\n" in c):
                places[c].append((d is None, d if d is not None else 0, t, i))
    out = {}
    for (d, t), cs in docs.items():
        if cs is None:
            out[d, t] = None
            continue
        out[d, t] = "\n".join(c for i, c in enumerate(cs) if c not in places or min(places[c], key=lambda p: p[:2] + p[3:]) == (d is None, d or 0, t, i))
    return out


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(5)
    pool = [" ".join(rnd.choice(["lorem", "ipsum", "dolor", "sit", "amet", "é"]) for _ in range(rnd.randint(2, 60))) for _ in range(60)]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 25)))) for i in range(200)]
    block = "\n".join(pool[:9])
    rows += [(1000 + i, f"own line {i}\n{block}\nend {i}") for i in range(20)]
    rows += [(3000, None), (3001, ""), (3002, "\n\n"), (3003, "x" * 300), (3004, "y " * 50_000)]
    got = {(r.doc_id): r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = {d: t for (d, _), t in brute_lines(rows).items()}
    assert got == want
    assert sum(t is not None and t != dict(rows)[d] for d, t in got.items()) > 100


def test_line_dedup_passage_in_clean_documents(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    clean = {i: f"first line of document {i}\n" + " ".join(f"t{i}x{j}" for j in range(80)) for i in range(30)}
    rows = [(i, t + ("\n" + passage if i % 2 else "")) for i, t in clean.items()]
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [i for i, t in got.items() if passage in t] == [1]
    assert all(got[i] == clean[i] for i in clean if i != 1)


def test_chunks_join_to_the_text_and_resist_shifts(spark):
    lines = [f"line number {i} of the text" for i in range(200)]
    d = spark.createDataFrame([(0, "\n".join(lines)), (1, "\n".join(["inserted", *lines]))], "doc_id bigint, text string")
    got = {r.doc_id: r.ch for r in with_chunks(d, "text", "ch").collect()}
    assert "\n".join(got[0]) == "\n".join(lines)
    assert len(set(got[0]) - set(got[1])) <= 2 and 20 < len(got[0]) < 140


def test_line_dedup_repeated_rows_null_ids_and_names(spark):
    b = "\n".join(f"a shared line with some words {i}" for i in range(12))
    rows = [(None, b, 1), (7, b, 2), (7, b, 2), (8, b + "\nmore", 3)]
    got = line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string, chunks int"))
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id, r.chunks].append(r.text)
    assert by[7, 2] == [b, b]                          # one document, so both stay whole
    assert len(by[None, 1][0]) < len(b) / 2            # null ids come last
    assert line_dedup(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


# --- passages ----------------------------------------------------------------

def brute_passages(rows, words=50):
    def h60(s):
        return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    places, docs = defaultdict(set), {(d, t): t.split("\n") for d, t in rows if t is not None}
    for (d, t), ls in docs.items():
        key, full = (d is None, d or 0, t), [i for i, x in enumerate(ls) if x.split()]
        size = {i: len(ls[i].split()) for i in full}
        for s in range(len(full)):                      # every run of whole lines, the shortest that reaches the words
            for e in range(s, len(full)):
                run = full[s:e + 1]
                n = sum(size[i] for i in run)
                if n >= words and (n - size[run[-1]] < words or n - size[run[0]] < words):
                    places["w", tuple(ls[i] for i in run)].add((*key, run[0], run[-1]))
        at, prev_r, prev_h, prev_long, chunks = 0, None, 0, False, []
        for i, x in enumerate(ls):
            h, long = h60(x) % 2147483647, len(x.encode()) >= 200
            if i == 0 or long or prev_long or prev_r % 3 == 0:
                chunks.append([])
            chunks[-1].append(x)
            prev_r, prev_h, prev_long = (h + (prev_h * 1_000_003 if i else 0)) % 2147483647, h, long
        for c in chunks:
            text = "\n".join(c)
            if len(text.encode()) >= 40 and (len(text.encode()) >= 200 or len(c) > 1):
                places["c", text].add((*key, at, at + len(c) - 1))
            at += len(c)
        if len(t.encode()) >= 40:
            places["t", t].add((*key, 0, len(ls) - 1))
    gone = defaultdict(set)
    for (_, _), at in places.items():
        first = min(at, key=lambda p: p[:2] + p[3:])
        for p in at - {first}:
            gone[p[:3]] |= set(range(max(p[3], first[4] + 1) if p[:3] == first[:3] else p[3], p[4] + 1))
    return {(d, t): t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d is None, d or 0, t]) for d, t in rows}


def test_passage_dedup_matches_brute_force(spark):
    rnd = random.Random(7)
    pool = [" ".join(rnd.choice(["lorem", "ipsum", "dolor", "sit", "amet", "é"]) for _ in range(rnd.choice([1, 4, 9, 14, 30, 60]))) for _ in range(150)] + ["", " \t"]
    rows = [(i, "\n".join(rnd.choice(pool) if rnd.random() < .5 else f"own {i} {rnd.random()}" for _ in range(rnd.randint(1, 30)))) for i in range(200)]
    for i in range(80):
        at = rnd.randrange(140)
        rows.append((500 + i, "\n".join([f"start {i}", *pool[at:at + rnd.randint(2, 12)], f"end {i}"])))
    rows += [(900, "\n".join(["again and again and again"] * 60)), (901, None), (902, ""), (903, "\n\n"), (904, "a b c"), (905, "a b c"), (906, "w " * 50_000)]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:30])] + [rows[3]]
    got = passage_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    want = {d: t for (d, _), t in brute_passages(rows).items()}
    assert {r.doc_id: r.text for r in got} == want
    assert all(want[1000 + i] == "" for i in range(30) if len(rows[i][1]) >= 40)
    assert want[900] == "\n".join(["again and again and again"] * 10)


@pytest.mark.parametrize("n_lines,n_words", [(3, 20), (4, 14), (6, 14), (10, 14)])
def test_passage_of_short_lines_goes_whole(spark, n_lines, n_words):
    passages = ["\n".join(" ".join(f"p{k}l{i}w{j}" for j in range(n_words)) for i in range(n_lines)) for k in range(40)]
    rows = [(2 * k + c, f"head {k} {c}\n{p}\ntail {k} {c}") for k, p in enumerate(passages) for c in (0, 1)]
    got = {r.doc_id: r.text for r in passage_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {d: t if d % 2 == 0 else f"head {d // 2} 1\ntail {d // 2} 1" for d, t in rows}


def test_passage_dedup_null_ids_names_and_empty_table(spark):
    b = "\n".join(f"a shared line with some words {i}" for i in range(12))
    rows = [(None, b, 1), (7, b, 2), (7, b, 2), (8, b + "\nmore", 3)]
    got = passage_dedup(spark.createDataFrame(rows, "doc_id bigint, text string, gone int")).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_removed, r.n_lines) for r in got) == [(0, "", 12, 12), (7, b, 0, 12), (7, b, 0, 12), (8, "more", 12, 13)]
    assert passage_dedup(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


# --- SimHash -----------------------------------------------------------------

def brute_fp(t):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_definition():
    rnd = random.Random(2)
    texts = [None, "", " \t\n", "One", "one two", "A b C", "É é  x y", *[" ".join(rnd.choice("abcdef") for _ in range(n)) for n in (3, 4, 50, 999)]]
    for t in texts:
        assert fingerprint(t) % (1 << 64) == brute_fp(t)
    import memberlens.llm.simhash as S
    long, block = " ".join(rnd.choice(["x", "yy", "z"]) for _ in range(500)), S.BLOCK
    try:
        S.BLOCK = 64
        assert fingerprint(long) % (1 << 64) == brute_fp(long)
    finally:
        S.BLOCK = block


@pytest.mark.parametrize("bits,segments", [(2, 2), (3, 2), (0, 2), (1, 4), (4, 3)])
def test_near_pairs_are_complete(spark, bits, segments):
    rnd = random.Random(bits * 10 + segments)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        f = rnd.getrandbits(64)
        fps.add(f)
        for _ in range(4):
            g = f
            for b in rnd.sample(range(64), rnd.randint(0, 5)):
                g ^= 1 << b
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.a, r.b) for r in near_pairs(spark.createDataFrame([(f,) for f in signed], "fp bigint"), bits, segments).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= bits}
    assert got == want
    assert sum(r + 1 for r in segment_radii(bits, segments) if r >= 0) == bits + 1
    assert len(ball(32, 1)) == 33


def test_components_match_union_find(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash_on_a_table_matches_brute_force(spark):
    got = {r.doc_id: r for r in Q.op1_simhash(spark, SMALL).collect()}
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    fp = {d: brute_fp(t) for d, t in docs}
    comp = {d: d for d in fp}
    for _ in range(len(fp)):
        new = {a: min(comp[b] for b in fp if bin(fp[a] ^ fp[b]).count("1") <= 2) for a in fp}
        if new == comp:
            break
        comp = new
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{fp[d]:016x}", comp[d]) for d in fp}


def test_simhash_odd_rows(spark):
    got = simhash_dedup(spark.createDataFrame(odd_rows(), DOCS)).collect()
    assert len(got) == len(odd_rows())
    assert {r.component_id for r in got if r.text in (None, "")} == {3}
    assert {r.component_id for r in got if r.text == "a b c"} == {1}
    assert [r.kept for r in got if r.text == "only here"] == [True]
    assert simhash_dedup(spark.createDataFrame([], DOCS)).count() == 0
    d = spark.createDataFrame([(1, "x y z", 3)], "doc_id bigint, text string, fp int")
    assert simhash_dedup(d).first()["fp"] == 3
    assert np.unique([r.fingerprint for r in got if r.text == "a b c"]).size == 1
