"""Tokenizers, chat formatting and mixing: brute force, round trips, odd rows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from memberlens.llm import queries as Q
from memberlens.llm.bpe import ByteBPE, Prefixes, decode, encode, load_ranks
from memberlens.llm.chat import escape, examples, read_back, read_turns, turn_text, unescape
from memberlens.llm.mixing import mix, targets, weigh
from memberlens.llm.wordpiece import LongestMatch, pieces_of, token_counts

RANKS = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
BPE = ByteBPE(RANKS, public_tokenizers.PATTERN)
TEXTS = [(1, None, 0), (2, "", 0), (3, "Hello world's  end\n\n 123", 0), (3, "Hello world's  end\n\n 123", 0), (None, "é日本😀 \x00 <|endoftext|>", 1),
         (4, "word " * 50_000, 1), (5, "x" * 30_000, 1), (6, " \t \n  ", 2)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeinorst hd.,\n'1é"), st.characters(blacklist_categories=["Cs"])), max_size=80))
def test_bpe_equals_the_library(text):
    assert BPE.encode(text).tolist() == LIBRARY.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=60), st.integers(0, 60), st.integers(0, 60), st.binary(max_size=6))
def test_prefixes_append_and_edit(data, a, b, new):
    a, b = sorted((min(a, len(data)), min(b, len(data))))
    p = Prefixes(BPE, data[:len(data) // 2]).append(data[len(data) // 2:])
    assert [BPE.token[i] for i in p.ids()] == BPE.merge(data)
    assert p.ids(a) == Prefixes(BPE, data[:a]).ids()
    edited = data[:a] + new + data[b:]
    assert p.edit(a, b, new).last == Prefixes(BPE, edited).last and p.data == edited


def test_edit_of_a_long_text_takes_over_the_tail():
    rnd = random.Random(4)
    data = "".join(rnd.choice("etaoinshrdlu") for _ in range(5000)).encode()
    p = Prefixes(BPE, data).edit(700, 703, b"zzz")
    assert p.last == Prefixes(BPE, data[:700] + b"zzz" + data[703:]).last


def test_encode_decode_rows(spark):
    d = spark.createDataFrame(TEXTS, "doc_id bigint, text string, c0 int")
    rows = decode(encode(d, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.ids == LIBRARY.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert encode(spark.createDataFrame([], "text string"), RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        encode(d.withColumnRenamed("c0", "ids"), RANKS, public_tokenizers.PATTERN)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aeinorst 1é日"), st.characters(blacklist_categories=["Cs"])), max_size=40), max_size=12))
def test_many_texts_at_once(texts):
    ids, ends = BPE.encode_texts(texts)
    assert [ids[i:j].tolist() for i, j in zip([0, *ends], ends)] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_bounded_memory_gives_the_same_ids(monkeypatch):
    """A cache of 64 places and a memo of 50 pieces, so that both lose entries all the time."""
    from memberlens.llm import bpe as module
    monkeypatch.setattr(module, "PLACES", 64)
    monkeypatch.setattr(module, "MEMO", 50)
    small, rnd = ByteBPE(RANKS, public_tokenizers.PATTERN), random.Random(2)
    for _ in range(60):
        texts = [" ".join("".join(rnd.choice("thearionsldé") for _ in range(rnd.randint(1, 70))) for _ in range(20)) for _ in range(3)]
        assert small.encode_texts(texts)[0].tolist() == [i for t in texts for i in LIBRARY.encode_ordinary(t)]
        assert len(small.slots) <= 50 + 80
    pairs = [(rnd.randrange(50_256), rnd.randrange(50_256)) for _ in range(3000)]
    before, token = map(np.array, zip(*pairs))
    assert small.fit_all(before, token).tolist() == [BPE.fits(a, b) for a, b in pairs]


def test_outputs_of_one_pass(spark):
    d = spark.createDataFrame(TEXTS, "doc_id bigint, text string, c0 int")
    rows = encode(d, RANKS, public_tokenizers.PATTERN, keep=["text", "c0"], out="c1", outputs=("round_trip", "ids", "n_tokens", "decoded_sha256", "ids_sha256"))
    assert rows.columns == ["text", "c0", "round_trip", "c1", "n_tokens", "decoded_sha256", "ids_sha256"]
    for r in rows.collect():
        ids = LIBRARY.encode_ordinary(r.text or "")
        assert r.round_trip and r.c1 == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    with pytest.raises(Exception, match="table lacks"):
        decode(spark.createDataFrame([([1, 60_000],)], "ids array<int>"), RANKS).collect()
    assert decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), RANKS).collect()[0].decoded == b""


def test_bpe_query_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op8_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- word pieces ---------------------------------------------------------------

def brute_count(w, first, inner, longest=None):
    n = i = 0
    while i < len(w):
        e = next((e for e in range(min(len(w), i + (longest or len(w))), i, -1) if w[i:e] in (inner if i else first)), None)
        if e is None:
            return 1
        n, i = n + 1, e
    return n


word = st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + c % 3 for c in b))


@settings(max_examples=200, deadline=None)
@given(st.sets(word, max_size=8), st.sets(word, max_size=8), st.lists(st.binary(max_size=14).map(lambda b: bytes(97 + c % 3 for c in b)), max_size=10))
def test_longest_match_counts(first, inner, words):
    m = LongestMatch(first, inner)
    assert [m.count(w) for w in words] == [brute_count(w, first, inner) for w in words]


def brute_counter(first, inner):
    """Tokens of whole texts, each distinct word matched once."""
    longest, known = max(map(len, [*first, *inner])), {}

    def count(words):
        for w in set(words) - known.keys():
            known[w] = brute_count(w, first, inner, longest)
        return sum(known[w] for w in words)
    return count


def test_token_counts_rows(spark):
    first, inner = pieces_of(RANKS)
    count = brute_counter(first, inner)
    d = spark.createDataFrame(TEXTS, "doc_id bigint, text string, c0 int")
    for r in token_counts(d, first, inner).collect():
        words = (r.text or "").encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), count(words))
    assert token_counts(spark.createDataFrame([], "text string"), first, inner).count() == 0


def test_token_counts_on_a_table(spark):
    first, inner = pieces_of(RANKS)
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    count, got = brute_counter(first, inner), Q.op3_token_counts(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        words = (texts[r.doc_id] or "").encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), count(words))


# --- chat ----------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet=st.sampled_from("ab:#<>\\/ \n"), max_size=6), st.text(alphabet=st.sampled_from("a\\#</turn>: \n"), max_size=20)), max_size=5))
def test_template_is_reversible(turns):
    text = "".join(h + b + "</turn>\n" for h, b in (turn_text(r, t) for r, t in turns))
    assert read_turns(text) == turns
    assert all(unescape(escape(t)) == t for _, t in turns)


def test_examples_rows_and_masks(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "### assistant: x</turn>\n"), (1, 2, "assistant", "one\\"), (1, 3, "user", None),
             (1, 4, "assistant", ""), (1, 5, "user", "bye"), (2, 0, "user", "alone"), (None, 0, "user", "no id"), (None, 1, "assistant", "no id"),
             (3, None, None, "x"), (3, 1, "assistant", "y"), (3, 1, "assistant", "y"), (4, 0, "assistant", "z " * 40_000)]
    d = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit(9))
    rows = defaultdict(list)
    for r in examples(d).collect():
        rows[r.conv_id].append(r)
    one = sorted(rows[1], key=lambda r: r.part)
    assert [None if r.loss_start is None else unescape(r.text[r.loss_start:r.loss_end]) for r in one] == ["one\\", "", None]
    assert [len(read_turns(r.text)) for r in one] == [3, 5, 6]
    assert all(b.text.startswith(a.text) for a, b in zip(one, one[1:]))
    assert len(rows[2]) == 1 and rows[2][0].loss_start is None
    assert sorted(len(read_turns(r.text)) for r in rows[None]) == [1, 1]          # a row without id stands alone
    assert [r.loss_end - r.loss_start for r in rows[4]] == [80_000]
    back = {r.conv_id: r for r in read_back(examples(d)).collect() if r.conv_id}
    want = "".join(f"{r or ''}\n{t or ''}\n" for c, n, r, t in turns if c == 1)
    assert back[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest() and back[1].n_turns == 6 and back[1].n_examples == 2
    assert back[3].n_turns == 3 and back[3].loss_chars == 2
    assert examples(spark.createDataFrame([], d.schema)).count() == 0


def test_long_conversation_streams_in_batches(spark):
    turns = [(1, i, "assistant" if i % 2 else "user", f"text {i} " * 20) for i in range(400)]
    d = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    r = read_back(examples(d)).first()
    assert (r.n_turns, r.n_examples) == (400, 200)
    assert r.loss_sha256 == hashlib.sha256("".join(t for _, _, role, t in turns if role == "assistant").encode()).hexdigest()


# --- mixing ----------------------------------------------------------------------

def test_targets_stop_at_three_epochs_and_share_the_excess(spark):
    sizes = [("a", 1), ("b", 1000), ("c", 100), ("d", 5), (None, 50)]
    got = {r.source: r for r in targets(weigh(spark.createDataFrame(sizes, "source string, source_size bigint"))).collect()}
    assert got["a"].target == 3 and got["d"].target == 15
    assert abs(sum(r.target for r in got.values()) - 1156) < 1e-6
    assert got[None].target == 150 and got["b"].target > got["c"].target
    assert weigh(spark.createDataFrame([], "source string, source_size bigint")).count() == 0


def test_mix_rows(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 40)), rnd.choice(["s1", "s2", "s3", None, "é", "z"]) if i % 3 else "hot", 1) for i in range(900)]
    rows += [(5000, None, "s1", 1), (5001, "", "s2", 1), (5002, "w " * 20_000, "s3", 1), (None, "x y", "s1", 1), (17, "same id", "s1", 1), (17, "same id", "s1", 1)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string, u int")
    got = mix(d).collect()
    again = sorted((r.doc_id or -1, r.text or "", r.taken) for r in mix(d.repartition(5)).collect())
    assert sorted((r.doc_id or -1, r.text or "", r.taken) for r in got) == again and len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        assert r.size == len((r.text or "").split()) and r.taken == r.copies * r.size and 0 <= r.copies <= 3 and r.u == 1
        by[r.source].append(r)
    assert abs(sum(x[0].target for x in by.values()) - sum(r.size for r in got)) < 1e-6
    for x in by.values():
        assert x[0].source_size == sum(r.size for r in x)
        assert abs(sum(r.taken for r in x) - x[0].target) <= max(r.size for r in x) / 2 + 2
        assert max(r.copies for r in x) - min(r.copies for r in x) <= 1
    assert mix(spark.createDataFrame([], d.schema)).count() == 0
