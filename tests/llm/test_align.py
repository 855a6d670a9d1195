"""Token alignment: brute force over bytes, the tokenizers' own libraries, odd rows."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from memberlens.llm import queries as Q
from memberlens.llm.align import Aligner, Tokenizers, align_tokens, byte_symbols, load_byte_level, score_links

JSON, MODEL = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
A = Tokenizer.from_file(JSON)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=MODEL)
LEVEL = load_byte_level(JSON)
with open(MODEL, "rb") as f:
    PIECES = f.read()
BOTH = Tokenizers(LEVEL, public_tokenizers.PATTERN, PIECES)
ALIGNER = Aligner(BOTH.bytes_a, BOTH.bytes_b)
SYMBOL = byte_symbols()
NAME = {i: t for t, i in A.get_vocab().items()}
TEXTS = ["Hello world's  end\n\n 123", "é日本😀 \x00 <|endoftext|> <s> </s>", "a▁b", "word " * 4000, "x" * 9000, " \t \n  ", "ﬁ Ⅷ é  x",
         "<0x41> tab\there\r\n", "q"]


def token_bytes(text):
    """Bytes of both encodings' tokens, by the libraries alone; none where they do not give the text back."""
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    bytes_a = [bytes(SYMBOL[c] for c in NAME[i]) for i in a]
    pieces = [B.id_to_piece(i) for i in b]
    bytes_b = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
    if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return [], [], [], []
    return a, b, bytes_a, bytes_b


def brute(text):
    """Groups and links byte by byte: which tokens of A and B each byte lies in."""
    a, b, bytes_a, bytes_b = token_bytes(text)
    of_a = [i for i, t in enumerate(bytes_a) for _ in t]
    of_b = [j for j, t in enumerate(bytes_b) for _ in t]
    links = list(dict.fromkeys(zip(of_a, of_b)))
    groups, i0, j0 = [], 0, 0
    for k in range(len(of_a)):
        last = k + 1 == len(of_a)
        if last or (of_a[k] != of_a[k + 1] and of_b[k] != of_b[k + 1]):
            groups.append(",".join(map(str, a[i0:of_a[k] + 1])) + "|" + ",".join(map(str, b[j0:of_b[k] + 1])))
            i0, j0 = of_a[k] + 1, of_b[k] + 1
    return len(a), len(b), groups, [(a[i], b[j]) for i, j in links]


def brute_rows(rows):
    told = [(i, brute(t or "")) for i, t in rows]
    count = Counter(x for _, t in told for x in t[3])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [(i, na, nb, len(g), len(l), sum(count[x] == top[x[1]] for x in l), sum(count[x] for x in l),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, (na, nb, g, l) in told]


def test_encoder_equals_the_library_on_every_character():
    for start in range(0, 0x110000, 64):
        text = "".join(f" a{chr(c)}1 {chr(c)}{chr(c)}! {chr(c)} \n{chr(c)}'s" for c in range(start, start + 64) if not 0xd800 <= c < 0xe000)
        assert BOTH.a.encode_ordinary(text) == A.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeinorst hd.,\n'1é▁"), st.characters(blacklist_categories=["Cs"])), max_size=60))
def test_windows_equal_brute_force(text):
    na, nb, groups, links = brute(text)
    ids = BOTH.encode(text) if text else None
    told, n_groups, n_links, pairs, times = ALIGNER.batch([ids])[0]
    assert told == ";".join(groups) and (n_groups, n_links) == (len(groups), len(links))
    assert dict(zip(pairs.tolist(), times.tolist())) == Counter(a * ALIGNER.n_b + b for a, b in links)


def test_query_equals_brute_force(spark):
    rows = Q.op12_token_alignment(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert rows[0].__fields__ == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows]
    assert sorted(got) == sorted(brute_rows([(d.doc_id, d.text) for d in docs]))


@pytest.mark.parametrize("hot", [1 << 19, 40, 1])
def test_odd_rows_with_and_without_the_broadcast(spark, hot):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (0, TEXTS[0]), (None, None), (None, ""), (None, TEXTS[0])]
    d = spark.createDataFrame([(t, i, "k") for i, t in rows], "text string, doc_id bigint, c0 string")
    out = score_links(align_tokens(d, LEVEL, public_tokenizers.PATTERN, PIECES, keep=["doc_id", "c0"]), B.vocab_size(), hot_pairs=hot).collect()
    assert {r.c0 for r in out} == {"k"}
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, sha(r.groups)) for r in out]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(brute_rows(rows), key=order)


def test_empty_table_and_names(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string, groups string")
    out = score_links(align_tokens(d, LEVEL, public_tokenizers.PATTERN, PIECES, keep=["doc_id"]), B.vocab_size())
    assert out.collect() == [] and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    with pytest.raises(ValueError):
        align_tokens(d, LEVEL, public_tokenizers.PATTERN, PIECES)


def test_vocabulary_that_does_not_follow_its_merges(tmp_path):
    with open(JSON, encoding="utf-8") as f:
        told = json.load(f)
    told["model"]["merges"] = told["model"]["merges"][::-1]
    (tmp_path / "v.json").write_text(json.dumps(told))
    with pytest.raises(ValueError):
        load_byte_level(str(tmp_path / "v.json"))
