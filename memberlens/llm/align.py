"""Alignment of two tokenisations of one text, and how often each pair of tokens meets."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from memberlens.session import ensure_checkpoint_dir

from .common import cut, own_columns, scratch

#: A Python worker remembers so many windows (some 100 MB) before it starts anew.
MEMO = 150_000
#: Texts are handed back in batches of about so many characters.
BATCH_CHARS = 2_000_000
#: At most so many pairs, the most frequent ones, are looked up in a broadcast table; the rest are joined.
HOT_PAIRS = 1 << 19
#: Pairs that a task counts before it hands counts on.
COUNTED = 1 << 21


def byte_symbols() -> dict[str, int]:
    """The printable symbol that a byte-level vocabulary writes for each byte:
    visible Latin-1 characters stand for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_byte_level(path: str) -> dict:
    """Tokens of a byte-level BPE's JSON file: {"bytes": per id, "ranks": of the
    ordinary tokens}.  Ids must follow the order of the merges, as they then are
    the ranks of the merges."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    symbol = byte_symbols()
    special = {t["content"] for t in told.get("added_tokens", []) if t["special"]}
    vocab = {t: i for t, i in told["model"]["vocab"].items() if t not in special}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in told["model"]["merges"]]
    if any(vocab[a] >= vocab[b] for a, b in zip(merged, merged[1:])):
        raise ValueError("ids do not follow the merges")
    ranks = {bytes(symbol[c] for c in t): i for t, i in vocab.items()}
    table = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        table[i] = t
    return {"bytes": table, "ranks": ranks}


def vocabulary_size(pieces: bytes) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=pieces).vocab_size()


class Tokenizers:
    """The two encoders: A, byte-level BPE; B, word pieces with byte fallback, which sets a space before the text."""

    def __init__(self, byte_level: dict, pattern: str, pieces: bytes):
        import sentencepiece
        import tiktoken
        self.a = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=byte_level["ranks"], special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = byte_level["bytes"]
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.vocab_size())]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B; None if the bytes of either are not a space and the text."""
        whole = b" " + text.encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text, num_threads=1)
        if b"".join(map(self.bytes_b.__getitem__, b)) != whole or b"".join(map(self.bytes_a.__getitem__, a)) != whole:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)


class Aligner:
    """Aligns windows of the two id sequences, and remembers them by their ids."""

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]):
        self.size = [np.array([len(t) for t in table], np.int64) for table in (bytes_a, bytes_b)]
        self.spaced = [np.array([t.startswith(b" ") for t in table]) for table in (bytes_a, bytes_b)]
        # each id as text, with the mark behind it inside a group and at the end of its side
        self.names = [[np.array([f"{i}{mark}" for i in range(len(s))], object) for mark in marks] for s, marks in zip(self.size, (",|", ",;"))]
        self.n_b = len(bytes_b)
        self.forget()

    def forget(self) -> None:
        self.slots: dict[tuple[bytes, bytes], int] = defaultdict()
        self.slots.default_factory = self.slots.__len__
        self.texts: list[str] = []
        self.groups, self.first, self.links = np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def align(self, windows: list[tuple[bytes, bytes]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Groups as text, their number and the number of links of each window, and all
        links' pairs a * n_b + b, window by window.

        Both sides of a window have the same bytes, so windows are laid end to end:
        a place where either side ends a token ends one link, a place where both do
        ends a group as well.
        """
        ids = [np.frombuffer(b"".join(side), np.int32) for side in zip(*windows)]
        ends = [size[x].cumsum() for size, x in zip(self.size, ids)]
        at = np.union1d(*ends)
        links = ids[0][np.searchsorted(ends[0], at)].astype(np.int64) * self.n_b + ids[1][np.searchsorted(ends[1], at)]
        shared = np.intersect1d(*ends, assume_unique=True)
        last = [np.cumsum([len(w[k]) // 4 for w in windows]) for k in (0, 1)]       # tokens up to each window's end
        closed = ends[0][last[0] - 1]
        # text: tokens of a group, A's before B's, each with the mark behind it
        words, group = [], []
        for k in (0, 1):
            mine = np.searchsorted(shared, ends[k])
            final = shared[mine] == ends[k]
            words.append(np.where(final, self.names[k][1][ids[k]], self.names[k][0][ids[k]]))
            group.append(2 * mine + k)
        words = np.concatenate(words)[np.argsort(np.concatenate(group), kind="stable")].tolist()
        upto = (last[0] + last[1]).tolist()
        texts = ["".join(words[i:j])[:-1] for i, j in zip([0, *upto], upto)]
        return texts, np.diff(np.searchsorted(shared, closed, side="right"), prepend=0), np.diff(np.searchsorted(at, closed, side="right"), prepend=0), links

    def windows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of the windows that the two sequences (of the same bytes) consist of.

        A window begins where a token of either sequence begins with a space at
        the same byte, so where both have ended a token: nothing overlaps across.
        """
        ends = [size[x].cumsum() for size, x in zip(self.size, (a, b))]
        starts = [e - size[x] for size, x, e in zip(self.size, (a, b), ends)]
        spaced = [np.flatnonzero(s[x]) for s, x in zip(self.spaced, (a, b))]
        mark = np.zeros(int(ends[0][-1]) + 1, bool)
        mark[starts[0][spaced[0]]] = True
        at_b = spaced[1][mark[starts[1][spaced[1]]]]
        mark[:] = False
        mark[starts[1][at_b]] = True
        at_a = spaced[0][mark[starts[0][spaced[0]]]]
        cut_a = (np.concatenate([[0], at_a[at_a > 0], [len(a)]]) * 4).tolist()
        cut_b = (np.concatenate([[0], at_b[at_b > 0], [len(b)]]) * 4).tolist()
        raw_a, raw_b, slots = a.tobytes(), b.tobytes(), self.slots
        return np.array([slots[raw_a[i:j], raw_b[k:m]] for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])])

    def batch(self, texts: list[tuple[np.ndarray, np.ndarray] | None]) -> list[tuple]:
        """(groups, their number, number of links, distinct pairs, times each) of every text's two sequences."""
        if len(self.slots) >= MEMO:
            self.forget()
        known = len(self.slots)
        found = [self.windows(*t) if t is not None else None for t in texts]
        if len(self.slots) > known:
            told, groups, n, links = self.align(list(islice(self.slots, known, None)))
            self.texts += told
            self.groups = np.concatenate([self.groups, groups])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n)])
            self.links = np.concatenate([self.links, links])
        out = []
        for w in found:
            if w is None:
                out.append(("", 0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64)))
                continue
            n = self.first[w + 1] - self.first[w]
            at = np.repeat(self.first[w] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            pairs, times = np.unique(self.links[at], return_counts=True)
            out.append((";".join(map(self.texts.__getitem__, w.tolist())), int(self.groups[w].sum()), int(n.sum()), pairs, times))
        return out


def align_tokens(docs: DataFrame, byte_level: dict, pattern: str, pieces: bytes, text_col: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """Add to each row the alignment of its text's two tokenisations: ``n_a`` and
    ``n_b`` (tokens), ``n_groups``, ``n_links`` (bigint), ``groups`` (string), and
    ``pairs`` (array<bigint>, distinct a * size of B's vocabulary + b) with ``times``.

    A encodes a space and the text, B the text, to which it adds the space;
    special tokens' strings are plain text.  Groups lie between byte offsets at
    which both end a token, written ``a1,a2|b1;a3|b2``; a link is a pair of token
    occurrences whose bytes overlap.

    Null and empty texts have no tokens (zeros, ``groups`` is ''), and so have
    texts that either tokeniser does not give back byte by byte (white space or
    U+2581 that B rewrites).  Repeated rows are told each; rows do not meet, so
    there is no shuffle.  Texts are encoded whole; the windows that a worker
    remembers are bounded in number.  ``keep`` names the columns that pass through
    (default: all); an input with one of the added names is refused.
    """
    keep = docs.columns if keep is None else keep
    added = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
    own_columns(docs.select(*[docs[f"`{c}`"] for c in keep]), added)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}       # inputs may bring any names
    d = docs.toDF(*names.values()).select(*dict.fromkeys([*(names[c] for c in keep), names[text_col]]))
    at, n = d.columns.index(names[text_col]), len(keep)
    schema = StructType([*(d.schema[names[c]] for c in keep), *(StructField(c, LongType()) for c in added[:4]), StructField("groups", StringType()),
                         StructField("pairs", ArrayType(LongType())), StructField("times", ArrayType(IntegerType()))])
    shared = docs.sparkSession.sparkContext.broadcast({"byte_level": byte_level, "pieces": pieces})

    def told(part: pa.RecordBatch, texts: list[str], box: dict) -> pa.RecordBatch:
        ids = [box["tokenizers"].encode(t) if t else None for t in texts]
        groups, n_groups, n_links, pairs, times = zip(*box["aligner"].batch(ids))
        ends = np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x).astype(kind))) for x, kind in ((pairs, np.int64), (times, np.int32))]
        counts = [[len(x[k]) if x is not None else 0 for x in ids] for k in (0, 1)] + [n_groups, n_links]
        return pa.RecordBatch.from_arrays([*part.columns[:n], *(pa.array(c, pa.int64()) for c in counts), pa.array(groups, pa.string()), *lists], names=schema.names)

    def run(batches):
        box = shared.value                  # a worker keeps this, and so its windows, for its next task
        if "aligner" not in box:
            box["tokenizers"] = Tokenizers(box["byte_level"], pattern, box["pieces"])
            box["aligner"] = Aligner(box["tokenizers"].bytes_a, box["tokenizers"].bytes_b)
        for b in batches:
            start, held, size = 0, [], 0
            for i, t in enumerate(b.column(at)):
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size >= BATCH_CHARS or i == b.num_rows - 1:
                    yield told(b.slice(start, len(held)), held, box)
                    start, held, size = i + 1, [], 0
    return d.mapInArrow(run, schema).toDF(*keep, *added)


def count_pairs(rows: DataFrame) -> DataFrame:
    """(pair, n): how many links of all rows hold each pair; counted in each task before the shuffle."""
    def run(batches):
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            pairs, at = np.unique(np.concatenate([pairs, b.column(0).flatten().to_numpy()]), return_inverse=True)
            times = np.bincount(at, np.concatenate([times, b.column(1).flatten().to_numpy()]), len(pairs)).astype(np.int64)
            if len(pairs) > COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], names=["pair", "n"])
                pairs, times = pairs[:0], times[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], names=["pair", "n"])
    return rows.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def score_links(rows: DataFrame, n_b: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Rows of ``align_tokens`` with ``n_best`` and ``count_sum`` (bigint) in place of
    ``pairs`` and ``times``.

    A pair's count is the number of links of all rows that hold it.  ``count_sum``
    adds it up over a row's links; ``n_best`` counts the links whose count is the
    highest of their B token, ties included.

    Rows are written once to the shared folder and read again, so texts are
    encoded once.  Of L links, at most ``hot_pairs`` pairs can have L /
    ``hot_pairs`` links or more: these are broadcast, with a bound that holds
    whatever the input, and settle most links without a shuffle.  All other
    pairs are exploded and joined; none of them is hot.
    """
    own_columns(rows, ["n_best", "count_sum"])
    spark, row = rows.sparkSession, scratch(rows, "row")
    path = f"{ensure_checkpoint_dir(spark)}/aligned-{uuid.uuid4()}"
    # an id of a row that is written with it, so no later attempt changes it
    rows.withColumn(row, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    kept = spark.read.parquet(path)
    counts = cut(count_pairs(kept))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // hot_pairs))
    # one row a token of B, so bounded by its vocabulary
    top = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("top"))
    judged = counts.join(F.broadcast(top), F.col("pair") % n_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    judged = cut(judged)
    hot = judged.filter(F.col("n") >= least).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(hot.column(c).to_numpy() for c in ("pair", "n", "best")))

    def look_up(batches):
        pair, n, best = shared.value
        for b in batches:
            ends = b.column(1).offsets.to_numpy().astype(np.int64)
            mine, times = (b.column(i).flatten().to_numpy().astype(np.int64) for i in (1, 2))
            ends -= ends[0]
            at = np.minimum(np.searchsorted(pair, mine), max(len(pair) - 1, 0))
            known = pair[at] == mine if len(pair) else np.zeros(len(mine), bool)
            of = np.repeat(np.arange(b.num_rows), np.diff(ends))
            sums = []
            for value in (best, n):
                run = np.concatenate([[0], np.cumsum(np.where(known, value[at] * times, 0) if len(pair) else np.zeros(len(mine), np.int64))])
                sums.append(pa.array(run[ends[1:]] - run[ends[:-1]]))
            rest = np.concatenate([[0], np.cumsum(np.bincount(of[~known], minlength=b.num_rows))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(rest), pa.array(x[~known])) for x in (mine, times)]
            yield pa.RecordBatch.from_arrays([b.column(0), *sums, *lists], names=["row", "hot_best", "hot_sum", "pairs", "times"])
    looked = cut(kept.select(row, "pairs", "times").mapInArrow(look_up, "row long, hot_best long, hot_sum long, pairs array<long>, times array<long>"))
    rest = (looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("z"))
            .select("row", F.col("z.pairs").alias("p"), F.col("z.times").alias("t")))
    rest = (rest.join(judged.filter(F.col("n") < least), F.col("p") == F.col("pair"))
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("rest_best"), F.sum(F.col("t") * F.col("n")).alias("rest_sum")))
    sums = (looked.select("row", "hot_best", "hot_sum").join(rest, "row", "left")
            .select("row", (F.col("hot_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
                    (F.col("hot_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum")))
    others = [c for c in rows.columns if c not in ("pairs", "times")]
    return kept.select(row, *others).join(sums, F.col(row) == F.col("row")).select(*others, "n_best", "count_sum")
