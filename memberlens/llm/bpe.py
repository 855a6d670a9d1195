"""Byte-level BPE encoding by prefix dynamic programming, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from itertools import chain, islice, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .common import own_columns

#: Pieces, and bytes of pieces, that a Python worker remembers before it starts anew.
MEMO, MEMO_BYTES = 100_000, 1 << 22
#: Token pairs that the scalar form remembers, and places (a power of two) of the other form's cache of 9 bytes each.
MEMO_PAIRS, PLACES = 250_000, 1 << 20
#: Above every rank; stands before the first token.
NEVER, BEGIN = 1 << 60, -1
#: Longer pieces are encoded one by one.
SHORT = 64
#: Pieces that are encoded together, and characters of the texts that are.
TOGETHER, BATCH_CHARS = 1 << 14, 1 << 19


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file: base64 of the token's bytes, space, rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


class Prefixes:
    """The encoding of one growing byte string.

    ``last[e]`` is the id of the one token with which the encoding of the first
    e bytes ends.  So an append only extends the array, any prefix's encoding is
    read by walking back, and an edit needs work from the edited place on.
    """

    def __init__(self, bpe: ByteBPE, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", [BEGIN]
        self.append(data)

    def append(self, more: bytes) -> Prefixes:
        self.data += more
        self.bpe.extend(self.data, self.last)
        return self

    def edit(self, start: int, end: int, new: bytes) -> Prefixes:
        """Replace bytes ``start:end``; prefixes up to ``start`` stay, and those
        behind the edit are taken over from where old and new tokens meet again."""
        old, shift, tail = self.last, len(new) - (end - start), self.data[end:]
        self.data, self.last = self.data[:start] + new, self.last[:start + 1]
        self.bpe.extend(self.data, self.last)
        run, longest = 0, self.bpe.longest
        for i in range(0, len(tail), longest):
            self.append(tail[i:i + longest])
            for e in range(len(self.data) - len(tail[i:i + longest]) + 1, len(self.data) + 1):
                run = run + 1 if self.last[e] == old[e - shift] else 0
            # tokens look back ``longest`` bytes at most: once so many in a row agree, all later ones do
            if run >= longest:
                self.data += tail[i + longest:]
                self.last += old[len(self.last) - shift:]
                break
        return self

    def ids(self, end: int | None = None) -> list[int]:
        """Encoding of the first ``end`` bytes (all by default)."""
        return self.bpe.walk(self.last, len(self.data) if end is None else end)


class ByteBPE:
    """Encoder for one rank table; equal to merging the lowest rank first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.token = {i: t for t, i in ranks.items()}
        self.size = [len(self.token.get(i, b"")) for i in range(max(self.token) + 1)]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for t, i in ranks.items():
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pattern = regex.compile(pattern)
        self.forget()
        self.pairs: dict[int, dict[int, bool]] = defaultdict(dict)
        self.known = 0
        self.courses: dict[int, tuple] = {}
        self.tables: dict[str, np.ndarray] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """The definition: merge the adjacent pair of lowest rank, leftmost first, until none is left."""
        parts, get = [data[i:i + 1] for i in range(len(data))], self.ranks.get
        ranks = [get(a + b, NEVER) for a, b in pairwise(parts)]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], NEVER)
        return parts

    def course(self, token: int) -> tuple[bool, list[int], list[bytes], list[bytes]]:
        """How the token's bytes merge: whether into the token itself, the ranks
        in order (then NEVER), and the first and the last part before each merge."""
        known = self.courses.get(token)
        if known is None:
            data, get = self.token[token], self.ranks.get
            parts = [data[i:i + 1] for i in range(len(data))]
            ranks, heads, tails = [], [], []
            while True:
                heads.append(parts[0])
                tails.append(parts[-1])
                low, i = min(((get(a + b, NEVER), i) for i, (a, b) in enumerate(pairwise(parts))), default=(NEVER, 0))
                ranks.append(low)
                if low == NEVER:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            known = self.courses[token] = (len(parts) == 1, ranks, heads, tails)
        return known

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before``: merging the two tokens' bytes gives just them.

        Up to a first merge across the border either side merges as it does
        alone, so the two courses are followed side by side, lowest rank first,
        to see whether such a merge is ever the next one.
        """
        if self.known >= MEMO_PAIRS:
            for row in self.pairs.values():             # emptied in place: loops hold these rows
                row.clear()
            self.known = 0
        known, right, heads, _ = self.course(token)
        if known and before != BEGIN:
            _, left, _, tails = self.course(before)
            get, i, j = self.ranks.get, 0, 0
            while True:
                a, b, across = left[i], right[j], get(tails[i] + heads[j], NEVER)
                if across < a and across <= b:
                    known = False
                    break
                if a == b == NEVER:
                    break
                if a <= b:
                    i += 1
                else:
                    j += 1
        self.pairs[before][token] = known
        self.known += 1
        return known

    def extend(self, data: bytes, last: list[int]) -> None:
        """Extend ``last`` to every prefix of ``data``: of the tokens that end the
        prefix, the one that fits behind the encoding of what stands before it.
        The automaton tells all tokens by their end, the longest first."""
        size, done = self.size, len(last) - 1
        base = max(0, done + 1 - self.longest)
        pairs = self.pairs
        after = [pairs[t] for t in last[base:]]         # what is known of the tokens behind each prefix
        at = done - base
        for end, t in self.automaton.iter(data[base:].decode("latin-1")):
            if end >= at:
                if end > at:
                    break
                s = end + 1 - size[t]
                ok = after[s].get(t)
                if ok or ok is None and self.fits(last[base + s], t):
                    last.append(t)
                    after.append(pairs[t])
                    at += 1
        if base + at < len(data):
            raise ValueError(f"no token for byte {data[base + at]}")

    def walk(self, last: list[int], e: int) -> list[int]:
        out, size = [], self.size
        while e:
            out.append(last[e])
            e -= size[last[e]]
        return out[::-1]

    # --- many pieces at once ---

    def prepare(self) -> None:
        """The rank table as arrays: sizes, the longest token that ends each token (-1: none),
        all courses laid end to end, and the rank of each pair that makes a token."""
        v = self.vocab = len(self.size)
        size, shorter = np.array(self.size), np.full(v, -1, np.int32)
        first, ranks, heads, tails, closed, pairs = np.zeros(v, np.int64), [], [], [], np.zeros(v, bool), {}
        get = self.ranks.get
        for t, i in self.ranks.items():
            shorter[i] = next((x for x in (get(t[k:]) for k in range(1, len(t))) if x is not None), -1)
            for k in range(1, len(t)):
                x, y = get(t[:k]), get(t[k:])
                if x is not None and y is not None:
                    pairs[x * v + y] = i
            closed[i], r, h, e = self.course(i)
            first[i] = len(ranks)
            ranks += r
            heads += [self.ranks[x] for x in h]
            tails += [self.ranks[x] for x in e]
        self.courses.clear()
        keys = np.sort(np.fromiter(pairs, np.int64, len(pairs)))
        self.tables = {"size": size, "shorter": shorter, "first": first, "ranks": np.array(ranks), "heads": np.array(heads), "tails": np.array(tails),
                       "closed": closed, "pairs": keys, "made": np.array([pairs[k] for k in keys.tolist()]),
                       "asked": np.full(PLACES, -1, np.int64), "told": np.zeros(PLACES, bool)}

    def fit_all(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``fits`` of many pairs: all pairs of courses are followed a step at a time."""
        t, v = self.tables, self.vocab
        known = t["closed"][token].copy()
        live = np.flatnonzero(known & (before != BEGIN))
        i, j = t["first"][before[live]], t["first"][token[live]]
        while len(live):
            a, b, key = t["ranks"][i], t["ranks"][j], t["tails"][i] * v + t["heads"][j]
            at = np.minimum(np.searchsorted(t["pairs"], key), len(t["pairs"]) - 1)
            across = np.where(t["pairs"][at] == key, t["made"][at], NEVER)
            bad = (across < a) & (across <= b)
            known[live[bad]] = False
            on = ~bad & ((a != NEVER) | (b != NEVER))
            left = a <= b
            i, j, live = (i + left)[on], (j + ~left)[on], live[on]
        return known

    @staticmethod
    def place(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (PLACES - 1)

    def fit(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``fit_all`` behind a cache of fixed size: a pair has one place, which a later pair may take."""
        asked, told = self.tables["asked"], self.tables["told"]
        key = (before.astype(np.int64) + 1) * self.vocab + token
        place = self.place(key)
        known = told[place]
        miss = np.flatnonzero(asked[place] != key)
        if len(miss):
            new, at = np.unique(key[miss], return_inverse=True)
            fits = self.fit_all(new // self.vocab - 1, new % self.vocab)
            known[miss] = fits[at]
            place = self.place(new)
            _, only = np.unique(place, return_index=True)
            asked[place[only]], told[place[only]] = new[only], fits[only]
        return known

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short pieces, one behind the other, and how many each has.

        The array ``last`` of ``Prefixes`` is filled for all pieces at once, a
        prefix length at a time: of the tokens that end the prefix, the longest
        first, the one that fits behind what stands before it.
        """
        if not self.tables:
            self.prepare()
        t = self.tables
        size, by = np.array([len(p) for p in pieces]), np.argsort([-len(p) for p in pieces], kind="stable")
        start = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        # a mark that is no byte parts the pieces; the first token told at each end is the longest
        told = np.fromiter(chain.from_iterable(self.automaton.iter("\u0100".join(p.decode("latin-1") for p in pieces))), np.int64).reshape(-1, 2)
        longest = np.full(int((size + 1).sum()), -1, np.int64)
        new = np.concatenate([[True], told[1:, 0] != told[:-1, 0]]) if len(told) else np.zeros(0, bool)
        longest[told[new, 0]] = told[new, 1]
        last = np.full((len(pieces), int(size.max(initial=0)) + 1), BEGIN, np.int32)
        rows = np.searchsorted(-size[by], -np.arange(last.shape[1]), side="right")      # pieces of each length or more
        for e in range(1, last.shape[1]):
            row = by[:rows[e]]
            token = longest[start[row] + e - 1]
            while len(row):
                if (token < 0).any():
                    raise ValueError("no token for a byte")
                ok = self.fit(last[row, e - t["size"][token]], token)
                last[row[ok], e] = token[ok]
                row, token = row[~ok], t["shorter"][token[~ok]]
        at, row, n, back = size.copy(), np.flatnonzero(size > 0), np.zeros(len(pieces), np.int64), []
        while len(row):
            token = last[row, at[row]]
            back.append((row, n[row].copy(), token))
            n[row] += 1
            at[row] -= t["size"][token]
            row = row[at[row] > 0]
        ids, ends = np.zeros(int(n.sum()), np.int32), np.cumsum(n)
        for row, k, token in back:
            ids[ends[row] - 1 - k] = token
        return ids, n

    def forget(self) -> None:
        self.slots: dict[str, int] = defaultdict()
        self.slots.default_factory = self.slots.__len__
        self.first, self.flat, self.held = np.zeros(1, np.int64), np.zeros(0, np.int32), 0

    def learn(self, pieces: list[str]) -> None:
        """Remember the ids of new matches of the pattern; one that is a token as a whole is that token."""
        data = [p.encode() for p in pieces]
        self.held += sum(map(len, data))
        told: list = [None] * len(data)
        many = []
        for k, d in enumerate(data):
            whole = self.ranks.get(d)
            if whole is not None:
                told[k] = [whole]
            elif len(d) > SHORT:
                last = [BEGIN]
                self.extend(d, last)
                told[k] = self.walk(last, len(d))
            else:
                many.append(k)
        for s in range(0, len(many), TOGETHER):
            some = many[s:s + TOGETHER]
            ids, n = self.encode_pieces([data[k] for k in some])
            ends = np.cumsum(n).tolist()
            ids = ids.tolist()
            for k, i, j in zip(some, [0, *ends], ends):
                told[k] = ids[i:j]
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum([len(x) for x in told])])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(told), np.int32)])

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and where each text's ids end."""
        if len(self.slots) > MEMO or self.held > MEMO_BYTES:
            self.forget()
        known, slots, split = len(self.slots), self.slots, [self.pattern.findall(t) for t in texts]
        found = np.fromiter(map(slots.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        if len(slots) > known:
            self.learn(list(islice(slots, known, None)))
        n = self.first[found + 1] - self.first[found]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.first[found] - upto[:-1], n) + np.arange(upto[-1])]
        return ids, upto[np.cumsum([len(p) for p in split], dtype=np.int64)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_texts([text])[0]


class Decoder:
    """Bytes of ids: the tokens' bytes laid end to end, and where each begins."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        token = {i: t for t, i in ranks.items()}
        for i, t in token.items():
            self.size[i] = len(t)
        self.start = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.data = np.frombuffer(b"".join(token.get(i, b"") for i in range(len(self.size))), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and how many have come before each id and in all."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id that the table lacks")
        upto = np.concatenate([[0], np.cumsum(self.size[ids])])
        return self.data[np.repeat(self.start[ids] - upto[:-1], self.size[ids]) + np.arange(upto[-1])], upto


#: What ``encode`` can add, and its type.
OUTPUTS = {"ids": ArrayType(IntegerType()), "n_tokens": LongType(), "ids_sha256": StringType(), "decoded_sha256": StringType(), "round_trip": BooleanType()}


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", out: str = "ids",
           keep: list[str] | None = None, outputs: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Add ``out`` (array<int>): ids of the whole text, each match of ``pattern``
    encoded by itself, without special tokens.

    ``outputs`` names what is added, in order: ``ids`` (under the name ``out``),
    ``n_tokens``, ``ids_sha256`` (hex digest of the decimal ids, joined by commas),
    and of the ids decoded again ``decoded_sha256`` (hex digest) and ``round_trip``
    (whether they are the text's bytes).  All come from one pass over the text, so
    a text goes through one Python step.

    Null and empty texts give no ids.  Repeated rows are encoded each; rows do
    not meet, so there is no shuffle.  Texts are encoded whole, so the longest one
    sets a task's memory; what a worker remembers is bounded in entries and bytes.
    The rank table (bounded by its file) is broadcast.  ``keep`` names the columns
    that pass through (default: all); an input with one of the added names is refused.
    """
    keep = docs.columns if keep is None else keep
    added = [out if o == "ids" else o for o in outputs]
    own_columns(docs.select(*[docs[f"`{c}`"] for c in keep]), added)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    d = docs.toDF(*names.values()).select(*dict.fromkeys([*(names[c] for c in keep), names[text_col]]))
    at, n = d.columns.index(names[text_col]), len(keep)
    schema = StructType([*(d.schema[names[c]] for c in keep), *(StructField(f"out {o}", OUTPUTS[o]) for o in outputs)])
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks})

    def told(part: pa.RecordBatch, texts: list[str], box: dict) -> pa.RecordBatch:
        ids, ends = box["bpe"].encode_texts(texts)
        starts = np.concatenate([[0], ends])
        new = {"ids": lambda: pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids)), "n_tokens": lambda: pa.array(np.diff(starts))}
        if "ids_sha256" in outputs:
            names = box["names"]
            new["ids_sha256"] = lambda: pa.array([hashlib.sha256(",".join(map(names.__getitem__, ids[i:j].tolist())).encode()).hexdigest()
                                                  for i, j in pairwise(starts.tolist())], pa.string())
        if {"decoded_sha256", "round_trip"} & set(outputs):
            data, upto = box["decoder"].decode(ids)
            decoded = [data[i:j].tobytes() for i, j in pairwise(upto[starts].tolist())]
            new["decoded_sha256"] = lambda: pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())
            new["round_trip"] = lambda: pa.array([x == t.encode() for x, t in zip(decoded, texts)], pa.bool_())
        return pa.RecordBatch.from_arrays([*part.columns[:n], *(new[o]() for o in outputs)], names=schema.names)

    def run(batches):
        box = shared.value                  # a worker keeps this, and so what the encoder has memorised, for its next task
        if "bpe" not in box:
            box["bpe"], box["decoder"] = ByteBPE(box["ranks"], pattern), Decoder(box["ranks"])
            box["names"] = list(map(str, range(len(box["decoder"].size))))
        for b in batches:
            start, held, size = 0, [], 0
            for i, t in enumerate(b.column(at)):
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size >= BATCH_CHARS or i == b.num_rows - 1:
                    yield told(b.slice(start, len(held)), held, box)
                    start, held, size = i + 1, [], 0
    return d.mapInArrow(run, schema).toDF(*keep, *added)


def decode(rows: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary): the bytes of the ids' tokens, joined.  Null ids give
    no bytes; an id that the table lacks raises."""
    own_columns(rows, [out])
    names = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    d = rows.toDF(*names.values())
    at = rows.columns.index(ids_col)
    schema = StructType([*d.schema.fields, StructField("out", BinaryType())])
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        decoder = Decoder(shared.value)
        for b in batches:
            n = np.array([len(x) if x.is_valid else 0 for x in b.column(at)], np.int64)
            data, upto = decoder.decode(b.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            ends = upto[np.concatenate([[0], np.cumsum(n)])].tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([data[i:j].tobytes() for i, j in pairwise(ends)], pa.binary())], names=schema.names)
    return d.mapInArrow(run, schema).toDF(*rows.columns, out)
