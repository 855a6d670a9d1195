"""Word-piece token counts by a linear longest-match automaton."""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from .common import own_columns

#: Words whose counts a Python worker remembers before it starts anew.
MEMO = 500_000


class LongestMatch:
    """Counts of greedy longest-match word pieces in time linear in the word.

    ``first`` are the pieces that may begin a word, ``inner`` those that may
    continue it (both bytes).  The trie holds both, the inner ones below a root
    of their own.  Where the trie has no way on, the failure link of a node leads
    to the node of what is left after the longest pieces have been popped, and
    ``pops`` has precomputed how many these are; so no byte is read twice and no
    piece is built.
    """

    def __init__(self, first, inner):
        self.step: dict[int, int] = {}            # node * 256 + byte -> node
        ends, depth_first = set(), 2              # nodes: 0 root, 1 root of the inner pieces
        n = depth_first
        for root, pieces in ((0, first), (1, inner)):
            for p in pieces:
                u = root
                for c in p:
                    v = self.step.get(u * 256 + c)
                    if v is None:
                        v = self.step[u * 256 + c] = n
                        n += 1
                    u = v
                if p:
                    ends.add(u)
        below: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for k, v in self.step.items():
            below[k // 256].append((k % 256, v))
        self.fail, self.pops = [-1] * n, [0] * n  # fail -1: no piece fits here
        todo = deque((u, c, v) for u in (0, 1) for c, v in below[u])
        while todo:
            u, c, v = todo.popleft()
            if v in ends:
                self.fail[v], self.pops[v] = 1, 1
            else:
                z, count = self.fail[u], self.pops[u]
                while z >= 0 and (z * 256 + c) not in self.step:
                    count += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.pops[v] = self.step[z * 256 + c], count
            todo.extend((v, d, w) for d, w in below[v])
        self.memo: dict[bytes, int] = {}

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 (the unknown token) when some part has no piece; 0 for no bytes."""
        if not word:
            return 0
        step, fail, pops = self.step, self.fail, self.pops
        u, n = 0, 0
        for c in word:
            v = step.get(u * 256 + c)
            while v is None:
                if fail[u] < 0:
                    return 1
                n += pops[u]
                u = fail[u]
                v = step.get(u * 256 + c)
            u = v
        while u != 1:                             # pop what the last node still holds
            if fail[u] < 0:
                return 1
            n += pops[u]
            u = fail[u]
        return n

    def total(self, text: str) -> tuple[int, int]:
        """Words and pieces of a text; words are split at space and \\x09-\\x0D."""
        memo, words, n = self.memo, text.encode().split(), 0
        for w in words:
            k = memo.get(w)
            if k is None:
                k = self.count(w)
                if len(w) <= 64:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[w] = k
            n += k
        return len(words), n


def pieces_of(ranks) -> tuple[set[bytes], set[bytes]]:
    """Word pieces from a byte-level rank table: a token that begins with a space
    begins words, every other token continues them; each byte may do both."""
    single = {bytes([b]) for b in range(256)}
    first = {t[1:] for t in ranks if t[:1] == b" " and len(t) > 1} | single
    return first, {t for t in ranks if t[:1] != b" "} | single


def token_counts(docs: DataFrame, first, inner, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``n_words`` and ``n_tokens`` (bigint) to the columns ``keep`` (default: all).

    Null and empty texts count 0.  A row's counts depend on its text alone, so
    there is no shuffle, repeated rows get equal counts, and an empty table gives
    an empty result.  The vocabulary is broadcast; a
    word of any length is read once.
    """
    own_columns(docs, ["n_words", "n_tokens"])
    keep = docs.columns if keep is None else keep
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    d = docs.toDF(*names.values()).select(*dict.fromkeys([*(names[c] for c in keep), names[text_col]]))
    at, n = d.columns.index(names[text_col]), len(keep)
    schema = StructType([*(d.schema[names[c]] for c in keep), StructField("n_words", LongType()), StructField("n_tokens", LongType())])
    shared = docs.sparkSession.sparkContext.broadcast({"pieces": (first, inner)})

    def run(batches):
        box = shared.value                  # a worker keeps this, and so the automaton, for its next task
        box["match"] = box.get("match") or LongestMatch(*box["pieces"])
        total = box["match"].total
        for b in batches:
            both = [total(t.as_py() or "") for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array([x[0] for x in both], pa.int64()),
                                              pa.array([x[1] for x in both], pa.int64())], names=schema.names)
    return d.mapInArrow(run, schema).toDF(*keep, "n_words", "n_tokens")
