"""Periodic runs of words by internal pattern matching, and texts without their repeats."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import own_columns

#: A run has so many words at least, and so many periods.
LEAST, TIMES = 24, 3
#: Texts are searched together up to so many words; a longer text is searched by itself.
BATCH_WORDS = 1 << 18
#: Behind every place.
NOWHERE = 1 << 60

RUNS = ArrayType(StructType([StructField("start", LongType(), False), StructField("length", LongType(), False),
                             StructField("period", LongType(), False)]), False)


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each stretch, one behind the other."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())


class Suffixes:
    """Suffix order of several texts of word numbers, by prefix doubling.

    ``levels[k][i]`` names the 2**k words from i on: the first place in the
    suffix order of the suffixes that begin with them.  A stretch that its text's
    end cuts short has a name of its own.  Texts do not mix: each one's suffixes
    fill the same places of the order as its words do of the input.  ``repeated``
    has, for each level, the places whose stretch occurs again in their text, with
    the number of its occurrences.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n, sizes = len(words), np.diff(bounds)
        self.start, self.end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        rank, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        key, place, width = self.start * (int(words.max(initial=0)) + 1) + words, np.arange(n), 0
        self.levels, self.repeated = [], []
        while len(place):
            if width:
                after = place + width
                second = np.where(after < self.end[place], rank[np.minimum(after, n - 1)] + 1, 0)
                key = rank[place] * (n + 1) + second
            order = np.argsort(key)
            place, key, at = place[order], key[order], np.arange(len(order))
            new = np.concatenate([[True], key[1:] != key[:-1]])
            old = rank[place]
            block = np.concatenate([[True], old[1:] != old[:-1]])
            first = np.flatnonzero(new)
            many = np.diff(np.append(first, len(place)))
            rank[place] = old + np.repeat(first, many) - np.maximum.accumulate(np.where(block, at, 0))
            count = np.repeat(many, many)
            place = place[count > 1]
            self.levels.append(rank.astype(np.int32))
            self.repeated.append((place, count[count > 1]))
            width = 2 * width or 1
        self.rank = rank

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and from j on (i < j, in one text)."""
        end, top, i, j0, j = self.end[i], len(self.start) - 1, i.copy(), j, j.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            same = (j < end) & (level[i] == level[np.minimum(j, top)])
            i[same] += 1 << k
            j[same] += 1 << k
        return j - j0

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words before i and before j (i < j, in one text)."""
        start, i0, i, j = self.start[i], i, i.copy(), j.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            same = (i - step >= start) & (level[np.maximum(i - step, 0)] == level[np.maximum(j - step, 0)])
            i[same] -= step
            j[same] -= step
        return i0 - i


class Wavelet:
    """Wavelet matrix of a permutation of 0..n-1: for each bit, the highest first,
    how many values before each place have it clear."""

    def __init__(self, values: np.ndarray):
        self.n, self.clear = len(values), []
        self.bits = max(1, int(self.n - 1).bit_length())
        for b in range(self.bits - 1, -1, -1):
            zero = (values >> b) & 1 == 0
            self.clear.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Number of values under x at places lo..hi-1 (x <= n)."""
        total, over = np.zeros(len(lo), np.int64), x >> self.bits > 0
        width = hi - lo
        for b, clear in zip(range(self.bits - 1, -1, -1), self.clear):
            one, zl, zh = (x >> b) & 1 == 1, clear[lo], clear[hi]
            total += np.where(one, zh - zl, 0)
            lo, hi = np.where(one, clear[-1] + lo - zl, zl), np.where(one, clear[-1] + hi - zh, zh)
        return np.where(over, width, total)

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) at places lo..hi-1."""
        value = np.zeros(len(lo), np.int64)
        for b, clear in zip(range(self.bits - 1, -1, -1), self.clear):
            zl, zh = clear[lo], clear[hi]
            one = k >= zh - zl
            value += np.where(one, 1 << b, 0)
            k = np.where(one, k - (zh - zl), k)
            lo, hi = np.where(one, clear[-1] + lo - zl, zl), np.where(one, clear[-1] + hi - zh, zh)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Smallest value of x or more at places lo..hi-1; n if there is none."""
        found = np.full(len(lo), self.n, np.int64)
        k = self.below(lo, hi, x)
        some = np.flatnonzero(k < hi - lo)
        found[some] = self.nth(lo[some], hi[some], k[some])
        return found


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of texts of word numbers, by start, then period.

    Text t has the words ``bounds[t]:bounds[t + 1]``; starts count through all texts.

    Let m be the largest power of two with 2 * m > period >= m, or the smallest
    scale m0 (3 * m0 <= least) for shorter periods.  The first block of m words
    at a multiple of m inside a run occurs again one period later, still inside
    the run.  So for every block of every scale the occurrences that begin in
    its neighbouring window (m to 2 * m - 1 words on; at scale m0 also nearer) are
    asked for, as the next values of the suffix order's stretch of that block.
    One or two are candidates as they stand.  Three or more are one progression
    of some difference e < m / 2: block and occurrences lie in stretches of
    period e, and as the run shifts one such stretch to the other, the distance of
    the ends of these stretches is the only candidate.  A candidate is extended
    to both sides as far as it holds and kept if it is long enough.
    """
    if not len(words):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    order = Suffixes(words, bounds)
    smallest = max(0, int(max(least, TIMES) // TIMES).bit_length() - 1)
    blocks = []
    for k in range(smallest, len(order.levels)):
        place, count = order.repeated[k]
        on = ((place - order.start[place]) % (1 << k) == 0) & (place + (1 << k) <= order.end[place])
        blocks.append((k, place[on], count[on]))
    live = np.zeros(len(words), bool)                  # only texts with a repeated block go on
    for _, place, _ in blocks:
        live[order.start[place]] = True
    if not live.any():
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    live = live[order.start]
    shift = np.arange(len(words)) - (np.cumsum(live) - 1)      # of a live text's places, and of its suffixes' order
    by_rank = np.empty(len(words), np.int64)
    by_rank[order.rank] = np.arange(len(words))
    by_rank = by_rank[live]
    tree = Wavelet(by_rank - shift[by_rank])

    def following(place, lo, hi, x):
        """First occurrence at x or behind; far behind every word if there is none."""
        s = shift[place]
        found = tree.successor(lo - s, hi - s, np.minimum(x - s, tree.n))
        return np.where(found < tree.n, found + s, NOWHERE)
    at, by = [], []
    for k, place, count in blocks:
        m, lo = 1 << k, order.levels[k][place].astype(np.int64)
        hi = lo + count
        if k == smallest:
            near = following(place, lo, hi, place + 1)
            some = near < place + m
            at.append(place[some])
            by.append((near - place)[some])
        one = following(place, lo, hi, place + m)
        some = one < place + 2 * m
        place, lo, hi, one = place[some], lo[some], hi[some], one[some]
        two = following(place, lo, hi, one + 1)
        three = following(place, lo, hi, two + 1)
        few = three >= place + 2 * m
        at.append(place[few])
        by.append((one - place)[few])
        pair = few & (two < place + 2 * m)
        at.append(place[pair])
        by.append((two - place)[pair])
        p, o, e = place[~few], one[~few], (two - one)[~few]
        distance = (o + order.forward(o, o + e)) - (p + order.forward(p, p + e))
        some = (distance >= m) & (distance < 2 * m)
        at.append(p[some])
        by.append(distance[some])
    at, by = np.concatenate(at), np.concatenate(by)
    start = at - order.backward(at, at + by)
    length = at + by + order.forward(at, at + by) - start
    keep = length >= np.maximum(least, TIMES * by)
    start, length, by = start[keep], length[keep], by[keep]
    by_place = np.lexsort((by, length, start))         # of one stretch, the smallest period is the true one
    start, length, by = start[by_place], length[by_place], by[by_place]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, by = start[new], length[new], by[new]
    by_place = np.lexsort((by, start))
    return start[by_place], length[by_place], by[by_place]


def _search(texts: list[bytes], least: int) -> tuple[list[list[tuple]], list[str]]:
    """Runs and collapsed text of each text."""
    split = [t.split() for t in texts]                 # bytes split at just the six ASCII spaces
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in split])])
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    words = np.fromiter((numbers[w] for ws in split for w in ws), np.int64, int(bounds[-1]))
    start, length, period = find_runs(words, bounds, least)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    stays = np.cumsum(edge)[:-1] == 0
    of = np.searchsorted(bounds, start, side="right") - 1
    first = np.searchsorted(of, np.arange(len(texts) + 1))
    runs, collapsed = [], []
    for t, ws in enumerate(split):
        a, b = first[t], first[t + 1]
        runs.append(list(zip((start[a:b] - bounds[t]).tolist(), length[a:b].tolist(), period[a:b].tolist())))
        kept = [w for w, s in zip(ws, stays[bounds[t]:bounds[t + 1]].tolist()) if s] if b > a else ws
        collapsed.append(b" ".join(kept).decode())
    return runs, collapsed


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, keep: list[str] | None = None) -> DataFrame:
    """Add ``n_words`` (bigint), ``runs`` (array of start, length, period, by start, then
    period) and ``collapsed`` (string) to each row.

    Words are what stands between space, tab, newline, vertical tab, form feed and
    carriage return, numbered from 0.  A run is a stretch of at least ``least``
    words and 3 periods that no neighbouring word extends, with its smallest
    period.  ``collapsed`` has the words joined by one space, without those that
    lie in some run behind its first period.

    Null and empty texts, and texts of white space, have no words, no runs and an
    empty ``collapsed``.  Repeated rows are told each; rows do not meet, so there is
    no shuffle.  A text is searched whole, in some 300 bytes a word.  ``keep`` names
    the columns that pass through (default: all); an input with one of the added
    names is refused.
    """
    keep = docs.columns if keep is None else keep
    added = ["n_words", "runs", "collapsed"]
    own_columns(docs.select(*[docs[f"`{c}`"] for c in keep]), added)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}       # inputs may bring any names
    d = docs.toDF(*names.values()).select(*dict.fromkeys([*(names[c] for c in keep), names[text_col]]))
    at, n = d.columns.index(names[text_col]), len(keep)
    schema = StructType([*(d.schema[names[c]] for c in keep), StructField("n_words", LongType()), StructField("runs", RUNS),
                         StructField("collapsed", StringType())])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def told(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        runs, collapsed = _search(texts, least)
        return pa.RecordBatch.from_arrays(
            [*part.columns[:n], pa.array([len(t.split()) for t in texts], pa.int64()),
             pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], run_type),
             pa.array(collapsed, pa.string())], names=schema.names)

    def run(batches):
        for b in batches:
            start, held, size = 0, [], 0
            for i, t in enumerate(b.column(at)):
                text = (t.as_py() or "").encode()
                if held and size + len(text) // 4 > BATCH_WORDS:
                    yield told(b.slice(start, len(held)), held)
                    start, held, size = i, [], 0
                held.append(text)
                size += len(text) // 4                 # about its words
            if held:
                yield told(b.slice(start, len(held)), held)
    return d.mapInArrow(run, schema).toDF(*keep, *added)
