"""Toxicity grades by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from .common import cut, own_columns

#: Labelled rows of each grade that the fit may see (the smallest id hashes).
SAMPLE_ROWS = 3000
#: Hashed feature space, and how many features the model keeps.
HASH_SPACE, FEATURES = 1 << 20, 1000
#: Word beginnings that are features beside the word itself.
PREFIXES = (4, 5, 6)
PUNCTUATION = ".,;:!?\"'()[]{}|*%$&#<>/\\-_=+~`^@"
#: Words whose features a Python worker remembers before it starts anew.
MEMO = 500_000


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself and its beginnings."""
    parts = {"w" + word, *(f"p{word[:k]}" for k in PREFIXES if len(word) >= k)}
    return tuple(sorted({zlib.crc32(p.encode()) % HASH_SPACE for p in parts}))


def words_of(text: str | None) -> set[str]:
    return {w.strip(PUNCTUATION) for w in set((text or "").lower().split())} - {""}


def fit_ordinal(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, grades: int, penalty: float = 1e-4,
                steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of P(grade > k) = sigmoid(x w - t_k), t_0 < t_1 < ...

    One weight vector serves all thresholds.  The thresholds are the first one
    plus positive steps (exp), so they stay in order.  Minimises the mean
    negative log-likelihood of the grades plus ``penalty`` |w|^2 / 2 by
    Nesterov's accelerated gradient with a backtracking step.
    """
    k, n = grades - 1, len(grade)
    weight = weight / weight.sum()
    tail = [float(np.clip((weight * (grade > j)).sum(), 1e-4, 1 - 1e-4)) for j in range(k)]
    t0 = [-np.log(p / (1 - p)) for p in tail]
    theta = np.r_[np.zeros(x.shape[1]), t0[0], [np.log(max(1e-2, t0[j] - t0[j - 1])) for j in range(1, k)]]

    def cuts(theta):
        return np.cumsum(np.r_[theta[-k], np.exp(np.clip(theta[len(theta) - k + 1:], -20, 20))])

    def loss(theta):
        w, t = theta[:-k], cuts(theta)
        z = (x @ w.astype(x.dtype)).astype(float)
        above = 1 / (1 + np.exp(-np.clip(z[:, None] - t, -30, 30)))              # P(grade > j)
        edge = np.c_[np.ones(n), above, np.zeros(n)]
        at = np.arange(n)
        p = np.maximum(edge[at, grade] - edge[at, grade + 1], 1e-12)
        value = -(weight * np.log(p)).sum() + penalty * (w @ w) / 2
        slope = np.c_[np.zeros(n), above * (1 - above), np.zeros(n)]             # derivative of an edge by z
        dz = -weight * (slope[at, grade] - slope[at, grade + 1]) / p
        dt = np.zeros(k)
        for j in range(k):
            dt[j] = (-weight / p * (-slope[:, j + 1]) * ((grade == j + 1) * 1.0 - (grade == j))).sum()
        raw = np.array([dt[j:].sum() * (1.0 if j == 0 else np.exp(np.clip(theta[len(theta) - k + j], -20, 20))) for j in range(k)])
        return value, np.r_[dz.astype(x.dtype) @ x + penalty * w, raw]

    y, before, step, momentum = theta.copy(), theta.copy(), 1.0, 1.0
    for _ in range(steps):
        value, grad = loss(y)
        while True:
            new = y - step * grad
            if loss(new)[0] <= value - step * (grad @ grad) / 2 + 1e-12 or step < 1e-8:
                break
            step /= 2
        if np.abs(new - before).max() < 1e-7:
            break
        nxt = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        y = new + (momentum - 1) / nxt * (new - before)
        before, momentum, step = new, nxt, step * 1.5
    return before[:-k], cuts(before)


def severity(z: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(expected grade, probability of a grade above 0) for scores ``z``."""
    above = 1 / (1 + np.exp(-np.clip(np.asarray(z)[:, None] - cuts, -30, 30)))
    return above.sum(1), above[:, 0]


def best_threshold(p: np.ndarray, positive: np.ndarray, weight: np.ndarray) -> float:
    """The probability from which on rows count as positive: the middle of the gap
    in ``p`` at which the weighted F1 is largest."""
    order = np.argsort(-p, kind="stable")
    p, hit = p[order], (weight * positive)[order].cumsum()
    f1 = 2 * hit / (weight[order].cumsum() + hit[-1])
    ends = np.flatnonzero(np.r_[p[1:] != p[:-1], True])
    at = ends[np.argmax(f1[ends])]
    return float((p[at] + (p[at + 1] if at + 1 < len(p) else 0.0)) / 2)


def split_grades(present: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 from labels 0, 1: a positive row is grade 2 when its share of
    features that only positive rows have is above their median."""
    high = np.zeros(HASH_SPACE, np.int64)
    low = np.zeros(HASH_SPACE, np.int64)
    for f, y in zip(present, label):
        (high if y else low)[f] += 1
    telling = (high >= 5) & (low == 0)
    share = np.array([telling[f].mean() if len(f) else 0.0 for f in present])
    middle = np.median(share[label == 1]) if (label == 1).any() else 0.0
    return np.where(label == 1, 1 + (share > middle), 0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 grades: int | None = None, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES, where=None) -> dict:
    """Ordinal model from labelled rows (those that ``where`` selects, default all).

    ``label_col`` holds grades 0 .. ``grades`` - 1; with ``grades`` None it holds
    0 and 1 and the positive rows are split in two grades by how much of their
    text is telling (``split_grades``).  Of each label value the ``sample_rows``
    rows with the smallest id hash are used, a fixed bound at any input size, and
    weighted back to their share.  Whole texts give the features; the
    ``features`` with the largest chi-square are kept.  ``decision`` is the
    probability of a grade above 0 with the best F1 on the sample.  Labels of one value only
    (or none) give a constant model.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = (known if where is None else known.filter(where)).select(F.col(id_col).alias("lid"), F.col(label_col).cast("int").alias("label"))
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(total) < 2:
        return {"constant": float(next(iter(total), 0)), "decision": 0.5}
    chosen = None
    for c in sorted(total):
        some = known.filter(F.col("label") == c).orderBy(F.xxhash64("lid"), "lid").limit(sample_rows)
        chosen = some if chosen is None else chosen.union(some)
    texts = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                .join(F.broadcast(chosen), F.col("id") == F.col("lid")).select("text", "label")
                .orderBy(F.xxhash64("text")).limit(sample_rows * len(total)))
    schema = StructType([texts.schema["label"], StructField("f", BinaryType())])

    def run(batches):
        for b in batches:
            found = [np.array(sorted({f for w in words_of(t) for f in word_features(w)}), np.int32).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.binary())], names=["label", "f"])
    rows = texts.mapInArrow(run, schema).collect()
    if len({r["label"] for r in rows}) < 2:
        return {"constant": float(rows[0]["label"]) if rows else 0.0, "decision": 0.5}
    present = [np.frombuffer(r["f"], np.int32) for r in rows]
    label = np.array([r["label"] for r in rows])
    grade = split_grades(present, label) if grades is None else label
    n_grades = int(grades or max(2, grade.max() + 1))
    weight = np.array([total[c] / (label == c).sum() for c in label])

    counts = [np.bincount(np.concatenate([f for f, g in zip(present, grade) if hit(g)] or [np.zeros(0, np.int32)]), minlength=HASH_SPACE).astype(float)
              for hit in ((lambda g: g > 0), (lambda g: g == 0))]
    n1, n0 = (grade > 0).sum(), (grade == 0).sum()
    a, b = counts
    seen = a + b
    chi = (a * n0 - b * n1) ** 2 / np.maximum(seen * (n1 + n0 - seen), 1.0) * (seen >= 3)
    chosen_ids = np.sort(np.argsort(-chi, kind="stable")[:features])
    column = np.full(HASH_SPACE, -1)
    column[chosen_ids] = np.arange(len(chosen_ids))
    x = np.zeros((len(rows), len(chosen_ids)), np.float32)
    for i, f in enumerate(present):
        at = column[f]
        x[i, at[at >= 0]] = 1
    w, t = fit_ordinal(x, grade, weight, n_grades)
    decision = best_threshold(severity(x @ w, t)[1], grade > 0, weight)
    return {"weights": {int(i): float(v) for i, v in zip(chosen_ids, w)}, "cuts": t, "decision": decision}


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``severity`` (expected grade) and ``p_toxic`` (probability of a grade
    above 0) to the columns ``keep`` (default: all).

    Features are the distinct words of the whole text and their beginnings.  Null
    and empty texts have no features and get the thresholds' own values.  Rows do
    not meet: no shuffle, and repeated rows score alike.
    """
    own_columns(docs, ["severity", "p_toxic"])
    keep = docs.columns if keep is None else keep
    if "constant" in model:
        c = model["constant"]
        return docs.select(*[F.col(f"`{k}`") for k in keep], F.lit(c).alias("severity"), F.lit(min(c, 1.0)).alias("p_toxic"))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    d = docs.toDF(*names.values()).select(*dict.fromkeys([*(names[c] for c in keep), names[text_col]]))
    at, n = d.columns.index(names[text_col]), len(keep)
    schema = StructType([*(d.schema[names[c]] for c in keep), StructField("severity", DoubleType()), StructField("p_toxic", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast({"weights": model["weights"], "cuts": model["cuts"], "memo": {}})

    def run(batches):
        box = shared.value                  # a worker keeps this, and so its words, for its next task
        weights, memo = box["weights"], box["memo"]

        def score(text):
            found = set()
            for w in words_of(text):
                f = memo.get(w)
                if f is None:
                    if len(memo) >= MEMO:
                        memo.clear()
                    f = tuple(i for i in word_features(w) if i in weights)
                    if len(w) <= 64:
                        memo[w] = f
                found.update(f)
            return sum(weights[i] for i in sorted(found))
        for b in batches:
            s, p = severity(np.array([score(t.as_py()) for t in b.column(at)], float), box["cuts"])
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(s), pa.array(p)], names=schema.names)
    return d.mapInArrow(run, schema).toDF(*keep, "severity", "p_toxic")
