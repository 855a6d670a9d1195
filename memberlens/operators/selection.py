"""Model selection in which all candidates advance together.

A grid of k-means starts, of mixtures or of logistic regressions is fitted by
passes over the rows: a pass takes the parameters of every candidate, returns
partial sums per task, Spark adds them up, and the driver gets one row of sums
per candidate and component, whatever the number of rows.  So a grid costs as
many jobs as its slowest candidate has iterations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import metrics as M
from . import ml as ML

#: Rows from which the k-means starts are drawn (the smallest hashes of the key).
START_ROWS = 1024
#: Largest number of folds x grid values of ``logit_grid``: the driver holds their parameters.
MAX_CANDIDATES = 2000
#: Rows of a piece that is held beside all candidates.
PIECE = 4096


def _sums(data: DataFrame, part: Callable, ids: list[str], width: int) -> dict[tuple, np.ndarray]:
    """Add up ``part(pdf piece) -> [(ids..., vector of width)]`` over all rows: ids -> vector."""
    schema = ", ".join(f"{c} int" for c in ids) + ", v array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple, np.ndarray] = {}
        for p in batches:
            for s in range(0, len(p), PIECE):
                for *i, v in part(p.iloc[s:s + PIECE]):
                    total[tuple(i)] = total.get(tuple(i), 0.0) + v
        if total:
            yield pd.DataFrame([(*i, v) for i, v in total.items()], columns=[*ids, "v"])
    added = data.mapInPandas(run, schema).groupBy(*ids).agg(F.array(*[F.sum(F.col("v")[i]) for i in range(width)]).alias("v"))
    return {tuple(r[c] for c in ids): np.array(r["v"]) for r in added.collect()}


# ----------------------------------------------------------------------- J8 / J9 / J9b
def _starts(x: np.ndarray, k: int, n: int, seed: int) -> list[np.ndarray]:
    """``n`` starts of ``k`` rows, each drawn with chance in proportion to its squared
    distance from those before it; fewer rows than k: none."""
    out = []
    for i in range(n if len(x) >= k else 0):
        rng = np.random.default_rng([seed, k, i])
        c = x[[rng.integers(len(x))]]
        while len(c) < k:
            d = ((x[:, None] - c) ** 2).sum(2).min(1)
            c = np.vstack([c, x[rng.choice(len(x), p=d / d.sum()) if d.sum() > 0 else rng.integers(len(x))]])
        out.append(c)
    return out


def _vectors(p: pd.DataFrame) -> np.ndarray:
    return np.stack(p["x"].to_numpy())


def kmeans_grid(data: DataFrame, starts: dict[tuple[int, int], np.ndarray], max_iter: int = 300) -> dict:
    """Lloyd's rounds of every (k, start) on ``data`` (column ``x``) at once.
    Returns (k, start) -> (centroids, inertia); an empty cluster keeps its centroid."""
    centres, inertia = dict(starts), {}
    open_ = set(centres)
    d = next(iter(centres.values())).shape[1] if centres else 0
    for _ in range(max_iter):
        if not open_:
            break
        asked = {c: centres[c] for c in open_}

        def part(p):
            x = _vectors(p)
            for (k, s), c in asked.items():
                sq = ((x[:, None] - c) ** 2).sum(2)
                own = sq.argmin(1)
                for j in np.unique(own):
                    at = own == j
                    yield k, s, int(j), np.concatenate([[at.sum(), sq[at, j].sum()], x[at].sum(0)])
        got = _sums(data, part, ["k", "s", "j"], d + 2)
        for c in sorted(open_):
            new = centres[c].copy()
            for j in range(c[0]):
                v = got.get((*c, j))
                if v is not None:
                    new[j] = v[2:] / v[0]
            inertia[c] = sum(got[(*c, j)][1] for j in range(c[0]) if (*c, j) in got)
            if np.allclose(new, centres[c], rtol=0, atol=1e-10):
                open_.discard(c)
            centres[c] = new
    return {c: (centres[c], inertia[c]) for c in centres}


def mixture_grid(data: DataFrame, n: int, centres: dict[tuple[int, int], np.ndarray], max_iter: int = 100,
                 tol: float = 1e-3, reg: float = 1e-6) -> dict:
    """EM of full-covariance mixtures for every (k, start) at once, from the
    cells of ``centres``.  Returns (k, start) -> (weights, means, covariances,
    log-likelihood); a candidate stops when its mean log-likelihood gains under ``tol``."""
    d = next(iter(centres.values())).shape[1] if centres else 0
    model: dict = {c: None for c in centres}
    before: dict = {c: -np.inf for c in centres}
    done, open_ = {}, set(centres)
    for _ in range(max_iter + 2):
        if not open_:
            break
        asked = {c: (centres[c], model[c]) for c in open_}

        def part(p):
            x = _vectors(p)
            for (k, s), (cells, m) in asked.items():
                if m is None:
                    r, ll = np.eye(k)[((x[:, None] - cells) ** 2).sum(2).argmin(1)], 0.0
                else:
                    logs = np.empty((len(x), k))
                    for j, (w, mu, cov) in enumerate(zip(*m)):
                        low = np.linalg.cholesky(cov)
                        z = np.linalg.solve(low, (x - mu).T)
                        logs[:, j] = np.log(w) - 0.5 * (d * np.log(2 * np.pi) + (z ** 2).sum(0)) - np.log(np.diag(low)).sum()
                    top = logs.max(1, keepdims=True)
                    lse = top + np.log(np.exp(logs - top).sum(1, keepdims=True))
                    r, ll = np.exp(logs - lse), float(lse.sum())
                for j in range(k):
                    yield k, s, j, np.concatenate([[ll if j == 0 else 0.0, r[:, j].sum()], r[:, j] @ x, ((r[:, j, None] * x).T @ x).ravel()])
        got = _sums(data, part, ["k", "s", "j"], 2 + d + d * d)
        for c in sorted(open_):
            ll = got[(*c, 0)][0]
            if model[c] is not None:
                if ll - before[c] < tol * n:              # the parameters that gave ll
                    done[c] = (*model[c], ll)
                    open_.discard(c)
                    continue
                before[c] = ll
            w, mu, cov = [], [], []
            for j in range(c[0]):
                v = got[(*c, j)]
                nj = v[1] + 10 * np.finfo(float).eps
                m = v[2:2 + d] / nj
                w.append(nj / n)
                mu.append(m)
                cov.append(v[2 + d:].reshape(d, d) / nj - np.outer(m, m) + reg * np.eye(d))
            model[c] = (np.array(w) / sum(w), np.array(mu), np.array(cov))
            done[c] = (*model[c], ll)
    return done


def k_selection(df: DataFrame, key: str, feats: list[str], ks: list[int], n_init: int = 10, seed: int = 42) -> DataFrame:
    """J8 + J9b + J10 + J11: per k the best of ``n_init`` k-means starts (inertia,
    Euclidean silhouette, Davies-Bouldin) and of ``n_init`` mixtures (log-likelihood,
    BIC, AIC), and the picks: largest silhouette, smallest BIC (ties: smaller k).

    ``feats`` are scaled and not null, ``key`` is unique.  A k without as many
    rows gives no row; fewer filled clusters than two give a silhouette and
    a Davies-Bouldin index of null.  The exact silhouette costs the square of the rows.
    """
    spark = df.sparkSession
    data = cut_lineage(df.select(F.col(key).alias("key"), F.array(*[F.col(c).cast("double") for c in feats]).alias("x")))
    n, d = data.count(), len(feats)
    first = np.array([r["x"] for r in data.orderBy(F.xxhash64("key"), "key").limit(START_ROWS).collect()])
    starts = {(k, i): c for k in ks for i, c in enumerate(_starts(first, k, n_init, seed) if k <= n else [])}
    fits = kmeans_grid(data, starts)
    mixtures = mixture_grid(data, n, {c: v[0] for c, v in fits.items()})
    rows = []
    for k in sorted({c[0] for c in fits}):
        centres, inertia = fits[min((c for c in fits if c[0] == k), key=lambda c: (fits[c][1], c[1]))]
        sq = [F.aggregate(F.zip_with("x", F.array(*map(F.lit, map(float, c))), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v) for c in centres]
        lab = data.withColumn("_d", F.array(*sq)).withColumn("label", F.expr("cast(array_position(_d, array_min(_d)) - 1 as int)")).drop("_d")
        filled = lab.select("label").distinct().count()
        sil = db = None
        if filled > 1:
            sil = ML.silhouette_exact(lab, "key", "x", "label").agg(F.avg("silhouette")).first()[0]
            db = ML.davies_bouldin(lab, "x", "label").first()["davies_bouldin"]
        ll = max(mixtures[c][3] for c in mixtures if c[0] == k)
        params = k * d + k * d * (d + 1) / 2 + k - 1
        rows.append((k, float(inertia), filled, sil, db, float(ll), float(-2 * ll + params * np.log(n)), float(-2 * ll + 2 * params)))
    known = [r for r in rows if r[3] is not None]
    best_km = max(known, key=lambda r: (r[3], -r[0]))[0] if known else None
    best_gm = min(rows, key=lambda r: (r[6], r[0]))[0] if rows else None
    return spark.createDataFrame([(*r, r[0] == best_km, r[0] == best_gm) for r in rows],
                                 "k int, inertia double, n_clusters int, silhouette double, davies_bouldin double, log_likelihood double, "
                                 "bic double, aic double, best_kmeans boolean, best_mixture boolean")


# ----------------------------------------------------------------------- J23 / J24 for the logit
def logit_grid(df: DataFrame, key: str, feats: list[str], y: str, fold: str, cs: list[float], max_iter: int = 100,
               tol: float = 1e-8) -> DataFrame:
    """J5 + J23 + J24: out-of-fold (``key``, ``fold``, C, label, p1, pred) of balanced L2
    logistic regressions for every C, all folds x C fitted together by Newton's method.

    Scaler and class weights come from a fold's training rows only (totals minus
    the fold's own sums).  The objective is the sum of weighted losses plus
    |w|^2 / (2 C), the intercept free; a step that does not lower it is halved.
    Features and labels (0 / 1) are not null.  A fold without which one class is
    empty raises, and so do more than MAX_CANDIDATES folds x C.
    """
    d = len(feats)
    data = cut_lineage(df.select(F.col(key).alias("key"), F.col(fold).cast("int").alias("fold"), F.col(y).cast("int").alias("y"),
                                 F.array(*[F.col(c).cast("double") for c in feats]).alias("x")))
    per = data.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1"),
                                   F.array(*[F.sum(F.col("x")[i]) for i in range(d)]).alias("s")).limit(MAX_CANDIDATES + 1).collect()
    if len(per) * len(cs) > MAX_CANDIDATES:
        raise ValueError(f"{len(per)} folds x {len(cs)} values are more than {MAX_CANDIDATES} candidates")
    n, n1, s = sum(r["n"] for r in per), sum(r["n1"] for r in per), sum((np.array(r["s"]) for r in per), np.zeros(d))
    train = {r["fold"]: (n - r["n"], n1 - r["n1"], (s - np.array(r["s"])) / max(n - r["n"], 1)) for r in per}
    if any(t[1] == 0 or t[1] == t[0] for t in train.values()):
        raise ValueError("a fold's training rows lack a class")
    means = {f: t[2] for f, t in train.items()}

    def spread(p):                                        # squared deviations from each fold's own training mean
        x, f = _vectors(p), p["fold"].to_numpy()
        for g, m in means.items():
            yield g, ((x[f != g] - m) ** 2).sum(0)
    dev = _sums(data, spread, ["f"], d) if per else {}
    prepared = {}
    for f, (m, m1, mean) in train.items():
        std = np.sqrt(dev[(f,)] / m)
        prepared[f] = (mean, np.where(std > 0, std, 1.0), m / (2 * (m - m1)), m / (2 * m1))
    theta = {(f, i): np.zeros(d + 1) for f in train for i in range(len(cs))}
    kept: dict = {}                                       # candidate -> (theta, loss, Newton step, its length)
    open_ = set(theta)
    for _ in range(max_iter):
        if not open_:
            break
        asked = {c: theta[c] for c in open_}

        def part(p):
            x, f, t = _vectors(p), p["fold"].to_numpy(), p["y"].to_numpy(dtype=float)
            for (g, i), w in asked.items():
                at = f != g
                mean, std, w0, w1 = prepared[g]
                z = np.column_stack([np.ones(at.sum()), (x[at] - mean) / std])
                m, ty = z @ w, t[at]
                wt, pr = np.where(ty == 1, w1, w0), 1 / (1 + np.exp(-np.clip(m, -700, 700)))
                loss = (wt * (np.logaddexp(0, m) - ty * m)).sum()
                yield g, i, np.concatenate([[loss], z.T @ (wt * (pr - ty)), ((z * (wt * pr * (1 - pr))[:, None]).T @ z).ravel()])
        got = _sums(data, part, ["f", "i"], 1 + (d + 1) + (d + 1) ** 2)
        for c in sorted(open_):
            v, w = got[c], theta[c]
            ridge = np.r_[0.0, np.full(d, 1 / cs[c[1]])]
            loss = v[0] + 0.5 * (ridge * w * w).sum()
            if c in kept and loss > kept[c][1] + 1e-12 * abs(kept[c][1]):
                w0, l0, step, length = kept[c]
                theta[c], kept[c] = w0 + step * length / 2, (w0, l0, step, length / 2)
                if length < 1e-10:
                    theta[c] = w0
                    open_.discard(c)
                continue
            grad = v[1:d + 2] + ridge * w
            hess = v[d + 2:].reshape(d + 1, d + 1) + np.diag(ridge)
            step = -np.linalg.lstsq(hess, grad, rcond=None)[0]
            if np.abs(step).max() < tol:
                open_.discard(c)
            else:
                theta[c], kept[c] = w + step, (w, loss, step, 1.0)
    if open_:
        raise RuntimeError(f"{len(open_)} candidates did not settle in {max_iter} rounds")

    def score(batches):
        for p in batches:
            for s_ in range(0, len(p), PIECE):
                q = p.iloc[s_:s_ + PIECE]
                x, f = _vectors(q), q["fold"].to_numpy()
                for i, C in enumerate(cs):
                    m = np.empty(len(q))
                    for g in np.unique(f):
                        mean, std, _, _ = prepared[g]
                        at, w = f == g, theta[(g, i)]
                        m[at] = w[0] + ((x[at] - mean) / std) @ w[1:]
                    p1 = 1 / (1 + np.exp(-np.clip(m, -700, 700)))
                    yield pd.DataFrame({"key": q["key"].to_numpy(), "fold": f, "C": float(C), "label": q["y"].to_numpy(), "p1": p1, "pred": (p1 > 0.5).astype("int32")})
    kind = data.schema["key"].dataType.simpleString()
    return data.mapInPandas(score, f"key {kind}, fold int, C double, label int, p1 double, pred int").withColumnRenamed("key", key)


def grid_metrics(oof: DataFrame, by: str = "C") -> DataFrame:
    """Metrics per grid value after pooling all folds' rows, and the best pick
    (largest F1, ties: smaller value); AUC for the pick only."""
    def n(cond):
        return F.count_if(cond).cast("double")
    tp, fp = n((F.col("label") == 1) & (F.col("pred") == 1)), n((F.col("label") == 0) & (F.col("pred") == 1))
    fn = n((F.col("label") == 1) & (F.col("pred") == 0))

    def ratio(a, b):
        return F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))
    m = cut_lineage(oof.groupBy(by).agg(F.count(F.lit(1)).alias("n"), (n(F.col("label") == F.col("pred")) / F.count(F.lit(1))).alias("accuracy"),
                                        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1")))
    best = m.orderBy(F.col("f1").desc(), by).first()
    if best is None:
        return m.withColumns({"best": F.lit(False), "auc": F.lit(None).cast("double")})
    area = M.auc(oof.where(F.col(by) == best[by]).select("label", F.col("p1").alias("score"))).first()["auc"]
    return m.withColumn("best", F.col(by) == best[by]).withColumn("auc", F.when(F.col("best"), F.lit(area)))
