"""Anomaly scores and the 3-method vote.

kNN for LOF is exact without emitting all pairs: points are put on a grid of
cell width r over the leading dimensions; every neighbour within distance r
lies in an adjacent cell, so a point that finds k candidates within r has its
exact k nearest neighbours.  Unresolved points retry with a 4x radius.  Isolation
Forest trains each tree on a bounded subsample (<= 256 rows) in one
``applyInPandas`` group and scores rows with the broadcast forest.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import with_scalars
from ..session import cut_lineage
from .ml import pop_scale, pop_stats
from .quantile import exact_quantile


# Distances are ranked after rounding to 9 digits so that ties (duplicates,
# symmetric neighbours) break by neighbour id, not by last-bit float noise.
DIST_DIGITS = 9


def vec(cols: list[str]):
    return F.array(*[F.col(c).cast("double") for c in cols])


def euclid(a, b):
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0.0),
                              lambda acc, t: acc + t))


# ----------------------------------------------------------------------- J16 / J17 / J18
def zscore(df: DataFrame, feats: list[str], thr: float = 2.0) -> DataFrame:
    """Max |z| over features (population std), flag > thr."""
    z = pop_scale(df, feats, suffix="__z")
    zmax = F.greatest(*[F.abs(F.col(c + "__z")) for c in feats]) if len(feats) > 1 else F.abs(F.col(feats[0] + "__z"))
    return z.select(*df.columns, zmax.alias("zscore_max")) \
            .withColumn("zscore_anomaly", (F.col("zscore_max") > thr).cast("int"))


def consensus(df: DataFrame, flags: list[str], min_votes: int = 2) -> DataFrame:
    """Vote sum of 0/1 flags, consensus when >= min_votes."""
    s = F.lit(0)
    for f in flags:
        s = s + F.coalesce(F.col(f), F.lit(0)).cast("int")
    return df.withColumn("vote_sum", s).withColumn("consensus", (F.col("vote_sum") >= min_votes).cast("int"))


def normalise(df: DataFrame, cols: dict[str, bool]) -> DataFrame:
    """Min-max to [0, 1] with a 1e-9 guard; ``cols`` maps column ->
    higher_is_anomalous (False flips the direction)."""
    mm = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols], *[F.max(c).alias(f"{c}__hi") for c in cols])
    j = with_scalars(df, mm, "_mm")
    for c, up in cols.items():
        lo, hi = F.col(f"_mm.{c}__lo"), F.col(f"_mm.{c}__hi")
        num = (F.col(c) - lo) if up else (hi - F.col(c))
        j = j.withColumn(f"{c}_norm", num / (hi - lo + 1e-9))
    return j.drop("_mm")


# ----------------------------------------------------------------------- kNN / LOF
def knn(df: DataFrame, id_col: str, v: str, k: int, r0: float | None = None, grid_dims: int = 3,
        max_rounds: int = 40, growth: float = 4.0) -> DataFrame:
    """Exact k nearest neighbours: (id, nbr, dist, rank) with rank 1..k.

    Ties at equal distance are broken by neighbour id.  Each round only
    handles the still-unresolved points; the radius grows by ``growth``.
    Equal vectors are one point of the search, so a crowd of copies costs
    nothing.  Vectors with a NULL or NaN have no neighbours and are not
    returned; should any other be left after ``max_rounds``, this raises.
    The grid uses the ``grid_dims`` dimensions with the most distinct values
    (a sketch count), so discrete features do not make coarse, hot cells;
    exactness holds for any subset of dimensions.
    """
    d = df.select(F.size(v).alias("d")).first()["d"]
    m = min(grid_dims, d)
    if m < d:
        nd = df.agg(*[F.approx_count_distinct(F.col(v)[i]).alias(f"c{i}") for i in range(d)]).first()
        dims = sorted(range(d), key=lambda i: (-nd[f"c{i}"], i))[:m]
    else:
        dims = list(range(d))
    offsets = [list(o) for o in itertools.product((-1, 0, 1), repeat=m)]
    whole = F.col(v).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x))
    pts = df.where(whole).select(F.col(id_col).alias("id"), F.col(v).alias("v")).cache()
    total = pts.count()
    if total <= k:
        raise ValueError("need more than k points")
    # equal vectors are searched once, with the k + 1 smallest ids that any list can need
    first = pts.withColumn("_o", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("_o") <= k + 1)
    vecs = cut_lineage(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    pending = vecs.select("v")
    parts = []
    if r0 is None:  # spacing of k points in the unit-variance cube
        r0 = 2.0 * math.sqrt(d) * (k / total) ** (1.0 / d)
    r = r0
    for _ in range(max_rounds):
        cell = F.array(*[F.floor(F.col("v")[i] / F.lit(r)).cast("long") for i in dims])
        data = vecs.select("ids", F.col("v").alias("nv"), cell.alias("cell"))
        q = pending.select("v", cell.alias("qc"))
        q = q.select("v", F.explode(F.array(*[
            F.array(*[F.col("qc")[i] + o[i] for i in range(m)]) for o in offsets])).alias("cell"))
        cand = (q.join(data, "cell")
                .select("v", "ids", F.round(euclid(F.col("v"), F.col("nv")), DIST_DIGITS).alias("dist"))
                .where(F.col("dist") <= r).select("v", "dist", F.explode("ids").alias("nbr")))
        w = Window.partitionBy("v").orderBy("dist", "nbr")
        ranked = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k + 1)
        near = ranked.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("rank", "dist", "nbr"))).alias("near"))
        # each round is written out (reliable checkpoint): the plan of round
        # n does not carry rounds 1..n-1, and lost executors recompute one round
        parts.append(cut_lineage(near.where(F.size("near") > k)))
        pending = cut_lineage(pending.join(parts[-1].select("v"), "v", "left_anti"))
        if pending.isEmpty():
            break
        r *= growth
    else:
        raise RuntimeError(f"{pending.count()} vectors have no {k} neighbours within radius {r}")
    done = parts[0]
    for p_ in parts[1:]:
        done = done.unionByName(p_)
    others = F.slice(F.filter("near", lambda x: x["nbr"] != F.col("id")), 1, k)
    out = pts.join(done, "v").select("id", F.posexplode(others).alias("_p", "_n"))
    return out.select("id", F.col("_n.nbr").alias("nbr"), F.col("_n.dist").alias("dist"), (F.col("_p") + 1).alias("rank"))


def lof(df: DataFrame, id_col: str, feats: list[str], k: int = 3, contamination: float = 0.15,
        scale: bool = True) -> DataFrame:
    """Local Outlier Factor (Q12 spec).

    lrd = 1 / (mean reach-dist + 1e-10), reach-dist = max(k-dist(o), d);
    lof = mean lrd(o) / lrd(p); flagged when lof > its (1 - contamination)
    quantile (strict, linear interpolation), which is exact at every size.  A row
    with a NULL or NaN feature has no neighbours: its score is NULL, its flag 0.
    """
    base = pop_scale(df, feats, suffix="__z") if scale else df.select("*", *[F.col(c).alias(c + "__z") for c in feats])
    pts = base.select(F.col(id_col), vec([c + "__z" for c in feats]).alias("_v"))
    nn = knn(pts, id_col, "_v", k)
    kd = nn.where(F.col("rank") == k).select(F.col("id").alias("nbr"), F.col("dist").alias("kdist_nbr"))
    reach = nn.join(kd, "nbr").withColumn("reach", F.greatest("kdist_nbr", "dist"))

    def mean_by_rank(c):
        # k values per point, summed in neighbour-rank order: the result does
        # not depend on the order rows arrive in (values span 1e-10 .. 1e10)
        ordered = F.array_sort(F.collect_list(F.struct("rank", F.col(c).alias("x"))))
        return F.aggregate(ordered, F.lit(0.0), lambda acc, s: acc + s["x"]) / F.size(ordered)

    lrd = reach.groupBy("id").agg((1.0 / (mean_by_rank("reach") + 1e-10)).alias("lrd"))
    lrd_n = lrd.select(F.col("id").alias("nbr"), F.col("lrd").alias("lrd_nbr"))
    lofv = (nn.join(lrd_n, "nbr").groupBy("id").agg(mean_by_rank("lrd_nbr").alias("m"))
            .join(lrd, "id").select("id", (F.col("m") / F.col("lrd")).alias("lof_score")))
    lofv = cut_lineage(lofv)
    thr = exact_quantile(lofv, "lof_score", 1.0 - contamination)
    out = lofv.select(F.col("id").alias(id_col), "lof_score", (F.col("lof_score") > F.lit(thr)).cast("int").alias("lof_anomaly"))
    return df.join(out, id_col, "left").withColumn("lof_anomaly", F.coalesce("lof_anomaly", F.lit(0)))


# ----------------------------------------------------------------------- J14 isolation forest
def _c(n):
    """Average path length of an unsuccessful BST search (Liu et al. 2008)."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(X: np.ndarray, rng: np.random.Generator, limit: int):
    """One isolation tree as flat arrays (feature, threshold, left, right, size)."""
    feat, thr, left, right, size = [], [], [], [], []

    def node(idx, depth):
        i = len(feat)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= limit or len(idx) <= 1:
            return i
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.where(hi > lo)[0]
        if cand.size == 0:
            return i
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        feat[i], thr[i] = f, t
        li = node(idx[sub[:, f] < t], depth + 1)
        ri = node(idx[sub[:, f] >= t], depth + 1)
        left[i], right[i] = li, ri
        return i

    node(np.arange(len(X)), 0)
    return np.array(feat), np.array(thr), np.array(left), np.array(right), np.array(size)


def _path_length(X: np.ndarray, tree) -> np.ndarray:
    feat, thr, left, right, size = tree
    pos = np.zeros(len(X), dtype=int)
    depth = np.zeros(len(X))
    active = feat[pos] >= 0
    while active.any():
        f = feat[pos[active]]
        go_left = X[active, f] < thr[pos[active]]
        pos[active] = np.where(go_left, left[pos[active]], right[pos[active]])
        depth[active] += 1
        active = feat[pos] >= 0
    return depth + _c(size[pos])


def _forest_points(df: DataFrame, id_col: str, feats: list[str], stats: DataFrame | None = None) -> DataFrame:
    """(id, scaled features); a missing feature counts as the mean."""
    zc = [c + "__z" for c in feats]
    return pop_scale(df, feats, stats=stats, suffix="__z").select(
        F.col(id_col), *[F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")), F.lit(0.0)).alias(c) for c in zc])


def _grow_forest(pts: DataFrame, id_col: str, zc: list[str], trees: int, max_samples: int, seed: int):
    """The packed trees over cached points and their sample size."""
    n = pts.count()
    psi = int(min(max_samples, n))
    frac = min(1.0, 4.0 * psi / max(n, 1))
    # Bounded sample per tree: each row joins the trees whose hash draw falls
    # under ``frac`` (about 4 psi rows per tree), then the psi smallest hashes
    # are kept.  Only selected (row, tree) pairs are emitted.
    m = 1 << 30

    def draw(t):
        return F.pmod(F.xxhash64(F.col(id_col), t, F.lit(seed)), F.lit(m)) / float(m)
    chosen = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < F.lit(frac))
    samp = (pts.select("*", F.explode(chosen).alias("tree"))
            .withColumn("_h", F.xxhash64(F.col(id_col), F.col("tree"), F.lit(seed + 1)))
            .withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("_h", id_col)))
            .where(F.col("_r") <= psi).drop("_h", "_r"))
    limit = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed * 100003 + t)
        f, th, le, ri, sz = _grow(pdf[zc].to_numpy(dtype=float), rng, limit)
        return pd.DataFrame({"tree": t, "node": np.arange(len(f)), "feat": f, "thr": th,
                             "left": le, "right": ri, "size": sz})

    forest = samp.groupBy("tree").applyInPandas(
        grow, "tree int, node long, feat long, thr double, left long, right long, size long").toPandas()
    return [tuple(g.sort_values("node")[c].to_numpy() for c in ("feat", "thr", "left", "right", "size"))
            for _, g in forest.groupby("tree")], psi


def forest_scores(X: np.ndarray, packed: list, psi: int) -> np.ndarray:
    """0.5 - 2^(-E[h]/c(psi)) of scaled rows, before the threshold is taken off."""
    h = np.mean([_path_length(X, t) for t in packed], axis=0)
    return 0.5 - 2.0 ** (-h / float(_c(np.array([psi]))[0]))


def _score_points(pts: DataFrame, id_col: str, zc: list[str], packed: list, psi: int) -> DataFrame:
    bc = pts.sparkSession.sparkContext.broadcast(packed)

    def score(batches):
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col], "iso_score": forest_scores(pdf[zc].to_numpy(dtype=float), bc.value, psi)})
    return pts.mapInPandas(score, T.StructType([pts.schema[id_col], T.StructField("iso_score", T.DoubleType())]))


def forest_fit(df: DataFrame, id_col: str, feats: list[str], trees: int = 100, max_samples: int = 256,
               contamination: float = 0.15, seed: int = 42):
    """J14 as a fit: packed trees, sample size, threshold, and the scaler's means and deviations."""
    stats = cut_lineage(pop_stats(df, feats))
    row, zc = stats.first(), [c + "__z" for c in feats]
    pts = _forest_points(df, id_col, feats, stats).cache()
    packed, psi = _grow_forest(pts, id_col, zc, trees, max_samples, seed)
    offset = exact_quantile(cut_lineage(_score_points(pts, id_col, zc, packed, psi)), "iso_score", contamination)
    pts.unpersist()
    std = np.array([row[f"{c}__std"] or 1.0 for c in feats])
    return packed, psi, float(offset), np.array([row[f"{c}__mean"] or 0.0 for c in feats]), std


def isolation_forest(df: DataFrame, id_col: str, feats: list[str], trees: int = 100,
                     max_samples: int = 256, contamination: float = 0.15, seed: int = 42) -> DataFrame:
    """Isolation Forest (Liu et al. 2008).

    Each tree samples <= ``max_samples`` rows by hashing (row id, tree id)
    - a bounded group - and grows in ``groupBy(tree).applyInPandas``.  The
    forest (trees x <= 2*max_samples nodes) is broadcast; rows are scored by
    ``mapInPandas``.  score = 2^(-E[h]/c(psi)); decision = 0.5 - score
    shifted by its contamination quantile, anomaly when decision < 0.
    """
    zc = [c + "__z" for c in feats]
    pts = _forest_points(df, id_col, feats).cache()        # sampled, counted and scored: build once
    packed, psi = _grow_forest(pts, id_col, zc, trees, max_samples, seed)
    sc = _score_points(pts, id_col, zc, packed, psi).cache()   # (id, score): read by the threshold and the output
    off = exact_quantile(sc, "iso_score", contamination)
    sc = sc.select(id_col, (F.col("iso_score") - F.lit(off)).alias("iso_score"))
    sc = sc.withColumn("iso_anomaly", (F.col("iso_score") < 0).cast("int"))
    return df.join(sc, id_col)
