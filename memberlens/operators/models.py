"""A8 + J22: fitted models as values, a versioned store of them, and scoring.

A :class:`Model` holds what a fit found (coefficients, mixture, trees: bounded by
the model, never by the data), so it can be written, read in another session and
applied to any frame, batch or stream.  Linear, logistic and mixture models are
scored by column arithmetic inside whole-stage codegen; a forest by a vectorised
function over its packed trees; a Spark ML model by its own ``transform``.

Layout of the store, under a folder that all executors share::

    <root>/<name>/versions/      one row a version, appended after its data
    <root>/<name>/v<n>-<uuid>/   arrays as Parquet, or a saved Spark ML model

A version exists once its row does: a save that dies leaves only an unread folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from ..sources.tables import read_optional
from .anomaly import forest_fit, forest_scores
from .ml import gmm_em, pop_stats, ridge_fit

VERSION_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("version", T.IntegerType()), T.StructField("kind", T.StringType()),
                               T.StructField("features", T.ArrayType(T.StringType())),
                               T.StructField("params", T.MapType(T.StringType(), T.StringType())), T.StructField("path", T.StringType())])


@dataclass
class Model:
    """``kind`` is one of ``linear``, ``logit``, ``mixture``, ``forest``, ``spark_ml``."""
    kind: str
    features: list[str]
    arrays: dict[str, np.ndarray] = field(default_factory=dict)
    params: dict[str, str] = field(default_factory=dict)
    ml: object = None
    version: int | None = None


# ----------------------------------------------------------------------- fits
def fit_ridge(df: DataFrame, feats: list[str], y: str, alpha: float, clamp_min: float | None = 0.0) -> Model:
    """Ridge on scaled features; predictions below ``clamp_min`` become it."""
    got = {r["feature"]: r["coefficient"] for r in ridge_fit(df, feats, y, alpha).collect()}
    params = {"alpha": repr(alpha)} | ({} if clamp_min is None else {"clamp_min": repr(float(clamp_min))})
    return Model("linear", list(feats), {"coef": np.array([got[f] for f in feats]), "intercept": np.array([got["(intercept)"]])}, params)


def fit_logit(df: DataFrame, feats: list[str], y: str, C: float = 1.0, max_iter: int = 50, tol: float = 1e-10,
              threshold: float = 0.5) -> Model:
    """Balanced L2 logistic regression by Newton's method, one JVM aggregate a step.

    The objective is the sum of weighted losses plus |w|^2 / (2 C) on features scaled
    by their population mean and deviation, the intercept free.  A step that raises
    it is halved.  Rows with a null feature or label are left out; a label that has one class only
    raises, and so does a fit that does not settle.
    """
    d = len(feats)
    data = cut_lineage(df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(feats)], F.col(y).cast("int").alias("y")).dropna())
    cols = [f"x{i}" for i in range(d)]
    n, n1 = data.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or n1 in (0, n):
        raise ValueError(f"the label {y} has one class only")
    st = pop_stats(data, cols).first()
    mean, std = np.array([st[f"{c}__mean"] for c in cols]), np.array([st[f"{c}__std"] for c in cols])
    std = np.where(std > 0, std, 1.0)
    z = [F.lit(1.0)] + [(F.col(c) - float(mean[i])) / float(std[i]) for i, c in enumerate(cols)]
    weight = F.when(F.col("y") == 1, n / (2.0 * n1)).otherwise(n / (2.0 * (n - n1)))
    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]
    ridge = np.r_[0.0, np.full(d, 1.0 / C)]

    def step(w):
        m = sum((c * float(b) for c, b in zip(z[1:], w[1:])), F.lit(float(w[0])))
        p = 1 / (1 + F.exp(-m))
        loss = F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m))) - F.col("y") * m
        row = data.withColumns({"wt": weight, "p": p, "loss": loss}).agg(
            F.sum(F.col("wt") * F.col("loss")), *[F.sum(F.col("wt") * (F.col("p") - F.col("y")) * c) for c in z],
            *[F.sum(F.col("wt") * F.col("p") * (1 - F.col("p")) * z[i] * z[j]) for i, j in pairs]).first()
        hess = np.zeros((d + 1, d + 1))
        for (i, j), v in zip(pairs, row[d + 2:]):
            hess[i, j] = hess[j, i] = v
        loss = row[0] + 0.5 * (ridge * w * w).sum()
        return loss, -np.linalg.solve(hess + np.diag(ridge), np.array(row[1:d + 2]) + ridge * w)
    w = np.zeros(d + 1)
    loss, move = step(w)
    for _ in range(max_iter):
        if np.abs(move).max() < tol:
            break
        new, length = step(w + move), 1.0
        while new[0] > loss + 1e-12 * abs(loss) and length > 1e-8:
            length /= 2
            new = step(w + move * length)
        w, (loss, move) = w + move * length, new
    else:
        raise RuntimeError(f"the fit did not settle in {max_iter} steps")
    coef = w[1:] / std
    return Model("logit", list(feats), {"coef": coef, "intercept": np.array([w[0] - (coef * mean).sum()])},
                 {"C": repr(C), "threshold": repr(threshold)})


def fit_mixture(df: DataFrame, feats: list[str], k: int, cov: str = "diag", seed: int = 42) -> Model:
    """Gaussian mixture by EM."""
    _, info = gmm_em(df, feats, k, cov=cov, seed=seed)
    return Model("mixture", list(feats), {c: info[c] for c in ("weights", "means", "covariances")}, {"cov": cov})


def fit_forest(df: DataFrame, id_col: str, feats: list[str], trees: int = 100, max_samples: int = 256, contamination: float = 0.15,
               seed: int = 42) -> Model:
    """Isolation forest with its scaler and threshold."""
    packed, psi, offset, mean, std = forest_fit(df, id_col, feats, trees, max_samples, contamination, seed)
    nodes = np.vstack([np.column_stack([np.full(len(t[0]), i), *t]) for i, t in enumerate(packed)])
    return Model("forest", list(feats), {"nodes": nodes, "mean": mean, "std": std},
                 {"psi": str(psi), "offset": repr(offset)})


def ml_model(fitted, feats: list[str]) -> Model:
    """Any fitted Spark ML model that can be written (pipelines of forests, boosting, k-means, PCA)."""
    return Model("spark_ml", list(feats), ml=fitted)


# ----------------------------------------------------------------------- store
def versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of a model's versions (none, if it was never saved)."""
    return read_optional(spark, f"{root}/{name}/versions", VERSION_SCHEMA)


def save_model(spark: SparkSession, model: Model, root: str, name: str) -> int:
    """Write ``model`` as the next version of ``name``; returns its number.

    Writers of one name take turns; ``load_model`` refuses a number given twice.
    """
    version = (versions(spark, root, name).agg(F.max("version")).first()[0] or 0) + 1
    path = f"{root}/{name}/v{version}-{uuid.uuid4().hex[:12]}"
    if model.ml is not None:
        model.ml.write().save(path)
    else:
        spark.createDataFrame([(k, list(map(int, a.shape)), a.ravel().astype(float).tolist()) for k, a in model.arrays.items()],
                              "array string, shape array<int>, numbers array<double>").coalesce(1).write.parquet(path)
    spark.createDataFrame([(name, version, model.kind, model.features, model.params, path)], VERSION_SCHEMA) \
         .coalesce(1).write.mode("append").parquet(f"{root}/{name}/versions")
    return version


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None) -> Model:
    """The given version of ``name``, or the newest; ``LookupError`` if there is none."""
    rows = versions(spark, root, name)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    found = rows.orderBy(F.col("version").desc()).limit(2).collect()
    if not found:
        raise LookupError(f"no version {version or ''} of {name} in {root}")
    if len(found) == 2 and found[0]["version"] == found[1]["version"]:
        raise ValueError(f"version {found[0]['version']} of {name} was saved twice")
    r = found[0]
    model = Model(r["kind"], list(r["features"]), params=dict(r["params"] or {}), version=r["version"])
    if model.kind == "spark_ml":
        model.ml = DefaultParamsReader.loadParamsInstance(r["path"], spark)
    else:
        model.arrays = {a["array"]: np.array(a["numbers"]).reshape(a["shape"]) for a in spark.read.parquet(r["path"]).collect()}
    return model


# ----------------------------------------------------------------------- scoring
def _linear(model: Model) -> Column:
    return sum((F.col(f).cast("double") * float(c) for f, c in zip(model.features, model.arrays["coef"])), F.lit(float(model.arrays["intercept"][0])))


def linear_value(model: Model) -> Column:
    """The prediction of a linear model; null if a feature is."""
    m = _linear(model)
    return F.when(m.isNotNull(), F.greatest(m, F.lit(float(model.params["clamp_min"])))) if "clamp_min" in model.params else m


def logit_value(model: Model) -> Column:
    """P(class 1) of a logistic model; null if a feature is."""
    return 1 / (1 + F.exp(-_linear(model)))


def _mixture(model: Model) -> Column:
    x = [F.col(f).cast("double") for f in model.features]
    parts = []
    for w, mu, cov in zip(*(model.arrays[c] for c in ("weights", "means", "covariances"))):
        prec, logdet = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
        quad = sum((float(prec[a, b]) * (x[a] - float(mu[a])) * (x[b] - float(mu[b])) for a in range(len(x)) for b in range(len(x)) if prec[a, b]),
                   F.lit(0.0))
        parts.append(float(np.log(w) - 0.5 * (len(x) * np.log(2 * np.pi) + logdet)) - 0.5 * quad)
    top = F.greatest(*parts) if len(parts) > 1 else parts[0]
    total = sum((F.exp(p - top) for p in parts), F.lit(0.0))
    return F.array(*[F.exp(p - top) / total for p in parts])


def score(model: Model, df: DataFrame) -> DataFrame:
    """``df`` with the model's columns beside its own.

    linear: ``prediction``.  logit: ``p1`` and ``prediction`` (1 above the threshold).
    mixture: ``proba`` and ``label``.  forest: ``iso_score`` and ``iso_anomaly``; a missing feature counts as
    the training mean.  Elsewhere a missing feature makes the score null.  spark_ml: what its ``transform`` adds.
    """
    if model.kind == "linear":
        return df.withColumn("prediction", linear_value(model))
    if model.kind == "logit":
        return df.withColumn("p1", logit_value(model)).withColumn("prediction", (F.col("p1") > float(model.params["threshold"])).cast("int"))
    if model.kind == "mixture":
        known = sum((F.col(f).isNull().cast("int") for f in model.features), F.lit(0)) == 0
        return df.withColumn("proba", F.when(known, _mixture(model))).withColumn("label", F.expr("array_position(proba, array_max(proba)) - 1").cast("int"))
    if model.kind == "forest":
        nodes, mean, std = (model.arrays[c] for c in ("nodes", "mean", "std"))
        packed = [tuple(t[:, c] if c == 2 else t[:, c].astype(int) for c in range(1, 6)) for _, t in pd.DataFrame(nodes).groupby(0)
                  for t in [t.to_numpy()]]
        psi, offset = int(model.params["psi"]), float(model.params["offset"])

        def run(pieces):
            for cols in pieces:
                x = (np.column_stack([c.to_numpy(dtype=float) for c in cols]) - mean) / std
                yield pd.Series(forest_scores(np.nan_to_num(x, nan=0.0), packed, psi) - offset)
        value = F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)
        return df.withColumn("iso_score", value(*[F.col(f).cast("double") for f in model.features])) \
                 .withColumn("iso_anomaly", (F.col("iso_score") < 0).cast("int"))
    if model.kind == "spark_ml":
        return model.ml.transform(df)
    raise ValueError(f"unknown kind of model: {model.kind}")
