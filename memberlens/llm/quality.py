"""Quality classifier by compression with dictionaries of good and bad text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import cut, own_columns

#: Labelled rows of each class that the fit may see (the smallest id hashes).
SAMPLE_ROWS = 3000
#: Bytes of each dictionary, and of the slice that one text gives to it (more where texts are few).
DICT_BYTES, SLICE_BYTES = 1 << 19, 2000
#: Texts are compressed in blocks of so many bytes, so that a long text cannot
#: become its own dictionary and long and short texts compare.
BLOCK, LEVEL = 2048, 3


def training_rows(id_col: str = "doc_id", folds: int = 5):
    """True for rows outside the held-out fold: crc32 of the id as text, mod ``folds``, is not 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != 0, F.lit(True))


def compressor(dictionary: bytes, level: int = LEVEL):
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_checksum=False,
                                    write_dict_id=False).compress


def difference(text: str | None, good, bad) -> float:
    """(compressed size with the bad dictionary - with the good one) / size; 0 for no text."""
    data = (text or "").encode()
    return sum(len(bad(data[i:i + BLOCK])) - len(good(data[i:i + BLOCK])) for i in range(0, len(data), BLOCK)) / (len(data) + 1)


def calibrate(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit of ``label`` on ``x`` (Newton steps)."""
    mean, sd = np.average(x, weights=weight), x.std() or 1.0
    design, w = np.c_[(x - mean) / sd, np.ones(len(x))], np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (weight * (p - label)) + 1e-3 * w
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0] / sd), float(w[1] - w[0] * mean / sd)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                sample_rows: int = SAMPLE_ROWS, dict_bytes: int = DICT_BYTES, slice_bytes: int = SLICE_BYTES) -> dict:
    """Model (two dictionaries, slope, offset) from labelled rows outside the held-out fold.

    Of each class the ``sample_rows`` rows with the smallest id hash are taken, so
    the sample has a fixed bound at any input size; its ids are broadcast and one
    scan fetches the texts.  Half of the distinct sampled texts (by hash)
    makes the dictionaries, one slice per text; the others calibrate, weighted
    back to the classes' shares among all labelled rows.  Without rows of both
    classes the model scores everything by the share of class 1 (0.5 if there
    are no labels at all).
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & training_rows(id_col)) \
                  .select(F.col(id_col).alias("lid"), F.col(label_col).cast("int").alias("label"))
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(total) < 2:
        share = (total.get(1, 0) / sum(total.values())) if total else 0.5
        return {"share": share}
    chosen = [known.filter(F.col("label") == c).orderBy(F.xxhash64("lid"), "lid").limit(sample_rows) for c in (0, 1)]
    h = F.xxhash64("text")
    sample = cut(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                 .join(F.broadcast(chosen[0].union(chosen[1])), F.col("id") == F.col("lid"))
                 .select("text", "label", h.alias("h")).dropDuplicates(["h"]).orderBy("h").limit(2 * sample_rows))
    for_dict, dicts = F.pmod(F.col("h"), F.lit(2)) == 0, []
    for c in (0, 1):
        pool = sample.filter(for_dict & (F.col("label") == c))
        width = max(slice_bytes, dict_bytes // max(1, pool.count()))
        start = F.pmod(F.col("h"), F.greatest(F.lit(1), F.length("text") - width)).cast("int") + 1
        slices = pool.orderBy(F.col("h").desc()).limit(dict_bytes // slice_bytes + 1).select(F.substring("text", start, F.lit(width)).alias("s"))
        dicts.append("\n".join(r["s"] for r in slices.collect()).encode()[:dict_bytes])
    if min(map(len, dicts)) < 8:
        return {"share": total[1] / sum(total.values())}
    model = {"bad": dicts[0], "good": dicts[1]}
    seen = _with_difference(sample.filter(~for_dict).select("text", "label"), "text", ["label"], model).toPandas()
    weight = seen["label"].map({c: total[c] / max(1, (seen["label"] == c).sum()) for c in (0, 1)}).to_numpy(float)
    model["slope"], model["offset"] = calibrate(seen["x"].to_numpy(), seen["label"].to_numpy(float), weight * len(seen) / weight.sum())
    return model


def _with_difference(docs: DataFrame, text_col: str, keep: list[str], model: dict) -> DataFrame:
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    d = docs.toDF(*names.values()).select(*dict.fromkeys([*(names[c] for c in keep), names[text_col]]))
    at, n = d.columns.index(names[text_col]), len(keep)
    schema = StructType([*(d.schema[names[c]] for c in keep), StructField("x", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast({"dicts": (model["good"], model["bad"])})

    def run(batches):
        box = shared.value                  # a worker keeps this, and so the digested dictionaries, for its next task
        good, bad = box["compress"] = box.get("compress") or tuple(compressor(d) for d in box["dicts"])
        for b in batches:
            x = pa.array([difference(t.as_py(), good, bad) for t in b.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:n], x], names=schema.names)
    return d.mapInArrow(run, schema).toDF(*keep, "x")


def score_quality(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """Add ``out`` (double, 0 to 1; higher: label 1 likelier) to the columns ``keep`` (default: all).

    Whole texts are compressed, block by block, with either dictionary.  Null and
    empty texts have difference 0 and get that point's calibrated score.  Rows do
    not meet: no shuffle, and repeated rows score alike.  A name in ``keep`` that
    equals ``out`` is refused.
    """
    keep = docs.columns if keep is None else keep
    own_columns(docs.select(*[F.col(f"`{c}`") for c in keep]), [out])
    if "share" in model:
        return docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(float(model["share"])).alias(out))
    d = _with_difference(docs, text_col, keep, model)
    z = F.lit(model["slope"]) * d[d.columns[-1]] + F.lit(model["offset"])
    return d.select(*[F.col(f"`{c}`") for c in keep], (1 / (1 + F.exp(-z))).alias(out))
