"""A12 + C7 + L22: a request stream scored with stored models against a snapshot that moves."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import monitoring as L
from ..operators import requests as R
from ..operators.models import load_model
from .streams import scratch_path


def score_stream(requests: DataFrame, snapshot: Callable[[], DataFrame], store: str, regressor: str, classifier: str,
                 reference: DataFrame, feats: list[str], tag: str, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run the stream to the end of its input; (answers, drift per batch and feature).

    Every micro-batch reads the units' snapshot and the newest models anew, so a model
    saved or a panel rewritten between batches is used from the next one on; the
    versions used stand in the answers.  The drift compares a batch's features with
    ``reference`` (feature, ref_mean, ref_std).  A batch owns its folder and
    overwrites it when it is retried.  ``base`` resumes an earlier run.
    """
    spark = requests.sparkSession
    base = base or scratch_path(spark, tag)
    out, drift = os.path.join(base, "answers"), os.path.join(base, "drift")

    def sink(batch: DataFrame, batch_id: int) -> None:
        reg, cls = (load_model(spark, store, n) for n in (regressor, classifier))
        snap = snapshot().cache()
        rows = R.answer(R.request_features(batch, snap), reg, cls) \
                .withColumns({"regressor_version": F.lit(reg.version), "classifier_version": F.lit(cls.version)})
        path = os.path.join(out, f"batch_id={batch_id}")
        rows.write.mode("overwrite").parquet(path)
        snap.unpersist()
        stats = L.feature_stats(spark.read.parquet(path).withColumn("_batch", F.lit(batch_id)), feats, "_batch").drop("_batch")
        L.drift_score(stats, reference).write.mode("overwrite").parquet(os.path.join(drift, f"batch_id={batch_id}"))

    q = requests.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    return tuple(spark.read.option("basePath", p).parquet(p) for p in (out, drift))
