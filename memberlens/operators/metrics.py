"""Regression and classification metrics as aggregates.

All metrics are one partial aggregate (or a score-grouped prefix sum for the
ROC family), so they run on any number of rows without collecting them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import one_of, with_scalars

MACHINE_EPS = 2.220446049250313e-16


def regression_metric_aggs(y: str, p: str):
    """n, MAE, MSE, RMSE, MAPE(%), R^2 (NULL when n <= 1 or var(y) = 0)."""
    e = F.col(y).cast("double") - F.col(p).cast("double")
    yy = F.col(y).cast("double")
    n = F.count(F.lit(1))
    mse = F.avg(e * e)
    return [n.alias("n"),
            F.avg(F.abs(e)).alias("mae"),
            mse.alias("mse"),
            F.sqrt(mse).alias("rmse"),
            (F.avg(F.abs(e) / F.greatest(F.abs(yy + 1e-9), F.lit(MACHINE_EPS))) * 100.0).alias("mape"),
            F.when(n > 1, 1 - mse / F.nullif(F.var_pop(yy), F.lit(0.0))).alias("r2")]


def regression_metrics(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    """Error metrics overall or per group."""
    if by:
        return df.groupBy(*by).agg(*regression_metric_aggs(y, p))
    return df.agg(*regression_metric_aggs(y, p))


def classification_metrics(df: DataFrame, y: str = "label", p: str = "pred") -> DataFrame:
    """Accuracy, precision, recall, F1 for the positive class 1
    (zero division -> 0)."""
    tp = F.count_if((F.col(y) == 1) & (F.col(p) == 1))
    fp = F.count_if((F.col(y) == 0) & (F.col(p) == 1))
    fn = F.count_if((F.col(y) == 1) & (F.col(p) == 0))
    agg = df.agg(F.count(F.lit(1)).alias("n"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
                 F.count_if(F.col(y) == F.col(p)).alias("correct"))
    prec = F.coalesce(F.col("tp") / F.nullif((F.col("tp") + F.col("fp")).cast("double"), F.lit(0.0)), F.lit(0.0))
    rec = F.coalesce(F.col("tp") / F.nullif((F.col("tp") + F.col("fn")).cast("double"), F.lit(0.0)), F.lit(0.0))
    return agg.select(
        "n", "tp", "fp", "fn",
        (F.col("correct") / F.nullif(F.col("n").cast("double"), F.lit(0.0))).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        F.coalesce(2 * prec * rec / F.nullif(prec + rec, F.lit(0.0)), F.lit(0.0)).alias("f1"))


def confusion(df: DataFrame, y: str = "label", p: str = "pred", classes=(0, 1)) -> DataFrame:
    """Confusion matrix, rows = actual, one column per predicted class; a
    prediction outside ``classes`` fails the query."""
    return (df.withColumn(p, one_of(p, classes)).groupBy(F.col(y).alias("actual")).pivot(p, list(classes))
            .agg(F.count(F.lit(1))).na.fill(0)
            .select("actual", *[F.col(str(c)).cast("bigint").alias(f"pred_{c}") for c in classes]))


def class_report(df: DataFrame, y: str = "label", p: str = "pred") -> DataFrame:
    """Per-class precision/recall/F1/support plus macro and weighted rows."""
    counts = df.groupBy(y, p).agg(F.count(F.lit(1)).alias("c"))
    # each (actual, predicted) cell counts towards both of its classes: no join
    per = (counts.select(F.explode(F.array_distinct(F.array(F.col(y), F.col(p)))).alias("cls"), y, p, "c")
           .groupBy("cls")
           .agg(F.sum(F.when((F.col(y) == F.col("cls")) & (F.col(p) == F.col("cls")), F.col("c")).otherwise(0)).alias("tp"),
                F.sum(F.when(F.col(p) == F.col("cls"), F.col("c")).otherwise(0)).alias("pred_n"),
                F.sum(F.when(F.col(y) == F.col("cls"), F.col("c")).otherwise(0)).alias("support")))
    prec = F.coalesce(F.col("tp") / F.nullif(F.col("pred_n").cast("double"), F.lit(0.0)), F.lit(0.0))
    rec = F.coalesce(F.col("tp") / F.nullif(F.col("support").cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = per.select(F.col("cls").cast("string").alias("label"), prec.alias("precision"),
                      rec.alias("recall"), F.col("support").cast("bigint").alias("support"))
    rows = rows.withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall")
                                            / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)))
    avgs = rows.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").cast("bigint").alias("s"))
    macro = avgs.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                        F.col("mr").alias("recall"), F.col("s").alias("support"), F.col("mf").alias("f1"))
    weighted = avgs.select(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                           F.col("wr").alias("recall"), F.col("s").alias("support"), F.col("wf").alias("f1"))
    return rows.unionByName(macro).unionByName(weighted)


def score_buckets(scores: DataFrame, score: str, n_buckets: int = 256) -> DataFrame:
    """Monotone bucket id per score from a bounded quantile sketch.

    Used to split a global prefix sum into per-bucket windows (no window over
    all rows in one partition).
    """
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = scores.agg(F.array_distinct(F.percentile_approx(score, probs, 10000)).alias("b"))
    j = with_scalars(scores, bounds.select(F.col("b").alias("bounds")), "_bb")
    return j.withColumn("_bucket", F.size(F.filter("_bb.bounds", lambda b: b < F.col(score)))).drop("_bb")


def prefix_sums(df: DataFrame, order: str, cols: list[str], descending: bool = False,
                partition: list[str] | None = None, bucket: str = "_bucket") -> DataFrame:
    """Exact running sums of ``cols`` in ``order`` (inclusive), distributed.

    Two levels: a window inside (partition, bucket), plus the running total of
    earlier buckets from a per-bucket summary (#buckets rows per partition).
    ``bucket`` must be monotone in ``order``.
    """
    part = partition or []
    o = F.col(order).desc() if descending else F.col(order).asc()
    ob = F.col(bucket).desc() if descending else F.col(bucket).asc()
    w_in = Window.partitionBy(*part, bucket).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    within = df.select("*", *[F.sum(c).over(w_in).alias(f"_in_{c}") for c in cols])
    btot = df.groupBy(*part, bucket).agg(*[F.sum(c).alias(f"_bt_{c}") for c in cols])
    w_b = Window.partitionBy(*part).orderBy(ob).rowsBetween(Window.unboundedPreceding, -1)
    before = btot.select(*part, bucket, *[F.coalesce(F.sum(f"_bt_{c}").over(w_b), F.lit(0)).alias(f"_bf_{c}")
                                          for c in cols])
    j = within.join(before, [*part, bucket])
    return j.select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_bf_{c}")).alias(f"cum_{c}") for c in cols])


def roc_curve(df: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """J20d: (threshold, fpr, tpr) at every distinct score, descending."""
    g = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    tot = df.agg(F.count_if(F.col(y) == 1).alias("P"), F.count_if(F.col(y) != 1).alias("N"))
    cum = prefix_sums(score_buckets(g, "threshold"), "threshold", ["pos", "neg"], descending=True)
    cum = with_scalars(cum, tot)
    return cum.select("threshold",
                      (F.col("cum_neg") / F.nullif(F.col("_s.N").cast("double"), F.lit(0.0))).alias("fpr"),
                      (F.col("cum_pos") / F.nullif(F.col("_s.P").cast("double"), F.lit(0.0))).alias("tpr"))


def auc(df: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """J20e: ROC-AUC by rank sum, ties count 1/2 (Mann-Whitney)."""
    g = df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    cum = prefix_sums(score_buckets(g, "s"), "s", ["neg"], descending=False)
    contrib = F.col("pos") * (F.col("cum_neg") - F.col("neg")) + 0.5 * F.col("pos") * F.col("neg")
    return cum.agg((F.sum(contrib) / F.nullif((F.sum("pos") * F.sum("neg")).cast("double"), F.lit(0.0)))
                   .alias("auc"),
                   F.sum("pos").cast("bigint").alias("n_pos"), F.sum("neg").cast("bigint").alias("n_neg"))


def class_weights(df: DataFrame, y: str = "label") -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    c = df.groupBy(y).agg(F.count(F.lit(1)).alias("n_c"))
    tot = c.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    return with_scalars(c, tot).select(y, "n_c", (F.col("_s.n") / (F.col("_s.k") * F.col("n_c"))).alias("weight"))
