"""Evaluation of predicted probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mailtriage import constants as K

RANK_BUCKETS = 256


def classify(p: Column, threshold: float = K.MODEL_THRESHOLD) -> Column:
    return F.when(p >= threshold, 1).otherwise(0)


def confusion(scored: DataFrame, threshold: float = K.MODEL_THRESHOLD, p: str = "p", label: str = "label") -> DataFrame:
    hit, true = classify(F.col(p), threshold) == 1, F.col(label) == 1
    return scored.agg(
        F.count_if(hit & true).alias("true_positives"), F.count_if(hit & ~true).alias("false_positives"),
        F.count_if(~hit & true).alias("false_negatives"), F.count_if(~hit & ~true).alias("true_negatives"))


def rates(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 (4 places; an empty denominator gives 0)."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")

    def ratio(a: Column, b: Column) -> Column:
        return F.bround(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 4)

    return counts.select(
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        fp.alias("false_positives"), fn.alias("false_negatives"))


def roc_auc(scored: DataFrame, p: str = "p", label: str = "label", buckets: int = RANK_BUCKETS) -> DataFrame:
    """Exact area under the ROC curve with ties, as one row ``roc_auc``.

    Rows shrink to one per distinct score.  Scores are cut at approximate quantiles, so
    the running count of negatives needs a window only inside each slice; slice offsets
    add the rest.  Any cut gives the exact result.
    """
    hist = scored.groupBy(F.col(p).alias("p")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = hist.agg(F.percentile_approx("p", steps, 10_000)).scalar()
    sliced = hist.withColumn("_c", cuts).withColumn("_b", F.size(F.filter("_c", lambda c: c < F.col("p")))).drop("_c")
    # at most `buckets` rows
    totals = sliced.groupBy("_b").agg(F.sum("neg").alias("_n"))
    offsets = totals.select("_b", F.coalesce(F.sum("_n").over(
        W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    inside = W.partitionBy("_b").orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    ranked = sliced.withColumn("_i", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(F.broadcast(offsets), "_b")
    wins = F.sum(F.col("pos") * (F.col("_o") + F.col("_i") + F.col("neg") / 2))
    return ranked.agg(F.bround(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")), 4).alias("roc_auc"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """label, n, weight = total / (classes * n)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    every = W.partitionBy()  # one row per class
    return counts.withColumn("weight", F.sum("n").over(every) / (F.count("*").over(every) * F.col("n")))


def scaling(df: DataFrame, columns: list[str] = K.NUMERIC_COLUMNS) -> DataFrame:
    """feature, mean, std (population; 0 becomes 1) in one pass."""
    wide = df.agg(*[f(c).alias(f"{c}__{k}") for c in columns for k, f in (("mean", F.avg), ("std", F.stddev_pop))])
    rows = F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
        F.when(F.col(f"{c}__std") == 0, 1.0).otherwise(F.col(f"{c}__std")).alias("std")) for c in columns])
    return wide.select(F.inline(rows))
