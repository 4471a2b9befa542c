"""Scores of predictions against labels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.plans.ordered import lay_out
from metricloom.plans.workspace import materialize


def class_weights(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """Balanced weights: n / (classes * n_class), one row per class; rows without a label count nowhere."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn("_classes", F.lit(1))
    classes = Window.partitionBy("_classes")
    total, kinds = F.sum("n").over(classes), F.sum("_classes").over(classes)
    return counts.select(label, "n", (total / (kinds * F.col("n"))).alias("weight"))


def prediction_summary(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """anomaly_count, total_count, anomaly_ratio (0 for no rows)."""
    anomalies = F.coalesce(F.sum((F.col(prediction) == 1).cast("int")), F.lit(0))
    total = F.count(F.lit(1))
    return df.agg(
        anomalies.alias("anomaly_count"),
        total.alias("total_count"),
        F.coalesce(F.try_divide(anomalies, total), F.lit(0.0)).alias("anomaly_ratio"),
    )


def probability_range(
    df: DataFrame, threshold: float = 0.5, probability: str = "probability", prediction: str = "prediction"
) -> DataFrame:
    """Smallest and largest probability, and rows flagged below the threshold."""
    below = (F.col(probability) < threshold) & (F.col(prediction) == 1)
    return df.agg(
        F.min(probability).alias("min_probability"),
        F.max(probability).alias("max_probability"),
        F.coalesce(F.sum(below.cast("int")), F.lit(0)).alias("n_below_threshold"),
    )


def confusion_matrix(df: DataFrame, label: str = "is_anomaly", prediction: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp."""

    def cell(actual: int, predicted: int) -> Column:
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        return F.coalesce(F.sum(hit.cast("int")), F.lit(0))

    return df.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def accuracy(df: DataFrame, label: str = "is_anomaly", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def classification_report(df: DataFrame, label: str = "is_anomaly", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support per class, accuracy, macro and weighted averages."""
    pairs = materialize(
        df.groupBy(F.col(label).cast("int").alias("a"), F.col(prediction).cast("int").alias("p")).agg(
            F.count(F.lit(1)).alias("n")
        ),
        "pairs",
    )
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
            )
        ).alias("s"),
        F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
    )
    zero = F.lit(0.0)
    per_class = sides.groupBy("s.c").agg(
        F.sum("s.support").alias("support"),
        F.sum("s.predicted").alias("predicted"),
        (F.sum("tp") / 2).alias("tp"),
    )
    per_class = per_class.withColumn("precision", F.coalesce(F.try_divide("tp", "predicted"), zero))
    per_class = per_class.withColumn("recall", F.coalesce(F.try_divide("tp", "support"), zero))
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    per_class = per_class.withColumn("f1", F.coalesce(f1, zero))
    scores = ["precision", "recall", "f1"]
    total = F.sum("support")
    macro = per_class.agg(*[F.avg(s).alias(s) for s in scores], total.alias("support"))
    weighted = per_class.agg(
        *[F.try_divide(F.sum(F.col(s) * F.col("support")), total).alias(s) for s in scores], total.alias("support")
    )
    share = F.try_divide(F.sum("tp"), total)
    overall = per_class.agg(*[share.alias(s) for s in scores], total.alias("support"))
    named = per_class.select(F.col("c").cast("string").alias("class"), *scores, "support")
    for name, rows in (("accuracy", overall), ("macro avg", macro), ("weighted avg", weighted)):
        named = named.unionByName(rows.select(F.lit(name).alias("class"), *scores, "support"))
    return named


def _thresholds(df: DataFrame, label: str, score: str, parts: int | None) -> DataFrame:
    """One row per distinct score, descending: own and cumulated positives and negatives."""
    positive = (F.col(label) == 1).cast("long")
    by_score = (
        df.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
        .withColumn("_curve", F.lit(0))
    )
    ordered = lay_out(by_score, ["_curve"], [F.col("threshold").desc()], parts)
    return ordered.running({"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}, totals=True)


def roc_curve(df: DataFrame, label: str = "is_anomaly", score: str = "probability", parts: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) for each distinct score, and the starting point at infinity."""
    points = _thresholds(df, label, score, parts).select(
        F.col("threshold").cast("double").alias("threshold"),
        F.try_divide("fp", "fp_total").alias("fpr"),
        F.try_divide("tp", "tp_total").alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def roc_auc(df: DataFrame, label: str = "is_anomaly", score: str = "probability", parts: int | None = None) -> DataFrame:
    """Area under the ROC curve by trapezoids."""
    t = _thresholds(df, label, score, parts)
    area = F.sum(F.col("neg") * (2.0 * F.col("tp") - F.col("pos")) / 2)
    pairs = F.max("tp_total").cast("double") * F.max("fp_total")
    return t.agg(F.try_divide(area, pairs).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str = "is_anomaly", score: str = "probability", parts: int | None = None) -> DataFrame:
    """(threshold, precision, recall) for each distinct score, and the anchor (1, 0) at infinity."""
    points = _thresholds(df, label, score, parts).select(
        F.col("threshold").cast("double").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "tp_total").alias("recall"),
    )
    anchor = df.sparkSession.range(1).select(
        F.lit(math.inf).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(anchor)


def pr_auc(df: DataFrame, label: str = "is_anomaly", score: str = "probability", parts: int | None = None) -> DataFrame:
    """Area under the precision-recall curve by trapezoids, anchored at recall 0, precision 1."""
    t = _thresholds(df, label, score, parts)
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    before = F.coalesce(F.try_divide(before_tp, before_tp + before_fp), F.lit(1.0))
    area = F.sum(F.col("pos") * (precision + before) / 2)
    return t.agg(F.try_divide(area, F.max("tp_total")).alias("pr_auc"))


def cv_summary(folds: DataFrame, score: str = "f1") -> DataFrame:
    """Mean and twice the population standard deviation of fold scores."""
    return folds.agg(F.avg(score).alias("cv_mean"), (2 * F.stddev_pop(score)).alias("cv_spread"))
