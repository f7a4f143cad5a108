"""Classifier quality from one pass over (actual, predicted) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Rows per pair: the only pass over the predictions; k*k rows come out."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(counts: DataFrame, labels) -> DataFrame:
    """One row per actual label, one ``Pred_`` column per predicted label, zero-filled."""
    listed = F.explode(F.array(*[F.lit(x) for x in labels])).alias("actual")
    rows = counts.sparkSession.range(1).select(listed)
    # only the named labels: as many rows as there are labels
    cells = counts.filter(F.col("actual").isin(*labels)).groupBy("actual").agg(
        *[F.sum(F.when(F.col("predicted") == x, F.col("n"))).alias(f"Pred_{x}") for x in labels]
    )
    return (
        rows.join(F.broadcast(cells), "actual", "left")
        .na.fill(0)
        .withColumnRenamed("actual", "Actual")
    )


def class_metrics(counts: DataFrame, labels) -> DataFrame:
    """Precision, recall, F1 and support per known label, denominators never zero."""
    per_label = F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")
    n, label = F.col("n"), F.col("label")
    sums = (
        counts.select("*", per_label)
        .groupBy("label")
        .agg(
            F.sum(F.when((F.col("actual") == label) & (F.col("predicted") == label), n).otherwise(0)).alias("tp"),
            F.sum(F.when(~F.col("actual").eqNullSafe(label) & (F.col("predicted") == label), n).otherwise(0)).alias("fp"),
            F.sum(F.when((F.col("actual") == label) & ~F.col("predicted").eqNullSafe(label), n).otherwise(0)).alias("fn"),
        )
        .withColumn("p", F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)))
        .withColumn("r", F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1)))
    )
    return sums.select(
        "label",
        F.bround("p", 4).alias("precision"),
        F.bround("r", 4).alias("recall"),
        F.bround(2 * F.col("p") * F.col("r") / F.greatest(F.col("p") + F.col("r"), F.lit(1e-9)), 4).alias("f1"),
        (F.col("tp") + F.col("fn")).alias("support"),
    )


def overall_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F over the labels that occur.

    Every cell adds to the support of its actual label and to the said count of its predicted
    one; summing both per label needs no join.
    """
    n, nothing = F.col("n"), F.lit(0).cast("bigint")
    right = F.when(F.col("actual") == F.col("predicted"), n).otherwise(nothing)
    roles = F.array(
        F.struct(F.col("actual").alias("label"), n.alias("support"), nothing.alias("said"), right.alias("tp")),
        F.struct(F.col("predicted").alias("label"), nothing.alias("support"), n.alias("said"), nothing.alias("tp")),
    )
    scored = (
        counts.select(F.inline(roles))
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("tp").alias("tp"))
        .withColumn("p", F.coalesce(F.try_divide("tp", "said"), F.lit(0.0)))
        .withColumn("r", F.coalesce(F.try_divide("tp", "support"), F.lit(0.0)))
        .withColumn("f", F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0)))
    )
    total = F.sum("support")

    def weighted(c: str, name: str):
        return F.bround(F.try_divide(F.sum(F.col(c) * F.col("support")), total), 4).alias(name)

    return scored.agg(
        F.bround(F.try_divide(F.sum("tp"), total), 4).alias("accuracy"),
        weighted("p", "weighted_precision"),
        weighted("r", "weighted_recall"),
        weighted("f", "weighted_f1"),
        total.alias("test_count"),
    )


def confusion_percent(counts: DataFrame) -> DataFrame:
    """Cells as percent of their actual label, one digit."""
    whole = F.sum("n").over(W.partitionBy("actual"))
    return counts.select(
        "actual",
        "predicted",
        "n",
        F.round(100.0 * F.col("n") / F.greatest(whole, F.lit(1)), 1).alias("pct"),
    )
