"""Quality of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscore.functions import split_bucket
from payscore.shared import with_total


def split_by_key(df: DataFrame, *key: str, share: int = 80) -> DataFrame:
    """Add ``part``: ``train`` for ``share`` percent of the keys, ``test`` for the others."""
    bucket = split_bucket(*[F.col(k) for k in key])
    return df.withColumn("part", F.when(bucket < share, F.lit("train")).otherwise(F.lit("test")))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    pairs = df.select(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
    return pairs.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("cnt"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def weighted_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall, F1 and false-positive rate weighted by label counts.

    Works on the confusion matrix, which has a row per pair of classes.
    """
    sides = F.array(
        F.struct(F.col("label").alias("c"), F.col("cnt").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("long").alias("support"), F.col("cnt").alias("predicted")),
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("cnt")).otherwise(0)
    # The hit belongs to one side only, or it would be counted twice.
    per_class = (
        matrix.select(F.posexplode(sides).alias("side", "x"), hit.alias("hit"))
        .groupBy(F.col("x.c").alias("c"))
        .agg(
            F.sum("x.support").alias("support"),
            F.sum("x.predicted").alias("predicted"),
            F.sum(F.when(F.col("side") == 0, F.col("hit")).otherwise(0)).alias("hits"),
        )
    )
    # Every row of the matrix has one label, so its counts sum up to those of the classes.
    per_class = with_total(per_class, matrix.agg(F.sum("cnt").alias("n")))
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    share = F.col("support") / F.col("n")
    return per_class.agg(
        F.sum("support").alias("n_rows"),
        F.sum("hits").alias("n_correct"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.sum(share * precision).alias("precision"),
        F.sum(share * recall).alias("recall"),
        F.sum(share * _ratio(2 * precision * recall, precision + recall)).alias("f1"),
        F.sum(share * _ratio(F.col("predicted") - F.col("hits"), F.col("n") - F.col("support"))).alias("fpr"),
    )


def binary_auc(matrix: DataFrame) -> DataFrame:
    """Area under the ROC and precision-recall curves of hard 0/1 predictions."""
    def total(label: int | None, prediction: int | None) -> Column:
        here = F.lit(True)
        if label is not None:
            here = here & ((F.col("label") > 0.5) == F.lit(label == 1))
        if prediction is not None:
            here = here & (F.col("prediction") == float(prediction))
        return F.sum(F.when(here, F.col("cnt")).otherwise(0))

    one = matrix.agg(
        total(1, 1).alias("tp"), total(None, 1).alias("pp"), total(1, None).alias("p"), total(None, None).alias("n")
    )
    tp, pp, p, n = (F.col(x) for x in ("tp", "pp", "p", "n"))
    recall, base = _ratio(tp, p), p / n
    precision = F.when(pp == 0, base).otherwise(tp / pp)
    roc = (recall + 1 - _ratio(pp - tp, n - p)) / 2
    pr = recall * precision + (1 - recall) * (precision + base) / 2
    return one.select(roc.alias("area_under_roc"), pr.alias("area_under_pr"))


def evaluate(
    df: DataFrame, label: str = "label", prediction: str = "prediction", as_published: bool = False
) -> DataFrame:
    """All metrics in one row. ``as_published`` swaps label and prediction, as published figures did."""
    if as_published:
        label, prediction = prediction, label
    matrix = confusion(df, label, prediction)
    return with_total(weighted_metrics(matrix), binary_auc(matrix))
