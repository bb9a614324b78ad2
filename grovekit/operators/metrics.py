"""Losses, accuracies and confusion statistics of (actual, predicted) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.functions.vectors import squared_error, truncate_to_int


def task_loss(df: DataFrame, task: str, y_hat: str = "y_hat", y: str = "y_true") -> DataFrame:
    """``regression``: truncated mean squared error; ``classification``: count of hits."""
    if task == "regression":
        value = truncate_to_int(
            F.avg(squared_error(F.col(y_hat).cast("double"), F.col(y).cast("double")))
        )
    elif task == "classification":
        value = F.sum((F.col(y_hat) == F.col(y)).cast("bigint"))
    else:
        raise ValueError(f"unknown task {task!r}")
    return df.agg(value.alias("loss"))


def accuracy(df: DataFrame, y_hat: str = "predicted", y: str = "actual", by=()) -> DataFrame:
    """``n, hits, accuracy, error`` over all expected rows; a NULL prediction is a miss."""
    hit = F.coalesce(F.col(y_hat) == F.col(y), F.lit(False)).cast("bigint")
    return (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("hits"))
        .withColumn("accuracy", F.try_divide(F.col("hits").cast("double"), F.col("n")))
        .withColumn("error", 1 - F.col("accuracy"))
    )


def confusion(df: DataFrame, y_hat: str = "predicted", y: str = "actual") -> DataFrame:
    """Long confusion table ``actual, predicted, n``."""
    return df.groupBy(F.col(y).alias("actual"), F.col(y_hat).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_stats(table: DataFrame) -> DataFrame:
    """``total, correct, incorrect`` of a confusion table; all -1 when it is empty."""
    diagonal = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return table.agg(F.sum("n").alias("total"), diagonal.alias("correct")).select(
        F.coalesce("total", F.lit(-1)).alias("total"),
        F.coalesce("correct", F.lit(-1)).alias("correct"),
        F.coalesce(F.col("total") - F.col("correct"), F.lit(-1)).alias("incorrect"),
    )


def class_counts(df: DataFrame, label: str = "label", by=()) -> DataFrame:
    """Distinct labels with their counts."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))


def impurities(counts: DataFrame, by=()) -> DataFrame:
    """``n, entropy, gini, majority`` from a (label, n) table.

    The majority's ties go to the smallest label.
    """
    total = counts.groupBy(*by).agg(
        F.sum("n").alias("n_total"),
        F.sum(F.col("n") * F.log2("n")).alias("_nlogn"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("_sq"),
        F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("majority"),
    )
    n = F.col("n_total").cast("double")
    return total.select(
        *by,
        F.col("n_total").alias("n"),
        (F.log2(n) - F.col("_nlogn") / n).alias("entropy"),
        (1 - F.col("_sq") / (n * n)).alias("gini"),
        "majority",
    )


def vector_overlap(train: DataFrame, test: DataFrame, features: str = "features") -> DataFrame:
    """Test rows whose whole vector occurs in train.

    Train is reduced to its distinct vectors, so a vector copied many times
    meets each test row once.  Vectors with NaN equal nothing.
    """
    clean = ~F.exists(F.col(features), lambda v: F.isnan(v) | v.isNull())
    seen = train.filter(clean).select(features).distinct()
    return test.filter(clean).join(seen, features, "left_semi")


def has_overlap(train: DataFrame, test: DataFrame, features: str = "features") -> DataFrame:
    """One row ``overlap BOOLEAN``; False when either side is empty."""
    hit = vector_overlap(train, test, features).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("overlap"))
