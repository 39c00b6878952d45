"""Accuracy and per-class quality from a table of labels and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.schemas import LABEL


def confusion(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Number of rows for every pair of label and prediction."""
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def accuracy(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    right = F.col(label).cast("int") == F.col(prediction).cast("int")
    return df.agg(F.avg(F.when(right, 1.0).otherwise(0.0)).alias("accuracy"))


def classification_report(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """One row per class, then accuracy, plain mean and mean weighted by support.

    A ratio without a denominator is 0. In the accuracy row all three
    ratios are the accuracy.
    """
    entry = [
        _entry(F.col("label"), F.col("rows"), F.lit(0), _if_right()),
        _entry(F.col("prediction"), F.lit(0), F.col("rows"), F.lit(0)),
    ]
    classes = (
        confusion(df, label, prediction)
        .select(F.inline(F.array(*entry)))
        .groupBy("class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("hits").alias("hits"),
        )
        .withColumns(
            {
                "precision": _ratio(F.col("hits"), F.col("predicted")),
                "recall": _ratio(F.col("hits"), F.col("support")),
                "f1": _ratio(F.col("hits") * 2, F.col("predicted") + F.col("support")),
            }
        )
    )
    measures = ["precision", "recall", "f1"]
    per_class = classes.select(F.col("class").cast("string").alias("class"), *measures, "support")
    overall = classes.agg(
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.sum("support").alias("support"),
        *[F.avg(m).alias(f"plain_{m}") for m in measures],
        *[
            _ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}")
            for m in measures
        ],
    )

    def summary(name: str, values: list[str]) -> Column:
        named = [F.col(v).alias(m) for v, m in zip(values, measures)]
        return F.struct(F.lit(name).alias("class"), *named, "support")

    rows = F.array(
        summary("accuracy", ["accuracy"] * 3),
        summary("macro avg", [f"plain_{m}" for m in measures]),
        summary("weighted avg", [f"weighted_{m}" for m in measures]),
    )
    return per_class.unionByName(overall.select(F.inline(rows)))


def _entry(cls: Column, support: Column, predicted: Column, hits: Column) -> Column:
    return F.struct(
        cls.alias("class"),
        support.cast("long").alias("support"),
        predicted.cast("long").alias("predicted"),
        hits.cast("long").alias("hits"),
    )


def _if_right() -> Column:
    return F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
