"""From probabilities and raw scores to classes and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_count(probability: Column, prediction: Column) -> Column:
    """Percent rounded half to even; without a probability the 0/1 prediction."""
    return F.coalesce(F.bround(probability * 100).cast("int"), prediction.cast("int"))


def to_class(probability: Column) -> Column:
    return (probability >= 0.5).cast("int")


def minmax_scores(df: DataFrame, raw: str, out: str = "probability") -> DataFrame:
    """Scale raw scores to [0, 1] over the whole frame; all equal gives 0."""
    limits = df.agg(F.struct(F.min(raw).alias("lo"), F.max(raw).alias("hi")).alias("r")).scalar()
    lo, hi = limits["lo"], limits["hi"]
    scaled = F.when(hi > lo, (F.col(raw) - lo) / (hi - lo)).otherwise(F.lit(0.0))
    return df.withColumn(out, F.when(F.col(raw).isNotNull(), scaled))
