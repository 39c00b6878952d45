"""Training, scoring, evaluating and keeping the presence model."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions.features import feature_columns
from pelagia.functions.scoring import minmax_scores
from pelagia.operators.report import accuracy, classification_report
from pelagia.plans.boosting import Settings, boost
from pelagia.plans.trees import model_of, node_importance, nodes_of
from pelagia.schemas import LABEL, TEST_FROM

# Settings of the classifier (trees, depth, learning rate, seed, loss).
DEFAULTS = {"maxIter": 200, "maxDepth": 6, "stepSize": 0.3, "seed": 42, "lossType": "logistic"}


# What the settings are called by ``pelagia.plans.boosting``.
SETTINGS = {"maxIter": "trees", "maxDepth": "depth", "stepSize": "rate"}


def temporal_split(
    df: DataFrame, cutoff: datetime = TEST_FROM, date: str = "date"
) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff for training, from it on for testing."""
    if date not in df.columns:
        raise ValueError(f"cannot split rows without a column '{date}'")
    limit = F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.filter(F.col(date) < limit), df.filter(F.col(date) >= limit)


def train(
    df: DataFrame,
    features: Sequence[str] | None = None,
    label: str = LABEL,
    method: str = "histogram",
    **params,
) -> PipelineModel:
    """Fit boosted trees on named features; keywords override the settings.

    By default trees grow from histograms of both derivatives, with ``penalty``, ``least_gain`` and
    ``least_weight`` as further keywords; this draws nothing, so that the seed does not matter. The method
    ``library`` is Spark's own classifier, which takes its own keywords.
    """
    names = list(features) if features is not None else feature_columns(df, label)
    if method == "histogram":
        chosen = {**DEFAULTS, **params}
        given = {to: chosen.pop(name) for name, to in SETTINGS.items()}
        rest = {k: v for k, v in chosen.items() if k not in ("seed", "lossType")}
        return model_of(boost(df, names, label, Settings(**given, **rest)), names)
    if method != "library":
        raise ValueError("method is 'histogram' or 'library'")
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    trees = GBTClassifier(labelCol=label, featuresCol="features", **{**DEFAULTS, **params})
    # every tree reads the rows again
    data = df.select(*names, F.col(label).cast("double").alias(label)).persist()
    try:
        return Pipeline(stages=[assembler, trees]).fit(data)
    finally:
        data.unpersist()


def feature_names(model: PipelineModel) -> list[str]:
    """Features of a model, in its order."""
    return list(model.stages[0].getInputCols())


def score(df: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Add ``prediction`` (0/1) and ``probability`` of the positive class.

    For a model that only gives raw scores these are scaled to [0, 1] over all rows;
    with neither the probability is null.
    """
    if model is None:
        raise RuntimeError("there is no model to score with")
    scored = model.transform(df).withColumn("prediction", F.col("prediction").cast("int"))
    if "probability" in scored.columns:
        scored = scored.withColumn("probability", vector_to_array("probability")[1])
    elif "rawPrediction" in scored.columns:
        scored = minmax_scores(scored.withColumn("__raw", vector_to_array("rawPrediction")[1]), "__raw")
    else:
        scored = scored.withColumn("probability", F.lit(None).cast("double"))
    return scored.drop("features", "rawPrediction", "__raw")


def evaluate(
    model: PipelineModel | None, test: DataFrame, train_set: DataFrame, label: str = LABEL
) -> tuple[DataFrame, DataFrame]:
    """Report on the test rows, and accuracy on test and training rows."""
    if model is None:
        raise ValueError("there is no trained model")
    tested = score(test, model)
    both = accuracy(tested, label).withColumn("part", F.lit("test")).unionByName(
        accuracy(score(train_set, model), label).withColumn("part", F.lit("train"))
    )
    return classification_report(tested, label), both


def importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Features by their importance in the trees, the highest first; the shares add up to 1.

    It is the gain of a feature's average split; ``node_importance`` has counts and covers as well.
    """
    return node_importance(nodes_of(model, spark), feature_names(model)).select("feature", "importance")


def save(model: PipelineModel | None, path: str) -> None:
    if model is None:
        raise ValueError("there is no trained model")
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
