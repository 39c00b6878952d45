"""Scores for requests that keep arriving."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.plans.classify import classify
from pelagia.sources.requests import accepted, parse_requests


def read_request_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """JSON request lines from files as they arrive: ``req_id, value``.

    The id is the hash of the text and its file, so that a batch which runs
    again gives the same ids. Equal lines of one file share an id; each is scored.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return lines.select(
        F.xxhash64(F.col("_metadata.file_path"), F.col("value")).alias("req_id"), "value"
    )


def classify_stream(
    stream: DataFrame,
    weather: DataFrame,
    model: PipelineModel,
    strict: bool = False,
    **options,
) -> DataFrame:
    """Score a stream of request texts against stored weather.

    Each request stands alone, so there is no state and no watermark; rows are
    appended. Refused rows are found by ``rejected(parse_requests(stream))``.
    """
    points = accepted(parse_requests(stream), strict)
    return classify(points, weather, model, spread=("req_id", "pos"), **options)
