"""Scores for requested coordinates under what-if scenarios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.functions.features import apply_scenario, clean_features, model_rows
from pelagia.functions.scoring import score_count
from pelagia.operators.nearest import nearest_grid_value, with_month
from pelagia.operators.weather import weather_match
from pelagia.plans import model as models
from pelagia.schemas import WEATHER_PARAMETERS
from pelagia.sources.store import WeatherStore


def request_features(
    requests: DataFrame,
    weather: DataFrame | WeatherStore,
    names: Sequence[str],
    order: Sequence = ("date", *WEATHER_PARAMETERS),
    spread: Sequence[str] = ("req_id",),
    clean: bool = False,
    depth_delta: str = "found",
    grid: DataFrame | None = None,
    grid_order: Sequence[str] | None = None,
    grid_unique: bool = False,
    one_per_key: bool = False,
) -> DataFrame:
    """Model rows of requests ``longitude, latitude, date, depth, d_temp, d_clouds, d_ocean``.

    By default found weather is used as it is stored; ``clean`` turns its missing
    marker and NaN to 0 as in training. A feature that requests do not have, such
    as the grid value, is 0 unless ``grid`` is given; ``grid_order`` and ``grid_unique`` are
    those of the training set. ``one_per_key`` says that the weather is keyed and has no
    duplicates.
    """
    rows = with_month(requests)
    if grid is not None:
        near = nearest_grid_value(
            rows, grid, spread, lon="longitude", lat="latitude", order=grid_order, unique=grid_unique
        )
        rows = near.drop("c_lon", "c_lat")
    matched = weather_match(rows, weather, order, spread, one_per_key=one_per_key)
    return matched_features(matched, names, clean, depth_delta)


def matched_features(
    matched: DataFrame, names: Sequence[str], clean: bool = False, depth_delta: str = "found"
) -> DataFrame:
    """Model rows of requests that have their weather beside them."""
    if clean:
        matched = clean_features(matched, WEATHER_PARAMETERS)
    return model_rows(apply_scenario(matched), list(names), depth_delta=depth_delta)


def classify(
    requests: DataFrame,
    weather: DataFrame | WeatherStore,
    model: PipelineModel,
    spread: Sequence[str] = ("req_id",),
    **options,
) -> DataFrame:
    """Longitude, latitude and count (0 to 100) of every request."""
    names = models.feature_names(model)
    return counted(request_features(requests, weather, names, spread=spread, **options), model, spread)


def counted(rows: DataFrame, model: PipelineModel, spread: Sequence[str]) -> DataFrame:
    """Longitude, latitude and count of model rows."""
    scored = models.score(rows, model)
    return scored.select(
        *spread,
        "longitude",
        "latitude",
        score_count(F.col("probability"), F.col("prediction")).alias("count"),
    )
