"""From sightings to a training set, and from there to an evaluated model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, time, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.functions.coords import in_bbox
from pelagia.functions.dates import day, has_date, in_window, parse_rfc1123
from pelagia.functions.features import clean_features, with_label
from pelagia.operators.background import draw_days, uniform_points
from pelagia.operators.keyed import shuffle_rows
from pelagia.operators.nearest import nearest_grid_value, with_month
from pelagia.operators.weather import attach_weather, stack
from pelagia.plans import model as models
from pelagia.schemas import LABEL, TEST_FROM, TRAINING_FEATURES, WEATHER_PARAMETERS, WINDOW, Box
from pelagia.sources.store import WeatherStore
from pelagia.sources.writers import checkpointed


@dataclass(frozen=True)
class TrainingConfig:
    window: tuple[datetime | None, datetime | None] = WINDOW
    box: Box = Box()
    weather_order: Sequence[str] = field(default_factory=lambda: ["date", *WEATHER_PARAMETERS])
    grid_order: Sequence[str] | None = None  # of duplicate cells: file order where it is known
    grid_unique: bool = False
    share: int = 3  # background points per round: one for so many positives
    rounds: int = 3
    batch: int = 100
    seed: int = 42


def filter_sightings(
    sightings: DataFrame,
    window: tuple[datetime | None, datetime | None] = WINDOW,
    box: Box = Box(),
    raw_date: str = "raw_date",
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Dated sightings inside the time window and the box, with the parsed ``date``."""
    dated = sightings.filter(has_date(F.col(raw_date)) & in_bbox(F.col(lat), F.col(lon), box))
    parsed = dated.withColumn("date", parse_rfc1123(F.col(raw_date)))
    return parsed.filter(in_window(F.col("date"), *window))


def days_of_window(
    weather: DataFrame | WeatherStore, window: tuple[datetime | None, datetime | None]
) -> DataFrame | WeatherStore:
    """Observations on the days that the window touches; constants reach the scan.

    A store is returned as it is: lookups read the days they need.
    """
    lo, hi = window
    if isinstance(weather, WeatherStore):
        return weather
    if "date" not in weather.columns:  # a keyed table
        if lo is not None:
            weather = weather.filter(F.col("key_day") >= F.lit(lo.date()))
        if hi is not None:
            weather = weather.filter(F.col("key_day") <= F.lit(hi.date()))
        return weather
    if lo is not None:
        first = datetime.combine(lo.date(), time.min)
        weather = weather.filter(F.col("date") >= F.lit(str(first)).cast("timestamp_ntz"))
    if hi is not None:
        after = datetime.combine(hi.date() + timedelta(days=1), time.min)
        weather = weather.filter(F.col("date") < F.lit(str(after)).cast("timestamp_ntz"))
    return weather


def build_training_set(
    sightings: DataFrame,
    weather: DataFrame | WeatherStore,
    grid: DataFrame,
    background_weather: DataFrame | WeatherStore | Callable[[DataFrame], DataFrame],
    cfg: TrainingConfig = TrainingConfig(),
) -> DataFrame:
    """Labelled, cleaned and shuffled rows.

    ``sightings`` has ``id, raw_date, lat, lon``; ``weather`` holds stored
    observations. ``background_weather`` holds those for the background points,
    or makes them from the drawn points (``id, batch, round, lat, lon, date``).
    """
    spark = sightings.sparkSession
    seen = filter_sightings(sightings, cfg.window, cfg.box)
    seen = seen.select("id", "lat", "lon", day(F.col("date")).alias("date"))
    weather = days_of_window(weather, cfg.window)
    # used for the count, the date range and the rows themselves
    seen = checkpointed(attach_weather(seen, weather, cfg.weather_order, ["id"]))

    known = seen.agg(
        F.struct(
            F.floor(F.count(F.lit(1)) / cfg.share).alias("wanted"),
            F.min("date").alias("first"),
            F.max("date").alias("last"),
        )
    ).scalar()
    points = uniform_points(spark, known["wanted"], cfg.box, cfg.seed)
    drawn = draw_days(points, known["first"], known["last"], cfg.rounds, cfg.batch, cfg.seed)
    # made from one row, its size cannot be estimated: joins would broadcast all points by way of the driver
    drawn = checkpointed(drawn.withColumn("date", day(F.col("date"))))
    around = background_weather(drawn) if callable(background_weather) else background_weather
    empty = attach_weather(
        drawn.select("id", "round", "lat", "lon", "date"),
        around,
        cfg.weather_order,
        ["id", "round"],
    )

    positive = with_label(seen.withColumn("round", F.lit(0)), 1)
    both = with_month(stack(positive, with_label(empty, 0)))
    # numbered before the lookup, which keeps every row once, so that it runs once
    row_key = [LABEL, "round", "id"]
    shuffled = checkpointed(shuffle_rows(both, f"{cfg.seed}:shuffle", row_key))
    enriched = nearest_grid_value(
        shuffled, grid, row_key, order=cfg.grid_order, unique=cfg.grid_unique
    )
    cleaned = clean_features(enriched, TRAINING_FEATURES)
    return cleaned.select("position", "lat", "lon", "date", *TRAINING_FEATURES[2:], LABEL)


@dataclass(frozen=True)
class TrainingRun:
    model: PipelineModel
    report: DataFrame
    accuracy: DataFrame


def run_training(
    df: DataFrame,
    path: str | None = None,
    cutoff: datetime = TEST_FROM,
    features: Sequence[str] | None = None,
    **params,
) -> TrainingRun:
    """Split by date, train, evaluate, and save if a path is given."""
    train_set, test = models.temporal_split(df, cutoff)
    names = list(features) if features is not None else TRAINING_FEATURES
    fitted = models.train(train_set, names, **params)
    report, accuracies = models.evaluate(fitted, test, train_set)
    if path is not None:
        models.save(fitted, path)
    return TrainingRun(fitted, report, accuracies)
