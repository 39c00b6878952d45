"""Points for a map of the sightings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.functions.coords import given, point_label
from pelagia.operators.profile import center
from pelagia.plans.training import filter_sightings
from pelagia.schemas import WINDOW, Box


def map_sightings(
    sightings: DataFrame, since: datetime | None = WINDOW[0], box: Box = Box(), **columns
) -> DataFrame:
    """Dated sightings in the box after a date, with no later limit."""
    return filter_sightings(sightings, (since, None), box, **columns)


def map_points(
    points: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    lat_given: Column | None = None,
    lon_given: Column | None = None,
    lat_text: str | None = None,
    lon_text: str | None = None,
) -> DataFrame:
    """Label of every point that has both coordinates, as they were written where that is kept."""
    lat_given = given(F.col(lat)) if lat_given is None else lat_given
    lon_given = given(F.col(lon)) if lon_given is None else lon_given
    return points.filter(lat_given & lon_given).withColumn(
        "label", point_label(F.col("date"), F.col(lat_text or lat), F.col(lon_text or lon))
    )


def latest(points: DataFrame, n: int = 10, tie: str = "id") -> DataFrame:
    """The last ``n`` points by date."""
    return points.orderBy(F.desc("date"), F.desc(tie)).limit(n)


def map_center(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return center(points, lat, lon)
