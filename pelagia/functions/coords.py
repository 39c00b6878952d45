"""Coordinates: coercion, boxes, match keys and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.schemas import Box

KEY = ["key_lat", "key_lon", "key_day"]


def to_number(raw: Column) -> Column:
    """Double value of a text; what is not a number becomes null.

    The cast alone would also take a number with a type letter, as in ``1d``.
    """
    return F.when(~raw.rlike(r"[0-9.][dDfF]\s*$"), raw.try_cast("double"))


def in_bbox(lat: Column, lon: Column, box: Box = Box()) -> Column:
    """Point inside the box, edges included."""
    return lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)


def with_coord_key(
    df: DataFrame, lat: str = "lat", lon: str = "lon", date: str = "date"
) -> DataFrame:
    """Add the match key: both coordinates rounded to 5 places, and the day.

    Use it on both sides of a match, so that both are rounded alike.
    """
    return df.withColumns(
        {
            KEY[0]: F.round(lat, 5),
            KEY[1]: F.round(lon, 5),
            KEY[2]: F.to_date(date),
        }
    )


def keyed(weather: DataFrame) -> DataFrame:
    """Observations with their match key, which a stored table may have already."""
    if set(KEY) <= set(weather.columns):
        return weather
    if {"lat", "lon", "date"} <= set(weather.columns):
        return with_coord_key(weather)
    raise ValueError(f"observations need the columns {KEY} or lat, lon and date")


def given(value: Column) -> Column:
    """A numeric coordinate counts as given unless it is null or zero."""
    return value.isNotNull() & (value != 0)


def given_variant(value: Column) -> Column:
    """As :func:`given` for JSON values: a text counts unless it is empty."""
    text = F.try_variant_get(value, "$", "string")
    is_text = F.schema_of_variant(value) == "STRING"
    return F.when(is_text, text != "").otherwise(F.coalesce(given(to_number(text)), F.lit(False)))


def first_alias(point: Column, names: list[str]) -> Column:
    """First value that is not null among the keys of a JSON object, as text."""
    return F.coalesce(*[F.try_variant_get(point, f"$.{name}", "string") for name in names])


def point_label(date: Column, lat: Column, lon: Column) -> Column:
    """Text shown at a point of the map."""
    # fixed values: the wording
    return F.concat(
        F.lit("Date: "),
        date.cast("string"),
        F.lit("<br>Location: ("),
        lat.cast("string"),
        F.lit(", "),
        lon.cast("string"),
        F.lit(")"),
    )
