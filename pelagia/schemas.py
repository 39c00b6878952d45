"""Column names and Spark types of the tables that pass between operators."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

# Names of the weather parameters, in their order.
WEATHER_PARAMETERS = [
    "temperature",
    "max_individual_wave_height",
    "mean_wave_direction",
    "mean_period_total_swell",
    "clouds",
    "ocean_depth",
]

# Features of a model that does not name its own.
DEFAULT_FEATURES = ["lat", "lon", *WEATHER_PARAMETERS]

# Features of a training set with the grid value.
TRAINING_FEATURES = [*DEFAULT_FEATURES, "phyto"]

# File position columns of a raster row, in reading order.
FILE_ORDER = ["file_block", "file_row"]

# Fixed value: "no data" marker in the provider's weather columns.
MISSING = -666.0

LABEL = "label"


@dataclass(frozen=True)
class Box:
    """Latitude and longitude limits, both ends included."""

    lat_min: float = -70.0
    lat_max: float = 70.0
    lon_min: float = -100.0
    lon_max: float = 25.0


# Time window of the sightings (both ends excluded) and first test day.
WINDOW = (datetime(2020, 1, 1), datetime(2025, 1, 1))
TEST_FROM = datetime(2024, 1, 1)

SIGHTING = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("latitude", T.VariantType()),
        T.StructField("longitude", T.VariantType()),
    ]
)

OBSERVATION = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("date", T.TimestampNTZType()),
        *[T.StructField(name, T.DoubleType()) for name in WEATHER_PARAMETERS],
    ]
)

ENRICHED = T.StructType([*OBSERVATION.fields, T.StructField("phyto", T.DoubleType())])

TRAINING = T.StructType([*ENRICHED.fields, T.StructField(LABEL, T.IntegerType())])
