"""Column rules for weather features: factors, cleaning, scenarios, model rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.schemas import LABEL, MISSING

_NUMBERS = (T.NumericType,)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMBERS)]


def scale_parameters(df: DataFrame, factors: Mapping[str, float] | None = None) -> DataFrame:
    """Multiply weather columns by factors; a column without one stays as it is."""
    factors = factors or {}
    unknown = set(factors) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.withColumns({name: F.col(name) * F.lit(float(f)) for name, f in factors.items()})


def clean_features(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Null, NaN and the missing marker become 0 in numeric columns."""
    names = list(columns) if columns is not None else numeric_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    cleaned = {}
    for name in names:
        c = F.col(name)
        bad = c.isNull() | (c == F.lit(MISSING).cast(types[name]))
        if isinstance(types[name], (T.DoubleType, T.FloatType)):
            bad = bad | F.isnan(c)
        cleaned[name] = F.when(bad, F.lit(0).cast(types[name])).otherwise(c)
    return df.withColumns(cleaned) if cleaned else df


def with_label(df: DataFrame, value: int, label: str = LABEL) -> DataFrame:
    """Add a constant label."""
    return df.withColumn(label, F.lit(value).cast("int"))


def effective_depth(depth: Column, found: Column, delta: Column) -> Column:
    """Depth of the scenario: asked depth, else found depth, else 0, times (1 + delta)."""
    base = F.coalesce(depth.cast("double"), found, F.lit(0.0))
    return base * (F.lit(1.0) + F.coalesce(delta, F.lit(0.0)))


def apply_scenario(
    df: DataFrame,
    depth: str = "depth",
    d_temp: str = "d_temp",
    d_clouds: str = "d_clouds",
    d_ocean: str = "d_ocean",
) -> DataFrame:
    """Add the what-if deltas to matched requests.

    Temperature and clouds are shifted, the ocean depth is scaled. Rows without
    weather start from 0.
    """
    zero = F.lit(0.0)

    def shifted(name: str, delta: str) -> Column:
        return F.coalesce(F.col(name), zero) + F.coalesce(F.col(delta), zero)

    return df.withColumns(
        {
            "temperature": shifted("temperature", d_temp),
            "clouds": shifted("clouds", d_clouds),
            "ocean_depth": effective_depth(F.col(depth), F.col("ocean_depth"), F.col(d_ocean)),
        }
    )


def model_rows(
    df: DataFrame,
    names: list[str],
    depth: str = "depth",
    lat: str = "latitude",
    lon: str = "longitude",
    depth_delta: str = "found",
) -> DataFrame:
    """Put the model's features in its order next to the other columns.

    Missing values and features the row does not have are 0. An asked depth
    replaces the scenario's ocean depth, so that its delta only acts on a found
    depth; ``depth_delta="always"`` keeps the delta.
    """
    if depth_delta not in ("found", "always"):
        raise ValueError("depth_delta is 'found' or 'always'")
    source = {"lat": F.col(lat), "lon": F.col(lon)}
    if depth_delta == "found":
        source["ocean_depth"] = F.coalesce(F.col(depth).cast("double"), F.col("ocean_depth"))

    def value(name: str) -> Column:
        if name in source:
            c = source[name]
        elif name in df.columns:
            c = F.col(name)
        else:
            return F.lit(0.0).alias(name)
        return F.coalesce(c.cast("double"), F.lit(0.0)).alias(name)

    keep = [F.col(c) for c in df.columns if c not in names]
    return df.select(*keep, *[value(name) for name in names])


def feature_columns(df: DataFrame, label: str = LABEL, drop: Iterable[str] = ()) -> list[str]:
    """All columns but the label, the date and those dropped, in table order."""
    out = {label, "date", *drop}
    return [c for c in df.columns if c not in out]
