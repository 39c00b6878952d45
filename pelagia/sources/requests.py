"""Coordinate requests given as JSON texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.functions.coords import first_alias, to_number
from pelagia.functions.dates import parse_iso

# Accepted names of a coordinate, the first given one counts.
LON_NAMES = ["longitude", "lon", "x"]
LAT_NAMES = ["latitude", "lat", "y"]

# Names of the scenario's deltas.
DELTA_NAMES = {"d_temp": "deltaTemp", "d_clouds": "deltaClouds", "d_ocean": "deltaOceanDepth"}

NO_COORDINATES = "the request has no points"
BAD_PAIR = "a point is a list of two numbers or an object"
NO_LON_LAT = "the object lacks a coordinate"
NOT_NUMERIC = "a coordinate is no number"
BAD_DATE = "the date is missing or not in ISO form"
BAD_DEPTH = "the depth is no whole number"
BAD_DELTAS = "one of the three deltas is missing or no number"


def parse_requests(
    df: DataFrame, body: str = "value", request_id: str = "req_id", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per requested coordinate, or per request that has none.

    Coordinates come under ``coords``, else ``coordinates``, as a list or as an
    object whose values are taken in their order. Each is ``[lon, lat]`` or an object.
    ``reason`` says why a row cannot be used, and is null for good rows. ``whole``
    is true if no row of the same request has a reason. ``keep`` names columns that come along.
    """
    fields = F.from_json(body, "map<string,string>")
    raw = df.select(F.col(request_id).alias("req_id"), *keep, fields.alias("f"))
    f = F.col("f")
    coords = F.when(F.map_contains_key(f, "coords"), _get(f, "coords")).otherwise(
        _get(f, "coordinates")
    )
    # a map keeps the order in which the values are written
    as_list = F.from_json("c", "array<variant>")
    as_values = F.map_values(F.from_json("c", "map<string,variant>"))
    points = F.coalesce(F.when(F.col("c").startswith("{"), as_values).otherwise(as_list), F.array())
    deltas = F.from_json("d", "map<string,string>")
    request = raw.select(
        "req_id",
        *keep,
        F.trim(coords).alias("c"),
        parse_iso(_get(f, "date")).alias("date"),
        _get(f, "view").alias("view"),
        _get(f, "depth").alias("depth_text"),
        _get(f, "deltas").alias("d"),
    ).select(
        "req_id",
        *keep,
        "date",
        "view",
        "depth_text",
        to_number(F.col("depth_text")).alias("depth_number"),
        points.alias("points"),
        F.col("d").alias("deltas_text"),
        *[to_number(_get(deltas, name)).alias(c) for c, name in DELTA_NAMES.items()],
    )
    depth, no_deltas = F.col("depth_number"), F.col("deltas_text").isNull()
    partial = F.greatest(*[F.col(c).isNull() for c in DELTA_NAMES])
    whole_depth = depth.try_cast("int")
    bad_depth = F.col("depth_text").isNotNull() & (whole_depth.isNull() | (depth != whole_depth))
    request_reason = (
        F.when(F.size("points") == 0, NO_COORDINATES)
        .when(F.col("date").isNull(), BAD_DATE)
        .when(bad_depth, BAD_DEPTH)
        .when(~no_deltas & partial, BAD_DELTAS)
    )
    checked = request.select(
        "req_id",
        *keep,
        "date",
        "view",
        F.when(~bad_depth, whole_depth).alias("depth"),
        "d_temp",
        "d_clouds",
        "d_ocean",
        request_reason.alias("request_reason"),
        _points(F.col("points")).alias("points"),
    ).withColumn(
        "whole",
        F.col("request_reason").isNull()
        & ~F.exists("points", lambda p: p["reason"].isNotNull()),
    )
    return checked.select("*", F.posexplode_outer("points").alias("pos", "p")).select(
        "req_id",
        "pos",
        F.col("p.longitude").alias("longitude"),
        F.col("p.latitude").alias("latitude"),
        "date",
        "view",
        "depth",
        "d_temp",
        "d_clouds",
        "d_ocean",
        *keep,
        "whole",
        F.coalesce("request_reason", "p.reason").alias("reason"),
    )


def accepted(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Usable coordinates; ``strict`` refuses a request as a whole for one bad point."""
    good = F.col("whole") if strict else F.col("reason").isNull()
    return parsed.filter(good).drop("whole", "reason")


def rejected(parsed: DataFrame) -> DataFrame:
    """Rows that cannot be used, with the reason."""
    return parsed.filter(F.col("reason").isNotNull()).select("req_id", "pos", "reason")


def _points(items: Column) -> Column:
    """Coordinates of list or object items, and why one cannot be used.

    In steps, so that no value is looked up twice for an item.
    """

    def look_up(item: Column) -> Column:
        # a list has no names and an object no positions: at most one of them is there
        lon = F.coalesce(F.try_variant_get(item, "$[0]", "string"), first_alias(item, LON_NAMES))
        lat = F.coalesce(F.try_variant_get(item, "$[1]", "string"), first_alias(item, LAT_NAMES))
        return F.struct(item.alias("item"), lon.alias("lon"), lat.alias("lat"))

    def convert(p: Column) -> Column:
        return F.struct(
            to_number(p["lon"]).alias("longitude"),
            to_number(p["lat"]).alias("latitude"),
            (p["lon"].isNull() | p["lat"].isNull()).alias("absent"),
            p["item"].alias("item"),
        )

    def judge(p: Column) -> Column:
        is_object = F.schema_of_variant(p["item"]).startswith("OBJECT")
        why = (
            F.when(~F.coalesce(is_object, F.lit(False)), BAD_PAIR)
            .when(p["absent"], NO_LON_LAT)
            .otherwise(NOT_NUMERIC)
        )
        bad = p["longitude"].isNull() | p["latitude"].isNull()
        return F.struct(p["longitude"], p["latitude"], F.when(bad, why).alias("reason"))

    return F.transform(F.transform(F.transform(items, look_up), convert), judge)


def _get(fields: Column, name: str) -> Column:
    return F.try_element_at(fields, F.lit(name))
