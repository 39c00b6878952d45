"""Value of the nearest cell of a monthly grid, in two steps.

First the nearest longitude among all of the month's, then the nearest latitude
among the cells of that longitude only. This is not the cell at the least
distance: a cell that is closer but lies on another longitude loses. Ties go to the
larger coordinate, targets beyond an end take the end.

Both steps are hash joins. Neighbouring values on an axis form intervals, each of
which is listed under all bins it touches; a target looks in its own bin and
keeps the one interval that holds it. The longitude axis of all months is small
and is broadcast if a count proves that; the cells are shuffled with the points,
and points crowding at one place are spread out by ``joins.lookup``.

Intervals and bins depend on the grid alone. A grid that is used again and again is worked out once, as a
``GridIndex``, and then read by month.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.operators import joins
from pelagia.operators.keyed import first_per_key
from pelagia.schemas import FILE_ORDER
from pelagia.sources import commits
from pelagia.sources.writers import checkpointed

MONTH = ("year", "month")

# Up to so many distinct months of points narrow the grid down before it is read.
MONTHS = 10_000


def with_month(df: DataFrame, date: str = "date") -> DataFrame:
    """Add the year and month that pick a grid."""
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


def month_match(points: DataFrame, grid: DataFrame, keys: Sequence[str] = MONTH) -> DataFrame:
    """Say for every point whether its month has a grid."""
    months = grid.select(*keys).distinct().withColumn("has_grid", F.lit(True))
    spread = [c for c in points.columns if c not in keys] or list(keys)
    return joins.lookup(points, months, keys, spread).withColumn(
        "has_grid", F.coalesce("has_grid", F.lit(False))
    )


def one_row_per_cell(
    grid: DataFrame,
    keys: Sequence[str] = MONTH,
    value: str = "chlor_a",
    order: Sequence[str] = (),
) -> DataFrame:
    """First row of every cell by ``order``; without an order the least value."""
    cell = [*keys, "lon", "lat"]
    if order:
        return first_per_key(grid, cell, [*order, value]).select(*cell, value)
    return grid.groupBy(*cell).agg(F.min(value).alias(value))


@dataclass(frozen=True)
class _Axis:
    """Intervals of longitudes and of latitudes by bin, the longitude bins, and which side is small."""

    lon: DataFrame
    lat: DataFrame
    start: float
    width: float
    last: int
    lon_small: bool | None = None
    lat_small: bool | None = None


def nearest_grid_value(
    points: DataFrame,
    grid: DataFrame | GridIndex,
    spread: Sequence[str],
    keys: Sequence[str] = MONTH,
    lon: str = "lon",
    lat: str = "lat",
    value: str = "chlor_a",
    out: str = "phyto",
    order: Sequence[str] | None = None,
    unique: bool = False,
    lon_bin: float | None = None,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Add ``c_lon``, ``c_lat`` and the value of the nearest cell to every point.

    Every point is kept; without a grid in its month, or without a coordinate, it
    gets nulls. ``spread`` names the columns that identify a point, ``lon`` and
    ``lat`` its coordinates; the grid's are called ``lon`` and ``lat``. ``unique``
    says that the grid has one row per cell already. Of duplicate cells the first by
    ``order`` counts; by default that is the order in the file where the grid has it, and
    else the least value. ``lon_bin`` is the bin width in degrees of the first step; by default
    it is the mean spacing of the grid's longitudes, as it is of the latitudes in the second.
    A ``GridIndex`` has its keys, value, order and bins; the arguments for these are not read then.
    """
    if isinstance(grid, GridIndex):
        axis, keys = grid.axis(points, broadcast_rows), grid.keys
    else:
        axis = _worked_out(points, grid, keys, value, order, unique, lon_bin, broadcast_rows)

    # names of the point's own columns never clash with the working columns
    work = points.withColumns({"__lon": _number(F.col(lon)), "__lat": _number(F.col(lat))})

    # step 1: longitude
    work = work.withColumn("__bin", _lon_bin(F.col("__lon"), axis.start, axis.width, axis.last))
    work = joins.lookup(
        work,
        axis.lon,
        [*keys, "__bin"],
        spread,
        condition=_holds("__lon"),
        small=axis.lon_small,
        broadcast_rows=broadcast_rows,
    )
    near = _nearer("__lon")
    work = work.withColumns(
        {
            "c_lon": near["at"],
            "__lat_bin": _lat_bin(F.col("__lat"), near["lat0"], near["step"], near["last"]),
        }
    ).drop("__lon", "__bin", "__from", "__until", "__below", "__above")

    # step 2: latitude on that longitude, and the value
    work = joins.lookup(
        work,
        axis.lat,
        [*keys, "c_lon", "__lat_bin"],
        spread,
        condition=_holds("__lat"),
        small=axis.lat_small,
    )
    near = _nearer("__lat")
    return work.withColumns({"c_lat": near["at"], out: near["value"]}).drop(
        "__lat", "__lat_bin", "__from", "__until", "__below", "__above"
    )


def _cells(grid: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] | None, unique: bool) -> DataFrame:
    if order is None:
        order = FILE_ORDER if set(FILE_ORDER) <= set(grid.columns) else ()
    cells = grid if unique else one_row_per_cell(grid, keys, value, order)
    return cells.select(
        *keys,
        F.col("lon").alias("g_lon"),
        F.col("lat").alias("g_lat"),
        F.col(value).alias("g_value"),
    )


def _worked_out(
    points: DataFrame,
    grid: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] | None,
    unique: bool,
    lon_bin: float | None,
    broadcast_rows: int,
) -> _Axis:
    # the cells are measured, counted and joined, and a grid that has to be worked out is so once
    cells = checkpointed(_cells(wanted_months(points, grid, keys), keys, value, order, unique))
    # n cells of a longitude are listed at most 2n times in the second step
    small = joins.has_at_most(cells, broadcast_rows // 4)
    # the axis is small, and is counted, measured and joined
    axis = checkpointed(lon_axis(cells, keys))
    bins = _axis_bins(axis, lon_bin)
    listed = checkpointed(lon_intervals(axis, keys, *bins))
    return _Axis(listed, lat_intervals(cells, keys), *bins, lat_small=small)


@dataclass(frozen=True)
class _Build:
    """A version of an index: where it lies, what it was made with, and how many rows it has."""

    number: int
    folder: str
    keys: list[str]
    start: float
    width: float
    last: int
    lon_rows: int
    lat_rows: int
    lon_schema: str
    lat_schema: str


class GridIndex:
    """The intervals of a grid, stored by its keys (year and month), so that no call works them out again.

    Building again publishes a new version in one step; readers of the old one are not disturbed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, commits.qualified(spark, path).rstrip("/")
        found = _versions(spark, self.path)
        if not found:
            raise FileNotFoundError(f"no grid index at {self.path}")
        self.build = _Build(**json.loads(commits.read_text(spark, f"{self.path}/versions/{found[-1]}")))

    @property
    def keys(self) -> list[str]:
        return self.build.keys

    def axis(self, points: DataFrame, broadcast_rows: int) -> _Axis:
        """The months that points ask for, or the whole index if it is small."""
        b = self.build
        lon, lat = (
            self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.path}/data/{b.folder}/{side}")
            for side, schema in (("lon", b.lon_schema), ("lat", b.lat_schema))
        )
        lon_small, lat_small = b.lon_rows <= broadcast_rows, b.lat_rows <= broadcast_rows // 2
        if not (lon_small and lat_small):
            lon, lat = wanted_months(points, lon, b.keys), wanted_months(points, lat, b.keys)
        return _Axis(lon, lat, b.start, b.width, b.last, lon_small, lat_small)


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [n for n in commits.names(spark, f"{path}/versions") if n.endswith(".json") and n[0] != "."]


def build_grid_index(
    grid: DataFrame,
    path: str,
    keys: Sequence[str] = MONTH,
    value: str = "chlor_a",
    order: Sequence[str] | None = None,
    unique: bool = False,
    lon_bin: float | None = None,
) -> GridIndex:
    """Work out the intervals of a grid and store them as a new version of the index at a path.

    The arguments mean what they do in ``nearest_grid_value``. Of two builds at the same time one wins
    and the other raises.
    """
    spark = grid.sparkSession
    top, folder = commits.qualified(spark, path).rstrip("/"), uuid.uuid4().hex
    cells = checkpointed(_cells(grid, keys, value, order, unique))
    axis = checkpointed(lon_axis(cells, keys))
    bins = _axis_bins(axis, lon_bin)
    facts = {}
    for side, df in (("lon", lon_intervals(axis, keys, *bins)), ("lat", lat_intervals(cells, keys))):
        place = f"{top}/data/{folder}/{side}"
        # a month's rows lie together, in several files where they are many
        df.repartition(*keys, F.pmod(F.xxhash64("__from"), F.lit(4))).write.partitionBy(*keys).parquet(place)
        facts[f"{side}_rows"] = spark.read.schema(df.schema).parquet(place).count()
        facts[f"{side}_schema"] = df.schema.json()
    number = len(_versions(spark, top)) + 1
    made = _Build(number, folder, list(keys), *bins, **facts)
    if not commits.publish(spark, f"{top}/versions/{number:012d}.json", json.dumps(asdict(made))):
        commits.remove(spark, f"{top}/data/{folder}")
        raise FileExistsError(f"another build of {top} was faster")
    return GridIndex(spark, path)


def wanted_months(points: DataFrame, grid: DataFrame, keys: Sequence[str] = MONTH) -> DataFrame:
    """Grid without the years and months that no point has.

    The filter is made of constants, so that it prunes the folders of a grid stored
    by year and month. A stream of points gets the whole grid.
    """
    if points.isStreaming:
        return grid
    found = points.select(*keys).distinct().limit(MONTHS + 1).collect()
    if len(found) > MONTHS:
        return grid
    for key in keys:
        grid = grid.filter(F.col(key).isin(sorted({r[key] for r in found} - {None})))
    return grid


def lon_axis(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A month's longitudes, each with what the second step needs to know of it.

    That is its least latitude, the mean spacing and the index of the last bin.
    """
    spacing = (F.max("g_lat") - F.min("g_lat")) / (F.count("g_lat") - 1)
    return cells.groupBy(*keys, "g_lon").agg(
        F.min("g_lat").alias("lat0"),
        F.when(F.count("g_lat") > 1, spacing).otherwise(F.lit(1.0)).alias("step"),
        (F.count("g_lat") - 1).alias("last"),
    )


def _axis_bins(axis: DataFrame, width: float | None) -> tuple[float, float, int]:
    """Start, width and last number of the longitude bins, from the axis of all months."""
    seen = axis.agg(F.min("g_lon"), F.max("g_lon"), F.count_distinct("g_lon")).first()
    if seen[0] is None:
        return 0.0, width or 1.0, 0
    if width is None:
        width = (seen[1] - seen[0]) / (seen[2] - 1) if seen[2] > 1 else 1.0
    return seen[0], width, int((seen[1] - seen[0]) // width)


def lon_intervals(axis: DataFrame, keys: Sequence[str], start: float, width: float, last: int) -> DataFrame:
    """Intervals between a month's longitudes, listed by bin."""
    ends = F.struct(F.col("g_lon").alias("at"), "lat0", "step", "last")
    listed = _intervals(axis, keys, "g_lon", ends)
    first = F.coalesce(_lon_bin(F.col("__from"), start, width, last), F.lit(0).cast("long"))
    final = F.coalesce(_lon_bin(F.col("__until"), start, width, last), F.lit(last).cast("long"))
    return listed.withColumn("__bin", F.explode(F.sequence(first, final)))


def lat_intervals(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Intervals between the latitudes of one longitude, listed by bin."""
    column = Window.partitionBy(*keys, "g_lon")
    lat0, n = F.min("g_lat").over(column), F.count("g_lat").over(column)
    spacing = (F.max("g_lat").over(column) - lat0) / (n - 1)
    sized = cells.withColumns(
        {
            "lat0": lat0,
            "step": F.when(n > 1, spacing).otherwise(F.lit(1.0)),
            "last": n - 1,
        }
    )
    ends = F.struct(F.col("g_lat").alias("at"), F.col("g_value").alias("value"))
    listed = _intervals(sized, [*keys, "g_lon"], "g_lat", ends, "lat0", "step", "last")

    def bin_of(end: str) -> Column:
        return _lat_bin(F.col(end), F.col("lat0"), F.col("step"), F.col("last"))

    first = F.coalesce(bin_of("__from"), F.lit(0).cast("long"))
    final = F.coalesce(bin_of("__until"), F.col("last"))
    return (
        listed.withColumn("__lat_bin", F.explode(F.sequence(first, final)))
        .withColumnRenamed("g_lon", "c_lon")
        .drop("lat0", "step", "last")
    )


def _intervals(
    axis: DataFrame, keys: Sequence[str], at: str, ends: Column, *keep: str
) -> DataFrame:
    """One row per value of an axis, with the value above it.

    The first interval is open below and the last one above (null limits).
    """
    ordered = Window.partitionBy(*keys).orderBy(at)
    return axis.select(
        *keys,
        *keep,
        F.when(F.lag(at).over(ordered).isNotNull(), F.col(at)).alias("__from"),
        F.lead(at).over(ordered).alias("__until"),
        ends.alias("__below"),
        F.lead(ends).over(ordered).alias("__above"),
    )


def _holds(target: str) -> Column:
    t, lo, hi = F.col(target), F.col("__from"), F.col("__until")
    return (lo.isNull() | (t >= lo)) & (hi.isNull() | (t < hi))


def _nearer(target: str) -> Column:
    """The end of the interval to take; ties go up.

    Distances are compared, never a midpoint, which rounding could move.
    """
    t, below, above = F.col(target), F.col("__below"), F.col("__above")
    lower = above.isNull() | (t - below["at"] < above["at"] - t)
    return F.when(lower, below).otherwise(above)


def _lon_bin(lon: Column, start: float, width: float, last: int) -> Column:
    at = F.floor((lon - start) / width)
    return F.when(at < 0, F.lit(0).cast("long")).when(at > last, F.lit(last).cast("long")).otherwise(at)


def _lat_bin(lat: Column, lat0: Column, step: Column, last: Column) -> Column:
    at = F.floor((lat - lat0) / step)
    return F.when(at < 0, F.lit(0).cast("long")).when(at > last, last).otherwise(at)


def _number(c: Column) -> Column:
    """Doubles without NaN, which would compare above everything."""
    return F.when(~F.isnan(c), c.cast("double"))
