"""Reading sightings, weather parts, monthly rasters and tables."""

from __future__ import annotations

import csv
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.functions.coords import given_variant, to_number
from pelagia.functions.dates import has_date
from pelagia.operators.weather import stack
from pelagia.schemas import FILE_ORDER, SIGHTING
from pelagia.sources import commits


def read_sightings(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Sightings from JSON arrays, or from JSON lines, as ``build_training_set`` takes them.

    ``id`` is a hash of the file's name, what is written, and the number among rows that are equal in
    this: it does not depend on how files are split, or on their order.
    ``raw_date`` stays a text. Coordinates may be numbers or texts: ``lat`` and ``lon`` are their
    values, ``lat_text`` and ``lon_text`` what is written, and the ``_given`` flags tell
    which count for the map centre. ``rejected_sightings`` lists those that cannot be used.
    A file holding one array is read by one task, so large collections should come as
    lines or as many files.
    """
    raw = spark.read.schema(SIGHTING).option("multiLine", not lines).json(path)

    def text(name: str) -> Column:
        return F.try_variant_get(name, "$", "string").alias(f"{name[:3]}_text")

    def number(name: str) -> Column:
        return F.try_variant_get(name, "$", "double").alias(name[:3])

    rows = raw.select(
        F.col("date").alias("raw_date"),
        number("latitude"),
        number("longitude"),
        text("latitude"),
        text("longitude"),
        given_variant(F.col("latitude")).alias("lat_given"),
        given_variant(F.col("longitude")).alias("lon_given"),
        F.col("_metadata.file_name").alias("__file"),
    )
    return _identified(rows)


# Equal rows that are numbered in one go.
EQUAL_ROWS = 10_000


def _identified(rows: DataFrame) -> DataFrame:
    """Rows with an ``id`` from their values; equal ones, which are interchangeable, are counted and numbered."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("__n"))
    # very many equal rows are numbered by several tasks
    last = F.floor((F.col("__n") - 1) / EQUAL_ROWS)
    parts = counted.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("__part") * EQUAL_ROWS
    nth = F.sequence(first, F.least(F.col("__n"), first + EQUAL_ROWS) - 1)
    dealt = parts.repartition(F.xxhash64("__part", *rows.columns))
    return dealt.withColumn("__nth", F.explode(nth)).select(
        F.xxhash64(F.lit(1), *rows.columns, "__nth").alias("id"), *[c for c in rows.columns if c != "__file"]
    )


# Why a sighting cannot be used.
NO_LATITUDE = "latitude is no number"
NO_LONGITUDE = "longitude is no number"


def rejected_sightings(
    sightings: DataFrame, lat: str = "lat", lon: str = "lon", raw_date: str = "raw_date"
) -> DataFrame:
    """Dated sightings with a coordinate that is missing or no number, and the ``reason``.

    The filters of the training set leave these out; sightings without a date are left out
    by rule and are not listed.
    """
    reason = F.when(_missing(lat), NO_LATITUDE).when(_missing(lon), NO_LONGITUDE)
    return sightings.filter(has_date(F.col(raw_date))).withColumn("reason", reason).filter("reason is not null")


def _missing(name: str) -> Column:
    return F.col(name).isNull() | F.isnan(F.col(name).cast("double"))


def read_observation_parts(spark: SparkSession, path: str) -> DataFrame:
    """Stack CSV parts by column name, without their first (index) column.

    ``path`` is a glob. Duplicate rows of overlapping parts are kept.
    """
    parts = []
    for df in _csv_by_header(spark, _files(spark, path), marker="lat"):
        kept = df.drop(df.columns[0])
        parts.append(
            kept.withColumns(
                {
                    c: F.col(c).cast("timestamp_ntz") if c == "date" else to_number(F.col(c))
                    for c in kept.columns
                }
            )
        )
    if not parts:
        raise FileNotFoundError(f"no weather parts at {path}")
    return stack(*parts)


# Names of raster files: sensor, first and last day, anything, and the ending.
RASTER_NAME = r"^[^.]*\.([0-9]{4})([0-9]{2})[^.]*\.(?:.*\.)?csv$"


def raster_month(name: str) -> tuple[int, int] | None:
    """Year and month in a raster's file name, or None if it has none."""
    found = re.match(RASTER_NAME, name)
    return (int(found[1]), int(found[2])) if found else None


def month_files(paths: Sequence[str]) -> list[str]:
    """The raster file of each month: the first by name if there are several."""
    chosen: dict[tuple[int, int], str] = {}
    for path in sorted(paths, key=os.path.basename):
        month = raster_month(os.path.basename(path))
        if month is not None:
            chosen.setdefault(month, path)
    return list(chosen.values())


def read_monthly_grid(
    spark: SparkSession, folder: str, months: Iterable[tuple[int, int]] | None = None
) -> DataFrame:
    """Cells of the monthly rasters in a folder, with year and month.

    With ``months`` only the files of these years and months are opened. Cells that are no numbers, and rows with any empty column, are dropped. Files
    with other names are skipped. ``FILE_ORDER`` gives the order within a file.
    """
    files = month_files(_files(spark, os.path.join(folder, "*.csv")))
    if months is not None:
        wanted = set(months)
        files = [f for f in files if raster_month(os.path.basename(f)) in wanted]
    groups = _csv_by_header(spark, files, marker="lon")
    if not groups:
        raise FileNotFoundError(f"no raster files in {folder}")
    grids = []
    for df in groups:
        absent = {"lon", "lat", "chlor_a"} - set(df.columns)
        if absent:
            raise ValueError(f"raster without columns {sorted(absent)}")
        name = F.col("_metadata.file_name")
        placed = df.select(
            "*",
            F.regexp_extract(name, RASTER_NAME, 1).cast("int").alias("year"),
            F.regexp_extract(name, RASTER_NAME, 2).cast("int").alias("month"),
            F.col("_metadata.file_block_start").alias(FILE_ORDER[0]),
            F.monotonically_increasing_id().alias(FILE_ORDER[1]),
        )
        grids.append(
            clean_grid(placed).select("year", "month", "lon", "lat", "chlor_a", *FILE_ORDER)
        )
    return stack(*grids)


def clean_grid(df: DataFrame) -> DataFrame:
    """Coerce the cell columns to numbers and drop rows with any null."""
    numbers = {c: to_number(F.col(c)) for c in ("lon", "lat", "chlor_a")}
    return df.withColumns(numbers).dropna("any")


def read_table(
    spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """A stored table; CSV has a header, and its date is parsed by the schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows by an order."""
    return df.orderBy(*order).limit(n)


def _files(spark: SparkSession, path: str) -> list[str]:
    """File names only, without reading; none match gives an empty list.

    One folder is listed in one go, and its names are picked by the pattern; folders that are patterns
    themselves are listed by Spark.
    """
    folder, name = os.path.split(path)
    try:
        if not folder or any(c in folder for c in "*?[{"):
            return sorted(spark.read.text(path).inputFiles())
        found = spark.read.option("pathGlobFilter", name).text(folder).inputFiles()
        # not those of folders below, which Spark lists too
        depth = commits.qualified(spark, folder).rstrip("/").replace("///", "/").count("/") + 1
        return sorted(f for f in found if f.replace("///", "/").count("/") == depth)
    except Exception as error:  # the reader's own error class differs by deployment
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise


# Bytes of a file that are read at a time until its first line is whole, and files that one task opens.
HEAD_BYTES = 1 << 14
HEADS = 64


def _headers(spark: SparkSession, files: list[str]) -> list[tuple[str, list[str]]]:
    """First lines of the files, each with the files that begin with it. Tasks open the files.

    Only the different lines and the names of files come to the driver, which has the names anyway.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [_head(name) for name in batch.column("file").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(lines, pa.string())], ["file", "line"])

    tasks = max(1, -(-len(files) // HEADS))
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(tasks)
    found = listed.mapInArrow(read, "file string, line string").groupBy("line")
    return [(r["line"], r["files"]) for r in found.agg(F.sort_array(F.collect_list("file")).alias("files")).collect()]


def _head(file: str) -> str:
    """The first line of a file; little beyond the bytes that hold it is read."""
    if file.startswith("file:"):
        system, path = fs.LocalFileSystem(), unquote(urlsplit(file).path)
    else:
        system, path = fs.FileSystem.from_uri(file)
    with system.open_input_stream(path) as stream:
        raw = b""
        while b"\n" not in raw:
            more = stream.read(HEAD_BYTES)
            if not more:
                break
            raw += more
    return raw.split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r")


def _csv_by_header(spark: SparkSession, files: list[str], marker: str) -> list[DataFrame]:
    """One frame for every distinct header, read with that header as its columns.

    A single read of files with different headers would match columns by position. The
    header is a file's first line; headers that differ in quotes only are the same.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for line, group in _headers(spark, files) if files else ():
        groups.setdefault(tuple(next(csv.reader([line]), ())), []).extend(group)
    bad = sum(len(group) for names, group in groups.items() if marker not in names)
    if bad:
        raise ValueError(f"{bad} of {len(files)} files have no column {marker}")
    return [spark.read.option("header", True).csv(sorted(groups[names])) for names in sorted(groups)]
