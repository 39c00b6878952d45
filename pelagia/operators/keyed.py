"""First and sampled rows per key, row numbers, and batches."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.functions.dates import day as midnight
from pelagia.functions.draws import draw
from pelagia.sources.writers import checkpointed

# Rows in a piece of a group that are numbered by one task, on the average.
PIECE_ROWS = 100_000
# Pieces of a key whose rows are limited in two steps.
BUCKETS = 1024


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """First row of every key; the order should have no ties.

    Spark keeps one row per key and task before the shuffle, so a frequent key
    costs no more than a rare one.
    """
    return _first_n(df, keys, order, 1)


def sample_per_key(
    df: DataFrame, keys: Sequence[str], n: int, seed: int | str, row_key: Sequence[str]
) -> DataFrame:
    """``n`` random rows of every key without replacement, or all if there are fewer."""
    lot = draw(seed, *[F.col(c) for c in row_key])
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        # beyond what Spark limits before its shuffle: limit within pieces of a key first
        piece = F.pmod(F.xxhash64(*row_key), F.lit(BUCKETS))
        cut = df.withColumn("__part", piece)
        df = _first_n(cut, [*keys, "__part"], [lot, *row_key], n).drop("__part")
    return _first_n(df, keys, [lot, *row_key], n)


def _first_n(df: DataFrame, keys: Sequence[str], order: Sequence, n: int) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(ordered)).filter(F.col("__rn") <= n).drop("__rn")


def number_rows(
    df: DataFrame,
    lot: Column,
    tie: Sequence[str],
    by: Sequence[str] = (),
    out: str = "position",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Number the rows of every group from 0 by a draw in [0, 1), then by ``tie``.

    Draws are even, so equal ranges of them cut any group, and also the whole
    frame, into even pieces of about ``piece_rows`` rows. Rows are numbered within a piece, and
    the sizes of the pieces before it are added. No task ever sorts a whole group. The
    input is stored and computed once. Grouping columns must not be null. The draw must come
    from a key that identifies a row: rows that share a draw stay together.
    """
    stored = checkpointed(df.withColumn("__lot", lot))
    if by:
        counts = stored.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / piece_rows).alias("__pieces"))
        cut = stored.join(counts, list(by)).withColumn("__piece", F.floor(F.col("__lot") * F.col("__pieces")))
        cut = cut.drop("__pieces")
    else:
        cut = stored.withColumn("__piece", F.floor(F.col("__lot") * max(1, ceil(stored.count() / piece_rows))))
    piece = [*by, "__piece"]
    sizes = cut.groupBy(*piece).agg(F.count(F.lit(1)).alias("__size"))
    # one row for each piece: without groups these are the only rows of one task
    earlier = Window.partitionBy(*by).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *piece, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__start")
    )
    within = Window.partitionBy(*piece).orderBy("__lot", *tie)
    numbered = cut.withColumn("__at", F.row_number().over(within) - 1)
    return (
        numbered.join(starts, piece)
        .withColumn(out, F.col("__start") + F.col("__at"))
        .drop("__lot", "__piece", "__start", "__at")
    )


def shuffle_rows(df: DataFrame, seed: int | str, row_key: Sequence[str]) -> DataFrame:
    """Random order of all rows, given as a ``position`` from 0.

    ``row_key`` identifies a row.
    """
    return number_rows(df, draw(seed, *[F.col(c) for c in row_key]), row_key)


def batches(df: DataFrame, index: str, size: int = 100, out: str = "batch") -> DataFrame:
    """Batch number of rows that have a running index."""
    return df.withColumn(out, F.floor(F.col(index) / size))


def daily_batches(
    df: DataFrame,
    row_key: Sequence[str],
    date: str = "date",
    lat: str = "lat",
    lon: str = "lon",
    size: int = 100,
    seed: int | str = "batch",
) -> DataFrame:
    """Coordinates of each day, in lists of at most ``size``.

    Batches of one day are numbered from 0; which point is in which is drawn.
    """
    dated = df.select(
        midnight(F.col(date)).alias("day"), lat, lon, *row_key
    ).filter(F.col("day").isNotNull())
    lot = draw(seed, *[F.col(c) for c in row_key])
    numbered = number_rows(dated, lot, row_key, by=["day"])
    point = F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    return (
        batches(numbered, "position", size)
        .groupBy("day", "batch")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sort_array(F.collect_list(point)).alias("points"),
        )
    )


def group_slice(df: DataFrame, lo: int, hi: int, date: str = "date") -> DataFrame:
    """Rows of the day groups number ``lo`` to ``hi - 1``, counted from 0 by date."""
    day = midnight(F.col(date))
    days = df.select(day.alias("d")).filter("d is not null").distinct().orderBy("d")
    # the wanted days and one more, which is the end if there is one
    some = days.offset(lo).limit(hi - lo + 1)
    ends = some.agg(
        F.struct(
            F.min("d").alias("start"),
            F.when(F.count("d") > hi - lo, F.max("d")).alias("end"),
        )
    ).scalar()
    return df.filter((day >= ends["start"]) & (ends["end"].isNull() | (day < ends["end"])))
