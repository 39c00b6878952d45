"""Random background points and days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions.draws import draw_between, draw_index
from pelagia.operators.keyed import batches
from pelagia.schemas import Box

# Rows made by one step of a task.
CHUNK = 1_000_000


def running_ids(spark: SparkSession, n: int | Column) -> DataFrame:
    """Ids 0 to n - 1; ``n`` may be a scalar subquery, so that nothing is collected."""
    if isinstance(n, int):
        return spark.range(n)
    # a list of chunks first, spread over the tasks, then the ids of each chunk
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = (
        spark.range(1)
        .select(n.cast("long").alias("n"))
        .filter("n > 0")
        .select("n", F.explode(F.expr(f"sequence(0L, (n - 1) div {CHUNK})")).alias("chunk"))
        .repartition(parts, "chunk")
    )
    ids = f"sequence(chunk * {CHUNK}, least(n, (chunk + 1) * {CHUNK}) - 1)"
    return chunks.select(F.explode(F.expr(ids)).alias("id"))


def uniform_points(
    spark: SparkSession, n: int | Column, box: Box = Box(), seed: int | str = 42
) -> DataFrame:
    """``n`` points, latitude and longitude uniform in the box."""
    return running_ids(spark, n).select(
        "id",
        draw_between(box.lat_min, box.lat_max, f"{seed}:lat", F.col("id")).alias("lat"),
        draw_between(box.lon_min, box.lon_max, f"{seed}:lon", F.col("id")).alias("lon"),
    )


def draw_days(
    points: DataFrame,
    first: Column,
    last: Column,
    rounds: int = 3,
    size: int = 100,
    seed: int | str = 42,
) -> DataFrame:
    """A random day in [first, last) for each batch of points, in every round.

    The last day is left out, except where the range has one day only.
    """
    days = F.greatest(_whole_days(first, last), F.lit(1))
    drawn = (
        batches(points, "id", size)
        .withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
        .withColumn("__days", days)
    )
    shift = draw_index(F.col("__days"), f"{seed}:day", F.col("round"), F.col("batch"))
    return drawn.withColumn(
        "date", (first + F.make_dt_interval(days=shift.cast("int"))).cast("timestamp_ntz")
    ).drop("__days")


def _whole_days(first: Column, last: Column) -> Column:
    return F.extract(F.lit("DAY"), last - first)
