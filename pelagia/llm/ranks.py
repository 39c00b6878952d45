"""Row numbers within keys, also where one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key that one task sorts, on the average.
PIECE = 100_000


def rank_within(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str, piece: int = PIECE) -> DataFrame:
    """Number the rows of each key from 0 without gaps; every run gives the same numbers.

    ``df`` should be stored: it is read twice. A key is cut into as many pieces as its rows
    need, by a hash of ``order``; rows are numbered in their piece by that hash and
    then ``order``, and the sizes of the pieces before are added. The pieces of a key are
    numbered one after another, so a window sees one row for each piece and not the rows.
    """
    draw = F.xxhash64(F.lit(17), *order)
    counts = df.groupBy(*key).agg(F.ceil(F.count("*") / piece).cast("int").alias("__pieces"))
    same = None
    for k in key:
        condition = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        same = condition if same is None else same & condition
    cut = df.withColumn("__draw", draw).alias("l").join(counts.alias("r"), same)
    cut = cut.select("l.*", F.pmod(F.shiftright("l.__draw", 20), F.col("r.__pieces")).cast("int").alias("__piece"))

    sizes = cut.groupBy(*key, "__piece").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*key).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*key, "__piece", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))

    inside = Window.partitionBy(*key, "__piece").orderBy("__draw", *order)
    numbered = cut.withColumn("__at", F.row_number().over(inside) - 1)
    joined = numbered.alias("l").join(starts.alias("r"), same & (F.col("l.__piece") == F.col("r.__piece")))
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns], (F.col("r.__start") + F.col("l.__at")).cast("long").alias(name)
    )
