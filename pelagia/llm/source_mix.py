"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected as many times as the source's target is of its size. The
documents of a source stand in a row, short texts first. The expected copies are added
up along the row from one random start, and a document is taken once for each whole number
that the sum passes at it. A document is thus taken the expected number of times, rounded up
or down, and as the row is ordered by size the words taken come near the target.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.llm.names import free
from pelagia.llm.ranks import rank_within
from pelagia.llm.storage import stored
from pelagia.llm.textbytes import pieces, word_bounds

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# Random starts drawn for each source.
STARTS = 16


def word_counts(documents: DataFrame) -> DataFrame:
    """Id, source and number of words of each document; a null text has none."""

    def count(batches):
        for batch in batches:
            sizes = [np.zeros(0, dtype=np.int64)]
            for _, _, data, ends in pieces(batch.column("text")):
                starts, _ = word_bounds(data, ends)
                sizes.append(np.diff(np.searchsorted(starts, ends)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), batch.column("row"), pa.array(np.concatenate(sizes))],
                ["doc_id", "source", "row", "size"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(F.lit(13), F.col("doc_id").cast("long"), "source", "text").alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(count, "doc_id long, source string, row long, size long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Source, its size, and the words to take from it.

    ``sizes`` has ``source`` and ``size``. Sources in order of their names' code points, null last,
    weigh as ``weights`` says, over and over. They share ``share`` of all words by weight;
    none gets more than ``most`` times its size, and what is over is shared again. There
    is one level at which all sources with a target below their bound stand: sources are
    filled in order of bound by weight until the level of the rest is under the next bound.
    """
    each = sizes.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    each = each.withColumn("w", weight).withColumn("bound", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("bound") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("source_size").over(everything) * share
    level = (total - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("w").over(after)
    each = each.withColumn("level", level)
    # Once a source is not filled, none after it is.
    filled = F.max(F.when(F.col("level") * F.col("w") < F.col("bound"), 1).otherwise(0)).over(
        by_level.rowsBetween(Window.unboundedPreceding, 0)
    )
    each = each.withColumn("open", filled == 1)
    first_open = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("open"), first_open * F.col("w")).otherwise(F.col("bound"))
    return each.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def sampled(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 10,
) -> DataFrame:
    """Per document id, source, size, the source's size and target, and copies and words taken.

    Null texts have no words. Rows of a source without words are expected as often as
    nothing is of nothing: never. Rows repeated in all of id, source and text may be
    taken unequally often; which of them is which does not matter. Null ids and sources are
    taken like others. ``row`` is a hash of id, source and text.
    """
    sizes = stored(word_counts(documents))
    goal = stored(targets(sizes, weights, share, most))
    # Documents of one source and size stand together; their row number follows from counts.
    per_size = sizes.groupBy("source", "size").agg(F.count("*").alias("n"))
    shorter = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    start = per_size.select("source", "size", F.coalesce(F.sum("n").over(shorter), F.lit(0)).alias("start"))
    ranked = rank_within(sizes, ["source", "size"], ["row", "doc_id"], "at").alias("l")
    placed = ranked.join(
        start.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.size") == F.col("r.size"))
    ).select("l.*", (F.col("l.at") + F.col("r.start")).alias("place"))
    joined = placed.alias("p").join(goal.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")))
    rate = F.when(F.col("g.source_size") > 0, F.col("g.target") / F.col("g.source_size")).otherwise(0.0)
    rows = stored(
        joined.select("p.doc_id", "p.source", "p.row", "p.size", "p.place", "g.source_size", "g.target", rate.alias("rate"))
    )

    # Starts are steps of 2**-20, so that adding whole numbers to them is exact.
    def copies(k: int):
        draw = F.xxhash64(F.lit(seed + k), F.coalesce("source", F.lit("")), F.col("source").isNull())
        u = F.pmod(draw, F.lit(1 << 20)) / float(1 << 20)
        return (F.floor(u + F.col("rate") * (F.col("place") + 1)) - F.floor(u + F.col("rate") * F.col("place"))).cast("long")

    # One start for each source: of a few drawn, that with the words nearest to the target.
    sums = rows.groupBy("source", "target").agg(
        F.array(*[F.sum(copies(k) * F.col("size")) for k in range(STARTS)]).alias("sums")
    )
    nearest = F.array_min(
        F.array(*[F.struct(F.abs(F.col("sums")[k] - F.col("target")), F.lit(k).alias("k")) for k in range(STARTS)])
    )
    chosen = sums.select("source", nearest["k"].alias("k")).alias("c")
    out = rows.alias("p").join(chosen, F.col("p.source").eqNullSafe(F.col("c.source"))).select("p.*", "c.k")
    out = out.withColumn("copies", F.element_at(F.array(*[copies(k) for k in range(STARTS)]), F.col("k") + 1))
    return out.drop("k", "rate", "place").withColumn("taken", F.col("copies") * F.col("size"))


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The documents, each as many times as the mix takes it, with their columns, whatever these are called.

    Null texts, and texts without words, are taken as often as others of their source. Rows that are equal in id, source and text are dealt
    their copies in the order of a hash of all their columns.
    """
    names = documents.columns
    row, n, copies, copy = free(names, "row", "n", "copies", "copy")
    taken = sampled(documents, **options).select(F.col("row").alias(row), F.col("copies").alias(copies))
    # They are numbered on both sides.
    taken = taken.withColumn(n, F.row_number().over(Window.partitionBy(row).orderBy(copies)))
    key = F.xxhash64(F.lit(13), F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    unlike = (T.MapType, T.VariantType)
    every = [F.col(f"`{f.name}`") for f in documents.schema.fields if not isinstance(f.dataType, unlike)]
    nth = Window.partitionBy(row).orderBy(F.xxhash64(F.lit(14), *every))
    keyed = documents.withColumn(row, key).withColumn(n, F.row_number().over(nth))
    out = keyed.join(taken.filter(F.col(copies) > 0), [row, n])
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*names)
