"""Probability surfaces over pairs of features."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence
from itertools import combinations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.operators.profile import feature_medians, feature_ranges
from pelagia.schemas import LABEL

# The pairs of features that are looked at by default.
DEFAULT_PAIRS = [
    ("temperature", "ocean_depth"),
    ("phyto", "temperature"),
    ("phyto", "ocean_depth"),
    ("temperature", "max_individual_wave_height"),
    ("ocean_depth", "max_individual_wave_height"),
    ("phyto", "max_individual_wave_height"),
    ("temperature", "clouds"),
    ("phyto", "clouds"),
    ("lon", "lat"),
    ("mean_wave_direction", "mean_period_total_swell"),
]


def feature_pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    """Every pair of features, in their order."""
    return list(combinations(names, 2))


def known_pairs(
    pairs: Iterable[tuple[str, str]], names: Sequence[str]
) -> list[tuple[str, str]]:
    """Pairs of features that exist; others are left out with a warning."""
    kept = []
    for pair in pairs:
        if set(pair) <= set(names):
            kept.append(tuple(pair))
        else:
            warnings.warn(f"skipping {pair}: not among the features", stacklevel=2)
    return kept


def axis(lo: Column, hi: Column, i: Column, n: int) -> Column:
    """Value ``i`` of ``n`` evenly spaced ones, both ends included."""
    return lo + i * (hi - lo) / max(n - 1, 1)


def feature_grid(
    df: DataFrame,
    names: Sequence[str],
    pairs: Iterable[tuple[str, str]],
    n: int = 50,
) -> DataFrame:
    """Model rows of all pairs: ``n`` by ``n`` points, other features at the median.

    The table is read for its ranges and medians only. The grid itself is made
    from one row of those.
    """
    pairs = known_pairs(pairs, names)
    if not pairs:
        raise ValueError("no pair of known features")
    ranges = feature_ranges(df, names).select(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("lo", "hi"))))
    )
    medians = feature_medians(df, names).select(
        F.map_from_entries(F.collect_list(F.struct("feature", "median")))
    )
    spark = df.sparkSession
    listed = F.array(
        *[F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2")) for a, b in pairs]
    )
    steps = F.sequence(F.lit(0), F.lit(n - 1))
    base = spark.range(1).select(
        ranges.scalar().alias("r"), medians.scalar().alias("m"), F.explode(listed).alias("p")
    )
    placed = (
        base.select("r", "m", "p.*", F.explode(steps).alias("i"))
        .select("*", F.explode(steps).alias("j"))
        .withColumns(
            {
                "x": _along(F.col("feature1"), F.col("j"), n),
                "y": _along(F.col("feature2"), F.col("i"), n),
            }
        )
    )
    value = {
        f: F.when(F.col("feature1") == f, F.col("x"))
        .when(F.col("feature2") == f, F.col("y"))
        .otherwise(F.try_element_at("m", F.lit(f)))
        for f in names
    }
    return placed.select(
        "feature1", "feature2", "i", "j", "x", "y", *[c.alias(f) for f, c in value.items()]
    )


def surfaces(
    model: PipelineModel,
    df: DataFrame,
    pairs: Iterable[tuple[str, str]] = DEFAULT_PAIRS,
    n: int = 50,
) -> DataFrame:
    """Probability at every grid point of every pair, by one run of the model."""
    from pelagia.plans.model import feature_names, score

    rows = feature_grid(df, feature_names(model), pairs, n)
    return score(rows, model).select(
        "feature1", "feature2", "i", "j", "x", "y", "probability"
    )


def surface(
    model: PipelineModel, df: DataFrame, feature1: str, feature2: str, n: int = 50
) -> DataFrame:
    """Probability surface of one pair."""
    return surfaces(model, df, [(feature1, feature2)], n)


def positives(
    df: DataFrame, pairs: Iterable[tuple[str, str]], label: str = LABEL
) -> DataFrame:
    """Points of the positive rows on each pair's plane, where both values exist."""
    points = F.array(
        *[
            F.struct(
                F.lit(a).alias("feature1"),
                F.lit(b).alias("feature2"),
                F.col(a).cast("double").alias("x"),
                F.col(b).cast("double").alias("y"),
            )
            for a, b in pairs
        ]
    )
    found = df.filter(F.col(label) == 1).select(F.inline(points))
    return found.filter(
        F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    )


def _along(feature: Column, i: Column, n: int) -> Column:
    limits = F.try_element_at(F.col("r"), feature)
    return axis(limits["lo"], limits["hi"], i, n)
