"""Summaries of a table: ranges, medians, coverage, nulls, counts, map centre."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.functions.coords import given
from pelagia.operators.joins import GROUPS
from pelagia.schemas import LABEL
from pelagia.sources.writers import checkpointed


def date_range(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"))


def center(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    lat_given: Column | None = None,
    lon_given: Column | None = None,
) -> DataFrame:
    """Mean of the given latitudes and longitudes, each over its own count.

    Without data the centre is (0, 0). The flags tell which coordinates are given;
    by default those that are neither null nor zero.
    """
    lat_given = given(F.col(lat)) if lat_given is None else lat_given
    lon_given = given(F.col(lon)) if lon_given is None else lon_given
    return df.agg(
        F.coalesce(F.avg(F.when(lat_given, F.col(lat))), F.lit(0.0)).alias("center_lat"),
        F.coalesce(F.avg(F.when(lon_given, F.col(lon))), F.lit(0.0)).alias("center_lon"),
    )


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows, rows with a value, and their percentage (null without rows)."""
    total, matched = F.count(F.lit(1)), F.count(column)
    return df.agg(
        total.alias("total_rows"),
        matched.alias("matched_rows"),
        F.when(total > 0, matched / total * 100).alias("percent"),
    )


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and NaN of every column, and the number of rows."""
    kinds = dict(df.dtypes)

    def empty(name: str) -> Column:
        c = F.col(name)
        return c.isNull() | F.isnan(c) if kinds[name] in ("double", "float") else c.isNull()

    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(empty(c)).alias(c) for c in df.columns]
    )
    entry = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(c).alias("column_name"),
            F.col(c).alias("nulls"),
            F.col("__rows").alias("rows"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counted.select(F.inline(F.array(*entry)))


def feature_ranges(df: DataFrame, columns: Sequence[str], padding: float = 0.1) -> DataFrame:
    """Least and greatest value of each feature, widened by a part of the range."""
    limits = df.agg(
        *[
            F.struct(F.min(_value(c)).alias("lo"), F.max(_value(c)).alias("hi")).alias(c)
            for c in columns
        ]
    )
    rows = limits.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.col(c)["lo"].alias("lo"),
                        F.col(c)["hi"].alias("hi"),
                    )
                    for c in columns
                ]
            )
        )
    )
    pad = (F.col("hi") - F.col("lo")) * padding
    return rows.select(
        "feature", (F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi")
    )


def feature_medians(
    df: DataFrame, columns: Sequence[str], accuracy: int = 1000, bins: int = 512, most: int = 100_000
) -> DataFrame:
    """Exact medians of many columns, the mean of the two middle values.

    Spark's own exact median keeps every distinct value in one task. Here quantile
    sketches of fixed size first bracket the middle. Then the rows are counted by bins
    of the bracket, and the bins that hold the middle become the next bracket, until it has
    at most ``most`` rows or one value. Only what is in the last bracket is ranked.

    The columns are stored first, so that a table that has to be worked out is so once, and not for every
    pass. The sketches are merged in groups of tasks. The middle of all rows lies between
    the least and the greatest middle of the groups. Of each column two numbers per group
    and three per bin are read.
    """
    margin = 10.0 / accuracy
    df = checkpointed(df.select(*[_value(c).alias(c) for c in columns]))
    at = F.array(F.lit(max(0.0, 0.5 - margin)), F.lit(min(1.0, 0.5 + margin)))
    numbers = df.select(
        F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("__group"),
        *[_value(c).alias(c) for c in columns],
    )
    grouped = numbers.groupBy("__group").agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.percentile_approx(c, at, accuracy).alias("ends"),
            ).alias(c)
            for c in columns
        ]
    )
    groups = grouped.collect()
    found = {}
    for c in columns:
        filled = [g[c] for g in groups if g[c]["n"] > 0]
        if filled:
            found[c] = (
                sum(g["n"] for g in filled),
                min(g["ends"][0] for g in filled),
                max(g["ends"][1] for g in filled),
            )
    if not found:
        return df.sparkSession.createDataFrame([], "feature string, median double")
    state = {c: (lo, hi, None) for c, (n, lo, hi) in found.items()}
    middle: dict[str, tuple[float, float, int, int]] = {}
    while state:
        for c, rows in _bin_counts(df, state, bins).items():
            n = sum(size for size, _, _ in rows)
            before, kept, start = 0, [], 0
            for size, lo, hi in rows:
                # ranks (n - 1) / 2 rounded down and up
                if before <= n // 2 and before + size > (n - 1) // 2:
                    start = start if kept else before
                    kept.append((size, lo, hi))
                before += size
            lo, hi = min(k[1] for k in kept), max(k[2] for k in kept)
            size, last = sum(k[0] for k in kept), state[c][2]
            if size <= most or lo == hi or size == last:
                middle[c] = (lo, hi, start, n)
                del state[c]
            else:
                state[c] = (lo, hi, size)

    listed = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                _value(c).alias("value"),
                F.lit(lo).alias("lo"),
                F.lit(hi).alias("hi"),
                F.lit(start).cast("long").alias("before"),
                F.lit(n).cast("long").alias("n"),
            )
            for c, (lo, hi, start, n) in middle.items()
        ]
    )
    ranked = (
        df.select(F.inline(listed))
        .filter(F.col("value").between(F.col("lo"), F.col("hi")))
        .groupBy("feature", "n", "before", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    within = Window.partitionBy("feature").orderBy("value")
    placed = ranked.withColumn("start", F.col("before") + _sum_before("copies", within))
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)

    def at_rank(rank: Column) -> Column:
        here = (F.col("start") <= rank) & (rank < F.col("start") + F.col("copies"))
        return F.max(F.when(here, F.col("value")))

    return placed.groupBy("feature").agg(((at_rank(low) + at_rank(high)) / 2).alias("median"))


def _bin_counts(
    df: DataFrame, state: dict[str, tuple], bins: int
) -> dict[str, list[tuple[int, float, float]]]:
    """Number, least and greatest of the values in each bin of each bracket, and beside it, in order."""
    listed = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), _value(c).alias("value"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
            for c, (lo, hi, _) in state.items()
        ]
    )
    width = F.col("hi") - F.col("lo")
    inner = F.least(F.floor((F.col("value") - F.col("lo")) / width * bins), F.lit(bins - 1))
    place = (
        F.when(F.col("value") < F.col("lo"), F.lit(-1))
        .when(F.col("value") > F.col("hi"), F.lit(bins))
        .when(width > 0, inner)
        .otherwise(F.lit(0))
    )
    counted = (
        df.select(F.inline(listed))
        .filter("value is not null")
        .groupBy("feature", place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("size"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .collect()
    )
    out: dict[str, list] = {c: [] for c in state}
    for row in sorted(counted, key=lambda r: r["bin"]):
        out[row["feature"]].append((row["size"], row["lo"], row["hi"]))
    return out


def _sum_before(column: str, window) -> Column:
    rows = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(rows), F.lit(0))


def _value(name: str) -> Column:
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)
