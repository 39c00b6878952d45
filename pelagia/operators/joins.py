"""Lookups that stay balanced when a few keys hold most of the rows.

A lookup attaches to every left row the matching rows of a right table with few
rows per key. The right side is broadcast only when a count proves it small.
Otherwise both sides are shuffled, and the keys found to be frequent on the left
are spread over several partitions; their right rows are repeated as often.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# No shuffle partition should get more than about 1/PIECES of the left rows, or less where there
# are more partitions, up to the second number.
PIECES = 256
MOST_PIECES = 10_000

# Groups of tasks whose sketches are merged, so that no single task merges all of them.
GROUPS = 64

# Right sides up to this many rows are broadcast (a few dozen bytes per row).
BROADCAST_ROWS = 200_000

_SALT = "__salt"


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether a frame is small, found by taking rows until there are too many."""
    return rows > 0 and not df.select(F.lit(1).alias("one")).offset(rows).head(1)


def frequent_keys(df: DataFrame, keys: Sequence[str], pieces: int = PIECES) -> dict[int, int]:
    """Hash of every frequent key, and the number of pieces to cut it into.

    One narrow pass with sketches of fixed size: one per task, merged in ``GROUPS``
    groups. A key with more than 1/pieces of all rows has as much of some group, so
    it is on that group's list. The lists only decide where rows go. A key
    that is counted wrongly costs time and never changes a result. They are read
    once, since a second run may differ and the two sides of a join must agree.
    """
    hashed = df.select(
        F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g"), F.xxhash64(*keys).alias("h")
    )
    lists = (
        hashed.groupBy("g")
        .agg(
            F.expr(f"approx_top_k(h, {pieces}, {8 * pieces})").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
        .collect()
    )
    total = sum(group["n"] for group in lists)
    counts: Counter[int] = Counter()
    for group in lists:
        for entry in group["top"]:
            counts[entry["item"]] += entry["count"]
    return {key: ceil(n * pieces / total) for key, n in counts.items() if n * pieces > total}


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    condition: Column | None = None,
    small: bool | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    pieces: int | None = None,
) -> DataFrame:
    """Equi-join on ``keys``, optionally with a further condition.

    ``spread`` names left columns that identify a row (or nearly so): they decide
    where the rows of a frequent key go. Apart from the keys, the two sides must
    not share column names, so that the condition can use plain names.
    The right side is broadcast if it has at most ``broadcast_rows`` rows. Where that
    is known from a frame that is cheaper to count, such as the table the side is
    made from, ``small`` gives the answer.
    """
    if how not in ("left", "inner"):
        raise ValueError("a lookup is a left or an inner join")
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    right = _with_types_of(left, right, keys)

    if small is None:
        small = has_at_most(right, broadcast_rows)
    if small:
        return _join(left, F.broadcast(right), keys, condition, how)
    if left.isStreaming:  # a micro-batch is bounded, and has no totals to take
        return _join(left, right, keys, condition, how)

    if pieces is None:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pieces = min(max(PIECES, partitions), MOST_PIECES)
    hot = frequent_keys(left, keys, pieces)
    if not hot:
        return _join(left, right, keys, condition, how)
    table = F.map_from_arrays(
        F.lit(list(hot)).cast("array<bigint>"), F.lit(list(hot.values())).cast("array<int>")
    )
    copies = F.coalesce(F.try_element_at(table, F.xxhash64(*keys)), F.lit(1))
    left = left.withColumn(_SALT, F.pmod(F.xxhash64(*spread), copies.cast("long")).cast("int"))
    right = right.withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), (copies - 1).cast("int")))
    )
    return _join(left, right, [*keys, _SALT], condition, how).drop(_SALT)


def bucketed_lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", pieces: int | None = None
) -> DataFrame:
    """Equi-join with a table bucketed by ``keys`` that has one row per key, which is not moved.

    Only the left rows are shuffled, into the table's buckets. Rows of the keys found to be frequent are
    left where they are: the few rows that the table has for these keys, at most one for each, are broadcast.
    """
    if how not in ("left", "inner"):
        raise ValueError("a lookup is a left or an inner join")
    hot = {} if left.isStreaming else frequent_keys(left, keys, pieces or PIECES)
    if not hot:
        return left.join(right, list(keys), how)
    listed = F.coalesce(F.xxhash64(*keys).isin(list(hot)), F.lit(False))
    few = F.broadcast(right.filter(listed))
    rest = left.filter(~listed).join(right, list(keys), how)
    return rest.unionByName(left.filter(listed).join(few, list(keys), how))


def _with_types_of(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Right side with the left's key types, since equal numbers of two types hash apart."""
    for k in keys:
        want, have = left.schema[k].dataType, right.schema[k].dataType
        if want == have:
            continue
        if not (isinstance(want, T.IntegralType) and isinstance(have, T.IntegralType)):
            raise ValueError(f"key {k} is {want.simpleString()} and {have.simpleString()}")
        # a number that does not fit becomes null, and would not have matched
        right = right.withColumn(k, F.col(k).try_cast(want))
    return right


def _join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], condition: Column | None, how: str
) -> DataFrame:
    if condition is None:
        return left.join(right, list(keys), how)
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = condition
    for k in keys:
        on = on & (F.col(k) == F.col(f"__r_{k}"))
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])
