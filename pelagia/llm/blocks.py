"""Groups of rows in order, and large groups cut into pairs of blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped(batches: Iterator[pa.RecordBatch], key: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches in which equal keys follow each other."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for name in key:
            column = table[name].combine_chunks().to_numpy(zero_copy_only=False)
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            part = table.slice(first, last - first)
            if held and any(held[0][k][0].as_py() != part[k][0].as_py() for k in key):
                yield pa.concat_tables(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_tables(held)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as compressed bytes: the first bytes of all values, then the second ones, and so on."""
    n = len(columns[0])
    planes = []
    for c in columns:
        bits = np.ascontiguousarray(c).view(f"<u{c.itemsize}")
        planes += [(bits >> bits.dtype.type(8 * k)).astype(np.uint8).tobytes() for k in range(c.itemsize)]
    raw = b"".join(planes)
    return n.to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    """The columns that were packed, by their kinds."""
    n, out, at = int.from_bytes(blob[:8], "little"), [], 0
    widths = [np.dtype(k).itemsize for k in kinds]
    raw = pa.decompress(blob[8:], n * sum(widths), "zstd", asbytes=True) if n else b""
    for kind, width in zip(kinds, widths, strict=True):
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * width, offset=at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out


def block_pairs(df: DataFrame, key: Sequence[str], member: str, size: int) -> DataFrame:
    """Rows of groups of two and more, repeated for each pair of blocks they belong to.

    A group of n rows is cut by a hash of ``member`` into n / ``size`` blocks, rounded up.
    Adds ``block``, and ``left`` <= ``right``, the pair. Every two rows of a group meet in
    exactly one pair, so that no task holds a whole large group.
    """
    counts = df.groupBy(*key).agg(F.ceil(F.count("*") / size).cast("int").alias("__blocks"), F.count("*").alias("__n"))
    cut = df.join(counts.filter("__n > 1").drop("__n"), list(key))
    cut = cut.withColumn("block", F.pmod(F.xxhash64(F.lit(7), member), F.col("__blocks")).cast("int"))
    one = F.array(F.lit(0))
    others = F.when(F.col("__blocks") == 1, one).otherwise(F.sequence(F.lit(0), F.col("__blocks") - 1))
    cut = cut.withColumn("__other", F.explode(others))
    return cut.select(
        "*", F.least("block", "__other").alias("left"), F.greatest("block", "__other").alias("right")
    ).drop("__blocks", "__other")


def in_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Equal keys in one partition, one after the other."""
    return df.repartition(*[F.col(k) for k in key]).sortWithinPartitions(*key)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the given edges connect: each node and the least it reaches."""
    label = np.arange(n)
    while len(left):
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    nodes = np.flatnonzero(label != np.arange(n))
    return nodes, label[nodes]
