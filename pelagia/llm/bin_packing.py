"""Best-fit-decreasing packing of indivisible groups into shards of fixed capacity.

Groups, largest first, go to the fullest shard that still takes them; a new shard is opened
when none does. What this needs of the groups is how many there are of each size. Groups of
one size are placed together: as many as fit into the tightest shard, the next into the
tightest then, and so on. The sizes are counted on the cluster, and the packing of the
counts says how many groups of each size every shard gets. Different sizes
are few: if there are m, they add up to m * m / 2 at least, so that m is less than the square
root of twice the total. Groups are then numbered within their size, and the number
tells the shard.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.ranks import rank_within
from pelagia.llm.storage import stored


class Free:
    """Shards by free room in a balanced tree: the tightest that takes a size, in log time.

    A treap: ordered by (room, shard), and a heap by a scrambled shard number, which
    keeps it balanced whatever the order of entries is.
    """

    def __init__(self):
        self._root = None

    def add(self, room: int, shard: int) -> None:
        node = [(room, shard), (shard * 0x9E3779B1 + room * 0x85EBCA6B) & 0xFFFFFFFF, None, None]
        below, above = self._split(self._root, node[0])
        self._root = self._merge(self._merge(below, node), above)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the least (room, shard) with room for the size."""
        below, above = self._split(self._root, (size, -1))
        if above is None:
            self._root = below
            return None
        first = above
        while first[2] is not None:
            first = first[2]
        _, rest = self._split(above, (first[0][0], first[0][1] + 1))
        self._root = self._merge(below, rest)
        return first[0]

    def _split(self, node, key):
        """Nodes below the key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return [a[0], a[1], a[2], self._merge(a[3], b)]
        return [b[0], b[1], self._merge(a, b[2]), b[3]]


def pack(counts: Iterable[tuple[int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Place groups given as (size, how many); sizes above the capacity get a shard each.

    Returns (size, first number, number after the last, shard) and the shards opened.
    """
    free, out, opened = Free(), [], 0
    for size, many in sorted(counts, reverse=True):
        at = 0
        while at < many:
            found = free.take(size)
            if found is None:
                found = (max(capacity, size), opened)
                opened += 1
            room, shard = found
            fits = min(many - at, room // size) if size else many - at
            out.append((size, at, at + fits, shard))
            at += fits
            if room > fits * size:
                free.add(room - fits * size, shard)
    return out, opened


def least_capacity(counts: list[tuple[int, int]], shards: int) -> int:
    """A capacity, close to an even share, with which no more than ``shards`` are opened.

    A group above the even share has a shard of its own and the others share the rest.
    """
    sizes = sorted(counts, reverse=True)
    total, left = sum(s * n for s, n in sizes), shards
    for size, many in sizes:
        for _ in range(min(many, left)):
            if left < 2 or size * left <= total:
                break
            total, left = total - size, left - 1
        else:
            continue
        break
    low = max(1, -(-total // max(1, left)))
    step, high = 1, low
    while pack(sizes, high)[1] > shards:
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        middle = (low + high) // 2
        if pack(sizes, middle)[1] > shards:
            low = middle + 1
        else:
            high = middle
    return high


def sharded(documents: DataFrame, shards: int = 8, capacity: int | None = None) -> DataFrame:
    """Every document's size, text checksum, shard, and place in the shard from 0.

    The size is the bytes of the text in UTF-8 (none for null) and one. Documents of equal
    text, nulls among themselves, are a group and stay together; groups are told apart by
    length and SHA-256. With ``capacity`` as many shards are opened as needed, otherwise the
    least capacity found that ``shards`` suffice for. Repeated rows have a place each.
    """
    text = F.col("text").cast("string")
    raw = F.coalesce(text.cast("binary"), F.lit(b""))
    rows = stored(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.unhex(F.sha2(raw, 256)).alias("digest"),
            text.isNull().alias("none"),
        )
    )
    groups = stored(rows.groupBy("none", "digest").agg(F.sum("size").alias("group_size")))
    found = groups.groupBy("group_size").agg(F.count("*").alias("n")).toPandas()
    counts = list(zip(found["group_size"].tolist(), found["n"].tolist(), strict=True))
    if capacity is None:
        capacity = least_capacity(counts, shards)
    plan, opened = pack(counts, capacity)
    spark = documents.sparkSession
    where = spark.createDataFrame(
        [(s, a, b, k) for s, a, b, k in plan], "group_size long, first long, after long, shard int"
    )
    ranked = rank_within(groups, ["group_size"], ["digest", "none"], "number")
    placed = ranked.join(where, "group_size").filter("number >= first and number < after")
    with_shard = stored(rows.join(placed.select("none", "digest", "shard"), ["none", "digest"]))
    numbered = rank_within(with_shard.drop("none"), ["shard"], ["digest", "doc_id"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot", F.lit(opened).alias("shards"))
