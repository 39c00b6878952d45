"""Document fingerprints by one-permutation MinHash, with DataFrame functions only.

Each five-word shingle is hashed once; the first bits of the hash choose a bin, which keeps its least hash. A
bin that stays empty takes the value of another: an order of all bins is drawn for each bin, the same
for all texts, and the first bin in it that is filled lends its value (optimal densification). Of each value
the low-order bits are stored. Two different values agree in these bits by chance, so the share of
equal bins m estimates the likeness as (m - c) / (1 - c) with c = 2**-bits.

The order of bin i is c(i) + a(i) * t modulo the prime 257 for t = 0, 1, ...; numbers beyond the bins are passed
over. The first few are looked up one by one; where all of these are empty, the filled bins
are ranked by their place in the order, which gives the same bin.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.llm.names import free, others

WIDTH = 5
# Bins, the bits of a hash that choose one, and the bits that are stored of a value.
BINS, BIN_BITS, BITS = 256, 8, 8
PRIME = 257
# Places of an order that are looked up one by one.
LOOKS = 8
# Rows of a stretch of documents in order that one task sorts, on the average.
STRETCH = 100_000

_LOW = (1 << 64 - BIN_BITS) - 1
_BLANK = "[ \\t-\\r]+"


def _orders() -> list[list[int]]:
    """For each bin the first places of its order, the order's start, and its step's inverse."""
    out = []
    for i in range(BINS):
        # A fixed draw for each bin (a multiplicative hash of its number).
        draw = (i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
        start, step = (draw >> 40) % PRIME, 1 + (draw >> 16 & 0xFFFFFF) % (PRIME - 1)
        out.append([*((start + step * t) % PRIME for t in range(LOOKS)), start, pow(step, -1, PRIME)])
    return out


def _hashes(words: Column, width: int) -> Column:
    """Sorted hashes of all shingles, with the greatest number of every bin as its last."""
    last = [(b << 64 - BIN_BITS | _LOW) - (1 << 64 if b >= BINS // 2 else 0) for b in range(BINS)]
    at = F.sequence(F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(1)))
    shingles = F.when(F.size(words) > 0, F.transform(at, lambda i: F.xxhash64(F.slice(words, i, width))))
    return F.sort_array(F.concat(F.coalesce(shingles, F.array().cast("array<bigint>")), F.lit(last)))


def _bin(h: Column) -> Column:
    """Bins follow the signed order of the hashes."""
    return F.shiftright(h, 64 - BIN_BITS) + BINS // 2


def with_fingerprint(df: DataFrame, text: str, name: str, width: int = WIDTH) -> DataFrame:
    """All columns and a fingerprint of one of them, in hexadecimal digits.

    Words are runs without ASCII white space, lower-cased; fewer than ``width`` are one shingle. Texts
    without words, and null, have the empty fingerprint. Equal texts have equal fingerprints. A column
    that has the name gives way.
    """
    kept = others(df, [name])
    words, hashes, least, bins = free([*df.columns, name], "words", "hashes", "least", "bins")
    # Each step is a column of its own, so that it is worked out once.
    plain = F.btrim(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    split = F.when(plain != "", F.split(plain, _BLANK)).otherwise(F.array().cast("array<string>"))
    out = df.withColumn(words, split).withColumn(hashes, _hashes(F.col(words), width))
    first = F.filter(
        F.col(hashes), lambda h, i: (i == 0) | (F.shiftright(h, 56) != F.shiftright(F.get(hashes, i - 1), 56))
    )
    out = out.withColumn(least, first)
    value = F.transform(F.col(least), lambda h: F.when(h.bitwiseAND(F.lit(_LOW)) != _LOW, h))
    out = out.withColumn(bins, value).withColumn(least, F.array_compact(bins))

    def taken(order: Column, i: Column) -> Column:
        looks = [F.get(bins, order[t]) for t in range(LOOKS)]
        # The place of a filled bin in the order; the least is taken, with its value.
        place = lambda h: F.pmod((_bin(h).cast("int") - order[LOOKS]) * order[LOOKS + 1], F.lit(PRIME))
        ranked = F.transform(F.col(least), lambda h: F.struct(place(h).alias("p"), h.alias("h")))
        return F.coalesce(F.get(bins, i), *looks, F.array_min(ranked)["h"])

    digits = BITS // 4
    low = lambda h: F.substring(F.hex(h.bitwiseAND(F.lit((1 << BITS) - 1)) + (1 << BITS)), 2, digits)
    orders = F.from_json(F.lit(str(_orders())), "array<array<int>>")
    packed = F.array_join(F.transform(orders, lambda order, i: low(taken(order, i))), "")
    made = F.when(F.size(least) > 0, F.lower(packed)).otherwise("")
    return out.select(*kept, made.alias(name))


def likeness(a: str, b: str) -> Column:
    """Estimated share of common shingles of two fingerprints, 0 to 1; two empty ones are alike."""
    # Bytes are found at once, characters only by going through those before.
    x, y = F.unhex(a), F.unhex(b)
    same = F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substr(x, i, F.lit(1)) == F.substr(y, i, F.lit(1)))
    chance = 2.0**-BITS
    corrected = F.greatest((F.size(same) / BINS - chance) / (1 - chance), F.lit(0.0))
    # Also where both are empty.
    return F.when(F.col(a) == F.col(b), 1.0).when((F.col(a) == "") | (F.col(b) == ""), 0.0).otherwise(corrected)


def _place(id: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts, but for the first, are not above the id; nulls come last."""
    if len(cuts) < 2:
        return F.lit(0)
    table = F.from_json(F.lit(str(cuts)), "array<bigint>")
    # A binary search: from the highest step on, each step is taken if the cut there is not above.
    steps = [1 << k for k in reversed(range((len(cuts) - 1).bit_length()))]

    def step(at: Column, size: Column) -> Column:
        return F.when(F.coalesce(F.get(table, at + size) <= id, F.lit(False)), at + size).otherwise(at)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
    return F.when(id.isNull(), len(cuts) - 1).otherwise(found)


def _cuts(df: DataFrame, key: str, stretch: int) -> list[int]:
    """Ids at which stretches of about so many rows begin: the least id, and others that occur."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.agg(F.count(key)).first()[0]
    wanted = max(math.ceil(total / stretch), 4 * partitions)
    wanted = max(1, min(wanted, total // 64))
    shares = [k / wanted for k in range(wanted)]
    near = df.agg(F.percentile_approx(key, shares, 10 * wanted)).first()[0] if total else []
    places = df.filter(F.col(key).isNotNull()).groupBy(_place(F.col(key), sorted(set(near))).alias("p"))
    # One number for each stretch.
    return sorted(row["first"] for row in places.agg(F.min(key).alias("first")).collect())


def with_next(df: DataFrame, key: str, carried: dict[str, str], stretch: int = STRETCH) -> DataFrame:
    """All columns, and some of them from the next row by ascending ``key`` (a long) under other names.

    The row after the last is the first. Null keys come last; rows with one key follow each other by the carried
    columns. A column that has one of the new names gives way. Rows are cut into stretches by
    key, each sorted by a task of its own; the first key of a stretch, known from counting, goes
    to the stretch before as well. Spark sorts a stretch with spilling, so that very many rows under one key
    take time and not memory.
    """
    kept = others(df, list(carried.values()))
    place, extra, following = free([*df.columns, *carried.values()], "place", "extra", "following")
    cuts = _cuts(df.select(key), key, stretch)
    last = max(len(cuts) - 1, 0)
    own = df.withColumn(place, _place(F.col(key), cuts))
    if last:
        # A row that begins a stretch is sent to the one before too; the very first goes to the last.
        begins = F.get(F.from_json(F.lit(str(cuts)), "array<bigint>"), F.col(place)) == F.col(key)
        before = F.when(F.col(place) == 0, last).otherwise(F.col(place) - 1)
        both = F.array(F.struct(F.col(place).alias("p"), F.lit(0).alias("e")), F.struct(before.alias("p"), F.lit(1).alias("e")))
        once = F.array(F.struct(F.col(place).alias("p"), F.lit(0).alias("e")))
        at = F.explode(F.when(F.coalesce(begins, F.lit(False)), both).otherwise(once))
        own = own.withColumn(extra, at).withColumn(place, F.col(extra)["p"]).withColumn(extra, F.col(extra)["e"])
    else:
        own = own.withColumn(extra, F.lit(0))
    order = [F.col(extra), F.asc_nulls_last(key), *[F.asc(c) for c in carried if c != key]]
    window = Window.partitionBy(place).orderBy(*order)
    fields = F.struct(*[F.col(c).alias(n) for c, n in carried.items()])
    after = F.lead(fields).over(window)
    if not last:
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        after = F.coalesce(after, F.first(fields).over(whole))
    own = own.withColumn(following, after).filter(F.col(extra) == 0)
    return own.select(*kept, *[F.col(following)[n].alias(n) for n in carried.values()])
