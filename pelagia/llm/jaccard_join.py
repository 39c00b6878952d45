"""Similarity join of texts by the Jaccard overlap of their word shingles.

The method is a grouped prefix join. All shingles have one global order, rare before
frequent. Two sets with overlap of at least a share t of their union have a common shingle
among the first n - ceil(t n) + 1 of each, the prefix. Texts with equal prefix and size form
a group, so that the copies of a text are one entry. Groups that share a shingle of
their prefixes and whose sizes allow the overlap are candidates; they are expanded to their
distinct sets, bounded by the bit maps of the sets, and verified with the sets
themselves, built anew from the whole texts. Candidates that hang together are brought to one
task for that, in blocks of bounded size, so that a text is sent there once and not for
each of its pairs.

Frequent shingles are those that some tasks see twice or more, counted over all texts. They
come last in the order, which keeps lists short; which shingles are taken for frequent
has no influence on the result.

Lists of one shingle are kept small by that order, but groups of very many near copies have
long ones. Of a list longer than ``LIST`` only neighbours by size are candidates at
first. The members that are then still apart are compared by their bit maps, in blocks.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.blocks import block_pairs, forest, grouped, in_groups
from pelagia.llm.components import components
from pelagia.llm.names import free
from pelagia.llm.storage import stored
from pelagia.llm.textbytes import mix, pieces, shingle_sets

# Least bits of the map of a set, for an upper bound of overlaps; larger sets have larger maps.
MAP_BITS = 1024
# A shingle that is counted more often comes late in the order.
FREQUENT = 16
# At most so many frequent shingles are sent to the tasks (12 bytes each).
FREQUENT_KEPT = 1 << 18
# Postings in one bucket on the average, 20 bytes each.
BUCKET = 1 << 18
LIST = 64
BLOCK = 512


def _row():
    return F.xxhash64(F.lit(5), F.col("doc_id"), F.col("text"))


def frequent_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles with high counts and the logarithms of their counts, by shingle.

    A task reports what it has seen at least twice within some millions of shingles.
    """

    def count(batches):
        held: list[np.ndarray] = []
        size = 0

        def report():
            if held:
                values, counts = np.unique(np.concatenate(held), return_counts=True)
                many = counts > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[many].view(np.int64)), pa.array(counts[many])], ["token", "n"]
                )

        for batch in batches:
            for _, _, data, ends in pieces(batch.column(0)):
                for s in shingle_sets(data, ends, width):
                    held.append(s)
                    size += len(s)
                if size > 1 << 22:
                    yield from report()
                    held, size = [], 0
        yield from report()

    counted = texts.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    kept = counted.filter(F.col("n") > FREQUENT).orderBy(F.desc("n"), "token").limit(FREQUENT_KEPT).toPandas()
    tokens = kept["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.log2(np.maximum(kept["n"].to_numpy(dtype=np.float64), 1)).astype(np.int8)[order]


def _bit_map(s: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; at least as many bits as shingles."""
    size = max(MAP_BITS, 1 << (len(s) - 1).bit_length())
    bits = np.bincount((mix(s) >> np.uint64(24)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


class BitMaps:
    """The maps of some sets. Half a map on the other half, bit by bit, is the map of half the size."""

    def __init__(self, blobs: pa.ChunkedArray | pa.Array):
        blobs = blobs.to_pylist()
        size = np.array([len(b) for b in blobs], dtype=np.int64)
        self.level = np.log2(np.maximum(size, 1)).astype(np.int64)
        self.place = np.zeros(len(blobs), dtype=np.int64)
        self.rows: dict[int, np.ndarray] = {}
        for level in np.unique(self.level).tolist():
            own = np.flatnonzero(self.level == level)
            self.place[own] = np.arange(len(own))
            self.rows[level] = np.frombuffer(b"".join([blobs[k] for k in own]), dtype=np.uint64).reshape(len(own), -1)

    def at(self, level: int, sets: np.ndarray) -> np.ndarray:
        """Maps of sets, folded to the size of a level not above theirs."""
        out = np.empty((len(sets), (1 << level) // 8), dtype=np.uint64)
        for own in np.unique(self.level[sets]).tolist():
            which = self.level[sets] == own
            rows = self.rows[own][self.place[sets[which]]]
            while own > level:
                half = rows.shape[1] // 2
                rows, own = rows[:, :half] ^ rows[:, half:], own - 1
            out[which] = rows
        return out


def _fit(n: np.ndarray, maps: BitMaps, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and maps of the sets x and y, pair by pair, allow the overlap.

    Two sets differ in at least as many shingles as their maps in bits.
    """
    small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
    out = 100 * small >= percent * large
    left = np.flatnonzero(out)
    level = np.minimum(maps.level[x[left]], maps.level[y[left]])
    for k in np.unique(level).tolist():
        own = left[level == k]
        step = max(1, (1 << 22) >> k)
        for at in range(0, len(own), step):
            some = own[at : at + step]
            apart = np.bitwise_count(maps.at(k, x[some]) ^ maps.at(k, y[some])).sum(axis=1, dtype=np.int64)
            total = n[x[some]] + n[y[some]]
            most = np.minimum((total - apart) // 2, small[some])
            out[some] = 100 * most >= percent * (total - most)
    return out


def shingled(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of each text its row key, set size, set key, prefix and bit map."""
    tokens, levels = frequent_shingles(texts, width)
    sent = texts.sparkSession.sparkContext.broadcast((tokens, levels))

    def build(batches):
        common, level = sent.value
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for _, _, data, ends in pieces(batch.column("text")):
                for s in shingle_sets(data, ends, width):
                    n = len(s)
                    out[0].append(n)
                    if not n:
                        for values in out[1:]:
                            values.append(None)
                        continue
                    digest = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                    out[1].append(struct.unpack("<q", digest)[0])
                    first = s
                    if len(common):
                        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                        late = np.where(common[at] == s, level[at], 0)
                        if late.any():
                            first = s[np.argsort(late, kind="stable")]
                    out[2].append(first[: n - -(-percent * n // 100) + 1].tobytes())
                    out[3].append(_bit_map(s))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.binary()),
                    pa.array(out[3], pa.binary()),
                ],
                ["row", "doc_id", "n", "node", "prefix", "bits"],
            )

    rows = texts.select("doc_id", _row().alias("row"), "text")
    schema = "row long, doc_id long, n long, node long, prefix binary, bits binary"
    return rows.mapInArrow(build, schema).withColumn("grp", F.xxhash64("n", "prefix"))


def _packed(groups: DataFrame, buckets: int) -> DataFrame:
    """Postings (shingle, group, size) by bucket, as blobs of 20-byte entries."""
    entry = np.dtype([("token", "<u8"), ("grp", "<i8"), ("n", "<i4")])

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            blobs = batch.column("prefix").to_pylist()
            sizes = np.array([len(b) // 8 for b in blobs])
            rows = np.empty(int(sizes.sum()), dtype=entry)
            rows["token"] = np.frombuffer(b"".join(blobs), dtype=np.uint64)
            rows["grp"] = np.repeat(batch.column("grp").to_numpy(zero_copy_only=False), sizes)
            rows["n"] = np.repeat(batch.column("n").to_numpy(zero_copy_only=False), sizes)
            place = (mix(rows["token"]) >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(place, kind="stable")
            rows, place = rows[order], place[order]
            found, first = np.unique(place, return_index=True)
            cuts = [*first.tolist(), len(rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.astype(np.int32)),
                    pa.array([rows[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                ],
                ["bucket", "entries"],
            )

    return groups.mapInArrow(pack, "bucket int, entries binary")


def _pairs_of(n: np.ndarray, percent: int, reach: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places i < j of entries sorted by size whose sizes allow the overlap, near ones if asked."""
    last = np.searchsorted(n, n * 100 // percent, side="right")
    if reach is not None:
        last = np.minimum(last, np.arange(len(n)) + 1 + reach)
    many = np.maximum(last - np.arange(len(n)) - 1, 0)
    i = np.repeat(np.arange(len(n)), many)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
    return i, j


def _lists(packed: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of groups, once for each bucket, and the members of long lists."""
    entry = np.dtype([("token", "<u8"), ("grp", "<i8"), ("n", "<i4")])

    def candidates(batches):
        for table in grouped(batches, ["bucket"]):
            rows = np.frombuffer(b"".join(table["entries"].to_pylist()), dtype=entry)
            rows = rows[np.lexsort((rows["grp"], rows["n"], rows["token"]))]
            new = np.flatnonzero(np.r_[True, rows["token"][1:] != rows["token"][:-1]])
            length = np.diff(np.r_[new, len(rows)])
            found = [np.zeros((0, 2), dtype=np.int64)]
            held = 0
            long = [rows[:0]]
            for a, size in zip(new[length > 1].tolist(), length[length > 1].tolist(), strict=True):
                part = rows[a : a + size]
                i, j = _pairs_of(part["n"].astype(np.int64), percent, None if size <= LIST else 8)
                found.append(np.stack([part["grp"][i], part["grp"][j]], axis=1))
                held += len(i)
                if held > 1 << 19:
                    found = [_distinct(np.concatenate(found))]
                    held = len(found[0])
                    if held > 1 << 18:
                        yield _pair_rows(found[0])
                        found, held = found[:0], 0
                if size > LIST:
                    long.append(part)
            if found:
                yield _pair_rows(_distinct(np.concatenate(found)))
            members = np.concatenate(long)
            if len(members):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(members["token"].view(np.int64)),
                        pa.array(members["grp"]),
                        pa.array(members["n"].astype(np.int64)),
                        pa.nulls(len(members), pa.int64()),
                    ],
                    ["token", "a", "n", "b"],
                )

    return in_groups(packed, ["bucket"]).mapInArrow(candidates, "token long, a long, n long, b long")


def _distinct(pairs: np.ndarray) -> np.ndarray:
    low, high = pairs.min(axis=1), pairs.max(axis=1)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    keep &= low != high
    return np.stack([low[keep], high[keep]], axis=1)


def _pair_rows(pairs: np.ndarray) -> pa.RecordBatch:
    n = len(pairs)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()), pa.array(pairs[:, 0].copy()), pa.nulls(n, pa.int64()), pa.array(pairs[:, 1].copy())],
        ["token", "a", "n", "b"],
    )


def _bounded(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets from the pairs of their groups, as far as their bit maps allow the overlap."""
    left = members.select(*(F.col(c).alias(c + "a") for c in ("grp", "node", "n", "bits")))
    right = members.select(*(F.col(c).alias(c + "b") for c in ("grp", "node", "n", "bits")))

    def check(batches):
        for batch in batches:
            if batch.num_rows:
                rows = batch.num_rows
                n = np.r_[batch.column("na").to_numpy(), batch.column("nb").to_numpy()]
                maps = BitMaps(pa.chunked_array([batch.column("bitsa"), batch.column("bitsb")]))
                keep = _fit(n, maps, np.arange(rows), np.arange(rows, 2 * rows), percent)
                out = batch.select(["nodea", "nodeb"]).filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(out.columns, ["a", "b"])

    joined = pairs.join(left, pairs["a"] == left["grpa"]).drop("grpa", "a")
    joined = joined.join(right, joined["b"] == right["grpb"]).drop("grpb", "b")
    return joined.mapInArrow(check, "a long, b long")


def _forest_in_blocks(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """Edges that connect the sets of each key as all pairs that fit would; in blocks.

    ``rows`` has the key, ``node``, ``n``, ``bits`` and ``part``; sets of one part are not compared.
    """
    cut = block_pairs(rows, [key], "node", BLOCK)
    place = [key, "left", "right"]

    def connect(batches):
        for table in grouped(batches, place):
            node, n, part, block = (table[c].to_numpy() for c in ("node", "n", "part", "block"))
            maps = BitMaps(table["bits"])
            i = np.flatnonzero(block == table["left"][0].as_py())
            j = np.flatnonzero(block == table["right"][0].as_py())
            x, y = np.nonzero(part[i][:, None] != part[j])
            x, y = i[x], j[y]
            fits = _fit(n, maps, x, y, percent)
            u, v = forest(len(node), x[fits], y[fits])
            yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], ["a", "b"])

    return in_groups(cut, place).mapInArrow(connect, "a long, b long")


# Bits of the filter that keeps texts nobody needs out of a shuffle: 2 MB at most.
FILTER_BITS = 1 << 24


def _needed(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts that may be among ``rows``, by a filter of fixed size."""
    place = F.pmod("row", F.lit(FILTER_BITS))
    words = rows.select(F.shiftright(place, 6).alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    table[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    sent = texts.sparkSession.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool))

    def keep(batches):
        for batch in batches:
            place = batch.column("row").to_numpy() & (FILTER_BITS - 1)
            yield batch.filter(pa.array(sent.value[place]))

    return texts.select(_row().alias("row"), "text").mapInArrow(keep, "row long, text string")


def _verified(members: DataFrame, known: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between the sets of each component of the candidates, enough to connect what is linked.

    The sets of a component meet in blocks. Pairs that fit by size and bit map are compared
    by their shingles unless the block's links connect them already.
    """
    placed = members.drop("grp").join(known, "node")
    cut = block_pairs(placed, ["component"], "node", BLOCK)
    rows = _needed(texts, placed.select("row")).join(cut, "row")
    place = ["component", "left", "right"]
    rows = in_groups(rows, place)

    def link(batches):
        for table in grouped(batches, place):
            # Rows repeated in id and text give the same set more than once.
            _, once = np.unique(table["node"].to_numpy(), return_index=True)
            table = table.take(pa.array(once))
            node, n, block = (table[c].to_numpy() for c in ("node", "n", "block"))
            maps = BitMaps(table["bits"])
            i = np.flatnonzero(block == table["left"][0].as_py())
            j = np.flatnonzero(block == table["right"][0].as_py())
            text = table["text"].combine_chunks()
            held: dict[int, np.ndarray] = {}
            top = list(range(len(node)))

            def root(x, top=top):
                while top[x] != x:
                    top[x] = top[top[x]]
                    x = top[x]
                return x

            def shingles(x, text=text, held=held):
                if x not in held:
                    held[x] = next(s for _, _, d, e in pieces(text.slice(x, 1)) for s in shingle_sets(d, e, width))
                return held[x]

            a, b = [], []
            for x in i.tolist():
                for y in j[_fit(n, maps, np.full(len(j), x), j, percent)].tolist():
                    if root(x) == root(y):
                        continue
                    s, t = shingles(x), shingles(y)
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    if 100 * both >= percent * (len(s) + len(t) - both):
                        top[root(x)] = root(y)
                        a.append(node[x])
                        b.append(node[y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(link, "a long, b long")


def similar_sets(texts: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """The stored sets of all texts, and the component of every set that has a link."""
    sets = stored(shingled(texts, width, percent))
    full = sets.filter("n > 0")
    total = full.agg(F.sum(F.length("prefix")) / 8).first()[0] or 0
    groups = full.groupBy("grp", "n").agg(F.any_value("prefix").alias("prefix"))
    found = stored(_lists(_packed(groups, max(1, round(total / BUCKET))), percent))
    members = stored(
        full.groupBy("node", "grp", "n").agg(F.min("row").alias("row"), F.any_value("bits").alias("bits"))
    )

    candidates = _bounded(found.filter("b is not null").select("a", "b").distinct(), members, percent)
    in_group = _forest_in_blocks(members.withColumn("part", F.col("node")), "grp", percent)
    known = stored(components(candidates.unionByName(in_group)))
    lists = found.filter("b is null").select("token", F.col("a").alias("grp"))
    if not lists.isEmpty():
        placed = lists.join(members, "grp").join(known, "node", "left")
        placed = placed.select("token", "node", "n", "bits", F.coalesce("component", "node").alias("part"))
        # A list that lies in one component needs no comparison.
        mixed = placed.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y")
        across = _forest_in_blocks(placed.join(mixed.select("token"), "token"), "token", percent)
        joined = known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(across)
        known = stored(components(joined))
    return sets, components(_verified(members, known, texts, width, percent))


def jaccard_components(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Of each document its set size and the least ``doc_id`` reachable by links.

    Words are runs of bytes other than ASCII white space, A to Z lower-cased. Two documents
    link when 100 times their common shingles are at least ``percent`` times those of both
    together. Null and blank texts have an empty set and link with nothing: their component
    is their own id. A null ``doc_id`` takes part; it is never the least of its component
    unless all ids there are null. Repeated rows are returned as often as they come. Other
    columns are not read. Adds ``row_key``, a hash of id and text, and ``kept``, true
    for the rows of one document in each component and for those without words.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets, known = similar_sets(texts, width, percent)
    named = sets.select("row", "doc_id", "n", "node").join(known, "node", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "node")))
    least = (
        named.filter("n > 0")
        .groupBy("component")
        .agg(F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    )
    joined = named.join(least, "component", "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        (F.col("n").eqNullSafe(0) | (F.col("first.row") == F.col("row"))).alias("kept"),
        F.col("row").alias("row_key"),
    )


def one_of_each(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one left of each component, the one of least id.

    Documents without words all stay. Rows repeated in id and text count as copies. All columns come back,
    whatever they are called.
    """
    found = jaccard_components(documents, width, percent)
    row, n = free(documents.columns, "row", "n")
    kept = found.filter("kept").groupBy(F.col("row_key").alias(row)).agg(F.max("n_shingles").alias(n))
    name = F.xxhash64(F.lit(5), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = documents.withColumn(row, name).join(kept, row)
    some = keyed.filter(F.col(n) > 0).dropDuplicates([row])
    return some.unionByName(keyed.filter(F.col(n) == 0)).select(*documents.columns)
