"""Near-duplicate vectors by binary codes with a learned rotation.

Iterative quantisation: a bounded sample of the vectors is centred and turned to its principal
axes, and a rotation is found that brings the turned vectors close to the corners of a cube.
The signs along the rotated axes are a code of balanced bits, in which vectors of a small
angle differ in few places. The code is cut into ``PARTS`` parts; each pair of parts is
a hash table of a multi-index. Two codes that agree in two parts or more meet in a bucket of some
table, so up to ``PARTS`` - 2 wrong bits never hide a pair, and more seldom do.

Equal vectors are one entry. Buckets that hold one entry are dropped before any vector is sent;
the others are compared block by block, with the original vectors in double precision. A
pair that meets in several tables is counted in the first of them. A block gives back how
many links each entry has, and only as many pairs as connect what is linked.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.blocks import block_pairs, forest, grouped, in_groups
from pelagia.llm.components import components
from pelagia.llm.storage import stored

LEAST = 0.98
# Vectors that the rotation is learned from, at most; they are taken by a hash.
SAMPLE = 20_000
ROUNDS = 30
BITS = 64
PARTS = 8
BLOCK = 512

_TABLES = list(combinations(range(PARTS), 2))


def valid(vector: str):
    """Whether a vector has no null or non-finite component and is not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(sample: np.ndarray, bits: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (columns are bits) that iterative quantisation finds."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    turn = axes[:, ::-1][:, :bits]
    v = centred @ turn
    r, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((turn.shape[1], turn.shape[1])))
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (left @ right).T
    return mean, turn @ r


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors as rows of length one, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # Scaled first: squares of very large or small components would not be finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def entries(vectors: DataFrame) -> DataFrame:
    """Equal vectors of a label once: key, label, length, vector, least id and number."""
    rows = vectors.filter(F.col("label").isNotNull() & valid("embedding"))
    grouped_rows = rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    return grouped_rows.withColumn("entry", F.xxhash64("label", "embedding")).withColumn("dim", F.size("embedding"))


def with_codes(found: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Entries with their binary codes, one rotation for each length of vectors."""
    spark = found.sparkSession
    learned = {}
    for dim in [r["dim"] for r in found.select("dim").distinct().collect()]:
        some = found.filter(F.col("dim") == dim).orderBy(F.xxhash64(F.lit(2), "entry"), "entry").limit(sample)
        x = _unit(some.select("embedding").toArrow()["embedding"])
        learned[dim] = rotation(x, min(dim, BITS))
    sent = spark.sparkContext.broadcast(learned)

    def code(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out = np.zeros(batch.num_rows, dtype=np.int64)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                mean, turn = sent.value[dim]
                signs = (_unit(batch.column("embedding").take(pa.array(own))) - mean) @ turn >= 0
                wide = np.zeros((len(own), BITS), dtype=np.uint8)
                # Short codes are spread over all parts.
                wide[:, np.linspace(0, BITS - 1, signs.shape[1]).round().astype(int)] = signs
                out[own] = np.packbits(wide, axis=1).view(">i8").ravel()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "code"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return found.mapInArrow(code, f"{schema}, code long")


def _buckets(found: DataFrame) -> DataFrame:
    """Entry, table and the bits that address it, for every table; one row for each."""
    width = BITS // PARTS
    part = [F.shiftrightunsigned("code", width * k).bitwiseAND((1 << width) - 1) for k in range(PARTS)]
    places = F.array(
        *[F.struct(F.lit(t).alias("table"), (F.shiftleft(part[i], width) + part[j]).alias("address")) for t, (i, j) in enumerate(_TABLES)]
    )
    return found.select("entry", "label", "dim", F.explode(places).alias("place")).select(
        "entry", "label", "dim", "place.table", "place.address"
    )


def _first_tables() -> np.ndarray:
    """For each set of equal parts, as bits, the first table in which a pair meets."""
    first = np.full(1 << PARTS, -1, dtype=np.int64)
    for t, (i, j) in reversed(list(enumerate(_TABLES))):
        both = (1 << i) | (1 << j)
        first[(np.arange(1 << PARTS) & both) == both] = t
    return first


def _compared(found: DataFrame, least: float) -> DataFrame:
    """Numbers of links by entry (``a``, ``n``), and pairs of nodes (``a``, ``b``), from all blocks."""
    key = ["label", "dim", "table", "address"]
    place = [*key, "left", "right"]
    cut = block_pairs(_buckets(found), key, "entry", BLOCK)
    rows = in_groups(cut.join(found.select("entry", "node", "copies", "code", "embedding"), "entry"), place)
    first, width = _first_tables(), BITS // PARTS

    def link(batches):
        for table in grouped(batches, place):
            if len(table) < 2:
                continue
            entry, node, copies, code, block = (
                table[c].to_numpy() for c in ("entry", "node", "copies", "code", "block")
            )
            x = _unit(table["embedding"])
            left, right = table["left"][0].as_py(), table["right"][0].as_py()
            i, j = np.flatnonzero(block == left), np.flatnonzero(block == right)
            u, v = np.nonzero(x[i] @ x[j].T >= least - 1e-9)
            u, v = i[u], j[v]
            if left == right:
                u, v = u[u < v], v[u < v]
            exact = np.einsum("ij,ij->i", x[u], x[v]) >= least
            u, v = u[exact], v[exact]
            apart = (code[u] ^ code[v]).view(np.uint64)
            equal = np.zeros(len(u), dtype=np.int64)
            for k in range(PARTS):
                same = (apart >> np.uint64(width * k)) & np.uint64((1 << width) - 1) == 0
                equal |= same.astype(np.int64) << k
            mine = first[equal] == table["table"][0].as_py()
            u, v = u[mine], v[mine]
            if not len(u):
                continue
            n = np.bincount(u, weights=copies[v], minlength=len(node)) + np.bincount(v, weights=copies[u], minlength=len(node))
            some = np.flatnonzero(n)
            a, b = forest(len(node), u, v)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[entry[some], node[a]]),
                    pa.array(np.r_[np.zeros(len(some), dtype=np.int64), node[b]], mask=np.r_[np.ones(len(some), bool), np.zeros(len(a), bool)]),
                    pa.array(np.r_[n[some].astype(np.int64), np.zeros(len(a), dtype=np.int64)]),
                ],
                ["a", "b", "n"],
            )

    return rows.mapInArrow(link, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, least: float = LEAST, sample: int = SAMPLE) -> DataFrame:
    """Links and component of each vector among those of equal label, with cosine >= ``least``.

    A row whose label is null, or whose vector is null, zero or has null or non-finite components,
    links with nothing; vectors of different lengths do not link. Repeated rows link with
    each other like other equal vectors, and rows that share an id are one node of the
    graph. A null id is never the least one; a component without any id has none.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )
    found = stored(with_codes(entries(rows), sample))
    pairs = stored(_compared(found, least))
    counts = pairs.filter("b is null").groupBy(F.col("a").alias("entry")).agg(F.sum("n").alias("others"))
    known = components(pairs.filter("b is not null").select("a", "b"))
    per_entry = (
        found.select("entry", "node", "copies")
        .join(counts, "entry", "left")
        .join(known, "node", "left")
        .select(
            "entry",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    own = F.when(F.col("label").isNotNull() & valid("embedding"), F.xxhash64("label", "embedding"))
    keyed = rows.select("vec_id", own.alias("entry"))
    joined = keyed.join(per_entry, "entry", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
