"""Nearest vectors by cosine, by multi-probe hashing with p-stable projections.

Vectors are scaled to length one, so that the nearest by cosine are the nearest in space. A table
projects them on a few random directions with normal components, moves each projection by a
random offset, and cuts it into intervals of one width: the intervals name a cell. A query
visits its own cell and others around it, in the order of the estimated chance that
a neighbour lies there: given a neighbour's cosine, its projections are normal around a share of
the query's. Cells are visited until the chances add up to ``SUCCESS``. The cosine is the query's
own in the end. A bounded sample, where neighbours are farther than among all, only says
with which cosines to begin: a query whose last found neighbour is farther than the
cosine it was asked with is asked again, at last with the cosine of that neighbour itself. The true
last neighbour is at least as near, so that the chance holds for each of them.

Cells are dealt to buckets, and a bucket of too many vectors is cut into pieces, which all its queries
visit. A task compares the queries with the vectors of their cells in blocks, and gives back the
best of each. The results of all tables are merged. Where fewer were found than there are, or
the last one is nearly at a right angle, the query is compared with all vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pelagia.llm.blocks import grouped, in_groups
from pelagia.llm.itq_dedup import valid
from pelagia.llm.storage import stored

TABLES = 4
DIRECTIONS = 8
WIDTH = 2.0
# Chance of a neighbour to be met in one table.
SUCCESS = 0.55
SAMPLE = 4000
SAMPLE_QUERIES = 100
# Queries begin at the middle of the sample's cosines, if a low quantile is less by so much, then at that.
LOW, APART = 0.05, 0.2
# With a lower cosine nearly all cells are likely, and the query is compared with all vectors.
LEAST_COSINE = 0.1
# Vectors in a bucket, on the average, and in a piece of one at most, on the average.
BUCKET = 1 << 14
QUERIES = 128

_erf = np.vectorize(math.erf, otypes=[np.float64])


def _normal(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(z / math.sqrt(2)))


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Table:
    """Projections and cells of one table, for vectors of one length."""

    def __init__(self, number: int, dim: int):
        draw = np.random.default_rng([number, dim])
        self.directions = draw.standard_normal((dim, DIRECTIONS))
        self.offsets = draw.random(DIRECTIONS) * WIDTH

    def project(self, x: np.ndarray) -> np.ndarray:
        return _unit(x) @ self.directions

    @staticmethod
    def names(intervals: np.ndarray) -> np.ndarray:
        """A number for each row of intervals, of which 128 are told apart in each direction."""
        out = np.zeros(intervals.shape[:-1], dtype=np.int64)
        for k in range(DIRECTIONS):
            out = out << 7 | (intervals[..., k] + 64).astype(np.int64) & 127
        return out

    def cells(self, x: np.ndarray) -> np.ndarray:
        return self.names(np.floor((self.project(x) + self.offsets) / WIDTH))

    def probes(self, projection: np.ndarray, cosine: float, success: float = SUCCESS) -> np.ndarray:
        """Cells to visit for one query, the likeliest first."""
        spread = math.sqrt(max(1e-6, 1 - cosine * cosine))
        chance, cells = np.ones(1), np.zeros(1, dtype=np.int64)
        for k in range(DIRECTIONS):
            middle = cosine * projection[k]
            low = math.floor((middle - 5 * spread + self.offsets[k]) / WIDTH)
            high = math.floor((middle + 5 * spread + self.offsets[k]) / WIDTH)
            at = np.arange(low, high + 2)
            each = np.diff(_normal((at * WIDTH - self.offsets[k] - middle) / spread))
            keep = each > 1e-3
            chance = (chance[:, None] * each[keep]).ravel()
            cells = (cells[:, None] << 7 | (at[:-1][keep] + 64).astype(np.int64) & 127).ravel()
            keep = chance > 1e-7
            chance, cells = chance[keep], cells[keep]
        order = np.argsort(-chance, kind="stable")
        return cells[order[: int(np.searchsorted(np.cumsum(chance[order]), success)) + 1]]


def _first_cosines(rows: DataFrame, k: int) -> list[float]:
    """Cosines to begin with, from the k-th neighbours in a sample of at most ``SAMPLE`` vectors."""
    some = rows.orderBy(F.xxhash64(F.lit(4), "vec_id", "embedding")).limit(SAMPLE).select("embedding", "dim").toArrow()
    if not some.num_rows:
        return [0.5]
    dims = some["dim"].to_numpy()
    dim = np.bincount(dims).argmax()
    x = _unit(_rows(some["embedding"].filter(pa.array(dims == dim))))
    if len(x) <= k:
        return [0.5]
    s = x[:SAMPLE_QUERIES] @ x.T
    np.fill_diagonal(s, -2.0)
    middle, low = np.clip(np.quantile(np.partition(s, -k, axis=1)[:, -k], [0.5, LOW]), LEAST_COSINE, 0.99).tolist()
    return [middle, low] if middle - low > APART else [low]


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("dim", "table", "cell"), F.lit(buckets)).cast("int")


def _indexed(rows: DataFrame, buckets: int) -> DataFrame:
    """Each vector once for each table, with its cell and bucket."""

    def place(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                x = _rows(own.column("embedding"))
                for t in range(TABLES):
                    cell = pa.array(Table(t, dim).cells(x))
                    yield pa.RecordBatch.from_arrays(
                        [own.column("vec_id"), own.column("embedding"), own.column("dim"), pa.array(np.full(len(own), t, dtype=np.int32)), cell],
                        ["vec_id", "embedding", "dim", "table", "cell"],
                    )

    placed = rows.mapInArrow(place, "vec_id long, embedding array<double>, dim int, table int, cell long")
    return placed.withColumn("bucket", _bucket(buckets))


def _probed(queries: DataFrame, buckets: int) -> DataFrame:
    """Each query once for each bucket that it visits, with the cells there, by its ``cosine``."""

    def probe(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                x, cosines = _rows(own.column("embedding")), own.column("cosine").to_pylist()
                for t in range(TABLES):
                    table = Table(t, dim)
                    cells = [table.probes(p, c) for p, c in zip(table.project(x), cosines, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [own.column("vec_id"), own.column("dim"), pa.array(np.full(len(own), t, dtype=np.int32)), pa.array(cells, pa.list_(pa.int64()))],
                        ["vec_id", "dim", "table", "cells"],
                    )

    found = queries.mapInArrow(probe, "vec_id long, dim int, table int, cells array<long>")
    each = found.withColumn("cell", F.explode("cells")).withColumn("bucket", _bucket(buckets))
    listed = each.groupBy("vec_id", "dim", "table", "bucket").agg(F.collect_list("cell").alias("cells"))
    return listed.join(queries.select("vec_id", "embedding").dropDuplicates(["vec_id"]), "vec_id")


def _best(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k best of each query in each bucket: ``query_id``, ``vec_id``, ``score``.

    ``asked`` holds the cells that a query visits in a bucket, null for all.
    """
    key = ["bucket", "dim", "table", "piece"]
    sizes = index.groupBy("bucket", "dim", "table").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("pieces"))
    own = index.join(sizes, ["bucket", "dim", "table"]).withColumn("piece", F.pmod(F.xxhash64(F.lit(8), "vec_id"), "pieces").cast("int"))
    visits = asked.join(sizes, ["bucket", "dim", "table"]).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    rows = own.select(*key, F.lit(0).alias("kind"), "vec_id", "embedding", F.array("cell").alias("cells")).unionByName(
        visits.select(*key, F.lit(1).alias("kind"), "vec_id", "embedding", "cells")
    )

    def search(batches):
        for table in grouped(batches, key):
            kind = table["kind"].to_numpy()
            here, asking = table.filter(pa.array(kind == 0)), table.filter(pa.array(kind == 1))
            if not len(here) or not len(asking):
                continue
            ids, x = here["vec_id"].to_numpy(), _rows(here["embedding"])
            names, place = np.unique(here["cells"].combine_chunks().flatten().to_numpy(), return_inverse=True)
            unit, length = _unit(x), np.linalg.norm(x, axis=1)
            lists = asking["cells"].combine_chunks()
            for at in range(0, len(asking), QUERIES):
                q_ids = asking["vec_id"].to_numpy()[at : at + QUERIES]
                q = _rows(asking["embedding"].slice(at, QUERIES))
                visited = np.zeros((len(q_ids), len(names)), dtype=bool)
                for n in range(len(q_ids)):
                    cells = lists[at + n].values
                    if cells is None:
                        visited[n] = True
                        continue
                    cells = cells.to_numpy()
                    there = np.minimum(np.searchsorted(names, cells), len(names) - 1)
                    visited[n, there[names[there] == cells]] = True
                s = _unit(q) @ unit.T
                s[~visited[:, place] | (q_ids[:, None] == ids)] = -2
                # All that may be among the best, and those that tie with them.
                last = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -2.0)
                n, m = np.nonzero((s >= last[:, None] - 1e-9) & (s > -2))
                score = np.einsum("ij,ij->i", q[n], x[m]) / (np.linalg.norm(q[n], axis=1) * length[m])
                order = np.lexsort((ids[m], -score, n))
                n, m, score = n[order], m[order], score[order]
                rank = np.arange(len(n)) - np.searchsorted(n, n)
                keep = rank < k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[n[keep]]), pa.array(ids[m[keep]]), pa.array(score[keep])], ["query_id", "vec_id", "score"]
                )

    return in_groups(rows, key).mapInArrow(search, "query_id long, vec_id long, score double")


def _merged(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """For each vector whose id is divisible by ``every``, the k nearest others found, by rank.

    Vectors that are null, zero, or have null or non-finite components take no part, nor do rows
    without an id. Vectors of different lengths are not compared. Rows that share an id are
    one candidate with the best of their scores, and none of each other; if several of them are queries,
    the least vector is taken. Equal scores are ranked by id. With k others or fewer all are returned.
    """
    rows = stored(
        vectors.filter(F.col("vec_id").isNotNull() & valid("embedding")).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
            F.size("embedding").alias("dim"),
        )
    )
    total = rows.count()
    buckets = max(1, round(total * TABLES / BUCKET))
    # Few bytes, but much to do for each: so many tasks on purpose.
    tasks = max(1, total // every // QUERIES)
    # Of rows that share an id the least vector asks, whatever the order of the rows.
    asking = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("embedding", "dim")).alias("q"))
    queries = stored(asking.select("vec_id", "q.embedding", "q.dim")).repartition(tasks, "vec_id")
    index = stored(_indexed(rows, buckets))
    others = rows.groupBy("dim").agg((F.count_distinct("vec_id") - 1).alias("others"))
    first = _first_cosines(rows, k)
    asked = queries.withColumn("cosine", F.lit(first[0]))
    found = stored(_merged(_best(index, _probed(asked, buckets), k), k))
    for level in first[1:]:
        # Those whose last neighbour is farther than supposed.
        asked = stored(_unsettled(queries, others, found, first[0], k).withColumn("cosine", F.lit(level)).repartition(tasks, "vec_id"))
        found = stored(_merged(found.drop("rank").unionByName(_best(index, _probed(asked, buckets), k)), k))
    left = stored(_unsettled(queries, others, found, first[-1], k).repartition(tasks, "vec_id"))
    everywhere = index.select("bucket", "dim", "table").filter("table = 0").distinct()
    by_all = F.coalesce("cosine", F.lit(-1.0)) < LEAST_COSINE
    few = left.filter(by_all).join(everywhere, "dim").withColumn("cells", F.lit(None).cast("array<long>"))
    more = [
        (left.filter(~by_all), lambda asked: _best(index, _probed(asked, buckets), k)),
        (few, lambda asked: _best(index.filter("table = 0"), asked, k)),
    ]
    for asked, search in more:
        if not asked.isEmpty():
            found = _merged(found.select("query_id", "vec_id", "score").unionByName(search(asked)), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _unsettled(queries: DataFrame, others: DataFrame, found: DataFrame, asked: float, k: int) -> DataFrame:
    """Queries whose last neighbour found is farther than ``asked``: its ``cosine``, null if some are missing."""
    last = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").alias("cosine"))
    most = F.least("others", F.lit(k))
    out = queries.join(last, "vec_id", "left").join(others, "dim").withColumn("n", F.coalesce("n", F.lit(0)))
    out = out.withColumn("cosine", F.when(F.col("n") >= most, F.col("cosine"))).filter(most > 0)
    return out.filter(F.col("cosine").isNull() | (F.col("cosine") < asked)).select("vec_id", "embedding", "dim", "cosine")
