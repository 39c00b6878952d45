"""Boosted trees by histograms, with second-order gains, over data of any number of rows.

Every feature is cut into at most 256 bins once, at values of its quantiles, and the rows are kept as
blocks of bin numbers. For a level of a tree each task adds up first and second derivatives of the
loss by node, feature and bin; the sums of all tasks are merged and the driver, which holds the histograms
of one level only, chooses the splits. Of two siblings the smaller is counted and the other is what its
parent has besides. A block carries the logit of its rows from tree to tree. Rows that one task
holds need no merging: there trees grow inside the task, some of them in a job, by the same steps.

Derivatives are rounded to whole multiples of a power of two, so that sums are exact: the trees do not
depend on how rows are dealt to tasks or on the order in which sums arrive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.plans.trees import NODES
from pelagia.sources.writers import checkpointed, shared_folder

BINS = 256
# Rows of a block at most and at least; a task works on one block at a time.
BLOCK_ROWS, LEAST_ROWS = 1 << 18, 1 << 15
# Trees after which the blocks are written, so that a lost one is not worked out from the first tree on.
KEPT_EVERY = 25
# Rows that one task takes by itself.
TASK_ROWS = 1 << 17
# Tasks whose sums are merged without a stage of their own: a level is a job, and most of a job's time is its stages.
FEW_TASKS = 64


@dataclass(frozen=True)
class Settings:
    """``rate`` shrinks leaf values, ``penalty`` is added to a node's second derivatives, a split must gain
    more than ``least_gain``, and each side must have second derivatives of ``least_weight``."""

    trees: int = 200
    depth: int = 6
    rate: float = 0.3
    penalty: float = 1.0
    least_gain: float = 0.0
    least_weight: float = 1.0


def cut_points(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Values at which each feature may be split, rising: all it has if these are few, else quantiles.

    The largest value is no cut. Missing values are left out: they lie above all cuts.
    """
    columns = [F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f"v{k}") for k, f in enumerate(features)]
    values = df.select(*columns)
    names = values.columns
    counts = values.agg(*[F.approx_count_distinct(n, 0.02).alias(n) for n in names]).first()
    few = {n for n in names if counts[n] < 0.9 * bins}
    shares = [k / bins for k in range(1, bins)]
    found = values.agg(
        *[
            (F.sort_array(F.collect_set(n)) if n in few else F.percentile_approx(n, shares, 20 * bins)).alias(n)
            for n in names
        ],
        *[F.max(n).alias(f"max_{n}") for n in names],
    ).first()
    return [sorted({v for v in found[n] or [] if v < found[f"max_{n}"]})[: bins - 1] for n in names]


def _blocks(df: DataFrame, features: Sequence[str], label: str, cuts: list[list[float]], rows: int) -> DataFrame:
    """Rows as blocks: bin numbers feature by feature, and labels."""
    numbers = [F.col(f).cast("double").alias(f"f{k}") for k, f in enumerate(features)]
    wanted = df.select(*numbers, F.col(label).cast("double").alias("y"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            y = table["y"].to_numpy()
            bins = np.empty((len(features), len(y)), dtype=np.uint8)
            for k, points in enumerate(cuts):
                bins[k] = np.searchsorted(points, table[f"f{k}"].to_numpy(), side="left")
            return pa.RecordBatch.from_arrays(
                [pa.array([bins.tobytes()], pa.binary()), pa.array([(y > 0).astype(np.uint8).tobytes()], pa.binary())],
                ["bins", "y"],
            )

        for batch in batches:
            while batch.num_rows:
                room = rows - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == rows:
                    yield block()
                    held.clear()
        if held:
            yield block()

    return wanted.mapInArrow(pack, "bins binary, y binary")


class _Tree:
    """A tree while it grows; nodes have the numbers of a heap, from 1 on."""

    def __init__(self):
        self.splits: dict[int, tuple[int, int]] = {}
        self.values: dict[int, float] = {}
        self.facts: dict[int, tuple[float, float]] = {}

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        size = 2 * max(self.splits, default=0) + 2
        feature, limit = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.uint8)
        for node, (f, b) in self.splits.items():
            feature[node], limit[node] = f, b
        node, rows = np.ones(bins.shape[1], dtype=np.int64), np.arange(bins.shape[1])
        for _ in range(max(self.splits, default=0).bit_length()):
            f = feature[node]
            goes = bins[f, rows] > limit[node]
            node = np.where(f >= 0, 2 * node + goes, node)
        return node

    def added(self, bins: np.ndarray) -> np.ndarray:
        value = np.zeros(max(self.values) + 1)
        for node, v in self.values.items():
            value[node] = v
        return value[self.places(bins)]


def _sums(bins: np.ndarray, y: np.ndarray, logit: np.ndarray, tree: _Tree, nodes: list[int], scale: float) -> np.ndarray:
    """Sums of both derivatives in whole numbers: node, feature, bin, which of the two."""
    slot = np.full(2 * max(nodes) + 2, -1, dtype=np.int64)
    slot[nodes] = np.arange(len(nodes))
    at = slot[tree.places(bins)]
    some = np.flatnonzero(at >= 0)
    if len(some) < len(at):
        bins, at, y, logit = bins[:, some], at[some], y[some], logit[some]
    p = 1 / (1 + np.exp(-logit))
    derivatives = np.rint((p - y) * scale), np.rint(p * (1 - p) * scale)
    out = np.empty((len(bins), len(nodes) * BINS, 2), dtype=np.int64)
    at *= BINS
    for f in range(len(bins)):
        cell = at + bins[f]
        for k in (0, 1):
            out[f, :, k] = np.bincount(cell, weights=derivatives[k], minlength=len(nodes) * BINS)
    return np.moveaxis(out.reshape(len(bins), len(nodes), BINS, 2), 0, 1)


def _merged(state: RDD, tree: _Tree, nodes: list[int], scale: float) -> np.ndarray:
    """The sums of all blocks."""

    def task(blocks):
        total = None
        for bins, y, logit in blocks:
            found = _sums(bins, y, logit, tree, nodes, scale)
            total = found if total is None else total + found
        if total is not None:
            yield total

    return state.mapPartitions(task).treeReduce(lambda a, b: a + b, 1 if state.getNumPartitions() <= FEW_TASKS else 2)


def _best(found: np.ndarray, scale: float, cuts: list[list[float]], s: Settings) -> tuple[float, int, int] | None:
    """Gain, feature and bin of the best split of a node: the first of equal ones."""
    sums = found / scale
    g, h = sums[0, :, 0].sum(), sums[0, :, 1].sum()
    left = np.cumsum(sums, axis=1)
    gl, hl = left[..., 0], left[..., 1]
    gr, hr = g - gl, h - hl
    gain = gl * gl / (hl + s.penalty) + gr * gr / (hr + s.penalty) - g * g / (h + s.penalty)
    allowed = (hl >= s.least_weight) & (hr >= s.least_weight) & (gain > s.least_gain)
    for f, points in enumerate(cuts):
        allowed[f, len(points) :] = False
    gain = np.where(allowed, gain, -np.inf)
    at = int(np.argmax(gain))
    if not np.isfinite(gain.flat[at]):
        return None
    return float(gain.flat[at]), at // BINS, at % BINS


def _grow(
    sums: Callable[[_Tree, list[int]], np.ndarray], cuts: list[list[float]], scale: float, s: Settings
) -> _Tree:
    """One tree, level by level; ``sums`` gives the histograms of nodes of the tree so far."""
    tree, level, above = _Tree(), [1], {}
    for depth in range(s.depth + 1):
        # Of two siblings the one with less weight is counted.
        counted = [n for n in level if n == 1 or (tree.facts[n][1], n) < (tree.facts[n ^ 1][1], n ^ 1)]
        last = depth == s.depth
        here: dict[int, np.ndarray] = {}
        if not last:
            for n, found in zip(counted, sums(tree, counted), strict=True):
                here[n] = found
                if n > 1:
                    here[n ^ 1] = above[n // 2] - found
        following = []
        for n in level:
            if n == 1:
                total = here[1][0].sum(axis=0) / scale
                tree.facts[1] = (float(total[0]), float(total[1]))
            g, h = tree.facts[n]
            split = None if last else _best(here[n], scale, cuts, s)
            if split is None:
                tree.values[n] = -s.rate * g / (h + s.penalty)
                continue
            gain, f, b = split
            tree.splits[n] = (f, b)
            left = here[n][f, : b + 1].sum(axis=0) / scale
            tree.facts[2 * n] = (float(left[0]), float(left[1]))
            tree.facts[2 * n + 1] = (g - float(left[0]), h - float(left[1]))
            tree.facts[n] = (*tree.facts[n], gain)
            following += [2 * n, 2 * n + 1]
        if not following:
            return tree
        level, above = following, here
    return tree


def boost(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    s: Settings = Settings(),
    cuts: list[list[float]] | None = None,
) -> DataFrame:
    """The nodes of trees that tell positive labels (above 0) from others; a table of ``pelagia.plans.trees``.

    ``cuts`` are the values at which features may be split, found by ``cut_points`` unless given. Missing
    values go right. Rows without a label count as negative. Fewer trees than asked for come back if no
    split gains anything any more; at least one does, maybe of a single leaf.
    """
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    rows = df.count()
    if not rows:
        raise ValueError("there are no rows to learn from")
    cuts = cuts if cuts is not None else cut_points(df, features)
    if any(len(c) >= BINS for c in cuts):
        raise ValueError(f"a feature has at most {BINS - 1} cuts")
    block = int(min(max(rows / (2 * sc.defaultParallelism), LEAST_ROWS), BLOCK_ROWS))
    stored = checkpointed(_blocks(df, features, label, cuts, block))
    # Sums of a block are exact as doubles and those of all rows as whole numbers.
    scale = float(1 << min(34, 61 - int(rows).bit_length()))
    n = len(features)

    def opened(row):
        y = np.frombuffer(row["y"], dtype=np.uint8)
        return np.frombuffer(row["bins"], dtype=np.uint8).reshape(n, len(y)), y, np.zeros(len(y))

    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    tasks = max(1, math.ceil(rows / TASK_ROWS))
    if tasks > 1:  # each core has one task where there is enough for it, and several blocks where there are many
        tasks = max(min(tasks, sc.defaultParallelism), rows // (4 * BLOCK_ROWS))
    state = stored.repartition(tasks).rdd.map(opened).persist(StorageLevel.MEMORY_AND_DISK)
    before, grown = None, []
    try:
        while len(grown) < s.trees:
            if tasks == 1:
                wanted = min(KEPT_EVERY, s.trees - len(grown))
                new = state.mapPartitions(lambda blocks, n=wanted: [_in_task(blocks, n, cuts, scale, s)]).first()
            else:
                new = [_grow(lambda tree, nodes, now=state: _merged(now, tree, nodes, scale), cuts, scale, s)]
            if before is not None:  # its blocks have been read, and are kept anew
                before.unpersist()
            useful = [t for t in new if t.splits]
            grown += useful or new[: not grown]
            if len(useful) < len(new):
                break
            before, state = state, state.map(lambda block, t=useful: _moved(block, t))
            state.persist(StorageLevel.MEMORY_AND_DISK)
            if tasks > 1 and len(grown) % KEPT_EVERY == 0:
                state.checkpoint()
    finally:
        for held in (before, state):
            if held is not None:
                held.unpersist()
    return spark.createDataFrame(list(_rows(grown, features, cuts)), NODES)


def _moved(block: tuple, trees: list[_Tree]) -> tuple:
    """A block after some trees, added one after the other as they were grown."""
    bins, y, logit = block
    for tree in trees:
        logit = logit + tree.added(bins)
    return bins, y, logit


def _in_task(
    blocks: Iterator[tuple], trees: int, cuts: list[list[float]], scale: float, s: Settings
) -> list[_Tree]:
    """Some trees over the blocks of this task, up to one that has no split."""
    parts = list(blocks)
    bins = np.concatenate([p[0] for p in parts], axis=1)
    y, logit = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
    grown: list[_Tree] = []
    for _ in range(trees):
        tree = _grow(lambda tree, nodes: _sums(bins, y, logit, tree, nodes, scale), cuts, scale, s)
        grown.append(tree)
        if not tree.splits:
            break
        logit = logit + tree.added(bins)
    return grown


def _rows(grown: list[_Tree], features: Sequence[str], cuts: list[list[float]]) -> Iterator[tuple]:
    for number, tree in enumerate(grown):
        for node, (f, b) in sorted(tree.splits.items()):
            _, cover, gain = tree.facts[node]
            yield number, node, features[f], float(cuts[f][b]), 2 * node, 2 * node + 1, None, gain, cover
        for node, value in sorted(tree.values.items()):
            yield number, node, None, None, None, None, value, None, tree.facts[node][1]
