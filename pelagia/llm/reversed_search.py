"""Ranked lexical search turned round: the items are indexed, and the documents stream by.

The terms of a block of items, with the items that hold each and how often, make an inverted index
that is broadcast; its size is checked. A first pass over all documents counts how many have a term of
the index, how many have any term, and all terms. In a second pass each document's term
counts meet the postings of its terms, which gives its scores with all items that share a term with it;
every task keeps a heap of bounded size for each item. The heaps are stored and merged in two steps.

More items than one block holds are searched block by block, each with two passes.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pelagia.llm.storage import stored

TOP = 20
# Bytes of the texts of the items that one broadcast index is made of.
BLOCK_BYTES = 8 << 20
# A text is cut into terms in stretches of about so many bytes, at separators.
STRETCH = 1 << 20
# Scores, and scores before they are added up, that a task holds at a time.
CELLS = 1 << 20
# Heaps of an item that are merged by one task.
MERGED = 64

# Terms are runs of digits, ASCII letters and whatever is not ASCII; A to Z lower-cased.
_IN_TERM = [b >= 0x80 or chr(b).isalnum() for b in range(256)]
_PLAIN = bytes((b + 32 if 65 <= b <= 90 else b) if keep else 32 for b, keep in enumerate(_IN_TERM))


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of bounded length (but for a single longer term)."""
    at = 0
    while at < len(raw):
        stop = at + STRETCH
        while stop < len(raw) and _IN_TERM[raw[stop]]:
            stop += 1
        yield raw[at:stop].translate(_PLAIN).split()
        at = stop


class Index:
    """Numbers of the terms of some items, and of each term the items that hold it and how often."""

    def __init__(self, texts: list[str | None]):
        self.items = len(texts)
        postings: dict[bytes, list[tuple[int, int]]] = {}
        for item, text in enumerate(texts):
            counts: Counter[bytes] = Counter()
            for part in terms((text or "").encode()):
                counts.update(part)
            for term, times in counts.items():
                postings.setdefault(term, []).append((item, times))
        self.number = {term: k for k, term in enumerate(postings)}
        self.start = np.cumsum([0, *map(len, postings.values())])
        flat = np.array([p for found in postings.values() for p in found], dtype=np.int64).reshape(-1, 2)
        self.item, self.times = flat[:, 0], flat[:, 1]

    def counts(self, raw: bytes) -> tuple[int, dict[int, int]]:
        """Terms of a text with repeats, and how often each term of the index is among them."""
        total, found = 0, {}
        for part in terms(raw):
            total += len(part)
            numbers = list(map(self.number.get, part))
            for k, times in Counter(compress(numbers, [k is not None for k in numbers])).items():
                found[k] = found.get(k, 0) + times
        return total, found


def _raw(column: pa.Array) -> Iterator[bytes]:
    """Texts one at a time; a null is an empty one."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def _statistics(texts: DataFrame, index) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and of each term of the index the documents that hold it."""

    def count(batches):
        known = index.value
        frequency = np.zeros(len(known.number) + 2, dtype=np.int64)
        for batch in batches:
            for raw in _raw(batch.column("text")):
                total, found = known.counts(raw)
                frequency[list(found)] += 1
                frequency[-2:] += total > 0, total
        at = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(frequency[at])], ["term", "n"])

    # As many rows as the index has terms, and two.
    rows = texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(index.value.number) + 2, dtype=np.int64)
    for row in rows:
        out[row["term"]] = row["n"]
    return int(out[-2]), int(out[-1]), out[:-2]


class Heaps:
    """The best documents of every item so far: highest score first, then least id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.heaps: list[list] = [[] for _ in range(items)]
        # Scores below this cannot enter any more.
        self.least = np.ones(items, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        doc, item = np.nonzero(scores >= self.least)
        for d, i, score in zip(doc.tolist(), item.tolist(), scores[doc, item].tolist(), strict=True):
            known = ids[d] is not None
            entry, heap = (score, known, -ids[d] if known else 0), self.heaps[i]
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        flat = [(i, -d if known else None, score) for i, heap in enumerate(self.heaps) for score, known, d in heap]
        columns = list(zip(*flat, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])


def _scores(index: Index, weight: np.ndarray, docs: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Scores of some documents (their length figure and counts) with every item."""
    out = np.zeros(len(docs) * index.items, dtype=np.int64)
    sizes = [len(found) for _, found in docs]
    term = np.fromiter((t for _, found in docs for t in found), dtype=np.int64, count=sum(sizes))
    tf = np.fromiter((n for _, found in docs for n in found.values()), dtype=np.int64, count=sum(sizes))
    m = np.repeat(np.array([m for m, _ in docs], dtype=np.int64), sizes)
    value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
    doc = np.repeat(np.arange(len(docs)) * index.items, sizes)
    holders = index.start[term + 1] - index.start[term]
    # Stretches whose postings fit; a single term has at most as many as there are items.
    stretch = np.cumsum(holders) // CELLS
    for part in np.split(np.arange(len(term)), np.flatnonzero(np.diff(stretch)) + 1):
        n = holders[part]
        at = np.repeat(index.start[term[part]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        np.add.at(out, np.repeat(doc[part], n) + index.item[at], np.repeat(value[part], n) * index.times[at])
    return out.reshape(len(docs), index.items)


def _search(spark: SparkSession, texts: DataFrame, items: list[str | None], top: int) -> DataFrame:
    """Stored heaps of all tasks: number of the item, document and score."""
    made = Index(items)
    index = spark.sparkContext.broadcast(made)
    documents, length, frequency = _statistics(texts, index)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()])
    sent = spark.sparkContext.broadcast(weight.astype(np.int64))

    def scan(batches):
        known, heaps, docs, ids, held = index.value, Heaps(index.value.items, top), [], [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), _raw(batch.column("text")), strict=True):
                total, found = known.counts(raw)
                if not found:
                    continue
                docs.append((75 + (25 * total * documents) // length, found))
                ids.append(doc_id)
                held += known.items + len(found)
                if held >= CELLS:
                    heaps.add(_scores(known, sent.value, docs), ids)
                    docs, ids, held = [], [], 0
        if docs:
            heaps.add(_scores(known, sent.value, docs), ids)
        yield heaps.rows()

    found = stored(texts.mapInArrow(scan, "item long, doc_id long, score long"))
    index.destroy()
    sent.destroy()
    return found


def _merged(heaps: DataFrame, top: int) -> DataFrame:
    """The best rows of every item, from the heaps of all tasks."""
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = heaps.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGED)))
    for key in (["item", "part"], ["item"]):
        place = F.row_number().over(Window.partitionBy(*key).orderBy(*best))
        part = part.withColumn("rank", place).filter(F.col("rank") <= top)
    return part.select("item", "rank", "doc_id", "score")


def _blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, list[int]]:
    """Items with the number of their block; no block has more bytes than allowed, but for one long item."""
    blocks = 1
    while True:
        cut = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
        size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)
        sizes = cut.groupBy("block").agg(size.alias("size"), F.count("*").alias("n")).collect()
        if all(row["size"] <= block_bytes or row["n"] == 1 for row in sizes):
            return cut, sorted(row["block"] for row in sizes)
        blocks = max(2 * blocks, math.ceil(2 * sum(row["size"] for row in sizes) / block_bytes))


def ranked(documents: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` documents of every item by weighted shared terms: item_id, rank, doc_id, score.

    Terms are runs of digits, ASCII letters (A to Z lower-cased) and characters beyond ASCII, in whole
    texts; null and empty texts have none. Scores are whole numbers; equal ones rank by ascending ``doc_id``,
    null ids last. Each row of ``documents`` ranks for itself, also where ids or whole rows repeat.
    Rows of ``items`` that are equal in id and text are one item; different texts under one id (or
    none) are ranked each for itself. Items that share no term with a document, and all items where there is
    no document, have no rows. Columns other than ``doc_id``, ``item_id`` and ``text`` are not read.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    cut, blocks = _blocks(stored(asked.distinct()), block_bytes)
    out = None
    for block in blocks:
        # A block of items is bounded: its texts, and with them its terms, postings and numbers.
        rows = cut.filter(F.col("block") == block).select("item_id", "text").collect()
        best = _merged(_search(spark, texts, [r["text"] for r in rows], top), top)
        names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], "item long, item_id long")
        named = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.unionByName(named)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
