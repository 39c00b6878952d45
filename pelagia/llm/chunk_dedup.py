"""Removal of passages that repeat across texts, by content-defined chunks.

A gear hash rolls over the bytes of each text: every step doubles it and adds a number
that belongs to the byte, so that it depends on the last 32 bytes. A chunk ends where
the hash has zeros in certain places, but not before ``MIN_BYTES`` and at ``MAX_BYTES`` at
the latest. Borders depend on nearby bytes only; an insertion moves the borders near it
and none further on. Texts are taken with A to Z lower-cased and white space as one
space, so that other line ends do not hide a copy. Chunks with equal digests are equal; the first one, by document and
place, stays.

Borders agree only some bytes inside a repeated passage. Each run of repeated chunks, of one chunk even, therefore
grows at both ends, as far as the text before and after it equals that beside the first place, to whole
words: the first place is asked for the ``WINDOW`` bytes there. What then holds at least
``MIN_WORDS`` words, or ``MIN_RUN`` bytes, is removed; less is a phrase or a line. A passage of 51 words is found if one
chunk of it is the same in both texts, whatever stands before and after it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.names import ddl, free, others
from pelagia.llm.storage import stored
from pelagia.llm.textbytes import LOWER, SPACE, mix, pieces

MIN_BYTES = 24
MAX_BYTES = 256
# Zeros asked of the hash: beyond the shortest, a chunk ends at one byte of 32.
ZEROS = 5
# What a run holds when it has grown: so many words, or bytes where words are long or not parted by space.
MIN_WORDS = 45
MIN_RUN = 512
# Bytes beside a first place that a run may grow by: twice the longest chunk.
WINDOW = 512

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte, over the 32 bytes up to it."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] += h[:-step] << np.uint32(step)
    return h


def plain(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with A to Z lower-cased and one space for white space, offsets, and old places."""
    space = SPACE[data]
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    inner = ends[:-1]
    keep[inner[inner < len(data)]] = True
    places = np.flatnonzero(keep)
    out = LOWER[data[places]]
    out[space[places]] = 32
    return out, np.searchsorted(places, ends), np.r_[places, len(data)]


def chunk_ends(data: np.ndarray, ends: np.ndarray) -> Iterator[list[int]]:
    """Ends of the chunks of each text, as places in ``data``."""
    marks = np.flatnonzero(gear_hashes(data) >> np.uint32(32 - ZEROS) == 0) + 1
    first = np.searchsorted(marks, ends).tolist()
    places, borders = marks.tolist(), ends.tolist()
    for k in range(len(borders) - 1):
        at, last = borders[k], borders[k + 1]
        out = []
        for mark in places[first[k] : first[k + 1]]:
            if mark - at < MIN_BYTES:
                continue
            while mark - at > MAX_BYTES:
                at += MAX_BYTES
                out.append(at)
            if mark - at >= MIN_BYTES:
                out.append(mark)
                at = mark
        while last - at > MAX_BYTES:
            at += MAX_BYTES
            out.append(at)
        if last > at:
            out.append(last)
        yield out


def _chunks(texts: DataFrame) -> DataFrame:
    """Every chunk: key and order of its row, start and stop, digest in two parts.

    ``inner`` marks the chunks that come in the same text before, from ``hstart`` to ``hstop``.
    """

    def cut(batches):
        for batch in batches:
            keys, order = (batch.column(c).to_numpy() for c in ("row", "ord"))
            for a, _, data, borders in pieces(batch.column("text")):
                rows, starts, stops, digests, holders = [], [], [], [], []
                data, ends, places = plain(data, borders)
                raw, places = data.tobytes(), places.tolist()
                for k, cuts in enumerate(chunk_ends(data, ends)):
                    at, begin = int(ends[k]), int(borders[k])
                    seen: dict = {}
                    for end in cuts:
                        digest = hashlib.blake2b(raw[at:end], digest_size=16).digest()
                        rows.append(a + k)
                        starts.append(places[at] - begin)
                        stops.append(places[end] - begin)
                        digests.append(digest)
                        holders.append(seen.get(digest))
                        seen.setdefault(digest, (starts[-1], stops[-1]))
                        at = end
                halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                at_rows = np.array(rows, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[at_rows]),
                        pa.array(order[at_rows]),
                        pa.array(starts, pa.int32()),
                        pa.array(stops, pa.int32()),
                        pa.array(halves[:, 0].copy()),
                        pa.array(halves[:, 1].copy()),
                        pa.array([h is not None for h in holders], pa.bool_()),
                        pa.array([h and h[0] for h in holders], pa.int32()),
                        pa.array([h and h[1] for h in holders], pa.int32()),
                    ],
                    ["row", "ord", "start", "stop", "d1", "d2", "inner", "hstart", "hstop"],
                )

    schema = "row long, ord long, start int, stop int, d1 long, d2 long, inner boolean, hstart int, hstop int"
    return texts.mapInArrow(cut, schema)


def repeated_chunks(texts: DataFrame) -> DataFrame:
    """Row key, start and stop in bytes of every chunk that repeats one before it, and the same of that one.

    ``texts`` has ``row``, a key, ``ord``, its place among all rows, and ``text``.
    """
    chunks = stored(_chunks(texts))
    outer = chunks.filter("not inner").drop("inner", "hstart", "hstop")
    first = outer.groupBy("d1", "d2").agg(F.min(F.struct("ord", "row", "start", "stop")).alias("h"), F.count("*").alias("n"))
    later = outer.join(first.filter("n > 1"), ["d1", "d2"]).filter("ord > h.ord")
    return later.selectExpr("row", "start", "stop", "h.row hrow", "h.start hstart", "h.stop hstop").unionByName(
        chunks.filter("inner").selectExpr("row", "start", "stop", "row hrow", "hstart", "hstop")
    )


def grown_runs(texts: DataFrame) -> DataFrame:
    """Runs of repeated chunks by row, with the bytes before and after their first places.

    ``runs`` has start and stop, and ``left`` and ``right``, as ``plain`` has them.
    """
    spans = repeated_chunks(texts).groupBy("row").agg(F.collect_set(F.struct("start", "stop", "hrow", "hstart", "hstop")).alias("spans"))

    def join(batches):
        names = ("start", "stop", "hrow", "hstart", "hstop")
        for batch in batches:
            lists = batch.column("spans")
            own = np.repeat(batch.column("row").to_numpy(), np.diff(lists.offsets.to_numpy()))
            values = lists.flatten()
            start, stop, hrow, hstart, hstop = (values.field(names.index(n)).to_numpy() for n in names)
            order = np.lexsort((start, np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))))
            own, start, stop, hrow, hstart, hstop = (x[order] for x in (own, start, stop, hrow, hstart, hstop))
            begins = np.flatnonzero(np.r_[True, (start[1:] != stop[:-1]) | (own[1:] != own[:-1])][: len(own)])
            last = np.r_[begins[1:], len(own)][: len(begins)] - 1
            columns = (own[begins], start[begins], stop[last], hrow[begins], hstart[begins], hrow[last], hstop[last])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["row", "start", "stop", "lrow", "lplace", "rrow", "rplace"])

    runs = stored(spans.mapInArrow(join, "row long, start int, stop int, lrow long, lplace int, rrow long, rplace int"))
    asked = runs.selectExpr("lrow hrow", "lplace place", "false after").unionByName(runs.selectExpr("rrow hrow", "rplace place", "true after"))
    asked = asked.distinct().groupBy("hrow").agg(F.collect_list(F.struct("place", "after")).alias("asked"))

    def answer(batches):
        for batch in batches:
            keys, places, sides, found = [], [], [], []
            for key, text, wanted in zip(batch.column("hrow").to_pylist(), batch.column("text").to_pylist(), batch.column("asked").to_pylist(), strict=True):
                raw = text.encode()
                for x in wanted:
                    keys.append(key)
                    places.append(x["place"])
                    sides.append(x["after"])
                    found.append(_beside(raw, x["place"], x["after"])[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(places, pa.int32()), pa.array(sides, pa.bool_()), pa.array(found, pa.binary())],
                ["hrow", "place", "after", "bytes"],
            )

    holders = asked.join(texts.select(F.col("row").alias("hrow"), "text"), "hrow")
    # Rows that repeat answer alike.
    beside = stored(holders.mapInArrow(answer, "hrow long, place int, after boolean, bytes binary").dropDuplicates(["hrow", "place", "after"]))
    left = beside.filter("not after").selectExpr("hrow lrow", "place lplace", "bytes left")
    right = beside.filter("after").selectExpr("hrow rrow", "place rplace", "bytes right")
    both = runs.join(left, ["lrow", "lplace"]).join(right, ["rrow", "rplace"])
    return both.groupBy("row").agg(F.collect_list(F.struct("start", "stop", "left", "right")).alias("runs"))


def _beside(raw: bytes, at: int, after: bool) -> tuple[bytes, list[int]]:
    """At most ``WINDOW`` bytes before or after a place, as ``plain`` has them, and their places and the end."""
    low, high = (at, at + 2 * WINDOW) if after else (max(0, at - 2 * WINDOW), at)
    data = np.frombuffer(raw[low:high], dtype=np.uint8)
    out, _, places = plain(data, np.array([0, len(data)]))
    cut = slice(0, WINDOW) if after else slice(max(0, len(out) - WINDOW), None)
    places = (places + low).tolist()
    return out[cut].tobytes(), places[: min(WINDOW, len(out)) + 1] if after else places[cut]


def _common(own: bytes, other: bytes, space: int) -> int:
    """How many bytes at the beginning are equal, up to the end of a word in both, with so many spaces after it."""
    least = min(len(own), len(other))
    differ = np.flatnonzero(np.frombuffer(own[:least], dtype=np.uint8) != np.frombuffer(other[:least], dtype=np.uint8))
    n = int(differ[0]) if len(differ) else least
    if own[n : n + 1] in (b"", b" ") and other[n : n + 1] in (b"", b" "):
        return n
    found = own.rfind(b" ", 0, n)
    return found + space if found >= 0 else 0


def _grown(raw: bytes, runs: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs, in order, grown to their ends and joined where they meet."""
    out: list[list[int]] = []
    for run in sorted(runs, key=lambda x: x["start"]):
        # The space before a run stays, so that the words around it do not become one.
        own, places = _beside(raw, run["start"], False)
        start = places[len(own) - _common(own[::-1], run["left"][::-1], 0)]
        own, places = _beside(raw, run["stop"], True)
        stop = places[_common(own, run["right"], 1)]
        if out and start <= out[-1][1]:
            out[-1] = [min(start, out[-1][0]), max(stop, out[-1][1])]
            while len(out) > 1 and out[-1][0] <= out[-2][1]:
                a = out.pop()
                out[-1] = [min(a[0], out[-1][0]), max(a[1], out[-1][1])]
        else:
            out.append([start, stop])
    found = np.array(out, dtype=np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


MADE = ("removed_spans", "removed_bytes")


def dedup_chunks(
    documents: DataFrame, min_words: int = MIN_WORDS, min_run: int = MIN_RUN, made: Sequence[str] = MADE
) -> DataFrame:
    """All columns of the documents, with repeated passages cut out of ``text``.

    A passage stays where it comes first, by ``doc_id`` and place in the text; a null
    ``doc_id`` is replaced by a hash of the text. Rows that share an id count as one place:
    what repeats between them stays. Null and empty texts come back as they are; a text
    of which only white space is left becomes empty. Spans grow to whole characters. Adds
    ``removed_spans`` (start and stop in bytes of the old text) and ``removed_bytes``, or the names given
    as ``made``; columns that have these give way.
    """
    names = others(documents, made)
    row, found = free([*documents.columns, *made], "row", "spans")
    keyed = documents.withColumn(row, F.xxhash64(F.lit(11), F.col("doc_id").cast("long"), F.col("text").cast("string")))
    texts = keyed.select(
        F.col(row).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), row).alias("ord"),
        F.col("text").cast("string").alias("text"),
    )
    runs = grown_runs(texts).select(F.col("row").alias(row), F.col("runs").alias(found))
    joined = keyed.join(runs, row, "left").select(*names, found)

    def remove(batches):
        for batch in batches:
            out = batch.column("text").to_pylist()
            kept, size = [[] for _ in out], [0] * len(out)
            spans = batch.column(found)
            for k in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)).tolist():
                raw = out[k].encode()
                runs = _runs(raw, *_grown(raw, spans[k].as_py()), min_words, min_run)
                if runs:
                    out[k], kept[k] = _without(raw, runs)
                    size[k] = sum(s["stop"] - s["start"] for s in kept[k])
            columns = {c: batch.column(c) for c in names}
            columns["text"] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    *columns.values(),
                    pa.array(kept, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                    pa.array(size, pa.int64()),
                ],
                [*names, *made],
            )

    extra = f"`{made[0]}` array<struct<start:int,stop:int>>, `{made[1]}` long"
    return joined.mapInArrow(remove, ddl(documents, names) + extra)


def _runs(raw: bytes, starts: np.ndarray, stops: np.ndarray, min_words: int, min_run: int) -> list[tuple[int, int]]:
    """Adjacent spans joined; those that stay short are left out."""
    new = np.flatnonzero(np.r_[True, starts[1:] != stops[:-1]])
    a, b = starts[new], stops[np.r_[new[1:] - 1, len(stops) - 1]]
    runs = zip(a.tolist(), b.tolist(), strict=True)
    return [(x, y) for x, y in runs if y - x >= min_run or len(raw[x:y].split()) >= min_words]


def _without(raw: bytes, runs: list[tuple[int, int]]) -> tuple[str, list[dict]]:
    """The text without the runs, and what was cut."""
    left, cut, at = [], [], 0
    for start, stop in runs:
        start, stop = _whole(raw, start), _whole(raw, stop)
        left.append(raw[at:start])
        cut.append({"start": start, "stop": stop})
        at = stop
    left.append(raw[at:])
    rest = b"".join(left)
    blank = SPACE[np.frombuffer(rest, dtype=np.uint8)].all()
    return "" if blank else rest.decode(), cut


def _whole(raw: bytes, at: int) -> int:
    """The next place from ``at`` on where a character begins."""
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return at
