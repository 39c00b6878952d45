"""Scores of texts under a model that mixes bit predictors, trained on the corpus.

A text is coded byte by byte and each byte bit by bit, highest first, A to Z lower-cased, with
an end mark. The contexts are the one to five bytes before, and the bytes of the word so far. Each
context and the bits known so far have counts of the zeros and ones that followed in the training texts
and vote with the logit of their ratio; a vote's weight is gated by kind of context, bit, and how much the
context has seen. The weights are learned online, by logistic regression on one group of occurrences after the
other, in each of many buckets, and averaged. A last table, addressed by the known bits and the mixed
logit, corrects the result to what was seen in training. While learning, an occurrence is taken out of
the counts it is predicted from, so that rare contexts are not trusted too much.

The model is fixed when texts are scored: a text has one score, whatever stands beside it. Then the probability
of a byte depends on its state only, the six bytes up to it and its word so far. Tasks name the different
states of each ``PART`` of their texts and how often training texts have them. States meet in buckets by the
hash of their four bytes before, so that a bucket has all occurrences of its contexts of four and five bytes and
of words: these are counted exactly, and grow with the corpus. Contexts of one to three bytes are hashed to
cells of tables of fixed size, which every task gets. A bucket answers with the logarithm of each
state's probability, in the order in which it was asked, and the tasks read their texts again and
add the answers up.

Tasks know their answers by the number of their partition, so the texts must come in the same partitions and
order when they are read again, as those of stored tables do. A sum over the names of the states is
checked, and other texts raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.blocks import grouped, in_groups, packed, unpacked
from pelagia.llm.storage import shared_folder, stored
from pelagia.llm.textbytes import LOWER, SPACE, Places, mix, pieces, range_hashes, range_numbers, word_bounds
from pelagia.sources.commits import qualified

# Context lengths in bytes: those with cells, with the logarithm of their number, and those with counts, 0 for the word.
LOW, HIGH = (1, 2, 3), (4, 5, 0)
CELLS = (18, 19, 21)
KINDS = len(LOW) + len(HIGH)
REACH = 5
# States between two steps, and rounds of averaging.
STEP, ROUNDS, RATE = 2048, 1, 0.005
LEVELS = 12
SLOTS = 33
GRID = 2048
# A text's end is a zero byte and a flag; a zero byte of the text has the other flag.
FLAG = 2.0**-12
# Words whose counts are sent to all tasks: the most frequent ones, at most so many.
FREQUENT = 1 << 18
# Entries in a bucket of words, and states that a bucket is asked for, on the average.
BUCKET = 1 << 19
ASKS = 1 << 20
# Bytes of text that are worked on at a time, whose states are named together, and different keys that a task holds.
PIECE = 1 << 19
PART = 16 << 20
NAMED = 1 << 20
HELD = 1 << 20
# Tasks that bring the contexts of one to three bytes together.
LOW_TASKS = 8

# A count n is kept as 8 log2(1 + n), in a byte.
_SEEN = 2.0 ** (np.arange(256) / 8) - 1


def _votes(less_zero: int, less_one: int) -> tuple[np.ndarray, np.ndarray]:
    """Logit and gate of every pair of kept counts, with occurrences taken out."""
    n0 = np.maximum(_SEEN - less_zero, 0)[:, None]
    n1 = np.maximum(_SEEN - less_one, 0)[None, :]
    logit = np.log((n1 + 0.4) / (n0 + 0.4)).astype(np.float32).ravel()
    return logit, _gate(n0 + n1).ravel()


def _gate(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(seen + 1)), LEVELS - 1).astype(np.uint8)


_VOTES = _votes(0, 0)
# With one zero taken out, and then with one one: addressed by the bit that came and the kept counts.
_LEFT = tuple(np.concatenate(v) for v in zip(_votes(1, 0), _votes(0, 1), strict=True))


def _hashed(size: int, context: np.ndarray, high: np.ndarray | None = None) -> np.ndarray:
    """First of the 16 cells, of 2 ** ``size``, for one half of a byte in a context; the lower half knows the upper."""
    h = context * np.uint64(0x9E3779B97F4A7C15)
    if high is not None:
        h = h + (high + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(68 - size)).astype(np.int64) << 4


def _low_contexts(runs: np.ndarray) -> list[np.ndarray]:
    before = runs >> np.uint64(8)
    return [before & np.uint64((1 << 8 * order) - 1) for order in LOW]


def _cells(runs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each bit of the last bytes: the bits known under a leading one, the bit, the cells of the short contexts."""
    contexts, byte = _low_contexts(runs), (runs & np.uint64(255)).astype(np.int64)
    for half in (0, 1):
        upper = byte >> 4
        high = upper.astype(np.uint64) if half else None
        first = [_hashed(k, c, high) for k, c in zip(CELLS, contexts, strict=True)]
        nibble = byte & 15 if half else upper
        for b in range(4):
            bit = 4 * half + b
            inside = (1 << b) | (nibble >> (4 - b))
            known = (1 << bit) | (byte >> (8 - bit))
            yield bit, known, (byte >> (7 - bit)) & 1, [f + inside for f in first]


class Contexts:
    """Votes of the long contexts of a bucket's states, from all occurrences that these have."""

    def __init__(self, runs: np.ndarray, words: np.ndarray, counts: np.ndarray, less: int):
        """``less`` is 1 to take an occurrence out of the counts that predict it."""
        four = runs & np.uint64((1 << 40) - 1)
        word = mix((four >> np.uint64(8)) | words.astype(np.uint64) << np.uint64(32)) & ~np.uint64(255)
        self.place, self.logit, self.gate = [], [], []
        for key in (four, runs, word | (runs & np.uint64(255))):
            entries, place = np.unique(key, return_inverse=True)
            n = np.bincount(place, weights=counts, minlength=len(entries))
            # Occurrences that share the context and the first so many bits of the byte.
            sums = []
            for b in range(9):
                prefix = entries >> np.uint64(8 - b)
                group = np.cumsum(np.r_[False, prefix[1:] != prefix[:-1]][: len(entries)])
                sums.append(np.bincount(group, weights=n)[group] if len(n) else n)
            byte = (entries & np.uint64(255)).astype(np.int64)
            logit, gate = np.empty((8, len(entries)), dtype=np.float32), np.empty((8, len(entries)), dtype=np.uint8)
            for b in range(8):
                own, other = np.maximum(sums[b + 1] - less, 0), sums[b] - sums[b + 1]
                ratio = np.log((own + 0.4) / (other + 0.4))
                logit[b] = np.where((byte >> (7 - b)) & 1, ratio, -ratio)
                gate[b] = _gate(own + other)
            self.place.append(place)
            self.logit.append(logit)
            self.gate.append(gate)

    def places(self, some: np.ndarray | slice) -> list[np.ndarray]:
        """Which entry of each kind some states have."""
        return [p[some] for p in self.place]

    def votes_at(self, places: list[np.ndarray], bit: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Logit and gate of each kind for one bit of the states with these places."""
        return [(v[bit][p], g[bit][p]) for p, v, g in zip(places, self.logit, self.gate, strict=True)]

    def votes(self, some: np.ndarray, bit: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Logit and gate of each kind for one bit of some states."""
        return self.votes_at(self.places(some), bit)


class Model:
    """Cells, weights and corrections."""

    def __init__(self, cells: list[np.ndarray] | None = None):
        self.cells = cells
        self.weights = np.full((8, KINDS, LEVELS), 0.3)
        self.weights[:, :, 0] = 0
        self.bias = np.zeros(256)
        self.final: np.ndarray | None = None

    def _learned(self, long: list[tuple[np.ndarray, np.ndarray]], bit: int, known: np.ndarray, y: np.ndarray, cells: list[np.ndarray]):
        """Mixed logit without the occurrence itself, and the logit and gate of each context; ``long`` are the long ones'."""
        came, votes = y << 16, []
        for k, cell in enumerate(cells):
            left = came | self.cells[k][cell]
            votes.append(tuple(v[left] for v in _LEFT))
        votes += long
        z = self.bias[known]
        for k, (logit, gate) in enumerate(votes):
            z = z + self.weights[bit, k][gate] * logit
        return np.clip(z, -15, 15), votes

    def learn(self, contexts: Contexts, runs: np.ndarray, words: np.ndarray, counts: np.ndarray) -> None:
        """One pass over states with how often each comes, in small steps."""
        scale_w, scale_b = np.full_like(self.weights, 1e-6), np.full_like(self.bias, 1e-6)
        order, mean = np.argsort(_names(runs, words)), counts.mean()
        for at in range(0, len(runs), STEP):
            some = order[at : at + STEP]
            share, places = counts[some] / (mean * len(some)), contexts.places(some)
            for bit, known, y, cells in _cells(runs[some]):
                z, votes = self._learned(contexts.votes_at(places, bit), bit, known, y, cells)
                error = share * (y - 1 / (1 + np.exp(-z)))
                for k, (logit, gate) in enumerate(votes):
                    g = np.bincount(gate, weights=error * logit, minlength=LEVELS)
                    scale_w[bit, k] += g * g
                    self.weights[bit, k] += RATE * g / np.sqrt(scale_w[bit, k])
                g = np.bincount(known, weights=error, minlength=256)
                scale_b += g * g
                self.bias += RATE * g / np.sqrt(scale_b)

    @staticmethod
    def _slots(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.clip((z + 8) * ((SLOTS - 1) / 16), 0, SLOTS - 1.001)
        low = place.astype(np.int64)
        return low, place - low

    def seen(self, contexts: Contexts, runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each known bits and slot, what came: weight of ones, weight of all."""
        out = np.zeros((2, 256 * SLOTS))
        for at in range(0, len(runs), 1 << 15):
            some = slice(at, at + (1 << 15))
            c, places = counts[some], contexts.places(some)
            for bit, known, y, cells in _cells(runs[some]):
                low, part = self._slots(self._learned(contexts.votes_at(places, bit), bit, known, y, cells)[0])
                for place, share in ((known * SLOTS + low, 1 - part), (known * SLOTS + low + 1, part)):
                    out[0] += np.bincount(place, weights=c * share * y, minlength=out.shape[1])
                    out[1] += np.bincount(place, weights=c * share, minlength=out.shape[1])
        return out

    def correct(self, seen: np.ndarray) -> None:
        """Set the last table; cells that have seen little stay near what they stand for."""
        z = np.tile(np.linspace(-8, 8, SLOTS), 256)
        self.final = (seen[0] + 8 / (1 + np.exp(-z))) / (seen[1] + 8)

    def fixed(self) -> None:
        """Work out the weighted vote of every pair of kept counts, and the logarithm of every result."""
        logit, gate = _VOTES
        self.table = (self.weights[:, : len(LOW), gate] * logit).astype(np.float32)
        z = (np.arange(GRID) + 0.5) * (30 / GRID) - 15
        known = np.repeat(np.arange(256), GRID)
        low, part = self._slots(np.tile(z, 256))
        p = np.tile(1 / (1 + np.exp(-z)), 256)
        if self.final is not None:
            at = known * SLOTS + low
            p = 0.5 * p + 0.5 * (self.final[at] * (1 - part) + self.final[at + 1] * part)
        p = np.clip(p, 1e-6, 1 - 1e-6)
        self.logs = np.log2(np.stack([1 - p, p])).astype(np.float32).ravel()

    def log2(self, contexts: Contexts, runs: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of the last byte of each state, given its contexts.

        The mixed logit is taken in ``GRID`` steps.
        """
        out = np.zeros(len(runs))
        for at in range(0, len(runs), 1 << 14):
            some = slice(at, at + (1 << 14))
            places = contexts.places(some)
            for bit, known, y, cells in _cells(runs[some]):
                z = self.bias[known] + 15
                for k, cell in enumerate(cells):
                    z += self.table[bit, k][self.cells[k][cell]]
                for k, (logit, gate) in enumerate(contexts.votes_at(places, bit), len(LOW)):
                    z += self.weights[bit, k][gate] * logit
                z *= GRID / 30
                np.clip(z, 0, GRID - 1, out=z)
                out[some] += self.logs[(y << 8 | known) * GRID + z.astype(np.int64)]
        return out


def states(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte and end mark the run of six bytes up to it and a 32-bit hash of its word so far.

    Also where each text begins. Before a text stand zeros. The hash is 0 where the run shows the
    word from its beginning on.
    """
    texts, size = len(ends) - 1, np.diff(ends)
    first = ends[:-1] + np.arange(texts)
    # Each text with its end after it, and seven zeros before all so that eight bytes can be read up to every place.
    padded = np.zeros(REACH + 2 + len(data) + texts, dtype=np.uint8)
    out = padded[REACH + 2 :]
    inner = np.ones(len(out), dtype=bool)
    inner[first + size] = False
    out[inner] = LOWER[data]
    blocks = np.ndarray((len(out),), dtype=">u8", buffer=padded, strides=(1,))
    runs = blocks.astype(np.uint64)
    runs &= np.uint64((1 << 8 * (REACH + 1)) - 1)
    # Before a text stand zeros, and not the bytes of another.
    for k in range(REACH):
        runs[first[size >= k] + k] &= np.uint64((1 << 8 * (k + 1)) - 1)
    # Where the word of each byte begins; white space begins the next one.
    begins = np.zeros(len(out), dtype=bool)
    begins[1:] = SPACE[out[:-1]]
    begins[first] = True
    starts = np.flatnonzero(begins)
    lengths = np.diff(starts, append=len(out))
    begin = np.repeat(starts, lengths)
    deep = np.flatnonzero(np.arange(len(out)) - begin >= REACH)
    word = np.zeros(len(out), dtype=np.uint32)
    number = range_numbers(out, begin[deep], deep) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)
    word[deep] = number.astype(np.uint32)
    return runs, word, first


def states_in_parts(data: np.ndarray, ends: np.ndarray, size: int = 1 << 16) -> tuple[np.ndarray, ...]:
    """As ``states``, worked out for some texts at a time, which the caches hold."""
    found, at = [], 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
        found.append(states(data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]))
        at = to
    return (*(np.concatenate([f[k] for f in found]) for k in (0, 1)), ends[:-1] + np.arange(len(ends) - 1))


def _names(runs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A number for each state, never 0."""
    h = mix(words.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) ^ runs * np.uint64(0x9E3779B97F4A7C15))
    return np.maximum(h, np.uint64(1))


def _state_bucket(runs: np.ndarray, buckets: int) -> np.ndarray:
    """By the four bytes before the last, so that a longer context is in one bucket."""
    four = (runs >> np.uint64(8)) & np.uint64((1 << 32) - 1)
    return ((mix(four + np.uint64(1)) >> np.uint64(16)) % np.uint64(buckets)).astype(np.int32)


# Columns of what is asked for, run, word and count, and of a bucket's states.
_ASK = ("<u8", "<u4", "<u4")
_STATE = ("<u8", "<u4", "<u8")


class Part:
    """The different states of some texts, numbered in the order in which they come."""

    def __init__(self, room: int):
        self.places, self.room, self.used, self.bytes = Places(1 << (2 * room - 1).bit_length()), room, 0, 0
        self.runs, self.words = np.zeros(room, dtype=np.uint64), np.zeros(room, dtype=np.uint32)
        self.names, self.counts = np.zeros(room, dtype=np.uint64), np.zeros(room, dtype=np.int64)

    def add(self, runs: np.ndarray, words: np.ndarray, names: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers of different states; ``counts`` are added to theirs."""
        at, new = self.places.number(names, self.used)
        own = slice(self.used, self.used + len(new))
        self.runs[own], self.words[own], self.names[own] = runs[new], words[new], names[new]
        self.used += len(new)
        self.counts[at] += counts
        return at

    def by_bucket(self, buckets: int) -> list[tuple[int, np.ndarray]]:
        """Each bucket that has some of the states, with their numbers by run."""
        runs = self.runs[: self.used]
        place = _state_bucket(runs, buckets)
        # By the lowest 16 bits first and the bucket last, each time in the order there was: numpy counts so short keys.
        order = np.argsort(runs.astype(np.uint16), kind="stable")
        for shift in (16, 32):
            order = order[np.argsort((runs >> np.uint64(shift)).astype(np.uint16)[order], kind="stable")]
        order = order[np.argsort(place.astype(np.min_scalar_type(buckets - 1))[order], kind="stable")]
        found, first = np.unique(place[order], return_index=True)
        return list(zip(found.tolist(), np.split(order, first[1:]), strict=True))

    def check(self, numbers: np.ndarray) -> int:
        """What tells that states are the same and come in the same order."""
        return int((self.names[numbers] * (2 * np.arange(len(numbers), dtype=np.uint64) + np.uint64(1))).sum().view(np.int64))


def in_parts(batches, kept: bool) -> Iterator[tuple[Part, list]]:
    """The texts of a task in parts: their states, and the pieces they are made of.

    A piece is a batch, its first and last row, bytes, offsets, the number of each state if they are ``kept``,
    and where each text begins. The same texts give the same parts.
    """
    part, held = Part(NAMED), []
    for batch in batches:
        learned = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        for a, b, data, ends in pieces(batch.column("text"), PIECE):
            runs, words, first = states_in_parts(data, ends)
            codes, names = pd.factorize(_names(runs, words))
            place = np.empty(len(names), dtype=np.int64)
            place[codes] = np.arange(len(codes))
            counts = np.bincount(codes[np.repeat(learned[a:b], np.diff(ends) + 1)], minlength=len(names))
            if part.used and (part.bytes + len(codes) > PART or part.used + len(names) > part.room):
                yield part, held
                part, held = Part(NAMED), []
            if len(names) > part.room:
                part = Part(len(names))
            numbers = part.add(runs[place], words[place], np.asarray(names, dtype=np.uint64), counts)
            part.bytes += len(codes)
            held.append((batch, a, b, data, ends, numbers[codes] if kept else None, first))
    if part.used:
        yield part, held


class Tally:
    """Counts by key, up to ``HELD`` keys."""

    def __init__(self):
        self.places, self.used = Places(2 * HELD), 0
        self.keys, self.counts = np.zeros(HELD, dtype=np.uint64), np.zeros(HELD, dtype=np.int64)

    def room(self, keys: np.ndarray) -> bool:
        return self.used + len(keys) <= HELD

    def add(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Add counts of different keys, of which there is room for all; which of them are new."""
        names = np.maximum(mix(keys), np.uint64(1))
        at = self.places.find(names)
        old, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        self.counts[at[old]] += counts[old]
        own = np.arange(self.used, self.used + len(new))
        self.keys[own], self.counts[own] = keys[new], counts[new]
        self.places.enter(names[new], own.astype(np.int32))
        self.used += len(new)
        return new


def _word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and where each text's begin. The end of a text is no word here."""
    data = LOWER[data]
    starts, stops = word_bounds(data, ends)
    return range_hashes(data, starts, stops), np.searchsorted(starts, ends)


_COUNTED = np.dtype([("key", "<u8"), ("n", "<u8")])


def _added(keys: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and the sums of their counts, or how often each comes."""
    codes, distinct = pd.factorize(keys)
    if counts is None:
        return np.asarray(distinct, dtype=np.uint64), np.bincount(codes, minlength=len(distinct)).astype(np.int64)
    sums = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(sums, codes, counts.astype(np.int64))
    return np.asarray(distinct, dtype=np.uint64), sums


STATES, WORDS = 0, 1
_SENT = "kind int, bucket int, p int, j int, check long, rows binary"


def _sent(kind: int, bucket: list[int], rows: list[bytes], p: int = -1, j: int = -1, check: list[int] | None = None) -> pa.RecordBatch:
    n = len(bucket)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * n, pa.int32()),
            pa.array(bucket, pa.int32()),
            pa.array([p] * n, pa.int32()),
            pa.array([j] * n, pa.int32()),
            pa.array(check or [0] * n, pa.int64()),
            pa.array(rows, pa.binary()),
        ],
        ["kind", "bucket", "p", "j", "check", "rows"],
    )


def _blobs(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Counts of words by bucket."""
    rows = np.empty(len(keys), dtype=_COUNTED)
    rows["key"], rows["n"] = keys, counts
    place = ((mix(keys) >> np.uint64(16)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(place, kind="stable")
    rows, place = rows[order], place[order]
    found, first = np.unique(place, return_index=True)
    return _sent(WORDS, found.tolist(), [x.tobytes() for x in np.split(rows, first[1:])])


def corpus_counts(texts: DataFrame, asks: int, buckets: int) -> DataFrame:
    """Merged counts of the states of all texts and of the words of training texts, by bucket.

    A bucket of states is sorted by run (``rows``), counts occurrences in training texts, and knows
    for each part that has some of them which and in what order (``asked``). A bucket of words has
    sorted (key, n).
    """

    def count(batches):
        p, held, j = TaskContext.get().partitionId(), Tally(), 0
        # Words of a piece are counted when its part is done.
        for j, (part, found) in enumerate(in_parts(batches, False)):
            for batch, a, b, data, ends, _, _ in found:
                words, bounds = _word_hashes(data, ends)
                learned = ~batch.column("held_out").to_numpy(zero_copy_only=False)[a:b]
                keys, counts = _added(words[np.repeat(learned, np.diff(bounds))], None)
                if not held.room(keys) and held.used:
                    yield _blobs(held.keys[: held.used], held.counts[: held.used], buckets)
                    held = Tally()
                if held.room(keys):
                    held.add(keys, counts)
                else:
                    yield _blobs(keys, counts, buckets)
            each = part.by_bucket(asks)
            # A part has fewer bytes than its counts can hold, but for one text of four billion.
            counts = np.minimum(part.counts, 0xFFFFFFFF).astype(np.uint32)
            rows = [packed(part.runs[numbers], part.words[numbers], counts[numbers]) for _, numbers in each]
            checks = [part.check(numbers) for _, numbers in each]
            yield _sent(STATES, [bucket for bucket, _ in each], rows, p, j, checks)
        if held.used:
            yield _blobs(held.keys[: held.used], held.counts[: held.used], buckets)

    def add(batches):
        for table in grouped(batches, ["kind", "bucket"]):
            yield _merged_words(table) if table["kind"][0].as_py() == WORDS else _merged_states(table)

    counted = texts.mapInArrow(count, _SENT)
    schema = "kind int, bucket int, rows binary, asked array<struct<p:int,j:int,check:long,index:binary>>, total long, distinct long, sizes array<long>"
    return in_groups(counted, ["kind", "bucket"]).mapInArrow(add, schema)


_ASKED_BY = pa.list_(pa.struct([("p", pa.int32()), ("j", pa.int32()), ("check", pa.int64()), ("index", pa.binary())]))


def _merged(table: pa.Table, rows: bytes, asked: list | None, total: int, distinct: int, sizes: list[int] | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            table["kind"].combine_chunks()[:1],
            table["bucket"].combine_chunks()[:1],
            pa.array([rows], pa.binary()),
            pa.array([asked], _ASKED_BY),
            pa.array([total], pa.int64()),
            pa.array([distinct], pa.int64()),
            pa.array([sizes], pa.list_(pa.int64())),
        ],
        ["kind", "bucket", "rows", "asked", "total", "distinct", "sizes"],
    )


def _merged_words(table: pa.Table) -> pa.RecordBatch:
    rows = np.frombuffer(b"".join(table["rows"].to_pylist()), dtype=_COUNTED)
    keys, counts = _added(rows["key"], rows["n"])
    order = np.argsort(keys)
    out = np.empty(len(keys), dtype=_COUNTED)
    out["key"], out["n"] = keys[order], counts[order]
    # How many keys have counts of so many bits.
    sizes = np.bincount(np.log2(out["n"]).astype(np.int64), minlength=64)
    return _merged(table, out.tobytes(), None, int(counts.sum()), len(keys), sizes.tolist())


def _merged_states(table: pa.Table) -> pa.RecordBatch:
    blobs = [unpacked(b, *_ASK) for b in table["rows"].to_pylist()]
    runs, words, times = (np.concatenate([b[k] for b in blobs]) for k in range(3))
    codes, names = pd.factorize(_names(runs, words))
    place = np.empty(len(names), dtype=np.int64)
    place[codes] = np.arange(len(codes))
    order = np.lexsort((words[place], runs[place]))
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    index = rank[codes]
    counts = np.zeros(len(names), dtype=np.int64)
    np.add.at(counts, index, times.astype(np.int64))
    out = packed(runs[place][order], words[place][order], counts.astype(np.uint64))
    cuts = np.cumsum([0, *(len(b[0]) for b in blobs)]).tolist()
    parts = zip(*(table[c].to_pylist() for c in ("p", "j", "check")), cuts[:-1], cuts[1:], strict=True)
    steps = [packed(np.diff(index[a:b], prepend=np.int32(0))) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    asked = [{"p": p, "j": j, "check": c, "index": s} for (p, j, c, _, _), s in zip(parts, steps, strict=True)]
    return _merged(table, out, asked, int(counts.sum()), len(names), None)


def _states(blob: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    runs, words, n = unpacked(blob.as_py(), *_STATE)
    return runs, words, n.astype(np.float64)


def low_cells(states: DataFrame) -> list[np.ndarray]:
    """The kept counts of the cells of short contexts, two bytes each. The tables have a fixed size."""
    entry = np.dtype([("key", "<u4"), ("n", "<u8")])

    def spread(batches):
        for batch in batches:
            for blob in batch.column("rows"):
                runs, _, n = _states(blob)
                keys, counts = _added(runs & np.uint64((1 << 32) - 1), n.astype(np.int64))
                out = np.empty(len(keys), dtype=entry)
                out["key"], out["n"] = keys, counts
                place = (mix(keys) % np.uint64(LOW_TASKS)).astype(np.int64)
                parts = [out[place == k].tobytes() for k in range(LOW_TASKS)]
                yield pa.RecordBatch.from_arrays([pa.array(range(LOW_TASKS), pa.int32()), pa.array(parts, pa.binary())], ["slice", "rows"])

    def add(batches):
        total = [np.zeros((2, 1 << size), dtype=np.int64) for size in CELLS]
        for table in grouped(batches, ["slice"]):
            rows = np.frombuffer(b"".join(table["rows"].to_pylist()), dtype=entry)
            keys, counts = _added(rows["key"].astype(np.uint64), rows["n"])
            for _, _, y, cells in _cells(keys):
                for k, cell in enumerate(cells):
                    for bit in (0, 1):
                        np.add.at(total[k][bit], cell[y == bit], counts[y == bit])
        for k, (zero, one) in enumerate(total):
            at = np.flatnonzero(zero + one)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, dtype=np.int32)), pa.array(at), pa.array(zero[at]), pa.array(one[at])],
                ["k", "cell", "zero", "one"],
            )

    parts = in_groups(states.select("rows").mapInArrow(spread, "slice int, rows binary"), ["slice"])
    sums = parts.mapInArrow(add, "k int, cell long, zero long, one long").groupBy("k", "cell")
    # At most as many rows as the tables have cells.
    found = sums.agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toPandas()
    out = []
    for k, size in enumerate(CELLS):
        total, own = np.zeros((2, 1 << size)), found[found["k"] == k]
        total[:, own["cell"].to_numpy()] = own["zero"].to_numpy(), own["one"].to_numpy()
        kept = np.minimum(np.round(8 * np.log2(1 + total)), 255).astype(np.uint16)
        out.append(kept[0] << 8 | kept[1])
    return out


def fit(states: DataFrame) -> tuple[Model, Broadcast]:
    """Cells, then weights and corrections from the states of all training texts.

    Every bucket learns by itself, so that the model does not depend on which task has which.
    """
    sent = states.sparkSession.sparkContext.broadcast(low_cells(states))
    model = Model()

    def taught(batches) -> Iterator[tuple[Contexts, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for blob in batch.column("rows"):
                runs, words, n = _states(blob)
                seen = n > 0
                runs, words, n = runs[seen], words[seen], n[seen]
                if len(runs):
                    yield Contexts(runs, words, n, 1), runs, words, n

    for _ in range(ROUNDS):
        start = (model.weights, model.bias)

        def learn(batches, start=start):
            total, mass = np.zeros(start[0].size + start[1].size), 0.0
            for contexts, runs, words, n in taught(batches):
                own = Model(sent.value)
                own.weights, own.bias = start[0].copy(), start[1].copy()
                own.learn(contexts, runs, words, n)
                total += np.r_[own.weights.ravel(), own.bias] * n.sum()
                mass += n.sum()
            if mass:
                yield _vector(np.r_[total, mass])

        sums = _sum(states.select("rows").mapInArrow(learn, "at int, v double"))
        if len(sums):
            values = np.round(sums[:-1] / sums[-1], 9)
            model.weights = values[: model.weights.size].reshape(model.weights.shape)
            model.bias = values[model.weights.size :]
    last = (model.weights, model.bias)

    def look(batches):
        total = None
        own = Model(sent.value)
        own.weights, own.bias = last
        for contexts, runs, _, n in taught(batches):
            seen = own.seen(contexts, runs, n)
            total = seen if total is None else total + seen
        if total is not None:
            yield _vector(total.ravel())

    sums = _sum(states.select("rows").mapInArrow(look, "at int, v double"))
    if len(sums):
        model.correct(np.round(sums, 3).reshape(2, -1))
    return model, sent


def _vector(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["at", "v"])


def _sum(vectors: DataFrame) -> np.ndarray:
    """Sum of vectors of one fixed length, place by place."""
    rows = vectors.groupBy("at").agg(F.sum("v").alias("v")).toPandas().sort_values("at")
    return rows["v"].to_numpy()


def answers(states: DataFrame, model: Model, cells: Broadcast) -> DataFrame:
    """For each part and bucket the logarithms of the states' probabilities, as they were asked for."""

    def work_out(batches):
        own = Model(cells.value)
        own.weights, own.bias, own.final = model.weights, model.bias, model.final
        own.fixed()
        for batch in batches:
            for bucket, blob, asked in zip(batch.column("bucket").to_pylist(), batch.column("rows"), batch.column("asked"), strict=True):
                runs, words, n = _states(blob)
                bits = own.log2(Contexts(runs, words, n, 0), runs)
                # A zero byte is an end or, with a flag of its own, part of the text.
                bits[(runs & np.uint64(255)) == 0] += math.log2(FLAG)
                # Half precision: a byte's bits are off by a thousandth at most.
                bits = bits.astype(np.float16)
                for one in asked:
                    values = bits[np.cumsum(unpacked(one["index"].as_py(), "<i4")[0])]
                    columns = [[one[c].as_py()] for c in ("p", "j")] + [[bucket], [one["check"].as_py()], [values.tobytes()]]
                    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["p", "j", "bucket", "check", "bits"]
                    )

    return states.select("bucket", "rows", "asked").mapInArrow(work_out, "p int, j int, bucket int, check long, bits binary")


class Answers:
    """What the buckets have answered to the task of one partition, by part."""

    def __init__(self, folder: str, p: int):
        if folder.startswith("file:/") and not folder.startswith("file://"):
            folder = folder.replace("file:/", "file:///", 1)
        system, path = fs.FileSystem.from_uri(f"{folder}/p={p}")
        info = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        files = sorted(f.path for f in info if f.path.endswith(".parquet"))
        self.parts: dict[int, dict[int, tuple[int, bytes]]] = {}
        for file in files:
            with system.open_input_file(file) as stream:
                for row in pq.read_table(stream, columns=["j", "bucket", "check", "bits"]).to_pylist():
                    self.parts.setdefault(row["j"], {})[row["bucket"]] = (row["check"], row["bits"])

    def bits(self, j: int, part: Part, buckets: int) -> np.ndarray:
        """The logarithm of each state of a part, in half precision."""
        out = np.empty(part.used, dtype=np.float16)
        known = self.parts.pop(j, {})
        for bucket, numbers in part.by_bucket(buckets):
            check, values = known.get(bucket, (None, b""))
            if check != part.check(numbers):
                raise RuntimeError("the texts came in other partitions or another order than before: store them first")
            out[numbers] = np.frombuffer(values, dtype=np.float16)
        return out


def _frequent(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The words with the highest counts, by key, as far as the limit allows whole classes of counts."""
    sizes = words.agg(*[F.sum(F.col("sizes")[k]).alias(f"s{k}") for k in range(64)]).first()
    bits, left = 64, FREQUENT
    while bits > 0 and (sizes[bits - 1] or 0) <= left:
        bits -= 1
        left -= sizes[bits] or 0
    least = 1 << bits

    def high(batches):
        for batch in batches:
            for blob in batch.column("rows").to_pylist():
                rows = np.frombuffer(blob, dtype=_COUNTED)
                yield pa.RecordBatch.from_arrays([pa.array([rows[rows["n"] >= least].tobytes()], pa.binary())], ["rows"])

    found = [r["rows"] for r in words.select("rows").mapInArrow(high, "rows binary").collect()]
    rows = np.frombuffer(b"".join(bytes(f) for f in found), dtype=_COUNTED)
    rows = rows[np.argsort(rows["key"])]
    return rows["key"].copy(), rows["n"].copy()


def _placed(words: np.ndarray) -> Places:
    """Where different words stand, for looking them up. What is found is to be compared: 0 has the place of 1."""
    out = Places(2 << len(words).bit_length())
    out.number(np.maximum(words, np.uint64(1)), 0)
    return out


_ASKED = np.dtype([("key", "<u8"), ("row", "<i8"), ("n", "<i4")])


def lm_scores(documents: DataFrame) -> DataFrame:
    """Scores of all documents by the mixed model and by word frequencies.

    Texts whose id has a crc32 of 1 modulo 5 are held out; the others are learned from. A null
    id is learned from, a null text is empty. ``base_score`` and ``score`` are decimal logarithms
    of probabilities, of the words with an end, and of the text, lower-cased, with its
    end; ``bits`` is the latter in bits and ``bits_per_byte`` divides by bytes and end.
    Repeated rows are scored alike. Without training texts all bits are even. Other columns are not read.
    ``documents`` is read twice and should be a stored table: rows that come in another order the second time raise.
    """
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text")
    )
    octets = F.octet_length("text")
    size = texts.agg(F.sum(F.when(~F.col("held_out"), octets)), F.count_if(~F.col("held_out")), F.sum(octets)).first()
    ends = int(size[1])
    buckets = max(1, round(int(size[0] or 0) / 24 / BUCKET))
    asks = max(1, round(int(size[2] or 0) / 10 / ASKS))
    counts = stored(corpus_counts(texts, asks, buckets))
    words, states = counts.filter(F.col("kind") == WORDS), counts.filter(F.col("kind") == STATES)
    known = words.agg(F.sum("total"), F.sum("distinct")).first()
    tokens, distinct = int(known[0] or 0) + ends, int(known[1] or 0) + (ends > 0)
    below = tokens + 0.5 * (distinct + 1)
    context = documents.sparkSession.sparkContext
    model, cells = fit(states)
    folder = shared_folder(documents.sparkSession) + "/answers"
    answers(states, model, cells).repartition("p").write.partitionBy("p").parquet(folder)
    cells.destroy()
    folder = qualified(documents.sparkSession, folder)
    frequent = context.broadcast(_frequent(words))
    end_score = math.log10((ends + 0.5) / below)

    def rate(batches):
        p = TaskContext.get().partitionId()
        told, at = Answers(folder, p), p << 33
        top, top_n = frequent.value
        top_score, among = np.log10((top_n + 0.5) / below), _placed(top)
        for j, (part, found) in enumerate(in_parts(batches, True)):
            bits = told.bits(j, part, asks)
            for batch, a, b, data, borders, numbers, first in found:
                rows = at + np.arange(b - a)
                at += b - a
                each = np.add.reduceat(bits[numbers].astype(np.float64), first) - math.log2(FLAG) + math.log2(1 - FLAG)
                h, bounds = _word_hashes(data, borders)
                word, different = pd.factorize(h)
                place = np.maximum(among.find(np.maximum(different, np.uint64(1))), 0)
                hit = top[place] == different if len(top) else np.zeros(len(different), dtype=bool)
                worth = np.where(hit, top_score[place], 0.0) if len(top) else np.zeros(len(different))
                hit, value = hit[word], np.r_[0.0, np.cumsum(worth[word])]
                seen = np.r_[0, np.cumsum(hit)]
                text = np.repeat(np.arange(b - a), np.diff(bounds))[~hit]
                asked = np.empty(len(text), dtype=_ASKED)
                asked["key"], asked["row"], asked["n"] = h[~hit], rows[text], 1
                place = ((mix(asked["key"]) >> np.uint64(16)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(place, kind="stable")
                asked, place = asked[order], place[order]
                different, start = np.unique(place, return_index=True)
                cuts = [*start.tolist(), len(asked)]
                n = b - a
                yield _scored(
                    n,
                    len(different),
                    row=rows,
                    doc_id=batch.column("doc_id").slice(a, n),
                    held_out=batch.column("held_out").slice(a, n),
                    n_tokens=np.diff(bounds) + 1,
                    n_known=seen[bounds[1:]] - seen[bounds[:-1]] + (ends > 0),
                    base=value[bounds[1:]] - value[bounds[:-1]] + end_score,
                    bits=each,
                    size=np.diff(borders) + 1,
                    bucket=different,
                    asked=[asked[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)],
                )

    return _finished(stored(texts.mapInArrow(rate, SCORED)), words, tokens, below)


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, bits double, size long, "
    "bucket int, asked binary"
)


def _scored(n: int, m: int, **columns) -> pa.RecordBatch:
    """Rows of texts, then rows of words whose counts are asked for."""
    arrays, names = [], []
    for name, kind in (part.split(" ") for part in SCORED.split(", ")):
        kind = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary()}[kind]
        own = name in ("bucket", "asked")
        values = columns[name]
        values = values if isinstance(values, pa.Array) else pa.array(values, kind)
        gap = pa.nulls(n if own else m, kind)
        arrays.append(pa.concat_arrays([gap, values.cast(kind)] if own else [values.cast(kind), gap]))
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names)


def _finished(first: DataFrame, words: DataFrame, tokens: int, below: float) -> DataFrame:
    """Add what the less frequent words are worth, which their buckets know."""

    def answer(batches):
        counts = None
        now = None
        for batch in batches:
            for bucket, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "rows")), strict=True):
                if bucket != now:
                    now, counts = bucket, np.zeros(0, dtype=_COUNTED)
                if kind == 0:
                    counts = np.frombuffer(blob, dtype=_COUNTED)
                    continue
                asked = np.frombuffer(blob, dtype=_ASKED)
                n = np.zeros(len(asked), dtype=np.int64)
                if len(counts):
                    at = np.minimum(np.searchsorted(counts["key"], asked["key"]), len(counts) - 1)
                    n = np.where(counts["key"][at] == asked["key"], counts["n"][at], 0)
                codes, rows = pd.factorize(asked["row"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.asarray(rows, dtype=np.int64)),
                        pa.array(np.bincount(codes, weights=np.log10((n + 0.5) / below), minlength=len(rows))),
                        pa.array(np.bincount(codes, weights=n > 0, minlength=len(rows)).astype(np.int64)),
                    ],
                    ["row", "more", "known"],
                )

    # The counts of a bucket come first and are held; questions pass by one after the other.
    asked = first.filter("asked is not null").select("bucket", F.lit(1).alias("kind"), F.col("asked").alias("rows"))
    given = words.select("bucket", F.lit(0).alias("kind"), "rows")
    both = given.unionByName(asked).repartition(F.col("bucket")).sortWithinPartitions("bucket", "kind")
    more = both.mapInArrow(answer, "row long, more double, known long")
    more = more.groupBy("row").agg(F.sum("more").alias("more"), F.sum("known").alias("known"))
    texts = first.filter("row is not null").drop("bucket", "asked").join(more, "row", "left")
    return texts.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("bits") * math.log10(2)).alias("score"),
        (-F.col("bits")).alias("bits"),
        (-F.col("bits") / F.col("size")).alias("bits_per_byte"),
    )
