"""Texts of an Arrow column as one byte array, and their words, with numpy.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Only the letters A to Z are lower-cased, so that all work is
done on UTF-8 bytes. Words and word sequences are named by 64-bit hashes: blocks of eight bytes go one after
another through a one-to-one scramble that is not linear, so that no arrangement of the same letters
cancels out; long words go through BLAKE2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are handled in pieces of about so many bytes; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), ends - ends[:1]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: first row, row after the last, bytes, offsets."""
    data, ends = flat(column)
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + size, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _powers[:] = [_power_table(_BASE, size), _power_table(pow(_BASE, -1, 1 << 64), size)]
    return _powers[0][:n], _powers[1][:n]


def _power_table(base: int, size: int) -> np.ndarray:
    table = np.full(size, base, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def word_bounds(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; words do not cross the borders of texts."""
    inside = ~SPACE[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[ends] = True
    before = np.empty(len(data) + 1, dtype=bool)
    before[0], before[1:] = False, inside
    before[border] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.empty(len(data) + 1, dtype=bool)
    after[-1], after[:-1] = False, inside
    after[border] = False
    return starts, np.flatnonzero(inside & ~after[1:]) + 1


def range_numbers(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A number for each byte range, by a polynomial; its lower bits depend on few of the bytes' bits.

    Different ranges may well have one number: it picks places in tables and tells nothing apart.
    """
    power, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= power[: len(data)]
    np.cumsum(terms, out=total[1:])
    h = total[stops]
    h -= total[starts]
    h *= inverse[starts]
    return h


# Words of more bytes are hashed one by one.
LONG_WORD = 512
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def range_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range; another seed gives hashes that have nothing to do with the first."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    # The eight bytes from every place on.
    blocks = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = stops - starts
    h = mix(length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(seed * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1))
    left = np.flatnonzero(length <= LONG_WORD)
    at, rest = starts[left], length[left]
    on = rest > 0
    while on.any():
        left, at, rest = left[on], at[on], rest[on]
        block = blocks[at] & _KEEP[np.minimum(rest, 8)]
        h[left] = mix(h[left] ^ block)
        at, rest = at + 8, rest - 8
        on = rest > 0
    for k in np.flatnonzero(length > LONG_WORD).tolist():
        own = data[starts[k] : stops[k]].tobytes()
        digest = hashlib.blake2b(own, digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        h[k] = int.from_bytes(digest, "little")
    return h


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts and ends, word hashes, and where each text's words begin."""
    data = LOWER[data]
    starts, stops = word_bounds(data, ends)
    return data, starts, stops, range_hashes(data, starts, stops), np.searchsorted(starts, ends)


def sequence_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` hashes from each place on; short by ``width - 1`` places."""
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + hashes[i : i + n]
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text; fewer words are one shingle, none is none."""
    *_, hashes, first = words(data, ends)
    every = sequence_hashes(hashes, width)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(every[a : b - width + 1])
        elif b > a:
            yield sequence_hashes(hashes[a:b], int(b - a))
        else:
            yield every[:0]


class Places:
    """Numbers by 64-bit key, looked up and entered for whole arrays at once. Keys are hashes, and none is 0."""

    def __init__(self, size: int):
        self.keys, self.numbers = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int32)
        self.mask = np.uint64(size - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left, at = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(left):
            there = self.keys[at]
            hit = there == keys[left]
            out[left[hit]] = self.numbers[at[hit]]
            on = ~hit & (there != 0)
            left, at = left[on], (at[on] + 1) & int(self.mask)
        return out

    def number(self, keys: np.ndarray, used: int) -> tuple[np.ndarray, np.ndarray]:
        """The number of each of different keys, and which are new: these get the numbers from ``used`` on, as they come."""
        slot, new = (keys & self.mask).astype(np.int64), np.zeros(len(keys), dtype=bool)
        left, at = np.arange(len(keys)), slot
        while len(left):
            there = self.keys[at]
            free = np.flatnonzero(there == 0)
            own, place = keys[left[free]], at[free]
            self.keys[place] = own
            won = self.keys[place] == own
            new[left[free[won]]] = True
            there[free[won]] = own[won]
            on = np.flatnonzero(there != keys[left])
            left, at = left[on], (at[on] + 1) & int(self.mask)
            slot[left] = at
        new = np.flatnonzero(new)
        self.numbers[slot[new]] = np.arange(used, used + len(new), dtype=np.int32)
        return self.numbers[slot], new

    def enter(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Enter different keys that are not there; the places must be at most half full."""
        left, at = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[left[free]]
            won = free & (self.keys[at] == keys[left])
            self.numbers[at[won]] = numbers[left[won]]
            left, at = left[~won], (at[~won] + 1) & int(self.mask)
