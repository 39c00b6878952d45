"""Packing of documents into training sequences, in their order, by dynamic programming.

The documents of a task follow each other as one stream of token ids. Where the stream is cut
into sequences is chosen so that padding and penalties for cut documents are least: a cut
at the end of a document is free, one at the end of a sentence costs a little, and one
inside a sentence (offered only where a sentence is long) costs more. With positions t and
least costs f, f(i) = penalty(i) + width - t(i) + min(f(j) + t(j)) over the places j within the width
before i. The minimum slides, and a queue whose values rise keeps it, so that each place is
handled in constant time. A sequence whose length is a power of two needs no padding; places j
at a half and a quarter of the width are looked up besides.

The stream is packed in bounded stretches: the last sequences of a stretch are taken back and
packed again with what follows. Nothing is shuffled; what a task packs depends on its rows
and their order only. At the end of a stream the rest is cut at powers of two if that
costs less than its padding.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.textbytes import LOWER, Places, pieces, range_hashes, word_bounds

WIDTH = 2048
SENTENCE, INSIDE = 4, 64
# A stretch without the end of a sentence is offered a cut after so many tokens.
LONG = 256
END = 1
# Words whose ids a task remembers, and places for them.
REMEMBERED = 1 << 19
PLACES = 1 << 20
# Texts are taken in pieces of so many bytes.
STRETCH_BYTES = 1 << 20


_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[33:127] = True
_SIGN[48:58] = _SIGN[65:91] = _SIGN[97:123] = _SIGN[ord("'")] = False


class WordTokens:
    """Ids of texts, by parts that this kind of tokenizer never joins.

    It lower-cases, drops white space, and has no token of both a letter and a sign unless an
    apostrophe stands between. Texts are cut at ASCII white space and between ASCII letters and signs
    (not where a special token may be written out), and each different part is encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        found = self.tokenizer.get_vocab()
        ends = [i for w, i in found.items() if w.endswith("</w>") and w != "</w>" and set(w[:-4]) <= set(".!?")]
        self.sentence = np.zeros(max(found.values()) + 1, dtype=bool)
        self.sentence[ends] = True
        # A special token stands between parts that are encoded together.
        special = sorted((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special)
        self.between = special[0] if special else None
        self._forget()

    def _forget(self) -> None:
        self.known = Places(PLACES)
        self.store = np.zeros(1 << 20, dtype=np.uint32)
        self.start = np.zeros(REMEMBERED + 1, dtype=np.int64)
        self.second = np.zeros(REMEMBERED, dtype=np.uint64)
        self.count = self.used = 0

    def _encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, and how many each has."""
        if self.between and not any(b"<" in p for p in parts):
            number, mark = self.between
            rows = [mark.encode().join(parts[k : k + 512]).decode() for k in range(0, len(parts), 512)]
            every = [e.ids + [number] for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]
            flat = np.fromiter((i for ids in every for i in ids), dtype=np.uint32, count=sum(map(len, every)))
            stops = np.flatnonzero(flat == number)
            return flat[flat != number], np.diff(np.r_[-1, stops]) - 1
        found = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter((i for ids in found for i in ids), dtype=np.uint32, count=int(lengths.sum())), lengths

    def _learn(self, keys: np.ndarray, second: np.ndarray, parts: list[bytes]) -> np.ndarray:
        flat, lengths = self._encode(parts)
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[self.used : self.used + len(flat)] = flat
        numbers = np.arange(self.count, self.count + len(parts))
        self.start[numbers + 1] = self.used + np.cumsum(lengths)
        self.used, self.count = self.used + len(flat), self.count + len(parts)
        self.second[numbers] = second
        self.known.enter(keys, numbers.astype(np.int32))
        return numbers

    @staticmethod
    def _second(low: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """What besides its hash names a part: its length, which is enough up to eight bytes, or another hash."""
        out = (stops - starts).astype(np.uint64)
        longer = np.flatnonzero(stops - starts > 8)
        out[longer] = range_hashes(low, starts[longer], stops[longer], 1)
        return out

    def ids(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id after it, and the number of each text."""
        raw = data.tobytes()
        cut = b"<|" not in raw
        # A special token counts as one only in its own case.
        low = LOWER[data] if cut else data
        starts, stops = word_bounds(low, ends)
        if cut and len(low) > 1:
            letter, sign = _LETTER[low], _SIGN[low]
            change = np.flatnonzero((letter[1:] & sign[:-1]) | (letter[:-1] & sign[1:])) + 1
            change = change[~np.isin(change, ends)] if len(ends) < len(change) else np.setdiff1d(change, ends)
            starts, stops = np.sort(np.r_[starts, change]), np.sort(np.r_[stops, change])
        hashes, second = range_hashes(low, starts, stops), self._second(low, starts, stops)
        hashes[hashes == 0] = 1
        codes, different = pd.factorize(hashes)
        if self.count + len(different) > REMEMBERED:
            self._forget()
        if len(different) > REMEMBERED:
            # One long text with very many different parts: each is encoded as it comes.
            return self._as_they_come(low, starts, stops, ends)
        at = self.known.find(np.asarray(different, dtype=np.uint64))
        new = np.flatnonzero(at < 0)
        text = low.tobytes()
        if len(new):
            place = np.empty(len(different), dtype=np.int64)
            place[codes] = np.arange(len(codes))
            place = place[new]
            bounds = zip(starts[place].tolist(), stops[place].tolist(), strict=True)
            at[new] = self._learn(different[new], second[place], [text[a:b] for a, b in bounds])
        word = at[codes]
        begin, length, store = self.start[word], self.start[word + 1] - self.start[word], self.store
        other = np.flatnonzero(self.second[word] != second)
        if len(other):
            # Parts that share the hash of another one are encoded for themselves.
            flat, own = self._encode([text[a:b] for a, b in zip(starts[other].tolist(), stops[other].tolist(), strict=True)])
            store = np.concatenate([store[: self.used], flat])
            begin[other], length[other] = self.used + np.cumsum(own) - own, own
        return self._together(store, begin, length, np.searchsorted(starts, ends))

    def _as_they_come(
        self, low: np.ndarray, starts: np.ndarray, stops: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        text, found, lengths = low.tobytes(), [], []
        for at in range(0, len(starts), 1 << 16):
            bounds = zip(starts[at : at + (1 << 16)].tolist(), stops[at : at + (1 << 16)].tolist(), strict=True)
            flat, own = self._encode([text[a:b] for a, b in bounds])
            found.append(flat)
            lengths.append(own)
        length = np.concatenate(lengths)
        return self._together(np.concatenate(found), np.cumsum(length) - length, length, np.searchsorted(starts, ends))

    @staticmethod
    def _together(
        store: np.ndarray, begin: np.ndarray, length: np.ndarray, bounds: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in their order, with the end id after those of each text."""
        total = np.r_[0, np.cumsum(length)]
        counts = total[bounds[1:]] - total[bounds[:-1]] + 1
        # Room for one end id after the words of each text.
        out = np.full(int(total[-1]) + len(counts), END, dtype=np.uint32)
        own = np.ones(len(out), dtype=bool)
        own[np.cumsum(counts) - 1] = False
        out[own] = store[np.repeat(begin - total[:-1], length) + np.arange(int(total[-1]))]
        return out, counts


def best_cuts(t: np.ndarray, penalty: np.ndarray, width: int) -> list[int]:
    """Indices of the places where sequences end; ``t`` rises from 0, no step above the width."""
    n = len(t)
    # Pairs of places whose distance needs no padding.
    extra: dict[int, list[int]] = {}
    step = width // 4
    while step < width:
        j = np.searchsorted(t, t - step)
        hit = np.flatnonzero((t >= step) & (t[j] == t - step))
        for i, k in zip(hit.tolist(), j[hit].tolist(), strict=True):
            extra.setdefault(i, []).append(k)
        step *= 2
    places, costs = t.tolist(), penalty.tolist()
    f, way = [0] * n, [0] * n
    queue, head = [0], 0
    key = [0] * n
    for i in range(1, n):
        ti = places[i]
        low = ti - width
        while places[queue[head]] < low:
            head += 1
        j = queue[head]
        best = key[j] + width - ti
        if i in extra:
            for k in extra[i]:
                if f[k] < best:
                    best, j = f[k], k
        best += costs[i]
        f[i], way[i] = best, j
        own = key[i] = best + ti
        while len(queue) > head and key[queue[-1]] >= own:
            queue.pop()
        queue.append(i)
    out, i = [], n - 1
    while i > 0:
        out.append(i)
        i = way[i]
    return out[::-1]


def places_to_cut(ids: np.ndarray, doc_ends: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a stream may be cut, from 0 to its end, and what each costs."""
    stops = np.flatnonzero(sentence[ids]) + 1
    t = np.unique(np.r_[0, stops, doc_ends])
    gaps = np.diff(t)
    many = (gaps - 1) // LONG
    if many.any():
        more = np.repeat(t[:-1], many) + LONG * (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + 1)
        t = np.sort(np.r_[t, more])
    penalty = np.full(len(t), INSIDE, dtype=np.int64)
    penalty[np.searchsorted(t, stops)] = SENTENCE
    penalty[np.searchsorted(t, doc_ends)] = 0
    return t, penalty


class Stream:
    """The documents of a task, packed stretch by stretch."""

    def __init__(self, sentence: np.ndarray, width: int, first_sequence: int):
        self.sentence, self.width, self.sequence = sentence, width, first_sequence
        self.ids = np.zeros(0, dtype=np.uint32)
        # Of each document with ids here: row, all its ids, those before this stretch, those in it.
        self.docs = np.zeros((0, 4), dtype=np.int64)

    def add(self, ids: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Take documents in; return what can be packed now, as rows of pieces."""
        self.ids = np.concatenate([self.ids, ids])
        new = np.stack([rows, counts, np.zeros_like(counts), counts], axis=1)
        self.docs = np.concatenate([self.docs, new])
        if len(self.ids) < 16 * self.width:
            return np.zeros((0, 7), dtype=np.int64)
        cuts = self._cuts()
        return self._emit(cuts[:-2] or cuts)

    def end(self) -> np.ndarray:
        if not len(self.ids):
            return np.zeros((0, 7), dtype=np.int64)
        cuts = self._cuts()
        before = cuts[-2] if len(cuts) > 1 else 0
        rest = cuts[-1] - before
        powers = [1 << k for k in range(self.width.bit_length() - 1, -1, -1) if rest >> k & 1]
        if len(powers) > 1 and INSIDE * (len(powers) - 1) < self.width - rest:
            cuts = cuts[:-1] + (before + np.cumsum(powers)).tolist()
        return self._emit(cuts)

    def _cuts(self) -> list[int]:
        t, penalty = places_to_cut(self.ids, np.cumsum(self.docs[:, 3]), self.sentence)
        return t[best_cuts(t, penalty, self.width)].tolist()

    def _emit(self, cuts: list[int]) -> np.ndarray:
        """Pieces up to the last cut: row, start, length, crc, ids of the document, sequence, offset."""
        last = cuts[-1]
        doc_ends = np.cumsum(self.docs[:, 3])
        borders = np.unique(np.r_[0, cuts, doc_ends[doc_ends < last]])
        a, b = borders[:-1], borders[1:]
        doc = np.searchsorted(doc_ends, a, side="right")
        sequence = np.searchsorted(cuts, a, side="right")
        begins = np.r_[0, cuts][sequence]
        raw = self.ids[:last].astype("<u4").tobytes()
        crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        first = doc_ends[doc] - self.docs[doc, 3]
        out = np.stack(
            [
                self.docs[doc, 0],
                self.docs[doc, 2] + a - first,
                b - a,
                np.array(crc, dtype=np.int64),
                self.docs[doc, 1],
                sequence + self.sequence,
                a - begins,
            ],
            axis=1,
        )
        self.sequence += len(cuts)
        self.ids = self.ids[last:]
        left = np.flatnonzero(doc_ends > last)
        self.docs = self.docs[left]
        if len(left):
            gone = last - (doc_ends[left[0]] - self.docs[0, 3])
            if gone > 0:
                self.docs[0, 2] += gone
                self.docs[0, 3] -= gone
        return out


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_tokens: dict[str, WordTokens] = {}


def packed(documents: DataFrame, tokenizer: str, width: int = WIDTH) -> DataFrame:
    """The pieces of all documents with their sequences.

    Every text is turned into ids by the tokenizer at that path (no special tokens) and gets id 1
    after it; a null text has that id alone. A piece is a run of ids of one document in one
    sequence; ``start`` counts the document's ids before it and ``offset`` the ids before it in
    its sequence. The sequence's number holds the number of the task. Null ids and repeated
    rows are packed like others.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def pack(batches):
        if tokenizer not in _tokens:
            _tokens[tokenizer] = WordTokens(tokenizer)
        tokens = _tokens[tokenizer]
        stream = Stream(tokens.sentence, width, TaskContext.get().partitionId() << 40)
        # Ids of the documents that the stream still holds, by the number of their row.
        ids, first = pa.chunked_array([], pa.int64()), 0
        for batch in batches:
            ids = pa.chunked_array([*ids.chunks, batch.column("doc_id")])
            for a, b, data, ends in pieces(batch.column("text"), STRETCH_BYTES):
                flat, counts = tokens.ids(data, ends)
                at = first + len(ids) - batch.num_rows
                out = stream.add(flat, np.arange(at + a, at + b), counts)
                if len(out):
                    yield _listed(out, ids, first)
            if len(stream.docs):
                held = int(stream.docs[0, 0]) - first
                ids, first = ids.slice(held), first + held
            else:
                ids, first = ids.slice(len(ids)), first + len(ids)
        out = stream.end()
        if len(out):
            yield _listed(out, ids, first)

    return rows.mapInArrow(pack, PIECES)


def _listed(out: np.ndarray, ids: pa.ChunkedArray, first: int) -> pa.RecordBatch:
    doc = ids.take(pa.array(out[:, 0] - first)).combine_chunks()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([doc, *(pa.array(out[:, k].copy()) for k in range(1, 7))], names)
