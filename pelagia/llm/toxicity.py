"""Toxicity of texts whose words may be disguised.

The text is seen as the output of a noisy channel that writes letters as look-alike digits
and signs, puts signs or spaces between letters, and repeats letters. For every token that
may have passed such a channel there is a lattice: at each place the letters that may
have been meant, with what the channel asks for them. The best path under a
character language model (trigrams counted over all texts) is found by Viterbi's method and
put in the place of the token. The restored text is scored by a logistic model over the
words and word beginnings that tell labelled texts apart.

Tokens of letters of which no two equal ones stand together have one path, themselves, and are not decoded. Of each text only
its own bytes are used: neither label, language, source nor id is an input of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.names import ddl, free, others
from pelagia.llm.storage import stored
from pelagia.llm.textbytes import LOWER, SPACE, pieces, range_hashes, word_bounds

# The model is fitted on at most so many labelled rows, taken by a hash of their ids.
LABELLED = 40_000
# Features of the model, and in how many of these rows one has to be.
FEATURES = 2048
LEAST_ROWS = 5
# Features with less evidence (half the likelihood ratio) are left out.
LEAST_GAIN = 3.0
# Word beginnings of these lengths in bytes are features beside whole words.
BEGINNINGS = (3, 4, 5, 6, 7, 8)

# Signs written in place of letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = ".-_*~'`/\\,:;^=#%&"
# Log probabilities of the channel.
SWAP, DROP, KEEP, AGAIN, GAP = math.log(0.1), math.log(0.1), math.log(0.5), math.log(0.3), math.log(0.02)
# A letter that stands twice is mostly meant so.
TWICE = math.log(0.01)

# Classes of bytes in the language model: white space, 26 letters, digits, signs, and
# eight classes of bytes beyond ASCII.
CLASSES = 37
_CLASS = np.full(256, 28, dtype=np.int64)
_CLASS[SPACE] = 0
_CLASS[97:123] = np.arange(1, 27)
_CLASS[48:58] = 27
_CLASS[128:] = 29 + (np.arange(128, 256) & 7)

# Characters that are decoded as one lattice, and decoded tokens that a task remembers.
LONGEST = 512
REMEMBERED = 100_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_SWAPPED = np.zeros(256, dtype=bool)
_SWAPPED[[ord(c) for c in LOOK_ALIKES if ord(c) < 128]] = True
_PARTED = np.zeros(256, dtype=bool)
_PARTED[[ord(c) for c in SEPARATORS]] = True
# A swap beside a letter, letters or swaps parted by signs, or a letter twice.
_SWAPS = re.escape("".join(LOOK_ALIKES))
_DISGUISED = re.compile(
    rf"[^\W\d_][{_SWAPS}]|[{_SWAPS}][^\W\d_]|(?:[^\W\d_]|[{_SWAPS}])[{re.escape(SEPARATORS)}]+(?:[^\W\d_]|[{_SWAPS}])|([^\W\d_])\1"
)


def trigram_counts(texts: DataFrame) -> np.ndarray:
    """Counts of class triples over all bytes of all texts, each between two spaces."""

    def count(batches):
        total = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in batches:
            for _, _, data, ends in pieces(batch.column(0)):
                c = np.insert(_CLASS[LOWER[data]], ends, 0)
                if len(c) > 2:
                    total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    found = texts.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # At most 37 to the power of three rows.
    rows = found.toPandas()
    out = np.zeros(CLASSES**3)
    out[rows["cell"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    return out.reshape(CLASSES, CLASSES, CLASSES)


def language_model(counts: np.ndarray) -> list:
    """Log probability of a class after two others, mixed with shorter contexts."""
    two, one = counts.sum(axis=0), counts.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 4 * p1) / (two.sum(axis=1, keepdims=True) + 4)
    p3 = (counts + 4 * p2[None]) / (counts.sum(axis=2, keepdims=True) + 4)
    return np.log(p3).tolist()


def _class_of(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    if c in "0123456789":
        return 27
    if c.isspace():
        return 0
    return 28 if ord(c) < 128 else 29 + (c.encode()[0] & 7)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """At each place what may have been meant, "" for nothing, and the channel's log probability."""
    places = []
    for i, c in enumerate(token):
        same = c.isalpha() and token[i - 1 : i] == c
        more = same and 3 * c in token[max(0, i - 2) : i + 3]
        here = [(c, KEEP if more else 0.0)]
        if c in LOOK_ALIKES:
            # One of ten digits, or of some twenty signs, is less likely than its class.
            here = [(c, math.log(0.1 if c.isdigit() else 0.05))]
            here += [(x, SWAP) for x in LOOK_ALIKES[c]]
        elif c.isspace() or c in SEPARATORS:
            here = [(c, GAP if c.isspace() else math.log(0.05)), ("", DROP)]
        if same:
            here.append(("", AGAIN if more else TWICE))
        places.append(here)
    return places


def decode(token: str, model: list) -> str:
    """The most likely meaning of a token or a run of single letters."""
    # A state is the last two classes; it holds the score and the way there.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for here in lattice(token):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (x, y), (score, way) in states.items():
            for meant, cost in here:
                if meant:
                    z = _class_of(meant)
                    key, value = (y, z), score + cost + model[x][y][z]
                    step = (meant, way)
                else:
                    key, value, step = (x, y), score + cost, way
                if key not in after or value > after[key][0]:
                    after[key] = (value, step)
        states = after
    _, way = max(((s + model[x][y][0], w) for (x, y), (s, w) in states.items()), key=lambda v: v[0])
    out = []
    while way:
        out.append(way[0])
        way = way[1]
    return "".join(reversed(out))


def _suspects(data: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of tokens that may be disguised, and of runs of three single letters, swaps among them, or more.

    ``data`` is lower-cased. What is found here is looked at again as text.
    """
    starts, stops = word_bounds(data, ends)
    letter = _LETTER[data]
    # Letters twice in a row, swaps beside a letter, signs before a letter or a swap.
    swap = _SWAPPED[data]
    # The swaps of more than one byte, by their last two.
    swap[1:] |= ((data[:-1] == 0xC2) & (data[1:] == 0xA3)) | ((data[:-1] == 0x82) & (data[1:] == 0xAC))
    odd = swap & (data >= 128)
    odd[1:] |= letter[1:] & (data[1:] == data[:-1])
    odd[1:] |= (swap[1:] & letter[:-1]) | (letter[1:] & swap[:-1])
    odd[1:] |= (letter[1:] | swap[1:]) & _PARTED[data[:-1]]
    marks = np.r_[0, np.cumsum(odd)]
    letters = np.r_[0, np.cumsum(letter)]
    found = (marks[stops] > marks[starts]) & (letters[stops] > letters[starts])
    at = np.flatnonzero(found)
    ranges = list(zip(starts[at].tolist(), stops[at].tolist(), strict=True))
    # One letter or swap, of one byte or two, or three for the euro sign.
    length = stops - starts
    single = ((length == 1) & (letter[starts] | swap[starts])) | ((length == 2) & (data[starts] >= 0xC2))
    single |= (length == 3) & (data[starts] == 0xE2) & swap[stops - 1]
    text = np.searchsorted(ends, starts, side="right")
    joined = single[1:] & single[:-1] & (text[1:] == text[:-1])
    if joined.any():
        edge = np.diff(np.r_[False, joined, False].astype(np.int8))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if b - a >= 2 and letters[stops[b]] > letters[starts[a]]:
                ranges.append((int(starts[a]), int(stops[b])))
    ranges.sort()
    return ranges


def restored(data: np.ndarray, ends: np.ndarray, model: list, known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased texts with disguised tokens replaced, offsets, and tokens replaced in each."""
    data = LOWER[data]
    raw = data.tobytes()
    shift = np.zeros(len(ends), dtype=np.int64)
    changed = np.zeros(len(ends) - 1, dtype=np.int64)
    parts, at = [], 0
    for a, b in _suspects(data, ends):
        if a < at:
            continue
        token = raw[a:b]
        meant = known.get(token)
        if meant is None:
            text = token.decode("utf-8", "replace")
            spaced = any(c.isspace() for c in text)
            disguised = spaced or _DISGUISED.search(text)
            # The lattice of a very long run is cut at fixed places.
            cuts = range(0, len(text), LONGEST)
            meant = "".join(decode(text[k : k + LONGEST], model) for k in cuts).encode() if disguised else token
            if len(text) <= LONGEST:
                if len(known) > REMEMBERED:
                    known.clear()
                known[token] = meant
        if meant != token:
            parts += [raw[at:a], meant]
            at = b
            text_no = int(np.searchsorted(ends, a, side="right"))
            shift[text_no:] += len(meant) - (b - a)
            changed[text_no - 1] += 1
    if not parts:
        return data, ends, changed
    parts.append(raw[at:])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), ends + shift, changed


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word of letters and of its beginnings."""
    inside = _LETTER[data]
    gaps = np.where(inside, data, 32).astype(np.uint8)
    starts, stops = word_bounds(gaps, ends)
    text = np.searchsorted(ends, starts, side="right") - 1
    rows, hashes = [text], [range_hashes(data, starts, stops)]
    for k in BEGINNINGS:
        longer = stops - starts > k
        rows.append(text[longer])
        hashes.append(range_hashes(data, starts[longer], starts[longer] + k) + np.uint64(k))
    return np.concatenate(rows), np.concatenate(hashes)


def _restored_pieces(column: pa.Array, model: list, known: dict) -> Iterator[tuple[int, np.ndarray, ...]]:
    for first, _, data, ends in pieces(column):
        yield first, *restored(data, ends, model, known)


class ToxicityModel:
    """Language model, feature hashes in order, their weights, and the intercept."""

    def __init__(self, chars: list, hashes: np.ndarray, weights: np.ndarray, intercept: float):
        self.chars, self.hashes, self.weights, self.intercept = chars, hashes, weights, intercept

    def hits(self, column: pa.Array, known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row and feature of each feature that a text has, once; tokens replaced by row."""
        # Most hashes are none of the model's; a table of marks rules them out.
        marks = np.zeros(1 << 18, dtype=bool)
        marks[(self.hashes >> np.uint64(46)).astype(np.int64)] = True
        rows, found, changed = [], [], []
        for first, data, ends, replaced in _restored_pieces(column, self.chars, known):
            row, h = features(data, ends)
            maybe = marks[(h >> np.uint64(46)).astype(np.int64)]
            row, h = row[maybe] + first, h[maybe]
            at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
            hit = self.hashes[at] == h if len(self.hashes) else np.zeros(0, dtype=bool)
            both = np.unique(row[hit] * len(self.hashes) + at[hit])
            rows.append(both // max(1, len(self.hashes)))
            found.append(both % max(1, len(self.hashes)))
            changed.append(replaced)
        if not rows:
            return (np.zeros(0, dtype=np.int64),) * 3
        return np.concatenate(rows), np.concatenate(found), np.concatenate(changed)


def _fit(rows: np.ndarray, found: np.ndarray, label: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse ones, by steps with a running scale for each weight."""
    w, b = np.zeros(width), 0.0
    gw, gb = np.full(width, 1e-8), 1e-8
    n = max(1, len(label))
    for _ in range(800):
        z = b + np.bincount(rows, weights=w[found], minlength=len(label))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
        dw = np.bincount(found, weights=error[rows], minlength=width) / n + 1e-4 * w
        db = error.sum() / n
        gw += dw * dw
        gb += db * db
        w -= 0.5 * dw / np.sqrt(gw)
        b -= 0.5 * db / math.sqrt(gb)
    return w, float(b)


def _split(df: DataFrame):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)), F.lit(0))


def fit(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> ToxicityModel:
    """Count the language model over all texts and fit the weights on labelled rows.

    Only labels of rows whose crc32 of the id modulo 5 is not 0 are read, at most
    ``labelled`` of them. Rows with a null label or id teach nothing; of several labels of
    one id the largest counts, and of several texts the least.
    """
    chars = language_model(trigram_counts(documents))
    known_labels = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(_split(labels) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id")
        .limit(labelled)
    )
    sent = documents.sparkSession.sparkContext.broadcast(chars)
    # One row for each id, so that there are no more than labels.
    own = documents.select("doc_id", "text").join(F.broadcast(known_labels), "doc_id").groupBy("doc_id", "toxic")
    rows = stored(own.agg(F.min("text").alias("text")).select("text", "toxic"))

    def count(batches):
        known: dict = {}
        for batch in batches:
            toxic = batch.column("toxic").to_numpy() > 0
            for first, data, ends, _ in _restored_pieces(batch.column("text"), sent.value, known):
                row, h = features(data, ends)
                pair = np.unique(np.stack([h, row.astype(np.uint64)], axis=1), axis=0) if len(h) else None
                if pair is None:
                    continue
                bad = toxic[first + pair[:, 1].astype(np.int64)]
                values, start = np.unique(pair[:, 0], return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values.view(np.int64)),
                        pa.array(np.diff(np.r_[start, len(pair)])),
                        pa.array(np.add.reduceat(bad.astype(np.int64), start)),
                    ],
                    ["h", "n", "bad"],
                )

    share = known_labels.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    counted = rows.mapInArrow(count, "h long, n long, bad long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    p = (F.col("bad") + 0.5) / (F.col("n") + 1)
    gain = F.col("bad") * F.log(p / (share + 1e-9)) + (F.col("n") - F.col("bad")) * F.log((1 - p) / (1 - share + 1e-9))
    clear = counted.filter((F.col("n") >= LEAST_ROWS) & (gain > LEAST_GAIN))
    best = clear.orderBy(gain.desc(), "h").limit(FEATURES).select("h").toPandas()
    hashes = np.sort(best["h"].to_numpy(dtype=np.int64).view(np.uint64))
    model = ToxicityModel(chars, hashes, np.zeros(len(hashes)), 0.0)
    sent_model = documents.sparkSession.sparkContext.broadcast(model)

    def find(batches):
        known: dict = {}
        for batch in batches:
            row, found, _ = sent_model.value.hits(batch.column("text"), known)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), lists], ["toxic", "found"])

    # At most ``labelled`` rows with the features that each has.
    taught = rows.mapInArrow(find, "toxic int, found array<int>").toPandas()
    lists = [np.asarray(x, dtype=np.int64) for x in taught["found"]]
    label = (taught["toxic"].to_numpy() > 0).astype(np.float64)
    at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    model.weights, model.intercept = _fit(at, np.concatenate([np.zeros(0, dtype=np.int64), *lists]), label, len(hashes))
    return model


MADE = ("tox_score", "tox_predicted", "tox_restored")


def score(documents: DataFrame, model: ToxicityModel, made: Sequence[str] = MADE) -> DataFrame:
    """All columns of the documents and ``tox_score``, ``tox_predicted``, ``tox_restored``.

    The score lies between 0 and 1 and is predicted 1 from 0.5 on; ``tox_restored`` counts the
    tokens that were read otherwise than written. A null text is scored as an empty one, repeated rows
    alike. ``made`` gives the new columns other names; a column that has one of them gives way.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    names = others(documents, made)
    new = ", ".join(f"`{n}` {t}" for n, t in zip(made, ("double", "int", "long"), strict=True))

    def rate(batches):
        known: dict = {}
        for batch in batches:
            m = sent.value
            row, found, changed = m.hits(batch.column("text"), known)
            z = m.intercept + np.bincount(row, weights=m.weights[found], minlength=batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(changed)],
                [*names, *made],
            )

    return documents.mapInArrow(rate, ddl(documents, names) + new)


def restore_texts(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """All columns and ``restored``, the lower-cased text as it was decoded; null stays null.

    A column of that name gives way.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model.chars)
    names = others(documents, ["restored"])

    def restore(batches):
        known: dict = {}
        for batch in batches:
            out = []
            for _, data, ends, _ in _restored_pieces(batch.column("text"), sent.value, known):
                raw = data.tobytes()
                out += [raw[a:b].decode() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            out = [None if t is None else x for t, x in zip(batch.column("text").to_pylist(), out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(out, pa.string())], [*names, "restored"]
            )

    return documents.mapInArrow(restore, ddl(documents, names) + "restored string")


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Id, whether the id is held out of learning, score and prediction of every document.

    A null id counts as held out. Repeated rows are scored alike.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = score(rows, fit(rows, labels))
    return out.select(
        "doc_id",
        (_split(out) == 0).alias("held_out"),
        F.col("tox_score").alias("score"),
        F.col("tox_predicted").alias("predicted"),
        F.col("tox_restored").alias("restored_tokens"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose prediction is 0, with their columns, whatever these are called.

    Null and empty texts are scored like others, and repeated rows alike. Where no label teaches anything all
    documents have one score.
    """
    names = documents.columns
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = free(names, *MADE)
    return score(documents, fit(texts, labels), made).filter(F.col(made[1]) == 0).select(*names)
