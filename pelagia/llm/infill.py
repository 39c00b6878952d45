"""Fill-in-the-middle forms of texts by rotating blocks of a byte array in place.

A text is cut at the ends of tokens into prefix, middle and suffix. A sentinel is put before each part in
a byte array; the order of the parts is then changed by exchanging neighbouring blocks, each exchange
by three reversals. The way back finds the sentinels, undoes the rotation and takes the
sentinels out, which gives the text exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pelagia.llm.names import batch, ddl, others
from pelagia.llm.textbytes import SPACE, pieces, word_bounds

# Marks before prefix, suffix and middle, and the seed.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
# Of 100 texts so many stay plain, and of 100 others so many put the suffix first.
PLAIN, SUFFIX_FIRST = 50, 80


def exchange(block: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchange the neighbours [start, middle) and [middle, stop) by three reversals."""
    for a, b in ((start, middle), (middle, stop), (start, stop)):
        part = np.frombuffer(block, dtype=np.uint8)[a:b]
        part[:] = part[::-1].copy()


def rotated(raw: bytes, first: int, second: int, form: str) -> bytes:
    """The parts of a text, cut at two places, with their sentinels in the order of the form."""
    block = bytearray(raw)
    block[second:second] = SUFFIX
    block[first:first] = MIDDLE
    block[:0] = PREFIX
    middle = len(PREFIX) + first
    suffix = second + len(PREFIX) + len(MIDDLE)
    # From prefix, middle, suffix: either the last two change places, or the last goes before both.
    exchange(block, middle if form == "psm" else 0, suffix, len(block))
    return bytes(block)


def unrotated(raw: bytes, form: str) -> bytes:
    """The text that ``rotated`` was given."""
    block = bytearray(raw)
    if form == "psm":
        start = block.find(SUFFIX)
        suffix = block.find(MIDDLE, start)
        exchange(block, start, suffix, len(block))
    else:
        exchange(block, 0, block.find(PREFIX), len(block))
    middle = block.find(MIDDLE)
    suffix = block.find(SUFFIX, middle)
    del block[suffix : suffix + len(SUFFIX)]
    del block[middle : middle + len(MIDDLE)]
    del block[: len(PREFIX)]
    return bytes(block)


def _draws(seed: int, doc_id: int | None) -> tuple[int, ...]:
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).digest()
    return tuple(int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4))


def _chars(data: np.ndarray) -> int:
    """Characters of UTF-8 bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


MADE = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


def infilled(
    documents: DataFrame, seed: int = SEED, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """Columns of the documents, and their number of tokens ``n``, ``form``, lengths in characters, ``output``.

    A token is white space with the word that follows, or white space at the end. Prefix and middle end
    after numbers of tokens drawn from the seed and ``doc_id`` (a null id draws like an empty one, rows that
    share an id alike). The form is ``psm`` or ``spm``, or ``plain`` where the draw says so, the text is
    null or empty, or holds one of the sentinels; a plain output is the text (empty for null) and its
    lengths are null. Whole texts of any length are used. Other columns stay as they are; one that is called
    like a new column gives way.
    """
    names = others(documents, list(MADE))
    schema = ddl(documents, names) + ", ".join(f"{n} {t}" for n, t in MADE.items())

    def change(batches):
        for rows in batches:
            ids = rows.column("doc_id").cast(pa.int64()).to_pylist()
            made = {name: [] for name in MADE}
            for first, last, data, ends in pieces(rows.column("text").cast(pa.string())):
                starts, stops = word_bounds(data, ends)
                words = np.searchsorted(starts, ends)
                for k in range(last - first):
                    a, b = int(ends[k]), int(ends[k + 1])
                    own, text = stops[words[k] : words[k + 1]] - a, data[a:b]
                    tail = int(b > a and SPACE[text[-1]])
                    n, raw = len(own) + tail, text.tobytes()
                    h1, h2, h3, h4 = _draws(seed, ids[first + k])
                    stays = not raw or h3 % 100 >= plain or any(s in raw for s in (PREFIX, SUFFIX, MIDDLE))
                    form = "plain" if stays else "spm" if h4 % 100 < suffix_first else "psm"
                    lengths = (None, None)
                    if form != "plain":
                        x, y = (_end(own, c, len(raw)) for c in sorted((h1 % (n + 1), h2 % (n + 1))))
                        lengths = (_chars(text[:x]), _chars(text[x:y]))
                        raw = rotated(raw, x, y, form)
                    for name, value in zip(MADE, (n, form, *lengths, raw.decode()), strict=True):
                        made[name].append(value)
            kinds = {"long": pa.int64(), "string": pa.string()}
            yield batch(
                {c: rows.column(c) for c in names} | {c: pa.array(made[c], kinds[t]) for c, t in MADE.items()}
            )

    return documents.mapInArrow(change, schema)


def _end(stops: np.ndarray, tokens: int, size: int) -> int:
    """Where so many tokens end: at the end of a word, or of the text after the white space there."""
    return 0 if not tokens else int(stops[tokens - 1]) if tokens <= len(stops) else size


def restored(rows: DataFrame) -> DataFrame:
    """All columns and ``restored``, the exact text, from ``output`` and ``form`` alone; null outputs stay null."""
    names = others(rows, ["restored"])

    def back(batches):
        for part in batches:
            texts = part.column("output").cast(pa.string()).to_pylist()
            forms = part.column("form").to_pylist()
            out = [
                t if t is None or f not in ("psm", "spm") else unrotated(t.encode(), f).decode()
                for t, f in zip(texts, forms, strict=True)
            ]
            yield batch({c: part.column(c) for c in names} | {"restored": pa.array(out, pa.string())})

    return rows.mapInArrow(back, ddl(rows, names) + "restored string")
