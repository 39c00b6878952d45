"""Reversed search, fill-in-middle forms and fingerprints: against plain versions, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from pelagia.llm import infill, minhash, reversed_search
from pelagia.llm.queries import op12_infill, op13_minhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(60_000))
ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (3, " \t\n", "en", "a", 3),
    (4, "one two", "en", "b", 7),
    (5, "One  TWO three, four-five\x0bsix ", "en", "b", 8),
    (6, "a\x00b éé \U0001f600 tail", "fr", "a", 9),
    (7, LONG, "en", "c", len(LONG)),
    (8, LONG + " more", "en", "c", len(LONG)),
    (None, "no id here at all", "en", "b", 4),
    (9, "no id here at all", "en", "b", 4),
    (9, "no id here at all", "en", "b", 4),
    (10, "holds <P> a mark", "en", "b", 4),
    (11, "  starts blank and ends so too \n", "en", "b", 4),
]


def random_rows(n: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    words = ["de", "la", "über", "Zug", "x1", "a-b", "çok", "the", "of", "rare", "日本", "o'clock", "END"]
    weights = [30, 20, 3, 4, 2, 2, 1, 40, 30, 1, 1, 2, 3]
    space = [" ", " ", " ", "  ", "\n", "\t", " \r\n"]
    out = []
    for k in range(n):
        parts = draw.choices(words, weights, k=draw.choice([0, 1, 2, 4, 5, 6, 20, 60]))
        text = "".join(p + draw.choice(space) for p in parts)
        out.append((k * 3, text if draw.random() < 0.5 else text.strip(), "en", "s", len(text)))
    return out


def frame(spark, rows, *extra):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    return df


# ---------------------------------------------------------------- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def plain_ranking(docs, items, top=20):
    known = [(d, Counter(plain_terms(t))) for d, t in docs]
    known = [(d, c) for d, c in known if c]
    n_docs, length = len(known), sum(sum(c.values()) for _, c in known)
    df = Counter(t for _, c in known for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c in known:
            m = 75 + 25 * sum(c.values()) * n_docs // length
            score = 0
            for t in plain_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d, score))
        out += [(item, r, s[3], s[4]) for r, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


ITEMS = [
    (1, "rare Zug 日本 rare"),
    (2, "the of the"),
    (2, "the of the"),
    (2, "another text: x1, one two w7919"),
    (3, None),
    (4, ""),
    (None, "UÜber über no id"),
    (5, "nowhere else"),
]


@pytest.mark.parametrize("block_bytes", [reversed_search.BLOCK_BYTES, 60])
def test_search_finds_what_a_plain_ranking_finds(spark, block_bytes):
    rows = random_rows(300, 1) + ODD
    docs = frame(spark, rows, "item", "score", "rank", "item_id", "term", "part").repartition(5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = reversed_search.ranked(docs, items, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, found), key=str) == plain_ranking([r[:2] for r in rows], ITEMS)


def test_search_in_small_steps_gives_the_same(spark, monkeypatch):
    rows = random_rows(60, 2)
    monkeypatch.setattr(reversed_search, "STRETCH", 7)
    monkeypatch.setattr(reversed_search, "CELLS", 9)
    index = reversed_search.Index([t for _, t in ITEMS])
    docs = [(80 + k, index.counts((r[1] or "").encode())[1]) for k, r in enumerate(rows)]
    small = reversed_search._scores(index, reversed_search.np.arange(len(index.number)) + 1, docs)
    monkeypatch.setattr(reversed_search, "CELLS", 1 << 20)
    large = reversed_search._scores(index, reversed_search.np.arange(len(index.number)) + 1, docs)
    assert (small == large).all() and small.any()
    for r in rows:
        assert [t.decode() for p in reversed_search.terms(r[1].encode()) for t in p] == plain_terms(r[1])


def test_search_of_empty_tables(spark):
    docs, items = frame(spark, ODD), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert reversed_search.ranked(docs.limit(0), items).count() == 0
    assert reversed_search.ranked(docs.filter("doc_id <= 3"), items).count() == 0
    assert reversed_search.ranked(docs, items.limit(0)).count() == 0


def test_heaps_hold_ties_in_order_of_ids():
    heaps = reversed_search.Heaps(1, 3)
    for doc_id in [5, None, 9, 2, 7, 1]:
        heaps.add(reversed_search.np.array([[10]]), [doc_id])
    heaps.add(reversed_search.np.array([[11]]), [100])
    rows = heaps.rows().to_pylist()
    assert {(r["doc_id"], r["score"]) for r in rows} == {(100, 11), (1, 10), (2, 10)}


# ---------------------------------------------------------------- fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


def test_infill_matches_plain_strings_and_comes_back(spark):
    rows = random_rows(400, 3) + ODD + [(k, "< P><S <M x", "en", "b", 1) for k in range(1000, 1040)]
    docs = frame(spark, rows, "Output", "form", "n", "restored", "words")
    made = infill.infilled(docs)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "restored", "words", *infill.MADE]
    found = infill.restored(made).collect()
    assert len(found) == len(rows)
    forms = Counter()
    for r in found:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_infill(r["doc_id"], r["text"])
        assert r["restored"] == (r["text"] or "") and r["words"] == "x"
        forms[r["form"]] += 1
    assert min(forms[f] for f in ("plain", "spm", "psm")) > 20
    assert infill.infilled(docs.limit(0)).count() == 0


def test_infill_restores_all_cuts():
    for text in ("", "<", "S>", "<<M", "P>é<", "one two"):
        raw = text.encode()
        for a in range(len(raw) + 1):
            for b in range(a, len(raw) + 1):
                x, y, z = raw[:a], raw[a:b], raw[b:]
                assert infill.rotated(raw, a, b, "psm") == b"<P>" + x + b"<S>" + z + b"<M>" + y
                assert infill.rotated(raw, a, b, "spm") == b"<S>" + z + b"<P>" + x + b"<M>" + y
                assert all(infill.unrotated(infill.rotated(raw, a, b, f), f) == raw for f in ("psm", "spm"))


# ---------------------------------------------------------------- fingerprints


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def plain_fingerprint(text):
    """Bins by trying every place of every order in turn."""
    bins = {}
    for shingle in plain_shingles(text):
        h = 42
        for word in shingle:
            h = xxhash.xxh64_intdigest(word.encode(), h)
        h = h - (1 << 64) if h >> 63 else h
        at = (h >> 56) + 128
        bins[at] = min(h, bins.get(at, h))
    if not bins:
        return ""
    out = ""
    for i, order in enumerate(minhash._orders()):
        start, step = order[minhash.LOOKS], pow(order[minhash.LOOKS + 1], -1, 257)
        tries = [i, *((start + step * t) % 257 for t in range(257))]
        out += f"{next(bins[t] for t in tries if t in bins) & 255:02x}"
    return out


def test_fingerprints_match_plain_ones(spark):
    rows = random_rows(120, 4) + ODD
    docs = frame(spark, rows, "words", "hashes", "Bins", "least", "fp").repartition(3)
    found = minhash.with_fingerprint(docs, "text", "fp").collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["fp"] == plain_fingerprint(r["text"]) and r["Bins"] == "x"
    assert minhash.with_fingerprint(docs.limit(0), "text", "fp").count() == 0


def test_likeness_follows_the_share_of_common_shingles(spark):
    draw = random.Random(5)
    rows, wanted = [], {}
    for k in range(60):
        words = [str(draw.random()) for _ in range(draw.choice([30, 200, 900]))]
        other = words[: len(words) * k // 60] + [str(draw.random()) for _ in range(20)]
        rows.append((k, " ".join(words), " ".join(other)))
        x, y = plain_shingles(rows[-1][1]), plain_shingles(rows[-1][2])
        wanted[k] = len(x & y) / len(x | y)
    df = spark.createDataFrame([*rows, (60, "", None), (61, "a", " "), (62, "A b", "a B")], "k long, a string, b string")
    df = minhash.with_fingerprint(minhash.with_fingerprint(df, "a", "x"), "b", "y")
    found = {r["k"]: r["l"] for r in df.select("k", minhash.likeness("x", "y").alias("l")).collect()}
    assert (found[60], found[61], found[62]) == (1.0, 0.0, 1.0)
    errors = [abs(found[k] - wanted[k]) for k in wanted]
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.04


@pytest.mark.parametrize("stretch", [5, 100_000])
def test_next_row(spark, stretch):
    rows = [(k * k % 1009, f"t{k}") for k in range(700)] + [(5, "same")] * 300 + [(None, "n1"), (None, "n2")]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("place", F.lit(1)).repartition(7)
    out = minhash.with_next(df, "id", {"id": "next_id", "text": "next_text"}, stretch)
    assert out.columns == ["id", "text", "place", "next_id", "next_text"]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wanted = [(*a, *b) for a, b in zip(order, order[1:] + order[:1])]
    assert sorted(((r[0], r[1], r[3], r[4]) for r in out.collect()), key=str) == sorted(wanted, key=str)


def test_next_row_of_few_rows(spark):
    schema = "id long, text string"
    one = spark.createDataFrame([(3, "a")], schema)
    assert [tuple(r) for r in minhash.with_next(one, "id", {"text": "t"}).collect()] == [(3, "a", "a")]
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], schema)
    assert sorted(r["t"] for r in minhash.with_next(nulls, "id", {"text": "t"}).collect()) == ["a", "b"]
    assert minhash.with_next(one.limit(0), "id", {"text": "t"}).count() == 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_queries_on_odd_rows(spark, tmp_path):
    rows = ODD + random_rows(80, 6)
    frame(spark, rows, "edited", "next_text", "next_fingerprint").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_infill(spark, str(tmp_path)).filter("restored_sha256 is null").count() == 0
    out = op13_minhash(spark, str(tmp_path))
    assert "Python" not in plan(out) and "Arrow" not in plan(out)
    texts = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wanted = Counter()
    for (doc_id, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        wanted[doc_id, len(text), digest, plain_fingerprint(text), plain_fingerprint(edited)] += 1
    found = out.collect()
    assert Counter(tuple(r[:5]) for r in found) == wanted
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
