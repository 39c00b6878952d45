"""Operators on vectors and pages, the pipeline, and the registered queries."""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from pelagia.llm import itq_dedup, multiprobe, warc
from pelagia.llm.components import components
from pelagia.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
VECTOR = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors():
    """Random vectors, near and exact copies, and rows that take no part."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        if i % 4 == 0 or not rows:
            x = rng.standard_normal(16)
        else:
            x = np.array(rows[-1][1]) + rng.standard_normal(16) * (0 if i % 4 == 1 else 0.12)
        rows.append((i, x.astype(np.float32).tolist(), i // 40 % 5))
    bad = [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [1.0] * 15, []]
    rows += [(1000 + 50 * k, x, 1) for k, x in enumerate(bad)]
    rows += [(2000, rows[0][1], None), (2001, rows[0][1][:8], 0), (None, rows[0][1], 0), (5, rows[5][1], rows[5][2])]
    return rows


def fine(x):
    return bool(x) and None not in x and np.isfinite(x).all() and np.any(x)


def cosine(a, b):
    a, b = np.array(a, dtype=np.float64), np.array(b, dtype=np.float64)
    return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))


def frame(spark, rows):
    df = spark.createDataFrame(rows, VECTOR)
    for name in ("code", "node", "entry", "table", "cell", "score", "kind"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates_against_all_pairs(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(itq_dedup, "BLOCK", block)
    got = itq_dedup.near_duplicates(frame(spark, vectors)).collect()
    n, top = Counter(), {}

    def root(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for i, (a, x, k) in enumerate(vectors):
        for b, y, m in vectors[:i]:
            if k is not None and k == m and fine(x) and fine(y) and len(x) == len(y) and cosine(x, y) >= 0.98:
                n[a] += 1
                n[b] += 1
                if a is not None and b is not None:
                    top[max(root(a), root(b))] = min(root(a), root(b))
    assert len(got) == len(vectors)
    for r in got:
        if r["vec_id"] in (None, 5):
            continue
        assert (r["n_links"], r["component_id"]) == (n[r["vec_id"]], root(r["vec_id"]))
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    # the row without an id hangs on the first vector and its copies; two rows share the id 5
    assert [r["component_id"] for r in got if r["vec_id"] is None] == [0]
    assert sum(r["n_links"] for r in got if r["vec_id"] == 5) == n[5]
    assert itq_dedup.near_duplicates(frame(spark, vectors).limit(0)).count() == 0


def test_rotation_is_orthogonal_and_bits_are_balanced():
    x = np.random.default_rng(2).standard_normal((2000, 24)) * np.linspace(0.2, 3, 24)
    mean, turn = itq_dedup.rotation(x, 24)
    assert np.allclose(turn.T @ turn, np.eye(24), atol=1e-8)
    share = ((x - mean) @ turn >= 0).mean(axis=0)
    assert (abs(share - 0.5) < 0.1).all()


def test_nearest(spark, vectors):
    rows = [r for r in vectors if r[0] != 5]
    got = multiprobe.nearest(frame(spark, rows), every=20).collect()
    whole = [(i, x) for i, x, _ in rows if i is not None and fine(x)]
    found = Counter()
    for q, x in whole:
        if q % 20:
            continue
        order = sorted((-cosine(x, y), i) for i, y in whole if i != q and len(x) == len(y))[:5]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, len(order) + 1))
        found["met"] += len({i for _, i in order} & {r[1] for r in own})
        found["all"] += len(order)
        scores = {i: cosine(x, y) for i, y in whole if len(x) == len(y)}
        assert all(abs(r[2] - scores[r[1]]) < 1e-12 for r in own)
        assert own == sorted(own, key=lambda r: (-r[2], r[1]))
    assert found["met"] >= 0.9 * found["all"]
    assert {r["query_id"] for r in got} == {i for i, _ in whole if i % 20 == 0}
    few = multiprobe.nearest(frame(spark, rows[:3]), every=1).collect()
    assert Counter(r["query_id"] for r in few) == {0: 2, 1: 2, 2: 2}
    assert multiprobe.nearest(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("copies", [0.3, 0.6])
def test_nearest_of_lone_vectors_among_near_copies(spark, copies):
    """Recall does not depend on how many other vectors are near copies."""
    rng = np.random.default_rng(11)
    n, dim = 4000, 64
    grouped = int(n * copies)
    x = rng.standard_normal((n, dim))
    x[:grouped] = np.repeat(rng.standard_normal((grouped // 20, dim)), 20, axis=0) + 0.02 * rng.standard_normal((grouped, dim))
    ids = rng.permutation(n)
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], VECTOR)
    got = multiprobe.nearest(df, every=25).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    met, every = Counter(), Counter()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    for at in np.flatnonzero(ids % 25 == 0).tolist():
        s = unit @ unit[at]
        s[at] = -2
        best = set(ids[np.argsort(-s)[:5]].tolist())
        kind = "group" if at < grouped else "lone"
        met[kind] += len(best & found[ids[at]])
        every[kind] += 5
    recall = {kind: met[kind] / every[kind] for kind in every}
    print(f"recall with {copies:.0%} near copies: {recall}")
    assert min(recall.values()) >= 0.9


def test_probes_come_in_order_of_chance_and_start_at_home():
    table = multiprobe.Table(0, 16)
    x = np.random.default_rng(3).standard_normal((1, 16))
    own = table.cells(x)[0]
    cells = table.probes(table.project(x)[0], 0.995)
    assert cells[0] == own and len(set(cells.tolist())) == len(cells)
    assert len(table.probes(table.project(x)[0], 0.2)) > len(cells)


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 600 + i) for i in range(200)] + [(7, 7)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {}

    def root(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        top[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


PAGES = [
    (1, "http://a/\n b", "<p>" + "x" * 200),
    (2, None, "<p>" + "x" * 200),
    (3, "u", "short"),
    (4, "u", "short"),
    (5, "u", None),
    (6, "u", ""),
    (None, "u", "<p>" + "x" * 200),
    (7, "u", "\x1f\u008b\x08 WARC/1.1 \r\n\r\n" + "é" * 300),
    (8, "u", "y" * 3_000_000),
    (8, "u", "y" * 3_000_000),
]


@pytest.mark.parametrize("range_bytes", [7, 1000, 1 << 22])
def test_archives(spark, tmp_path, range_bytes):
    rows = PAGES if range_bytes > 500 else PAGES[:8]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    files = warc.write_archives(warc.with_revisits(pages), str(tmp_path / "w"), file_bytes=600)
    got = warc.read_archives(files, range_bytes).collect()
    want = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        copy = len(raw) >= 100 and page_id != 1 and html == rows[0][2]
        want.append((page_id or 0, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if copy else "response", 1 if copy else None))
    have = [(r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert files.agg(F.sum("records")).head()[0] == len(rows)
    # other readers of gzip see whole records one after the other
    whole = b"".join(gzip.open(f["path"]).read() for f in files.collect())
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)


def test_ranges_own_each_record_once():
    members = [warc.record(i, None, os.urandom(300) + b"\x1f\x8b\x08WARC/1.1", "d", None) for i in range(20)]
    data = b"".join(members)
    for size in (1, 50, 333, 10_000):
        seen = [p for a in range(0, len(data), size) for p, _ in warc.records_in(io.BytesIO(data), a, min(a + size, len(data)))]
        assert seen == np.cumsum([0, *map(len, members[:-1])]).tolist()
    # the end of a cut file is no record
    assert len(list(warc.records_in(io.BytesIO(data[:-5]), 0, len(data)))) == 19


def test_no_pages(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty, str(tmp_path / "w")).count() == 0


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_oracle(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    want = connection.sql(ORACLE_SQL[name]).df().astype(object)
    got = driver.queries()[name](spark, FOLDER).toPandas().astype(object)
    assert sorted(got) == sorted(want)
    names = sorted(want)

    def plain(value):
        """Whole numbers alike, whether or not the column had nulls."""
        return None if pd.isna(value) else int(value) if isinstance(value, float) else value

    rows = [sorted(str([plain(v) for v in r]) for r in df[names].itertuples(index=False)) for df in (got, want)]
    assert rows[0] == rows[1]


def test_all_ten_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 11)) and "pipeline" in driver.queries()


def test_pipeline(spark):
    """Each stage keeps the columns, and the last packs what is left whole."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first, counts = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == first.columns
        docs = spark.createDataFrame(docs.collect(), first.schema)
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] <= counts[2]
    packed = corpus_pipeline.packing(spark, docs, FOLDER)
    assert packed.filter("start = 0").count() == counts[-1]
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.columns == packed.columns
    assert whole.filter("start = 0").count() == counts[-1]
