"""Columns of any name survive, and different words stay different."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pelagia.llm import chunk_dedup, jaccard_join, order_packing, source_mix, textbytes, toxicity
from pelagia.llm.names import free, others
from tests.llm.test_search_and_forms import LONG, ODD, SCHEMA

NAMES = [
    "row", "Row_", "__row", "__n", "__copy", "__spans", "copies", "n", "copy", "spans", "size", "node", "component",
    "tox_score", "tox_predicted", "TOX_restored", "removed_spans", "removed_bytes", "kept", "digest", "made",
]


def documents(spark, rows=ODD):
    df = spark.createDataFrame(rows, SCHEMA)
    for k, name in enumerate(NAMES):
        df = df.withColumn(name, F.lit(f"value {k}"))
    return df


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, 1, int(k == 5)) for k in range(12)] + [(None, 0, 1), (4, None, None), (9, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_free_names():
    assert free(["A", "b_"], "a", "b", "A") == ["a_", "b", "A__"]


def kept_values(df):
    rows = df.collect()
    assert all(r[name] == f"value {k}" for r in rows for k, name in enumerate(NAMES))
    return rows


def test_columns_come_back(spark, labels):
    docs = documents(spark)
    assert others(docs, ["N", "text"]) == [c for c in docs.columns if c not in ("n", "text")]
    for out in (
        toxicity.without_toxic(docs, labels),
        jaccard_join.one_of_each(docs),
        source_mix.mixed(docs),
        chunk_dedup.dedup_chunks(docs, made=("x1", "x2")).drop("x1", "x2"),
    ):
        assert out.columns == docs.columns
        kept_values(out)
    cut = chunk_dedup.dedup_chunks(docs)
    assert cut.columns[-2:] == ["removed_spans", "removed_bytes"] and cut.count() == len(ODD)


def test_pipeline_on_odd_rows(spark, labels, tmp_path):
    docs = documents(spark, [*ODD, (20, LONG, "en", None, None), (21, " ".join(["a"] * 3000), None, "a", 1)])
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    pieces = out.collect()
    assert pieces and sum(p["length"] for p in pieces) > 20_000
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        kept_values(now)


def test_pipeline_on_no_rows(spark, labels, tmp_path):
    documents(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def thue_morse(size: int) -> tuple[str, str]:
    word = "a"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [8, 512, 1024, 2048, 4096])
def test_words_of_the_same_letters_differ(spark, size):
    from public_tokenizers import path

    one, two = thue_morse(size)
    data = np.frombuffer(f"{one} {two} {one}".encode(), dtype=np.uint8)
    starts = np.array([0, size + 1, 2 * size + 2])
    h = textbytes.range_hashes(data, starts, starts + size)
    assert h[0] == h[2] != h[1]
    ends = np.array([0, size, 2 * size + 2, len(data)])
    tokens = order_packing.WordTokens(path("word_bpe_49k.json"))
    ids, counts = tokens.ids(data, ends)
    want = [tokens.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in (one, two, one)]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    found = jaccard_join.jaccard_components(docs).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 2)]


def test_parts_that_share_a_hash_are_told_apart(monkeypatch):
    """As if all parts of one length had one hash."""
    from public_tokenizers import path

    real = order_packing.range_hashes

    def weak(data, starts, stops, seed=0):
        return real(data, starts, stops, seed) if seed else (stops - starts).astype(np.uint64)

    monkeypatch.setattr(order_packing, "range_hashes", weak)
    tokens = order_packing.WordTokens(path("word_bpe_49k.json"))
    text = "remarkable translation something different translation remarkable"
    for _ in range(2):
        ids, _ = tokens.ids(np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids + [1]
    monkeypatch.setattr(order_packing, "REMEMBERED", 2)
    monkeypatch.setattr(order_packing, "range_hashes", real)
    few = order_packing.WordTokens(path("word_bpe_49k.json"))
    ids, _ = few.ids(np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text)]))
    assert ids.tolist() == few.tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_very_long_runs_are_decoded_in_stretches():
    text = ("i d 1 o t " * 4000).strip()
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    model = toxicity.language_model(np.ones((toxicity.CLASSES,) * 3))
    known: dict = {}
    out, ends, _ = toxicity.restored(data, np.array([0, len(data)]), model, known)
    assert ends[-1] == len(out) and not known
