"""A corpus pipeline of five stages, each by one operator of the subpackage ``llm``.

Every stage reads what the one before has written as Parquet and works on all of it. All but the
last return the columns of ``documents``, whatever further columns there are and whatever these are called.
Null ids, texts and sources, empty and very long texts, repeated rows and empty tables are worked on like
others; what a stage makes of them is said with its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm.chunk_dedup import dedup_chunks
from pelagia.llm.jaccard_join import one_of_each
from pelagia.llm.names import free
from pelagia.llm.order_packing import packed
from pelagia.llm.source_mix import mixed
from pelagia.llm.storage import shared_folder, short_batches
from pelagia.llm.toxicity import without_toxic
from pelagia.sources.commits import remove

TOKENIZER = "word_bpe_49k.json"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model fitted on these rows does not take for toxic.

    Null and empty texts are scored like others; without labels nothing is taken for toxic.
    """
    return without_toxic(docs, short_batches(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles, the one of least id, null last.

    Documents without words all stay; of rows that are equal in id and text one stays.
    """
    short_batches(spark)
    return one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that came before; documents of which nothing is left go.

    ``n_chars`` is counted anew where a text has changed. Null and empty texts stay as they are.
    """
    short_batches(spark)
    made = free(docs.columns, "removed_spans", "removed_bytes")
    cut = dedup_chunks(docs, made=made)
    removed = F.col(made[1])
    kept = cut.filter((removed == 0) | (F.col("text") != ""))
    counted = F.when(removed > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", counted).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; a null source is one of them."""
    short_batches(spark)
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences; a null text is an end alone."""
    from public_tokenizers import path

    short_batches(spark)
    return packed(docs, path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("jaccard", jaccard),
    ("passages", passages),
    ("mix", mix),
    ("packing", packing),
]

# The fitted model, the components and the packing are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to the rows that the one before has written.

    What a stage has written goes when the next one is done.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = shared_folder(spark), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
