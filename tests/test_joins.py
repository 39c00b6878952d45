"""Lookups with a few very frequent keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pelagia.operators import joins


@pytest.fixture
def crowded(spark):
    """A third of the rows on key 0, a tenth without a key."""
    id = F.col("id")
    key = F.when(id % 3 == 0, 0).when(id % 10 == 1, None).otherwise(id % 500)
    return spark.range(30_000).select("id", key.alias("k"))


def test_frequent_keys_are_found_and_cut_by_their_share(crowded):
    hot = joins.frequent_keys(crowded, ["k"], 32)
    assert len(hot) == 2
    assert max(hot.values()) in (11, 12)


def test_no_frequent_keys_in_even_data(spark):
    assert joins.frequent_keys(spark.range(5_000), ["id"], 16) == {}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_shuffled_lookup_equals_plain_join(shuffled, crowded, how):
    right = shuffled.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    plain = sorted(map(str, crowded.join(right, "k", how).select("id", "k", "v").collect()))
    got = joins.lookup(crowded, right, ["k"], ["id"], how, broadcast_rows=0, pieces=32)
    assert sorted(map(str, got.select("id", "k", "v").collect())) == plain


def test_frequent_key_is_spread_over_partitions(shuffled, crowded):
    shuffled.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = shuffled.range(0, 400).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        got = joins.lookup(crowded, right, ["k"], ["id"], broadcast_rows=0, pieces=32)
        parts = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in parts) < 30_000 / 8 * 2
    finally:
        shuffled.conf.unset("spark.sql.adaptive.enabled")


def test_condition_in_a_left_lookup(shuffled, crowded):
    right = shuffled.range(0, 400).select(F.col("id").alias("k"), F.lit(20_000).alias("limit"))
    for rows in (0, 1000):
        got = joins.lookup(
            crowded, right, ["k"], ["id"], condition=F.col("id") < F.col("limit"), broadcast_rows=rows
        )
        assert got.count() == 30_000
        assert got.filter("limit is not null and id >= 20000").count() == 0
        assert got.filter("limit is null and id < 20000 and k < 400").count() == 0


def test_keys_of_two_integer_types(shuffled, crowded):
    right = shuffled.range(0, 400).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("v"))
    got = joins.lookup(crowded, right, ["k"], ["id"], "inner", broadcast_rows=0, pieces=32)
    assert got.count() == crowded.join(right, "k").count()
    with pytest.raises(ValueError, match="key k is bigint and string"):
        joins.lookup(crowded, right.withColumn("k", F.col("k").cast("string")), ["k"], ["id"])


def test_size_check(spark):
    assert joins.has_at_most(spark.range(10), 10)
    assert not joins.has_at_most(spark.range(11), 10)


def test_shared_columns_are_refused(spark):
    df = spark.range(3).withColumn("x", F.lit(1))
    with pytest.raises(ValueError, match="both sides"):
        joins.lookup(df, df, ["id"], ["id"])
    with pytest.raises(ValueError, match="left or an inner"):
        joins.lookup(df, df.drop("x"), ["id"], ["id"], how="full")
