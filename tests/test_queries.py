"""Every registered query against its oracle, and properties of the whole jobs."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import catalog
from fixtures import Tables
from pelagia.schemas import TRAINING_FEATURES

FOLDER = "/root/testdata/sf0.001"
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in catalog.QUERIES}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in ("orders", "lineitem"):
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]) or c == "key_day":
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]")
    return df.sort_values(list(df.columns), na_position="last").reset_index(drop=True)


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracle(spark, oracle, name):
    got = normal(driver.queries()[name](spark, FOLDER).toPandas())
    want = normal(oracle.sql(ORACLES[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in ORACLES])
def test_runs(spark, name):
    assert driver.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_training_set_is_whole_and_clean(spark):
    t = Tables(spark, FOLDER)
    rows = catalog.training_rows(t)
    n = rows.count()
    assert [r[0] for r in rows.orderBy("position").select("position").collect()] == list(range(n))
    bad = " or ".join(f"{c} is null or isnan({c}) or {c} = -666" for c in TRAINING_FEATURES)
    assert rows.filter(bad).count() == 0
    positive = rows.filter("label = 1").count()
    assert 0 < n - positive <= 3 * (positive // 3)


def test_training_set_by_shuffle_joins(shuffled, monkeypatch):
    """The same rows when nothing is small enough to broadcast."""
    from pelagia.operators import joins

    t = Tables(shuffled, FOLDER)
    want = sorted(map(str, catalog.training_rows(t).collect()))
    monkeypatch.setattr(joins, "has_at_most", lambda df, rows: False)
    assert sorted(map(str, catalog.training_rows(t).collect())) == want


def test_plans_push_filters_and_read_few_columns(spark):
    t = Tables(spark, FOLDER)
    stored = t.orders.withColumns(
        {"raw_date": F.col("o_orderpriority"), "lat": F.col("o_totalprice"), "lon": F.col("o_totalprice")}
    )
    from pelagia.plans.training import filter_sightings

    df = filter_sightings(stored).select("o_orderkey", "date")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(o_totalprice,-70.0)" in scan
    assert "o_custkey" not in scan and "o_orderstatus" not in scan


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_no_python_in_the_plan(spark, name):
    plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan
