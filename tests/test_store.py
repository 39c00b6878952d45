"""The versioned store: merging, reading, failed and repeated commits, and lookups that leave it where it is."""

from __future__ import annotations

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from pelagia.functions.coords import KEY
from pelagia.operators import joins, weather
from pelagia.schemas import WEATHER_PARAMETERS
from pelagia.sources import commits
from pelagia.sources import store as stores

OBSERVATION = "lat double, lon double, date string, " + ", ".join(f"{p} double" for p in WEATHER_PARAMETERS)


def observed(spark, *rows):
    full = [(lat, lon, day, *[float(value + i) for i in range(6)]) for lat, lon, day, value in rows]
    return spark.createDataFrame(full, OBSERVATION).withColumn("date", F.col("date").cast("timestamp_ntz"))


def content(store, **options):
    rows = store.read(**options).select(*KEY, "temperature").collect()
    return {(r[0], r[1], str(r[2])): r[3] for r in rows}


def files(path):
    found = glob.glob(f"{path}/data/*/part=*/*.parquet")
    return {os.path.basename(f): os.path.basename(os.path.dirname(f)) for f in found}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark, tmp_path):
    made = stores.create_store(spark, str(tmp_path / "store"), 4)
    made.upsert(
        observed(
            spark,
            (1.0, 2.0, "2020-01-05 06:00:00", 10),
            (-1.0, 2.123456, "2020-01-31", 20),
            (1.0, 2.0, "2020-02-01", 30),
            (1.0, 2.0, "2020-03-01 23:59:59", 40),
        ),
        ["date"],
    )
    return made


def test_an_upsert_rewrites_the_parts_it_touches(spark, store, tmp_path):
    before, old = files(tmp_path / "store"), store.version()
    assert set(old.parts) == {"2020-01", "2020-02", "2020-03"}
    new = observed(
        spark,
        (1.0, 2.0, "2020-01-05", 50),
        (1.0, 2.0, "2020-01-05 09:00:00", 51),
        (7.0, 7.0, "2020-01-09", 60),
        (7.0, 7.0, "2021-07-01", 70),
    )
    version = store.upsert(new, ["date"])
    assert content(store) == {
        (1.0, 2.0, "2020-01-05"): 51.0,
        (-1.0, 2.12346, "2020-01-31"): 20.0,
        (7.0, 7.0, "2020-01-09"): 60.0,
        (1.0, 2.0, "2020-02-01"): 30.0,
        (1.0, 2.0, "2020-03-01"): 40.0,
        (7.0, 7.0, "2021-07-01"): 70.0,
    }
    assert {p for p in version.parts if version.parts[p] != old.parts.get(p)} == {"2020-01", "2021-07"}
    after = files(tmp_path / "store")
    assert set(before) <= set(after)
    assert {after[f] for f in set(after) - set(before)} == {"part=2020-01", "part=2021-07"}
    # an older version still reads as it was
    assert content(store, version=old)[(1.0, 2.0, "2020-01-05")] == 10.0


def test_days_prune_parts(spark, store):
    df = store.read(date(2020, 1, 20), date(2020, 2, 15))
    assert {str(r["key_day"]) for r in df.collect()} == {"2020-01-31", "2020-02-01"}
    assert "part" in plan(df) and "2020-03" not in plan(df).split("PartitionFilters")[1].split("]")[0]
    assert len(df.inputFiles()) <= 3


def test_a_failed_commit_changes_nothing(spark, store, monkeypatch):
    before = content(store)

    def fail(*_):
        raise OSError("no space")

    monkeypatch.setattr(stores.commits, "publish", fail)
    with pytest.raises(OSError):
        store.upsert(observed(spark, (1.0, 2.0, "2020-01-05", 99)), ["date"])
    monkeypatch.undo()
    assert content(store) == before and content(stores.WeatherStore(spark, store.path)) == before
    store.upsert(observed(spark, (1.0, 2.0, "2020-01-05", 99)), ["date"])
    assert content(store) == before | {(1.0, 2.0, "2020-01-05"): 99.0}


def test_a_repeated_batch_changes_nothing(spark, store):
    first = store.upsert(observed(spark, (1.0, 2.0, "2020-01-05", 60)), ["date"], ("feed", 7))
    for number in (7, 3):
        again = store.upsert(observed(spark, (1.0, 2.0, "2020-01-05", 61)), ["date"], ("feed", number))
        assert again == first
    other = store.upsert(observed(spark, (1.0, 2.0, "2020-01-05", 62)), ["date"], ("other", 1))
    assert other.applied == {"feed": 7, "other": 1} and content(store)[(1.0, 2.0, "2020-01-05")] == 62.0


def test_an_overtaken_commit_is_merged_again(spark, store, monkeypatch):
    plain, rival = stores.commits.publish, []

    def slow(session, path, text):
        if not rival:
            rival.append(None)
            store.upsert(observed(spark, (3.0, 3.0, "2020-01-07", 80)), ["date"])
        return plain(session, path, text)

    monkeypatch.setattr(stores.commits, "publish", slow)
    store.upsert(observed(spark, (1.0, 2.0, "2020-01-05", 81)), ["date"])
    found = content(store)
    assert found[(3.0, 3.0, "2020-01-07")] == 80.0 and found[(1.0, 2.0, "2020-01-05")] == 81.0
    assert store.versions() == [1, 2, 3, 4]


def test_expired_versions_go_with_their_files(spark, store, tmp_path):
    store.upsert(observed(spark, (1.0, 2.0, "2020-01-05", 50)), ["date"])
    want = content(store)
    (tmp_path / "store" / "data" / "unfinished").mkdir()
    assert store.expire(2) == [] and store.versions() == [2, 3]
    store.upsert(observed(spark, (1.0, 2.0, "2020-01-05", 50)), ["date"])
    assert len(store.expire(1)) == 1 and store.versions() == [4]
    assert content(store) == want and (tmp_path / "store" / "data" / "unfinished").exists()


def test_odd_observations(spark, tmp_path):
    store = stores.create_store(spark, str(tmp_path / "days"), 2, by="day")
    assert store.read().count() == 0 and store.read(date(2020, 1, 1), date(2020, 1, 2)).count() == 0
    nan, null = float("nan"), None
    rows = observed(
        spark, (nan, 1.0, "2020-01-01", 1), (1.0, null, "2020-01-01", 2), (1.0, 1.0, null, 3), (-0.000001, 0.1 + 0.2, "2020-01-01", 4)
    )
    assert set(store.upsert(rows, ["date"]).parts) == {"2020-01-01"}
    assert content(store) == {(0.0, 0.3, "2020-01-01"): 4.0}
    assert store.upsert(rows.limit(0), ["date"]).parts == store.version().parts
    with pytest.raises(FileExistsError):
        stores.create_store(spark, str(tmp_path / "days"), 2)
    with pytest.raises(FileNotFoundError):
        stores.WeatherStore(spark, str(tmp_path / "nowhere")).read()
    with pytest.raises(ValueError):
        stores.create_store(spark, str(tmp_path / "x"), 2, by="year")


def test_publish_once(spark, tmp_path):
    path = f"{tmp_path}/a/1.json"
    assert commits.publish(spark, path, "é one") and not commits.publish(spark, path, "two")
    assert commits.read_text(spark, path) == "é one"
    assert commits.names(spark, f"{tmp_path}/a") == ["1.json"] or all(
        n == "1.json" or n.startswith(".") for n in commits.names(spark, f"{tmp_path}/a")
    )


def requests(spark, *rows):
    df = spark.createDataFrame(rows, "req_id int, pos int, latitude double, longitude double, date string")
    return df.withColumn("date", F.col("date").cast("timestamp_ntz"))


ASKED = [
    (1, 0, 1.0, 2.0, "2020-01-05 12:00:00"),
    (1, 1, 9.0, 9.0, "2020-01-05"),
    (1, 2, 1.0, 2.0, "2020-01-05"),
    (0, 0, -1.0, 2.1234561, "2020-01-31"),
    (0, 1, None, 2.0, "2020-01-31"),
]


def test_lookups_do_not_move_the_store(shuffled, store):
    asked = requests(shuffled, *ASKED)
    got = weather.answer(asked, store, [], ["req_id", "pos"])
    rows = [(r["req_id"], r["pos"], r["temperature"], r["found"]) for r in got.collect()]
    assert rows == [(0, 0, 20.0, True), (0, 1, None, False), (1, 0, 10.0, True), (1, 1, None, False), (1, 2, 10.0, True)]
    assert got.columns[:5] == asked.columns
    joined = weather.weather_match(asked, store, [], ["req_id", "pos"])
    text = plan(joined)
    # the points are shuffled into the store's buckets, and no row of the store is
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert text.count("Exchange hashpartitioning") == 1
    assert ", 4), ENSURE_REQUIREMENTS" in text
    points = asked.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    assert sorted(r["pos"] for r in weather.attach_weather(points, store, [], ["req_id"]).collect()) == [0, 0, 2]
    assert [tuple(r)[:2] for r in weather.missing_keys(asked, store).orderBy("key_lat").collect()] == [(None, 2.0), (9.0, 9.0)]


def test_frequent_points_stay_where_they_are(shuffled, store):
    asked = requests(shuffled, *[(k, 0, 1.0, 2.0, "2020-01-05") for k in range(400)], *[(k, 1, float(k), 2.0, "2020-01-05") for k in range(300)])
    got = weather.weather_match(asked, store, [], ["req_id"])
    assert "BroadcastHashJoin" in plan(got)
    assert got.count() == 700 and got.filter("found").count() == 401
    with pytest.raises(ValueError):
        joins.bucketed_lookup(asked, asked, ["req_id"], "full")


def test_answer_from_a_table(spark):
    table = observed(spark, (1.0, 2.0, "2020-01-05", 10), (-1.0, 2.12346, "2020-01-31", 20))
    got = weather.answer(requests(spark, *ASKED), table, ["date"], ["req_id", "pos"]).collect()
    assert [(r["req_id"], r["pos"], r["temperature"]) for r in got] == [(0, 0, 20.0), (0, 1, None), (1, 0, 10.0), (1, 1, None), (1, 2, 10.0)]
    empty = weather.answer(requests(spark, *ASKED).limit(0), table, ["date"], ["req_id", "pos"])
    assert empty.count() == 0


def test_a_store_of_many_rows_gets_more_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "BUCKET_ROWS", 5)
    monkeypatch.setattr(stores, "FULL", 2)

    def days(*numbers):
        return observed(spark, *[(float(k), 2.0, f"2020-0{1 + k % 3}-05", 10 + k) for k in numbers])

    def made_by_tasks():
        return {os.path.basename(f).split("-")[1] for f in glob.glob(f"{path}/data/*/part=*/*.parquet")}

    path = tmp_path / "store"
    store = stores.create_store(spark, str(path), 2)
    version = store.upsert(days(*range(36)), ["date"])
    assert version.buckets == 8 and sum(version.rows.values()) == 36 and len(made_by_tasks()) > 2
    # as many as are asked for are enough for a while, and then all parts are written anew
    version = store.upsert(days(0, 3), ["date"])
    assert version.buckets == 8 and len(set(version.parts.values())) == 2 and sum(version.rows.values()) == 36
    version = store.upsert(days(*range(30, 90, 3)), ["date"])
    assert version.buckets == 8
    version = store.upsert(days(*range(90, 180, 3)), ["date"])
    assert version.buckets == 32 and len(set(version.parts.values())) == 1
    want = [*range(36), *range(36, 180, 3)]
    assert {k[0]: v for k, v in content(store).items()} == {float(k): 10.0 + k for k in want}
    assert sum(version.rows.values()) == len(want)
    asked = requests(spark, *[(k, 0, float(k), 2.0, f"2020-0{1 + k % 3}-05") for k in range(200)])
    assert weather.weather_match(asked, store, [], ["req_id"]).filter("found").count() == len(want)
