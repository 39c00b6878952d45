"""The online job: answers once each over restarts, a store that grows meanwhile, and late observations."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from pelagia.plans import trees
from pelagia.schemas import OBSERVATION, WEATHER_PARAMETERS
from pelagia.sources.store import create_store
from pelagia.streaming import serve as online
from pelagia.streaming.sink import BatchLog

FEATURES = ["lat", "temperature"]
# warm places score 73, others 27
NODES = [
    (0, 1, "temperature", 15.0, 2, 3, None, 1.0, 2.0),
    (0, 2, None, None, None, None, -1.0, None, 1.0),
    (0, 3, None, None, None, None, 1.0, None, 1.0),
]


@pytest.fixture(scope="module")
def model(spark):
    return trees.model_of(spark.createDataFrame(NODES, trees.NODES), FEATURES)


@pytest.fixture
def place(spark, tmp_path):
    for name in ("requests", "observations"):
        (tmp_path / name).mkdir()
    return tmp_path


def ask(place, name, *points, day="2021-08-19"):
    lines = [json.dumps({"coords": [list(p)], "date": f"{day}T10:00:00"}) for p in points]
    (place / "requests" / f"{name}.json").write_text("\n".join(lines) + "\n")


def observe(spark, place, name, *rows):
    full = [(lat, lon, day, *[float(t if p == "temperature" else 1) for p in WEATHER_PARAMETERS]) for lat, lon, day, t in rows]
    text = "lat double, lon double, date string, " + ", ".join(f"{p} double" for p in WEATHER_PARAMETERS)
    df = spark.createDataFrame(full, text).withColumn("date", F.col("date").cast("timestamp_ntz"))
    df = df.select(*[f.name for f in OBSERVATION.fields])
    df.coalesce(1).write.parquet(str(place / f"draft-{name}"))
    part = next((place / f"draft-{name}").glob("part-*.parquet"))
    os.rename(part, place / "observations" / f"{name}.parquet")


def serve(spark, place, store, model):
    requests = online.read_requests(spark, str(place / "requests"), 1)
    online.serve(requests, store, model, str(place / "out"), str(place / "check-serve")).awaitTermination()


def feed(spark, place, store):
    rows = online.read_observations(spark, str(place / "observations"), 1)
    online.feed_store(rows, store, ["date"], str(place / "check-feed")).awaitTermination()


def answers(spark, place):
    rows = online.read_answers(spark, str(place / "out")).collect()
    return sorted((r["latitude"], r["count"], r["found"]) for r in rows)


def test_requests_are_served_once_and_see_the_store_of_their_time(spark, place, model):
    store = create_store(spark, str(place / "store"), 2)
    observe(spark, place, "1", (1.0, 2.0, "2021-08-19", 20))
    feed(spark, place, store)
    ask(place, "1", (2.0, 1.0), (2.0, 5.0))
    (place / "requests" / "bad.json").write_text('{"coords": "none"}\n')
    serve(spark, place, store, model)
    assert answers(spark, place) == [(1.0, 73, True), (5.0, 27, False)]
    # what arrives later serves later requests only
    observe(spark, place, "2", (5.0, 2.0, "2021-08-19", 25))
    feed(spark, place, store)
    feed(spark, place, store)
    assert store.version().applied == {"feed": 1}
    ask(place, "2", (2.0, 5.0), (2.0, 1.0))
    serve(spark, place, store, model)
    serve(spark, place, store, model)
    assert answers(spark, place) == [(1.0, 73, True), (1.0, 73, True), (5.0, 27, False), (5.0, 73, True)]
    refused = BatchLog(spark, str(place / "out" / "rejected")).read(online.REJECTED).collect()
    assert len(refused) == 1


def test_a_batch_that_dies_is_served_again(spark, place, model, monkeypatch):
    store = create_store(spark, str(place / "store"), 2)
    ask(place, "1", (2.0, 1.0))
    real = online.BatchLog.write

    def dies(log, df, batch):
        if log.path.endswith("answers"):
            df.write.parquet(f"{log.path}/data/{batch:012d}-dead")
            raise OSError("executor lost")
        return real(log, df, batch)

    monkeypatch.setattr(online.BatchLog, "write", dies)
    with pytest.raises(Exception, match="executor lost"):
        serve(spark, place, store, model)
    assert answers(spark, place) == []
    monkeypatch.undo()
    serve(spark, place, store, model)
    assert answers(spark, place) == [(1.0, 27, False)]


def test_a_batch_is_written_once(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"))
    assert log.read("id long").count() == 0 and not log.done(0)
    assert log.write(spark.range(3), 0) and not log.write(spark.range(5), 0) and log.write(spark.range(2), 7)
    assert log.read("id long").count() == 5 and log.read("id long", first=1).count() == 2
    # another writer publishes first
    slow = BatchLog(spark, str(tmp_path / "log"))
    slow.done = lambda batch: False
    assert not slow.write(spark.range(9), 7) and log.read("id long").count() == 5


def test_missing_places_are_listed_once(spark, place):
    store = create_store(spark, str(place / "store"), 2)
    observe(spark, place, "1", (1.0, 2.0, "2021-08-19", 20))
    feed(spark, place, store)

    def run():
        requests = online.read_requests(spark, str(place / "requests"), 1)
        online.ask_missing(requests, store, str(place / "out"), str(place / "check-ask")).awaitTermination()
        rows = BatchLog(spark, str(place / "out" / "missing")).read(online.MISSING).collect()
        return sorted((r["key_lat"], r["key_lon"], str(r["key_day"])) for r in rows)

    ask(place, "1", (2.0, 1.0), (2.0, 5.0), (2.0, 5.0))
    ask(place, "2", (2.0, 5.0), (3.0, 5.0))
    assert run() == [(5.0, 2.0, "2021-08-19"), (5.0, 3.0, "2021-08-19")]
    ask(place, "3", (2.0, 5.0), (2.0, 7.0))
    assert run() == [(5.0, 2.0, "2021-08-19"), (5.0, 3.0, "2021-08-19"), (7.0, 2.0, "2021-08-19")]


def test_late_observations_answer_waiting_requests(spark, place, model):
    store = create_store(spark, str(place / "store"), 2)

    def late():
        requests = online.read_requests(spark, str(place / "requests"), 1)
        rows = online.read_observations(spark, str(place / "observations"), 1)
        online.serve_late(requests, rows, model, str(place / "out"), str(place / "check-late")).awaitTermination()

    observe(spark, place, "0", (9.0, 9.0, "2021-08-19", 3))
    ask(place, "1", (2.0, 5.0), (2.0, 6.0))
    serve(spark, place, store, model)
    late()
    assert answers(spark, place) == [(5.0, 27, False), (6.0, 27, False)]
    # the observation comes after the request, in a run of its own
    observe(spark, place, "1", (5.0, 2.0, "2021-08-19 23:00:00", 30))
    late()
    late()
    assert answers(spark, place) == [(5.0, 73, True), (6.0, 27, False)]
