from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pelagia.operators import surface
from pelagia.plans import classify as plans
from pelagia.plans import model, training
from pelagia.schemas import WEATHER_PARAMETERS
from pelagia.streaming.classify_stream import classify_stream, read_request_stream


@pytest.fixture(scope="module")
def rows(spark):
    """Presence where it is warm and shallow; years 2022 to 2025."""
    warm = (F.col("id") * 37 % 100) / 100 * 30
    deep = (F.col("id") * 53 % 100) / 100 * 1000
    return spark.range(800).select(
        F.lit(1.0).alias("lat"),
        F.lit(2.0).alias("lon"),
        F.make_date((F.col("id") % 4 + 2022).cast("int"), F.lit(6), F.lit(1))
        .cast("timestamp_ntz")
        .alias("date"),
        warm.alias("temperature"),
        deep.alias("ocean_depth"),
        ((warm > 15) & (deep < 500)).cast("int").alias("label"),
    )


FEATURES = ["lat", "lon", "temperature", "ocean_depth"]


@pytest.fixture(scope="module")
def fitted(rows):
    train_set, _ = model.temporal_split(rows)
    return model.train(train_set, maxIter=5, maxDepth=3)


def test_split(rows):
    train_set, test = model.temporal_split(rows)
    assert (train_set.count(), test.count()) == (400, 400)
    on_the_day = rows.limit(1).withColumn("date", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert [df.count() for df in model.temporal_split(on_the_day)] == [0, 1]
    with pytest.raises(ValueError, match="date"):
        model.temporal_split(rows.drop("date"))


def test_learns_and_reports(rows, fitted):
    train_set, test = model.temporal_split(rows)
    assert model.feature_names(fitted) == FEATURES
    report, accuracies = model.evaluate(fitted, test, train_set)
    both = {r["part"]: r["accuracy"] for r in accuracies.collect()}
    assert both["test"] > 0.95 and both["train"] > 0.95
    table = {r["class"]: r for r in report.collect()}
    assert table["accuracy"]["f1"] == pytest.approx(both["test"])
    scored = model.score(test, fitted)
    assert scored.filter("probability < 0 or probability > 1 or prediction not in (0, 1)").count() == 0
    with pytest.raises(RuntimeError):
        model.score(test, None)
    with pytest.raises(ValueError):
        model.evaluate(None, test, train_set)


def test_importance(spark, fitted):
    ranked = model.importance(fitted, spark).collect()
    assert {r["feature"] for r in ranked[:2]} == {"temperature", "ocean_depth"}
    weights = [r["importance"] for r in ranked]
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1)


def test_save_and_load(rows, fitted, tmp_path):
    path = str(tmp_path / "model")
    model.save(fitted, path)
    again = model.load(path)
    a, b = (model.score(rows, m).select("probability").collect() for m in (fitted, again))
    assert a == b
    with pytest.raises(ValueError):
        model.save(None, path)
    with pytest.raises(Exception, match="(?i)path|exist"):
        model.load(str(tmp_path / "nothing"))


def test_run_training(rows, tmp_path):
    path = str(tmp_path / "kept")
    run = training.run_training(rows, path, datetime(2024, 1, 1), FEATURES, maxIter=2, maxDepth=2)
    assert model.feature_names(model.load(path)) == model.feature_names(run.model) == FEATURES
    assert run.report.count() == 5


def test_raw_scores_stand_in_for_probabilities(rows):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import VectorAssembler

    stages = [VectorAssembler(inputCols=FEATURES, outputCol="features"), LinearSVC(maxIter=5)]
    scored = model.score(rows, Pipeline(stages=stages).fit(rows))
    ends = scored.agg(F.min("probability"), F.max("probability")).head()
    assert tuple(ends) == (0.0, 1.0)


def test_surface(rows, fitted):
    df = surface.surface(fitted, rows, "temperature", "ocean_depth", 7)
    got = {(r["i"], r["j"]): r["probability"] for r in df.collect()}
    assert len(got) == 49
    assert got[0, 6] > 0.5 > got[6, 0]
    points = surface.positives(rows, [("temperature", "ocean_depth")])
    assert points.count() == rows.filter("label = 1").count()
    with pytest.warns(UserWarning), pytest.raises(ValueError):
        surface.surface(fitted, rows, "temperature", "salinity")


@pytest.fixture(scope="module")
def store(spark):
    values = {"temperature": 25.0, "ocean_depth": 100.0}
    return spark.sql("select 12.25d lat, -41.5d lon, timestamp_ntz'2021-08-19 12:00:00' date").withColumns(
        {p: F.lit(values.get(p, 0.0)) for p in WEATHER_PARAMETERS}
    )


BODIES = [
    '{"coords": [[-41.5, 12.25], [7.75, -3.5]], "view": "list", "date": "2021-08-19T00:00:00"}',
    '{"coordinates": {"a": [-41.5, 12.25], "b": {"x": 1}}, "date": "2021-08-19T00:00:00", "depth": 870}',
    '{"coords": [[-41.5, 12.25]], "date": "2021-08-19T00:00:00", "deltas": {"deltaTemp": -20, "deltaClouds": 0, "deltaOceanDepth": 0}}',
]


def test_stream_equals_batch(spark, fitted, store, tmp_path):
    for i, body in enumerate(BODIES):
        (tmp_path / f"{i}.json").write_text(body + "\n")
    stream = read_request_stream(spark, str(tmp_path), files_per_batch=1)
    out = classify_stream(stream, store, fitted)
    query = (
        out.writeStream.format("memory")
        .queryName("scores")
        .option("checkpointLocation", str(tmp_path / "_state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    streamed = sorted((r["longitude"], r["latitude"], r["count"]) for r in spark.table("scores").collect())

    from pelagia.sources.requests import accepted, parse_requests

    texts = spark.createDataFrame(list(enumerate(BODIES)), "req_id long, value string")
    batch = plans.classify(accepted(parse_requests(texts)), store, fitted, spread=("req_id", "pos"))
    counted = batch.orderBy("req_id", "pos").collect()
    assert streamed == sorted((r["longitude"], r["latitude"], r["count"]) for r in counted)
    # warm and shallow; unknown place; asked depth; cooled
    assert counted[0]["count"] > 50
    assert all(r["count"] < 50 for r in counted[1:])
    assert len(counted) == 4


def test_clean_and_grid_options(spark, store):
    asked = spark.sql(
        """select 1 req_id, 12.25d latitude, -41.5d longitude, timestamp_ntz'2021-08-19 00:00:00' date,
        cast(null as int) depth, 0d d_temp, 0d d_clouds, 0d d_ocean"""
    )
    raw = store.withColumns({"clouds": F.lit(-666.0), "ocean_depth": F.lit(float("nan"))})
    names = ["clouds", "ocean_depth", "phyto"]
    kept = plans.request_features(asked, raw, names).head()
    assert kept["clouds"] == -666.0 and kept["ocean_depth"] != kept["ocean_depth"] and kept["phyto"] == 0.0
    grid = spark.sql("select 2021 year, 8 month, 0d lon, 0d lat, 0.5d chlor_a")
    cleaned = plans.request_features(asked, raw, names, clean=True, grid=grid).head()
    assert (cleaned["clouds"], cleaned["ocean_depth"], cleaned["phyto"]) == (0.0, 0.0, 0.5)


def test_training_and_scoring_take_the_same_cell(spark, store):
    """Of two values of a cell the first in the file counts in both."""
    from pelagia.operators.nearest import nearest_grid_value, with_month
    from pelagia.schemas import FILE_ORDER

    asked = spark.sql(
        """select 1 req_id, 12.25d latitude, -41.5d longitude, timestamp_ntz'2021-08-19 00:00:00' date,
        cast(null as int) depth, 0d d_temp, 0d d_clouds, 0d d_ocean"""
    )
    grid = spark.createDataFrame(
        [(2021, 8, 0.0, 0.0, 0.5, 0, 1), (2021, 8, 0.0, 0.0, 0.25, 0, 2)],
        f"year int, month int, lon double, lat double, chlor_a double, {FILE_ORDER[0]} long, {FILE_ORDER[1]} long",
    )
    scored = plans.request_features(asked, store, ["phyto"], grid=grid).head()["phyto"]
    points = with_month(asked.withColumnsRenamed({"latitude": "lat", "longitude": "lon"}))
    assert scored == nearest_grid_value(points, grid, ["req_id"]).head()["phyto"] == 0.5


def test_files_to_training_set(spark, tmp_path):
    """Sightings, weather parts and rasters from files, through to labelled rows."""
    import json
    from datetime import datetime

    from pelagia.plans.training import TrainingConfig, build_training_set
    from pelagia.sources import readers

    days = [f"2021-0{m}-0{d}" for m in (1, 2) for d in (2, 5, 8)]
    dated = [datetime.fromisoformat(d).strftime("%a, %d %b %Y 10:00:00 GMT") for d in days]
    rows = [{"date": t, "latitude": str(k), "longitude": 2 * k} for k, t in enumerate(dated)]
    rows.append({"date": dated[0], "latitude": "far out", "longitude": 1})
    (tmp_path / "sightings.json").write_text(json.dumps(rows))
    head = ",lat,lon,date," + ",".join(WEATHER_PARAMETERS)
    lines = [f"{k},{k}.0,{2 * k}.0,{d} 00:00:00,{k},1,2,3,4,-666" for k, d in enumerate(days)]
    (tmp_path / "weather_data_1.csv").write_text("\n".join([head, *lines[:3]]))
    (tmp_path / "weather_data_2.csv").write_text("\n".join([head, *lines[3:5]]))
    for month in (1, 2):
        name = f"S.20210{month}01_20210{month}28.a.csv"
        (tmp_path / name).write_text(f"lon,lat,chlor_a\n0,0,{month}\n")

    seen = readers.read_sightings(spark, str(tmp_path / "sightings.json"))
    weather = readers.read_observation_parts(spark, str(tmp_path / "weather_data*.csv"))
    grid = readers.read_monthly_grid(spark, str(tmp_path))

    def around(drawn):
        return drawn.select("lat", "lon", "date", *[F.lit(7.0).alias(p) for p in WEATHER_PARAMETERS])

    config = TrainingConfig(window=(datetime(2020, 1, 1), datetime(2022, 1, 1)))
    out = build_training_set(seen, weather, grid, around, config).collect()
    positive = sorted((r["lat"], r["lon"], r["temperature"], r["ocean_depth"], r["phyto"]) for r in out if r["label"])
    assert positive == [(float(k), 2.0 * k, float(k), 0.0, 1.0 if k < 3 else 2.0) for k in range(5)]
    assert sum(r["label"] == 0 for r in out) == 3 * (5 // 3)
    assert readers.rejected_sightings(seen).count() == 1


def test_drawn_points_are_measured(spark):
    """Points that are made from one row are no small side of a join: all of them would go through the driver."""
    from datetime import datetime

    from pelagia.plans.training import TrainingConfig, build_training_set

    place = [(F.col("id") % 60 / 10.0).alias("lat"), (F.col("id") / 200.0).alias("lon")]
    n = 3000
    seen = spark.range(n).select("id", F.lit("Sat, 02 Jan 2021 10:00:00 GMT").alias("raw_date"), *place)
    values = [F.lit(1.0).alias(p) for p in WEATHER_PARAMETERS]
    weather = spark.range(n).select(*place, F.lit("2021-01-02").cast("timestamp_ntz").alias("date"), *values)
    grid = spark.createDataFrame([(2021, 1, 0.0, 0.0, 1.0)], "year int, month int, lon double, lat double, chlor_a double")
    plans = []

    def around(drawn):
        joined = drawn.join(spark.range(10**9), "id")
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return drawn.select("lat", "lon", "date", *values)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    try:
        config = TrainingConfig(window=(datetime(2020, 1, 1), datetime(2022, 1, 1)), grid_unique=True)
        out = build_training_set(seen, weather, grid, around, config)
        labels = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert labels == {1: n, 0: n}
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
