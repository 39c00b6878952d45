from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from pelagia.operators import background, keyed, profile, report, surface, weather
from pelagia.schemas import WEATHER_PARAMETERS


def test_first_per_key_stops_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    first = keyed.first_per_key(df, ["k"], [F.desc("id")])
    assert sorted(r["id"] for r in first.collect()) == [997, 998, 999]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_sample_per_key(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id").filter("k <> 6 or id = 6")
    got = keyed.sample_per_key(df, ["k"], 3, 1, ["id"]).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {**{k: 3 for k in range(6)}, 6: 1}


def test_sample_beyond_the_limit_of_the_optimizer(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), "id")
    got = keyed.sample_per_key(df, ["k"], 1200, 1, ["id"])
    assert {r["k"]: r["count"] for r in got.groupBy("k").count().collect()} == {0: 1200, 1: 1200}
    plain = keyed._first_n(df, ["k"], [keyed.draw(1, F.col("id")), "id"], 1200)
    assert sorted(got.collect()) == sorted(plain.collect())


def test_numbers_are_complete_and_do_not_depend_on_partitions(spark):
    def numbered(parts, piece_rows):
        df = spark.range(0, 700, 1, parts)
        rows = keyed.number_rows(df, keyed.draw(3, F.col("id")), ["id"], piece_rows=piece_rows).collect()
        return [r["id"] for r in sorted(rows, key=lambda r: r["position"])], {r["position"] for r in rows}

    order, places = numbered(1, 44)
    assert places == set(range(700)) and order != sorted(order)
    assert numbered(4, 44)[0] == numbered(16, 700)[0] == numbered(16, 1)[0] == order


def test_daily_batches_of_a_crowded_day(spark):
    df = spark.range(1000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("2020-01-01 05:00:00"))
        .otherwise(F.concat(F.lit("2020-02-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")))
        .cast("timestamp_ntz")
        .alias("date"),
        F.col("id").cast("double").alias("lat"),
        F.lit(1.0).alias("lon"),
    )
    rows = keyed.daily_batches(df, ["id"], size=50).collect()
    assert all(r["n"] == len(r["points"]) <= 50 for r in rows)
    assert sorted(p["lat"] for r in rows for p in r["points"]) == [float(i) for i in range(1000)]
    crowded = [r for r in rows if str(r["day"]).startswith("2020-01-01")]
    assert sorted(r["n"] for r in crowded) == [34] + [50] * 6


def test_group_slice_ends(spark):
    df = spark.sql("select timestampadd(HOUR, id * 12, timestamp_ntz'2020-01-01 00:00:00') date from range(10)")
    def size(lo, hi):
        return keyed.group_slice(df, lo, hi).count()
    assert (size(0, 100), size(1, 3), size(4, 5), size(5, 9), size(0, 0)) == (10, 4, 2, 0, 0)


def observation(id, lat, lon, date, value):
    return (id, lat, lon, date, *[float(value + i) for i in range(6)])


OBSERVATION = "n int, lat double, lon double, date string, " + ", ".join(
    f"{p} double" for p in WEATHER_PARAMETERS
)


def observed(spark, *rows):
    return spark.createDataFrame([observation(*r) for r in rows], OBSERVATION).withColumn(
        "date", F.col("date").cast("timestamp_ntz")
    )


def test_weather_match_keeps_requests_and_takes_the_first(spark):
    store = observed(
        spark, (2, 1.0, 2.0, "2020-01-01 06:00:00", 20), (1, 1.0, 2.0, "2020-01-01 18:00:00", 10)
    )
    asked = spark.createDataFrame(
        [(1, 1.0, 2.000001, "2020-01-01 23:00:00"), (2, 1.0, 2.0, "2020-01-02"), (3, None, 2.0, "2020-01-01")],
        "req_id int, latitude double, longitude double, date string",
    ).withColumn("date", F.col("date").cast("timestamp_ntz"))
    got = weather.weather_match(asked, store, ["n"], ["req_id"]).orderBy("req_id").collect()
    assert [(r["found"], r["temperature"]) for r in got] == [(True, 10.0), (False, None), (False, None)]
    points = asked.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    assert weather.attach_weather(points, store, ["n"], ["req_id"]).count() == 1
    assert weather.missing_keys(asked, store).count() == 2


def test_store_depth_stands_in_for_ocean_depth(spark):
    store = observed(spark, (1, 1.0, 2.0, "2020-01-01", 10)).withColumns(
        {"ocean_depth": F.lit(None).cast("double"), "depth": F.lit(77.0)}
    )
    assert weather.weather_by_key(store, ["n"]).head()["ocean_depth"] == 77.0


def test_upsert(spark):
    store = observed(spark, (9, 1.0, 2.0, "2020-01-01", 10), (1, 5.0, 5.0, "2020-01-01", 11))
    new = observed(spark, (1, 1.0, 2.0, "2020-01-01", 20), (2, 1.0, 2.0, "2020-01-01", 30), (1, 8.0, 8.0, "2020-01-01", 40))
    got = weather.upsert(store, new, ["n"])
    assert got.columns == store.columns
    assert sorted(r["temperature"] for r in got.collect()) == [11.0, 30.0, 40.0]


def test_upsert_of_nothing_changes_nothing(spark):
    raw = observed(spark, (9, 1.0, 2.0, "2020-01-01", 10), (1, 5.0, 5.0, "2020-01-01", 11))
    for store in (raw, weather.weather_by_key(raw, ["n"])):
        got = weather.upsert(store, raw.limit(0), ["n"])
        assert got.columns == store.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, store.collect()))
    with pytest.raises(ValueError, match="key_lat"):
        weather.upsert(raw.drop("lat"), raw, ["n"])


def test_keyed_store(spark, tmp_path):
    raw = observed(spark, (9, 1.0, 2.0, "2020-01-01", 10), (1, 5.0, 5.0, "2020-01-03", 11))
    weather.weather_by_key(raw, ["n"]).write.parquet(str(tmp_path / "store"))
    store = spark.read.parquet(str(tmp_path / "store"))
    new = observed(spark, (1, 1.0, 2.0, "2020-01-01", 20))
    assert sorted(r["temperature"] for r in weather.upsert(store, new, ["n"]).collect()) == [11.0, 20.0]
    plan = weather.upsert(store, new, ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 2 and "LeftAnti" in plan
    asked = spark.sql("select 1 req_id, 1d latitude, 2d longitude, timestamp_ntz'2020-01-01 09:00:00' date")
    assert weather.missing_keys(asked, store).isEmpty()
    # twice the same keys: one answer for each request
    twice = store.unionByName(store)
    assert weather.weather_match(asked, twice, ["date"], ["req_id"]).count() == 1


def test_only_asked_days_are_read(spark, tmp_path):
    raw = observed(spark, (9, 1.0, 2.0, "2020-01-01", 10), (1, 5.0, 5.0, "2020-01-03", 11))
    asked = spark.sql("select 1 req_id, 1d latitude, 2d longitude, timestamp_ntz'2020-01-01 09:00:00' date")
    for name, df, pushed in (
        ("raw", raw, "GreaterThanOrEqual(date,2020-01-01T00:00)"),
        ("keyed", weather.weather_by_key(raw, ["n"]), "(key_day,2020-01-01)"),
    ):
        df.write.parquet(str(tmp_path / name))
        stored = spark.read.parquet(str(tmp_path / name))
        got = weather.weather_match(asked, stored, ["date"], ["req_id"])
        spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
        plan = got._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        assert pushed in plan
        assert got.head()["temperature"] == 10.0


def test_stack_keeps_duplicates(spark):
    a, b = spark.sql("select 1 x, 2 y"), spark.sql("select 3 z, 1 x")
    rows = sorted(map(str, weather.stack(a, b, a).select("x", "y", "z").collect()))
    assert rows == ["Row(x=1, y=2, z=None)"] * 2 + ["Row(x=1, y=None, z=3)"]


def test_background_points(spark):
    n = spark.range(2_500).agg(F.count("*")).scalar()
    lazy = background.uniform_points(spark, n)
    assert sorted(lazy.collect()) == sorted(background.uniform_points(spark, 2_500).collect())
    assert lazy.filter("lat >= -70 and lat < 70 and lon >= -100 and lon < 25").count() == 2_500
    assert background.uniform_points(spark, F.lit(0)).count() == 0


def test_chunks_of_ids(spark, monkeypatch):
    monkeypatch.setattr(background, "CHUNK", 7)
    ids = background.running_ids(spark, F.lit(50))
    assert sorted(r["id"] for r in ids.collect()) == list(range(50))


def test_days_per_batch(spark):
    def stamp(text):
        return F.lit(text).cast("timestamp_ntz")

    points = background.uniform_points(spark, 250)
    days = background.draw_days(points, stamp("2020-01-01 06:00:00"), stamp("2020-01-11 05:00:00"))
    assert days.count() == 750
    per_batch = days.groupBy("round", "batch").agg(F.count_distinct("date").alias("n"), F.min("date").alias("d"))
    assert [r["n"] for r in per_batch.collect()] == [1] * 9
    # nine whole days, the last one excluded
    assert days.filter("date < '2020-01-01 06:00:00' or date > '2020-01-09 06:00:00'").count() == 0
    same = background.draw_days(points, stamp("2020-01-01"), stamp("2020-01-01"))
    assert same.select("date").distinct().count() == 1


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999, 1000])
def test_medians(spark, n):
    rng = random.Random(n)
    rows = [
        (rng.gauss(0, 1), rng.choice([-1.0, -1.0, 5.0]), None if i % 2 else float(i), float("nan"))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    for accuracy, bins, most in ((10_000, 4096, 1000), (20, 3, 1000), (20, 3, 1)):
        got = profile.feature_medians(df, ["a", "b", "c", "d"], accuracy, bins, most)
        want = {
            "a": statistics.median(r[0] for r in rows),
            "b": statistics.median(r[1] for r in rows),
            "c": statistics.median([r[2] for r in rows if r[2] is not None]),
        }
        assert {r["feature"]: r["median"] for r in got.collect()} == pytest.approx(want, abs=1e-12)


def test_median_of_a_heavy_tail_in_sorted_parts(spark, monkeypatch):
    """The last bracket is small, wherever the sketches put the first one."""
    df = spark.range(0, 40_000, 1, 8).select(F.exp(F.col("id") / 2000).alias("a"))
    seen = []
    counted = profile._bin_counts

    def spy(df, state, bins):
        out = counted(df, state, bins)
        seen.append(out["a"])
        return out

    monkeypatch.setattr(profile, "_bin_counts", spy)
    got = profile.feature_medians(df, ["a"], most=100).head()["median"]
    values = [r["a"] for r in df.collect()]
    assert got == statistics.median(values)
    assert len(seen) > 1 and max(size for size, lo, hi in seen[-1] if lo <= got <= hi) <= 100


def test_profiles(spark):
    df = spark.createDataFrame([(0.0, 1.0), (4.0, None), (float("nan"), 3.0)], "x double, y double")
    assert [tuple(r) for r in profile.feature_ranges(df, ["x", "y"]).collect()] == [
        ("x", -0.4, 4.4),
        ("y", 0.8, 3.2),
    ]
    assert [tuple(r) for r in profile.null_profile(df).collect()] == [(0, "x", 1, 3), (1, "y", 1, 3)]
    assert tuple(profile.coverage(df, "y").head())[:2] == (3, 2)
    assert tuple(profile.coverage(df.limit(0), "y").head()) == (0, 0, None)
    empty = df.limit(0).withColumnsRenamed({"x": "latitude", "y": "longitude"})
    assert tuple(profile.center(empty).head()) == (0.0, 0.0)


def test_report_by_hand(spark):
    # class 2 is never predicted, class 3 is never a label
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] + [(2, 0)] * 2 + [(1, 3)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    got = {r["class"]: r for r in report.classification_report(df).collect()}
    assert set(got) == {"0", "1", "2", "3", "accuracy", "macro avg", "weighted avg"}
    p0, r0 = 5 / 8, 5 / 7
    assert got["0"]["precision"] == pytest.approx(p0)
    assert got["0"]["recall"] == pytest.approx(r0)
    assert got["0"]["f1"] == pytest.approx(2 * p0 * r0 / (p0 + r0))
    assert (got["2"]["precision"], got["2"]["recall"], got["2"]["support"]) == (0.0, 0.0, 2)
    assert (got["3"]["recall"], got["3"]["support"]) == (0.0, 0)
    assert got["accuracy"]["f1"] == pytest.approx(8 / 14)
    assert got["macro avg"]["recall"] == pytest.approx((5 / 7 + 3 / 5) / 4)
    assert got["weighted avg"]["recall"] == pytest.approx(8 / 14)
    assert report.accuracy(df).head()["accuracy"] == pytest.approx(8 / 14)


def test_pairs():
    assert surface.feature_pairs("abc") == [("a", "b"), ("a", "c"), ("b", "c")]
    with pytest.warns(UserWarning, match="skipping"):
        assert surface.known_pairs([("a", "x"), ("a", "b")], "ab") == [("a", "b")]


def test_feature_grid(spark):
    df = spark.createDataFrame([(0.0, 10.0, 1.0), (10.0, 20.0, 2.0), (4.0, 12.0, 9.0)], "a double, b double, c double")
    rows = surface.feature_grid(df, ["a", "b", "c"], [("a", "b"), ("c", "a")], 5).collect()
    assert len(rows) == 50
    first = next(r for r in rows if r["feature1"] == "a" and r["i"] == 0 and r["j"] == 4)
    assert (first["a"], first["b"], first["c"]) == (11.0, 9.0, 2.0)
    second = next(r for r in rows if r["feature1"] == "c" and r["i"] == 4 and r["j"] == 0)
    assert (second["c"], second["a"], second["b"]) == pytest.approx((0.2, 11.0, 12.0))


def counting(spark, df):
    """The frame, and how often each of its rows has been worked out."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(passed, df.schema), seen


def test_medians_work_their_table_out_once(spark):
    df, seen = counting(spark, spark.range(1000).select(F.col("id").cast("double").alias("a"), (-F.col("id")).alias("b")))
    got = {r["feature"]: r["median"] for r in profile.feature_medians(df, ["a", "b"], most=10).collect()}
    assert got == {"a": 499.5, "b": -499.5} and seen.value == 1000


def test_asking_does_not_work_observations_out_for_their_number(spark, monkeypatch):
    def counted(*_):
        raise AssertionError("the observations are counted")

    monkeypatch.setattr(weather.joins, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(weather.joins, "has_at_most", counted)
    stored = observed(spark, *[(k, float(k), 2.0, "2020-01-01", k) for k in range(20)])
    df, seen = counting(spark, stored)
    asked = spark.range(3).selectExpr("id req_id", "double(id) latitude", "2d longitude", "timestamp_ntz'2020-01-01' date")
    assert weather.weather_match(asked, df, ["n"], ["req_id"]).filter("found").count() == 3 and seen.value == 20
    points = asked.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    assert weather.attach_weather(points, df, ["n"], ["req_id"]).count() == 3 and seen.value == 40


def test_many_points_are_matched_without_moving_all_observations(spark, monkeypatch):
    # several observations of each place and day, some without one, and points that ask twice or nowhere
    rows = [(n, None if k == 5 else float(k), 2.0, f"2020-01-0{1 + k % 3}", 10 * k + n) for k in range(30) for n in (2, 1, 3)]
    stored = observed(spark, *rows)
    asked = spark.range(60).selectExpr(
        "id req_id", "if(id = 7, null, double(id div 2)) latitude", "2d longitude",
        "timestamp_ntz'2020-01-01' + make_dt_interval((id div 2) % 3, 5) date",
    )
    points = asked.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})

    def got():
        matched = weather.weather_match(asked, stored, ["n"], ["req_id"])
        attached = weather.attach_weather(points, stored, ["n"], ["req_id"])
        plan = matched._jdf.queryExecution().optimizedPlan().toString()
        return sorted(map(str, matched.collect())), sorted(map(str, attached.collect())), "LeftSemi" in plan

    few = got()
    monkeypatch.setattr(weather.joins, "BROADCAST_ROWS", 1)
    many = got()
    assert few[:2] == many[:2] and few[2] and not many[2] and len(few[0]) == 60 and len(few[1]) == 57
