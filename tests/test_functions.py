from __future__ import annotations

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pelagia.functions.coords import given, in_bbox, point_label, to_number, with_coord_key
from pelagia.functions.dates import day, has_date, in_window, parse_iso, parse_rfc1123
from pelagia.functions.draws import draw, draw_index
from pelagia.functions.features import (
    apply_scenario,
    clean_features,
    feature_columns,
    model_rows,
    scale_parameters,
)
from pelagia.functions.scoring import minmax_scores, score_count, to_class
from pelagia.schemas import DEFAULT_FEATURES, Box


def one(df):
    return [r[0] for r in df.collect()]


def test_dates(spark):
    texts = ["Mon, 05 Jan 2021 10:00:00 GMT", "Tue, 5 feb 2021 1:02:03 GMT", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    assert one(df.select(parse_rfc1123(F.col("raw")))) == [
        datetime(2021, 1, 5, 10),
        datetime(2021, 2, 5, 1, 2, 3),
        None,
        None,
    ]
    assert df.filter(has_date(F.col("raw"))).count() == 2


@pytest.mark.parametrize("text", ["bad", "05 Jan 2021 10:00:00 GMT", "Xyz, 05 Jan 2021 10:00:00 GMT"])
def test_malformed_date_raises(spark, text):
    df = spark.createDataFrame([(text,)], "raw string")
    with pytest.raises(Exception, match="(?i)parse|format"):
        df.select(parse_rfc1123(F.col("raw"))).collect()


def test_iso_dates(spark):
    texts = ["2023-01-05T00:00:00", "2023-01-05T23:30:00+02:00", "2023-01-05T01:00:00Z", "soon"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    assert one(df.select(parse_iso(F.col("raw")))) == [
        datetime(2023, 1, 5),
        datetime(2023, 1, 5, 23, 30),
        datetime(2023, 1, 5, 1),
        None,
    ]


def test_window_excludes_both_ends(spark):
    rows = ["2020-01-01 00:00:00", "2020-01-01 00:00:01", "2024-12-31 23:59:59", "2025-01-01 00:00:00"]
    df = spark.createDataFrame([(r,) for r in rows], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("d")
    )
    lo, hi = datetime(2020, 1, 1), datetime(2025, 1, 1)
    assert df.filter(in_window(F.col("d"), lo, hi)).count() == 2
    assert df.filter(in_window(F.col("d"), lo, None)).count() == 3
    assert df.filter(in_window(F.col("d"), None, None)).count() == 4
    assert one(df.select(day(F.col("d"))))[2] == datetime(2024, 12, 31)


def test_box_includes_its_edges(spark):
    points = [(-70.0, -100.0), (70.0, 25.0), (70.01, 0.0), (0.0, 25.01), (None, 0.0)]
    df = spark.createDataFrame(points, "lat double, lon double")
    assert df.filter(in_bbox(F.col("lat"), F.col("lon"), Box())).count() == 2


def test_coordinates(spark):
    df = spark.createDataFrame(
        [("1.5", 0.0), ("x", 2.0), ("", None), ("1d", 1.0), (None, 1.0), ("-2e3", 1.0)],
        "t string, v double",
    )
    assert one(df.select(to_number(F.col("t")))) == [1.5, None, None, None, None, -2000.0]
    assert one(df.select(F.coalesce(given(F.col("v")), F.lit(False))))[:3] == [False, True, False]
    keyed = spark.sql("select 1.0000049d lat, -2.000004d lon, timestamp_ntz'2020-05-06 07:08:09' date")
    row = with_coord_key(keyed).head()
    assert (row["key_lat"], row["key_lon"], str(row["key_day"])) == (1.0, -2.0, "2020-05-06")
    label = keyed.select(point_label(F.col("date"), F.col("lat"), F.col("lon")))
    assert one(label) == ["Date: 2020-05-06 07:08:09<br>Location: (1.0000049, -2.000004)"]


def test_draws_do_not_depend_on_partitions(spark):
    def rows(parts):
        df = spark.range(0, 500, 1, parts).select("id", draw(7, F.col("id")).alias("u"))
        return sorted(df.collect())

    assert rows(1) == rows(4) == rows(16)
    values = [r["u"] for r in rows(4)]
    assert 0 <= min(values) and max(values) < 1 and 0.45 < sum(values) / 500 < 0.55
    picks = one(spark.range(500).select(draw_index(F.lit(3), "x", F.col("id"))))
    assert set(picks) == {0, 1, 2}


def test_clean_leaves_no_marker(spark):
    df = spark.createDataFrame(
        [(None, -666, "-666"), (float("nan"), 1, None), (-666.0, None, "a"), (-666.5, 2, "b")],
        "x double, n int, s string",
    )
    assert [tuple(r) for r in clean_features(df).collect()] == [
        (0.0, 0, "-666"),
        (0.0, 1, None),
        (0.0, 0, "a"),
        (-666.5, 2, "b"),
    ]
    assert clean_features(df, ["n"]).head()["x"] is None


def test_factors(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "temperature double, clouds double")
    assert tuple(scale_parameters(df).head()) == (2.0, 3.0)
    assert tuple(scale_parameters(df, {"clouds": 2}).head()) == (2.0, 6.0)
    with pytest.raises(ValueError):
        scale_parameters(df, {"depth": 2})


def scenario_by_hand(temperature, clouds, ocean, depth, deltas):
    d_temp, d_clouds, d_ocean = deltas or (0.0, 0.0, 0.0)
    base = depth if depth is not None else (ocean if ocean is not None else 0.0)
    scaled = float(base) * (1.0 + d_ocean)
    fed = float(depth) if depth is not None else scaled
    return (temperature or 0.0) + d_temp, (clouds or 0.0) + d_clouds, scaled, fed


def test_scenario_combinations(spark):
    cases = list(
        itertools.product([None, (20.0, 4.0, 800.0)], [None, 50], [None, (1.5, -1.0, 0.25)])
    )
    rows, want = [], []
    for i, (found, depth, deltas) in enumerate(cases):
        t, c, o = found or (None, None, None)
        rows.append((i, 10.0, -5.0, t, c, o, depth, *(deltas or (None,) * 3)))
        want.append(scenario_by_hand(t, c, o, depth, deltas))
    schema = """i int, latitude double, longitude double, temperature double, clouds double,
        ocean_depth double, depth int, d_temp double, d_clouds double, d_ocean double"""
    df = apply_scenario(spark.createDataFrame(rows, schema)).orderBy("i")
    fed = model_rows(df, [*DEFAULT_FEATURES, "phyto"]).orderBy("i").collect()
    for got, row, (t, c, scaled, o) in zip(df.collect(), fed, want):
        assert (got["temperature"], got["clouds"], got["ocean_depth"]) == (t, c, scaled)
        assert (row["temperature"], row["clouds"], row["ocean_depth"]) == (t, c, o)
        assert (row["lat"], row["lon"], row["phyto"], row["mean_wave_direction"]) == (10.0, -5.0, 0.0, 0.0)
    kept = model_rows(df, DEFAULT_FEATURES, depth_delta="always").orderBy("i").collect()
    assert [r["ocean_depth"] for r in kept] == [w[2] for w in want]
    with pytest.raises(ValueError):
        model_rows(df, DEFAULT_FEATURES, depth_delta="never")


def test_feature_columns(spark):
    df = spark.sql("select 1d lat, current_date() date, 2d phyto, 1 label, 5 position")
    assert feature_columns(df, drop=["position"]) == ["lat", "phyto"]


def test_percent_rounds_half_to_even(spark):
    df = spark.createDataFrame(
        [(0.005, 1), (0.125, 0), (0.5, 1), (1.0, 1), (0.015, 0), (None, 1)], "p double, c int"
    )
    got = one(df.select(score_count(F.col("p"), F.col("c"))))
    assert got == [round(p * 100) if p is not None else 1 for p in (0.005, 0.125, 0.5, 1.0, 0.015, None)]
    assert one(df.select(to_class(F.col("p")))) == [0, 0, 1, 1, 0, None]


def test_minmax(spark):
    df = spark.createDataFrame([(2.0,), (4.0,), (6.0,), (None,)], "s double")
    assert one(minmax_scores(df, "s").select("probability")) == [0.0, 0.5, 1.0, None]
    assert one(minmax_scores(df.filter("s = 2"), "s").select("probability")) == [0.0]
