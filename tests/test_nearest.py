"""The two-step nearest lookup against plain searches over the axis."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pelagia.operators import joins
from pelagia.operators.nearest import (
    GridIndex,
    build_grid_index,
    month_match,
    nearest_grid_value,
    one_row_per_cell,
    wanted_months,
)

POINT = "id long, year int, month int, lon double, lat double"
CELL = "year int, month int, lon double, lat double, chlor_a double"


def closest(axis, target: float) -> float:
    """By trying every value; of two at the same distance the larger."""
    return min(axis, key=lambda v: (abs(target - v), -v))


def expected(points, cells):
    out = {}
    for id, year, month, lon, lat in points:
        own = [c for c in cells if c[:2] == (year, month)]
        if not own or lon is None:
            out[id] = (None, None, None)
            continue
        c_lon = closest({c[2] for c in own}, lon)
        column = [c for c in own if c[2] == c_lon]
        if lat is None:
            out[id] = (c_lon, None, None)
            continue
        c_lat = closest({c[3] for c in column}, lat)
        out[id] = (c_lon, c_lat, min(c[4] for c in column if c[3] == c_lat))
    return out


def found(df):
    return {r["id"]: (r["c_lon"], r["c_lat"], r["phyto"]) for r in df.collect()}


def run(spark, points, cells, **options):
    return found(
        nearest_grid_value(
            spark.createDataFrame(points, POINT), spark.createDataFrame(cells, CELL), ["id"], **options
        )
    )


@pytest.mark.parametrize(
    "target, answer",
    [(-5, 0), (0, 0), (4, 0), (5, 10), (6, 10), (10, 10), (14.9, 10), (25, 20), (-400, 0), (400, 20)],
)
def test_one_axis(spark, target, answer):
    cells = [(2020, 1, float(x), 0.0, float(x)) for x in (0, 10, 20)]
    cells += [(2020, 1, 0.0, float(y), 100.0 + y) for y in (10, 20)]
    by_lon = run(spark, [(1, 2020, 1, float(target), 0.0)], cells)
    assert by_lon[1] == (answer, 0.0, answer)
    by_lat = run(spark, [(1, 2020, 1, -3.0, float(target))], cells)
    assert by_lat[1][:2] == (0.0, answer)


def test_longitude_goes_first(spark):
    # the cell at (1, 0) is closer, but its longitude is not the nearest one
    cells = [(2020, 1, 0.0, 50.0, 1.0), (2020, 1, 1.0, 0.0, 2.0)]
    assert run(spark, [(1, 2020, 1, 0.4, 0.0)], cells)[1] == (0.0, 50.0, 1.0)


def test_missing_month_single_cell_and_empty_targets(spark):
    cells = [(2020, 1, 3.0, 4.0, 0.5), (2020, 2, 1.0, 1.0, 9.0)]
    points = [
        (1, 2020, 1, -170.0, 80.0),
        (2, 2021, 1, 3.0, 4.0),
        (3, 2020, 1, None, 4.0),
        (4, 2020, 1, 3.0, None),
        (5, 2020, 1, float("nan"), 4.0),
    ]
    got = run(spark, points, cells)
    assert got[1] == (3.0, 4.0, 0.5)
    assert got[2] == got[3] == got[5] == (None, None, None)
    assert got[4] == (3.0, None, None)


def test_duplicate_cells_take_the_first_in_order(spark):
    grid = spark.createDataFrame(
        [(2020, 1, 0.0, 0.0, 7.0, 2), (2020, 1, 0.0, 0.0, 9.0, 1)], CELL + ", row int"
    )
    assert one_row_per_cell(grid, order=["row"]).head()["chlor_a"] == 9.0
    assert one_row_per_cell(grid).head()["chlor_a"] == 7.0
    points = spark.createDataFrame([(1, 2020, 1, 0.0, 0.0)], POINT)
    assert found(nearest_grid_value(points, grid, ["id"], order=["row"]))[1][2] == 9.0


def random_case(seed, n=600, hot=0.4):
    """Points of which a good part crowds around one cell; an uneven grid."""
    rng = random.Random(seed)
    cells = []
    for month in (1, 2, 3):
        lons = [rng.choice([rng.uniform(-180, 180), rng.uniform(10, 11)]) for _ in range(25)]
        for lon in lons:
            for _ in range(rng.randint(1, 12)):
                lat = rng.choice([rng.uniform(-90, 90), rng.uniform(0, 0.01), rng.randint(-9, 9) * 10.0])
                cells.append((2020, month, lon, lat, rng.random()))
    axis = sorted({c[2] for c in cells})
    points = []
    for id in range(n):
        if rng.random() < hot:
            lon, lat = 10.5 + rng.uniform(-1e-3, 1e-3), 0.005 + rng.uniform(-1e-3, 1e-3)
            points.append((id, 2020, 1, lon, lat))
        else:
            a, b = rng.sample(axis, 2)
            lon = rng.choice([rng.uniform(-200, 200), a, (a + b) / 2])
            points.append((id, 2020, rng.randint(1, 4), lon, rng.uniform(-95, 95)))
    return points, cells


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_grids(spark, seed):
    points, cells = random_case(seed)
    assert run(spark, points, cells) == expected(points, cells)


def test_axis_from_0_to_360_has_few_intervals_in_a_bin(spark):
    """By default a bin is as wide as the grid's longitudes lie apart, wherever they lie."""
    from pelagia.operators import nearest

    cells = spark.range(720).select(
        F.lit(2020).alias("year"), F.lit(1).alias("month"), (F.col("id") / 2).alias("g_lon"), F.lit(0.0).alias("g_lat")
    )
    axis = nearest.lon_axis(cells, nearest.MONTH)
    listed = nearest.lon_intervals(axis, nearest.MONTH, *nearest._axis_bins(axis, None))
    assert listed.groupBy("__bin").count().agg(F.max("count")).head()[0] <= 3


@pytest.mark.parametrize("lon_bin", [0.25, 7.5, None])
def test_random_grids_by_shuffle_with_crowded_points(shuffled, lon_bin):
    points, cells = random_case(4)
    df = shuffled.createDataFrame(points, POINT)
    hot = joins.frequent_keys(df, ["year", "month"], 16)
    assert max(hot.values()) >= 6
    got = run(shuffled, points, cells, broadcast_rows=0, lon_bin=lon_bin)
    assert got == expected(points, cells)


def test_window_form_agrees(spark):
    """Longitude step once more, by carrying the neighbours along a sorted union."""
    points, cells = random_case(5)
    p, g = spark.createDataFrame(points, POINT), spark.createDataFrame(cells, CELL)
    axis = g.select("year", "month", F.col("lon").alias("v")).distinct()
    both = p.select("id", "year", "month", F.col("lon").alias("v")).unionByName(
        axis.withColumn("axis", F.col("v")), allowMissingColumns=True
    )
    w = Window.partitionBy("year", "month").orderBy("v")
    below = F.last("axis", True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    above = F.first("axis", True).over(w.rangeBetween(0, Window.unboundedFollowing))
    near = F.when(
        F.col("b").isNotNull() & (F.col("a").isNull() | (F.col("v") - F.col("b") < F.col("a") - F.col("v"))),
        F.col("b"),
    ).otherwise(F.col("a"))
    carried = both.withColumns({"b": below, "a": above}).filter("id is not null")
    second = {r["id"]: r["near"] for r in carried.select("id", near.alias("near")).collect()}
    got = found(nearest_grid_value(p, g, ["id"]))
    assert {k: v[0] for k, v in got.items()} == second


def test_never_farther_than_another_longitude(spark):
    points, cells = random_case(6)
    got = run(spark, points, cells)
    for id, year, month, lon, _ in points:
        axis = {c[2] for c in cells if c[:2] == (year, month)}
        if axis:
            assert abs(got[id][0] - lon) <= min(abs(x - lon) for x in axis)


def test_grid_is_narrowed_to_the_months_of_the_points(spark, tmp_path):
    points, cells = random_case(8)
    path = str(tmp_path / "grid")
    spark.createDataFrame(cells, CELL).write.partitionBy("year", "month").parquet(path)
    some = spark.createDataFrame([p for p in points if p[2] == 2], POINT)
    narrow = wanted_months(some, spark.read.parquet(path))
    assert {(r["year"], r["month"]) for r in narrow.select("year", "month").distinct().collect()} == {(2020, 2)}
    scan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in scan and "(month#" in scan
    got = found(nearest_grid_value(some, spark.read.parquet(path), ["id"]))
    assert got == expected([p for p in points if p[2] == 2], cells)


def test_month_match_keeps_every_point(spark):
    points, cells = random_case(7)
    rows = month_match(
        spark.createDataFrame(points, POINT), spark.createDataFrame(cells, CELL)
    ).collect()
    assert len(rows) == len(points)
    assert all(r["has_grid"] == (r["month"] != 4) for r in rows)


def test_an_index_gives_the_same_without_windows(spark, tmp_path):
    rng = random.Random(8)
    cells = [
        (y, m, float(rng.randrange(-18, 18)) * 10, float(rng.randrange(-9, 9)) * 10, rng.random())
        for y in (2020, 2021) for m in (1, 2, 3) for _ in range(60)
    ]
    points = [(k, rng.choice([2020, 2021, 2022]), rng.choice([1, 2, 3]), rng.uniform(-200, 200), rng.uniform(-95, 95)) for k in range(500)]
    points.append((500, 2020, 1, None, 1.0))
    grid, df = spark.createDataFrame(cells, CELL), spark.createDataFrame(points, POINT)
    index = build_grid_index(grid, str(tmp_path / "index"))
    want = expected(points, cells)
    for options in ({}, {"broadcast_rows": 0}):
        got = nearest_grid_value(df, index, ["id"], **options)
        assert found(got) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan
    # few months are read
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    some = nearest_grid_value(df.filter("year = 2021 and month = 2"), index, ["id"], broadcast_rows=0)
    plan = some._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("PartitionFilters: [" in line and "2021" in line.split("PartitionFilters")[1] for line in scans)


def test_versions_of_an_index(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        GridIndex(spark, path)
    one = build_grid_index(spark.createDataFrame([(2020, 1, 0.0, 0.0, 1.0), (2020, 1, 0.0, 0.0, 0.5)], CELL), path)
    two = build_grid_index(spark.createDataFrame([(2020, 1, 0.0, 0.0, 2.0)], CELL), path)
    point = spark.createDataFrame([(1, 2020, 1, 5.0, 5.0)], POINT)
    values = [nearest_grid_value(point, i, ["id"]).head()["phyto"] for i in (one, two, GridIndex(spark, path))]
    assert values == [0.5, 2.0, 2.0]
    empty = build_grid_index(spark.createDataFrame([], CELL), str(tmp_path / "empty"))
    assert found(nearest_grid_value(point, empty, ["id"])) == {1: (None, None, None)}
    monkeypatch.setattr("pelagia.operators.nearest.commits.publish", lambda *_: False)
    with pytest.raises(FileExistsError):
        build_grid_index(spark.createDataFrame([], CELL), path)


def test_a_grid_is_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(40).selectExpr(
        "2020 year", "1 month", "double(id % 8) lon", "double(id div 8) lat", "double(id) chlor_a"
    )
    points = spark.range(5).selectExpr("id", "2020 year", "1 month", "id + 0.2d lon", "id + 0.2d lat")
    got = nearest_grid_value(points, rows.mapInArrow(passed, rows.schema), ["id"]).select("id", "phyto").collect()
    assert {r["id"]: r["phyto"] for r in got} == {k: 9.0 * k for k in range(5)} and seen.value == 40
