from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pelagia.operators.nearest import one_row_per_cell
from pelagia.plans.map_summary import map_points
from pelagia.schemas import OBSERVATION
from pelagia.sources import readers, requests
from pelagia.sources.writers import checkpointed, write_table


def test_sightings(spark, tmp_path):
    rows = [
        {"date": "Mon, 05 Jan 2021 10:00:00 GMT", "latitude": 1.5, "longitude": "-20.25"},
        {"date": "", "latitude": 0, "longitude": "0"},
        {"date": None, "latitude": "x"},
    ]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.jsonl").write_text("\n".join(map(json.dumps, rows)))
    for path, lines in ((tmp_path / "a.json", False), (tmp_path / "b.jsonl", True)):
        df = readers.read_sightings(spark, str(path), lines)
        assert {tuple(r)[1:] for r in df.collect()} == {
            ("Mon, 05 Jan 2021 10:00:00 GMT", 1.5, -20.25, "1.5", "-20.25", True, True),
            ("", 0.0, 0.0, "0", "0", False, True),
            (None, None, None, "x", None, True, False),
        }
        assert df.select("id").distinct().count() == 3


def test_ids_do_not_depend_on_splits(spark, tmp_path, monkeypatch):
    row = {"date": "Mon, 05 Jan 2021 10:00:00 GMT", "latitude": 1.5, "longitude": 2}
    rows = [row | {"longitude": k % 7} for k in range(400)] + [row] * 50 + [{}] * 3
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, rows)))
    monkeypatch.setattr(readers, "EQUAL_ROWS", 9)

    def read(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            return sorted(map(str, readers.read_sightings(spark, str(tmp_path), True).collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")

    small = read("1k")
    assert len(small) == 906 and len({r.split(",")[0] for r in small}) == 906
    assert read("1g") == small
    # a reading of one of the files gives its rows the ids they have among others
    alone = readers.read_sightings(spark, str(tmp_path / "a.jsonl"), True).collect()
    assert set(map(str, alone)) <= set(small)


def test_rejected_sightings(spark, tmp_path):
    day = "Mon, 05 Jan 2021 10:00:00 GMT"
    rows = [(day, 1, 2), (day, "north", 2), (day, 1, None), ("", None, None), (day, "x", "y")]
    text = [json.dumps(dict(zip(("date", "latitude", "longitude"), r))) for r in rows]
    (tmp_path / "a.jsonl").write_text("\n".join(text))
    bad = readers.rejected_sightings(readers.read_sightings(spark, str(tmp_path / "a.jsonl"), True))
    assert sorted((r["lat_text"] or "", r["reason"]) for r in bad.collect()) == [
        ("1", readers.NO_LONGITUDE),
        ("north", readers.NO_LATITUDE),
        ("x", readers.NO_LATITUDE),
    ]


def test_label_shows_what_was_written(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"date": "x", "latitude": 12, "longitude": "-20.50"}')
    points = readers.read_sightings(spark, str(tmp_path / "a.jsonl"), True).withColumn("date", F.lit("d"))
    shown = map_points(points, lat_text="lat_text", lon_text="lon_text").head()["label"]
    assert shown.endswith("(12, -20.50)")


def test_headers_of_many_files_are_read_by_tasks(spark, tmp_path, monkeypatch):
    """5,000 files of three kinds; the driver opens none of them."""
    heads = [",lat,lon,date,clouds", ",lat,lon,date,clouds,depth", ',lat,"lon",date,temperature']
    for k in range(5000):
        (tmp_path / f"weather data {k}.csv").write_text(f"{heads[k % 3]}\n0,1.0,{k}.5,2020-01-01,5,7\n")

    def refuse(*_):
        raise AssertionError("the driver opened a file")

    # tasks run in processes of their own
    monkeypatch.setattr(readers.fs, "LocalFileSystem", refuse)
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "weather data x.csv").write_text("other\n")
    files = readers._files(spark, f"{tmp_path}/weather*.csv")
    assert len(files) == 5000
    groups = readers._headers(spark, files)
    assert sorted((line, len(found)) for line, found in groups) == sorted(
        (h, sum(k % 3 == n for k in range(5000))) for n, h in enumerate(heads)
    )
    assert sorted(f for _, found in groups for f in found) == files


def test_first_lines(tmp_path):
    for k, (raw, want) in enumerate([(b"", ""), (b"a,b", "a,b"), (b"\xef\xbb\xbfa\r\nx", "a"), (b"y" * 40_000 + b"\nz", "y" * 40_000)]):
        (tmp_path / f"{k}.csv").write_bytes(raw)
        assert readers._head((tmp_path / f"{k}.csv").as_uri()) == want


def test_repeated_and_quoted_headers(spark, tmp_path):
    (tmp_path / "S.20200101_20200131.a.csv").write_text('lon,lat,chlor_a\n1,2,0.5\n"lon","lat","chlor_a"\n3,4,0.25\n')
    (tmp_path / "S.20200201_20200229.a.csv").write_text('"lon","lat","chlor_a"\n1,2,0.5\n')
    assert readers.read_monthly_grid(spark, str(tmp_path)).count() == 3
    some = readers.read_monthly_grid(spark, str(tmp_path), months=[(2020, 2), (1999, 1)])
    assert [f.rsplit("/", 1)[1] for f in some.inputFiles()] == ["S.20200201_20200229.a.csv"]


def test_weather_parts_with_different_headers(spark, tmp_path):
    (tmp_path / "weather_data_1.csv").write_text(
        ",lat,lon,date,temperature,clouds\n0,1.0,2.0,2020-01-01 00:00:00,10.5,3\n1,1.5,2.5,2020-01-02,,4\n"
    )
    (tmp_path / "weather_data_2second.csv").write_text(
        ",lon,lat,date,temperature\n0,2.0,1.0,2020-01-01 00:00:00,10.5\n"
    )
    (tmp_path / "other.csv").write_text(",lat\n0,9\n")
    df = readers.read_observation_parts(spark, str(tmp_path / "weather_data*.csv"))
    assert set(df.columns) == {"lat", "lon", "date", "temperature", "clouds"}
    got = sorted(
        map(str, df.select("lat", "lon", F.col("date").cast("string"), "temperature", "clouds").collect())
    )
    assert len(got) == 3
    assert "temperature=None, clouds=4.0" in got[2]
    assert df.filter("lat = 1.0 and lon = 2.0 and temperature = 10.5").count() == 2
    with pytest.raises(FileNotFoundError):
        readers.read_observation_parts(spark, str(tmp_path / "nothing*.csv"))


def test_part_without_the_column_raises(spark, tmp_path):
    (tmp_path / "weather_data_1.csv").write_text(",lat,lon\n0,1,2\n")
    (tmp_path / "weather_data_2.csv").write_text(",x,y\n0,1,2\n")
    with pytest.raises(ValueError, match="1 of 2 files"):
        readers.read_observation_parts(spark, str(tmp_path / "weather_data*.csv"))


def test_raster_names():
    assert readers.raster_month("S.20200131_20200229.L3m.csv") == (2020, 1)
    for name in ("notes.csv", "S.2020x131_2.csv", "S.20200101_20200131.nc", "csv"):
        assert readers.raster_month(name) is None
    files = ["f/S.20200101_2.b.csv", "f/S.20200101_2.a.csv", "f/S.20200201_2.a.csv", "f/bad.csv"]
    assert readers.month_files(files) == ["f/S.20200101_2.a.csv", "f/S.20200201_2.a.csv"]


def test_monthly_rasters(spark, tmp_path):
    (tmp_path / "S.20200101_20200131.a.csv").write_text(
        "lon,lat,chlor_a\n1,2,0.5\n1,2,0.25\nx,2,1\n3,4,\n5,6,0.75\n"
    )
    (tmp_path / "S.20200101_20200131.b.csv").write_text("lon,lat,chlor_a\n9,9,9\n")
    (tmp_path / "S.20200201_20200229.a.csv").write_text("lat,flag,lon,chlor_a\n2,,1,8\n4,ok,3,7\n")
    (tmp_path / "notes.csv").write_text("lon,lat,chlor_a\n1,1,1\n")
    grid = readers.read_monthly_grid(spark, str(tmp_path))
    rows = sorted(tuple(r)[:5] for r in grid.collect())
    assert rows == [
        (2020, 1, 1.0, 2.0, 0.25),
        (2020, 1, 1.0, 2.0, 0.5),
        (2020, 1, 5.0, 6.0, 0.75),
        (2020, 2, 3.0, 4.0, 7.0),
    ]
    cells = one_row_per_cell(grid, order=readers.FILE_ORDER)
    assert cells.filter("month = 1 and lon = 1").head()["chlor_a"] == 0.5


def test_raster_without_a_column_raises(spark, tmp_path):
    (tmp_path / "S.20200101_20200131.csv").write_text("lon,lat\n1,2\n")
    with pytest.raises(ValueError, match="chlor_a"):
        readers.read_monthly_grid(spark, str(tmp_path))


def test_write_and_read_tables(spark, tmp_path):
    df = spark.sql(
        """select 1d lat, 2d lon, timestamp_ntz'2020-01-02 00:00:00' date, 3d temperature,
        4d max_individual_wave_height, 5d mean_wave_direction, 6d mean_period_total_swell,
        7d clouds, 8d ocean_depth"""
    )
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        write_table(df, path, fmt)
        assert readers.read_table(spark, path, OBSERVATION, fmt).collect() == df.collect()
        with pytest.raises(Exception, match="(?i)exist"):
            write_table(df, path, fmt)
    assert readers.head_rows(df, 1, ["lat"]).count() == 1


def test_checkpoint_goes_to_the_session_folder(spark):
    kept = checkpointed(spark.range(5))
    assert kept.count() == 5
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in kept.inputFiles())


def parse(spark, *bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "req_id long, value string")
    return requests.parse_requests(df)


def points(df):
    return [(r["longitude"], r["latitude"]) for r in df.orderBy("req_id", "pos").collect()]


DATE = ', "date": "2021-08-19T00:00:00"}'


@pytest.mark.parametrize(
    "coords",
    [
        '{"coords": [[17.0, -8.0], [-63.5, 41.0]]',
        '{"coordinates": [["17", "-8"], [-63.5, 41, 7]]',
        '{"coords": [{"longitude": 17, "latitude": -8}, {"lon": "-63.5", "lat": 41}]',
        '{"coords": [{"longitude": null, "x": 17, "y": -8}, {"x": -63.5, "lat": 41}]',
        '{"coords": {"z": [17, -8], "a": [-63.5, 41]}',
    ],
)
def test_coordinate_shapes(spark, coords):
    got = requests.accepted(parse(spark, coords + DATE))
    assert points(got) == [(17.0, -8.0), (-63.5, 41.0)]


def test_request_fields(spark):
    body = '{"coords": [[1, 2]], "view": "map", "depth": 50, "deltas": {"deltaTemp": 1, "deltaClouds": 2, "deltaOceanDepth": 0.5}'
    row = requests.accepted(parse(spark, body + DATE)).head()
    assert (row["view"], row["depth"], row["d_temp"], row["d_clouds"], row["d_ocean"]) == (
        "map",
        50,
        1.0,
        2.0,
        0.5,
    )
    assert str(row["date"]) == "2021-08-19 00:00:00"
    bare = requests.accepted(parse(spark, '{"coords": [[1, 2]]' + DATE)).head()
    assert (bare["depth"], bare["d_temp"], bare["view"]) == (None, None, None)


def test_refused_rows(spark):
    bodies = [
        '{"coords": [[1, 2], {"lon": 3}]' + DATE,
        '{"coords": [{"lon": "east", "lat": 1}]' + DATE,
        '{"coords": [[1], "x"]' + DATE,
        '{"coords": []' + DATE,
        '{"coords": [[1, 2]], "date": "soon"}',
        '{"coords": [[1, 2]], "depth": 1.5' + DATE,
        '{"coords": [[1, 2]], "deltas": {"deltaTemp": 1}' + DATE,
        "not json",
        '{"coords": [[1, 2]], "depth": 1e12' + DATE,
    ]
    parsed = parse(spark, *bodies)
    bad = requests.rejected(parsed).orderBy("req_id", "pos").collect()
    assert [(r["req_id"], r["reason"]) for r in bad] == [
        (0, requests.NO_LON_LAT),
        (1, requests.NOT_NUMERIC),
        (2, requests.BAD_PAIR),
        (2, requests.BAD_PAIR),
        (3, requests.NO_COORDINATES),
        (4, requests.BAD_DATE),
        (5, requests.BAD_DEPTH),
        (6, requests.BAD_DELTAS),
        (7, requests.NO_COORDINATES),
        (8, requests.BAD_DEPTH),
    ]
    assert points(requests.accepted(parsed)) == [(1.0, 2.0)]
    assert points(requests.accepted(parsed, strict=True)) == []
