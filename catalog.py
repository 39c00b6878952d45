"""The registered queries: each operator over the derived tables, with its oracle.

``QUERIES`` maps a name to ``(function(Tables) -> DataFrame, oracle SQL or None)``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fixtures import BOX, TEST_FROM, WEATHER_ORDER, WINDOW, Tables, with_tables
from pelagia.functions.coords import KEY, to_number
from pelagia.functions.dates import has_date, parse_rfc1123
from pelagia.functions.draws import draw
from pelagia.functions.features import (
    apply_scenario,
    clean_features,
    scale_parameters,
)
from pelagia.functions.scoring import minmax_scores, score_count, to_class
from pelagia.operators import background, keyed, profile, report, surface, weather
from pelagia.operators.nearest import build_grid_index, month_match, nearest_grid_value
from pelagia.plans import boosting, map_summary, model, trees
from pelagia.plans.classify import classify, request_features
from pelagia.plans.training import TrainingConfig, build_training_set, filter_sightings
from pelagia.schemas import DEFAULT_FEATURES, LABEL, TRAINING_FEATURES, WEATHER_PARAMETERS
from pelagia.sources.readers import clean_grid, head_rows, rejected_sightings
from pelagia.sources.requests import accepted, parse_requests
from pelagia.sources.store import WeatherStore, create_store
from pelagia.sources.writers import checkpointed, shared_folder

QUERIES: dict = {}
PARAMS = ", ".join(WEATHER_PARAMETERS)
ORDER = ", ".join(WEATHER_ORDER)
MONTH = ("y", "m")
SQL_YEAR = "case when year(l_shipdate)<2001 then year(l_shipdate) else year(l_shipdate)+100 end"


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = (fn, oracle)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# ---------------------------------------------------------------- oracle pieces


def o_draw(seed: str, *key: str) -> str:
    """The draw of ``pelagia.functions.draws`` in the oracle's SQL."""
    text = f"'{seed}:' || " + " || ':' || ".join(f"cast({k} as varchar)" for k in key)
    return f"(cast('0x' || substr(md5({text}), 1, 8) as bigint) / 4294967296e0)"


O_IN_BOX = "lat between -70 and 70 and lon between -100 and 25"
O_DATED = "raw_date is not null and raw_date <> ''"
O_PARSED = "strptime(raw_date, '%a, %d %b %Y %H:%M:%S GMT')"
O_SEEN = f"""select id, lat, lon, {O_PARSED} date from sightings where {O_DATED} and {O_IN_BOX}
    and {O_PARSED} > timestamp '1996-01-01' and {O_PARSED} < timestamp '2001-01-01'"""
O_MAP = f"""select id, lat, lon, {O_PARSED} date from sightings
    where {O_DATED} and {O_IN_BOX} and {O_PARSED} > timestamp '1996-01-01'"""
O_KEY = "round({0}lat, 5) key_lat, round({0}lon, 5) key_lon, cast({0}date as date) key_day"
O_WEATHER_KEY = f"""first_weather as (select * from (select *, {O_KEY.format('')},
    row_number() over (partition by round(lat, 5), round(lon, 5), cast(date as date)
    order by {ORDER}) rn from weather) where rn = 1)"""
O_MATCH = f"""{O_WEATHER_KEY}, matched as (select r.*, w.rn is not null found,
    {', '.join('w.' + p for p in WEATHER_PARAMETERS)} from requests r left join first_weather w
    on round(r.latitude, 5) = w.key_lat and round(r.longitude, 5) = w.key_lon
    and cast(r.date as date) = w.key_day)"""
O_SCENARIO = f"""{O_MATCH}, scenario as (select * exclude (temperature, clouds, ocean_depth),
    coalesce(temperature, 0) + coalesce(d_temp, 0) temperature,
    coalesce(clouds, 0) + coalesce(d_clouds, 0) clouds,
    coalesce(depth, ocean_depth, 0) * (1 + coalesce(d_ocean, 0)) ocean_depth from matched)"""


def o_nearest(points: str) -> str:
    """Clauses that end in ``near(k, c_lon, c_lat, chlor_a)`` for points ``k, y, m, lat, lon``."""
    return f"""
    near_a as (select * from (select s.*, g.lon c_lon, row_number() over
        (partition by k order by abs(s.lon - g.lon), g.lon desc) rn
      from {points} s left join (select distinct y, m, lon from phyto_grid) g using (y, m))
      where rn = 1),
    near as (select * from (select a.k, a.c_lon, p.lat c_lat, p.chlor_a, row_number() over
        (partition by a.k order by abs(a.lat - p.lat), p.lat desc) rn2
      from near_a a left join phyto_grid p on a.y = p.y and a.m = p.m and a.c_lon = p.lon)
      where rn2 = 1)"""


O_POINTS = "points as (select id k, y, m, lat, lon from sightings)"
O_NEAR = f"{O_POINTS}, {o_nearest('points')}"


# ---------------------------------------------------------------- sightings


def seen(t: Tables) -> DataFrame:
    return filter_sightings(t.sightings.drop("date"), WINDOW, BOX).select("id", "lat", "lon", "date")


def mapped(t: Tables) -> DataFrame:
    found = map_summary.map_sightings(t.sightings.drop("date"), WINDOW[0], BOX)
    return found.select("id", "lat", "lon", "date")


@query(
    "parse_dates",
    with_tables(f"select id, {O_PARSED} parsed from sightings where {O_DATED}", "sightings"),
)
def parse_dates(t):
    raw = F.col("raw_date")
    return t.sightings.filter(has_date(raw)).select("id", parse_rfc1123(raw).alias("parsed"))


@query("sighting_filter", with_tables(O_SEEN, "sightings"))
def sighting_filter(t):
    return seen(t)


O_TEXTS = """texts as (select id, raw_date, case when id % 31 = 0 then 'north' when id % 37 <> 0 then
    cast(lat as varchar) end lat_text, case when id % 41 = 0 then '' else cast(lon as varchar) end lon_text
    from sightings)"""


@query(
    "rejected_sightings",
    with_tables(
        f"""select id, lat_text, lon_text, case when try_cast(lat_text as double) is null
        then 'latitude is no number' else 'longitude is no number' end reason from texts
        where {O_DATED} and (try_cast(lat_text as double) is null or try_cast(lon_text as double) is null)""",
        "sightings",
        extra=O_TEXTS,
    ),
)
def rejected_rows(t):
    id = F.col("id")
    lat = F.when(id % 31 == 0, "north").when(id % 37 != 0, F.col("lat").cast("string"))
    lon = F.when(id % 41 == 0, "").otherwise(F.col("lon").cast("string"))
    texts = t.sightings.select("id", "raw_date", lat.alias("lat_text"), lon.alias("lon_text"))
    numbers = texts.withColumns({"lat": to_number(F.col("lat_text")), "lon": to_number(F.col("lon_text"))})
    return rejected_sightings(numbers).select("id", "lat_text", "lon_text", "reason")


@query(
    "daily_batches",
    with_tables(
        f"""select day, batch, count(*) n, string_agg(lat || ',' || lon, ';' order by lat, lon) points
        from (select *, cast(floor((row_number() over (partition by day
                 order by {o_draw('batch', 'id')}, id) - 1) / 5) as bigint) batch
              from (select *, cast(date_trunc('day', date) as timestamp) as day from seen))
        group by day, batch""",
        "sightings",
        extra=f"seen as ({O_SEEN})",
    ),
)
def daily_batches(t):
    lists = keyed.daily_batches(seen(t), ["id"], size=5)
    texts = F.transform(
        "points", lambda p: F.concat(p["lat"].cast("string"), F.lit(","), p["lon"].cast("string"))
    )
    return lists.withColumn("points", F.array_join(texts, ";"))


@query(
    "group_slice",
    with_tables(
        """select id, date from (select *, dense_rank() over (order by date_trunc('day', date)) - 1 i
        from seen) where i >= 100 and i < 400""",
        "sightings",
        extra=f"seen as ({O_SEEN})",
    ),
)
def group_slice(t):
    return keyed.group_slice(seen(t), 100, 400).select("id", "date")


@query(
    "date_range",
    with_tables(
        "select min(date) start_date, max(date) end_date from seen",
        "sightings",
        extra=f"seen as ({O_SEEN})",
    ),
)
def date_range(t):
    return profile.date_range(seen(t))


@query(
    "head_rows",
    with_tables(
        "select id, lat, lon, date from seen order by id limit 10",
        "sightings",
        extra=f"seen as ({O_SEEN})",
    ),
)
def first_rows(t):
    return head_rows(seen(t), 10, ["id"])


@query(
    "map_points",
    with_tables(
        f"""select id, 'Date: ' || date || '<br>Location: (' || lat || ', ' || lon || ')' as label
        from ({O_MAP}) where lat <> 0 and lon <> 0""",
        "sightings",
    ),
)
def map_points(t):
    return map_summary.map_points(mapped(t)).select("id", "label")


@query(
    "map_center",
    with_tables(
        f"""select round(avg(case when lat <> 0 then lat end), 6) center_lat,
        round(avg(case when lon <> 0 then lon end), 6) center_lon from ({O_MAP})""",
        "sightings",
    ),
)
def map_center(t):
    return rounded(map_summary.map_center(mapped(t)), "center_lat", "center_lon")


@query("latest_points", with_tables(f"{O_MAP} order by date desc, id desc limit 10", "sightings"))
def latest_points(t):
    return map_summary.latest(mapped(t), 10)


# ---------------------------------------------------------------- grids


@query(
    "grid_clean",
    with_tables(
        """select cast(y as int) as y, cast(m as int) as m, lon, lat, chlor_a from (select y, m, extra, try_cast(lon as double) lon,
        try_cast(lat as double) lat, try_cast(chlor_a as double) chlor_a from cells)
        where lon is not null and lat is not null and chlor_a is not null and extra is not null""",
        "phyto_grid",
        extra="""cells as (select y, m, case when lon = 0 then 'x' else cast(lon as varchar) end lon,
        cast(lat as varchar) lat, case when lat = 5 then '' else cast(chlor_a as varchar) end chlor_a,
        case when m = 7 and lon > 100 then null else 1 end extra from phyto_grid)""",
    ),
)
def grid_clean(t):
    text = {c: F.col(c).cast("string") for c in ("lon", "lat", "chlor_a")}
    cells = t.phyto_grid.select(
        "y",
        "m",
        F.when(F.col("lon") == 0, "x").otherwise(text["lon"]).alias("lon"),
        text["lat"].alias("lat"),
        F.when(F.col("lat") == 5, "").otherwise(text["chlor_a"]).alias("chlor_a"),
        F.when(~((F.col("m") == 7) & (F.col("lon") > 100)), 1).alias("extra"),
    )
    return clean_grid(cells).drop("extra")


def near(t: Tables) -> DataFrame:
    return nearest_grid_value(
        t.sightings.select("id", "y", "m", "lat", "lon"), t.phyto_grid, ["id"], MONTH, unique=True
    )


@query(
    "nearest_grid_value",
    with_tables(
        "select k id, c_lon, c_lat, chlor_a phyto from near", "sightings", "phyto_grid", extra=O_NEAR
    ),
)
def nearest(t):
    return near(t).select("id", "c_lon", "c_lat", "phyto")


@query(
    "nearest_grid_index",
    with_tables(
        "select k id, c_lon, c_lat, chlor_a phyto from near", "sightings", "phyto_grid", extra=O_NEAR
    ),
)
def nearest_indexed(t):
    index = build_grid_index(t.phyto_grid, f"{shared_folder(t.spark)}/index", MONTH, unique=True)
    points = t.sightings.select("id", "y", "m", "lat", "lon")
    return nearest_grid_value(points, index, ["id"]).select("id", "c_lon", "c_lat", "phyto")


@query(
    "duplicate_cells",
    with_tables(
        "select k id, c_lon, c_lat, chlor_a phyto from near",
        "sightings",
        extra=f"""raw_cells as (select {SQL_YEAR} y, month(l_shipdate) m, ((l_partkey*13)%73)*5e0-1.8e2 lon,
          ((l_suppkey*17+l_partkey)%37)*5e0-9e1 lat, l_tax+l_discount chlor_a, l_orderkey, l_linenumber
          from lineitem),
          phyto_grid as (select y, m, lon, lat, chlor_a from (select *, row_number() over (partition by
          y, m, lon, lat order by l_orderkey, l_linenumber, chlor_a) rn from raw_cells) where rn = 1), {O_NEAR}""",
    ),
)
def duplicate_cells(t):
    cells = t.lineitem.select(
        F.expr(SQL_YEAR).alias("y"),
        F.month("l_shipdate").alias("m"),
        F.expr("((l_partkey*13)%73)*5e0-1.8e2").alias("lon"),
        F.expr("((l_suppkey*17+l_partkey)%37)*5e0-9e1").alias("lat"),
        (F.col("l_tax") + F.col("l_discount")).alias("chlor_a"),
        F.col("l_orderkey").alias("file_block"),
        F.col("l_linenumber").alias("file_row"),
    )
    points = t.sightings.select("id", "y", "m", "lat", "lon")
    return nearest_grid_value(points, cells, ["id"], MONTH).select("id", "c_lon", "c_lat", "phyto")


@query(
    "month_match",
    with_tables(
        """select id, cast(y as int) as y, cast(m as int) as m, hit is not null has_grid from (select id, y, m from sightings)
        left join (select distinct y, m, 1 hit from phyto_grid) using (y, m)""",
        "sightings",
        "phyto_grid",
    ),
)
def months(t):
    return month_match(t.sightings.select("id", "y", "m"), t.phyto_grid, MONTH)


@query(
    "coverage",
    with_tables(
        """select count(*) total_rows, count(chlor_a) matched_rows,
        round(count(chlor_a) / count(*) * 100, 6) as "percent" from near""",
        "sightings",
        "phyto_grid",
        extra=O_NEAR,
    ),
)
def coverage(t):
    return rounded(profile.coverage(near(t), "phyto"), "percent")


PROFILED = ["id", "raw_date", "date", "lat", "lon", "phyto"]


@query(
    "null_profile",
    with_tables(
        " union all ".join(
            f"""select {i} as ordinal, '{c}' as column_name, count(*) - count({c}) as nulls,
            count(*) as "rows" from profiled"""
            for i, c in enumerate(PROFILED)
        ),
        "sightings",
        "phyto_grid",
        extra=f"""{O_NEAR}, profiled as (select id, raw_date, date, lat, lon, chlor_a phyto
        from sightings join near on id = k)""",
    ),
)
def null_profile(t):
    found = nearest_grid_value(t.sightings, t.phyto_grid, ["id"], MONTH, unique=True)
    return profile.null_profile(found.select(*PROFILED))


# ---------------------------------------------------------------- weather


@query(
    "observations",
    with_tables(f"select lat, lon, date, {PARAMS} from weather", "weather"),
)
def observations(t):
    stored = t.weather.withColumnsRenamed({"temperature": "t_0m", "date": "validdate"})
    return weather.observations(stored, {"temperature": "t_0m", "date": "validdate"})


@query(
    "scale_parameters",
    with_tables(
        """select id, l_linenumber, temperature * 1.5e0 temperature, clouds * 5e-1 clouds,
        ocean_depth * 2e0 ocean_depth from weather""",
        "weather",
    ),
)
def scaled(t):
    rows = t.weather.select("id", "l_linenumber", "temperature", "clouds", "ocean_depth")
    return scale_parameters(rows, {"temperature": 1.5, "clouds": 0.5, "ocean_depth": 2.0})


@query(
    "clean_features",
    with_tables(
        """select id, l_linenumber, coalesce(case when temperature = 5 then null else temperature end, 0)
        temperature, case when ocean_depth = -666 then 0 else ocean_depth end ocean_depth,
        case when l_partkey % 2 = 0 then '-666' end note from weather""",
        "weather",
    ),
)
def cleaned(t):
    rows = t.weather.select(
        "id",
        "l_linenumber",
        F.when(F.col("temperature") != 5, F.col("temperature")).alias("temperature"),
        "ocean_depth",
        F.when(F.col("l_partkey") % 2 == 0, F.lit("-666")).alias("note"),
    )
    return clean_features(rows)


@query(
    "first_per_key",
    with_tables(
        f"select key_lat, key_lon, key_day, {PARAMS} from first_weather",
        "weather",
        extra=O_WEATHER_KEY,
    ),
)
def first_weather(t):
    return weather.weather_by_key(t.weather, WEATHER_ORDER)


@query(
    "attach_weather",
    with_tables(
        f"""select s.id, s.lat, s.lon, s.date, {', '.join('w.' + p for p in WEATHER_PARAMETERS)}
        from seen s join first_weather w on round(s.lat, 5) = key_lat and round(s.lon, 5) = key_lon
        and cast(s.date as date) = key_day""",
        "weather",
        extra=f"{O_WEATHER_KEY}, seen as ({O_SEEN})",
    ),
)
def attach(t):
    return weather.attach_weather(seen(t), t.weather, WEATHER_ORDER, ["id"])


@query(
    "weather_match",
    with_tables(f"select req_id, found, {PARAMS} from matched", "weather", "requests", extra=O_MATCH),
)
def matched(t):
    found = weather.weather_match(t.requests, t.weather, WEATHER_ORDER, ["req_id"])
    return found.select("req_id", "found", *WEATHER_PARAMETERS)


@query(
    "missing_keys",
    with_tables(
        f"""select distinct {O_KEY.format('')} from (select latitude lat, longitude lon, date
        from requests) except select {O_KEY.format('')} from weather""",
        "weather",
        "requests",
    ),
)
def missing(t):
    return weather.missing_keys(t.requests, t.weather)


LATEST = WEATHER_ORDER


@query(
    "missing_keys_keyed",
    with_tables(
        f"""select distinct {O_KEY.format('')} from (select latitude lat, longitude lon, date
        from requests) except select {O_KEY.format('')} from weather""",
        "weather",
        "requests",
    ),
)
def missing_keyed(t):
    return weather.missing_keys(t.requests, checkpointed(weather.weather_by_key(t.weather, WEATHER_ORDER)))


# New observations: all of them a degree warmer, those of every third sighting at another place.
O_FRESH = "fresh as (select * replace (temperature + 1 as temperature, " + (
    "case when id % 3 = 0 then lat + 5e-1 else lat end as lat) from weather)"
)
O_UPSERTED = f"""select key_lat, key_lon, key_day, {PARAMS} from (select *, row_number() over (partition by
    key_lat, key_lon, key_day order by fresh desc, {', '.join(c + ' desc' for c in WEATHER_PARAMETERS)}) rn
    from (select 0 fresh, key_lat, key_lon, key_day, {PARAMS} from first_weather union all
          select 1 fresh, {O_KEY.format('')}, {PARAMS} from fresh)) where rn = 1"""


def fresh(t: Tables) -> DataFrame:
    moved = F.when(F.col("id") % 3 == 0, F.col("lat") + 0.5).otherwise(F.col("lat"))
    return t.weather.withColumns({"temperature": F.col("temperature") + 1, "lat": moved})


def stored_weather(t: Tables) -> WeatherStore:
    """A new store with the first observation of every place and day."""
    store = create_store(t.spark, f"{shared_folder(t.spark)}/store", 2)
    store.upsert(weather.weather_by_key(t.weather, WEATHER_ORDER), [])
    return store


@query("upsert_keyed", with_tables(O_UPSERTED, "weather", extra=f"{O_WEATHER_KEY}, {O_FRESH}"))
def upserted_keyed(t):
    store = checkpointed(weather.weather_by_key(t.weather, WEATHER_ORDER))
    return weather.upsert(store, fresh(t), []).select(*KEY, *WEATHER_PARAMETERS)


@query("upsert_store", with_tables(O_UPSERTED, "weather", extra=f"{O_WEATHER_KEY}, {O_FRESH}"))
def upserted_store(t):
    store = stored_weather(t)
    store.upsert(fresh(t), [], ("feed", 1))
    # the same batch again changes nothing
    store.upsert(fresh(t).withColumn("clouds", F.lit(-1.0)), [], ("feed", 1))
    return store.read().select(*KEY, *WEATHER_PARAMETERS)


@query(
    "missing_keys_store",
    with_tables(
        f"""select distinct {O_KEY.format('')} from (select latitude lat, longitude lon, date
        from requests) except select {O_KEY.format('')} from weather""",
        "weather",
        "requests",
    ),
)
def missing_stored(t):
    return weather.missing_keys(t.requests, stored_weather(t))


@query(
    "attach_store",
    with_tables(
        f"""select s.id, s.lat, s.lon, s.date, {', '.join('w.' + p for p in WEATHER_PARAMETERS)}
        from seen s join first_weather w on round(s.lat, 5) = key_lat and round(s.lon, 5) = key_lon
        and cast(s.date as date) = key_day""",
        "weather",
        extra=f"{O_WEATHER_KEY}, seen as ({O_SEEN})",
    ),
)
def attach_stored(t):
    return weather.attach_weather(seen(t), stored_weather(t), WEATHER_ORDER, ["id"])


# Eight coordinates for each request, every fourth one asked for twice.
O_ANSWER = f"""select req_id // 8 as request, (req_id % 8) * 2 + k as pos, found, {PARAMS}
    from (select *, unnest(case when req_id % 4 = 0 then [0, 1] else [0] end) k from matched)"""


def coordinate_lists(t: Tables) -> DataFrame:
    twice = F.explode(F.when(F.col("req_id") % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    request, pos = F.floor(F.col("req_id") / 8), (F.col("req_id") % 8) * 2 + F.col("k")
    return t.requests.withColumn("k", twice).select(
        request.alias("request"), pos.alias("pos"), "latitude", "longitude", "date"
    )


@query("answer", with_tables(O_ANSWER, "weather", "requests", extra=O_MATCH))
def answered(t):
    got = weather.answer(coordinate_lists(t), t.weather, WEATHER_ORDER, ["request", "pos"])
    return got.select("request", "pos", "found", *WEATHER_PARAMETERS)


@query("answer_store", with_tables(O_ANSWER, "weather", "requests", extra=O_MATCH))
def answered_stored(t):
    got = weather.answer(coordinate_lists(t), stored_weather(t), [], ["request", "pos"])
    return got.select("request", "pos", "found", *WEATHER_PARAMETERS)


@query(
    "upsert",
    with_tables(
        f"""select lat, lon, date, {PARAMS} from (select *, row_number() over (partition by
        round(lat, 5), round(lon, 5), cast(date as date)
        order by fresh desc, {', '.join(c + ' desc' for c in LATEST)}) rn
        from (select 0 fresh, * from weather where l_linenumber > 2 union all
              select 1 fresh, * replace (temperature + 1 as temperature) from weather
              where l_linenumber <= 2)) where rn = 1""",
        "weather",
    ),
)
def upserted(t):
    # a store has one observation for each key: here the last
    last = [F.col(c).desc() for c in LATEST]
    raw = weather.keyed(t.weather.filter("l_linenumber > 2"))
    store = keyed.first_per_key(raw, KEY, last).drop(*KEY)
    new = t.weather.filter("l_linenumber <= 2")
    new = new.withColumn("temperature", F.col("temperature") + 1)
    return weather.upsert(store, new, LATEST).select("lat", "lon", "date", *WEATHER_PARAMETERS)


@query(
    "stack_parts",
    with_tables(
        """select lat, lon, date, temperature, clouds from weather where l_linenumber <= 3
        union all by name
        select clouds, date, lon, lat, ocean_depth from weather where l_linenumber >= 3""",
        "weather",
    ),
)
def stacked(t):
    a = t.weather.filter("l_linenumber <= 3").select("lat", "lon", "date", "temperature", "clouds")
    b = t.weather.filter("l_linenumber >= 3").select("clouds", "date", "lon", "lat", "ocean_depth")
    return weather.stack(a, b)


ROW_KEY = ["id", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "sample_days",
    with_tables(
        f"""select {', '.join(ROW_KEY)} from (select *, row_number() over (partition by lat, lon
        order by {o_draw('days', *ROW_KEY)}, {', '.join(ROW_KEY)}) rn from weather) where rn <= 3""",
        "weather",
    ),
)
def sample_days(t):
    return keyed.sample_per_key(t.weather, ["lat", "lon"], 3, "days", ROW_KEY).select(*ROW_KEY)


# ---------------------------------------------------------------- draws


@query(
    "shuffle_rows",
    with_tables(
        f"select id, row_number() over (order by {o_draw('42', 'id')}, id) - 1 as position from sightings",
        "sightings",
    ),
)
def shuffled(t):
    return keyed.shuffle_rows(t.sightings.select("id"), 42, ["id"])


@query(
    "batches",
    with_tables(
        f"""select id, cast(floor((row_number() over (order by {o_draw('42', 'id')}, id) - 1) / 100)
        as bigint) as batch from sightings""",
        "sightings",
    ),
)
def batched(t):
    numbered = keyed.shuffle_rows(t.sightings.select("id"), 42, ["id"])
    return keyed.batches(numbered, "position").select("id", "batch")


def third(df: DataFrame) -> Column:
    return df.agg(F.floor(F.count(F.lit(1)) / 3)).scalar()


def drawn_points(t: Tables) -> DataFrame:
    return background.uniform_points(t.spark, third(seen(t)), BOX, 42)


O_UNIFORM = f"""uniform as (select id, -70e0 + {o_draw('42:lat', 'id')} * 14e1 lat,
    -100e0 + {o_draw('42:lon', 'id')} * 125e0 lon
    from (select unnest(range(n)) id from (select count(*) // 3 n from seen)))"""
O_DAYS = f"""drawn as (select id, cast(floor(id / 100) as bigint) as batch, round, lat, lon,
    start_date + to_days(cast(floor({o_draw('42:day', 'round', 'cast(floor(id / 100) as bigint)')}
    * greatest(days, 1)) as int)) date
    from uniform, (select min(date) start_date,
      floor(date_diff('second', min(date), max(date)) / 86400) as days from seen),
    (select unnest([1, 2, 3]) round))"""


@query(
    "uniform_points",
    with_tables(
        "select id, lat, lon from uniform", "sightings", extra=f"seen as ({O_SEEN}), {O_UNIFORM}"
    ),
)
def uniform(t):
    return drawn_points(t)


@query(
    "draw_days",
    with_tables(
        """select id, batch, "round", lat, lon, date from drawn""",
        "sightings",
        extra=f"seen as ({O_SEEN}), {O_UNIFORM}, {O_DAYS}",
    ),
)
def days(t):
    found = seen(t)
    first, last = (found.agg(f("date")).scalar() for f in (F.min, F.max))
    return background.draw_days(drawn_points(t), first, last, 3, 100, 42)


# ---------------------------------------------------------------- requests


@query(
    "scenario",
    with_tables(
        "select req_id, temperature, clouds, ocean_depth from scenario",
        "weather",
        "requests",
        extra=O_SCENARIO,
    ),
)
def scenario(t):
    found = weather.weather_match(t.requests, t.weather, WEATHER_ORDER, ["req_id"])
    return apply_scenario(found).select("req_id", "temperature", "clouds", "ocean_depth")


@query(
    "feature_rows",
    with_tables(
        f"""select req_id, latitude lat, longitude lon, temperature,
        coalesce(max_individual_wave_height, 0) max_individual_wave_height,
        coalesce(mean_wave_direction, 0) mean_wave_direction,
        coalesce(mean_period_total_swell, 0) mean_period_total_swell,
        clouds, cast(coalesce(depth, ocean_depth) as double) ocean_depth, 0e0 phyto from scenario""",
        "weather",
        "requests",
        extra=O_SCENARIO,
    ),
)
def feature_rows(t):
    rows = request_features(t.requests, t.weather, TRAINING_FEATURES, WEATHER_ORDER)
    return rows.select("req_id", *TRAINING_FEATURES)


def request_texts(t: Tables) -> DataFrame:
    """Requests as JSON texts of several shapes, two points each, some of them bad."""
    return t.sightings.select(
        F.col("id").alias("req_id"),
        F.expr(
            """concat('{"', if(id % 2 = 0, 'coords', 'coordinates'), '": ',
            case id % 5 when 0 then concat('[[', lon, ', ', lat, '], [1.5, "2.5"]]')
              when 1 then concat('[{"lon": ', lon, ', "lat": ', lat, '}, {"x": 1, "y": 2}]')
              when 2 then concat('{"b": [', lon, ', ', lat, '], "a": [3, 4]}')
              when 3 then concat('[{"longitude": null, "lon": ', lon, ', "latitude": ', lat, '}, {"lon": 1}]')
              else concat('[[', lon, ', ', lat, ', 7], ["east", 4]]') end,
            ', "view": "map", "date": "', date_format(date, "yyyy-MM-dd'T'HH:mm:ss"), '"',
            if(id % 3 = 0, concat(', "depth": ', id % 50), ''),
            if(id % 4 = 0, ', "deltas": {"deltaTemp": 1.5, "deltaClouds": -1, "deltaOceanDepth": 0.25}', ''),
            '}')"""
        ).alias("value"),
    )


@query(
    "parse_requests",
    with_tables(
        """select id req_id, pos, longitude, latitude, date, 'map' as view,
          case when id % 3 = 0 then cast(id % 50 as int) end depth,
          case when id % 4 = 0 then 1.5e0 end d_temp, case when id % 4 = 0 then -1e0 end d_clouds,
          case when id % 4 = 0 then 25e-2 end d_ocean
        from (select id, date, 0 as pos, lon longitude, lat latitude from sightings union all
          select id, date, 1, case id % 5 when 0 then 15e-1 when 1 then 1e0 else 3e0 end,
            case id % 5 when 0 then 25e-1 when 1 then 2e0 else 4e0 end
          from sightings where id % 5 < 3)""",
        "sightings",
    ),
)
def parsed(t):
    return accepted(parse_requests(request_texts(t)))


# ---------------------------------------------------------------- scores and reports


def predicted(t: Tables) -> DataFrame:
    """Labels with fixed predictions from a draw; every sixteenth has no probability."""
    id = F.col("id")
    probability = F.floor(draw("p", id) * 200) / 200
    return t.sightings.select(
        "id",
        F.when(id % 3 == 0, 1).otherwise(0).alias(LABEL),
        F.when(id % 16 != 0, probability).alias("probability"),
        F.when(draw("q", id) < 0.5 + 0.2 * (id % 3), 0).otherwise(1).alias("prediction"),
    )


O_PREDICTED = f"""predicted as (select id, case when id % 3 = 0 then 1 else 0 end as label,
    case when id % 16 <> 0 then floor({o_draw('p', 'id')} * 200) / 200 end probability,
    case when {o_draw('q', 'id')} < 5e-1 + 2e-1 * (id % 3) then 0 else 1 end prediction
    from sightings)"""


@query(
    "score_count",
    with_tables(
        """select id, coalesce(cast(round_even(probability * 100, 0) as int), prediction) as "count",
        cast(probability >= 5e-1 as int) class from predicted""",
        "sightings",
        extra=O_PREDICTED,
    ),
)
def counted(t):
    p = F.col("probability")
    return predicted(t).select(
        "id", score_count(p, F.col("prediction")).alias("count"), to_class(p).alias("class")
    )


@query(
    "minmax_scores",
    with_tables(
        """select id, round((s - min(s) over ()) / (max(s) over () - min(s) over ()), 9) probability
        from (select id, lat * 2 - lon s from sightings)""",
        "sightings",
    ),
)
def minmax(t):
    raw = t.sightings.select("id", (F.col("lat") * 2 - F.col("lon")).alias("s"))
    return rounded(minmax_scores(raw, "s"), "probability", places=9).drop("s")


@query(
    "confusion",
    with_tables(
        'select label, prediction, count(*) as "rows" from predicted group by all',
        "sightings",
        extra=O_PREDICTED,
    ),
)
def confusion(t):
    return report.confusion(predicted(t))


O_REPORT = f"""{O_PREDICTED}, c as (select k, count(*) filter (label = k) sup,
    count(*) filter (prediction = k) pre, count(*) filter (label = k and prediction = k) hit
    from predicted, (select unnest([0, 1]) k) group by k),
    r as (select k, sup, hit, hit / pre p, hit / sup r, 2 * hit / (pre + sup) f from c)"""


@query(
    "classification_report",
    with_tables(
        """select cast(k as varchar) as "class", round(p, 6) as "precision", round(r, 6) as recall,
          round(f, 6) as f1, sup as support from r
        union all select 'accuracy', round(sum(hit) / sum(sup), 6), round(sum(hit) / sum(sup), 6),
          round(sum(hit) / sum(sup), 6), cast(sum(sup) as bigint) from r
        union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
          cast(sum(sup) as bigint) from r
        union all select 'weighted avg', round(sum(p * sup) / sum(sup), 6),
          round(sum(r * sup) / sum(sup), 6), round(sum(f * sup) / sum(sup), 6),
          cast(sum(sup) as bigint) from r""",
        "sightings",
        extra=O_REPORT,
    ),
)
def classification(t):
    return rounded(report.classification_report(predicted(t)), "precision", "recall", "f1")


@query(
    "class_counts",
    with_tables(
        'select label, count(*) as "rows" from predicted group by label',
        "sightings",
        extra=O_PREDICTED,
    ),
)
def counts(t):
    return profile.class_counts(predicted(t))


# ---------------------------------------------------------------- features


def featured(t: Tables) -> DataFrame:
    return t.weather.select(*DEFAULT_FEATURES)


@query(
    "feature_ranges",
    with_tables(
        " union all ".join(
            f"""select '{f}' as feature, round(min({f}) - 1e-1 * (max({f}) - min({f})), 6) as lo,
            round(max({f}) + 1e-1 * (max({f}) - min({f})), 6) as hi from weather"""
            for f in DEFAULT_FEATURES
        ),
        "weather",
    ),
)
def ranges(t):
    return rounded(profile.feature_ranges(featured(t), DEFAULT_FEATURES), "lo", "hi")


@query(
    "feature_medians",
    with_tables(
        " union all ".join(
            f"select '{f}' as feature, round(median({f}), 6) as median from weather"
            for f in DEFAULT_FEATURES
        ),
        "weather",
    ),
)
def medians(t):
    return rounded(profile.feature_medians(featured(t), DEFAULT_FEATURES), "median")


def labelled(t: Tables) -> DataFrame:
    """Weather rows with a label, and some features missing."""
    return t.weather.select(
        *ROW_KEY,
        (F.col("id") % 2).cast("int").alias(LABEL),
        F.when(F.col("clouds") != 3, F.col("clouds")).alias("clouds"),
        "temperature",
        F.when(F.col("ocean_depth") != -666, F.col("ocean_depth")).alias("ocean_depth"),
    )


PLANES = ["temperature", "clouds", "ocean_depth"]
O_PLANES = " union all ".join(
    f"""select '{a}' as feature1, '{b}' as feature2, {a} as x, {b} as y from labelled
    where label = 1 and {a} is not null and {b} is not null"""
    for a, b in [("temperature", "clouds"), ("temperature", "ocean_depth"), ("clouds", "ocean_depth")]
)
O_LABELLED = """labelled as (select id % 2 as label, case when clouds <> 3 then clouds end clouds,
    temperature, case when ocean_depth <> -666 then ocean_depth end ocean_depth from weather)"""


@query("surface_points", with_tables(O_PLANES, "weather", extra=O_LABELLED))
def surface_points(t):
    return surface.positives(labelled(t), surface.feature_pairs(PLANES))


@query(
    "feature_pairs",
    with_tables(
        f'select feature1, feature2, count(*) as "rows" from ({O_PLANES}) group by all',
        "weather",
        extra=O_LABELLED,
    ),
)
def pairs(t):
    rows = labelled(t)
    names = [c for c in PLANES if c in rows.columns]
    known = surface.known_pairs(surface.feature_pairs(names), rows.columns)
    return (
        surface.positives(rows, known)
        .groupBy("feature1", "feature2")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# ---------------------------------------------------------------- training


@query(
    "temporal_split",
    with_tables(
        """select id, case when date < timestamp '2000-01-01' then 'train' else 'test' end as part
        from seen""",
        "sightings",
        extra=f"seen as ({O_SEEN})",
    ),
)
def split(t):
    train, test = model.temporal_split(seen(t), TEST_FROM)
    named = [df.select("id", F.lit(n).alias("part")) for df, n in ((train, "train"), (test, "test"))]
    return weather.stack(*named)


CONFIG = TrainingConfig(window=WINDOW, box=BOX, weather_order=WEATHER_ORDER, grid_unique=True)


def training_rows(t: Tables) -> DataFrame:
    """The training set; background points borrow the weather of a sighting.

    For every fourth one it is stored at another place, so that it is not found.
    """

    def around(drawn: DataFrame) -> DataFrame:
        placed = drawn.select(
            F.when((F.col("id") + F.col("round")) % 4 == 0, F.col("lat") + 0.25)
            .otherwise(F.col("lat"))
            .alias("lat"),
            "lon",
            "date",
            (1 + 3 * F.col("id") + F.col("round")).alias("source"),
        )
        # weather that no point borrows is not ranked; the first and the last id are constants for the scan
        first, last = placed.agg(F.min("source"), F.max("source")).first()
        lent = t.weather.filter(F.col("id").between(first, last))
        lent = lent.join(placed.select(F.col("source").alias("id")).distinct(), "id", "left_semi")
        by_id = keyed.first_per_key(lent, ["id"], WEATHER_ORDER).drop("lat", "lon", "date")
        return placed.join(by_id.withColumnRenamed("id", "source"), "source").drop("source")

    return build_training_set(
        t.sightings.select("id", "raw_date", "lat", "lon"),
        t.weather,
        t.phyto_grid.withColumnsRenamed({"y": "year", "m": "month"}),
        around,
        CONFIG,
    )


def o_clean(c: str) -> str:
    return f"case when {c} is null or {c} = -666 then 0 else {c} end {c}"


O_TRAINING = f"""{O_WEATHER_KEY},
    seen0 as ({O_SEEN}),
    seen as (select s.id, s.lat, s.lon, cast(date_trunc('day', s.date) as timestamp) date,
      {', '.join('w.' + p for p in WEATHER_PARAMETERS)}
      from seen0 s join first_weather w on round(s.lat, 5) = key_lat and round(s.lon, 5) = key_lon
      and cast(s.date as date) = key_day),
    {O_UNIFORM}, {O_DAYS},
    by_id as (select * from (select *, row_number() over (partition by id order by {ORDER}) rn
      from weather) where rn = 1),
    both0 as (select 1 as label, 0 as round, * from seen union all
      select 0, d.round, d.id, d.lat, d.lon, cast(date_trunc('day', d.date) as timestamp),
      {', '.join('w.' + p for p in WEATHER_PARAMETERS)}
      from drawn d join by_id w on w.id = 1 + 3 * d.id + d.round
      where (d.id + d.round) % 4 <> 0),
    both1 as (select *, year(date) y, month(date) m, label || ':' || round || ':' || id k from both0),
    {o_nearest('both1')}"""


@query(
    "training_set",
    with_tables(
        f"""select row_number() over (order by {o_draw('42:shuffle', 'label', 'round', 'id')},
          label, round, id) - 1 as position, lat, lon, date,
          {', '.join(o_clean(p) for p in WEATHER_PARAMETERS)},
          coalesce(chlor_a, 0) phyto, label from both1 join near using (k)""",
        "weather",
        "phyto_grid",
        extra=O_TRAINING,
    ),
)
def training_set(t):
    return training_rows(t)


O_TRAINING_TABLE = f"""{O_TRAINING}, training as (select row_number() over (order by
    {o_draw('42:shuffle', 'label', 'round', 'id')}, label, round, id) - 1 as position, lat, lon, date,
    {', '.join(o_clean(p) for p in WEATHER_PARAMETERS)}, coalesce(chlor_a, 0) phyto, label
    from both1 join near using (k))"""

_STORED: dict[tuple[str, str], DataFrame] = {}
_TRAINED: dict[tuple[str, str], PipelineModel] = {}


def training_table(t: Tables) -> DataFrame:
    """The training set, stored once per application."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _STORED:
        _STORED[key] = checkpointed(training_rows(t))
    return _STORED[key]


def trained(t: Tables) -> PipelineModel:
    """The model of the folder with the settings of the plan, made once per application."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _TRAINED:
        train, _ = model.temporal_split(training_table(t), TEST_FROM)
        _TRAINED[key] = model.train(train, TRAINING_FEATURES)
    return _TRAINED[key]


# The pairs that are looked at, written out for the oracle.
O_PAIRS = [
    ("temperature", "ocean_depth"),
    ("phyto", "temperature"),
    ("phyto", "ocean_depth"),
    ("temperature", "max_individual_wave_height"),
    ("ocean_depth", "max_individual_wave_height"),
    ("phyto", "max_individual_wave_height"),
    ("temperature", "clouds"),
    ("phyto", "clouds"),
    ("lon", "lat"),
    ("mean_wave_direction", "mean_period_total_swell"),
]


def o_grid(a: str, b: str) -> str:
    def value(f: str) -> str:
        return {a: "round(x, 6)", b: "round(y, 6)"}.get(f, f"round(m_{f}, 6)")

    return f"""select '{a}' as feature1, '{b}' as feature2, cast(i as int) as i, cast(j as int) as j,
        round(x, 6) x, round(y, 6) y, {', '.join(f'{value(f)} as {f}' for f in TRAINING_FEATURES)}
        from (select *, lo_{a} + j * (hi_{a} - lo_{a}) / 49 x, lo_{b} + i * (hi_{b} - lo_{b}) / 49 y
        from stats, range(50) u(i), range(50) v(j))"""


O_STATS = f"{O_TRAINING_TABLE}, stats as (select " + ", ".join(
    f"""median({f}) m_{f}, min({f}) - 1e-1 * (max({f}) - min({f})) lo_{f},
    max({f}) + 1e-1 * (max({f}) - min({f})) hi_{f}"""
    for f in TRAINING_FEATURES
) + " from training)"
O_GRID = " union all ".join(o_grid(a, b) for a, b in O_PAIRS)


@query("feature_grid", with_tables(O_GRID, "weather", "phyto_grid", extra=O_STATS))
def grid(t):
    rows = surface.feature_grid(training_table(t), TRAINING_FEATURES, surface.DEFAULT_PAIRS)
    return rounded(rows, "x", "y", *TRAINING_FEATURES)


def valid(name: str) -> Column:
    return F.col(name).between(0, 1)


@query(
    "train_score",
    with_tables(
        """select position, label, true as valid from training where date >= timestamp '2000-01-01'""",
        "weather",
        "phyto_grid",
        extra=O_TRAINING_TABLE,
    ),
)
def train_score(t):
    _, test = model.temporal_split(training_table(t), TEST_FROM)
    scored = model.score(test, trained(t))
    agrees = F.col("prediction") == (F.col("probability") > 0.5).cast("int")
    return scored.select("position", LABEL, (valid("probability") & agrees).alias("valid"))


@query(
    "importance",
    " union all ".join(f"select '{f}' as feature, true as valid, 1e0 as total" for f in TRAINING_FEATURES),
)
def importance(t):
    found = model.importance(trained(t), t.spark)
    total = F.round(F.sum("importance").over(Window.partitionBy(F.lit(1))), 6)
    return found.select("feature", valid("importance").alias("valid"), total.alias("total"))


@query(
    "surface",
    with_tables(
        f"select feature1, feature2, i, j, x, y, true as valid from ({O_GRID})",
        "weather",
        "phyto_grid",
        extra=O_STATS,
    ),
)
def surfaces(t):
    found = surface.surfaces(trained(t), training_table(t))
    return rounded(found.withColumn("valid", valid("probability")).drop("probability"), "x", "y")


@query(
    "classify",
    with_tables("select req_id, longitude, latitude, true as valid from requests", "requests"),
)
def classified(t):
    found = classify(t.requests, t.weather, trained(t), order=WEATHER_ORDER)
    return found.withColumn("valid", F.col("count").between(0, 100)).drop("count")


# One tree with one split on a feature of two values has a closed form: at a leaf with mean label m
# the probability is 1 / (1 + exp(-2 (2 m - 1))).


def stump_rows(t: Tables) -> DataFrame:
    """Warm and cold rows; a third of the cold and a fifth of the warm ones are positive."""
    cold = F.col("l_linenumber") % 2 == 0
    return t.weather.select(
        *ROW_KEY,
        F.when(cold, 10.0).otherwise(20.0).alias("temperature"),
        F.lit(1.0).alias("clouds"),
        F.when(cold, F.col("id") % 3 == 0).otherwise(F.col("id") % 5 == 0).cast("int").alias(LABEL),
    )


def stump(t: Tables) -> PipelineModel:
    return model.train(stump_rows(t), ["temperature", "clouds"], method="library", maxIter=1, maxDepth=1)


O_STUMP = """leaves as (select cold, 1 / (1 + exp(-2 * (2 * avg(cast(case when cold then id % 3 = 0 else
    id % 5 = 0 end as int)) - 1))) p from (select id, l_linenumber % 2 = 0 cold from weather) group by cold)"""


@query(
    "stump_score",
    with_tables(
        f"""select {', '.join(ROW_KEY)}, round(p, 9) as probability, cast(p > 5e-1 as int) as prediction
        from weather join leaves on cold = (l_linenumber % 2 = 0)""",
        "weather",
        extra=O_STUMP,
    ),
)
def stump_score(t):
    scored = model.score(stump_rows(t), stump(t))
    return rounded(scored.select(*ROW_KEY, "probability", "prediction"), "probability", places=9)


@query(
    "stump_importance",
    "select 'temperature' as feature, 1e0 as importance union all select 'clouds', 0e0",
)
def stump_importance(t):
    return model.importance(stump(t), t.spark)


@query(
    "stump_classify",
    with_tables(
        """select req_id, longitude, latitude, cast(round_even(p * 100, 0) as int) as "count"
        from scenario join leaves on cold = (temperature <= 15)""",
        "weather",
        "requests",
        extra=f"{O_SCENARIO}, {O_STUMP}",
    ),
)
def stump_classify(t):
    return classify(t.requests, t.weather, stump(t), order=WEATHER_ORDER)


@query(
    "stump_evaluate",
    with_tables(
        """select 'train' as part, round(avg(cast((p > 5e-1) = (case when cold then id % 3 = 0 else
        id % 5 = 0 end) as int)), 9) as accuracy from (select id, l_linenumber % 2 = 0 cold from weather)
        join leaves using (cold)""",
        "weather",
        extra=O_STUMP,
    ),
)
def stump_evaluate(t):
    rows = stump_rows(t)
    _, both = model.evaluate(stump(t), rows, rows)
    return rounded(both.filter("part = 'train'").select("part", "accuracy"), "accuracy", places=9)


# ---------------------------------------------------------------- small models worked out in full

# Features with few values, all of which are places to split.
COARSE = ["temperature", "max_individual_wave_height", "mean_period_total_swell", "clouds", "phyto"]
SMALL = boosting.Settings(trees=2, depth=2)


def o_descend(tree: int, rows: str, key: str, depth: int, name: str) -> str:
    """Clauses that lead rows down a tree whose splits are known: ``<name>_<depth>`` has key and node."""
    out = [f"{name}_0 as (select {key}, 1 as node from {rows})"]
    for d in range(depth):
        value = "case s.feature " + " ".join(f"when '{f}' then r.{f}" for f in COARSE) + " end"
        out.append(
            f"""{name}_{d + 1} as (select n.{key}, case when s.node is null then n.node
            when {value} <= s.threshold then 2 * n.node else 2 * n.node + 1 end as node
            from {name}_{d} n join {rows} r using ({key}) left join split_{tree}_{d} s on s.node = n.node)"""
        )
    return ", ".join(out)


def o_boost(settings: boosting.Settings) -> str:
    """Clauses of the trees that boosting grows on the training rows before the test date.

    ``nodes`` has them all, ``value_<tree>`` a node and its leaf value, ``split_<tree>_<depth>`` its splits.
    """
    long = " union all ".join(
        f"select position, {k} as k, '{f}' as feature, {f} as v from learned" for k, f in enumerate(COARSE)
    )
    out = [
        "learned as (select * from training where date < timestamp '2000-01-01')",
        f"long as ({long})",
        "logit_0 as (select position, 0e0 as m from learned)",
    ]
    found = []
    for t in range(settings.trees):
        out.append(
            f"""grad_{t} as (select position, p - label as g, p * (1 - p) as h
            from (select position, label, 1 / (1 + exp(-m)) as p from logit_{t} join learned using (position)))"""
        )
        out.append(f"at_{t}_0 as (select position, 1 as node from learned)")
        for d in range(settings.depth):
            out.append(
                f"""cell_{t}_{d} as (select node, k, feature, v, sum(g) as g, sum(h) as h
                from at_{t}_{d} join long using (position) join grad_{t} using (position) group by all),
                side_{t}_{d} as (select *, sum(g) over up as gl, sum(h) over up as hl,
                sum(g) over (partition by node, k) as gt, sum(h) over (partition by node, k) as ht
                from cell_{t}_{d} window up as (partition by node, k order by v)),
                split_{t}_{d} as (select node, feature, v as threshold, gain, ht as cover from (select *,
                row_number() over (partition by node order by gain desc, k, v) as rn from (select *,
                gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) as gain
                from side_{t}_{d} where hl >= 1 and ht - hl >= 1) where gain > 0) where rn = 1),
                at_{t}_{d + 1} as (select n.position, case when x.v <= s.threshold then 2 * n.node
                else 2 * n.node + 1 end as node from at_{t}_{d} n join split_{t}_{d} s using (node)
                join long x on x.position = n.position and x.feature = s.feature)"""
            )
        out.append(o_descend(t, "learned", "position", settings.depth, f"leaf_{t}"))
        out.append(
            f"""value_{t} as (select node, -{settings.rate} * sum(g) / (sum(h) + 1) as value, sum(h) as cover
            from leaf_{t}_{settings.depth} join grad_{t} using (position) group by node),
            logit_{t + 1} as (select position, m + value as m
            from logit_{t} join leaf_{t}_{settings.depth} using (position) join value_{t} using (node))"""
        )
        found += [f"select {t} as tree, node, feature, threshold, null as value, gain, cover from split_{t}_{d}" for d in range(settings.depth)]
        found.append(f"select {t}, node, null, null, value, null, cover from value_{t}")
    return ", ".join([*out, f"nodes as ({' union all '.join(found)})"])


def o_logit(rows: str, key: str, settings: boosting.Settings) -> str:
    """Clauses that end in ``scored(key, p)`` for rows that have the features."""
    last = settings.depth
    down = [o_descend(t, rows, key, last, f"{rows}_{t}") for t in range(settings.trees)]
    joins = " ".join(
        f"join {rows}_{t}_{last} n{t} on n{t}.{key} = r.{key} join value_{t} v{t} on v{t}.node = n{t}.node"
        for t in range(settings.trees)
    )
    total = " + ".join(f"v{t}.value" for t in range(settings.trees))
    return ", ".join([*down, f"scored as (select r.{key}, 1 / (1 + exp(-({total}))) as p from {rows} r {joins})"])


O_BOOST = f"{O_TRAINING_TABLE}, {o_boost(SMALL)}"


def small_nodes(t: Tables) -> DataFrame:
    learned, _ = model.temporal_split(training_table(t), TEST_FROM)
    return boosting.boost(learned, COARSE, LABEL, SMALL)


def small_model(t: Tables) -> PipelineModel:
    return trees.model_of(small_nodes(t), COARSE)


@query(
    "boosted_nodes",
    with_tables(
        """select tree, cast(node as int) as node, feature, round(threshold, 6) as threshold,
        cast(case when feature is not null then 2 * node end as int) as "left",
        cast(case when feature is not null then 2 * node + 1 end as int) as "right",
        round(value, 6) as value, round(gain, 6) as gain, round(cover, 6) as cover from nodes""",
        "weather",
        "phyto_grid",
        extra=O_BOOST,
    ),
)
def boosted_nodes(t):
    return rounded(small_nodes(t), "threshold", "value", "gain", "cover")


@query(
    "boosted_score",
    with_tables(
        """select position, label, round(p, 9) as probability, cast(p > 5e-1 as int) as prediction
        from tested join scored using (position)""",
        "weather",
        "phyto_grid",
        extra=f"""{O_BOOST}, tested as (select * from training where date >= timestamp '2000-01-01'),
        {o_logit('tested', 'position', SMALL)}""",
    ),
)
def boosted_score(t):
    _, test = model.temporal_split(training_table(t), TEST_FROM)
    scored = model.score(test, small_model(t)).select("position", LABEL, "probability", "prediction")
    return rounded(scored, "probability", places=9)


O_BY_FEATURE = " union all ".join(f"select '{f}' as feature" for f in COARSE)


@query(
    "boosted_importance",
    with_tables(
        f"""select feature, coalesce(n, 0) as splits, round(coalesce(total_gain, 0), 6) as total_gain,
        round(coalesce(total_cover, 0), 6) as total_cover, round(coalesce(mean_gain, 0), 6) as mean_gain,
        round(coalesce(mean_cover, 0), 6) as mean_cover,
        round(coalesce(mean_gain, 0) / sum(mean_gain) over (), 6) as importance
        from ({O_BY_FEATURE}) left join (select feature, count(*) as n, sum(gain) as total_gain,
          sum(cover) as total_cover, avg(gain) as mean_gain, avg(cover) as mean_cover
          from nodes where feature is not null group by feature) using (feature)""",
        "weather",
        "phyto_grid",
        extra=O_BOOST,
    ),
)
def boosted_importance(t):
    found = trees.node_importance(small_nodes(t), COARSE)
    return rounded(found, "total_gain", "total_cover", "mean_gain", "mean_cover", "importance")


@query(
    "boosted_surface",
    with_tables(
        """select feature1, feature2, i, j, round(x, 6) as x, round(y, 6) as y, round(p, 6) as probability
        from planes join scored using (k)""",
        "weather",
        "phyto_grid",
        extra=f"""{O_BOOST}, axes as (select """
        + ", ".join(
            f"""median({f}) m_{f}, min({f}) - 1e-1 * (max({f}) - min({f})) lo_{f},
            max({f}) + 1e-1 * (max({f}) - min({f})) hi_{f}"""
            for f in COARSE
        )
        + " from training), planes as (select *, feature1 || feature2 || i || ':' || j as k from ("
        + " union all ".join(
            f"""select '{a}' as feature1, '{b}' as feature2, cast(i as int) as i, cast(j as int) as j, x, y,
            {', '.join(({a: 'x', b: 'y'}.get(f, f'm_{f}')) + ' as ' + f for f in COARSE)}
            from (select *, lo_{a} + j * (hi_{a} - lo_{a}) / 49 x, lo_{b} + i * (hi_{b} - lo_{b}) / 49 y
            from axes, range(50) u(i), range(50) v(j))"""
            for a, b in (("temperature", "clouds"), ("phyto", "max_individual_wave_height"))
        )
        + f")), {o_logit('planes', 'k', SMALL)}",
    ),
)
def boosted_surface(t):
    pairs = [("temperature", "clouds"), ("phyto", "max_individual_wave_height")]
    return rounded(surface.surfaces(small_model(t), training_table(t), pairs), "x", "y", "probability")


@query(
    "boosted_classify",
    with_tables(
        """select req_id, longitude, latitude, cast(round_even(p * 100, 0) as int) as "count"
        from requests join scored using (req_id)""",
        "weather",
        "phyto_grid",
        "requests",
        extra=f"""{O_BOOST}, {O_SCENARIO.replace(O_WEATHER_KEY + ', ', '')}, asked as (select req_id, temperature, clouds,
        coalesce(max_individual_wave_height, 0) max_individual_wave_height,
        coalesce(mean_period_total_swell, 0) mean_period_total_swell, 0e0 phyto from scenario),
        {o_logit('asked', 'req_id', SMALL)}""",
    ),
)
def boosted_classify(t):
    return classify(t.requests, t.weather, small_model(t), order=WEATHER_ORDER)


# A model that is given as a table, with features of many values.
GIVEN_FEATURES = ["lat", "lon", "ocean_depth", "temperature"]
GIVEN_NODES = [
    (0, 1, "lat", 3.25, 2, 3, None, 5.0, 100.0),
    (0, 2, "ocean_depth", 2500.5, 4, 5, None, 3.0, 60.0),
    (0, 3, None, None, None, None, -0.375, None, 40.0),
    (0, 4, None, None, None, None, 0.625, None, 20.0),
    (0, 5, None, None, None, None, 0.125, None, 40.0),
    (1, 1, "temperature", 15.5, 2, 3, None, 2.0, 100.0),
    (1, 2, None, None, None, None, -0.25, None, 50.0),
    (1, 3, "lon", -41.123, 6, 7, None, 1.0, 50.0),
    (1, 6, None, None, None, None, 0.75, None, 25.0),
    (1, 7, None, None, None, None, -0.5, None, 25.0),
]
O_GIVEN = """1 / (1 + exp(-(case when lat <= 325e-2 then case when ocean_depth <= 25005e-1 then 625e-3 else
    125e-3 end else -375e-3 end + case when temperature <= 155e-1 then -25e-2 else case when lon <= -41123e-3
    then 75e-2 else -5e-1 end end)))"""


@query(
    "tree_score",
    with_tables(
        f"""select {', '.join(ROW_KEY)}, round({O_GIVEN}, 9) as probability, round({O_GIVEN}, 9) as by_column,
        cast({O_GIVEN} > 5e-1 as int) as prediction from weather""",
        "weather",
    ),
)
def tree_score(t):
    nodes = t.spark.createDataFrame(GIVEN_NODES, trees.NODES)
    scored = model.score(t.weather, trees.model_of(nodes, GIVEN_FEATURES))
    both = scored.select(*ROW_KEY, "probability", trees.probability(nodes).alias("by_column"), "prediction")
    return rounded(both, "probability", "by_column", places=9)


@query(
    "tree_classify",
    with_tables(
        f"""select req_id, longitude, latitude, cast(round_even({O_GIVEN} * 100, 0) as int) as "count" from
        (select req_id, longitude, latitude, latitude lat, longitude lon, temperature,
        cast(coalesce(depth, ocean_depth) as double) ocean_depth from scenario)""",
        "weather",
        "requests",
        extra=O_SCENARIO,
    ),
)
def tree_classify(t):
    nodes = t.spark.createDataFrame(GIVEN_NODES, trees.NODES)
    return classify(t.requests, stored_weather(t), trees.model_of(nodes, GIVEN_FEATURES))
