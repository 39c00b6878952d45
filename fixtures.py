"""Sightings, weather, grids and requests derived from ``orders`` and ``lineitem``.

The same SQL text makes the tables in Spark and, as WITH clauses, in the oracle. All rows of the
given tables are used. So that lookups also miss, the weather of every fifth sighting is stored at
another place, and the grids from 2001 on belong to other years.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from pelagia.schemas import Box

RAW_DATE = {
    "spark": """case when o_orderkey%97=0 then null when o_orderkey%89=0 then ''
        else date_format(o_orderdate,"EEE, dd MMM yyyy HH:mm:ss 'GMT'") end""",
    "duckdb": """case when o_orderkey%97=0 then null when o_orderkey%89=0 then ''
        else strftime(o_orderdate,'%a, %d %b %Y %H:%M:%S GMT') end""",
}

SQL = {
    "sightings": """
        select o_orderkey id, <raw_date> raw_date, o_orderdate date,
               year(o_orderdate) y, month(o_orderdate) m,
               ((o_orderkey*7919)%18001)/1e2-9e1 lat,
               ((o_custkey*104729+o_orderkey*31)%36001)/1e2-1.8e2 lon
        from {orders}""",
    "weather": """
        select s.id, l_linenumber, l_partkey, l_suppkey,
               case when s.id%5=0 then s.lat+25e-2 else s.lat end lat, s.lon, s.date,
               l_quantity-1e1 temperature, l_discount*1e2 max_individual_wave_height,
               cast((l_partkey*37)%360 as double) mean_wave_direction,
               l_tax*1e2 mean_period_total_swell, cast(l_linenumber%9 as double) clouds,
               case when l_returnflag='A' then -666e0 else l_extendedprice/1e1 end ocean_depth
        from {sightings} s join {lineitem} on l_orderkey=s.id""",
    "phyto_grid": """
        select case when year(l_shipdate)<2001 then year(l_shipdate) else year(l_shipdate)+100 end y,
               month(l_shipdate) m, ((l_partkey*13)%73)*5e0-1.8e2 lon,
               ((l_suppkey*17+l_partkey)%37)*5e0-9e1 lat, min(l_tax+l_discount) chlor_a
        from {lineitem} group by 1,2,3,4""",
    "requests": """
        select id req_id, lat latitude, lon longitude, date,
               case when id%3=0 then null else cast(id%50 as int) end depth,
               case when id%4=0 then null else (id%7)/2e0 end d_temp,
               case when id%4=0 then null else (id%3)/1e0 end d_clouds,
               case when id%4=0 then null else (id%5)/1e1 end d_ocean
        from {sightings}""",
}

# Which derived tables each one is made from.
NEEDS = {
    "sightings": ["orders"],
    "weather": ["sightings", "lineitem"],
    "phyto_grid": ["lineitem"],
    "requests": ["sightings"],
}

# First observation of a place and day.
WEATHER_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "temperature",
    "ocean_depth",
    "mean_period_total_swell",
    "max_individual_wave_height",
]

WINDOW = (datetime(1996, 1, 1), datetime(2001, 1, 1))
TEST_FROM = datetime(2000, 1, 1)
BOX = Box()


class Tables:
    """The given and the derived tables of one folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in SQL:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = SQL[name].replace("<raw_date>", RAW_DATE["spark"])
        return self.spark.sql(text, **{t: getattr(self, t) for t in NEEDS[name]})


def with_tables(query: str, *names: str, extra: str = "") -> str:
    """Oracle text: the derived tables as WITH clauses, then the query.

    ``extra`` holds further clauses (``a as (...), b as (...)``).
    """
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name in SQL and name not in order:
            order.append(name)

    for name in names:
        add(name)
    clauses = []
    for name in order:
        text = SQL[name].replace("<raw_date>", RAW_DATE["duckdb"])
        for need in NEEDS[name]:
            text = text.replace("{" + need + "}", need)
        clauses.append(f"{name} as ({text})")
    if extra:
        clauses.append(extra)
    return (f"with {', '.join(clauses)} " if clauses else "") + query
