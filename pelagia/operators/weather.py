"""Stored weather observations: matching, filling gaps, keeping the latest.

Wherever observations are asked for they may be a table, raw or keyed, or a ``WeatherStore``, which
joins without moving its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.functions.coords import KEY, keyed, with_coord_key
from pelagia.operators import joins
from pelagia.operators.keyed import first_per_key
from pelagia.schemas import WEATHER_PARAMETERS
from pelagia.sources.store import BUCKET_KEY, WeatherStore, whole_key


def observations(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Pick, rename and cast the columns of a stored observation table.

    ``names`` maps a parameter to the table's column where the two differ.
    """
    names = names or {}
    numbers = ["lat", "lon", *WEATHER_PARAMETERS]
    cast = {n: F.col(names.get(n, n)).cast("double").alias(n) for n in numbers}
    date = F.col(names.get("date", "date")).cast("timestamp_ntz").alias("date")
    return df.select(cast["lat"], cast["lon"], date, *[cast[n] for n in WEATHER_PARAMETERS])


def weather_by_key(weather: DataFrame, order: Sequence, one_per_key: bool = False) -> DataFrame:
    """First observation of every coordinate and day, by ``order``.

    The result can be stored and passed wherever observations are asked for. Columns of
    ``order`` that such a table no longer has are left out; the parameters decide last.
    ``one_per_key`` says that there is one observation for each key, which spares
    sorting them out again; a stream should be given such a table, as it reads it for
    every micro-batch.
    """
    rows = keyed(weather)
    if "depth" in rows.columns:
        rows = rows.withColumn("ocean_depth", F.coalesce("ocean_depth", "depth"))
    if one_per_key:
        return rows.select(*KEY, *WEATHER_PARAMETERS)
    known = [c for c in order if not isinstance(c, str) or c in rows.columns]
    ties = [c for c in WEATHER_PARAMETERS if c not in known]
    return first_per_key(rows, KEY, [*known, *ties]).select(*KEY, *WEATHER_PARAMETERS)


def days_between(weather: DataFrame, first, last) -> DataFrame:
    """Observations from one day (a date) to another; the constants reach the scan."""
    if first is None or last is None:
        return weather.limit(0)
    if "date" in weather.columns:
        start, after = datetime.combine(first, time.min), datetime.combine(last + timedelta(days=1), time.min)
        at = F.col("date")
        return weather.filter(
            (at >= F.lit(str(start)).cast("timestamp_ntz")) & (at < F.lit(str(after)).cast("timestamp_ntz"))
        )
    return weather.filter(F.col("key_day").between(F.lit(first), F.lit(last)))


def asked_only(weather: DataFrame, asked: DataFrame) -> tuple[DataFrame, bool]:
    """Observations of the days that are asked for, before any are ranked, and whether the keys asked for are few.

    The first and the last day asked for are constants for the scan. There are at most as many keys as points
    that ask, which are counted in the same pass, so that observations that have to be worked out are
    not worked out for their number alone. Of few points the places narrow the observations down, too. With
    many that would move and sort all observations before they are ranked, where ranking first leaves one of a key
    in each task; those nobody asked for go in the lookup. A stream gets all observations, and these
    are counted.
    """
    if asked.isStreaming:
        return weather, _is_small(weather)
    first, last, points = asked.agg(F.min(KEY[2]), F.max(KEY[2]), F.count(F.lit(1))).first()
    near, few = keyed(days_between(weather, first, last)), points <= joins.BROADCAST_ROWS
    return near.join(asked.select(*KEY).distinct(), KEY, "left_semi") if few else near, few


def _from_store(
    asked: DataFrame, store: WeatherStore, spread: Sequence[str], how: str, *flags: Column
) -> DataFrame:
    """Points with a key, and what the store holds for it: only the points are shuffled."""
    if asked.isStreaming:
        rows = store.read()
    else:
        span = asked.agg(F.min(KEY[2]), F.max(KEY[2])).first()
        rows = store.read(*span) if span[0] is not None else store.read().limit(0)
    found = rows.select(*BUCKET_KEY, *WEATHER_PARAMETERS, *flags)
    return joins.bucketed_lookup(whole_key(asked), found, BUCKET_KEY, how).drop(*BUCKET_KEY[:2])


def weather_match(
    requests: DataFrame,
    weather: DataFrame | WeatherStore,
    order: Sequence,
    spread: Sequence[str],
    lat: str = "latitude",
    lon: str = "longitude",
    date: str = "date",
    one_per_key: bool = False,
) -> DataFrame:
    """Weather of every requested place and day; ``found`` is false without one.

    No request is lost or repeated. Where nothing is found the parameters are
    null here and become 0 in the scenario and model rows.
    """
    asked = with_coord_key(requests, lat, lon, date)
    flag = F.lit(True).alias("found")
    if isinstance(weather, WeatherStore):
        matched = _from_store(asked, weather, spread, "left", flag)
    else:
        near, small = asked_only(weather, asked)
        found = weather_by_key(near, order, one_per_key).select("*", flag)
        matched = joins.lookup(asked, found, KEY, spread, small=small)
    return matched.withColumn("found", F.coalesce("found", F.lit(False))).drop(*KEY)


def answer(
    requests: DataFrame,
    weather: DataFrame | WeatherStore,
    order: Sequence,
    spread: Sequence[str],
    **options,
) -> DataFrame:
    """Weather of every asked coordinate, in the order of ``spread`` (request and position in it).

    A coordinate that is asked twice is answered twice; where nothing is stored the parameters are
    null. Takes the options of ``weather_match``.
    """
    return weather_match(requests, weather, order, spread, **options).orderBy(*spread)


def attach_weather(
    points: DataFrame,
    weather: DataFrame | WeatherStore,
    order: Sequence,
    spread: Sequence[str],
    one_per_key: bool = False,
) -> DataFrame:
    """Weather of points on their day; points without any are left out.

    Only observations of days that are asked for are ranked. A table of one observation for each key
    needs no ranking and is joined as it is.
    """
    asked = with_coord_key(points)
    if isinstance(weather, WeatherStore):
        return _from_store(asked, weather, spread, "inner").drop(*KEY)
    near, small = (weather, _is_small(weather)) if one_per_key else asked_only(weather, asked)
    found = weather_by_key(near, order, one_per_key)
    return joins.lookup(asked, found, KEY, spread, how="inner", small=small).drop(*KEY)


def _is_small(weather: DataFrame) -> bool:
    """There are at most as many keys as observations, which are there to be counted."""
    return joins.has_at_most(weather, joins.BROADCAST_ROWS)


def missing_keys(
    requests: DataFrame,
    store: DataFrame | WeatherStore,
    lat: str = "latitude",
    lon: str = "longitude",
    date: str = "date",
) -> DataFrame:
    """Places and days that are asked for and not stored yet, once each.

    Of the store the days between the first and the last one asked for are read.
    """
    asked = with_coord_key(requests, lat, lon, date).select(*KEY).distinct()
    span = asked.agg(F.min(KEY[2]), F.max(KEY[2])).first()
    if isinstance(store, WeatherStore):
        stored = store.read(*span) if span[0] is not None else store.read().limit(0)
        return whole_key(asked).join(stored.select(*BUCKET_KEY), BUCKET_KEY, "left_anti").select(*KEY)
    stored = keyed(days_between(store, span[0], span[1])).select(*KEY)
    return asked.join(stored, KEY, "left_anti")


def upsert(store: DataFrame, new: DataFrame, latest: Sequence[str]) -> DataFrame:
    """Store with new observations added; new replaces stored for the same key.

    Among several new observations of a key the last by ``latest`` wins. The store may be raw
    or keyed and keeps its columns. Its rows are neither sorted nor compared among
    themselves: those with a new key go, the others stay as they are.
    """
    fresh = keyed(new)
    known = [F.col(c).desc() for c in latest if c in fresh.columns]
    ties = [F.col(c).desc() for c in WEATHER_PARAMETERS if c in fresh.columns and c not in latest]
    fresh = first_per_key(fresh, KEY, [*known, *ties])
    kept = keyed(store).join(keyed(new).select(*KEY).distinct(), KEY, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True).select(*store.columns)


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; absent columns are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
