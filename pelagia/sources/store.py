"""A store of keyed observations that grows by small commits and is laid out for lookups.

Data lie in ``data/<commit>/part=<month or day>/``, bucketed by the key, and never change. A version is
one small file that says which commit holds each part. An upsert merges only the parts that its batch
touches into a new commit, and then publishes the next version in one step: a failed
attempt leaves nothing that a reader could see, and files of other parts stay as they are.

A version is read as a bucketed table, so that a join on the key moves no row of the store. The key is kept in whole
numbers (coordinates times 1e5): join keys of type double are rewritten by Spark, which hides the buckets.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions.coords import KEY, keyed
from pelagia.operators.keyed import first_per_key
from pelagia.schemas import WEATHER_PARAMETERS
from pelagia.sources import commits
from pelagia.sources.writers import checkpointed

# The key in whole numbers: columns of buckets.
BUCKET_KEY = ["lat_e5", "lon_e5", "key_day"]
PART_FORMAT = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}
ATTEMPTS = 5
# Rows of a bucket, one task's share of a join or a commit, that a store is laid out for, and how many times that
# many make it get more buckets.
BUCKET_ROWS, FULL = 2_000_000, 4


@dataclass(frozen=True)
class Version:
    """Which commit holds each part, and how many rows; the last batch of every source that is in it."""

    number: int = 0
    buckets: int = 0
    by: str = "month"
    parts: dict[str, str] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


class ConflictError(RuntimeError):
    """Other writers were faster, again and again."""


def whole_key(df: DataFrame) -> DataFrame:
    """Add the key's coordinates in whole numbers; null for what is no place."""

    def e5(name: str) -> Column:
        c = F.col(name)
        return F.when(~F.isnan(c) & (F.abs(c) < 1e9), F.round(c * 1e5).cast("long"))

    return df.withColumns({"lat_e5": e5(KEY[0]), "lon_e5": e5(KEY[1])})


def create_store(spark: SparkSession, path: str, buckets: int, by: str = "month") -> WeatherStore:
    """An empty store; ``buckets`` files at least for each part (a month or a day).

    A task joins or writes one bucket of all parts, so that a store of many rows gets more of them.
    """
    if by not in PART_FORMAT:
        raise ValueError(f"parts are by {' or '.join(PART_FORMAT)}")
    store = WeatherStore(spark, path)
    if not store._publish(Version(number=1, buckets=buckets, by=by)):
        raise FileExistsError(f"there is a store at {path}")
    return store


class WeatherStore:
    """One observation for each place and day, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, pinned: Version | None = None):
        self.spark, self.path, self.pinned = spark, commits.qualified(spark, path).rstrip("/"), pinned

    # ------------------------------------------------------------ versions

    def _file(self, number: int) -> str:
        return f"{self.path}/versions/{number:012d}.json"

    def _publish(self, version: Version) -> bool:
        return commits.publish(self.spark, self._file(version.number), json.dumps(asdict(version)))

    def versions(self) -> list[int]:
        found = commits.names(self.spark, f"{self.path}/versions")
        return [int(name[:-5]) for name in found if name.endswith(".json") and name[0] != "."]

    def version(self, number: int | None = None) -> Version:
        """The last version, or an older one; of a store ``at`` a version, that one."""
        if number is None and self.pinned is not None:
            return self.pinned
        if number is None:
            number = max(self.versions(), default=0)
        if not number:
            raise FileNotFoundError(f"no store at {self.path}")
        return Version(**json.loads(commits.read_text(self.spark, self._file(number))))

    def at(self, version: Version | None = None) -> WeatherStore:
        """The store as it is in one version, the last one by default, whatever is added later."""
        return WeatherStore(self.spark, self.path, version or self.version())

    # ------------------------------------------------------------ reading

    def read(
        self, first: date | None = None, last: date | None = None, version: Version | None = None
    ) -> DataFrame:
        """The key, also in whole numbers, and the parameters; from one day to another if given.

        The constants prune parts and reach the scan. A frame stays with the version it was made from.
        """
        version = version or self.version()
        if not version.parts:
            return self.spark.createDataFrame([], _SCHEMA).selectExpr(*_READ)
        rows = self.spark.table(self._table(version))
        for day, of_part, of_day in (
            (first, F.col("part").__ge__, F.col("key_day").__ge__),
            (last, F.col("part").__le__, F.col("key_day").__le__),
        ):
            if day is not None:
                limit = day.strftime("%Y-%m" if version.by == "month" else "%Y-%m-%d")
                rows = rows.filter(of_part(limit) & of_day(F.lit(day)))
        return rows.selectExpr(*_READ)

    def _table(self, version: Version) -> str:
        """The version as a table of this session, with its buckets and parts."""
        name = f"pelagia_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{version.number}"
        if self.spark.catalog.tableExists(name):
            return name
        key = ", ".join(BUCKET_KEY)
        self.spark.sql(
            f"create table if not exists {name} ({_SCHEMA}, part string) using parquet partitioned by (part) "
            f"clustered by ({key}) sorted by ({key}) into {version.buckets} buckets location '{self.path}/data'"
        )
        places = [f"partition (part = '{p}') location '{self._folder(c)}/part={p}'" for p, c in version.parts.items()]
        for at in range(0, len(places), 500):
            self.spark.sql(f"alter table {name} add if not exists {' '.join(places[at : at + 500])}")
        return name

    def _folder(self, commit: str) -> str:
        return f"{self.path}/data/{commit}"

    # ------------------------------------------------------------ writing

    def upsert(self, new: DataFrame, latest: Sequence[str], batch: tuple[str, int] | None = None) -> Version:
        """Add observations; new ones replace stored ones of their key. Returns the version that has them.

        Among several new observations of a key the last by ``latest`` wins. Those without a place or a
        day are left out, as nothing could find them. ``batch`` names the source and the rising
        number of the batch: a batch that is in the store already changes nothing. A commit that
        another writer overtakes is merged again with what that writer has published.
        """
        rows = whole_key(keyed(new))
        for name in set(WEATHER_PARAMETERS) - set(rows.columns):
            rows = rows.withColumn(name, F.lit(None).cast("double"))
        rows = rows.dropna("any", subset=BUCKET_KEY)
        known = [F.col(c).desc() for c in latest if c in rows.columns]
        ties = [F.col(c).desc() for c in WEATHER_PARAMETERS if c not in latest]
        columns = [*BUCKET_KEY, *WEATHER_PARAMETERS]
        if self.pinned is not None:
            raise ValueError("a store at one version is not written to")
        fresh = None
        for _ in range(ATTEMPTS):
            now = self.version()
            if batch is not None and now.applied.get(batch[0], -1) >= batch[1]:
                return now
            if fresh is None:
                part = F.date_format("key_day", PART_FORMAT[now.by]).alias("part")
                fresh = checkpointed(first_per_key(rows, BUCKET_KEY, [*known, *ties]).select(*columns, part))
                # As many rows as parts.
                new_rows = dict(fresh.groupBy("part").count().collect())
            applied = now.applied | ({batch[0]: batch[1]} if batch is not None else {})
            commit, counts = uuid.uuid4().hex, {}
            buckets = _enough_buckets(now, sum(new_rows.values()))
            # all parts of a version have the same buckets
            touched = sorted(set(new_rows) if buckets == now.buckets else set(new_rows) | set(now.parts))
            if touched:
                counts = self._write(now, fresh, touched, commit, buckets)
            parts, counted = now.parts | {p: commit for p in touched}, now.rows | counts
            following = replace(
                now, number=now.number + 1, buckets=buckets, parts=parts, rows=counted, applied=applied
            )
            if self._publish(following):
                return following
            commits.remove(self.spark, self._folder(commit))
        raise ConflictError(f"no commit in {ATTEMPTS} attempts at {self.path}")

    def _write(
        self, now: Version, fresh: DataFrame, touched: list[str], commit: str, buckets: int
    ) -> dict[str, int]:
        """The touched parts with the new rows, as a commit of its own; returns the rows of each."""
        merged = fresh.repartition(buckets, *BUCKET_KEY)
        old = [p for p in touched if p in now.parts]
        if old:
            rows = self.spark.table(self._table(now)).filter(F.col("part").isin(old))
            kept = rows.join(fresh.select(*BUCKET_KEY), BUCKET_KEY, "left_anti")
            moved = kept if buckets == now.buckets else kept.repartition(buckets, *BUCKET_KEY)
            merged = merged.unionByName(moved)
        name = f"pelagia_commit_{commit}"
        (
            merged.write.partitionBy("part")
            .bucketBy(buckets, *BUCKET_KEY)
            .sortBy(*BUCKET_KEY)
            .option("path", self._folder(commit))
            .saveAsTable(name)
        )
        # The files stay: the table has a path of its own.
        self.spark.sql(f"drop table {name}")
        written = self.spark.read.schema(f"{_SCHEMA}, part string").parquet(self._folder(commit))
        return dict(written.groupBy("part").count().collect())

    def expire(self, keep: int) -> list[str]:
        """Drop all but the last versions, with the commits that only these refer to; returns the commits."""
        numbers = self.versions()
        gone, kept = numbers[:-keep] if keep else numbers, numbers[-keep:] if keep else []
        if not kept:
            raise ValueError("keep one version at least")
        used = {c for n in kept for c in self.version(n).parts.values()}
        dropped = sorted({c for n in gone for c in self.version(n).parts.values()} - used)
        for number in gone:
            commits.remove(self.spark, self._file(number))
        for commit in dropped:
            commits.remove(self.spark, self._folder(commit))
        return dropped


def _enough_buckets(now: Version, more: int) -> int:
    """Buckets of the version that follows with some more rows: doubled as often as they are overfull."""
    rows, buckets = sum(now.rows.values()) + more, now.buckets
    if rows <= buckets * BUCKET_ROWS * (FULL if now.parts else 1):
        return buckets
    while rows > buckets * BUCKET_ROWS:
        buckets *= 2
    return buckets


_SCHEMA = "lat_e5 long, lon_e5 long, key_day date, " + ", ".join(f"{p} double" for p in WEATHER_PARAMETERS)
# A whole number over 1e5 is the double that rounding to 5 places gives.
_READ = [*BUCKET_KEY, f"lat_e5 / 1e5 as {KEY[0]}", f"lon_e5 / 1e5 as {KEY[1]}", *WEATHER_PARAMETERS]
