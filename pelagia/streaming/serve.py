"""The online job: requests and observations keep arriving, answers appear once each.

Four queries share a store, each with a checkpoint of its own:

- ``feed_store`` adds arriving observations to the store, a commit for each micro-batch;
- ``serve`` scores requests against the store as it is when their micro-batch runs;
- ``ask_missing`` lists each place and day that is asked for and not stored, once;
- ``serve_late`` scores requests that found nothing when their observation arrives in time.

A micro-batch is handled as a table, so that places which very many requests ask for are spread as in a
batch job. Output goes to a ``BatchLog``: a restart neither loses nor repeats a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pelagia.functions.coords import KEY, keyed, with_coord_key
from pelagia.operators.keyed import first_per_key
from pelagia.operators.nearest import with_month
from pelagia.operators.weather import missing_keys, weather_match
from pelagia.plans import model as models
from pelagia.plans.classify import counted, matched_features
from pelagia.schemas import OBSERVATION, WEATHER_PARAMETERS
from pelagia.sources.requests import accepted, parse_requests, rejected
from pelagia.sources.store import BUCKET_KEY, WeatherStore, whole_key
from pelagia.sources.writers import checkpointed
from pelagia.streaming.sink import BatchLog

POINT = ("req_id", "pos")
ANSWER = "req_id long, pos int, longitude double, latitude double, count int, found boolean"
REJECTED = "req_id long, pos int, reason string"
MISSING = "key_lat double, key_lon double, key_day date"


def read_requests(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """JSON request lines as files arrive: ``req_id, value, asked_at``.

    The id is a hash of the text and its file, the time that of the file: a batch that runs again gives
    the same rows. Equal lines of one file are one request.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return lines.select(
        F.xxhash64(F.col("_metadata.file_path"), F.col("value")).alias("req_id"),
        "value",
        F.col("_metadata.file_modification_time").alias("asked_at"),
    )


def read_observations(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Observations as Parquet files arrive, with ``arrived_at``."""
    reader = spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(folder)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("arrived_at"))


def _started(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None, name: str
) -> StreamingQuery:
    """Run to the end of what is there, or every so often (as in ``10 seconds``)."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).queryName(name)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def feed_store(
    observations: DataFrame,
    store: WeatherStore,
    latest: Sequence[str],
    checkpoint: str,
    source: str = "feed",
    every: str | None = None,
) -> StreamingQuery:
    """Add arriving observations to the store; a batch that runs again changes nothing.

    ``source`` names this query in the store's versions: its batches count up from 0 there, so a new
    checkpoint needs a new name.
    """

    def handle(batch: DataFrame, number: int) -> None:
        store.upsert(batch, latest, (source, number))

    return _started(observations, handle, checkpoint, every, source)


def serve(
    requests: DataFrame,
    store: WeatherStore,
    model: PipelineModel,
    path: str,
    checkpoint: str,
    strict: bool = False,
    clean: bool = False,
    depth_delta: str = "found",
    every: str | None = None,
) -> StreamingQuery:
    """Score requests (``req_id, value``); answers and refused rows go to folders of ``path``.

    Every micro-batch reads the store's version of its moment, all of it one version. ``found``
    tells whether the place and day were stored.
    """
    spark = requests.sparkSession
    answers, refused = BatchLog(spark, f"{path}/answers"), BatchLog(spark, f"{path}/rejected")
    names = models.feature_names(model)

    def handle(batch: DataFrame, number: int) -> None:
        if answers.done(number):
            return
        # equal lines of a file have one id and one answer
        parsed = checkpointed(parse_requests(batch.dropDuplicates(["req_id"])))
        points = with_month(accepted(parsed, strict))
        matched = weather_match(points, store.at(), [], POINT)
        rows = matched_features(matched, names, clean, depth_delta)
        refused.write(rejected(parsed).select(*POINT, "reason"), number)
        # last, since it says that the batch is done
        answers.write(counted(rows, model, [*POINT, "found"]).select(*_names(ANSWER)), number)

    return _started(requests, handle, checkpoint, every, "serve")


def asked_points(requests: DataFrame, strict: bool = False) -> DataFrame:
    """Usable coordinates of a request stream, with ``asked_at``."""
    return accepted(parse_requests(requests, keep=["asked_at"]), strict)


def ask_missing(
    requests: DataFrame, store: WeatherStore, path: str, checkpoint: str, memory: str = "30 days", every: str | None = None
) -> StreamingQuery:
    """List each place and day that is asked for and not stored, once for as long as ``memory``.

    The keys that were asked for are the state of the query, one row each, which expires; a key that is asked
    for again after that, and is still missing, is listed again.
    """
    missing = BatchLog(requests.sparkSession, f"{path}/missing")
    points = with_coord_key(asked_points(requests), "latitude", "longitude")
    new = points.select(*KEY, "asked_at").withWatermark("asked_at", memory).dropDuplicatesWithinWatermark(KEY)

    def handle(batch: DataFrame, number: int) -> None:
        if missing.done(number):
            return
        named = checkpointed(batch.select(F.col(KEY[0]).alias("lat"), F.col(KEY[1]).alias("lon"), F.col(KEY[2]).alias("date")))
        missing.write(missing_keys(named, store.at(), "lat", "lon", "date"), number)

    return _started(new, handle, checkpoint, every, "ask_missing")


def arrived(requests: DataFrame, observations: DataFrame, wait: str = "7 days", late: str = "1 hour") -> DataFrame:
    """Usable coordinates of a stream with observations of their place and day that come within ``wait``.

    Both sides are kept as state, row by row, until the other side's time has passed by ``wait``. ``late`` is
    how far behind the latest time a row may come on either side.
    """
    points = whole_key(with_coord_key(asked_points(requests), "latitude", "longitude")).drop(*KEY[:2])
    points = points.withWatermark("asked_at", late).dropna("any", subset=BUCKET_KEY)
    seen = whole_key(keyed(observations.withColumnsRenamed({"arrived_at": "__at"})))
    seen = seen.select(*[F.col(k).alias(f"o_{k}") for k in BUCKET_KEY], *WEATHER_PARAMETERS, F.col("__at").alias("arrived_at"))
    seen = seen.withWatermark("arrived_at", late)
    on = F.expr(f"arrived_at >= asked_at - interval {wait} and arrived_at <= asked_at + interval {wait}")
    for k in BUCKET_KEY:
        on = on & (F.col(k) == F.col(f"o_{k}"))
    return points.join(seen, on).drop(*[f"o_{k}" for k in BUCKET_KEY])


def serve_late(
    requests: DataFrame,
    observations: DataFrame,
    model: PipelineModel,
    path: str,
    checkpoint: str,
    wait: str = "7 days",
    clean: bool = False,
    depth_delta: str = "found",
    every: str | None = None,
) -> StreamingQuery:
    """Score requests whose observation arrives within ``wait`` of them, to the folder ``late`` of ``path``.

    Readers of ``read_answers`` see the late answer where ``serve`` had found nothing.
    """
    late = BatchLog(requests.sparkSession, f"{path}/late")
    names = models.feature_names(model)

    def handle(batch: DataFrame, number: int) -> None:
        if late.done(number):
            return
        # of several observations that came together the last
        first = first_per_key(checkpointed(batch), POINT, [F.desc("arrived_at"), *WEATHER_PARAMETERS])
        rows = matched_features(with_month(first.withColumn("found", F.lit(True))), names, clean, depth_delta)
        late.write(counted(rows, model, [*POINT, "found"]).select(*_names(ANSWER)), number)

    return _started(arrived(requests, observations, wait), handle, checkpoint, every, "serve_late")


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """One answer for each coordinate: the one that found its weather, or else the one without.

    Of several late answers the first counts, by the order of batches.
    """
    parts = []
    for rank, name in enumerate(("answers", "late")):
        rows = BatchLog(spark, f"{path}/{name}").read(ANSWER)
        file = F.col("_metadata.file_path") if rows.inputFiles() else F.lit("")
        parts.append(rows.select("*", F.lit(rank).alias("rank"), file.alias("file")))
    both = parts[0].unionByName(parts[1])
    return first_per_key(both, POINT, [F.desc("found"), "rank", "file", "count"]).select(*_names(ANSWER))


def _names(schema: str) -> list[str]:
    return [f.name for f in T.StructType.fromDDL(schema).fields]
