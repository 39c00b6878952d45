"""Written tables in the shared folder, which survive lost executors and are computed once."""

from pyspark.sql import SparkSession

from pelagia.sources.writers import checkpointed as stored
from pelagia.sources.writers import shared_folder

__all__ = ["shared_folder", "short_batches", "stored"]

# Rows that a Python worker gets at a time. Whole texts are long rows.
BATCH_ROWS = 2000


def short_batches(spark: SparkSession) -> SparkSession:
    """Have the session send fewer rows at a time to Python workers than it does by default."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    return spark
