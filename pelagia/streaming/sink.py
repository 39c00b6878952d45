"""Output of micro-batches that appears once and whole, however often a batch runs."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from pelagia.sources import commits


class BatchLog:
    """Parquet folders of micro-batches; a batch is there when its pointer file is.

    A batch that runs again after its pointer was published changes nothing. An attempt that died before
    that leaves a folder that no pointer names, and no reader sees.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, commits.qualified(spark, path).rstrip("/")

    def _pointer(self, batch: int) -> str:
        return f"{self.path}/batches/{batch:012d}.json"

    def done(self, batch: int) -> bool:
        return f"{batch:012d}.json" in commits.names(self.spark, f"{self.path}/batches")

    def write(self, df: DataFrame, batch: int) -> bool:
        """Write the output of a batch; false if it was there already."""
        if self.done(batch):
            return False
        folder = f"{batch:012d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/data/{folder}")
        text = json.dumps({"batch": batch, "folder": folder})
        if commits.publish(self.spark, self._pointer(batch), text):
            return True
        commits.remove(self.spark, f"{self.path}/data/{folder}")
        return False

    def folders(self, first: int = 0) -> list[str]:
        """Folders of the published batches from one on, in their order."""
        if not commits.names(self.spark, f"{self.path}/batches"):
            return []
        rows = self.spark.read.schema("batch long, folder string").json(f"{self.path}/batches").collect()
        return [f"{self.path}/data/{r['folder']}" for r in sorted(rows) if r["batch"] >= first]

    def read(self, schema: str, first: int = 0) -> DataFrame:
        """Rows of the published batches from one on; none before the first batch."""
        found = self.folders(first)
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*found)
