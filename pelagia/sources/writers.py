"""Writing tables, and cutting long plans."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a table without an index; CSV gets a header."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the one that ``spark.checkpoint.dir`` names; raises without it.

    Spark removes the folder when the application ends.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{top.rstrip('/')}/pelagia-{uuid.uuid4().hex}"
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(jvm)
    system.deleteOnExit(jvm)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Store a frame that is used several times in the shared folder, and read it from there."""
    path = shared_folder(df.sparkSession) + "/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
