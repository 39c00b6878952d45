"""Small files that appear whole or not at all, by which written data becomes visible."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system."""
    return _system(spark, path).makeQualified(_path(spark, path)).toString()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    system, path = _system(spark, folder), _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file under a name that nobody has taken; false if somebody has.

    The text is written under another name and renamed, which on the file systems that Spark's own
    committers rely on is one step: of two writers one wins, and no reader sees part of a file.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    system, final = _system(spark, path), _path(spark, path)
    draft = _path(spark, f"{final.getParent().toString()}/.{uuid.uuid4().hex}.draft")
    system.mkdirs(final.getParent())
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf)
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(final), never)
        return True
    except Exception:
        if not system.exists(final):
            raise
        system.delete(draft, False)
        return False


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder."""
    _system(spark, path).delete(_path(spark, path), True)
