"""The few file operations that Spark's readers and writers don't have, in any file system Spark knows."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing if there is none."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _at(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; one that is there already is an error."""
    files, place = _at(spark, path)
    folder, _, name = path.rpartition("/")
    _, staged = _at(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = files.create(staged)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(staged, place):
        files.delete(staged, False)
        raise OSError(f"{path} was written by another job")


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)
