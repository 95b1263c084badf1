"""Small files of a shared folder, by the file system that its path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> dict[str, int]:
    """Files and folders directly in `path` with their bytes (0 for folders); none if it is not there."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return {}
    return {s.getPath().getName(): 0 if s.isDirectory() else s.getLen() for s in fs.listStatus(place)}


def is_file(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place) and fs.getFileStatus(place).isFile()


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Put `text` at a path that is not taken yet, all at once: it is written beside it
    and renamed. False if somebody else was first."""
    fs, place = _at(spark, path)
    draft = place.suffix(".draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return not fs.exists(place) and fs.rename(draft, place)


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)
