"""Files and folders of any file system that Spark reaches, by way of its own file-system client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (none, if it does not exist)."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def bytes_of(spark: SparkSession, path: str) -> int:
    """Size of all files below ``path`` (0, if it does not exist)."""
    files, place = _file_system(spark, path)
    return files.getContentSummary(place).getLength() if files.exists(place) else 0


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (none, if it does not exist)."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isFile())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written under another name and then moved, so that no reader sees a part of it."""
    files, place = _file_system(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_new-{place.getName()}")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(place, False)
    files.rename(beside, place)
