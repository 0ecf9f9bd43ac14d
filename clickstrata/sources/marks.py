"""How far a job has come: a numbered empty file in a folder, put there in one step."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """What is in a folder, but for hidden files; nothing if there is none."""
    path, files = file_system(spark, folder)
    if not files.exists(path):
        return []
    found = [entry.getPath().getName() for entry in files.listStatus(path)]
    return [name for name in found if name[0] not in "._"]


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name) for name in names(spark, folder) if name.isdigit())


def last_mark(spark: SparkSession, folder: str) -> int:
    """The highest number set in a folder; -1 without any."""
    return max(_numbers(spark, folder), default=-1)


def set_mark(spark: SparkSession, folder: str, number: int) -> None:
    """Set a number and take away lower ones, so a folder holds a file or two."""
    path, files = file_system(spark, f"{folder}/{number}")
    files.create(path, True).close()
    for lower in _numbers(spark, folder):
        if lower < number:
            remove(spark, f"{folder}/{lower}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that nothing refers to any more."""
    hadoop_path, files = file_system(spark, path)
    files.delete(hadoop_path, True)


def children(spark: SparkSession, folder: str, key: str) -> list[int]:
    """The numbers n of the folders ``key=n`` in a folder."""
    found = names(spark, folder)
    return sorted(int(name.removeprefix(f"{key}=")) for name in found if name.startswith(f"{key}="))
