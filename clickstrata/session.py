"""Session settings the results depend on, and the shared working folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Hours and days are cut in this zone.
    "spark.sql.session.timeZone": "UTC",
    # 64-bit timestamps carry min/max statistics in Parquet; the 96-bit default does not.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def working_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder named by ``spark.checkpoint.dir``.

    Without that setting, only a local session gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def overridden(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Run a block under other runtime settings and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Bytes a shuffle partition should hold.
PARTITION_BYTES = 128 * 1024 * 1024


def partitions_for(frame: DataFrame, days: int | None = None) -> int:
    """Shuffle partitions for an aggregation over a frame: by the size of its files.

    Spark's estimate follows the columns a frame reads but not the days it
    selects, so a selection of days gets no more than the session's own number
    for each. Adaptive execution joins what turns out small, so this may be
    generous.
    """
    stats = frame._jdf.queryExecution().optimizedPlan().stats()
    size = int(str(stats.sizeInBytes()))
    least = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(size / PARTITION_BYTES)
    return max(least, wanted if days is None else min(least * max(1, days), wanted))


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def holds_only_files(spark: SparkSession, root: str) -> bool:
    """Whether a folder has files and no folder in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    entries = [e for e in files.listStatus(folder) if e.getPath().getName()[0] not in "._"]
    return bool(entries) and not any(entry.isDirectory() for entry in entries)


def files_beside_folders(spark: SparkSession, root: str) -> list[str]:
    """Files directly in a folder that holds other folders too; none if it holds only files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    entries = [e for e in files.listStatus(folder) if e.getPath().getName()[0] not in "._"]
    if not any(entry.isDirectory() for entry in entries):
        return []
    return [entry.getPath().toString() for entry in entries if entry.isFile()]
