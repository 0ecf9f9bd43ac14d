"""The ingest sink and what is read from it.

Each batch of an ingest is a folder ``batch=N`` with both zones: ``zone=silver/year=/month=/
day=`` for events and ``zone=quarantine/...`` for refused lines. A batch written again
replaces its folder. Readers go by the number of the last finished batch, so they see all of
a batch or nothing, and there is no list of files to read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from clickstrata.schemas import (
    BATCH,
    DAY_KEYS,
    LAKE_READ,
    QUARANTINE_ZONE,
    SILVER,
    SILVER_ZONE,
    ZONE,
)
from clickstrata.session import overridden
from clickstrata.sources.marks import last_mark, set_mark

# On this data 40 percent smaller than the default codec, at the same speed.
CODEC = "zstd"


def committed(spark: SparkSession, lake: str) -> int:
    """The number of the last finished batch, -1 if there is none."""
    return last_mark(spark, f"{lake}/_committed")


def write_batch(
    rows: DataFrame, lake: str, number: int, before_it_counts: Callable[[], None] | None = None
) -> bool:
    """Store a batch and count it as finished; False if it was already."""
    spark = rows.sparkSession
    if number <= committed(spark, lake):
        return False
    writer = rows.write.mode("overwrite").partitionBy(ZONE, *DAY_KEYS)
    writer.option("compression", CODEC).parquet(f"{lake}/{BATCH}={number}")
    if before_it_counts:
        before_it_counts()
    set_mark(spark, f"{lake}/_committed", number)
    return True


def read_batches(spark: SparkSession, lake: str, after: int | None = None) -> DataFrame:
    """All finished batches, or those after a given one, whose folders alone are listed."""
    last = committed(spark, lake)
    reader = spark.read.schema(LAKE_READ).option("basePath", lake)
    if after is None:
        return reader.parquet(lake).where(F.col(BATCH) <= last)
    if after >= last:
        return spark.createDataFrame([], LAKE_READ)
    return reader.parquet(*[f"{lake}/{BATCH}={n}" for n in range(after + 1, last + 1)])


def silver_of(rows: DataFrame, *others: str) -> DataFrame:
    return rows.where(F.col(ZONE) == SILVER_ZONE).select(*SILVER.names, *others)


def read_silver(spark: SparkSession, lake: str) -> DataFrame:
    return silver_of(read_batches(spark, lake))


def read_quarantine(spark: SparkSession, lake: str) -> DataFrame:
    """Refused lines with their file; year, month and day are those of arrival."""
    refused = read_batches(spark, lake).where(F.col(ZONE) == QUARANTINE_ZONE)
    return refused.select("raw_line", "source_file", *DAY_KEYS)


def day_number() -> Column:
    """The event day as one number, 20240131 for 2024-01-31; from partition columns only."""
    year, month, day = (F.col(key).cast("bigint") for key in DAY_KEYS)
    return year * 10_000 + month * 100 + day


def on_days(silver: DataFrame, days: list[int | None]) -> DataFrame:
    """Silver rows of the given days, None for rows without a date.

    The test is on the partition columns, so other days are not read.
    """
    known = [day for day in days if day is not None]
    wanted = day_number().isin(known)
    return silver.where(wanted | F.col("year").isNull() if None in days else wanted)


def write_silver(silver: DataFrame, root: str) -> int:
    """Batch form of the silver sink: append, Parquet by event day.

    Returns the number of rows, counted while writing; without rows nothing is
    written. Unlike the streaming sink it does not know what it wrote before.
    """
    if silver.isEmpty():
        return 0
    rows = Observation()
    counted = silver.observe(rows, F.count("*").alias("rows"))
    writer = counted.write.mode("append").partitionBy(*DAY_KEYS)
    writer.option("compression", CODEC).parquet(root)
    return rows.get["rows"]


def read_silver_files(spark: SparkSession, root: str) -> DataFrame:
    """Silver written by the batch sink or by compaction."""
    return spark.read.schema(SILVER).parquet(root).select(SILVER.names)


# Rows of a compacted file before encoding; a file ends up a fraction of this.
COMPACT_BYTES = "1g"


def compact(silver: DataFrame, root: str) -> None:
    """Rewrite the days in ``silver`` as few, larger files under another root.

    The rebalance splits a crowded day over several files and joins thin ones.
    Rows are sorted by event type inside a file, so that a filter on it skips
    most of the file. Days already there are replaced, so a rerun changes nothing.
    """
    size = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": COMPACT_BYTES}
    with overridden(silver.sparkSession, size):
        (
            silver.hint("rebalance", *[F.col(key) for key in DAY_KEYS])
            .sortWithinPartitions(*DAY_KEYS, "event_type", "timestamp_parsed")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            .partitionBy(*DAY_KEYS)
            .parquet(root)
        )
