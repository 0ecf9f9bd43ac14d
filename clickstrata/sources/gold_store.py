"""Gold on disk: versions of the published tables, shares of batches, report files.

``<table>/version=V`` is a published table; all tables of a version are written before its
number is set, and the version before stays for those who still read it. ``shares/<name>/
batch=N`` is what a batch adds, ``shares/day_ids/event_date=D/batch=N`` are the ids it was the
first to have that day, and ``base=K/<name>`` holds the shares up to batch K added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from clickstrata.schemas import BATCH, DAY_IDS, GOLD, SHARES, SKETCHES
from clickstrata.session import path_exists
from clickstrata.sources.marks import children, last_mark, remove, set_mark

_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def published(spark: SparkSession, root: str) -> int:
    """The number of the version to be read, -1 before the first."""
    return last_mark(spark, f"{root}/_published")


def table_path(spark: SparkSession, name: str, root: str) -> str:
    return f"{root}/{name}/version={published(spark, root)}"


def read_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    return spark.read.schema(GOLD[name]).parquet(table_path(spark, name, root))


def write_table(name: str, table: DataFrame, root: str, version: int) -> int:
    """Write a table of a version to be; returns its row count without a second pass."""
    rows = Observation()
    counted = table.select(GOLD[name].names).observe(rows, F.count("*").alias("rows"))
    counted.write.mode("overwrite").parquet(f"{root}/{name}/version={version}")
    return rows.get["rows"]


def set_version(spark: SparkSession, root: str, version: int) -> None:
    """Let readers see a version, all tables at once; the one before stays readable."""
    set_mark(spark, f"{root}/_published", version)
    for name in GOLD:
        for old in children(spark, f"{root}/{name}", "version"):
            if old < version - 1:
                remove(spark, f"{root}/{name}/version={old}")


def write_shares(name: str, shares: DataFrame, root: str) -> None:
    """Store shares by batch; those of the same batches are replaced, others stay."""
    (
        shares.hint("rebalance", F.col(BATCH))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(f"{root}/shares/{name}")
    )


def write_day_ids(ids: DataFrame, root: str) -> None:
    (
        ids.hint("rebalance", F.col("event_date"), F.col(BATCH))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", BATCH)
        .parquet(f"{root}/shares/day_ids")
    )


def read_day_ids(spark: SparkSession, root: str, days: list[str | None]) -> DataFrame:
    """The stored ids of some days, given as text; other days' folders are not listed."""
    folder = f"{root}/shares/day_ids"
    paths = [f"{folder}/event_date={_NO_DAY if day is None else day}" for day in days]
    found = [path for path in paths if path_exists(spark, path)]
    if not found:
        return spark.createDataFrame([], DAY_IDS)
    return spark.read.schema(DAY_IDS).option("basePath", folder).parquet(*found)


def read_sketches(spark: SparkSession, root: str, through: int) -> DataFrame:
    """The sketches of all batches up to one that were refreshed with them."""
    rows = spark.read.schema(SKETCHES).parquet(f"{root}/shares/day_sketches")
    return rows.where(F.col(BATCH) <= through)


def base(spark: SparkSession, root: str) -> int:
    """The last batch whose shares are in the base, -1 without one."""
    return last_mark(spark, f"{root}/_base")


def read_shares(spark: SparkSession, name: str, root: str, through: int) -> DataFrame:
    """The shares of all batches up to one: the base and those after it."""
    done = base(spark, root)
    schema = SHARES[name]
    shares = spark.read.schema(schema).parquet(f"{root}/shares/{name}")
    shares = shares.where((F.col(BATCH) > done) & (F.col(BATCH) <= through))
    if done < 0:
        return shares
    return spark.read.schema(schema).parquet(f"{root}/base={done}/{name}").unionAll(shares)


def write_base(name: str, shares: DataFrame, root: str, number: int) -> None:
    shares.write.mode("overwrite").parquet(f"{root}/base={number}/{name}")


def set_base(spark: SparkSession, root: str, number: int) -> None:
    """Read shares up to a batch from its base; the shares themselves and older bases go."""
    before = base(spark, root)
    set_mark(spark, f"{root}/_base", number)
    for old in children(spark, root, "base"):
        if old < before:
            remove(spark, f"{root}/base={old}")
    for name in SHARES:
        for batch in children(spark, f"{root}/shares/{name}", BATCH):
            if batch <= before:
                remove(spark, f"{root}/shares/{name}/{BATCH}={batch}")


def write_report(report: DataFrame, path: str, file_format: str = "csv") -> None:
    """Save a report; the part files, read by name, keep its order."""
    writer = report.write.mode("overwrite").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
