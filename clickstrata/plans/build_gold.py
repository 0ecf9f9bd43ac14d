"""Silver to gold: everything at once, or what new batches add."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstrata.operators import daily, gold, sketches
from clickstrata.schemas import BATCH, SHARES
from clickstrata.session import overridden, partitions_for
from clickstrata.sources import catalog, gold_store

# So many batches are kept one by one before they are added up into a base.
BATCHES_KEPT = 100


def _together(spark: SparkSession, jobs: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Submit independent jobs at once, so that the tail of one overlaps the next."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def _spread(spark: SparkSession, events: DataFrame):
    """Shuffle partitions by the amount of ids: only they make a shuffle that grows."""
    partitions = partitions_for(events.select("event_date", "user_id", "session_id"))
    return overridden(
        spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)}
    )


def add_batches(events: DataFrame, root: str, done: int, with_sketches: bool = False) -> None:
    """Store the shares of the batches in ``events``, which follow batch ``done``.

    With sketches, those of the days' users and sessions are stored as well. Only these rows are read, and the ids that their days had before. Done again, after a
    crash or together with later batches, it replaces the shares by the same ones.
    """
    spark = events.sparkSession
    days = events.select(F.col("event_date").cast("string").alias("day")).distinct().collect()
    earlier = gold_store.read_day_ids(spark, root, [row.day for row in days])
    earlier = earlier.where(F.col(BATCH) <= done)

    def day_counts() -> None:
        gold_store.write_day_ids(daily.new_ids(events, earlier), root)
        ids = gold_store.read_day_ids(spark, root, [row.day for row in days])
        counts = daily.day_counts(events, ids.where(F.col(BATCH) > done))
        gold_store.write_shares("day_counts", counts, root)

    more = {}
    if with_sketches:
        more["day_sketches"] = lambda: gold_store.write_shares(
            "day_sketches", sketches.day_sketches(events), root
        )
    with _spread(spark, events):
        _together(
            spark,
            more
            | {
                "product_counts": lambda: gold_store.write_shares(
                    "product_counts", daily.product_counts(events), root
                ),
                "revenue_hours": lambda: gold_store.write_shares(
                    "revenue_hours", daily.revenue_hours(events), root
                ),
                "day_counts": day_counts,
            },
        )


def fold(spark: SparkSession, root: str, through: int) -> None:
    """Add up the shares up to a batch into a base, so that few folders are read."""
    for name in SHARES:
        shares = gold_store.read_shares(spark, name, root, through)
        gold_store.write_base(name, daily.merged(name, shares, through), root, through)
    gold_store.set_base(spark, root, through)


def publish(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], database: str | None = None
) -> dict[str, int]:
    """Write a new version of the gold tables and let readers see it; returns row counts."""
    version = gold_store.published(spark, root) + 1
    counts = _together(
        spark,
        {
            name: lambda name=name, table=table: gold_store.write_table(name, table, root, version)
            for name, table in tables.items()
        },
    )
    gold_store.set_version(spark, root, version)
    if database:
        catalog.register_gold(spark, root, database)
    return counts


def from_shares(spark: SparkSession, root: str, through: int) -> dict[str, DataFrame]:
    """The gold tables as of a batch."""
    return {
        name: build(gold_store.read_shares(spark, source, root, through))
        for name, (source, build) in daily.FROM_SHARES.items()
    }


def build_gold(silver: DataFrame, root: str, database: str | None = None) -> dict[str, int]:
    """Recompute everything from silver. Without silver rows nothing is written."""
    if silver.isEmpty():
        return {}
    with _spread(silver.sparkSession, silver):
        tables = {name: build(silver) for name, build in gold.TABLES.items()}
        return publish(silver.sparkSession, root, tables, database)
