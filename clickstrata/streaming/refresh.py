"""Keep gold and compacted silver up to date with the batches that ingest has finished."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstrata.operators import sketches
from clickstrata.plans.build_gold import BATCHES_KEPT, add_batches, fold, from_shares, publish
from clickstrata.schemas import BATCH
from clickstrata.session import configure
from clickstrata.sources import gold_store, lake as lake_store
from clickstrata.sources.marks import last_mark, set_mark


def touched_days(events: DataFrame) -> list[int | None]:
    """Day numbers of some events: as many as days with news, a small number for each."""
    return [row.day for row in events.select(lake_store.day_number().alias("day")).distinct().collect()]


def run_refresh(
    spark: SparkSession,
    lake: str,
    gold: str,
    checkpoint: str,
    database: str | None = None,
    with_sketches: bool = False,
) -> dict[str, int]:
    """Bring gold up to date with all batches finished since the last run.

    The rows of these batches are read, no others; their shares are stored by batch number
    and the tables published from all shares. A run repeated after a crash replaces what it
    wrote. Returns the row counts of the published tables, or nothing without news. With a
    database, its registered tables are switched to the new version. With sketches, asked for
    from the first run on, ``approximate_activity`` can put days together.
    """
    configure(spark)
    done, last = last_mark(spark, checkpoint), lake_store.committed(spark, lake)
    if done >= last:
        return {}
    news = lake_store.silver_of(lake_store.read_batches(spark, lake, after=done), BATCH)
    if news.isEmpty():
        set_mark(spark, checkpoint, last)
        return {}
    add_batches(news, gold, done, with_sketches)
    if last - gold_store.base(spark, gold) > BATCHES_KEPT:
        fold(spark, gold, last)
    counts = publish(spark, gold, from_shares(spark, gold, last), database)
    set_mark(spark, checkpoint, last)
    return counts


def approximate_activity(spark: SparkSession, gold: str, checkpoint: str, period: str) -> DataFrame:
    """About how many users and sessions each week, month, quarter or year had so far."""
    stored = gold_store.read_sketches(spark, gold, last_mark(spark, checkpoint))
    return sketches.activity_by(stored, period)


def run_compaction(spark: SparkSession, lake: str, into: str, checkpoint: str) -> bool:
    """Rewrite the days that got rows since the last run as few large files.

    After a run the compacted copy holds all silver rows committed by then.
    False if there were no new ones.
    """
    configure(spark)
    done, last = last_mark(spark, checkpoint), lake_store.committed(spark, lake)
    if done >= last:
        return False
    days = touched_days(lake_store.silver_of(lake_store.read_batches(spark, lake, after=done)))
    if days:
        lake_store.compact(lake_store.on_days(lake_store.read_silver(spark, lake), days), into)
    set_mark(spark, checkpoint, last)
    return bool(days)
