"""Hourly revenue as a stream: hours are closed by a watermark and written once.

Unlike gold, which is recomputed from whatever has come, an hour here is final when it
appears. It is closed when an event has been seen that is later than its end by the allowed
delay; purchases that come for an hour already closed are not counted in it, but reported.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from clickstrata.functions.expressions import event_time, hour_label, purchase_revenue
from clickstrata.schemas import BATCH, DEFAULT_CUTOFF_YEAR, GOLD
from clickstrata.session import configure, overridden
from clickstrata.sources import bronze
from clickstrata.sources.marks import children, last_mark, set_mark

# Arrivals may be this much later than their events.
DELAY = "6 hours"


@dataclass(frozen=True)
class HoursResult:
    """Hours closed by a run, and purchases that came too late for theirs."""

    closed: int
    too_late: int


class _TooLate(StreamingQueryListener):
    """Adds up what a query's windows turned away, report by report."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.runs: set[str] = set()
        self.ended = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        own, run = event.progress.stateOperators, str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + sum(s.numRowsDroppedByWatermark for s in own)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.ended:
            self.runs.add(str(event.runId))
            self.ended.notify_all()

    def wait(self, run: str, seconds: float = 60.0) -> int:
        """The sum, once all reports of a run are in."""
        with self.ended:
            self.ended.wait_for(lambda: run in self.runs, seconds)
        return self.rows.get(run, 0)


def hours_of(lines: DataFrame, delay: str = DELAY) -> DataFrame:
    """Revenue and purchases per event hour, from a stream of parsed lines."""
    purchases = (
        bronze.well_formed(lines)
        .where(F.col("event_type") == "purchase")
        .select(event_time("timestamp").alias("at"), purchase_revenue().alias("revenue"))
        .where(F.col("at").isNotNull())
        .withWatermark("at", delay)
    )
    hours = purchases.groupBy(F.window("at", "1 hour").alias("slot")).agg(
        F.sum("revenue").alias("total_revenue"), F.count("*").alias("purchase_count")
    )
    start = F.col("slot.start")
    return hours.withColumns({"day": F.to_date(start), "hour": F.hour(start)}).select(
        hour_label("day", "hour").alias("event_datetime"), "total_revenue", "purchase_count"
    )


def write_hours(hours: DataFrame, path: str) -> None:
    """Write a batch's closed hours as few files.

    They are shuffled for it: coalescing would put the windows' state, which the batch has
    in its last stage, into as few tasks as there are files.
    """
    with overridden(hours.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
        hours.hint("rebalance").write.mode("overwrite").parquet(path)


def run_hours(
    spark: SparkSession,
    feed: str,
    into: str,
    checkpoint: str,
    delay: str = DELAY,
    cutoff: str | None = DEFAULT_CUTOFF_YEAR,
    max_files_per_trigger: int | None = None,
) -> HoursResult:
    """Take in new files and write the hours that they close, each batch as a folder."""
    configure(spark)
    bronze.refuse_mixed(spark, feed)
    closed = 0

    def handle(batch: DataFrame, number: int) -> None:
        nonlocal closed
        if number <= last_mark(spark, f"{into}/_committed"):
            # Written before a crash; the windows' state still has to go through it.
            batch.write.format("noop").mode("overwrite").save()
        else:
            path = f"{into}/{BATCH}={number}"
            write_hours(batch, path)
            set_mark(spark, f"{into}/_committed", number)
            closed += spark.read.schema(GOLD["hourly_revenue"]).parquet(path).count()

    late = _TooLate()
    spark.streams.addListener(late)
    try:
        query = (
            hours_of(bronze.stream(spark, feed, cutoff, max_files_per_trigger), delay)
            .writeStream.foreachBatch(handle)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return HoursResult(closed, late.wait(str(query.runId)))
    finally:
        spark.streams.removeListener(late)


def read_hours(spark: SparkSession, into: str) -> DataFrame:
    """All closed hours, a row each."""
    last = last_mark(spark, f"{into}/_committed")
    paths = [f"{into}/{BATCH}={n}" for n in children(spark, into, BATCH) if n <= last]
    if not paths:
        return spark.createDataFrame([], GOLD["hourly_revenue"])
    return spark.read.schema(GOLD["hourly_revenue"]).parquet(*paths)
