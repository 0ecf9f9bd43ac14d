"""New arrivals to silver and quarantine, each file once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from clickstrata.operators.silver import to_lake
from clickstrata.schemas import DEFAULT_CUTOFF_YEAR, QUARANTINE_ZONE, SOURCE_FILE, ZONE
from clickstrata.session import configure, path_exists
from clickstrata.sources import bronze, catalog, lake as lake_store
from clickstrata.streaming.archive import Archive


@dataclass(frozen=True)
class IngestResult:
    """Lines read by one run and how many of them were refused."""

    lines: int
    refused: int

    @property
    def accepted(self) -> int:
        return self.lines - self.refused


def run_ingest(
    spark: SparkSession,
    source: str,
    lake: str,
    checkpoint: str,
    cutoff: str | None = DEFAULT_CUTOFF_YEAR,
    max_files_per_trigger: int | None = None,
    database: str | None = None,
    archive: str | None = None,
    **source_options: str,
) -> IngestResult:
    """Take in all files not seen by this checkpoint, then stop.

    Lines are parsed once. Each batch is counted while it is written and becomes visible as
    a whole; one repeated after a crash adds nothing twice. Files that arrived before the
    cutoff year count as seen. To read everything again, use a new checkpoint together with
    a new lake folder. With a database, each batch is added to its registered lake table.
    With an archive, files that were taken in are moved there (``streaming.archive``); give
    it in every run or in none.
    """
    configure(spark)
    bronze.refuse_mixed(spark, source)
    known = f"{checkpoint}/files" if archive else f"{checkpoint}/offsets"
    if lake_store.committed(spark, lake) >= 0 and not path_exists(spark, known):
        # Batches are numbered by the checkpoint; new ones would be taken for old.
        raise ValueError(f"{lake} was filled under another checkpoint; use a new lake folder")
    counts = {"lines": 0, "refused": 0}
    place, first = checkpoint, 0
    if archive:
        kept = Archive(spark, source, archive, checkpoint)
        kept.move(lake_store.committed(spark, lake))
        place, first = kept.epoch(lake_store.committed(spark, lake))

    def handle(batch: DataFrame, at: int) -> None:
        number = first + at
        files, seen = Observation(), Observation()
        if archive:
            # At most as many as a batch may have.
            batch = batch.observe(files, F.collect_set(SOURCE_FILE).alias("files"))
        counted = to_lake(batch).observe(
            seen,
            F.count("*").alias("lines"),
            F.count_if(F.col(ZONE) == QUARANTINE_ZONE).alias("refused"),
        )
        note = (lambda: kept.note(number, files.get["files"])) if archive else None
        if lake_store.write_batch(counted, lake, number, note):
            for name, own in seen.get.items():
                counts[name] += own
        if database:
            catalog.add_batches(spark, lake, database)

    lines = bronze.stream(spark, source, cutoff, max_files_per_trigger, **source_options)
    query = (
        lines.writeStream.foreachBatch(handle)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if archive:
        kept.move(lake_store.committed(spark, lake))
    return IngestResult(**counts)
