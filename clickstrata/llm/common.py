"""What the operators share: reading tables, stored intermediates, word rules."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickstrata.session import working_dir
from clickstrata.sources.marks import remove

# Words are runs of anything but ASCII white space.
SPACES = r"[\x20\x09-\x0D]+"

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Bytes of rows that go to Python at once. By number alone it is 10,000 rows, 30 MB and more of
# text, held several times over by the executor and its workers.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """Let rows go to Python in batches of bounded size; no result depends on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


# Parts that small results are dealt into, where adaptive execution cuts those that are not
# small after all; and rows of a few numbers in a file.
FEW = 8
ROWS_A_FILE = 50_000


def store(
    frame: DataFrame, label: str, few: bool = False, rows: int | None = None, a_file: int = ROWS_A_FILE
) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors.

    few: what many tasks return little of goes into few files, by one more shuffle. For each
    file on a local disk an executor starts processes, which take time and at first count with
    its memory. rows: what a last shuffle gives, that many rows at most, is written by as many
    tasks as ``a_file`` rows a file make, without one more shuffle.
    """
    spark = frame.sparkSession
    if few:
        frame = frame.hint("rebalance", FEW)
    elif rows is not None:
        frame = frame.coalesce(max(1, -(-rows // a_file)))
    path = working_dir(spark, label)
    frame.write.parquet(path)
    stored = spark.read.schema(frame.schema).parquet(path)
    stored.stored_in = path
    return stored


def release(*frames: DataFrame) -> None:
    """Delete stored tables that nothing will read any more."""
    for frame in frames:
        remove(frame.sparkSession, frame.stored_in)


def computed(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add columns and compute each once per row.

    A plain select may be merged with the next one, so that an expression used
    inside a lambda runs once per element. A generator is not merged.
    """
    row = F.struct(*(value.alias(name) for name, value in columns.items()))
    return frame.select("*", F.inline(F.array(row)))


def text_of(column: str = "text") -> Column:
    """The text as a string, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def shared(spark: SparkSession, value: T) -> Callable[[], T]:
    """Broadcast a value of bounded size; call the result in a task to get it.

    Classes of this package travel with the value.
    """
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)
