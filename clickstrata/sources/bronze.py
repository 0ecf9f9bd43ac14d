"""The raw feed: gzipped JSON lines under year=/month=/day=/hour=/minute= folders.

Lines are read as text and parsed once, against all event fields, so the verdict on a line
does not depend on what a query needs of it. A line is accepted if it is one JSON object of
the declared types and nothing else; a root array, a second object or any other text after
the first one is refused. A refused line keeps its text in ``_corrupt_record``. Lines of
white space are no lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clickstrata.schemas import (
    ARRIVAL_KEYS,
    BRONZE,
    CORRUPT_COLUMN,
    DEFAULT_CUTOFF_YEAR,
    EVENT_FIELDS,
    LINES,
    NEWEST_FILES,
    READY_FILES,
    RECORD,
    SOURCE_FILE,
)
from clickstrata.session import files_beside_folders, holds_only_files

_PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}

# Arrivals are never too old to be taken in; the file source would forget files
# a week older than the newest one.
_MAX_FILE_AGE = "36500d"

# JSON's white space, and an object without nested ones: after its first brace, strings and
# anything but quotes, braces and brackets, up to a last brace.
_BLANK = r"^[ \t\r\n]*$"
_FLAT_OBJECT = r"""^[ \t\r\n]*\{(?:"(?:[^"\\]|\\.)*+"|[^"'{}\[\]])*+\}[ \t\r\n]*$"""


def _one_value(line: Column) -> Column:
    """Whether a line that begins with a JSON object has nothing after it.

    A flat object is known by its braces. Any other line is put into an array before an
    object with the line's own hash, and must be all that the array holds before that: text
    after the first object breaks the array, adds to it, or ends it early.
    """
    mark = F.xxhash64(line).cast("string")
    array = F.concat(F.lit("["), line, F.lit(',{"mark":"'), mark, F.lit('"}]'))
    parsed = F.from_json(array, "array<struct<mark:string>>")
    alone = (F.size(parsed) == 2) & (F.try_element_at(parsed, F.lit(2))["mark"] == mark)
    return F.when(line.rlike(_FLAT_OBJECT), True).otherwise(F.coalesce(alone, F.lit(False)))


def parsed(lines: DataFrame) -> DataFrame:
    """Text lines (value, arrival keys, source file) as events, refused ones with their text.

    The verdict is computed by a generator, which filters do not duplicate.
    """
    record = F.from_json("value", RECORD, _PARSE_OPTIONS)
    verdict = F.struct(record.alias("record"), _one_value(F.col("value")).alias("alone"))
    refused = ~F.col("alone") | F.col("record").isNull() | F.col(f"record.{CORRUPT_COLUMN}").isNotNull()
    return (
        lines.where(~F.col("value").rlike(_BLANK))
        .select("*", F.inline(F.array(verdict)))
        .select(
            *[F.col("record")[name].alias(name) for name in EVENT_FIELDS.names],
            F.when(refused, F.col("value")).alias(CORRUPT_COLUMN),
            *ARRIVAL_KEYS,
            SOURCE_FILE,
        )
    )


def _arrived_since(lines: DataFrame, cutoff: str | None) -> DataFrame:
    return lines if cutoff is None else lines.where(F.col("year") >= cutoff)


def read_lines(
    spark: SparkSession, root: str, cutoff: str | None = DEFAULT_CUTOFF_YEAR
) -> DataFrame:
    """All text lines that arrived in or after the cutoff year (compared as text), by file.

    None takes all; so it does for files outside arrival folders, whose arrival
    keys are NULL.
    """
    lines = _keyed(_with_file(spark.read.schema(_layout(spark, root)).text(root)))
    # Folder discovery passes over files beside the folders.
    if cutoff is None and (beside := files_beside_folders(spark, root)):
        lines = lines.unionByName(_keyed(_with_file(spark.read.text(beside))))
    return _arrived_since(lines, cutoff)


def _layout(spark: SparkSession, root: str) -> StructType:
    """The text source takes arrival keys only where there are folders."""
    return StructType(LINES.fields[:1]) if holds_only_files(spark, root) else LINES


def _keyed(lines: DataFrame) -> DataFrame:
    """Lines with arrival keys, NULL for files outside arrival folders."""
    missing = {key: F.lit(None).cast("string") for key in ARRIVAL_KEYS if key not in lines.columns}
    return lines.withColumns(missing) if missing else lines


def table_lines(spark: SparkSession, table: str, cutoff: str | None = DEFAULT_CUTOFF_YEAR) -> DataFrame:
    """The same from a partitioned table of the catalog; other years' folders are not listed."""
    return _with_file(_arrived_since(spark.table(table), cutoff))


def _with_file(lines: DataFrame) -> DataFrame:
    return lines.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def scan(spark: SparkSession, root: str, cutoff: str | None = DEFAULT_CUTOFF_YEAR) -> DataFrame:
    """All lines since the cutoff year as events; refused ones have their text."""
    return parsed(read_lines(spark, root, cutoff))


def refuse_mixed(spark: SparkSession, root: str) -> None:
    """Stop before a stream marks files as seen that folder discovery would pass over."""
    if beside := files_beside_folders(spark, root):
        raise ValueError(
            f"{root} holds arrival folders and, beside them, files that would be lost "
            f"({', '.join(beside[:3])}, ...): move them into an arrival folder"
        )


def stream(
    spark: SparkSession,
    root: str,
    cutoff: str | None = DEFAULT_CUTOFF_YEAR,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """The same lines as a stream over files not seen before.

    A gzip file is one task, so a batch takes 1000 files, or four per core if that is more,
    unless told otherwise: enough to keep the cluster busy, little to repeat after a crash.
    """
    files = max_files_per_trigger or max(1000, 4 * spark.sparkContext.defaultParallelism)
    lines = (
        spark.readStream.schema(_layout(spark, root))
        .option("maxFileAge", _MAX_FILE_AGE)
        .option("maxFilesPerTrigger", files)
        .options(**options)
        .text(root)
    )
    return parsed(_arrived_since(_keyed(_with_file(lines)), cutoff))


def well_formed(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(CORRUPT_COLUMN).isNull()).select(BRONZE.names)


def malformed(lines: DataFrame) -> DataFrame:
    """Refused lines: arrival keys, the raw text and what could be read of it."""
    return lines.where(F.col(CORRUPT_COLUMN).isNotNull()).select(
        *ARRIVAL_KEYS,
        F.col(CORRUPT_COLUMN).alias("raw_line"),
        F.to_json(F.struct(*EVENT_FIELDS.names)).alias("readable_part"),
    )


def inventory(files: DataFrame, lines: DataFrame) -> DataFrame:
    """Files, lines and bytes per arrival hour, from a listing and the lines of the same folder.

    Counting lines unpacks every file, but parses none. A file without lines counts as a file.
    """
    counts = lines.where(~F.col("value").rlike(_BLANK)).groupBy(F.col(SOURCE_FILE).alias("file"))
    counts = counts.agg(F.count("*").alias("lines"))
    return files.join(counts, "file", "left").groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
        F.sum("length").alias("bytes"),
        F.max("modified").alias("newest"),
    )


def listing(spark: SparkSession, root: str, cutoff: str | None = None) -> DataFrame:
    """One row per file: arrival keys, path, length, modification time.

    Only the folder listing is used; no file is opened. The cutoff selects as in
    ``scan``. Arrival keys are NULL for files outside arrival folders; ``file`` is
    the path as scans name it.
    """
    files = _listed(spark, root)
    if cutoff is None and (beside := files_beside_folders(spark, root)):
        files = files.unionAll(_listed(spark, beside))
    return _arrived_since(files, cutoff)


def _listed(spark: SparkSession, root: str | list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").load(root)
    keys = [
        f"lpad(CAST({key} AS STRING), {4 if key == 'year' else 2}, '0') AS {key}"
        if key in files.columns
        else f"CAST(NULL AS STRING) AS {key}"
        for key in ARRIVAL_KEYS
    ]
    return files.selectExpr(
        *keys,
        "path",
        "length",
        "modificationTime AS modified",
        "_metadata.file_path AS file",
    )


def newest_files(files: DataFrame, most: int = NEWEST_FILES) -> DataFrame:
    """The files of a listing that were written last, newest first, with their size."""
    order = (F.desc("modified"), F.asc("path"))
    return files.select(*ARRIVAL_KEYS, "path", "length", "modified").orderBy(*order).limit(most)


def readiness(files: DataFrame, needed: int = READY_FILES) -> DataFrame:
    """One row over a listing: file count, bytes, newest arrival, and whether enough arrived."""
    return files.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.max(F.expr(" || '-' || ".join(ARRIVAL_KEYS))).alias("newest_arrival"),
        (F.count("*") >= needed).alias("ready"),
    )
