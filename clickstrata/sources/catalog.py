"""Databases, tables and views in the session catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from clickstrata.schemas import (
    ARRIVAL_KEYS,
    BATCH,
    BRONZE_READ,
    CORRUPT_COLUMN,
    DAY_KEYS,
    GOLD,
    LAKE_READ,
    LINES,
    SILVER,
    SILVER_ZONE,
    ZONE,
)
from clickstrata.sources.gold_store import table_path
from clickstrata.sources.lake import committed, read_batches

# The three layers.
LAYERS = ("bronze", "silver", "gold")

LAKE_TABLE = "lake"


def identifier(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema) -> str:
    return ", ".join(f"{identifier(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def create_databases(spark: SparkSession, names=LAYERS, location: str | None = None) -> None:
    for name in names:
        place = f" LOCATION {text(f'{location}/{name}')}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(name)}{place}")


def register_bronze(
    spark: SparkSession, root: str, database: str = "bronze", table: str = "events"
) -> None:
    """The raw feed as partitioned tables; call again to pick up new arrival folders.

    ``events`` has the columns as Spark's JSON reader finds them, for questions in SQL;
    ``events_lines`` has the text, from which ``bronze.table_lines`` and ``bronze.parsed``
    give lines with the strict verdict.
    """
    kinds = {
        table: (BRONZE_READ, f"JSON OPTIONS (mode 'PERMISSIVE', columnNameOfCorruptRecord {text(CORRUPT_COLUMN)})"),
        f"{table}_lines": (LINES, "TEXT"),
    }
    for name, (schema, source) in kinds.items():
        full = identifier(database, name)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({_columns(schema)}) USING {source} "
            f"PARTITIONED BY ({', '.join(map(identifier, ARRIVAL_KEYS))}) LOCATION {text(root)}"
        )
        spark.sql(f"MSCK REPAIR TABLE {full}")


# Partitions added by one statement.
_PARTITIONS_AT_ONCE = 200
_ADDED, _FOLDER = "batches_added", "lake_folder"


def _property(spark: SparkSession, table: str, key: str) -> str | None:
    row = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == key).first()
    return None if row is None else row["value"]


def register_silver(
    spark: SparkSession, lake: str, database: str = "silver", table: str = "events"
) -> None:
    """The lake as a partitioned table ``lake``, and its events as a view on it.

    The catalog knows the partitions, so a query on a few days lists only those. Call
    again, or let ingest do so, to add the batches finished since.
    """
    files = identifier(database, LAKE_TABLE)
    keys = (BATCH, ZONE, *DAY_KEYS)
    if spark.catalog.tableExists(files) and _property(spark, files, _FOLDER) != lake:
        spark.sql(f"DROP TABLE {files}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {files} ({_columns(LAKE_READ)}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(map(identifier, keys))}) LOCATION {text(lake)} "
        f"TBLPROPERTIES ('{_FOLDER}' = {text(lake)})"
    )
    add_batches(spark, lake, database)
    spark.sql(
        f"CREATE OR REPLACE VIEW {identifier(database, table)} AS "
        f"SELECT {', '.join(map(identifier, SILVER.names))} FROM {files} "
        f"WHERE {ZONE} = '{SILVER_ZONE}'"
    )


def add_batches(spark: SparkSession, lake: str, database: str) -> None:
    """Add the partitions of the batches finished since the last call to the lake table."""
    files = identifier(database, LAKE_TABLE)
    done, last = int(_property(spark, files, _ADDED) or -1), committed(spark, lake)
    if done >= last:
        return
    rows = read_batches(spark, lake, after=done).select(BATCH, ZONE, *DAY_KEYS).distinct().collect()

    def value(key: str, own) -> str:
        literal = "null" if own is None else text(own) if isinstance(own, str) else str(own)
        return f"{identifier(key)} = {literal}"

    specs = [
        "PARTITION (" + ", ".join(value(k, v) for k, v in row.asDict().items()) + ")" for row in rows
    ]
    for first in range(0, len(specs), _PARTITIONS_AT_ONCE):
        some = " ".join(specs[first : first + _PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {files} ADD IF NOT EXISTS {some}")
    spark.sql(f"ALTER TABLE {files} SET TBLPROPERTIES ('{_ADDED}' = '{last}')")


def register_compacted(
    spark: SparkSession, root: str, database: str = "silver", table: str = "compacted_events"
) -> None:
    """Compacted silver as a partitioned table; call again to pick up new days.

    The catalog knows its partitions, so a query on a few days lists only those.
    """
    full = identifier(database, table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({_columns(SILVER)}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(map(identifier, DAY_KEYS))}) LOCATION {text(root)}"
    )
    spark.sql(f"MSCK REPAIR TABLE {full}")
    spark.sql(f"REFRESH TABLE {full}")


def register_gold(spark: SparkSession, root: str, database: str = "gold") -> None:
    """The five published tables; call again to switch them to the version published last.

    They have no partitions to repair, only a place to change.
    """
    create_databases(spark, (database,))
    for name, schema in GOLD.items():
        full, place = identifier(database, name), text(table_path(spark, name, root))
        if spark.catalog.tableExists(full):
            spark.sql(f"ALTER TABLE {full} SET LOCATION {place}")
        else:
            spark.sql(f"CREATE TABLE {full} ({_columns(schema)}) USING PARQUET LOCATION {place}")
        spark.sql(f"REFRESH TABLE {full}")
