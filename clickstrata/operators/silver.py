"""Raw events to clean events. One row in, one row out, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickstrata.functions.expressions import event_time, purchase_revenue
from clickstrata.schemas import (
    CORRUPT_COLUMN,
    DAY_KEYS,
    LAKE,
    QUARANTINE_ZONE,
    SILVER,
    SILVER_ZONE,
    SOURCE_FILE,
    ZONE,
)


def _derive(events: DataFrame) -> DataFrame:
    """Add event time, date, hour and revenue; the arrival keys stay untouched.

    The date parts follow the event, not its arrival. A timestamp that cannot
    be read leaves them NULL and keeps the row.
    """
    timed = events.withColumn("timestamp_parsed", event_time("timestamp"))
    return timed.withColumns(
        {
            "event_date": F.to_date("timestamp_parsed"),
            "event_hour": F.hour("timestamp_parsed"),
            "revenue": purchase_revenue(),
        }
    )


def _event_day() -> dict:
    return {
        "year": F.year("event_date"),
        "month": F.month("event_date"),
        "day": F.dayofmonth("event_date"),
    }


def to_silver(bronze: DataFrame) -> DataFrame:
    """The sixteen silver columns of well-formed bronze rows."""
    return _derive(bronze).withColumns(_event_day()).select(SILVER.names)


def to_lake(lines: DataFrame) -> DataFrame:
    """Every line, good or bad, with the zone it belongs to.

    Good lines become silver rows. Bad ones carry their raw text and source
    file instead and are dated by arrival. Both come from one parse.
    """
    refused = F.col(CORRUPT_COLUMN).isNotNull()
    located = lines.withColumn(SOURCE_FILE, F.when(refused, F.col(SOURCE_FILE)))
    day = {
        key: F.when(refused, F.col(key).try_cast("int")).otherwise(value)
        for key, value in _event_day().items()
    }
    zone = F.when(refused, QUARANTINE_ZONE).otherwise(SILVER_ZONE)
    return (
        _derive(located)
        .withColumns({**day, ZONE: zone})
        .withColumnRenamed(CORRUPT_COLUMN, "raw_line")
        .select([field.name for field in LAKE.fields if field.name not in DAY_KEYS] + [*DAY_KEYS])
    )
