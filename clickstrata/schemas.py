"""Column layouts of the three layers and the values their rules depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Event kinds, catalog categories and search phrases of the feed.
EVENT_TYPES = ("page_view", "add_to_cart", "remove_from_cart", "purchase", "search")
CATEGORIES = ("electronics", "clothing", "home", "books", "sports", "toys")
SEARCH_PHRASES = (
    "wireless headphones",
    "running shoes",
    "coffee maker",
    "python books",
    "yoga mat",
    "laptop stand",
    "winter jacket",
    "desk lamp",
)

# Arrivals before this year are skipped, and an hour of data
# (twelve five-minute files) makes the feed ready.
DEFAULT_CUTOFF_YEAR = "2025"
READY_FILES = 12
# How many files the list of the newest shows.
NEWEST_FILES = 10

# The funnel's steps and the rates between them.
FUNNEL_STEPS = {"views": "page_view", "add_to_cart": "add_to_cart", "purchases": "purchase"}
FUNNEL_RATES = {
    "view_to_cart_rate": ("add_to_cart", "views"),
    "cart_to_purchase_rate": ("purchases", "add_to_cart"),
    "view_to_purchase_rate": ("purchases", "views"),
}

CORRUPT_COLUMN = "_corrupt_record"


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BINARY": T.BinaryType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """``name TYPE, ...`` as nullable fields; unlike StructType.fromDDL, no session is needed."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


EVENT_FIELDS = _struct(
    "timestamp STRING, user_id STRING, session_id STRING, event_type STRING, "
    "product_id STRING, quantity INT, price DOUBLE, category STRING, search_query STRING"
)

# Arrival time, from the path. Strings, so that '04' stays '04' and the cutoff
# compares as text.
ARRIVAL_KEYS = ("year", "month", "day", "hour", "minute")
ARRIVAL_FIELDS = _struct(", ".join(f"{key} STRING" for key in ARRIVAL_KEYS))

BRONZE = T.StructType(EVENT_FIELDS.fields + ARRIVAL_FIELDS.fields)

# What a line is parsed into: a line that does not fit lands in the extra column.
RECORD = T.StructType(EVENT_FIELDS.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])

# The lines of the feed as text, and the same parsed.
SOURCE_FILE = "source_file"
LINES = T.StructType([T.StructField("value", T.StringType())] + ARRIVAL_FIELDS.fields)
BRONZE_READ = T.StructType(RECORD.fields + ARRIVAL_FIELDS.fields)

DAY_KEYS = ("year", "month", "day")
SILVER = _struct(
    "timestamp STRING, timestamp_parsed TIMESTAMP, event_date DATE, event_hour INT, "
    "user_id STRING, session_id STRING, event_type STRING, product_id STRING, "
    "quantity INT, price DOUBLE, revenue DOUBLE, category STRING, search_query STRING, "
    "year INT, month INT, day INT"
)

GOLD = {
    "conversion_funnel": _struct(
        "product_id STRING, category STRING, views BIGINT, add_to_cart BIGINT, "
        "purchases BIGINT, view_to_cart_rate DOUBLE, cart_to_purchase_rate DOUBLE, "
        "view_to_purchase_rate DOUBLE"
    ),
    "hourly_revenue": _struct(
        "event_datetime STRING, total_revenue DOUBLE, purchase_count BIGINT"
    ),
    "product_views": _struct("product_id STRING, category STRING, view_count BIGINT"),
    "category_performance": _struct(
        "event_date DATE, category STRING, event_type STRING, event_count BIGINT"
    ),
    "user_activity": _struct(
        "event_date DATE, unique_users BIGINT, unique_sessions BIGINT, total_events BIGINT"
    ),
}

# Shares of the lake's batches in the gold tables. They add up over batches; an id stands in
# the first batch that had it on that day.
BATCH = "batch"
SHARES = {
    "product_counts": _struct(
        "event_date DATE, product_id STRING, category STRING, event_type STRING, "
        "events BIGINT, batch BIGINT"
    ),
    "revenue_hours": _struct(
        "event_date DATE, event_datetime STRING, total_revenue DOUBLE, purchase_count BIGINT, "
        "batch BIGINT"
    ),
    "day_counts": _struct(
        "event_date DATE, unique_users BIGINT, unique_sessions BIGINT, total_events BIGINT, "
        "batch BIGINT"
    ),
}
SKETCHES = _struct(
    "event_date DATE, users BINARY, sessions BINARY, total_events BIGINT, batch BIGINT"
)
DAY_IDS = _struct("kind STRING, id STRING, event_date DATE, batch BIGINT")

# Where ingest writes: accepted events and refused lines share a folder for each batch, told
# apart by the leading partition column there.
ZONE = "zone"
SILVER_ZONE = "silver"
QUARANTINE_ZONE = "quarantine"
LAKE = T.StructType(
    [field for field in SILVER.fields if field.name not in DAY_KEYS]
    + _struct("raw_line STRING, source_file STRING").fields
    + [T.StructField(ZONE, T.StringType())]
    + [field for field in SILVER.fields if field.name in DAY_KEYS]
)
LAKE_READ = T.StructType([*LAKE.fields, T.StructField(BATCH, T.LongType())])
