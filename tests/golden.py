"""A feed of eleven lines with every edge case, and the tables it must give."""

import datetime as dt
import gzip
import json
from pathlib import Path

from pyspark.sql import functions as F

from clickstrata.operators import daily
from clickstrata.schemas import EVENT_FIELDS

# The feed's fields, the category moved to its product, which is how ``event`` is called.
FIELDS = [name for name in EVENT_FIELDS.names if name != "category"]
FIELDS.insert(FIELDS.index("product_id") + 1, "category")

DEC4 = "year=2025/month=12/day=04/hour=09/minute=00"
DEC4_LATE = "year=2025/month=12/day=04/hour=23/minute=55"
DEC5 = "year=2025/month=12/day=05/hour=01/minute=00"
OLD = "year=2024/month=12/day=31/hour=10/minute=00"


def event(*values):
    return json.dumps(dict.fromkeys(FIELDS) | dict(zip(FIELDS, values)))


E1 = ("p_1001", "electronics")
LINES = {
    DEC4: [
        event("2025-12-04T09:05:00Z", "u1", "s1", "page_view", *E1),
        event("2025-12-04T09:06:00Z", "u1", "s1", "add_to_cart", *E1, 2, 29.99),
        event("2025-12-04T09:59:59.999Z", "u1", "s1", "purchase", *E1, 2, 29.99),
        event("2025-12-04T10:00:00+00:00", "u2", "s2", "purchase", "p_4001", "books", 1, 10.00),
        event("2025-12-04T10:01:00Z", "u2", "s2", "search", None, None, None, None, "desk lamp"),
        event("2025-12-04T23:59:59Z", "u3", "s3", "remove_from_cart", *E1, 1, 29.99),
        "{bad json",
        event("nope", "u9", "s9", "page_view", *E1),
    ],
    DEC4_LATE: [event("2025-12-05T00:00:01Z", "u1", "s4", "page_view", *E1)],
    DEC5: [event("2025-12-05T01:00:00Z", "u4", "s5", "purchase", *E1, 1, None)],
    OLD: [event("2024-12-31T10:00:00Z", "u8", "s8", "page_view", *E1)],
}

D4, D5 = dt.date(2025, 12, 4), dt.date(2025, 12, 5)
GOLD = {
    "conversion_funnel": {
        ("p_1001", "electronics", 3, 1, 2, 1 / 3, 2.0, 2 / 3),
        ("p_4001", "books", 0, 0, 1, 0.0, 0.0, 0.0),
    },
    "hourly_revenue": {
        ("2025-12-04 09:00:00", 59.98, 1),
        ("2025-12-04 10:00:00", 10.0, 1),
        ("2025-12-05 01:00:00", None, 1),
    },
    "product_views": {("p_1001", "electronics", 3)},
    "category_performance": {
        (D4, None, "search", 1),
        (D4, "books", "purchase", 1),
        (D4, "electronics", "add_to_cart", 1),
        (D4, "electronics", "page_view", 1),
        (D4, "electronics", "purchase", 1),
        (D4, "electronics", "remove_from_cart", 1),
        (D5, "electronics", "page_view", 1),
        (D5, "electronics", "purchase", 1),
        (None, "electronics", "page_view", 1),
    },
    "user_activity": {(D4, 3, 3, 6), (D5, 2, 2, 2), (None, 1, 1, 1)},
}


def write_file(root, slot, lines, name="events.jsonl.gz"):
    folder = Path(root) / slot
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(gzip.compress("\n".join(lines).encode()))


def write_feed(root, slots=tuple(LINES)):
    for slot in slots:
        write_file(root, slot, LINES[slot])
    return str(root)


def shares(silver, batches=3):
    """What silver adds to the gold tables, as if it had come in some batches."""
    batch = F.pmod(F.xxhash64("user_id", "timestamp"), F.lit(batches))
    events = silver.withColumn("batch", batch)
    return {
        "product_counts": daily.product_counts(events),
        "revenue_hours": daily.revenue_hours(events),
        "day_counts": daily.day_counts(events, daily.ids_of_days(events)),
    }


def rows(frame):
    return {tuple(row) for row in frame.collect()}
