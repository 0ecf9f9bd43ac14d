"""Shares of batches in the gold tables, and the gold tables made from them.

A share is what one batch of events adds to a table: sums by day, which add up over batches,
and the ids a day had not seen in the batches before, so that distinct counts add up too.
A batch computed again gives the same share. Gold tables are small sums over shares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from clickstrata.operators import gold
from clickstrata.schemas import BATCH, DAY_IDS, FUNNEL_STEPS, SHARES


def product_counts(events: DataFrame) -> DataFrame:
    """Events per batch, day, product, category and type."""
    counts = events.groupBy(BATCH, "event_date", *gold.PRODUCT, "event_type")
    return counts.agg(F.count("*").alias("events")).select(SHARES["product_counts"].names)


def revenue_hours(events: DataFrame) -> DataFrame:
    """Revenue and purchases per batch and hour."""
    return gold.revenue_by_hour(events, BATCH).select(SHARES["revenue_hours"].names)


def ids_of_days(events: DataFrame) -> DataFrame:
    """The users and sessions of each day, with the first of these batches that had them."""
    found = [
        events.where(F.col(column).isNotNull())
        .groupBy("event_date", F.col(column).alias("id"))
        .agg(F.min(BATCH).alias(BATCH))
        .withColumn("kind", F.lit(kind))
        .select(DAY_IDS.names)
        for kind, column in (("user", "user_id"), ("session", "session_id"))
    ]
    return found[0].unionAll(found[1])


def new_ids(events: DataFrame, earlier: DataFrame) -> DataFrame:
    """Ids of these events that their day had not seen in earlier batches."""
    known = earlier.select(
        F.col("event_date").alias("day"), F.col("kind").alias("sort"), F.col("id").alias("old")
    )
    same = (
        F.col("event_date").eqNullSafe(F.col("day"))
        & (F.col("kind") == F.col("sort"))
        & (F.col("id") == F.col("old"))
    )
    return ids_of_days(events).join(known, same, "left_anti")


def day_counts(events: DataFrame, ids: DataFrame) -> DataFrame:
    """Events, new users and new sessions per batch and day, to be added up."""
    nothing = F.lit(0).cast("bigint")
    totals = events.groupBy(BATCH, "event_date").agg(
        nothing.alias("unique_users"), nothing.alias("unique_sessions"),
        F.count("*").alias("total_events"),
    )
    first = ids.groupBy(BATCH, "event_date").agg(
        F.count_if(F.col("kind") == "user").alias("unique_users"),
        F.count_if(F.col("kind") == "session").alias("unique_sessions"),
        nothing.alias("total_events"),
    )
    names = SHARES["day_counts"].names
    return totals.select(names).unionAll(first.select(names))


def funnel_from(counts: DataFrame) -> DataFrame:
    steps = [
        F.sum(F.when(F.col("event_type") == kind, F.col("events")).otherwise(0)).alias(name)
        for name, kind in FUNNEL_STEPS.items()
    ]
    in_funnel = counts.where(F.col("event_type").isin(*FUNNEL_STEPS.values()))
    return gold.with_rates(in_funnel.groupBy(*gold.PRODUCT).agg(*steps))


def views_from(counts: DataFrame) -> DataFrame:
    viewed = counts.where(F.col("event_type") == "page_view")
    return viewed.groupBy(*gold.PRODUCT).agg(F.sum("events").alias("view_count"))


def categories_from(counts: DataFrame) -> DataFrame:
    return counts.groupBy("event_date", "category", "event_type").agg(
        F.sum("events").alias("event_count")
    )


def revenue_from(hours: DataFrame) -> DataFrame:
    return hours.groupBy("event_datetime").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("purchase_count").alias("purchase_count"),
    )


def activity_from(days: DataFrame) -> DataFrame:
    sums = [F.sum(name).alias(name) for name in ("unique_users", "unique_sessions", "total_events")]
    return days.groupBy("event_date").agg(*sums)


# Gold table: the shares it comes from, and how.
FROM_SHARES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "conversion_funnel": ("product_counts", funnel_from),
    "hourly_revenue": ("revenue_hours", revenue_from),
    "product_views": ("product_counts", views_from),
    "category_performance": ("product_counts", categories_from),
    "user_activity": ("day_counts", activity_from),
}

# What of several shares with equal keys may be put together into one.
MERGED: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "product_counts": (("event_date", *gold.PRODUCT, "event_type"), ("events",)),
    "revenue_hours": (("event_date", "event_datetime"), ("total_revenue", "purchase_count")),
    "day_counts": (("event_date",), ("unique_users", "unique_sessions", "total_events")),
}


def merged(name: str, shares: DataFrame, number: int) -> DataFrame:
    """Shares added up by their keys, as if of one batch."""
    keys, values = MERGED[name]
    sums = shares.groupBy(*keys).agg(*[F.sum(value).alias(value) for value in values])
    return sums.withColumn(BATCH, F.lit(number).cast("bigint")).select(SHARES[name].names)
