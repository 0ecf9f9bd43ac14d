"""Clean events to the five aggregate tables.

Each function takes a silver frame and returns an unsorted table; ``ordered``
gives a table in its reading order. All group-bys combine on the map side, so
a crowded product, category or day shrinks to a few rows per task before the
shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from clickstrata.functions.expressions import hour_label, rate
from clickstrata.schemas import FUNNEL_RATES, FUNNEL_STEPS, GOLD

PRODUCT = ("product_id", "category")


def shaped(name: str, frame: DataFrame) -> DataFrame:
    return frame.select(GOLD[name].names)


def with_rates(steps: DataFrame) -> DataFrame:
    rates = {name: rate(part, whole) for name, (part, whole) in FUNNEL_RATES.items()}
    return shaped("conversion_funnel", steps.withColumns(rates))


def conversion_funnel(silver: DataFrame) -> DataFrame:
    """Views, cart additions and purchases per product, and the rates between them.

    Rates compare counts; they may exceed 1 and follow no single user.
    """
    steps = [F.count_if(F.col("event_type") == kind).alias(n) for n, kind in FUNNEL_STEPS.items()]
    in_funnel = silver.where(F.col("event_type").isin(*FUNNEL_STEPS.values()))
    return with_rates(in_funnel.groupBy(*PRODUCT).agg(*steps))


def revenue_by_hour(silver: DataFrame, *keys: str) -> DataFrame:
    # Date and hour are dictionary-coded columns; grouping by them instead of by
    # text made from the timestamp reads less and formats once per group.
    return (
        silver.where(F.col("event_type") == "purchase")
        .groupBy(*keys, "event_date", "event_hour")
        .agg(F.sum("revenue").alias("total_revenue"), F.count("*").alias("purchase_count"))
        .withColumn("event_datetime", hour_label("event_date", "event_hour"))
    )


def hourly_revenue(silver: DataFrame) -> DataFrame:
    """Revenue and number of purchases per event hour."""
    return shaped("hourly_revenue", revenue_by_hour(silver))


def product_views(silver: DataFrame) -> DataFrame:
    """Page views per product."""
    viewed = silver.where(F.col("event_type") == "page_view")
    return viewed.groupBy(*PRODUCT).agg(F.count("*").alias("view_count"))


def category_performance(silver: DataFrame) -> DataFrame:
    """Events of every type per day and category; events without category form a group."""
    return silver.groupBy("event_date", "category", "event_type").agg(
        F.count("*").alias("event_count")
    )


def user_activity(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct users and sessions and all events per day.

    Each id is deduplicated by itself, keyed by day and id, so no day is counted
    in one place, and the two results, a row per day each, are put together.
    Two COUNT(DISTINCT) in one aggregation would triple the rows and hold both
    sets of ids at once. ``approximate`` needs one pass and a sketch per day.
    """
    if approximate:
        return silver.groupBy("event_date").agg(
            F.approx_count_distinct("user_id").alias("unique_users"),
            F.approx_count_distinct("session_id").alias("unique_sessions"),
            F.count("*").alias("total_events"),
        )
    users = (
        silver.groupBy("event_date", "user_id")
        .agg(F.count("*").alias("events"))
        .groupBy("event_date")
        .agg(F.count("user_id").alias("unique_users"), F.sum("events").alias("total_events"))
    )
    sessions = (
        silver.select(F.col("event_date").alias("day"), "session_id")
        .distinct()
        .groupBy("day")
        .agg(F.count("session_id").alias("unique_sessions"))
    )
    same_day = F.col("event_date").eqNullSafe(F.col("day"))
    return shaped("user_activity", users.join(sessions, same_day))


TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "conversion_funnel": conversion_funnel,
    "hourly_revenue": hourly_revenue,
    "product_views": product_views,
    "category_performance": category_performance,
    "user_activity": user_activity,
}


def ordered(name: str, table: DataFrame, newest_first: bool = False) -> DataFrame:
    """A table in its reading order, ties settled; the daily tables from either end.

    The funnel has no order of its own.
    """
    day = F.desc("event_date") if newest_first else F.asc("event_date")
    keys: dict[str, list[Column]] = {
        "hourly_revenue": [F.asc("event_datetime")],
        "product_views": [F.desc("view_count"), F.asc("product_id"), F.asc("category")],
        "category_performance": [day, F.asc("category"), F.asc("event_type")],
        "user_activity": [day],
    }
    return table.orderBy(*keys[name]) if name in keys else table
