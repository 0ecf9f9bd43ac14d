"""Five reports over the aggregate tables. Ties are settled, so a report is repeatable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from clickstrata.functions.expressions import per, percent

# How many products the two rankings show.
FUNNEL_ROWS = 20
TOP_PRODUCTS = 10


def conversion_funnel(table: DataFrame) -> DataFrame:
    """The most bought of the viewed products, with conversion in percent."""
    return (
        table.where(F.col("views") > 0)
        .select(
            "product_id",
            "category",
            "views",
            "add_to_cart",
            "purchases",
            percent("view_to_cart_rate").alias("view_to_cart_pct"),
            percent("cart_to_purchase_rate").alias("cart_to_purchase_pct"),
            percent("view_to_purchase_rate").alias("view_to_purchase_pct"),
        )
        .orderBy(F.desc("purchases"), F.desc("views"), "product_id", "category")
        .limit(FUNNEL_ROWS)
    )


def hourly_revenue(table: DataFrame) -> DataFrame:
    """Revenue per hour, oldest first."""
    return table.select(
        F.col("event_datetime").alias("hour"),
        F.round("total_revenue", 2).alias("revenue"),
        F.col("purchase_count").alias("num_purchases"),
    ).orderBy("hour")


def top_products(table: DataFrame) -> DataFrame:
    """The most viewed products."""
    ranked = table.orderBy(F.desc("view_count"), "product_id", "category")
    return ranked.limit(TOP_PRODUCTS)


def category_performance(table: DataFrame) -> DataFrame:
    """Newest day first; within a day by category, the one without a name last, then count."""
    return table.orderBy(
        F.desc("event_date"),
        F.asc_nulls_last("category"),
        F.desc("event_count"),
        "event_type",
    )


def user_activity(table: DataFrame) -> DataFrame:
    """Daily activity with events per user and per session, newest day first."""
    return table.withColumns(
        {
            "events_per_user": per("total_events", "unique_users"),
            "events_per_session": per("total_events", "unique_sessions"),
        }
    ).orderBy(F.desc("event_date"))


# Report: the gold table it reads, and the function.
REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "conversion_funnel": ("conversion_funnel", conversion_funnel),
    "hourly_revenue": ("hourly_revenue", hourly_revenue),
    "top_products": ("product_views", top_products),
    "category_performance": ("category_performance", category_performance),
    "user_activity": ("user_activity", user_activity),
}
