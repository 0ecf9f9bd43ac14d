"""The five reports as Spark SQL, equal to ``operators.reports``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstrata.operators.reports import FUNNEL_ROWS, TOP_PRODUCTS
from clickstrata.sources.catalog import identifier

# Report: the gold table it reads, and the query.
QUERIES = {
    "conversion_funnel": (
        "conversion_funnel",
        f"""
        SELECT product_id, category, views, add_to_cart, purchases,
               round(view_to_cart_rate * 100, 2) AS view_to_cart_pct,
               round(cart_to_purchase_rate * 100, 2) AS cart_to_purchase_pct,
               round(view_to_purchase_rate * 100, 2) AS view_to_purchase_pct
        FROM {{table}}
        WHERE views > 0
        ORDER BY purchases DESC, views DESC, product_id, category
        LIMIT {FUNNEL_ROWS}
        """,
    ),
    "hourly_revenue": (
        "hourly_revenue",
        """
        SELECT event_datetime AS hour, round(total_revenue, 2) AS revenue,
               purchase_count AS num_purchases
        FROM {table}
        ORDER BY hour
        """,
    ),
    "top_products": (
        "product_views",
        f"""
        SELECT product_id, category, view_count
        FROM {{table}}
        ORDER BY view_count DESC, product_id, category
        LIMIT {TOP_PRODUCTS}
        """,
    ),
    "category_performance": (
        "category_performance",
        """
        SELECT event_date, category, event_type, event_count
        FROM {table}
        ORDER BY event_date DESC, category ASC NULLS LAST, event_count DESC, event_type
        """,
    ),
    "user_activity": (
        "user_activity",
        """
        SELECT event_date, unique_users, unique_sessions, total_events,
               round(try_divide(double(total_events), unique_users), 2) AS events_per_user,
               round(try_divide(double(total_events), unique_sessions), 2) AS events_per_session
        FROM {table}
        ORDER BY event_date DESC
        """,
    ),
}


def over_frame(spark: SparkSession, name: str, table: DataFrame) -> DataFrame:
    return spark.sql(QUERIES[name][1], table=table)


def over_catalog(spark: SparkSession, name: str, database: str = "gold") -> DataFrame:
    source, query = QUERIES[name]
    return spark.sql(query.format(table=identifier(database, source)))
