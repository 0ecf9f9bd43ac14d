"""The five aggregate tables as Spark SQL, equal to ``operators.gold``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstrata.sources.catalog import identifier, text

SELECTS = {
    "conversion_funnel": """
        WITH steps AS (
            SELECT product_id, category,
                   count_if(event_type = 'page_view') AS views,
                   count_if(event_type = 'add_to_cart') AS add_to_cart,
                   count_if(event_type = 'purchase') AS purchases
            FROM {events}
            WHERE event_type IN ('page_view', 'add_to_cart', 'purchase')
            GROUP BY product_id, category
        )
        SELECT steps.*,
               coalesce(try_divide(add_to_cart, views), 0.0D) AS view_to_cart_rate,
               coalesce(try_divide(purchases, add_to_cart), 0.0D) AS cart_to_purchase_rate,
               coalesce(try_divide(purchases, views), 0.0D) AS view_to_purchase_rate
        FROM steps
    """,
    "hourly_revenue": """
        SELECT date_format(date_trunc('HOUR', timestamp_parsed), 'yyyy-MM-dd HH:mm:ss')
                   AS event_datetime,
               sum(revenue) AS total_revenue,
               count(*) AS purchase_count
        FROM {events}
        WHERE event_type = 'purchase'
        GROUP BY date_trunc('HOUR', timestamp_parsed)
    """,
    "product_views": """
        SELECT product_id, category, count(*) AS view_count
        FROM {events}
        WHERE event_type = 'page_view'
        GROUP BY product_id, category
    """,
    "category_performance": """
        SELECT event_date, category, event_type, count(*) AS event_count
        FROM {events}
        GROUP BY event_date, category, event_type
    """,
    "user_activity": """
        WITH users AS (
            SELECT event_date, user_id, count(*) AS n
            FROM {events} GROUP BY event_date, user_id
        ), sessions AS (
            SELECT DISTINCT event_date, session_id FROM {events}
        ), by_user AS (
            SELECT event_date, count(user_id) AS unique_users, sum(n) AS total_events
            FROM users GROUP BY event_date
        ), by_session AS (
            SELECT event_date, count(session_id) AS unique_sessions
            FROM sessions GROUP BY event_date
        )
        SELECT by_user.event_date, unique_users, unique_sessions, total_events
        FROM by_user JOIN by_session ON by_user.event_date <=> by_session.event_date
    """,
}


def select(spark: SparkSession, name: str, silver: DataFrame) -> DataFrame:
    return spark.sql(SELECTS[name], events=silver)


def create_table(
    spark: SparkSession, name: str, events: str, database: str = "gold", root: str | None = None
) -> None:
    """Build a gold table once from the named silver table or view; an existing one stays."""
    place = f"LOCATION {text(f'{root}/{name}')}" if root else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {identifier(database, name)} USING PARQUET {place} "
        f"AS {SELECTS[name].format(events=events)}"
    )


def refill_table(spark: SparkSession, name: str, events: str, database: str = "gold") -> None:
    """Replace the rows of an existing gold table."""
    query = SELECTS[name].format(events=events)
    spark.sql(f"INSERT OVERWRITE TABLE {identifier(database, name)} {query}")
