"""What each registered query must return, as DuckDB SQL over the given tables."""

from __future__ import annotations

from clickstrata.schemas import CATEGORIES, SEARCH_PHRASES

# The bronze feed derived from the events table, then clean events and gold tables.
_FEED = f"""
raw AS (
    SELECT event_id, ts, user_id, value,
           ts + CASE WHEN event_id % 4 = 3 THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END
               AS arrived,
           CAST(props ->> 'k' AS INTEGER) AS k,
           CASE event_type WHEN 'view' THEN 'page_view'
                           WHEN 'click' THEN 'add_to_cart'
                           WHEN 'error' THEN 'remove_from_cart'
                           WHEN 'purchase' THEN 'purchase'
                           WHEN 'signup' THEN 'search' END AS kind
    FROM events
),
arrivals AS (
    SELECT event_id,
           CASE WHEN event_id % 97 = 13 THEN 'no time'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS "timestamp",
           CASE WHEN event_id % 97 <> 13 THEN ts END AS event_ts,
           'u_' || user_id AS user_id,
           's_' || user_id || '_' || (10 * dayofyear(ts) + hour(ts) // 6) AS session_id,
           kind AS event_type,
           CASE WHEN kind = 'purchase' AND event_id % 53 = 5 THEN 'p_9001'
                WHEN kind <> 'search'
                THEN 'p_' || ((k % 6 + 1) * 1000 + k % 5 + 1) END AS product_id,
           CASE WHEN kind IN ('add_to_cart', 'remove_from_cart', 'purchase')
                THEN CAST(event_id % 5 + 1 AS INTEGER) END AS quantity,
           CASE WHEN kind IN ('add_to_cart', 'remove_from_cart', 'purchase')
                     AND event_id % 89 <> 7
                THEN value END AS price,
           CASE WHEN kind <> 'search'
                THEN {list(CATEGORIES)}[k % 6 + 1]
           END AS category,
           CASE WHEN kind = 'search'
                THEN {list(SEARCH_PHRASES)}[event_id % 8 + 1]
           END AS search_query,
           CASE WHEN event_id % 101 = 50 THEN '2023' ELSE strftime(arrived, '%Y') END AS "year",
           strftime(arrived, '%m') AS "month", strftime(arrived, '%d') AS "day",
           strftime(arrived, '%H') AS "hour", '00' AS "minute"
    FROM raw
),
feed AS (SELECT * FROM arrivals WHERE "year" >= '2024')"""

_SILVER = f"""{_FEED},
silver AS (
    SELECT "timestamp", event_ts AS timestamp_parsed, CAST(event_ts AS DATE) AS event_date,
           CAST(hour(event_ts) AS INTEGER) AS event_hour, user_id, session_id, event_type,
           product_id, quantity, price,
           CASE WHEN event_type = 'purchase' THEN price * quantity ELSE 0.0e0 END AS revenue,
           category, search_query,
           CAST(year(event_ts) AS INTEGER) AS "year",
           CAST(month(event_ts) AS INTEGER) AS "month",
           CAST(day(event_ts) AS INTEGER) AS "day"
    FROM feed
)"""

_GOLD = {
    "conversion_funnel": """
        SELECT product_id, category, views, add_to_cart, purchases,
               CASE WHEN views = 0 THEN 0.0e0
                    ELSE add_to_cart / CAST(views AS DOUBLE) END AS view_to_cart_rate,
               CASE WHEN add_to_cart = 0 THEN 0.0e0
                    ELSE purchases / CAST(add_to_cart AS DOUBLE) END AS cart_to_purchase_rate,
               CASE WHEN views = 0 THEN 0.0e0
                    ELSE purchases / CAST(views AS DOUBLE) END AS view_to_purchase_rate
        FROM (SELECT product_id, category,
                     COUNT(*) FILTER (WHERE event_type = 'page_view') AS views,
                     COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart,
                     COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases
              FROM silver
              WHERE event_type IN ('page_view', 'add_to_cart', 'purchase')
              GROUP BY ALL)""",
    "hourly_revenue": """
        SELECT strftime(timestamp_parsed, '%Y-%m-%d %H:00:00') AS event_datetime,
               ROUND(SUM(revenue), 2) AS total_revenue, COUNT(*) AS purchase_count
        FROM silver WHERE event_type = 'purchase' GROUP BY event_datetime""",
    "product_views": """
        SELECT product_id, category, COUNT(*) AS view_count
        FROM silver WHERE event_type = 'page_view' GROUP BY ALL""",
    "category_performance": """
        SELECT event_date, category, event_type, COUNT(*) AS event_count
        FROM silver GROUP BY ALL""",
    "user_activity": """
        SELECT event_date, COUNT(DISTINCT user_id) AS unique_users,
               COUNT(DISTINCT session_id) AS unique_sessions, COUNT(*) AS total_events
        FROM silver GROUP BY event_date""",
}

# Report: gold table, query.
_REPORTS = {
    "conversion_funnel": (
        "conversion_funnel",
        """
        SELECT product_id, category, views, add_to_cart, purchases,
               ROUND(view_to_cart_rate * 100, 2) AS view_to_cart_pct,
               ROUND(cart_to_purchase_rate * 100, 2) AS cart_to_purchase_pct,
               ROUND(view_to_purchase_rate * 100, 2) AS view_to_purchase_pct
        FROM gold WHERE views > 0
        ORDER BY purchases DESC, views DESC, product_id, category LIMIT 20""",
    ),
    "hourly_revenue": (
        "hourly_revenue",
        """
        SELECT event_datetime AS "hour", total_revenue AS revenue,
               purchase_count AS num_purchases FROM gold ORDER BY 1""",
    ),
    "top_products": (
        "product_views",
        """
        SELECT product_id, category, view_count FROM gold
        ORDER BY view_count DESC, product_id, category LIMIT 10""",
    ),
    "category_performance": (
        "category_performance",
        """
        SELECT event_date, category, event_type, event_count FROM gold
        ORDER BY event_date DESC, category NULLS LAST, event_count DESC, event_type""",
    ),
    "user_activity": (
        "user_activity",
        """
        SELECT event_date, unique_users, unique_sessions, total_events,
               ROUND(total_events / CAST(unique_users AS DOUBLE), 2) AS events_per_user,
               ROUND(total_events / CAST(unique_sessions AS DOUBLE), 2) AS events_per_session
        FROM gold ORDER BY event_date DESC""",
    ),
}

_BRONZE_COLUMNS = (
    '"timestamp", user_id, session_id, event_type, product_id, quantity, price, category, '
    'search_query, "year", "month", "day", "hour", "minute"'
)
_HEAD = """'{"timestamp":"' || "timestamp" || '","user_id":"' || user_id || '"'"""
_REFUSED = f"""
    SELECT "year", "month", "day", "hour", "minute", {_HEAD} AS raw_line, '{{}}' AS readable_part
    FROM feed WHERE event_type = 'remove_from_cart'
    UNION ALL
    SELECT "year", "month", "day", "hour", "minute", {_HEAD} || ',"quantity":"x"}}', {_HEAD} || '}}'
    FROM feed WHERE event_type = 'search'
    UNION ALL
    SELECT "year", "month", "day", "hour", "minute",
           CASE event_id % 7 WHEN 3 THEN {_HEAD} || '}}' || {_HEAD} || '}}'
                             WHEN 4 THEN '[' || {_HEAD} || '}}]'
                             ELSE {_HEAD} || '}} x' END,
           CASE event_id % 7 WHEN 4 THEN '{{}}' ELSE {_HEAD} || '}}' END
    FROM feed WHERE event_type = 'add_to_cart' AND event_id % 7 IN (3, 4, 5)"""


def statements() -> dict[str, str]:
    silver = f"WITH {_SILVER} SELECT * FROM silver"
    sql = {
        "silver_events": silver,
        "ingest_incremental": silver,
        "silver_compacted": silver,
        "silver_table_events": silver,
        "bronze_table_events": f"WITH {_FEED} SELECT {_BRONZE_COLUMNS} FROM feed",
        "streamed_hourly_revenue": f"""
            WITH {_SILVER}, gold AS ({_GOLD["hourly_revenue"]})
            SELECT * FROM gold
            WHERE CAST(event_datetime AS TIMESTAMP) + INTERVAL 1 HOUR <= (
                SELECT max(timestamp_parsed) - INTERVAL 6 HOUR FROM silver
                WHERE event_type = 'purchase')""",
        "sketched_monthly_activity": f"""
            WITH {_SILVER}
            SELECT CAST(date_trunc('month', event_date) AS DATE) AS "month",
                   COUNT(DISTINCT user_id) AS unique_users,
                   COUNT(DISTINCT session_id) AS unique_sessions, COUNT(*) AS total_events,
                   TRUE AS users_near, TRUE AS sessions_near
            FROM silver GROUP BY 1""",
        "bronze_scan": f"WITH {_FEED} SELECT {_BRONZE_COLUMNS} FROM feed",
        "bronze_quarantine": f"WITH {_FEED} {_REFUSED}",
        "ingest_quarantine": f"""
            WITH {_FEED}, refused AS ({_REFUSED})
            SELECT raw_line, CAST("year" AS INTEGER) AS "year",
                   CAST("month" AS INTEGER) AS "month", CAST("day" AS INTEGER) AS "day"
            FROM refused""",
        "bronze_inventory": f"""
            WITH {_FEED}
            SELECT "year", "month", "day", "hour",
                   COUNT(DISTINCT event_id // 600000) AS files,
                   COUNT(*) + COUNT(*) FILTER (
                       WHERE event_type IN ('remove_from_cart', 'search')
                             OR event_type = 'add_to_cart' AND event_id % 7 IN (3, 4, 5)) AS lines
            FROM feed GROUP BY ALL""",
        "bronze_readiness": f"""
            WITH {_FEED}, files AS (
                SELECT DISTINCT "year", "month", "day", "hour", "minute", event_id // 600000
                FROM feed)
            SELECT COUNT(*) AS files,
                   MAX("year" || '-' || "month" || '-' || "day" || '-' || "hour" || '-' || "minute")
                       AS newest_arrival,
                   COUNT(*) >= 12 AS ready
            FROM files""",
    }
    for name, query in _GOLD.items():
        for key in (
            f"gold_{name}", f"gold_{name}_sql", f"gold_{name}_ctas", f"refresh_{name}"
        ):
            sql[key] = f"WITH {_SILVER} {query}"
    for name, (source, query) in _REPORTS.items():
        for key in (f"report_{name}", f"report_{name}_sql", f"report_{name}_stored"):
            sql[key] = f"WITH {_SILVER}, gold AS ({_GOLD[source]}) {query}"
    return sql
