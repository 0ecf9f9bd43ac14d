"""Column expressions: event time, revenue, hour label, ratios, percent."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def event_time(text: str) -> Column:
    """ISO-8601 text as a timestamp; text that is no timestamp becomes NULL."""
    return F.try_to_timestamp(text)


def purchase_revenue() -> Column:
    """Price times quantity for a purchase (NULL if either is NULL), 0.0 for the rest."""
    return F.expr("CASE WHEN event_type = 'purchase' THEN price * quantity ELSE 0.0D END")


def hour_label(date: str, hour: str) -> Column:
    """``yyyy-MM-dd HH:00:00`` from a date and an hour; NULL if either is NULL."""
    day = f"date_format({date}, 'yyyy-MM-dd')"
    return F.expr(f"{day} || ' ' || lpad(CAST({hour} AS STRING), 2, '0') || ':00:00'")


def rate(part: str, whole: str) -> Column:
    """part / whole, and 0.0 where whole is zero."""
    return F.expr(f"coalesce(try_divide({part}, {whole}), 0.0D)")


def percent(fraction: str) -> Column:
    return F.expr(f"round({fraction} * 100, 2)")


def per(total: str, count: str) -> Column:
    """total / count to two places; NULL where count is zero."""
    return F.expr(f"round(try_divide(CAST({total} AS DOUBLE), CAST({count} AS DOUBLE)), 2)")
