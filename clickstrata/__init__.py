"""Event analytics on Spark: raw event files, clean events, aggregate tables, reports."""
