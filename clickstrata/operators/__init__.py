"""DataFrame-to-DataFrame steps: clean events, aggregate tables, reports."""
