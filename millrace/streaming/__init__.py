"""Event time, starting queries and running totals on streams."""
