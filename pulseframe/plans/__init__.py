"""The tables: staging, dimensions, daily facts, metrics and reports."""
