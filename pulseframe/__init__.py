"""Daily time-series analytics for many users, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
