"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each season.
SEASON_MONTHS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}


def day_of_week(d: Column) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(d) - 1


def season(d: Column) -> Column:
    """Season name of a date, by month."""
    month, out = F.month(d), None
    for name, months in SEASON_MONTHS.items():
        hit = month.isin(*months)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday."""
    return F.dayofweek(d).isin(1, 7)
