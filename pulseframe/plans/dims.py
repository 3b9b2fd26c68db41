"""Date and user dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions import calendar, labels
from pulseframe.functions.compat import date_key, surrogate_key

# Range of the date dimension.
FIRST_DAY = dt.date(2020, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)

DIM_DATE_COLUMNS = (
    "date_sk",
    "date_day",
    "day_of_week",
    "day_of_week_name",
    "day_of_month",
    "day_of_year",
    "week_of_year",
    "month_of_year",
    "month_name",
    "quarter_of_year",
    "year_number",
    "season",
)


def date_series(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    n = (last - first).days + 1
    start = F.lit(first.isoformat()).cast("date")
    return spark.range(n).select(F.date_add(start, F.col("id").cast("int")).alias("date_day"))


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day of each ``(first, last)`` row, unfolded on the executors."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("date_day"))


def calendar_columns(days: DataFrame) -> DataFrame:
    """Calendar attributes of the dates in ``date_day``."""
    d = F.col("date_day")
    return days.select(
        date_key(d).alias("date_sk"),
        d,
        calendar.day_of_week(d).alias("day_of_week"),
        F.dayname(d).alias("day_of_week_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_of_year"),
        F.monthname(d).alias("month_name"),
        F.quarter(d).alias("quarter_of_year"),
        F.year(d).alias("year_number"),
        calendar.season(d).alias("season"),
    )


def dim_date(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """Date dimension. Its size is fixed by the range (4,018 rows by default), and
    as a generated range Spark knows that, so it is broadcast without a hint."""
    return calendar_columns(date_series(spark, first, last))


def with_weekend(dim: DataFrame) -> DataFrame:
    return dim.withColumn("is_weekend", calendar.is_weekend(F.col("date_day")))


def with_extra_columns(dim: DataFrame, as_of: Column) -> DataFrame:
    """Further documented date columns."""
    d = F.col("date_day")
    return dim.select(
        "*",
        (~calendar.is_weekend(d)).alias("is_weekday"),
        F.date_format(d, "EEEE").alias("date_day_name"),
        F.date_format(d, "MMMM yyyy").alias("month_year_name"),
        F.datediff(d, as_of).alias("days_from_today"),
    )


def dim_user(stg_user: DataFrame) -> DataFrame:
    """User dimension with a text key; current values only."""
    return stg_user.select(
        surrogate_key("user_id").alias("user_sk"),
        "user_id",
        "email",
        "first_name",
        "last_name",
        "created_at",
        "updated_at",
    )


def score_states(staging: DataFrame, subject: str) -> DataFrame:
    """Distinct score states of a staging table with a description."""
    states = staging.select("score_state").filter(F.col("score_state").isNotNull()).distinct()
    text = labels.score_state_text(F.col("score_state"), subject)
    return states.withColumn("score_state_description", text)
