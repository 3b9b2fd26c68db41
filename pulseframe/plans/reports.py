"""Reports over the metric tables, their key figures and distributions.

Every figure is an aggregation on Spark; nothing is computed on a collected frame.
"Current" figures are per user.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import labels
from pulseframe.operators.dedup import latest_row
from pulseframe.operators.series import DAY, USER

# The date ranges on offer, in days.
DATE_RANGES = {
    "Last 7 Days": 7,
    "Last 30 Days": 30,
    "Last 90 Days": 90,
    "Last 365 Days": 365,
    "All Time": None,
}
# Columns of each report after the date.
REPORT_COLUMNS = {
    "momentum": (
        "recovery_score",
        "day_1_change",
        "day_3_change",
        "day_7_change",
        "day_14_change",
        "recovery_momentum_score",
        "momentum_category",
    ),
    "efficiency": (
        "day_strain",
        "recovery_score",
        "next_day_recovery",
        "baseline_recovery",
        "recovery_efficiency_ratio",
        "efficiency_30day_avg",
        "efficiency_category",
    ),
    "readiness": (
        "recovery_score",
        "body_readiness",
        "optimal_strain_target",
        "training_recommendation_score",
        "readiness_motivation_gap",
        "gap_category",
        "overtraining_risk_flag",
    ),
    "volatility": (
        "recovery_score",
        "volatility_7d",
        "volatility_30d",
        "volatility_coefficient",
        "volatility_trend",
        "volatility_category",
    ),
    "balance": (
        "hrv_rmssd",
        "resting_heart_rate",
        "hrv_rhr_ratio",
        "hrv_rhr_ratio_7d_avg",
        "autonomic_balance_score",
        "balance_category",
    ),
    "seasonal": (
        "month_name",
        "season",
        "recovery_score",
        "seasonal_recovery_baseline",
        "recovery_deviation",
        "seasonal_adaptation_index",
        "adaptation_category",
    ),
}
# Key figures of each report, as column means and latest values.
MEANS = {
    "momentum": ("recovery_momentum_score", "recovery_score"),
    "efficiency": ("recovery_efficiency_ratio",),
    "readiness": ("recovery_score",),
}
CURRENT = {
    "momentum": ("momentum_category", "day_1_change"),
    "efficiency": ("efficiency_category", "efficiency_30day_avg"),
    "readiness": ("readiness_motivation_gap", "gap_category"),
    "volatility": ("volatility_7d", "volatility_30d", "volatility_category"),
    "balance": (
        "hrv_rmssd",
        "resting_heart_rate",
        "autonomic_balance_score",
        "balance_category",
    ),
    "seasonal": ("season", "seasonal_recovery_baseline", "adaptation_category"),
}


def last_days(df: DataFrame, as_of: Column, days: int | None, day: str = "date_day") -> DataFrame:
    """Rows of the last ``days`` days; all rows for None."""
    if days is None:
        return df
    return df.filter(F.col(day) >= F.date_sub(as_of, days))


def report_rows(
    name: str,
    metric: DataFrame,
    dim_date: DataFrame,
    as_of: Column | None = None,
    days: int | None = None,
) -> DataFrame:
    """Unsorted report of one metric: user, date and the report's columns.

    The date range is put on the date dimension, so the join prunes the metric.
    """
    day_columns = [DAY, "date_day", "month_name"]
    dates = dim_date.select(*day_columns)
    if days is not None:
        dates = last_days(dates, as_of, days)
    columns = REPORT_COLUMNS[name]
    own = [c for c in columns if c in metric.columns]
    joined = metric.select(USER, DAY, *own).join(dates, DAY)
    return joined.select(USER, "date_day", *columns)


def report(
    name: str,
    metric: DataFrame,
    dim_date: DataFrame,
    as_of: Column | None = None,
    days: int | None = None,
) -> DataFrame:
    """Report in date order. The user breaks ties, which also keeps the sort's
    ranges even when one date holds many users."""
    return report_rows(name, metric, dim_date, as_of, days).orderBy("date_day", USER)


def key_means(rows: DataFrame, name: str) -> DataFrame:
    """Means of the report's key columns, one row."""
    return rows.agg(*[F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in MEANS[name]])


def risk_days(rows: DataFrame) -> DataFrame:
    """Number of days with the overtraining flag."""
    return rows.agg(F.count_if("overtraining_risk_flag").alias("risk_days"))


def current_values(rows: DataFrame, name: str) -> DataFrame:
    """Latest value of the report's key columns per user."""
    return latest_row(rows, [USER], "date_day", ["date_day", *CURRENT[name]])


def distribution(rows: DataFrame, category: str) -> DataFrame:
    """Rows per category, most frequent first."""
    counts = rows.filter(F.col(category).isNotNull()).groupBy(category).agg(
        F.count("*").alias("n")
    )
    return counts.orderBy(F.desc("n"), category)


def season_summary(rows: DataFrame) -> DataFrame:
    """Mean recovery and adaptation index per season."""
    return rows.groupBy("season").agg(
        F.avg(F.col("recovery_score").cast("double")).alias("recovery_score"),
        F.avg("seasonal_adaptation_index").alias("seasonal_adaptation_index"),
    )


def chart_columns(rows: DataFrame, name: str) -> DataFrame:
    """Colour and size columns the report's charts use."""
    if name == "readiness":
        return rows.withColumn("color", labels.gap_color(F.col("readiness_motivation_gap")))
    if name == "seasonal":
        return rows.withColumn("color", labels.sign_color(F.col("recovery_deviation")))
    if name == "efficiency":
        return rows.withColumn("size", labels.bubble_size(F.col("recovery_efficiency_ratio")))
    return rows


def all_reports(
    metrics: Mapping[str, DataFrame],
    dim_date: DataFrame,
    as_of: Column,
    days: int | None,
    names: Sequence[str] = tuple(REPORT_COLUMNS),
) -> dict[str, DataFrame]:
    """Every report over the same date range."""
    return {n: report(n, metrics[n], dim_date, as_of, days) for n in names}
