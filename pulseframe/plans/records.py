"""Documented record-grain facts, their reports and run figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.incremental import after_target
from pulseframe.plans.staging import HOURS, MINUTES


def _unit_names(df: DataFrame) -> list[Column]:
    """Columns with the unit they hold in their name."""
    out = []
    for c in df.columns:
        if c in HOURS:
            out.append(F.col(c).alias(c.replace("_time_milli", "_milli").replace("_milli", "_hours")))
        elif c in MINUTES:
            out.append(
                F.col(c).alias(c.replace("_time_milli", "_milli").replace("_milli", "_minutes"))
            )
        else:
            out.append(F.col(c))
    return out


def _fresh(staging: DataFrame, target: DataFrame | None) -> DataFrame:
    return staging if target is None else after_target(staging, target, "ingested_at")


def fact_sleep(stg_sleep: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = _fresh(stg_sleep, target)
    return rows.select(F.to_date("start_time").alias("sleep_date"), *_unit_names(rows)).drop("v1_id")


def fact_cycles(stg_cycle: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = _fresh(stg_cycle, target)
    return rows.select(F.to_date("start_time").alias("cycle_date"), "*")


def fact_workouts(stg_workout: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = _fresh(stg_workout, target)
    unused = (
        "v1_id",
        "sport_name",
        "percent_recorded",
        "distance_meter",
        "altitude_gain_meter",
        "altitude_change_meter",
    )
    return rows.select(
        F.to_date("created_at").alias("workout_date"), *_unit_names(rows)
    ).drop(*unused)


def fact_recovery(stg_recovery: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = _fresh(stg_recovery, target)
    return rows.select(F.to_date("created_at").alias("recovery_date"), "*").drop("sleep_id")


def sleep_report(
    sleeps: DataFrame, dim_user: DataFrame, dim_date: DataFrame, as_of: Column, days: int = 30
) -> DataFrame:
    """Sleep performance of the last days, best first."""
    dates = dim_date.filter(F.col("date_day") >= F.date_sub(as_of, days)).select("date_day")
    users = dim_user.select("user_id", "first_name", "last_name")
    rows = sleeps.join(dates, F.col("sleep_date") == F.col("date_day")).join(users, "user_id")
    return rows.select(
        "first_name",
        "last_name",
        "date_day",
        "sleep_performance_percentage",
        "total_in_bed_hours",
        "id",
    ).orderBy(F.desc_nulls_first("sleep_performance_percentage"), "id")


def weekly_correlation(cycles: DataFrame, recovery: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Mean strain and recovery per week of the year."""
    pairs = cycles.select("id", "cycle_date", "strain").join(
        recovery.select(F.col("cycle_id").alias("id"), "recovery_score"), "id"
    )
    weeks = dim_date.select(F.col("date_day").alias("cycle_date"), "week_of_year")
    return (
        pairs.join(weeks, "cycle_date")
        .groupBy("week_of_year")
        .agg(
            F.avg(F.col("strain").cast("double")).alias("avg_strain"),
            F.avg(F.col("recovery_score").cast("double")).alias("avg_recovery"),
        )
        .orderBy("week_of_year")
    )


def created_between(raw: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Records created from ``first`` to ``last`` (both included), for a range backfill."""
    end = last + dt.timedelta(days=1)
    low, high = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (first, end))
    return raw.filter((F.col("created_at") >= low) & (F.col("created_at") < high))


def run_figures(run_log: DataFrame, as_of: Column) -> DataFrame:
    """Per source: runs, success rate, mean records and seconds, freshness in hours."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(
        F.max("newest").cast("timestamp")
    )) / 3_600_000_000
    return run_log.groupBy("source").agg(
        F.count("*").alias("runs"),
        F.avg((F.col("status") == "success").cast("double")).alias("success_rate"),
        F.avg(F.col("records").cast("double")).alias("avg_records"),
        F.avg("seconds").alias("avg_seconds"),
        age.alias("hours_since_newest"),
    )
