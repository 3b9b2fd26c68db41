"""Recovery percentiles and the two daily facts.

Every input is reduced to one row per user and day before it is joined or
windowed. The reduction runs in the map tasks, and afterwards no user has more
rows than the calendar has days, so neither the joins nor the per-user windows
depend on how many raw rows a single user has. User and date joins come after
the reduction; both are on keys, so the order does not change the result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.compat import hash64_key, minutes_between, surrogate_key
from pulseframe.operators import series
from pulseframe.operators.dedup import latest_per_key
from pulseframe.operators.incremental import after_watermark, merge_upsert, since_horizon

# Gates and frames of the percentile table.
BASELINE_ROWS = 29
BASELINE_MIN_ROWS = 14
HISTORY_ROWS = 365
HISTORY_MIN_ROWS = 60
HORIZON_DAYS = 90
# Fixed value: the watermark of an empty strain fact.
STRAIN_FLOOR = dt.datetime(1990, 1, 1)

ZONES = ("zero", "one", "two", "three", "four", "five")


def _with_keys(df: DataFrame, day: str, dim_user: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Inner joins to both dimensions; adds ``user_sk`` and ``date_sk``.

    Profiles may repeat (they are not deduplicated), hence one row per user here.
    """
    return _with_date_key(df, day, dim_date).join(_user_keys(dim_user), "user_id")


def _with_date_key(df: DataFrame, day: str, dim_date: DataFrame) -> DataFrame:
    return df.join(dim_date.select(F.col("date_day").alias(day), "date_sk"), day)


def _user_keys(dim_user: DataFrame) -> DataFrame:
    return dim_user.select("user_id", "user_sk").dropDuplicates(["user_id"])


# Columns of a staged recovery that its daily measures come from.
RECOVERY_COLUMNS = (
    "cycle_id",
    "user_id",
    "created_at",
    "updated_at",
    "recovery_score",
    "hrv_rmssd_milli",
    "resting_heart_rate",
    "skin_temp_celsius",
)


def recovery_days(stg_recovery: DataFrame, dim_user: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The measures of each user and day: what is ranked. Rows without a score or a skin temperature take no part."""
    keyed = _measured_days(stg_recovery, dim_date).join(_user_keys(dim_user), "user_id")
    return keyed.select("user_id", "user_sk", "date_sk", *MEASURES, "skin_temp_celsius")


def _newest_of_day(rows: DataFrame, day: str, unique: Sequence[str] | None) -> DataFrame:
    """The newest recovery of each user and day.

    ``unique`` says that ``cycle_id`` is unique, as in a staging table, so that no hash of the row is shuffled
    to tell rows apart. It names columns that are carried along all the same: two reductions
    of the same staged rows that need the same columns read one shuffle of them.
    """
    order = ["updated_at", "created_at", "cycle_id"]
    if unique is None:
        return latest_per_key(rows, ["user_id", day], order)
    carried = [F.col(c).isNull() for c in unique]  # behind a unique id this orders nothing
    return latest_per_key(rows, ["user_id", day], [*order, *carried], order_is_total=True)


def _measured_days(
    stg_recovery: DataFrame, dim_date: DataFrame, unique: Sequence[str] | None = None
) -> DataFrame:
    """The same by ``user_id`` alone."""
    rows = stg_recovery.filter(
        F.col("recovery_score").isNotNull() & F.col("skin_temp_celsius").isNotNull()
    ).select(
        "user_id",
        F.to_date("created_at").alias("recovery_date"),
        "recovery_score",
        F.col("hrv_rmssd_milli").alias("hrv_rmssd"),
        "resting_heart_rate",
        "skin_temp_celsius",
        "updated_at",
        "created_at",
        "cycle_id",
    )
    daily = _newest_of_day(rows, "recovery_date", unique)
    dated = _with_date_key(daily, "recovery_date", dim_date)
    return dated.select("user_id", "recovery_date", "date_sk", *MEASURES, "skin_temp_celsius")


# What is ranked, with the name of its rank and whether the greatest value has rank 0.
RANKS = {
    "recovery_score": ("recovery_score_percentile", False),
    "hrv_rmssd": ("hrv_percentile", False),
    "resting_heart_rate": ("rhr_percentile", True),
}
MEASURES = tuple(RANKS)
RANKED = [rank for rank, _ in RANKS.values()]
# Keys of the records, by which percentiles and records of a day can meet.
RECORD_KEYS = ("user_id", "recovery_date")
PERCENTILES = ["user_sk", "date_sk", *RANKED, "skin_temp_celsius", "skin_temp_deviation", "days_of_history"]


def rank_days(days: DataFrame, user: str = "user_sk", keep: Sequence[str] = ()) -> DataFrame:
    """Percentiles and skin-temperature baseline of one row per user and day, over each user's full series.

    ``user`` names the column that tells users apart, ``keep`` further columns.
    """
    before = series.previous_rows(BASELINE_ROWS, user)
    temp = F.col("skin_temp_celsius").cast("double")
    measured = days.select(
        user,
        "date_sk",
        "skin_temp_celsius",
        *keep,
        F.avg(temp).over(before).alias("_baseline"),
        F.count(temp).over(before).alias("_baseline_rows"),
        series.rows_so_far(HISTORY_ROWS, user).alias("days_of_history"),
        *[series.rank_percentile(c, down, user).alias(name) for c, (name, down) in RANKS.items()],
    )
    ranked = F.col("days_of_history") >= HISTORY_MIN_ROWS
    return measured.select(
        user,
        "date_sk",
        *[F.when(ranked, F.col(c)).alias(c) for c in RANKED],
        "skin_temp_celsius",
        F.when(
            F.col("_baseline_rows") >= BASELINE_MIN_ROWS,
            F.round(temp - F.col("_baseline"), 2),
        ).alias("skin_temp_deviation"),
        "days_of_history",
        *keep,
    )


def recovery_percentiles(
    stg_recovery: DataFrame,
    dim_user: DataFrame,
    dim_date: DataFrame,
    as_of: Column | None = None,
    horizon_days: int = HORIZON_DAYS,
    keep: Sequence[str] = (),
    unique: Sequence[str] | None = None,
) -> DataFrame:
    """Skin-temperature baseline and percentiles per user and day.

    Ranks and frames always see the full history; with ``as_of`` only the last
    ``horizon_days`` are returned. ``keep`` names measures, or ``RECORD_KEYS``, that are kept too.
    For ``unique`` see :func:`_newest_of_day`.
    """
    # Frames by user_id, which is one to one with user_sk: the long key is joined behind them, so no
    # sort carries it, and the join finds the rows laid out and sorted by user_id.
    more = [c for c in keep if c != "user_id"]
    ranked = rank_days(_measured_days(stg_recovery, dim_date, unique), "user_id", more)
    ranked = ranked.join(_user_keys(dim_user), "user_id").select(*PERCENTILES, *keep)
    if as_of is None:
        return ranked
    day = F.to_date(F.col("date_sk").cast("string"), "yyyyMMdd")
    return since_horizon(ranked.withColumn("_day", day), "_day", as_of, horizon_days).drop("_day")


def renew_percentiles(stored: DataFrame, new_days: DataFrame) -> DataFrame:
    """Rows of a percentile table that new days change, whatever their age.

    ``stored`` has one row per user and day, with the measures; so has ``new_days``, whose rows
    replace stored ones of the same day. The table is its own state: a rank depends on all days of
    a user, so of users with new days the stored rows are read and ranked again, of others none is.
    Rows that come out as they were stored are left out.
    """
    keys = ["user_sk", "date_sk"]
    touched = stored.join(new_days.select("user_sk").distinct(), "user_sk", "left_semi")
    columns = [*keys, *MEASURES, "skin_temp_celsius"]
    held = touched.select(*columns, F.struct(*PERCENTILES, *MEASURES).alias("_stored"))
    added = new_days.select(*columns).join(held.select(*keys, "_stored"), keys, "left")
    ranked = rank_days(merge_upsert(held, added, keys), keep=[*MEASURES, "_stored"])
    same = F.struct(*PERCENTILES, *MEASURES).cast(held.schema["_stored"].dataType).eqNullSafe(F.col("_stored"))
    return ranked.filter(~same).drop("_stored")


def daily_sleep(stg_sleep: DataFrame) -> DataFrame:
    """The sleep of each user and day: nights before naps, then the newest."""
    rows = stg_sleep.select(
        "user_id",
        F.to_date("created_at").alias("day"),
        "nap",
        "updated_at",
        "id",
        "sleep_performance_percentage",
        "sleep_consistency_percentage",
        "sleep_efficiency_percentage",
        "respiratory_rate",
    )
    order = [F.asc_nulls_last("nap"), F.desc_nulls_first("updated_at"), F.desc_nulls_first("id")]
    # staged sleeps are unique by id
    best = latest_per_key(rows, ["user_id", "day"], order, order_is_total=True)
    return best.drop("nap", "updated_at", "id")


def fact_daily_recovery(
    stg_recovery: DataFrame,
    dim_user: DataFrame,
    dim_date: DataFrame,
    percentiles: DataFrame,
    stg_sleep: DataFrame,
    md5_key: bool = False,
    unique: Sequence[str] | None = None,
) -> DataFrame:
    """Recovery fact, one row per user and day. ``hrv_rmssd`` is in seconds.

    ``recovery_sk`` has 64 bits, in which two of some ten billion rows can be
    expected to collide; with ``md5_key`` it is the MD5 text key instead.

    Percentiles are joined by ``RECORD_KEYS``, where the records already lie. Those that do not keep
    them get them from the dimensions first: they are far shorter than the records, which are not moved.
    For ``unique`` see :func:`_newest_of_day`.
    """
    rows = stg_recovery.filter(F.col("recovery_score").isNotNull()).select(
        "cycle_id",
        "user_id",
        "created_at",
        "updated_at",
        "recovery_score",
        "resting_heart_rate",
        "hrv_rmssd_milli",
        "skin_temp_celsius",
        F.to_date("created_at").alias("day"),
    )
    daily = _newest_of_day(rows, "day", unique)
    with_sleep = daily.join(daily_sleep(stg_sleep), ["user_id", "day"], "left")
    found = [*RANKED, "skin_temp_deviation"]
    if not set(RECORD_KEYS) <= set(percentiles.columns):
        days = dim_date.select("date_sk", F.col("date_day").alias("recovery_date")).distinct()
        percentiles = percentiles.select("user_sk", "date_sk", *found).join(days, "date_sk")
        percentiles = percentiles.join(_user_keys(dim_user), "user_sk")
    ranks = percentiles.select("user_id", F.col("recovery_date").alias("day"), *found)
    ranked = with_sleep.join(ranks, ["user_id", "day"], "left")
    joined = _with_keys(ranked, "day", dim_user, dim_date)

    def decimal(c: Column | str, precision: int, scale: int) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        return c.cast(f"decimal({precision},{scale})")

    return joined.select(
        (surrogate_key if md5_key else hash64_key)("cycle_id", "user_id").alias("recovery_sk"),
        "user_sk",
        "date_sk",
        decimal("recovery_score", 5, 2).alias("recovery_score"),
        "recovery_score_percentile",
        decimal(F.col("hrv_rmssd_milli") / 1000, 8, 3).alias("hrv_rmssd"),
        "hrv_percentile",
        F.col("resting_heart_rate").cast("int").alias("resting_heart_rate"),
        "rhr_percentile",
        *[
            decimal(c, 5, 2).alias(c)
            for c in (
                "sleep_performance_percentage",
                "sleep_consistency_percentage",
                "sleep_efficiency_percentage",
            )
        ],
        decimal("skin_temp_celsius", 4, 2).alias("skin_temp_celsius"),
        decimal("skin_temp_deviation", 4, 2).alias("skin_temp_deviation"),
        decimal("respiratory_rate", 4, 2).alias("respiratory_rate"),
        F.col("created_at").alias("created_timestamp"),
        F.col("updated_at").alias("source_updated_at"),
        F.col("user_id").alias("source_user_id"),
        F.col("cycle_id").alias("source_cycle_id"),
    )


def workout_totals() -> list[Column]:
    """Totals of a group of workouts."""
    return [
        F.sum("strain").alias("total_workout_strain"),
        F.count("*").alias("workout_count"),
        F.sum(minutes_between("start_time", "end_time")).alias("total_workout_minutes"),
        *[F.sum(f"zone_{name}_milli").alias(f"zone_{i}_minutes") for i, name in enumerate(ZONES)],
        F.max("strain").alias("max_workout_strain"),
        F.sort_array(F.collect_set("sport_name")).alias("workout_types"),
    ]


def daily_workouts(stg_workout: DataFrame) -> DataFrame:
    """Workout totals per user and day; all parts combine in the map tasks."""
    return (
        stg_workout.filter(F.col("created_at").isNotNull())
        .groupBy("user_id", F.to_date("created_at").alias("workout_date"))
        .agg(*workout_totals())
    )


def fact_daily_strain(
    stg_cycle: DataFrame,
    stg_workout: DataFrame,
    dim_user: DataFrame,
    dim_date: DataFrame,
    run_at: Column | None = None,
    optimal_strain: DataFrame | None = None,
    since: dt.datetime | None = None,
    late_workouts: bool = False,
) -> DataFrame:
    """Strain fact, one row per user and day.

    ``calories_burned`` holds kilojoules. ``optimal_strain`` (``user_id``, ``day``,
    ``optimal_strain_min``, ``optimal_strain_max``, one row per user and day)
    fills the two limits, which are null without it. ``since`` takes only cycles
    updated after it, and with ``late_workouts`` also the days of workouts
    updated after it; workouts of other days are not added up.
    """
    cycles = stg_cycle.withColumn("cycle_date", F.to_date("created_at"))
    if since is not None:
        fresh = after_watermark(cycles, "updated_at", since)
        touched = fresh.select("user_id", "cycle_date")
        if late_workouts:
            late = after_watermark(stg_workout, "updated_at", since)
            touched = touched.unionByName(
                late.select("user_id", F.to_date("created_at").alias("cycle_date"))
            )
            fresh = cycles.join(touched.distinct(), ["user_id", "cycle_date"], "left_semi")
        cycles = fresh
        stg_workout = stg_workout.withColumn("cycle_date", F.to_date("created_at")).join(
            touched.distinct(), ["user_id", "cycle_date"], "left_semi"
        )
    daily = latest_per_key(
        cycles.drop("start_time", "end_time", "timezone_offset", "score_state", "ingested_at"),
        ["user_id", "cycle_date"],
        ["updated_at", "created_at", "id"],
        order_is_total=True,  # staged cycles are unique by id
    )
    workouts = daily_workouts(stg_workout).withColumnRenamed("workout_date", "cycle_date")
    joined = daily.join(workouts, ["user_id", "cycle_date"], "left")
    limits = ("optimal_strain_min", "optimal_strain_max")
    if optimal_strain is not None:
        known = optimal_strain.withColumnRenamed("day", "cycle_date")
        joined = joined.join(known, ["user_id", "cycle_date"], "left")
    else:
        joined = joined.withColumns({c: F.lit(None) for c in limits})
    keyed = _with_keys(joined, "cycle_date", dim_user, dim_date)
    return keyed.select(
        surrogate_key("user_sk", "date_sk").alias("strain_sk"),
        "user_sk",
        "date_sk",
        F.col("strain").alias("day_strain"),
        F.coalesce("total_workout_strain", F.lit(0)).alias("workout_strain"),
        *[F.col(c).cast("double").alias(c) for c in limits],
        F.col("kilojoule").alias("calories_burned"),
        "average_heart_rate",
        "max_heart_rate",
        *[f"zone_{i}_minutes" for i in range(len(ZONES))],
        F.coalesce("workout_count", F.lit(0)).alias("workout_count"),
        "total_workout_minutes",
        "max_workout_strain",
        "workout_types",
        (F.current_timestamp() if run_at is None else run_at)
        .cast("timestamp_ntz")
        .alias("created_timestamp"),
        F.col("created_at").alias("source_created_at"),
        F.col("updated_at").alias("source_updated_at"),
        "cycle_date",
    )
