"""Sensor records derived from the driver's tables.

Every raw record comes from one lineitem row: supplier = user, ship date (moved
into the calendar) = day, (order, line) = record id, which repeats, so there is
something to deduplicate. The expressions are portable SQL; the oracle uses the
same text, so both engines start from the same records.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators.dedup import latest_per_key
from pulseframe.plans import dims, facts, pipeline, staging
from pulseframe.sources.specs import SOURCES

_ID = "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))"
_CREATED = "l_shipdate + INTERVAL 9131 DAY + INTERVAL 1 MINUTE * (l_orderkey % 1440)"
_UPDATED = f"{_CREATED} + INTERVAL 1 MINUTE * l_partkey"
_INGESTED = f"{_UPDATED} + INTERVAL 1 SECOND * l_suppkey"
_USER = "cast(l_suppkey as string)"
_WHOLE = "cast(l_quantity as bigint)"
_STATE = "case l_returnflag when 'A' then 'SCORED' when 'N' then 'PENDING' else 'UNSCORABLE' end"

_AUDIT = {"created_at": _CREATED, "updated_at": _UPDATED}

RAW = {
    "cycle": {
        "id": _ID,
        "user_id": _USER,
        **_AUDIT,
        "start_time": f"{_CREATED} - INTERVAL 4 HOUR",
        "end_time": f"{_CREATED} + INTERVAL 20 HOUR",
        "timezone_offset": "'+00:00'",
        "score_state": _STATE,
        "strain": "21 * l_quantity / 50",
        "kilojoule": "l_extendedprice / 10",
        "average_heart_rate": "case when l_linenumber = 7 then null "
        "else cast(40 + floor(l_extendedprice / 1000) as bigint) end",
        "max_heart_rate": "cast(60 + floor(l_extendedprice / 700) as bigint)",
        "ingested_at": _INGESTED,
    },
    "recovery": {
        "cycle_id": _ID,
        "sleep_id": f"concat('s', {_ID})",
        "user_id": _USER,
        **_AUDIT,
        "score_state": _STATE,
        "user_calibrating": "l_linestatus = 'O'",
        "recovery_score": "case when l_returnflag = 'A' and l_linenumber = 2 then null "
        "else 40 + l_quantity + 5 * l_discount end",
        "resting_heart_rate": "40 + floor(l_extendedprice / 5000)",
        "hrv_rmssd_milli": "20 + l_extendedprice / 1000",
        "spo2_percentage": "90 + 100 * l_tax",
        "skin_temp_celsius": "case when l_returnflag = 'R' and l_linenumber = 1 then null "
        "else 33 + 10 * l_discount end",
        "ingested_at": _INGESTED,
    },
    "sleep": {
        "id": f"concat('s', {_ID})",
        "v1_id": _ID,
        "user_id": _USER,
        **_AUDIT,
        "start_time": f"{_CREATED} - INTERVAL 8 HOUR",
        "end_time": _CREATED,
        "timezone_offset": "'+02:00'",
        "nap": "l_linenumber % 3 = 0",
        "score_state": _STATE,
        "total_in_bed_time_milli": f"{_WHOLE} * 600000 + l_suppkey",
        "total_awake_time_milli": f"{_WHOLE} * 7000 + l_suppkey",
        "total_no_data_time_milli": f"{_WHOLE} * 1000",
        "total_light_sleep_time_milli": f"{_WHOLE} * 300000 + l_partkey",
        "total_slow_wave_sleep_time_milli": f"{_WHOLE} * 100000 + l_partkey",
        "total_rem_sleep_time_milli": f"{_WHOLE} * 90000",
        "sleep_cycle_count": "cast(l_linenumber as bigint)",
        "disturbance_count": f"{_WHOLE} % 13",
        "baseline_milli": "27000000 + l_suppkey",
        "need_from_sleep_debt_milli": f"{_WHOLE} * 50000",
        "need_from_recent_strain_milli": f"{_WHOLE} * 30000",
        "need_from_recent_nap_milli": f"-1 * {_WHOLE} * 20000",
        "respiratory_rate": "case when l_linenumber = 5 then null else 12 + 100 * l_tax end",
        "sleep_performance_percentage": "50 + l_quantity",
        "sleep_consistency_percentage": "60 + 100 * l_discount",
        "sleep_efficiency_percentage": "100 - l_quantity / 2",
        "ingested_at": _INGESTED,
    },
    "workout": {
        "id": f"concat('w', {_ID})",
        "v1_id": _ID,
        "user_id": _USER,
        **_AUDIT,
        "start_time": _CREATED,
        "end_time": f"{_CREATED} + INTERVAL 1 MINUTE * {_WHOLE} + INTERVAL 1 SECOND * l_linenumber",
        "timezone_offset": "'+00:00'",
        "sport_name": "case when l_linenumber = 4 then null "
        "else concat(l_returnflag, l_linestatus) end",
        "score_state": _STATE,
        "sport_id": "cast(l_linenumber as bigint)",
        "strain": "21 * l_quantity / 50",
        "average_heart_rate": "cast(90 + floor(l_extendedprice / 2000) as bigint)",
        "max_heart_rate": "cast(120 + floor(l_extendedprice / 1500) as bigint)",
        "kilojoule": "l_extendedprice / 100",
        "percent_recorded": "100 - l_linenumber / 2.0e0",
        "distance_meter": "l_extendedprice",
        "altitude_gain_meter": "l_quantity * 1.5e0",
        "altitude_change_meter": "l_quantity - 25",
        "zone_zero_milli": f"{_WHOLE} * 30000 + l_suppkey",
        "zone_one_milli": f"{_WHOLE} * 20000 + l_suppkey",
        "zone_two_milli": f"{_WHOLE} * 10000",
        "zone_three_milli": f"{_WHOLE} * 5000",
        "zone_four_milli": f"{_WHOLE} * 2000 + l_partkey",
        "zone_five_milli": f"{_WHOLE} * 1000",
        "ingested_at": _INGESTED,
    },
    "user": {
        "user_id": "cast(s_suppkey as string)",
        "email": "concat(lower(s_name), '@example.org')",
        "first_name": "s_name",
        "last_name": "concat('Nation ', cast(s_nationkey as string))",
        "created_at": "cast('2020-01-01' as date) + INTERVAL 1 HOUR * s_nationkey",
        "updated_at": "cast('2021-01-01' as date) + INTERVAL 1 HOUR * s_nationkey",
        "ingested_at": "cast('2021-01-01' as date) + INTERVAL 1 DAY * s_nationkey",
    },
}
RAW_TABLE = {name: "supplier" if name == "user" else "lineitem" for name in RAW}

# A daily series straight from lineitem, for the operator-level queries.
DAY_EXPR = "cast(l_shipdate as date) + 9131"
DAILY = {
    "user_sk": _USER,
    "day": DAY_EXPR,
    "recovery_score": "40 + l_quantity",
    "resting_heart_rate": "40 + floor(l_extendedprice / 5000)",
    "hrv_rmssd_milli": "20 + floor(l_extendedprice / 1000)",
    "respiratory_rate": "case when l_linenumber = 5 then null else 12 + 100 * l_tax end",
    "skin_temp_celsius": "case when l_returnflag = 'R' and l_linenumber = 1 then null "
    "else 33 + 10 * l_discount end",
    "day_strain": "21 * l_quantity / 50",
    "sport_name": "concat(l_returnflag, l_linestatus)",
    "l_partkey": "l_partkey",
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
}
DAILY_ORDER = ["l_partkey", "l_orderkey", "l_linenumber"]

# Added to user ids where users without records, and the reverse, are wanted.
MOVED_USERS = 10
# Optimal strain limits, an optional input of the strain fact.
OPTIMAL_MIN, OPTIMAL_MAX = 6.0, 14.0
AS_OF = "2026-11-04"
AS_OF_DAY = dt.date.fromisoformat(AS_OF)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def raw(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Raw rows of a source."""
    types = {f.name: f.dataType.simpleString() for f in SOURCES[source].raw_schema.fields}
    exprs = [f"cast({e} as {types[name]}) as {name}" for name, e in RAW[source].items()]
    return read(spark, sf_dir, RAW_TABLE[source]).selectExpr(*exprs)


def staged(spark: SparkSession, sf_dir: str, source: str, whole: bool = False) -> DataFrame:
    return staging.stage(raw(spark, sf_dir, source), source, whole=whole)


def users(spark: SparkSession, sf_dir: str, moved: int = 0) -> DataFrame:
    """User dimension; ``moved`` is added to the ids, so some records have no user, some users no record."""
    profiles = raw(spark, sf_dir, "user")
    if moved:
        profiles = profiles.withColumn("user_id", (F.col("user_id").cast("int") + moved).cast("string"))
    return dims.dim_user(staging.stage_user(profiles))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lineitem rows as (not yet deduplicated) daily observations."""
    exprs = [f"{e} as {name}" for name, e in DAILY.items()]
    return read(spark, sf_dir, "lineitem").selectExpr(*exprs)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per user and day."""
    newest = latest_per_key(lines(spark, sf_dir), ["user_sk", "day"], DAILY_ORDER)
    return newest.withColumn("date_sk", dims.date_key("day"))


def next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series moved one day on: next to the series itself, days without a match occur."""
    moved = daily(spark, sf_dir).withColumn("day", F.date_add("day", 1))
    return moved.withColumn("date_sk", dims.date_key("day"))


def percentiles(
    spark: SparkSession, sf_dir: str, keep: Sequence[str] = (), unique: Sequence[str] | None = None
) -> DataFrame:
    return facts.recovery_percentiles(
        staged(spark, sf_dir, "recovery"), users(spark, sf_dir), dims.dim_date(spark), keep=keep, unique=unique
    )


def fact_recovery(
    spark: SparkSession, sf_dir: str, md5_key: bool = False, scores_only: bool = False
) -> DataFrame:
    """The recovery fact; ``scores_only`` says that of the measures only the recovery score is read.

    Then the rows that are reduced to the fact and those that are ranked are the staged scores beside the
    temperature, by which the latter are chosen, and both are read from one shuffle of these.
    """
    ranked, recorded = ((), ("skin_temp_celsius",)) if scores_only else (None, None)
    return facts.fact_daily_recovery(
        staged(spark, sf_dir, "recovery"),
        users(spark, sf_dir),
        dims.dim_date(spark),
        percentiles(spark, sf_dir, facts.RECORD_KEYS, ranked),
        staged(spark, sf_dir, "sleep"),
        md5_key,
        recorded,
    )


def optimal_strain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits for every user and day with a cycle."""
    days = raw(spark, sf_dir, "cycle").select("user_id", F.to_date("created_at").alias("day"))
    return days.distinct().withColumns(
        {
            "optimal_strain_min": F.lit(OPTIMAL_MIN),
            "optimal_strain_max": F.lit(OPTIMAL_MAX),
        }
    )


def fact_strain(spark: SparkSession, sf_dir: str, with_limits: bool = False) -> DataFrame:
    return facts.fact_daily_strain(
        staged(spark, sf_dir, "cycle"),
        staged(spark, sf_dir, "workout"),
        users(spark, sf_dir),
        dims.dim_date(spark),
        run_at=F.lit(AS_OF),
        optimal_strain=optimal_strain(spark, sf_dir) if with_limits else None,
    )


# Metrics that read no other measure of the recovery fact than its score.
SCORE_METRICS = ("strain_recovery_efficiency", "training_readiness_gap")


def metric(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A metric from raw records, with the optimal strain limits filled."""
    build, needs = pipeline.METRICS[name]
    frames = {
        pipeline.RECOVERY: lambda: fact_recovery(spark, sf_dir, scores_only=name in SCORE_METRICS),
        pipeline.STRAIN: lambda: fact_strain(spark, sf_dir, with_limits=True),
        pipeline.DAYS: lambda: dims.dim_date(spark),
    }
    return build(*[frames[n]() for n in needs])
