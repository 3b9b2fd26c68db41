"""Queries: projections, filters, joins, aggregations, windows, scalar functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.catalog import inputs
from pulseframe.catalog.registry import Registry
from pulseframe.functions import calendar, compat, labels
from pulseframe.operators import dedup, incremental, series
from pulseframe.plans import dims, facts, metrics, reports, staging
from pulseframe.sources.specs import SOURCES

query = Registry()
KEYS = ("user_sk", "date_sk")
AUDIT_TIME = "2026-11-05 06:00:00"


def lineitem(spark: SparkSession, sf_dir: str, *exprs: str) -> DataFrame:
    return inputs.read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *exprs
    )


LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# Projections, filters, predicates


@query("proj_cast_spec")
def _(spark, sf_dir):
    spec = staging.staging_spec(SOURCES["sleep"])
    return staging.project(inputs.raw(spark, sf_dir, "sleep"), spec.casts, spec.overrides)


@query("proj_round_cast")
def _(spark, sf_dir):
    return lineitem(spark, sf_dir, "l_quantity / 4 as q", "-l_quantity / 4 as m").select(
        *LINE_KEYS,
        compat.round_to_long("q").alias("rounded"),
        compat.round_to_long("m").alias("rounded_negative"),
    )


@query("proj_ms_to_hours")
def _(spark, sf_dir):
    return inputs.raw(spark, sf_dir, "sleep").select(
        "id",
        "ingested_at",
        compat.ms_to_hours("total_light_sleep_time_milli").alias("light_hours"),
        compat.ms_to_hours("need_from_recent_nap_milli").alias("nap_hours"),
    )


@query("proj_ms_to_minutes")
def _(spark, sf_dir):
    return inputs.raw(spark, sf_dir, "workout").select(
        "id",
        "ingested_at",
        compat.ms_to_minutes("zone_zero_milli").alias("zone_0_minutes"),
        compat.ms_to_minutes("zone_four_milli").alias("zone_4_minutes"),
    )


@query("proj_rename")
def _(spark, sf_dir):
    return inputs.raw(spark, sf_dir, "cycle").select(
        "id",
        "ingested_at",
        F.col("start_time").alias("start"),
        F.col("end_time").alias("end"),
        F.col("kilojoule").alias("calories_burned"),
    )


@query("proj_exclude")
def _(spark, sf_dir):
    return inputs.read(spark, sf_dir, "lineitem").drop("l_tax", "l_shipdate")


@query("proj_decimal")
def _(spark, sf_dir):
    return lineitem(
        spark,
        sf_dir,
        "cast(l_quantity as decimal(5,2)) as score",
        "cast(cast(l_quantity as bigint) / 1000.0e0 as decimal(8,3)) as seconds",
        "cast(33 + 10 * l_discount as decimal(4,2)) as temperature",
    )


@query("proj_null_const")
def _(spark, sf_dir):
    null = F.lit(None).cast("double")
    return lineitem(spark, sf_dir).select(
        *LINE_KEYS, null.alias("optimal_strain_min"), null.alias("optimal_strain_max")
    )


@query("proj_audit")
def _(spark, sf_dir):
    return metrics.with_calculated_at(lineitem(spark, sf_dir), F.lit(AUDIT_TIME))


@query("filter_not_null")
def _(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, "recovery")
    kept = rows.filter(
        F.col("recovery_score").isNotNull() & F.col("skin_temp_celsius").isNotNull()
    )
    return kept.select("cycle_id", "ingested_at", "recovery_score", "skin_temp_celsius")


def _as_of() -> Column:
    return F.lit(inputs.AS_OF).cast("date")


@query("filter_horizon")
def _(spark, sf_dir):
    rows = incremental.since_horizon(
        inputs.daily(spark, sf_dir), "day", _as_of(), facts.HORIZON_DAYS
    )
    return rows.select(*KEYS, "recovery_score")


@query("filter_date_range")
def _(spark, sf_dir):
    days = reports.DATE_RANGES["Last 90 Days"]
    rows = reports.last_days(inputs.daily(spark, sf_dir), _as_of(), days, "day")
    return rows.select(*KEYS, "day", "recovery_score")


@query("filter_upper_bound")
def _(spark, sf_dir):
    rows = inputs.daily(spark, sf_dir).filter(F.col("day") <= F.lit("2024-12-31").cast("date"))
    return rows.select(*KEYS, "recovery_score")


@query("pred_in")
def _(spark, sf_dir):
    rows = inputs.daily(spark, sf_dir)
    return rows.filter(F.month("day").isin(12, 1, 2)).select(*KEYS, "recovery_score")


@query("pred_between")
def _(spark, sf_dir):
    rows = inputs.daily(spark, sf_dir)
    return rows.filter(F.col("day_strain").between(6, 14)).select(*KEYS, "day_strain")


@query("pred_case_state")
def _(spark, sf_dir):
    rows = inputs.daily(spark, sf_dir).select(
        *KEYS,
        "recovery_score",
        series.rows_so_far(facts.HISTORY_ROWS).alias("days_of_history"),
    )
    enough = F.col("days_of_history") >= facts.HISTORY_MIN_ROWS
    return rows.select(*KEYS, F.when(enough, F.col("recovery_score")).alias("shown_score"))


# Joins


def _recovery_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.staged(spark, sf_dir, "recovery").withColumn("day", F.to_date("created_at"))


@query("join_inner_user")
def _(spark, sf_dir):
    recovery = inputs.staged(spark, sf_dir, "recovery").select(
        "cycle_id", "user_id", "recovery_score"
    )
    return recovery.join(inputs.users(spark, sf_dir).select("user_id", "user_sk"), "user_id")


@query("join_inner_date")
def _(spark, sf_dir):
    days = dims.dim_date(spark).select(F.col("date_day").alias("day"), "date_sk")
    return _recovery_days(spark, sf_dir).join(days, "day").select("cycle_id", "date_sk")


@query("join_left_composite")
def _(spark, sf_dir):
    left = inputs.daily(spark, sf_dir).select(*KEYS, "recovery_score")
    right = inputs.next_day(spark, sf_dir).select(*KEYS, "day_strain")
    return left.join(right, list(KEYS), "left")


@query("join_left_sleep_fanout")
def _(spark, sf_dir):
    """Recovery and the one sleep kept of each user and day before."""
    recovery = dedup.latest_per_key(
        _recovery_days(spark, sf_dir),
        ["user_id", "day"],
        ["updated_at", "created_at", "cycle_id"],
    ).select("user_id", "day", "cycle_id", "recovery_score")
    nights = inputs.staged(spark, sf_dir, "sleep").withColumn(
        "created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY")
    )
    return recovery.join(facts.daily_sleep(nights), ["user_id", "day"], "left")


@query("join_left_to_inner")
def _(spark, sf_dir):
    users = inputs.users(spark, sf_dir, moved=inputs.MOVED_USERS)
    rows = inputs.staged(spark, sf_dir, "cycle").select("id", "user_id", "strain")
    joined = rows.join(users.select("user_id", "user_sk"), "user_id", "left")
    return joined.filter(F.col("user_sk").isNotNull())


@query("join_left_preagg")
def _(spark, sf_dir):
    cycles = inputs.staged(spark, sf_dir, "cycle").select(
        "id", "user_id", F.to_date("created_at").alias("workout_date"), "strain"
    )
    moved = inputs.staged(spark, sf_dir, "workout").withColumn(
        "created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY")
    )
    workouts = facts.daily_workouts(moved).select(
        "user_id", "workout_date", "total_workout_strain", "workout_count"
    )
    return cycles.join(workouts, ["user_id", "workout_date"], "left")


def _strain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.daily(spark, sf_dir).select(*KEYS, "day_strain")


def _recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.next_day(spark, sf_dir).select(*KEYS, "recovery_score")


@query("join_strain_recovery")
def _(spark, sf_dir):
    pairs = series.beside(_strain(spark, sf_dir), _recovery(spark, sf_dir), ["recovery_score"])
    return pairs.drop("_matched")


@query("join_recovery_strain")
def _(spark, sf_dir):
    pairs = series.beside(_recovery(spark, sf_dir), _strain(spark, sf_dir), ["day_strain"])
    return pairs.drop("_matched")


@query("join_fact_date")
def _(spark, sf_dir):
    days = dims.dim_date(spark).select("date_sk", "season", "year_number")
    return inputs.daily(spark, sf_dir).select(*KEYS, "recovery_score").join(days, "date_sk")


def _daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series under the recovery fact's column names."""
    return inputs.daily(spark, sf_dir).withColumn("hrv_rmssd", F.col("hrv_rmssd_milli"))


@query("join_self_baseline")
def _(spark, sf_dir):
    dated = metrics.with_season(_daily_fact(spark, sf_dir), dims.dim_date(spark)).repartition(
        "user_sk"
    )
    usual = metrics.season_baselines(metrics.season_years(dated))
    return dated.join(usual, ["user_sk", "season"], "left").select(
        *KEYS, "season", "recovery_score", "seasonal_recovery_baseline"
    )


@query("join_metric_date")
def _(spark, sf_dir):
    momentum = metrics.recovery_momentum(_daily_fact(spark, sf_dir))
    return reports.report_rows("momentum", momentum, dims.dim_date(spark))


@query("join_anti_fk")
def _(spark, sf_dir):
    parents = inputs.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("o_custkey"))
    orders = inputs.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(parents, "o_custkey", "left_anti")


# Aggregations


@query("agg_workout_daily")
def _(spark, sf_dir):
    return facts.daily_workouts(inputs.staged(spark, sf_dir, "workout"))


@query("agg_distinct_array")
def _(spark, sf_dir):
    return (
        inputs.raw(spark, sf_dir, "workout")
        .groupBy("user_id", F.to_date("created_at").alias("day"))
        .agg(F.sort_array(F.collect_set("sport_name")).alias("sports"))
    )


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.with_season(_daily_fact(spark, sf_dir), dims.dim_date(spark))


@query("agg_season_year")
def _(spark, sf_dir):
    return metrics.season_years(_dated(spark, sf_dir))


@query("agg_two_level")
def _(spark, sf_dir):
    return metrics.season_baselines(metrics.season_years(_dated(spark, sf_dir)))


# Windows


@query("win_dedup_latest")
def _(spark, sf_dir):
    return dedup.latest_per_key(
        inputs.raw(spark, sf_dir, "cycle"), ["id"], staging.NEWEST_UPDATE
    )


@query("win_dedup_ingested")
def _(spark, sf_dir):
    return dedup.latest_per_key(
        inputs.raw(spark, sf_dir, "cycle"), ["id"], staging.NEWEST_INGEST
    )


@query("win_dedup_user_day")
def _(spark, sf_dir):
    return dedup.latest_per_key(
        _recovery_days(spark, sf_dir), ["user_id", "day"], ["updated_at", "created_at", "cycle_id"]
    )


@query("win_dedup_cycle_day")
def _(spark, sf_dir):
    cycles = inputs.staged(spark, sf_dir, "cycle").withColumn("day", F.to_date("created_at"))
    return dedup.latest_per_key(cycles, ["user_id", "day"], ["updated_at", "created_at", "id"])


@query("top1_per_key")
def _(spark, sf_dir):
    newest = dedup.latest_per_key(inputs.lines(spark, sf_dir), ["user_sk"], [
        "day", *inputs.DAILY_ORDER
    ])
    return newest.select("user_sk", "day", "recovery_score", "l_orderkey")


Columns = Callable[[], dict[str, Column]]


def _window_query(name: str, columns: Columns) -> None:
    """A query that adds window columns to the daily series."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        cols = [c.alias(alias) for alias, c in columns().items()]
        return inputs.daily(spark, sf_dir).select(*KEYS, *cols)

    query.add(name, build)


def _strain_deviation() -> Column:
    return labels.strain_distance(F.col("day_strain"), F.lit(6.0), F.lit(14.0))


_window_query(
    "win_avg_prev29",
    lambda: {"baseline": F.avg("skin_temp_celsius").over(series.previous_rows(29))},
)
_window_query(
    "win_count_prev29",
    lambda: {"n": F.count("skin_temp_celsius").over(series.previous_rows(29))},
)
_window_query(
    "win_percent_rank_asc",
    lambda: {
        "score_rank": series.rank_percentile("recovery_score"),
        "hrv_rank": series.rank_percentile("hrv_rmssd_milli"),
        "temp_rank": series.rank_percentile("skin_temp_celsius"),
    },
)
_window_query(
    "win_percent_rank_desc",
    lambda: {
        "rhr_rank": series.rank_percentile("resting_heart_rate", descending=True),
        "respiratory_rank": series.percent_rank("respiratory_rate", descending=True),
    },
)
_window_query("win_count_365", lambda: {"n": series.rows_so_far(365)})
_window_query("win_avg_7", lambda: {"mean": F.avg("recovery_score").over(series.last_rows(7))})
_window_query(
    "win_lag_1_3_7_14",
    lambda: {f"day_{k}_change": series.change("recovery_score", k) for k in (1, 3, 7, 14)},
)
_window_query(
    "win_stddev_7",
    lambda: {"spread": F.stddev_samp("recovery_score").over(series.last_rows(7))},
)
_window_query(
    "win_stddev_30",
    lambda: {"spread": F.stddev_samp("recovery_score").over(series.last_rows(30))},
)
_window_query("win_avg_30", lambda: {"mean": F.avg("recovery_score").over(series.last_rows(30))})
_window_query(
    "win_lead_next", lambda: {"following": F.lead("recovery_score").over(series.by_day())}
)
_window_query("win_count_30", lambda: {"n": F.count("*").over(series.last_rows(30))})
_window_query(
    "win_count_if_30",
    lambda: {
        "optimal": F.count(F.when(F.col("day_strain").between(6, 14), 1)).over(
            series.last_rows(30)
        ),
        "over": F.count(F.when(F.col("day_strain") > 14, 1)).over(series.last_rows(30)),
    },
)
_window_query(
    "win_avg_dev_30",
    lambda: {"mean_deviation": F.avg(_strain_deviation()).over(series.last_rows(30))},
)


@query("win_lag_of_window")
def _(spark, sf_dir):
    spread = F.stddev_samp("recovery_score").over(series.last_rows(7))
    rows = inputs.daily(spark, sf_dir).select(*KEYS, spread.alias("volatility_7d"))
    return rows.select(*KEYS, series.change("volatility_7d", 7).alias("trend"))


@query("win_avg_prev7_right")
def _(spark, sf_dir):
    """Mean over the earlier matched rows, none for unmatched rows."""
    pairs = series.beside(_strain(spark, sf_dir), _recovery(spark, sf_dir), ["recovery_score"])
    before = series.previous_rows(7, "user_sk", "date_sk", "_matched")
    return pairs.select(*KEYS, F.avg("recovery_score").over(before).alias("baseline"))


@query("win_avg_prev6")
def _(spark, sf_dir):
    pairs = series.beside(_recovery(spark, sf_dir), _strain(spark, sf_dir), ["day_strain"])
    before = series.previous_rows(6, "user_sk", "date_sk", "_matched")
    return pairs.select(*KEYS, F.avg("day_strain").over(before).alias("recent_strain"))


# Set operations


@query("set_distinct_states")
def _(spark, sf_dir):
    return inputs.raw(spark, sf_dir, "cycle").select("score_state").distinct()


# Scalar functions: one value column each over all lineitem rows or days


def _line_query(name: str, inputs_sql: list[str], columns: Columns) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = lineitem(spark, sf_dir, *inputs_sql)
        return rows.select(*LINE_KEYS, *[c.alias(alias) for alias, c in columns().items()])

    query.add(name, build)


DAY = f"{inputs.DAY_EXPR} as day"
CREATED = f"{inputs.RAW['cycle']['created_at']} as created"


def _value(expr: str) -> list[str]:
    """A column ``v`` that is null on the first line of every order."""
    return [f"case when l_linenumber = 1 then null else {expr} end as v"]


_line_query("fn_date_of_ts", [CREATED], lambda: {"day": F.to_date("created")})
_line_query(
    "fn_dateadd_day",
    [DAY],
    lambda: {"later": F.date_add("day", 30), "earlier": F.date_sub("day", 90)},
)
_line_query(
    "fn_datediff_minute",
    [
        f"{inputs.RAW['workout']['start_time']} + INTERVAL 59 SECOND as a",
        f"{inputs.RAW['workout']['end_time']} as b",
    ],
    lambda: {
        "minutes": compat.minutes_between("a", "b"),
        "minutes_back": compat.minutes_between("b", "a"),
    },
)
_line_query("fn_date_sk", [DAY], lambda: {"date_sk": dims.date_key("day")})
_line_query(
    "fn_calendar",
    [DAY],
    lambda: {
        "day_of_week": calendar.day_of_week(F.col("day")),
        "day_of_month": F.dayofmonth("day"),
        "day_of_year": F.dayofyear("day"),
        "week_of_year": F.weekofyear("day"),
        "month_of_year": F.month("day"),
        "quarter_of_year": F.quarter("day"),
        "year_number": F.year("day"),
    },
)
_line_query(
    "fn_day_month_name",
    [DAY],
    lambda: {"day_name": F.dayname("day"), "month_name": F.monthname("day")},
)
_line_query("fn_season", [DAY], lambda: {"season": calendar.season(F.col("day"))})
_line_query(
    "fn_now", [DAY], lambda: {"as_of": _as_of(), "age": F.datediff(_as_of(), F.col("day"))}
)
_line_query(
    "fn_md5_key",
    ["nullif(l_returnflag, 'A') as part"],
    lambda: {
        "one_key": compat.surrogate_key("l_suppkey"),
        "two_key": compat.surrogate_key("l_orderkey", "part"),
    },
)
_line_query(
    "fn_concat_replace",
    [DAY],
    lambda: {
        "joined": F.concat("l_orderkey", F.lit("|"), "l_suppkey"),
        "digits": F.replace(F.col("day").cast("string"), F.lit("-"), F.lit("")),
    },
)
_line_query(
    "fn_round",
    ["l_quantity / 4 as q", "l_extendedprice / 1000 as p"],
    lambda: {"whole": F.round("q"), "two": F.round("p", 2)},
)
_line_query(
    "fn_coalesce",
    ["nullif(l_quantity, 25) as q"],
    lambda: {"zero": F.coalesce("q", F.lit(0.0)), "fifty": F.coalesce("q", F.lit(50.0))},
)
_line_query(
    "fn_nullif_div",
    ["l_quantity as q", "l_quantity - 25 as z"],
    lambda: {"ratio": compat.safe_divide("q", "z")},
)
_line_query(
    "fn_clamp", _value("l_quantity * 10 - 250"), lambda: {"v2": compat.clamp("v", -100.0, 100.0)}
)
_line_query(
    "fn_weighted",
    ["l_quantity as a", "l_discount * 100 as b", "l_tax * 100 as c"],
    lambda: {
        "score": compat.weighted_sum([(F.col("a"), 0.45), (F.col("b"), 0.35), (F.col("c"), 0.2)])
    },
)
_line_query(
    "fn_abs_fillna",
    _value("l_quantity - 25"),
    lambda: {"size": labels.bubble_size(F.col("v"))},
)
_line_query(
    "fn_sign_bucket",
    _value("l_quantity - 25"),
    lambda: {"gap": labels.gap_color(F.col("v")), "sign": labels.sign_color(F.col("v"))},
)
_line_query(
    "client_lambda", _value("l_quantity - 25"), lambda: {"color": labels.gap_color(F.col("v"))}
)


def _label_query(name: str, expr: str, label: Callable[[Column], Column]) -> None:
    _line_query(name, _value(expr), lambda: {"label": label(F.col("v"))})


_label_query("fn_bucket_momentum", "(l_quantity - 25) / 10", labels.momentum)
_label_query("fn_bucket_volatility", "l_quantity / 2", labels.volatility)
_label_query("fn_bucket_balance", "l_quantity * 2", labels.balance)
_label_query("fn_bucket_efficiency", "(l_quantity - 25) / 20", labels.efficiency)
_label_query("fn_bucket_season", "l_quantity - 25", labels.adaptation)
_label_query("fn_bucket_sustain", "l_quantity / 50", labels.sustainability)
_label_query("fn_bucket_gap", "l_quantity - 25", labels.readiness_gap)
_label_query("fn_step_score", "l_quantity / 3", labels.training_step)
_line_query(
    "fn_bucket_strain",
    [
        "21 * l_quantity / 50 as strain",
        "case when l_linenumber = 1 then null else 6.0e0 end as low",
        "case when l_linenumber <= 2 then null else 14.0e0 end as high",
    ],
    lambda: {
        "zone": labels.strain_zone(F.col("strain"), F.col("low"), F.col("high")),
        "deviation": labels.strain_distance(F.col("strain"), F.col("low"), F.col("high")),
    },
)
_line_query(
    "fn_risk_flag",
    [
        "case when l_linenumber = 1 then null else l_quantity - 60 end as gap",
        "210 * l_discount as recent",
    ],
    lambda: {"risk": labels.overtraining_risk(F.col("gap"), F.col("recent"))},
)


@query("fn_md5_recovery_key")
def _(spark, sf_dir):
    """The recovery fact under keys that do not collide."""
    fact = inputs.fact_recovery(spark, sf_dir, md5_key=True)
    return fact.select("recovery_sk", "user_sk", "date_sk", "source_cycle_id")


@query("fn_hash64_key")
def _(spark, sf_dir):
    """Keys of distinct inputs have to be distinct."""
    keyed = inputs.staged(spark, sf_dir, "recovery").select(
        "cycle_id", "user_id", compat.hash64_key("cycle_id", "user_id").alias("k")
    )
    return keyed.agg(
        F.count_distinct("cycle_id", "user_id").alias("inputs"),
        F.count_distinct("k").alias("keys"),
    )
