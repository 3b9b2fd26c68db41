"""SQL with the same results as the registered queries, for an independent engine.

Statements are written against the driver's tables. Shared subqueries are named
once below; a statement gets a WITH clause of those it mentions.
"""

from __future__ import annotations

import re

from pulseframe.catalog import inputs, model_queries, operator_queries, source_queries
from pulseframe.plans import checks, pipeline, staging
from pulseframe.sources.specs import SOURCES

KEYS = "user_sk date_sk"


def out(columns: str) -> str:
    """Select list in portable form. Suffixes: ``:r`` fraction, ``:t`` date or time
    text, ``:a`` list, ``:i`` whole number."""
    forms = {
        "r": "round(cast({0} as double), 6) as {0}",
        "t": "cast({0} as varchar) as {0}",
        "a": "array_to_string({0}, ',') as {0}",
        "i": "cast({0} as bigint) as {0}",
    }
    parts = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        parts.append(forms[kind].format(name) if kind else name)
    return ", ".join(parts)


def latest(source: str, keys: str, order: str) -> str:
    """First row of each key."""
    return (
        f"select * exclude (rn_) from (select *, row_number() over "
        f"(partition by {keys} order by {order}) as rn_ from {source}) where rn_ = 1"
    )


def desc(*columns: str) -> str:
    return ", ".join(f"{c} desc nulls first" for c in columns)


NEWEST = desc("updated_at", "created_at", "ingested_at")


def whole(x: str) -> str:
    return f"cast(round({x}) as bigint)"


def units(x: str, over_18: int) -> str:
    """Milliseconds to a unit, rounded half away from zero at six decimals, with
    whole-number arithmetic only: x * 10^6 / unit = x * over_18 / 18."""
    return f"(sign({x}) * ((2 * abs({x}) * {over_18} + 18) // 36) / 1e6)"


def _kinds(source: str, staged: bool) -> str:
    """Portable column list of a raw or staging table."""
    items = []
    for name, _, type in SOURCES[source].fields:
        if type == "timestamp":
            items.append(f"{name}:t")
        elif staged and (name in staging.HOURS or name in staging.MINUTES):
            items.append(f"{name}:r")
        elif type == "double":
            items.append(f"{name}:i" if staged else f"{name}:r")
        else:
            items.append(name)
    return " ".join(items)


def _staged(source: str) -> str:
    """Typed projection of a raw table."""
    parts = []
    for name, _, type in SOURCES[source].fields:
        if name in staging.HOURS:
            parts.append(f"{units(name, 5)} as {name}")
        elif name in staging.MINUTES:
            parts.append(f"{units(name, 300)} as {name}")
        elif type == "double":
            parts.append(f"{whole(name)} as {name}")
        elif name == "sport_id":
            parts.append("cast(sport_id as varchar) as sport_id")
        else:
            parts.append(name)
    return ", ".join(parts)


def _exprs(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} as {name}" for name, e in exprs.items())


WINDOW = "partition by user_sk order by date_sk"
ROWS_7 = f"{WINDOW} rows between 6 preceding and current row"
ROWS_30 = f"{WINDOW} rows between 29 preceding and current row"
PREV_29 = f"{WINDOW} rows between 29 preceding and 1 preceding"
SEASON = (
    "case when month({0}) in (12, 1, 2) then 'Winter' when month({0}) in (3, 4, 5) then 'Spring' "
    "when month({0}) in (6, 7, 8) then 'Summer' else 'Fall' end"
)
DATE_SK = "cast(strftime({0}, '%Y%m%d') as integer)"
AS_OF = f"date '{inputs.AS_OF}'"


WORKOUT_TOTALS = (
    "user_id workout_date:t total_workout_strain workout_count total_workout_minutes "
    "zone_0_minutes:r zone_1_minutes:r zone_2_minutes:r zone_3_minutes:r zone_4_minutes:r "
    "zone_5_minutes:r max_workout_strain workout_types:a"
)


def label(value: str, test: str, table, otherwise) -> str:
    """CASE over a table of limits; the value is rounded before it is tested."""
    whens = " ".join(f"when round({value}, 6) {test} {limit} then '{name}'" for limit, name in table)
    return f"case {whens} else '{otherwise}' end"


MOMENTUM = (
    (2, "Accelerating"),
    (0.5, "Improving"),
    (-0.5, "Stable"),
    (-2, "Declining"),
)
VOLATILITY = ((5, "Very Stable"), (10, "Stable"), (15, "Moderate"), (20, "Volatile"))
BALANCE = (
    (80, "Excellent Balance"),
    (60, "Good Balance"),
    (40, "Moderate Balance"),
    (20, "Poor Balance"),
)
EFFICIENCY = ((1, "Highly Efficient"), (0.5, "Efficient"), (0, "Moderate"), (-0.5, "Poor"))
ADAPTATION = (
    (10, "Thriving"),
    (5, "Well Adapted"),
    (-5, "Normal Adaptation"),
    (-10, "Struggling"),
)
SUSTAIN = (
    (0.7, "Highly Sustainable"),
    (0.5, "Sustainable"),
    (0.3, "Moderately Sustainable"),
)


def gap_label(v: str) -> str:
    return (
        f"case when {v} > 20 then 'Body Ready, Training Light' "
        f"when {v} > 10 then 'Slight Over-recovery' "
        f"when {v} between -10 and 10 then 'Well Aligned' "
        f"when {v} < -20 then 'Body Tired, Training High' else 'Slight Under-recovery' end"
    )


def step_score(v: str) -> str:
    return (
        f"case when round({v}, 6) > 15 then 90 when round({v}, 6) > 12 then 70 "
        f"when round({v}, 6) > 9 then 50 when round({v}, 6) > 6 then 30 else 10 end"
    )


def _named() -> dict[str, str]:
    """Shared subqueries, each using only earlier ones."""
    named = {
        f"raw_{name}": f"select {_exprs(exprs)} from {inputs.RAW_TABLE[name]}"
        for name, exprs in inputs.RAW.items()
    }
    for name in pipeline.STAGED:
        typed = f"(select {_staged(name)} from raw_{name})"
        named[f"stg_{name}"] = latest(typed, SOURCES[name].key, NEWEST)
    named["dim_user"] = (
        "select md5(user_id) as user_sk, user_id, email, first_name, last_name, "
        "created_at, updated_at from raw_user"
    )
    named["dim_date"] = (
        f"select {DATE_SK.format('d')} as date_sk, d as date_day, dayofweek(d) as day_of_week, "
        "strftime(d, '%a') as day_of_week_name, day(d) as day_of_month, "
        "dayofyear(d) as day_of_year, weekofyear(d) as week_of_year, month(d) as month_of_year, "
        "strftime(d, '%b') as month_name, quarter(d) as quarter_of_year, year(d) as year_number, "
        f"{SEASON.format('d')} as season from (select cast(unnest(generate_series("
        "date '2020-01-01', date '2030-12-31', interval 1 day)) as date) as d)"
    )
    named["lines"] = f"select {_exprs(inputs.DAILY)} from lineitem"
    order = ", ".join(f"{c} desc" for c in inputs.DAILY_ORDER)
    named["daily"] = (
        f"select *, {DATE_SK.format('day')} as date_sk, hrv_rmssd_milli as hrv_rmssd "
        f"from ({latest('lines', 'user_sk, day', order)})"
    )
    named["next_day"] = f"select * replace ({DATE_SK.format('day + 1')} as date_sk) from daily"
    named["day_recovery"] = latest(
        "(select *, cast(created_at as date) as day from stg_recovery "
        "where recovery_score is not null)",
        "user_id, day",
        desc("updated_at", "created_at", "cycle_id"),
    )
    named["measured"] = (
        "select u.user_sk, d.date_sk, r.* from ("
        + latest(
            "(select *, cast(created_at as date) as day from stg_recovery "
            "where recovery_score is not null and skin_temp_celsius is not null)",
            "user_id, day",
            desc("updated_at", "created_at", "cycle_id"),
        )
        + ") r join dim_user u on u.user_id = r.user_id join dim_date d on d.date_day = r.day"
    )

    def rank(c: str, order: str) -> str:
        return (
            "cast(round(percent_rank() over (partition by user_sk order by "
            f"{c} {order}) * 100) as integer)"
        )

    named["ranked"] = (
        "select user_sk, date_sk, skin_temp_celsius, "
        f"avg(skin_temp_celsius) over ({PREV_29}) as baseline, "
        f"count(skin_temp_celsius) over ({PREV_29}) as baseline_rows, "
        f"{rank('recovery_score', 'asc nulls last')} as p_score, "
        f"{rank('hrv_rmssd_milli', 'asc nulls last')} as p_hrv, "
        f"{rank('resting_heart_rate', 'desc nulls first')} as p_rhr, "
        f"count(*) over ({WINDOW} rows between 364 preceding and current row) as days_of_history "
        "from measured"
    )
    named["percentiles"] = (
        "select user_sk, date_sk, "
        "case when days_of_history >= 60 then p_score end as recovery_score_percentile, "
        "case when days_of_history >= 60 then p_hrv end as hrv_percentile, "
        "case when days_of_history >= 60 then p_rhr end as rhr_percentile, skin_temp_celsius, "
        "case when baseline_rows >= 14 then round(skin_temp_celsius - baseline, 2) end "
        "as skin_temp_deviation, days_of_history from ranked"
    )
    named["day_sleep"] = latest(
        "(select *, cast(created_at as date) as day from stg_sleep)",
        "user_id, day",
        "nap asc nulls last, updated_at desc nulls first, id desc nulls first",
    )
    named["fact_recovery"] = (
        "select u.user_sk, d.date_sk, cast(r.recovery_score as double) as recovery_score, "
        "p.recovery_score_percentile, round(r.hrv_rmssd_milli / 1000e0, 3) as hrv_rmssd, "
        "p.hrv_percentile, cast(r.resting_heart_rate as integer) as resting_heart_rate, "
        "p.rhr_percentile, s.sleep_performance_percentage, s.sleep_consistency_percentage, "
        "s.sleep_efficiency_percentage, cast(r.skin_temp_celsius as double) as skin_temp_celsius, "
        "p.skin_temp_deviation, cast(s.respiratory_rate as double) as respiratory_rate, "
        "r.created_at as created_timestamp, r.updated_at as source_updated_at, "
        "r.user_id as source_user_id, r.cycle_id as source_cycle_id from day_recovery r "
        "join dim_user u on u.user_id = r.user_id join dim_date d on d.date_day = r.day "
        "left join percentiles p on p.user_sk = u.user_sk and p.date_sk = d.date_sk "
        "left join day_sleep s on s.user_id = r.user_id and s.day = r.day"
    )
    zones = ", ".join(
        f"sum(zone_{name}_milli) as zone_{i}_minutes"
        for i, name in enumerate(("zero", "one", "two", "three", "four", "five"))
    )
    totals = (
        "cast(sum(strain) as bigint) as total_workout_strain, count(*) as workout_count, "
        "cast(sum(datediff('minute', start_time, end_time)) as bigint) as total_workout_minutes, "
        f"{zones}, max(strain) as max_workout_strain, "
        "coalesce(list_sort(list(distinct sport_name) filter (where sport_name is not null)), []) "
        "as workout_types"
    )
    named["workout_days"] = (
        f"select user_id, cast(created_at as date) as workout_date, {totals} "
        "from stg_workout group by 1, 2"
    )
    # All records, with their repeats.
    named["workout_record_days"] = (
        f"select user_id, cast(created_at as date) as day, {totals} "
        f"from (select {_staged('workout')} from raw_workout) group by 1, 2"
    )
    named["day_cycle"] = latest(
        "(select *, cast(created_at as date) as cycle_date from stg_cycle)",
        "user_id, cycle_date",
        desc("updated_at", "created_at", "id"),
    )
    named["fact_strain_plain"] = (
        "select md5(concat(u.user_sk, '-', d.date_sk)) as strain_sk, u.user_sk, d.date_sk, "
        "c.strain as day_strain, coalesce(w.total_workout_strain, 0) as workout_strain, "
        "cast(null as double) as optimal_strain_min, cast(null as double) as optimal_strain_max, "
        "c.kilojoule as calories_burned, c.average_heart_rate, c.max_heart_rate, "
        + ", ".join(f"w.zone_{i}_minutes" for i in range(6))
        + ", coalesce(w.workout_count, 0) as workout_count, w.total_workout_minutes, "
        "w.max_workout_strain, w.workout_types, c.created_at as source_created_at, "
        "c.updated_at as source_updated_at, c.cycle_date from day_cycle c "
        "left join workout_days w on w.user_id = c.user_id and w.workout_date = c.cycle_date "
        "join dim_user u on u.user_id = c.user_id join dim_date d on d.date_day = c.cycle_date"
    )
    named["fact_strain"] = (
        f"select * replace ({inputs.OPTIMAL_MIN} as optimal_strain_min, "
        f"{inputs.OPTIMAL_MAX} as optimal_strain_max) from fact_strain_plain"
    )
    named.update(_metrics())
    return named


def momentum_of(source: str) -> str:
    changes = ", ".join(
        f"recovery_score - lag(recovery_score, {k}) over ({WINDOW}) as day_{k}_change"
        for k in (1, 3, 7, 14)
    )
    raw = (
        "(coalesce(day_1_change, 0) * 0.4e0 + coalesce(day_3_change, 0) * 0.3e0 + "
        "coalesce(day_7_change, 0) * 0.2e0 + coalesce(day_14_change, 0) * 0.1e0) / 4"
    )
    return (
        "select *, greatest(-100, least(100, raw_momentum * 10)) as recovery_momentum_score, "
        f"{label('raw_momentum', '>', MOMENTUM, 'Deteriorating')} as momentum_category "
        f"from (select *, {raw} as raw_momentum from (select user_sk, date_sk, recovery_score, "
        f"{changes} from {source}))"
    )


def season_years_of(source: str) -> str:
    return (
        "select user_sk, season, year_number, avg(recovery_score) as avg_recovery, "
        "avg(hrv_rmssd) as avg_hrv, avg(resting_heart_rate) as avg_rhr, "
        "avg(skin_temp_celsius) as avg_skin_temp, stddev_samp(recovery_score) as recovery_stddev, "
        f"count(*) as sample_size from {source} r join dim_date d on d.date_sk = r.date_sk "
        "group by 1, 2, 3"
    )


def season_baselines_of(years: str) -> str:
    means = ", ".join(
        f"avg(avg_{c}) as seasonal_{c}_baseline" for c in ("recovery", "hrv", "rhr", "skin_temp")
    )
    return f"select user_sk, season, {means} from ({years}) group by 1, 2"


def _metrics() -> dict[str, str]:
    balance = (
        "round(round(coalesce(hrv_percentile, 50) * 0.45e0 + coalesce(rhr_percentile, 50) * 0.35e0 "
        "+ coalesce(respiratory_percentile, 50) * 0.2e0, 9), 2)"
    )
    season_index = (
        "round(round(((recovery_score - seasonal_recovery_baseline) * 0.4e0 "
        "+ (hrv_rmssd - seasonal_hrv_baseline) * 0.3e0 "
        "+ (seasonal_rhr_baseline - resting_heart_rate) * 0.2e0 "
        "+ (skin_temp_celsius - seasonal_skin_temp_baseline) * 0.1e0) / 4, 9), 2)"
    )
    share = "optimal_days / cast(days as double)"
    return {
        "recovery_momentum": momentum_of("fact_recovery"),
        "recovery_volatility": (
            "select user_sk, date_sk, recovery_score, volatility_7d, volatility_30d, "
            "volatility_30d / nullif(mean_30, 0) as volatility_coefficient, "
            f"volatility_7d - lag(volatility_7d, 7) over ({WINDOW}) as volatility_trend, "
            f"{label('volatility_30d', '<', VOLATILITY, 'Very Volatile')} as volatility_category "
            f"from (select *, stddev_samp(recovery_score) over ({ROWS_7}) as volatility_7d, "
            f"stddev_samp(recovery_score) over ({ROWS_30}) as volatility_30d, "
            f"avg(recovery_score) over ({ROWS_30}) as mean_30 from fact_recovery)"
        ),
        "autonomic_balance": (
            "select *, "
            f"{label('autonomic_balance_score', '>=', BALANCE, 'Very Poor Balance')} "
            f"as balance_category from (select *, {balance} as autonomic_balance_score, "
            f"avg(hrv_rhr_ratio) over ({ROWS_7}) as hrv_rhr_ratio_7d_avg from ("
            "select user_sk, date_sk, recovery_score, hrv_rmssd, hrv_percentile, "
            "resting_heart_rate, rhr_percentile, respiratory_rate, percent_rank() over "
            "(partition by user_sk order by respiratory_rate desc nulls first) * 100 "
            "as respiratory_percentile, hrv_rmssd / nullif(resting_heart_rate, 0) as hrv_rhr_ratio "
            "from fact_recovery where hrv_rmssd is not null and resting_heart_rate is not null))"
        ),
        "strain_recovery_efficiency": (
            f"select *, avg(recovery_efficiency_ratio) over ({ROWS_30}) as efficiency_30day_avg, "
            f"{label('recovery_efficiency_ratio', '>', EFFICIENCY, 'Very Poor')} "
            "as efficiency_category from (select *, case when day_strain > 0 then "
            "(next_day_recovery - baseline_recovery) / cast(day_strain as double) end "
            "as recovery_efficiency_ratio from (select s.user_sk, s.date_sk, s.day_strain, "
            "r.recovery_score, lead(r.recovery_score) over (partition by s.user_sk "
            "order by s.date_sk) as next_day_recovery, avg(r.recovery_score) over "
            "(partition by r.user_sk order by r.date_sk rows between 7 preceding and 1 preceding) "
            "as baseline_recovery from fact_strain s left join fact_recovery r "
            "on r.user_sk = s.user_sk and r.date_sk = s.date_sk))"
        ),
        "strain_sustainability": (
            "select user_sk, date_sk, day_strain, optimal_strain_min, optimal_strain_max, "
            "strain_category, strain_deviation, round(round(100 * optimal_days / "
            "cast(days as double) - 50 * over_days / cast(days as double), 9), 2) "
            "as sustainability_score_30d, "
            f"{label(share, '>', SUSTAIN, 'Unsustainable')} as sustainability_category from ("
            f"select *, count(*) over ({ROWS_30}) as days, "
            f"count(*) filter (where strain_category = 'Optimal') over ({ROWS_30}) "
            f"as optimal_days, count(*) filter (where strain_category = 'Over') over ({ROWS_30}) "
            "as over_days from (select *, case when day_strain < optimal_strain_min then 'Under' "
            "when day_strain <= optimal_strain_max then 'Optimal' else 'Over' end "
            "as strain_category, case when day_strain < optimal_strain_min "
            "then optimal_strain_min - day_strain when day_strain > optimal_strain_max "
            "then day_strain - optimal_strain_max else 0 end as strain_deviation "
            "from fact_strain where optimal_strain_max is not null))"
        ),
        "training_readiness_gap": (
            "select user_sk, date_sk, recovery_score, recovery_score as body_readiness, "
            "optimal_strain_target, training_recommendation_score, readiness_motivation_gap, "
            f"{gap_label('readiness_motivation_gap')} as gap_category, "
            "coalesce(readiness_motivation_gap < -30 and recent > 14, false) "
            "as overtraining_risk_flag from (select *, "
            f"{step_score('optimal_strain_target')} as training_recommendation_score, "
            f"recovery_score - {step_score('optimal_strain_target')} as readiness_motivation_gap "
            "from (select r.user_sk, r.date_sk, r.recovery_score, "
            "(s.optimal_strain_min + s.optimal_strain_max) / 2 as optimal_strain_target, "
            "avg(s.day_strain) over (partition by s.user_sk order by s.date_sk "
            "rows between 6 preceding and 1 preceding) as recent from fact_recovery r "
            "left join fact_strain s on s.user_sk = r.user_sk and s.date_sk = r.date_sk))"
        ),
        "seasonal_adaptation": (
            "select user_sk, date_sk, season, recovery_score, seasonal_recovery_baseline, "
            "recovery_deviation, seasonal_adaptation_index, "
            f"{label('recovery_deviation', '>', ADAPTATION, 'Poorly Adapted')} "
            "as adaptation_category from (select r.user_sk, r.date_sk, d.season, "
            "r.recovery_score, b.seasonal_recovery_baseline, "
            "r.recovery_score - b.seasonal_recovery_baseline as recovery_deviation, "
            f"{season_index} as seasonal_adaptation_index from fact_recovery r "
            "join dim_date d on d.date_sk = r.date_sk left join "
            f"({season_baselines_of(season_years_of('fact_recovery'))}) b "
            "on b.user_sk = r.user_sk and b.season = d.season)"
        ),
    }


METRIC_COLUMNS = {
    "recovery_momentum": "user_sk date_sk recovery_score:r day_1_change:r day_3_change:r "
    "day_7_change:r day_14_change:r raw_momentum:r recovery_momentum_score:r momentum_category",
    "recovery_volatility": "user_sk date_sk recovery_score:r volatility_7d:r volatility_30d:r "
    "volatility_coefficient:r volatility_trend:r volatility_category",
    "autonomic_balance": "user_sk date_sk recovery_score:r hrv_rmssd:r hrv_percentile "
    "resting_heart_rate rhr_percentile respiratory_rate:r respiratory_percentile:r "
    "hrv_rhr_ratio:r hrv_rhr_ratio_7d_avg:r autonomic_balance_score:r balance_category",
    "strain_recovery_efficiency": "user_sk date_sk day_strain:r recovery_score:r "
    "next_day_recovery:r baseline_recovery:r recovery_efficiency_ratio:r efficiency_30day_avg:r "
    "efficiency_category",
    "strain_sustainability": "user_sk date_sk day_strain optimal_strain_min:r "
    "optimal_strain_max:r strain_category strain_deviation:r sustainability_score_30d:r "
    "sustainability_category",
    "training_readiness_gap": "user_sk date_sk recovery_score:r body_readiness:r "
    "optimal_strain_target:r training_recommendation_score readiness_motivation_gap:r "
    "gap_category overtraining_risk_flag",
    "seasonal_adaptation": "user_sk date_sk season recovery_score:r "
    "seasonal_recovery_baseline:r recovery_deviation:r seasonal_adaptation_index:r "
    "adaptation_category",
}
STRAIN_COLUMNS = (
    "strain_sk user_sk date_sk day_strain workout_strain optimal_strain_min:r "
    "optimal_strain_max:r calories_burned average_heart_rate max_heart_rate zone_0_minutes:r "
    "zone_1_minutes:r zone_2_minutes:r zone_3_minutes:r zone_4_minutes:r zone_5_minutes:r "
    "workout_count total_workout_minutes max_workout_strain workout_types:a source_created_at:t "
    "source_updated_at:t cycle_date:t"
)
RECOVERY_COLUMNS = (
    "user_sk date_sk recovery_score:r recovery_score_percentile hrv_rmssd:r hrv_percentile "
    "resting_heart_rate rhr_percentile sleep_performance_percentage:r "
    "sleep_consistency_percentage:r sleep_efficiency_percentage:r skin_temp_celsius:r "
    "skin_temp_deviation:r respiratory_rate:r created_timestamp:t source_updated_at:t "
    "source_user_id source_cycle_id"
)


def _models() -> dict[str, str]:
    q: dict[str, str] = {}
    for name in pipeline.STAGED:
        q[f"stg_{name}"] = f"select {out(_kinds(name, True))} from stg_{name}"
    q["stg_user"] = f"select {out(_kinds('user', True))} from raw_user"
    q["dim_user"] = (
        "select user_sk, user_id, email, first_name, last_name, "
        f"{out('created_at:t updated_at:t')} from dim_user"
    )
    in_use = (
        "(select d.*, coalesce(l.n, 0) as n_rows from dim_date d left join "
        "(select day, count(*) as n from lines group by 1) l on l.day = d.date_day)"
    )
    q["dim_date"] = (
        f"select * replace (cast(date_day as varchar) as date_day) from {in_use}"
    )
    q["doc_dim_date_weekend"] = (
        "select date_sk, cast(date_day as varchar) as date_day, n_rows, "
        f"dayofweek(date_day) in (0, 6) as is_weekend from {in_use}"
    )
    q["doc_dim_date_extra"] = (
        "select date_sk, cast(date_day as varchar) as date_day, n_rows, "
        "isodow(date_day) <= 5 as is_weekday, dayname(date_day) as date_day_name, "
        "strftime(date_day, '%B %Y') as month_year_name, "
        f"date_day - {AS_OF} as days_from_today from {in_use}"
    )
    q["int_recovery_percentiles"] = (
        "select user_sk, date_sk, recovery_score_percentile, hrv_percentile, rhr_percentile, "
        f"skin_temp_celsius, {out('skin_temp_deviation:r')}, days_of_history from percentiles"
    )
    q["inc_recovery_percentiles"] = q["int_recovery_percentiles"]
    # Exact sums, as in the state, and whole-number arithmetic: a floating-point mean can fall below a tie.
    means = ", ".join(
        f"(2 * cast(sum(cast({c} as decimal(12,4)) * 10000) as bigint) * 100 + count({c})) "
        f"// (2 * count({c})) / 1e6 as {name}"
        for c, name in (
            ("recovery_score", "avg_recovery"),
            ("hrv_rmssd", "avg_hrv"),
            ("resting_heart_rate", "avg_rhr"),
            ("skin_temp_celsius", "avg_skin_temp"),
        )
    )
    q["inc_season_year"] = (
        f"select user_sk, season, year_number, {means}, "
        "round(stddev_samp(recovery_score), 6) as recovery_stddev, count(*) as sample_size "
        "from fact_recovery r join dim_date d on d.date_sk = r.date_sk group by 1, 2, 3"
    )
    q["inc_seasonal_adaptation"] = f"select {out(METRIC_COLUMNS['seasonal_adaptation'])} from seasonal_adaptation"
    q["fact_daily_recovery"] = f"select {out(RECOVERY_COLUMNS)} from fact_recovery"
    q["fact_daily_strain"] = f"select {out(STRAIN_COLUMNS)} from fact_strain_plain"
    for name, columns in METRIC_COLUMNS.items():
        q[name] = f"select {out(columns)} from {name}"

    recent = f"date_day >= {AS_OF} - 365"
    reports = {
        "report_momentum": ("recovery_momentum", "", ""),
        "report_efficiency": (
            "strain_recovery_efficiency",
            "",
            ", round(coalesce(abs(recovery_efficiency_ratio), 1), 6) as size",
        ),
        "report_readiness": (
            "training_readiness_gap",
            "",
            ", case when readiness_motivation_gap < -20 then 'red' "
            "when readiness_motivation_gap < 0 then 'orange' else 'green' end as color",
        ),
        "report_volatility": ("recovery_volatility", "", ""),
        "report_balance": ("autonomic_balance", "", ""),
        "report_seasonal": (
            "seasonal_adaptation",
            "month_name, ",
            ", case when recovery_deviation > 0 then 'green' else 'red' end as color",
        ),
    }
    hidden = {
        "report_momentum": {"raw_momentum:r"},
        "report_balance": {
            "recovery_score:r",
            "hrv_percentile",
            "rhr_percentile",
            "respiratory_rate:r",
            "respiratory_percentile:r",
        },
    }
    for name, (metric, more, extra) in reports.items():
        columns = [
            c
            for c in METRIC_COLUMNS[metric].split()
            if c not in {"user_sk", "date_sk", "season"} and c not in hidden.get(name, ())
        ]
        season = "m.season, " if metric == "seasonal_adaptation" else ""
        q[name] = (
            f"select user_sk, cast(date_day as varchar) as date_day, {more}{season}"
            f"{out(' '.join(columns))}{extra} from {metric} m "
            f"join dim_date d on d.date_sk = m.date_sk where {recent} order by date_day, user_sk"
        )
    q["sort_by_date"] = (
        f"select {out('day:t user_sk recovery_score:r')} from daily order by day, user_sk"
    )
    q["latest_row"] = (
        f"select user_sk, {out('date_day:t volatility_7d:r volatility_30d:r')}, "
        "volatility_category from ("
        + latest(
            "(select m.*, d.date_day from recovery_volatility m "
            f"join dim_date d on d.date_sk = m.date_sk where {recent})",
            "user_sk",
            "date_day desc",
        )
        + ")"
    )
    q["agg_kpi_mean"] = (
        "select round(avg(recovery_momentum_score), 6) as avg_recovery_momentum_score, "
        "round(avg(recovery_score), 6) as avg_recovery_score from recovery_momentum m "
        f"join dim_date d on d.date_sk = m.date_sk where {recent}"
    )
    q["agg_kpi_sum_bool"] = (
        "select count(*) filter (where overtraining_risk_flag) as risk_days "
        "from training_readiness_gap"
    )
    q["agg_value_counts"] = (
        "select momentum_category, count(*) as n from recovery_momentum group by 1 "
        "order by n desc, momentum_category"
    )
    q["sort_counts_desc"] = (
        "select volatility_category, count(*) as n from recovery_volatility group by 1 "
        "order by n desc, volatility_category"
    )
    q["agg_season_summary"] = (
        "select season, round(avg(recovery_score), 6) as recovery_score, "
        "round(avg(seasonal_adaptation_index), 6) as seasonal_adaptation_index "
        "from seasonal_adaptation group by 1"
    )
    return q


def _quality() -> dict[str, str]:
    q = {
        "dq_not_null": "select cycle_id, user_id, cast(ingested_at as varchar) as ingested_at "
        "from raw_recovery where skin_temp_celsius is null",
        "dq_unique": "select id, count(*) as n from raw_cycle where id is not null "
        "group by 1 having count(*) > 1",
        "agg_having_dup": "select l_partkey, count(*) as n from lineitem "
        "where l_partkey is not null group by 1 having count(*) > 1",
        "dq_unique_combo": "select user_sk, cast(day as varchar) as day, count(*) as n "
        "from lines group by 1, 2 having count(*) > 1",
        "dq_relationships": "select o_custkey, count(*) as n_rows from orders o where not exists "
        "(select 1 from supplier where s_suppkey = o.o_custkey) group by 1",
        "dq_accepted_range": "select o_orderkey, round(o_totalprice, 6) as o_totalprice "
        "from orders where o_orderstatus <> 'P' "
        "and (o_totalprice < 1000 or o_totalprice > 400000)",
        "dq_accepted_values": "select event_type, count(*) as n from events "
        "where event_type not in ('click', 'view') group by 1",
        "dq_expression": "select l_orderkey, l_linenumber, round(l_quantity, 6) as l_quantity, "
        "round(l_extendedprice, 6) as l_extendedprice from lineitem "
        "where not (l_quantity * 1000 + l_extendedprice <= 120000)",
        "dq_volume": "select source, records, case when records = 0 then 'info' "
        "when records > 1000 then 'warn' else 'ok' end as status from ("
        "select user_id as source, count(l.user_sk) as records from raw_user u "
        "left join lines l on l.user_sk = u.user_id group by 1 union all "
        "select concat('new-', user_id), 0 from raw_user) union all select 'user', count(*), "
        "case when count(*) <> 1 then 'warn' else 'ok' end from raw_user",
        "agg_test_summary": "select 'not_null_skin_temp_celsius' as test, count(*) as failures, "
        "count(*) <> 0 as should_warn, count(*) <> 0 as should_error "
        "from raw_recovery where skin_temp_celsius is null",
    }

    def fresh(as_of: str, where: str) -> str:
        return (
            "select cast(newest as varchar) as newest, case when newest is null "
            f"or newest < timestamp '{as_of}' - interval 7 day then 'error' "
            f"when newest < timestamp '{as_of}' - interval 2 day then 'warn' else 'pass' end "
            f"as status from (select max(ts) as newest from events where {where})"
        )

    q["dq_freshness"] = fresh("2024-02-02", "ts > timestamp '2024-01-01'")
    q["stream_freshness"] = fresh("2024-02-08", "true")

    tests = [(f"not_null_{c}", f"{c} is null") for c in checks.STRAIN_NOT_NULL]
    tests += [
        (f"accepted_range_{c}", f"({c} < {low} or {c} > {high})")
        for c, (low, high) in checks.STRAIN_RANGES.items()
    ]
    zones = " + ".join(f"coalesce(zone_{i}_minutes, 0)" for i in range(6))
    tests += [
        ("zone_total_within_day", f"{zones} > 1440"),
        ("cycle_date_not_too_old", f"cycle_date < {AS_OF} - interval 6 year"),
        ("cycle_date_not_in_future", f"cycle_date > {AS_OF}"),
    ]
    parts = [
        f"select '{name}' as test, count(*) filter (where {fails}) as failures from f"
        for name, fails in tests
    ]

    def duplicates(name: str, source: str, keys: str) -> str:
        return (
            f"select '{name}' as test, count(*) as failures from "
            f"(select {keys} from {source} group by {keys} having count(*) > 1)"
        )

    parts.append(duplicates("unique_strain_sk", "f", "strain_sk"))
    parts.append(duplicates("unique_user_sk_date_sk", "f", "user_sk, date_sk"))
    parts.append(
        "select 'relationships_user_sk' as test, count(*) as failures from f where user_sk not in "
        "(select md5(cast(cast(user_id as int) + 10 as varchar)) from dim_user)"
    )
    parts.append(
        "select 'relationships_date_sk' as test, count(*) as failures from f "
        "where date_sk not in (select date_sk from dim_date)"
    )
    for c in ("id", "user_id", "created_at"):
        parts.append(
            f"select 'raw_not_null_{c}' as test, count(*) as failures from raw_cycle "
            f"where {c} is null"
        )
    parts.append(duplicates("raw_unique_id", "raw_cycle", "id"))
    q["dq_suite"] = (
        "select test, failures, failures <> 0 as should_warn, failures <> 0 as should_error from ("
        + " union all ".join(parts).replace(
            " from f", " from (select *, timestamp '2026-11-04' as created_timestamp from fact_strain)"
        )
        + ")"
    )
    q["backfill_recovery"] = _backfill_suite()
    return q


def _backfill_suite() -> str:
    parts = [
        f"select 'not_null_{c}' as test, count(*) filter (where {c} is null) as failures "
        "from fact_recovery"
        for c in checks.RECOVERY_NOT_NULL
        if c != "recovery_sk"
    ]
    parts.append("select 'not_null_recovery_sk', count(*) filter (where source_cycle_id is null "
                 "or source_user_id is null) from fact_recovery")
    parts.append(
        "select 'accepted_range_recovery_score', count(*) filter "
        "(where recovery_score < 0 or recovery_score > 100) from fact_recovery"
    )
    parts.append(
        "select 'unique_recovery_sk', count(*) from (select source_cycle_id, source_user_id "
        "from fact_recovery group by 1, 2 having count(*) > 1)"
    )
    return (
        "select test, failures, failures <> 0 as should_warn, failures <> 0 as should_error from ("
        + " union all ".join(parts)
        + ")"
    )


def _streams_and_documented() -> dict[str, str]:
    q = {
        "stream_dedup_upsert": f"select {out(_kinds('cycle', True))} from stg_cycle",
        "stream_late_data": "select distinct user_id, event_type from events union all "
        "select distinct user_id + 1000000, event_type from events "
        "where ts > (select max(ts) from events) - interval 10 day",
        "stream_late_rows": " union all ".join(
            f"select user_id + {k * model_queries.OTHER_USERS} as user_id, event_type, "
            f"cast(ts as varchar) as ts, {k} as batch from events where ts <= "
            f"(select max(ts) from events where {known}) - interval {model_queries.LATENESS_DAYS} day"
            for k, known in ((1, f"ts < '{model_queries.EARLY_END}'"), (2, "true"))
        ),
        "stream_daily_workout": "select "
        + out(WORKOUT_TOTALS.replace("workout_date:t", "day:t"))
        + " from workout_record_days",
    }
    raw_cycle = _kinds("cycle", False).replace(" ingested_at:t", "")
    q["stream_ingest"] = f"select {out(raw_cycle)} from raw_cycle"

    def text(subject: str) -> str:
        lower = subject.lower()
        return (
            f"case score_state when 'SCORED' then '{subject} data fully processed' "
            f"when 'PENDING' then '{subject} data being processed' "
            f"when 'UNSCORABLE' then 'Unable to score {lower} data' else 'Unknown state' end"
        )

    q["doc_score_state_dim"] = " union all ".join(
        f"select distinct score_state, {text(subject)} as score_state_description "
        f"from stg_{subject.lower()} where score_state is not null"
        for subject in ("Sleep", "Cycle")
    )
    renamed = {
        "sleep": [
            ("total_in_bed_time_milli", "total_in_bed_hours"),
            ("total_awake_time_milli", "total_awake_minutes"),
            ("total_no_data_time_milli", "total_no_data_minutes"),
            ("total_light_sleep_time_milli", "total_light_sleep_hours"),
            ("total_slow_wave_sleep_time_milli", "total_slow_wave_sleep_hours"),
            ("total_rem_sleep_time_milli", "total_rem_sleep_hours"),
            ("baseline_milli", "baseline_hours"),
            ("need_from_sleep_debt_milli", "need_from_sleep_debt_hours"),
            ("need_from_recent_strain_milli", "need_from_recent_strain_hours"),
            ("need_from_recent_nap_milli", "need_from_recent_nap_hours"),
        ],
        "workout": [
            (f"zone_{z}_milli", f"zone_{z}_minutes")
            for z in ("zero", "one", "two", "three", "four", "five")
        ],
    }
    same = {
        "sleep": "id user_id created_at:t updated_at:t start_time:t end_time:t timezone_offset "
        "nap score_state sleep_cycle_count disturbance_count respiratory_rate "
        "sleep_performance_percentage sleep_consistency_percentage sleep_efficiency_percentage "
        "ingested_at:t",
        "workout": "id user_id created_at:t updated_at:t start_time:t end_time:t "
        "timezone_offset sport_id score_state strain average_heart_rate max_heart_rate "
        "kilojoule ingested_at:t",
    }
    day = {"sleep": ("sleep_date", "start_time"), "workout": ("workout_date", "created_at")}
    for name, pairs in renamed.items():
        measures = ", ".join(f"round({old}, 6) as {new}" for old, new in pairs)
        alias, time = day[name]
        key = "doc_fact_workouts" if name == "workout" else "doc_fact_sleep"
        q[key] = (
            f"select cast(cast({time} as date) as varchar) as {alias}, {out(same[name])}, "
            f"{measures} from stg_{name}"
        )
    q["doc_fact_cycles"] = (
        "select cast(cast(start_time as date) as varchar) as cycle_date, "
        f"{out(_kinds('cycle', True))} from stg_cycle where ingested_at > "
        "(select max(ingested_at) from stg_cycle where ingested_at <= timestamp '2022-01-01')"
    )
    recovery = _kinds("recovery", True).replace("sleep_id ", "")
    q["doc_fact_recovery"] = (
        "select cast(cast(created_at as date) as varchar) as recovery_date, "
        f"{out(recovery)} from stg_recovery"
    )
    q["doc_sleep_report"] = (
        "select first_name, last_name, cast(day as varchar) as date_day, "
        "sleep_performance_percentage, round(total_in_bed_time_milli, 6) as total_in_bed_hours, id "
        "from (select *, cast(start_time as date) as day from stg_sleep) s "
        "join dim_user u on u.user_id = s.user_id "
        f"where day >= {AS_OF} - 30 and day in (select date_day from dim_date) "
        "order by sleep_performance_percentage desc nulls first, id"
    )
    q["doc_weekly_corr"] = (
        "select week_of_year, round(avg(c.strain), 6) as avg_strain, "
        "round(avg(r.recovery_score), 6) as avg_recovery from stg_cycle c "
        "join stg_recovery r on r.cycle_id = c.id "
        "join dim_date d on d.date_day = cast(c.start_time as date) group by 1 order by 1"
    )
    return q


def _sources() -> dict[str, str]:
    q = {
        f"src_{name}": f"select {out(_kinds(name, False))} from raw_{name}"
        for name in inputs.RAW
    }
    short = out("id user_id created_at:t strain:r")
    q["src_single_object"] = f"select {short} from raw_cycle"
    q["sink_append"] = q["src_single_object"]
    q["sink_replace"] = f"select {short} from raw_cycle where score_state <> 'SCORED'"
    q["src_pages"] = (
        f"select {short} from (select * from raw_cycle union all "
        "select * replace (concat(id, '-b') as id) from raw_cycle)"
    )
    q["set_union_pages"] = "select id, user_id, score_state from raw_cycle"
    stamp = source_queries.BATCH_TIME
    q["src_ingested_at"] = (
        f"select id, user_id, {out('created_at:t')}, '{stamp}' as ingested_at from raw_cycle"
    )
    created = inputs.RAW["cycle"]["created_at"]
    q["src_parse_ts"] = (
        f"select l_orderkey, l_linenumber, {source_queries.TIME_TEXT} as time_text, "
        "case l_linenumber when 3 then concat(c, '.123') when 4 then null when 5 then null "
        "when 6 then concat(substr(c, 1, 10), ' 00:00:00') else c end as parsed, "
        "l_linenumber = 4 as is_bad from "
        f"(select l_orderkey, l_linenumber, cast({created} as varchar) as c from lineitem)"
    )
    q["fn_iso_parse"] = (
        "select event_id, regexp_replace(regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%g'), "
        "'(\\.\\d*?)0+$', '\\1'), '\\.$', '') as ts from events"
    )
    q["src_flatten"] = (
        "select event_id, user_id, concat('[\"', event_type, '\",\"any\"]') as user_tags, "
        "cast(json_extract(props, '$.k') as bigint) as data_props_k, "
        "round(value, 6) as data_value from events"
    )
    q["fn_json_text"] = (
        "select event_id, concat('[\"', event_type, '\",\"', event_type, '\"]') as list_text "
        "from events"
    )
    start, now = source_queries.EXTRACT_FROM, source_queries.EXTRACT_NOW.isoformat(sep=" ")
    within = f"updated_at between timestamp '{start}' and timestamp '{now}'"
    q["extract_incremental"] = (
        f"select id, user_id, {out('created_at:t updated_at:t')}, '{now}' as ingested_at, "
        "cast((select max(updated_at) from raw_cycle "
        f"where {within}) as varchar) as state_after from raw_cycle where {within}"
    )
    q["extract_full"] = (
        "select user_id, email, first_name, last_name, "
        f"{out('created_at:t updated_at:t')}, '{now}' as ingested_at from raw_user"
    )
    first_load = source_queries.FIRST_LOAD_END
    sports = (
        "(select coalesce(sport_name, 'none') as known, "
        "concat(substr(coalesce(sport_name, 'none'), 1, 1), 'F') as asked, "
        "updated_at, ingested_at from raw_workout)"
    )
    states = (
        "(select known as table_name, max(updated_at) as last_processed_at "
        f"from {sports} group by 1)"
    )
    names = f"(select distinct asked as table_name from {sports})"
    known = (
        "select n.table_name, coalesce(s.last_processed_at, timestamp '2024-01-01') "
        f"as last_processed_at from {names} n left join {states} s on s.table_name = n.table_name"
    )
    q["state_get"] = f"select table_name, {out('last_processed_at:t')} from ({known})"
    kept = (
        f"select table_name, {out('last_processed_at:t')}, 'success' as last_run_status, "
        f"'{first_load}' as updated_at from {states} where table_name not in "
        f"(select table_name from {names})"
    )
    q["state_upsert"] = (
        f"{kept} union all select asked, cast(max(ingested_at) as varchar), 'success', "
        f"'{stamp}' from {sports} group by 1"
    )
    q["state_failed"] = (
        f"{kept} union all select table_name, cast(last_processed_at as varchar), 'failed', "
        f"'{stamp}' from ({known})"
    )
    q["scan_source"] = f"select id, user_id, nap, {out('created_at:t')} from raw_sleep"
    q["scan_ref"] = "select cycle_id, user_id, recovery_score from stg_recovery"
    q["row_count"] = "select count(*) as n from raw_workout"
    q["scan_dashboard"] = (
        "select user_sk, count(*) as days, round(avg(recovery_score), 6) as avg_recovery "
        "from daily group by 1"
    )
    q["gen_series"] = (
        "select cast(cast(unnest(generate_series(a, b, interval 1 day)) as date) as varchar) "
        "as date_day from (select min(day) as a, max(day) as b from lines)"
    )
    q["tbl_fn_generator"] = (
        "select user_sk, max(day) - min(day) + 1 as days, cast(min(day) as varchar) as first_day, "
        "cast(max(day) as varchar) as last_day from lines group by 1"
    )
    q["mat_table"] = (
        "select user_sk, user_id, email, first_name, last_name, "
        f"{out('created_at:t updated_at:t')} from dim_user"
    )
    q["filter_watermark"] = (
        f"select id, user_id, {out('created_at:t updated_at:t')} from raw_cycle where created_at > "
        f"(select max(created_at) from raw_cycle where created_at <= timestamp '{first_load}')"
    )
    q["agg_max_global"] = (
        "select cast(max(created_at) as varchar) as newest_created, "
        "cast(max(updated_at) as varchar) as newest_updated from raw_cycle"
    )

    def two_loads(source: str) -> tuple[str, str]:
        key, old = SOURCES[source].key, f"created_at <= timestamp '{first_load}'"
        typed = f"(select {_staged(source)} from raw_{source} where {{}})"
        mark = f"created_at > (select max(created_at) from stg_{source}_first)"
        first = latest(typed.format(old), key, NEWEST)
        return first, latest(typed.format(mark), key, NEWEST)

    for source in ("recovery", "cycle"):
        first, batch = two_loads(source)
        key = SOURCES[source].key
        loads = f"with stg_{source}_first as ({first}), stg_{source}_next as ({batch}) "
        merged = (
            f"select * from stg_{source}_first where {key} not in "
            f"(select {key} from stg_{source}_next) union all select * from stg_{source}_next"
        )
        if source == "recovery":
            q["mat_incremental_merge"] = (
                f"{loads} select {out(_kinds(source, True))} from ({merged})"
            )
            wrong = {
                "not_null_cycle_id": "cycle_id is null",
                "not_null_skin_temp_celsius": "skin_temp_celsius is null",
                "accepted_range_recovery_score": "recovery_score < 20 or recovery_score > 80",
            }
            counts = " union all ".join(
                f"select '{name}' as test, count(*) filter (where {rule}) as failures from merged"
                for name, rule in wrong.items()
            )
            q["dq_while_writing"] = (
                f"{loads}, merged as ({merged}) select test, failures, failures <> 0 as should_warn, "
                f"failures <> 0 as should_error from ({counts})"
            )
            continue
        q["join_merge_key"] = (
            f"{loads} select id, user_id, {out('updated_at:t')} from ({merged})"
        )
        q["mat_merge_partial"] = (
            f"{loads} select {out(_kinds(source, True))} from ("
            "select f.* replace (coalesce(n.updated_at, f.updated_at) as updated_at, "
            "coalesce(n.ingested_at, f.ingested_at) as ingested_at) from stg_cycle_first f "
            "left join stg_cycle_next n on n.id = f.id union all select * from stg_cycle_next "
            "where id not in (select id from stg_cycle_first))"
        )
        q["mat_schema_change"] = (
            f"{loads} select id, user_id, {out('updated_at:t')}, strain from ("
            "select * replace (null as strain) from stg_cycle_first where id not in "
            "(select id from stg_cycle_next) union all select * from stg_cycle_next)"
        )
    q["mat_full_refresh"] = f"select {out(_kinds('cycle', True))} from stg_cycle"
    in_2023 = "created_at >= timestamp '2023-01-01' and created_at < timestamp '2024-01-01'"
    q["doc_backfill_range"] = (
        f"select id, user_id, {out('created_at:t updated_at:t')} from ("
        + latest(f"(select * from raw_sleep where {in_2023})", "id", NEWEST)
        + ")"
    )
    profile = f"email, first_name, last_name, {out('created_at:t updated_at:t')}"
    pages = """
        linked as (select cast(o_custkey as varchar) as request_id, o_orderkey as k,
                case when row_number() over w > 1 then cast(o_orderkey as varchar) end as token,
                cast(case when o_orderkey % 29 = 0 and row_number() over w > 2 then lag(o_orderkey) over w
                    else lead(o_orderkey) over w end as varchar) as next_token
            from orders window w as (partition by o_custkey order by o_orderkey)),
        pages as (select request_id, token, next_token from linked where k % 23 <> 0
            union all select request_id, token, next_token from linked where k % 23 <> 0 and k % 31 = 0
            union all select request_id, token, null from linked where k % 37 = 0),
        nodes as (select request_id, token, min(next_token) as next_token, count(*) as copies,
                count(distinct coalesce(next_token, '')) > 1 as differ from pages group by 1, 2),
        walk as (select request_id, next_token as token, 1 as position, [next_token] as seen from nodes
                where token is null and next_token is not null
            union all select w.request_id, n.next_token, w.position + 1, list_append(w.seen, n.next_token)
            from walk w join nodes n on n.request_id = w.request_id and n.token = w.token
            where n.next_token is not null and not list_contains(w.seen, n.next_token)),
        chain as (select n.*, case when n.token is null then 0 else w.position end as position
            from nodes n left join walk w on w.request_id = n.request_id and w.token = n.token)"""
    q["src_page_chain"] = f"with recursive {pages} select * from chain"
    q["src_page_faults"] = f"""with recursive {pages}
        select 'repeated page' as reason, request_id, token from chain where copies > 1
        union all select 'differing pages', request_id, token from chain where differ
        union all select distinct 'missing page', request_id, next_token from chain c where next_token is not null
            and not exists (from chain d where d.request_id = c.request_id and d.token = c.next_token)
        union all select 'no first page', request_id, null from chain
            group by request_id having count(*) = count(token)
        union all select 'page not reached', request_id, token from chain where position is null
        union all select 'circle', c.request_id, c.token from chain c join chain d
            on d.request_id = c.request_id and d.token = c.next_token and d.position <= c.position"""
    q["doc_scd2_user"] = f"""
        with m as (select user_sk, user_id, {profile} from dim_user),
        k as (select md5(i) as user_sk, i as user_id, {profile}
              from (select *, cast(cast(user_id as int) + 10 as varchar) as i from dim_user))
        select k.*, '2024-01-01' as effective_date,
            case when m.last_name <> k.last_name then '2025-01-01' end as expiry_date,
            coalesce(m.last_name = k.last_name, true) as is_current
        from k left join m on m.user_id = k.user_id
        union all
        select m.*, '2025-01-01', null, true from m left join k on k.user_id = m.user_id
        where k.user_id is null or k.last_name <> m.last_name"""
    q["join_user_version"] = f"""
        with versions as ({q["doc_scd2_user"]})
        select f.user_sk, cast(f.cycle_date as varchar) as cycle_date, f.day_strain, v.last_name, v.effective_date
        from fact_strain_plain f left join versions v on v.user_sk = f.user_sk
            and cast(v.effective_date as date) <= f.cycle_date
            and f.cycle_date < coalesce(cast(v.expiry_date as date), date '9999-12-31')"""
    q["doc_ops_metrics"] = f"""
        select source, count(*) as runs,
            round(avg(case when month < 202101 then 0e0 else 1e0 end), 6) as success_rate,
            round(avg(records), 6) as avg_records, round(avg(records / 10e0), 6) as avg_seconds,
            round(date_diff('second', max(newest), timestamp '{stamp}') / 3600e0, 6)
                as hours_since_newest
        from (select score_state as source, year(created_at) * 100 + month(created_at) as month,
                count(*) as records, max(updated_at) as newest from raw_cycle group by 1, 2)
        group by 1"""
    return q


def _operators() -> dict[str, str]:
    line = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
    q: dict[str, str] = {}
    q["proj_cast_spec"] = (
        f"select {out(_kinds('sleep', True))} from (select {_staged('sleep')} from raw_sleep)"
    )
    q["proj_round_cast"] = (
        f"select {line}, {whole('l_quantity / 4')} as rounded, "
        f"{whole('-l_quantity / 4')} as rounded_negative from lineitem"
    )
    q["proj_ms_to_hours"] = (
        f"select id, {out('ingested_at:t')}, "
        f"round({units('total_light_sleep_time_milli', 5)}, 6) as light_hours, "
        f"round({units('need_from_recent_nap_milli', 5)}, 6) as nap_hours from raw_sleep"
    )
    q["proj_ms_to_minutes"] = (
        f"select id, {out('ingested_at:t')}, "
        f"round({units('zone_zero_milli', 300)}, 6) as zone_0_minutes, "
        f"round({units('zone_four_milli', 300)}, 6) as zone_4_minutes from raw_workout"
    )
    q["proj_rename"] = (
        f"select id, {out('ingested_at:t')}, cast(start_time as varchar) as start, "
        'cast(end_time as varchar) as "end", round(kilojoule, 6) as calories_burned from raw_cycle'
    )
    q["proj_exclude"] = (
        "select * exclude (l_tax, l_shipdate) replace (round(l_quantity, 6) as l_quantity, "
        "round(l_extendedprice, 6) as l_extendedprice, round(l_discount, 6) as l_discount) "
        "from lineitem"
    )
    q["proj_decimal"] = (
        f"select {line}, round(l_quantity, 6) as score, round(l_quantity / 1000, 6) as seconds, "
        "round(33 + 10 * l_discount, 2) as temperature from lineitem"
    )
    null = "cast(null as double)"
    q["proj_null_const"] = (
        f"select {line}, {null} as optimal_strain_min, {null} as optimal_strain_max from lineitem"
    )
    q["proj_audit"] = (
        f"select {line}, '{operator_queries.AUDIT_TIME}' as calculated_at from lineitem"
    )
    q["filter_not_null"] = (
        f"select cycle_id, {out('ingested_at:t recovery_score:r skin_temp_celsius:r')} "
        "from raw_recovery where recovery_score is not null and skin_temp_celsius is not null"
    )
    keyed = f"select {out('user_sk date_sk recovery_score:r')} from daily"
    q["filter_horizon"] = f"{keyed} where day >= {AS_OF} - 90"
    q["filter_date_range"] = (
        f"select {out('user_sk date_sk day:t recovery_score:r')} from daily "
        f"where day >= {AS_OF} - 90"
    )
    q["filter_upper_bound"] = f"{keyed} where day <= date '2024-12-31'"
    q["pred_in"] = f"{keyed} where month(day) in (12, 1, 2)"
    q["pred_between"] = (
        f"select {out('user_sk date_sk day_strain:r')} from daily where day_strain between 6 and 14"
    )
    q["pred_case_state"] = (
        "select user_sk, date_sk, case when least(row_number() over "
        f"({WINDOW}), 365) >= 60 then round(recovery_score, 6) end as shown_score from daily"
    )
    q.update(_joins())
    q.update(_windows())
    q.update(_functions(line))
    return q


def _joins() -> dict[str, str]:
    moved = (
        "(select md5(i) as user_sk, i as user_id from "
        "(select cast(cast(user_id as int) + 10 as varchar) as i from dim_user))"
    )
    q = {
        "join_inner_user": "select r.user_id, cycle_id, recovery_score, user_sk "
        "from stg_recovery r join dim_user u on u.user_id = r.user_id",
        "join_inner_date": "select cycle_id, date_sk from stg_recovery r "
        "join dim_date d on d.date_day = cast(r.created_at as date)",
        "join_left_composite": "select a.user_sk, a.date_sk, "
        "round(a.recovery_score, 6) as recovery_score, round(b.day_strain, 6) as day_strain "
        "from daily a left join next_day b "
        "on b.user_sk = a.user_sk and b.date_sk = a.date_sk",
        "join_left_to_inner": "select c.user_id, c.id, c.strain, u.user_sk from stg_cycle c "
        f"join {moved} u on u.user_id = c.user_id",
        "join_left_preagg": "select c.user_id, cast(cast(c.created_at as date) as varchar) "
        "as workout_date, c.id, c.strain, w.total_workout_strain, w.workout_count "
        "from stg_cycle c left join (select user_id, cast(created_at as date) + 1 as d, "
        "cast(sum(strain) as bigint) as total_workout_strain, count(*) as workout_count "
        "from stg_workout group by 1, 2) w "
        "on w.user_id = c.user_id and w.d = cast(c.created_at as date)",
        "join_fact_date": "select a.date_sk, user_sk, round(recovery_score, 6) as recovery_score, "
        "season, year_number from daily a join dim_date d on d.date_sk = a.date_sk",
        "join_anti_fk": "select o_custkey, o_orderkey from orders where o_custkey not in "
        "(select s_suppkey from supplier)",
    }
    night = latest(
        "(select *, cast(created_at as date) + 1 as day from stg_sleep)",
        "user_id, day",
        "nap asc nulls last, updated_at desc nulls first, id desc nulls first",
    )
    recovery = latest(
        "(select *, cast(created_at as date) as day from stg_recovery)",
        "user_id, day",
        desc("updated_at", "created_at", "cycle_id"),
    )
    q["join_left_sleep_fanout"] = (
        "select r.user_id, cast(r.day as varchar) as day, r.cycle_id, r.recovery_score, "
        "s.sleep_performance_percentage, s.sleep_consistency_percentage, "
        f"s.sleep_efficiency_percentage, s.respiratory_rate from ({recovery}) r "
        f"left join ({night}) s on s.user_id = r.user_id and s.day = r.day"
    )
    strain, scored = "daily", "next_day"
    on = "on r.user_sk = s.user_sk and r.date_sk = s.date_sk"
    both = "round(day_strain, 6) as day_strain, round(recovery_score, 6) as recovery_score"
    both = both.replace("(day_strain", "(s.day_strain").replace("(recovery", "(r.recovery")
    q["join_strain_recovery"] = (
        f"select s.user_sk, s.date_sk, {both} from {strain} s left join {scored} r {on}"
    )
    q["join_recovery_strain"] = (
        f"select r.user_sk, r.date_sk, {both} from {scored} r left join {strain} s {on}"
    )
    q["win_avg_prev7_right"] = (
        "select s.user_sk, s.date_sk, round(avg(r.recovery_score) over (partition by r.user_sk "
        "order by r.date_sk rows between 7 preceding and 1 preceding), 6) as baseline "
        f"from {strain} s left join {scored} r {on}"
    )
    q["win_avg_prev6"] = (
        "select r.user_sk, r.date_sk, round(avg(s.day_strain) over (partition by s.user_sk "
        "order by s.date_sk rows between 6 preceding and 1 preceding), 6) as recent_strain "
        f"from {scored} r left join {strain} s {on}"
    )
    years = season_years_of("daily")
    q["agg_season_year"] = (
        f"select user_sk, season, year_number, "
        f"{out('avg_recovery:r avg_hrv:r avg_rhr:r avg_skin_temp:r recovery_stddev:r')}, "
        f"sample_size from ({years})"
    )
    baselines = season_baselines_of(years)
    names = " ".join(f"seasonal_{c}_baseline:r" for c in ("recovery", "hrv", "rhr", "skin_temp"))
    q["agg_two_level"] = f"select user_sk, season, {out(names)} from ({baselines})"
    q["join_self_baseline"] = (
        "select a.user_sk, a.date_sk, d.season, round(a.recovery_score, 6) as recovery_score, "
        "round(b.seasonal_recovery_baseline, 6) as seasonal_recovery_baseline from daily a "
        f"join dim_date d on d.date_sk = a.date_sk left join ({baselines}) b "
        "on b.user_sk = a.user_sk and b.season = d.season"
    )
    momentum = (
        "recovery_score:r day_1_change:r day_3_change:r day_7_change:r day_14_change:r "
        "recovery_momentum_score:r momentum_category"
    )
    q["join_metric_date"] = (
        f"select user_sk, cast(date_day as varchar) as date_day, {out(momentum)} "
        f"from ({momentum_of('daily')}) m join dim_date d on d.date_sk = m.date_sk"
    )
    q["agg_workout_daily"] = f"select {out(WORKOUT_TOTALS)} from workout_days"
    q["agg_distinct_array"] = (
        "select user_id, cast(cast(created_at as date) as varchar) as day, "
        "coalesce(string_agg(distinct sport_name, ',' order by sport_name), '') as sports "
        "from raw_workout group by 1, cast(created_at as date)"
    )
    q["set_distinct_states"] = "select distinct score_state from raw_cycle"
    return q


def _windows() -> dict[str, str]:
    raw_cycle = out(_kinds("cycle", False))
    recovery = (
        "(select *, cast(created_at as date) as day from stg_recovery)",
        "user_id, day",
        desc("updated_at", "created_at", "cycle_id"),
    )
    cycle = (
        "(select *, cast(created_at as date) as day from stg_cycle)",
        "user_id, day",
        desc("updated_at", "created_at", "id"),
    )
    q = {
        "win_dedup_latest": f"select {raw_cycle} from ({latest('raw_cycle', 'id', NEWEST)})",
        "win_dedup_ingested": f"select {raw_cycle} from ("
        + latest("raw_cycle", "id", desc("ingested_at", "updated_at", "created_at"))
        + ")",
        "win_dedup_user_day": f"select {out(_kinds('recovery', True))}, {out('day:t')} "
        f"from ({latest(*recovery)})",
        "win_dedup_cycle_day": f"select {out(_kinds('cycle', True))}, {out('day:t')} "
        f"from ({latest(*cycle)})",
        "top1_per_key": f"select user_sk, {out('day:t recovery_score:r')}, l_orderkey from ("
        + latest("lines", "user_sk", "day desc, l_partkey desc, l_orderkey desc, l_linenumber desc")
        + ")",
    }

    def column(name: str, **exprs: str) -> None:
        cols = ", ".join(f"{e} as {alias}" for alias, e in exprs.items())
        q[name] = f"select user_sk, date_sk, {cols} from daily"

    def rank(c: str, order: str) -> str:
        return f"percent_rank() over (partition by user_sk order by {c} {order}) * 100"

    def rank_int(c: str, order: str) -> str:
        return f"cast(round({rank(c, order)}) as integer)"

    column("win_avg_prev29", baseline=f"round(avg(skin_temp_celsius) over ({PREV_29}), 6)")
    column("win_count_prev29", n=f"count(skin_temp_celsius) over ({PREV_29})")
    column(
        "win_percent_rank_asc",
        score_rank=rank_int("recovery_score", "asc nulls last"),
        hrv_rank=rank_int("hrv_rmssd_milli", "asc nulls last"),
        temp_rank=rank_int("skin_temp_celsius", "asc nulls last"),
    )
    column(
        "win_percent_rank_desc",
        rhr_rank=rank_int("resting_heart_rate", "desc nulls first"),
        respiratory_rank=f"round({rank('respiratory_rate', 'desc nulls first')}, 6)",
    )
    column(
        "win_count_365",
        n=f"count(*) over ({WINDOW} rows between 364 preceding and current row)",
    )
    column("win_avg_7", mean=f"round(avg(recovery_score) over ({ROWS_7}), 6)")
    column(
        "win_lag_1_3_7_14",
        **{
            f"day_{k}_change": "round(recovery_score - "
            f"lag(recovery_score, {k}) over ({WINDOW}), 6)"
            for k in (1, 3, 7, 14)
        },
    )
    column("win_stddev_7", spread=f"round(stddev_samp(recovery_score) over ({ROWS_7}), 6)")
    column("win_stddev_30", spread=f"round(stddev_samp(recovery_score) over ({ROWS_30}), 6)")
    column("win_avg_30", mean=f"round(avg(recovery_score) over ({ROWS_30}), 6)")
    column("win_lead_next", following=f"round(lead(recovery_score) over ({WINDOW}), 6)")
    column("win_count_30", n=f"count(*) over ({ROWS_30})")
    column(
        "win_count_if_30",
        optimal=f"count(*) filter (where day_strain between 6 and 14) over ({ROWS_30})",
        over=f"count(*) filter (where day_strain > 14) over ({ROWS_30})",
    )
    q["win_count_if_30"] = q["win_count_if_30"].replace(" as over", ' as "over"')
    column(
        "win_avg_dev_30",
        mean_deviation="round(avg(case when day_strain < 6 then 6 - day_strain "
        f"when day_strain > 14 then day_strain - 14 else 0 end) over ({ROWS_30}), 6)",
    )
    q["win_lag_of_window"] = (
        f"select user_sk, date_sk, round(v - lag(v, 7) over ({WINDOW}), 6) as trend from "
        f"(select *, stddev_samp(recovery_score) over ({ROWS_7}) as v from daily)"
    )
    return q


def _functions(line: str) -> dict[str, str]:
    q: dict[str, str] = {}

    def add(name: str, source: str, **exprs: str) -> None:
        cols = ", ".join(f"{e} as {alias}" for alias, e in exprs.items())
        q[name] = f"select {line}, {cols} from (select *, {source} from lineitem)"

    day = f"{inputs.DAY_EXPR} as day"
    add(
        "fn_date_of_ts",
        f"{inputs.RAW['cycle']['created_at']} as created",
        day="cast(cast(created as date) as varchar)",
    )
    add(
        "fn_dateadd_day",
        day,
        later="cast(day + 30 as varchar)",
        earlier="cast(day - 90 as varchar)",
    )
    workout = inputs.RAW["workout"]
    add(
        "fn_datediff_minute",
        f"{workout['start_time']} + INTERVAL 59 SECOND as a, {workout['end_time']} as b",
        minutes="datediff('minute', a, b)",
        minutes_back="datediff('minute', b, a)",
    )
    add("fn_date_sk", day, date_sk=DATE_SK.format("day"))
    add(
        "fn_calendar",
        day,
        day_of_week="dayofweek(day)",
        day_of_month="day(day)",
        day_of_year="dayofyear(day)",
        week_of_year="weekofyear(day)",
        month_of_year="month(day)",
        quarter_of_year="quarter(day)",
        year_number="year(day)",
    )
    add(
        "fn_day_month_name",
        day,
        day_name="strftime(day, '%a')",
        month_name="strftime(day, '%b')",
    )
    add("fn_season", day, season=SEASON.format("day"))
    add("fn_now", day, as_of=f"'{inputs.AS_OF}'", age=f"{AS_OF} - day")
    add(
        "fn_md5_key",
        "nullif(l_returnflag, 'A') as part",
        one_key="md5(cast(l_suppkey as varchar))",
        two_key="md5(concat(l_orderkey, '-', "
        "coalesce(part, '_dbt_utils_surrogate_key_null_')))",
    )
    add(
        "fn_concat_replace",
        day,
        joined="concat(l_orderkey, '|', l_suppkey)",
        digits="strftime(day, '%Y%m%d')",
    )
    add(
        "fn_round",
        "l_quantity / 4 as q, l_extendedprice / 1000 as p",
        whole="round(q)",
        two="cast(round(cast(p as decimal(18, 6)), 2) as double)",
    )
    add(
        "fn_coalesce",
        "nullif(l_quantity, 25) as q",
        zero="round(coalesce(q, 0), 6)",
        fifty="round(coalesce(q, 50), 6)",
    )
    add(
        "fn_nullif_div",
        "l_quantity as q, l_quantity - 25 as z",
        ratio="case when z <> 0 then round(q / z, 6) end",
    )

    def value(expr: str) -> str:
        return f"case when l_linenumber = 1 then null else {expr} end as v"

    add(
        "fn_clamp",
        value("l_quantity * 10 - 250"),
        v2="case when v < -100 then -100e0 when v > 100 then 100e0 else v end",
    )
    add(
        "fn_weighted",
        "l_quantity as a, l_discount * 100 as b, l_tax * 100 as c",
        score="round(0.45e0 * a + 0.35e0 * b + 0.2e0 * c, 6)",
    )
    shifted = value("l_quantity - 25")
    color = "case when v < -20 then 'red' when v < 0 then 'orange' else 'green' end"
    add("fn_abs_fillna", shifted, size="coalesce(abs(v), 1)")
    add(
        "fn_sign_bucket",
        shifted,
        gap=color,
        sign="case when v > 0 then 'green' else 'red' end",
    )
    add("client_lambda", shifted, color=color)
    add(
        "fn_bucket_momentum",
        value("(l_quantity - 25) / 10"),
        label=label("v", ">", MOMENTUM, "Deteriorating"),
    )
    add(
        "fn_bucket_volatility",
        value("l_quantity / 2"),
        label=label("v", "<", VOLATILITY, "Very Volatile"),
    )
    add(
        "fn_bucket_balance",
        value("l_quantity * 2"),
        label=label("v", ">=", BALANCE, "Very Poor Balance"),
    )
    add(
        "fn_bucket_efficiency",
        value("(l_quantity - 25) / 20"),
        label=label("v", ">", EFFICIENCY, "Very Poor"),
    )
    add("fn_bucket_season", shifted, label=label("v", ">", ADAPTATION, "Poorly Adapted"))
    add(
        "fn_bucket_sustain",
        value("l_quantity / 50"),
        label=label("v", ">", SUSTAIN, "Unsustainable"),
    )
    add("fn_bucket_gap", shifted, label=gap_label("v"))
    add("fn_step_score", value("l_quantity / 3"), label=step_score("v"))
    add(
        "fn_bucket_strain",
        "21 * l_quantity / 50 as strain, "
        "case when l_linenumber = 1 then null else 6 end as low, "
        "case when l_linenumber <= 2 then null else 14 end as high",
        zone="case when strain < low then 'Under' "
        "when strain between low and high then 'Optimal' when strain > high then 'Over' end",
        deviation="round(case when strain < low then low - strain "
        "when strain > high then strain - high else 0 end, 6)",
    )
    add(
        "fn_risk_flag",
        "case when l_linenumber = 1 then null else l_quantity - 60 end as gap, "
        "210 * l_discount as recent",
        risk="coalesce(gap < -30 and round(recent, 6) > 14, false)",
    )
    q["fn_md5_recovery_key"] = (
        "select md5(concat(source_cycle_id, '-', source_user_id)) as recovery_sk, user_sk, "
        "date_sk, source_cycle_id from fact_recovery"
    )
    q["fn_hash64_key"] = (
        "select count(*) as inputs, count(*) as keys from "
        "(select distinct cycle_id, user_id from stg_recovery)"
    )
    return q


def statements() -> dict[str, str]:
    """All statements, each with the shared subqueries it needs."""
    named = _named()
    bodies = {
        **_models(),
        **_quality(),
        **_streams_and_documented(),
        **_sources(),
        **_operators(),
    }

    def mentioned(sql: str) -> list[str]:
        return [n for n in named if re.search(rf"\b{n}\b", sql)]

    def with_clause(sql: str) -> str:
        needed: set[str] = set()
        queue = mentioned(sql)
        while queue:
            name = queue.pop()
            if name not in needed:
                needed.add(name)
                queue += [n for n in mentioned(named[name]) if n != name]
        shared = ", ".join(f"{n} as ({named[n]})" for n in named if n in needed)
        if not shared:
            return sql
        own = sql.strip()
        if own.startswith("with "):
            return f"with {shared}, {own[5:]}"
        return f"with {shared} {own}"

    return {name: with_clause(sql) for name, sql in bodies.items()}
