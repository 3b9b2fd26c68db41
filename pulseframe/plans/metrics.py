"""The seven metric tables over the daily facts.

All results are per user and day. A fact holds one row per user and day, so the
per-user frames are bounded by the calendar. Every fact is shuffled once, by user.

Measures are computed in double; labels test values rounded to six decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions import labels
from pulseframe.functions.compat import clamp, safe_divide, weighted_sum
from pulseframe.operators import moments, series
from pulseframe.operators.series import DAY, USER

# Lags and weights of the momentum, weights and default of the
# balance score, weights of the seasonal index, and the divisor of both sums.
MOMENTUM_WEIGHTS = {1: 0.4, 3: 0.3, 7: 0.2, 14: 0.1}
MOMENTUM_SCALE, MOMENTUM_BOUND = 10, 100.0
BALANCE_WEIGHTS = {"hrv_percentile": 0.45, "rhr_percentile": 0.35, "respiratory_percentile": 0.20}
BALANCE_DEFAULT = 50
SEASON_WEIGHTS = {
    "recovery_deviation": 0.4,
    "hrv_deviation": 0.3,
    "rhr_deviation": 0.2,
    "skin_temp_deviation": 0.1,
}
WEIGHTED_TERMS = 4
# Frame lengths in rows.
SHORT_ROWS, LONG_ROWS = 7, 30
BASELINE_ROWS = 7
RECENT_STRAIN_ROWS = 6
TREND_LAG = 7


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def recovery_momentum(fact_recovery: DataFrame) -> DataFrame:
    """Weighted change of the recovery score over 1, 3, 7 and 14 rows."""
    changes = {k: f"day_{k}_change" for k in MOMENTUM_WEIGHTS}
    changed = fact_recovery.select(
        USER,
        DAY,
        "recovery_score",
        *[series.change("recovery_score", k).alias(name) for k, name in changes.items()],
    )
    terms = [
        (F.coalesce(_double(changes[k]), F.lit(0.0)), weight)
        for k, weight in MOMENTUM_WEIGHTS.items()
    ]
    raw = F.col("raw_momentum")
    return changed.withColumn("raw_momentum", weighted_sum(terms) / WEIGHTED_TERMS).select(
        "*",
        clamp(raw * MOMENTUM_SCALE, -MOMENTUM_BOUND, MOMENTUM_BOUND).alias(
            "recovery_momentum_score"
        ),
        labels.momentum(raw).alias("momentum_category"),
    )


def recovery_volatility(fact_recovery: DataFrame) -> DataFrame:
    """Standard deviation over 7 and 30 rows, relative to the mean, and its trend."""
    score = _double("recovery_score")
    spread = fact_recovery.select(
        USER,
        DAY,
        "recovery_score",
        F.stddev_samp(score).over(series.last_rows(SHORT_ROWS)).alias("volatility_7d"),
        F.stddev_samp(score).over(series.last_rows(LONG_ROWS)).alias("volatility_30d"),
        F.avg(score).over(series.last_rows(LONG_ROWS)).alias("_mean"),
    )
    return spread.select(
        USER,
        DAY,
        "recovery_score",
        "volatility_7d",
        "volatility_30d",
        safe_divide("volatility_30d", "_mean").alias("volatility_coefficient"),
        series.change("volatility_7d", TREND_LAG).alias("volatility_trend"),
        labels.volatility(F.col("volatility_30d")).alias("volatility_category"),
    )


def autonomic_balance(fact_recovery: DataFrame) -> DataFrame:
    """Weighted percentiles of heart-rate variability, resting rate and breathing."""
    measured = fact_recovery.filter(
        F.col("hrv_rmssd").isNotNull() & F.col("resting_heart_rate").isNotNull()
    ).select(
        USER,
        DAY,
        "recovery_score",
        "hrv_rmssd",
        "hrv_percentile",
        "resting_heart_rate",
        "rhr_percentile",
        "respiratory_rate",
        series.percent_rank("respiratory_rate", descending=True).alias("respiratory_percentile"),
        safe_divide(_double("hrv_rmssd"), _double("resting_heart_rate")).alias("hrv_rhr_ratio"),
    )
    terms = [
        (F.coalesce(_double(c), F.lit(float(BALANCE_DEFAULT))), weight)
        for c, weight in BALANCE_WEIGHTS.items()
    ]
    score = F.round(F.round(weighted_sum(terms), 9), 2)
    scored = measured.select(
        "*",
        F.avg("hrv_rhr_ratio").over(series.last_rows(SHORT_ROWS)).alias("hrv_rhr_ratio_7d_avg"),
        score.alias("autonomic_balance_score"),
    )
    return scored.withColumn(
        "balance_category", labels.balance(F.col("autonomic_balance_score"))
    )


def strain_recovery_efficiency(
    fact_strain: DataFrame, fact_recovery: DataFrame, calendar_days: bool = False
) -> DataFrame:
    """Recovery gained over the recent mean, per unit of strain.

    The next recovery is that of the user's next strain row. ``calendar_days``
    accepts it only if that row is the next calendar day.
    """
    pairs = series.beside(
        fact_strain.select(USER, DAY, _double("day_strain").alias("day_strain")),
        fact_recovery,
        ["recovery_score"],
    )
    ahead = series.by_day()
    following = F.lead("recovery_score").over(ahead)
    if calendar_days:
        day = F.to_date(F.col(DAY).cast("string"), "yyyyMMdd")
        following = F.when(F.lead(day).over(ahead) == F.date_add(day, 1), following)
    # The mean runs over matched rows only. An unmatched row has no such mean;
    # its own frame holds nulls and is kept apart per user, not in one null group.
    matched_before = series.previous_rows(BASELINE_ROWS, USER, DAY, "_matched")
    signals = pairs.select(
        USER,
        DAY,
        "day_strain",
        "recovery_score",
        following.alias("next_day_recovery"),
        F.avg(_double("recovery_score")).over(matched_before).alias("baseline_recovery"),
    )
    gained = _double("next_day_recovery") - F.col("baseline_recovery")
    strain = F.col("day_strain")
    rated = signals.withColumn("recovery_efficiency_ratio", F.when(strain > 0, gained / strain))
    ratio = F.col("recovery_efficiency_ratio")
    return rated.select(
        "*",
        F.avg(ratio).over(series.last_rows(LONG_ROWS)).alias("efficiency_30day_avg"),
        labels.efficiency(ratio).alias("efficiency_category"),
    )


def strain_sustainability(fact_strain: DataFrame) -> DataFrame:
    """Share of the last 30 rows inside the optimal strain range.

    Rows without an upper limit take no part, so the result is empty unless the
    fact was built with optimal strain limits.
    """
    strain, low, high = (
        _double(c) for c in ("day_strain", "optimal_strain_min", "optimal_strain_max")
    )
    zoned = fact_strain.filter(F.col("optimal_strain_max").isNotNull()).select(
        USER,
        DAY,
        "day_strain",
        "optimal_strain_min",
        "optimal_strain_max",
        labels.strain_zone(strain, low, high).alias("strain_category"),
        labels.strain_distance(strain, low, high).alias("strain_deviation"),
    )
    frame = series.last_rows(LONG_ROWS)

    def days(zone: str) -> Column:
        return F.count(F.when(F.col("strain_category") == zone, 1)).over(frame)

    total = F.count("*").over(frame)
    rolled = zoned.select(
        "*",
        (days("Optimal") / total).alias("_optimal"),
        (days("Over") / total).alias("_over"),
        F.avg("strain_deviation").over(frame).alias("avg_deviation_30d"),
    )
    score = F.round(F.round(100 * F.col("_optimal") - 50 * F.col("_over"), 9), 2)
    return rolled.select(
        *zoned.columns,
        score.alias("sustainability_score_30d"),
        labels.sustainability(F.col("_optimal")).alias("sustainability_category"),
    )


def training_readiness_gap(fact_recovery: DataFrame, fact_strain: DataFrame) -> DataFrame:
    """Recovery score against the training load the optimal strain stands for."""
    signals = series.beside(
        fact_recovery.select(USER, DAY, "recovery_score"),
        fact_strain,
        ["day_strain", "optimal_strain_min", "optimal_strain_max"],
    )
    matched_before = series.previous_rows(RECENT_STRAIN_ROWS, USER, DAY, "_matched")
    target = (_double("optimal_strain_min") + _double("optimal_strain_max")) / 2
    rated = signals.select(
        USER,
        DAY,
        "recovery_score",
        F.col("recovery_score").alias("body_readiness"),
        target.alias("optimal_strain_target"),
        labels.training_step(target).alias("training_recommendation_score"),
        F.avg(_double("day_strain")).over(matched_before).alias("_recent_strain"),
    ).withColumn(
        "readiness_motivation_gap",
        F.col("recovery_score") - F.col("training_recommendation_score"),
    )
    gap = F.col("readiness_motivation_gap")
    risk = labels.overtraining_risk(_double("readiness_motivation_gap"), F.col("_recent_strain"))
    return rated.select(
        USER,
        DAY,
        "recovery_score",
        "body_readiness",
        "optimal_strain_target",
        "training_recommendation_score",
        "readiness_motivation_gap",
        labels.readiness_gap(gap).alias("gap_category"),
        risk.alias("overtraining_risk_flag"),
    )


SEASON_MEASURES = {
    "recovery": "recovery_score",
    "hrv": "hrv_rmssd",
    "rhr": "resting_heart_rate",
    "skin_temp": "skin_temp_celsius",
}


def season_years(dated: DataFrame) -> DataFrame:
    """Means, spread and size per user, season and year."""
    return dated.groupBy(USER, "season", "year_number").agg(
        *[F.avg(_double(c)).alias(f"avg_{name}") for name, c in SEASON_MEASURES.items()],
        F.stddev_samp(_double("recovery_score")).alias("recovery_stddev"),
        F.count("*").alias("sample_size"),
    )


SEASON_KEYS = (USER, "season", "year_number")


def season_moments(dated: DataFrame, sign: Column | None = None) -> DataFrame:
    """State of every user, season and year, which new days are merged into."""
    return moments.moments(dated, SEASON_KEYS, list(SEASON_MEASURES.values()), sign)


def season_years_from(state: DataFrame) -> DataFrame:
    """:func:`season_years` from its state."""
    return state.filter("rows > 0").select(
        *SEASON_KEYS,
        *[moments.mean(c).alias(f"avg_{name}") for name, c in SEASON_MEASURES.items()],
        moments.deviation("recovery_score").alias("recovery_stddev"),
        F.col("rows").alias("sample_size"),
    )


def season_baselines(years: DataFrame) -> DataFrame:
    """Mean of the yearly means per user and season: every year weighs the same."""
    return years.groupBy(USER, "season").agg(
        *[F.avg(f"avg_{name}").alias(f"seasonal_{name}_baseline") for name in SEASON_MEASURES]
    )


def with_season(fact_recovery: DataFrame, dim_date: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    days = dim_date.select(DAY, "season", "year_number")
    return fact_recovery.select(USER, DAY, *SEASON_MEASURES.values(), *keep).join(days, DAY)


def seasonal_adaptation(fact_recovery: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Deviation from the user's own baseline of the season.

    The baseline is that of :func:`season_baselines`, taken here as frames over
    the user's rows: one shuffle by user and one sort serve both levels, and no
    aggregate is joined back.
    """
    dated = with_season(fact_recovery, dim_date).repartition(USER)
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    in_year = Window.partitionBy(USER, "season", "year_number").orderBy(DAY)
    in_season = Window.partitionBy(USER, "season").orderBy("year_number", DAY)
    yearly = dated.select(
        "*",
        (F.row_number().over(in_year) == 1).alias("_first"),
        *[
            F.avg(_double(c)).over(in_year.rowsBetween(*everything)).alias(f"_avg_{name}")
            for name, c in SEASON_MEASURES.items()
        ],
    )
    # One row stands for each year, so that every year weighs the same.
    compared = yearly.select(
        USER,
        DAY,
        "season",
        *SEASON_MEASURES.values(),
        *[
            F.avg(F.when(F.col("_first"), F.col(f"_avg_{name}")))
            .over(in_season.rowsBetween(*everything))
            .alias(f"seasonal_{name}_baseline")
            for name in SEASON_MEASURES
        ],
    )
    return _adapted(compared)


def adaptation_from(dated: DataFrame, baselines: DataFrame) -> DataFrame:
    """:func:`seasonal_adaptation` of some days (see :func:`with_season`) from :func:`season_baselines`."""
    return _adapted(dated.join(baselines, [USER, "season"]))


def _adapted(compared: DataFrame) -> DataFrame:
    """Deviations of days from the baselines beside them."""
    deviations = {
        f"{name}_deviation": _double(c) - F.col(f"seasonal_{name}_baseline")
        for name, c in SEASON_MEASURES.items()
    }
    deviations["rhr_deviation"] = -deviations["rhr_deviation"]
    index = weighted_sum([(deviations[n], w) for n, w in SEASON_WEIGHTS.items()]) / WEIGHTED_TERMS
    deviation = deviations["recovery_deviation"]
    return compared.select(
        USER,
        DAY,
        "season",
        "recovery_score",
        "seasonal_recovery_baseline",
        deviation.alias("recovery_deviation"),
        F.round(F.round(index, 9), 2).alias("seasonal_adaptation_index"),
        labels.adaptation(deviation).alias("adaptation_category"),
    )


def with_calculated_at(metric: DataFrame, run_at: Column) -> DataFrame:
    """Audit column of a metric table."""
    return metric.withColumn("calculated_at", run_at.cast("timestamp_ntz"))
