"""Staging, facts and metrics on hand-made records, against plain Python."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pulseframe.functions.compat import date_key
from pulseframe.operators import series
from pulseframe.plans import dims, facts, metrics, reports, staging
from pulseframe.sources.specs import SOURCES

START = dt.datetime(2024, 1, 1, 7)


def raw(spark, source, records):
    """Raw frame; absent columns are null."""
    schema = SOURCES[source].raw_schema
    rows = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(rows, schema)


def at(day, hours=0):
    return START + dt.timedelta(days=day, hours=hours)


def users(spark, *ids):
    data = [{"user_id": u, "created_at": START} for u in ids]
    return dims.dim_user(staging.stage_user(raw(spark, "user", data)))


def recovery(day, score, user="u", temp=33.0, hrv=50.0, rhr=55.0, **more):
    return {
        "cycle_id": f"{user}{day}",
        "user_id": user,
        "created_at": at(day),
        "updated_at": at(day),
        "recovery_score": score,
        "skin_temp_celsius": temp,
        "hrv_rmssd_milli": hrv,
        "resting_heart_rate": rhr,
        **more,
    }


def staged(spark, source, records, **options):
    return staging.stage(raw(spark, source, records), source, **options)


def by_day(df, *cols):
    return [tuple(r) for r in df.orderBy("user_sk", "date_sk").select(*cols).collect()]


def test_staging_rounds_converts_and_dedups(spark):
    sleep = {
        "id": "s",
        "user_id": "u",
        "created_at": at(0),
        "updated_at": at(0),
        "total_in_bed_time_milli": 27_000_000,
        "total_awake_time_milli": 90_000,
        "sleep_performance_percentage": 84.5,
        "respiratory_rate": 15.4,
    }
    newer = {**sleep, "updated_at": at(1), "sleep_performance_percentage": 90.0}
    row = staged(spark, "sleep", [newer, sleep]).first()
    assert (float(row.total_in_bed_time_milli), float(row.total_awake_time_milli)) == (7.5, 1.5)
    assert (row.sleep_performance_percentage, row.respiratory_rate) == (90, 15)
    exact = staged(spark, "sleep", [sleep], keep_fractions=True).first()
    assert exact.sleep_performance_percentage == 84.5
    workout = staged(spark, "workout", [{"id": "w", "sport_id": 63, "zone_one_milli": 30_000}])
    assert workout.first().sport_id == "63" and float(workout.first().zone_one_milli) == 0.5


def test_staging_after_target(spark):
    first = staged(spark, "recovery", [recovery(0, 50.0)])
    rows = [recovery(0, 60.0), recovery(1, 70.0)]
    batch = staged(spark, "recovery", rows, target=first).collect()
    assert [(r.cycle_id, r.recovery_score) for r in batch] == [("u1", 70)]


def test_user_profiles_are_not_deduplicated(spark):
    assert users(spark, "u", "u").count() == 2


def percent_rank(xs, x, descending=False):
    below = sum((y > x) if descending else (y < x) for y in xs)
    return round(100 * below / (len(xs) - 1) + 1e-9)


def test_percentiles(spark):
    rng = random.Random(5)
    scores = [float(rng.randint(1, 99)) for _ in range(80)]
    temps = [float(rng.randint(30, 36)) for _ in range(80)]
    records = [
        recovery(i, s, temp=t, hrv=s + 1, rhr=100 - s)
        for i, (s, t) in enumerate(zip(scores, temps, strict=True))
    ]
    # Neither a missing score nor a missing temperature takes part.
    records += [recovery(90, None), recovery(91, 50.0, temp=None), recovery(3, 9.0, user="x")]
    df = facts.recovery_percentiles(
        staged(spark, "recovery", records), users(spark, "u", "u"), dims.dim_date(spark)
    )
    got = by_day(
        df,
        "recovery_score_percentile",
        "hrv_percentile",
        "rhr_percentile",
        "skin_temp_deviation",
        "days_of_history",
    )
    assert len(got) == 80
    for i, (p, hrv, rhr, deviation, history) in enumerate(got):
        before = temps[max(0, i - 29) : i]
        want = round(temps[i] - sum(before) / len(before), 2) if len(before) >= 14 else None
        assert deviation == pytest.approx(want, abs=0.011) if want is not None else deviation is None
        assert history == i + 1
        rank = percent_rank(scores, scores[i]) if i >= 59 else None
        assert (p, hrv, rhr) == (rank, rank, rank)


def test_percentile_gates_at_the_limits(spark):
    records = [recovery(i, 50.0) for i in range(61)]
    df = facts.recovery_percentiles(
        staged(spark, "recovery", records), users(spark, "u"), dims.dim_date(spark)
    )
    got = by_day(df, "recovery_score_percentile", "skin_temp_deviation")
    assert [p for p, _ in got] == [None] * 59 + [0, 0]
    assert [d for _, d in got] == [None] * 14 + [0.0] * 47


def test_percentile_horizon_keeps_full_ranks(spark):
    records = [recovery(i, float(i % 90)) for i in range(200)]
    inputs = (staged(spark, "recovery", records), users(spark, "u"), dims.dim_date(spark))
    full = facts.recovery_percentiles(*inputs)
    as_of = F.lit(at(199).date())
    recent = facts.recovery_percentiles(*inputs, as_of=as_of)
    kept, everything = recent.collect(), set(full.collect())
    assert len(kept) == 91 and set(kept) <= everything


def sleep_record(id, day, nap, performance, hours=0):
    return {
        "id": id,
        "user_id": "u",
        "created_at": at(day),
        "updated_at": at(day, hours),
        "nap": nap,
        "sleep_performance_percentage": performance,
        "respiratory_rate": 14.0,
    }


def test_recovery_fact(spark):
    records = [
        recovery(0, 50.0),
        {**recovery(0, 60.0), "cycle_id": "later", "updated_at": at(0, 5)},
        recovery(1, 70.0, hrv=45.0),
        recovery(2, None),
        recovery(3, 80.0, user="stranger"),
        recovery(4000, 80.0),
    ]
    sleeps = [
        sleep_record("nap", 0, True, 99.0, hours=9),
        sleep_record("night", 0, False, 80.0),
        sleep_record("night2", 0, False, 85.0, hours=1),
    ]
    stg = staged(spark, "recovery", records)
    dim_user, dim_date = users(spark, "u"), dims.dim_date(spark)
    ranks = facts.recovery_percentiles(stg, dim_user, dim_date)
    args = (stg, dim_user, dim_date, ranks, staged(spark, "sleep", sleeps))
    fact = facts.fact_daily_recovery(*args)
    assert len(fact.columns) == 19
    rows = fact.orderBy("date_sk").collect()
    assert [(r.date_sk, float(r.recovery_score)) for r in rows] == [(20240101, 60), (20240102, 70)]
    assert rows[0].source_cycle_id == "later"
    assert float(rows[0].sleep_performance_percentage) == 85
    assert rows[1].sleep_performance_percentage is None
    assert float(rows[1].hrv_rmssd) == 0.045
    assert fact.schema["recovery_score"].dataType.simpleString() == "decimal(5,2)"
    later = facts.fact_daily_recovery(stg.filter("created_at >= '2024-01-02'"), *args[1:])
    assert [r.date_sk for r in later.collect()] == [20240102]


@pytest.mark.parametrize("unique", [(), ("skin_temp_celsius",), ("recovery_score", "resting_heart_rate")])
def test_days_of_unique_recoveries_need_no_hash(spark, unique):
    """Records of a day with the same times, null ids and times, and versions of a record."""
    records = [{**recovery(d, 50.0 + k, temp=None if k == 3 else 33.0 + k), "cycle_id": f"{d}-{k}"} for d in range(70) for k in range(4)]
    records += [
        {**recovery(0, 90.0), "cycle_id": None, "updated_at": at(0, 1)},
        {**recovery(1, 91.0), "cycle_id": "none", "updated_at": None},
        {**recovery(2, 92.0, temp=None), "cycle_id": "2-0", "updated_at": at(2, 9)},
        recovery(3, 93.0, user=None),
        {**recovery(4, 94.0), "cycle_id": "zz"},
    ]
    records += records[:8]
    stg, dim_user, dim_date = staged(spark, "recovery", records), users(spark, "u"), dims.dim_date(spark)
    sleeps = staged(spark, "sleep", [])
    found = []
    for u in (None, unique):
        ranks = facts.recovery_percentiles(stg, dim_user, dim_date, keep=facts.RECORD_KEYS, unique=u)
        fact = facts.fact_daily_recovery(stg, dim_user, dim_date, ranks, sleeps, unique=u)
        found.append([sorted(map(str, t.collect())) for t in (ranks, fact)])
    assert found[0] == found[1] and len(found[0][1]) == 70


def cycle(day, strain, user="u", updated=None, **more):
    return {
        "id": f"c{user}{day}",
        "user_id": user,
        "created_at": at(day),
        "updated_at": updated or at(day),
        "strain": strain,
        "kilojoule": 1000.4,
        **more,
    }


def workout(id, day, strain, sport, minutes, updated=None):
    return {
        "id": id,
        "user_id": "u",
        "created_at": at(day),
        "updated_at": updated or at(day),
        "start_time": at(day),
        "end_time": at(day) + dt.timedelta(minutes=minutes),
        "strain": strain,
        "sport_name": sport,
        "zone_zero_milli": 60_000,
    }


def test_strain_fact(spark):
    cycles = [cycle(0, 10.4), {**cycle(0, 12.0), "id": "z", "updated_at": at(0, 2)}, cycle(1, 5.0)]
    workouts = [
        workout("a", 0, 4.0, "run", 30),
        workout("b", 0, 6.0, "bike", 45),
        workout("c", 0, 1.0, "run", 5),
        workout("d", 0, 1.0, None, 5),
    ]
    dim_user, dim_date = users(spark, "u"), dims.dim_date(spark)
    args = (staged(spark, "cycle", cycles), staged(spark, "workout", workouts), dim_user, dim_date)
    fact = facts.fact_daily_strain(*args, run_at=F.lit("2024-05-01"))
    assert len(fact.columns) == 24
    a, b = fact.orderBy("date_sk").collect()
    assert (a.day_strain, a.workout_strain, a.workout_count, a.max_workout_strain) == (12, 12, 4, 6)
    assert (a.total_workout_minutes, float(a.zone_0_minutes)) == (85, 4.0)
    assert a.workout_types == ["bike", "run"] and a.calories_burned == 1000
    assert (b.workout_strain, b.workout_count, b.total_workout_minutes) == (0, 0, None)
    assert b.workout_types is None and b.optimal_strain_min is None
    assert fact.schema["optimal_strain_min"].dataType.simpleString() == "double"

    limits = spark.createDataFrame(
        [("u", at(0).date(), 6.0, 14.0)],
        "user_id string, day date, optimal_strain_min double, optimal_strain_max double",
    )
    filled = facts.fact_daily_strain(*args, optimal_strain=limits).orderBy("date_sk").collect()
    assert [r.optimal_strain_max for r in filled] == [14.0, None]


def test_strain_fact_increment_and_late_workouts(spark):
    dim = (users(spark, "u"), dims.dim_date(spark))
    cycles = staged(spark, "cycle", [cycle(0, 10.0), cycle(1, 5.0)])
    before = staged(spark, "workout", [workout("a", 0, 4.0, "run", 30)])
    target = facts.fact_daily_strain(cycles, before, *dim)
    since = target.agg(F.max("source_updated_at")).first()[0]
    late = staged(
        spark,
        "workout",
        [workout("a", 0, 4.0, "run", 30), workout("b", 0, 2.0, "run", 10, updated=at(5))],
    )
    more = staged(spark, "cycle", [cycle(0, 10.0), cycle(1, 5.0), cycle(2, 7.0)])
    plain = facts.fact_daily_strain(more, late, *dim, since=since)
    assert [r.date_sk for r in plain.collect()] == [20240103]
    wide = facts.fact_daily_strain(more, late, *dim, since=since, late_workouts=True)
    got = {r.date_sk: r.workout_count for r in wide.collect()}
    assert got == {20240101: 2, 20240103: 0}


FACT_SCHEMA = (
    "user_sk string, date_sk int, recovery_score double, hrv_rmssd double, hrv_percentile int, "
    "resting_heart_rate int, rhr_percentile int, respiratory_rate double, skin_temp_celsius double"
)


def fact_frame(spark, user, days, scores, **more):
    rows = []
    for i, (d, s) in enumerate(zip(days, scores, strict=True)):
        day = (dt.datetime(2024, 1, 1) + dt.timedelta(days=d)).strftime("%Y%m%d")
        extra = {k: v[i] for k, v in more.items()}
        rows.append(
            (
                user,
                int(day),
                s,
                extra.get("hrv", 0.05),
                extra.get("hrv_p"),
                extra.get("rhr", 50),
                extra.get("rhr_p"),
                extra.get("resp", 14.0),
                extra.get("temp", 33.0),
            )
        )
    return spark.createDataFrame(rows, FACT_SCHEMA)


def test_momentum(spark):
    scores = [float(x) for x in (50, 55, 40, 70, 65, 60, 58, 90, 20, 30, 35, 60, 61, 62, 95)]
    df = fact_frame(spark, "u", range(15), scores).unionByName(
        fact_frame(spark, "v", range(3), [99.0, 1.0, 99.0])
    )
    got = by_day(
        metrics.recovery_momentum(df).filter("user_sk = 'u'"),
        "day_1_change",
        "day_3_change",
        "day_7_change",
        "day_14_change",
        "raw_momentum",
        "recovery_momentum_score",
    )
    for i, row in enumerate(got):
        changes = [scores[i] - scores[i - k] if i >= k else None for k in (1, 3, 7, 14)]
        assert list(row[:4]) == changes
        raw = sum((c or 0) * w for c, w in zip(changes, (0.4, 0.3, 0.2, 0.1), strict=True)) / 4
        assert row[4] == pytest.approx(raw)
        assert row[5] == pytest.approx(max(-100, min(100, raw * 10)))


def test_volatility_counts_rows_not_days(spark):
    rng = random.Random(3)
    scores = [float(rng.randint(20, 95)) for _ in range(45)]
    gaps = [2 * i for i in range(45)]
    df = metrics.recovery_volatility(fact_frame(spark, "u", gaps, scores))
    got = by_day(df, "volatility_7d", "volatility_30d", "volatility_coefficient", "volatility_trend")
    week = [None if i == 0 else statistics.stdev(scores[max(0, i - 6) : i + 1]) for i in range(45)]
    for i, row in enumerate(got):
        month = scores[max(0, i - 29) : i + 1]
        spread = statistics.stdev(month) if i else None
        trend = week[i] - week[i - 7] if i >= 8 else None
        for value, want in zip(
            row,
            (week[i], spread, spread / statistics.mean(month) if i else None, trend),
            strict=True,
        ):
            assert value == pytest.approx(want) if want is not None else value is None


def test_volatility_of_one_row_and_zero_mean(spark):
    one = metrics.recovery_volatility(fact_frame(spark, "u", [0], [50.0])).first()
    assert one.volatility_30d is None and one.volatility_category == "Very Volatile"
    zeros = metrics.recovery_volatility(fact_frame(spark, "u", [0, 1], [0.0, 0.0]))
    assert [r.volatility_coefficient for r in zeros.collect()] == [None, None]


def test_autonomic_balance(spark):
    df = fact_frame(
        spark,
        "u",
        range(4),
        [50.0] * 4,
        hrv=[0.05, 0.06, None, 0.08],
        hrv_p=[90, None, 10, 100],
        rhr=[50, 0, 55, 40],
        rhr_p=[80, None, 10, 100],
        resp=[12.0, 14.0, 15.0, None],
    )
    got = metrics.autonomic_balance(df).orderBy("date_sk").collect()
    assert len(got) == 3
    # Descending with nulls first: none 0, 14 next 50, 12 last 100.
    assert [r.respiratory_percentile for r in got] == [100.0, 50.0, 0.0]
    assert [r.autonomic_balance_score for r in got] == [88.5, 50.0, 80.0]
    assert got[1].hrv_rhr_ratio is None
    assert got[2].hrv_rhr_ratio_7d_avg == pytest.approx((0.05 / 50 + 0.08 / 40) / 2)
    assert [r.balance_category for r in got] == [
        "Excellent Balance",
        "Moderate Balance",
        "Excellent Balance",
    ]


def strain_frame(spark, user, days, strains, low=None, high=None):
    rows = []
    for d, s in zip(days, strains, strict=True):
        day = (dt.datetime(2024, 1, 1) + dt.timedelta(days=d)).strftime("%Y%m%d")
        rows.append((user, int(day), s, low, high))
    return spark.createDataFrame(
        rows,
        "user_sk string, date_sk int, day_strain double, optimal_strain_min double, "
        "optimal_strain_max double",
    )


def test_efficiency(spark):
    rng = random.Random(9)
    strains = [float(rng.randint(0, 20)) for _ in range(40)]
    scores = {i: float(rng.randint(20, 95)) for i in range(40) if i % 5 != 2}
    strain = strain_frame(spark, "u", range(40), strains).unionByName(
        strain_frame(spark, "lonely", range(3), [5.0, 6.0, 7.0])
    )
    recovery_days = fact_frame(spark, "u", list(scores), list(scores.values()))
    df = metrics.strain_recovery_efficiency(strain, recovery_days)
    got = by_day(
        df.filter("user_sk = 'u'"),
        "next_day_recovery",
        "baseline_recovery",
        "recovery_efficiency_ratio",
        "efficiency_30day_avg",
    )
    ratios = []
    for i, row in enumerate(got):
        following = scores.get(i + 1)
        earlier = [scores[j] for j in sorted(scores) if j < i][-7:]
        baseline = sum(earlier) / len(earlier) if earlier and i in scores else None
        known = following is not None and baseline is not None and strains[i] > 0
        ratio = (following - baseline) / strains[i] if known else None
        ratios.append(ratio)
        recent = [r for r in ratios[-30:] if r is not None]
        mean = sum(recent) / len(recent) if recent else None
        for value, want in zip(row, (following, baseline, ratio, mean), strict=True):
            assert value == pytest.approx(want) if want is not None else value is None
    lonely = df.filter("user_sk = 'lonely'").collect()
    assert [r.baseline_recovery for r in lonely] == [None] * 3
    assert {r.efficiency_category for r in lonely} == {"Very Poor"}


def test_efficiency_by_calendar_day(spark):
    strain = strain_frame(spark, "u", [0, 1, 3], [5.0, 5.0, 5.0])
    recovery_days = fact_frame(spark, "u", [0, 1, 3], [50.0, 60.0, 70.0])
    rows = metrics.strain_recovery_efficiency(strain, recovery_days)
    assert by_day(rows, "next_day_recovery") == [(60.0,), (70.0,), (None,)]
    strict = metrics.strain_recovery_efficiency(strain, recovery_days, calendar_days=True)
    assert by_day(strict, "next_day_recovery") == [(60.0,), (None,), (None,)]


def test_sustainability(spark):
    assert metrics.strain_sustainability(strain_frame(spark, "u", [0], [5.0])).isEmpty()
    strains = [float(i % 20) for i in range(50)]
    df = metrics.strain_sustainability(strain_frame(spark, "u", range(50), strains, 6.0, 14.0))
    got = by_day(df, "strain_category", "strain_deviation", "sustainability_score_30d")
    for i, (zone, deviation, score) in enumerate(got):
        s = strains[i]
        assert zone == ("Under" if s < 6 else "Over" if s > 14 else "Optimal")
        assert deviation == max(6 - s, s - 14, 0)
        frame = strains[max(0, i - 29) : i + 1]
        good = sum(6 <= x <= 14 for x in frame) / len(frame)
        over = sum(x > 14 for x in frame) / len(frame)
        assert score == pytest.approx(100 * good - 50 * over, abs=0.0051)


def test_readiness(spark):
    scores = [20.0, 90.0, 45.0, 20.0, 20.0, 20.0, 20.0, 20.0, 20.0]
    recovery_days = fact_frame(spark, "u", range(9), scores)
    strains = [16.0, 15.0, 17.0, 16.0, 18.0, 19.0, 20.0, 13.0]
    strain = strain_frame(spark, "u", [0, 1, 2, 3, 4, 5, 7, 8], strains, 10.0, 16.0)
    df = metrics.training_readiness_gap(recovery_days, strain)
    got = by_day(
        df, "optimal_strain_target", "training_recommendation_score", "overtraining_risk_flag"
    )
    assert got[0] == (13.0, 70, False)
    # No strain that day: no target, lowest step, no risk.
    assert got[6] == (None, 10, False)
    assert [flag for _, _, flag in got] == [
        False,
        False,
        False,
        True,
        True,
        True,
        False,
        True,
        True,
    ]


def test_seasons_weigh_years_equally(spark):
    days = [0, 1, 2, 366, 367]
    scores = [10.0, 20.0, 30.0, 80.0, 100.0]
    df = fact_frame(spark, "u", days, scores, temp=[33.0, None, 33.0, 33.0, 33.0])
    got = metrics.seasonal_adaptation(df, dims.dim_date(spark)).orderBy("date_sk").collect()
    assert {r.seasonal_recovery_baseline for r in got} == {55.0}
    assert [r.recovery_deviation for r in got] == [-45.0, -35.0, -25.0, 25.0, 45.0]
    assert got[1].seasonal_adaptation_index is None
    assert got[4].seasonal_adaptation_index == pytest.approx(4.5)
    assert [r.adaptation_category for r in got][-1] == "Thriving"


def test_reports(spark, day):
    df = fact_frame(spark, "u", range(30), [float(i) for i in range(30)]).unionByName(
        fact_frame(spark, "v", range(5), [1.0] * 5)
    )
    momentum = metrics.recovery_momentum(df)
    dim = dims.dim_date(spark)
    as_of = F.lit("2024-01-30").cast("date")
    week = reports.report("momentum", momentum, dim, as_of, 7)
    assert [str(r.date_day) for r in week.collect()] == [f"2024-01-{d}" for d in range(23, 31)]
    assert tuple(week.columns) == ("user_sk", "date_day", *reports.REPORT_COLUMNS["momentum"])
    everything = reports.report_rows("momentum", momentum, dim)
    assert everything.count() == 35
    latest = {r.user_sk: r for r in reports.current_values(everything, "momentum").collect()}
    assert str(latest["u"].date_day) == "2024-01-30"
    assert str(latest["v"].date_day) == "2024-01-05"
    means = reports.key_means(everything, "momentum").first()
    assert means.avg_recovery_score == pytest.approx((sum(range(30)) + 5) / 35)
    counts = reports.distribution(everything, "momentum_category").collect()
    assert [r.n for r in counts] == sorted((r.n for r in counts), reverse=True)
    assert sum(r.n for r in counts) == 35


def test_series_rows_so_far_is_capped(spark, day):
    df = spark.range(10).select(
        F.lit("u").alias("user_sk"),
        date_key(F.date_add(F.lit("2024-01-28").cast("date"), F.col("id").cast("int"))).alias(
            "date_sk"
        ),
    )
    got = df.select("date_sk", series.rows_so_far(4).alias("n")).orderBy("date_sk").collect()
    assert [r.n for r in got] == [1, 2, 3, 4, 4, 4, 4, 4, 4, 4]
