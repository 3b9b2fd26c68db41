"""Scalar helpers: rounding, minutes, keys, timestamps, calendar."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from pulseframe.functions import calendar, compat, labels
from pulseframe.plans import dims


def values(spark, schema, rows, column):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_round_to_long_goes_away_from_zero(spark):
    xs = [(2.5,), (-2.5,), (14.7,), (0.5,), (-0.4,), (None,)]
    assert values(spark, "x double", xs, compat.round_to_long("x")) == [3, -3, 15, 1, 0, None]


def test_ms_units_are_exact_to_six_decimals(spark):
    ms = [(3_600_000,), (9,), (-9,), (1,), (None,)]
    hours = values(spark, "x long", ms, compat.ms_to_hours("x").cast("string"))
    assert hours == ["1.000000", "0.000003", "-0.000003", "0.000000", None]
    minutes = values(spark, "x long", ms, compat.ms_to_minutes("x").cast("string"))
    assert minutes == ["60.000000", "0.000150", "-0.000150", "0.000017", None]


def test_minutes_count_boundaries(spark, ts):
    rows = [
        (ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:00")),
        (ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:59")),
        (ts("2024-01-01 23:59:30"), ts("2024-01-02 00:10:00")),
        (ts("2024-01-02 00:10:00"), ts("2024-01-01 23:59:30")),
        (None, ts("2024-01-01 00:00:00")),
    ]
    got = values(
        spark, "a timestamp_ntz, b timestamp_ntz", rows, compat.minutes_between("a", "b")
    )
    assert got == [1, 0, 11, -11, None]


def test_minutes_do_not_depend_on_the_session_time_zone(spark, ts):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = [(ts("2024-03-10 01:30:00"), ts("2024-03-10 03:30:00"))]
        got = values(
            spark, "a timestamp_ntz, b timestamp_ntz", rows, compat.minutes_between("a", "b")
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [120]


def test_safe_divide_and_clamp(spark):
    rows = [(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None)]
    got = values(spark, "a double, b double", rows, compat.safe_divide("a", "b"))
    assert got == [0.5, None, None, None]
    xs = [(-500.0,), (500.0,), (7.0,), (None,)]
    got = values(spark, "x double", xs, compat.clamp("x", -100.0, 100.0))
    assert got == [-100.0, 100.0, 7.0, None]


def test_surrogate_key_marks_nulls(spark):
    rows = [("7", "x"), ("7", None)]
    got = values(spark, "a string, b string", rows, compat.surrogate_key("a", "b"))
    want = ["7-x", "7-_dbt_utils_surrogate_key_null_"]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in want]


def test_hash_key_is_null_safe_and_distinguishes(spark):
    rows = [("1", "2"), ("12", ""), (None, "2")]
    got = values(spark, "a string, b string", rows, compat.hash64_key("a", "b"))
    assert got[0] != got[1] and got[2] is None


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-01-05T10:11:12.345Z", "2024-01-05 10:11:12.345"),
        ("2024-01-05T10:11:12.345678+02:00", "2024-01-05 10:11:12.345"),
        ("2024-01-05 10:11:12", "2024-01-05 10:11:12"),
        ("2024-01-05T10:11:12-0530", "2024-01-05 10:11:12"),
        ("2024-01-05T10:11", "2024-01-05 10:11:00"),
        ("2024-01-05", "2024-01-05 00:00:00"),
        ("", None),
        (None, None),
        ("yesterday", None),
        ("2024-13-05T10:11:12Z", None),
    ],
)
def test_parse_timestamp(spark, text, want):
    got = values(spark, "t string", [(text,)], compat.parse_timestamp("t").cast("string"))
    assert got == [want]
    bad = values(spark, "t string", [(text,)], compat.is_bad_timestamp("t"))
    assert bad == [want is None and bool(text)]


def test_calendar_edges(spark, day):
    days = [("2020-02-29",), ("2024-12-30",), ("2024-12-29",), ("2021-09-01",)]
    df = spark.createDataFrame([(day(d),) for (d,) in days], "date_day date")
    got = {str(r.date_day): r for r in dims.calendar_columns(df).collect()}
    assert got["2020-02-29"].date_sk == 20200229
    assert got["2020-02-29"].season == "Winter"
    assert got["2024-12-30"].week_of_year == 1
    assert got["2024-12-29"].day_of_week == 0
    assert got["2024-12-29"].day_of_week_name == "Sun"
    assert got["2021-09-01"].season == "Fall"
    assert got["2021-09-01"].month_name == "Sep"


def test_dim_date_range(spark):
    dim = dims.dim_date(spark)
    row = dim.agg(
        F.count("*").alias("n"),
        F.count_distinct("date_sk").alias("keys"),
        F.min("date_day").alias("a"),
        F.max("date_day").alias("b"),
        F.count_distinct("season").alias("seasons"),
    ).first()
    assert (row.n, row.keys, row.seasons) == (4018, 4018, 4)
    assert (row.a, row.b) == (dt.date(2020, 1, 1), dt.date(2030, 12, 31))
    assert tuple(dim.columns) == dims.DIM_DATE_COLUMNS


def test_weekend_and_extra_columns(spark, day):
    df = spark.createDataFrame([(day("2024-06-01"),), (day("2024-06-03"),)], "date_day date")
    got = dims.with_extra_columns(dims.with_weekend(df), F.lit("2024-06-02").cast("date"))
    sat, mon = got.orderBy("date_day").collect()
    assert (sat.is_weekend, sat.is_weekday, sat.date_day_name) == (True, False, "Saturday")
    assert (mon.is_weekend, mon.month_year_name, mon.days_from_today) == (False, "June 2024", 1)


def labelled(spark, label, xs):
    rows = [(None if x is None else float(x),) for x in xs]
    return values(spark, "x double", rows, label(F.col("x")))


def test_label_limits(spark):
    assert labelled(spark, labels.momentum, [2.1, 2.0, 0.5, -0.5, -2.0, None]) == [
        "Accelerating",
        "Improving",
        "Stable",
        "Declining",
        "Deteriorating",
        "Deteriorating",
    ]
    assert labelled(spark, labels.volatility, [4.9, 5.0, 10.0, 15.0, 20.0, None]) == [
        "Very Stable",
        "Stable",
        "Moderate",
        "Volatile",
        "Very Volatile",
        "Very Volatile",
    ]
    assert labelled(spark, labels.balance, [80.0, 79.9, 40.0, 20.0, 19.9, None]) == [
        "Excellent Balance",
        "Good Balance",
        "Moderate Balance",
        "Poor Balance",
        "Very Poor Balance",
        "Very Poor Balance",
    ]
    assert labelled(spark, labels.efficiency, [1.1, 1.0, 0.5, 0.0, -0.5, None]) == [
        "Highly Efficient",
        "Efficient",
        "Moderate",
        "Poor",
        "Very Poor",
        "Very Poor",
    ]
    assert labelled(spark, labels.adaptation, [10.1, 10.0, 5.0, -5.0, -10.0]) == [
        "Thriving",
        "Well Adapted",
        "Normal Adaptation",
        "Struggling",
        "Poorly Adapted",
    ]
    assert labelled(spark, labels.sustainability, [0.71, 0.7, 0.5, 0.3]) == [
        "Highly Sustainable",
        "Sustainable",
        "Moderately Sustainable",
        "Unsustainable",
    ]
    assert labelled(spark, labels.readiness_gap, [21, 20, 10, -10, -11, -20, -21]) == [
        "Body Ready, Training Light",
        "Slight Over-recovery",
        "Well Aligned",
        "Well Aligned",
        "Slight Under-recovery",
        "Slight Under-recovery",
        "Body Tired, Training High",
    ]
    assert labelled(spark, labels.training_step, [15.1, 15.0, 12.0, 9.0, 6.0, None]) == [
        90,
        70,
        50,
        30,
        10,
        10,
    ]


def test_labels_ignore_last_bit_noise(spark):
    noisy = 0.1 + 0.2 + 0.2
    assert labelled(spark, labels.momentum, [noisy + 1e-13]) == ["Stable"]


def test_strain_zone_with_missing_limits(spark):
    rows = [(5.0, 6.0, 14.0), (6.0, 6.0, 14.0), (15.0, 6.0, 14.0), (15.0, None, 14.0), (9.0, None, None)]
    cols = [F.col(c) for c in ("s", "lo", "hi")]
    schema = "s double, lo double, hi double"
    assert values(spark, schema, rows, labels.strain_zone(*cols)) == [
        "Under",
        "Optimal",
        "Over",
        "Over",
        None,
    ]
    assert values(spark, schema, rows, labels.strain_distance(*cols)) == [1.0, 0.0, 1.0, 1.0, 0.0]


def test_risk_and_colors(spark):
    rows = [(-31.0, 15.0), (-30.0, 15.0), (-31.0, 14.0), (None, 15.0), (-31.0, None)]
    risk = labels.overtraining_risk(F.col("g"), F.col("s"))
    assert values(spark, "g double, s double", rows, risk) == [True, False, False, False, False]
    assert labelled(spark, labels.gap_color, [-21, -20, -1, 0, None]) == [
        "red",
        "orange",
        "orange",
        "green",
        "green",
    ]
    assert labelled(spark, labels.sign_color, [1, 0, None]) == ["green", "red", "red"]
    assert labelled(spark, labels.bubble_size, [-3.0, None]) == [3.0, 1.0]


def test_season_of_every_month(spark, day):
    df = spark.createDataFrame([(day(f"2024-{m:02d}-15"),) for m in range(1, 13)], "d date")
    got = [r[0] for r in df.orderBy("d").select(calendar.season(F.col("d"))).collect()]
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
