"""Quality checks on clean and broken data."""

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import quality
from pulseframe.plans import checks, dims

SCHEMA = "id string, v double, k int"


@pytest.fixture
def broken(spark):
    return spark.createDataFrame(
        [("a", 1.0, 1), ("a", 99.0, 2), ("b", None, 9), (None, -1.0, None), (None, 5.0, 9)], SCHEMA
    )


@pytest.fixture
def parents(spark):
    return spark.createDataFrame([(1,), (2,)], "key int")


def test_single_checks(broken, parents):
    assert quality.not_null(broken, "id").count() == 2
    assert [tuple(r) for r in quality.unique(broken, "id").collect()] == [("a", 2)]
    assert quality.unique_combination(broken, ["id", "k"]).isEmpty()
    assert [tuple(r) for r in quality.orphans(broken, "k", parents, "key").collect()] == [(9, 2)]
    assert quality.orphan_rows(broken, "k", parents, "key").count() == 2
    assert quality.accepted_range(broken, "v", 0, 50).count() == 2
    assert quality.accepted_range(broken, "v", 0, 50, where="id is not null").count() == 1
    assert quality.accepted_range(broken, "v", low=1, inclusive=False).count() == 2
    assert [tuple(r) for r in quality.accepted_values(broken, "id", ["a"]).collect()] == [("b", 1)]
    assert quality.expression_holds(broken, "v >= 0").count() == 2
    assert quality.expression_holds(broken, "v >= 0", "v is not null").count() == 1
    with pytest.raises(ValueError, match="limit"):
        quality.out_of_range("v")


@pytest.mark.parametrize(
    ("as_of", "status"),
    [("2024-01-03", "pass"), ("2024-01-03 00:00:01", "warn"), ("2024-01-09", "error")],
)
def test_freshness(spark, ts, as_of, status):
    df = spark.createDataFrame([(ts("2024-01-01"),), (ts("2023-01-01"),)], "t timestamp_ntz")
    row = quality.freshness(df, "t", F.lit(as_of), 2, 7).first()
    assert row.status == status
    assert quality.freshness(df, "t", F.lit(as_of), 2, 7, "t > '2030-01-01'").first().status == "error"


def test_volume(spark):
    batch = spark.range(1001).select(F.lit("cycle").alias("s")).unionByName(
        spark.createDataFrame([("sleep",), ("user",), ("user",)], "s string")
    )
    names = [("cycle",), ("sleep",), ("user",), ("workout",)]
    got = quality.volume(batch, "s", spark.createDataFrame(names, "s string")).collect()
    assert {r.source: (r.records, r.status) for r in got} == {
        "cycle": (1001, "warn"),
        "sleep": (1, "ok"),
        "user": (2, "warn"),
        "workout": (0, "info"),
    }


def test_suite_counts_every_failure(broken, parents):
    result = quality.run_suite(
        broken,
        [
            quality.null_check("id"),
            quality.range_check("v", 0, 50),
            quality.expression_check("k_small", "k < 9"),
        ],
        [quality.unique_check(broken, "id"), quality.relationship_check(broken, "k", parents, "key")],
    )
    got = {r.test: (r.failures, r.should_error) for r in result.collect()}
    assert got == {
        "not_null_id": (2, True),
        "accepted_range_v": (2, True),
        "k_small": (3, True),
        "unique_id": (1, True),
        "relationships_k": (2, True),
    }


def strain_rows(spark, day, **changes):
    row = {
        "strain_sk": "s",
        "user_sk": "u",
        "date_sk": 20240101,
        "day_strain": 10.0,
        "calories_burned": 1000.0,
        "created_timestamp": "t",
        "source_created_at": "t",
        "source_updated_at": "t",
        "cycle_date": day("2024-01-01"),
        "optimal_strain_min": None,
        "optimal_strain_max": None,
        "average_heart_rate": 60.0,
        "max_heart_rate": 150.0,
        "workout_count": 1.0,
        "total_workout_minutes": None,
        "max_workout_strain": 5.0,
        **{f"zone_{i}_minutes": 10.0 for i in range(6)},
        **changes,
    }
    text = {"strain_sk", "user_sk", "created_timestamp", "source_created_at", "source_updated_at"}
    types = {"date_sk": "int", "cycle_date": "date", **dict.fromkeys(text, "string")}
    schema = ", ".join(f"{c} {types.get(c, 'double')}" for c in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def failing_tests(spark, fact):
    dim_user = spark.createDataFrame([("u",)], "user_sk string")
    suite = checks.strain_suite(
        fact, dim_user, dims.dim_date(spark), F.lit("2024-06-01").cast("date")
    )
    return {r.test for r in suite.collect() if r.should_error}


def test_strain_suite(spark, day):
    assert failing_tests(spark, strain_rows(spark, day)) == set()
    bad = strain_rows(
        spark,
        day,
        day_strain=22.0,
        average_heart_rate=30.0,
        zone_0_minutes=1431.0,
        cycle_date=day("2017-01-01"),
        user_sk="nobody",
        source_created_at=None,
    )
    assert failing_tests(spark, bad) == {
        "accepted_range_day_strain",
        "accepted_range_average_heart_rate",
        "zone_total_within_day",
        "cycle_date_not_too_old",
        "relationships_user_sk",
        "not_null_source_created_at",
    }
    future = strain_rows(spark, day, cycle_date=day("2024-06-02"), date_sk=19990101)
    assert failing_tests(spark, future) == {"cycle_date_not_in_future", "relationships_date_sk"}
    twice = strain_rows(spark, day).unionByName(strain_rows(spark, day))
    assert failing_tests(spark, twice) == {"unique_strain_sk", "unique_user_sk_date_sk"}


def test_summaries_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    row = quality.summarize(quality.not_null(empty, "id"), "t").first()
    assert (row.test, row.failures, row.should_warn) == ("t", 0, False)
    staging = checks.staging_suite(
        spark.createDataFrame([], "id string, user_id string, created_at timestamp_ntz"), "id"
    )
    assert [r.failures for r in staging.collect()] == [0, 0, 0, 0]
