"""Checks that are counted while a table is written, against a suite that reads it."""

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import quality
from pulseframe.plans import checks, dims
from pulseframe.sources import tables

SCHEMA = "k int, v double, month int"


@pytest.fixture
def rules(spark):
    return [
        quality.null_check("v"),
        quality.range_check("v", 0, 10),
        quality.expression_check("k_is_odd", "k % 2 = 1", "k is not null"),
    ]


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def read_again(spark, path, rules):
    found = quality.run_suite(spark.read.parquet(path), rules).collect()
    return {r["test"]: r["failures"] for r in found}


@pytest.fixture
def no_reading(monkeypatch):
    def stop(*_):
        raise AssertionError("the table was read")

    monkeypatch.setattr(quality, "failures_by_part", stop)


FIRST = [(k, None if k % 5 == 0 else float(k % 14), 202401 + k % 4) for k in range(200)]


@pytest.mark.parametrize("columns", [[], ["month"]])
def test_counts_of_a_write(spark, rules, tmp_path, no_reading, columns):
    path = str(tmp_path / "t")
    tables.replace(rows(spark, *FIRST), path, columns, ["k"], rules)
    found = tables.failures(spark, path, rules, *columns)
    assert found == read_again(spark, path, rules)
    assert found["not_null_v"] == 40 and found["k_is_odd"] == 100


def test_rows_stay_sorted_in_a_file(spark, rules, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(rows(spark, *FIRST[::-1]), path, ["month"], ["k"], rules)
    for name in tables.entries(spark, path):
        found = [r[0] for r in spark.read.parquet(f"{path}/{name}").select("k").collect()]
        assert len(found) == 50 and found == sorted(found)


def test_an_upsert_counts_touched_partitions_only(spark, rules, tmp_path, no_reading):
    """Rows change, arrive, move to another month, leave a month empty and have no month."""
    path = str(tmp_path / "t")
    tables.replace(rows(spark, *FIRST, (999, 99.0, 202501)), path, ["month"], checks=rules)
    batch = rows(spark, (0, 3.0, 202401), (1001, -1.0, 202409), (999, None, 202402), (7, 50.0, None))
    tables.upsert(batch, path, ["k"], "month", checks=rules)
    assert "month=202501" not in tables.entries(spark, path)
    assert tables.failures(spark, path, rules, "month") == read_again(spark, path, rules)
    tables.upsert(rows(spark, (7, 5.0, None)), path, ["k"], "month", checks=rules)
    assert tables.failures(spark, path, rules, "month") == read_again(spark, path, rules)


def test_an_upsert_without_partitions(spark, rules, tmp_path, no_reading):
    path = str(tmp_path / "t")
    for batch in (FIRST, [(0, 3.0, 202401), (1001, -1.0, 202409)]):
        tables.upsert(rows(spark, *batch), path, ["k"], checks=rules)
        assert tables.failures(spark, path, rules) == read_again(spark, path, rules)


@pytest.mark.parametrize("write", ["append", "upsert", "replace", "other rule"])
def test_stale_counts_are_not_used(spark, rules, tmp_path, write):
    """After a write without checks, or with another rule, the table is read once and counted again."""
    path = str(tmp_path / "t")
    tables.replace(rows(spark, *FIRST), path, ["month"], checks=rules)
    more = rows(spark, (500, None, 202401), (501, 77.0, 202407))
    if write == "append":
        tables.append(more, path, ["month"])
    elif write == "upsert":
        tables.upsert(more, path, ["k"], "month")
    elif write == "replace":
        tables.replace(more, path, ["month"])
    else:
        rules = [rules[0], quality.range_check("v", 0, 5), rules[2]]
    assert tables.failures(spark, path, rules, "month") == read_again(spark, path, rules)
    # the counts of the reading are kept, and an upsert goes on from them
    tables.upsert(rows(spark, (502, None, 202402)), path, ["k"], "month", checks=rules)
    assert (tmp_path / "t" / tables.COUNTS).exists()
    assert tables.failures(spark, path, rules, "month") == read_again(spark, path, rules)


def test_an_interrupted_rewrite_keeps_its_counts(spark, rules, tmp_path, monkeypatch, no_reading):
    path = str(tmp_path / "t")
    tables.replace(rows(spark, *FIRST), path, ["month"], checks=rules)
    whole = tables.recover
    calls = []

    def stop(spark, where):
        # the first look is for what an earlier run left, the second moves the parts
        calls.append(where)
        if len(calls) > 1:
            raise KeyboardInterrupt
        return whole(spark, where)

    monkeypatch.setattr(tables, "recover", stop)
    with pytest.raises(KeyboardInterrupt):
        tables.upsert(rows(spark, (1, None, 202402), (600, -9.0, 202403)), path, ["k"], "month", checks=rules)
    monkeypatch.setattr(tables, "recover", whole)
    found = tables.failures(spark, path, rules, "month")
    assert found == read_again(spark, path, rules)
    assert found["not_null_v"] == 41


def test_an_empty_table(spark, rules, tmp_path, no_reading):
    for n, df in enumerate((rows(spark), rows(spark, *FIRST).filter("k < 0"))):
        path = str(tmp_path / f"t{n}")
        tables.replace(df, path, ["month"], checks=rules)
        assert tables.failures(spark, path, rules, "month") == {r.name: 0 for r in rules}


def test_many_parts_are_counted_by_reading(spark, rules, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "MAX_PARTS", 3)
    path = str(tmp_path / "t")
    tables.replace(rows(spark, *FIRST), path, ["month"], checks=rules)
    assert not (tmp_path / "t" / tables.COUNTS).exists()
    assert tables.failures(spark, path, rules, "month") == read_again(spark, path, rules)


def test_counts_are_taken_after_the_last_shuffle(spark, rules):
    """A repeated task of an earlier stage would be counted twice."""
    df = tables._gathered(rows(spark, *FIRST), ["month"])
    df, _ = quality.watch(df, rules, F.col("month"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.index("CollectMetrics") < text.index("Exchange")
    assert "Exchange" not in text[: text.index("CollectMetrics")]


@pytest.mark.parametrize("n", [0, 40])
def test_strain_suite_counts_while_its_keys_are_written(spark, tmp_path, n):
    """One run of the fact gives what reading it for every check gives; repeated and unknown keys are among its rows."""
    names = [*checks.STRAIN_RANGES, "calories_burned"]
    rows = [
        (f"s{k % 37}", f"u{k % 5}", 20240100 + k % 33, *[None if k % 7 == 0 else float(100 * (k % 3)) for _ in names], k)
        for k in range(n)
    ]
    schema = "strain_sk string, user_sk string, date_sk int, " + ", ".join(f"{c} double" for c in names) + ", k int"
    day = F.date_add(F.lit("2019-06-01").cast("date"), F.col("k") * 100)
    times = {c: F.when(F.col("k") % 4 > 0, F.current_timestamp()) for c in checks.STRAIN_NOT_NULL if c.endswith(("_at", "timestamp"))}
    fact = spark.createDataFrame(rows, schema).withColumns({**times, "cycle_date": day})
    users = spark.createDataFrame([(f"u{k}",) for k in range(3)], "user_sk string")
    args = fact, users, dims.dim_date(spark), F.lit("2026-11-04").cast("date")

    def written(df):
        df.write.parquet(str(tmp_path / "keys"))
        return spark.read.parquet(str(tmp_path / "keys"))

    got, want = checks.strain_suite(*args, written=written), checks.strain_suite(*args)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(str(tmp_path / "keys")).columns == list(checks.STRAIN_KEYS)
    if n:
        assert got.filter("failures > 0").count() > 10
