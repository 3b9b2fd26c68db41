"""State that increments merge into: ranks of old days, moments of seasons, and runs that stop in between."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import moments
from pulseframe.operators.incremental import merge_upsert, update_matched
from pulseframe.plans import dims, facts, metrics, pipeline
from pulseframe.sources import tables

DAYS = "user_sk string, date_sk int, recovery_score long, hrv_rmssd long, resting_heart_rate long, skin_temp_celsius long"


def day(k):
    return int(f"{dt.date(2023, 1, 1) + dt.timedelta(days=k):%Y%m%d}")


def series(rng, users, days):
    value = lambda n: rng.choice([None, *range(n)])
    return [(u, day(k), rng.randrange(30), value(9), value(12), 30 + rng.randrange(5)) for u in users for k in days if rng.random() < 0.9]


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_renewed_ranks_equal_all_ranked_again(spark):
    """New days at the end and in the middle, days with other values, a new user, a user left alone."""
    rng = random.Random(1)
    old = spark.createDataFrame(series(rng, "abc", range(100)), DAYS)
    new = spark.createDataFrame(series(rng, "ad", range(95, 120)) + series(rng, "b", range(40, 43)), DAYS)
    stored = facts.rank_days(old, keep=facts.MEASURES)
    changed = facts.renew_percentiles(stored, new)
    keys = ["user_sk", "date_sk"]
    want = facts.rank_days(merge_upsert(old, new, keys), keep=facts.MEASURES)
    assert rows(merge_upsert(stored, changed, keys)) == rows(want)
    users = {r.user_sk for r in changed.select("user_sk").distinct().collect()}
    assert users == {"a", "b", "d"}
    oldest = changed.filter("user_sk = 'a'").agg(F.min("date_sk")).first()[0]
    assert oldest < day(95)  # ranks of old days have moved
    assert facts.renew_percentiles(want, new).count() == 0
    assert facts.renew_percentiles(stored, new.limit(0)).count() == 0


def test_only_matched_rows_are_updated(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    source = spark.createDataFrame([(2, None, 9), (3, "c", 9)], "k int, v string, w int")
    got = sorted(tuple(r) for r in update_matched(target, source, ["k"], ["v"]).collect())
    assert got == [(1, "a", 1), (2, None, 2)]


MEASURES = ["m", "w"]
SCHEMA = "k string, m decimal(8,3), w int"


def sample(rng, n):
    return [(rng.choice("abcd"), rng.choice([None, Decimal(rng.randrange(10**6)) / 1000]), rng.randrange(100)) for _ in range(n)]


def merged(state, part, name):
    changed = moments.merge_part(state, part, ["k"], MEASURES, name)
    return merge_upsert(state, changed, ["k"])


def test_merged_moments_equal_those_counted_at_once(spark):
    rng = random.Random(2)
    parts = [sample(rng, 60), sample(rng, 5), [("e", Decimal("1.5"), 3)], sample(rng, 40)]
    state = moments.moments(spark.createDataFrame(parts[0], SCHEMA), ["k"], MEASURES).withColumn("applied", F.lit(""))
    for i, p in enumerate(parts[1:], 1):
        # what came last goes with the next part
        gone = parts[i - 1][:3] if i > 1 else []
        signed = [(*r, 1) for r in p] + [(*r, -1) for r in gone]
        part = moments.moments(spark.createDataFrame(signed, SCHEMA + ", s int"), ["k"], MEASURES, F.col("s"))
        state = merged(state, part, str(i))
        # a part that comes again changes nothing
        assert rows(merged(state, part, str(i))) == rows(state)
        parts[i - 1] = parts[i - 1][len(gone) :]
    everything = spark.createDataFrame(sum(parts, []), SCHEMA)
    want = moments.moments(everything, ["k"], MEASURES)
    left = state.filter("rows > 0")
    assert rows(left.drop("applied")) == rows(want)
    plain = everything.groupBy("k").agg(F.avg("m").cast("double").alias("a"), F.stddev_samp("w").alias("d")).collect()
    got = {r.k: (r.a, r.d) for r in left.select("k", moments.mean("m").alias("a"), moments.deviation("w").alias("d")).collect()}
    assert set(got) == {r.k for r in plain}
    for r in plain:
        assert got[r.k][1] == (None if r.d is None else pytest.approx(r.d, rel=1e-12))
        assert got[r.k][0] == (None if r.a is None else pytest.approx(r.a, rel=1e-6))


STG = (
    "cycle_id string, user_id string, created_at timestamp_ntz, updated_at timestamp_ntz, recovery_score long, "
    "resting_heart_rate long, hrv_rmssd_milli long, skin_temp_celsius long, month int"
)
SLEEP = (
    "id string, user_id string, created_at timestamp_ntz, updated_at timestamp_ntz, nap boolean, sleep_performance_percentage long, "
    "sleep_consistency_percentage long, sleep_efficiency_percentage long, respiratory_rate long, month int"
)


def recoveries(rng, users, days, version=0):
    out = []
    for u in users:
        for k in days:
            t = dt.datetime(2023, 1, 1, 6 + version) + dt.timedelta(days=k)
            out.append((f"{u}-{k}-{version}", u, t, t, rng.randrange(40, 90), rng.randrange(50, 60), rng.randrange(20, 90), 33, t.year * 100 + t.month))
    return out


def land(spark, root, *parts):
    staged = spark.createDataFrame(sum(parts, []), STG)
    tables.replace(staged, f"{root}/stg_recovery", ["month"])
    tables.replace(spark.createDataFrame([], SLEEP), f"{root}/stg_sleep", ["month"])
    users = spark.createDataFrame([(u, u) for u in "ab"], "user_id string, user_sk string")
    tables.replace(users, f"{root}/dim_user")
    tables.replace(dims.dim_date(spark), f"{root}/dim_date")




def build(spark, root, full=False):
    pipeline.build_percentiles(spark, root, full)
    pipeline.build_fact_recovery(spark, root, full)
    pipeline.build_seasonal(spark, root, F.lit("2024-01-01"), full)


TABLES = ("int_recovery_percentiles", pipeline.RECOVERY, "seasonal_adaptation", pipeline.SEASON_STATE)


def content(spark, root):
    return {t: rows(spark.read.parquet(f"{root}/{t}").drop("calculated_at", "applied")) for t in TABLES}


class Stop(Exception):
    pass


@pytest.mark.parametrize("where", ["_write_fact", "refresh_ranks", "build_season_state", None])
def test_a_run_that_stops_in_between(spark, tmp_path, monkeypatch, where):
    """The next run finishes what was left, and every old row is as after a full refresh."""
    rng = random.Random(4)
    first, second = recoveries(rng, "ab", range(80)), recoveries(rng, "a", range(79, 84), 1)
    third = recoveries(rng, "b", range(84, 86))
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    land(spark, step, first)
    build(spark, step)
    land(spark, step, first, second)
    if where:
        own = getattr(pipeline, where)

        def stop(*args):
            if where == "_write_fact" and not args[1].endswith(pipeline.RECOVERY):
                return own(*args)
            raise Stop

        with monkeypatch.context() as m:
            m.setattr(pipeline, where, stop)
            with pytest.raises(Stop):
                build(spark, step)
    else:
        build(spark, step)
    land(spark, step, first, second, third)
    build(spark, step)
    land(spark, whole, first, second, third)
    build(spark, whole, full=True)
    a, b = content(spark, step), content(spark, whole)
    for name in TABLES:
        assert a[name] == b[name], name
    assert not (tmp_path / "step" / pipeline.PENDING_DAYS).exists()
    assert not (tmp_path / "step" / pipeline.PENDING_RANKS).exists()


def test_an_increment_reads_new_days_and_state(spark, tmp_path):
    root = str(tmp_path)
    rng = random.Random(5)
    land(spark, root, recoveries(rng, "ab", range(400)))
    build(spark, root)
    land(spark, root, recoveries(rng, "ab", range(403)))
    pipeline.build_percentiles(spark, root)
    pipeline.build_fact_recovery(spark, root)
    days = spark.read.parquet(f"{root}/{pipeline.PENDING_DAYS}")
    assert days.count() == 6
    pipeline.build_season_state(spark, root)
    applied = {(r.season, r.year_number) for r in spark.read.parquet(f"{root}/{pipeline.SEASON_STATE}").filter("applied <> ''").collect()}
    assert applied == {("Winter", 2024)}
    names = list(metrics.SEASON_MEASURES.values())
    assert moments._columns(names)[0] == "rows"
