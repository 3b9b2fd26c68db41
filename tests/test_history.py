"""Versions of a key on a day, against a plain search."""

import datetime as dt
import random
import re

from pulseframe.operators.history import version_on

ROWS = "k string, day date, v int, `a.b` int"
VERSIONS = "k string, name string, effective_date date, expiry_date date"


def at(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def plain(row, versions):
    k, day, *_ = row
    found = [x for x in versions if k is not None and day is not None and x[0] == k and x[2] is not None and x[2] <= day]
    found.sort(key=lambda x: (x[2], x[3] or dt.date.max))
    if not found or found[-1][3] is not None and day >= found[-1][3]:
        return (*row, None)
    return (*row, found[-1][1])


def test_against_a_plain_search(spark):
    rng = random.Random(6)
    versions = [(k, f"{k}{i}", at(s), at(e)) for k in "abc" for i, (s, e) in enumerate([(5, 20), (20, 30), (35, None)])]
    # two that start on a day, one that never ends, and rows that match nothing
    versions += [("d", "short", at(3), at(4)), ("d", "long", at(3), at(9)), (None, "x", at(1), None), ("a", "y", None, at(9))]
    rows = [(rng.choice(["a", "b", "c", "d", "e", None]), at(rng.choice([None, *range(45)])), i, 1) for i in range(300)]
    rows += rows[:5]
    got = version_on(spark.createDataFrame(rows, ROWS), spark.createDataFrame(versions, VERSIONS), "k", "day", ["name"])
    assert got.columns == ["k", "day", "v", "a.b", "name"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(plain(r, versions)) for r in rows)
    assert {r[-1] for r in map(tuple, got.collect())} >= {None, "a0", "a1", "b2", "long"}


def test_one_shuffle_and_empty_sides(spark):
    rows = spark.createDataFrame([("a", at(1), 1, 1)], ROWS)
    versions = spark.createDataFrame([("a", "x", at(0), None)], VERSIONS)
    df = version_on(rows, versions, "k", "day", ["name"])
    assert len(re.findall("Exchange hash", df._jdf.queryExecution().executedPlan().toString())) == 1
    assert version_on(rows.limit(0), versions, "k", "day", ["name"]).count() == 0
    assert [r.name for r in version_on(rows, versions.limit(0), "k", "day", ["name"]).collect()] == [None]
