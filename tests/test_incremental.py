"""Dedup, watermarks, upserts, schema policy, history, tables on disk."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import dedup, incremental, series
from pulseframe.sources import tables

SCHEMA = "id string, v int, updated_at timestamp_ntz"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_latest_per_key(spark, ts):
    data = [
        ("a", 1, ts("2024-01-01")),
        ("a", 2, ts("2024-01-02")),
        ("b", 1, None),
        ("b", 2, ts("2024-01-02")),
        ("c", 1, ts("2024-01-01")),
        ("c", 2, ts("2024-01-01")),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    got = dedup.latest_per_key(df, ["id"], ["updated_at", "v"])
    # A null time is the newest, a tie goes to the next sort column.
    assert rows(got, "id", "v") == [("a", 2), ("b", 1), ("c", 2)]
    assert rows(dedup.latest_per_key(got, ["id"], ["updated_at", "v"]), "id", "v") == rows(
        got, "id", "v"
    )


def test_full_ties_are_settled_by_content(spark, ts):
    data = [("a", v, ts("2024-01-01")) for v in range(50)]
    kept = set()
    for parts in (1, 3, 7):
        for rows_in in (data, data[::-1]):
            df = spark.createDataFrame(rows_in, SCHEMA).repartition(parts)
            kept |= {r.v for r in dedup.latest_per_key(df, ["id"], ["updated_at"]).collect()}
    assert len(kept) == 1


def test_a_hot_key_leaves_one_row_per_task(spark):
    df = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id"
    )
    newest = dedup.latest_per_key(df, ["k"], ["id"])
    assert newest.filter("k = 0").first()["id"] == 89_997
    assert newest.count() == 60_001


def test_latest_row(spark, ts):
    df = spark.createDataFrame([("a", 1, ts("2024-01-01")), ("a", 2, ts("2024-01-02"))], SCHEMA)
    assert rows(dedup.latest_row(df, ["id"], "updated_at", ["v"]), "id", "v") == [("a", 2)]


def test_watermark_is_strict(spark, ts):
    df = spark.createDataFrame(
        [("a", 1, ts("2024-01-01")), ("b", 2, ts("2024-01-02")), ("c", 3, ts("2024-01-03"))],
        SCHEMA,
    )
    target = df.filter("v <= 2")
    newest = incremental.read_watermark(target, "updated_at")
    assert newest == ts("2024-01-02")
    assert rows(incremental.after_watermark(df, "updated_at", newest), "id") == [("c",)]
    assert rows(incremental.after_target(df, target, "updated_at"), "id") == [("c",)]
    late = incremental.after_watermark(df, "updated_at", newest, dt.timedelta(days=1))
    assert rows(late, "id") == [("b",), ("c",)]
    empty = df.filter("false")
    assert incremental.read_watermark(empty, "updated_at") == incremental.FLOOR
    assert incremental.after_target(df, empty, "updated_at").count() == 3


def test_upsert_and_partial(spark, ts):
    old = spark.createDataFrame([("a", 1, ts("2024-01-01")), ("b", 1, ts("2024-01-01"))], SCHEMA)
    new = spark.createDataFrame([("b", 2, ts("2024-01-02")), ("c", 2, ts("2024-01-02"))], SCHEMA)
    once = incremental.merge_upsert(old, new, ["id"])
    assert rows(once, "id", "v") == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(incremental.merge_upsert(once, new, ["id"]), "id", "v") == rows(once, "id", "v")
    part = incremental.merge_partial(old, new, ["id"], ["updated_at"])
    assert rows(part, "id", "v", "updated_at") == [
        ("a", 1, ts("2024-01-01")),
        ("b", 1, ts("2024-01-02")),
        ("c", 2, ts("2024-01-02")),
    ]


def test_newest_wins_in_any_order(spark, ts):
    newer = spark.createDataFrame([("a", 2, ts("2024-01-02"))], SCHEMA)
    older = spark.createDataFrame([("a", 1, ts("2024-01-01"))], SCHEMA)
    for target, source in ((newer, older), (older, newer)):
        got = incremental.merge_newest(target, source, ["id"], ["updated_at"])
        assert rows(got, "id", "v") == [("a", 2)]


def test_schema_policy(spark, ts):
    old = spark.createDataFrame([("a", 1)], "id string, v int")
    new = spark.createDataFrame([("b", 2.5)], "id string, w double")
    with pytest.raises(ValueError, match="schema changed"):
        incremental.merge_with_policy(old, new, ["id"], "fail")
    got = incremental.merge_with_policy(old, new, ["id"], "append_new_columns")
    assert sorted(map(tuple, got.collect())) == [("a", 1, None), ("b", None, 2.5)]


def test_history(spark, day):
    schema = "k string, x string, effective_date date, expiry_date date, is_current boolean"
    dim = spark.createDataFrame(
        [
            ("a", "0", day("2023-01-01"), day("2024-01-01"), False),
            ("a", "1", day("2024-01-01"), None, True),
            ("b", "1", day("2024-01-01"), None, True),
            ("d", None, day("2024-01-01"), None, True),
        ],
        schema,
    )
    updates = spark.createDataFrame(
        [("a", "2"), ("b", "1"), ("c", "1"), ("d", None)], "k string, x string"
    )
    when = F.lit("2025-01-01").cast("date")
    got = incremental.merge_history(dim, updates, "k", ["x"], when)
    want = [
        ("a", "0", "2024-01-01", False),
        ("a", "1", "2025-01-01", False),
        ("a", "2", None, True),
        ("b", "1", None, True),
        ("c", "1", None, True),
        ("d", None, None, True),
    ]
    seen = [
        (r.k, r.x, str(r.expiry_date) if r.expiry_date else None, r.is_current)
        for r in got.collect()
    ]
    assert sorted(seen, key=repr) == sorted(want, key=repr)
    again = incremental.merge_history(got, updates, "k", ["x"], when)
    assert again.exceptAll(got).isEmpty() and got.count() == again.count()


def month_frame(spark, data):
    return spark.createDataFrame(data, "id string, v int, month int")


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(month_frame(spark, [("a", 1, 202401), ("b", 1, 202402)]), path, ["id"], "month")
    kept = set((tmp_path / "t" / "month=202401").iterdir())
    tables.upsert(month_frame(spark, [("b", 2, 202402), ("c", 1, 202403)]), path, ["id"], "month")
    assert set((tmp_path / "t" / "month=202401").iterdir()) == kept
    want = [("a", 1, 202401), ("b", 2, 202402), ("c", 1, 202403)]
    assert rows(spark.read.parquet(path), "id", "v", "month") == want


def test_upsert_moves_a_row_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(
        month_frame(spark, [("a", 1, 202401), ("b", 1, 202402), ("d", 1, 202405)]),
        path,
        ["id"],
        "month",
    )
    # "b" moves and leaves its month empty.
    tables.upsert(month_frame(spark, [("b", 2, 202401)]), path, ["id"], "month")
    want = [("a", 1, 202401), ("b", 2, 202401), ("d", 1, 202405)]
    assert rows(spark.read.parquet(path), "id", "v", "month") == want


def test_upsert_without_partitions_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark.createDataFrame([("a", 1)], "id string, v int"), path, ["id"])
    wider = spark.createDataFrame([("a", 2, "x")], "id string, v int, w string")
    with pytest.raises(ValueError, match="schema changed"):
        tables.upsert(wider, path, ["id"])
    tables.upsert(wider, path, ["id"], on_schema_change="append_new_columns")
    assert rows(spark.read.parquet(path), "id", "v", "w") == [("a", 2, "x")]


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("a", 1)], "id string, v int")
    tables.append(one, path)
    tables.append(one, path)
    assert spark.read.parquet(path).count() == 2
    tables.replace(one, path)
    assert spark.read.parquet(path).count() == 1


def test_history_keeps_every_column(spark, day):
    schema = "k int, sk string, mail string, x int, effective_date date, expiry_date date, is_current boolean"
    start, when = day("2024-01-01"), day("2024-06-01")
    dim = spark.createDataFrame(
        [(1, "s1", "a@x", 5, start, None, True), (2, "s2", "b@x", 6, start, None, True), (3, "s3", "c@x", 7, start, None, True)],
        schema,
    )
    updates = spark.createDataFrame([(1, "new@x", 50), (2, "b2@x", 6), (4, "d@x", 8)], "k int, mail string, x int")
    got = incremental.merge_history(dim, updates, "k", ["x"], F.lit(when))
    again = incremental.merge_history(got, updates, "k", ["x"], F.lit(when))
    want = {
        (1, "s1", "a@x", 5, start, when, False),
        (1, "s1", "new@x", 50, when, None, True),
        (2, "s2", "b@x", 6, start, None, True),
        (3, "s3", "c@x", 7, start, None, True),
        (4, None, "d@x", 8, when, None, True),
    }
    for df in (got, again):
        rows = df.select(*dim.columns).collect()
        assert len(rows) == 5 and {tuple(r) for r in rows} == want


def test_two_rows_of_a_user_and_day_are_an_error(spark):
    left = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), (None, 1, 3.0)], "user_sk string, date_sk int, v double")
    right = spark.createDataFrame([("a", 1, 9.0), (None, 1, 8.0), ("b", 1, 7.0)], "user_sk string, date_sk int, w double")
    got = {(r.user_sk, r.date_sk): (r.v, r.w) for r in series.beside(left, right, ["w"]).collect()}
    assert got == {("a", 1): (1.0, 9.0), ("a", 2): (2.0, None), (None, 1): (3.0, None)}
    for one, two in ((left.union(left.limit(1)), right), (left, right.union(right.limit(1)))):
        with pytest.raises(Exception, match="more than one row for a user and day"):
            series.beside(one, two, ["w"]).collect()


def test_older_versions_are_looked_up_outside_the_months_of_the_batch(spark, tmp_path):
    """The months of the batch are read anyway; records move out of, into and between a month and no month."""
    path = str(tmp_path / "t")
    start = [("a", 1, 202401), ("b", 1, 202402), ("c", 1, None), ("d", 1, 202403), ("e", 1, 202401)]
    tables.upsert(month_frame(spark, start), path, ["id"], "month")
    batch = [("a", 2, 202402), ("b", 2, 202401), ("c", 2, 202401), ("f", 2, 202402)]
    with_null = [("d", 3, None), ("c", 3, None), ("e", 3, 202404)]
    for rows_ in (batch, with_null):
        tables.upsert(month_frame(spark, rows_), path, ["id"], "month")
    got = sorted((r.id, r.v, r.month) for r in spark.read.parquet(path).collect())
    assert got == [("a", 2, 202402), ("b", 2, 202401), ("c", 3, None), ("d", 3, None), ("e", 3, 202404), ("f", 2, 202402)]


def test_a_batch_of_all_months_reads_no_keys_to_find_older_ones(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(month_frame(spark, [("a", 1, 202401), ("b", 1, 202402)]), path, ["id"], "month")
    frame, read = type(spark.range(0)), []
    join = frame.join

    def seen(self, other, on=None, how=None):
        if how == "left_semi":
            read.append(self.count())
        return join(self, other, on, how)

    monkeypatch.setattr(frame, "join", seen)
    tables.upsert(month_frame(spark, [("a", 2, 202402), ("c", 2, 202401)]), path, ["id"], "month")
    assert read == [0]
    got = sorted((r.id, r.v, r.month) for r in spark.read.parquet(path).collect())
    assert got == [("a", 2, 202402), ("b", 1, 202402), ("c", 2, 202401)]
