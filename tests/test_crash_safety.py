"""Writes that stop half-way: whatever the step, the next reader or writer finds every row."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulseframe.sources import extract, state, tables
from pulseframe.sources.specs import STATE_SCHEMA

SCHEMA = "k int, v string, month int"


class Stop(Exception):
    """The process ends here."""


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def content(spark, path):
    schema = rows(spark).schema
    return sorted(tuple(r) for r in tables.read_table(spark, path, schema).select("k", "v", "month").collect())


START = [(1, "a", 202401), (2, "b", 202401), (3, "c", 202402)]
BATCH = [(2, "B", 202401), (4, "d", 202403)]
AFTER = [(1, "a", 202401), (2, "B", 202401), (3, "c", 202402), (4, "d", 202403)]


def stop_before_plan(monkeypatch):
    def stop(*_):
        raise Stop

    monkeypatch.setattr(tables, "_write_plan", stop)


def stop_after_plan(monkeypatch):
    """The copy is complete, the table has not been touched."""
    whole = tables._write_plan

    def stop(*args):
        whole(*args)
        raise Stop

    monkeypatch.setattr(tables, "_write_plan", stop)


def stop_at_cleanup(monkeypatch):
    """The table has been replaced, the copy is still there."""

    def stop(spark, path):
        if path.endswith(tables.PLAN):
            raise Stop
        whole(spark, path)

    whole = tables._delete
    monkeypatch.setattr(tables, "_delete", stop)


def half_written(spark, path, by):
    """What a second write that stopped in the middle leaves: part of the old files is gone."""
    tables._delete(spark, f"{path}/month=202401" if by else path)


@pytest.mark.parametrize("by", [None, "month"])
@pytest.mark.parametrize("stop", [stop_before_plan, stop_after_plan, stop_at_cleanup])
def test_interrupted_upsert(spark, tmp_path, monkeypatch, stop, by):
    path = str(tmp_path / "t")
    tables.upsert(rows(spark, *START), path, ["k"], by)
    with monkeypatch.context() as m:
        stop(m)
        with pytest.raises(Stop):
            tables.upsert(rows(spark, *BATCH), path, ["k"], by)
    # A copy without its plan was not complete: the table is as before. Else the upsert is finished.
    assert content(spark, path) == (START if stop is stop_before_plan else AFTER)
    tables.upsert(rows(spark, *BATCH), path, ["k"], by)
    assert content(spark, path) == AFTER
    tables.upsert(rows(spark, (5, "e", 202403)), path, ["k"], by)
    assert content(spark, path) == [*AFTER, (5, "e", 202403)]


@pytest.mark.parametrize("by", [None, "month"])
def test_stopped_in_the_middle_of_the_second_write(spark, tmp_path, monkeypatch, by):
    path = str(tmp_path / "t")
    tables.upsert(rows(spark, *START), path, ["k"], by)
    with monkeypatch.context() as m:
        stop_after_plan(m)
        with pytest.raises(Stop):
            tables.upsert(rows(spark, *BATCH), path, ["k"], by)
    half_written(spark, path, by)
    tables.upsert(rows(spark, (5, "e", 202403)), path, ["k"], by)
    assert content(spark, path) == [*AFTER, (5, "e", 202403)]
    assert not (tmp_path / "t__staged").exists()


def test_a_partition_that_loses_its_last_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(rows(spark, *START), path, ["k"], "month")
    with monkeypatch.context() as m:
        stop_after_plan(m)
        with pytest.raises(Stop):
            tables.upsert(rows(spark, (3, "moved", 202405)), path, ["k"], "month")
    assert content(spark, path) == [*START[:2], (3, "moved", 202405)]
    assert not (tmp_path / "t" / "month=202402").exists()


def test_a_full_refresh_voids_what_was_left_to_do(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(rows(spark, *START), path, ["k"])
    with monkeypatch.context() as m:
        stop_after_plan(m)
        with pytest.raises(Stop):
            tables.upsert(rows(spark, *BATCH), path, ["k"])
    tables.replace(rows(spark, (9, "z", 202409)), path)
    assert content(spark, path) == [(9, "z", 202409)]


def test_interrupted_state(spark, tmp_path, monkeypatch, ts):
    root = str(tmp_path)
    path = f"{root}/{extract.STATE_TABLE}"
    old = spark.createDataFrame([("cycle", ts("2024-02-01"), "success", ts("2024-02-01"))], STATE_SCHEMA)
    tables.rewrite(old, path)
    update = spark.createDataFrame([("sleep", ts("2024-02-03"))], "table_name string, last_processed_at timestamp_ntz")
    new = state.upsert_state(tables.read_table(spark, path, STATE_SCHEMA), update, F.lit(str(dt.datetime(2024, 3, 1))))
    with monkeypatch.context() as m:
        stop_after_plan(m)
        with pytest.raises(Stop):
            tables.rewrite(new, path)
    half_written(spark, path, None)
    got = {r.table_name: r.last_processed_at for r in tables.read_table(spark, path, STATE_SCHEMA).collect()}
    assert got == {"cycle": ts("2024-02-01"), "sleep": ts("2024-02-03")}


def test_null_keys_are_set_aside_and_not_added_again(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = rows(spark, (1, "a", 202401), (None, "x", 202401))
    for _ in range(2):
        assert tables.upsert(batch, path, ["k"]) == 1
    assert content(spark, path) == [(1, "a", 202401)]
    assert spark.read.parquet(tables.rejected_path(path)).count() == 2


def test_trouble_is_not_absence(spark, tmp_path):
    assert not tables.table_exists(spark, str(tmp_path / "none"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("not parquet")
    assert tables.table_exists(spark, str(tmp_path / "broken"))
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.upsert(rows(spark, *BATCH), str(tmp_path / "broken"), ["k"])


@pytest.mark.parametrize("by", [None, "month"])
def test_stopped_between_two_moves(spark, tmp_path, monkeypatch, by):
    """Some parts of the copy are in the table, the others are not."""
    path = str(tmp_path / "t")
    tables.upsert(rows(spark, *START), path, ["k"], by)
    batch = [(2, "B", 202401), (3, "C", 202402), (4, "d", 202403)]
    whole = tables._delete
    for k in range(4):
        deleted = []

        def stop(spark, at, deleted=deleted, k=k):
            if at.startswith(f"{path}/"):
                deleted.append(at)
                if len(deleted) > k:
                    raise Stop
            whole(spark, at)

        with monkeypatch.context() as m:
            m.setattr(tables, "_delete", stop)
            try:
                tables.upsert(rows(spark, *batch), path, ["k"], by)
            except Stop:
                pass
        assert content(spark, path) == [START[0], *batch]
        assert not (tmp_path / "t__staged").exists()


def test_a_partitioned_table_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    none = rows(spark, *START).limit(0)
    tables.replace(none, path, ["month"])
    assert tables.table_exists(spark, path) and spark.read.parquet(path).columns == ["k", "v", "month"]
    assert content(spark, path) == []
    tables.upsert(none, path, ["k"], "month")
    assert content(spark, path) == []
    tables.upsert(rows(spark, *START), path, ["k"], "month", partition_is_part_of_key=True)
    assert content(spark, path) == START
    assert spark.read.parquet(path).schema["month"].dataType.simpleString() == "int"
    # a rewrite that leaves nothing
    tables.rewrite(spark.read.parquet(path).filter("k > 9"), path, ["month"])
    assert content(spark, path) == [] and spark.read.parquet(path).columns == ["k", "v", "month"]


def test_every_way_of_writing_compresses_by_the_same_codec(spark, tmp_path):
    path = tmp_path / "t"
    tables.append(rows(spark, *START), str(path), ["month"])
    tables.upsert(rows(spark, *BATCH), str(path), ["k"], "month")
    tables.append(rows(spark, (9, "i", 202409)), str(path), ["month"])
    tables.replace(rows(spark, *START), str(tmp_path / "plain"))
    files = [f.name for f in tmp_path.rglob("*.parquet")]
    assert files and all(f.endswith(f".{tables.CODEC}.parquet") for f in files)
