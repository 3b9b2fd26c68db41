"""Streams: late rows put aside, first arrivals over several batches, figures of every batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulseframe.sources import tables
from pulseframe.streaming import jobs

SCHEMA = "user string, t timestamp_ntz, v double"
WEEK = dt.timedelta(days=7)


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(day, hour=0):
    return dt.datetime(2024, 3, 1, hour) + dt.timedelta(days=day)


def run(spark, tmp_path, batches, keys=("user",)):
    source, root, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for rows in batches:
        land(spark, source, rows)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        jobs.first_arrivals_stream(stream, root, check, list(keys), "t", WEEK).awaitTermination()
    late = sorted((r.user, r.t, r.batch) for r in jobs.late_arrivals(spark, root).collect())
    return sorted(((r.user, r.t, r.v) for r in jobs.arrivals(spark, root).collect()), key=repr), late


def plain(batches, lateness=WEEK):
    """First arrivals and late rows by a pass over the batches; a key is a user."""
    newest, taken, late = None, [], []
    for number, rows in enumerate(batches):
        on_time = [r for r in rows if newest is None or r[1] is None or r[1] > newest - lateness]
        late += [(r[0], r[1], number) for r in rows if r not in on_time]
        first = {}
        for r in on_time:
            if r[0] not in first or (r[1] or dt.datetime.max) < (first[r[0]][1] or dt.datetime.max):
                first[r[0]] = r
        known = {u for u, t, _ in taken if newest is None or t is None or t > newest - 2 * lateness}
        taken += [r for r in first.values() if r[0] not in known]
        newest = max((t for t in (newest, *(r[1] for r in rows)) if t is not None), default=None)
    return sorted(taken, key=repr), sorted(late)


BATCHES = [
    [("a", at(0), 1.0), ("b", at(20), 2.0), ("c", at(1), 3.0), ("c", at(1, 5), 4.0)],
    # the watermark is day 13: x is late, y is on it and late, z is not, b is known
    [("x", at(2), 5.0), ("y", at(13), 6.0), ("z", at(13, 1), 7.0), ("b", at(21), 8.0), ("a", at(22), 9.0)],
    # watermark 15; z is remembered, b too; c was forgotten
    [("z", at(16), 10.0), ("b", at(40), 11.0), ("c", at(23), 12.0), ("x", at(15), 13.0), ("x", at(15, 2), 14.0)],
    [],
    [("q", at(33), 15.0), ("b", at(34), 16.0), ("w", None, 17.0), (None, at(39), 18.0)],
    [("w", None, 19.0), (None, at(41), 20.0), (None, None, 21.0)],
]


@pytest.mark.parametrize("number", [2, 3, 6])
def test_first_arrivals_and_late_rows(spark, tmp_path, number):
    got, late = run(spark, tmp_path, BATCHES[:number])
    want, want_late = plain(BATCHES[:number])
    assert got == want and late == want_late
    assert ("x", at(2), 1) in late and ("y", at(13), 1) in late
    assert ("a", at(22), 9.0) in got  # its first arrival, 20 days before the watermark, was forgotten


def test_two_keys(spark, tmp_path):
    got, _ = run(spark, tmp_path, [[("a", at(1), 1.0), ("a", at(2), 2.0), ("a", at(1), 1.0)]] * 2, ("user", "v"))
    assert got == [("a", at(1), 1.0), ("a", at(2), 2.0)]


def test_a_repeated_batch_replaces_its_part(spark, tmp_path, monkeypatch):
    """The run stops before the batch is committed; the next one gives it the same number."""
    whole = jobs._put

    def stop(df, path, *rest):
        if path.endswith("/clock") and rest[0] == 1:
            raise RuntimeError("stopped")
        whole(df, path, *rest)

    run(spark, tmp_path, BATCHES[:1])
    with monkeypatch.context() as m:
        m.setattr(jobs, "_put", stop)
        with pytest.raises(Exception, match="stopped"):
            run(spark, tmp_path, BATCHES[1:2])
    got, late = run(spark, tmp_path, BATCHES[2:3])
    # what landed meanwhile comes with the batch after the repeated one
    want, want_late = plain(BATCHES[:3])
    assert got == want and late == want_late


def test_the_state_is_read_by_day(spark, tmp_path):
    run(spark, tmp_path, BATCHES[:3])
    rows = spark.read.parquet(str(tmp_path / "in"))  # of a known size, as the kept batch is
    text = jobs._unseen(rows, str(tmp_path / "out"), 3, ["user"], "t", at(26))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "PartitionFilters" in line and "arrival_day" in line)
    assert "20240327" in scan and "ReadSchema: struct<user:string,t:timestamp_ntz>" in scan
    # the keys of the batch are small and go to the state, not the state to them
    assert "BroadcastHashJoin" in text and "LeftSemi, BuildRight" in text


def test_every_batch_is_written_down(spark, tmp_path):
    """More batches than the query remembers."""
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    land(spark, source, [("a", at(30), 1.0)])
    for k in range(5):
        land(spark, source, [(f"u{k}", at(1), 1.0), (f"v{k}", at(29), 1.0)])
    keep = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    listener = jobs.BatchLog(spark, log)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        kept = jobs.drop_repeats(stream, ["user"], "t", "7 days")
        query = jobs.append_stream(kept, str(tmp_path / "out"), str(tmp_path / "check"))
        query.awaitTermination()
        spark._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", keep)
    figures = jobs.batch_figures(spark, log).filter(F.col("run_id") == str(query.runId))
    total = figures.agg(F.count("*"), F.sum("rows"), F.sum("late_rows"), F.countDistinct("batch_id")).first()
    # the last batch may only move the watermark; of the rows of day 1, those after the second batch are late
    assert total[0] == total[3] >= 6 and total[1] == 11 and total[2] == 4 > jobs.late_rows(query)
    assert tables.table_exists(spark, str(tmp_path / "out"))
