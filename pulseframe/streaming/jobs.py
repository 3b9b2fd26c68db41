"""Streaming ingestion, upsert and daily totals.

All jobs run with ``availableNow``: they take what has landed and stop, and the
checkpoint (in a folder all executors share) remembers how far they came. Tables
that are upserted lie by month, so a batch rewrites the months it touches.

A stateful job forgets what is older than its ``lateness``. The engine drops rows that come later
than that without a trace, by the watermark of the batch before the last one. :func:`first_arrivals_stream`
judges every row by the batches before its own and puts late ones into a table beside the
target. Of the other jobs :class:`BatchLog` writes the figures of every batch, with the late rows.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pulseframe.operators.dedup import latest_per_key
from pulseframe.operators.incremental import merge_newest
from pulseframe.plans import staging
from pulseframe.sources import landed, tables
from pulseframe.sources.specs import SourceSpec

MONTH = "month"
_ADAPTIVE = "spark.sql.adaptive.enabled"


def landed_stream(
    spark: SparkSession, path: str, spec: SourceSpec, files_per_batch: int = 1000, deal_lines: bool = False
) -> DataFrame:
    """Records of page files as they land, flattened and stamped per batch.

    What cannot be loaded is in :func:`rejected_stream`.

    A file in gzip cannot be split, so one task reads all of it, and a batch of few files keeps few
    cores busy. With ``deal_lines`` these tasks only unpack the lines, one page each, and deal them to
    as many tasks as there are cores, which parse them; that is most of the work.
    """
    if deal_lines:
        lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
        dealt = lines.repartition(max(2, spark.sparkContext.defaultParallelism), "value")
        pages = landed.parse_pages(dealt, "value", spec)
    else:
        reader = spark.readStream.schema(spec.page_schema)
        pages = reader.option("maxFilesPerTrigger", files_per_batch).json(path)
    records = landed.explode_records(pages, spec).filter(landed.why_rejected(spec).isNull())
    return landed.flatten_records(records, spec, F.current_timestamp())


def rejected_stream(
    spark: SparkSession, path: str, spec: SourceSpec, files_per_batch: int = 1000
) -> DataFrame:
    """Pages and records that :func:`landed_stream` cannot load, for a quarantine table."""
    reader = spark.readStream.schema(landed.page_schema(spec))
    reader = reader.option("columnNameOfCorruptRecord", landed.CORRUPT)
    pages = reader.option("maxFilesPerTrigger", files_per_batch).json(path)
    records = landed.explode_records(pages, spec)
    return landed.rejected_pages(pages).unionByName(landed.rejected_records(records, spec))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came later than the lateness of the job's stateful steps and were not taken.

    Of the last hundred batches, which is what a query remembers; see :class:`BatchLog` for all.
    """
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


class BatchLog(StreamingQueryListener):
    """Writes the progress of every batch of a session's streams to a table.

    A query itself remembers the last hundred only. Each batch is a small file named after the run
    and the batch, so a report that comes twice is one row.

    Use it as ``spark.streams.addListener(BatchLog(spark, path))``; :func:`batch_figures` reads it.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        where = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{progress.runId}-{progress.batchId}.json")
        out = where.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(where, True)
        row = {
            "run_id": str(progress.runId),
            "name": progress.name,
            "batch_id": progress.batchId,
            "ended_at": progress.timestamp,
            "rows": progress.numInputRows,
            "seconds": progress.batchDuration / 1000,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
            "state_rows": sum(s.numRowsTotal for s in progress.stateOperators),
        }
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


BATCH_LOG_SCHEMA = (
    "run_id string, name string, batch_id long, ended_at string, rows long, seconds double, "
    "late_rows long, state_rows long"
)


def batch_figures(spark: SparkSession, path: str) -> DataFrame:
    """Every batch that a :class:`BatchLog` wrote down."""
    return spark.read.schema(BATCH_LOG_SCHEMA).json(path)


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table; the file sink writes every batch exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return (
        writer.option("checkpointLocation", checkpoint)
        .option("compression", tables.CODEC)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def drop_repeats(
    stream: DataFrame, keys: Sequence[str], time: str, lateness: str = "30 days"
) -> DataFrame:
    """First arrival of each key; state older than the allowed lateness is dropped.

    The time is carried as TIMESTAMP, which a watermark needs.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def first_arrivals_stream(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    lateness: dt.timedelta,
) -> StreamingQuery:
    """First arrival of each key to ``root``/arrivals, late rows to ``root``/late.

    A row is late if its time is at or before the greatest time of all earlier batches less
    ``lateness``; rows of one batch never make each other late. A row without a time is never
    late and lies in a part of its own. Of the rows of a key that come in one batch the earliest
    stays; of those with the same time, one by their content. A null in a key is a value like others.

    The state is the table of arrivals, by day, and a row with the greatest time for each batch. A key
    is remembered until the watermark is ``lateness`` beyond its time, as with
    ``dropDuplicatesWithinWatermark``, so a batch reads the keys of that many days. They are not
    shuffled to find the few that the batch has too, if its keys are small enough to broadcast.

    Every table is written by batch, so a batch that is repeated replaces what it left.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        limit = _clock(spark, root, number)
        known = F.col(time).cast("timestamp_ntz")
        is_late = F.lit(False) if limit is None else F.coalesce(known <= F.lit(limit - lateness), F.lit(False))
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            newest = batch.agg(F.max(known)).first()[0]
            _put(batch.filter(is_late), f"{root}/late", number)
            on_time = batch.filter(~is_late)
            first = latest_per_key(on_time, keys, [F.asc_nulls_last(known)])
            if limit is not None:
                first = _unseen(first, root, number, keys, time, limit - 2 * lateness)
            day = F.coalesce(F.date_format(known, "yyyyMMdd").cast("int"), F.lit(0))
            _put(first.withColumn(ARRIVAL_DAY, day), f"{root}/arrivals", number, [ARRIVAL_DAY])
            greatest = max(filter(None, (limit, newest)), default=None)
            _put(spark.createDataFrame([(greatest,)], _CLOCK_SCHEMA), f"{root}/clock", number)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


BATCH, ARRIVAL_DAY = "batch", "arrival_day"
_CLOCK_SCHEMA = "newest timestamp_ntz"


def _put(df: DataFrame, path: str, number: int, partition_by: Sequence[str] = ()) -> None:
    """Write a batch's part of a table, in place of what an earlier attempt left."""
    tables.replace(df, f"{path}/{BATCH}={number}", partition_by)


def _clock(spark: SparkSession, root: str, number: int) -> dt.datetime | None:
    """Greatest time of all batches before this one; each batch has one row, so one file is read."""
    path = f"{root}/clock/{BATCH}={number - 1}"
    if number == 0 or not tables.table_exists(spark, path):
        return None
    return spark.read.schema(_CLOCK_SCHEMA).parquet(path).first()[0]


def _unseen(
    rows: DataFrame, root: str, number: int, keys: Sequence[str], time: str, since: dt.datetime
) -> DataFrame:
    """Rows whose key did not arrive in an earlier batch at a time after ``since``."""
    arrived = rows.sparkSession.read.parquet(f"{root}/arrivals").filter(F.col(BATCH) < number)
    # the day is a partition, so what was forgotten is not opened; without a time it is 0
    arrived = arrived.filter((F.col(ARRIVAL_DAY) >= int(f"{since:%Y%m%d}")) | (F.col(ARRIVAL_DAY) == 0))
    known = F.col(time).cast("timestamp_ntz")
    arrived = arrived.filter(known.isNull() | (known > F.lit(since)))
    names = [f"_seen_{i}" for i in range(len(keys))]

    def same(left: Sequence[str], right: Sequence[str]) -> Column:
        pairs = zip(left, right, strict=True)
        return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])

    seen = arrived.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    seen = seen.join(rows.select(*keys).distinct(), same(names, keys), "left_semi").distinct()
    return rows.join(seen, same(keys, names), "left_anti")


def arrivals(spark: SparkSession, root: str) -> DataFrame:
    """What :func:`first_arrivals_stream` has taken."""
    return spark.read.parquet(f"{root}/arrivals").drop(BATCH, ARRIVAL_DAY)


def late_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Late rows that :func:`first_arrivals_stream` has put aside, with their batch."""
    return spark.read.parquet(f"{root}/late")


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str | Column],
    partition_by: str | None = None,
    partition_is_part_of_key: bool = False,
) -> StreamingQuery:
    """Merge each batch into a Parquet table; the newest version of a key wins.

    Neither a repeated batch nor another order of batches changes the outcome.
    """
    newest_wins = partial(merge_newest, order=order)

    def merge_batch(batch: DataFrame, _: int) -> None:
        newest = latest_per_key(batch, keys, order)
        tables.upsert(
            newest, path, keys, partition_by, partition_is_part_of_key, merge=newest_wins
        )

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def staging_stream(
    raw: DataFrame, spec: SourceSpec, path: str, checkpoint: str
) -> StreamingQuery:
    """Raw stream to a staging table: the batch projection, then an upsert by key.

    Late records are merged too; the batch form skips them until a full refresh.
    """
    projection = staging.staging_spec(spec)
    typed = staging.project(raw, projection.casts, projection.overrides)
    by_month = typed.withColumn(MONTH, tables.month_of("created_at"))
    return upsert_stream(by_month, path, checkpoint, [spec.key], staging.NEWEST_UPDATE, MONTH)


@contextmanager
def _adaptive(spark: SparkSession, setting: str) -> Iterator[None]:
    """Adaptive execution as set, while the rows of a batch are written.

    The engine turns it off in the session of a stream, for the plans of its stateful steps. The rows that
    a batch hands over come from such a plan already; without it their partitions would not be gathered
    (see :func:`pulseframe.sources.tables.upsert`), and every task writes a file into every month.
    """
    before = spark.conf.get(_ADAPTIVE)
    spark.conf.set(_ADAPTIVE, setting)
    try:
        yield
    finally:
        spark.conf.set(_ADAPTIVE, before)


def daily_totals(
    stream: DataFrame,
    user: str,
    time: str,
    totals: Sequence[Column],
    lateness: str = "2 days",
) -> DataFrame:
    """Totals per user and day in tumbling one-day windows."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return (
        timed.groupBy(user, F.window(time, "1 day").alias("w"))
        .agg(*totals)
        .withColumn("day", F.to_date("w.start"))
        .drop("w")
    )


def totals_stream(
    totals: DataFrame, path: str, checkpoint: str, user: str
) -> StreamingQuery:
    """Keep the latest total of every user and day in a Parquet table, by month of the day."""
    adaptive = totals.sparkSession.conf.get(_ADAPTIVE)

    def merge_batch(batch: DataFrame, _: int) -> None:
        by_month = batch.withColumn(MONTH, tables.month_of("day"))
        with _adaptive(batch.sparkSession, adaptive):
            tables.upsert(by_month, path, [user, "day"], MONTH, partition_is_part_of_key=True)

    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
