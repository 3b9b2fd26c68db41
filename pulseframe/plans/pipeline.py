"""Jobs that write the tables in order: staging, dimensions, facts, metrics, checks, reports.

Each table is written before the next one reads it, so a lost executor repeats
tasks of one table only. Raw tables lie by day of ingestion, staging tables by
month of creation, facts and metrics by month of the day. An incremental run
looks up its watermark as one row, and puts it on the scans as a literal: of raw
tables it reads the days of ingestion since then, of the others the months that
its new rows belong to.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators import moments, quality
from pulseframe.operators.incremental import after_watermark, update_matched
from pulseframe.plans import checks, dims, facts, metrics, records, reports, staging
from pulseframe.sources import extract, tables
from pulseframe.sources.specs import SOURCES

STAGED = ("cycle", "recovery", "sleep", "workout")
MONTH = "month"
CHECKS_TABLE = "check_results"
PENDING_RANKS = "pending_ranks"
# Recovery rows that came and went since the seasons' state was brought up to date, by watermark.
PENDING_DAYS = "pending_days"
SEASON_STATE = "season_moments"
RECOVERY, STRAIN, DAYS = "fact_daily_recovery", "fact_daily_strain", "dim_date"
# Metric table that each report reads.
REPORTS = {
    "momentum": "recovery_momentum",
    "efficiency": "strain_recovery_efficiency",
    "readiness": "training_readiness_gap",
    "volatility": "recovery_volatility",
    "balance": "autonomic_balance",
    "seasonal": "seasonal_adaptation",
}


def _raw(
    spark: SparkSession, root: str, source: str, since: dt.datetime | None = None
) -> DataFrame:
    """Raw rows, of the days of ingestion from ``since`` on."""
    spec = SOURCES[source]
    raw = tables.read_table(spark, f"{root}/{spec.table}", spec.raw_schema)
    if since is not None and extract.INGEST_DAY in raw.columns:
        raw = raw.filter(F.col(extract.INGEST_DAY) >= int(f"{since:%Y%m%d}"))
    return raw.drop(extract.INGEST_DAY)


def month_number(day: dt.date) -> int:
    return day.year * 100 + day.month


def _read(
    spark: SparkSession, root: str, name: str, first_month: int | None = None
) -> DataFrame:
    """A table, from a month on; the month is a partition, so earlier files are not opened."""
    table = spark.read.parquet(f"{root}/{name}")
    if first_month is not None:
        table = table.filter(F.col(MONTH) >= first_month)
    return table.drop(MONTH)


def _newest(spark: SparkSession, root: str, name: str, *columns: str) -> list[dt.datetime | None]:
    """Greatest values of columns in the last month of a table.

    The last month is the greatest name of a partition folder, so no other file is opened.
    """
    path = f"{root}/{name}"
    tables.recover(spark, path)
    last = tables.last_partition(spark, path, MONTH)
    table = spark.read.parquet(path)
    if last is not None:
        table = table.filter(F.col(MONTH) == int(last))
    return list(table.agg(*[F.max(c) for c in columns]).first())


def _created_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, tables.month_of("created_at"))


def _day_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, (F.col("date_sk") / 100).cast("int"))


def build_staging(
    spark: SparkSession, root: str, source: str, full_refresh: bool = False
) -> None:
    """Write or upsert one staging table, laid out by month of creation.

    A row that is not staged yet was ingested after the newest staged one, or on the same day.
    """
    path, rows = f"{root}/stg_{source}", checks.staging_rows(SOURCES[source].key)
    if full_refresh or not tables.table_exists(spark, path):
        raw = _raw(spark, root, source)
        tables.replace(_created_month(staging.stage(raw, source)), path, [MONTH], checks=rows)
        return
    created, ingested = _newest(spark, root, f"stg_{source}", "created_at", "ingested_at")
    raw = _raw(spark, root, source, since=ingested)
    if created is not None:
        raw = after_watermark(raw, "created_at", created)
    tables.upsert(_created_month(staging.stage(raw, source)), path, [SOURCES[source].key], MONTH, checks=rows)


def build_dims(spark: SparkSession, root: str) -> None:
    tables.replace(staging.stage_user(_raw(spark, root, "user")), f"{root}/stg_user")
    tables.replace(dims.dim_user(_read(spark, root, "stg_user")), f"{root}/dim_user")
    tables.replace(dims.dim_date(spark), f"{root}/dim_date")


def _write_fact(
    df: DataFrame,
    path: str,
    keys: list[str],
    full_refresh: bool,
    rows: Sequence[quality.RowCheck] = (),
) -> None:
    """Facts lie by month of the day and sorted by user and day inside a file."""
    laid_out = _day_month(df)
    if full_refresh or not tables.table_exists(df.sparkSession, path):
        tables.replace(laid_out, path, [MONTH], ["user_sk", "date_sk"], rows)
    else:
        tables.upsert(
            laid_out,
            path,
            keys,
            MONTH,
            partition_is_part_of_key=True,
            on_schema_change="append_new_columns",
            checks=rows,
        )


def build_percentiles(spark: SparkSession, root: str, full_refresh: bool = False) -> None:
    """Percentiles, ranked over the full history.

    An incremental run reads the staged recoveries from the month of the newest one in the fact on, and
    the stored percentiles, which carry their measures, of users with new days. It writes the
    rows that differ from the stored ones, and leaves them as pending for :func:`refresh_ranks`.
    """
    path = f"{root}/int_recovery_percentiles"
    since = None if full_refresh else _recovery_watermark(spark, root)
    users, days = _read(spark, root, "dim_user"), _read(spark, root, DAYS)
    if since is None or not tables.table_exists(spark, path):
        whole = facts.recovery_percentiles(_read(spark, root, "stg_recovery"), users, days, keep=facts.MEASURES)
        _write_fact(whole, path, ["user_sk", "date_sk"], True)
        return
    recent = _read(spark, root, "stg_recovery", month_number(since))
    recent = recent.withColumn("day", F.to_date("created_at"))
    fresh = after_watermark(recent, "created_at", since).select("user_id", "day").distinct()
    new = facts.recovery_days(recent.join(fresh, ["user_id", "day"], "left_semi"), users, days)
    changed = facts.renew_percentiles(_read(spark, root, "int_recovery_percentiles"), new)
    # Written first: the table that it is merged into is one of its inputs. Each run has its own part, so
    # one that stops before the fact is renewed leaves its rows to the next.
    pending = f"{root}/{PENDING_RANKS}/run={uuid.uuid4().hex}"
    tables.replace(changed, pending)
    _write_fact(spark.read.parquet(pending), path, ["user_sk", "date_sk"], False)


def refresh_ranks(spark: SparkSession, root: str) -> None:
    """Give the recovery fact the ranks that new days have changed, whatever the age of the row.

    What is pending is removed at the end, so a run that stops before leaves it to the next one.
    """
    pending, path = f"{root}/{PENDING_RANKS}", f"{root}/{RECOVERY}"
    if not tables.table_exists(spark, pending):
        return
    ranks = [*facts.RANKED, "skin_temp_deviation"]
    keys = spark.read.parquet(pending).select("user_sk", "date_sk").distinct()
    months = keys.select((F.col("date_sk") / 100).cast("int").alias(MONTH)).distinct().collect()
    current = spark.read.parquet(f"{root}/int_recovery_percentiles").filter(F.col(MONTH).isin([r[0] for r in months]))
    current = current.select("user_sk", "date_sk", *ranks).join(keys, ["user_sk", "date_sk"], "left_semi")
    kind = spark.read.parquet(path).schema["skin_temp_deviation"].dataType
    current = current.withColumn("skin_temp_deviation", F.col("skin_temp_deviation").cast(kind))
    tables.upsert(
        _day_month(current),
        path,
        ["user_sk", "date_sk"],
        MONTH,
        partition_is_part_of_key=True,
        merge=partial(update_matched, update=ranks),
        on_schema_change="append_new_columns",
        checks=checks.recovery_rows(),
    )
    tables.remove(spark, pending)


def _recovery_watermark(spark: SparkSession, root: str) -> dt.datetime | None:
    if not tables.table_exists(spark, f"{root}/{RECOVERY}"):
        return None
    return _newest(spark, root, RECOVERY, "created_timestamp")[0]


def build_fact_recovery(spark: SparkSession, root: str, full_refresh: bool = False) -> None:
    """Recovery fact; an incremental run reads its inputs from the month of the newest row on.

    Sleeps and percentiles belong to the day of a recovery, so earlier months have none that fit.
    Earlier rows get the ranks that the new days have changed.
    """
    path = f"{root}/{RECOVERY}"
    since = None if full_refresh else _recovery_watermark(spark, root)
    month = None if since is None else month_number(since)
    recovery = _read(spark, root, "stg_recovery", month)
    if since is not None:
        recovery = after_watermark(recovery, "created_at", since)
    fact = facts.fact_daily_recovery(
        recovery,
        _read(spark, root, "dim_user"),
        _read(spark, root, "dim_date"),
        _read(spark, root, "int_recovery_percentiles", month),
        _read(spark, root, "stg_sleep", month),
    )
    keys = ["user_sk", "date_sk"]
    if since is None:
        _write_fact(fact, path, keys, True, checks.recovery_rows())
        for name in (PENDING_RANKS, PENDING_DAYS, SEASON_STATE):
            tables.remove(spark, f"{root}/{name}")
        return
    # Named by the watermark: a run that is repeated writes its part again, not another one.
    part = f"{root}/{PENDING_DAYS}/since={since:%Y%m%d%H%M%S%f}"
    columns = [*keys, *metrics.SEASON_MEASURES.values()]
    come = f"{part}/sign=1"
    tables.replace(fact, come)
    fact = spark.read.parquet(come)
    gone = _read(spark, root, RECOVERY, month).select(*columns).join(fact.select(*keys), keys, "left_semi")
    tables.replace(gone, f"{part}/sign=-1")
    _write_fact(fact, path, keys, False, checks.recovery_rows())
    refresh_ranks(spark, root)


def build_season_state(spark: SparkSession, root: str) -> DataFrame | None:
    """Bring the seasons' state up to date; (user_sk, season) that changed, or None if all did.

    An incremental run reads what is pending and the state of those years only. What is pending is left
    to :func:`build_seasonal`, and merged once, however often a run is repeated.
    """
    path, pending = f"{root}/{SEASON_STATE}", f"{root}/{PENDING_DAYS}"
    days, names = _read(spark, root, DAYS), list(metrics.SEASON_MEASURES.values())
    if not tables.table_exists(spark, path):
        whole = metrics.season_moments(metrics.with_season(_read(spark, root, RECOVERY), days))
        whole = whole.withColumn(moments.APPLIED, F.lit(""))
        tables.replace(whole, path, ["year_number"])
        tables.remove(spark, pending)
        return None
    changed = None
    for name in tables.entries(spark, pending):
        rows = spark.read.parquet(f"{pending}/{name}")
        part = metrics.season_moments(metrics.with_season(rows, days, ["sign"]), F.col("sign"))
        years = [r[0] for r in part.select("year_number").distinct().collect()]
        state = spark.read.parquet(path).filter(F.col("year_number").isin(years))
        merged = moments.merge_part(state, part, metrics.SEASON_KEYS, names, name.partition("=")[2])
        tables.upsert(merged, path, metrics.SEASON_KEYS, "year_number", partition_is_part_of_key=True)
        found = part.select("user_sk", "season")
        changed = found if changed is None else changed.unionByName(found)
    return changed.distinct() if changed is not None else _read(spark, root, DAYS).limit(0).select(
        F.lit("").alias("user_sk"), "season"
    )


def build_seasonal(spark: SparkSession, root: str, at: Column, full_refresh: bool = False) -> None:
    """The seasonal metric from the seasons' state.

    An incremental run renews the rows of users and seasons with new days: it reads the months of
    those seasons of the fact, whatever the year, since their baseline is another one now.
    """
    path = f"{root}/seasonal_adaptation"
    if full_refresh:
        tables.remove(spark, f"{root}/{SEASON_STATE}")
    changed = build_season_state(spark, root)
    baselines = metrics.season_baselines(metrics.season_years_from(spark.read.parquet(f"{root}/{SEASON_STATE}")))
    days = _read(spark, root, DAYS)
    if changed is None or not tables.table_exists(spark, path):
        rows = metrics.adaptation_from(metrics.with_season(_read(spark, root, RECOVERY), days), baselines)
        _write_fact(metrics.with_calculated_at(rows, at), path, ["user_sk", "date_sk"], True)
    else:
        # four seasons, twelve months
        seasons = [r[0] for r in changed.select("season").distinct().collect()]
        months = [r[0] for r in days.filter(F.col("season").isin(seasons)).select("month_of_year").distinct().collect()]
        fact = spark.read.parquet(f"{root}/{RECOVERY}").filter((F.col(MONTH) % 100).isin(months)).drop(MONTH)
        keys = ["user_sk", "season"]
        rows = metrics.with_season(fact, days).join(changed, keys, "left_semi")
        rows = metrics.adaptation_from(rows, baselines.join(changed, keys, "left_semi"))
        _write_fact(metrics.with_calculated_at(rows, at), path, ["user_sk", "date_sk"], False)
    tables.remove(spark, f"{root}/{PENDING_DAYS}")


def _months(df: DataFrame) -> list[int]:
    """Months of creation of some rows: as many as there are partitions."""
    found = df.select(tables.month_of("created_at").alias(MONTH)).distinct().collect()
    return [r[MONTH] for r in found if r[MONTH] is not None]


def build_fact_strain(
    spark: SparkSession,
    root: str,
    run_at: dt.datetime,
    full_refresh: bool = False,
    late_workouts: bool = False,
) -> None:
    """Strain fact; an incremental run reads cycles and workouts of the months with new ones.

    With ``late_workouts`` a workout that arrives after its cycle makes its day count again.
    """
    path = f"{root}/{STRAIN}"
    full_refresh = full_refresh or not tables.table_exists(spark, path)
    cycles = spark.read.parquet(f"{root}/stg_cycle")
    workouts = spark.read.parquet(f"{root}/stg_workout")
    since = None
    if not full_refresh:
        # One column of the fact: updates come to days of any month.
        since = _read(spark, root, STRAIN).agg(F.max("source_updated_at")).first()[0]
        since = since or facts.STRAIN_FLOOR
        touched = _months(after_watermark(cycles, "updated_at", since))
        if late_workouts:
            touched += _months(after_watermark(workouts, "updated_at", since))
        cycles, workouts = (t.filter(F.col(MONTH).isin(touched)) for t in (cycles, workouts))
    fact = facts.fact_daily_strain(
        cycles.drop(MONTH),
        workouts.drop(MONTH),
        _read(spark, root, "dim_user"),
        _read(spark, root, "dim_date"),
        run_at=F.lit(run_at.isoformat(sep=" ")),
        since=since,
        late_workouts=late_workouts,
    )
    _write_fact(fact, path, ["user_sk", "date_sk"], full_refresh, checks.strain_rows())


# Metric tables: the function and the tables it reads.
METRICS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "recovery_momentum": (metrics.recovery_momentum, (RECOVERY,)),
    "recovery_volatility": (metrics.recovery_volatility, (RECOVERY,)),
    "autonomic_balance": (metrics.autonomic_balance, (RECOVERY,)),
    "strain_recovery_efficiency": (metrics.strain_recovery_efficiency, (STRAIN, RECOVERY)),
    "strain_sustainability": (metrics.strain_sustainability, (STRAIN,)),
    "training_readiness_gap": (metrics.training_readiness_gap, (RECOVERY, STRAIN)),
    "seasonal_adaptation": (metrics.seasonal_adaptation, (RECOVERY, DAYS)),
}


def build_metrics(
    spark: SparkSession, root: str, run_at: dt.datetime, full_refresh: bool = True
) -> None:
    """Write the metric tables, laid out by month.

    Each fact is shuffled by user once, and all metrics read that layout: a row needs the frames
    of its user's whole history, so the tables are rebuilt in full; only the seasonal one is
    renewed from its state.
    """
    at = F.lit(run_at.isoformat(sep=" "))
    inputs = {
        name: _read(spark, root, name).repartition("user_sk").persist(StorageLevel.MEMORY_AND_DISK)
        for name in (RECOVERY, STRAIN)
    }
    try:
        for name, (build, needs) in METRICS.items():
            if name == "seasonal_adaptation":
                continue
            df = metrics.with_calculated_at(build(*[inputs[n] for n in needs]), at)
            tables.replace(_day_month(df), f"{root}/{name}", [MONTH])
    finally:
        for name in (RECOVERY, STRAIN):
            inputs[name].unpersist()
    build_seasonal(spark, root, at, full_refresh)


def _at_ends(spark: SparkSession, root: str, run_at: dt.datetime) -> DataFrame:
    """Strain rows of the months that can hold days too old or in the future; others cannot fail."""
    now = month_number(run_at)
    month = F.col(MONTH)
    ends = month.isNull() | (month <= now - 100 * checks.MAX_AGE_YEARS) | (month >= now)
    return spark.read.parquet(f"{root}/{STRAIN}").filter(ends).drop(MONTH)


def run_checks(spark: SparkSession, root: str, run_at: dt.datetime) -> DataFrame:
    """All checks of the written tables: staging, facts, batch volumes and freshness.

    Row checks were counted as the tables were written, so no table is read for them. Appends one row per check to the table of results and returns these rows.
    """
    as_of = F.lit(run_at.date())

    def suite(name: str, results: DataFrame) -> DataFrame:
        return results.select(F.lit(name).alias("suite"), "test", "failures", "should_warn", "should_error")

    def kept(name: str, rows: list[quality.RowCheck]) -> DataFrame:
        failures = tables.failures(spark, f"{root}/{name}", rows, MONTH)
        return suite(name, quality.counted(spark, failures))

    parts = []
    for name, key in ((f"stg_{s}", SOURCES[s].key) for s in STAGED):
        parts.append(kept(name, checks.staging_rows(key)))
        staged = _read(spark, root, name)
        parts.append(suite(name, quality.run_suite(staged, [], checks.staging_keys(staged, key))))
    users, days = _read(spark, root, "dim_user"), _read(spark, root, DAYS)
    strain, recovery = _read(spark, root, STRAIN), _read(spark, root, RECOVERY)
    parts += [kept(STRAIN, checks.strain_rows()), kept(RECOVERY, checks.recovery_rows())]
    parts.append(suite(STRAIN, quality.run_suite(strain, [], checks.strain_keys(strain, users, days))))
    parts.append(suite(STRAIN, quality.run_suite(_at_ends(spark, root, run_at), checks.date_checks(as_of))))
    parts.append(suite(RECOVERY, quality.run_suite(recovery, [], checks.recovery_keys(recovery))))
    if tables.table_exists(spark, f"{root}/{extract.RUN_LOG_TABLE}"):
        log = spark.read.schema(extract.RUN_LOG_SCHEMA).parquet(f"{root}/{extract.RUN_LOG_TABLE}")
        last = log.filter(F.col("run_at") == log.agg(F.max("run_at")).scalar())
        status = quality.volume_status(F.col("source"), F.col("records"))
        volumes = last.select(
            F.concat(F.lit("volume_"), "source").alias("test"),
            (status != "ok").cast("long").alias("failures"),
            (status == "warn").alias("should_warn"),
            F.lit(False).alias("should_error"),
        )
        parts.append(suite("volume", volumes))
    for s in STAGED:
        fresh = quality.freshness(
            _read(spark, root, f"stg_{s}"),
            "ingested_at",
            F.lit(run_at.isoformat(sep=" ")),
            checks.FRESHNESS_DAYS["warn"],
            checks.FRESHNESS_DAYS["error"],
        )
        fresh = fresh.select(
            F.lit(f"freshness_{s}").alias("test"),
            (F.col("status") != "pass").cast("long").alias("failures"),
            (F.col("status") != "pass").alias("should_warn"),
            (F.col("status") == "error").alias("should_error"),
        )
        parts.append(suite("freshness", fresh))
    found = reduce(DataFrame.unionByName, parts)
    at = F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz")
    path = f"{root}/{CHECKS_TABLE}"
    tables.append(found.withColumn("run_at", at).coalesce(1), path)
    written = spark.read.parquet(path)
    return written.filter(F.col("run_at") == at)


def build_reports(
    spark: SparkSession, root: str, as_of: dt.date, days: int | None = None
) -> Mapping[str, DataFrame]:
    """Every report over the written metric tables; a range of days opens the files of its months."""
    first = None if days is None else month_number(as_of - dt.timedelta(days=days))
    found = {name: _read(spark, root, table, first) for name, table in REPORTS.items()}
    return reports.all_reports(found, _read(spark, root, DAYS), F.lit(as_of), days)


def build_all(
    spark: SparkSession,
    root: str,
    run_at: dt.datetime,
    full_refresh: bool = False,
    late_workouts: bool = False,
) -> DataFrame:
    """Everything after extraction; returns the results of the checks."""
    for source in STAGED:
        build_staging(spark, root, source, full_refresh)
    build_dims(spark, root)
    build_percentiles(spark, root, full_refresh)
    build_fact_recovery(spark, root, full_refresh)
    build_fact_strain(spark, root, run_at, full_refresh, late_workouts)
    build_metrics(spark, root, run_at, full_refresh)
    return run_checks(spark, root, run_at)


def backfill_recovery(spark: SparkSession, root: str) -> DataFrame:
    """Rebuild the recovery fact and what it reads, then return its checks."""
    for source in ("recovery", "sleep"):
        build_staging(spark, root, source, full_refresh=True)
    build_dims(spark, root)
    build_percentiles(spark, root, full_refresh=True)
    build_fact_recovery(spark, root, full_refresh=True)
    return checks.recovery_suite(_read(spark, root, "fact_daily_recovery"))


def backfill_range(
    spark: SparkSession, root: str, source: str, first: dt.date, last: dt.date
) -> None:
    """Stage again the records created in a date range, whatever the watermark says."""
    raw = records.created_between(_raw(spark, root, source), first, last)
    batch, key = _created_month(staging.stage(raw, source)), SOURCES[source].key
    tables.upsert(batch, f"{root}/stg_{source}", [key], MONTH, checks=checks.staging_rows(key))
