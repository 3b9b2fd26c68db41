"""Queries: whole tables, reports, quality checks, streams, documented tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulseframe.catalog import inputs
from pulseframe.catalog.registry import Registry
from pulseframe.catalog.source_queries import page_texts
from pulseframe.operators import incremental, moments, quality
from pulseframe.plans import checks, dims, facts, metrics, pipeline, records, reports, staging
from pulseframe.session import scratch_path
from pulseframe.sources import tables
from pulseframe.sources.specs import SOURCES
from pulseframe.streaming import jobs

query = Registry()

FRESH_AS_OF = "2024-02-02"
LATENESS_DAYS = 10
# Where the second part of incremental runs begins: in the middle of a day, so that the day is in both.
INCREMENT_FROM = "2025-06-15 12:00:00"
# Days that a state has with other values than they get later.
WRONG_DAYS = 20250601, 20250614
# Added to the user ids of the late batch.
OTHER_USERS = 1_000_000
# End of the first of three batches.
EARLY_END = "2024-01-16"


def _as_of() -> Column:
    return F.lit(inputs.AS_OF).cast("date")


# Whole tables

# Sources whose records are so wide that a map task cannot sort its part in memory.
WIDE = ("sleep", "workout")


def _staging_query(source: str) -> None:
    query.add(f"stg_{source}", lambda s, d: inputs.staged(s, d, source, whole=source in WIDE))


for _source in pipeline.STAGED:
    _staging_query(_source)


@query("stg_user")
def _(spark, sf_dir):
    return staging.stage_user(inputs.raw(spark, sf_dir, "user"))


@query("dim_user")
def _(spark, sf_dir):
    return inputs.users(spark, sf_dir)


def _days_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that occur in the data, with their row count."""
    return inputs.lines(spark, sf_dir).groupBy("day").agg(F.count("*").alias("n_rows"))


def _with_use(spark: SparkSession, sf_dir: str, dim: DataFrame) -> DataFrame:
    """Every calendar day, with the number of rows the data has for it."""
    days = _days_in_use(spark, sf_dir).withColumnRenamed("day", "date_day")
    return dim.join(days, "date_day", "left").na.fill(0, ["n_rows"])


@query("dim_date")
def _(spark, sf_dir):
    """The whole calendar."""
    return _with_use(spark, sf_dir, dims.dim_date(spark))


@query("doc_dim_date_weekend")
def _(spark, sf_dir):
    dim = dims.with_weekend(dims.dim_date(spark).select("date_sk", "date_day"))
    return _with_use(spark, sf_dir, dim)


@query("doc_dim_date_extra")
def _(spark, sf_dir):
    dim = dims.with_extra_columns(dims.dim_date(spark).select("date_sk", "date_day"), _as_of())
    return _with_use(spark, sf_dir, dim)


@query("int_recovery_percentiles")
def _(spark, sf_dir):
    return inputs.percentiles(spark, sf_dir)


def _written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a temporary table, so that its plan runs once however often it is read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=tables.CODEC)
    return df.sparkSession.read.parquet(path)


@query("inc_recovery_percentiles")
def _(spark, sf_dir):
    """Percentiles of all days but those of the last records, written; then those that the rest changes, merged."""
    # Each is read more than once below, so each is written, as the pipeline's tables are.
    staged = _written(inputs.staged(spark, sf_dir, "recovery").select(*facts.RECOVERY_COLUMNS), "staged-recovery")
    dimensions = inputs.users(spark, sf_dir), dims.dim_date(spark)
    first = facts.recovery_days(staged.filter(F.col("created_at") < INCREMENT_FROM), *dimensions)
    stored = _written(facts.rank_days(first, keep=facts.MEASURES), "percentiles")
    days = staged.withColumn("day", F.to_date("created_at"))
    fresh = days.filter(F.col("created_at") >= INCREMENT_FROM).select("user_id", "day").distinct()
    recent = days.filter(F.col("day") >= F.to_date(F.lit(INCREMENT_FROM)))
    new = facts.recovery_days(recent.join(fresh, ["user_id", "day"], "left_semi"), *dimensions)
    changed = _written(facts.renew_percentiles(stored, _written(new, "new-days")), "changed-percentiles")
    return incremental.merge_upsert(stored, changed, ["user_sk", "date_sk"]).drop(*facts.MEASURES)


@query("fact_daily_recovery")
def _(spark, sf_dir):
    return inputs.fact_recovery(spark, sf_dir).drop("recovery_sk")


@query("fact_daily_strain")
def _(spark, sf_dir):
    return inputs.fact_strain(spark, sf_dir).drop("created_timestamp")


def _metric_query(name: str) -> None:
    query.add(name, lambda s, d: inputs.metric(s, d, name))


for _metric in pipeline.METRICS:
    _metric_query(_metric)


def _season_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All days with their seasons, and a state that was written before the last of them came.

    The state has other scores for two weeks of days, which are taken away again, and lacks all later days.
    """
    dated = metrics.with_season(inputs.fact_recovery(spark, sf_dir), dims.dim_date(spark))
    path = scratch_path(spark, "season-days")
    dated.write.parquet(path)
    dated = spark.read.parquet(path)
    first, last = WRONG_DAYS
    wrong = dated.filter(F.col("date_sk").between(first, last)).withColumn("recovery_score", F.col("recovery_score") + 5)
    old = dated.filter(F.col("date_sk") < first).unionByName(wrong.select(dated.columns))
    path = scratch_path(spark, "season-moments")
    metrics.season_moments(old).withColumn(moments.APPLIED, F.lit("1")).write.parquet(path)
    state = spark.read.parquet(path)
    come = dated.filter(F.col("date_sk") >= first).withColumn("sign", F.lit(1))
    part = metrics.season_moments(come.unionByName(wrong.withColumn("sign", F.lit(-1))), F.col("sign"))
    names = list(metrics.SEASON_MEASURES.values())
    changed = moments.merge_part(state, part, metrics.SEASON_KEYS, names, "2")
    return dated, incremental.merge_upsert(state, changed, list(metrics.SEASON_KEYS))


@query("inc_season_year")
def _(spark, sf_dir):
    """Means, spread and size per user, season and year from a state and the days that changed it."""
    return metrics.season_years_from(_season_state(spark, sf_dir)[1])


@query("inc_seasonal_adaptation")
def _(spark, sf_dir):
    """The seasonal metric from that state."""
    dated, state = _season_state(spark, sf_dir)
    return metrics.adaptation_from(dated, metrics.season_baselines(metrics.season_years_from(state)))


@query("backfill_recovery")
def _(spark, sf_dir):
    """Raw tables written, recovery fact rebuilt from them, then checked."""
    root = scratch_path(spark, "backfill")
    for source in ("recovery", "sleep", "user"):
        tables.append(inputs.raw(spark, sf_dir, source), f"{root}/raw_{source}")
    return pipeline.backfill_recovery(spark, root)


# Reports

REPORTS = {
    "report_momentum": ("momentum", "recovery_momentum"),
    "report_efficiency": ("efficiency", "strain_recovery_efficiency"),
    "report_readiness": ("readiness", "training_readiness_gap"),
    "report_volatility": ("volatility", "recovery_volatility"),
    "report_balance": ("balance", "autonomic_balance"),
    "report_seasonal": ("seasonal", "seasonal_adaptation"),
}
REPORT_DAYS = 365


def _report_rows(
    spark: SparkSession, sf_dir: str, name: str, days: int | None = REPORT_DAYS
) -> DataFrame:
    short, metric = REPORTS[name]
    return reports.report_rows(
        short, inputs.metric(spark, sf_dir, metric), dims.dim_date(spark), _as_of(), days
    )


def _report_query(name: str) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        short, metric = REPORTS[name]
        rows = reports.report(
            short, inputs.metric(spark, sf_dir, metric), dims.dim_date(spark), _as_of(), REPORT_DAYS
        )
        return reports.chart_columns(rows, short)

    query.add(name, build)


for _report in REPORTS:
    _report_query(_report)


@query("sort_by_date")
def _(spark, sf_dir):
    rows = inputs.daily(spark, sf_dir).select("day", "user_sk", "recovery_score")
    return rows.orderBy("day", "user_sk")


@query("latest_row")
def _(spark, sf_dir):
    return reports.current_values(_report_rows(spark, sf_dir, "report_volatility"), "volatility")


@query("agg_kpi_mean")
def _(spark, sf_dir):
    return reports.key_means(_report_rows(spark, sf_dir, "report_momentum"), "momentum")


@query("agg_kpi_sum_bool")
def _(spark, sf_dir):
    return reports.risk_days(_report_rows(spark, sf_dir, "report_readiness", None))


@query("agg_value_counts")
def _(spark, sf_dir):
    rows = _report_rows(spark, sf_dir, "report_momentum", None)
    return reports.distribution(rows, "momentum_category")


@query("sort_counts_desc")
def _(spark, sf_dir):
    rows = _report_rows(spark, sf_dir, "report_volatility", None)
    return reports.distribution(rows, "volatility_category")


@query("agg_season_summary")
def _(spark, sf_dir):
    return reports.season_summary(_report_rows(spark, sf_dir, "report_seasonal", None))


# Data quality


@query("dq_not_null")
def _(spark, sf_dir):
    rows = quality.not_null(inputs.raw(spark, sf_dir, "recovery"), "skin_temp_celsius")
    return rows.select("cycle_id", "user_id", "ingested_at")


@query("dq_unique")
def _(spark, sf_dir):
    return quality.unique(inputs.raw(spark, sf_dir, "cycle"), "id")


@query("agg_having_dup")
def _(spark, sf_dir):
    return quality.unique(inputs.read(spark, sf_dir, "lineitem"), "l_partkey")


@query("dq_unique_combo")
def _(spark, sf_dir):
    return quality.unique_combination(inputs.lines(spark, sf_dir), ["user_sk", "day"])


@query("dq_relationships")
def _(spark, sf_dir):
    orders = inputs.read(spark, sf_dir, "orders")
    # Suppliers have fewer keys than customers, so some orders have no parent among them.
    return quality.orphans(orders, "o_custkey", inputs.read(spark, sf_dir, "supplier"), "s_suppkey")


@query("dq_accepted_range")
def _(spark, sf_dir):
    orders = inputs.read(spark, sf_dir, "orders")
    rows = quality.accepted_range(
        orders, "o_totalprice", 1000, 400000, where="o_orderstatus <> 'P'"
    )
    return rows.select("o_orderkey", "o_totalprice")


@query("dq_accepted_values")
def _(spark, sf_dir):
    events = inputs.read(spark, sf_dir, "events")
    return quality.accepted_values(events, "event_type", ["click", "view"])


@query("dq_expression")
def _(spark, sf_dir):
    lines = inputs.read(spark, sf_dir, "lineitem")
    rows = quality.expression_holds(
        lines, "l_quantity * 1000 + l_extendedprice <= 120000", "l_returnflag is not null"
    )
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def _fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(
        inputs.read(spark, sf_dir, "events"),
        "ts",
        F.lit(FRESH_AS_OF),
        checks.FRESHNESS_DAYS["warn"],
        checks.FRESHNESS_DAYS["error"],
        f"ts > '{checks.FRESHNESS_SINCE}'",
    )


query.add("dq_freshness", _fresh)


@query("stream_freshness")
def _(spark, sf_dir):
    """Freshness of a table that a stream wrote."""
    root = scratch_path(spark, "fresh")
    jobs.append_stream(_event_stream(spark, sf_dir), f"{root}/t", f"{root}/c").awaitTermination()
    return quality.freshness(
        spark.read.parquet(f"{root}/t"),
        "ts",
        F.lit("2024-02-08"),
        checks.FRESHNESS_DAYS["warn"],
        checks.FRESHNESS_DAYS["error"],
    )


@query("dq_volume")
def _(spark, sf_dir):
    """Batch sizes per user, and of the profiles; a source without records counts zero."""
    lines = inputs.lines(spark, sf_dir).select(F.col("user_sk").alias("source"))
    some = inputs.users(spark, sf_dir).select(F.col("user_id").alias("source"))
    profiles = some.select(F.lit("user").alias("source"))
    more = some.select(F.concat(F.lit("new-"), "source").alias("source"))
    expected = some.unionByName(more).unionByName(profiles.distinct())
    return quality.volume(lines.unionByName(profiles), "source", expected)


@query("agg_test_summary")
def _(spark, sf_dir):
    failing = quality.not_null(inputs.raw(spark, sf_dir, "recovery"), "skin_temp_celsius")
    return quality.summarize(failing, "not_null_skin_temp_celsius")


@query("dq_suite")
def _(spark, sf_dir):
    """All checks of the strain fact, on a fact that breaks some of them."""
    fact = inputs.fact_strain(spark, sf_dir, with_limits=True)
    users = inputs.users(spark, sf_dir, moved=inputs.MOVED_USERS)
    suite = checks.strain_suite(
        fact, users, dims.dim_date(spark), _as_of(), written=lambda keys: _written(keys, "strain-keys")
    )
    staged = checks.staging_suite(inputs.raw(spark, sf_dir, "cycle"), "id")
    return suite.unionByName(staged.withColumn("test", F.concat(F.lit("raw_"), "test")))


# Streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = inputs.read(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


def _in_batches(
    spark: SparkSession, parts: Sequence[DataFrame], start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Run a stream whose batches are the given frames: each lands, and the stream goes on where it was."""
    path = scratch_path(spark, "batches")
    for part in parts:
        tables.append(part, path)
        start(spark.readStream.schema(part.schema).parquet(path)).awaitTermination()


@query("stream_ingest")
def _(spark, sf_dir):
    root, pages = scratch_path(spark, "ingest"), scratch_path(spark, "landed")
    # Names and times that every page repeats take most of its text.
    page_texts(spark, sf_dir, "cycle").write.text(pages, compression="gzip")
    stream = jobs.landed_stream(spark, pages, SOURCES["cycle"], files_per_batch=2, deal_lines=True)
    jobs.append_stream(stream, f"{root}/raw", f"{root}/check").awaitTermination()
    return spark.read.parquet(f"{root}/raw").drop("ingested_at")


@query("stream_dedup_upsert")
def _(spark, sf_dir):
    """Versions of a record come in different batches, in no order."""
    root = scratch_path(spark, "upsert")
    rows = inputs.raw(spark, sf_dir, "cycle")
    third = F.pmod(F.xxhash64("user_id", "updated_at"), F.lit(3))
    _in_batches(
        spark,
        [rows.filter(third == k) for k in range(3)],
        lambda stream: jobs.staging_stream(stream, SOURCES["cycle"], f"{root}/stg", f"{root}/check"),
    )
    return spark.read.parquet(f"{root}/stg").drop(jobs.MONTH)


def _arrivals_in(spark: SparkSession, parts: Sequence[DataFrame]) -> str:
    """First arrivals by user and type of events; returns the folder of the tables."""
    root = scratch_path(spark, "late")
    lateness = dt.timedelta(days=LATENESS_DAYS)
    _in_batches(
        spark,
        parts,
        lambda stream: jobs.first_arrivals_stream(
            stream, root, f"{root}/check", ["user_id", "event_type"], "ts", lateness
        ),
    )
    return root


def _events_of(spark: SparkSession, sf_dir: str, moved: int) -> DataFrame:
    events = inputs.read(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    return events.withColumn("user_id", F.col("user_id") + moved * OTHER_USERS)


@query("stream_late_data")
def _(spark, sf_dir):
    """First arrivals by key. The second batch has the same times again under other users; what is
    older than the lateness by then is not taken."""
    root = _arrivals_in(spark, [_events_of(spark, sf_dir, k) for k in range(2)])
    return jobs.arrivals(spark, root).select("user_id", "event_type")


@query("stream_late_rows")
def _(spark, sf_dir):
    """Late rows of three batches: events up to a time, then all of them under other users, twice."""
    early = _events_of(spark, sf_dir, 0).filter(F.col("ts") < EARLY_END)
    root = _arrivals_in(spark, [early, _events_of(spark, sf_dir, 1), _events_of(spark, sf_dir, 2)])
    return jobs.late_arrivals(spark, root).select("user_id", "event_type", "ts", "batch")


@query("stream_daily_workout")
def _(spark, sf_dir):
    """Daily totals of all workout records, which come year by year."""
    root = scratch_path(spark, "totals")
    rows = inputs.raw(spark, sf_dir, "workout")
    year = F.year("created_at")
    spec = staging.staging_spec(SOURCES["workout"])

    def start(stream: DataFrame) -> StreamingQuery:
        typed = staging.project(stream, spec.casts, spec.overrides)
        totals = jobs.daily_totals(typed, "user_id", "created_at", facts.workout_totals())
        return jobs.totals_stream(totals, f"{root}/out", f"{root}/check", "user_id")

    _in_batches(
        spark,
        [rows.filter(year <= 2021), rows.filter(year.between(2022, 2023)), rows.filter(year >= 2024)],
        start,
    )
    return spark.read.parquet(f"{root}/out").drop(jobs.MONTH)


# Documented tables


@query("doc_score_state_dim")
def _(spark, sf_dir):
    sleep = dims.score_states(inputs.staged(spark, sf_dir, "sleep"), "Sleep")
    return sleep.unionByName(dims.score_states(inputs.staged(spark, sf_dir, "cycle"), "Cycle"))


@query("doc_fact_sleep")
def _(spark, sf_dir):
    return records.fact_sleep(inputs.staged(spark, sf_dir, "sleep", whole=True))


@query("doc_fact_cycles")
def _(spark, sf_dir):
    staged = inputs.staged(spark, sf_dir, "cycle")
    known = staged.filter(F.col("ingested_at") <= "2022-01-01 00:00:00")
    return records.fact_cycles(staged, known)


@query("doc_fact_workouts")
def _(spark, sf_dir):
    return records.fact_workouts(inputs.staged(spark, sf_dir, "workout"))


@query("doc_fact_recovery")
def _(spark, sf_dir):
    return records.fact_recovery(inputs.staged(spark, sf_dir, "recovery"))


@query("doc_sleep_report")
def _(spark, sf_dir):
    return records.sleep_report(
        records.fact_sleep(inputs.staged(spark, sf_dir, "sleep")),
        inputs.users(spark, sf_dir),
        dims.dim_date(spark),
        _as_of(),
    )


@query("doc_weekly_corr")
def _(spark, sf_dir):
    return records.weekly_correlation(
        records.fact_cycles(inputs.staged(spark, sf_dir, "cycle")),
        records.fact_recovery(inputs.staged(spark, sf_dir, "recovery")),
        dims.dim_date(spark),
    )
