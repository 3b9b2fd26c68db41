"""Queries: sources, sinks, state, incremental loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.catalog import inputs
from pulseframe.catalog.registry import Registry
from pulseframe.functions.compat import is_bad_timestamp, parse_timestamp
from pulseframe.operators import history, incremental, quality
from pulseframe.plans import dims, records, staging
from pulseframe.session import scratch_path
from pulseframe.sources import chain, extract, landed, state, tables
from pulseframe.sources.specs import SOURCES, STATE_SCHEMA

query = Registry()

BATCH_TIME = "2026-11-05 06:00:00"
FIRST_LOAD_END = "2024-06-30 00:00:00"
EXTRACT_FROM = "2026-10-20 00:00:00"
EXTRACT_NOW = dt.datetime(2026, 11, 4)


def record_texts(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Every raw row as the JSON text of its nested record."""
    return inputs.raw(spark, sf_dir, source).select(
        landed.nest_record(SOURCES[source]).alias("value")
    )


def page_texts(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Every raw row as a page with one record."""
    page = F.concat(F.lit('{"records":['), "value", F.lit('],"next_token":null}'))
    return record_texts(spark, sf_dir, source).select(page.alias("value"))


def _parsed(texts: DataFrame, source: str) -> DataFrame:
    spec = SOURCES[source]
    pages = landed.parse_pages(texts, "value", spec)
    return landed.flatten_records(landed.explode_records(pages, spec), spec)


def _source_query(source: str) -> None:
    query.add(f"src_{source}", lambda s, d: _parsed(page_texts(s, d, source), source))


for _source in ("cycle", "sleep", "recovery", "workout"):
    _source_query(_source)


@query("src_user")
def _(spark, sf_dir):
    return _parsed(record_texts(spark, sf_dir, "user"), "user")


@query("src_single_object")
def _(spark, sf_dir):
    return _parsed(record_texts(spark, sf_dir, "cycle"), "cycle").select(
        "id", "user_id", "created_at", "strain"
    )


@query("src_pages")
def _(spark, sf_dir):
    spec = SOURCES["cycle"]
    first = inputs.raw(spark, sf_dir, "cycle")
    record = landed.nest_record(spec)
    both = first.select(
        record.alias("a"), F.regexp_replace(record, '"id":"([^"]*)"', '"id":"$1-b"').alias("b")
    )
    pages = both.select(
        F.concat(
            F.lit('{"records":['), "a", F.lit(","), "b", F.lit('],"next_token":"next"}')
        ).alias("value")
    )
    return _parsed(pages, "cycle").select("id", "user_id", "created_at", "strain")


def _order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a page of its customer's request, with gaps, circles and repeats."""
    by = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    key = F.col("o_orderkey")
    place, before = F.row_number().over(by), F.lag(key).over(by)
    pages = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").cast("string").alias("request_id"),
        F.when(place > 1, key).cast("string").alias("token"),
        F.when((key % 29 == 0) & (place > 2), before).otherwise(F.lead(key).over(by)).cast("string").alias("next_token"),
        key.alias("k"),
    )
    kept = pages.filter("k % 23 <> 0")
    lost_end = pages.filter("k % 37 = 0").withColumn("next_token", F.lit(None).cast("string"))
    return kept.union(kept.filter("k % 31 = 0")).union(lost_end).drop("k")


@query("src_page_chain")
def _(spark, sf_dir):
    return chain.follow(_order_pages(spark, sf_dir))


@query("src_page_faults")
def _(spark, sf_dir):
    return chain.faults(_order_pages(spark, sf_dir))


@query("src_ingested_at")
def _(spark, sf_dir):
    stamped = landed.stamp_ingested(inputs.raw(spark, sf_dir, "cycle"), BATCH_TIME)
    return stamped.select("id", "user_id", "created_at", "ingested_at")


TIME_TEXT = """case l_linenumber
 when 1 then concat(replace(c, ' ', 'T'), '.000Z')
 when 2 then concat(c, '+02:00')
 when 3 then concat(c, '.123456-05:30')
 when 4 then concat('at ', c)
 when 5 then ''
 when 6 then substr(c, 1, 10)
 else substr(c, 1, 16) end"""


@query("src_parse_ts")
def _(spark, sf_dir):
    created = inputs.RAW["cycle"]["created_at"]
    rows = inputs.read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"cast({created} as string) as c"
    )
    texts = rows.withColumn("time_text", F.expr(TIME_TEXT))
    return texts.select(
        "l_orderkey",
        "l_linenumber",
        "time_text",
        parse_timestamp("time_text").alias("parsed"),
        is_bad_timestamp("time_text").alias("is_bad"),
    )


@query("fn_iso_parse")
def _(spark, sf_dir):
    times = inputs.read(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("t")
    )
    return times.select("event_id", parse_timestamp("t").alias("ts"))


@query("src_flatten")
def _(spark, sf_dir):
    nested = inputs.read(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.col("user_id").alias("id"), F.array("event_type", F.lit("any")).alias("tags")
        ).alias("user"),
        F.struct(F.from_json("props", "k bigint").alias("props"), "value").alias("data"),
    )
    return landed.flatten_struct(nested)


@query("fn_json_text")
def _(spark, sf_dir):
    return inputs.read(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.array("event_type", "event_type")).alias("list_text")
    )


@query("sink_append")
def _(spark, sf_dir):
    path = scratch_path(spark, "append")
    rows = inputs.raw(spark, sf_dir, "cycle")
    tables.append(rows.filter("score_state = 'SCORED'"), path)
    tables.append(rows.filter("score_state <> 'SCORED'"), path)
    return spark.read.parquet(path).select("id", "user_id", "created_at", "strain")


@query("set_union_pages")
def _(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, "cycle").select("id", "user_id", "score_state")
    scored = rows.filter("score_state = 'SCORED'")
    return scored.unionByName(rows.filter("score_state <> 'SCORED'"))


@query("sink_replace")
def _(spark, sf_dir):
    path = scratch_path(spark, "replace")
    rows = inputs.raw(spark, sf_dir, "cycle")
    tables.replace(rows.filter("score_state = 'SCORED'"), path)
    tables.replace(rows.filter("score_state <> 'SCORED'"), path)
    return spark.read.parquet(path).select("id", "user_id", "created_at", "strain")


@query("extract_incremental")
def _(spark, sf_dir):
    root, pages = scratch_path(spark, "extract"), scratch_path(spark, "landed")
    # Names and times that every page repeats take most of its text.
    page_texts(spark, sf_dir, "cycle").write.text(pages, compression="lz4")
    start = spark.createDataFrame(
        [("cycle", dt.datetime.fromisoformat(EXTRACT_FROM), "success", EXTRACT_NOW)], STATE_SCHEMA
    )
    tables.replace(start, f"{root}/{extract.STATE_TABLE}")
    extract.run_extract(spark, {"cycle": pages}, root, EXTRACT_NOW)
    reached = spark.read.parquet(f"{root}/{extract.STATE_TABLE}").select(
        F.col("last_processed_at").alias("state_after")
    )
    rows = spark.read.parquet(f"{root}/raw_cycle")
    return rows.select(
        "id", "user_id", "created_at", "updated_at", "ingested_at"
    ).withColumn("state_after", reached.scalar())


@query("extract_full")
def _(spark, sf_dir):
    root, pages = scratch_path(spark, "extract"), scratch_path(spark, "landed")
    record_texts(spark, sf_dir, "user").write.text(pages)
    for _ in range(2):
        extract.run_extract(spark, {"user": pages}, root, EXTRACT_NOW)
    return spark.read.parquet(f"{root}/raw_user")


def _workout_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two names of every workout row: its sport, and that with the last letter F."""
    sport = F.coalesce("sport_name", F.lit("none"))
    other = F.concat(F.substring(sport, 1, 1), F.lit("F"))
    return inputs.raw(spark, sf_dir, "workout").select(
        sport.alias("known"), other.alias("asked"), "updated_at", "ingested_at"
    )


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run state per sport."""
    rows = _workout_names(spark, sf_dir).groupBy(F.col("known").alias("table_name"))
    return rows.agg(F.max("updated_at").alias("last_processed_at")).select(
        "table_name",
        "last_processed_at",
        F.lit("success").alias("last_run_status"),
        F.lit(FIRST_LOAD_END).cast("timestamp_ntz").alias("updated_at"),
    )


def _state_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that are asked for; one of them has never run."""
    return _workout_names(spark, sf_dir).select(F.col("asked").alias("table_name")).distinct()


@query("state_get")
def _(spark, sf_dir):
    return state.last_processed(_states(spark, sf_dir), _state_names(spark, sf_dir))


@query("state_upsert")
def _(spark, sf_dir):
    rows = _workout_names(spark, sf_dir).groupBy(F.col("asked").alias("table_name"))
    updates = rows.agg(F.max("ingested_at").alias("last_processed_at"))
    return state.upsert_state(_states(spark, sf_dir), updates, F.lit(BATCH_TIME))


@query("state_failed")
def _(spark, sf_dir):
    return state.mark_failed(
        _states(spark, sf_dir), _state_names(spark, sf_dir), F.lit(BATCH_TIME)
    )


@query("scan_source")
def _(spark, sf_dir):
    return inputs.raw(spark, sf_dir, "sleep").select("id", "user_id", "nap", "created_at")


@query("scan_ref")
def _(spark, sf_dir):
    return inputs.staged(spark, sf_dir, "recovery").select("cycle_id", "user_id", "recovery_score")


@query("row_count")
def _(spark, sf_dir):
    return inputs.raw(spark, sf_dir, "workout").agg(F.count("*").alias("n"))


@query("scan_dashboard")
def _(spark, sf_dir):
    return spark.sql(
        "select user_sk, count(*) as days, avg(recovery_score) as avg_recovery "
        "from {daily_scores} group by user_sk",
        daily_scores=inputs.daily(spark, sf_dir),
    )


def _day_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.lines(spark, sf_dir).agg(F.min("day").alias("a"), F.max("day").alias("b"))


@query("gen_series")
def _(spark, sf_dir):
    return dims.days_between(_day_bounds(spark, sf_dir), "a", "b")


@query("tbl_fn_generator")
def _(spark, sf_dir):
    """Generated days per user, from each user's first to last day."""
    spans = (
        inputs.lines(spark, sf_dir)
        .groupBy("user_sk")
        .agg(F.min("day").alias("a"), F.max("day").alias("b"))
    )
    days = spans.select("user_sk", F.explode(F.sequence("a", "b")).alias("day"))
    return days.groupBy("user_sk").agg(
        F.count("*").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )


@query("mat_table")
def _(spark, sf_dir):
    path = scratch_path(spark, "table")
    tables.replace(inputs.users(spark, sf_dir), path)
    return spark.read.parquet(path)


def _first_and_next(spark: SparkSession, sf_dir: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Staging after a first load up to a date, and the batch that comes after it."""
    rows = inputs.raw(spark, sf_dir, source)
    first = staging.stage(rows.filter(F.col("created_at") <= FIRST_LOAD_END), source)
    return first, staging.stage(rows, source, target=first)


@query("filter_watermark")
def _(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, "cycle")
    target = rows.filter(F.col("created_at") <= FIRST_LOAD_END)
    newest = incremental.read_watermark(target, "created_at")
    return incremental.after_watermark(rows, "created_at", newest).select(
        "id", "user_id", "created_at", "updated_at"
    )


@query("agg_max_global")
def _(spark, sf_dir):
    return inputs.raw(spark, sf_dir, "cycle").agg(
        F.max("created_at").alias("newest_created"), F.max("updated_at").alias("newest_updated")
    )


@query("mat_incremental_merge")
def _(spark, sf_dir):
    path = scratch_path(spark, "merge")
    first, batch = _first_and_next(spark, sf_dir, "recovery")
    for df in (first, batch):
        laid_out = df.withColumn("month", tables.month_of("created_at"))
        tables.upsert(laid_out, path, ["cycle_id"], "month")
    return spark.read.parquet(path).drop("month")


@query("join_merge_key")
def _(spark, sf_dir):
    first, batch = _first_and_next(spark, sf_dir, "cycle")
    return incremental.merge_upsert(first, batch, ["id"]).select("id", "user_id", "updated_at")


@query("dq_while_writing")
def _(spark, sf_dir):
    """Failures that were counted while a table was loaded and then merged into, per check."""
    path = scratch_path(spark, "watched")
    rules = [
        quality.null_check("cycle_id"),
        quality.null_check("skin_temp_celsius"),
        quality.range_check("recovery_score", 20, 80),
    ]
    first, batch = _first_and_next(spark, sf_dir, "recovery")
    for df in (first, batch):
        laid_out = df.withColumn("month", tables.month_of("created_at"))
        tables.upsert(laid_out, path, ["cycle_id"], "month", checks=rules)
    return quality.counted(spark, tables.failures(spark, path, rules, "month"))


@query("mat_merge_partial")
def _(spark, sf_dir):
    first, batch = _first_and_next(spark, sf_dir, "cycle")
    return incremental.merge_partial(first, batch, ["id"], ["updated_at", "ingested_at"])


@query("mat_full_refresh")
def _(spark, sf_dir):
    path = scratch_path(spark, "refresh")
    first, _ = _first_and_next(spark, sf_dir, "cycle")
    tables.replace(first, path)
    tables.replace(inputs.staged(spark, sf_dir, "cycle"), path)
    return spark.read.parquet(path)


@query("mat_schema_change")
def _(spark, sf_dir):
    first, batch = _first_and_next(spark, sf_dir, "cycle")
    old = first.select("id", "user_id", "updated_at")
    new = batch.select("id", "user_id", "updated_at", "strain")
    return incremental.merge_with_policy(old, new, ["id"], "append_new_columns")


@query("doc_backfill_range")
def _(spark, sf_dir):
    rows = records.created_between(
        inputs.raw(spark, sf_dir, "sleep"), dt.date(2023, 1, 1), dt.date(2023, 12, 31)
    )
    return staging.stage(rows, "sleep").select("id", "user_id", "created_at", "updated_at")


def _user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    day_one, day_two = (F.lit(d).cast("date") for d in ("2024-01-01", "2025-01-01"))
    known = inputs.users(spark, sf_dir, moved=inputs.MOVED_USERS).select(
        "*",
        day_one.alias("effective_date"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"),
    )
    return incremental.merge_history(
        known, inputs.users(spark, sf_dir), "user_id", ["last_name"], day_two
    )


@query("doc_scd2_user")
def _(spark, sf_dir):
    """All profiles, next to the same profiles known under other ids."""
    return _user_history(spark, sf_dir)


@query("join_user_version")
def _(spark, sf_dir):
    """Strain of every user and day, with the profile that was valid on the day."""
    days = inputs.fact_strain(spark, sf_dir).select("user_sk", "cycle_date", "day_strain")
    versions = _user_history(spark, sf_dir)
    return history.version_on(days, versions, "user_sk", "cycle_date", ["last_name", "effective_date"])


@query("doc_ops_metrics")
def _(spark, sf_dir):
    """Figures over a run log with one run per score state and month."""
    runs = (
        inputs.raw(spark, sf_dir, "cycle")
        .groupBy(
            F.col("score_state").alias("source"), tables.month_of("created_at").alias("month")
        )
        .agg(F.count("*").alias("records"), F.max("updated_at").alias("newest"))
        .withColumn("status", F.when(F.col("month") < 202101, "failed").otherwise("success"))
        .withColumn("seconds", F.col("records") / 10)
    )
    return records.run_figures(runs, F.lit(BATCH_TIME).cast("timestamp_ntz"))
