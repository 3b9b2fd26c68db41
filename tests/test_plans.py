"""Shape of the physical plans: reductions before shuffles, pushdown, no Python, no cross joins."""

import re

import pytest
from pyspark.sql import functions as F

from pulseframe.catalog import inputs, model_queries, operator_queries, source_queries
from pulseframe.operators import incremental, quality, series
from pulseframe.plans import dims, facts, metrics, staging
from pulseframe.sources.specs import SOURCES

SF = "/root/testdata/sf0.001"
FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "PythonMapInArrow",
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|single|round)", plan(df)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Both facts and the date dimension as written tables, never broadcast."""
    root = str(tmp_path_factory.mktemp("facts"))
    inputs.fact_recovery(spark, SF).write.parquet(f"{root}/r")
    inputs.fact_strain(spark, SF, with_limits=True).write.parquet(f"{root}/s")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.read.parquet(f"{root}/r"), spark.read.parquet(f"{root}/s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_dedup_cuts_in_the_map_tasks(spark):
    text = plan(staging.stage(inputs.raw(spark, SF, "cycle"), "cycle"))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning(id") < partial


@pytest.mark.parametrize("name", ["stg_sleep", "stg_workout", "doc_fact_sleep"])
def test_whole_wide_records_are_not_sorted_in_the_map_tasks(spark, name):
    text = plan(model_queries.query.queries[name](spark, SF))
    in_maps = text[text.index("Exchange hashpartitioning(id") :]
    assert "Sort [" not in in_maps and "WindowGroupLimit" not in in_maps
    assert exchanges(model_queries.query.queries[name](spark, SF)) == 1


def test_whole_records_are_the_same_rows(spark):
    rows = inputs.raw(spark, SF, "sleep")
    missing = F.when(F.col("id").substr(-1, 1) != "1", F.col("id"))
    rows = rows.unionByName(rows).unionByName(rows.withColumn("id", missing)).withColumn("nap", F.lit(None).cast("boolean"))
    whole, cut = staging.stage(rows, "sleep", whole=True), staging.stage(rows, "sleep")
    assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty() and not cut.isEmpty()


def test_one_shuffle_per_single_fact_metric(tables):
    recovery, strain = tables
    assert exchanges(metrics.recovery_momentum(recovery)) == 1
    assert exchanges(metrics.recovery_volatility(recovery)) == 1
    assert exchanges(metrics.autonomic_balance(recovery)) == 1
    assert exchanges(metrics.strain_sustainability(strain)) == 1


def test_two_fact_metrics_shuffle_once(tables):
    recovery, strain = tables
    assert exchanges(metrics.strain_recovery_efficiency(strain, recovery)) == 1
    assert exchanges(metrics.training_readiness_gap(recovery, strain)) == 1


def test_seasonal_metric_shuffles_and_sorts_once(spark, tables, tmp_path):
    recovery, _ = tables
    dims.dim_date(spark).write.parquet(str(tmp_path / "days"))
    days = F.broadcast(spark.read.parquet(str(tmp_path / "days")))
    text = plan(metrics.seasonal_adaptation(recovery, days))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_two_facts_are_put_side_by_side_by_one_sort_and_no_hash_tables(tables):
    recovery, strain = tables
    pairs = series.beside(strain.select("user_sk", "date_sk", "day_strain"), recovery, ["recovery_score"])
    text = plan(pairs.select("*", F.lag("recovery_score").over(series.by_day()).alias("before")))
    assert "Aggregate" not in text
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_ranks_sort_short_rows_and_not_once_more_for_the_users(spark, tables):
    staged, users = inputs.staged(spark, SF, "recovery"), inputs.users(spark, SF)
    text = plan(facts.recovery_percentiles(staged, users, F.broadcast(dims.dim_date(spark))))
    join = text.index("SortMergeJoin [user_id")
    ranks = text.index("percent_rank")
    assert join < ranks
    # between the join and the ranks its rows are neither shuffled nor sorted again
    assert not re.search(r"Exchange|\bSort \[", text[join:ranks])


def test_ranks_meet_the_records_of_a_day_where_these_lie(spark):
    text = plan(inputs.fact_recovery(spark, SF))
    assert not re.search(r"Exchange hashpartitioning\(user_sk", text)


def test_stored_ranks_meet_the_records_where_these_lie(spark):
    """Percentiles as a backfill stores them, without the keys of the records; nothing is small enough to broadcast."""
    recovery, sleep = (
        staging.stage(spark.createDataFrame([], SOURCES[s].raw_schema), s) for s in ("recovery", "sleep")
    )
    users = dims.dim_user(staging.stage_user(spark.createDataFrame([], SOURCES["user"].raw_schema)))
    ranks = spark.createDataFrame(
        [], "user_sk string, date_sk int, recovery_score_percentile int, hrv_percentile int, rhr_percentile int, skin_temp_deviation double"
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(facts.fact_daily_recovery(recovery, users, dims.dim_date(spark), ranks, sleep))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert re.search(r"Exchange hashpartitioning\(user_sk#\d+, \d+\)", text)  # the short ranks, to meet the users
    assert not re.search(r"Exchange hashpartitioning\(user_sk#\d+, date_sk", text)


def test_ranks_come_by_either_key(spark):
    args = inputs.staged(spark, SF, "recovery"), inputs.users(spark, SF), dims.dim_date(spark)
    by_record, by_key = (
        facts.fact_daily_recovery(*args, inputs.percentiles(spark, SF, keep), inputs.staged(spark, SF, "sleep"))
        for keep in (facts.RECORD_KEYS, ())
    )
    assert by_record.columns == by_key.columns
    rows = sorted(map(str, by_record.collect()))
    assert rows == sorted(map(str, by_key.collect()))
    assert any("hrv_percentile=None" not in r for r in rows)


def test_days_of_unique_records_carry_no_hash(spark):
    sleeps = facts.daily_sleep(inputs.staged(spark, SF, "sleep")).select("user_id", "day")
    text = plan(sleeps)
    # one hash for the newest version of a record, none for the sleep of a day
    assert len(re.findall(r"xxhash64\(", text)) == 1


def test_matched_rows_need_no_null_partition(tables):
    recovery, strain = tables
    text = plan(metrics.strain_recovery_efficiency(strain, recovery))
    assert not re.search(r"hashpartitioning\(_matched", text)


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    inputs.raw(spark, SF, "cycle").write.parquet(path)
    rows = spark.read.parquet(path)
    newest = incremental.read_watermark(rows.filter("score_state = 'SCORED'"), "created_at")
    text = plan(incremental.after_watermark(rows, "created_at", newest).select("id"))
    assert "GreaterThan(created_at" in text
    assert "ReadSchema: struct<id:string,created_at:timestamp_ntz>" in text


def test_report_reads_only_its_columns(spark, tables):
    recovery, _ = tables
    text = plan(metrics.recovery_momentum(recovery))
    assert "ReadSchema: struct<user_sk:string,date_sk:int,recovery_score:decimal(5,2)>" in text


def test_relationship_check_counts_before_the_join(spark):
    orders = inputs.read(spark, SF, "orders")
    customers = inputs.read(spark, SF, "customer")
    text = plan(quality.orphans(orders, "o_custkey", customers, "c_custkey"))
    assert text.index("LeftAnti") < text.index("HashAggregate")


def test_date_dimension_is_broadcast_without_a_hint(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    days = dims.dim_date(spark).select(F.col("date_day").alias("day"), "season")
    text = plan(inputs.lines(spark, SF).join(days, "day"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastHashJoin" in text


QUERIES = {
    name: build
    for part in (model_queries, operator_queries, source_queries)
    for name, build in part.query.queries.items()
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_joins(spark, name):
    if name in WRITES:
        pytest.skip("runs its jobs while it is built; covered by the oracle test")
    text = plan(QUERIES[name](spark, SF))
    for operator in FORBIDDEN:
        assert operator not in text, operator


WRITES = {
    "backfill_recovery",
    "extract_full",
    "extract_incremental",
    "mat_full_refresh",
    "mat_incremental_merge",
    "mat_table",
    "sink_append",
    "sink_replace",
    "stream_daily_workout",
    "stream_dedup_upsert",
    "stream_freshness",
    "stream_ingest",
    "stream_late_data",
    "stream_late_rows",
}


@pytest.mark.parametrize("name", ["report_readiness", "report_efficiency"])
def test_scores_are_shuffled_without_tie_hashes(spark, name):
    """Both reductions of the staged recoveries need the same columns of them, so one shuffle serves both."""
    text = plan(model_queries.query.queries[name](spark, SF))
    hashes = re.findall(r"xxhash64\((\w+)#", text)
    assert "user_id" not in hashes and hashes.count("cycle_id") == 2  # of the versions of a record only
    cuts = re.findall(r"WindowGroupLimit \[cycle_id#\d+\].*Partial\n.*\n.*Project \[(.*), xxhash64", text)
    needed = [re.findall(r"(\w+)#\d+", c.split(", xxhash64")[0]) for c in cuts]
    assert len(needed) == 2 and needed[0] == needed[1]
    assert set(needed[0]) == {
        "cycle_id", "user_id", "created_at", "updated_at", "recovery_score", "skin_temp_celsius", "ingested_at"
    }


def test_strain_suite_reads_written_keys(spark):
    """The fact is worked out once; its checks of keys read a table of keys."""
    text = plan(model_queries.query.queries["dq_suite"](spark, SF))
    assert "strain_sk" in text and not re.search(r"Window(GroupLimit)? \[", text)


def test_increment_of_percentiles_reads_what_it_wrote(spark):
    """The staged rows, the new days and the changed ranks are computed once, not wherever they are read."""
    text = plan(model_queries.query.queries["inc_recovery_percentiles"](spark, SF))
    assert "WindowGroupLimit" not in text
    assert "lineitem" not in text
