"""Written tables: incremental runs against a full refresh, backfill, streams, run figures."""

import datetime as dt
import gzip
import json
import re
from pathlib import Path

from pyspark.sql import functions as F

from pulseframe.catalog import inputs, model_queries, source_queries
from pulseframe.operators import quality
from pulseframe.plans import checks, pipeline, records
from pulseframe.session import shared_dir
from pulseframe.sources import extract, tables
from pulseframe.sources.specs import SOURCES
from pulseframe.streaming import jobs

FIRST = dt.datetime(2024, 1, 1, 6)
SCORED = {"state": "SCORED"}


def iso(t):
    return t.isoformat() + "Z"


def pages_of_days(days):
    """One page per source for a range of days and two users."""
    out = {"cycle": [], "recovery": [], "sleep": [], "workout": []}
    for d in days:
        for user in ("1", "2"):
            t = FIRST + dt.timedelta(days=d)
            base = {"user_id": user, "created_at": iso(t), "updated_at": iso(t)}
            span = {"start": iso(t), "end": iso(t + dt.timedelta(minutes=40 + d))}
            n = (7 * d + int(user)) % 50
            out["cycle"].append(
                {"id": f"{user}-{d}", **base, **span, "score": {**SCORED, "strain": n / 3, "kilojoule": 100 * n}}
            )
            out["recovery"].append(
                {
                    "cycle_id": f"{user}-{d}",
                    **base,
                    "score": {
                        **SCORED,
                        "recovery_score": 40 + n,
                        "resting_heart_rate": 50 + n / 9,
                        "hrv_rmssd_milli": 30 + n,
                        "skin_temp_celsius": 33 + n / 40,
                    },
                }
            )
            out["sleep"].append(
                {
                    "id": f"s{user}-{d}",
                    **base,
                    **span,
                    "nap": False,
                    "score": {**SCORED, "respiratory_rate": 14, "sleep_performance_percentage": 80 + n % 9},
                }
            )
            out["workout"].append(
                {"id": f"w{user}-{d}", **base, **span, "sport_name": "run", "score": {**SCORED, "strain": 3.0}}
            )
    return out


def land(folder, days):
    for source, rows in pages_of_days(days).items():
        (folder / source).mkdir(parents=True, exist_ok=True)
        page = json.dumps({"records": rows, "next_token": None})
        (folder / source / f"{min(days)}.json").write_text(page)
    (folder / "user").mkdir(exist_ok=True)
    users = {"records": [{"user_id": u, "email": f"{u}@example.org"} for u in ("1", "2")]}
    (folder / "user" / "u.json").write_text(json.dumps(users))
    return {source: str(folder / source) for source in SOURCES}


def content(spark, root, name):
    df = spark.read.parquet(f"{root}/{name}")
    volatile = {"ingested_at", "created_timestamp", "calculated_at"}
    if name == "fact_daily_recovery":
        volatile.discard("created_timestamp")
    return sorted(map(str, df.select(*[c for c in sorted(df.columns) if c not in volatile]).collect()))


def run(spark, folder, root, days, now, full_refresh=False):
    paths = land(folder, days)
    extract.run_extract(spark, paths, root, now)
    return pipeline.build_all(spark, root, now, full_refresh).collect()


def scans(df):
    """Partition filters of every scan of the plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", text)


def check_plans(spark, root):
    """Incremental reads put a literal on the partition column."""
    since = dt.datetime(2024, 5, 1)
    assert "ingest_day" in scans(pipeline._raw(spark, root, "cycle", since))[0]
    for name in ("stg_sleep", "stg_cycle", "fact_daily_recovery", "int_recovery_percentiles", "recovery_momentum"):
        (found,) = scans(pipeline._read(spark, root, name, 202405))
        assert "month" in found and "202405" in found
    for report in pipeline.build_reports(spark, root, dt.date(2024, 5, 9), 20).values():
        assert any("202404" in f for f in scans(report))


def check_counts(spark, root):
    """Row checks were counted by every write, in increments too, and equal those of a reading."""
    suites = {f"stg_{s}": checks.staging_rows(SOURCES[s].key) for s in pipeline.STAGED}
    suites |= {pipeline.STRAIN: checks.strain_rows(), pipeline.RECOVERY: checks.recovery_rows()}
    for name, rows in suites.items():
        kept = tables._read_json(spark, f"{root}/{name}/{tables.COUNTS}")
        assert set(kept) == {c.name for c in rows}
        found = quality.run_suite(spark.read.parquet(f"{root}/{name}"), rows).collect()
        assert tables.failures(spark, f"{root}/{name}", rows, "month") == {r["test"]: r["failures"] for r in found}


def check_reports(spark, root, as_of):
    everything = pipeline.build_reports(spark, root, as_of)
    some = pipeline.build_reports(spark, root, as_of, 20)
    assert set(everything) == set(some) == set(pipeline.REPORTS)
    for name, rows in everything.items():
        recent = rows.filter(F.col("date_day") >= F.date_sub(F.lit(as_of), 20))
        assert sorted(map(str, recent.collect())) == sorted(map(str, some[name].collect()))
    assert some["momentum"].count() > 0


N_DAYS = 130


def test_incremental_runs_equal_a_full_refresh(spark, tmp_path):
    """Every row of every table, also the ranks of old days, which new days change."""
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    now = FIRST + dt.timedelta(days=N_DAYS + 1)
    run(spark, tmp_path / "in", step, range(0, 120), FIRST + dt.timedelta(days=120))
    results = run(spark, tmp_path / "in", step, range(120, N_DAYS), now)
    run(spark, tmp_path / "in", step, range(120, N_DAYS), now)  # the same files again
    run(spark, tmp_path / "in", whole, range(0, N_DAYS), now, full_refresh=True)
    assert {r.suite for r in results} >= {"stg_sleep", "fact_daily_strain", "fact_daily_recovery", "volume", "freshness"}
    failed = {r.test for r in results if r.failures}
    assert failed <= {"volume_user", "freshness_cycle", "not_null_calories_burned"}
    names = [
        "stg_cycle",
        "stg_recovery",
        "stg_sleep",
        "stg_workout",
        "int_recovery_percentiles",
        "fact_daily_recovery",
        "fact_daily_strain",
        *pipeline.METRICS,
    ]
    for name in names:
        a, b = (content(spark, root, name) for root in (step, whole))
        assert a == b, name
        assert a or name == "strain_sustainability"
    fact = spark.read.parquet(f"{step}/fact_daily_recovery")
    assert fact.count() == fact.select("user_sk", "date_sk").distinct().count() == 2 * N_DAYS
    check_plans(spark, step)
    check_counts(spark, step)
    check_reports(spark, step, now.date())

    suite = pipeline.backfill_recovery(spark, step)
    assert {r.failures for r in suite.collect()} == {0}
    first, last = (FIRST + dt.timedelta(days=d) for d in (3, 5))
    pipeline.backfill_range(spark, step, "sleep", first.date(), last.date())
    assert content(spark, step, "stg_sleep") == content(spark, whole, "stg_sleep")

    log = spark.read.parquet(f"{step}/{extract.RUN_LOG_TABLE}")
    figures = records.run_figures(log, F.lit(str(now)).cast("timestamp_ntz")).collect()
    assert {r.source: r.runs for r in figures} == dict.fromkeys(SOURCES, 3)
    assert {r.success_rate for r in figures} == {1.0}


def test_stream_ingest_and_staging_upsert(spark, tmp_path):
    raw, stg = str(tmp_path / "raw"), str(tmp_path / "stg")
    spec = SOURCES["cycle"]
    folder = tmp_path / "in"
    for days in (range(0, 5), range(5, 8)):
        paths = land(folder, days)
        stream = jobs.landed_stream(spark, paths["cycle"], spec)
        jobs.append_stream(stream, raw, str(tmp_path / "c1")).awaitTermination()
        landed = spark.readStream.schema(spec.raw_schema).parquet(raw)
        jobs.staging_stream(landed, spec, stg, str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(raw).count() == spark.read.parquet(stg).count() == 16

    # An older version that arrives later does not replace a newer one.
    late = pages_of_days([2])["cycle"]
    for r in late:
        r["updated_at"], r["score"]["strain"] = iso(FIRST), 0.0
    (folder / "cycle" / "late.json").write_text(json.dumps({"records": late}))
    stream = jobs.landed_stream(spark, str(folder / "cycle"), spec)
    jobs.append_stream(stream, raw, str(tmp_path / "c1")).awaitTermination()
    landed = spark.readStream.schema(spec.raw_schema).parquet(raw)
    jobs.staging_stream(landed, spec, stg, str(tmp_path / "c2")).awaitTermination()
    rows = spark.read.parquet(stg).filter("id = '1-2'").collect()
    assert [r.strain for r in rows] == [5]


def test_packed_pages_are_parsed_by_all_tasks(spark, tmp_path):
    """Lines of gzip files, good and bad, give the records that plain files give."""
    folder, spec = tmp_path / "in", SOURCES["cycle"]
    land(folder, range(6))
    lines = [line for f in sorted((folder / "cycle").glob("*.json")) for line in f.read_text().splitlines()]
    lines += ["", "null", '{"records": [{"id": "x"', '{"records": [{"id": "y", "updated_at": "soon"}]}', lines[0]]
    lines += [json.dumps({"records": [r]}) for r in pages_of_days([7, 8])["cycle"]]
    for name, opened in (("plain", open), ("packed", gzip.open)):
        (tmp_path / name).mkdir()
        with opened(tmp_path / name / f"pages.txt{'.gz' if name == 'packed' else ''}", "wt") as f:
            f.write("\n".join(lines))
    found = {}
    for name in ("plain", "packed"):
        out = str(tmp_path / f"raw-{name}")
        stream = jobs.landed_stream(spark, str(tmp_path / name), spec, deal_lines=name == "packed")
        jobs.append_stream(stream, out, str(tmp_path / f"c-{name}")).awaitTermination()
        found[name] = sorted(map(str, spark.read.parquet(out).drop("ingested_at").collect()))
    assert found["packed"] == found["plain"] and len(found["plain"]) == 28
    parts = {r[0] for r in spark.read.parquet(out).select(F.input_file_name()).distinct().collect()}
    assert len(parts) > 1  # one file, but several tasks


def test_ingest_query_lands_packed_pages(spark, tmp_path, ts):
    rows = [(k // 5, k, k % 7, k % 5, 5.0 + k, 900.5 * k, 0.01, 0.02, "A", "O", ts(f"1999-01-{1 + k % 28:02d}")) for k in range(60)]
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = set(Path(shared_dir(spark)).glob("pulseframe/landed-*"))
    got = model_queries.query.queries["stream_ingest"](spark, str(tmp_path))
    kept = ["id", "user_id", "score_state", "strain", "kilojoule", "max_heart_rate"]
    want = inputs.raw(spark, str(tmp_path), "cycle").select(kept)
    assert sorted(map(str, got.select(kept).collect())) == sorted(map(str, want.collect()))
    (pages,) = set(Path(shared_dir(spark)).glob("pulseframe/landed-*")) - before
    files = list(pages.glob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files)


def test_extract_query_lands_packed_pages(spark, tmp_path, ts):
    """Records of which some lie between the watermark and the day of the run, in a few packed files."""
    rows = [(k // 5, k, k % 7, k % 5, 5.0 + k, 900.5 * k, 0.01, 0.02, "A", "O", ts(f"2001-10-{1 + k % 28:02d}")) for k in range(60)]
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = set(Path(shared_dir(spark)).glob("pulseframe/landed-*"))
    got = source_queries.query.queries["extract_incremental"](spark, str(tmp_path))
    raw = inputs.raw(spark, str(tmp_path), "cycle")
    want = raw.filter(F.col("updated_at") >= source_queries.EXTRACT_FROM).select("id", "user_id")
    assert 0 < want.count() < 60
    assert sorted(map(str, got.select("id", "user_id").collect())) == sorted(map(str, want.collect()))
    (pages,) = set(Path(shared_dir(spark)).glob("pulseframe/landed-*")) - before
    files = list(pages.glob("part-*"))
    assert files and all(f.suffix == ".lz4" for f in files)


def events(spark, path, rows):
    schema = "user string, t timestamp_ntz, v double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_stream_writes_a_month_of_totals_by_one_task(spark, tmp_path, ts):
    """A batch has its totals in several tasks, each with rows of all months; the second batch is merged."""
    path, out = str(tmp_path / "events"), tmp_path / "out"
    setting = spark.conf.get("spark.sql.adaptive.enabled")

    def run(year):
        events(spark, path, [(f"u{k}", ts(f"{year}-{m:02d}-01 10:00"), 1.0) for k in range(40) for m in (1, 2, 3)])
        stream = spark.readStream.schema("user string, t timestamp_ntz, v double").parquet(path)
        totals = jobs.daily_totals(stream, "user", "t", [F.sum("v").alias("total")])
        jobs.totals_stream(totals, str(out), str(tmp_path / "check"), "user").awaitTermination()

    run(2024)
    run(2025)
    months = {p.name: len(list(p.glob("*.parquet"))) for p in out.glob("month=*")}
    assert months == {f"month={y}{m:02d}": 1 for y in (2024, 2025) for m in (1, 2, 3)}
    got = spark.read.parquet(str(out))
    assert got.count() == 240 and got.select("user", "day").distinct().count() == 240
    assert {r[0] for r in got.select("total").distinct().collect()} == {1.0}
    assert spark.conf.get("spark.sql.adaptive.enabled") == setting


def test_stream_daily_totals_over_several_batches(spark, tmp_path, ts):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    batches = [
        [("a", ts("2024-01-01 10:00:00"), 1.0), ("b", ts("2024-01-01 11:00:00"), 5.0)],
        [("a", ts("2024-01-01 20:00:00"), 2.0), ("a", ts("2024-01-02 01:00:00"), 4.0)],
    ]
    for rows in batches:
        events(spark, source, rows)
        stream = spark.readStream.schema("user string, t timestamp_ntz, v double").parquet(source)
        totals = jobs.daily_totals(
            stream, "user", "t", [F.count("*").alias("n"), F.sum("v").alias("v")]
        )
        jobs.totals_stream(totals, out, check, "user").awaitTermination()
    got = sorted((r.user, str(r.day), r.n, r.v) for r in spark.read.parquet(out).collect())
    assert got == [
        ("a", "2024-01-01", 2, 3.0),
        ("a", "2024-01-02", 1, 4.0),
        ("b", "2024-01-01", 1, 5.0),
    ]


def test_late_rows_are_counted(spark, tmp_path, ts):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    found = []
    for rows in (
        [("a", ts("2024-01-01"), 1.0), ("b", ts("2024-02-01"), 1.0)],
        [("c", ts("2024-01-02"), 1.0), ("d", ts("2024-01-31"), 1.0)],
    ):
        events(spark, source, rows)
        stream = spark.readStream.schema("user string, t timestamp_ntz, v double").parquet(source)
        query = jobs.append_stream(jobs.drop_repeats(stream, ["user"], "t", "5 days"), out, check)
        query.awaitTermination()
        found.append(jobs.late_rows(query))
    assert found == [0, 1]
    assert sorted(r.user for r in spark.read.parquet(out).collect()) == ["a", "b", "d"]


def test_stream_quarantine(spark, tmp_path):
    paths = land(tmp_path / "in", range(2))
    (tmp_path / "in" / "cycle" / "cut.json").write_text('{"records": [{"id": "x"')
    (tmp_path / "in" / "cycle" / "bad.json").write_text('{"records": [{"id": "y", "updated_at": "soon"}]}')
    spec = SOURCES["cycle"]
    for name, stream in (
        ("raw", jobs.landed_stream(spark, paths["cycle"], spec)),
        ("held", jobs.rejected_stream(spark, paths["cycle"], spec)),
    ):
        jobs.append_stream(stream, str(tmp_path / name), str(tmp_path / f"c-{name}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 4
    held = {r.reason for r in spark.read.parquet(str(tmp_path / "held")).collect()}
    assert held == {"unreadable page", "no readable updated_at"}


def test_stream_repeats_within_the_watermark(spark, tmp_path, ts):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for rows in (
        [("a", ts("2024-01-01"), 1.0)],
        [("a", ts("2024-01-01 01:00:00"), 2.0), ("b", ts("2024-01-02"), 1.0)],
    ):
        events(spark, source, rows)
        stream = spark.readStream.schema("user string, t timestamp_ntz, v double").parquet(source)
        first = jobs.drop_repeats(stream, ["user"], "t", "5 days")
        jobs.append_stream(first, out, check).awaitTermination()
    got = sorted((r.user, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1.0), ("b", 1.0)]
