"""Landed JSON: pages, single objects, flattening, bad input, extraction runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pulseframe.sources import extract, landed, state, tables
from pulseframe.sources.specs import SOURCES, STATE_SCHEMA, spec_for_table

NOW = dt.datetime(2024, 3, 1, 12)


def cycle(id, updated="2024-02-20T08:00:00.000Z", **more):
    record = {
        "id": id,
        "user_id": 10,
        "created_at": "2024-02-19T08:00:00.123456Z",
        "updated_at": updated,
        "start": "2024-02-19T01:00:00+02:00",
        "end": None,
        "timezone_offset": "+02:00",
        "score": {"state": "SCORED", "strain": 12.3, "kilojoule": 100, "average_heart_rate": 61.5},
    }
    record.update(more)
    return record


def write_pages(folder, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    for i, page in enumerate(pages):
        (folder / f"page{i}.json").write_text(json.dumps(page))
    return str(folder)


def load(spark, folder, source="cycle"):
    spec = SOURCES[source]
    return landed.explode_records(landed.read_pages(spark, folder, spec), spec)


def test_pages_are_flattened(spark, tmp_path, ts):
    folder = write_pages(
        tmp_path / "c",
        {"records": [cycle(1), cycle(2, score=None)], "next_token": "n"},
        {"records": [cycle(3)]},
        {"records": []},
    )
    raw = landed.flatten_records(load(spark, folder), SOURCES["cycle"], F.lit(str(NOW)))
    rows = {r.id: r for r in raw.collect()}
    assert raw.schema == SOURCES["cycle"].raw_schema
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].user_id == "10"
    assert rows["1"].created_at == ts("2024-02-19 08:00:00.123")
    assert rows["1"].start_time == ts("2024-02-19 01:00:00")
    assert rows["1"].end_time is None
    assert rows["1"].average_heart_rate == 62
    assert rows["2"].strain is None and rows["2"].score_state is None
    assert {r.ingested_at for r in rows.values()} == {NOW}


def test_times_are_read_by_one_expression(spark, tmp_path, ts):
    """One for each time, beside the numbers, makes a generated method too long to be compiled."""
    folder = write_pages(
        tmp_path / "c", {"records": [cycle(1), cycle(2, start="soon", updated_at=None, ingested_at="2024-02-21")]}
    )
    flat = landed.flatten_records(load(spark, folder), SOURCES["cycle"])
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
    rows = {r.id: r for r in flat.collect()}
    assert flat.schema == SOURCES["cycle"].raw_schema
    assert rows["1"].created_at == ts("2024-02-19 08:00:00.123") and rows["1"].ingested_at is None
    assert rows["2"].start_time is None and rows["2"].updated_at is None
    assert rows["2"].ingested_at == ts("2024-02-21 00:00:00")


def test_a_built_text_is_not_worked_out_within_the_parser(spark):
    built = F.when(F.col("id") < 2, F.to_json(F.struct(F.col("id").cast("string").alias("id"))))
    pages = landed.parse_pages(spark.range(3).select(built.alias("value")), "value", SOURCES["cycle"])
    lines = pages._jdf.queryExecution().optimizedPlan().toString().splitlines()
    (parser,) = [line for line in lines if "from_json(" in line]
    assert "StructsToJsonEvaluator" not in parser
    assert any("StructsToJsonEvaluator" in line for line in lines)
    assert sorted((r.id or "") for r in pages.select("id").collect()) == ["", "0", "1"]


def test_pretty_printed_page_files(spark, tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"records": [cycle(1), cycle(2)]}, indent=2))
    spec = SOURCES["cycle"]
    pages = landed.read_pages(spark, str(folder), spec, one_page_per_line=False)
    assert landed.explode_records(pages, spec).count() == 2


def test_single_object_and_nested_levels(spark, tmp_path):
    folder = write_pages(tmp_path / "u", {"user_id": 7, "email": "a@example.org"})
    rows = load(spark, folder, "user").collect()
    assert [(r.user_id, r.email) for r in rows] == [("7", "a@example.org")]

    sleep = {
        "id": "s",
        "nap": True,
        "score": {
            "stage_summary": {"total_in_bed_time_milli": 3600000},
            "sleep_needed": {"need_from_recent_nap_milli": -5},
        },
    }
    folder = write_pages(tmp_path / "s", {"records": [sleep]})
    row = landed.flatten_records(load(spark, folder, "sleep"), SOURCES["sleep"]).first()
    assert row.total_in_bed_time_milli == 3600000
    assert row.need_from_recent_nap_milli == -5
    assert row.disturbance_count is None and row.nap is True


def test_bad_records_are_told_apart(spark, tmp_path):
    records = [cycle(1), cycle(2, updated="soon"), cycle(3, updated=""), cycle(None), cycle(5, created_at="x")]
    folder = write_pages(tmp_path / "b", {"records": records})
    bad = landed.rejected_records(load(spark, folder), SOURCES["cycle"]).collect()
    got = {json.loads(r.content).get("id"): r.reason for r in bad}
    assert got == {
        "2": "no readable updated_at",
        "3": "no readable updated_at",
        None: "no id",
        "5": "unreadable created_at",
    }


def test_flatten_any_struct(spark):
    row = {"a": 1, "b": {"c": "x", "d": {"e": 2.5}}, "f": [1, 2]}
    df = spark.read.json(spark.createDataFrame([(json.dumps(row),)], "value string").rdd.map(lambda r: r[0]))
    flat = landed.flatten_struct(df)
    assert flat.columns == ["a", "b_c", "b_d_e", "f"]
    assert flat.first().asDict() == {"a": 1, "b_c": "x", "b_d_e": 2.5, "f": "[1,2]"}


def test_route_by_table_name():
    assert spec_for_table("lake.raw_sleep") is SOURCES["sleep"]
    with pytest.raises(ValueError, match="unknown table"):
        spec_for_table("raw_steps")


def test_column_counts():
    counts = {name: len(spec.fields) for name, spec in SOURCES.items()}
    assert counts == {"cycle": 13, "sleep": 27, "recovery": 13, "workout": 26, "user": 7}


def test_state_rows(spark, ts):
    known = spark.createDataFrame(
        [("cycle", ts("2024-02-01"), "success", ts("2024-02-01"))], STATE_SCHEMA
    )
    names = spark.createDataFrame([("cycle",), ("sleep",)], "table_name string")
    got = {r.table_name: r.last_processed_at for r in state.last_processed(known, names).collect()}
    assert got == {"cycle": ts("2024-02-01"), "sleep": ts("2024-01-01")}

    updates = spark.createDataFrame(
        [("sleep", ts("2024-02-05"))], "table_name string, last_processed_at timestamp_ntz"
    )
    after = state.upsert_state(known, updates, F.lit(str(NOW)))
    assert after.count() == 2
    failed = state.mark_failed(after, names, F.lit(str(NOW)))
    got = {r.table_name: (r.last_processed_at, r.last_run_status) for r in failed.collect()}
    assert got == {
        "cycle": (ts("2024-02-01"), "failed"),
        "sleep": (ts("2024-02-05"), "failed"),
    }


def test_extraction_runs(spark, tmp_path, ts):
    root = str(tmp_path / "root")
    pages = write_pages(tmp_path / "in", {"records": [cycle(1), cycle(2, "2024-02-25T00:00:00Z")]})
    user = write_pages(tmp_path / "user", {"user_id": 7, "email": "a@example.org"})
    paths = {"cycle": pages, "user": user, "sleep": str(tmp_path / "missing")}

    log = {r.source: r for r in extract.run_extract(spark, paths, root, NOW).collect()}
    assert (log["cycle"].status, log["cycle"].records) == ("success", 2)
    assert (log["user"].status, log["user"].records) == ("success", 1)
    assert (log["sleep"].status, log["sleep"].records) == ("failed", 0)
    states = {r.table_name: r for r in spark.read.parquet(f"{root}/pipeline_state").collect()}
    assert states["cycle"].last_processed_at == ts("2024-02-25")
    assert states["sleep"].last_run_status == "failed"
    assert states["sleep"].last_processed_at == ts("2024-01-01")

    # Next run: files that were loaded are not read again, new ones are.
    later = NOW + dt.timedelta(days=1)
    new = [cycle(3, "2024-02-25T00:00:00Z"), cycle(4, "2024-02-24T00:00:00Z")]
    (tmp_path / "in" / "page9.json").write_text(json.dumps({"records": new}))
    log = {r.source: r for r in extract.run_extract(spark, paths, root, later).collect()}
    assert (log["cycle"].records, log["cycle"].outside) == (1, 1)
    raw = spark.read.parquet(f"{root}/raw_cycle")
    assert sorted(r.id for r in raw.collect()) == ["1", "2", "3"]
    assert {r[extract.INGEST_DAY] for r in raw.collect()} == {20240301, 20240302}
    assert spark.read.parquet(f"{root}/raw_user").count() == 1
    assert spark.read.parquet(f"{root}/run_log").count() == 6


def test_nothing_is_dropped_silently(spark, tmp_path, ts):
    root, folder = str(tmp_path / "root"), tmp_path / "in"
    page = {"records": [cycle(1), cycle(2, updated="soon"), cycle(None), cycle(3)]}
    write_pages(folder, page)
    (folder / "cut.json").write_text(json.dumps({"records": [cycle(4), cycle(5)]})[:-40])
    (folder / "pretty.json").write_text(json.dumps({"records": [cycle(6)]}, indent=2))
    row = extract.run_extract(spark, {"cycle": str(folder)}, root, NOW).first()
    held = spark.read.parquet(f"{root}/quarantine").collect()
    assert row.status == "incomplete" and row.rejected == len(held) > 3 and row.error is None
    assert {r.id for r in spark.read.parquet(f"{root}/raw_cycle").collect()} >= {"1", "3"}
    text = "\n".join(r.content for r in held)
    assert '"updated_at":"soon"' in text and '"id": 5' in text and '"id": 6' in text
    assert sum(r.reason == "no id" for r in held) == 1
    state_row = spark.read.parquet(f"{root}/pipeline_state").first()
    assert (state_row.last_run_status, state_row.last_processed_at) == ("incomplete", ts("2024-02-20 08:00"))


def test_a_batch_without_times_keeps_the_watermark(spark, tmp_path, ts):
    root, folder = str(tmp_path / "root"), tmp_path / "in"
    write_pages(folder, {"records": [cycle(1)]})
    extract.run_extract(spark, {"cycle": str(folder)}, root, NOW)
    (folder / "bad.json").write_text(json.dumps({"records": [cycle(2, updated=None)]}))
    row = extract.run_extract(spark, {"cycle": str(folder)}, root, NOW).first()
    assert (row.records, row.rejected, row.newest) == (0, 1, None)
    kept = spark.read.parquet(f"{root}/pipeline_state").collect()
    assert [r.last_processed_at for r in kept] == [ts("2024-02-20 08:00")]


def test_long_errors_are_logged_whole(spark, tmp_path):
    missing = str(tmp_path / ("long" * 50) / ("name" * 50) / ("x" * 200))
    row = extract.run_extract(spark, {"cycle": missing}, str(tmp_path / "root"), NOW).first()
    assert row.status == "failed" and "x" * 200 in row.error


def test_range_includes_its_ends(spark, ts):
    rows = spark.createDataFrame([(ts("2024-02-20"),), (NOW,), (ts("2024-02-19"),), (None,)], "t timestamp_ntz")
    assert rows.filter(extract.in_range("t", ts("2024-02-20"), NOW)).count() == 2


def test_empty_table_has_its_schema(spark, tmp_path):
    spec = SOURCES["workout"]
    empty = tables.read_table(spark, str(tmp_path / "none"), spec.raw_schema)
    assert empty.schema == spec.raw_schema and empty.isEmpty()
