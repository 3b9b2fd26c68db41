"""Run state: one watermark row per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.incremental import merge_upsert
from pulseframe.sources.specs import FIRST_WATERMARK


def _first() -> Column:
    return F.lit(FIRST_WATERMARK).cast("timestamp_ntz")


def last_processed(state: DataFrame, names: DataFrame) -> DataFrame:
    """Watermark of each requested source; the first-run default where there is none."""
    known = state.select("table_name", "last_processed_at")
    return names.join(known, "table_name", "left").select(
        "table_name", F.coalesce("last_processed_at", _first()).alias("last_processed_at")
    )


def upsert_state(
    state: DataFrame, updates: DataFrame, now: Column, status: str = "success"
) -> DataFrame:
    """State after a run; ``updates`` holds ``(table_name, last_processed_at)``."""
    rows = updates.select(
        "table_name",
        "last_processed_at",
        F.lit(status).alias("last_run_status"),
        now.cast("timestamp_ntz").alias("updated_at"),
    )
    return merge_upsert(state, rows, ["table_name"])


def mark_failed(state: DataFrame, names: DataFrame, now: Column) -> DataFrame:
    """State after a failed run: the watermark stays, the status becomes ``failed``."""
    return upsert_state(state, last_processed(state, names), now, status="failed")
