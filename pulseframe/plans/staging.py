"""Raw to staging: typed projection, newest version of each record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.compat import ms_to_hours, ms_to_minutes, round_to_long
from pulseframe.operators.dedup import latest_per_key
from pulseframe.operators.incremental import after_target
from pulseframe.sources.specs import SOURCES, SourceSpec

# Columns turned from milliseconds into hours or minutes. They keep
# their names.
HOURS = (
    "total_in_bed_time_milli",
    "total_light_sleep_time_milli",
    "total_slow_wave_sleep_time_milli",
    "total_rem_sleep_time_milli",
    "baseline_milli",
    "need_from_sleep_debt_milli",
    "need_from_recent_strain_milli",
    "need_from_recent_nap_milli",
)
MINUTES = (
    "total_awake_time_milli",
    "total_no_data_time_milli",
    "zone_zero_milli",
    "zone_one_milli",
    "zone_two_milli",
    "zone_three_milli",
    "zone_four_milli",
    "zone_five_milli",
)
_SHORT_NAMES = {"long": "bigint"}
NEWEST_UPDATE = ("updated_at", "created_at", "ingested_at")
NEWEST_INGEST = ("ingested_at", "updated_at", "created_at")


@dataclass(frozen=True)
class StagingSpec:
    """Typed projection of a raw table: column -> type, with overriding expressions."""

    key: str
    casts: Mapping[str, str]
    overrides: Mapping[str, Column] = field(default_factory=dict)


def project(df: DataFrame, casts: Mapping[str, str], overrides: Mapping[str, Column]) -> DataFrame:
    """One select from a column -> type table; an override replaces the cast."""
    present = dict(df.dtypes)

    def column(name: str, type: str) -> Column:
        if name in overrides:
            return overrides[name]
        if present[name] in (type, _SHORT_NAMES.get(type)):
            return F.col(name)
        return round_to_long(name) if type == "long" else F.col(name).cast(type)

    return df.select(*[column(name, type).alias(name) for name, type in casts.items()])


def staging_spec(source: SourceSpec, keep_fractions: bool = False) -> StagingSpec:
    """Staging projection of a source.

    Measures are rounded to whole numbers unless ``keep_fractions`` is set.
    """
    casts, overrides = {}, {}
    for name, _, type in source.fields:
        if type == "double":
            casts[name] = "double" if keep_fractions else "long"
        elif type == "timestamp":
            casts[name] = "timestamp_ntz"
        else:
            casts[name] = "string" if name == "sport_id" else type
        if name in HOURS:
            overrides[name] = ms_to_hours(name)
        elif name in MINUTES:
            overrides[name] = ms_to_minutes(name)
    return StagingSpec(source.key, casts, overrides)


def stage(
    raw: DataFrame,
    source: str,
    target: DataFrame | None = None,
    order: Sequence[str] = NEWEST_UPDATE,
    keep_fractions: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Staging rows of ``cycle``, ``recovery``, ``sleep`` or ``workout``.

    With a ``target`` only rows created after its newest row are taken; without
    one this is the full refresh. Ties in the update time go to the row created,
    then ingested last. Conversions come after the reduction to one row per record:
    they leave the key and the times as they are. ``whole`` says that all columns are
    wanted: such wide rows are not sorted in the map tasks (see
    :func:`pulseframe.operators.dedup.latest_per_key`).
    """
    spec = staging_spec(SOURCES[source], keep_fractions)
    if target is not None:
        raw = after_target(raw, target, "created_at")
    newest = latest_per_key(raw, [spec.key], order, cut_in_maps=not whole)
    return project(newest, spec.casts, spec.overrides)


def stage_user(raw_user: DataFrame) -> DataFrame:
    """Typed user profiles; rebuilt as a whole, not deduplicated."""
    spec = staging_spec(SOURCES["user"])
    return project(raw_user, spec.casts, spec.overrides)
