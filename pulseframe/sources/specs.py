"""The five record sources: where each raw column sits in the nested record.

A field is ``(raw column, path in the record, type)``. Times arrive as text and
whole numbers may arrive with a fraction, so the read schema takes text for the
former and double for the latter; :mod:`pulseframe.sources.landed` converts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed value: first watermark of a source.
FIRST_WATERMARK = "2024-01-01 00:00:00"

Field = tuple[str, str, str]


def _record(*names: str, type: str = "string") -> list[Field]:
    return [(name, name, type) for name in names]


def _nested(prefix: str, type: str, *names: str) -> list[Field]:
    return [(name, f"{prefix}.{name}", type) for name in names]


_AUDIT_IN = _record("created_at", "updated_at", type="timestamp")
_SPAN = [("start_time", "start", "timestamp"), ("end_time", "end", "timestamp")]
_STATE = [("score_state", "score.state", "string")]
_AUDIT_OUT = _record("ingested_at", type="timestamp")

_CYCLE = [
    *_record("id", "user_id"),
    *_AUDIT_IN,
    *_SPAN,
    *_record("timezone_offset"),
    *_STATE,
    *_nested("score", "double", "strain", "kilojoule"),
    *_nested("score", "long", "average_heart_rate", "max_heart_rate"),
    *_AUDIT_OUT,
]
_RECOVERY = [
    *_record("cycle_id", "sleep_id", "user_id"),
    *_AUDIT_IN,
    *_STATE,
    ("user_calibrating", "score.user_calibrating", "boolean"),
    *_nested(
        "score",
        "double",
        "recovery_score",
        "resting_heart_rate",
        "hrv_rmssd_milli",
        "spo2_percentage",
        "skin_temp_celsius",
    ),
    *_AUDIT_OUT,
]
_SLEEP = [
    *_record("id", "v1_id", "user_id"),
    *_AUDIT_IN,
    *_SPAN,
    *_record("timezone_offset"),
    *_record("nap", type="boolean"),
    *_STATE,
    *_nested(
        "score.stage_summary",
        "long",
        "total_in_bed_time_milli",
        "total_awake_time_milli",
        "total_no_data_time_milli",
        "total_light_sleep_time_milli",
        "total_slow_wave_sleep_time_milli",
        "total_rem_sleep_time_milli",
        "sleep_cycle_count",
        "disturbance_count",
    ),
    *_nested(
        "score.sleep_needed",
        "long",
        "baseline_milli",
        "need_from_sleep_debt_milli",
        "need_from_recent_strain_milli",
        "need_from_recent_nap_milli",
    ),
    *_nested(
        "score",
        "double",
        "respiratory_rate",
        "sleep_performance_percentage",
        "sleep_consistency_percentage",
        "sleep_efficiency_percentage",
    ),
    *_AUDIT_OUT,
]
_WORKOUT = [
    *_record("id", "v1_id", "user_id"),
    *_AUDIT_IN,
    *_SPAN,
    *_record("timezone_offset", "sport_name"),
    *_STATE,
    *_record("sport_id", type="long"),
    *_nested("score", "double", "strain"),
    *_nested("score", "long", "average_heart_rate", "max_heart_rate"),
    *_nested(
        "score",
        "double",
        "kilojoule",
        "percent_recorded",
        "distance_meter",
        "altitude_gain_meter",
        "altitude_change_meter",
    ),
    *_nested(
        "score.zone_duration",
        "long",
        "zone_zero_milli",
        "zone_one_milli",
        "zone_two_milli",
        "zone_three_milli",
        "zone_four_milli",
        "zone_five_milli",
    ),
    *_AUDIT_OUT,
]
_USER = [
    *_record("user_id", "email", "first_name", "last_name"),
    *_AUDIT_IN,
    *_AUDIT_OUT,
]

_RAW_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
}
_READ_TYPES = {**_RAW_TYPES, "timestamp": T.StringType(), "long": T.DoubleType()}


@dataclass(frozen=True)
class SourceSpec:
    """One record source."""

    name: str
    fields: tuple[Field, ...]
    key: str
    incremental: bool = True
    time_field: str | None = "updated_at"

    @property
    def table(self) -> str:
        return f"raw_{self.name}"

    @property
    def raw_schema(self) -> T.StructType:
        """Schema of the flat raw table."""
        return T.StructType([T.StructField(n, _RAW_TYPES[t]) for n, _, t in self.fields])

    @property
    def record_schema(self) -> T.StructType:
        """Schema of one nested record as it is read."""
        tree: dict = {}
        for _, path, type in self.fields:
            *parents, leaf = path.split(".")
            node = tree
            for parent in parents:
                node = node.setdefault(parent, {})
            node[leaf] = _READ_TYPES[type]

        def build(node) -> T.DataType:
            if isinstance(node, dict):
                return T.StructType([T.StructField(k, build(v)) for k, v in node.items()])
            return node

        return build(tree)

    @property
    def page_schema(self) -> T.StructType:
        """Schema of one page; a payload that is one bare record fits as well.

        ``request_id`` and ``token`` say which request and token brought the page, if that was landed.
        """
        record = self.record_schema
        return T.StructType(
            [
                T.StructField("records", T.ArrayType(record)),
                T.StructField("next_token", T.StringType()),
                T.StructField("request_id", T.StringType()),
                T.StructField("token", T.StringType()),
                *record.fields,
            ]
        )


SOURCES = {
    "cycle": SourceSpec("cycle", tuple(_CYCLE), key="id"),
    "sleep": SourceSpec("sleep", tuple(_SLEEP), key="id"),
    "recovery": SourceSpec("recovery", tuple(_RECOVERY), key="cycle_id"),
    "workout": SourceSpec("workout", tuple(_WORKOUT), key="id"),
    "user": SourceSpec("user", tuple(_USER), key="user_id", incremental=False, time_field=None),
}

STATE_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("last_processed_at", T.TimestampNTZType()),
        T.StructField("last_run_status", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)


def spec_for_table(table: str) -> SourceSpec:
    """Spec of a raw table; a schema prefix is ignored, an unknown table is an error."""
    suffix = table.split(".")[-1]
    for spec in SOURCES.values():
        if spec.table == suffix:
            return spec
    raise ValueError(f"unknown table: {suffix}")
