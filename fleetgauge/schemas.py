"""Explicit schemas: no scan infers types, and an absent column reads as NULL."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """Flat struct from "name type, ..."; needs no session, unlike a DDL string."""
    pairs = [item.split() for item in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Schedule files hold text only; staging decides the types.
SCHEDULE_COLUMNS = {
    "routes": ("route_id", "agency_id", "route_short_name", "route_long_name", "route_type"),
    "trips": ("route_id", "service_id", "trip_id", "trip_headsign", "direction_id", "shape_id"),
    "stops": ("stop_id", "stop_name", "stop_lat", "stop_lon"),
    "stop_times": (
        "trip_id",
        "arrival_time",
        "departure_time",
        "stop_id",
        "stop_sequence",
        "pickup_type",
        "drop_off_type",
        "timepoint",
    ),
    "calendar": (
        "service_id",
        "monday",
        "tuesday",
        "wednesday",
        "thursday",
        "friday",
        "saturday",
        "sunday",
        "start_date",
        "end_date",
    ),
    "calendar_dates": ("service_id", "date", "exception_type"),
}

STOP_UPDATE_FIELDS = (
    "stop_id",
    "stop_sequence",
    "arrival_time",
    "arrival_delay",
    "departure_time",
    "departure_delay",
)
# One mismatched field would void a typed element, so elements are read as text and cast after.
STOP_UPDATES_TEXT = T.ArrayType(_text(*STOP_UPDATE_FIELDS))

RAW_VEHICLE_POSITIONS = _struct(
    "feed_type string, snapshot_timestamp_utc string, entity_id string, vehicle_id string, "
    "trip_id string, route_id string, latitude double, longitude double, bearing double, "
    "speed double, current_stop_sequence bigint, current_status string, timestamp bigint, "
    "snapshot_folder string"
)
RAW_TRIP_UPDATES = _struct(
    "feed_type string, snapshot_timestamp_utc string, entity_id string, trip_id string, "
    "route_id string, vehicle_id string, stop_time_updates string, timestamp bigint, "
    "snapshot_folder string"
)

# Decoded realtime entities, as a protobuf reader hands them over; unset fields are NULL.
_TRIP = "trip:struct<trip_id:string, route_id:string>"
_VEHICLE = "vehicle:struct<id:string>"
_EVENT = "struct<time:bigint, delay:int>"
VEHICLE_ENTITY = (
    f"id string, vehicle struct<{_TRIP}, {_VEHICLE}, "
    "position:struct<latitude:double, longitude:double, bearing:double, speed:double>, "
    "current_stop_sequence:bigint, current_status:int, timestamp:bigint>, "
    "snapshot_timestamp_utc string"
)
TRIP_UPDATE_ENTITY = (
    f"id string, trip_update struct<{_TRIP}, {_VEHICLE}, "
    f"stop_time_update:array<struct<stop_id:string, stop_sequence:bigint, arrival:{_EVENT}, "
    f"departure:{_EVENT}>>, timestamp:bigint>, snapshot_timestamp_utc string"
)

FINDING_COLUMNS = (
    "anomaly_id",
    "anomaly_grain",
    "snapshot_folder",
    "snapshot_timestamp_utc",
    "route_id",
    "trip_id",
    "entity_id",
    "vehicle_id",
    "anomaly_type",
    "anomaly_severity",
    "anomaly_score",
    "anomaly_reason",
    "detector_rule_id",
    "source_model",
)

EVALUATION = _struct(
    "evaluation_record_id string, source_model string, evaluation_record_type string, "
    "snapshot_folder string, snapshot_timestamp_utc timestamp, entity_id string, trip_id string, "
    "route_id string, vehicle_id string, latitude double, longitude double, speed double, "
    "vehicle_timestamp_utc timestamp, trip_update_timestamp_utc timestamp, "
    "schedule_match_status string, estimated_delay_minutes double, delay_sanity_status string, "
    "delay_band string, on_time_flag boolean, is_synthetic_anomaly boolean, "
    "synthetic_anomaly_type string, anomaly_severity string, anomaly_reason string"
)
