"""Staging: rename and cast, row for row. Nothing is filtered or deduplicated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions import lenient_double, lenient_int, lenient_long


def _text(*names: str) -> list[Column]:
    return [F.col(name).cast("string").alias(name) for name in names]


def _ints(df: DataFrame, *names: str) -> list[Column]:
    return [lenient_int(df, name).alias(name) for name in names]


def _doubles(df: DataFrame, *names: str) -> list[Column]:
    return [lenient_double(df, name).alias(name) for name in names]


def _capture_time() -> Column:
    # Strict on purpose: a snapshot without a readable time must not pass unnoticed.
    return F.col("snapshot_timestamp_utc").cast("timestamp").alias("snapshot_timestamp_utc")


def _reported_time(df: DataFrame, alias: str) -> Column:
    return F.timestamp_seconds(lenient_long(df, "timestamp")).alias(alias)


def stg_routes(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("source_feed", "route_id", "agency_id", "route_short_name", "route_long_name"),
        *_ints(raw, "route_type"),
    )


def stg_trips(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("route_id", "service_id", "trip_id", "trip_headsign"),
        *_ints(raw, "direction_id"),
        *_text("shape_id"),
    )


def stg_stops(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("source_feed", "stop_id", "stop_name"), *_doubles(raw, "stop_lat", "stop_lon")
    )


def stg_stop_times(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("source_feed", "trip_id", "arrival_time", "departure_time", "stop_id"),
        *_ints(raw, "stop_sequence", "pickup_type", "drop_off_type", "timepoint"),
    )


def stg_vehicle_positions(raw: DataFrame) -> DataFrame:
    return raw.select(
        _capture_time(),
        *_text("snapshot_folder", "entity_id", "vehicle_id", "trip_id", "route_id"),
        *_doubles(raw, "latitude", "longitude", "bearing", "speed"),
        *_ints(raw, "current_stop_sequence"),
        *_text("current_status"),
        _reported_time(raw, "vehicle_timestamp_utc"),
    )


def stg_trip_updates(raw: DataFrame) -> DataFrame:
    """``stop_time_updates`` is passed through, as JSON text or as a native array."""
    return raw.select(
        _capture_time(),
        *_text("snapshot_folder", "entity_id", "trip_id", "route_id", "vehicle_id"),
        "stop_time_updates",
        _reported_time(raw, "trip_update_timestamp_utc"),
    )
