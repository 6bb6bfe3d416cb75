"""Flat realtime records out of decoded feed entities (nested structs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.labels import TRIP_UPDATE_FEED, VEHICLE_FEED, VEHICLE_STOP_STATUS


def _id(path: str) -> Column:
    """Identifier with the empty text of an unset field as NULL."""
    return F.nullif(F.col(path), F.lit(""))


def _status_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(part) for item in VEHICLE_STOP_STATUS.items() for part in item])
    return F.try_element_at(names, code)


def flatten_vehicle_entity(entities: DataFrame) -> DataFrame:
    """One 13-field record per entity that carries a vehicle."""
    return entities.where(F.col("vehicle").isNotNull()).select(
        F.lit(VEHICLE_FEED).alias("feed_type"),
        "snapshot_timestamp_utc",
        _id("id").alias("entity_id"),
        _id("vehicle.vehicle.id").alias("vehicle_id"),
        _id("vehicle.trip.trip_id").alias("trip_id"),
        _id("vehicle.trip.route_id").alias("route_id"),
        "vehicle.position.latitude",
        "vehicle.position.longitude",
        "vehicle.position.bearing",
        "vehicle.position.speed",
        "vehicle.current_stop_sequence",
        _status_name(F.col("vehicle.current_status")).alias("current_status"),
        "vehicle.timestamp",
    )


def flatten_trip_update_entity(entities: DataFrame) -> DataFrame:
    """One 8-field record per entity that carries a trip update, stop updates as a native array."""

    def stop_update(update: Column) -> Column:
        return F.struct(
            F.nullif(update["stop_id"], F.lit("")).alias("stop_id"),
            update["stop_sequence"].alias("stop_sequence"),
            update["arrival"]["time"].alias("arrival_time"),
            update["arrival"]["delay"].alias("arrival_delay"),
            update["departure"]["time"].alias("departure_time"),
            update["departure"]["delay"].alias("departure_delay"),
        )

    no_updates = F.array().cast(
        "array<struct<stop_id:string, stop_sequence:bigint, arrival_time:bigint, "
        "arrival_delay:int, departure_time:bigint, departure_delay:int>>"
    )
    updates = F.transform("trip_update.stop_time_update", stop_update)
    return entities.where(F.col("trip_update").isNotNull()).select(
        F.lit(TRIP_UPDATE_FEED).alias("feed_type"),
        "snapshot_timestamp_utc",
        _id("id").alias("entity_id"),
        _id("trip_update.trip.trip_id").alias("trip_id"),
        _id("trip_update.trip.route_id").alias("route_id"),
        _id("trip_update.vehicle.id").alias("vehicle_id"),
        F.coalesce(updates, no_updates).alias("stop_time_updates"),
        "trip_update.timestamp",
    )
