"""Route and stop dimensions, route activity, and spacing of vehicles on a route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.functions import ratio_or_zero
from fleetgauge.operators.windows import gap_statistics

_ROUTE_SNAPSHOT = ["snapshot_folder", "route_id"]


def _feed_key(name: str) -> Column:
    # concat, not concat_ws: a key with a missing part must be NULL.
    return F.concat("source_feed", F.lit(":"), name)


def dim_route(routes: DataFrame) -> DataFrame:
    return routes.select(
        _feed_key("route_id").alias("route_key"),
        "source_feed",
        "route_id",
        "agency_id",
        "route_short_name",
        "route_long_name",
        "route_type",
    )


def dim_stop(stops: DataFrame) -> DataFrame:
    return stops.select(
        _feed_key("stop_id").alias("stop_key"),
        "source_feed",
        "stop_id",
        "stop_name",
        "stop_lat",
        "stop_lon",
    )


def _route_counts(records: DataFrame, prefix: str, distinct: dict[str, str]) -> DataFrame:
    """Per route and snapshot: rows, first capture time, distinct values of some columns."""
    return (
        records.where(F.col("route_id").isNotNull())
        .groupBy(*_ROUTE_SNAPSHOT)
        .agg(
            F.count(F.lit(1)).alias(f"{prefix}_rows"),
            F.min("snapshot_timestamp_utc").alias(f"{prefix}_taken_at"),
            *[F.count_distinct(F.col(column)).alias(alias) for alias, column in distinct.items()],
        )
    )


def fct_route_realtime_activity(vehicles: DataFrame, trip_updates: DataFrame) -> DataFrame:
    """Activity of each route in each snapshot, from either feed."""
    seen = _route_counts(vehicles, "vehicle", {"vehicles": "vehicle_id", "vehicle_trips": "trip_id"})
    told = _route_counts(trip_updates, "update", {"update_trips": "trip_id"})
    # One row each way as a rule; two if the feeds of a snapshot carry different capture times.
    taken_at = F.array_distinct(
        F.concat(
            F.when(F.col("vehicle_rows") > 0, F.array("vehicle_taken_at")).otherwise(F.array()),
            F.when(F.col("update_rows") > 0, F.array("update_taken_at")).otherwise(F.array()),
        )
    )
    vehicle_count, update_count = F.col("vehicle_position_count"), F.col("trip_update_count")
    status = (
        F.when((vehicle_count > 0) & (update_count > 0), L.BOTH_FEEDS)
        .when(vehicle_count > 0, L.VEHICLES_ONLY)
        .when(update_count > 0, L.TRIP_UPDATES_ONLY)
        .otherwise(L.INACTIVE)
    )
    return (
        seen.join(told, _ROUTE_SNAPSHOT, "full_outer")
        .select(
            "snapshot_folder",
            F.explode(taken_at).alias("snapshot_timestamp_utc"),
            "route_id",
            F.coalesce("vehicle_rows", F.lit(0)).alias("vehicle_position_count"),
            F.coalesce("update_rows", F.lit(0)).alias("trip_update_count"),
            F.coalesce("vehicles", F.lit(0)).alias("distinct_vehicle_count"),
            F.greatest(F.col("vehicle_trips"), F.col("update_trips")).alias("distinct_trip_count"),
        )
        .select(
            "*",
            (vehicle_count > 0).alias("has_vehicle_positions"),
            (update_count > 0).alias("has_trip_updates"),
            (vehicle_count + update_count).alias("total_realtime_records"),
            ratio_or_zero(vehicle_count, update_count).alias("vehicle_to_trip_update_ratio"),
            status.alias("route_activity_status"),
        )
    )


def fct_headway(
    vehicles: DataFrame,
    *,
    stable: float = L.STABLE_SPACING_MINUTES,
    variable: float = L.VARIABLE_SPACING_MINUTES,
) -> DataFrame:
    """Spacing of successive vehicle reports per route and snapshot.

    ``headway_variance_minutes`` is a sample standard deviation, as its first users named it.
    """
    on_route = vehicles.where(F.col("route_id").isNotNull())
    counts = on_route.groupBy(*_ROUTE_SNAPSHOT).agg(
        F.min("snapshot_timestamp_utc").alias("snapshot_timestamp_utc"),
        F.count(F.lit(1)).alias("vehicle_count"),
        F.count_distinct(F.col("vehicle_id")).alias("distinct_vehicle_count"),
        F.count("vehicle_timestamp_utc").alias("observed_vehicle_sequence_count"),
    )
    gaps = gap_statistics(on_route, _ROUTE_SNAPSHOT, "vehicle_timestamp_utc")
    gap_count = F.col("gap_count")
    span = F.col("last_second") - F.col("first_second")
    comparable = (F.col("distinct_vehicle_count") >= 2) & (gap_count > 0)

    def minutes(seconds: Column) -> Column:
        return F.when(comparable, seconds.cast("double") / 60)

    # n * sum of squares - square of sum, in exact decimals: no cancellation for even spacing.
    spans = span.cast("decimal(19,0)") * span.cast("decimal(19,0)")
    spread = gap_count.cast("decimal(19,0)") * F.col("gap_square_sum").cast("decimal(38,0)") - spans
    pairs = gap_count.cast("double") * (gap_count - 1).cast("double")
    deviation = F.when(gap_count > 1, F.sqrt(spread.cast("double") / pairs)).otherwise(F.lit(0.0))
    status = (
        F.when(F.col("headway_variance_minutes") <= stable, L.STABLE)
        .when(F.col("headway_variance_minutes") <= variable, L.VARIABLE)
        .when(F.col("headway_variance_minutes") > variable, L.HIGHLY_VARIABLE)
        .otherwise(L.TOO_FEW_VEHICLES)
    )
    return (
        counts.join(gaps, _ROUTE_SNAPSHOT, "left")
        .select(
            "snapshot_folder",
            "snapshot_timestamp_utc",
            "route_id",
            "vehicle_count",
            "distinct_vehicle_count",
            "observed_vehicle_sequence_count",
            minutes(span.cast("double") / gap_count).alias("avg_vehicle_spacing_minutes"),
            minutes(F.col("min_gap")).alias("min_vehicle_spacing_minutes"),
            minutes(F.col("max_gap")).alias("max_vehicle_spacing_minutes"),
            minutes(deviation).alias("headway_variance_minutes"),
        )
        .withColumn("headway_reliability_status", status)
    )
