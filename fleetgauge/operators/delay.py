"""Stop-level delay: unnest realtime stop updates, match the schedule, estimate delay, sum up trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge import labels as L
from fleetgauge.functions import late_by_seconds, number_from_json, with_clock_seconds
from fleetgauge.schemas import STOP_UPDATES_TEXT

_TRIP_SNAPSHOT = ["snapshot_folder", "trip_id"]


def _is_native(trip_updates: DataFrame) -> bool:
    return isinstance(trip_updates.schema["stop_time_updates"].dataType, T.ArrayType)


def _stop_update_array(trip_updates: DataFrame) -> Column:
    """The stop updates as an array of text fields, whichever way they are stored; NULL for a text that is no array."""
    column = F.col("stop_time_updates")
    if _is_native(trip_updates):
        return column
    # A lone object would pass for an array of one.
    return F.when(F.ltrim(column).startswith("["), F.from_json(column, STOP_UPDATES_TEXT))


def _whole(value: Column, stored: T.DataType, target: str) -> Column:
    if isinstance(stored, T.StringType):
        return number_from_json(value, target)
    return value.try_cast(target)


_UPDATE_COLUMNS = ("snapshot_folder", "snapshot_timestamp_utc", "entity_id", "trip_id", "route_id", "vehicle_id")


def _typed_updates(exploded: DataFrame, stored: T.StructType, *kept: str) -> DataFrame:
    """Columns of the struct ``update`` with their types and presence flags."""

    def field(name: str, target: str) -> Column:
        return _whole(F.col("update")[name], stored[name].dataType, target)

    typed = exploded.select(
        *_UPDATE_COLUMNS,
        F.col("update.stop_id").cast("string").alias("stop_id"),
        field("stop_sequence", "int").alias("stop_sequence"),
        F.timestamp_seconds(field("arrival_time", "bigint")).alias("arrival_time_utc"),
        field("arrival_delay", "int").alias("arrival_delay_seconds"),
        F.timestamp_seconds(field("departure_time", "bigint")).alias("departure_time_utc"),
        field("departure_delay", "int").alias("departure_delay_seconds"),
        *kept,
    )
    presence = {
        "stop_update_has_arrival_time": "arrival_time_utc",
        "stop_update_has_departure_time": "departure_time_utc",
        "stop_update_has_arrival_delay": "arrival_delay_seconds",
        "stop_update_has_departure_delay": "departure_delay_seconds",
    }
    return typed.withColumns({flag: F.col(name).isNotNull() for flag, name in presence.items()})


def _element_type(trip_updates: DataFrame) -> T.StructType:
    return trip_updates.select(_stop_update_array(trip_updates).alias("a")).schema["a"].dataType.elementType


def realtime_stop_time_updates(trip_updates: DataFrame) -> DataFrame:
    """One row per stop update. A trip update without any, or with NULL, yields no row."""
    exploded = trip_updates.select(*_UPDATE_COLUMNS, F.explode(_stop_update_array(trip_updates)).alias("update"))
    return _typed_updates(exploded, _element_type(trip_updates))


def unreadable_stop_updates(trip_updates: DataFrame) -> DataFrame:
    """Trip updates whose stop update text is no JSON array; the unnest drops these silently."""
    unreadable = F.col("stop_time_updates").isNotNull() & _stop_update_array(trip_updates).isNull()
    return trip_updates.where(unreadable)


def tagged_stop_updates(trip_updates: DataFrame) -> DataFrame:
    """``realtime_stop_time_updates`` and the unreadable trip updates, from one parse of each text.

    ``is_rejected`` tells them apart: a rejected row has the text in ``rejected_text`` and no stop. NULL and
    empty arrays give no row of either kind; natively stored arrays are never rejected.
    """
    element = _element_type(trip_updates)
    text = F.lit(None).cast("string") if _is_native(trip_updates) else F.col("stop_time_updates")
    no_update, no_text = F.lit(None).cast(element), F.lit(None).cast("string")
    entries = F.when(
        F.col("parsed").isNotNull(),
        F.transform("parsed", lambda update: F.struct(update.alias("update"), no_text.alias("rejected_text"))),
    ).when(text.isNotNull(), F.array(F.struct(no_update.alias("update"), text.alias("rejected_text"))))
    exploded = (
        trip_updates.withColumn("parsed", _stop_update_array(trip_updates))
        .select(*_UPDATE_COLUMNS, F.explode(entries).alias("entry"))
        .select(*_UPDATE_COLUMNS, "entry.update", "entry.rejected_text")
    )
    typed = _typed_updates(exploded, element, "rejected_text")
    return typed.withColumn("is_rejected", F.col("rejected_text").isNotNull())


_CLOCKS = {
    "arrival_time": "arrival_seconds_after_midnight",
    "departure_time": "departure_seconds_after_midnight",
}


def _normalized(stop_times: DataFrame) -> DataFrame:
    columns = ["trip_id", "stop_id", "stop_sequence", *_CLOCKS]
    return with_clock_seconds(stop_times.select(*columns), _CLOCKS)


def scheduled_stop_times_normalized(stop_times: DataFrame, stop_updates: DataFrame) -> DataFrame:
    """Schedule of the trips seen in realtime, with clock texts as seconds after midnight."""
    # Distinct before the semi join: one row per trip crosses the network, not one per stop update.
    seen = stop_updates.select("trip_id").where(F.col("trip_id").isNotNull()).distinct()
    # A hash of these trips, dealt over the tasks: the whole schedule need not be sorted to find a few of its trips.
    return _normalized(stop_times.join(seen.hint("shuffle_hash"), "trip_id", "left_semi"))


def _estimated_minutes(side: str, **service_day) -> Column:
    """Stated delay if there is one, else actual time against the scheduled time of its service day."""
    stated = F.col(f"{side}_delay_seconds")
    derived = late_by_seconds(
        F.col(f"{side}_time_utc"), F.col(f"{side}_seconds_after_midnight"), **service_day
    )
    return F.coalesce(stated.cast("bigint"), derived) / F.lit(60.0).cast("double")


def stop_time_schedule_vs_actual(
    stop_updates: DataFrame,
    stop_times: DataFrame,
    *,
    day_offset_seconds: int = L.SERVICE_DAY_OFFSET_SECONDS,
    service_day: str = "calendar",
) -> DataFrame:
    """Left join of stop updates to the schedule on trip, sequence and stop, with delays.

    ``stop_times`` is the staged or the normalized schedule. Reducing it to realtime trips first
    changes nothing here, since the left join already ignores the other trips; leaving that out
    saves a second pass over the stop updates.
    """
    key = ["trip_id", "stop_sequence", "stop_id"]
    if "arrival_seconds_after_midnight" not in stop_times.columns:
        stop_times = _normalized(stop_times)
    scheduled = stop_times.where(
        F.col("trip_id").isNotNull() & F.col("stop_sequence").isNotNull() & F.col("stop_id").isNotNull()
    ).select(
        *key,
        "arrival_seconds_after_midnight",
        "departure_seconds_after_midnight",
        F.lit(True).alias("in_schedule"),
    )
    matched = F.col("in_schedule").isNotNull()
    scheduled_at = F.coalesce("arrival_seconds_after_midnight", "departure_seconds_after_midnight")
    service = {"day_offset_seconds": day_offset_seconds, "service_day": service_day}
    joined = stop_updates.join(scheduled, key, "left").withColumns(
        {
            "estimated_arrival_delay_minutes": _estimated_minutes("arrival", **service),
            "estimated_departure_delay_minutes": _estimated_minutes("departure", **service),
        }
    )
    return joined.select(
        "snapshot_folder",
        "snapshot_timestamp_utc",
        "entity_id",
        "trip_id",
        "route_id",
        "vehicle_id",
        "stop_id",
        "stop_sequence",
        "arrival_time_utc",
        "departure_time_utc",
        "arrival_seconds_after_midnight",
        "departure_seconds_after_midnight",
        matched.alias("matched_scheduled_stop"),
        (matched & scheduled_at.isNull()).alias("schedule_time_parse_failed"),
        "estimated_arrival_delay_minutes",
        "estimated_departure_delay_minutes",
        F.coalesce("estimated_arrival_delay_minutes", "estimated_departure_delay_minutes").alias(
            "estimated_delay_minutes"
        ),
    )


def trip_schedule_vs_actual(trip_updates: DataFrame, trips: DataFrame) -> DataFrame:
    """Trip updates with their scheduled trip, if any, and the match status."""
    scheduled = trips.where(F.col("trip_id").isNotNull()).select(
        "trip_id",
        F.col("route_id").alias("scheduled_route_id"),
        "trip_headsign",
        "direction_id",
        "shape_id",
        F.lit(L.MATCHED).alias("match"),
    )
    return trip_updates.join(scheduled, "trip_id", "left").select(
        "snapshot_folder",
        "snapshot_timestamp_utc",
        "entity_id",
        "trip_id",
        F.col("route_id").alias("realtime_route_id"),
        "scheduled_route_id",
        "vehicle_id",
        "trip_update_timestamp_utc",
        F.coalesce("match", F.lit(L.UNMATCHED)).alias("schedule_match_status"),
        "trip_headsign",
        "direction_id",
        "shape_id",
    )


def _trip_snapshots(trip_updates: DataFrame) -> DataFrame:
    """One row per trip and snapshot. ``min`` stands for any value, so reruns agree."""
    return trip_updates.groupBy(*_TRIP_SNAPSHOT).agg(
        F.min("snapshot_timestamp_utc").alias("snapshot_timestamp_utc"),
        F.min("route_id").alias("route_id"),
        F.min("vehicle_id").alias("vehicle_id"),
    )


def _trip_attributes(trips: DataFrame) -> DataFrame:
    """One row per scheduled trip, so that a repeated trip id cannot multiply mart rows."""
    return (
        trips.where(F.col("trip_id").isNotNull())
        .groupBy("trip_id")
        .agg(
            F.min("trip_headsign").alias("trip_headsign"),
            F.min("direction_id").alias("direction_id"),
            F.lit(L.MATCHED).alias("match"),
        )
    )


def _trip_delays(stop_delays: DataFrame) -> DataFrame:
    minutes = F.col("estimated_delay_minutes")
    # Delays are whole seconds: their sum is exact, so the average does not depend on the
    # order in which partitions arrive and lands on the same side of a band edge every time.
    seconds = F.round(minutes * 60).cast("bigint")
    return stop_delays.groupBy(*_TRIP_SNAPSHOT).agg(
        F.count(F.lit(1)).alias("stop_updates"),
        F.count_if("matched_scheduled_stop").alias("matched_stops"),
        F.min(F.coalesce("arrival_time_utc", "departure_time_utc")).alias("first_realtime_stop_time_utc"),
        F.max(F.coalesce("departure_time_utc", "arrival_time_utc")).alias("last_realtime_stop_time_utc"),
        F.sum(seconds).alias("delay_seconds"),
        F.count(minutes).alias("delayed_stops"),
        F.max(minutes).alias("max_estimated_delay_minutes"),
        F.min(minutes).alias("min_estimated_delay_minutes"),
        F.count_if("schedule_time_parse_failed").alias("unreadable_stops"),
    )


def delay_band(minutes: Column) -> Column:
    """Seven bands; an edge belongs to the band nearer to on time, -5 and -1 to the later one."""
    very_early, early, on_time, late, later, very_late = L.DELAY_BAND_EDGES
    names = L.DELAY_BANDS
    return (
        F.when(minutes.isNull(), L.BAND_UNAVAILABLE)
        .when(minutes < very_early, names[0])
        .when(minutes < early, names[1])
        .when(minutes <= on_time, names[2])
        .when(minutes <= late, names[3])
        .when(minutes <= later, names[4])
        .when(minutes <= very_late, names[5])
        .otherwise(names[6])
    )


def delay_sanity(minutes: Column, plausible: tuple[float, float] = L.PLAUSIBLE_DELAY_RANGE) -> Column:
    return (
        F.when(minutes.isNull(), L.DELAY_UNAVAILABLE)
        .when(minutes < plausible[0], L.EXTREME_EARLY)
        .when(minutes > plausible[1], L.EXTREME_LATE)
        .otherwise(L.PLAUSIBLE)
    )


def fct_on_time_performance(
    trip_updates: DataFrame,
    trips: DataFrame,
    stop_delays: DataFrame,
    *,
    on_time: tuple[float, float] = L.ON_TIME_RANGE,
    plausible: tuple[float, float] = L.PLAUSIBLE_DELAY_RANGE,
) -> DataFrame:
    """One row per trip and snapshot with its delay summary.

    Both inputs are summed to that grain first and meet on the partitioning the sums left
    behind; only those rows, not the stop updates, then look up the schedule.
    """
    base = _trip_snapshots(trip_updates)
    delays = _trip_delays(stop_delays.where(F.col("trip_id").isNotNull()))
    summed = base.join(delays, _TRIP_SNAPSHOT, "left").join(_trip_attributes(trips), "trip_id", "left")
    average = F.col("avg_estimated_delay_minutes")
    stops, matched, delayed, unreadable = (
        F.coalesce(name, F.lit(0))
        for name in ("stop_updates", "matched_stops", "delayed_stops", "unreadable_stops")
    )
    average_of_sum = F.when(
        F.col("delayed_stops") > 0,
        F.col("delay_seconds").cast("double") / (F.col("delayed_stops").cast("double") * 60),
    )
    status = (
        F.when(delayed > 0, L.DELAY_AVAILABLE)
        .when((matched > 0) & (unreadable > 0), L.SCHEDULE_UNREADABLE)
        .otherwise(L.DELAY_UNAVAILABLE)
    )
    return summed.withColumn("avg_estimated_delay_minutes", average_of_sum).select(
        "snapshot_folder",
        "snapshot_timestamp_utc",
        "trip_id",
        "route_id",
        "vehicle_id",
        "trip_headsign",
        "direction_id",
        F.coalesce("match", F.lit(L.UNMATCHED)).alias("schedule_match_status"),
        stops.alias("stop_update_count"),
        matched.alias("matched_stop_update_count"),
        "first_realtime_stop_time_utc",
        "last_realtime_stop_time_utc",
        average,
        "max_estimated_delay_minutes",
        "min_estimated_delay_minutes",
        average.alias("estimated_delay_minutes"),
        F.abs(average).alias("delay_minutes_abs"),
        average.between(*on_time).alias("on_time_flag"),
        status.alias("delay_data_status"),
        delay_sanity(average, plausible).alias("delay_sanity_status"),
        delay_band(average).alias("delay_band"),
    )
