"""Feed quality: missing positions, duplicates, dangling references, freshness, snapshot summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.functions import ratio_or_zero, seconds_between
from fleetgauge.operators.windows import previous_time


def quality_null_gps(vehicles: DataFrame) -> DataFrame:
    no_lat, no_lon = F.col("latitude").isNull(), F.col("longitude").isNull()
    issue = (
        F.when(no_lat & no_lon, L.NO_COORDINATES).when(no_lat, L.NO_LATITUDE).otherwise(L.NO_LONGITUDE)
    )
    return vehicles.where(no_lat | no_lon).select(
        "snapshot_timestamp_utc",
        "snapshot_folder",
        "entity_id",
        "vehicle_id",
        "trip_id",
        "route_id",
        "latitude",
        "longitude",
        issue.alias("quality_issue"),
    )


def quality_duplicate_entities(records: DataFrame) -> DataFrame:
    """Entities that occur more than once in a snapshot; a NULL entity is an entity too."""
    return (
        records.groupBy("snapshot_folder", "entity_id")
        .agg(
            F.count(F.lit(1)).alias("duplicate_record_count"),
            F.min("snapshot_timestamp_utc").alias("first_snapshot_timestamp_utc"),
            F.max("snapshot_timestamp_utc").alias("last_snapshot_timestamp_utc"),
        )
        .where("duplicate_record_count > 1")
    )


def _by_feed(vehicles: DataFrame, trip_updates: DataFrame, *columns: str) -> DataFrame:
    """Both feeds stacked, with the feed name and the given columns."""
    tagged = [
        df.select(F.lit(feed).alias("realtime_source"), *columns)
        for feed, df in ((L.VEHICLE_FEED, vehicles), (L.TRIP_UPDATE_FEED, trip_updates))
    ]
    return tagged[0].unionByName(tagged[1])


def quality_realtime_trip_referential_integrity(
    vehicles: DataFrame, trip_updates: DataFrame, trips: DataFrame
) -> DataFrame:
    """Trips reported in a snapshot that the schedule does not have, once per feed.

    The schedule is looked up first: nearly all reports match, so only the few that do not reach
    the shuffle that makes them distinct. A trip id that dominates the reports is split by the
    skew handling of the anti join.
    """
    reported = _by_feed(vehicles, trip_updates, "snapshot_folder", "trip_id").where(
        F.col("trip_id").isNotNull()
    )
    unknown = reported.join(trips.select("trip_id"), "trip_id", "left_anti").distinct()
    return unknown.select(
        "realtime_source",
        "snapshot_folder",
        "trip_id",
        F.lit(L.MISSING_FROM_TRIPS).alias("quality_issue"),
    )


def _snapshots(vehicles: DataFrame, trip_updates: DataFrame) -> DataFrame:
    columns = ["snapshot_folder", "snapshot_timestamp_utc"]
    return vehicles.select(*columns).union(trip_updates.select(*columns)).distinct()


def quality_snapshot_freshness(
    vehicles: DataFrame, trip_updates: DataFrame, *, max_gap_minutes: float = L.SNAPSHOT_GAP_MINUTES
) -> DataFrame:
    """Gap between each snapshot and the one before it in time."""
    return snapshot_gaps(_snapshots(vehicles, trip_updates), max_gap_minutes=max_gap_minutes)


def snapshot_gaps(snapshots: DataFrame, *, max_gap_minutes: float = L.SNAPSHOT_GAP_MINUTES) -> DataFrame:
    """Freshness of (snapshot_folder, snapshot_timestamp_utc) rows."""
    previous = F.col("previous_snapshot_timestamp_utc")
    gap = seconds_between(previous, F.col("snapshot_timestamp_utc")) / F.lit(60.0).cast("double")
    status = (
        F.when(previous.isNull(), L.FIRST_SNAPSHOT)
        .when(F.col("gap_minutes") > max_gap_minutes, L.GAP_EXCEEDED)
        .otherwise(L.WITHIN_INTERVAL)
    )
    ordered = previous_time(
        snapshots,
        "snapshot_timestamp_utc",
        "previous_snapshot_timestamp_utc",
        tie_break="snapshot_folder",
    )
    return ordered.withColumn("gap_minutes", gap).select(
        "snapshot_folder",
        "snapshot_timestamp_utc",
        "previous_snapshot_timestamp_utc",
        "gap_minutes",
        status.alias("freshness_status"),
    )


def snapshot_keys(vehicles: DataFrame, trip_updates: DataFrame, trips: DataFrame) -> DataFrame:
    """What the snapshot summary and the findings on keys need, from one pass over each feed.

    Every record becomes three tagged keys: its entity, its trip if it names one, and its capture time. A
    row is a distinct one of them in a feed's snapshot with its number of records; of trips only those stay
    that the schedule lacks. Groupings combine on the map side, so neither a snapshot, an entity nor a
    trip with most of the records is gathered; distinct keys alone look up the schedule.
    """
    missing = F.col("latitude").isNull() | F.col("longitude").isNull()
    records = _by_feed(
        vehicles.withColumn("no_position", missing.cast("int")),
        trip_updates.withColumn("no_position", F.lit(0)),
        "snapshot_folder",
        "snapshot_timestamp_utc",
        "entity_id",
        "trip_id",
        "no_position",
    )
    no_time = F.lit(None).cast("timestamp")

    def tagged(kind: str, key: Column, time: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), time.alias("time"))

    keys = F.array(
        tagged("entity", F.col("entity_id"), no_time),
        tagged("time", F.lit(None).cast("string"), F.col("snapshot_timestamp_utc")),
        F.when(F.col("trip_id").isNotNull(), tagged("trip", F.col("trip_id"), no_time)),
    )
    source = ["realtime_source", "snapshot_folder"]
    tags = records.select(*source, "snapshot_timestamp_utc", "no_position", F.explode(keys).alias("tag"))
    distinct = (
        tags.where(F.col("tag").isNotNull())
        .groupBy(*source, F.col("tag.kind").alias("kind"), F.col("tag.key").alias("key"), F.col("tag.time").alias("time"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("snapshot_timestamp_utc").alias("first_time"),
            F.sum("no_position").alias("no_position"),
        )
    )
    scheduled = trips.select(F.col("trip_id").alias("scheduled_trip"))
    # Entities meet the schedule by their ids too, which spreads them; the kind keeps them from matching.
    in_schedule = (F.col("key") == F.col("scheduled_trip")) & (F.col("kind") == "trip")
    return distinct.join(scheduled, in_schedule, "left_anti")


def key_issues(keys: DataFrame) -> DataFrame:
    """Repeated trip update entities and unmatched trips among ``snapshot_keys``, in one table.

    Columns as in ``quality_duplicate_entities`` and ``quality_realtime_trip_referential_integrity``; those of the
    other kind are NULL.
    """
    entity, trip = F.col("kind") == "entity", F.col("kind") == "trip"
    repeated = entity & (F.col("realtime_source") == L.TRIP_UPDATE_FEED) & (F.col("records") > 1)
    # Asking for the missing positions as well keeps the columns those of the summary, so that both share one pass.
    found = keys.where((repeated | trip) & (F.col("no_position") >= 0))
    return found.select(
        "realtime_source",
        "snapshot_folder",
        F.when(entity, F.col("key")).alias("entity_id"),
        F.when(trip, F.col("key")).alias("trip_id"),
        F.when(entity, F.col("records")).alias("duplicate_record_count"),
        F.when(entity, F.col("first_time")).alias("first_snapshot_timestamp_utc"),
        F.when(trip, F.lit(L.MISSING_FROM_TRIPS)).alias("quality_issue"),
    )


def feed_quality_summary(
    vehicles: DataFrame,
    trip_updates: DataFrame,
    trips: DataFrame,
    *,
    max_gap_minutes: float = L.SNAPSHOT_GAP_MINUTES,
) -> DataFrame:
    """Per snapshot: counts of records and issues, gap, freshness and overall status."""
    return summarize_keys(snapshot_keys(vehicles, trip_updates, trips), max_gap_minutes=max_gap_minutes)


def summarize_keys(
    keys: DataFrame, *, max_gap_minutes: float = L.SNAPSHOT_GAP_MINUTES, known: DataFrame | None = None
) -> DataFrame:
    """The snapshot summary out of ``snapshot_keys``.

    ``known`` (snapshot_folder, snapshot_timestamp_utc) are snapshots that are in the order of times and not in the result.

    Both feeds of a snapshot share one capture time. Should they differ, the snapshot has a row
    for each time, as the set union of the two feeds' snapshots has.
    """
    vehicle = F.col("realtime_source") == L.VEHICLE_FEED
    entity, trip, time = (F.col("kind") == kind for kind in ("entity", "trip", "time"))

    def total(when: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0))

    # Sums and minima alone in the pass over the keys: a set of times there would have them sorted by snapshot.
    summed = keys.groupBy("snapshot_folder", time.alias("is_time"), "time").agg(
        total(entity & vehicle, F.col("records")).alias("vehicle_record_count"),
        total(entity & ~vehicle, F.col("records")).alias("trip_update_record_count"),
        total(entity, F.col("no_position")).alias("null_gps_count"),
        F.count_if(entity & vehicle & (F.col("records") > 1)).alias("duplicate_vehicle_entity_count"),
        F.count_if(entity & ~vehicle & (F.col("records") > 1)).alias("duplicate_trip_update_entity_count"),
        F.count_if(trip).alias("unmatched_realtime_trip_count"),
        F.min(F.when(entity & vehicle, F.col("first_time"))).alias("vehicles_taken_at"),
        F.min(F.when(entity & ~vehicle, F.col("first_time"))).alias("updates_taken_at"),
    )
    sums, firsts = summed.columns[3:9], summed.columns[9:]
    counts = summed.groupBy("snapshot_folder").agg(
        *[F.sum(name).alias(name) for name in sums],
        *[F.min(name).alias(name) for name in firsts],
        # As a rule one time; an unknown one is a time of its own.
        F.collect_set(F.when(F.col("is_time"), F.struct("time"))).alias("times"),
    )
    taken_at = F.array_distinct(
        F.concat(
            F.when(F.col("vehicle_record_count") > 0, F.array("vehicles_taken_at")).otherwise(F.array()),
            F.when(F.col("trip_update_record_count") > 0, F.array("updates_taken_at")).otherwise(F.array()),
        )
    )
    timed = counts.select("*", F.explode("times.time").alias("snapshot_time"), F.lit(False).alias("is_known"))
    if known is not None:
        others = known.select("snapshot_folder", F.col("snapshot_timestamp_utc").alias("snapshot_time"), F.lit(True).alias("is_known"))
        timed = timed.unionByName(others, allowMissingColumns=True)
    previous = F.col("previous_time")
    gap = seconds_between(previous, F.col("snapshot_time")) / F.lit(60.0).cast("double")
    late = F.col("snapshot_gap_minutes") > max_gap_minutes
    freshness = F.when(previous.isNull(), L.FIRST_SNAPSHOT).when(late, L.LATE).otherwise(L.WITHIN_INTERVAL)
    fresh = previous_time(timed, "snapshot_time", "previous_time", tie_break="snapshot_folder")
    fresh = fresh.where(~F.col("is_known")).withColumn("snapshot_gap_minutes", gap).withColumn("freshness_status", freshness)
    issues = (
        "null_gps_count",
        "duplicate_vehicle_entity_count",
        "duplicate_trip_update_entity_count",
        "unmatched_realtime_trip_count",
    )
    one_feed = (F.col("vehicle_record_count") == 0) | (F.col("trip_update_record_count") == 0)
    flawed = F.greatest(*issues) > 0
    status = (
        F.when(one_feed, L.CRITICAL)
        .when(flawed | (F.col("freshness_status") == L.LATE), L.WARNING)
        .otherwise(L.HEALTHY)
    )
    return fresh.withColumn("snapshot_timestamp_utc", F.explode(taken_at)).select(
        "snapshot_folder",
        "snapshot_timestamp_utc",
        "vehicle_record_count",
        "trip_update_record_count",
        *issues,
        "snapshot_gap_minutes",
        "freshness_status",
        status.alias("feed_quality_status"),
    )


_SUMMARY = (
    "snapshot_folder",
    "snapshot_timestamp_utc",
    "vehicle_record_count",
    "trip_update_record_count",
    "null_gps_count",
    "duplicate_vehicle_entity_count",
    "duplicate_trip_update_entity_count",
    "unmatched_realtime_trip_count",
    "snapshot_gap_minutes",
    "freshness_status",
    "feed_quality_status",
)


def summary_of_mart(mart: DataFrame) -> DataFrame:
    """The summary that ``fct_feed_quality`` was made of, whose rows and columns it all keeps."""
    return mart.select(*_SUMMARY)


def fct_feed_quality(summary: DataFrame) -> DataFrame:
    """The summary with totals, rates and the completeness proxy."""
    total = F.col("vehicle_record_count") + F.col("trip_update_record_count")
    complete = (F.col("vehicle_record_count") > 0) & (F.col("trip_update_record_count") > 0)
    return summary.select(
        "snapshot_folder",
        "snapshot_timestamp_utc",
        "vehicle_record_count",
        "trip_update_record_count",
        total.alias("total_realtime_records"),
        "null_gps_count",
        "duplicate_vehicle_entity_count",
        "duplicate_trip_update_entity_count",
        "unmatched_realtime_trip_count",
        "snapshot_gap_minutes",
        "freshness_status",
        "feed_quality_status",
        ratio_or_zero(F.col("null_gps_count"), F.col("vehicle_record_count")).alias("null_gps_rate"),
        ratio_or_zero(
            F.col("duplicate_trip_update_entity_count"), F.col("trip_update_record_count")
        ).alias("duplicate_trip_update_rate"),
        ratio_or_zero(F.col("unmatched_realtime_trip_count"), total).alias(
            "unmatched_realtime_trip_rate"
        ),
        complete.cast("double").alias("feed_completeness_proxy"),
    )
