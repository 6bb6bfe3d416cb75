"""Audits of a capture: what arrived, what succeeded, what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.sources.snapshots import snapshot_lineage


def capture_audit(records: DataFrame) -> DataFrame:
    """Record counts of both feeds per snapshot."""
    feed = F.col("feed_type")
    return records.groupBy("snapshot_folder").agg(
        F.min("snapshot_timestamp_utc").alias("snapshot_timestamp_utc"),
        F.count_if(feed == L.VEHICLE_FEED).alias("vehicle_record_count"),
        F.count_if(feed == L.TRIP_UPDATE_FEED).alias("trip_update_record_count"),
    )


def capture_files(spark: SparkSession, location: str) -> DataFrame:
    """(snapshot_folder, path, byte_count) of the files a capture wrote; contents are not read."""
    files = spark.read.format("binaryFile").load(location)
    return files.select(
        snapshot_lineage(F.col("path")).alias("snapshot_folder"), "path", F.col("length").alias("byte_count")
    )


def capture_status_summary(runs: DataFrame, succeeded: Column | None = None) -> DataFrame:
    """Attempted, succeeded and failed counts of a run log; a NULL status counts as failed."""
    ok = F.col("status") == "succeeded" if succeeded is None else succeeded
    attempted, good = F.count(F.lit(1)), F.count_if(ok)
    return runs.agg(
        attempted.alias("attempted"), good.alias("succeeded"), (attempted - good).alias("failed")
    )


def snapshot_count(duration_minutes: Column, interval_minutes: Column) -> Column:
    """Snapshots planned for a capture window: at least one, a started interval counts."""
    return F.greatest(F.lit(1).cast("bigint"), F.ceil(duration_minutes / interval_minutes))


def _check_interval(interval_minutes: float, duration_minutes: float | None = None) -> None:
    if interval_minutes <= 0:
        raise ValueError("interval_minutes must be greater than 0")
    if duration_minutes is not None and duration_minutes <= 0:
        raise ValueError("duration_minutes must be greater than 0")


def expected_snapshots(
    snapshots: DataFrame, *, interval_minutes: float, duration_minutes: float | None = None
) -> DataFrame:
    """Planned against observed number of snapshots.

    Without a duration the window runs from the first observed snapshot to one interval after
    the last one.
    """
    _check_interval(interval_minutes, duration_minutes)
    every = F.lit(float(interval_minutes))
    observed = snapshots.agg(
        F.count_distinct(F.col("snapshot_folder")).alias("observed_snapshots"),
        F.min("snapshot_timestamp_utc").alias("first_snapshot"),
        F.max("snapshot_timestamp_utc").alias("last_snapshot"),
    )
    span = (F.unix_seconds("last_snapshot") - F.unix_seconds("first_snapshot")).cast("double") / 60
    duration = span + every if duration_minutes is None else F.lit(float(duration_minutes))
    expected = snapshot_count(duration, every)
    return observed.select(
        expected.alias("expected_snapshots"),
        "observed_snapshots",
        F.greatest(expected - F.col("observed_snapshots"), F.lit(0)).alias("shortfall"),
    )


def missing_snapshot_slots(snapshots: DataFrame, *, interval_minutes: float) -> DataFrame:
    """Clock-aligned intervals between the first and the last snapshot in which none was taken.

    The slots of a day are generated per day, so no single row holds the whole calendar.
    """
    _check_interval(interval_minutes)
    step = int(interval_minutes * 60)
    per_day = max(1, 86_400 // step)
    slot = F.floor(F.unix_seconds("snapshot_timestamp_utc") / step)
    taken = snapshots.where(F.col("snapshot_timestamp_utc").isNotNull()).select(slot.alias("slot")).distinct()
    span = taken.agg(F.min("slot").alias("start"), F.max("slot").alias("stop"))
    blocks = span.where(F.col("start").isNotNull()).select(
        "stop", F.explode(F.sequence("start", "stop", F.lit(per_day).cast("bigint"))).alias("first")
    )
    in_block = F.sequence(F.col("first"), F.least(F.col("first") + (per_day - 1), F.col("stop")))
    planned = blocks.select(F.explode(in_block).alias("slot"))
    return planned.join(taken, "slot", "left_anti").select(
        F.timestamp_seconds(F.col("slot") * step).alias("missing_snapshot_timestamp_utc")
    )
