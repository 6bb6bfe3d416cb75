"""Schedule and snapshot files written by Spark out of the test tables, for the file scans to read.

Each folder is written once per application and table folder, below the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.labels import REQUIRED_TABLES, TRIP_UPDATE_FEED, VEHICLE_FEED
from fleetgauge.session import new_scratch_path, together
from fleetgauge.sources import star_tables
from fleetgauge.sources.snapshots import write_snapshot_arrays

_written: dict[tuple[str, str, str], str] = {}

FEEDS = ("busco", "brooklyn", "bronx")


def _once(spark: SparkSession, folder: str, label: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _written:
        # A label may end in the name that the file should have.
        label, _, name = label.partition("/")
        path = "/".join(filter(None, (new_scratch_path(spark, label), name)))
        write(path)
        _written[key] = path
    return _written[key]


def _feed_number(table: str) -> str:
    """Which of the feeds a row goes to, from the digits of its id."""
    key = {"routes": "route_id", "trips": "trip_id", "stops": "stop_id", "stop_times": "trip_id"}[table]
    return f"pmod(cast(substring({key}, 2) as bigint), {len(FEEDS)})"


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def schedule_folder(spark: SparkSession, folder: str) -> str:
    """Per-feed folders, two of them with a calendar table, beside a flat folder they take precedence over."""

    def write(root: str) -> None:
        for table in REQUIRED_TABLES:
            rows = getattr(star_tables, f"raw_{table}")(spark, folder).drop("source_feed")
            for number, feed in enumerate(FEEDS):
                part = rows.where(f"{_feed_number(table)} = {number}")
                _write_csv(part, f"{root}/{feed}/extracted/{table}.txt")
        services = star_tables.raw_trips(spark, folder).select("service_id").distinct()
        _write_csv(services, f"{root}/{FEEDS[0]}/extracted/calendar.txt")
        exceptions = star_tables.raw_trips(spark, folder).selectExpr(
            "service_id", "IF(direction_id = '0', '20240101', '20240704') AS date", "1 + direction_id AS exception_type"
        )
        _write_csv(exceptions.distinct(), f"{root}/{FEEDS[1]}/extracted/calendar_dates.txt")
        _write_csv(star_tables.raw_stops(spark, folder), f"{root}/extracted/stops.txt")

    return _once(spark, folder, "schedule", write)


def quoted_stop_times(spark: SparkSession, folder: str) -> str:
    """Stop times with headsigns that hold quotes and line breaks, some several."""

    def write(path: str) -> None:
        rows = star_tables.raw_stop_times(spark, folder).drop("source_feed").selectExpr(
            "*",
            """CASE stop_sequence % 3 WHEN 0 THEN concat('To "', stop_id, '"', chr(10), chr(10), trip_id)
            WHEN 1 THEN concat('Line,', chr(10), stop_id) ELSE concat('"', stop_id, '" only') END AS stop_headsign""",
        )
        _write_csv(rows, path)

    return _once(spark, folder, "quoted/stop_times.txt", write)


def capture_files_folder(spark: SparkSession, folder: str) -> str:
    """Snapshot files of both feeds, a snapshot a day: ``<feed>/snapshot_folder=snapshot_x/*``."""

    def daily(records: DataFrame) -> DataFrame:
        midnight = F.concat(F.substring("snapshot_timestamp_utc", 1, 10), F.lit("T00:00:00Z"))
        folder = F.concat(F.substring("snapshot_folder", 1, 17), F.lit("_000000"))
        return records.withColumns({"snapshot_timestamp_utc": midnight, "snapshot_folder": folder})

    def write(root: str) -> None:
        vehicles = star_tables.raw_vehicle_positions(spark, folder, iso_text=True)
        updates = star_tables.raw_trip_updates_with_stops(spark, folder, iso_text=True)
        # Writing files waits more than it computes, so both feeds are written at once.
        together(
            spark,
            lambda: write_snapshot_arrays(daily(vehicles), f"{root}/{VEHICLE_FEED}"),
            lambda: write_snapshot_arrays(daily(updates), f"{root}/{TRIP_UPDATE_FEED}"),
        )

    return _once(spark, folder, "capture", write)
