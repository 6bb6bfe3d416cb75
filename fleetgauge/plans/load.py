"""Load schedule and snapshot files into stored raw tables, and open those for the models."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetgauge.labels import OPTIONAL_TABLES, REQUIRED_TABLES, TRIP_UPDATE_FEED
from fleetgauge.operators.delay import tagged_stop_updates
from fleetgauge.operators.staging import stg_trip_updates
from fleetgauge.sources.schedule import load_schedule, path_exists
from fleetgauge.sources.snapshots import RAW_SCHEMAS, scan_snapshots, snapshot_range, with_snapshot_date
from fleetgauge.sources.tables import replace_sink, split_side, split_sink, stored_days


def _path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/raw_{table}"


def load_raw(
    spark: SparkSession,
    schedule_root: str,
    capture_root: str,
    folder: str,
    *,
    start: str | None = None,
    end: str | None = None,
    patterns: dict[str, str] | None = None,
    only_touched_days: bool = False,
    with_stop_updates: bool = False,
) -> dict[str, int]:
    """Replace the raw tables below ``folder``; returns the rows written per table.

    Snapshots from ``start`` to ``end`` are loaded. With ``only_touched_days`` the other days of
    the stored snapshots stay, so that a long capture is loaded piece by piece. With
    ``with_stop_updates`` the stored trip updates are unnested once: ``stop_updates`` counts the stop
    updates and ``stop_updates_rejected`` the trip updates whose text is no array; ``open_stop_updates`` and
    ``open_rejects`` read the two.
    """
    counts = {}
    for table, df in load_schedule(spark, schedule_root).items():
        counts[f"raw_{table}"] = replace_sink(df, _path(folder, table), as_path=True)
    for feed in RAW_SCHEMAS:
        pattern = (patterns or {}).get(feed)
        records = scan_snapshots(spark, capture_root, feed, start=start, end=end, pattern=pattern)
        counts[f"raw_{feed}"] = replace_sink(
            with_snapshot_date(records),
            _path(folder, feed),
            as_path=True,
            partition_by=("snapshot_date",),
            only_touched_partitions=only_touched_days,
        )
    if with_stop_updates:
        stored = stg_trip_updates(open_raw(spark, folder)[TRIP_UPDATE_FEED])
        written = store_stop_updates(stored, folder)
        counts |= {"stop_updates": written[False], "stop_updates_rejected": written[True]}
    return counts


def store_stop_updates(trip_updates: DataFrame, folder: str) -> dict[bool, int]:
    """Unnest staged trip updates below ``folder``; the rows written, rejected ones under True. One scan, one parse."""
    tagged = with_snapshot_date(tagged_stop_updates(trip_updates))
    return split_sink(tagged, _path(folder, "stop_updates"), "is_rejected", partition_by=("snapshot_date",))


def _stop_updates(spark: SparkSession, folder: str, rejected: bool) -> DataFrame:
    nothing = spark.createDataFrame([], RAW_SCHEMAS[TRIP_UPDATE_FEED])
    schema = with_snapshot_date(tagged_stop_updates(stg_trip_updates(nothing))).schema
    return split_side(spark, schema, _path(folder, "stop_updates"), "is_rejected", rejected)


def open_stop_updates(spark: SparkSession, folder: str) -> DataFrame:
    """The stop updates that ``store_stop_updates`` wrote."""
    return _stop_updates(spark, folder, False).drop("rejected_text", "snapshot_date")


def open_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The trip updates whose stop updates could not be read, with their text."""
    return _stop_updates(spark, folder, True).select(
        "snapshot_folder", "snapshot_timestamp_utc", "entity_id", "trip_id", "route_id", "vehicle_id", "rejected_text"
    )


def open_raw(
    spark: SparkSession, folder: str, *, start: str | None = None, end: str | None = None
) -> dict[str, DataFrame]:
    """The stored raw tables, snapshots cut to the range; feed them to ``Models``."""
    tables = {
        table: spark.read.parquet(_path(folder, table))
        for table in (*REQUIRED_TABLES, *OPTIONAL_TABLES)
        if path_exists(spark, _path(folder, table))
    }
    for feed, schema in RAW_SCHEMAS.items():
        stored = spark.read.schema(with_date(schema)).parquet(_path(folder, feed))
        tables[feed] = snapshot_range(stored, start, end).drop("snapshot_date")
    return tables


def open_days(spark: SparkSession, folder: str, days: Iterable[str]) -> dict[str, DataFrame]:
    """The stored raw tables, snapshots cut to the days and to the last stored day before each of them.

    What ``materialize_layers(..., days=days)`` builds from: the day before is read for its last snapshot.
    """
    days = set(days)
    stored = sorted(set().union(*(stored_days(spark, _path(folder, feed)) for feed in RAW_SCHEMAS)))
    read = days | {before for before, day in zip(stored, stored[1:], strict=False) if day in days}
    tables = open_raw(spark, folder)
    for feed, schema in RAW_SCHEMAS.items():
        raw = spark.read.schema(with_date(schema)).parquet(_path(folder, feed))
        tables[feed] = raw.where(F.col("snapshot_date").isin(*read)).drop("snapshot_date")
    return tables


def with_date(schema: StructType) -> StructType:
    """A raw schema with the partition column of its stored table."""
    return StructType(list(schema.fields)).add("snapshot_date", "string")
