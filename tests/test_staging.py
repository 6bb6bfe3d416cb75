from datetime import datetime

import pytest

from fleetgauge.operators import staging
from fleetgauge.sources.snapshots import empty_source_schema
from fleetgauge.sources.star_tables import read_table


def test_schedule_types(rows):
    trips = rows(
        "route_id string, service_id string, trip_id string, trip_headsign string, direction_id string, "
        "shape_id string, source_feed string",
        ("r", "s", "t", "North", "1", "x", "bronx"), ("r", "s", "u", "", "north", "", "bronx"))
    found = staging.stg_trips(trips)
    assert [r.direction_id for r in found.collect()] == [1, None]
    assert "source_feed" not in found.columns and dict(found.dtypes)["direction_id"] == "int"
    stops = rows("source_feed string, stop_id string, stop_name string, stop_lat string, stop_lon string",
                 ("f", "007", "A", "40.5", ""), ("f", "8", "B", "north", "-73.9"))
    assert [(r.stop_id, r.stop_lat, r.stop_lon) for r in staging.stg_stops(stops).collect()] == [
        ("007", 40.5, None), ("8", None, -73.9)]


def vehicle(spark, **values):
    schema = empty_source_schema(spark, "vehicle_positions").schema
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)


def test_capture_time_is_utc_and_keeps_fractions(spark):
    row = staging.stg_vehicle_positions(
        vehicle(spark, snapshot_timestamp_utc="2024-03-10T07:30:00.123456Z", timestamp=1710055800)).first()
    assert row.snapshot_timestamp_utc == datetime(2024, 3, 10, 7, 30, 0, 123456)
    assert row.vehicle_timestamp_utc == datetime(2024, 3, 10, 7, 30)


def test_unreadable_capture_time_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_vehicle_positions(vehicle(spark, snapshot_timestamp_utc="yesterday")).collect()
    assert staging.stg_vehicle_positions(vehicle(spark)).first().snapshot_timestamp_utc is None


def test_test_tables_have_the_given_schemas(spark):
    """A column of another type would fail the scan; one of another name would read as NULL."""
    from fleetgauge.sources import star_tables

    folder = "/root/testdata/sf0.001"
    for name in star_tables._SCHEMAS:
        given = dict(spark.read.parquet(f"{folder}/{name}.parquet").dtypes)
        assert dict(read_table(spark, folder, name).dtypes).items() <= given.items()
