"""A trip, or rows without a trip, that hold a third of the data are split over tasks."""

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import delay, quality

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_thresholds(spark):
    before = {key: spark.conf.get(key) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def updates(spark):
    """30,000 trip updates: a third of one trip, a third without a trip."""
    return spark.range(0, 30_000, 1, 6).selectExpr(
        "concat('s', id % 500) AS snapshot_folder",
        "timestamp_seconds(id % 500) AS snapshot_timestamp_utc",
        "uuid() AS entity_id",
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN concat('t', id % 997) END AS trip_id",
        "'r' AS route_id",
        "concat('v', id) AS vehicle_id",
        "timestamp_seconds(id) AS trip_update_timestamp_utc",
        "id",
    )


@pytest.fixture
def trips(spark):
    return spark.range(0, 1_000, 1, 2).selectExpr(
        "IF(id = 0, 'hot', concat('t', id)) AS trip_id", "'r' AS route_id", "'North' AS trip_headsign",
        "1 AS direction_id", "'x' AS shape_id")


def finished_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_trip_match_is_split(small_thresholds, updates, trips):
    rows, plan = finished_plan(delay.trip_schedule_vs_actual(updates, trips))
    assert "skew=true" in plan
    assert len(rows) == 30_000
    assert sum(r.trip_id == "hot" and r.trip_headsign == "North" for r in rows) == 10_000


def test_dangling_trips_are_split(small_thresholds, updates, trips):
    vehicles = updates.where("trip_id = 'hot'").limit(0)
    gone = trips.where("trip_id <> 'hot'")
    found = quality.quality_realtime_trip_referential_integrity(vehicles, updates, gone)
    rows, plan = finished_plan(found)
    assert "skew=true" in plan
    # The hot trip appears in the snapshots whose number is a multiple of three, modulo 500: in all.
    assert sum(r.trip_id == "hot" for r in rows) == 500


def test_stop_match_is_split(spark, small_thresholds, updates, trips):
    stops = updates.select(
        "*",
        F.lit("p").alias("stop_id"),
        F.lit(1).alias("stop_sequence"),
        F.timestamp_seconds("id").alias("arrival_time_utc"),
        F.lit(None).cast("int").alias("arrival_delay_seconds"),
        F.lit(None).cast("timestamp").alias("departure_time_utc"),
        F.lit(None).cast("int").alias("departure_delay_seconds"),
    )
    schedule = trips.selectExpr("trip_id", "'p' AS stop_id", "1 AS stop_sequence",
                                "'20:00:00' AS arrival_time", "'20:00:00' AS departure_time")
    delays = delay.stop_time_schedule_vs_actual(stops, schedule)
    mart = delay.fct_on_time_performance(updates, trips, delays)
    rows, plan = finished_plan(mart)
    assert "skew=true" in plan
    hot = [r for r in rows if r.trip_id == "hot"]
    assert len(hot) == 500 and {r.stop_update_count for r in hot} == {20}
