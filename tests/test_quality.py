from datetime import datetime, timedelta

from fleetgauge.operators import quality
from fleetgauge.operators.windows import previous_time

VEHICLES = (
    "snapshot_folder string, snapshot_timestamp_utc timestamp, entity_id string, vehicle_id string, "
    "trip_id string, route_id string, latitude double, longitude double"
)
UPDATES = "snapshot_folder string, snapshot_timestamp_utc timestamp, entity_id string, trip_id string"
T0 = datetime(2024, 1, 1, 12, 0)


def vehicle(folder, at, entity, trip=None, lat=40.5, lon=-74.0):
    return (folder, at, entity, "v", trip, "r", lat, lon)


def by_folder(df):
    return {r["snapshot_folder"]: r for r in df.collect()}


def test_null_gps_labels(rows):
    df = rows(
        VEHICLES,
        vehicle("s", T0, "a", lat=None, lon=None),
        vehicle("s", T0, "b", lat=None),
        vehicle("s", T0, "c", lon=None),
        vehicle("s", T0, "d"),
    )
    found = {r.entity_id: r.quality_issue for r in quality.quality_null_gps(df).collect()}
    assert found == {
        "a": "missing_latitude_and_longitude",
        "b": "missing_latitude",
        "c": "missing_longitude",
    }


def test_duplicates_include_the_null_entity(rows):
    df = rows(UPDATES, ("s", T0, "a", "t"), ("s", T0, "a", "t"), ("s", T0, None, "t"), ("s", T0, None, "u"),
              ("s", T0, "b", "t"), ("r", T0, "b", "t"))
    found = {(r.snapshot_folder, r.entity_id): r.duplicate_record_count
             for r in quality.quality_duplicate_entities(df).collect()}
    assert found == {("s", "a"): 2, ("s", None): 2}


def test_dangling_trips_count_once_per_feed(rows, spark):
    vehicles = rows(VEHICLES, vehicle("s", T0, "a", "known"), vehicle("s", T0, "b", "gone"),
                    vehicle("s", T0, "c", "gone"), vehicle("s", T0, "d"))
    updates = rows(UPDATES, ("s", T0, "x", "gone"), ("s", T0, "y", None))
    trips = rows("trip_id string", ("known",), (None,))
    found = quality.quality_realtime_trip_referential_integrity(vehicles, updates, trips).collect()
    assert sorted((r.realtime_source, r.trip_id) for r in found) == [
        ("trip_updates", "gone"),
        ("vehicle_positions", "gone"),
    ]


def test_gaps_at_the_threshold_and_across_days(rows):
    times = [
        ("a", T0),
        ("b", T0 + timedelta(minutes=10)),
        ("c", T0 + timedelta(minutes=20, seconds=1)),
        ("d", datetime(2024, 1, 2, 0, 0)),
        ("e", datetime(2024, 1, 5, 0, 0, 0, 500000)),
        ("f", datetime(2024, 1, 5, 0, 0, 1, 100000)),
        ("g", None),
        ("h", None),
    ]
    found = by_folder(quality.snapshot_gaps(rows("snapshot_folder string, snapshot_timestamp_utc timestamp", *times)))
    status = {folder: r.freshness_status for folder, r in found.items()}
    assert status["a"] == "first_snapshot"
    assert (found["b"].gap_minutes, status["b"]) == (10.0, "within_expected_interval")
    assert status["c"] == "gap_exceeds_threshold"
    assert found["d"].previous_snapshot_timestamp_utc == times[2][1]
    assert found["e"].previous_snapshot_timestamp_utc == times[3][1]
    assert found["f"].gap_minutes * 60 == 1
    # Without a time: after all others, and then after one without a time.
    assert found["g"].previous_snapshot_timestamp_utc == times[5][1] and found["g"].gap_minutes is None
    assert (status["g"], status["h"]) == ("within_expected_interval", "first_snapshot")


def test_previous_time_equals_one_global_window(spark):
    df = spark.sql(
        "SELECT string(id) AS name, timestamp_seconds(bigint(pmod(id * 7919, 997)) * 1800 - 300000) AS t "
        "FROM range(0, 2000)"
    )
    df.createOrReplaceTempView("events_for_lag")
    expected = spark.sql(
        "SELECT name, lag(t) OVER (ORDER BY t, name) AS p FROM events_for_lag"
    )
    actual = previous_time(df, "t", "p", tie_break="name").select("name", "p")
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()


def test_summary_statuses(rows):
    minute = timedelta(minutes=1)
    vehicles = rows(
        VEHICLES,
        vehicle("s1", T0, "a", "t"),
        vehicle("s2", T0 + 5 * minute, "a", "t", lat=None),
        vehicle("s3", T0 + 10 * minute, "a", "t"),
        vehicle("s4", T0 + 15 * minute, "a", "t"),
        vehicle("s4", T0 + 15 * minute, "a", "t"),
        vehicle("s5", T0 + 40 * minute, "a", "t"),
        vehicle("s6", T0 + 45 * minute, "a", "gone"),
    )
    updates = rows(UPDATES, *[(f"s{i}", T0 + m * minute, "u", "t") for i, m in
                              ((1, 0), (2, 5), (4, 15), (5, 40), (6, 45), (7, 50))])
    trips = rows("trip_id string", ("t",))
    found = by_folder(quality.fct_feed_quality(quality.feed_quality_summary(vehicles, updates, trips)))
    assert {f: r.feed_quality_status for f, r in found.items()} == {
        "s1": "healthy", "s2": "warning", "s3": "critical", "s4": "warning", "s5": "warning",
        "s6": "warning", "s7": "critical",
    }
    assert found["s5"].freshness_status == "late" and found["s5"].snapshot_gap_minutes == 25.0
    assert found["s4"].duplicate_vehicle_entity_count == 1 and found["s4"].vehicle_record_count == 2
    assert found["s2"].null_gps_rate == 1.0 and found["s6"].unmatched_realtime_trip_rate == 0.5
    assert found["s7"].null_gps_rate == 0.0 and found["s7"].feed_completeness_proxy == 0.0
    assert found["s3"].snapshot_timestamp_utc == T0 + 10 * minute


def test_feeds_that_disagree_on_the_time_give_a_row_each(rows):
    vehicles = rows(VEHICLES, vehicle("s", T0, "a", "t"))
    updates = rows(UPDATES, ("s", T0 + timedelta(minutes=1), "u", "t"))
    summary = quality.feed_quality_summary(vehicles, updates, rows("trip_id string", ("t",))).collect()
    assert len({r.snapshot_timestamp_utc for r in summary}) == 2
    assert {r.vehicle_record_count for r in summary} == {1}


def test_times_of_a_snapshot_are_gathered_after_its_keys_are_summed(rows):
    """A set within the pass over all keys would have every key sorted by its snapshot."""
    late = T0 + timedelta(minutes=1)
    vehicles = rows(VEHICLES, vehicle("s", T0, "a", "t"), vehicle("s", T0, "a", "x", lat=None), vehicle("s", late, "b"),
                    vehicle("r", None, "t", "t"), vehicle(None, T0, None, "x"))
    updates = rows(UPDATES, ("s", late, "u", "t"), ("s", late, "u", "x"), ("s", T0, "t", None))
    # The schedule repeats a trip and has one without an id; entities named like a trip are not looked up.
    keys = quality.snapshot_keys(vehicles, updates, rows("trip_id string", ("t",), ("t",), (None,)))
    summary = quality.summarize_keys(keys)
    found = {(r.snapshot_folder, r.previous) for r in summary.selectExpr("snapshot_folder", "snapshot_gap_minutes AS previous").collect()}
    assert found == {("s", None), (None, 0.0), ("s", 1.0), ("r", None)}
    one = by_folder(summary)["s"]
    assert (one.vehicle_record_count, one.trip_update_record_count, one.null_gps_count) == (3, 3, 1)
    assert (one.duplicate_vehicle_entity_count, one.duplicate_trip_update_entity_count, one.unmatched_realtime_trip_count) == (1, 1, 2)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    sets = [line for line in plan.splitlines() if "collect_set(" in line]
    assert sets and not any("kind" in line for line in sets)
