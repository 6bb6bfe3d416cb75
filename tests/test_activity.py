import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetgauge.operators import activity
from fleetgauge.operators.windows import gap_statistics

VEHICLES = (
    "snapshot_folder string, snapshot_timestamp_utc timestamp, route_id string, vehicle_id string, "
    "trip_id string, vehicle_timestamp_utc timestamp"
)
UPDATES = "snapshot_folder string, snapshot_timestamp_utc timestamp, route_id string, trip_id string"
T0 = datetime(2024, 1, 1, 12, 0)


def at(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def seen(route, vehicle, seconds, folder="s", trip=None):
    return (folder, T0, route, vehicle, trip, at(seconds))


def test_dimensions(rows):
    routes = rows(
        "source_feed string, route_id string, agency_id string, route_short_name string, "
        "route_long_name string, route_type int",
        ("bronx", "B1", "A", "1", "One", 3),
        (None, "B1", "A", "1", "One", 3),
    )
    assert {r.route_key for r in activity.dim_route(routes).collect()} == {"bronx:B1", None}
    stops = rows(
        "source_feed string, stop_id string, stop_name string, stop_lat double, stop_lon double",
        ("bronx", "7", "Seventh", 40.5, -73.9),
    )
    assert activity.dim_stop(stops).first().stop_key == "bronx:7"


def test_route_activity(rows):
    vehicles = rows(VEHICLES, seen("a", "v1", 0, trip="t1"), seen("a", "v1", 0, trip="t2"),
                    seen("a", None, 0, trip=None), seen("b", "v2", 0), seen(None, "v3", 0))
    updates = rows(UPDATES, ("s", T0, "a", "t1"), ("s", T0, "c", "t1"), ("s", T0, "c", "t1"), ("s", T0, None, "t"))
    found = {r.route_id: r for r in activity.fct_route_realtime_activity(vehicles, updates).collect()}
    assert {k: r.route_activity_status for k, r in found.items()} == {
        "a": "active_with_both_feeds",
        "b": "active_vehicle_only",
        "c": "active_trip_updates_only",
    }
    a = found["a"]
    assert (a.vehicle_position_count, a.distinct_vehicle_count, a.distinct_trip_count) == (3, 1, 2)
    assert a.vehicle_to_trip_update_ratio == 3.0 and found["b"].vehicle_to_trip_update_ratio == 0.0
    assert found["c"].total_realtime_records == 2 and not found["c"].has_vehicle_positions


def test_headway_cases(rows):
    df = rows(
        VEHICLES,
        seen("one", "v1", 0), seen("one", "v1", 600),
        seen("untimed", "v1", None), seen("untimed", "v2", None),
        seen("pair", "v1", 0), seen("pair", "v2", 600), seen("pair", "v3", None),
        seen("even", "v1", 0), seen("even", "v2", 300), seen("even", "v3", 600),
        seen("tied", "v1", 0), seen("tied", "v2", 0), seen("tied", "v3", 1200),
        seen(None, "v1", 0),
    )
    found = {r.route_id: r for r in activity.fct_headway(df).collect()}
    assert set(found) == {"one", "untimed", "pair", "even", "tied"}
    for name in ("one", "untimed"):
        assert found[name].headway_reliability_status == "insufficient_data"
        assert found[name].avg_vehicle_spacing_minutes is None
    pair = found["pair"]
    assert (pair.vehicle_count, pair.distinct_vehicle_count, pair.observed_vehicle_sequence_count) == (3, 3, 2)
    assert (pair.avg_vehicle_spacing_minutes, pair.headway_variance_minutes) == (10.0, 0.0)
    assert pair.headway_reliability_status == "stable"
    assert found["even"].headway_variance_minutes == 0.0
    tied = found["tied"]
    assert (tied.min_vehicle_spacing_minutes, tied.max_vehicle_spacing_minutes) == (0.0, 20.0)
    assert tied.headway_variance_minutes == pytest.approx(statistics.stdev([0, 20]))


@pytest.mark.parametrize("odd", [0, 1_704_103_200_000, 9_000_000_000_000 // 1000, 253_402_300_799])
def test_headway_survives_timestamps_of_another_unit(rows, odd):
    usual = [seen("usual", f"v{i}", 1_704_103_200 + i * 600) for i in range(3)]
    times = [1_704_103_200, odd, 1_704_103_800]
    wide = rows(VEHICLES, *usual)
    alone = activity.fct_headway(wide).collect()
    extra = rows("at bigint", *[(at,) for at in times]).selectExpr("timestamp_seconds(at) AS at")
    first = rows(VEHICLES, seen("broken", "v0", 0))
    moved = first.crossJoin(extra).select(
        *[extra["at"].alias(c) if c == "vehicle_timestamp_utc" else
          (F.expr("'b' || uuid()").alias(c) if c == "vehicle_id" else first[c]) for c in first.columns]
    )
    found = {r.route_id: r for r in activity.fct_headway(wide.union(moved)).collect()}
    assert found["usual"] == alone[0]
    assert found["broken"].headway_reliability_status == "highly_variable"
    seconds = sorted(times)
    gaps = [(b - a) / 60 for a, b in zip(seconds, seconds[1:])]  # noqa: B905
    assert found["broken"].headway_variance_minutes == pytest.approx(statistics.stdev(gaps))


@pytest.mark.parametrize(
    ("gaps", "status"), [((0, 0, 0), "stable"), ((10, 20), "variable"), ((0, 30), "highly_variable")]
)
def test_headway_status(rows, gaps, status):
    times = [0]
    for gap in gaps:
        times.append(times[-1] + gap * 60)
    df = rows(VEHICLES, *[seen("r", f"v{i}", t) for i, t in enumerate(times)])
    assert activity.fct_headway(df).first().headway_reliability_status == status


# Times from fractions of a second to several days apart, on both sides of hour and epoch edges.
_moments = st.lists(
    st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(-200_000, 200_000), st.integers(3_590, 3_610))),
    max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_moments)
def test_gap_statistics_equal_brute_force(rows, moments):
    df = rows("k string, t timestamp", *[(k, None if s is None else datetime(1970, 1, 1) + timedelta(seconds=s))
                                         for k, s in moments] or [("z", None)])
    expected = {}
    groups = defaultdict(list)
    for key, second in moments:
        if second is not None:
            groups[key].append(second)
    for key, seconds in groups.items():
        seconds.sort()
        steps = [b - a for a, b in zip(seconds, seconds[1:])]
        expected[key] = (seconds[0], seconds[-1], len(steps), min(steps, default=None), max(steps, default=None),
                         sum(s * s for s in steps))
    found = {r.k: (r.first_second, r.last_second, r.gap_count, r.min_gap, r.max_gap, r.gap_square_sum)
             for r in gap_statistics(df, ["k"], "t").collect()}
    assert found == expected


def test_a_third_of_all_rows_on_one_route(spark):
    """A hot group is reduced to one set per hour before it is shuffled, and stays exact."""
    df = spark.sql(
        "SELECT IF(id % 3 = 0, 'hot', string(id % 1000)) AS k, timestamp_seconds(id % 100000) AS t "
        "FROM range(0, 300000)"
    )
    hot = gap_statistics(df, ["k"], "t").where("k = 'hot'").first()
    # Every third of 100,000 seconds modulo 100,000 covers all of them exactly once.
    assert (hot.first_second, hot.last_second, hot.gap_count) == (0, 99_999, 99_999)
    assert (hot.min_gap, hot.max_gap, hot.gap_square_sum) == (1, 1, 99_999)
