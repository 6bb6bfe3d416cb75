from datetime import datetime, timedelta

import pytest

from fleetgauge import labels as L
from fleetgauge.operators import delay

UPDATES = (
    "snapshot_folder string, snapshot_timestamp_utc timestamp, entity_id string, trip_id string, "
    "route_id string, vehicle_id string, stop_time_updates string, trip_update_timestamp_utc timestamp"
)
STOP_TIMES = "trip_id string, stop_id string, stop_sequence int, arrival_time string, departure_time string"
TRIPS = "trip_id string, route_id string, trip_headsign string, direction_id int, shape_id string"
AT = datetime(2024, 1, 2, 12, 0)


def update(trip, stops, folder="s1", entity="e", **more):
    return (folder, AT, entity, trip, more.get("route", "r"), more.get("vehicle", "v"), stops, AT)


def test_unnest(rows):
    df = rows(
        UPDATES,
        update("a", '[{"stop_id":"p","stop_sequence":"2","arrival_time":1788393000.0,"arrival_delay":null,"x":1},{}]'),
        update("b", "[]"),
        update("c", None),
        update("d", '[{"stop_sequence":2.5,"departure_time":"soon","departure_delay":-60}]'),
    )
    found = delay.realtime_stop_time_updates(df).orderBy("trip_id", "stop_id").collect()
    assert [r.trip_id for r in found] == ["a", "a", "d"]
    empty, full, odd = found
    assert (full.stop_id, full.stop_sequence, full.arrival_delay_seconds) == ("p", 2, None)
    assert full.arrival_time_utc == datetime(2026, 9, 2, 23, 50) and full.stop_update_has_arrival_time
    assert not empty.stop_update_has_arrival_time and empty.stop_sequence is None
    assert (odd.stop_sequence, odd.departure_time_utc, odd.departure_delay_seconds) == (2, None, -60)
    assert odd.stop_update_has_departure_delay and not odd.stop_update_has_departure_time


def test_unnest_of_native_array_agrees_with_text(spark, rows):
    text = rows(UPDATES, update("a", '[{"stop_id":"p","stop_sequence":2,"arrival_time":1788393000}]'))
    native = text.withColumn(
        "stop_time_updates",
        spark.sql(
            "SELECT array(named_struct('stop_id','p','stop_sequence',2,'arrival_time',1788393000L,"
            "'arrival_delay',int(NULL),'departure_time',bigint(NULL),'departure_delay',int(NULL))) AS a"
        ).scalar(),
    )
    assert delay.realtime_stop_time_updates(text).collect() == delay.realtime_stop_time_updates(native).collect()


def test_unreadable_stop_updates(rows):
    df = rows(UPDATES, update("a", "[]"), update("b", None), update("c", '{"x":1}'), update("d", "[{"))
    assert sorted(r.trip_id for r in delay.unreadable_stop_updates(df).collect()) == ["c", "d"]


def stop_delays(rows, stops, times, **options):
    updates = delay.realtime_stop_time_updates(rows(UPDATES, *stops))
    return delay.stop_time_schedule_vs_actual(updates, rows(STOP_TIMES, *times), **options)


def epoch(moment):
    return int((moment - datetime(1970, 1, 1)).total_seconds())


def test_match_needs_trip_sequence_and_stop(rows):
    stops = [update("a", f'[{{"stop_id":"{s}","stop_sequence":{n},"arrival_delay":60}}]') for s, n in
             (("p", 1), ("q", 1), ("p", 2))]
    stops.append(update(None, '[{"stop_id":"p","stop_sequence":1}]'))
    found = stop_delays(rows, stops, [("a", "p", 1, "08:00:00", "08:00:00"), (None, "p", 1, "x", "x")])
    matched = {(r.trip_id, r.stop_id, r.stop_sequence): r.matched_scheduled_stop for r in found.collect()}
    assert matched == {("a", "p", 1): True, ("a", "q", 1): False, ("a", "p", 2): False, (None, "p", 1): False}
    # An unmatched stop keeps its stated delay.
    assert {r.estimated_delay_minutes for r in found.where("trip_id = 'a'").collect()} == {1.0}


def test_departure_stands_in_and_past_midnight_trips(rows):
    actual = epoch(datetime(2024, 1, 3, 5, 12))  # 01:12 local
    stops = [update("a", f'[{{"stop_id":"p","stop_sequence":1,"departure_time":{actual}}}]')]
    times = [("a", "p", 1, "bad", "25:10:00")]
    calendar = stop_delays(rows, stops, times).first()
    assert calendar.estimated_arrival_delay_minutes is None and not calendar.schedule_time_parse_failed
    assert calendar.estimated_delay_minutes == pytest.approx(-1438)
    assert stop_delays(rows, stops, times, service_day="nearest").first().estimated_delay_minutes == 2.0


def test_unreadable_schedule_time(rows):
    stops = [update("a", f'[{{"stop_id":"p","stop_sequence":1,"arrival_time":{epoch(AT)}}}]')]
    found = stop_delays(rows, stops, [("a", "p", 1, "bad", "")]).first()
    assert found.schedule_time_parse_failed and found.estimated_delay_minutes is None


def test_normalized_schedule_keeps_only_trips_seen(rows):
    updates = delay.realtime_stop_time_updates(rows(UPDATES, update("a", "[{}]"), update(None, "[{},{}]")))
    times = rows(STOP_TIMES, ("a", "p", 1, "25:10:00", "x"), ("a", "q", 2, "", None), ("b", "p", 1, "1:0:0", "1:0:0"))
    found = delay.scheduled_stop_times_normalized(times, updates).orderBy("stop_sequence").collect()
    assert [(r.trip_id, r.stop_id, r.arrival_seconds_after_midnight, r.departure_seconds_after_midnight)
            for r in found] == [("a", "p", 90600, None), ("a", "q", None, None)]


def mart(rows, stops, times=(), trips=()):
    updates = rows(UPDATES, *stops)
    schedule = rows(STOP_TIMES, *times)
    delays = delay.stop_time_schedule_vs_actual(delay.realtime_stop_time_updates(updates), schedule)
    return delay.fct_on_time_performance(updates, rows(TRIPS, *trips), delays)


@pytest.mark.parametrize(
    ("minutes", "band", "sanity", "on_time"),
    [
        (-15.0001, "early_more_than_5_min", "extreme_early", False),
        (-15, "early_more_than_5_min", "plausible", False),
        (-5, "early_1_to_5_min", "plausible", False),
        (-1, "on_time", "plausible", True),
        (5, "on_time", "plausible", True),
        (5.0001, "late_5_to_15_min", "plausible", False),
        (15, "late_5_to_15_min", "plausible", False),
        (30, "late_15_to_30_min", "plausible", False),
        (60, "late_30_to_60_min", "plausible", False),
        (60.0001, "late_over_60_min", "extreme_late", False),
        (None, "unavailable", "delay_unavailable", None),
    ],
)
def test_bands(rows, minutes, band, sanity, on_time):
    from pyspark.sql import functions as F

    df = rows("m double", (None if minutes is None else float(minutes),))
    m = F.col("m")
    found = df.select(delay.delay_band(m), delay.delay_sanity(m), m.between(*L.ON_TIME_RANGE)).first()
    assert tuple(found) == (band, sanity, on_time)


def test_average_of_whole_seconds_is_exact_on_a_band_edge(rows):
    # 7 stops with 1..599 s that average exactly 5 minutes; a sum of fractions may miss it.
    seconds = [1, 599, 137, 463, 299, 301, 300]
    stops = ",".join(f'{{"stop_id":"p{i}","stop_sequence":{i},"arrival_delay":{s}}}' for i, s in enumerate(seconds))
    found = mart(rows, [update("a", f"[{stops}]")]).first()
    assert found.estimated_delay_minutes == 5.0 and found.on_time_flag and found.delay_band == "on_time"


def test_trip_without_id_and_duplicated_entities(rows):
    stop = '[{"stop_id":"p","stop_sequence":1,"arrival_delay":%d}]'
    found = mart(
        rows,
        [update(None, stop % 60), update(None, stop % 60), update("a", stop % 60, entity="x"),
         update("a", stop % 180, entity="y", vehicle="w"), update("b", "[]")],
        trips=[("a", "R", "North", 1, "S"), ("a", "R", "North", 1, "S")],
    )
    result = {r.trip_id: r for r in found.collect()}
    assert found.count() == 3
    assert result[None].stop_update_count == 0 and result[None].delay_data_status == "delay_unavailable"
    assert result["a"].stop_update_count == 2 and result["a"].estimated_delay_minutes == 2.0
    assert (result["a"].schedule_match_status, result["a"].trip_headsign) == (L.MATCHED, "North")
    assert result["b"].schedule_match_status == L.UNMATCHED and result["b"].on_time_flag is None


def test_status_of_unreadable_schedule_and_times(rows):
    late = epoch(AT + timedelta(minutes=1))
    stops = [
        update("a", f'[{{"stop_id":"p","stop_sequence":1,"arrival_time":{epoch(AT)},"departure_time":{late}}}]'),
        update("b", f'[{{"stop_id":"p","stop_sequence":1,"departure_time":{late}}}]'),
    ]
    found = {r.trip_id: r for r in mart(rows, stops, times=[("a", "p", 1, "bad", "bad")]).collect()}
    assert found["a"].delay_data_status == "schedule_time_parse_issue"
    assert found["a"].first_realtime_stop_time_utc == AT
    assert found["a"].last_realtime_stop_time_utc == AT + timedelta(minutes=1)
    assert found["b"].delay_data_status == "delay_unavailable" and found["b"].matched_stop_update_count == 0


def test_trip_schedule_match(rows):
    updates = rows(UPDATES, update("a", None), update("b", None), update(None, None))
    found = delay.trip_schedule_vs_actual(updates, rows(TRIPS, ("a", "R1", "N", 0, "S"), (None, "R2", "N", 0, "S")))
    status = {r.trip_id: (r.schedule_match_status, r.scheduled_route_id) for r in found.collect()}
    assert status == {"a": (L.MATCHED, "R1"), "b": (L.UNMATCHED, None), None: (L.UNMATCHED, None)}


def test_stop_updates_and_rejects_come_from_one_parse(spark, rows, tmp_path):
    from fleetgauge.plans.load import open_rejects, open_stop_updates, store_stop_updates

    texts = ['[{"stop_id": "s", "stop_sequence": "2"}, {"stop_id": "t"}]', None, "[]", '{"stop_id": "u"}', '[{"stop_id"', " [{}]", ""]
    schema = (
        "snapshot_folder string, snapshot_timestamp_utc timestamp, entity_id string, trip_id string, route_id string, "
        "vehicle_id string, stop_time_updates string"
    )
    updates = spark.createDataFrame(
        [("snapshot_20240105_000000", None, f"e{i}", f"t{i}", "r", "v", text) for i, text in enumerate(texts)], schema
    )
    tagged = delay.tagged_stop_updates(updates)
    assert tagged._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert store_stop_updates(updates, str(tmp_path)) == {False: 3, True: 3}
    accepted = open_stop_updates(spark, str(tmp_path))
    plain = delay.realtime_stop_time_updates(updates)
    assert accepted.columns == plain.columns
    assert sorted(map(str, accepted.collect())) == sorted(map(str, plain.collect()))
    rejects = {r.trip_id: r.rejected_text for r in open_rejects(spark, str(tmp_path)).collect()}
    assert rejects == {"t3": texts[3], "t4": texts[4], "t6": ""}
    unreadable = delay.unreadable_stop_updates(updates).collect()
    assert {r.trip_id for r in unreadable} == set(rejects)


def test_the_schedule_is_not_sorted_to_find_the_trips_of_realtime(rows):
    times = rows("source_feed string, trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int",
                 *[("f", trip, "08:00:00", "08:01:00", "p", 1) for trip in ("hot", "hot", "other", None)])
    updates = rows("trip_id string", ("hot",), ("hot",), (None,), ("unknown",))
    found = delay.scheduled_stop_times_normalized(times, updates)
    assert [(r.trip_id, r.arrival_seconds_after_midnight) for r in found.collect()] == [("hot", 28_800)] * 2
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=shuffle_hash" in plan and "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
