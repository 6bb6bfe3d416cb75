import hashlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.operators import anomaly, evaluation, quality
from fleetgauge.schemas import EVALUATION, FINDING_COLUMNS

VEHICLES = (
    "snapshot_folder string, snapshot_timestamp_utc timestamp, entity_id string, vehicle_id string, "
    "trip_id string, route_id string, latitude double, longitude double, speed double, "
    "vehicle_timestamp_utc timestamp"
)
T0 = datetime(2024, 1, 1, 12, 0)


def vehicle(entity, lat=40.5, lon=-74.0, speed=10.0, age=0):
    reported = None if age is None else T0 - timedelta(seconds=age)
    return ("s", T0, entity, "v", "t", "r", lat, lon, speed, reported)


def vehicle_findings(rows, *values):
    rules = [anomaly.rule_stale_vehicle_timestamp(), anomaly.rule_missing_gps_coordinate(),
             anomaly.rule_implausible_gps_or_speed()]
    found = anomaly.evaluate_rules(rows(VEHICLES, *values), rules)
    assert tuple(found.columns) == FINDING_COLUMNS
    return found.collect()


@pytest.mark.parametrize(
    ("values", "rules"),
    [
        ({}, set()),
        ({"age": 1800}, set()),
        ({"age": 1801}, {"rule_stale_vehicle_timestamp"}),
        ({"age": None}, set()),
        ({"speed": 90.0}, set()),
        ({"speed": 90.1}, {"rule_implausible_gps_or_speed"}),
        ({"speed": None, "lat": 41.0, "lon": -74.5}, set()),
        ({"lat": 41.01}, {"rule_implausible_gps_or_speed"}),
        ({"lon": -73.39}, {"rule_implausible_gps_or_speed"}),
        ({"lat": None, "lon": -70.0}, {"rule_missing_gps_coordinate", "rule_implausible_gps_or_speed"}),
        ({"lat": None}, {"rule_missing_gps_coordinate"}),
        ({"lat": None, "speed": 91.0, "age": 9999},
         {"rule_stale_vehicle_timestamp", "rule_missing_gps_coordinate", "rule_implausible_gps_or_speed"}),
    ],
)
def test_vehicle_rules(rows, values, rules):
    assert {f.detector_rule_id for f in vehicle_findings(rows, vehicle("e", **values))} == rules


def test_finding_content(rows):
    (finding,) = vehicle_findings(rows, vehicle("e", speed=91.0, lat=0.0))
    assert finding.anomaly_id == hashlib.md5(b"rule_implausible_gps_or_speed|s|e").hexdigest()
    assert finding.anomaly_reason == L.SPEED_REASON
    assert (finding.anomaly_severity, finding.anomaly_score, finding.anomaly_grain) == (
        "critical", 0.95, "vehicle_entity")
    (off,) = vehicle_findings(rows, vehicle(None, lat=0.0))
    assert off.anomaly_id is None and "envelope" in off.anomaly_reason


@pytest.mark.parametrize(("copies", "score"), [(2, 0.60), (3, 0.65), (10, 1.0), (25, 1.0)])
def test_duplicate_score(rows, copies, score):
    updates = rows("snapshot_folder string, snapshot_timestamp_utc timestamp, entity_id string",
                   *[("s", T0, "e")] * copies)
    found = anomaly.evaluate_rules(
        quality.quality_duplicate_entities(updates), [anomaly.rule_duplicate_trip_update_entity()]).first()
    assert found.anomaly_score == pytest.approx(score) and found.snapshot_timestamp_utc == T0


@pytest.mark.parametrize(("minutes", "status", "score"), [
    (61.0, L.EXTREME_LATE, 0.9), (90.0, L.EXTREME_LATE, 1.0), (20.0, L.EXTREME_EARLY, 0.9), (20.0, L.PLAUSIBLE, None)])
def test_extreme_delay(rows, minutes, status, score):
    df = rows(
        "snapshot_folder string, snapshot_timestamp_utc timestamp, route_id string, trip_id string, "
        "vehicle_id string, delay_minutes_abs double, delay_sanity_status string",
        ("s", T0, "r", "t", "v", minutes, status))
    found = anomaly.evaluate_rules(df, [anomaly.rule_extreme_delay()]).collect()
    assert [f.anomaly_score for f in found] == ([] if score is None else [score])


def test_snapshot_rules(rows):
    df = rows("snapshot_folder string, snapshot_timestamp_utc timestamp, feed_quality_status string, "
              "freshness_status string",
              ("a", T0, "critical", "late"), ("b", T0, "warning", "first_snapshot"), ("c", T0, "healthy", None))
    found = anomaly.evaluate_rules(df, [anomaly.rule_feed_quality_warning(), anomaly.rule_feed_freshness()])
    got = sorted((f.snapshot_folder, f.detector_rule_id, f.anomaly_severity, f.anomaly_score) for f in found.collect())
    assert got == [("a", "rule_feed_freshness", "high", 0.8), ("a", "rule_feed_quality_warning", "critical", 1.0),
                   ("b", "rule_feed_quality_warning", "medium", 0.65)]


def record(spark, **values):
    fields = {"evaluation_record_id": "1", "snapshot_timestamp_utc": T0, "is_synthetic_anomaly": True,
              "synthetic_anomaly_type": "x", **values}
    return spark.createDataFrame([tuple(fields.get(f.name) for f in EVALUATION.fields)], EVALUATION)


@pytest.mark.parametrize(
    ("values", "label"),
    [
        ({"evaluation_record_type": "trip_performance"}, "normal"),
        ({"evaluation_record_type": "trip_performance", "estimated_delay_minutes": 60.0}, "normal"),
        ({"evaluation_record_type": "trip_performance", "estimated_delay_minutes": 60.1},
         "late_or_extreme_delay_outlier"),
        ({"evaluation_record_type": "trip_performance", "estimated_delay_minutes": -15.1},
         "late_or_extreme_delay_outlier"),
        ({"evaluation_record_type": "vehicle_position", "speed": 250.0}, "gps_jump_or_implausible_speed"),
        ({"evaluation_record_type": "vehicle_position", "speed": 250.0,
          "vehicle_timestamp_utc": T0 - timedelta(hours=2)}, "stale_vehicle_position_timestamp"),
        ({"evaluation_record_type": "trip_performance", "speed": 250.0}, "normal"),
        ({"evaluation_record_type": "trip_update", "schedule_match_status": L.UNMATCHED},
         "duplicate_trip_update_entity"),
        ({"evaluation_record_type": "trip_schedule_alignment", "schedule_match_status": L.UNMATCHED},
         "missing_or_unmatched_schedule_reference"),
    ],
)
def test_detector_takes_the_first_match(spark, values, label):
    found = evaluation.rule_based_anomaly_detection(record(spark, **values)).first()
    assert found.predicted_anomaly_type == label
    assert found.predicted_is_anomaly == (label != "normal")


def predictions(spark, *pairs):
    return spark.createDataFrame(
        [(a != "normal", p != "normal", a, p) for a, p in pairs],
        "is_synthetic_anomaly boolean, predicted_is_anomaly boolean, synthetic_anomaly_type string, "
        "predicted_anomaly_type string")


def test_metrics(spark):
    found = evaluation.anomaly_detection_metrics(predictions(
        spark, *[("normal", "normal")] * 5, ("normal", "a"), *[("a", "a")] * 3, ("a", "b"), ("b", "normal")))
    rows = {r.anomaly_type: r for r in found.collect()}
    assert set(rows) == {"all_anomalies", "a", "b"}

    def counts(name):
        r = rows[name]
        return r.true_positive, r.false_positive, r.false_negative, r.true_negative

    assert counts("all_anomalies") == (4, 1, 1, 5)
    assert counts("a") == (3, 1, 1, 6)
    assert counts("b") == (0, 1, 1, 9)
    assert {r.total_records for r in rows.values()} == {11}
    assert rows["a"].precision == rows["a"].recall == rows["a"].f1_score == 0.75
    assert (rows["b"].precision, rows["b"].recall, rows["b"].f1_score) == (0.0, 0.0, 0.0)


def test_metrics_without_predicted_anomalies_or_records(spark):
    only = evaluation.anomaly_detection_metrics(predictions(spark, ("normal", "normal"))).first()
    assert (only.precision, only.recall, only.f1_score, only.true_negative) == (None, None, 0.0, 1)
    (empty,) = evaluation.anomaly_detection_metrics(predictions(spark, ("a", "a")).where("false")).collect()
    assert (empty.metric_scope, empty.recall, empty.total_records) == ("overall", None, 0)


def test_unmatched_sample_with_a_trip_scheduled_twice(rows):
    updates = rows(
        "snapshot_folder string, snapshot_timestamp_utc timestamp, entity_id string, trip_id string, "
        "route_id string, vehicle_id string, trip_update_timestamp_utc timestamp",
        *[("s", T0, "e", f"t{i}", "r", "v", T0) for i in range(5)], ("s", T0, "e", None, "r", "v", T0))
    trips = rows("trip_id string", ("t0",), ("t0",), ("t1",))
    found = evaluation.inject_unmatched_reference(updates, trips, rows=3).orderBy("evaluation_record_id").collect()
    assert [r.trip_id for r in found] == [f"t{i}_SYNTH_UNMATCHED" for i in (0, 0, 1)]


def test_samples_number_from_one_and_sort_nulls_last(rows):
    df = rows(VEHICLES, vehicle("b"), vehicle("a"), vehicle(None), vehicle("c", lat=None))
    found = evaluation.inject_gps_jump(df, rows=2).orderBy("evaluation_record_id").collect()
    assert [(r.evaluation_record_id[-2:], r.entity_id) for r in found] == [("_1", "a"), ("_2", "b")]
    assert (found[0].latitude, found[0].longitude, found[0].speed) == (41.5, -75.0, 250.0)
    stale = evaluation.inject_stale_timestamp(df).agg(F.max("vehicle_timestamp_utc"), F.count("*")).first()
    assert tuple(stale) == (T0 - timedelta(hours=2), 4)


def test_repeated_ids_are_told_apart(spark):
    from fleetgauge.operators.anomaly import with_unique_ids
    from fleetgauge.operators.assertions import assert_unique

    rows = [("hot", f"r{i % 40}") for i in range(3_000)] + [("two", "a"), ("two", "b"), ("one", "c"), (None, "d"), (None, "d")]
    table = spark.createDataFrame(rows, "anomaly_id string, route_id string").repartition(5)
    found = with_unique_ids(table)
    assert assert_unique(found, "anomaly_id").isEmpty() and not assert_unique(table, "anomaly_id").isEmpty()
    ids = [r.anomaly_id for r in found.collect()]
    assert len(ids) == len(rows) and ids.count(None) == 2
    assert {i for i in ids if i} == {"hot", "two", "two#2", "one", *(f"hot#{n}" for n in range(2, 3_001))}
    again = with_unique_ids(table.repartition(3))
    assert sorted(map(str, again.collect())) == sorted(map(str, found.collect()))


def test_no_task_holds_a_repeated_id(spark):
    from fleetgauge.operators.windows import occurrence_number

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(20_000).selectExpr("'hot' AS k", "id AS v")
        found = occurrence_number(rows, "k", "n")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 12_000 and found.agg(F.count_distinct("n"), F.max("n")).first() == (20_000, 20_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
