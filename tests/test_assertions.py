from datetime import datetime

import pytest

from fleetgauge import labels as L
from fleetgauge.operators import assertions as A
from fleetgauge.operators import capture, reports
from fleetgauge.plans.checks import CHECKS


def test_there_are_160_checks():
    kinds = [check.kind for checks in CHECKS.values() for check in checks]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (124, 7, 21)
    assert kinds.count("unique_key") + 4 == 8  # the match rate, scores, labels and recall besides


def test_row_and_key_checks(rows):
    df = rows("k string, v string", ("a", "x"), ("a", None), (None, "y"), (None, "x"))
    checks = A.not_null("k", "v") + A.accepted("v", "x") + A.unique("k") + A.unique_key("k") + A.unique_key("k", "v")
    counts = {r.check_name: r.violation_count for r in A.check_table(df, "m", checks).collect()}
    assert counts == {"not_null(k)": 2, "not_null(v)": 1, "accepted_values(v)": 1, "unique(k)": 1,
                      "unique_key(k)": 2, "unique_key(k, v)": 0}
    for check in checks:
        details = A.violations(df, check)
        assert details.isEmpty() == (counts[check.name] == 0)


@pytest.mark.parametrize(("matched", "total", "fails"), [(95, 100, False), (94, 100, True), (0, 0, True)])
def test_match_rate(spark, matched, total, fails):
    status = f"IF(id < {matched}, '{L.MATCHED}', '{L.UNMATCHED}') AS schedule_match_status"
    found = A.assert_match_rate(spark.range(total).selectExpr(status)).collect()
    assert bool(found) == fails
    if fails:
        assert found[0].match_rate == (matched / total if total else 0.0)


def test_score_label_and_recall(rows):
    scores = rows("anomaly_id string, anomaly_score double", ("a", 0.0), ("b", 1.0), ("c", 1.01), ("d", -0.1))
    assert sorted(r.anomaly_id for r in A.assert_score_range(scores).collect()) == ["c", "d"]
    seen = rows("synthetic_anomaly_type string", ("normal",), ("normal",))
    missing = {r.synthetic_anomaly_type for r in A.assert_label_coverage(seen).collect()}
    assert missing == set(L.EVALUATION_CASES) - {"normal"}
    metrics = "metric_scope string, anomaly_type string, recall double"
    for recall, fails in ((0.9, False), (0.89, True), (None, True)):
        df = rows(metrics, ("overall", "all_anomalies", recall), ("by_anomaly_type", "a", 0.1))
        assert (A.assert_recall(df).count() == 1) == fails


@pytest.mark.parametrize(("minutes", "state"), [(10, "pass"), (11, "warn"), (60, "warn"), (61, "error")])
def test_source_freshness(rows, minutes, state):
    df = rows("snapshot_timestamp_utc string", ("2024-01-01T10:00:00Z",), ("2024-01-01T09:00:00Z",))
    as_of = datetime(2024, 1, 1, 10 + minutes // 60, minutes % 60)
    assert A.source_freshness(df, as_of).first().freshness_state == state
    assert A.source_freshness(df.where("false"), as_of).first().freshness_state == "error"


@pytest.mark.parametrize(("interval", "duration", "expected"), [(4, 12, 3), (4, 13, 4), (30, 5, 1)])
def test_planned_snapshots(rows, interval, duration, expected):
    df = rows("snapshot_folder string, snapshot_timestamp_utc timestamp", ("s", datetime(2024, 1, 1)))
    found = capture.expected_snapshots(df, interval_minutes=interval, duration_minutes=duration).first()
    assert (found.expected_snapshots, found.observed_snapshots, found.shortfall) == (expected, 1, expected - 1)
    with pytest.raises(ValueError):
        capture.expected_snapshots(df, interval_minutes=0)


def test_missing_slots(rows):
    times = [datetime(2024, 1, 1, 23, 50), datetime(2024, 1, 2, 0, 6), datetime(2024, 1, 2, 0, 14)]
    df = rows("snapshot_timestamp_utc timestamp", *[(t,) for t in times])
    found = capture.missing_snapshot_slots(df, interval_minutes=5).collect()
    assert sorted(r[0] for r in found) == [datetime(2024, 1, 1, 23, 55), datetime(2024, 1, 2, 0, 0)]
    assert capture.missing_snapshot_slots(df.where("false"), interval_minutes=5).count() == 0


def test_rates_of_nothing_are_null(rows):
    df = rows("schedule_match_status string, on_time_flag boolean, delay_sanity_status string, "
              "estimated_delay_minutes double")
    assert reports.kpi_match_rate(df).first()[0] is None
    assert reports.on_time_rate(df).first()[0] is None
    assert reports.kpi_avg_plausible_delay(df).first()[0] is None


def test_top_lists_are_complete_and_stable(spark):
    df = spark.range(60).selectExpr(
        "string(id % 30) AS route_id", f"'{L.PLAUSIBLE}' AS delay_sanity_status", "5D AS estimated_delay_minutes")
    assert reports.top_delayed_routes(df).count() == 0
    top = reports.top_delayed_routes(df, min_trips=2).collect()
    assert [r.route_id for r in top] == sorted((str(i) for i in range(30)))[:25]


def test_measured_counts_are_rows_of_one_task(rows):
    df = rows("k string, v string", ("a", "x"))
    checks = A.not_null("k", "v") + A.accepted("v", "it's", "x")
    measured = {"not_null(k)": 3, "not_null(v)": 0, "accepted_values(v)": 1 << 40}
    found = A.check_table(df, "m", checks, measured)
    assert {r.check_name: r.violation_count for r in found.collect()} == measured
    assert found.rdd.getNumPartitions() == 1
