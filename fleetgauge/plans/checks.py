"""The declared checks of every model, and their run over all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.operators.assertions import (
    Check,
    accepted,
    assert_label_coverage,
    assert_match_rate,
    assert_recall,
    assert_score_range,
    check_table,
    not_null,
    unique,
    unique_key,
)
from fleetgauge.plans.models import Models

_MATCH = (L.MATCHED, L.UNMATCHED)
_SANITY = (L.DELAY_UNAVAILABLE, L.PLAUSIBLE, L.EXTREME_EARLY, L.EXTREME_LATE)
_CASES = tuple(L.EVALUATION_CASES)
_SEVERITIES = ("none", "medium", "high", "critical")
_CAPTURED = ("snapshot_folder", "snapshot_timestamp_utc")

# Which columns of which tables must be set, unique, or one of a list.
CHECKS: dict[str, list[Check]] = {
    "routes": not_null("source_feed", "route_id") + unique_key("source_feed", "route_id"),
    "trips": not_null("trip_id") + unique("trip_id"),
    "stops": not_null("source_feed", "stop_id") + unique_key("source_feed", "stop_id"),
    "stop_times": not_null("trip_id", "stop_id", "stop_sequence"),
    "vehicle_positions": not_null("snapshot_timestamp_utc", "entity_id"),
    "trip_updates": not_null("snapshot_timestamp_utc", "entity_id"),
    "stg_vehicle_positions": not_null("snapshot_timestamp_utc", "entity_id"),
    "stg_trip_updates": not_null("snapshot_timestamp_utc", "entity_id"),
    "stg_routes": not_null("source_feed", "route_id") + unique_key("source_feed", "route_id"),
    "stg_trips": not_null("trip_id") + unique("trip_id") + not_null("route_id"),
    "stg_stops": not_null("source_feed", "stop_id") + unique_key("source_feed", "stop_id"),
    "stg_stop_times": not_null("trip_id", "stop_id", "stop_sequence"),
    "trip_schedule_vs_actual": not_null(*_CAPTURED, "entity_id", "trip_id")
    + accepted("schedule_match_status", *_MATCH),
    "realtime_stop_time_updates": not_null(*_CAPTURED, "entity_id", "trip_id"),
    "scheduled_stop_times_normalized": not_null("trip_id", "stop_id", "stop_sequence"),
    "stop_time_schedule_vs_actual": not_null(
        *_CAPTURED, "entity_id", "trip_id", "matched_scheduled_stop", "schedule_time_parse_failed"
    ),
    "quality_null_gps": not_null("snapshot_timestamp_utc", "snapshot_folder", "entity_id", "quality_issue"),
    "quality_duplicate_vehicle_entities": not_null("snapshot_folder", "entity_id", "duplicate_record_count"),
    "quality_duplicate_trip_update_entities": not_null(
        "snapshot_folder", "entity_id", "duplicate_record_count"
    ),
    "quality_realtime_trip_referential_integrity": not_null(
        "realtime_source", "snapshot_folder", "trip_id", "quality_issue"
    ),
    "quality_snapshot_freshness": not_null(*_CAPTURED, "freshness_status"),
    "feed_quality_summary": not_null(*_CAPTURED, "feed_quality_status"),
    "fct_feed_quality": not_null(*_CAPTURED)
    + accepted("freshness_status", L.FIRST_SNAPSHOT, L.WITHIN_INTERVAL, L.LATE)
    + not_null("feed_quality_status")
    + accepted("feed_quality_status", L.HEALTHY, L.WARNING, L.CRITICAL),
    "dim_route": not_null("route_key") + unique("route_key") + not_null("source_feed", "route_id"),
    "dim_stop": not_null("stop_key")
    + unique("stop_key")
    + not_null("source_feed", "stop_id", "stop_lat", "stop_lon"),
    "fct_route_realtime_activity": not_null(*_CAPTURED, "route_id", "route_activity_status")
    + accepted("route_activity_status", L.BOTH_FEEDS, L.VEHICLES_ONLY, L.TRIP_UPDATES_ONLY, L.INACTIVE),
    "fct_on_time_performance": not_null(*_CAPTURED, "trip_id", "route_id", "schedule_match_status")
    + accepted("schedule_match_status", *_MATCH)
    + not_null("delay_data_status")
    + accepted("delay_data_status", L.DELAY_AVAILABLE, L.DELAY_UNAVAILABLE, L.SCHEDULE_UNREADABLE)
    + not_null("delay_sanity_status")
    + accepted("delay_sanity_status", *_SANITY)
    + not_null("delay_band")
    + accepted("delay_band", L.BAND_UNAVAILABLE, *L.DELAY_BANDS),
    "fct_headway": not_null(*_CAPTURED, "route_id", "headway_reliability_status")
    + accepted("headway_reliability_status", L.TOO_FEW_VEHICLES, L.STABLE, L.VARIABLE, L.HIGHLY_VARIABLE),
    "fct_anomaly_findings": not_null("anomaly_id")
    + unique("anomaly_id")
    + not_null("anomaly_grain")
    + accepted("anomaly_grain", *sorted({rule[0] for rule in L.FINDING_RULES.values()}))
    + not_null("snapshot_folder", "anomaly_type")
    + accepted("anomaly_type", *[rule[1] for rule in L.FINDING_RULES.values()])
    + not_null("anomaly_severity")
    + accepted("anomaly_severity", *_SEVERITIES[1:])
    + not_null("anomaly_score", "anomaly_reason", "detector_rule_id")
    + accepted("detector_rule_id", *L.FINDING_RULES)
    + not_null("source_model"),
    "synthetic_anomaly_evaluation": not_null("evaluation_record_id")
    + unique("evaluation_record_id")
    + not_null("source_model", "evaluation_record_type")
    + accepted("evaluation_record_type", *dict.fromkeys(c[2] for c in L.EVALUATION_CASES.values()))
    + not_null(*_CAPTURED, "route_id", "delay_sanity_status")
    + accepted("delay_sanity_status", *_SANITY)
    + not_null("delay_band", "is_synthetic_anomaly", "synthetic_anomaly_type")
    + accepted("synthetic_anomaly_type", *_CASES)
    + not_null("anomaly_severity")
    + accepted("anomaly_severity", *_SEVERITIES)
    + not_null("anomaly_reason"),
    "rule_based_anomaly_detection": not_null("evaluation_record_id")
    + unique("evaluation_record_id")
    + not_null("predicted_is_anomaly", "predicted_anomaly_type")
    + accepted("predicted_anomaly_type", *_CASES)
    + not_null("predicted_severity")
    + accepted("predicted_severity", *_SEVERITIES)
    + not_null("detector_rule_id")
    + accepted("detector_rule_id", *dict.fromkeys(d[2] for d in L.DETECTIONS.values()))
    + not_null("detection_reason", "is_synthetic_anomaly", "synthetic_anomaly_type"),
    "anomaly_detection_metrics": not_null("metric_scope")
    + accepted("metric_scope", "overall", "by_anomaly_type")
    + not_null("anomaly_type", "true_positive", "false_positive", "false_negative", "true_negative"),
}


def _single(model: str, name: str, violating: DataFrame) -> DataFrame:
    return violating.agg(F.count(F.lit(1)).alias("violation_count")).select(
        F.lit(model).alias("model"), F.lit(name).alias("check_name"), "violation_count"
    )


def check_suite(models: Models, only: tuple[str, ...] = tuple(CHECKS)) -> DataFrame:
    """(model, check_name, violation_count) over the declared checks and the four special ones.

    What ``materialize_layers(..., checks=CHECKS)`` counted while it wrote is not counted again.
    """
    results = [check_table(models[model], model, CHECKS[model], models.measured.get(model)) for model in only]
    special = {
        "trip_schedule_vs_actual": ("match_rate", assert_match_rate),
        "fct_anomaly_findings": ("score_range", assert_score_range),
        "synthetic_anomaly_evaluation": ("label_coverage", assert_label_coverage),
        "anomaly_detection_metrics": ("recall", assert_recall),
    }
    results += [
        _single(model, name, check(models[model]))
        for model, (name, check) in special.items()
        if model in only
    ]
    return reduce(DataFrame.unionByName, results)
