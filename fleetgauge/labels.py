"""Names, labels, texts and thresholds that results are compared by."""

from __future__ import annotations

# Schedule feeds, in load order, and the name used for the flat layout.
SCHEDULE_FEEDS = ("busco", "brooklyn", "bronx", "manhattan", "queens", "staten_island")
SINGLE_FEED = "single_feed"

# Schedule files.
REQUIRED_TABLES = ("routes", "trips", "stops", "stop_times")
OPTIONAL_TABLES = ("calendar", "calendar_dates")

# Realtime feeds and the files that hold them inside a snapshot folder.
VEHICLE_FEED = "vehicle_positions"
TRIP_UPDATE_FEED = "trip_updates"
SNAPSHOT_PREFIX = "snapshot_"

# Vehicle stop status numbers of the public realtime transit feed format.
VEHICLE_STOP_STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}

# Schedule match.
MATCHED = "matched_to_static_schedule"
UNMATCHED = "unmatched_realtime_trip"
MISSING_FROM_TRIPS = "missing_from_static_trips"

# Missing coordinates.
NO_COORDINATES = "missing_latitude_and_longitude"
NO_LATITUDE = "missing_latitude"
NO_LONGITUDE = "missing_longitude"

# Snapshot freshness.
FIRST_SNAPSHOT = "first_snapshot"
GAP_EXCEEDED = "gap_exceeds_threshold"
WITHIN_INTERVAL = "within_expected_interval"
LATE = "late"

# Snapshot status.
HEALTHY = "healthy"
WARNING = "warning"
CRITICAL = "critical"

# Route activity.
BOTH_FEEDS = "active_with_both_feeds"
VEHICLES_ONLY = "active_vehicle_only"
TRIP_UPDATES_ONLY = "active_trip_updates_only"
INACTIVE = "inactive_or_missing"

# Delay.
DELAY_AVAILABLE = "delay_available"
DELAY_UNAVAILABLE = "delay_unavailable"
SCHEDULE_UNREADABLE = "schedule_time_parse_issue"
PLAUSIBLE = "plausible"
EXTREME_EARLY = "extreme_early"
EXTREME_LATE = "extreme_late"
BAND_UNAVAILABLE = "unavailable"
# Delay bands from early to late.
DELAY_BANDS = (
    "early_more_than_5_min",
    "early_1_to_5_min",
    "on_time",
    "late_5_to_15_min",
    "late_15_to_30_min",
    "late_30_to_60_min",
    "late_over_60_min",
)

# Spacing of vehicles on a route.
STABLE = "stable"
VARIABLE = "variable"
HIGHLY_VARIABLE = "highly_variable"
TOO_FEW_VEHICLES = "insufficient_data"

# Default thresholds.
SERVICE_DAY_OFFSET_SECONDS = 14_400
SNAPSHOT_GAP_MINUTES = 10.0
STALE_MINUTES = 30
MAX_SPEED = 90.0
LATITUDE_RANGE = (40.3, 41.0)
LONGITUDE_RANGE = (-74.5, -73.4)
ON_TIME_RANGE = (-1.0, 5.0)
PLAUSIBLE_DELAY_RANGE = (-15.0, 60.0)
DELAY_BAND_EDGES = (-5.0, -1.0, 5.0, 15.0, 30.0, 60.0)
SEVERE_DELAY_MINUTES = 90.0
STABLE_SPACING_MINUTES = 5.0
VARIABLE_SPACING_MINUTES = 15.0
MIN_MATCH_RATE = 0.95
MIN_RECALL = 0.90
NORMAL_SAMPLE_ROWS = 250
INJECTED_ROWS = 25

# The finding rules, as rule id -> (grain, anomaly type, source model, reason).
FINDING_RULES = {
    "rule_stale_vehicle_timestamp": (
        "vehicle_entity",
        "stale_realtime_timestamp",
        "stg_vehicle_positions",
        "Vehicle position timestamp is more than 30 minutes older than the snapshot timestamp.",
    ),
    "rule_duplicate_trip_update_entity": (
        "trip_update_entity",
        "duplicate_trip_update_entity",
        "int_quality_duplicate_trip_update_entities",
        "Trip update entity appears more than once within the same captured snapshot.",
    ),
    "rule_unmatched_schedule_reference": (
        "trip_schedule_reference",
        "unmatched_schedule_reference",
        "int_quality_realtime_trip_referential_integrity",
        "Realtime trip_id does not match the aligned static GTFS trips table.",
    ),
    "rule_missing_gps_coordinate": (
        "vehicle_entity",
        "missing_or_invalid_gps_coordinate",
        "int_quality_null_gps",
        "Vehicle position is missing latitude or longitude.",
    ),
    "rule_implausible_gps_or_speed": (
        "vehicle_entity",
        "implausible_gps_or_speed",
        "stg_vehicle_positions",
        "Vehicle GPS coordinate falls outside a broad NYC operating envelope.",
    ),
    "rule_extreme_delay": (
        "trip_snapshot",
        "extreme_delay_outlier",
        "fct_on_time_performance",
        "Trip has an extreme schedule-derived delay outside the plausible delay range.",
    ),
    "rule_feed_quality_warning": (
        "snapshot",
        "feed_quality_warning",
        "fct_feed_quality",
        "Snapshot feed quality status is warning or critical based on completeness, duplicate, "
        "GPS, schedule match, or freshness checks.",
    ),
    "rule_feed_freshness": (
        "snapshot",
        "feed_freshness_issue",
        "fct_feed_quality",
        "Snapshot arrived later than the expected realtime capture interval.",
    ),
}
# Fixed value: the other reason of rule_implausible_gps_or_speed.
SPEED_REASON = "Vehicle speed exceeds the 90 mph plausibility threshold."

# The labelled cases, as label -> (id prefix, source model, record type, severity, reason).
EVALUATION_CASES = {
    "normal": (
        "normal_trip_performance_",
        "fct_on_time_performance",
        "trip_performance",
        "none",
        "Baseline normal trip performance record sampled from plausible schedule-derived delay rows.",
    ),
    "stale_vehicle_position_timestamp": (
        "synthetic_stale_vehicle_position_timestamp_",
        "stg_vehicle_positions",
        "vehicle_position",
        "high",
        "Vehicle position timestamp was shifted two hours earlier than the snapshot timestamp.",
    ),
    "gps_jump_or_implausible_speed": (
        "synthetic_gps_jump_or_implausible_speed_",
        "stg_vehicle_positions",
        "vehicle_position",
        "critical",
        "Vehicle position was shifted by roughly one degree and speed was set to an implausible "
        "250 mph-equivalent value.",
    ),
    "duplicate_trip_update_entity": (
        "synthetic_duplicate_trip_update_entity_",
        "stg_trip_updates",
        "trip_update",
        "medium",
        "Trip update entity is intentionally labeled as a duplicate candidate within its snapshot "
        "for detector evaluation.",
    ),
    "missing_or_unmatched_schedule_reference": (
        "synthetic_missing_or_unmatched_schedule_reference_",
        "int_trip_schedule_vs_actual",
        "trip_schedule_alignment",
        "high",
        "Realtime trip_id was modified so it no longer resolves to the static GTFS schedule reference.",
    ),
    "late_or_extreme_delay_outlier": (
        "synthetic_late_or_extreme_delay_outlier_",
        "fct_on_time_performance",
        "trip_performance",
        "critical",
        "Estimated delay was increased by 90 minutes to create an extreme late schedule-derived "
        "delay outlier.",
    ),
}
UNMATCHED_TRIP_SUFFIX = "_SYNTH_UNMATCHED"

# Detector outcomes, as outcome -> (predicted label, severity, rule id, reason).
DETECTIONS = {
    "stale": (
        "stale_vehicle_position_timestamp",
        "high",
        "rule_stale_vehicle_timestamp",
        "Vehicle timestamp is more than 30 minutes older than the snapshot timestamp.",
    ),
    "speed": (
        "gps_jump_or_implausible_speed",
        "critical",
        "rule_implausible_gps_or_speed",
        SPEED_REASON,
    ),
    "position": (
        "gps_jump_or_implausible_speed",
        "critical",
        "rule_implausible_gps_or_speed",
        "Vehicle GPS coordinate falls outside a broad NYC operating envelope.",
    ),
    "trip_update": (
        "duplicate_trip_update_entity",
        "medium",
        "rule_duplicate_trip_update_candidate",
        "Trip update row is treated as a duplicate entity candidate in the synthetic evaluation set.",
    ),
    "unmatched": (
        "missing_or_unmatched_schedule_reference",
        "high",
        "rule_unmatched_schedule_reference",
        "Realtime trip record does not match the aligned static schedule.",
    ),
    "delay": (
        "late_or_extreme_delay_outlier",
        "critical",
        "rule_extreme_delay",
        "Schedule-derived delay is outside the plausible delay range.",
    ),
    "nothing": ("normal", "none", "rule_no_anomaly_detected", "No rule threshold was crossed."),
}
