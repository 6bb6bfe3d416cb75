"""Staging, intermediate and mart tables, in DuckDB SQL."""

from fleetgauge import labels as L
from fleetgauge.plans.catalog import HOURLY_GAP_MINUTES as GAP
from fleetgauge.labels import SERVICE_DAY_OFFSET_SECONDS as OFFSET


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _minutes(side: str) -> str:
    """Delay of one side; the service day starts at a fixed offset after UTC midnight."""
    clock, scheduled = f"{side}_time_utc", f"{side}_seconds_after_midnight"
    return f"""coalesce(
        {side}_delay_seconds / 60,
        (epoch({clock} - INTERVAL {OFFSET} SECOND)
         - epoch(date_trunc('day', {clock} - INTERVAL {OFFSET} SECOND)) - {scheduled}) / 60)"""


def _seconds(column: str) -> str:
    part = f"string_split({column}, ':')"
    return f"""(SELECT if(m BETWEEN 0 AND 59 AND s BETWEEN 0 AND 59, (h * 3600 + m * 60 + s)::INTEGER, NULL)
        FROM (SELECT try_cast({part}[1] AS INT) AS h, try_cast({part}[2] AS INT) AS m,
                     try_cast({part}[3] AS INT) AS s))"""


def _number(field: str, kind: str) -> str:
    return f"TRY_CAST(stop.value -> '{field}' AS {kind})"


def _finding(rule: str, key: str, severity: str, score: str, source: str, where: str, reason="", **carried) -> str:
    grain, kind, model, fixed_reason = L.FINDING_RULES[rule]
    carried = {"snapshot_timestamp_utc": "NULL::TIMESTAMP"} | {
        name: "NULL::VARCHAR" for name in ("route_id", "trip_id", "entity_id", "vehicle_id")
    } | carried
    columns = ", ".join(f"{value} AS {name}" for name, value in carried.items())
    return f"""
        SELECT md5({text(rule + '|')} || {key}) AS anomaly_id, {text(grain)} AS anomaly_grain,
               snapshot_folder, {columns}, {text(kind)} AS anomaly_type, {severity} AS anomaly_severity,
               round(({score})::DOUBLE, 6) AS anomaly_score, {reason or text(fixed_reason)} AS anomaly_reason,
               {text(rule)} AS detector_rule_id, {text(model)} AS source_model
        FROM {source} WHERE {where}
    """


_ENTITY_KEY = "snapshot_folder || '|' || entity_id"
_ALL = {n: n for n in ("snapshot_timestamp_utc", "route_id", "trip_id", "entity_id", "vehicle_id")}
_OUT = f"""(coalesce(speed > {L.MAX_SPEED}, false)
    OR coalesce(latitude < {L.LATITUDE_RANGE[0]} OR latitude > {L.LATITUDE_RANGE[1]}, false)
    OR coalesce(longitude < {L.LONGITUDE_RANGE[0]} OR longitude > {L.LONGITUDE_RANGE[1]}, false))"""

RULES = {
    "rule_stale_vehicle_timestamp": _finding(
        "rule_stale_vehicle_timestamp", _ENTITY_KEY, "'high'", "0.85", "stg_vehicle_positions",
        f"snapshot_timestamp_utc - vehicle_timestamp_utc > INTERVAL {L.STALE_MINUTES} MINUTE", **_ALL),
    "rule_missing_gps_coordinate": _finding(
        "rule_missing_gps_coordinate", _ENTITY_KEY, "'medium'", "0.70", "quality_null_gps", "true", **_ALL),
    "rule_implausible_gps_or_speed": _finding(
        "rule_implausible_gps_or_speed", _ENTITY_KEY, "'critical'", "0.95", "stg_vehicle_positions", _OUT,
        reason=f"if(speed > {L.MAX_SPEED}, {text(L.SPEED_REASON)}, "
               f"{text(L.FINDING_RULES['rule_implausible_gps_or_speed'][3])})", **_ALL),
    "rule_duplicate_trip_update_entity": _finding(
        "rule_duplicate_trip_update_entity", _ENTITY_KEY, "'medium'",
        "if(duplicate_record_count >= 10, 1.0, 0.5 + duplicate_record_count * 0.05)",
        "quality_duplicate_trip_update_entities", "true",
        snapshot_timestamp_utc="first_snapshot_timestamp_utc", entity_id="entity_id"),
    "rule_unmatched_schedule_reference": _finding(
        "rule_unmatched_schedule_reference", "snapshot_folder || '|' || realtime_source || '|' || trip_id",
        "'high'", "0.90", "quality_realtime_trip_referential_integrity", "true", trip_id="trip_id"),
    "rule_extreme_delay": _finding(
        "rule_extreme_delay", "snapshot_folder || '|' || trip_id", "'critical'",
        f"if(delay_minutes_abs < {L.SEVERE_DELAY_MINUTES}, 0.9, 1)", "fct_on_time_performance",
        "starts_with(delay_sanity_status, 'extreme')",
        **{n: n for n in ("snapshot_timestamp_utc", "route_id", "trip_id", "vehicle_id")}),
    "rule_feed_quality_warning": _finding(
        "rule_feed_quality_warning", "snapshot_folder", "if(feed_quality_status = 'warning', 'medium', 'critical')",
        "if(feed_quality_status = 'warning', 0.65, 1)", "fct_feed_quality", "feed_quality_status <> 'healthy'",
        snapshot_timestamp_utc="snapshot_timestamp_utc"),
    "rule_feed_freshness": _finding(
        "rule_feed_freshness", "snapshot_folder", "'high'", "0.80", "fct_feed_quality",
        "freshness_status = 'late'", snapshot_timestamp_utc="snapshot_timestamp_utc"),
}

MODELS = {
    "stg_routes": """
        SELECT source_feed, route_id, agency_id, route_short_name, route_long_name,
               TRY_CAST(route_type AS INT) AS route_type FROM raw_routes
    """,
    "stg_trips": """
        SELECT route_id, service_id, trip_id, trip_headsign, TRY_CAST(direction_id AS INT) AS direction_id,
               shape_id FROM raw_trips
    """,
    "stg_stops": "FROM raw_stops",
    "stg_stop_times": """
        SELECT * REPLACE (TRY_CAST(stop_sequence AS INT) AS stop_sequence,
            TRY_CAST(pickup_type AS INT) AS pickup_type, TRY_CAST(drop_off_type AS INT) AS drop_off_type,
            TRY_CAST(timepoint AS INT) AS timepoint)
        FROM raw_stop_times
    """,
    "stg_vehicle_positions": """
        SELECT snapshot_timestamp_utc::TIMESTAMP AS snapshot_timestamp_utc, snapshot_folder, entity_id,
               vehicle_id, trip_id, route_id, latitude, longitude, bearing, speed,
               current_stop_sequence::INT AS current_stop_sequence, current_status,
               make_timestamp("timestamp" * 1000000) AS vehicle_timestamp_utc
        FROM raw_vehicle_positions
    """,
    "stg_trip_updates": """
        SELECT snapshot_timestamp_utc::TIMESTAMP AS snapshot_timestamp_utc, snapshot_folder, entity_id,
               trip_id, route_id, vehicle_id, stop_time_updates,
               make_timestamp("timestamp" * 1000000) AS trip_update_timestamp_utc
        FROM raw_trip_updates
    """,
    "realtime_stop_time_updates": f"""
        SELECT snapshot_folder, snapshot_timestamp_utc::TIMESTAMP AS snapshot_timestamp_utc, entity_id, trip_id,
               route_id, vehicle_id, stop.value ->> 'stop_id' AS stop_id,
               {_number('stop_sequence', 'INT')} AS stop_sequence,
               make_timestamp({_number('arrival_time', 'BIGINT')} * 1000000) AS arrival_time_utc,
               {_number('arrival_delay', 'INT')} AS arrival_delay_seconds,
               make_timestamp({_number('departure_time', 'BIGINT')} * 1000000) AS departure_time_utc,
               {_number('departure_delay', 'INT')} AS departure_delay_seconds,
               arrival_time_utc IS NOT NULL AS stop_update_has_arrival_time,
               departure_time_utc IS NOT NULL AS stop_update_has_departure_time,
               arrival_delay_seconds IS NOT NULL AS stop_update_has_arrival_delay,
               departure_delay_seconds IS NOT NULL AS stop_update_has_departure_delay
        FROM raw_trip_update_stops, json_each(stop_time_updates) AS stop
    """,
    "scheduled_stop_times_normalized": f"""
        SELECT trip_id, stop_id, stop_sequence, arrival_time, departure_time,
               {_seconds('arrival_time')} AS arrival_seconds_after_midnight,
               {_seconds('departure_time')} AS departure_seconds_after_midnight
        FROM stg_stop_times SEMI JOIN realtime_stop_time_updates USING (trip_id)
    """,
    "stop_time_schedule_vs_actual": f"""
        SELECT u.snapshot_folder, u.snapshot_timestamp_utc, u.entity_id, u.trip_id, u.route_id, u.vehicle_id,
               u.stop_id, u.stop_sequence, u.arrival_time_utc, u.departure_time_utc,
               p.arrival_seconds_after_midnight, p.departure_seconds_after_midnight,
               p.planned IS NOT NULL AS matched_scheduled_stop,
               p.planned IS NOT NULL AND arrival_seconds_after_midnight IS NULL
                   AND departure_seconds_after_midnight IS NULL AS schedule_time_parse_failed,
               {_minutes('arrival')} AS estimated_arrival_delay_minutes,
               {_minutes('departure')} AS estimated_departure_delay_minutes,
               ifnull(estimated_arrival_delay_minutes, estimated_departure_delay_minutes)
                   AS estimated_delay_minutes
        FROM realtime_stop_time_updates u
        LEFT JOIN (SELECT *, true AS planned FROM scheduled_stop_times_normalized) p
            USING (trip_id, stop_sequence, stop_id)
    """,
    "trip_schedule_vs_actual": f"""
        SELECT u.snapshot_folder, u.snapshot_timestamp_utc, u.entity_id, u.trip_id,
               u.route_id AS realtime_route_id, t.route_id AS scheduled_route_id, u.vehicle_id,
               u.trip_update_timestamp_utc,
               if(t.planned, {text(L.MATCHED)}, {text(L.UNMATCHED)}) AS schedule_match_status,
               t.trip_headsign, t.direction_id, t.shape_id
        FROM stg_trip_updates u LEFT JOIN (SELECT *, true AS planned FROM stg_trips) t USING (trip_id)
    """,
    "quality_null_gps": """
        SELECT snapshot_timestamp_utc, snapshot_folder, entity_id, vehicle_id, trip_id, route_id, latitude,
               longitude,
               'missing_' || concat_ws('_and_', if(latitude IS NULL, 'latitude', NULL),
                                       if(longitude IS NULL, 'longitude', NULL)) AS quality_issue
        FROM stg_vehicle_positions WHERE latitude + longitude IS NULL
    """,
    "quality_duplicate_vehicle_entities": """
        SELECT snapshot_folder, entity_id, count() AS duplicate_record_count,
               min(snapshot_timestamp_utc) AS first_snapshot_timestamp_utc,
               max(snapshot_timestamp_utc) AS last_snapshot_timestamp_utc
        FROM stg_vehicle_positions GROUP BY ALL HAVING duplicate_record_count >= 2
    """,
    "quality_duplicate_trip_update_entities": """
        SELECT snapshot_folder, entity_id, count() AS duplicate_record_count,
               min(snapshot_timestamp_utc) AS first_snapshot_timestamp_utc,
               max(snapshot_timestamp_utc) AS last_snapshot_timestamp_utc
        FROM stg_trip_updates GROUP BY ALL HAVING duplicate_record_count >= 2
    """,
    "both_feeds": """
        SELECT 'vehicle_positions' AS realtime_source, snapshot_folder, snapshot_timestamp_utc, route_id, trip_id
        FROM stg_vehicle_positions
        UNION ALL
        SELECT 'trip_updates', snapshot_folder, snapshot_timestamp_utc, route_id, trip_id
        FROM stg_trip_updates
    """,
    "quality_realtime_trip_referential_integrity": f"""
        SELECT DISTINCT realtime_source, snapshot_folder, trip_id, {text(L.MISSING_FROM_TRIPS)} AS quality_issue
        FROM both_feeds WHERE trip_id NOT IN (SELECT trip_id FROM stg_trips)
    """,
    "quality_snapshot_freshness": f"""
        SELECT *, round((epoch(snapshot_timestamp_utc) - epoch(previous_snapshot_timestamp_utc)) / 60, 6)
                   AS gap_minutes,
               CASE WHEN previous_snapshot_timestamp_utc IS NULL THEN {text(L.FIRST_SNAPSHOT)}
                    WHEN gap_minutes <= {GAP} THEN {text(L.WITHIN_INTERVAL)}
                    ELSE {text(L.GAP_EXCEEDED)} END AS freshness_status
        FROM (SELECT *, lag(snapshot_timestamp_utc) OVER (ORDER BY snapshot_timestamp_utc, snapshot_folder)
                  AS previous_snapshot_timestamp_utc
              FROM (SELECT DISTINCT snapshot_folder, snapshot_timestamp_utc FROM both_feeds))
    """,
    "feed_quality_summary": f"""
        SELECT snapshot_folder, min(both_feeds.snapshot_timestamp_utc) AS snapshot_timestamp_utc,
               count() FILTER (realtime_source = 'vehicle_positions') AS vehicle_record_count,
               count() FILTER (realtime_source = 'trip_updates') AS trip_update_record_count,
               any_value(coalesce(g.n, 0)) AS null_gps_count,
               any_value(coalesce(v.n, 0)) AS duplicate_vehicle_entity_count,
               any_value(coalesce(u.n, 0)) AS duplicate_trip_update_entity_count,
               any_value(coalesce(r.n, 0)) AS unmatched_realtime_trip_count,
               any_value(f.gap_minutes) AS snapshot_gap_minutes,
               any_value(if(f.freshness_status = {text(L.GAP_EXCEEDED)}, 'late', f.freshness_status))
                   AS freshness_status,
               CASE WHEN least(vehicle_record_count, trip_update_record_count) = 0 THEN 'critical'
                    WHEN null_gps_count + duplicate_vehicle_entity_count + duplicate_trip_update_entity_count
                         + unmatched_realtime_trip_count > 0 OR any_value(f.gap_minutes) > {GAP} THEN 'warning'
                    ELSE 'healthy' END AS feed_quality_status
        FROM both_feeds
        JOIN quality_snapshot_freshness f USING (snapshot_folder)
        LEFT JOIN (SELECT snapshot_folder, count() AS n FROM quality_null_gps GROUP BY 1) g
            USING (snapshot_folder)
        LEFT JOIN (SELECT snapshot_folder, count() AS n FROM quality_duplicate_vehicle_entities GROUP BY 1) v
            USING (snapshot_folder)
        LEFT JOIN (SELECT snapshot_folder, count() AS n FROM quality_duplicate_trip_update_entities GROUP BY 1) u
            USING (snapshot_folder)
        LEFT JOIN (SELECT snapshot_folder, count() AS n FROM quality_realtime_trip_referential_integrity
                   GROUP BY 1) r USING (snapshot_folder)
        GROUP BY snapshot_folder
    """,
    "dim_route": "SELECT format('{}:{}', source_feed, route_id) AS route_key, * FROM stg_routes",
    "dim_stop": "SELECT format('{}:{}', source_feed, stop_id) AS stop_key, * FROM stg_stops",
    "fct_feed_quality": """
        SELECT snapshot_folder, snapshot_timestamp_utc, vehicle_record_count, trip_update_record_count,
               vehicle_record_count + trip_update_record_count AS total_realtime_records,
               null_gps_count, duplicate_vehicle_entity_count, duplicate_trip_update_entity_count,
               unmatched_realtime_trip_count, snapshot_gap_minutes, freshness_status, feed_quality_status,
               coalesce(null_gps_count / nullif(vehicle_record_count, 0), 0) AS null_gps_rate,
               coalesce(duplicate_trip_update_entity_count / nullif(trip_update_record_count, 0), 0)
                   AS duplicate_trip_update_rate,
               coalesce(unmatched_realtime_trip_count / nullif(total_realtime_records, 0), 0)
                   AS unmatched_realtime_trip_rate,
               if(feed_quality_status = 'critical', 0::DOUBLE, 1::DOUBLE) AS feed_completeness_proxy
        FROM feed_quality_summary
    """,
    "fct_route_realtime_activity": f"""
        SELECT snapshot_folder, min(snapshot_timestamp_utc) AS snapshot_timestamp_utc, route_id,
               count() FILTER (v) AS vehicle_position_count, count() FILTER (NOT v) AS trip_update_count,
               count(DISTINCT vehicle_id) FILTER (v) AS distinct_vehicle_count,
               greatest(count(DISTINCT trip_id) FILTER (v), count(DISTINCT trip_id) FILTER (NOT v))
                   AS distinct_trip_count,
               bool_or(v) AS has_vehicle_positions, bool_or(NOT v) AS has_trip_updates,
               count() AS total_realtime_records,
               if(has_trip_updates, vehicle_position_count / nullif(trip_update_count, 0), 0::DOUBLE)
                   AS vehicle_to_trip_update_ratio,
               CASE WHEN bool_and(v) THEN {text(L.VEHICLES_ONLY)}
                    WHEN NOT bool_or(v) THEN {text(L.TRIP_UPDATES_ONLY)}
                    ELSE {text(L.BOTH_FEEDS)} END AS route_activity_status
        FROM (SELECT true AS v, snapshot_folder, snapshot_timestamp_utc, route_id, vehicle_id, trip_id
              FROM stg_vehicle_positions
              UNION ALL
              SELECT false, snapshot_folder, snapshot_timestamp_utc, route_id, vehicle_id, trip_id
              FROM stg_trip_updates)
        WHERE route_id IS NOT NULL GROUP BY snapshot_folder, route_id
    """,
    "fct_on_time_performance": f"""
        WITH trip AS (
            SELECT snapshot_folder, min(snapshot_timestamp_utc) AS snapshot_timestamp_utc, trip_id,
                   min(realtime_route_id) AS route_id, min(vehicle_id) AS vehicle_id,
                   min(trip_headsign) AS trip_headsign, min(direction_id) AS direction_id,
                   min(schedule_match_status) AS schedule_match_status
            FROM trip_schedule_vs_actual GROUP BY snapshot_folder, trip_id
        ), stop AS (
            SELECT snapshot_folder, trip_id, count() AS n,
                   count() FILTER (matched_scheduled_stop) AS matched,
                   count() FILTER (schedule_time_parse_failed) AS unreadable,
                   min(ifnull(arrival_time_utc, departure_time_utc)) AS first_time,
                   max(ifnull(departure_time_utc, arrival_time_utc)) AS last_time,
                   -- Whole seconds add up exactly; a sum of fractions of minutes depends on its order,
                   -- and an average of exactly 5 minutes would fall on either side of the edge.
                   sum(round(estimated_delay_minutes * 60)::BIGINT)::DOUBLE
                       / (60 * count(estimated_delay_minutes)) AS mean,
                   max(estimated_delay_minutes) AS most,
                   min(estimated_delay_minutes) AS least_delay
            FROM stop_time_schedule_vs_actual GROUP BY ALL
        )
        SELECT trip.*, ifnull(n, 0) AS stop_update_count, ifnull(matched, 0) AS matched_stop_update_count,
               first_time AS first_realtime_stop_time_utc, last_time AS last_realtime_stop_time_utc,
               round(mean, 6) AS avg_estimated_delay_minutes, most AS max_estimated_delay_minutes,
               least_delay AS min_estimated_delay_minutes, round(mean, 6) AS estimated_delay_minutes,
               round(abs(mean), 6) AS delay_minutes_abs,
               mean >= {L.ON_TIME_RANGE[0]} AND mean <= {L.ON_TIME_RANGE[1]} AS on_time_flag,
               CASE WHEN mean IS NOT NULL THEN {text(L.DELAY_AVAILABLE)}
                    WHEN matched > 0 AND unreadable > 0 THEN {text(L.SCHEDULE_UNREADABLE)}
                    ELSE {text(L.DELAY_UNAVAILABLE)} END AS delay_data_status,
               CASE WHEN mean > {L.PLAUSIBLE_DELAY_RANGE[1]} THEN {text(L.EXTREME_LATE)}
                    WHEN mean >= {L.PLAUSIBLE_DELAY_RANGE[0]} THEN {text(L.PLAUSIBLE)}
                    WHEN mean IS NOT NULL THEN {text(L.EXTREME_EARLY)}
                    ELSE {text(L.DELAY_UNAVAILABLE)} END AS delay_sanity_status,
               CASE WHEN mean > 60 THEN {text(L.DELAY_BANDS[6])} WHEN mean > 30 THEN {text(L.DELAY_BANDS[5])}
                    WHEN mean > 15 THEN {text(L.DELAY_BANDS[4])} WHEN mean > 5 THEN {text(L.DELAY_BANDS[3])}
                    WHEN mean >= -1 THEN {text(L.DELAY_BANDS[2])} WHEN mean >= -5 THEN {text(L.DELAY_BANDS[1])}
                    WHEN mean < -5 THEN {text(L.DELAY_BANDS[0])}
                    ELSE {text(L.BAND_UNAVAILABLE)} END AS delay_band
        FROM trip LEFT JOIN stop USING (snapshot_folder, trip_id)
    """,
    "fct_headway": f"""
        WITH spaced AS (
            SELECT *, (epoch(vehicle_timestamp_utc) - epoch(lag(vehicle_timestamp_utc) OVER (
                       PARTITION BY snapshot_folder, route_id, vehicle_timestamp_utc IS NULL
                       ORDER BY vehicle_timestamp_utc))) / 60 AS spacing
            FROM stg_vehicle_positions WHERE route_id IS NOT NULL
        ), summed AS (
            SELECT snapshot_folder, min(snapshot_timestamp_utc) AS snapshot_timestamp_utc, route_id,
                   count() AS vehicle_count, count(DISTINCT vehicle_id) AS distinct_vehicle_count,
                   count(vehicle_timestamp_utc) AS observed_vehicle_sequence_count,
                   avg(spacing) AS mean, min(spacing) AS lowest, max(spacing) AS highest,
                   if(count(spacing) = 1, 0, stddev_samp(spacing)) AS deviation
            FROM spaced GROUP BY snapshot_folder, route_id
        )
        SELECT snapshot_folder, snapshot_timestamp_utc, route_id, vehicle_count, distinct_vehicle_count,
               observed_vehicle_sequence_count,
               if(distinct_vehicle_count > 1, round(mean, 6), NULL) AS avg_vehicle_spacing_minutes,
               if(distinct_vehicle_count > 1, lowest, NULL) AS min_vehicle_spacing_minutes,
               if(distinct_vehicle_count > 1, highest, NULL) AS max_vehicle_spacing_minutes,
               if(distinct_vehicle_count > 1, round(deviation, 6), NULL) AS headway_variance_minutes,
               CASE WHEN headway_variance_minutes > {L.VARIABLE_SPACING_MINUTES} THEN {text(L.HIGHLY_VARIABLE)}
                    WHEN headway_variance_minutes > {L.STABLE_SPACING_MINUTES} THEN {text(L.VARIABLE)}
                    WHEN headway_variance_minutes >= 0 THEN {text(L.STABLE)}
                    ELSE {text(L.TOO_FEW_VEHICLES)} END AS headway_reliability_status
        FROM summed
    """,
    **RULES,
    "fct_anomaly_findings": "\nUNION ALL BY NAME\n".join(f"FROM {rule}" for rule in RULES),
}


def _case(label: str, source: str, order: str, rows: int, **fields: str) -> str:
    prefix, model, record, severity, reason = L.EVALUATION_CASES[label]
    missing = "NULL::DOUBLE"
    values = {
        "entity_id": "NULL::VARCHAR", "trip_id": "trip_id", "route_id": "route_id", "vehicle_id": "vehicle_id",
        "latitude": missing, "longitude": missing, "speed": missing,
        "vehicle_timestamp_utc": "NULL::TIMESTAMP", "trip_update_timestamp_utc": "NULL::TIMESTAMP",
        "schedule_match_status": "NULL::VARCHAR", "estimated_delay_minutes": missing,
        "delay_sanity_status": text(L.DELAY_UNAVAILABLE), "delay_band": text(L.BAND_UNAVAILABLE),
        "on_time_flag": "NULL::BOOLEAN",
    } | fields
    columns = ", ".join(f"{value} AS {name}" for name, value in values.items())
    return f"""
        SELECT {text(prefix)} || nr AS evaluation_record_id, {text(model)} AS source_model,
               {text(record)} AS evaluation_record_type, snapshot_folder, snapshot_timestamp_utc, {columns},
               {label != 'normal'} AS is_synthetic_anomaly, {text(label)} AS synthetic_anomaly_type,
               {text(severity)} AS anomaly_severity, {text(reason)} AS anomaly_reason
        FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS nr FROM {source}) WHERE nr <= {rows}
    """


_PLAUSIBLE = f"(FROM fct_on_time_performance WHERE delay_sanity_status = {text(L.PLAUSIBLE)})"
_BY_TRIP = "snapshot_folder, route_id, trip_id"
_BY_VEHICLE = """snapshot_folder, route_id, vehicle_id, entity_id, snapshot_timestamp_utc, trip_id, latitude,
    longitude, speed, vehicle_timestamp_utc"""
_BY_UPDATE = f"{_BY_TRIP}, entity_id, snapshot_timestamp_utc, vehicle_id, trip_update_timestamp_utc"
_TRIP_COLUMNS = {n: n for n in ("schedule_match_status", "estimated_delay_minutes", "delay_sanity_status",
                                "delay_band", "on_time_flag")}
_VEHICLE_COLUMNS = {n: n for n in ("entity_id", "latitude", "longitude", "speed", "vehicle_timestamp_utc")}
_UPDATE_COLUMNS = {n: n for n in ("entity_id", "trip_update_timestamp_utc")}
_LABELS = list(L.EVALUATION_CASES)

CASES = {
    "sample_normal": _case("normal", _PLAUSIBLE, _BY_TRIP, L.NORMAL_SAMPLE_ROWS, **_TRIP_COLUMNS),
    "inject_stale_timestamp": _case(
        _LABELS[1], "(FROM stg_vehicle_positions WHERE vehicle_timestamp_utc IS NOT NULL)", _BY_VEHICLE,
        L.INJECTED_ROWS,
        **_VEHICLE_COLUMNS | {"vehicle_timestamp_utc": "vehicle_timestamp_utc - INTERVAL 120 MINUTE"}),
    "inject_gps_jump": _case(
        _LABELS[2], "(FROM stg_vehicle_positions WHERE latitude + longitude IS NOT NULL)", _BY_VEHICLE,
        L.INJECTED_ROWS,
        **_VEHICLE_COLUMNS | {"latitude": "latitude + 1", "longitude": "longitude - 1", "speed": "250::DOUBLE"}),
    "inject_duplicate_label": _case(
        _LABELS[3], "stg_trip_updates", _BY_UPDATE, L.INJECTED_ROWS,
        **_UPDATE_COLUMNS | {"schedule_match_status": text(L.MATCHED)}),
    "inject_unmatched_reference": _case(
        _LABELS[4], "(SELECT *, realtime_route_id AS route_id FROM trip_schedule_vs_actual)", _BY_UPDATE,
        L.INJECTED_ROWS,
        **_UPDATE_COLUMNS | {"schedule_match_status": text(L.UNMATCHED),
                             "trip_id": f"trip_id || {text(L.UNMATCHED_TRIP_SUFFIX)}"}),
    "inject_extreme_delay": _case(
        _LABELS[5], _PLAUSIBLE, _BY_TRIP, L.INJECTED_ROWS,
        schedule_match_status="schedule_match_status",
        estimated_delay_minutes="round(estimated_delay_minutes + 90, 6)",
        delay_sanity_status=text(L.EXTREME_LATE), delay_band=text(L.DELAY_BANDS[-1]), on_time_flag="false"),
}

_STEPS = {
    "stale": f"vehicle_timestamp_utc < snapshot_timestamp_utc - INTERVAL {L.STALE_MINUTES} MINUTE",
    "speed": f"evaluation_record_type = 'vehicle_position' AND speed > {L.MAX_SPEED}",
    "position": f"evaluation_record_type = 'vehicle_position' AND {_OUT}",
    "trip_update": "evaluation_record_type = 'trip_update'",
    "unmatched": f"schedule_match_status = {text(L.UNMATCHED)}",
    "delay": f"""delay_sanity_status LIKE 'extreme%' OR estimated_delay_minutes > {L.PLAUSIBLE_DELAY_RANGE[1]}
                 OR estimated_delay_minutes < {L.PLAUSIBLE_DELAY_RANGE[0]}""",
}
_OUTCOME_ROWS = ", ".join(
    f"({text(name)}, {name != 'nothing'}, {', '.join(map(text, values))})" for name, values in L.DETECTIONS.items()
)

MODELS |= CASES
MODELS["synthetic_anomaly_evaluation"] = "\nUNION ALL BY NAME\n".join(f"FROM {case}" for case in CASES)
MODELS["rule_based_anomaly_detection"] = f"""
    SELECT e.* EXCLUDE (outcome), o.* EXCLUDE (outcome)
    FROM (SELECT *, CASE {' '.join(f'WHEN {c} THEN {text(n)}' for n, c in _STEPS.items())}
                    ELSE 'nothing' END AS outcome
          FROM synthetic_anomaly_evaluation) e
    JOIN (VALUES {_OUTCOME_ROWS}) o(outcome, predicted_is_anomaly, predicted_anomaly_type, predicted_severity,
                                    detector_rule_id, detection_reason) USING (outcome)
"""
MODELS["anomaly_detection_metrics"] = """
    SELECT * EXCLUDE (place, tp_fn, tp_fp), tp_fn AS actual_positive_count, tp_fp AS predicted_positive_count,
           true_positive / nullif(tp_fp, 0) AS "precision", true_positive / nullif(tp_fn, 0) AS recall,
           coalesce(2 * true_positive / nullif(tp_fp + tp_fn, 0), 0) AS f1_score
    FROM (
        SELECT 0 AS place, 'overall' AS metric_scope, 'all_anomalies' AS anomaly_type,
               count() FILTER (is_synthetic_anomaly AND predicted_is_anomaly) AS true_positive,
               count() FILTER (NOT is_synthetic_anomaly AND predicted_is_anomaly) AS false_positive,
               count() FILTER (is_synthetic_anomaly AND NOT predicted_is_anomaly) AS false_negative,
               count() FILTER (NOT is_synthetic_anomaly AND NOT predicted_is_anomaly) AS true_negative,
               count() AS total_records
        FROM rule_based_anomaly_detection
        UNION ALL
        SELECT 1, 'by_anomaly_type', t.label,
               count() FILTER (synthetic_anomaly_type = t.label AND predicted_anomaly_type = t.label),
               count() FILTER (synthetic_anomaly_type <> t.label AND predicted_anomaly_type = t.label),
               count() FILTER (synthetic_anomaly_type = t.label AND predicted_anomaly_type <> t.label),
               count() FILTER (synthetic_anomaly_type <> t.label AND predicted_anomaly_type <> t.label),
               count()
        FROM rule_based_anomaly_detection,
             (SELECT DISTINCT synthetic_anomaly_type AS label FROM synthetic_anomaly_evaluation
              WHERE is_synthetic_anomaly) t
        GROUP BY t.label
    ), LATERAL (SELECT true_positive + false_negative AS tp_fn, true_positive + false_positive AS tp_fp)
"""
