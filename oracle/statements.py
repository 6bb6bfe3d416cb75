"""One SQL statement per query; every statement carries the table expressions it needs."""

from __future__ import annotations

import re

from fleetgauge import labels as L
from fleetgauge.plans.checks import CHECKS
from fleetgauge.plans.models import TABLES
from oracle.feeds import DAILY, FEEDS
from oracle.models import MODELS, text

_TABLES = {**FEEDS, **MODELS}
_NAME = re.compile(r"\b(" + "|".join(sorted(_TABLES, key=len, reverse=True)) + r")\b")
_QUOTED = re.compile(r"'(?:[^']|'')*'")


def _needed(sql: str, tables: dict[str, str], found: dict[str, None]) -> None:
    for name in _NAME.findall(_QUOTED.sub("''", sql)):
        if name not in found:
            _needed(tables[name], tables, found)
            found[name] = None


def with_tables(sql: str, replaced: dict[str, str] | None = None) -> str:
    tables = {**_TABLES, **(replaced or {})}
    needed: dict[str, None] = {}
    _needed(sql, tables, needed)
    parts = ",\n".join(f"{name} AS ({tables[name]})" for name in needed)
    return f"WITH {parts}\n{sql}" if parts else sql


def _residue(key: str) -> str:
    return f"substr({key}, 2)::BIGINT % 3 = residue"


_SCHEDULE_FILES = f"""
    SELECT feed AS source_feed, 'routes' AS table_name FROM raw_routes JOIN feed_names ON {_residue('route_id')}
    UNION ALL SELECT feed, 'trips' FROM raw_trips JOIN feed_names ON {_residue('trip_id')}
    UNION ALL SELECT feed, 'stops' FROM raw_stops JOIN feed_names ON {_residue('stop_id')}
    UNION ALL SELECT feed, 'stop_times' FROM raw_stop_times JOIN feed_names ON {_residue('trip_id')}
    UNION ALL SELECT DISTINCT 'busco', 'calendar' FROM raw_trips
"""
_CALENDAR_ROWS = """
    SELECT 'busco', 'calendar', count(DISTINCT service_id) FROM raw_trips
    UNION ALL SELECT 'brooklyn', 'calendar_dates', count(DISTINCT (service_id, direction_id)) FROM raw_trips"""

_DELAYED = "SELECT snapshot_folder, trip_id, stop_sequence, stop_id"

# The candidate days of a derived delay, the closest first; a stated delay has one candidate.
def _closest(minutes: str) -> str:
    candidates = f"[{minutes}, {minutes} - 1440, {minutes} + 1440]"
    return f"""if(derived AND {minutes} IS NOT NULL,
        list_extract(list_sort(list_transform({candidates}, lambda d: {{'off': abs(d), 'd': d}})), 1).d, {minutes})"""


_NEAREST = f"""
    SELECT snapshot_folder, trip_id, stop_sequence, stop_id,
           ifnull({_closest('estimated_arrival_delay_minutes')},
                  {_closest('estimated_departure_delay_minutes')}) AS estimated_delay_minutes
    FROM (SELECT *, coalesce(arrival_time_utc, departure_time_utc) IS NOT NULL AS derived
          FROM stop_time_schedule_vs_actual)
"""


def _check_sql() -> str:
    rows = []
    for model, checks in CHECKS.items():
        table = f"raw_{model}" if f"raw_{model}" in FEEDS else model
        for check in checks:
            columns = ", ".join(check.columns)
            if check.kind == "not_null":
                violating = f"FROM {table} WHERE {columns} IS NULL"
            elif check.kind == "accepted_values":
                listed = ", ".join(map(text, check.values))
                violating = f"FROM {table} WHERE {columns} NOT IN ({listed})"
            else:
                skip = f"WHERE {columns} IS NOT NULL" if check.kind == "unique" else ""
                violating = f"FROM (SELECT {columns} FROM {table} {skip} GROUP BY ALL HAVING count() > 1)"
            rows.append(f"SELECT {text(model)} AS model, {text(check.name)} AS check_name, "
                        f"(SELECT count() {violating}) AS violation_count")
    matched = f"(SELECT count() FROM trip_schedule_vs_actual WHERE schedule_match_status = {text(L.MATCHED)})"
    special = [
        ("trip_schedule_vs_actual", "match_rate",
         f"({matched} < {L.MIN_MATCH_RATE} * (SELECT count() FROM trip_schedule_vs_actual))::BIGINT"),
        ("fct_anomaly_findings", "score_range",
         "(SELECT count() FROM fct_anomaly_findings WHERE anomaly_score NOT BETWEEN 0 AND 1)"),
        ("synthetic_anomaly_evaluation", "label_coverage",
         f"{len(L.EVALUATION_CASES)} - (SELECT count(DISTINCT synthetic_anomaly_type) "
         "FROM synthetic_anomaly_evaluation)"),
        ("anomaly_detection_metrics", "recall",
         f"(SELECT count() FROM anomaly_detection_metrics WHERE metric_scope = 'overall' "
         f"AND NOT coalesce(recall >= {L.MIN_RECALL}, false))"),
    ]
    rows += [f"SELECT {text(m)}, {text(n)}, {count}" for m, n, count in special]
    return " UNION ALL ".join(rows)


def _counted(source: str, key: str, alias: str) -> str:
    return f"SELECT {key}, count() AS {alias} FROM {source} GROUP BY ALL"


def _statements() -> dict[str, str]:
    plain = {name: f"FROM {name}" for name in MODELS if name != "both_feeds"}
    found = {
        "scan_static_csv": "SELECT * EXCLUDE (source_feed) FROM raw_stop_times",
        "scan_quoted_csv": """
            SELECT * EXCLUDE (source_feed), CASE stop_sequence::INTEGER % 3
                WHEN 0 THEN 'To "' || stop_id || '"' || chr(10) || chr(10) || trip_id
                WHEN 1 THEN 'Line,' || chr(10) || stop_id ELSE '"' || stop_id || '" only' END AS stop_headsign
            FROM raw_stop_times""",
        "tag_source_feed": f"SELECT raw_trips.*, feed AS source_feed FROM raw_trips JOIN feed_names "
                           f"ON {_residue('trip_id')}",
        "union_feeds_by_name": f"""
            SELECT stop_id, if(feed = 'bronx', NULL, stop_name) AS stop_name, stop_lat::VARCHAR AS stop_lat,
                   stop_lon::VARCHAR AS stop_lon, feed AS source_feed
            FROM raw_stops JOIN feed_names ON {_residue('stop_id')}""",
        "resolve_feed_layout": f"""
            SELECT feed AS source_feed, count() AS trip_count FROM raw_trips
            JOIN feed_names ON {_residue('trip_id')} GROUP BY feed""",
        "check_required_tables": f"""
            SELECT feed AS source_feed, wanted AS table_name
            FROM feed_names, (SELECT unnest(['routes', 'trips', 'stops', 'stop_times', 'calendar']) AS wanted)
            WHERE (feed, wanted) NOT IN (SELECT (source_feed, table_name) FROM ({_SCHEDULE_FILES}))""",
        "optional_tables": f"""
            SELECT source_feed, table_name, count() AS row_count FROM ({_SCHEDULE_FILES})
            WHERE table_name <> 'calendar' GROUP BY ALL UNION ALL {_CALENDAR_ROWS}""",
        "snapshot_range": """
            FROM raw_vehicle_positions
            WHERE snapshot_timestamp_utc BETWEEN '2024-01-08T00:00:00Z' AND '2024-01-21T23:00:00Z'""",
        "nested_to_json": """
            SELECT trip_id, snapshot_folder, stop_time_updates FROM raw_trip_update_stops""",
        "empty_source_schema": "FROM raw_vehicle_positions",
        "replace_sink": "SELECT snapshot_folder, entity_id FROM stg_trip_updates",
        "materialize_layers": " UNION ALL ".join(
            f"SELECT '{model}' AS model, count() AS row_count FROM {model}"
            for model in TABLES
        ),
        "load_raw": " UNION ALL ".join(
            f"SELECT 'raw_{table}' AS table_name, count() AS row_count FROM raw_{table}"
            for table in (*L.REQUIRED_TABLES, L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)
        ) + """
            UNION ALL SELECT 'raw_calendar', count(DISTINCT service_id) FROM raw_trips
            UNION ALL SELECT 'raw_calendar_dates', count(DISTINCT (service_id, direction_id)) FROM raw_trips""",
        "flatten_vehicle_entity": """
            SELECT 'vehicle_positions' AS feed_type, taken_text AS snapshot_timestamp_utc,
                   if(event_id % 17 = 5, NULL, 'V' || user_id) AS entity_id, 'BUS_' || user_id AS vehicle_id,
                   if(event_id % 10 = 1, NULL, 'T' || event_id) AS trip_id,
                   if(event_id % 50 = 2, NULL, event_type) AS route_id,
                   if(located, 40.3::DOUBLE + value / 1000, NULL) AS latitude,
                   if(located, -73.9::DOUBLE - value / 500, NULL) AS longitude,
                   if(located, (event_id % 360)::DOUBLE, NULL) AS bearing,
                   if(located, value / 2, NULL) AS speed, event_id % 30 AS current_stop_sequence,
                   (['INCOMING_AT', 'STOPPED_AT', 'IN_TRANSIT_TO'])[event_id % 4 + 1] AS current_status,
                   if(event_id % 25 = 7, NULL, s) AS "timestamp"
            FROM (SELECT *, event_id % 40 <> 4 AS located FROM reports WHERE event_id % 3 <> 0)""",
        "flatten_trip_update_entity": """
            SELECT 'trip_updates' AS feed_type, taken_text AS snapshot_timestamp_utc,
                   'E' || (user_id % 40) AS entity_id, 'T' || event_id AS trip_id, event_type AS route_id,
                   if(event_id % 9 = 0, NULL, 'BUS_' || user_id) AS vehicle_id,
                   if(event_id % 21 = 0, '[]', '[' || json_object('stop_id', 'P' || (event_id % 100),
                       'stop_sequence', 1, 'arrival_time', s + 60, 'arrival_delay', event_id % 90,
                       'departure_time', s + 90, 'departure_delay', event_id % 60)::VARCHAR || ','
                    || json_object('stop_id', if(event_id % 5 = 0, NULL, 'P' || (event_id % 77)),
                       'stop_sequence', 2, 'arrival_time', if(event_id % 6 = 0, NULL, s + 300),
                       'arrival_delay', NULL, 'departure_time', NULL, 'departure_delay', NULL)::VARCHAR
                    || ']') AS stop_time_updates, s AS "timestamp"
            FROM reports WHERE event_id % 3 = 0""",
        "capture_audit": """
            SELECT snapshot_folder, min(snapshot_timestamp_utc) AS snapshot_timestamp_utc,
                   count() FILTER (realtime_source = 'vehicle_positions') AS vehicle_record_count,
                   count() FILTER (realtime_source <> 'vehicle_positions') AS trip_update_record_count
            FROM both_feeds GROUP BY snapshot_folder""",
        "capture_status_summary": """
            SELECT count() AS attempted, count() FILTER (n = 2) AS succeeded, count() FILTER (n < 2) AS failed
            FROM (SELECT count(DISTINCT realtime_source) AS n FROM both_feeds GROUP BY snapshot_folder)""",
        "expected_snapshots": """
            SELECT date_diff('hour', min(snapshot_timestamp_utc), max(snapshot_timestamp_utc)) + 1
                       AS expected_snapshots,
                   count(DISTINCT snapshot_folder) AS observed_snapshots,
                   expected_snapshots - observed_snapshots AS shortfall FROM both_feeds""",
        "missing_snapshot_slots": """
            SELECT slot AS missing_snapshot_timestamp_utc
            FROM (SELECT unnest(generate_series(min(snapshot_timestamp_utc), max(snapshot_timestamp_utc),
                                                INTERVAL 1 HOUR)) AS slot FROM both_feeds)
            WHERE slot NOT IN (SELECT snapshot_timestamp_utc FROM both_feeds)""",
        "windowed_record_counts": """
            SELECT make_timestamp(first_second * 1000000) AS window_start,
                   window_start + INTERVAL 6 HOUR AS window_end, feed_type, count() AS record_count
            FROM (SELECT realtime_source AS feed_type,
                         epoch_us(snapshot_timestamp_utc) // 1000000 // 21600 * 21600 AS first_second
                  FROM both_feeds)
            GROUP BY first_second, feed_type""",
        "realtime_stop_time_updates_native": "FROM realtime_stop_time_updates",
        "arrival_delay_minutes": f"{_DELAYED}, estimated_arrival_delay_minutes FROM stop_time_schedule_vs_actual",
        "departure_delay_minutes":
            f"{_DELAYED}, estimated_departure_delay_minutes FROM stop_time_schedule_vs_actual",
        "estimated_delay_minutes": f"{_DELAYED}, estimated_delay_minutes FROM stop_time_schedule_vs_actual",
        "schedule_time_parse_failed":
            f"{_DELAYED} FROM stop_time_schedule_vs_actual WHERE schedule_time_parse_failed",
        "nearest_service_day_delay": _NEAREST,
        "unreadable_stop_updates": """
            SELECT folder AS snapshot_folder, 'T' || event_id AS trip_id,
                   CASE event_id % 10 WHEN 2 THEN '{"stop_id": "P1"}' ELSE '[{"stop_id": "P1"' END
                       AS stop_time_updates
            FROM reports WHERE event_id % 3 = 0 AND event_id % 10 IN (2, 4)""",
        "stop_updates_with_rejects": """
            SELECT folder AS snapshot_folder, 'T' || event_id AS trip_id,
                   if(event_id % 10 = 6, 'P1', NULL) AS stop_id,
                   CASE event_id % 10 WHEN 2 THEN '{"stop_id": "P1"}' WHEN 4 THEN '[{"stop_id": "P1"' END AS rejected_text
            FROM reports WHERE event_id % 3 = 0 AND event_id % 10 IN (2, 4, 6)""",
        "assert_not_null": "FROM stg_vehicle_positions WHERE trip_id IS NULL",
        "assert_unique": """SELECT entity_id AS unique_field, count() AS n_records FROM stg_vehicle_positions
            WHERE entity_id IS NOT NULL GROUP BY 1 HAVING n_records > 1""",
        "assert_accepted_values": f"""SELECT delay_band AS value_field, count() AS n_records
            FROM fct_on_time_performance WHERE delay_band IN ({text(L.DELAY_BANDS[5])}, {text(L.DELAY_BANDS[6])})
            GROUP BY 1""",
        "assert_unique_key": """SELECT trip_id, stop_sequence, count() AS duplicate_count FROM stg_stop_times
            GROUP BY ALL HAVING duplicate_count > 1""",
        "assert_match_rate": f"""
            SELECT count() AS total_rows, count() FILTER (schedule_match_status = {text(L.MATCHED)}) AS matched_rows,
                   matched_rows / total_rows AS match_rate, {L.MIN_MATCH_RATE}::DOUBLE AS minimum_match_rate
            FROM trip_schedule_vs_actual HAVING matched_rows < {L.MIN_MATCH_RATE} * total_rows""",
        "assert_score_range": """SELECT anomaly_id, anomaly_score FROM fct_anomaly_findings
            WHERE anomaly_score > 0.9::DOUBLE""",
        "assert_label_coverage": f"""
            SELECT label AS synthetic_anomaly_type, 0::BIGINT AS row_count
            FROM (SELECT unnest([{', '.join(map(text, (*L.EVALUATION_CASES, 'unseen_label')))}]) AS label)
            WHERE label NOT IN (SELECT synthetic_anomaly_type FROM synthetic_anomaly_evaluation)""",
        "assert_recall": """SELECT metric_scope, anomaly_type, recall FROM anomaly_detection_metrics
            WHERE metric_scope = 'overall'""",
        "source_freshness": """
            SELECT realtime_source AS feed_type, max(snapshot_timestamp_utc) AS max_loaded_at,
                   (epoch_us(any_value(as_of)) - epoch_us(max_loaded_at)) / 60e6 AS age_minutes,
                   CASE WHEN age_minutes <= 10 THEN 'pass' WHEN age_minutes <= 60 THEN 'warn' ELSE 'error' END
                       AS freshness_state
            FROM both_feeds, (SELECT date_trunc('second', max(ts)) + INTERVAL 30 MINUTE AS as_of FROM events)
            GROUP BY realtime_source""",
        "check_suite": _check_sql(),
        "checks_while_writing": _check_sql(),
        "unique_finding_ids": """
            SELECT anomaly_id || CASE WHEN n > 1 THEN '#' || n ELSE '' END AS anomaly_id, detector_rule_id
            FROM (SELECT *, row_number() OVER (PARTITION BY anomaly_id) AS n FROM fct_anomaly_findings)""",
        "kpi_snapshots": "SELECT count() AS snapshot_count FROM fct_feed_quality",
        "kpi_findings": "SELECT count() AS finding_count FROM fct_anomaly_findings",
        "kpi_priority_findings": """SELECT count() FILTER (anomaly_severity <> 'medium')
            AS priority_finding_count FROM fct_anomaly_findings""",
        "kpi_avg_plausible_delay": f"""
            SELECT round(avg(estimated_delay_minutes) FILTER (delay_sanity_status = {text(L.PLAUSIBLE)}), 6)
                AS avg_plausible_delay_minutes FROM fct_on_time_performance""",
        "kpi_match_rate": f"""
            SELECT count() FILTER (schedule_match_status = {text(L.MATCHED)}) / nullif(count(), 0) AS match_rate
            FROM fct_on_time_performance""",
        "findings_by_type": _counted("fct_anomaly_findings", "anomaly_type", "finding_count"),
        "feed_status_counts": _counted("fct_feed_quality", "feed_quality_status", "snapshot_count"),
        "feed_quality_trend": """
            SELECT snapshot_timestamp_utc, snapshot_folder, feed_quality_status, null_gps_rate,
                   duplicate_trip_update_rate, unmatched_realtime_trip_rate, vehicle_record_count,
                   trip_update_record_count
            FROM fct_feed_quality ORDER BY ALL""",
        "feed_quality_avg_rates": """
            SELECT round(avg(null_gps_rate), 6) AS avg_null_gps_rate,
                   round(avg(duplicate_trip_update_rate), 6) AS avg_duplicate_trip_update_rate,
                   round(avg(unmatched_realtime_trip_rate), 6) AS avg_unmatched_realtime_trip_rate
            FROM fct_feed_quality""",
        "findings_by_type_severity":
            _counted("fct_anomaly_findings", "anomaly_type, anomaly_severity", "finding_count"),
        "detector_benchmark": """
            SELECT anomaly_type, true_positive, false_positive, false_negative, true_negative, "precision",
                   recall, f1_score FROM anomaly_detection_metrics""",
        "top_findings": """
            SELECT anomaly_type, anomaly_severity, anomaly_score, snapshot_folder, route_id, trip_id, entity_id,
                   detector_rule_id, anomaly_reason
            FROM fct_anomaly_findings
            ORDER BY anomaly_score DESC, anomaly_severity, anomaly_type, snapshot_folder, route_id, trip_id,
                     entity_id, anomaly_reason LIMIT 50""",
        "route_status_counts":
            _counted("fct_route_realtime_activity", "route_activity_status", "route_snapshot_count"),
        "top_routes": """
            SELECT route_id, sum(total_realtime_records)::BIGINT AS total_realtime_records,
                   sum(vehicle_position_count)::BIGINT AS vehicle_positions,
                   sum(trip_update_count)::BIGINT AS trip_updates,
                   max(distinct_vehicle_count) AS peak_distinct_vehicles
            FROM fct_route_realtime_activity GROUP BY route_id ORDER BY 2 DESC, 1 LIMIT 25""",
        "on_time_rate": """
            SELECT avg(on_time_flag::INT) AS on_time_rate FROM fct_on_time_performance""",
        "extreme_delay_count": """
            SELECT count() AS extreme_delay_count FROM fct_on_time_performance
            WHERE delay_sanity_status LIKE 'extreme%'""",
        "delay_band_counts": _counted("fct_on_time_performance", "delay_band", "trip_snapshot_count"),
        "top_delayed_routes": f"""
            SELECT route_id, count() AS trip_snapshot_count,
                   round(avg(estimated_delay_minutes), 6) AS avg_estimated_delay_minutes,
                   round(max(estimated_delay_minutes), 6) AS max_estimated_delay_minutes
            FROM fct_on_time_performance WHERE delay_sanity_status = {text(L.PLAUSIBLE)}
            GROUP BY route_id HAVING trip_snapshot_count >= 5
            ORDER BY avg_estimated_delay_minutes DESC, route_id LIMIT 25""",
        "headway_status_counts":
            _counted("fct_headway", "headway_reliability_status", "route_snapshot_count"),
        "kpi_avg_spacing": """
            SELECT round(sum(avg_vehicle_spacing_minutes::DECIMAL(28, 6))::DOUBLE
                         / nullif(count(avg_vehicle_spacing_minutes), 0), 6) AS avg_vehicle_spacing_minutes
            FROM fct_headway""",
        "top_variable_routes": """
            SELECT route_id, snapshot_folder, distinct_vehicle_count, avg_vehicle_spacing_minutes,
                   headway_variance_minutes, headway_reliability_status
            FROM fct_headway WHERE headway_variance_minutes >= 0
            ORDER BY headway_variance_minutes DESC, route_id, snapshot_folder LIMIT 25""",
        "snapshot_range_report": """
            SELECT min(snapshot_timestamp_utc) AS first_snapshot, max(snapshot_timestamp_utc) AS latest_snapshot
            FROM fct_feed_quality""",
    }
    return plain | found


_OVER_DAILY_FILES = {
    "scan_snapshots": "FROM raw_vehicle_positions",
    "snapshot_lineage": "SELECT snapshot_folder, entity_id, trip_id FROM raw_trip_updates",
    "capture_files": "SELECT DISTINCT snapshot_folder FROM both_feeds",
    "streamed_feed_quality": "FROM fct_feed_quality",
    "marts_by_day": "FROM fct_feed_quality",
    "streamed_findings": "FROM fct_anomaly_findings",
}


def statements() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in _statements().items()} | {
        name: with_tables(sql, DAILY) for name, sql in _OVER_DAILY_FILES.items()
    }
