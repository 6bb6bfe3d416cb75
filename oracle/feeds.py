"""Feed tables out of the star-schema tables, in DuckDB SQL."""

from fleetgauge.labels import SERVICE_DAY_OFFSET_SECONDS as OFFSET

FEEDS = {
    "raw_routes": """
        SELECT r_name AS source_feed, 'N' || n_nationkey AS route_id, 'A' || n_regionkey AS agency_id,
               n_name AS route_short_name, r_name || ' ' || n_name AS route_long_name,
               n_regionkey::VARCHAR AS route_type
        FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
    "raw_stops": """
        SELECT 'F' || (s_nationkey % 6) AS source_feed, 'P' || s_suppkey AS stop_id, s_name AS stop_name,
               40.3::DOUBLE + s_acctbal / 20000 AS stop_lat, -73.9::DOUBLE - s_acctbal / 20000 AS stop_lon
        FROM supplier
    """,
    "raw_trips": """
        SELECT 'R' || (o_custkey % 12) AS route_id, o_orderpriority AS service_id,
               if(o_orderkey % 20 = 0, 'X', 'T') || o_orderkey AS trip_id, o_orderstatus AS trip_headsign,
               (o_custkey % 2)::VARCHAR AS direction_id, 'S' || (o_custkey % 50) AS shape_id
        FROM orders
    """,
    "raw_stop_times": """
        SELECT 'F' || (l_suppkey % 6) AS source_feed,
               if(l_orderkey % 20 = 0, 'X', 'T') || l_orderkey AS trip_id,
               clock AS arrival_time, clock AS departure_time, 'P' || l_suppkey AS stop_id,
               l_linenumber::VARCHAR AS stop_sequence, (l_linenumber % 4)::VARCHAR AS pickup_type,
               '' AS drop_off_type, if(l_returnflag = 'R', '1', '0') AS timepoint
        FROM (
            SELECT *, (l_partkey * 37 + l_linenumber * 600) % 100000 AS s,
                   if(l_quantity = 13, 'bad', format('{:02d}:{:02d}:{:02d}', s // 3600, s // 60 % 60, s % 60))
                       AS clock
            FROM lineitem
        )
    """,
    "reports": """
        SELECT * EXCLUDE (ts), ts AS reported_at, epoch_us(ts) // 1000000 AS s,
               date_trunc('hour', ts) + to_hours(if(hour(ts) % 7 = 3, 2, 1)) AS taken_at,
               strftime(taken_at, 'snapshot_%Y%m%d_%H%M%S') AS folder,
               strftime(taken_at, '%Y-%m-%dT%H:%M:%SZ') AS taken_text,
               taken_at + to_hours(if(hour(ts) = 20, 1, 0)) AS late_at,
               strftime(late_at, 'snapshot_%Y%m%d_%H%M%S') AS late_folder,
               strftime(late_at, '%Y-%m-%dT%H:%M:%SZ') AS late_text
        FROM events
    """,
    "raw_vehicle_positions": """
        SELECT 'vehicle_positions' AS feed_type, late_text AS snapshot_timestamp_utc,
               'V' || user_id AS entity_id, 'BUS_' || user_id AS vehicle_id,
               if(event_id % 10 = 1, NULL, 'T' || event_id) AS trip_id,
               if(event_id % 50 = 2, NULL, event_type) AS route_id,
               if(event_id % 40 = 4, NULL, 40.3::DOUBLE + value / 1000) AS latitude,
               if(event_id % 60 = 4, NULL, -73.9::DOUBLE - value / 500) AS longitude,
               (event_id % 360)::DOUBLE AS bearing, value / 2 AS speed,
               event_id % 30 AS current_stop_sequence,
               if(event_id % 2 = 0, 'STOPPED_AT', 'IN_TRANSIT_TO') AS current_status,
               if(event_id % 25 = 7, NULL, s) AS "timestamp", late_folder AS snapshot_folder
        FROM reports WHERE event_id % 3 <> 0
    """,
    "raw_trip_updates": """
        SELECT 'trip_updates' AS feed_type, taken_text AS snapshot_timestamp_utc,
               'E' || (user_id % 40) AS entity_id, 'T' || event_id AS trip_id, event_type AS route_id,
               'BUS_' || user_id AS vehicle_id, NULL::VARCHAR AS stop_time_updates, s AS "timestamp",
               folder AS snapshot_folder
        FROM reports WHERE event_id % 3 = 0
    """,
    "raw_trip_update_stops": f"""
        SELECT 'trip_updates' AS feed_type, taken_text AS snapshot_timestamp_utc,
               'E' || (user_id % 40) AS entity_id, 'T' || event_id AS trip_id, event_type AS route_id,
               'BUS_' || user_id AS vehicle_id, s AS "timestamp", folder AS snapshot_folder,
               CASE WHEN l_linenumber IS NOT NULL
                    THEN '[' || first_stop || if(l_quantity % 4 = 0, ',' || second_stop, '') || ']'
                    WHEN event_id % 2 = 0 THEN '[]' END AS stop_time_updates
        FROM (
            SELECT *, (l_suppkey * 7 + l_linenumber * 11 + event_id) % 95 - 20 AS shift,
                   if(l_quantity = 17, shift * 60, NULL) AS lag_s,
                   if(l_quantity = 17, NULL,
                      epoch_us(date_trunc('day', reported_at - to_seconds({OFFSET}))) // 1000000 + {OFFSET}
                      + (l_partkey * 37 + l_linenumber * 600) % 86400 + shift * 60) AS at_s,
                   l_linenumber = 1 AS leaves,
                   json_object('stop_id', if(l_quantity = 50, 'Q', 'P') || l_suppkey,
                       'stop_sequence', l_linenumber,
                       'arrival_time', if(leaves, NULL, at_s), 'arrival_delay', if(leaves, NULL, lag_s),
                       'departure_time', if(leaves, at_s, NULL), 'departure_delay', if(leaves, lag_s, NULL)
                   )::VARCHAR AS first_stop,
                   json_object('stop_id', if(l_quantity = 50, 'Q', 'P') || l_suppkey,
                       'stop_sequence', l_linenumber + 50,
                       'arrival_time', if(leaves, NULL, at_s), 'arrival_delay', NULL,
                       'departure_time', if(leaves, at_s, NULL), 'departure_delay', NULL
                   )::VARCHAR AS second_stop
            FROM reports
            LEFT JOIN lineitem ON l_orderkey = event_id
            WHERE event_id % 3 = 0
        )
    """,
    # The schedule files written for the file scans: three feeds by the digits of an id.
    "feed_names": "SELECT unnest(['busco', 'brooklyn', 'bronx']) AS feed, unnest([0, 1, 2]) AS residue",
}

# Snapshots of a day instead of an hour, as the written snapshot files have them.
DAILY = {
    "reports": f"""
        SELECT * EXCLUDE (taken_at, late_at, folder, taken_text, late_folder, late_text),
               date_trunc('day', taken_at)::TIMESTAMP AS taken_at, date_trunc('day', late_at)::TIMESTAMP AS late_at,
               strftime(date_trunc('day', taken_at), 'snapshot_%Y%m%d_%H%M%S') AS folder,
               strftime(date_trunc('day', late_at), 'snapshot_%Y%m%d_%H%M%S') AS late_folder,
               strftime(date_trunc('day', taken_at), '%Y-%m-%dT%H:%M:%SZ') AS taken_text,
               strftime(date_trunc('day', late_at), '%Y-%m-%dT%H:%M:%SZ') AS late_text
        FROM ({FEEDS["reports"]})
    """
}
