"""Feed tables projected out of the star-schema test tables, so the operators can run on them.

Every rule is a plain column expression over ``region nation supplier orders lineitem events``;
the tables grow with those and nothing is sampled. Only a trip update as the capture files have it
gathers a group, the lines of its order, into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.labels import SERVICE_DAY_OFFSET_SECONDS, TRIP_UPDATE_FEED, VEHICLE_FEED

# Only the columns that are read; a given schema also spares Spark a look into the files.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_returnflag string"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


# Lines of an order that are gathered into one captured trip update at most.
LINES_OF_A_RECORD = 10_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def raw_routes(spark: SparkSession, folder: str) -> DataFrame:
    regions = read_table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nations = read_table(spark, folder, "nation")
    return nations.join(regions, "n_regionkey").selectExpr(
        "r_name AS source_feed",
        "'N' || n_nationkey AS route_id",
        "'A' || n_regionkey AS agency_id",
        "n_name AS route_short_name",
        "r_name || ' ' || n_name AS route_long_name",
        "string(n_regionkey) AS route_type",
    )


def raw_stops(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier").selectExpr(
        "'F' || s_nationkey % 6 AS source_feed",
        "'P' || s_suppkey AS stop_id",
        "s_name AS stop_name",
        "40.3D + s_acctbal / 20000D AS stop_lat",
        "-73.9D - s_acctbal / 20000D AS stop_lon",
    )


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Every twentieth order is a trip that realtime never names."""
    return (
        read_table(spark, folder, "orders")
        .selectExpr(
            "'R' || o_custkey % 12 AS route_id",
            "o_orderpriority AS service_id",
            "IF(o_orderkey % 20 = 0, 'X', 'T') || o_orderkey AS trip_id",
            "o_orderstatus AS trip_headsign",
            "string(o_custkey % 2) AS direction_id",
            "'S' || o_custkey % 50 AS shape_id",
        )
    )


_SCHEDULED_SECOND = "(l_partkey * 37 + l_linenumber * 600)"


def raw_stop_times(spark: SparkSession, folder: str) -> DataFrame:
    """Clock texts pass 24 hours, and are unreadable on lines with a quantity of 13."""
    clock = """IF(l_quantity = 13, 'bad', lpad(string(s div 3600), 2, '0') || ':' ||
        lpad(string(s div 60 % 60), 2, '0') || ':' || lpad(string(s % 60), 2, '0'))"""
    return (
        read_table(spark, folder, "lineitem")
        .selectExpr("*", f"{_SCHEDULED_SECOND} % 100000 AS s")
        .selectExpr(
            "'F' || l_suppkey % 6 AS source_feed",
            "IF(l_orderkey % 20 = 0, 'X', 'T') || l_orderkey AS trip_id",
            f"{clock} AS arrival_time",
            f"{clock} AS departure_time",
            "'P' || l_suppkey AS stop_id",
            "string(l_linenumber) AS stop_sequence",
            "string(l_linenumber % 4) AS pickup_type",
            "'' AS drop_off_type",
            "IF(l_returnflag = 'R', '1', '0') AS timepoint",
        )
    )


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the hourly snapshot that reports them; some hours have none, and wait for the next."""
    return (
        read_table(spark, folder, "events")
        .selectExpr("* EXCEPT (ts)", "timestamp(ts) AS at")
        .selectExpr(
            "*",
            "unix_seconds(at) AS second",
            "date_trunc('hour', at) + INTERVAL 1 HOUR * IF(hour(at) % 7 = 3, 2, 1) AS taken_at",
        )
    )


def _capture_columns(feed: str, iso_text: bool) -> list[str]:
    time = "date_format(taken_at, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")" if iso_text else "taken_at"
    return [
        f"'{feed}' AS feed_type",
        f"{time} AS snapshot_timestamp_utc",
        "date_format(taken_at, \"'snapshot_'yyyyMMdd_HHmmss\") AS snapshot_folder",
    ]


def raw_vehicle_positions(spark: SparkSession, folder: str, *, iso_text: bool = False) -> DataFrame:
    return (
        _reports(spark, folder)
        .where("event_id % 3 <> 0")
        # A snapshot without vehicles: those of hour 20 come an hour later.
        .selectExpr("* EXCEPT (taken_at)", "taken_at + INTERVAL 1 HOUR * IF(hour(at) = 20, 1, 0) AS taken_at")
        .selectExpr(
            *_capture_columns(VEHICLE_FEED, iso_text),
            "'V' || user_id AS entity_id",
            "'BUS_' || user_id AS vehicle_id",
            "IF(event_id % 10 = 1, NULL, 'T' || event_id) AS trip_id",
            "IF(event_id % 50 = 2, NULL, event_type) AS route_id",
            "IF(event_id % 40 = 4, NULL, 40.3D + value / 1000D) AS latitude",
            "IF(event_id % 60 = 4, NULL, -73.9D - value / 500D) AS longitude",
            "double(event_id % 360) AS bearing",
            "value / 2D AS speed",
            "event_id % 30 AS current_stop_sequence",
            "IF(event_id % 2 = 0, 'STOPPED_AT', 'IN_TRANSIT_TO') AS current_status",
            "IF(event_id % 25 = 7, NULL, second) AS timestamp",
        )
    )


def _trip_update_columns(iso_text: bool) -> list[str]:
    return [
        *_capture_columns(TRIP_UPDATE_FEED, iso_text),
        "'E' || user_id % 40 AS entity_id",
        "'T' || event_id AS trip_id",
        "event_type AS route_id",
        "'BUS_' || user_id AS vehicle_id",
        "second AS timestamp",
    ]


def raw_trip_updates(spark: SparkSession, folder: str, *, iso_text: bool = False) -> DataFrame:
    """Trip updates without their stop updates; ``raw_trip_updates_with_stops`` has both."""
    updates = _reports(spark, folder).where("event_id % 3 = 0")
    return updates.selectExpr(*_trip_update_columns(iso_text), "string(NULL) AS stop_time_updates")


def _stop_parts(spark: SparkSession, folder: str, updates: DataFrame, *, native: bool) -> DataFrame:
    """``updates`` with the ``stop_time_updates`` of one line of the order with the event's number a row.

    ``part`` numbers runs of lines; without a line it is NULL.
    """
    lines = (
        read_table(spark, folder, "lineitem")
        .selectExpr("l_orderkey AS event_id", "* EXCEPT (l_orderkey)")
    )
    columns, updates = updates.columns, updates.join(lines, "event_id", "left")
    offset = SERVICE_DAY_OFFSET_SECONDS

    def element(sequence: str, delay: str) -> str:
        return f"""named_struct(
            'stop_id', IF(l_quantity = 50, 'Q', 'P') || l_suppkey,
            'stop_sequence', {sequence},
            'arrival_time', IF(l_linenumber = 1, NULL, time),
            'arrival_delay', IF(l_linenumber = 1, NULL, {delay}),
            'departure_time', IF(l_linenumber = 1, time, NULL),
            'departure_delay', IF(l_linenumber = 1, {delay}, NULL))"""

    one = element("l_linenumber", "delay")
    two = f"{one}, {element('l_linenumber + 50', 'int(NULL)')}"
    array = f"IF(l_quantity % 4 = 0, array({two}), array({one}))"
    text = f"to_json({array}, map('ignoreNullFields', 'false'))"
    value, empty = (array, f"slice(array({one}), 1, 0)") if native else (text, "'[]'")
    return (
        updates.selectExpr(
            "*",
            "(l_suppkey * 7 + l_linenumber * 11 + event_id) % 95 - 20 AS shift",
            f"second - pmod(second - {offset}, 86400) AS day_start",
        )
        .selectExpr(
            "*",
            "IF(l_quantity = 17, int(shift * 60), NULL) AS delay",
            f"IF(l_quantity = 17, NULL, day_start + {_SCHEDULED_SECOND} % 86400 + shift * 60) AS time",
        )
        .selectExpr(
            *columns,
            f"l_linenumber div {LINES_OF_A_RECORD} AS part",
            f"CASE WHEN l_linenumber IS NOT NULL THEN {value} WHEN event_id % 2 = 0 THEN {empty} END "
            "AS stop_time_updates",
        )
    )


def raw_trip_update_stops(spark: SparkSession, folder: str, *, native: bool = False) -> DataFrame:
    """Trip updates in parts, each with the JSON (or native) array of one or two stop updates.

    One part per line of the order with the event's number. The first element can match the
    schedule, unless its quantity of 50 stands for an unknown stop; a second one, on some lines, names a
    stop the schedule does not have. Without lines
    the array is empty, or NULL for every other event. Parts keep an order with very many lines
    from becoming one row.
    """
    updates = _reports(spark, folder).where("event_id % 3 = 0")
    parts = _stop_parts(spark, folder, updates, native=native)
    return parts.selectExpr(*_trip_update_columns(False), "stop_time_updates")


def raw_trip_updates_with_stops(spark: SparkSession, folder: str, *, iso_text: bool = False) -> DataFrame:
    """The rows of ``raw_trip_updates``, each with its stop updates in one native array.

    A captured trip update is one record of a file, so the lines of an order do become one row here; an
    order with more than ``LINES_OF_A_RECORD`` lines becomes several records.
    """
    event = ["event_id", "event_type", "user_id", "second", "taken_at"]
    updates = _reports(spark, folder).where("event_id % 3 = 0").groupBy(*event).agg(F.count("*").alias("copies"))
    stops = F.sort_array(F.flatten(F.collect_list("stop_time_updates")))
    whole = (
        _stop_parts(spark, folder, updates, native=True)
        .groupBy(*event, "copies", "part")
        .agg(F.when(F.count("stop_time_updates") > 0, stops).alias("stop_time_updates"))
        .selectExpr("*", "explode(sequence(1L, copies)) AS copy")
    )
    return whole.selectExpr(*_trip_update_columns(iso_text), "stop_time_updates")


def vehicle_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded feed entities, vehicles and others; unset ids are empty text."""
    vehicle = """named_struct(
        'trip', named_struct(
            'trip_id', IF(event_id % 10 = 1, '', 'T' || event_id),
            'route_id', IF(event_id % 50 = 2, '', event_type)),
        'vehicle', named_struct('id', 'BUS_' || user_id),
        'position', IF(event_id % 40 = 4, NULL, named_struct(
            'latitude', 40.3D + value / 1000D,
            'longitude', -73.9D - value / 500D,
            'bearing', double(event_id % 360),
            'speed', value / 2D)),
        'current_stop_sequence', event_id % 30,
        'current_status', IF(event_id % 4 = 3, NULL, int(event_id % 4)),
        'timestamp', IF(event_id % 25 = 7, NULL, second))"""
    return _reports(spark, folder).selectExpr(
        "IF(event_id % 17 = 5, '', 'V' || user_id) AS id",
        f"IF(event_id % 3 = 0, NULL, {vehicle}) AS vehicle",
        _capture_columns(VEHICLE_FEED, True)[1],
    )


def trip_update_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded feed entities, trip updates and others."""
    update = """named_struct(
        'trip', named_struct('trip_id', 'T' || event_id, 'route_id', event_type),
        'vehicle', named_struct('id', IF(event_id % 9 = 0, '', 'BUS_' || user_id)),
        'stop_time_update', IF(event_id % 21 = 0, NULL, array(
            named_struct(
                'stop_id', 'P' || event_id % 100,
                'stop_sequence', 1L,
                'arrival', named_struct('time', second + 60, 'delay', int(event_id % 90)),
                'departure', named_struct('time', second + 90, 'delay', int(event_id % 60))),
            named_struct(
                'stop_id', IF(event_id % 5 = 0, '', 'P' || event_id % 77),
                'stop_sequence', 2L,
                'arrival', IF(event_id % 6 = 0, NULL,
                    named_struct('time', second + 300, 'delay', int(NULL))),
                'departure', CAST(NULL AS struct<time:bigint, delay:int>)))),
        'timestamp', second)"""
    return _reports(spark, folder).selectExpr(
        "'E' || user_id % 40 AS id",
        f"IF(event_id % 3 = 0, {update}, NULL) AS trip_update",
        _capture_columns(TRIP_UPDATE_FEED, True)[1],
    )
