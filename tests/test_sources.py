import pytest
from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.operators.capture import capture_audit, capture_files, capture_status_summary
from fleetgauge.plans.load import load_raw, open_raw
from fleetgauge.plans.models import Models, materialize_layers
from fleetgauge.schemas import TRIP_UPDATE_ENTITY, VEHICLE_ENTITY
from fleetgauge.sources.entities import flatten_trip_update_entity, flatten_vehicle_entity
from fleetgauge.session import configure
from fleetgauge.sources.schedule import (
    check_required_tables,
    empty_schedule_table,
    list_schedule_files,
    load_schedule,
    missing_required_tables,
    resolve_feed_layout,
    scan_static_csv,
    union_feeds_by_name,
)
from fleetgauge.sources.snapshots import (
    empty_source_schema,
    nested_to_json,
    scan_snapshots,
    snapshot_range,
    with_snapshot_date,
    write_snapshot_arrays,
)
from fleetgauge.sources.tables import replace_sink

FILES = {
    "routes": "route_id,route_short_name\nQ7,Q7\n",
    "trips": "route_id,service_id,trip_id\nQ7,wkd,T-11\n",
    "stops": "stop_id,stop_name\nS-81,Harbour Rd\n",
    "stop_times": "trip_id,stop_id,stop_sequence\nT-11,S-81,1\n",
}


def write_feed(folder, **changes):
    folder.mkdir(parents=True)
    for table, text in {**FILES, **changes}.items():
        if text is not None:
            (folder / f"{table}.txt").write_text(text, encoding="utf-8")


def test_csv_keeps_blanks_and_leading_zeros_as_text(spark, tmp_path):
    path = tmp_path / "stops.txt"
    path.write_text('stop_name,stop_id\n"A, ""B""",007\n,1\n"",2\nNA,3\n', encoding="utf-8")
    df = scan_static_csv(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [('A, "B"', "007"), ("", "1"), ("", "2"), ("NA", "3")]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}


def test_flat_layout_is_one_feed(spark, tmp_path):
    write_feed(tmp_path / "extracted")
    root = str(tmp_path / "extracted")
    assert resolve_feed_layout(spark, root) == {"single_feed": root}
    tables = load_schedule(spark, root)
    assert set(tables) == set(L.REQUIRED_TABLES)
    assert {name: df.count() for name, df in tables.items()} == dict.fromkeys(L.REQUIRED_TABLES, 1)
    assert tables["trips"].first().asDict() == {
        "route_id": "Q7",
        "service_id": "wkd",
        "trip_id": "T-11",
        "source_feed": "single_feed",
        "trip_headsign": None,
        "direction_id": None,
        "shape_id": None,
    }


def test_feeds_win_over_the_flat_folder_and_keep_their_order(spark, tmp_path):
    write_feed(tmp_path / "extracted")
    write_feed(tmp_path / "brooklyn" / "extracted", routes="route_id,route_color\nK1,red\n")
    write_feed(tmp_path / "busco" / "extracted", routes="route_id\nK100\n", calendar="service_id\nwkd\n")
    assert list(resolve_feed_layout(spark, str(tmp_path / "extracted"))) == ["busco", "brooklyn"]
    tables = load_schedule(spark, str(tmp_path))
    routes = tables["routes"].select("source_feed", "route_id", "route_color").collect()
    assert sorted(map(tuple, routes)) == [("brooklyn", "K1", "red"), ("busco", "K100", None)]
    assert tables["calendar"].count() == 1 and "calendar_dates" not in tables


def test_no_feed(spark, tmp_path):
    assert resolve_feed_layout(spark, str(tmp_path / "nowhere")) == {}
    assert load_schedule(spark, str(tmp_path / "nowhere")) == {}
    assert empty_schedule_table(spark, "routes").count() == 0


def test_an_unlisted_feed_folder_is_an_error_and_can_be_listed(spark, tmp_path):
    write_feed(tmp_path / "busco" / "extracted")
    write_feed(tmp_path / "hoboken" / "extracted")
    with pytest.raises(ValueError, match="hoboken"):
        load_schedule(spark, str(tmp_path))
    tables = load_schedule(spark, str(tmp_path), feeds=("hoboken", "busco"))
    assert {r.source_feed for r in tables["trips"].collect()} == {"hoboken", "busco"}


def test_an_unknown_file_system_is_no_empty_schedule(spark):
    with pytest.raises(Exception, match="nosuchfs"):
        load_schedule(spark, "nosuchfs://somewhere/feeds")


def test_quoted_line_breaks_stay_in_their_cell(spark, tmp_path):
    path = tmp_path / "stops.txt"
    path.write_text('stop_id,stop_name\n1,"Main\nStreet"\n2,"x\n\ny"\n', encoding="utf-8")
    found = scan_static_csv(spark, str(path)).orderBy("stop_id").collect()
    assert [tuple(r) for r in found] == [("1", "Main\nStreet"), ("2", "x\n\ny")]


def test_files_with_swapped_columns_are_not_mixed_up(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "a" / "stops.txt").write_text("stop_id,stop_name\n1,One\n", encoding="utf-8")
    (tmp_path / "b" / "stops.txt").write_text("stop_name,stop_id\nTwo,2\n", encoding="utf-8")
    paths = [str(tmp_path / folder / "stops.txt") for folder in "ab"]
    with pytest.raises(Exception, match="(?i)header"):
        scan_static_csv(spark, paths).collect()
    both = union_feeds_by_name([scan_static_csv(spark, path) for path in paths])
    assert sorted((r.stop_id, r.stop_name) for r in both.collect()) == [("1", "One"), ("2", "Two")]


def test_a_caller_keeps_its_plan_settings(spark):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "77m")
        configure(spark)
        assert spark.conf.get(key) == "77m"
    finally:
        spark.conf.set(key, before)


def test_missing_required_file_names_feed_and_file(spark, tmp_path):
    write_feed(tmp_path / "busco" / "extracted", trips=None, stop_times=None)
    layout = resolve_feed_layout(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError, match=r"'busco'.*trips\.txt, stop_times\.txt"):
        check_required_tables(spark, layout)
    missing = missing_required_tables(list_schedule_files(spark, layout), list(layout)).collect()
    assert sorted(map(tuple, missing)) == [("busco", "stop_times"), ("busco", "trips")]


def test_scan_adds_folder_and_compacts_stop_updates(spark, tmp_path, write_snapshot):
    record = {"entity_id": "T-11", "trip_id": "T-11", "stop_time_updates": [{"stop_id": "S-81"}]}
    write_snapshot(tmp_path, "snapshot_20231114_221000", trip_updates=[record, {"entity_id": "t2"}])
    found = scan_snapshots(spark, str(tmp_path), L.TRIP_UPDATE_FEED).orderBy("entity_id").collect()
    assert found[0]["snapshot_folder"] == "snapshot_20231114_221000"
    assert found[0]["stop_time_updates"] == '[{"stop_id":"S-81"}]'
    assert found[1]["stop_time_updates"] is None and found[1]["route_id"] is None


def test_scan_reads_odd_numbers_one_by_one(spark, tmp_path, write_snapshot):
    records = [
        {"entity_id": "a", "latitude": "40.5", "speed": "fast", "timestamp": 1700000300, "extra": {"x": 1}},
        {"entity_id": "b", "latitude": 40, "speed": 7.5, "timestamp": 1700000300.0},
    ]
    write_snapshot(tmp_path, "snapshot_20231114_221000", vehicle_positions=records)
    found = scan_snapshots(spark, str(tmp_path), L.VEHICLE_FEED).orderBy("entity_id")
    values = [tuple(r) for r in found.select("latitude", "speed", "timestamp").collect()]
    assert values == [(40.5, None, 1700000300), (40.0, 7.5, 1700000300)]


def test_range_is_inclusive_and_optional(spark, tmp_path, write_snapshot):
    folders = ["0301_101500", "0301_102000", "0301_102501", "0302_000010", "0302_000511"]
    for folder in folders:
        record = {"entity_id": folder, "snapshot_timestamp_utc": "2026-03-01T00:00:00Z"}
        write_snapshot(tmp_path, f"snapshot_2026{folder}", vehicle_positions=[record])
    write_snapshot(tmp_path, "other_folder", vehicle_positions=[{"entity_id": "no"}])

    def entities(df):
        return sorted(row["entity_id"] for row in df.select("entity_id").collect())

    start, end = "snapshot_20260301_102000", "snapshot_20260302_000010"
    scan = scan_snapshots(spark, str(tmp_path), L.VEHICLE_FEED, start=start, end=end)
    assert entities(scan) == folders[1:4]
    everything = scan_snapshots(spark, str(tmp_path), L.VEHICLE_FEED)
    assert entities(everything) == folders
    assert entities(snapshot_range(everything, start=start)) == folders[1:]
    assert entities(snapshot_range(everything, end=end)) == folders[:4]

    stored = str(tmp_path / "stored")
    replace_sink(with_snapshot_date(everything), stored, as_path=True, partition_by=["snapshot_date"])
    table = spark.read.schema(with_snapshot_date(everything).schema).parquet(stored)
    ranged = snapshot_range(table, start="snapshot_20260302_000000")
    assert entities(ranged) == folders[3:]
    plan = ranged._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and ">= 20260302" in plan


def test_missing_file_of_one_feed_is_empty(spark, tmp_path, write_snapshot):
    write_snapshot(tmp_path, "snapshot_20231114_221000", vehicle_positions=[{"entity_id": "v"}])
    assert scan_snapshots(spark, str(tmp_path), L.VEHICLE_FEED).count() == 1
    empty = scan_snapshots(spark, str(tmp_path), L.TRIP_UPDATE_FEED)
    assert empty.count() == 0 and empty.schema == empty_source_schema(spark, L.TRIP_UPDATE_FEED).schema


@pytest.mark.parametrize("content", ['{"entity_id": "v"}', "[{", "null"])
def test_a_file_that_is_no_array_fails(spark, tmp_path, write_snapshot, content):
    write_snapshot(tmp_path, "snapshot_20231114_221000", vehicle_positions=content)
    with pytest.raises(Exception, match="Expected a list of records|MALFORMED|FAILFAST"):
        scan_snapshots(spark, str(tmp_path), L.VEHICLE_FEED).collect()


def test_empty_array_has_no_records(spark, tmp_path, write_snapshot):
    write_snapshot(tmp_path, "snapshot_20231114_221000", vehicle_positions=" \n[]")
    assert scan_snapshots(spark, str(tmp_path), L.VEHICLE_FEED).count() == 0


def test_written_arrays_are_bounded_and_read_back(spark, tmp_path):
    records = spark.range(250).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("entity_id"),
        F.lit("snapshot_20240101_000000").alias("snapshot_folder"),
    )
    path = str(tmp_path / "out")
    write_snapshot_arrays(records.coalesce(1), path, max_records=100)
    found = scan_snapshots(spark, path, L.VEHICLE_FEED, pattern="*/*")
    assert found.count() == 250 and found.select("entity_id").distinct().count() == 250
    files = capture_files(spark, f"{path}/*/*").collect()
    assert len(files) == 3 and {f.snapshot_folder for f in files} == {"snapshot_20240101_000000"}


def test_nested_to_json(spark):
    df = spark.sql(
        "SELECT array(named_struct('stop_id', 'a', 'arrival_time', bigint(NULL))) AS stop_time_updates "
        "UNION ALL SELECT NULL"
    )
    texts = {row[0] for row in nested_to_json(df).collect()}
    assert texts == {'[{"stop_id":"a","arrival_time":null}]', None}


def test_vehicle_entity(spark):
    entities = spark.createDataFrame(
        [
            ("ent-9", (("T-1123", "X4"), ("veh-77",), (40.81, -73.77, 181.5, 6.25), 8, 1, 1700000300),
             "2023-11-14T22:15:00Z"),
            ("", (("", ""), None, None, None, None, None), "2023-11-14T22:15:00Z"),
            ("no vehicle", None, "2023-11-14T22:15:00Z"),
        ],
        VEHICLE_ENTITY,
    )
    first, second = flatten_vehicle_entity(entities).collect()
    assert first.asDict() == {
        "feed_type": "vehicle_positions",
        "snapshot_timestamp_utc": "2023-11-14T22:15:00Z",
        "entity_id": "ent-9",
        "vehicle_id": "veh-77",
        "trip_id": "T-1123",
        "route_id": "X4",
        "latitude": 40.81,
        "longitude": -73.77,
        "bearing": 181.5,
        "speed": 6.25,
        "current_stop_sequence": 8,
        "current_status": "STOPPED_AT",
        "timestamp": 1700000300,
    }
    assert [v for k, v in second.asDict().items() if v is not None] == [
        "vehicle_positions",
        "2023-11-14T22:15:00Z",
    ]


def test_trip_update_entity(spark):
    stop = ("S-5", 4, (1700000600, 120), (1700000640, 180))
    entities = spark.createDataFrame(
        [
            ("upd-1", (("T-610", "X9"), ("veh-12",), [stop, ("", None, None, None)], 1700000500), "s"),
            ("upd-2", (("T-611", "X9"), None, None, None), "s"),
            ("vehicle", None, "s"),
        ],
        TRIP_UPDATE_ENTITY,
    )
    first, second = flatten_trip_update_entity(entities).collect()
    assert (first.trip_id, first.route_id, first.vehicle_id, first.timestamp) == (
        "T-610", "X9", "veh-12", 1700000500)
    assert first.stop_time_updates[0].asDict() == {
        "stop_id": "S-5",
        "stop_sequence": 4,
        "arrival_time": 1700000600,
        "arrival_delay": 120,
        "departure_time": 1700000640,
        "departure_delay": 180,
    }
    assert set(first.stop_time_updates[1]) == {None}
    assert second.stop_time_updates == []


def test_replace_sink_counts_and_replaces(spark, tmp_path):
    target = str(tmp_path / "t")
    assert replace_sink(spark.range(10), target, as_path=True) == 10
    assert replace_sink(spark.range(3), target, as_path=True) == 3
    assert spark.read.parquet(target).count() == 3
    assert replace_sink(spark.range(0), target, as_path=True) == 0


def test_replace_sink_tables_and_touched_partitions(spark):
    def days(*pairs):
        return spark.createDataFrame(list(pairs), "n int, snapshot_date string")

    replace_sink(days((1, "a"), (2, "b")), "sink_test", partition_by=["snapshot_date"])
    written = replace_sink(days((3, "b")), "sink_test", only_touched_partitions=True)
    assert written == 1
    assert sorted(r["n"] for r in spark.table("sink_test").collect()) == [1, 3]
    replace_sink(days((4, "c")), "sink_test", partition_by=["snapshot_date"])
    assert [r["n"] for r in spark.table("sink_test").collect()] == [4]


def test_capture_reports(rows):
    records = rows(
        "snapshot_folder string, snapshot_timestamp_utc string, feed_type string",
        ("s1", "t", L.VEHICLE_FEED),
        ("s1", "t", L.TRIP_UPDATE_FEED),
        ("s1", "t", L.TRIP_UPDATE_FEED),
        ("s2", "t", L.TRIP_UPDATE_FEED),
    )
    audit = {r["snapshot_folder"]: tuple(r)[2:] for r in capture_audit(records).collect()}
    assert audit == {"s1": (1, 2), "s2": (0, 1)}
    runs = rows("status string", ("succeeded",), ("failed",), ("succeeded",), (None,))
    assert tuple(capture_status_summary(runs).first()) == (4, 2, 2)


def test_stored_raw_tables_are_replaced_day_by_day(spark, tmp_path, write_snapshot):
    write_feed(tmp_path / "static" / "extracted")
    for folder in ("snapshot_20231114_221000", "snapshot_20231115_000000", "snapshot_20231115_001000"):
        record = {"entity_id": folder[-6:], "snapshot_timestamp_utc": "2023-11-14T22:10:00Z"}
        write_snapshot(tmp_path / "realtime", folder, vehicle_positions=[record])
    roots = str(tmp_path / "static" / "extracted"), str(tmp_path / "realtime"), str(tmp_path / "raw")
    first = load_raw(spark, *roots, end="snapshot_20231114_999999")
    assert first["raw_vehicle_positions"] == 1 and first["raw_trip_updates"] == 0
    second = load_raw(spark, *roots, start="snapshot_20231115", only_touched_days=True)
    assert second["raw_vehicle_positions"] == 2 and second["raw_routes"] == 1
    raw = open_raw(spark, roots[2])
    assert raw[L.VEHICLE_FEED].count() == 3 and raw[L.TRIP_UPDATE_FEED].count() == 0
    assert open_raw(spark, roots[2], start="snapshot_20231115_000500")[L.VEHICLE_FEED].count() == 1
    quality = Models(raw)["fct_feed_quality"]
    assert {r.feed_quality_status for r in quality.collect()} == {"critical"}


def test_load_to_marts_end_to_end(spark, tmp_path, write_snapshot):
    write_feed(tmp_path / "static" / "extracted")
    captured = {"snapshot_timestamp_utc": "2023-11-14T22:10:00.250000Z", "route_id": "Q7"}
    update = {
        "entity_id": "T-11",
        "trip_id": "T-11",
        "stop_time_updates": [{"stop_id": "S-81", "stop_sequence": 1, "arrival_delay": 90}],
    }
    write_snapshot(
        tmp_path / "realtime",
        "snapshot_20231114_221000",
        vehicle_positions=[{**captured, "entity_id": "bus-3"}],
        trip_updates=[{**captured, **update}],
    )
    raw = load_schedule(spark, str(tmp_path / "static" / "extracted"))
    for feed in (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED):
        raw[feed] = scan_snapshots(spark, str(tmp_path / "realtime"), feed)
    models = Models(raw)
    counts = materialize_layers(models, str(tmp_path / "marts"))
    assert counts["fct_feed_quality"] == counts["fct_on_time_performance"] == counts["dim_route"] == 1
    mart = spark.table("fct_on_time_performance").first()
    assert (mart.estimated_delay_minutes, mart.delay_band, mart.on_time_flag) == (1.5, "on_time", True)
    assert spark.table("quality_null_gps").count() == 1
    partitions = [p.name for p in (tmp_path / "marts" / "fct_feed_quality").iterdir() if p.is_dir()]
    assert partitions == ["snapshot_date=20231114"]


def small_feeds(spark):
    """A schedule, and three hourly snapshots on two days with a repeated entity and a trip that is not scheduled."""
    taken = "timestamp '2024-01-01 22:00:00' + make_dt_interval(0, id div 4) AS snapshot_timestamp_utc"
    folder = "date_format(snapshot_timestamp_utc, \"'snapshot_'yyyyMMdd_HHmmss\") AS snapshot_folder"
    both = spark.range(12).selectExpr("id", taken).selectExpr("*", folder).selectExpr(
        "*", "'E' || id % 3 AS entity_id", "'t' || id % 3 AS trip_id", "'r' AS route_id", "'b' || id AS vehicle_id", "id * 60 AS timestamp")
    place = ["IF(id = 5, NULL, 40.5D) AS latitude", "-74D AS longitude", "0D AS bearing", "1D AS speed",
             "1L AS current_stop_sequence", "'STOPPED_AT' AS current_status"]
    stops = """'[{"stop_id":"p","stop_sequence":1,"arrival_delay":' || id * 600 || '}]' AS stop_time_updates"""
    one = spark.range(2)
    return {
        "routes": spark.range(1).selectExpr("'f' AS source_feed", "'r' AS route_id", "'a' AS agency_id", "'R' AS route_short_name",
                                            "'R' AS route_long_name", "'3' AS route_type"),
        "trips": one.selectExpr("'r' AS route_id", "'w' AS service_id", "'t' || id AS trip_id", "'h' AS trip_headsign",
                                "'0' AS direction_id", "'s' AS shape_id"),
        "stops": spark.range(1).selectExpr("'f' AS source_feed", "'p' AS stop_id", "'P' AS stop_name", "40.5D AS stop_lat", "-74D AS stop_lon"),
        "stop_times": one.selectExpr("'f' AS source_feed", "'t' || id AS trip_id", "'18:00:00' AS arrival_time", "'18:01:00' AS departure_time",
                                     "'p' AS stop_id", "'1' AS stop_sequence", "'0' AS pickup_type", "'0' AS drop_off_type", "'1' AS timepoint"),
        L.VEHICLE_FEED: both.selectExpr("*", *place),
        L.TRIP_UPDATE_FEED: both.selectExpr("*", stops),
    }


def test_marts_of_one_run_share_the_pass_over_the_feeds(spark, tmp_path):
    def built(folder, **options):
        models = Models(small_feeds(spark))
        materialize_layers(models, str(tmp_path / folder), register_views=False, **options)
        return models

    def reads(df, table):
        return any(f"/{table}/" in file for file in df.inputFiles())

    models, composed = built("whole"), Models(small_feeds(spark))
    # The keys of the snapshots are written once and read by the findings; the view reads the mart that keeps its rows.
    assert reads(models.fct_anomaly_findings, "whole/_snapshot_keys")
    assert reads(models["feed_quality_summary"], "whole/fct_feed_quality")
    for name, rows in (("feed_quality_summary", 3), ("fct_feed_quality", 3), ("fct_anomaly_findings", None)):
        mine, own = models[name], composed[name]
        assert mine.schema.simpleString() == own.schema.simpleString()
        assert mine.count() == own.count() == (rows or own.count()) > 0
        assert mine.exceptAll(own).isEmpty()
    # Marts of some days alone do not stand for the summary of all that was opened.
    some = built("days", days=["20240102"])
    assert not reads(some["feed_quality_summary"], "fct_feed_quality")
    assert (some["feed_quality_summary"].count(), some["fct_feed_quality"].count()) == (3, 1)


def test_snapshots_that_share_a_partition_do_not_make_small_files(spark, tmp_path):
    path = str(tmp_path / "mixed")
    records = spark.range(0, 2_050, numPartitions=1).selectExpr(
        "IF(id = 0, 'snapshot_20240101_230000', concat('snapshot_2024010', 1 + id % 5, '_000000')) AS snapshot_folder",
        "'a' || id AS entity_id", "id % 3 AS n",
    )
    write_snapshot_arrays(records, path, max_records=100)
    sizes = spark.read.text(path, wholetext=True).selectExpr("size(from_json(value, 'array<struct<entity_id string>>')) AS n")
    found = sorted(row.n for row in sizes.collect())
    # 409 or 410 records of each of five snapshots, one of a sixth.
    assert sum(found) == 2_050 and len(found) == 26 and found[0] == 1 and set(found[1:]) <= {81, 82}
    again = spark.read.text(path, wholetext=True).selectExpr("explode(from_json(value, 'array<struct<entity_id string>>')) AS r")
    assert again.select("r.entity_id").distinct().count() == 2_050


def test_written_arrays_are_compressed(spark, tmp_path):
    path = str(tmp_path / "out")
    records = spark.range(500).selectExpr("'snapshot_20240101_000000' AS snapshot_folder", "concat('e', id) AS entity_id")
    write_snapshot_arrays(records, path)
    plain = spark.read.text(path, wholetext=True).selectExpr("sum(length(value))").first()[0]
    stored = capture_files(spark, f"{path}/*/*").agg(F.sum("byte_count")).first()[0]
    assert stored * 3 < plain and scan_snapshots(spark, path, L.VEHICLE_FEED, pattern="*/*").count() == 500
