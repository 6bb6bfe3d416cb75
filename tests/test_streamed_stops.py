"""The written capture files carry the stop updates, so the stream finds what the batch finds."""

from pathlib import Path

import pytest

from fleetgauge.labels import TRIP_UPDATE_FEED
from fleetgauge.operators.delay import realtime_stop_time_updates
from fleetgauge.plans.catalog import CATALOG
from fleetgauge.plans.derived_files import capture_files_folder
from fleetgauge.sources import star_tables
from fleetgauge.sources.snapshots import scan_snapshots
from oracle.compare import connect, difference
from oracle.feeds import DAILY
from oracle.statements import with_tables

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_streamed_findings_are_all_findings(spark):
    found = CATALOG["streamed_findings"](spark, FOLDER).cache()
    assert not found.where("detector_rule_id = 'rule_extreme_delay'").isEmpty()
    connection = connect(FOLDER)
    assert difference(found, connection, with_tables("FROM fct_anomaly_findings", DAILY)) == ""
    connection.close()


def test_captured_stop_updates_are_those_of_the_batch(spark):
    captured = scan_snapshots(
        spark, capture_files_folder(spark, FOLDER), TRIP_UPDATE_FEED, pattern=f"{TRIP_UPDATE_FEED}/*/*"
    )
    assert captured.count() == star_tables.raw_trip_updates(spark, FOLDER).count()
    names = ["entity_id", "trip_id", "route_id", "vehicle_id", "stop_id", "stop_sequence", "arrival_time_utc",
             "arrival_delay_seconds", "departure_time_utc", "departure_delay_seconds"]
    streamed = realtime_stop_time_updates(captured).select(names)
    batch = realtime_stop_time_updates(star_tables.raw_trip_update_stops(spark, FOLDER)).select(names)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_an_order_with_very_many_lines_becomes_several_records(spark, tmp_path):
    for name in ("events", "lineitem"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    many = spark.range(1, 25_001).selectExpr("int(id) AS l_linenumber").crossJoin(lines.where("l_orderkey = 3").limit(1).drop("l_linenumber"))
    lines.where("l_orderkey <> 3").unionByName(many.select(lines.columns)).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    sizes = star_tables.raw_trip_updates_with_stops(spark, str(tmp_path)).selectExpr("trip_id", "size(stop_time_updates) AS n")
    found = sorted(r.n for r in sizes.where("trip_id = 'T3'").collect())
    assert len(found) == 3 and max(found) <= 2 * star_tables.LINES_OF_A_RECORD and sum(found) >= 25_000
