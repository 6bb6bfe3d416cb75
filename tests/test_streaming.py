from pyspark.sql import functions as F

from fleetgauge import labels as L
from fleetgauge.plans.models import Models
from fleetgauge.session import together
from fleetgauge.sources.snapshots import empty_source_schema, scan_snapshots
from fleetgauge.streaming.snapshot_stream import (
    STREAMED_MARTS,
    SnapshotStore,
    stream_records,
    windowed_record_counts,
)

STATIC = {
    "trips": "trip_id string, route_id string, service_id string, trip_headsign string, direction_id string, "
    "shape_id string",
    "stop_times": "source_feed string, trip_id string, arrival_time string, departure_time string, "
    "stop_id string, stop_sequence string, pickup_type string, drop_off_type string, timepoint string",
}


def schedule(rows):
    trips = rows(STATIC["trips"], *[(f"t{i}", "r", "s", "North", "1", "x") for i in range(3)])
    times = rows(STATIC["stop_times"], *[("f", f"t{i}", "08:00:00", "08:00:00", "p", "1", "", "", "") for i in range(3)])
    return {"trips": trips, "stop_times": times}


def snapshot(write, root, day, time, vehicles=2, feeds=(L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)):
    taken = f"2024-01-{day:02d}T{time[:2]}:{time[2:4]}:00Z"
    content = {
        L.VEHICLE_FEED: [
            {"feed_type": L.VEHICLE_FEED, "snapshot_timestamp_utc": taken, "entity_id": f"v{i % 2}",
             "vehicle_id": f"b{i}", "trip_id": f"t{i}", "route_id": "r", "latitude": 40.5 if i else None,
             "longitude": -74.0, "speed": 5.0, "timestamp": 1704103200 + i * 60}
            for i in range(vehicles)
        ],
        L.TRIP_UPDATE_FEED: [
            {"feed_type": L.TRIP_UPDATE_FEED, "snapshot_timestamp_utc": taken, "entity_id": "u",
             "trip_id": "t1", "route_id": "r", "vehicle_id": "b1", "timestamp": 1704103200,
             "stop_time_updates": [{"stop_id": "p", "stop_sequence": 1, "arrival_delay": 240}]}
        ],
    }
    write(root, f"snapshot_202401{day:02d}_{time}", **{feed: content[feed] for feed in feeds})


def same(left, right):
    columns = sorted(set(left.columns) - {"snapshot_date"})
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_stream_equals_batch_with_late_snapshots(spark, rows, tmp_path, write_snapshot):
    root, static = tmp_path / "capture", schedule(rows)
    store = SnapshotStore(spark, str(tmp_path / "store"), static)

    def arrive():
        query = store.follow(str(root), str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        assert query.exception() is None
        query.stop()

    snapshot(write_snapshot, root, 1, "235500")
    snapshot(write_snapshot, root, 3, "000000", vehicles=4)
    arrive()
    # A day between, later than its successor; and the second feed of a snapshot by itself.
    snapshot(write_snapshot, root, 2, "235800", feeds=[L.VEHICLE_FEED])
    arrive()
    snapshot(write_snapshot, root, 2, "235800", feeds=[L.TRIP_UPDATE_FEED])
    arrive()

    batch = Models({**static, **{feed: scan_snapshots(spark, str(root), feed) for feed in
                                 (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)}})
    for name in STREAMED_MARTS:
        assert same(store.mart(name), batch[name]), name
    gaps = {r.snapshot_folder: r.snapshot_gap_minutes for r in store.mart("fct_feed_quality").collect()}
    assert gaps["snapshot_20240103_000000"] == 2.0


def test_a_batch_run_again_replaces_itself(spark, rows, tmp_path, write_snapshot):
    root = tmp_path / "capture"
    snapshot(write_snapshot, root, 1, "120000")
    store = SnapshotStore(spark, str(tmp_path / "store"), schedule(rows))
    files = spark.read.text(f"{root}/snapshot_*/*.json", wholetext=True).select("value", "_metadata")
    store.add(files, 7)
    store.add(files, 7)
    assert store.records(L.VEHICLE_FEED).count() == 2
    assert store.mart("fct_feed_quality").first().vehicle_record_count == 2


def test_one_file_a_batch_equals_batch(spark, rows, tmp_path, write_snapshot):
    root, static = tmp_path / "capture", schedule(rows)
    for day in (1, 2):
        snapshot(write_snapshot, root, day, "120000")
    store = SnapshotStore(spark, str(tmp_path / "store"), static)
    query = store.follow(str(root), str(tmp_path / "checkpoint"), max_files=1)
    query.awaitTermination(300)
    assert query.exception() is None
    batch = Models({**static, **{feed: scan_snapshots(spark, str(root), feed) for feed in
                                 (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)}})
    for name in STREAMED_MARTS:
        assert same(store.mart(name), batch[name]), name


def test_a_finding_that_no_longer_holds_goes_away(spark, rows, tmp_path, write_snapshot):
    root, static = tmp_path / "capture", schedule(rows)
    store = SnapshotStore(spark, str(tmp_path / "store"), static)
    assert store.mart("fct_anomaly_findings").isEmpty()
    snapshot(write_snapshot, root, 1, "120000", feeds=[L.TRIP_UPDATE_FEED])
    for batch_id, feeds in enumerate(([], [L.VEHICLE_FEED])):
        if feeds:
            snapshot(write_snapshot, root, 1, "120000", feeds=feeds)
        pattern = f"{root}/snapshot_*/{feeds[0] if feeds else L.TRIP_UPDATE_FEED}.json"
        files = spark.read.text(pattern, wholetext=True).select("value", "_metadata")
        store.add(files, batch_id)
        batch = Models({**static, **{feed: scan_snapshots(spark, str(root), feed) for feed in
                                     (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)}})
        for name in STREAMED_MARTS:
            assert same(store.mart(name), batch[name]), (batch_id, name)


def test_nothing_stored_yet(spark, rows, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"), schedule(rows))
    records = store.records(L.TRIP_UPDATE_FEED)
    assert records.count() == 0 and "snapshot_date" in records.columns
    assert records.drop("snapshot_date").schema == empty_source_schema(spark, L.TRIP_UPDATE_FEED).schema


def test_windowed_counts(spark, tmp_path, write_snapshot):
    root = tmp_path / "capture"
    for day, time in ((1, "120000"), (1, "120500"), (1, "121000"), (2, "120000")):
        snapshot(write_snapshot, root, day, time)
    counts = windowed_record_counts(stream_records(spark, str(root), L.VEHICLE_FEED))
    query = (
        counts.writeStream.format("memory").queryName("window_counts").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    found = spark.table("window_counts").orderBy("window_start").collect()
    # The last window stays open: no later record has closed it.
    assert [(r.window_start.minute, r.record_count) for r in found] == [(0, 4), (10, 2)]
    assert spark.table("window_counts").where(F.col("feed_type") != L.VEHICLE_FEED).isEmpty()


def test_a_batch_reads_its_snapshots_and_their_successors_only(spark, rows, tmp_path, write_snapshot, monkeypatch):
    root, static = tmp_path / "capture", schedule(rows)
    store = SnapshotStore(spark, str(tmp_path / "store"), static)

    def add(batch_id, day, time):
        snapshot(write_snapshot, root, day, time)
        folder = f"snapshot_202401{day:02d}_{time}"
        store.add(spark.read.text(f"{root}/{folder}/*.json", wholetext=True).select("value", "_metadata"), batch_id)
        return folder

    times = [(1, "120000"), (1, "121000"), (2, "000500"), (2, "120000"), (4, "120000")]
    for batch_id, (day, time) in enumerate(times):
        add(batch_id, day, time)
    opened = set()
    read = SnapshotStore._read

    def spied(self, name, schema, snapshots):
        found = read(self, name, schema, snapshots)
        if found is not None and self is store:
            opened.update(part for file in found.inputFiles() for part in file.split("/") if part.startswith("snapshot_folder="))
        return found

    monkeypatch.setattr(SnapshotStore, "_read", spied)
    late = add(9, 1, "235500")
    assert opened == {f"snapshot_folder={late}", "snapshot_folder=snapshot_20240102_000500"}
    monkeypatch.undo()
    batch = Models({**static, **{feed: scan_snapshots(spark, str(root), feed) for feed in
                                 (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)}})
    for name in STREAMED_MARTS:
        assert same(store.mart(name), batch[name]), name
    gaps = {r.snapshot_folder: r.snapshot_gap_minutes for r in store.mart("fct_feed_quality").collect()}
    assert gaps["snapshot_20240102_000500"] == 10.0 and gaps[late] == 705.0


def test_a_batch_counts_what_violates_the_checks(spark, rows, tmp_path, write_snapshot):
    root = tmp_path / "capture"
    write_snapshot(root, "snapshot_20240101_120000", **{L.VEHICLE_FEED: [{"entity_id": None}, {"entity_id": "a"}]})
    store = SnapshotStore(spark, str(tmp_path / "store"), schedule(rows))
    store.add(spark.read.text(f"{root}/*/*.json", wholetext=True).select("value", "_metadata"), 0)
    assert store.violations[L.VEHICLE_FEED] == {"not_null(snapshot_timestamp_utc)": 2, "not_null(entity_id)": 1}
    assert store.records(L.VEHICLE_FEED).count() == 2 and store.mart("fct_feed_quality").count() == 1


def test_a_catch_up_refreshes_once_and_equals_batch(spark, rows, tmp_path, write_snapshot, monkeypatch):
    root, static = tmp_path / "capture", schedule(rows)
    for day in (1, 2, 3):
        snapshot(write_snapshot, root, day, "120000")
    store = SnapshotStore(spark, str(tmp_path / "store"), static)
    calls, refresh = [], SnapshotStore.refresh

    def failing(self, snapshots):
        calls.append(sorted(snapshots))
        if len(calls) == 1:
            raise OSError("lost")
        refresh(self, snapshots)

    monkeypatch.setattr(SnapshotStore, "refresh", failing)
    try:
        store.catch_up(str(root), str(tmp_path / "checkpoint"), max_files=1)
    except OSError:
        pass
    # Nothing new has come, but what was not refreshed is.
    store.catch_up(str(root), str(tmp_path / "checkpoint"), max_files=1)
    store.refresh_pending()
    assert calls == [[f"snapshot_2024010{day}_120000" for day in (1, 2, 3)]] * 2
    batch = Models({**static, **{feed: scan_snapshots(spark, str(root), feed) for feed in
                                 (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)}})
    for name in STREAMED_MARTS:
        assert same(store.mart(name), batch[name]), name


def test_a_catch_up_over_more_snapshots_than_it_refreshes_at_once(spark, rows, tmp_path, write_snapshot, monkeypatch):
    from fleetgauge.streaming import snapshot_stream

    monkeypatch.setattr(snapshot_stream, "REFRESHED_AT_ONCE", 2)
    root, static = tmp_path / "capture", schedule(rows)
    for day in (1, 2, 3):
        snapshot(write_snapshot, root, day, "120000")
    store = SnapshotStore(spark, str(tmp_path / "store"), static)
    store.catch_up(str(root), str(tmp_path / "checkpoint"))
    batch = Models({**static, **{feed: scan_snapshots(spark, str(root), feed) for feed in
                                 (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)}})
    for name in STREAMED_MARTS:
        assert same(store.mart(name), batch[name]), name


def test_a_catch_up_writes_the_table_of_snapshots_once(spark, rows, tmp_path, write_snapshot, monkeypatch):
    root, static = tmp_path / "capture", schedule(rows)
    for day in (1, 2, 3):
        snapshot(write_snapshot, root, day, "120000")
    store = SnapshotStore(spark, str(tmp_path / "store"), static)
    written, remember = [], SnapshotStore._remember

    def counted(self, added):
        written.append(len(added))
        remember(self, added)

    monkeypatch.setattr(SnapshotStore, "_remember", counted)
    store.catch_up(str(root), str(tmp_path / "checkpoint"), max_files=1)
    # Six batches, each of one snapshot of one feed.
    assert written == [6]
    known = store._known({f"2024010{day}" for day in (1, 2, 3)})
    assert sorted(batch for _, _, _, batch in known) == list(range(6)) and None not in {time for _, _, time, _ in known}
    assert [path.name for path in (tmp_path / "store" / "pending").iterdir() if not path.name.startswith(".")] == []
    assert not (tmp_path / "store" / "keys").exists()


def test_a_batch_after_a_lost_refresh_knows_the_snapshots_before_it(spark, rows, tmp_path, write_snapshot, monkeypatch):
    root, static = tmp_path / "capture", schedule(rows)
    for day in (1, 2):
        snapshot(write_snapshot, root, day, "120000")
    store = SnapshotStore(spark, str(tmp_path / "store"), static)
    with monkeypatch.context() as lost:
        lost.setattr(SnapshotStore, "refresh_pending", lambda self: None)
        store.catch_up(str(root), str(tmp_path / "checkpoint"), max_files=1)
    snapshot(write_snapshot, root, 2, "123000")
    store.add(spark.read.text(f"{root}/snapshot_20240102_123000/*.json", wholetext=True).select("value", "_metadata"), 99)
    assert [row.snapshot_gap_minutes for row in store.mart("fct_feed_quality").collect()] == [30.0]
    store.refresh_pending()
    batch = Models({**static, **{feed: scan_snapshots(spark, str(root), feed) for feed in
                                 (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)}})
    for name in STREAMED_MARTS:
        assert same(store.mart(name), batch[name]), name


def test_findings_of_a_refresh_read_the_keys_that_feed_quality_read(spark, rows, tmp_path, write_snapshot, monkeypatch):
    from fleetgauge.streaming import snapshot_stream

    root, opened = tmp_path / "capture", {}
    snapshot(write_snapshot, root, 1, "120000")
    replace = snapshot_stream.replace_snapshots

    def spied(df, path, snapshots):
        opened[path.rpartition("/")[2]] = " ".join(df.inputFiles())
        return replace(df, path, snapshots)

    monkeypatch.setattr(snapshot_stream, "replace_snapshots", spied)
    store = SnapshotStore(spark, str(tmp_path / "store"), schedule(rows))
    store.add(spark.read.text(f"{root}/*/*.json", wholetext=True).select("value", "_metadata"), 0)
    for name in ("fct_feed_quality", "fct_anomaly_findings"):
        assert "/store/keys/" in opened[name] and f"/store/{L.TRIP_UPDATE_FEED}/" not in opened[name], name


def test_a_catch_up_lists_its_files_by_a_task_a_core(spark, rows, tmp_path, write_snapshot, monkeypatch):
    root, setting = tmp_path / "capture", "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    snapshot(write_snapshot, root, 1, "120000")
    before, during, follow = spark.conf.get(setting), [], SnapshotStore.follow

    def spied(self, *place, **options):
        during.append(int(spark.conf.get(setting)))
        return follow(self, *place, **options)

    monkeypatch.setattr(SnapshotStore, "follow", spied)
    SnapshotStore(spark, str(tmp_path / "store"), schedule(rows)).catch_up(str(root), str(tmp_path / "checkpoint"))
    assert during == [spark.sparkContext.defaultParallelism] and spark.conf.get(setting) == before


def test_steps_side_by_side_belong_to_the_caller_and_end_before_an_error_shows(spark):
    def group():
        return spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    done = []

    def failing():
        raise OSError("lost")

    spark.sparkContext.setJobGroup("of the caller", "")
    try:
        assert together(spark, group, lambda: spark.range(3).count()) == ["of the caller", 3]
        try:
            together(spark, failing, lambda: done.append(spark.range(5).count()))
        except OSError:
            done.append("error")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert done == [5, "error"]
