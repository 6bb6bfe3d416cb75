"""Every operator as a named query over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge import labels as L
from fleetgauge.operators import anomaly, assertions, capture, delay, evaluation, reports
from fleetgauge.plans.checks import CHECKS, check_suite
from fleetgauge.plans.derived_files import capture_files_folder, quoted_stop_times, schedule_folder
from fleetgauge.plans.load import load_raw, open_days, open_rejects, open_stop_updates, store_stop_updates
from fleetgauge.plans.models import Models, materialize_layers
from fleetgauge.session import configure, new_scratch_path
from fleetgauge.sources import entities, schedule, snapshots, star_tables
from fleetgauge.sources.tables import read_days, replace_sink, stored_days
from fleetgauge.streaming.snapshot_stream import SnapshotStore, windowed_record_counts

Query = Callable[[SparkSession, str], DataFrame]

# Snapshots of the test tables are hourly, so an hour between two is not late.
HOURLY_GAP_MINUTES = 60.0


def star_models(spark: SparkSession, folder: str, **replaced: DataFrame) -> Models:
    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: getattr(star_tables, f"raw_{name}")(spark, folder)

    names = (*L.REQUIRED_TABLES, L.VEHICLE_FEED, L.TRIP_UPDATE_FEED, "trip_update_stops")
    raw = {name: reader(name) for name in names}
    return Models({**raw, **replaced}, max_gap_minutes=HOURLY_GAP_MINUTES)


def _comparable(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    """Zone-less timestamps, and averages without the digits that depend on summation order."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            changed[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif field.name in rounded:
            changed[field.name] = F.round(field.name, 6)
    return df.withColumns(changed) if changed else df


# Averages and deviations; everything else is exact.
ROUNDED = (
    "avg_estimated_delay_minutes",
    "estimated_delay_minutes",
    "delay_minutes_abs",
    "avg_vehicle_spacing_minutes",
    "headway_variance_minutes",
    "avg_plausible_delay_minutes",
    "avg_null_gps_rate",
    "avg_duplicate_trip_update_rate",
    "avg_unmatched_realtime_trip_rate",
    "gap_minutes",
    "anomaly_score",
)

CATALOG: dict[str, Query] = {}


def _query(name: str, rounded: tuple[str, ...] = ROUNDED) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return _comparable(build(spark, folder.rstrip("/")), rounded)

        CATALOG[name] = run
        return build

    return register


def _over_models(
    name: str, build: Callable[[Models], DataFrame], rounded: tuple[str, ...] = ROUNDED
) -> None:
    _query(name, rounded)(lambda spark, folder: build(star_models(spark, folder)))


# --- Scans and sinks -------------------------------------------------------------------------


@_query("scan_static_csv")
def _(spark, folder):
    layout = schedule.resolve_feed_layout(spark, schedule_folder(spark, folder))
    return schedule.scan_static_csv(spark, [f"{path}/stop_times.txt" for path in layout.values()])


@_query("scan_quoted_csv")
def _(spark, folder):
    """Stop times whose headsigns go over several lines."""
    return schedule.scan_static_csv(spark, quoted_stop_times(spark, folder))


@_query("tag_source_feed")
def _(spark, folder):
    layout = schedule.resolve_feed_layout(spark, schedule_folder(spark, folder))
    files = schedule.scan_static_csv(spark, [f"{path}/trips.txt" for path in layout.values()])
    return schedule.tag_source_feed(files, schedule.feed_from_path(F.col("_metadata.file_path"), "trips"))


@_query("union_feeds_by_name")
def _(spark, folder):
    """One feed's stops lack their names."""
    layout = schedule.resolve_feed_layout(spark, schedule_folder(spark, folder))
    frames = []
    for feed, path in layout.items():
        stops = schedule.scan_static_csv(spark, f"{path}/stops.txt")
        if feed == "bronx":
            stops = stops.drop("stop_name")
        frames.append(schedule.tag_source_feed(stops, feed))
    return schedule.union_feeds_by_name(frames)


@_query("resolve_feed_layout")
def _(spark, folder):
    """The root also has flat files; the feeds win and are counted per feed."""
    tables = schedule.load_schedule(spark, f"{schedule_folder(spark, folder)}/extracted")
    return tables["trips"].groupBy("source_feed").agg(F.count(F.lit(1)).alias("trip_count"))


def _rows_per_feed(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.groupBy("source_feed")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("source_feed", F.lit(table).alias("table_name"), "row_count")
        for table, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@_query("check_required_tables")
def _(spark, folder):
    """Files that a feed lacks; calendar is asked for here, which only one has."""
    layout = schedule.resolve_feed_layout(spark, schedule_folder(spark, folder))
    schedule.check_required_tables(spark, layout)
    present = schedule.list_schedule_files(spark, layout)
    return schedule.missing_required_tables(present, list(layout), (*L.REQUIRED_TABLES, "calendar"))


@_query("optional_tables")
def _(spark, folder):
    return _rows_per_feed(schedule.load_schedule(spark, schedule_folder(spark, folder)))


@_query("scan_snapshots")
def _(spark, folder):
    return snapshots.scan_snapshots(
        spark, capture_files_folder(spark, folder), L.VEHICLE_FEED, pattern=f"{L.VEHICLE_FEED}/*/*"
    )


@_query("snapshot_lineage")
def _(spark, folder):
    records = snapshots.scan_snapshots(
        spark, capture_files_folder(spark, folder), L.TRIP_UPDATE_FEED, pattern=f"{L.TRIP_UPDATE_FEED}/*/*"
    )
    return records.select("snapshot_folder", "entity_id", "trip_id")


@_query("snapshot_range")
def _(spark, folder):
    """The snapshots of the second and third week of January 2024, both ends included."""
    stored = new_scratch_path(spark, "snapshot-range")
    raw = star_tables.raw_vehicle_positions(spark, folder, iso_text=True)
    replace_sink(snapshots.with_snapshot_date(raw), stored, as_path=True, partition_by=("snapshot_date",))
    table = spark.read.schema(f"{_ddl(raw)}, snapshot_date string").parquet(stored)
    picked = snapshots.snapshot_range(table, "snapshot_20240108_000000", "snapshot_20240121_230000")
    return picked.drop("snapshot_date")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


@_query("nested_to_json")
def _(spark, folder):
    native = star_tables.raw_trip_update_stops(spark, folder, native=True)
    return snapshots.nested_to_json(native).select("trip_id", "snapshot_folder", "stop_time_updates")


@_query("empty_source_schema")
def _(spark, folder):
    """A capture without snapshots still has typed columns, to which later records are added."""
    empty = snapshots.empty_source_schema(spark, L.VEHICLE_FEED)
    return empty.unionByName(star_tables.raw_vehicle_positions(spark, folder, iso_text=True))


@_query("replace_sink")
def _(spark, folder):
    """The second write replaces the first."""
    target = new_scratch_path(spark, "replace-sink")
    models = star_models(spark, folder)
    replace_sink(models.stg_vehicle_positions.select("snapshot_folder", "entity_id"), target, as_path=True)
    replace_sink(models.stg_trip_updates.select("snapshot_folder", "entity_id"), target, as_path=True)
    return spark.read.parquet(target)


@_query("load_raw")
def _(spark, folder):
    """Schedule and snapshot files into stored raw tables."""
    counts = load_raw(
        spark,
        schedule_folder(spark, folder),
        capture_files_folder(spark, folder),
        new_scratch_path(spark, "raw"),
        patterns={feed: f"{feed}/*/*" for feed in (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)},
    )
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


@_query("materialize_layers")
def _(spark, folder):
    models = star_models(spark, folder)
    counts = materialize_layers(models, new_scratch_path(spark, "layers"), register_views=False)
    return spark.createDataFrame(list(counts.items()), "model string, row_count bigint")


@_query("flatten_vehicle_entity")
def _(spark, folder):
    return entities.flatten_vehicle_entity(star_tables.vehicle_entities(spark, folder))


@_query("flatten_trip_update_entity")
def _(spark, folder):
    records = entities.flatten_trip_update_entity(star_tables.trip_update_entities(spark, folder))
    return snapshots.nested_to_json(records)


def _all_records(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["feed_type", "snapshot_folder", "snapshot_timestamp_utc"]
    vehicles = star_tables.raw_vehicle_positions(spark, folder).select(*columns)
    return vehicles.unionByName(star_tables.raw_trip_updates(spark, folder).select(*columns))


@_query("capture_audit")
def _(spark, folder):
    return capture.capture_audit(_all_records(spark, folder))


@_query("capture_files")
def _(spark, folder):
    """Snapshots for which files of some feed are there."""
    files = capture.capture_files(spark, f"{capture_files_folder(spark, folder)}/*/*/*")
    return files.where("byte_count > 2").select("snapshot_folder").distinct()


@_query("capture_status_summary")
def _(spark, folder):
    """A snapshot counts as a success if it got records of both feeds."""
    audit = capture.capture_audit(_all_records(spark, folder))
    complete = (F.col("vehicle_record_count") > 0) & (F.col("trip_update_record_count") > 0)
    runs = audit.select(F.when(complete, "succeeded").otherwise("failed").alias("status"))
    return capture.capture_status_summary(runs)


@_query("expected_snapshots")
def _(spark, folder):
    return capture.expected_snapshots(_all_records(spark, folder), interval_minutes=60)


@_query("missing_snapshot_slots")
def _(spark, folder):
    return capture.missing_snapshot_slots(_all_records(spark, folder), interval_minutes=60)


# --- Streams ---------------------------------------------------------------------------------


@_query("windowed_record_counts")
def _(spark, folder):
    """The windowed counts of a stream, here over all records at once."""
    return windowed_record_counts(_all_records(spark, folder), window="6 hours")


@_query("marts_by_day")
def _(spark, folder):
    """Raw snapshots loaded at once, feed quality built in two halves of the days, the later one first."""
    root, marts = new_scratch_path(spark, "raw"), new_scratch_path(spark, "marts")
    captured = capture_files_folder(spark, folder)
    patterns = {feed: f"{feed}/*/*" for feed in (L.VEHICLE_FEED, L.TRIP_UPDATE_FEED)}
    load_raw(spark, schedule_folder(spark, folder), captured, root, patterns=patterns)
    days = sorted(stored_days(spark, f"{root}/raw_{L.VEHICLE_FEED}") | stored_days(spark, f"{root}/raw_{L.TRIP_UPDATE_FEED}"))
    for half in (days[len(days) // 2 :], days[: len(days) // 2]):
        models = Models(open_days(spark, root, half), max_gap_minutes=HOURLY_GAP_MINUTES)
        materialize_layers(models, marts, ["fct_feed_quality"], days=half, register_views=False)
    schema = T.StructType([*models["fct_feed_quality"].schema.fields]).add("snapshot_date", "string")
    return read_days(spark, f"{marts}/fct_feed_quality", schema).drop("snapshot_date")


def _streamed(spark: SparkSession, folder: str, **options) -> SnapshotStore:
    """The daily snapshot files, stored and summed up by a stream over them."""
    store = SnapshotStore(
        spark,
        new_scratch_path(spark, "stream-store"),
        {
            "trips": star_tables.raw_trips(spark, folder),
            "stop_times": star_tables.raw_stop_times(spark, folder),
        },
        {"max_gap_minutes": HOURLY_GAP_MINUTES},
    )
    store.catch_up(
        capture_files_folder(spark, folder),
        new_scratch_path(spark, "stream-checkpoint"),
        # Folders, of which each is listed once; a pattern of files would be listed file by file.
        pattern=f"{{{L.VEHICLE_FEED},{L.TRIP_UPDATE_FEED}}}/*",
        **options,
    )
    return store


@_query("streamed_feed_quality")
def _(spark, folder):
    return _streamed(spark, folder).mart("fct_feed_quality").drop("snapshot_date")


@_query("streamed_findings")
def _(spark, folder):
    """Findings of the same stream, its files taken in several batches."""
    store = _streamed(spark, folder, max_files=100)
    return store.mart("fct_anomaly_findings").drop("snapshot_date")


def _partly_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Trip updates some of whose texts are cut off, or no array."""
    return star_tables.raw_trip_updates(spark, folder).selectExpr(
        "* EXCEPT (stop_time_updates)",
        """CASE right(trip_id, 1) WHEN '2' THEN '{"stop_id": "P1"}' WHEN '4' THEN '[{"stop_id": "P1"'
        WHEN '6' THEN '[{"stop_id": "P1"}]' WHEN '8' THEN '[]' END AS stop_time_updates""",
    )


@_query("unreadable_stop_updates")
def _(spark, folder):
    bad = delay.unreadable_stop_updates(_partly_unreadable(spark, folder))
    return bad.select("snapshot_folder", "trip_id", "stop_time_updates")


@_query("stop_updates_with_rejects")
def _(spark, folder):
    """Stop updates and rejected trip updates as stored in one pass, read back apart."""
    stored = new_scratch_path(spark, "stop-updates")
    store_stop_updates(star_models(spark, folder, trip_updates=_partly_unreadable(spark, folder)).stg_trip_updates, stored)
    columns = ["snapshot_folder", "trip_id"]
    accepted = open_stop_updates(spark, stored).select(*columns, "stop_id", F.lit(None).cast("string").alias("rejected_text"))
    rejected = open_rejects(spark, stored).select(*columns, F.lit(None).cast("string").alias("stop_id"), "rejected_text")
    return accepted.union(rejected)


# --- Staging ---------------------------------------------------------------------------------

for _name in ("stg_routes", "stg_trips", "stg_stops", "stg_stop_times"):
    _over_models(_name, lambda m, name=_name: m[name])


@_query("stg_vehicle_positions")
def _(spark, folder):
    raw = star_tables.raw_vehicle_positions(spark, folder, iso_text=True)
    return star_models(spark, folder, vehicle_positions=raw).stg_vehicle_positions


@_query("stg_trip_updates")
def _(spark, folder):
    raw = star_tables.raw_trip_updates(spark, folder, iso_text=True)
    return star_models(spark, folder, trip_updates=raw).stg_trip_updates


# --- Models ----------------------------------------------------------------------------------

for _name in (
    "realtime_stop_time_updates",
    "scheduled_stop_times_normalized",
    "trip_schedule_vs_actual",
    "quality_null_gps",
    "quality_duplicate_vehicle_entities",
    "quality_duplicate_trip_update_entities",
    "quality_realtime_trip_referential_integrity",
    "quality_snapshot_freshness",
    "feed_quality_summary",
    "dim_route",
    "dim_stop",
    "fct_feed_quality",
    "fct_route_realtime_activity",
    "fct_on_time_performance",
    "fct_headway",
    "fct_anomaly_findings",
    "synthetic_anomaly_evaluation",
    "rule_based_anomaly_detection",
    "anomaly_detection_metrics",
):
    _over_models(_name, lambda m, name=_name: m[name])


@_query("realtime_stop_time_updates_native")
def _(spark, folder):
    raw = star_tables.raw_trip_update_stops(spark, folder, native=True)
    return star_models(spark, folder, trip_update_stops=raw).realtime_stop_time_updates


_over_models("stop_time_schedule_vs_actual", lambda m: m.stop_time_schedule_vs_actual, rounded=())
_STOP_KEY = ["snapshot_folder", "trip_id", "stop_sequence", "stop_id"]
_over_models(
    "arrival_delay_minutes",
    lambda m: m.stop_time_schedule_vs_actual.select(*_STOP_KEY, "estimated_arrival_delay_minutes"),
)
_over_models(
    "departure_delay_minutes",
    lambda m: m.stop_time_schedule_vs_actual.select(*_STOP_KEY, "estimated_departure_delay_minutes"),
)
_over_models(
    "estimated_delay_minutes",
    lambda m: m.stop_time_schedule_vs_actual.select(*_STOP_KEY, "estimated_delay_minutes"),
    rounded=(),
)
_over_models(
    "schedule_time_parse_failed",
    lambda m: m.stop_time_schedule_vs_actual.where("schedule_time_parse_failed").select(*_STOP_KEY),
)
_over_models(
    "nearest_service_day_delay",
    lambda m: delay.stop_time_schedule_vs_actual(
        m.realtime_stop_time_updates, m.stg_stop_times, service_day="nearest"
    ).select(*_STOP_KEY, "estimated_delay_minutes"),
    rounded=(),
)

# --- Finding rules ---------------------------------------------------------------------------

for _rule in (
    anomaly.rule_stale_vehicle_timestamp,
    anomaly.rule_missing_gps_coordinate,
    anomaly.rule_implausible_gps_or_speed,
):
    _over_models(
        _rule.__name__, lambda m, rule=_rule: anomaly.evaluate_rules(m.stg_vehicle_positions, [rule()])
    )
for _rule, _input in (
    (anomaly.rule_duplicate_trip_update_entity, "quality_duplicate_trip_update_entities"),
    (anomaly.rule_unmatched_schedule_reference, "quality_realtime_trip_referential_integrity"),
    (anomaly.rule_extreme_delay, "fct_on_time_performance"),
    (anomaly.rule_feed_quality_warning, "fct_feed_quality"),
    (anomaly.rule_feed_freshness, "fct_feed_quality"),
):
    _over_models(
        _rule.__name__,
        lambda m, rule=_rule, source=_input: anomaly.evaluate_rules(m[source], [rule()]),
    )

# --- Detector benchmark ----------------------------------------------------------------------

_over_models("sample_normal", lambda m: evaluation.sample_normal(m.fct_on_time_performance))
_over_models("inject_stale_timestamp", lambda m: evaluation.inject_stale_timestamp(m.stg_vehicle_positions))
_over_models("inject_gps_jump", lambda m: evaluation.inject_gps_jump(m.stg_vehicle_positions))
_over_models("inject_duplicate_label", lambda m: evaluation.inject_duplicate_label(m.stg_trip_updates))
_over_models(
    "inject_unmatched_reference",
    lambda m: evaluation.inject_unmatched_reference(m.stg_trip_updates, m.stg_trips),
)
_over_models("inject_extreme_delay", lambda m: evaluation.inject_extreme_delay(m.fct_on_time_performance))

# --- Assertions ------------------------------------------------------------------------------

_over_models("assert_not_null", lambda m: assertions.assert_not_null(m.stg_vehicle_positions, "trip_id"))
_over_models("assert_unique", lambda m: assertions.assert_unique(m.stg_vehicle_positions, "entity_id"))
_over_models(
    "assert_accepted_values",
    lambda m: assertions.assert_accepted_values(
        m.fct_on_time_performance, "delay_band", (L.BAND_UNAVAILABLE, *L.DELAY_BANDS[:5])
    ),
)
_over_models(
    "assert_unique_key",
    lambda m: assertions.assert_unique_key(m.stg_stop_times, ["trip_id", "stop_sequence"]),
)
_over_models("assert_match_rate", lambda m: assertions.assert_match_rate(m.trip_schedule_vs_actual))
_over_models(
    "assert_score_range", lambda m: assertions.assert_score_range(m.fct_anomaly_findings, high=0.9)
)
_over_models(
    "assert_label_coverage",
    lambda m: assertions.assert_label_coverage(
        m.synthetic_anomaly_evaluation, (*L.EVALUATION_CASES, "unseen_label")
    ),
)
_over_models("assert_recall", lambda m: assertions.assert_recall(m.anomaly_detection_metrics, 1.01))


@_query("source_freshness")
def _(spark, folder):
    """Age of both feeds half an hour after the newest event."""
    models = star_models(spark, folder)
    newest = star_tables.read_table(spark, folder, "events").agg(F.max("ts").alias("ts")).select(
        F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")) + 1800).alias("as_of")
    )
    feeds = {L.VEHICLE_FEED: models.stg_vehicle_positions, L.TRIP_UPDATE_FEED: models.stg_trip_updates}
    rows = [
        assertions.source_freshness(df, newest.scalar()).select(F.lit(feed).alias("feed_type"), "*")
        for feed, df in feeds.items()
    ]
    return rows[0].unionByName(rows[1])



@_query("check_suite")
def _(spark, folder):
    """All declared checks, over layers written once."""
    models = star_models(spark, folder)
    materialize_layers(models, new_scratch_path(spark, "checked"), register_views=False)
    return check_suite(models)


@_query("checks_while_writing")
def _(spark, folder):
    """The same checks, those on rows counted by the tasks that write the layers."""
    models = star_models(spark, folder)
    materialize_layers(models, new_scratch_path(spark, "checked"), register_views=False, checks=CHECKS)
    return check_suite(models)


@_query("unique_finding_ids")
def _(spark, folder):
    """Findings whose ids are told apart where an entity is reported more than once."""
    return anomaly.with_unique_ids(star_models(spark, folder).fct_anomaly_findings).select("anomaly_id", "detector_rule_id")


# --- Reports ---------------------------------------------------------------------------------

for _report, _input in (
    (reports.kpi_snapshots, "fct_feed_quality"),
    (reports.kpi_findings, "fct_anomaly_findings"),
    (reports.kpi_priority_findings, "fct_anomaly_findings"),
    (reports.kpi_avg_plausible_delay, "fct_on_time_performance"),
    (reports.kpi_match_rate, "fct_on_time_performance"),
    (reports.findings_by_type, "fct_anomaly_findings"),
    (reports.feed_status_counts, "fct_feed_quality"),
    (reports.feed_quality_trend, "fct_feed_quality"),
    (reports.feed_quality_avg_rates, "fct_feed_quality"),
    (reports.findings_by_type_severity, "fct_anomaly_findings"),
    (reports.detector_benchmark, "anomaly_detection_metrics"),
    (reports.top_findings, "fct_anomaly_findings"),
    (reports.route_status_counts, "fct_route_realtime_activity"),
    (reports.top_routes, "fct_route_realtime_activity"),
    (reports.on_time_rate, "fct_on_time_performance"),
    (reports.extreme_delay_count, "fct_on_time_performance"),
    (reports.delay_band_counts, "fct_on_time_performance"),
    (reports.headway_status_counts, "fct_headway"),
    (reports.kpi_avg_spacing, "fct_headway"),
    (reports.top_variable_routes, "fct_headway"),
    (reports.snapshot_range_report, "fct_feed_quality"),
):
    _over_models(_report.__name__, lambda m, report=_report, source=_input: report(m[source]))
# Here the largest value is one of averages.
_over_models(
    "top_delayed_routes",
    lambda m: reports.top_delayed_routes(m.fct_on_time_performance),
    rounded=(*ROUNDED, "max_estimated_delay_minutes"),
)
