"""The models, composed lazily: asking for one builds only the plan it needs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from fleetgauge import labels as L
from fleetgauge.operators import activity, anomaly, delay, evaluation, quality, staging
from fleetgauge.operators.assertions import Check, row_metrics
from fleetgauge.sources.snapshots import with_snapshot_date
from fleetgauge.sources.tables import read_days, replace_days, replace_sink


@dataclass
class Models:
    """Raw tables in, every model as an attribute.

    ``raw`` maps the names of the raw tables to DataFrames, or to functions that give them when a
    model asks. ``trip_update_stops`` may hold the stop updates apart from the trip updates; by
    default the trip updates carry them. ``known_snapshots`` (snapshot_folder, snapshot_timestamp_utc) are further
    snapshots, none of the raw tables, that the gaps of these are counted from.
    """

    raw: Mapping[str, DataFrame | Callable[[], DataFrame]]
    max_gap_minutes: float = L.SNAPSHOT_GAP_MINUTES
    service_day: str = "calendar"
    known_snapshots: DataFrame | None = None
    stored: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    measured: dict[str, dict[str, int]] = field(default_factory=dict, repr=False)
    _opened: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            source = self.raw[name]
            self._opened[name] = source if isinstance(source, DataFrame) else source()
        return self._opened[name]

    def __getitem__(self, name: str) -> DataFrame:
        """A raw table or model by name; stored models are read, the others composed."""
        if name in self.raw:
            return self.table(name)
        return self.stored[name] if name in self.stored else getattr(self, name)

    @cached_property
    def stg_routes(self) -> DataFrame:
        return staging.stg_routes(self.table("routes"))

    @cached_property
    def stg_trips(self) -> DataFrame:
        return staging.stg_trips(self.table("trips"))

    @cached_property
    def stg_stops(self) -> DataFrame:
        return staging.stg_stops(self.table("stops"))

    @cached_property
    def stg_stop_times(self) -> DataFrame:
        return staging.stg_stop_times(self.table("stop_times"))

    @cached_property
    def stg_vehicle_positions(self) -> DataFrame:
        return staging.stg_vehicle_positions(self.table("vehicle_positions"))

    @cached_property
    def stg_trip_updates(self) -> DataFrame:
        return staging.stg_trip_updates(self.table("trip_updates"))

    @property
    def realtime_stop_time_updates(self) -> DataFrame:
        holder = "trip_update_stops" if "trip_update_stops" in self.raw else "trip_updates"
        return delay.realtime_stop_time_updates(staging.stg_trip_updates(self.table(holder)))

    @property
    def scheduled_stop_times_normalized(self) -> DataFrame:
        return delay.scheduled_stop_times_normalized(
            self.stg_stop_times, self["realtime_stop_time_updates"]
        )

    @property
    def stop_time_schedule_vs_actual(self) -> DataFrame:
        schedule = self.stored.get("scheduled_stop_times_normalized", self.stg_stop_times)
        return delay.stop_time_schedule_vs_actual(
            self["realtime_stop_time_updates"], schedule, service_day=self.service_day
        )

    @property
    def trip_schedule_vs_actual(self) -> DataFrame:
        return delay.trip_schedule_vs_actual(self.stg_trip_updates, self.stg_trips)

    @property
    def quality_null_gps(self) -> DataFrame:
        return quality.quality_null_gps(self.stg_vehicle_positions)

    @property
    def quality_duplicate_vehicle_entities(self) -> DataFrame:
        return quality.quality_duplicate_entities(self.stg_vehicle_positions)

    @property
    def quality_duplicate_trip_update_entities(self) -> DataFrame:
        return quality.quality_duplicate_entities(self.stg_trip_updates)

    @property
    def quality_realtime_trip_referential_integrity(self) -> DataFrame:
        return quality.quality_realtime_trip_referential_integrity(
            self.stg_vehicle_positions, self.stg_trip_updates, self.stg_trips
        )

    @property
    def quality_snapshot_freshness(self) -> DataFrame:
        return quality.quality_snapshot_freshness(
            self.stg_vehicle_positions, self.stg_trip_updates, max_gap_minutes=self.max_gap_minutes
        )

    @cached_property
    def _snapshot_keys(self) -> DataFrame:
        return quality.snapshot_keys(self.stg_vehicle_positions, self.stg_trip_updates, self.stg_trips)

    @property
    def feed_quality_summary(self) -> DataFrame:
        return quality.summarize_keys(
            self["_snapshot_keys"], max_gap_minutes=self.max_gap_minutes, known=self.known_snapshots
        )

    @property
    def dim_route(self) -> DataFrame:
        return activity.dim_route(self.stg_routes)

    @property
    def dim_stop(self) -> DataFrame:
        return activity.dim_stop(self.stg_stops)

    @property
    def fct_feed_quality(self) -> DataFrame:
        return quality.fct_feed_quality(self["feed_quality_summary"])

    @property
    def fct_route_realtime_activity(self) -> DataFrame:
        return activity.fct_route_realtime_activity(self.stg_vehicle_positions, self.stg_trip_updates)

    @property
    def fct_on_time_performance(self) -> DataFrame:
        return delay.fct_on_time_performance(
            self.stg_trip_updates, self.stg_trips, self["stop_time_schedule_vs_actual"]
        )

    @property
    def fct_headway(self) -> DataFrame:
        return activity.fct_headway(self.stg_vehicle_positions)

    @property
    def fct_anomaly_findings(self) -> DataFrame:
        on_keys = quality.key_issues(self["_snapshot_keys"])
        return anomaly.fct_anomaly_findings(
            self.stg_vehicle_positions,
            on_keys,
            on_keys,
            self["fct_on_time_performance"],
            self["fct_feed_quality"],
        )

    @property
    def synthetic_anomaly_evaluation(self) -> DataFrame:
        return evaluation.synthetic_anomaly_evaluation(
            self["fct_on_time_performance"],
            self.stg_vehicle_positions,
            self.stg_trip_updates,
            self.stg_trips,
        )

    @property
    def rule_based_anomaly_detection(self) -> DataFrame:
        return evaluation.rule_based_anomaly_detection(self["synthetic_anomaly_evaluation"])

    @property
    def anomaly_detection_metrics(self) -> DataFrame:
        return evaluation.anomaly_detection_metrics(self["rule_based_anomaly_detection"])


# Models that several others read are written once; the rest are views.
VIEWS = (
    "stg_routes",
    "stg_trips",
    "stg_stops",
    "stg_stop_times",
    "stg_vehicle_positions",
    "stg_trip_updates",
    "trip_schedule_vs_actual",
    "quality_null_gps",
    "quality_duplicate_vehicle_entities",
    "quality_duplicate_trip_update_entities",
    "quality_realtime_trip_referential_integrity",
    "quality_snapshot_freshness",
    "feed_quality_summary",
)
# In the order they are written: each one reads the stored ones before it.
TABLES = (
    "realtime_stop_time_updates",
    "scheduled_stop_times_normalized",
    "stop_time_schedule_vs_actual",
    "dim_route",
    "dim_stop",
    "fct_on_time_performance",
    "fct_feed_quality",
    "fct_route_realtime_activity",
    "fct_headway",
    "fct_anomaly_findings",
    "synthetic_anomaly_evaluation",
    "rule_based_anomaly_detection",
    "anomaly_detection_metrics",
)
_WITHOUT_SNAPSHOT = (
    "scheduled_stop_times_normalized",
    "dim_route",
    "dim_stop",
    "anomaly_detection_metrics",
    # Small samples: a partition each day would be a file for a handful of rows.
    "synthetic_anomaly_evaluation",
    "rule_based_anomaly_detection",
)


# Two marts read the keys of the snapshots; both written in one run, they share one pass over the feeds.
_READ_KEYS = {"fct_feed_quality", "fct_anomaly_findings"}


def store_keys(models: Models, folder: str) -> None:
    """The keys as an unlisted table below ``folder``, which no mart name can take."""
    keys, path = models._snapshot_keys, f"{folder}/_snapshot_keys"
    replace_sink(keys, path, as_path=True)
    models.stored["_snapshot_keys"] = keys.sparkSession.read.schema(keys.schema).parquet(path)


def materialize_layers(
    models: Models,
    folder: str,
    tables: Iterable[str] = TABLES,
    *,
    days: Iterable[str] | None = None,
    register_views: bool = True,
    checks: Mapping[str, Iterable[Check]] | None = None,
) -> dict[str, int]:
    """Write the tables as parquet below ``folder`` and return their row counts.

    Snapshot tables are partitioned by day, so that a range of snapshots opens only its days.
    Each written table then stands in for its plan, which later models would else repeat.

    With ``days`` only these days of the snapshot tables are replaced, each table at once, and all others stay, so that a
    long capture is built piece by piece; ``read_days`` reads such tables. The gap of a day's first snapshot ends at the last one of the day
    before: let ``models`` cover that day too, as ``open_days`` reads it. Tables without snapshots
    are replaced by what ``models`` has.

    ``checks`` by table: those that look at one row at a time are counted by the writing tasks, into
    ``models.measured``, so ``check_suite`` need not read the tables for them.
    """
    wanted = set(tables)
    days = None if days is None else set(days)
    counts: dict[str, int] = {}
    for name in TABLES:
        if name not in wanted:
            continue
        if name in _READ_KEYS and _READ_KEYS <= wanted and not _READ_KEYS & counts.keys():
            store_keys(models, folder.rstrip("/"))
        df, partition_by = models[name], ()
        if name not in _WITHOUT_SNAPSHOT:
            df, partition_by = with_snapshot_date(df), ("snapshot_date",)
        path = f"{folder.rstrip('/')}/{name}"
        metrics = row_metrics((checks or {}).get(name, ()))
        observed = {"metrics": metrics, "measured": models.measured.setdefault(name, {})} if metrics else {}
        if partition_by and days is not None:
            counts[name] = replace_days(df, path, days, **observed)
        else:
            counts[name] = replace_sink(df, path, as_path=True, partition_by=partition_by, **observed)
        if partition_by and days is not None:
            stored = read_days(df.sparkSession, path, df.schema, days)
        else:
            stored = df.sparkSession.read.schema(df.schema).parquet(path)
        models.stored[name] = stored.drop("snapshot_date")
        if name == "fct_feed_quality" and days is None:
            # The mart keeps the summary as it is; the view need not go over both feeds again.
            models.stored["feed_quality_summary"] = quality.summary_of_mart(models.stored[name])
    if register_views:
        for name in (*VIEWS, *counts):
            models[name].createOrReplaceTempView(name)
    return counts
